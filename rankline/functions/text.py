"""Cell cleaning, number parsing and field splitting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters treated as white space, and the full-width digits.
WHITESPACE = " \t\n\r\x0b\x0c                　"
WIDE_DIGITS = "０１２３４５６７８９"
# Tokens that are categories or requirements, never school names.
NOT_A_SCHOOL = ("普通类", "少数民族预科班", "不限", "无", "历史类", "物理类", "综合改革")
# Fixed value: prefix of a source that came from text recognition.
RECOGNISED_PREFIX = "ocr_experimental:"
TRUE_WORDS = ("1", "true", "yes", "y", "是", "t")

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold(c: Column) -> Column:
    """Case folding of ASCII letters only, as prefix matches and keyword searches do."""
    return F.translate(c, _UPPER, _LOWER)


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def squeeze(c: Column) -> Column:
    """Remove all white space."""
    return F.translate(c, WHITESPACE, "")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def text_or_null(c: Column) -> Column:
    """Stripped text, null when nothing is left."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def missing_to_null(c: Column) -> Column:
    """Null for blank text; other text is returned unchanged."""
    return F.when(strip(c) != "", c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def number(c: Column) -> Column:
    """Double of a whole numeric text, null for anything else (also inf and nan)."""
    t = strip(F.translate(c, WIDE_DIGITS, "0123456789"))
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def to_int(c: Column) -> Column:
    """Integer by truncation toward zero; thousands separators are not numbers."""
    return number(c.cast("string")).try_cast("int")


def _leading_number(c: Column) -> Column:
    head = F.regexp_extract(F.translate(c, WIDE_DIGITS, "0123456789"), r"^[^\n(（]*", 0)
    return number(F.regexp_extract(head, r"[0-9.]+", 0))


def to_float(c: Column) -> Column:
    """First number before a line break or bracket (its sign is not part of it), else the whole text."""
    t = strip(c.cast("string"))
    return F.coalesce(_leading_number(t), number(t))


def digits_only(c: Column) -> Column:
    """Number left after dropping everything but digits, dot and minus."""
    return number(F.regexp_replace(F.translate(c.cast("string"), WIDE_DIGITS, "0123456789"), r"[^0-9.\-]", ""))


def score_cell(c: Column) -> Column:
    t = strip(c.cast("string"))
    return F.coalesce(_leading_number(t), digits_only(t))


def header_text(c: Column) -> Column:
    """Header cell without breaks, white space and full-width brackets."""
    return squeeze(F.translate(F.coalesce(c, F.lit("")), "（）", "()"))


def school_name(c: Column) -> Column:
    return squeeze(F.translate(text_or_empty(c), "（）", "()"))


def school_name_or_null(c: Column) -> Column:
    return F.nullif(school_name(c), F.lit(""))


def valid_school_name(c: Column) -> Column:
    """At least two characters, one of them CJK, and not a category token.

    A text with a CJK character is neither all digits nor all punctuation, so those
    two rules need no test of their own.
    """
    t = text_or_empty(c)
    return (F.length(t) > 1) & ~t.isin(*NOT_A_SCHOOL) & t.rlike("[一-鿿]")


def invalid_school_name(c: Column) -> Column:
    """True only for text that is present and not a valid name."""
    return (text_or_empty(c) != "") & ~valid_school_name(c)


_CODE_AND_NAME = r"(?U)^([A-Za-z]\d{3,4})(.+)$"
_CODE_AND_MAJOR = r"(?U)^(\d{1,3})(\S.+)$"


def with_split_school(df: DataFrame, code: str, name: str, out_code: str, out_name: str) -> DataFrame:
    """Add code and name after taking fields such as A001北京大学 apart.

    Done in projections that each read the columns of the one before, so that every pattern runs
    once per row instead of once per place it is used in.
    """
    df = df.withColumns({"_c": text_or_null(F.col(code)), "_n": text_or_null(F.col(name))})
    df = df.withColumns({
        "_c_tail": strip(F.regexp_extract("_c", _CODE_AND_NAME, 2)), "_c_head": F.regexp_extract("_c", _CODE_AND_NAME, 1),
        "_n_tail": strip(F.regexp_extract("_n", _CODE_AND_NAME, 2)), "_n_head": F.regexp_extract("_n", _CODE_AND_NAME, 1),
    })
    c, n = F.col("_c"), F.col("_n")
    keep = valid_school_name(n) & c.isNotNull() & (F.coalesce("_c_head", F.lit("")) == "")
    df = df.withColumn(
        "_how",
        F.when(keep, 0).when(valid_school_name(F.col("_c_tail")), 1).when(valid_school_name(F.col("_n_tail")), 2).otherwise(0),
    )
    picked = F.when(F.col("_how") == 1, F.col("_c_tail")).when(F.col("_how") == 2, F.col("_n_tail")).otherwise(n)
    return df.withColumns({
        out_code: F.when(F.col("_how") == 1, F.col("_c_head")).when(F.col("_how") == 2, F.col("_n_head")).otherwise(c),
        out_name: school_name_or_null(picked),
    }).drop("_c", "_n", "_c_tail", "_c_head", "_n_tail", "_n_head", "_how")


def split_major(code: Column, name: Column) -> tuple[Column, Column]:
    """(code, name) after taking fields such as 17文科试验班类 apart."""
    c, n = text_or_null(code), text_or_null(name)
    in_code = F.coalesce(c.rlike(_CODE_AND_MAJOR), F.lit(False))
    in_name = F.coalesce(n.rlike(_CODE_AND_MAJOR), F.lit(False))
    source = F.when(in_code, c).when(in_name, n)
    found = in_code | in_name
    return (
        F.when(found, F.regexp_extract(source, _CODE_AND_MAJOR, 1)).otherwise(c),
        F.when(found, strip(F.regexp_extract(source, _CODE_AND_MAJOR, 2))).otherwise(n),
    )


_GROUP_ORDINAL = r"(?U)^(.+?)(第\d+组)$"
_GROUP_PLAIN = r"(?U)^(.+?)([A-Za-z]?\d+组)$"


def split_group(c: Column) -> tuple[Column, Column]:
    """(school, group) of names such as 武汉大学第01组; the group is '' when there is none."""
    t = text_or_empty(c)
    school = (
        F.when(t.rlike(_GROUP_ORDINAL), strip(F.regexp_extract(t, _GROUP_ORDINAL, 1)))
        .when(t.rlike(_GROUP_PLAIN), strip(F.regexp_extract(t, _GROUP_PLAIN, 1)))
        .otherwise(t)
    )
    group = (
        F.when(t.rlike(_GROUP_ORDINAL), F.regexp_extract(t, _GROUP_ORDINAL, 2))
        .when(t.rlike(_GROUP_PLAIN), F.regexp_extract(t, _GROUP_PLAIN, 2))
        .otherwise(F.lit(""))
    )
    return school, group


_LINE = r"(?U)^([A-Z]\d{3,})\s+(.+?)\s+([一-鿿]{1,4})\s+(\d{3,})(.*)$"
_LINE_NOTE = r"(?U)([一-鿿][一-鿿\w（）()·]{1,30})$"


def row_line(c: Column) -> Column:
    """Struct of code, name, group, score and notes of one recognised text line, null if it is no data line."""
    t = text_or_empty(c)
    score = F.regexp_extract(t, _LINE, 4).try_cast("double")
    name = strip(F.regexp_extract(t, _LINE, 2))
    school, group = split_group(name)
    requirement = F.regexp_extract(t, _LINE, 3)
    note = F.nullif(F.regexp_extract(strip(F.regexp_extract(t, _LINE, 5)), _LINE_NOTE, 1), F.lit(""))
    notes = F.concat_ws(
        "；",
        F.when(~requirement.isin("不限", "无"), F.concat(F.lit("再选:"), requirement)),
        note,
    )
    return F.when(
        t.rlike(_LINE) & (score >= 100),
        F.struct(
            F.regexp_extract(t, _LINE, 1).alias("school_code"),
            F.coalesce(F.nullif(school, F.lit("")), name).alias("school_name"),
            F.nullif(group, F.lit("")).alias("major_group"),
            score.alias("min_score"),
            F.nullif(notes, F.lit("")).alias("notes"),
        ),
    )


def first_number(c: Column) -> Column:
    """First run of digits and dots anywhere in the text."""
    return number(F.regexp_extract(F.translate(c, WIDE_DIGITS, "0123456789"), r"[0-9.]+", 0))


def flag(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)).isin(*TRUE_WORDS), F.lit(False))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def file_suffix(path: Column) -> Column:
    """Lower-case extension with its dot, '' when there is none."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1))


def file_stem(path: Column) -> Column:
    name = file_name(path)
    return F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)).otherwise(name)


def _digits_key(d: Column) -> Column:
    # Length then text of the zero-stripped digits orders numbers of any size.
    bare = F.ltrim(d, F.lit("0"))
    return F.struct(F.length(bare).alias("n"), bare.alias("d"))


def natural_key(path: Column) -> Column:
    """Sortable struct: all-digit stems by value first, then digit and text runs, case folded."""
    stem = file_stem(path)
    all_digits = stem.rlike(r"^[0-9]+$")
    runs = F.transform(
        F.regexp_extract_all(stem, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1)),
        lambda r: F.struct(
            F.when(r.rlike(r"^[0-9]"), 0).otherwise(1).alias("kind"),
            F.when(r.rlike(r"^[0-9]"), _digits_key(r)).alias("value"),
            F.when(~r.rlike(r"^[0-9]"), F.lower(r)).alias("text"),
        ),
    )
    return F.struct(
        F.when(all_digits, 0).otherwise(1).alias("kind"),
        F.when(all_digits, _digits_key(stem)).alias("value"),
        F.when(~all_digits, runs).alias("runs"),
        file_suffix(path).alias("suffix"),
        F.lower(file_name(path)).alias("name"),
    )


def content_key(c: Column) -> Column:
    return F.sha2(c, 256)


def box_centre(box: Column) -> Column:
    """Mean point of a polygon given as array of [x, y]; (0, 0) without points."""
    points = F.filter(F.coalesce(box, F.array().cast("array<array<double>>")), lambda p: F.size(p) >= 2)
    n = F.size(points)

    def mean(i: int) -> Column:
        total = F.aggregate(points, F.lit(0.0), lambda acc, p: acc + F.get(p, i))
        return F.when(n > 0, total / n).otherwise(F.lit(0.0))

    return F.struct(mean(0).alias("x_center"), mean(1).alias("y_center"))


def corner_centre(box: Column) -> Column:
    """Centre of a box given as [left, top, right, bottom]."""
    return F.struct(
        ((F.get(box, 0) + F.get(box, 2)) / 2).alias("x_center"),
        ((F.get(box, 1) + F.get(box, 3)) / 2).alias("y_center"),
    )


def is_recognised_source(url: Column) -> Column:
    return F.coalesce(F.startswith(url, F.lit(RECOGNISED_PREFIX)), F.lit(False))


def year_in_path(path: Column) -> Column:
    """First path part that is a four-digit year."""
    return F.regexp_extract(path, r"(?:^|/)([0-9]{4})(?:/|$)", 1).try_cast("int")


def query_mode(score_null_rate: Column, rank_null_rate: Column) -> Column:
    return (
        F.when(score_null_rate < 0.2, "score")
        .when((rank_null_rate < 0.2) & (score_null_rate >= 0.8), "rank")
        .otherwise("mixed")
    )
