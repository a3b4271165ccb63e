"""Typed rows to the standard schema, one projection per record type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import school_name_or_null, split_major, text_or_empty, text_or_null, to_float, to_int, with_split_school
from .dictionary import Group, by_distinct
from .settle import settled

SCHOOL = (
    "year", "province", "subject_type", "admission_category", "batch", "school_code", "school_name", "major_group",
    "min_score", "min_rank", "tie_breaker_text", "plan_count",
)
RANK = ("year", "province", "subject_type", "score", "same_score_count", "cumulative_count")
CONTROL = ("year", "province", "subject_type", "batch", "score")
MAJOR = ("year", "province", "subject_type", "school_name", "major_name", "min_score", "min_rank")

Default = str | int | Column | None


def _as_column(value: Default) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def project(df: DataFrame, columns, keep=()) -> DataFrame:
    """The standard columns, missing ones as null text."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def defaulted(
    df: DataFrame, columns, year: Default = None, province: Default = None, subject_type: Default = None,
    legacy: Column | None = None, keep=(),
) -> DataFrame:
    """Standard columns with year and province filled, and province and subject in standard form.

    A subject default only counts when the input has no subject column.
    """
    out = project(df, columns, [*keep, *[c for c in df.columns if c not in columns and c not in keep]])
    subject = F.col("subject_type") if "subject_type" in df.columns else _as_column(subject_type).cast("string")
    place = F.coalesce(text_or_null(F.col("province")), _as_column(province).cast("string"))
    when = to_int(F.col("year")) if year is None else F.coalesce(to_int(F.col("year")), F.when(text_or_empty(F.col("year")) == "", _as_column(year)))
    return out.withColumns({
        "year": when.cast("int"), "province": rules.province_name(place), "subject_type": rules.subject_name(subject, legacy),
    })


def _by_text(df: DataFrame, columns, options: dict[str, Default], evaluate, *more: Group, keep=()) -> DataFrame:
    """``df`` with year, province, subject and the like worked out once per combination of their texts, by ``evaluate(table, options)``, and the results of ``more`` groups.

    An option that is a column is a text like the others; a plain value goes to the rules as it is.
    """
    given = {k: f"_{k}" for k, v in options.items() if isinstance(v, Column)}
    work = project(df, [c for c in columns if c not in keep], [*keep, *[c for c in df.columns if c not in columns and c not in keep]])
    work = work.withColumns({name: options[k].cast("string") for k, name in given.items()})
    plain = {k: F.col(given[k]) if k in given else v for k, v in options.items()}
    inputs = [c for c in ("year", "province", "subject_type", "admission_category", "batch") if c in columns]
    return by_distinct(work, [Group((*inputs, *given.values()), lambda table: evaluate(table, plain)), *more]).drop(*given.values())


def _standing(table: DataFrame, options: dict[str, Default], has_subject: bool) -> dict[str, Column]:
    """Year, province and subject of a table of texts."""
    legacy = options.get("legacy")
    subject = F.col("subject_type") if has_subject else _as_column(options.get("subject_type")).cast("string")
    place = F.coalesce(text_or_null(F.col("province")), _as_column(options.get("province")).cast("string"))
    year = options.get("year")
    when = to_int(F.col("year")) if year is None else F.coalesce(to_int(F.col("year")), F.when(text_or_empty(F.col("year")) == "", _as_column(year)))
    return {"year": when.cast("int"), "province": rules.province_name(place), "subject_type": rules.subject_name(subject, None if legacy is None else legacy.cast("boolean"))}


def _whole(column: str) -> Group:
    return Group((column,), lambda table: table.select(column, to_int(F.col(column)).alias(f"_{column}")))


def normalize_school(
    df: DataFrame, year: Default = None, province: Default = None, subject_type: Default = None,
    admission_category: Default = None, batch: Default = None, legacy: Column | None = None, keep=(),
) -> DataFrame:
    options = {"year": year, "province": province, "subject_type": subject_type, "admission_category": admission_category, "batch": batch, "legacy": legacy}
    has_subject = "subject_type" in df.columns

    def standing(table: DataFrame, options: dict[str, Default]) -> DataFrame:
        def given(column: str) -> Column:
            # A given value replaces the column for every row.
            return F.coalesce(text_or_null(_as_column(options[column]).cast("string")), text_or_null(F.col(column)))

        found = _standing(table, options, has_subject) | {
            "admission_category": F.coalesce(F.nullif(rules.category_name(given("admission_category")), F.lit("")), F.lit(rules.DEFAULT_CATEGORY)),
            "batch": F.coalesce(F.nullif(rules.school_batch_name(given("batch")), F.lit("")), F.lit(rules.DEFAULT_BATCH)),
        }
        return table.select("*", *[c.alias(f"_{name}") for name, c in found.items()])

    def majors(table: DataFrame) -> DataFrame:
        code, name = split_major(F.col("major_code"), F.col("major_name"))
        return table.select("major_code", "major_name", F.nullif(F.concat_ws("-", code, name), F.lit("")).alias("_major"))

    scores = Group(("min_score",), lambda table: table.select("min_score", to_float(F.col("min_score")).alias("_min_score")))
    more = [Group(("major_code", "major_name"), majors), scores, _whole("min_rank"), _whole("plan_count")]
    work = _by_text(df, (*SCHOOL, "major_code", "major_name"), options, standing, *more, keep=keep)
    # Pairs of code and name grow with the schools: a table of them outgrows a broadcast, and its join shuffles every row. They are read row by row.
    kept = [*keep, *[f"_{c}" for c in ("year", "province", "subject_type", "admission_category", "batch", "major", "min_score", "min_rank", "plan_count")], "major_group", "tie_breaker_text"]
    work = work.withColumns({"_given_code": F.col("school_code").cast("string"), "_raw": school_name_or_null(F.col("school_name").cast("string"))})
    split = with_split_school(work, "_given_code", "_raw", "_code", "_name")
    # A row with a name and no code: the name becomes the code and the name is empty.
    work = settled(split, [F.coalesce("_code", "_name").alias("_school_code"), F.when(F.col("_code").isNotNull(), F.col("_name")).alias("_school_name")], keep=kept)
    group = F.coalesce(text_or_null(F.col("major_group")), F.col("_major"))
    special = group.isNotNull() & F.col("_admission_category").isin("艺术类", "体育类")
    unnamed = F.col("_school_name").isNull() | (F.col("_school_name") == F.col("_school_code"))
    out = {c: F.col(f"_{c}") for c in ("year", "province", "subject_type", "admission_category", "batch", "school_code", "min_score", "min_rank", "plan_count")}
    out |= {"major_group": group, "school_name": F.when(special & unnamed, group).otherwise(F.col("_school_name")), "tie_breaker_text": text_or_null(F.col("tie_breaker_text"))}
    return work.select(*keep, *[out[c].alias(c) for c in SCHOOL])


def _normalize(df: DataFrame, columns, options: dict[str, Default], rest: dict[str, Column], keep, batch: Column | None = None) -> DataFrame:
    """Year, province, subject (and batch) by their texts, the other columns by ``rest``, row by row."""
    has_subject = "subject_type" in df.columns

    def standing(table: DataFrame, options: dict[str, Default]) -> DataFrame:
        found = _standing(table, options, has_subject) | ({"batch": batch} if batch is not None else {})
        return table.select("*", *[c.alias(f"_{name}") for name, c in found.items()])

    work = _by_text(df, columns, options, standing, keep=keep)
    out = {c: F.col(f"_{c}") for c in ("year", "province", "subject_type", *(["batch"] if batch is not None else []))} | rest
    return work.select(*keep, *[out[c].alias(c) for c in columns])


def normalize_rank(df: DataFrame, year: Default = None, province: Default = None, subject_type: Default = None, keep=()) -> DataFrame:
    options = {"year": year, "province": province, "subject_type": subject_type}
    return _normalize(df, RANK, options, {c: to_int(F.col(c)) for c in RANK[3:]}, keep)


def normalize_control(df: DataFrame, year: Default = None, province: Default = None, subject_type: Default = None, keep=()) -> DataFrame:
    options = {"year": year, "province": province, "subject_type": subject_type}
    batch = F.nullif(rules.batch_name(text_or_null(F.col("batch"))), F.lit(""))
    return _normalize(df, CONTROL, options, {"score": to_int(F.col("score"))}, keep, batch)


def normalize_major(df: DataFrame, year: Default = None, province: Default = None, subject_type: Default = None, keep=()) -> DataFrame:
    options = {"year": year, "province": province, "subject_type": subject_type}
    return _normalize(df, MAJOR, options, {
        "school_name": school_name_or_null(F.col("school_name")), "major_name": text_or_null(F.col("major_name")), "min_score": to_int(F.col("min_score")), "min_rank": to_int(F.col("min_rank")),
    }, keep)


NORMALIZERS = {"school": normalize_school, "rank": normalize_rank, "control": normalize_control, "major": normalize_major}


def normalize(df: DataFrame, record_type: str, **options) -> DataFrame:
    if record_type not in NORMALIZERS:
        raise ValueError(f"unknown record type: {record_type}")
    return NORMALIZERS[record_type](df, **options)


# Default subject and subject mode per province.
PROVINCE_DEFAULTS = (
    ("江苏", "jiangsu", "", "new"), ("浙江", "zhejiang", "综合改革", "comprehensive"), ("山东", "shandong", "综合改革", "comprehensive"),
    ("河南", "henan", "", "legacy"), ("广东", "guangdong", "", "new"), ("福建", "fujian", "", "new"), ("河北", "hebei", "", "new"),
    ("湖北", "hubei", "", "new"), ("湖南", "hunan", "", "new"), ("辽宁", "liaoning", "", "new"), ("重庆", "chongqing", "", "new"),
)


def with_province_defaults(df: DataFrame) -> DataFrame:
    """Standard province, its default subject where the row has none, and whether it uses the old subject names."""
    name = rules.province_name(F.col("province"))
    subject = rules.labelled(name, {p: s for p, _, s, _ in PROVINCE_DEFAULTS if s}, F.lit(None).cast("string"))
    legacy = name.isin(*[p for p, _, _, mode in PROVINCE_DEFAULTS if mode == "legacy"])
    return df.withColumns({
        "province": name, "subject_type": F.coalesce(text_or_null(F.col("subject_type")), subject), "legacy": legacy,
    })


def enrich_for_load(df: DataFrame, record_type: str, source_url: Default = None) -> DataFrame:
    """Source and the defaults the load needs: category, batch, codes from names."""
    out = df.withColumn("source_url", _as_column(source_url).cast("string"))

    def filled(column: str, other: Column) -> Column:
        own = F.col(column) if column in df.columns else F.lit(None).cast("string")
        return F.coalesce(F.nullif(own, F.lit("")), other)

    if record_type == "school":
        return out.withColumns({
            "admission_category": filled("admission_category", F.lit(rules.DEFAULT_CATEGORY)),
            "batch": filled("batch", F.lit(rules.DEFAULT_BATCH)), "school_code": filled("school_code", F.col("school_name")),
        })
    if record_type == "major":
        return out.withColumns({
            "batch": filled("batch", F.lit(rules.DEFAULT_BATCH)), "school_code": filled("school_code", F.col("school_name")),
            "major_code": filled("major_code", F.col("major_name")),
        })
    return out
