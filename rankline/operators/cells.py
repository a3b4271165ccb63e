"""Raw cell grids to typed rows.

Input is one long table of cells for all files: the sheet keys, ``row_idx``, ``col_idx``, ``value``
(all text). A sheet key is any list of columns, for example (file_id,) or (file_id, sheet).
Nothing here gathers a sheet: every step is a partial aggregate by row or column of a sheet, or an
equality join with one row per sheet or per header cell.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import digits_only, header_text, school_name, score_cell, strip, text_or_empty
from ..session import written
from .dictionary import Group, by_distinct
from .settle import settled

# Words that mark a header row, note rows and school sheets, and the column aliases, in order.
HEADER_WORDS = (
    "院校", "院校代号", "院校名称", "专业组", "专业组代码", "专业代码", "专业名称", "投档最低分", "投档最低分同分考生排序项", "辅助排序分",
    "分数线", "位次", "名次号", "最低位次", "分数", "人数", "累计人数",
)
NOTE_WORDS = ("说明", "备注", "注：", "注:", "合计", "总计", "单位：", "单位:")
SCHOOL_HEADER_WORDS = ("院校代号", "院校名称", "院校代码", "学校代号", "专业组", "专业代码", "专业名称", "投档最低分", "分数线")
ALIASES = {
    "year": ("年份", "year", "年度"),
    "province": ("省份", "province", "省市"),
    "school_name": ("院校名称", "学校名称", "school_name", "院校"),
    "school_code": ("院校代号", "院校代码", "学校代码", "school_code", "代号"),
    "major_name": ("专业名称", "major_name", "专业"),
    "major_code": ("专业代号", "major_code", "专业代码"),
    "subject_type": ("科类", "选科", "subject_type", "科目类别"),
    "batch": ("批次", "batch", "录取批次"),
    "major_group": ("专业组", "专业组代码", "major_group", "院校专业组", "院校专业组代号", "院校专业组名称"),
    "min_score": ("最低分", "投档分", "投档最低分", "分数线", "投档分数线", "min_score", "最低投档分", "投档线"),
    "tie_breaker_text": ("投档最低分同分考生排序项", "同分排序", "辅助排序分", "同分考生排序项"),
    "avg_score": ("平均分", "avg_score"),
    "max_score": ("最高分", "max_score"),
    "min_rank": ("最低位次", "位次", "名次号", "min_rank", "排名", "投档最低位次", "最低投档位次", "排位"),
    "plan_count": ("计划数", "招生人数", "招生计划", "投档计划数", "plan_count"),
    "score": ("分数", "score", "控制线", "成绩", "分值"),
    "same_score_count": ("同分人数", "same_score_count", "人数", "本段人数"),
    "cumulative_count": ("累计人数", "cumulative_count", "累计"),
}
TYPE_ALIASES = {
    "school": {
        "school_code": ("院校代号", "院校代码", "学校代码", "学校代号", "代号"),
        "school_name": ("院校名称", "院校", "学校名称", "院校代号及名称", "院校、专业组名称及选科要求", "名称及选科要求"),
        "major_code": ("专业代号", "专业代码"),
        "major_name": ("专业名称", "专业", "专业代号及名称"),
        "major_group": ("专业组代码", "院校专业组代号", "院校专业组", "专业组", "院校、专业组", "院校专业组名称"),
        "min_score": ("投档最低分", "最低投档分", "最低分", "投档分", "分数线", "投档分数线", "投档线"),
        "tie_breaker_text": ("投档最低分同分考生排序项", "同分排序", "辅助排序分", "同分考生排序项"),
        "min_rank": ("位次", "最低位次", "投档最低排位", "投档最低位次", "最低投档位次", "排名", "名次号", "排位"),
        "plan_count": ("计划数", "招生计划", "招生人数", "投档计划数", "计划人数"),
        "subject_type": ("科类", "类别", "选科", "科目类别"),
    },
    "rank": {"score": ("分数", "成绩", "分值"), "same_score_count": ("人数", "本段人数", "同分人数"), "cumulative_count": ("累计人数", "累计", "累计数")},
    "control": {"batch": ("批次", "录取批次"), "score": ("分数线", "控制线", "分数", "录取控制分数线"), "subject_type": ("科类", "科目类别", "选科")},
    "major": {
        "school_code": ("院校代号", "院校代码", "学校代码"), "school_name": ("院校名称", "院校", "学校名称"), "major_name": ("专业名称", "专业"),
        "major_code": ("专业代号", "专业代码"), "major_group": ("专业组代码", "专业组"), "min_score": ("投档最低分", "最低分", "最低投档分"),
        "min_rank": ("位次", "最低位次"),
    },
}
DEFAULT_BATCHES = {"school": "本科批", "major": "本科批"}
SCORE_COLUMNS = ("min_score", "score", "avg_score", "max_score")
COUNT_COLUMNS = ("min_rank", "plan_count", "same_score_count", "cumulative_count")
HEADER_SCAN_ROWS = 30
SUBJECT_WORDS = ("历史", "物理", "文科", "理科", "综合改革")
RANK_BLOCKS = (("历史等科目类", "历史类"), ("历史类", "历史类"), ("物理等科目类", "物理类"), ("物理类", "物理类"))


def aliases_for(record_type: str | None) -> dict[str, tuple[str, ...]]:
    """General aliases, then those of the record type, without repeats."""
    own = TYPE_ALIASES.get(record_type or "", {})
    return {name: tuple(dict.fromkeys((*words, *own.get(name, ())))) for name, words in ALIASES.items()}


def _on(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    return df.join(other, list(keys), how)


def _word_counts(cells: DataFrame, sheet: Sequence[str], scan_rows: int, **flags: Column) -> DataFrame:
    """Rows among the first of a sheet with their number of header words, and flags of their cells (true if one cell has it). All bits of a row are one number."""
    bits = [F.contains("value", F.lit(w)) for w in HEADER_WORDS] + list(flags.values())
    mask = sum((F.when(b, F.lit(1 << i)).otherwise(0) for i, b in enumerate(bits[1:], 1)), F.when(bits[0], F.lit(1)).otherwise(0))
    rows = cells.where(F.col("row_idx") < scan_rows).groupBy(*sheet, "row_idx").agg(F.bit_or(mask).alias("mask"))
    words = len(HEADER_WORDS)
    told = [(F.col("mask").bitwiseAND(F.lit(1 << (words + i))) != 0).alias(name) for i, name in enumerate(flags)]
    return rows.select(*sheet, "row_idx", F.bit_count(F.col("mask").bitwiseAND(F.lit((1 << words) - 1))).alias("hits"), *told)


def header_rows(cells: DataFrame, sheet: Sequence[str], scan_rows: int = HEADER_SCAN_ROWS) -> DataFrame:
    """Header row per sheet: most header words among the first rows; the first row wins ties, row 0 if none.

    The words hold no blanks, so a word is in the joined row text exactly when it is in a cell;
    one bit per word and row replaces the text.
    """
    rows = _word_counts(cells, sheet, scan_rows)
    best = rows.groupBy(*sheet).agg(F.max(F.struct(F.col("hits"), (-F.col("row_idx")).alias("neg"))).alias("b"))
    return best.select(*sheet, F.when(F.col("b.hits") > 0, -F.col("b.neg")).otherwise(0).cast("int").alias("header_row"), F.col("b.hits").alias("header_hits"))


def split_header(cells: DataFrame, sheet: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(header cells with cleaned text, body cells). Columns without a value below the header do not count as present."""
    tops = header_rows(cells, sheet)
    body = _on(cells, tops, sheet).where("row_idx > header_row").drop("header_row", "header_hits")
    # The last row with a value per column tells what lies below the header; one row per sheet, so that cells meet it by their sheet alone.
    last = drop_empty(cells).groupBy(*sheet, "col_idx").agg(F.max("row_idx").alias("last")).groupBy(*sheet).agg(F.collect_list(F.struct("col_idx", "last")).alias("lasts"))
    below = F.transform(F.filter("lasts", lambda e: e["last"] > F.col("header_row")), lambda e: e["col_idx"])
    place = _on(tops, last, sheet).select(*sheet, "header_row", below.alias("filled"))
    # A range, not an equality: that would become a join key and shuffle cells that lie by sheet already.
    head = _on(cells.where(F.col("row_idx") < HEADER_SCAN_ROWS), place.hint("shuffle_hash"), sheet).where(F.col("row_idx").between(F.col("header_row"), F.col("header_row")))
    return head.where(F.array_contains("filled", F.col("col_idx"))).select(*sheet, "col_idx", header_text(F.col("value")).alias("header")), body


def drop_empty(cells: DataFrame) -> DataFrame:
    """In a long table a row or column is empty exactly when it has no cell with a value."""
    return cells.where("value IS NOT NULL")


def note_rows(body: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """Rows of the body that are notes or blank."""
    note = F.bool_or(rules.any_in(F.col("value"), NOTE_WORDS))
    blank = ~F.bool_or(text_or_empty(F.col("value")) != "")
    rows = body.groupBy(*sheet, "row_idx").agg(F.coalesce(note, F.lit(False)).alias("note"), F.coalesce(blank, F.lit(True)).alias("blank"))
    return rows.where("note OR blank").select(*sheet, "row_idx")


def without_notes(body: DataFrame, sheet: Sequence[str]) -> DataFrame:
    return _on(drop_empty(body), note_rows(body, sheet), [*sheet, "row_idx"], "left_anti")


def _alias_literal(aliases: dict[str, tuple[str, ...]]) -> Column:
    """The alias lists as one constant array; JSON keeps the expression small until it is folded."""
    items = [
        {"canonical": name, "canonical_no": c, "alias_no": i, "alias": "".join(word.split()).lower()}
        for c, (name, words) in enumerate(aliases.items()) for i, word in enumerate(words)
    ]
    schema = "array<struct<canonical:string,canonical_no:int,alias_no:int,alias:string>>"
    return F.from_json(F.lit(json.dumps(items, ensure_ascii=False)), schema)


def _by_signature(headers: DataFrame, sheet: Sequence[str], resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``resolve`` makes of the header cells of a sheet, worked out once per distinct header (``sig`` stands for the sheet) and joined back."""
    whole = F.array_sort(F.collect_list(F.struct("col_idx", "header")))
    schema = headers.groupBy(*sheet).agg(whole.alias("header")).schema["header"].dataType
    sheets = written(headers.groupBy(*sheet).agg(F.to_json(whole).alias("sig")))
    found = written(resolve(sheets.select("sig").distinct().select("sig", F.inline(F.from_json("sig", schema)))))
    return sheets.join(found, "sig").select(*sheet, *[c for c in found.columns if c != "sig"])


def column_candidates(headers: DataFrame, sheet: Sequence[str], aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Every (header cell, canonical name) that fits, with the pass (1 exact, 2 contained) and number of the best alias."""
    return _by_signature(headers, sheet, lambda own: _candidates(own, ["sig"], aliases))


def _candidates(headers: DataFrame, sheet: Sequence[str], aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Header texts repeat over headers, so each distinct text is matched once and joined back."""
    texts = headers.select("header").distinct().withColumns({"h": F.lower("header"), "aliases": _alias_literal(aliases)})
    hits = texts.select("header", "h", F.explode(F.filter("aliases", lambda a: F.contains(F.col("h"), a["alias"]))).alias("a"))
    fit = F.min(F.struct(F.when(F.col("h") == F.col("a.alias"), 1).otherwise(2).alias("pass"), F.col("a.alias_no").alias("alias_no")))
    fits = hits.groupBy("header", F.col("a.canonical").alias("canonical"), F.col("a.canonical_no").alias("canonical_no")).agg(fit.alias("fit"))
    return headers.select(*sheet, "col_idx", "header").join(fits, "header").select(
        *sheet, "col_idx", "header", "canonical", "canonical_no", "fit.pass", "fit.alias_no"
    )


def resolve_columns(headers: DataFrame, sheet: Sequence[str], aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Column per canonical name: exact match before contained match, then alias order.

    Of equal exact headers the last column counts, of contained ones the first.
    """
    return _by_signature(headers, sheet, lambda own: _resolved(own, ["sig"], aliases))


def _resolved(headers: DataFrame, sheet: Sequence[str], aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    found = _candidates(headers, sheet, aliases)
    side = F.when(F.col("pass") == 1, -F.col("col_idx")).otherwise(F.col("col_idx"))
    best = F.min_by(F.struct("col_idx", "header"), F.struct(F.col("pass"), F.col("alias_no"), side.alias("side")))
    return found.groupBy(*sheet, "canonical", "canonical_no").agg(best.alias("b")).select(*sheet, "canonical", "canonical_no", "b.col_idx", "b.header")


def used_columns(resolved: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """A column goes to the first canonical name that asked for it. A header that occurs twice renames both columns."""
    return resolved.groupBy(*sheet, "header").agg(F.min_by("canonical", "canonical_no").alias("canonical"), F.min("col_idx").alias("col_idx"))


def most_frequent(df: DataFrame, sheet: Sequence[str], column: str) -> DataFrame:
    """Most frequent non-blank value per sheet; the smallest value wins ties."""
    value = strip(F.col(column))
    counts = df.where(text_or_empty(F.col(column)) != "").groupBy(*sheet, value.alias("v")).agg(F.count("*").alias("n"))
    return counts.groupBy(*sheet).agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"))


def gathered_rows(cells: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """One row per sheet row with a value: its cells as a map (bounded by the columns of a sheet) and what its text tells.

    Everything later reads these rows, so the cells are scanned and shuffled once.
    """
    cells = cells.where("value IS NOT NULL").groupBy(*sheet, "row_idx").agg(F.collect_list(F.struct("col_idx", "value")).alias("cells"))
    # A column that a row repeats keeps its greatest value, so that any order of the cells gives the same map.
    columns = F.array_distinct(F.transform("cells", lambda e: e["col_idx"]))
    greatest = F.transform(columns, lambda c: F.array_max(F.filter("cells", lambda e: e["col_idx"] == c)))
    rows = cells.withColumn("cells", F.map_from_entries(F.when(F.size(columns) == F.size("cells"), F.col("cells")).otherwise(greatest)))
    rows = settled(rows, ["row_idx", "cells", F.array_join(F.map_values("cells"), "\n").alias("line")], keep=sheet)
    line = F.col("line")
    hits = sum((F.contains(line, F.lit(w)).cast("int") for w in HEADER_WORDS), F.lit(0))
    return rows.select(
        *sheet, "row_idx", "cells", F.when(F.col("row_idx") < HEADER_SCAN_ROWS, hits).alias("hits"),
        rules.any_in(line, NOTE_WORDS).alias("note"), F.exists(F.map_values("cells"), lambda v: text_or_empty(v) != "").alias("filled"),
        rules.any_in(line, ("历史", "文科")).alias("history"), rules.any_in(line, ("物理", "理科")).alias("physics"),
    )


def sheet_facts(rows: DataFrame, sheet: Sequence[str], record_type: str) -> DataFrame:
    """Per sheet: header row, columns by canonical name, subject words up to the header, and the number of rows and of typed rows.

    ``columns`` maps a canonical name to its column, ``unmapped`` counts the header words that no name took. Headers repeat over sheets: each
    distinct header (cleaned texts of the columns that hold values below it) is resolved once and joined back.
    """
    # Most header words, then the first row, as one number: a plain aggregate without structs or maps.
    code = F.col("hits").cast("long") * 2**32 + (2**31 - F.col("row_idx"))
    first = [F.min(F.when(F.col(w), F.col("row_idx"))).alias(f"{w}_row") for w in ("history", "physics")]
    tops = rows.groupBy(*sheet).agg(F.max(code).alias("code"), F.count("*").alias("raw_rows"), *first).where("code IS NOT NULL")
    top_row = 2**31 - F.col("code").bitwiseAND(F.lit(2**32 - 1))
    tops = written(tops.withColumn("header_row", F.when(F.col("code") >= 2**32, top_row).otherwise(0).cast("int")))
    # A header is among the rows with header words, or the first of its sheet; no other row brings its cells, and one of a sheet alone leaves its task.
    head = rows.where(F.col("row_idx") < HEADER_SCAN_ROWS).where("hits > 0 OR row_idx = 0").groupBy(*sheet).agg(F.max_by("cells", code).alias("cells"))
    # Rows of a sheet mostly fill the same columns: the last row of a combination first, then of a column, with numbers alone.
    last = rows.select(*sheet, "row_idx", F.array_sort(F.map_keys("cells")).alias("keys")).groupBy(*sheet, "keys").agg(F.max("row_idx").alias("last"))
    last = last.repartition(*sheet).select(*sheet, "last", F.explode("keys").alias("col_idx")).groupBy(*sheet, "col_idx").agg(F.max("last").alias("last"))
    last = written(last.groupBy(*sheet).agg(F.collect_list(F.struct("col_idx", "last")).alias("lasts")))
    tops = _on(_on(tops, head, sheet, "left"), last, sheet, "left")
    in_use = lambda e: F.exists("lasts", lambda s: (s["col_idx"] == e["key"]) & (s["last"] > F.col("header_row")))
    present = F.filter(F.map_entries(F.coalesce("cells", F.create_map().cast("map<int,string>"))), lambda e: F.coalesce(in_use(e), F.lit(False)))
    texts = F.array_sort(F.transform(present, lambda e: F.struct(e["key"].alias("col_idx"), header_text(e["value"]).alias("header"))))
    tops = tops.withColumn("header", texts)
    schema = tops.schema["header"].dataType
    # Read twice below: for the distinct headers and for the join with what they resolve to.
    tops = written(tops.withColumn("sig", F.to_json("header")).drop("cells", "lasts", "header"))

    signs = tops.select("sig").distinct().withColumn("header", F.from_json("sig", schema))
    headers = signs.select("sig", F.inline("header"))
    used = used_columns(_resolved(headers, ["sig"], aliases_for(record_type)), ["sig"])
    columns = used.groupBy("sig").agg(F.map_from_entries(F.collect_list(F.struct("canonical", "col_idx"))).alias("columns"), F.collect_set("header").alias("taken"))
    resolved = signs.join(columns, "sig", "left")
    rest = F.array_join(F.transform(F.filter("header", lambda h: ~F.array_contains(F.coalesce("taken", F.array().cast("array<string>")), h["header"])), lambda h: h["header"]), "\n")
    unmapped = sum((F.contains(F.col("rest"), F.lit(w)).cast("int") for w in HEADER_WORDS), F.lit(0))
    resolved = written(resolved.withColumn("rest", rest).select("sig", "columns", unmapped.alias("unmapped")))
    up_to = {w: F.coalesce((F.col(f"{w}_row") <= F.col("header_row")) & (F.col(f"{w}_row") < HEADER_SCAN_ROWS), F.lit(False)) for w in ("history", "physics")}
    return tops.join(resolved, "sig").select(*sheet, "header_row", "raw_rows", "columns", "unmapped", *[c.alias(w) for w, c in up_to.items()])


def body_rows(rows: DataFrame, facts: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """Rows below the header that are neither notes nor blank, with the facts of their sheet."""
    kept = rows.where("filled AND NOT note").select(*sheet, "row_idx", "cells")
    return _on(kept, facts, sheet).where("row_idx > header_row")


def resolved_subject(
    hint: Column, file_name: Column, sheet_name: Column, header_history: Column, header_physics: Column, mode: Column, *, prefer_sheet: bool,
) -> Column:
    """Subject of a whole sheet by priority, null when nothing names one.

    Default: hint, file name, sheet and header text, mode of the column, sheet name. For rank
    sheets: sheet and header text, sheet name, file name, hint, mode.
    """
    given = F.when(text_or_empty(hint) != "", rules.subject_name(hint))
    from_file = rules.subject_in_text(F.coalesce(file_name, F.lit("")))
    from_sheet = rules.subject_in_text(F.coalesce(sheet_name, F.lit("")))
    name = F.coalesce(sheet_name, F.lit(""))
    history = rules.any_in(name, ("历史", "文科")) | F.coalesce(header_history, F.lit(False))
    physics = rules.any_in(name, ("物理", "理科")) | F.coalesce(header_physics, F.lit(False))
    from_head = F.when(history, "历史类").when(physics, "物理类")
    from_mode = F.nullif(rules.subject_name(mode), F.lit(""))
    order = [from_head, from_sheet, from_file, given, from_mode] if prefer_sheet else [given, from_file, from_head, from_mode, from_sheet]
    return F.coalesce(*order)


def parse_sheets(
    cells: DataFrame, sheet: Sequence[str], record_type: str, files: DataFrame, *, default_province: str = "江苏", prefer_sheet: bool | None = None,
) -> DataFrame:
    """All sheets of all files to typed rows.

    ``files`` has one row per sheet: file_name, sheet_name, default_year, subject_hint.
    """
    prefer = record_type == "rank" if prefer_sheet is None else prefer_sheet
    names = list(aliases_for(record_type))
    gathered = written(gathered_rows(cells, sheet))
    facts = written(sheet_facts(gathered, sheet, record_type))
    body = body_rows(gathered, facts.select(*sheet, "header_row", "columns"), sheet)

    # The column of every name, in order of the names, worked out per sheet; a row looks its cells up in one pass over that list.
    places = F.transform(F.array(*[F.lit(n) for n in names]), lambda n: F.try_element_at("columns", n))
    mode_of = F.try_element_at("cells", F.try_element_at("columns", F.lit("subject_type")))
    modes = most_frequent(body.where(F.map_contains_key("columns", "subject_type")).select(*sheet, mode_of.alias("v")), sheet, "v")
    whole = _on(_on(files, facts, sheet), modes, sheet, "left")
    subject = resolved_subject(F.col("subject_hint"), F.col("file_name"), F.col("sheet_name"), F.col("history"), F.col("physics"), F.col("mode"), prefer_sheet=prefer)
    whole = settled(whole, ["header_row", "file_name", "sheet_name", "default_year", subject.alias("whole_subject"), places.alias("places")], keep=sheet)
    out = body_rows(gathered, whole, sheet).withColumn("found", F.transform("places", lambda p: F.try_element_at("cells", p)))
    out = out.select(*sheet, "row_idx", "file_name", "sheet_name", "default_year", "whole_subject", "places", *[F.get("found", F.lit(i)).alias(n) for i, n in enumerate(names)])

    def has(name: str) -> Column:
        return F.get("places", F.lit(names.index(name))).isNotNull()

    batch = rules.school_batch_name if record_type == "school" else rules.batch_name
    out = written(out.withColumns({
        "year": F.when(has("year"), F.col("year")).otherwise(F.col("default_year").cast("string")),
        "province": F.when(has("province"), F.col("province")).otherwise(F.lit(default_province)),
        "batch": F.when(has("batch"), F.col("batch")).otherwise(F.lit(DEFAULT_BATCHES.get(record_type))),
        **({"min_score": F.when(has("min_score"), F.col("min_score")).otherwise(F.col("score"))} if record_type == "school" else {}),
    }))
    # Names of places, subjects and batches repeat over rows and sheets and have long rules; numbers have short ones and are read row by row, without a table of their texts.
    ruled = {"province": rules.province_name, "subject_type": rules.subject_name, "batch": batch}
    out = by_distinct(out, [Group((c,), lambda table, c=c, rule=rule: table.select(c, F.when(F.col(c).isNotNull(), rule(F.col(c))).alias(f"_{c}"))) for c, rule in ruled.items()])
    values: dict[str, Column] = {
        **{c: F.col(f"_{c}") for c in ruled},
        "subject_type": F.coalesce(F.col("whole_subject"), F.when(has("subject_type"), F.coalesce(F.col("_subject_type"), F.lit("")))),
        "school_name": F.when(has("school_name"), school_name(F.col("school_name"))),
        "tie_breaker_text": strip(F.col("tie_breaker_text")),
        # As lists: the long rules of numbers stand in the plan once, not once per column, and the code made of it stays short enough to be compiled.
        **{c: F.get("_scores", F.lit(i)) for i, c in enumerate(SCORE_COLUMNS)},
        **{c: F.get("_counts", F.lit(i)) for i, c in enumerate(COUNT_COLUMNS)},
        "source_file": F.col("file_name"),
    }
    values["batch"] = F.when(F.col("batch").isNotNull() | has("batch"), F.coalesce(F.col("_batch"), F.lit("")))
    values["province"] = F.coalesce(F.col("_province"), F.lit(""))
    out = out.withColumns({
        "_scores": F.transform(F.array(*SCORE_COLUMNS), lambda c: F.when(c.isNotNull(), score_cell(c))),
        "_counts": F.transform(F.array(*COUNT_COLUMNS), digits_only),
    }).withColumns(values)
    if record_type == "school":
        # Code and name stand in for each other only where the sheet lacks the column.
        out = out.withColumns({
            "school_name": F.when(has("school_name") | ~has("school_code"), F.col("school_name")).otherwise(F.col("school_code")),
            "school_code": F.when(has("school_code") | ~has("school_name"), F.col("school_code")).otherwise(F.col("school_name")),
        })
    return out.select(*sheet, "row_idx", *names, "source_file", F.col("sheet_name").alias("source_sheet"))


def sheet_profile(cells: DataFrame, sheet: Sequence[str], preview_rows: int = 20, preview_columns: int = 15) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(shape and header row, non-null count per column, preview cells)."""
    shape = cells.groupBy(*sheet).agg((F.max("row_idx") + 1).alias("row_count"), (F.max("col_idx") + 1).alias("column_count"))
    shape = _on(shape, header_rows(cells, sheet), sheet)
    filled = cells.groupBy(*sheet, "col_idx").agg(F.count("value").alias("non_null"))
    return shape, filled, cells.where((F.col("row_idx") < preview_rows) & (F.col("col_idx") < preview_columns))


def looks_like_school(cells: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """Per sheet, whether its header names school columns (used to keep such files out of other imports)."""
    rows = _word_counts(cells.dropna(subset=list(sheet)), sheet, HEADER_SCAN_ROWS, school=rules.any_in(F.col("value"), SCHOOL_HEADER_WORDS))
    # One pass: the flag of the row with most header words, and that of row 0, which is the header of a sheet without such words.
    best = F.max(F.struct("hits", (-F.col("row_idx")).alias("neg"), "school"))
    found = rows.groupBy(*sheet).agg(best.alias("b"), F.max(F.when(F.col("row_idx") == 0, F.col("school"))).alias("first"))
    return found.select(*sheet, F.when(F.col("b.hits") > 0, F.col("b.school")).otherwise(F.col("first")).alias("is_school")).where("is_school IS NOT NULL")
