"""Append without duplicates, metadata upsert, backfill and clean-up of recognised rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import RECOGNISED_PREFIX, invalid_school_name, number, text_or_empty, text_or_null, to_int
from ..session import shuffles_freed, written
from .ordered import asof_backward, numbered
from .search import first_per
from .settle import settled

KEYS = {
    "control": ("year", "province", "subject_type", "batch"),
    "school": ("year", "province", "school_code", "subject_type", "admission_category", "batch", "major_group"),
    "major": ("year", "province", "school_name", "major_name", "subject_type", "major_group"),
    "rank": ("year", "province", "subject_type", "score"),
}
_TEXT_KEYS = ("province", "subject_type", "school_name", "major_name")
# Columns that must hold a number, and those that may be missing but not be broken.
_NEEDED = {"control": ("score",), "school": (), "major": ("min_score",), "rank": ("score", "cumulative_count")}
_OPTIONAL = {
    "control": (), "school": ("min_score", "min_rank", "plan_count"), "major": ("avg_score", "max_score", "min_rank"), "rank": ("same_score_count",),
}
_WHOLE = ("min_rank", "plan_count", "same_score_count", "cumulative_count")
METADATA = (
    "school_name", "standard_name", "province", "city", "is_985", "is_211", "is_double_first_class", "school_type", "ownership", "source",
)


def _key_columns(df: DataFrame, record_type: str) -> dict[str, Column]:
    """Key columns in the form they are compared and stored in; missing group and batch equal ''."""
    out: dict[str, Column] = {"year": to_int(F.col("year"))}
    for c in KEYS[record_type]:
        if c in _TEXT_KEYS:
            out[c] = text_or_null(F.col(c))
    if record_type == "rank":
        out["score"] = number(F.col("score").cast("string"))
    else:
        if "batch" in KEYS[record_type]:
            default = rules.DEFAULT_BATCH if record_type == "school" else ""
            out["batch"] = F.coalesce(text_or_null(F.col("batch")), F.lit(default))
        if "major_group" in KEYS[record_type]:
            group = F.col("major_group") if "major_group" in df.columns else F.lit(None).cast("string")
            out["major_group"] = text_or_empty(group)
    if record_type == "school":
        out["school_name"] = text_or_null(F.col("school_name"))
        out["admission_category"] = F.coalesce(text_or_null(F.col("admission_category")), F.lit(rules.DEFAULT_CATEGORY))
        out["school_code"] = F.coalesce(text_or_null(F.col("school_code")), text_or_null(F.col("school_name")))
    return out


def prepared(df: DataFrame, record_type: str) -> DataFrame:
    """Rows with comparable keys plus ``bad_key`` and ``bad_value`` (a number is missing or broken)."""
    keys = _key_columns(df, record_type)
    needed = [c for c in _NEEDED[record_type] if c in df.columns]
    optional = [c for c in _OPTIONAL[record_type] if c in df.columns]

    def cell(c: str) -> Column:
        return number(F.col(c).cast("string"))

    keep = [c for c in df.columns if c not in keys and c not in needed and c not in optional]
    # Every number and key is worked out once; without this, each later mention would repeat its rules.
    raw = [F.col(c).isNotNull().alias(f"_given_{c}") for c in optional]
    values = [cell(c).alias(f"_number_{c}") for c in (*needed, *optional)]
    out = settled(df, [*[c.alias(k) for k, c in keys.items()], *values, *raw], keep=keep)
    bad_value = F.lit(False)
    for c in needed:
        bad_value = bad_value | F.col(f"_number_{c}").isNull()
    for c in optional:
        bad_value = bad_value | (F.col(f"_given_{c}") & F.col(f"_number_{c}").isNull())
    bad_key = F.lit(False)
    for c in keys:
        bad_key = bad_key | F.col(c).isNull()
    shown = [(F.col(f"_number_{c}").try_cast("int") if c in _WHOLE else F.col(f"_number_{c}")).alias(c) for c in (*needed, *optional) if c not in keys]
    return out.select(*keep, *keys, *shown, bad_value.alias("bad_value"), bad_key.alias("bad_key"))


def stored_keys(stored: DataFrame, record_type: str) -> DataFrame:
    keys = KEYS[record_type]
    columns = [text_or_empty(F.col(k)).alias(k) if k == "major_group" else F.col(k) for k in keys]
    columns = [F.col(k).cast("double").alias(k) if record_type == "rank" and k == "score" else c for k, c in zip(keys, columns)]
    return stored.select(*columns)


def new_rows(df: DataFrame, stored: DataFrame, record_type: str, order: list[str]) -> DataFrame:
    """Rows to append: the first good row of every key that is not stored yet. Appending them twice adds nothing."""
    keys = list(KEYS[record_type])
    good = prepared(df, record_type).where("NOT bad_key AND NOT bad_value").drop("bad_key", "bad_value")
    # A stored key never wins, so its rows leave before the window sorts anything.
    fresh = good.join(stored_keys(stored, record_type).distinct(), keys, "left_anti")
    first = first_per(fresh, keys, [F.asc_nulls_first(c) for c in order])
    return first.withColumn("major_group", F.nullif("major_group", F.lit(""))) if "major_group" in first.columns else first


def outcomes(df: DataFrame, stored: DataFrame, record_type: str, order: list[str]) -> DataFrame:
    """Every input row with its ``outcome``: inserted, skipped or failed.

    Broken rows before the first good row of a key fail; after it, and for stored keys, every
    row is a duplicate and skipped, whatever its values. The winners are one row per key, so the
    join back splits a hot key on the row side only.
    """
    keys = list(KEYS[record_type])
    place = F.struct(*order)
    # Read for the winners and again for the rows: written, so that the rules of a row run once.
    rows = written(prepared(df, record_type)).withColumn("_place", place)
    winners = rows.where("NOT bad_key AND NOT bad_value").groupBy(*keys).agg(F.min("_place").alias("_first"))
    known = stored_keys(stored, record_type).distinct().withColumn("_stored", F.lit(True))
    joined = rows.join(winners, keys, "left").join(known, keys, "left")
    outcome = (
        F.when(F.col("bad_key"), "failed").when(F.col("_stored"), "skipped")
        .when(F.col("_place") == F.col("_first"), "inserted").when(F.col("_place") > F.col("_first"), "skipped").otherwise("failed")
    )
    return joined.withColumn("outcome", outcome).drop("_place", "_first", "_stored", "bad_key", "bad_value")


def load_statistics(log: DataFrame, *by: str) -> DataFrame:
    return log.groupBy(*by).agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("inserted", "skipped", "failed")])


def merge_statistics(*parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    from .stats import stack

    return stack(list(parts)).groupBy(*by).agg(*[F.sum(o).alias(o) for o in ("inserted", "skipped", "failed")])


def code_conflicts(majors: DataFrame) -> DataFrame:
    """Keys on codes shared by rows that differ in their names; a table with a key on codes cannot hold both."""
    keys = ["year", "province", "school_code", "major_code", "subject_type", "major_group"]
    named = majors.withColumn("major_group", text_or_empty(F.col("major_group"))).groupBy(*keys, "school_name", "major_name").agg(F.count("*").alias("n"))
    return named.groupBy(*keys).agg(F.count("*").alias("names")).where("names > 1")


def append_table(fresh: DataFrame, path: str, files: int = 8) -> None:
    """Append to a table with a folder per year and province; a folder gets ``files`` files or fewer per append."""
    salt = F.pmod(F.xxhash64(*[c for c in fresh.columns if c not in ("year", "province")]), F.lit(files))
    with shuffles_freed(fresh.sparkSession):
        fresh.repartition("year", "province", salt).write.mode("append").partitionBy("year", "province").parquet(path)


@dataclass
class Upsert:
    table: DataFrame
    log: DataFrame


def clean_metadata(df: DataFrame) -> DataFrame:
    flags = ("is_985", "is_211", "is_double_first_class")
    out = df.where(text_or_empty(F.col("standard_name")) != "")
    columns = {c: text_or_null(F.col(c)) for c in METADATA if c not in flags}
    columns["school_name"] = F.coalesce(text_or_null(F.col("school_name")), text_or_null(F.col("standard_name")))
    columns.update({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})
    return out.withColumns(columns)


_BAND = 4096  # rows of a name or record that one window sorts


def _found(rows: DataFrame, writers: DataFrame) -> DataFrame:
    """For every batch row (at): the last earlier writer under its standard name (s) and under its school name (n), and the one its record is found by (parent).

    A name is looked up as standard name, then as school name, then the two crossed. All four lookups are one as-of join on (index, name).
    """
    entry = lambda kind, column: F.struct(F.lit(kind).alias("kind"), F.col(column).alias("name"))
    entries = writers.select("at", F.inline(F.array(entry("standard", "standard_name"), entry("school", "school_name")))).where("name IS NOT NULL")
    crossed = F.col("standard_name") != F.col("school_name")
    ask = lambda place, kind, column: F.struct(F.lit(place).alias("place"), F.lit(kind).alias("kind"), F.col(column).alias("name"))
    wanted = [ask(1, "standard", "standard_name"), ask(2, "school", "school_name"), F.when(crossed, ask(3, "school", "standard_name")), F.when(crossed, ask(4, "standard", "school_name"))]
    asks = rows.where("_new").select(F.col("at").alias("row"), (F.col("at") - 0.5).alias("at"), F.inline(F.filter(F.array(*wanted), lambda a: a.isNotNull())))
    hits = asof_backward(asks, entries, ["kind", "name"], "at", F.col("at"), _BAND)
    told = asks.join(hits, ["kind", "name", "at"])
    by = lambda place: F.max(F.when(F.col("place") == place, F.col("hit")))
    return told.groupBy(F.col("row").alias("at")).agg(by(1).alias("s"), by(2).alias("n"), F.min_by("hit", F.when(F.col("hit").isNotNull(), F.col("place"))).alias("parent"))


def _records(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The record (the row that began it) of every row: parents are followed by doubling, only those of rows that are not there yet."""
    links = rows.select("at").join(found.select("at", "parent"), "at", "left").withColumn("parent", F.coalesce("parent", "at"))
    now = written(links)
    done = written(now.where("parent = at").select("at", F.col("at").alias("record")))
    left = now.where("parent <> at")
    while not left.isEmpty():
        at_end = left.join(done.select(F.col("at").alias("parent"), "record"), "parent")
        rest = left.join(done.select(F.col("at").alias("parent")), "parent", "left_anti")
        jumps = rest.join(rest.select(F.col("at").alias("parent"), F.col("parent").alias("further")), "parent", "left")
        jumped = at_end.select("at", "record", F.lit(None).cast("long").alias("parent")).unionByName(jumps.select("at", F.lit(None).cast("long").alias("record"), F.coalesce("further", "parent").alias("parent")))
        jumped = written(jumped)
        done = written(done.unionByName(jumped.where("record IS NOT NULL").select("at", "record")))
        left = jumped.where("record IS NULL").select("at", "parent")
    return done


def upsert_metadata(stored: DataFrame, batch: DataFrame, order: list[str]) -> Upsert:
    """Match by standard name, else school name, else crossed names; insert, update or skip if equal, row after row.

    The result is that of applying the rows one by one in ``order``: a row that is inserted or changes a record is found under its names by later
    rows, as are the record's former names; a row equal to its record changes nothing. It is worked out without a loop over rows. Every row
    finds its parent, the last earlier row under one of its names, by an as-of join; following parents gives its record; the row before it in
    that record tells the outcome. Only a skipped row that would have changed which record a name finds breaks this order: such rows are taken
    out of the names, and the step is repeated until there are no others. Names and records are cut into bands, so one name may be on any share of the rows.
    """
    columns = list(METADATA)
    rows = clean_metadata(batch)
    old = stored.select(*columns, F.lit(False).alias("_new"), F.lit(None).cast(rows.select(F.struct(*order)).schema[0].dataType).alias("_place"))
    new = rows.select(*columns, F.lit(True).alias("_new"), F.struct(*order).alias("_place"))
    rows = numbered(old.unionByName(new), ["_new", "_place", "standard_name", *[c for c in columns if c != "standard_name"]], "at").drop("_place")
    data = F.struct(*columns)
    silent = None
    while True:
        writers = rows if silent is None else rows.join(silent, "at", "left_anti")
        found = written(_found(rows, writers))
        records = _records(rows, found)
        whole = written(rows.join(records, "at"))
        before = asof_backward(whole.where("_new").select("record", (F.col("at") - 0.5).alias("at")), whole.select("record", "at", data.alias("data")), ["record"], "at", F.col("data"), _BAND)
        log = whole.where("_new").join(before.select("record", (F.col("at") + 0.5).cast("long").alias("at"), F.col("hit").alias("earlier")), ["record", "at"], "left")
        outcome = F.when(F.col("earlier").isNull(), "inserted").when(F.col("earlier").eqNullSafe(data), "skipped").otherwise("updated")
        log = written(log.withColumn("outcome", outcome).drop("earlier"))
        target = lambda c: records.select(F.col("at").alias(c), F.col("record").alias(f"{c}_record"))
        skipped = log.where("outcome = 'skipped'").select("at", "record").join(found, "at").join(target("s"), "s", "left").join(target("n"), "n", "left")
        would = ~F.col("record").eqNullSafe(F.col("s_record")) | ~F.col("record").eqNullSafe(F.col("n_record"))
        now = written(skipped.where(would).select("at"))
        same = now.isEmpty() if silent is None else now.join(silent, "at", "left_anti").isEmpty() and silent.join(now, "at", "left_anti").isEmpty()
        if same:
            break
        silent = now
    table = whole.groupBy("record").agg(F.max_by(data, "at").alias("data")).select("data.*")
    return Upsert(table, log.select(*columns, "outcome"))


def is_blank() -> Column:
    """Category or batch is missing."""
    return (text_or_empty(F.col("admission_category")) == "") | (text_or_empty(F.col("batch")) == "")


def backfill(schools: DataFrame) -> DataFrame:
    """Blank category and batch get their defaults."""
    return schools.withColumns({
        "admission_category": F.coalesce(F.when(text_or_empty(F.col("admission_category")) != "", F.col("admission_category")), F.lit(rules.DEFAULT_CATEGORY)),
        "batch": F.coalesce(F.when(text_or_empty(F.col("batch")) != "", F.col("batch")), F.lit(rules.DEFAULT_BATCH)),
    })


def is_dirty(prefix: str = RECOGNISED_PREFIX) -> Column:
    """Recognised row whose name is no name: invalid, or at most one character (which covers blank ones).

    A name of digits has no CJK character and is therefore already invalid, whatever its code.
    """
    name = text_or_empty(F.col("school_name"))
    source = F.coalesce(F.startswith("source_url", F.lit(prefix)), F.lit(False))
    return source & (invalid_school_name(F.col("school_name")) | (F.length(name) <= 1))


def dirty_rows(schools: DataFrame, province: str | None = None, year: int | None = None) -> DataFrame:
    hits = schools.where(is_dirty())
    if province is not None:
        hits = hits.where(F.col("province") == province)
    if year is not None:
        hits = hits.where(F.col("year") == year)
    return hits


def dirty_by_source(schools: DataFrame, **scope) -> DataFrame:
    return dirty_rows(schools, **scope).groupBy("source_url").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_url")


def dirty_samples(schools: DataFrame, order: list[str], limit: int = 20, **scope) -> DataFrame:
    return dirty_rows(schools, **scope).orderBy(*[F.asc_nulls_first(c) for c in order]).limit(limit)


def without_dirty(schools: DataFrame, province: str | None = None, year: int | None = None) -> DataFrame:
    """Rows left after the clean-up; with dynamic partition overwrite only the given partition is rewritten."""
    scope = is_dirty()
    if province is not None:
        scope = scope & (F.col("province") == province)
    if year is not None:
        scope = scope & (F.col("year") == year)
    return schools.where(~F.coalesce(scope, F.lit(False)))
