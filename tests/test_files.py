"""Read-only SQL, and logged tables under failing, repeated and competing writers."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from rankline.operators.tablelog import TableLog
from rankline.sources import files


@pytest.mark.parametrize("sql", [
    "CREATE TABLE x (a int)", "DROP TABLE IF EXISTS x", "SET spark.sql.shuffle.partitions=3", "INSERT INTO {t} VALUES (1)", "INSERT OVERWRITE DIRECTORY '/tmp/x' USING parquet SELECT * FROM {t}",
    "WITH q AS (SELECT * FROM {t}) INSERT INTO x SELECT * FROM q", "FROM {t} INSERT INTO x SELECT * INSERT INTO y SELECT *", "DELETE FROM {t}", "UPDATE {t} SET a = 1", "TRUNCATE TABLE {t}",
    "MERGE INTO {t} USING u ON u.a = {t}.a WHEN MATCHED THEN DELETE", "CREATE OR REPLACE TEMP VIEW v AS SELECT 1", "CACHE TABLE {t}", "EXPLAIN SELECT 1", "USE x", "ADD JAR 'x.jar'", "CREATE TABLE x AS SELECT 1",
])
def test_anything_but_a_query_is_refused(spark, sql):
    t = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        files.query_tables(spark, sql, {"t": t})
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_queries_pass(spark):
    t = spark.createDataFrame([(1,), (5,)], "a int")
    sql = "WITH q AS (SELECT a FROM {t} WHERE a > :low) SELECT count(*) AS n, (SELECT max(a) FROM {t}) AS m FROM q UNION ALL SELECT 7, 8"
    assert sorted(map(tuple, files.query_tables(spark, sql, {"t": t}, low=2).collect())) == [(1, 5), (7, 8)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "year int, province string, k int, v string")


def table_log(spark, tmp_path, name="t"):
    return TableLog(spark, f"{tmp_path}/{name}", frame(spark, []).schema)


ROWS = [(2020 + i % 3, ["江苏 省", "a+b%c", None][i % 3], i, f"v{i}") for i in range(60)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_batch_that_died_half_way_and_ran_again_is_there_once(spark, tmp_path):
    log, rows = table_log(spark, tmp_path), frame(spark, ROWS)
    breaks = rows.withColumn("v", F.when(F.col("k") == 41, F.raise_error(F.lit("task dies"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        log.append(breaks, "b1")
    log.write_attempt(rows.where("k < 30"), files=2)  # all files of an attempt, but the driver died before the commit
    assert rows_of(log.read()) == []
    assert log.append(rows, "b1") and not log.append(rows, "b1")
    assert rows_of(log.read()) == rows_of(rows)
    again = table_log(spark, tmp_path)
    assert not again.append(rows, "b1") and again.append(frame(spark, [(1999, "x", 1, "y")]), "b2") and again.append(frame(spark, []), "b3")
    assert rows_of(log.read()) == rows_of(rows.unionByName(frame(spark, [(1999, "x", 1, "y")])))


def test_only_files_with_such_rows_are_rewritten(spark, tmp_path):
    log = table_log(spark, tmp_path)
    log.append(frame(spark, ROWS), "b1", files=1)
    before = {r.file for r in log.live().collect()}
    assert len(before) == 3 and {r.rows for r in log.live().collect()} == {20}
    for _ in range(2):
        report = log.rewrite("clean", F.col("k") % 12 == 0, lambda df: df.where("k % 12 <> 0"), files=1).collect()[0]
        assert tuple(report) == (1, 2, 20, 15)
    assert rows_of(log.read()) == rows_of(frame(spark, [r for r in ROWS if r[2] % 12]))
    assert len(before & {r.file for r in log.live().collect()}) == 2
    assert tuple(log.rewrite("none", F.lit(False), lambda df: df).collect()[0]) == (0, 3, 0, 0)
    assert tuple(log.rewrite("all", F.lit(True), lambda df: df.where("false")).collect()[0])[1:] == (0, 55, 0)
    assert rows_of(log.read()) == []


def test_writers_that_meet(spark, tmp_path):
    one, two = table_log(spark, tmp_path), table_log(spark, tmp_path)
    one.append(frame(spark, ROWS[:30]), "a")
    # Between the second writer's look at the log and its commit, the first commits: the second takes the next version.
    versions = two._versions
    calls = []
    two._versions = lambda: calls.append(1) or (versions()[:1] if len(calls) < 4 else versions())
    one.append(frame(spark, ROWS[30:40]), "b")
    assert two.append(frame(spark, ROWS[40:]), "c")
    assert rows_of(one.read()) == rows_of(frame(spark, ROWS))
    gone = [r.file for r in one.live().collect()]
    one.rewrite("x", F.lit(True), lambda df: df)
    with pytest.raises(RuntimeError):
        one._commit(one._mark("y"), gone)
