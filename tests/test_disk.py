"""What lies on disk while a query runs: shuffles go once their rows are written, and derived tables are worked out once."""

import datetime
import pathlib
import time

import pytest

from rankline.operators import load, stats
from rankline.operators.tablelog import TableLog
from rankline.plans import q_clean, q_stats
from rankline.plans.inputs import Inputs
from rankline.session import written


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Twenty orders of three lines; some lines repeat a key, some have a broken score."""
    path = str(tmp_path_factory.mktemp("given"))
    day = datetime.date(1995, 1, 1)
    lines = [(o, o % 3, o % 14, n, 38 + n + o % 4, 17000.0 + o, "R", "O", day) for o in range(20) for n in (1, 2, 5)]
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity int, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate date"
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(p, f"cold {p}", "Brand#1", "PROMO") for p in range(3)], "p_partkey bigint, p_name string, p_brand string, p_type string").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame([(s, s % 2) for s in range(14)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    spark.createDataFrame([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int").write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{path}/region.parquet")
    return path


def shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {p.name for d in dirs for p in pathlib.Path(d.toString()).rglob("shuffle_*.data")}


def test_shuffles_of_written_rows_go_at_once(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    known = shuffle_files(spark)
    rows = spark.range(1000).repartition(3, "id")
    back = written(rows)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    for _ in range(50):
        if not shuffle_files(spark) - known:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - known
    assert back.count() == rows.count() == 1000


def test_kept_tables_are_read_by_all_that_derive_from_them(spark, folder):
    plain = Inputs(spark, folder)
    t = plain.kept("school_raw")
    for name in ("school_raw", "school_fx", "school_batch", "school_stored", "school_lines"):
        assert "l_orderkey" not in plan(getattr(t, name)) and "l_orderkey" in plan(getattr(plain, name))
        assert sorted(map(str, getattr(t, name).collect())) == sorted(map(str, getattr(plain, name).collect()))
    assert plain.kept("school_fx", "year", "province").school_fx.columns == ["year", "province"]


def test_query_modes_work_the_schools_out_once(spark, folder, monkeypatch):
    calls = []
    own = stats.resolved_modes
    monkeypatch.setattr(stats, "resolved_modes", lambda *args: calls.append(args) or own(*args))
    out = q_stats.query_mode(Inputs(spark, folder))
    assert "l_orderkey" not in plan(out) and all("l_orderkey" not in plan(df) for df in calls[0])
    got = sorted((r.year or 0, r.province, r.query_mode) for r in out.collect())
    asked = {(1995, p) for p in ("ASIA", "EUROPE", "浙江", "山东")} | {(2005, p) for p in ("ASIA", "EUROPE", "山东")} | {(0, p) for p in ("ASIA", "EUROPE", "浙江")}
    assert {(y, p) for y, p, _ in got} == asked and len(got) == len(asked)
    modes = {(y, p): m for y, p, m in got}
    assert modes[1995, "浙江"] == "score" and modes[2005, "山东"] == "rank" and modes[0, "浙江"] == modes[2005, "ASIA"] == "mixed"


def test_loads_read_their_batch_once_written(spark, folder, monkeypatch):
    calls, attempts = [], []
    own, write = load.new_rows, TableLog.write_attempt
    monkeypatch.setattr(load, "new_rows", lambda *args: calls.append(args) or own(*args))
    monkeypatch.setattr(TableLog, "write_attempt", lambda self, rows, files: attempts.append(rows) or write(self, rows, files))
    t = Inputs(spark, folder)
    want = sorted(map(str, q_clean.append_schools(t).collect()))
    calls.clear()
    assert sorted(map(str, q_clean.append_schools_after_failure(t).collect())) == want
    assert sorted(map(str, q_clean.append_schools_twice(t).collect())) == want
    assert want and len(calls) == 3
    # Neither the batch nor the stored keys are worked out from the given tables again, and both attempts write rows that are on disk.
    assert all("l_orderkey" not in plan(df) for df, stored, *_ in calls for df in (df, stored))
    assert all("Window" not in plan(stored) for _, stored, *_ in calls)
    assert len(attempts) == 2 and all("Window" not in plan(rows) for rows in attempts)
