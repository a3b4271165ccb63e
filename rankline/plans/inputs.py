"""Domain tables derived from the given tables, as SQL both Spark and the SQL check can run.

Base tables are written as {name}. Derived tables are plain names and become CTEs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import written

BASE = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {}

VIEWS["rank_raw"] = """
SELECT year(o.o_orderdate) AS year, r.r_name AS province,
       CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN '物理类' ELSE '历史类' END AS subject_type,
       CAST(100 + floor(o.o_totalprice / 800) AS INT) AS score,
       CAST(count(*) AS INT) AS same_score_count
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
GROUP BY 1,2,3,4"""

VIEWS["rank_fx"] = """
SELECT CAST(year AS INT) AS year, province, subject_type, score, same_score_count,
       CAST(sum(same_score_count) OVER (PARTITION BY year, province, subject_type ORDER BY score DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS cumulative_count
FROM rank_raw"""

VIEWS["rank_bad"] = """
SELECT year, province, subject_type, score, same_score_count,
       CASE WHEN score % 41 = 0 THEN NULL WHEN score % 17 = 0 THEN cumulative_count - 25
            ELSE cumulative_count END AS cumulative_count FROM rank_fx"""

VIEWS["control_fx"] = """
SELECT CAST(year(o_orderdate) AS INT) AS year, r_name AS province,
       CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN '物理类' ELSE '历史类' END AS subject_type,
       CASE o_orderstatus WHEN 'F' THEN '本科批' WHEN 'O' THEN '专科批' ELSE '提前批' END AS batch,
       CAST(min(100 + floor(o_totalprice / 800)) AS DOUBLE) AS score
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
GROUP BY 1,2,3,4"""

VIEWS["school_raw"] = """
SELECT CAST(year(l.l_shipdate) AS INT) AS year, r.r_name AS province, p.p_name || ' ' || p.p_brand AS school_name,
       'P' || CAST(l.l_partkey AS STRING) AS school_code,
       CASE l.l_returnflag WHEN 'R' THEN '物理类' WHEN 'A' THEN '历史类' ELSE '综合改革' END AS subject_type,
       CASE WHEN p.p_type = 'PROMO' THEN '艺术类' WHEN p.p_type = 'LARGE' THEN '体育类' ELSE '普通类' END AS admission_category,
       CASE WHEN l.l_linestatus = 'O' THEN '本科批' ELSE '专科批' END AS batch,
       CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE 'G' || CAST(l.l_linenumber AS STRING) END AS major_group,
       CASE WHEN l.l_linenumber % 5 = 0 THEN NULL ELSE CAST(100 + floor(l.l_extendedprice / 160) AS DOUBLE) END AS min_score,
       CASE WHEN l.l_linenumber % 4 = 0 THEN NULL ELSE CAST(1 + (l.l_orderkey * 7 + l.l_suppkey) % 100000 AS INT) END AS min_rank,
       CAST(l.l_quantity AS INT) AS plan_count,
       l.l_orderkey AS src_order, l.l_linenumber AS src_line, l.l_suppkey AS src_supp
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} n ON s.s_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey"""

VIEWS["school_fx"] = """
SELECT year, province, school_name, school_code, subject_type, admission_category, batch, major_group,
       min_score, min_rank, plan_count FROM (
  SELECT *, row_number() OVER (PARTITION BY year, province, school_code, subject_type, admission_category, batch,
         coalesce(major_group, '') ORDER BY src_order, src_line, src_supp, min_score NULLS FIRST,
         min_rank NULLS FIRST, plan_count) AS rn FROM school_raw) t
WHERE rn = 1"""

VIEWS["school_noise"] = """
SELECT src_order, src_line, src_supp, plan_count,
       CASE src_line % 5 WHEN 0 THEN '江苏省' WHEN 1 THEN ' js ' WHEN 2 THEN '重庆市' WHEN 3 THEN '' ELSE '广西壮族自治区' END AS province_raw,
       CASE plan_count % 6 WHEN 0 THEN '理科综合' WHEN 1 THEN '首选历史' WHEN 2 THEN '不分文理' WHEN 3 THEN NULL WHEN 4 THEN '文史' ELSE '其他' END AS subject_raw,
       CASE plan_count % 5 WHEN 0 THEN '艺术本科' WHEN 1 THEN '提前批次' WHEN 2 THEN '高职专科' WHEN 3 THEN '本科提前批次' ELSE '第二段' END AS batch_raw,
       CASE src_line % 4 WHEN 0 THEN CAST(CAST(min_score AS INT) AS STRING) || '(文化总分478)' WHEN 1 THEN '-' || CAST(plan_count AS STRING)
            WHEN 2 THEN '1,2' || CAST(plan_count AS STRING) ELSE ' ' END AS score_raw,
       CASE plan_count % 4 WHEN 0 THEN 'A001北京大学' WHEN 1 THEN '（' || school_name || '）' WHEN 2 THEN '1234' ELSE '普通类' END AS name_raw,
       school_code, school_name, major_group, year, province, subject_type, min_score, min_rank
FROM school_raw"""

VIEWS["meta_fx"] = """
SELECT p_name AS standard_name, min(p_name || ' ' || p_brand) AS school_name,
       'CITY_' || CAST(length(p_name) % 4 AS STRING) AS city, (length(p_name) % 3 = 0) AS is_985, (length(p_name) % 2 = 0) AS is_211,
       (length(p_name) % 5 <> 0) AS is_double_first_class,
       CASE WHEN p_name LIKE '%bolt' THEN NULL ELSE split_part(p_name, ' ', 2) END AS school_type
FROM {part} WHERE p_name NOT LIKE '%ring%' GROUP BY p_name
UNION ALL
SELECT split_part(p_name, ' ', 1) AS standard_name, min(p_name || ' ' || p_brand) AS school_name, 'CITY_X' AS city,
       true AS is_985, true AS is_211, true AS is_double_first_class, 'group' AS school_type
FROM {part} WHERE p_name LIKE 'cold%' OR p_name LIKE 'small%' GROUP BY split_part(p_name, ' ', 1)"""

VIEWS["items_fx"] = """
SELECT e.user_id AS image_id, e.event_id, CAST(e.event_id % 12 AS DOUBLE) * 40 + CAST(e.event_id % 7 AS DOUBLE) AS y_center,
       CAST(e.event_id % 5 AS DOUBLE) * 100 AS x_center, e.event_type || '_' || CAST(e.event_id AS STRING) AS text FROM {events} e"""

_DEPENDS = {name: [v for v in VIEWS if re.search(rf"\b{v}\b", sql)] for name, sql in VIEWS.items()}
# Derived tables whose Spark side is written with DataFrames (their SQL serves the check only).
_BUILT: dict[str, Callable] = {}


def define(name: str, sql: str, build: Callable | None = None) -> None:
    """Add a derived table next to the queries that use it."""
    VIEWS[name] = sql
    _DEPENDS[name] = [v for v in VIEWS if v != name and re.search(rf"\b{v}\b", sql)]
    if build is not None:
        _BUILT[name] = build


def _closure(names, stop=()) -> list[str]:
    """The names and all they depend on, dependencies first; names in ``stop`` are not opened."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered or name in stop:
            return
        for dep in _DEPENDS[name]:
            if dep != name:
                visit(dep)
        ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _named(text: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b{v}\b", text)]


def check_sql(body: str) -> str:
    """Full SQL of a check: the derived tables the body names, as CTEs, then the body."""
    text = body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in _closure(_named(body)))
    if ctes:
        text = f"WITH {ctes},\n{text[4:].strip()}" if text[:5].upper() == "WITH " else f"WITH {ctes}\n{text}"
    return re.sub(r"\{(%s)\}" % "|".join(BASE), r"\1", text)


class Inputs:
    """Given and derived tables of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._kept: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        if name in self._kept:
            return self._kept[name]
        return _BUILT[name](self) if name in _BUILT else self.sql(f"SELECT * FROM {name}")

    def once(self, name: str) -> DataFrame:
        """A derived table that a query reads several times, written once."""
        return written(self.view(name))

    def kept(self, name: str, *columns: str) -> Inputs:
        """The same tables, with a derived one written once, all its columns or those that are needed; all tables derived from it read the written rows."""
        out = Inputs(self.spark, self.folder)
        out._kept = {**self._kept, name: written(self.view(name).select(*columns or "*"))}
        return out

    def sql(self, body: str) -> DataFrame:
        """Input shaping written in SQL over given and derived tables."""
        ready = (*_BUILT, *self._kept)
        names = _closure(_named(body), stop=ready)
        ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
        text = f"WITH {ctes}\n{body}" if ctes else body
        used = {b: self.base(b) for b in BASE if "{%s}" % b in text}
        for built in (v for v in _named(text) if v in ready):
            text = re.sub(rf"\b{built}\b", "{%s}" % built, text)
            used[built] = self.view(built)
        return self.spark.sql(text, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        if name in BASE:
            return self.base(name)
        raise AttributeError(name)
