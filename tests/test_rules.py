"""Literal cases of the scalar rules."""

import pytest
from pyspark.sql import functions as F

from rankline.functions import rules, text, titles


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("raw, want", [("武汉大学第01组", ("武汉大学", "第01组")), ("北京大学", ("北京大学", "")), (" 清华大学A05组 ", ("清华大学", "A05组"))])
def test_split_group(spark, raw, want):
    school, group = text.split_group(F.lit(raw))
    assert (value(spark, school), value(spark, group)) == want


def test_row_line(spark):
    row = value(spark, text.row_line(F.lit("A00105 北京大学 第05组 化 691")))
    assert (row["school_code"], row["school_name"], row["major_group"], row["min_score"]) == ("A00105", "北京大学", "第05组", 691.0)
    assert "化" in row["notes"]
    row = value(spark, text.row_line(F.lit("A00205 清华大学第05组 不限 690")))
    assert (row["school_name"], row["major_group"], row["min_score"], row["notes"]) == ("清华大学", "第05组", 690.0, None)
    assert value(spark, text.row_line(F.lit("说明文字"))) is None


def test_split_school_keeps_code_with_digit_tail(spark):
    df = spark.createDataFrame([("A00104", "北京大学"), ("A001北京大学", None), (None, "B012 清华大学")], "c string, n string")
    rows = text.with_split_school(df, "c", "n", "code", "name").select("code", "name").collect()
    assert [tuple(r) for r in rows] == [("A00104", "北京大学"), ("A001", "北京大学"), ("B012", "清华大学")]


@pytest.mark.parametrize("raw, want", [("606\n(文化总分478)", 606.0), ("-12", 12.0), ("1,212", 1.0), (" ", None), ("（5）", None), ("６９１", 691.0)])
def test_to_float(spark, raw, want):
    assert value(spark, text.to_float(F.lit(raw))) == want


@pytest.mark.parametrize("raw, want", [("12.9", 12), ("-3.7", -3), ("1,2", None), ("inf", None), ("12d", None), ("", None)])
def test_to_int(spark, raw, want):
    assert value(spark, text.to_int(F.lit(raw))) == want


def test_unreachable_batch_alias(spark):
    assert value(spark, rules.batch_name(F.lit("艺术本科"))) == "本科批"


@pytest.mark.parametrize("names, want", [
    (["1.png", "10.png", "2.png"], ["1.png", "2.png", "10.png"]), (["2.JPG", "1.png", "10.PNG", "3.jpg"], ["1.png", "2.JPG", "3.jpg", "10.PNG"]),
    (["page10.png", "page2.png", "a.png", "7.png"], ["7.png", "a.png", "page2.png", "page10.png"]),
])
def test_natural_order(spark, names, want):
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r["p"] for r in df.orderBy(text.natural_key(F.col("p"))).collect()] == want


@pytest.mark.parametrize("given, name, title, want", [("本科批", "专科", "", "本科批"), (None, "", "高职高专普通批", "专科批"), (None, "", "", "本科批")])
def test_batch_from_context(spark, given, name, title, want):
    got = rules.batch_from_context(F.lit(given).cast("string"), F.lit(name), F.lit(title), F.lit(""))
    assert value(spark, got) == want


def test_record_type(spark):
    cases = {"2024年逐分段统计表": "rank", "征求志愿计划": "unknown", "平行志愿投档线": "school", "录取控制分数线": "control", "专业录取情况": "major"}
    for title, want in cases.items():
        assert value(spark, titles.record_type(F.lit(title))) == want
