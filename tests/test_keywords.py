"""Keyword automaton and dictionary evaluation against plain versions."""

import random
import time

from pyspark.sql import functions as F
from rankline.functions import titles
from rankline.operators import dictionary, keywords


def plain_first(rules, text):
    for rule in rules:
        if all(any(w in text for w in g) for g in rule.groups) and not any(w in text for w in rule.absent):
            return rule.result
    return None


def random_rules(rng, n, symbols="abc专科本批"):
    word = lambda: "".join(rng.choice(symbols) for _ in range(rng.randint(1, 5)))
    words = lambda k: tuple(word() for _ in range(rng.randint(1, k)))
    return [keywords.Rule(f"r{i}", tuple(words(3) for _ in range(rng.choice([0, 1, 1, 1, 2]) if i % 40 == 39 else rng.choice([1, 1, 2]))), words(2) if rng.random() < 0.4 else ()) for i in range(n)]


def test_first_rule_agrees_with_the_ordered_lists():
    rng = random.Random(1)
    for n in (1, 5, 60, 400):
        lists = {"x": random_rules(rng, n), "y": random_rules(rng, max(1, n // 2), "ab专")}
        book = keywords.RuleBook(lists)
        for _ in range(300):
            text = "".join(rng.choice("abc专科本批 x") for _ in range(rng.randint(0, 25)))
            assert book.first(text) == [plain_first(rules, text) for rules in lists.values()]


def test_words_inside_words_are_found():
    words = ["he", "she", "his", "hers", "e", "本科", "本科批", "科批", ""]
    automaton = keywords.Automaton(words)
    for text in ("ushers", "本科批次", "x", "", "shhis"):
        assert automaton.found(text) == {i for i, w in enumerate(words) if w in text}


def test_a_thousand_rules_cost_about_what_ten_do():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60)) for _ in range(400)]
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))

    def seconds(n):
        book = keywords.RuleBook({"x": [keywords.Rule(str(i), ((word(),),)) for i in range(n)]})
        best = 9.0
        for _ in range(3):
            start = time.perf_counter()
            for t in texts:
                book.first(t)
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(1000) < 4 * seconds(10)


def test_rules_of_a_table_with_nulls_and_repeats(spark):
    rules = {"category": keywords.rules_of(titles.CATEGORY_RULES["hebei"]), "subject": keywords.rules_of(titles.SUBJECT_RULES["hubei"])}
    texts = [None, "", "普通类物理", "普通类物理", "艺术（普通）历史", "专升本", "历史物理"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, title string")
    got = {r.n: (r.category, r.subject) for r in keywords.first_rules(df, "title", rules).collect()}
    assert got == {i: tuple(plain_first(r, t or "") for r in rules.values()) for i, t in enumerate(texts)}


def test_by_distinct_keeps_rows_nulls_and_replaces_columns(spark):
    rows = [(i, ["a", None, "b"][i % 3], i % 2) for i in range(50)] + [(1, None, 1)]
    df = spark.createDataFrame(rows, "n int, x string, y int")
    first = dictionary.Group(("x", "y"), lambda d: d.select("x", "y", F.concat(F.coalesce("x", F.lit("-")), F.col("y")).alias("z"), F.upper("x").alias("x2")))
    second = dictionary.Group(("n",), lambda d: d.select("n", (F.col("n").cast("int") + 1).alias("y")))
    out = dictionary.by_distinct(df, [first, second], salts=3)
    assert out.columns == ["n", "x", "z", "x2", "y"]
    assert sorted((r.n, r.x or "", r.y, r.z) for r in out.collect()) == sorted((n, x or "", n + 1, f"{x or '-'}{y}") for n, x, y in rows)
