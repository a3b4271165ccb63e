"""Quality rules: text statistics and a learned decision list that runs as one Spark conditional expression.

Statistics cover every word of every text. The list is grown by sequential covering on labelled
documents: a rule gains threshold conditions on one part of the sample, loses conditions that
do not hold up on the other part, and the documents it covers leave before the next rule.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table

SYMBOLS = "#*$%&|<>"
PIECE = 256  # texts that are strings of Python at once
_NOT_WORD = re.compile("[\x20\x09-\x0d]+")
_STAT_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks")
# Shares a rule may test; each is read from the statistics with an expression both Spark and numpy can run.
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "marks": ("n_marks", "n_words"),
}


def repeated_words(words: list) -> int:
    """Words inside 3-word windows that occur twice or more in the list."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    pair = ids[:-2] * len(number) + ids[1:-1]
    if len(number) > 2_000_000:  # keeps the product of three ids below 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair * len(number) + ids[2:]
    _, place, times = np.unique(window, return_inverse=True, return_counts=True)
    hit = times[place] > 1
    inside = np.zeros(n, dtype=bool)
    for shift in range(3):
        inside[shift:n - 2 + shift] |= hit
    return int(inside.sum())


def text_statistics(text: str | None) -> tuple[int, ...]:
    """The values of _STAT_FIELDS for one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly space and \x09-\x0d
    lines = [line for line in text.split("\n") if _NOT_WORD.sub("", line)]
    return (
        len(words),
        len(_NOT_WORD.sub("", text)),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(map(str.isupper, text)),
        len(raw) - len(raw.translate(None, b"0123456789")),
        text.count("!") + text.count("?"),
    )


def _measured(texts: pa.Array) -> list[pa.Array]:
    """The columns of _STAT_FIELDS for the texts; a few of them are strings of Python at a time."""
    found = [text_statistics(t) for at in range(0, len(texts), PIECE) for t in texts.slice(at, PIECE).to_pylist()]
    found = np.array(found, dtype=np.int64).reshape(-1, len(_STAT_FIELDS))
    return [pa.array(found[:, i]) for i in range(len(_STAT_FIELDS))]


def statistics(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the statistics of each text; a null text counts as empty. Other columns are left out."""

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *_measured(batch["text"])], names=["doc_id", *_STAT_FIELDS])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(measure, ", ".join(f"{c} long" for c in ("doc_id", *_STAT_FIELDS)))


def rows_with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the whole row and the statistics of its text. Only the text goes to Python, once; the rows stay in the JVM."""

    def measure(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_measured(texts), names=list(_STAT_FIELDS))

    found = F.arrow_udf(measure, ", ".join(f"{c} long" for c in _STAT_FIELDS))(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*docs.columns).alias("row"), found.alias("found")).select("doc_id", "row", "found.*")


def feature(name: str) -> Column:
    top, under = FEATURES[name]
    return F.col(top).cast("double") if under is None else F.col(top) / F.greatest(F.col(under), F.lit(1)).cast("double")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


class DecisionList:
    """Ordered rules; each is a list of (feature, '<=' or '>', threshold). The first that holds rejects."""

    def __init__(self, rules: list[list[tuple[str, str, float]]]):
        self.rules = rules

    def rule_number(self) -> Column:
        """1 for the first rule, 2 for the second, ...; null where none holds."""
        out = None
        for i, rule in enumerate(self.rules, 1):
            holds = F.lit(True)
            for name, side, value in rule:
                holds &= feature(name) <= value if side == "<=" else feature(name) > value
            out = F.when(holds, i) if out is None else out.when(holds, i)
        return F.lit(None).cast("int") if out is None else out

    def __str__(self) -> str:
        return "\n".join(" and ".join(f"{n} {s} {v:.6g}" for n, s, v in rule) + " -> reject" for rule in self.rules) or "keep all"


def _holds(values: np.ndarray, rule, names) -> np.ndarray:
    out = np.ones(len(values), dtype=bool)
    for name, side, value in rule:
        column = values[:, names.index(name)]
        out &= column <= value if side == "<=" else column > value
    return out


def _grow(values, bad, names, cuts, longest):
    """Add the condition with the largest gain until only bad rows are left or nothing gains."""
    rule, now = [], np.ones(len(values), dtype=bool)
    while len(rule) < longest and (~bad[now]).any():
        p0, n0 = bad[now].sum(), (~bad[now]).sum()
        best, found = 1e-9, None
        for j, name in enumerate(names):
            column = values[now, j]
            order = np.argsort(column, kind="stable")
            sorted_bad = np.concatenate([[0], np.cumsum(bad[now][order])])
            at = np.searchsorted(column[order], cuts[name], "right")
            for side in ("<=", ">"):
                n_cov = at if side == "<=" else len(column) - at
                p = sorted_bad[at] if side == "<=" else p0 - sorted_bad[at]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / np.maximum(n_cov, 1)) - np.log2(p0 / (p0 + n0))), -np.inf)
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best:
                    best, found = float(gain[k]), (name, side, float(cuts[name][k]))
        if found is None:
            break
        name, side, value = found
        column = values[now, names.index(name)]
        above = column[column > value]
        if len(above):  # halfway to the next value seen, so that a small departure does not decide
            found = (name, side, float((column[column <= value].max(initial=value) + above.min()) / 2))
        rule.append(found)
        now &= _holds(values, [found], names)
    return rule


def _prune(rule, values, bad, names):
    """The prefix of the rule with the best share of bad over good on rows it was not grown on."""

    def worth(r):
        hit = _holds(values, r, names)
        p, n = bad[hit].sum(), (~bad[hit]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:i] for i in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))


def learn(values: np.ndarray, bad: np.ndarray, names: list[str], precision: float = 0.95, least: int = 5, longest: int = 4, most: int = 12) -> DecisionList:
    """Sequential covering. A rule enters only if at least ``precision`` of all rows it covers, and of those
    it was not grown on, are bad, and it covers ``least`` bad rows or more."""
    rules: list = []
    cuts = {name: np.unique(np.quantile(values[:, j], np.linspace(0, 1, 129))) if len(values) else np.array([]) for j, name in enumerate(names)}
    left = np.ones(len(values), dtype=bool)
    part = np.arange(len(values)) % 3 < 2
    while len(rules) < most and (bad & left).any():
        grow, held = left & part, left & ~part
        rule = _grow(values[grow], bad[grow], names, cuts, longest)
        if not rule:
            break
        rule = _prune(rule, values[held], bad[held], names) if held.any() else rule
        hit = _holds(values, rule, names) & left
        p, n, ph, nh = (bad & hit).sum(), (~bad & hit).sum(), (bad & hit & held).sum(), (~bad & hit & held).sum()
        if p < least or p < precision * (p + n) or ph < precision * (ph + nh):
            break
        rules.append(rule)
        left &= ~hit
    return DecisionList(rules)


def fit(stats: DataFrame, labels: DataFrame, sample: int = 20_000, **options) -> DecisionList:
    """Learn from at most ``sample`` labelled documents that pass the base rule (those with the smallest hash of id and statistics; a stated bound).

    labels: doc_id, quality (0 bad, 1 good; null rows and null ids are ignored; with several labels the worst counts).
    No labels at all give a list that keeps everything.
    """
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    names = list(FEATURES)
    rows = stats.where(~base_failed()).select("doc_id", *[feature(n).alias(n) for n in names]).distinct()
    rows = stored(rows.join(marked, "doc_id").withColumn("r", F.xxhash64("doc_id", *names)))
    # A sort with a limit would send so many rows of every task; the hash cuts the sample out where the rows lie, with slack for its chance.
    count = rows.count()
    slack = sample + 8 * int(np.sqrt(sample)) + 50
    near = rows if count <= slack else rows.where(F.col("r") < int(-(2**63) + 2**64 * (slack / count)))
    found = sorted(near.collect(), key=lambda r: (r["r"], *[r[n] for n in names]))[:sample]
    values = np.array([[r[n] for n in names] for r in found], dtype=float).reshape(-1, len(names))
    return learn(values, np.array([r["bad"] for r in found], dtype=bool), names, **options)


def judge(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """Add base_failed, the number of the rejecting rule and kept."""
    failed = base_failed()
    number = rules.rule_number()
    return stats.withColumns({"base_failed": failed, "rule": number.cast("int"), "kept": ~failed & number.isNull()})


def quality_verdicts(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document with statistics and verdict.

    Null and empty texts have no words and fail the base rule; repeated rows get equal verdicts, one row each;
    an empty table gives an empty result. Other columns are left out, so their names cannot clash.
    """
    stats = stored(statistics(df, id_column, text_column))
    return judge(stats, fit(stats, labels))


def op10(spark, folder: str) -> DataFrame:
    judged = quality_verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the verdict keeps, with all their columns; rules are learned from the labelled ones among them."""
    measured = stored(rows_with_statistics(docs))  # the fit reads the statistics alone
    return judge(measured, fit(measured, labels)).where("kept").select("row.*")
