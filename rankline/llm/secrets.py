"""Secret scans: fixed patterns, and a randomness test battery for what no pattern names. DataFrame functions only.

Runs of token characters are tested once per distinct run. The run's encoding is the smallest alphabet that holds it. Three tests say how
far it is from a uniform random string over that alphabet: chi-squared uniformity of its symbols, Wald-Wolfowitz runs of
symbols above and below the middle of the alphabet, and serial correlation of neighbours; Fisher's method combines their p-values.

Surviving these tests means little for a short run, so a second p-value asks whether text would look as even: under "symbols are drawn as
the corpus's own structured runs draw them", mean and variance of the chi-squared statistic are known exactly for every length. A run is reported if
Benjamini-Hochberg rejects that hypothesis within its encoding and length class and the battery does not reject randomness.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, stored, table

KINDS = ("assign", "access", "hex", "random")  # in the order they are listed
# Fixed patterns of the base scan; a match of an assignment counts if its value has six characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
LEAST_VALUE = 6
SHORTEST = 16  # characters of a run that is tested; below, no test has power
RUN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{SHORTEST},}}"
_DIGITS, _LOWER, _UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase
# Alphabets by name, the smallest first; a run has the first that holds all its characters.
ENCODINGS = {
    "decimal": _DIGITS, "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "lower": _LOWER, "upper": _UPPER, "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER, "BASE36": _DIGITS + _UPPER, "letters": _UPPER + _LOWER, "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_", "mixed": _UPPER + _LOWER + _DIGITS + "+/-_",
}
_EVERY = ENCODINGS["mixed"]
DISCOVERY = 0.01  # share of false discoveries accepted
REJECT = 0.001  # a run whose battery falls below is not random; it is structured text, and a reference for others
_BINS = 16  # per factor e of a p-value
_DEEPEST = 700  # -log of the smallest p-value told apart


def upper_tail(z: Column) -> Column:
    """Chance that a standard normal exceeds z; a rational approximation (fixed constants), its relative error below 1e-6 to z = 3."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = 0.5 * poly * F.exp(-x * x)
    return F.when(z >= 0, half).otherwise(1 - half)


def found(text: Column, kind: str) -> Column:
    """Matches of a pattern in order: kind, place in the order, code points since the match before, length, and the value (a run, or of an assignment what is assigned)."""
    pattern = F.lit(RUN if kind == "random" else PATTERNS[kind])
    between, whole = F.split(text, RUN if kind == "random" else PATTERNS[kind], -1), F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else whole
    rows = F.transform(F.arrays_zip(between.alias("gap"), whole.alias("all"), value.alias("value")), lambda m, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("at"), F.char_length(m["gap"]).cast("long").alias("gap"), F.char_length(m["all"]).cast("long").alias("len"),
        (m["value"] if kind == "random" else F.lit(None).cast("string")).alias("run"),
        (F.char_length(m["value"]) >= LEAST_VALUE if kind == "assign" else F.lit(True)).alias("good"),
    ))
    # The last gap has no match after it.
    return F.when(text.rlike(PATTERNS.get(kind, RUN)), F.filter(rows, lambda m: m["len"].isNotNull())).otherwise(F.filter(rows, lambda m: F.lit(False)))


def encoded(runs: DataFrame) -> DataFrame:
    """Add the run's encoding, its alphabet, the number k of its symbols and the run's length n."""
    name = None
    for e, alphabet in ENCODINGS.items():
        holds = F.length(F.translate("run", alphabet, "")) == 0
        name = F.when(holds, e) if name is None else name.when(holds, e)
    alphabets = F.create_map(*[F.lit(x) for pair in ENCODINGS.items() for x in pair])
    out = runs.withColumn("encoding", name)
    return out.withColumns({"alphabet": alphabets[F.col("encoding")], "n": F.length("run").cast("double")}).withColumn("k", F.length("alphabet").cast("double"))


def symbol_counts() -> Column:
    """How often each symbol of the alphabet stands in the run, in order of the alphabet."""
    return F.transform(F.split("alphabet", ""), lambda c: F.col("n") - F.length(F.replace(F.col("run"), c, F.lit(""))))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def battery(runs: DataFrame) -> DataFrame:
    """Runs (run) with encoding, alphabet, k, n, the chi-squared statistic, p-values of the three tests and ``p_random``, which combines them.

    A test without any spread to judge (all symbols on one side, or all equal) counts as failed.
    """
    rows = encoded(runs).withColumn("counts", symbol_counts())
    n, k = F.col("n"), F.col("k")
    rows = rows.withColumn("chi2", k / n * _sum(F.transform("counts", lambda c: c * c)) - n).drop("counts")
    free = k - 1
    # Wilson and Hilferty: the cube root of a chi-squared value is nearly normal.
    rows = rows.withColumn("p_uniform", upper_tail((F.cbrt(F.greatest(F.col("chi2"), F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))))

    # Runs of symbols below and above the middle of the alphabet.
    half = F.floor(k / 2).cast("int")
    sides = F.call_function("translate", F.col("run"), F.col("alphabet"), F.concat(F.repeat(F.lit("0"), half), F.repeat(F.lit("1"), k.cast("int") - half)))
    rows = rows.withColumn("sides", sides)
    low = F.length(F.replace(F.col("sides"), F.lit("1"), F.lit(""))).cast("double")
    blocks = F.length(F.regexp_replace(F.regexp_replace("sides", "0+", "0"), "1+", "1")).cast("double")
    rows = rows.withColumns({"low": low, "blocks": blocks}).drop("sides")
    mean = 2 * F.col("low") * (n - F.col("low")) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    rows = rows.withColumn("p_runs", F.when(spread > 0, 2 * upper_tail(F.abs(F.col("blocks") - mean) / F.sqrt(spread))).otherwise(0.0)).drop("low", "blocks")

    # Serial correlation of neighbours, the last with the first.
    rows = rows.withColumn("values", F.transform(F.split("run", ""), lambda c: F.call_function("instr", F.col("alphabet"), c).cast("double")))
    after = F.concat(F.slice("values", 2, F.size("values")), F.slice("values", 1, 1))
    rows = rows.withColumns({"s1": _sum(F.col("values")), "s2": _sum(F.transform("values", lambda x: x * x)), "s3": _sum(F.zip_with("values", after, lambda x, y: x * y))}).drop("values")
    scatter = n * F.col("s2") - F.col("s1") * F.col("s1")
    correlation = F.when(scatter > 0, (n * F.col("s3") - F.col("s1") * F.col("s1")) / scatter)
    deviation = F.abs(correlation + 1 / (n - 1)) / F.sqrt(n * (n - 3) / ((n + 1) * (n - 1) * (n - 1)))
    rows = rows.withColumn("p_serial", F.coalesce(2 * upper_tail(deviation), F.lit(0.0))).drop("s1", "s2", "s3")

    # Fisher: minus twice the sum of logs is chi-squared with six degrees, whose tail is closed.
    small = lambda c: F.log(F.greatest(F.col(c), F.lit(1e-300)))
    x = -(small("p_uniform") + small("p_runs") + small("p_serial"))
    return rows.withColumn("p_random", F.exp(-x) * (1 + x + x * x / 2))


def structure(tested: DataFrame) -> DataFrame:
    """encoding and the sums of the second and third powers of its symbol shares (s2, s3) in the runs that the battery rejects.

    The counts cover all distinct rejected runs, of any encoding; an encoding's shares are those of its own symbols among them. The table has a row
    per encoding. Where no structured run holds a symbol of an encoding, or the battery rejects less than ten times what it rejects by chance, even symbols
    are assumed, and then nothing is reported.
    """
    rejected = F.col("p_random") < REJECT
    sums = [F.coalesce(F.sum(F.when(rejected, F.col("n") - F.length(F.replace(F.col("run"), F.lit(c), F.lit(""))))), F.lit(0.0)) for c in _EVERY]
    sums = [F.when(F.count_if(rejected) >= 10 * REJECT * F.count("*"), c).otherwise(0.0).alias(f"c{i}") for i, c in enumerate(sums)]
    counts = tested.agg(*sums)
    rows = []
    for name, alphabet in ENCODINGS.items():
        own = F.array(*[F.col(f"c{_EVERY.index(c)}") for c in alphabet])
        total = _sum(own)
        power = lambda e, own=own, total=total, size=len(alphabet): F.when(total > 0, _sum(F.transform(own, lambda x: F.pow(x / total, F.lit(float(e)))))).otherwise(float(size) ** (1 - e))
        rows.append(F.struct(F.lit(name).alias("encoding"), power(2).alias("s2"), power(3).alias("s3")))
    return counts.select(F.inline(F.array(*rows)))



def discoveries(tested: DataFrame, discovery: float = DISCOVERY) -> DataFrame:
    """The runs that are random: not rejected by the battery, and more even than structured text by Benjamini-Hochberg within encoding and length class.

    p-values are counted in bins of a sixteenth of a factor e, each run at the upper edge of its bin, so the step-up procedure works
    on a table whose size does not depend on the number of runs, and errs to the careful side.
    """
    shape = stored(structure(tested))
    n, k = F.col("n"), F.col("k")
    rows = tested.join(shape, "encoding")
    pairs = n * (n - 1) / 2  # coincident pairs have mean pairs * s2 and this variance
    variance = pairs * (F.col("s2") - F.pow("s2", F.lit(2.0))) + n * (n - 1) * (n - 2) * F.greatest(F.col("s3") - F.pow("s2", F.lit(2.0)), F.lit(0.0))
    mean = k / n * (2 * pairs * F.col("s2") + n) - n
    p = upper_tail((mean - F.col("chi2")) / F.sqrt(F.greatest(variance, F.lit(1e-300))) * n / (2 * k))
    depth = F.least(F.lit(_DEEPEST * _BINS), F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * _BINS)).cast("int")
    rows = rows.select("run", "encoding", F.floor(F.log2("n")).cast("int").alias("class"), "p_random", depth.alias("depth"))
    bins = rows.groupBy("encoding", "class", "depth").agg(F.count("*").alias("m"))
    whole = Window.partitionBy("encoding", "class")
    reached = bins.withColumns({"below": F.sum("m").over(whole.orderBy(F.desc("depth"))), "all": F.sum("m").over(whole)})
    edge = F.exp(-F.col("depth") / _BINS)
    cut = stored(reached.where(edge <= discovery * F.col("below") / F.col("all")).groupBy("encoding", "class").agg(F.min("depth").alias("cut")))
    return rows.join(cut, ["encoding", "class"]).where((F.col("depth") >= F.col("cut")) & (F.col("p_random") >= REJECT)).select("run")


def scan(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", discovery: float = DISCOVERY) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, the end exclusive, by start and then kind (assign, access, hex, random), joined by commas. An
    assignment is the whole match. ``base_sha256`` is that of the spans of the first three kinds. Random runs are reported also inside other spans.

    Null and empty texts have no spans. Repeated rows get equal results, one row each; rows that share an id but differ in text are separate, a null
    doc_id stays null. Whole texts are scanned, however long; a text's matches are ordered by one window. Equal runs are tested once. Other columns
    are left out, so their names cannot clash. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    docs = df.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
    key = ["doc_id", "k1", "k2"]
    docs = stored(docs.select("doc_id", *row_key("doc_id", "text"), F.concat(*[found(F.col("text"), kind) for kind in KINDS]).alias("found")))

    # Repeated rows are one document until the end.
    matches = docs.where(F.size("found") > 0).dropDuplicates(["k1", "k2"]).select(*key, F.inline("found"))
    order = Window.partitionBy("k1", "k2", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matches = matches.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(order)).where("good")
    matches = stored(matches.select("k1", "k2", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "run"))

    tested = stored(battery(matches.where("kind = 3").select("run").distinct()))
    random = matches.where("kind = 3").join(discoveries(tested, discovery), "run", "left_semi")
    spans = matches.where("kind < 3").unionByName(random).select("k1", "k2", "start", "kind", "end")
    each = F.array_sort(F.collect_list(F.struct("start", "kind", "end")))
    names = F.array(*[F.lit(kind) for kind in KINDS])
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.count_if(F.col("kind") == i).alias(f"n_{KINDS[i]}") for i in range(3)]
    by_text = spans.groupBy("k1", "k2").agg(*counts, each.alias("all"))
    by_text = by_text.select("k1", "k2", *[f"n_{k}" for k in KINDS[:3]], F.sha2(told(F.filter("all", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), told(F.col("all")).alias("spans"))
    out = docs.select(*key).join(by_text, ["k1", "k2"], "left")
    return out.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def op11(spark, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"))
