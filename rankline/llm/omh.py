"""Near-duplicate texts by Order MinHash, verified by banded alignment.

The k-mers are shingles of five words, each labelled with its occurrence in the text, so that all symbols of
a text differ. A sketch takes the smallest symbols under a hash and keeps them in text order; texts with equal sketches share
not only symbols but their order. Several sketches make a band; texts that share a band are candidates. A
candidate pair is aligned: symbols of both texts are matched inside a diagonal band, and the longest
common subsequence m gives the similarity m / (n_a + n_b - m), the Jaccard index of what aligns.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, row_key, stored, table
from .components import components
from .pieces import mix

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 48
SKETCHES = 4  # per band
MINIMA = 2  # per sketch
WHOLE = 32  # buckets of at most so many texts are compared fully
HEADS = 4  # of a larger bucket that its texts meet first
SPARE_PAIRS = 256  # pairs per text, of which the bits are compared in blocks
BLOCK = 128  # texts, or so, of a bucket that are compared at once with as many of other components
SALTS = 16
SHORT = 15  # symbols; texts of at most so many get exact keys as well
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Symbols:
    """Occurrence-labelled shingles of texts as 64-bit hashes, with a bounded memory of word hashes."""

    def __init__(self, shingle: int = SHINGLE):
        self.shingle, self.words = shingle, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.words
        if len(known) > 200_000:
            known.clear()
        values = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            values.append(h)
        w = np.array(values, dtype=np.uint64)
        k = min(self.shingle, len(w))
        n = len(w) - k + 1
        h = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            h = mix(h * _ODD + w[i:i + n])
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        occurrence = np.zeros(n, dtype=np.uint64)
        occurrence[order] = np.arange(n) - first
        return mix(h + occurrence * _ODD)


def sketch_bands(symbols: np.ndarray, bands: int = BANDS, sketches: int = SKETCHES, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """One hash per band, of the ordered minima of its sketches, and one bit per sketch. Texts of one symbol repeat it."""
    count = bands * sketches
    factors = mix(np.arange(1, count + 1, dtype=np.uint64) * _ODD + np.uint64(seed)) | np.uint64(1)
    out = np.empty(count, dtype=np.uint64)
    step = max(1, 4_000_000 // max(1, len(symbols)))  # bounds the table of a very long text
    for at in range(0, count, step):
        part = factors[at:at + step]
        hashed = symbols[None, :] * part[:, None]
        rows = np.arange(len(part))
        one = hashed.argmin(1)
        hashed[rows, one] = np.uint64(2**64 - 1)
        two = hashed.argmin(1) if len(symbols) > 1 else one
        low, high = np.minimum(one, two), np.maximum(one, two)  # text order
        out[at:at + step] = mix(symbols[low] * _ODD + symbols[high])
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(sketches):
        keys = mix(keys * _ODD + out[i::sketches])
    bits = np.zeros(-(-count // 64) * 64, dtype=np.uint8)
    bits[:count] = (out >> np.uint64(17)) & np.uint64(1)
    return keys, np.packbits(bits, bitorder="little").view("<u8")


def short_keys(symbols: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Keys of which texts of the threshold's similarity share one for certain, where one of them has at most ``SHORT`` * threshold symbols.

    Of n symbols, ordered by hash, a text at least so similar misses fewer than the first n - ceil(t n) + 1. Few symbols leave sketches to chance, so short
    texts get these keys too; none for longer texts.
    """
    n = len(symbols)
    if n > SHORT:
        return np.zeros(0, dtype=np.uint64)
    first = n - int(np.ceil(threshold * n - 1e-9)) + 1
    return mix(np.sort(mix(symbols + _ODD))[:first] + np.uint64(1))


def most_different_bits(threshold: float, count: int) -> int:
    """Bits in which two texts of the threshold's similarity differ at most, but for a chance of about 1 in 100,000.

    Two sketches agree with a chance of about t squared (0.95 of it in very short texts), and bits of unequal ones half the time.
    """
    q = (1 - 0.95 * threshold**2) / 2
    return int(np.ceil(count * q + 4.5 * np.sqrt(count * q * (1 - q))))


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two symbol sequences, or 0 where it is below the threshold.

    Symbols of a text are distinct, so their longest common subsequence is the longest rising run of match places. To reach the
    threshold at most (na + nb)(1 - t) / (1 + t) symbols may be unmatched, which bounds how far a match can be off the diagonal.
    """
    na, nb = len(a), len(b)
    need = threshold * (na + nb) / (1 + threshold)
    if min(na, nb) < need - 1e-9:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= na + nb - 2 * need + 1e-9
    if near.sum() < need - 1e-9:
        return 0.0
    i, j = i[near], j[near]
    j = j[np.argsort(i)]
    if (np.diff(j) > 0).all():
        m = len(j)
    else:
        ends: list[int] = []
        for x in j.tolist():
            at = bisect_left(ends, x)
            ends[at:at + 1] = [x]
        m = len(ends)
    value = m / (na + nb - m)
    return value if value >= threshold - 1e-12 else 0.0


def sketched(df: DataFrame, id_column: str, text_column: str, shingle: int, bands: int, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, digest of the words (d1, d2; null without words), bands (with the keys of short texts) and sketch bits of every document."""

    def run(batches):
        symbols = Symbols(shingle)
        for batch in batches:
            digests, keys, bits = [], [], []
            for text in batch["text"].to_pylist():
                s = symbols(text)
                value = xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else None
                digests.append((None, None) if value is None else tuple(int.from_bytes((value >> 64 * k & 2**64 - 1).to_bytes(8, "little"), "little", signed=True) for k in (0, 1)))
                band, bit = (None, None) if value is None else sketch_bands(s, bands)
                keys.append(None if value is None else np.concatenate([band, short_keys(s, threshold)]).view(np.int64))
                bits.append(None if value is None else bit.view(np.int64))
            longs = pa.list_(pa.int64())
            columns = [batch["doc_id"], pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), pa.array(keys, longs), pa.array(bits, longs)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "d1", "d2", "bands", "bits"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, d1 long, d2 long, bands array<long>, bits array<long>")


def symbol_table(df: DataFrame, nodes: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """node and symbols of the documents named in ``nodes``."""

    def run(batches):
        symbols = Symbols(shingle)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array([symbols(t).tobytes() for t in batch["text"].to_pylist()], pa.binary())], names=["node", "symbols"])

    rows = df.select(F.col(id_column).cast("long").alias("node"), F.col(text_column).cast("string").alias("text"))
    # The named documents grow with the input: the same shuffle join at every size.
    return rows.join(nodes.hint("merge"), "node", "left_semi").mapInArrow(run, "node long, symbols binary")


def verified(pairs: DataFrame, symbols: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, with ranks ra, rb) whose alignment reaches the threshold."""

    def run(batches):
        for batch in batches:
            keep = [
                aligned(np.frombuffer(batch["sa"][k].as_buffer(), dtype=np.uint64), np.frombuffer(batch["sb"][k].as_buffer(), dtype=np.uint64), threshold) > 0
                for k in range(batch.num_rows)
            ]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch[c].filter(mask) for c in ("a", "b", "ra", "rb")], names=["a", "b", "ra", "rb"])

    rows = pairs.join(symbols.select(F.col("node").alias("a"), F.col("symbols").alias("sa")), "a")
    rows = rows.join(symbols.select(F.col("node").alias("b"), F.col("symbols").alias("sb")), "b")
    return rows.select("a", "b", "ra", "rb", "sa", "sb").mapInArrow(run, "a long, b long, ra long, rb long")


def _pair(x: str, y: str, rank_x: str, rank_y: str) -> list:
    """Two texts as a (the smaller id) and b, with their ranks ra and rb."""
    first = F.col(x) < F.col(y)
    return [F.when(first, F.col(p)).otherwise(F.col(q)).alias(n) for p, q, n in ((x, y, "a"), (y, x, "b"), (rank_x, rank_y, "ra"), (rank_y, rank_x, "rb"))]


def _alike(x, y, most: int):
    """Few enough of the sketch bits differ; part of the join, so unlike pairs are never rows."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, n: s + n) <= most


def represented(entries: DataFrame, links: DataFrame) -> DataFrame:
    """Entries (key, node) of texts that link to a text of higher rank in the same bucket; of a text's links the one of highest rank counts.

    Rank is the number of bucket mates, then the smaller id, so the highest text of a bucket always stays.
    """
    ends = [F.struct(F.col(r).alias("rank"), (-F.col(c)).alias("late")) for c, r in (("a", "ra"), ("b", "rb"))]
    low = F.when(ends[0] < ends[1], F.col("a")).otherwise(F.col("b"))
    best = links.select(low.alias("node"), F.greatest(*ends).alias("high")).groupBy("node").agg(F.max("high").alias("best"))
    mates = entries.select("key", "node").join(best.select("node", (-F.col("best.late")).alias("mate")), "node")
    return mates.join(entries.select("key", F.col("node").alias("mate")), ["key", "mate"], "left_semi").select("key", "node")


def across(large: DataFrame, classes: DataFrame, symbols: DataFrame, threshold: float, most: int) -> DataFrame:
    """Links (a, b) that join the components (classes: node, component) of texts that share a bucket (large: key, node, bits), as far as any join them.

    In a bucket of several components each text outside the largest one meets all others, block by block. A pair is aligned in the first of
    its buckets, if its bits are alike and no link of the same two blocks joins its components already. Rows are texts, not pairs.
    """
    now = large.select("key", "node", "bits").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = now.groupBy("key", "component").agg(F.count("*").alias("m"))
    mixed = parts.groupBy("key").agg(F.sum("m").alias("n"), F.max(F.struct("m", "component")).alias("main")).where("main.m < n")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    now = stored(now.join(mixed.select("key", F.col("main.component").alias("main"), blocks(F.col("n")).alias("all"), blocks(F.col("n") - F.col("main.m")).alias("outer")), "key"))
    keys = now.groupBy("node").agg(F.collect_set("key").alias("keys"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n).cast("long")).cast("int")
    out = now.where("component <> main").select("key", "node", "bits", "component", F.lit(True).alias("outside"), place("outer").alias("i"), each("all").alias("j"))
    rest = now.select("key", "node", "bits", "component", F.lit(False).alias("outside"), each("outer").alias("i"), place("all").alias("j"))
    cells = out.unionByName(rest)

    def alike(group: pa.Table):
        """Places of the outside texts, and for each the places of the others that are alike and of another component."""
        outside = np.array(group["outside"].to_pylist())
        bits = np.array(group["bits"].to_pylist(), dtype=np.int64).view(np.uint64)
        own = group["component"].to_numpy()
        ys = np.flatnonzero(~outside)
        for x in np.flatnonzero(outside).tolist():
            near = ys[(np.bitwise_count(bits[ys] ^ bits[x]).sum(1) <= most) & (own[ys] != own[x])]
            if len(near):
                yield x, near

    def mark(group: pa.Table) -> pa.Table:
        """Only the texts of a cell that are alike any other of it: bits alone decide, and few texts are left."""
        keep = np.zeros(group.num_rows, dtype=bool)
        for x, near in alike(group):
            keep[x] = True
            keep[near] = True
        return group.filter(pa.array(keep))

    def run(group: pa.Table) -> pa.Table:
        key = group["key"][0].as_py()
        nodes, own = group["node"].to_pylist(), group["component"].to_pylist()
        shared = [set(k) for k in group["keys"].to_pylist()]
        texts = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in group["symbols"]]
        sizes = np.array([len(t) for t in texts])
        numbers = np.split(np.unique(np.concatenate(texts), return_inverse=True)[1], np.cumsum(sizes)[:-1])
        inside = np.zeros(sizes.sum(), dtype=bool)
        parent: dict[int, int] = {}
        found = []

        def root(c):
            while (d := parent.get(c, c)) != c:
                c = d
            return c

        for x, near in alike(group):
            inside[numbers[x]] = True
            common = np.add.reduceat(inside[np.concatenate([numbers[y] for y in near])].astype(np.int64), np.cumsum(sizes[near]) - sizes[near])
            inside[numbers[x]] = False
            # Too few symbols in common, in whatever order, cannot align to the threshold.
            for y in near[common >= threshold * (sizes[x] + sizes[near]) / (1 + threshold) - 1e-9].tolist():
                p, q = root(own[x]), root(own[y])
                if p != q and min(shared[x] & shared[y]) == key and aligned(texts[x], texts[y], threshold) > 0:
                    parent[max(p, q)] = min(p, q)
                    found.append((min(nodes[x], nodes[y]), max(nodes[x], nodes[y])))
        return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate("ab")})

    marked = stored(cells.groupBy("key", "i", "j").applyInArrow(mark, cells.schema))
    found = stored(marked.join(keys, "node").join(symbols, "node").groupBy("key", "i", "j").applyInArrow(run, "a long, b long"))
    discard(marked, now)
    return found


def ranked(entries: DataFrame, bits: DataFrame) -> DataFrame:
    """Entries (key, node and n, the texts of the bucket) with the bits of their text and its rank ``shared``, the sum of n over its buckets."""
    texts = entries.groupBy("node").agg(F.sum("n").alias("shared"), F.collect_list(F.struct("key", "n")).alias("at"))
    # Texts grow with the input: the same shuffle join at every size.
    return texts.join(bits.hint("merge"), "node").select("node", "bits", "shared", F.explode("at").alias("at")).select("at.key", "node", "bits", "at.n", "shared")


def candidate_links(buckets: DataFrame, symbols: DataFrame, threshold: float, whole: int, most: int) -> DataFrame:
    """Edges of ``bucket_links`` for buckets with the columns key, node, bits."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n"))
    bits = buckets.groupBy("node").agg(F.first("bits").alias("bits"))
    return bucket_links(stored(ranked(buckets.select("key", "node").join(sizes, "key"), bits)), symbols, threshold, whole, most)


def bucket_links(buckets: DataFrame, symbols: DataFrame, threshold: float, whole: int, most: int) -> DataFrame:
    """Edges (a, b) with the connected components of all links between texts that share a bucket (columns of ``ranked``). Texts whose bits differ in more than ``most`` places are not aligned.

    Buckets of at most ``whole`` texts are compared fully. The texts of a larger one meet its heads, those of highest rank. Heads leave, and so do texts
    that link to one or to a text of higher rank. The next round takes four times as many heads, until what is left makes at most ``SPARE_PAIRS`` pairs per
    text. The rows of a round grow with the sizes of its buckets, not with their squares.
    At last all texts of large buckets, those that left too, are compared across the components that have come out, so each pair of a bucket is
    compared or known to be of one component.
    """
    active, links, tested, heads, spare = buckets, None, None, HEADS, SPARE_PAIRS * symbols.count()
    total = buckets.agg(F.coalesce(F.sum(F.when(F.col("n") > whole, (F.col("n") - 1) / 2)), F.lit(0))).first()[0]  # pairs of large buckets
    while True:
        small, large = active.where(F.col("n") <= whole).select("key", "node", "bits", "shared"), active.where(F.col("n") > whole)
        wanted = small.alias("x").join(small.alias("y"), "key").where("x.node < y.node").where(_alike(F.col("x.bits"), F.col("y.bits"), most))
        wanted = wanted.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.shared").alias("ra"), F.col("y.shared").alias("rb"))
        if total:
            place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("shared"), "node"))
            top = large.withColumn("place", place).where(F.col("place") <= heads).select("key", F.col("node").alias("head"), F.col("bits").alias("head_bits"), F.col("shared").alias("head_shared"))
            rest = large.join(top, "key").where("node <> head").where(_alike(F.col("bits"), F.col("head_bits"), most)).select("key", "node", *_pair("node", "head", "shared", "head_shared"))
            wanted = wanted.unionByName(rest.select("a", "b", "ra", "rb"))
        wanted = wanted.distinct()
        wanted = stored(wanted if tested is None else wanted.join(tested, ["a", "b"], "left_anti"))
        tested = wanted if tested is None else tested.unionByName(wanted)
        needed = wanted.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        found = stored(verified(wanted, symbols.join(needed, "node", "left_semi"), threshold))
        links = found if links is None else links.unionByName(found)
        if not total:  # all pairs have been compared
            return links.select("a", "b")
        gone = represented(large, found)  # the heads have met all others
        gone = gone.unionByName(rest.join(links, ["a", "b"], "left_semi").select("key", "node")).unionByName(top.select("key", F.col("head").alias("node")))
        left = stored(large.join(gone.distinct(), ["key", "node"], "left_anti").select("key", "node", "bits", "shared"))
        sizes = left.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        if sizes.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0))).first()[0] <= spare:
            break
        active, heads = stored(left.join(sizes, "key")), heads * 4
    classes = stored(components(links))
    stars = classes.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
    return stars.unionByName(across(buckets.where(F.col("n") > whole), classes, symbols, threshold, most))


def near_duplicates(
    df: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, bands: int = BANDS, whole: int = WHOLE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), kept (doc_id = class_id).

    Classes are the connected components of links with an alignment similarity of ``threshold`` or more, over shingles of ``shingle`` words;
    words are cut at white space and compared without case, a shorter text is one shingle. Texts with the same words are one text from the
    start, so their copies are counted and never paired. Texts without words (null, empty) are no duplicates of anything. Rows without id
    have a null class and are not kept as its head; texts that only such rows have take no part. doc_id names a document: rows that share one are one vertex, and repeated rows get the same
    class. Very long texts are aligned whole. Other columns are left out, so names cannot clash. An empty table gives an empty result.
    """
    docs = stored(sketched(df, id_column, text_column, shingle, bands, threshold))
    texts = docs.where("d1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    sketches = stored(texts)
    texts, documents = stored(sketches.select("d1", "d2", "node", "copies")), stored(docs.select("doc_id", "d1", "d2"))
    discard(docs)
    # Most bands are of one text only; the others get their bits once those are gone.
    rows = sketches.select("node", F.explode("bands").alias("key"))
    several = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = rows.join(several.hint("merge"), "key")
    buckets = stored(ranked(shared, sketches.select("node", "bits")))
    discard(sketches)
    symbols = stored(symbol_table(df, buckets.select("node").distinct(), id_column, text_column, shingle))
    links = stored(components(bucket_links(buckets, symbols, threshold, whole, most_different_bits(threshold, bands * SKETCHES))))
    discard(buckets, symbols)

    classes = texts.select("d1", "d2", "node", "copies").join(links, "node", "left").withColumn("class_id", F.coalesce("component", "node"))
    # Only texts with copies or links need a row here; salts spread the copies of one text.
    classes = stored(classes.where("copies > 1 OR component IS NOT NULL").select("d1", "d2", "class_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    out = documents.select("doc_id", "d1", "d2", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")).join(classes, ["d1", "d2", "salt"], "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce(F.col("doc_id") == class_id, F.lit(False)).alias("kept"))


def op8(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Whole rows without those that a smaller id of their class stands for.

    Rows equal in id and text are one document, of which one row stays. Rows that share an id but differ in text are documents of their
    own: each stays unless a row of another text stands for it (one with an id of its own, if there is any). Rows without id stay.
    """
    marked = docs.select("doc_id", *row_key("text")).where("doc_id IS NOT NULL")
    several = stored(marked.groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_distinct("k1", "k2").alias("texts")).where("rows > 1"))
    repeated, mixed = several.where("texts = 1").select("doc_id"), several.where("texts > 1").select("doc_id")
    if not several.isEmpty():
        # Few ids as a rule, and of a known size. Texts that share an id get one from their hash, above all others.
        own = F.lit(2**62) + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
        docs = docs.join(mixed.withColumn("_mixed", F.lit(True)), "doc_id", "left").join(repeated.withColumn("_repeated", F.lit(True)), "doc_id", "left")
        docs = docs.withColumns({"_id": F.when(F.col("_mixed"), own).otherwise(F.col("doc_id")), "_once": ~F.coalesce("_mixed", "_repeated", F.lit(False))}).drop("_mixed", "_repeated")
    else:
        docs = docs.withColumns({"_id": F.col("doc_id"), "_once": F.lit(True)})
    classes = near_duplicates(docs, id_column="_id")
    gone = classes.where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    left = docs.join(gone.hint("merge"), "_id", "left_anti")
    if several.isEmpty():
        return left.drop("_id", "_once")
    return left.where("_once").unionByName(left.where("NOT _once").dropDuplicates(["_id"])).drop("_id", "_once")
