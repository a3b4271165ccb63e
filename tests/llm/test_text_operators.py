"""Line dedup, quality rules, sharding, packing, pieces and the pipeline on small and awkward tables."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from rankline.llm import linededup, omh, packing, pieces, quality, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, salt int, line string, row string, bucket int, kept string"


def docs(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 1, "x", 2, "l", "r", 3, "k") for i, t, s in rows], SCHEMA)


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


AWKWARD = [
    (1, None, "a"), (2, "", "b"), (None, "one two three", None), (3, "same text here", "a"), (3, "same text here", "a"), (4, "same text here", None), (5, "line\n\nline \nother", "c"),
    (6, "é😀▁ <|endoftext|> x", "c"), (7, " \n\t ", "c"), (8, words(1, 30_000), "d"), (9, "x" * 60_000, "d"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return docs(spark, AWKWARD)


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


# ---- line dedup


def brute_lines(rows, least):
    trim = lambda x: x.strip(" \t\n\v\f\r")
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if trim(line) and site is not None:
                sites[trim(line)].add(site)
    bad = {x for x, s in sites.items() if len(s) >= least}
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if trim(x) not in bad)) for i, t, _ in rows]


def test_lines_agree_with_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "\n".join(f"line {rng.zipf(1.5) % 40}" + " " * (i % 2) for _ in range(6)), f"s{i % 23}" if i % 11 else None) for i in range(300)]
    got = linededup.remove_boilerplate(docs(spark, rows), min_sites=10)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(brute_lines(rows, 10))


def test_lines_of_awkward_rows(awkward, empty):
    got = linededup.remove_boilerplate(awkward, min_sites=2, count_column="shard")
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=key) == sorted(brute_lines(AWKWARD, 2), key=key)
    assert got.columns == [c for c in awkward.columns if c != "shard"] + ["shard"]
    assert linededup.remove_boilerplate(empty).count() == 0


# ---- quality rules


def brute_statistics(text):
    import re

    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(found[i:i + 3]) for i in range(len(found) - 2))
    hit = {j for i in range(len(found) - 2) if windows[tuple(found[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_statistics_agree_with_brute_force(awkward):
    rows = quality.statistics(awkward).collect()
    assert sorted(tuple(r)[:6] for r in rows if r.doc_id is not None) == sorted((i, *brute_statistics(t)) for i, t, _ in AWKWARD if i is not None)
    for text in ("a b c a b c", "a b a b a b", "a b c d a b c", "x y", "p q r\x1cs p q"):
        assert quality.text_statistics(text)[:5] == brute_statistics(text)


def test_decision_list_learns_and_explains():
    rng = np.random.default_rng(0)
    values = rng.random((4000, 3))
    bad = (values[:, 0] > 0.8) & (values[:, 1] <= 0.3)
    learned = quality.learn(values, bad, ["words", "symbols", "upper"])
    hit = np.zeros(4000, dtype=bool)
    for rule in learned.rules:
        hit |= quality._holds(values, rule, ["words", "symbols", "upper"])
    fresh = rng.random((4000, 3))
    truth = (fresh[:, 0] > 0.8) & (fresh[:, 1] <= 0.3)
    guess = np.zeros(4000, dtype=bool)
    for rule in learned.rules:
        guess |= quality._holds(fresh, rule, ["words", "symbols", "upper"])
    assert (hit == bad).mean() > 0.99 and (guess == truth).mean() > 0.98
    assert "reject" in str(learned) and str(quality.learn(values, np.zeros(4000, dtype=bool), ["words", "symbols", "upper"])) == "keep all"


def test_verdicts_of_documents(spark, awkward, empty):
    rows = [(i, words(i, 80) + (" ###" * 40 if i % 4 == 0 else ""), "a") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(0, 160)] + [(None, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_verdicts(docs(spark, rows), labels).collect()}
    assert all(got[i].kept == (i % 4 != 0) and not got[i].base_failed for i in range(200))
    short = {r.doc_id: r for r in quality.quality_verdicts(awkward, labels).collect()}
    assert len(short) == len({i for i, _, _ in AWKWARD}) and short[1].base_failed and not short[1].kept and short[8].kept
    assert quality.quality_verdicts(empty, labels).count() == 0
    assert quality.keep_good(awkward, labels.limit(0)).columns == awkward.columns


def test_only_texts_of_kept_documents_go_to_python(spark, monkeypatch):
    plans, write = [], quality.stored
    monkeypatch.setattr(quality, "stored", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    rows = [(i, words(i, 80) + (" ###" * 40 if i % 4 == 0 else ""), "a") for i in range(80)] + [(None, words(5, 90), "b"), (7, None, "c"), (9, "short", None)]
    table = docs(spark, rows).withColumn("n_words", F.lit("own"))
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(80)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(table, labels)
    assert "MapInArrow" not in plans[0] and "ArrowEvalPython" in plans[0]
    assert kept.columns == table.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in table.collect() if r.text and len(r.text) > 20 and "###" not in r.text)


def test_few_texts_are_strings_of_python_at_once(monkeypatch):
    texts = pa.array([None if i % 7 == 0 else words(i, 60) for i in range(1000)])
    monkeypatch.setattr(quality, "PIECE", 64)
    found = np.array([c.to_pylist() for c in quality._measured(texts)]).T
    assert [tuple(r) for r in found] == [quality.text_statistics(t) for t in texts.to_pylist()]
    assert [len(c) for c in quality._measured(texts[:0])] == [0] * len(quality._STAT_FIELDS)


# ---- sharding


def test_sample_is_bounded_and_ties_on_a_threshold_are_judged_alike(spark):
    rows = [(i % 40 if i % 3 else 7, " ".join(["w%d" % (k % (60 if i % 2 else 12)) for k in range(80)]), "a") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2 == 0 and 0 or 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    table = docs(spark, rows)
    judged = quality.quality_verdicts(table, labels).collect()
    verdicts = {(tuple(r[c] for c in quality._STAT_FIELDS), r.base_failed, r.rule, r.kept) for r in judged}
    assert len(verdicts) == len({v[0] for v in verdicts}) == 2 and len(judged) == len(rows)
    stats = quality.statistics(table)
    assert str(quality.fit(stats, labels, sample=5)) and str(quality.fit(stats, labels, sample=20_000))


def check_shards(got, rows, shards, tolerance):
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.size, r.text_crc32) for r in got) == sorted(((i is None, i or 0), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    for s, members in by.items():
        assert 0 <= s < shards and sorted(m.slot for m in members) == list(range(len(members)))
    largest = max(r.size for r in got)
    share = sum(r.size for r in got) / shards
    for s in range(shards):
        assert abs(sum(m.size for m in by[s]) - share) <= tolerance * share + 1.01 * largest


def test_shards_are_even_and_gapless(spark, awkward, empty):
    rows = [(i, "hot text of a large group", "a") if i % 3 == 0 else (i, words(i, i % 50), "b") for i in range(4000)]
    check_shards(sharding.shard_documents(docs(spark, rows), carry=("doc_id", "text")).collect(), rows, 24, 0.01)
    check_shards(sharding.shard_documents(awkward, shards=3).collect(), AWKWARD, 3, 0.01)
    assert sharding.shard_documents(empty).count() == 0


# ---- packing


def check_packing(pieces_found, rows, limit=1024):
    encode = packing.Encoder(packing.vocabulary_path())
    whole = defaultdict(list)
    for i, text, _ in rows:
        ids = encode.slow.encode(text or "", add_special_tokens=False).ids + [0]
        whole[i].append(ids)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in pieces_found:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for members in by_sequence.values():
        at = 0
        for m in sorted(members, key=lambda m: m.offset):
            assert m.offset == at
            at += m.length
        assert at <= limit and (at == limit or at & (at - 1) == 0) and all(m.context == at for m in members)
    assert set(by_doc) == set(whole)
    for i, copies in whole.items():
        want = Counter()
        if len(copies) == 1:
            at = 0
            for m in sorted(by_doc[i], key=lambda m: m.start):
                assert m.start == at and m.doc_tokens == len(copies[0])
                assert m.ids_crc32 == zlib.crc32(np.array(copies[0][at:at + m.length], dtype="<u4").tobytes())
                at += m.length
            assert at == len(copies[0])
        else:
            for m in by_doc[i]:
                want[m.doc_tokens] += m.length
            assert sum(want.values()) == sum(map(len, copies))


def test_packing_is_whole_and_without_padding(spark, awkward, empty):
    check_packing(packing.pack_documents(awkward.coalesce(1)).collect(), AWKWARD)
    rows = [(i, words(i, 1 + i * 7 % 900), "a") for i in range(300)]
    found = packing.pack_documents(docs(spark, rows).coalesce(2), pool_tokens=50_000, step_tokens=8192).collect()
    check_packing(found, rows)
    steps = Counter()
    for r in found:
        steps[r.step_group] += r.length
    assert max(steps.values()) <= 8192 + 1024
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_pool_windows_are_full(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 3000, rng.integers(1, 60)).tolist() if seed else [1]
    seen = Counter()
    for window in packing.pack_pool(lengths):
        total = sum(n for _, _, n in window)
        assert total in packing.TIERS or total & (total - 1) == 0 and total < 1024
        for doc, start, n in window:
            assert n > 0
            for i in range(start, start + n):
                seen[doc, i] += 1
    assert len(seen) == sum(lengths) and set(seen.values()) == {1}


# ---- pieces


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.model_path())


def sample_texts():
    return [t or "" for _, t, _ in AWKWARD[:-2]] + [words(2, 400), "a  b   c", " lead", "trail ", "tab\tand\nbreak", "Straße für Öl", "中文字符测试", "\x00​"]


def test_without_dropout_pieces_equal_the_library(codec):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = [t.replace("▁", "") for t in sample_texts()]
    assert [ids.tolist() for ids, _ in codec.encode_many(texts, [1] * len(texts), 0)] == model.encode(texts)


def test_dropout_agrees_with_the_agenda_one_chunk_at_a_time(codec):
    for number, text in enumerate(sample_texts()):
        key = pieces.document_key(5, number)
        got = codec.encode_many([text], [key], 40)[0][0].tolist()
        chunks = [m[0] for m in codec.chunks.finditer(" " + text)] if text else []
        want = []
        for i, (chunk, mask) in enumerate(zip(chunks, pieces.skip_masks(key, np.arange(len(chunks)), 40).tolist())):
            want += codec._single(chunk, mask, key, i, 40)[0]
        assert got == want


def test_dropout_varies_and_decodes(spark, awkward, empty, codec):
    texts = sample_texts()
    plain = [i.tolist() for i, _ in codec.encode_many(texts, [1] * len(texts), 0)]
    for eighths in (26, 128, 250):
        one = [i.tolist() for i, _ in codec.encode_many(texts, [7] * len(texts), eighths)]
        assert [codec.decode(i) for i in one] == texts and one != plain
        assert one == [i.tolist() for i, _ in codec.encode_many(texts, [7] * len(texts), eighths)]
        assert one != [i.tolist() for i, _ in codec.encode_many(texts, [8] * len(texts), eighths)]
    share = np.unpackbits(pieces.skip_masks(3, np.arange(20_000), 26).view(np.uint8)).mean()
    assert abs(share - 26 / 256) < 0.001
    coded = pieces.encode(awkward)
    back = {(r.doc_id, r.text) for r in pieces.decode(coded).collect()}
    assert back == {(i, t) for i, t, _ in AWKWARD}
    rows = pieces.round_trip(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(r.lossless for r in rows)
    assert pieces.round_trip(empty).count() == 0 and pieces.encode(empty).count() == 0


# ---- pipeline


def brute_classes(rows, threshold=0.8):
    symbols = omh.Symbols()
    parts = [(i, symbols(t)) for i, t, _ in rows]
    parent = {i: i for i, _ in parts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, a) in enumerate(parts):
        for j, b in parts[:x]:
            if len(a) and len(b) and omh.aligned(a, b, threshold):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i, _ in parts}


def test_pipeline_agrees_with_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        text = "\n".join(words(1000 + i * 7 + k, 30) for k in range(4)) + "\nshared footer line"
        if i % 10 == 1:
            text = rows[-1][1]
        if i % 10 == 2:
            parts = rows[-1][1].split(" ")
            parts[40] = "changed"
            text = " ".join(parts)
        if i % 10 == 3:
            text += " ***" * 60
        if i % 10 == 4:
            text = "too short"
        rows.append((i, text, f"s{i % 12}"))
    rows += [(900, None, None), (901, "", "s1")]
    table = docs(spark, rows)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 10 not in (3, 4)), 0) for i in range(0, 120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    expect = {i: t for i, t, _ in rows}
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, str(tmp_path)).cache()
        if name != "packing":
            assert now.columns == table.columns
        if name == "quality_rules":
            expect = {i: t for i, t in expect.items() if i < 900 and i % 10 not in (3, 4)}
        elif name == "line_dedup":
            expect = {i: t.replace("\nshared footer line", "") for i, t in expect.items()}
            assert all(r.n_chars == len(r.text) for r in now.collect())
        elif name == "near_dedup":
            classes = brute_classes([(i, t, None) for i, t in expect.items()])
            expect = {i: t for i, t in expect.items() if classes[i] == i}
            assert len(expect) == 120 // 10 * 6
        else:
            check_packing(now.collect(), [(i, t, None) for i, t in expect.items()])
            continue
        assert {r.doc_id: r.text for r in now.collect()} == expect, name
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("length")).first()[0] == sum(r.length for r in now.collect())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table.limit(0), str(tmp_path)).count() == 0, name
        stage(spark, docs(spark, AWKWARD), str(tmp_path)).count()
