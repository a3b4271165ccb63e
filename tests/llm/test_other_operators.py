"""Text and embedding near-duplicates, chats, pages and archives on small and awkward tables, and the catalogue."""

import base64
import hashlib
import struct

import __spark_entry__
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from rankline.llm import catalog, chat, components, epsgrid, htmltext, omh, sharding, warc
from test_text_operators import AWKWARD, brute_classes, docs, words

from compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


def test_entry_holds_all_queries():
    names = __spark_entry__.queries()
    assert [n for i in range(1, 14) for n in names if n.startswith(f"op{i}_")] == list(catalog.QUERIES) and "pipeline" in names
    assert set(catalog.ORACLE_SQL) < set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_agrees_with_its_sql(spark, name):
    ok, message, _, _ = compare(spark, duck(FOLDER), name, catalog.QUERIES[name], catalog.ORACLE_SQL[name], FOLDER)
    assert ok, message


# ---- near-duplicates of texts


def edited(text, rng, n):
    parts = text.split(" ")
    for i in rng.integers(0, len(parts), n):
        parts[i] = "edit" + str(i)
    return " ".join(parts)


def test_text_classes_agree_with_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for base in range(12):
        text = words(base, 120)
        rows += [(len(rows) + k, edited(text, rng, k % 5) if k else text, "a") for k in range(8)]
    half = words(50, 60)
    rows += [(len(rows) + k, half + " " + words(60 + k, 60), "a") for k in range(6)]  # half in common: no duplicates
    order = words(70, 200).split(" ")
    rows += [(len(rows), " ".join(order), "a"), (len(rows) + 1, " ".join(order[100:] + order[:100]), "a")]  # the same shingles in another order
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_classes(rows)
    assert got[rows[-1][0]] != got[rows[-2][0]]


def test_large_group_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(2)
    text = words(5, 150)
    rows = [(i, edited(text, rng, i % 3) if i else text, "a") for i in range(150)]
    want = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(docs(spark, rows), whole=8).collect()}
    assert got == want


def drifting(seed, n, chains=3, reach=4):
    """Rows of chains of copies of copies: only texts of a few steps between them are near-duplicates."""
    rng = np.random.default_rng(seed)
    texts = [words(200 + seed + k, 120) for k in range(chains)]
    while len(texts) < n:
        texts.append(edited(texts[max(len(texts) % chains, len(texts) - chains * int(rng.integers(1, reach)))], rng, 2))
    return [(int(i), t, "a") for i, t in zip(rng.permutation(n), texts)]


def test_chains_in_one_large_bucket_agree_with_brute_force(spark):
    rows = drifting(3, 300)
    table = docs(spark, rows)
    buckets = omh.sketched(table, "doc_id", "text", omh.SHINGLE, omh.BANDS).selectExpr("1L AS key", "doc_id AS node", "bits")
    symbols = omh.symbol_table(table, buckets.select("node"), "doc_id", "text", omh.SHINGLE)
    links = omh.candidate_links(buckets, symbols, omh.THRESHOLD, omh.WHOLE, omh.most_different_bits(omh.THRESHOLD, omh.BANDS * omh.SKETCHES))
    got = {i: i for i, _, _ in rows} | {r.node: r.component for r in components.components(links).collect()}
    assert got == brute_classes(rows)


def test_drifting_copies_agree_with_brute_force(spark):
    rng = np.random.default_rng(2)
    text = words(5, 150)
    rows = drifting(7, 300) + [(300 + i, edited(text, rng, i % 3) if i else text, "a") for i in range(150)]
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(docs(spark, rows), whole=8).collect()}
    assert got == brute_classes(rows)


def test_large_buckets_are_settled_in_few_written_steps(spark, monkeypatch):
    """Each written table has a file per partition, so every further round costs as much on small tables as on large ones."""
    steps, write = [], omh.stored
    monkeypatch.setattr(omh, "stored", lambda df: steps.append(df.columns) or write(df))
    rng = np.random.default_rng(4)
    text, rows = words(9, 150), drifting(5, 120)
    rows += [(120 + i, edited(text, rng, i % 3) if i else text, "a") for i in range(60)]
    rows += [(180 + i, words(300 + i, 20) + " " + words(9, 60), "a") for i in range(40)]  # a common passage: alike, not linked
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(docs(spark, rows), whole=8).collect()}
    assert got == brute_classes(rows)
    assert len(steps) <= 15, steps


def test_text_classes_of_awkward_rows(spark):
    got = [(r.doc_id, r.class_id, r.kept) for r in omh.near_duplicates(docs(spark, AWKWARD)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    want = [(i, 3 if t == "same text here" else i, i is not None and i != 4) for i, t, _ in AWKWARD]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert omh.near_duplicates(docs(spark, [])).count() == 0


def test_short_texts_share_a_key_for_certain():
    rng = np.random.default_rng(11)
    symbols, shared = omh.Symbols(), 0
    for _ in range(3000):
        a = [str(x) for x in rng.integers(0, 10**6, int(rng.integers(5, 20)))]
        b = list(a)
        for _ in range(int(rng.integers(1, 3))):
            place = int(rng.integers(0, len(b) + 1))
            b[place:place + int(rng.integers(0, 2))] = [str(x) for x in rng.integers(0, 10**6, int(rng.integers(0, 2)))]
        x, y = symbols(" ".join(a)), symbols(" ".join(b))
        if min(len(x), len(y)) <= omh.SHORT * omh.THRESHOLD and omh.aligned(x, y) > 0:
            shared += 1
            assert set(omh.short_keys(x).tolist()) & set(omh.short_keys(y).tolist())
    assert shared > 500


def test_rows_that_share_an_id_but_not_a_text_stay(spark):
    a, b, c = words(1, 60), words(2, 60), words(3, 60)
    rows = [(1, a, "s"), (1, b, "s"), (1, b, "s"), (2, a, "s"), (3, c, "s"), (3, c, "s"), (4, c + " x", "s"), (None, a, "s"), (5, None, "s"), (5, "", "s"), (6, b + " y", "s")]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in omh.keep_one(docs(spark, rows)).collect()))
    # 1 holds two texts; 2 stands for the first of them, 6 for the second. 3 stands for 4.
    assert got == sorted([(False, 2, a), (False, 6, b + " y"), (False, 3, c), (True, 0, a), (False, 5, ""), (False, 5, "")])
    alone = [(1, a, "s"), (1, b, "s"), (1, b, "s"), (1, a + " z", "s")]
    assert sorted(r.text for r in omh.keep_one(docs(spark, alone)).collect()) in (sorted([a, b]), sorted([a + " z", b]))


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a, b = rng.permutation(12).astype(np.uint64), rng.permutation(14).astype(np.uint64)
        table = np.zeros((13, 15), dtype=int)
        for i in range(12):
            for j in range(14):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        m = table[-1, -1]
        value = m / (26 - m)
        assert omh.aligned(a, b, 0.2) == pytest.approx(value if value >= 0.2 else 0)


def test_components_agree_with_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- embeddings


def brute_links(rows, threshold=0.98):
    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, dtype=np.float32).astype(float)
        return v / np.linalg.norm(v)

    units = [unit(v) if label is not None and i is not None else None for i, v, label in rows]
    links = {i: set() for i, *_ in rows}
    counts = [0] * len(rows)
    for x, (i, _, p) in enumerate(rows):
        for y, (j, _, q) in enumerate(rows):
            if x != y and p == q and units[x] is not None and units[y] is not None and len(units[x]) == len(units[y]) and units[x] @ units[y] >= threshold:
                counts[x] += 1
                links[i].add(j)
    least = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least[i] = None if i is None else min(seen)
    return [(i, n, least[i], i is not None and least[i] == i) for (i, *_), n in zip(rows, counts)]


def test_embedding_links_agree_with_brute_force(spark):
    rng = np.random.default_rng(0)
    rows, base = [], rng.normal(size=(25, 16))
    for i in range(600):
        rows.append((i, (base[i % 25] + rng.normal(size=16) * rng.choice([0.02, 0.15, 0.3])).tolist(), int(i % 3)))
    rows += [(700 + i, rows[0][1], 0) for i in range(40)]
    rows += [(800, None, 0), (801, [0.0] * 16, 0), (802, [float("nan")] + [1.0] * 15, 0), (803, [None] + [1.0] * 15, 0), (804, rows[0][1], None), (None, rows[0][1], 0), (805, [1.0, 2.0], 0), (806, [2.0, 4.0], 0), (807, [float("inf")] * 16, 0)]
    frame = spark.createDataFrame([(i, v, p, 1, "x", "y", "z") for i, v, p in rows], "vec_id long, embedding array<float>, label int, node int, copies string, g1 string, salt string")
    got = [tuple(r) for r in epsgrid.link_embeddings(frame, per_block=32, sample=100).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(brute_links(rows), key=key)
    assert epsgrid.link_embeddings(frame.limit(0)).count() == 0


def test_links_of_vectors_of_any_magnitude_and_several_levels(spark, monkeypatch):
    monkeypatch.setattr(epsgrid, "TOP", 2)
    monkeypatch.setattr(epsgrid, "INTERVAL", 2)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(6, 5))
    rows = [(i, ((base[i % 6] + rng.normal(size=5) * 0.02) * 10.0 ** float(rng.integers(-200, 200))).tolist(), 0) for i in range(150)]
    rows += [(500, [1e-200, 0.0, 0.0, 0.0, 0.0], 1), (501, [1e200, 1e190, 0.0, 0.0, 0.0], 1), (502, [1e200] * 5, 1), (503, [1e-300] * 5, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in epsgrid.link_embeddings(frame, per_block=8).collect()}
    scaled = [(i, (np.array(v) / np.abs(v).max()).tolist(), p) for i, v, p in rows]
    assert got == {i: (n, c) for i, n, c, _ in brute_links(scaled)}


# ---- chats


def test_chats_of_awkward_rows(spark):
    long = [(9, i, "user", f"t{i}") for i in range(600)]
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 1, "assistant", "yo"), (4, 5, "user", "hi"), (4, 6, "assistant", "yo"), (4, None, "user", "<|im_end|>"),
        (5, 0, None, None), (6, 0, "", ""), (None, 0, "user", "lost"), (7, 0, "user", "b"), (7, 0, "user", "a"), (8, 0, "user", "x" * 100_000),
    ] + long + [(10, i, "user", f"t{i}") for i in range(300)]
    frame = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], "conv_id long, turn long, role string, text string, pos int, cid string, n int")
    got = {(r.conv_id, r.segment): r for r in chat.format_chats(frame).collect()}
    assert set(got) == {(4, 0), (5, 0), (6, 0), (None, 0), (7, 0), (8, 0), (9, 0), (9, 1), (9, 2)}
    assert got[4, 0].rendered == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user\n<| im_end|><|im_end|>\n"
    assert got[5, 0].rendered == "<|im_start|>unknown\n<|im_end|>\n" and got[7, 0].rendered.index("a<") < got[7, 0].rendered.index("b<")
    assert "".join(got[9, s].rendered for s in range(3)) == "".join(f"<|im_start|>user\nt{i}<|im_end|>\n" for i in range(600)) and got[9, 2].n_turns == 600
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_equal_chats_keep_the_smallest_id(spark):
    frame = spark.createDataFrame([(c, t, "user", f"m{t}") for c in (5, 3, 8) for t in range(2)] + [(4, 0, "user", "m0")], "conv_id long, turn long, role string, text string")
    assert [(r.conv_id, r.n_copies) for r in chat.format_chats(frame).collect()] == [(3, 3)]


def test_a_third_of_the_turns_in_one_conversation_and_of_one_number(spark):
    rows = [(None, 0, "user", f"lost {i:04d}") for i in range(400)] + [(c, t, "user", f"m{c % 7} {t}") for c in range(100) for t in range(8)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    placed = chat.prefixes(frame)
    sizes = [r["count"] for r in placed.where("NOT known").groupBy(F.expr("pos div 100")).count().collect()]
    assert sizes == [100] * 4
    got = {(r.conv_id, r.segment): r for r in chat.format_chats(frame).collect()}
    assert set(got) == {(None, 0), (None, 1)} | {(c, 0) for c in range(7)}
    assert (got[None, 0].rendered + got[None, 1].rendered).count("lost ") == 400 and got[None, 0].rendered.index("lost 0001") < got[None, 0].rendered.index("lost 0002")
    assert all(got[c, 0].n_copies == sum(x % 7 == c for x in range(100)) for c in range(7))


# ---- pages

PARTS = {
    "<div><p>one<p>two <b>bold</i> end</b></div><div class=sidebar>no</div>": "one\ntwo bold end",
    "<html><body class='has-sidebar'><header>H</header><main><h1>T</h1><p>a  b\n c</p><form>f</form></main><section id=comments><p>c</p></section></body>": "T\na b c",
    "<nav>n</nav><div class='wrap content-sidebar'><article><p>x &lt;y&gt; &#233;&nbsp;z</p><aside>s</aside><ul><li>1<li>2</ul></article><div class='ad'>buy</div></div>": "x <y> é z\n1\n2",
    "<p>a<script>var x='<p>no</p>'</script>b<style>p{}</style></p><!-- <p>gone</p> --><noscript>off</noscript>": "ab",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc", "5 < 6 and 7 > 3": "5 < 6 and 7 > 3", "<p title='1>0'>t</p>": "t", "": "", "<": "<", "<div": "<div",
    "<article><p>text</p><article class='comment'>rude</article><div class='cookie-notice'>ok?</div><div hidden>h</div></article>": "text",
    "<![CDATA[<p>raw</p>]]>": "<p>raw</p>",
}


@pytest.mark.parametrize("source", PARTS)
def test_text_of_a_page(source):
    assert htmltext.Page(source).text(set()) == PARTS[source]


def test_site_template_is_removed(spark):
    box = "<div><div>Follow our daily letter with a long text that stands on every page of the site</div></div>"
    rows = []
    for i in range(12):
        rows.append((i, f"https://a.example/{i}", f"<body>{box}<div><p>{words(i, 20)}</p><p>shared line</p>{box}</div></body>"))
        rows.append((100 + i, f"https://b{i}.example/{i}", f"<body><div><p>{words(i, 20)}</p>{box}</div></body>"))
    rows += [(200, None, f"<body>{box}</body>"), (201, "https://a.example/x", None), (None, "not a url", "<p>x</p>"), (202, "https://a.example/y", "<p>" + words(9, 50_000) + "</p>"), (3, rows[6][1], rows[6][2])]
    frame = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, template string, salt int")
    got = htmltext.extract_text(frame).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert all(text[i] == f"{words(i, 20)}\nshared line" for i in range(12)), "deleted where it recurs on the host, with paragraphs kept"
    assert all("Follow" in text[100 + i] for i in range(12)), "kept on hosts with a single page"
    assert "Follow" in text[200] and text[201] == "" and text[None] == "x" and text[202] == words(9, 50_000)
    assert htmltext.extract_text(frame.limit(0)).count() == 0


# ---- archives


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def test_pages_survive_the_archive(spark):
    rows = [(i, f"https://x.example/{i}", f"<p>{words(i % 15, 40)}</p>") for i in range(60)] + [(None, None, "lonely"), (None, "u", rows_html := "<p>twice</p>"), (80, "", rows_html), (81, "a b", None), (82, "c", ""), (70, "r", "rep"), (70, "r", "rep"), (83, "long", "é" * 300_000)]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "page_id long, url string, html string, sha1 string, salt int, first_id string")
    got = [tuple(r) for r in warc.archive_pages(frame).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem").collect()]
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        h = h or ""
        head = first.get(h)
        again = head is not None and head != i
        want.append((i, len(h.encode()), digest(h), "revisit" if again else "response", head if again else None, None))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert warc.archive_pages(frame.limit(0)).count() == 0


def test_a_task_that_ran_twice_in_another_order_leaves_each_page_once(spark, tmp_path):
    rows = [(i, f"https://x.example/{i}", f"<p>{words(i, 400)}</p>") for i in range(60)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}"
    lost = warc.write_archives(frame.orderBy(F.desc("page_id")).coalesce(1), folder, archive_bytes=5_000)  # files of an attempt that did not count
    kept = warc.write_archives(frame.coalesce(1), folder, archive_bytes=20_000)
    found = warc.read_written(kept, folder).collect()
    assert sorted(r.page_id for r in found) == list(range(60)) and not any(r.problem for r in found)
    assert warc.read_archives(spark, folder).count() == 120 and lost.count() > kept.count()
    short = kept.withColumn("records", F.col("records") + 1)
    assert [r.problem for r in warc.read_written(short.limit(1), folder).where("problem IS NOT NULL").collect()][0].endswith("records of %d" % (kept.first().records + 1))


def archive(pages, dictionary=b"some words that pages share " * 20):
    packer = zstandard.ZstdCompressor(dict_data=warc.as_dictionary(dictionary))
    out = [warc.record_bytes(i, "u", p, hashlib.sha1(p).hexdigest(), None, "0", "2024-01-01T00:00:00Z") for i, p in enumerate(pages)]
    return warc.dictionary_frame(dictionary) + b"".join(packer.compress(r) for r in out)


def test_reader_checks_frames_headers_and_lengths():
    pages = [b"some words that pages share", b"", b"x" * 300_000]
    good = archive(pages)
    assert [r["payload"] for r in warc.records("a", good)] == pages and not any(r.get("problem") for r in warc.records("a", good))
    assert [r.get("problem") for r in warc.records("a", good[:-3])] == [None, None, "frame is cut short"]
    assert [r["problem"] for r in warc.records("a", good[:20])] == ["dictionary frame is cut short"]
    plain = struct.pack("<II", warc.SKIPPABLE, 5) + b"words"
    assert warc.read_dictionary(memoryview(plain))[1] == 13
    record = warc.record_bytes(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, "0", "d")
    for damage, problem in ((record.replace(b"WARC/1.1", b"WARC/9.9"), "no WARC version line"), (record.replace(b"abc", b"abd"), "payload digest differs"), (record[:-1], "content-length does not match the block"), (record.replace(b"WARC-Date", b"X-Date"), "missing warc-date")):
        with pytest.raises(ValueError, match=problem):
            warc.parse_record(damage)


def test_shards_can_be_written(spark, tmp_path):
    rows = [(i, words(i, 10), "a") for i in range(100)]
    sharding.write_shards(sharding.shard_documents(docs(spark, rows), shards=4, carry=("doc_id", "text")), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 100
