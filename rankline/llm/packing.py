"""Hierarchical packing of tokenised documents into windows of several context sizes.

A document's full windows of the longest size stand alone. What is left is routed to the tier of the
smallest context that holds it. Tiers are packed from long to short: each document opens a window of
its tier, and the gap is filled from shorter tiers, best fit first, at last by cutting one document.
Windows are so filled to the last token. Finished windows are dealt to step groups of equal tokens.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

TIERS = (128, 256, 512, 1024)
POOL_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
END_ID = 0
VOCABULARY = "byte_bpe_50k"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Path of a public tokenizer's JSON file, without the ending."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json").removesuffix(".json")


class Encoder:
    """Token ids of texts, equal to those of the tokenizers library for the JSON file.

    The same vocabulary as merge ranks lies beside it and is several times faster to apply. A text that
    contains a special token's string goes through the JSON file, which reads it as that token.
    """

    # The published pattern of this vocabulary, with possessive repeats: same splits, no backtracking.
    PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(f"{path}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.slow = Tokenizer.from_file(f"{path}.json")
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast(text)


class Tier:
    """Pieces (document, start, length) kept by length."""

    def __init__(self):
        self.lengths: list[int] = []
        self.by_length: dict[int, list] = {}

    def add(self, piece) -> None:
        n = piece[2]
        if n not in self.by_length:
            insort(self.lengths, n)
            self.by_length[n] = []
        self.by_length[n].append(piece)

    def take(self, n: int):
        pieces = self.by_length[n]
        piece = pieces.pop()
        if not pieces:
            del self.by_length[n]
            del self.lengths[bisect_left(self.lengths, n)]
        return piece

    def best_fit(self, room: int):
        """The longest piece of at most ``room``, or None."""
        i = bisect_right(self.lengths, room)
        return self.take(self.lengths[i - 1]) if i else None

    def shortest(self):
        return self.take(self.lengths[0]) if self.lengths else None


def pack_pool(lengths: list[int], tiers=TIERS) -> list[list[tuple[int, int, int]]]:
    """Windows, each a list of pieces (document, start, length); every window's total is one of the tiers or a power of two."""
    longest = tiers[-1]
    waiting = [Tier() for _ in tiers]

    def route(piece) -> None:
        waiting[bisect_left(tiers, piece[2])].add(piece)

    windows = []
    for doc, n in enumerate(lengths):
        full = n // longest * longest
        windows += [[(doc, start, longest)] for start in range(0, full, longest)]
        if n > full:
            route((doc, full, n - full))
    rest: list = []
    for t in range(len(tiers) - 1, -1, -1):
        while waiting[t].lengths:
            window = [waiting[t].best_fit(tiers[t])]
            room = tiers[t] - window[0][2]
            while room:
                found = next((p for s in range(t, -1, -1) if (p := waiting[s].best_fit(room))), None)
                if found is None:  # nothing fits whole: cut the shortest that is left
                    found = next((p for s in range(t + 1) if (p := waiting[s].shortest())), None)
                    if found is None:
                        break
                    doc, start, n = found
                    route((doc, start + room, n - room))
                    found = (doc, start, room)
                window.append(found)
                room -= found[2]
            if room:
                rest = window
            else:
                windows.append(window)
    size = longest
    while rest:  # the last window of the pool has a gap nothing can fill: cut it into powers of two
        while size > sum(p[2] for p in rest):
            size //= 2
        head, room = [], size
        while room:
            doc, start, n = rest.pop(0)
            used = min(n, room)
            head.append((doc, start, used))
            room -= used
            if used < n:
                rest.insert(0, (doc, start + used, n - used))
        windows.append(head)
    return windows


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """Group of each window: longest first, each to the group with the fewest tokens so far."""
    groups = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        tokens, g = groups[0]
        out[i] = g
        heapq.heapreplace(groups, (tokens + sizes[i], g))
    return out


_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_group long"
)


def pack_documents(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, tiers=TIERS, end_id: int = END_ID,
    pool_tokens: int = POOL_TOKENS, step_tokens: int = STEP_TOKENS, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it stands in its document and in its sequence.

    Tasks tokenise and pack their own rows in pools of ``pool_tokens`` or more, so nothing is shuffled, a long document just
    fills many windows, and a task that runs again makes the same sequences. ``tiers``: context sizes, each a power of two. ``context`` is the sequence's
    total, always one of the tiers or, at the end of a pool, a smaller power of two, so no sequence is padded. ``step_group``: windows of a pool
    dealt to groups of about ``step_tokens``. ``with_ids`` adds the ids of the piece. ``tokenizer``: path of the vocabulary without ending.
    A null text counts as empty and gives one piece with the end id; repeated rows and null ids are packed like any document (a piece belongs
    to a row, repeated rows give repeated pieces); an empty table gives an empty result. Other columns are left out, so names cannot clash.
    """
    path = tokenizer or vocabulary_path()
    if any(t & (t - 1) for t in tiers) or sorted(set(tiers)) != list(tiers):
        raise ValueError("tiers must be rising powers of two")
    names = [f.split()[0] for f in _SCHEMA.split(", ")]

    def pack(batches):
        encode, part, counter, pools = Encoder(path), TaskContext.get().partitionId(), 0, 0

        def flush(docs):
            nonlocal counter, pools
            windows = pack_pool([len(ids) for _, ids in docs], tiers)
            totals = [sum(p[2] for p in w) for w in windows]
            groups = step_groups(totals, step_tokens)
            rows, ids_out = [], []
            for window, total, group in zip(windows, totals, groups, strict=True):
                offset, group_id = 0, (part << 40) + (pools << 16) + group
                for doc, start, n in window:
                    doc_id, ids = docs[doc]
                    piece = ids[start:start + n]
                    rows.append((doc_id, start, n, zlib.crc32(piece.tobytes()), len(ids), (part << 40) + counter, offset, total, group_id))
                    offset += n
                    if with_ids:
                        ids_out.append(piece)
                counter += 1
            pools += 1
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int32() if name == "context" else pa.int64()) for name, c in zip(names, columns, strict=True)]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids_out)])
                arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids_out).astype(np.int32))))
            return pa.RecordBatch.from_arrays(arrays, names=[*names, *(["ids"] if with_ids else [])])

        docs, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                docs.append((doc_id, np.array(ids, dtype="<u4")))
                held += len(ids)
                if held >= pool_tokens:
                    yield flush(docs)
                    docs, held = [], 0
        if docs:
            yield flush(docs)

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(pack, _SCHEMA + (", ids array<int>" if with_ids else ""))


def op2(spark, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))
