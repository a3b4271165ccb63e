"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is encoded by an agenda of candidate merges, best score first. With dropout, each candidate taken
from the agenda is skipped if its keyed hash says so; the key is (seed, document, chunk of the text,
number of the candidate). The same key gives the same segmentation on any machine; another seed
gives another. Whatever is skipped, the pieces spell the text, so decoding gives it back exactly.
"""

from __future__ import annotations

import heapq
import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

MARK = "▁"  # how the vocabulary writes a space
MODEL = "piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 1
LONG_CHUNK = 20  # up to this many characters the candidates fit in the 64 bits of one mask
KNOWN_CHUNKS = 300_000  # distinct chunks a task remembers before it starts anew
LONG_TEXT = 1 << 20
TURN_CHUNKS = 200_000  # chunks segmented together
NEVER = np.int64(1 << 36)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def skip_masks(keys, numbers: np.ndarray, eighths: int) -> np.ndarray:
    """64 independent bits for each number, each set with chance ``eighths`` / 256: the binary digits of the chance
    fold eight hashed words, one hash bit per candidate and digit."""
    out = np.zeros(len(numbers), dtype=np.uint64)
    if not eighths:
        return out
    start = mix(np.asarray(keys, dtype=np.uint64) + (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    low = (eighths & -eighths).bit_length() - 1
    for digit in range(low, 8):
        word = mix(start + np.uint64((digit + 1) * 0xD1342543DE82EF95 & 2**64 - 1))
        out = out | word if eighths >> digit & 1 else out & word
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of all items of the slices, one slice after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Codec:
    """Vocabulary of a SentencePiece BPE model with byte fallback and without normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.ids, self.surface = {}, {}, []
        self.byte_ids = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                text = piece.replace(MARK, " ")
                self.ids[text], self.score[text] = i, -model.get_score(i)
                self.surface.append(text.encode())
        if any(" " in p.lstrip(" ") for p in self.ids):
            raise ValueError("a piece holds a space after a letter; texts cannot be cut at spaces")
        # No piece joins a line break with another character, so merges never cross one.
        alone = "\n" if not any("\n" in p and len(p) > 1 for p in self.ids) else ""
        # A literal mark character is written in bytes, else it would decode as a space.
        self.chunks = re.compile(f"{MARK}|{'|'.join([alone] if alone else [])}{'|' if alone else ''} +[^ {alone}{MARK}]*|[^ {alone}{MARK}]+")
        size = len(self.surface)
        codes = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    codes[left * size + right] = i
        self.size = np.int64(size)
        self.pairs = np.array(sorted(codes), dtype=np.int64)
        self.into = np.array([codes[c] for c in self.pairs.tolist()], dtype=np.int64)
        order = {x: k for k, x in enumerate(sorted(set(self.score.values())))}  # equal scores, equal rank
        rank = {i: order[self.score[p]] for p, i in self.ids.items()}
        self.rank = np.array([rank[i] for i in self.into.tolist()], dtype=np.int64)
        self.chars = {p: i for p, i in self.ids.items() if len(p) == 1}
        self._forget()

    def _forget(self) -> None:
        self.known: dict = {}
        self.letters, self.letter_at = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)  # characters of the known chunks, end to end
        self.roots, self.root_at = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)  # their ids without dropout
        self.limits = np.zeros(0, dtype=np.uint64)  # mask of the candidates these take

    def candidates(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the merges of neighbours; rank NEVER where there is none."""
        code = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        return np.where(self.pairs[at] == code, self.rank[at], NEVER), self.into[at]

    def segment_many(self, symbols: np.ndarray, lengths: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The agenda for many chunks side by side: in round k every chunk takes its best candidate, and skips it if bit k of its mask is set.

        ``symbols``: ids of the characters, chunk after chunk (no chunk is empty). Returns ids, their number and the candidates taken per chunk.
        """
        symbols, owner, sizes = symbols.astype(np.int64), np.arange(len(lengths)), lengths.copy()
        total, taken = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
        found_ids, found_owner = [], []
        last = np.cumsum(sizes) - 1
        rank, into = self.candidates(symbols, np.append(symbols[1:], 0)) if len(symbols) else (symbols, symbols)
        rank[last] = NEVER
        k = 0
        while len(owner):
            starts = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat((rank << 24) | np.arange(len(rank)), starts)
            place = best & 0xFFFFFF
            over = best >> 24 >= NEVER
            if over.any():
                gone = np.repeat(over, sizes)
                found_ids.append(symbols[gone])
                found_owner.append(np.repeat(owner[over], sizes[over]))
                total[owner[over]], taken[owner[over]] = sizes[over], k
                stay = ~gone
                moved = np.cumsum(stay) - 1
                symbols, rank, into, place = symbols[stay], rank[stay], into[stay], moved[place[~over]]
                owner, sizes, masks = owner[~over], sizes[~over], masks[~over]
                if not len(owner):
                    break
            skip = (masks >> np.uint64(k) & np.uint64(1)).astype(bool) if k < 64 else np.zeros(len(owner), dtype=bool)
            rank[place[skip]] = NEVER
            k += 1
            at = place[~skip]
            if not len(at):
                continue
            symbols[at] = into[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, rank, into = symbols[keep], rank[keep], into[keep]
            sizes = sizes - ~skip
            ends = np.cumsum(sizes)
            at, first, end = moved[at], (ends - sizes)[~skip], ends[~skip]
            inner = at + 1 < end
            rank[at] = NEVER
            j = at[inner]
            rank[j], into[j] = self.candidates(symbols[j], symbols[j + 1])
            j = at[at > first] - 1
            rank[j], into[j] = self.candidates(symbols[j], symbols[j + 1])
        if not found_ids:
            return symbols, total, taken
        ids, owners = np.concatenate(found_ids), np.concatenate(found_owner)
        return ids[np.argsort(owners, kind="stable")], total, taken

    def segment(self, chunk: str, skip) -> tuple[tuple[int, ...], int]:
        """Ids of the chunk and the number of candidates taken; ``skip(k)`` says whether the k-th is skipped."""
        score, symbols = self.score, list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            merged = symbols[i] + symbols[i + 1]
            if merged in score and MARK not in merged:
                agenda.append((score[merged], i, i + 1, merged))
        heapq.heapify(agenda)
        taken = 0
        while agenda:
            _, i, j, merged = heapq.heappop(agenda)
            left, right = symbols[i], symbols[j]
            if left is None or right is None or after[i] != j or len(left) + len(right) != len(merged):
                continue  # one of the two has been merged meanwhile
            taken += 1
            if skip(taken - 1):
                continue
            symbols[i], symbols[j] = merged, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = merged + symbols[k]
                if wider in score:
                    heapq.heappush(agenda, (score[wider], i, k, wider))
            h = before[i]
            if h >= 0:
                wider = symbols[h] + merged
                if wider in score:
                    heapq.heappush(agenda, (score[wider], h, i, wider))
        out = []
        for s in symbols:
            if s is not None:
                found = self.ids.get(s)
                out += [self.byte_ids[b] for b in s.encode()] if found is None else [found]
        return tuple(out), taken

    def _learn(self, chunks) -> None:
        """Number the chunks not met before and segment them without dropout. A chunk that needs single treatment gets -1."""
        fresh, letters, lengths = [], [], []
        for chunk in chunks:
            try:
                found = [self.chars[c] for c in chunk]
            except KeyError:
                found = None
            if found is None or len(chunk) > LONG_CHUNK:
                self.known[chunk] = -1
            else:
                self.known[chunk] = len(self.limits) + len(fresh)
                fresh.append(chunk)
                letters += found
                lengths.append(len(found))
        ids, count, taken = self.segment_many(np.array(letters, dtype=np.int64), np.array(lengths, dtype=np.int64), np.zeros(len(fresh), dtype=np.uint64))
        self.letters = np.concatenate([self.letters, np.array(letters, dtype=np.int64)])
        self.letter_at = np.concatenate([self.letter_at, self.letter_at[-1] + np.cumsum(lengths, dtype=np.int64)])
        self.roots = np.concatenate([self.roots, ids])
        self.root_at = np.concatenate([self.root_at, self.root_at[-1] + np.cumsum(count)])
        self.limits = np.concatenate([self.limits, (np.uint64(1) << np.minimum(taken, 63).astype(np.uint64)) - np.uint64(1)])

    def _turn(self, parts: list, keys: list[int], eighths: int) -> list[tuple[np.ndarray, int]]:
        """Ids of each part (document, number of its first chunk, chunks), and the count without dropout."""
        chunks = [c for _, _, part in parts for c in part]
        if len(self.known) > KNOWN_CHUNKS:
            self._forget()
        self._learn(c for c in dict.fromkeys(chunks) if c not in self.known)
        number = np.fromiter(map(self.known.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        sizes = np.array([len(part) for _, _, part in parts])
        place = np.concatenate([np.arange(first, first + len(part)) for _, first, part in parts])
        key = np.repeat(np.array([keys[d] for d, _, _ in parts], dtype=np.uint64), sizes)
        masks = skip_masks(key, place, eighths)

        roots, root_at, limits = self.roots, self.root_at, self.limits
        single = number < 0
        safe = np.where(single, 0, number)
        if len(limits):
            start, length = root_at[safe], root_at[safe + 1] - root_at[safe]
            dropped = ~single & ((masks & limits[safe]) != 0)
        else:
            start, length, dropped = np.zeros(len(chunks), dtype=np.int64), np.zeros(len(chunks), dtype=np.int64), np.zeros(len(chunks), dtype=bool)
        plain = np.where(single, 0, length)
        letters, letter_at = self.letters, self.letter_at
        which = safe[dropped]
        lengths = letter_at[which + 1] - letter_at[which]
        ids, count, _ = self.segment_many(letters[ragged(letter_at[which], lengths)], lengths, masks[dropped])
        start[dropped], length[dropped] = len(roots) + np.cumsum(count) - count, count
        pool = [roots, ids]
        at = len(roots) + len(ids)
        for i in np.flatnonzero(single).tolist():
            found, n = self._single(chunks[i], int(masks[i]), int(key[i]), int(place[i]), eighths)
            pool.append(np.array(found, dtype=np.int64))
            start[i], length[i], plain[i] = at, len(found), n
            at += len(found)
        out = np.concatenate(pool)[ragged(start, length)].astype(np.int32)
        ends = np.cumsum(sizes)
        tokens = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], ends])]
        counts = np.add.reduceat(plain, ends - sizes)
        return [(out[tokens[i]:tokens[i + 1]], int(counts[i])) for i in range(len(parts))]

    def encode_many(self, texts: list[str], keys: list[int], eighths: int) -> list[tuple[np.ndarray, int]]:
        """Ids of each text with dropout, and how many ids there are without. Long texts are worked through in parts."""
        done: list[list] = [[] for _ in texts]
        plain = [0] * len(texts)
        waiting, held = [], 0

        def work():
            nonlocal waiting, held
            for (d, _, _), (ids, n) in zip(waiting, self._turn(waiting, keys, eighths), strict=True):
                done[d].append(ids)
                plain[d] += n
            waiting, held = [], 0

        for d, text in enumerate(texts):
            if not text:
                continue
            # A very long text is cut lazily, so that its chunks are never held all at once.
            found = iter(self.chunks.findall(" " + text)) if len(text) < LONG_TEXT else (m[0] for m in self.chunks.finditer(" " + text))
            first = 0
            while part := list(islice(found, TURN_CHUNKS)):
                waiting.append((d, first, part))
                first, held = first + len(part), held + len(part)
                if held >= TURN_CHUNKS:
                    work()
        if waiting:
            work()
        none = np.array([], dtype=np.int32)
        return [(np.concatenate(ids) if len(ids) > 1 else ids[0] if ids else none, n) for ids, n in zip(done, plain, strict=True)]

    def _single(self, chunk: str, mask: int, key: int, number: int, eighths: int):
        """A chunk with characters outside the vocabulary, or with more candidates than one mask has bits: further masks are hashed for it."""
        plain = len(self.segment(chunk, lambda k: False)[0])
        if len(chunk) <= LONG_CHUNK:
            return self.segment(chunk, lambda k: mask >> k & 1)[0], plain
        lanes = skip_masks(key ^ (number + 1) * 0xA0761D6478BD642F & 2**64 - 1, np.arange(3 * len(chunk) // 64 + 1), eighths)
        bits = np.unpackbits(lanes.astype("<u8").view(np.uint8), bitorder="little")
        return self.segment(chunk, lambda k: bits[k])[0], plain

    def decode(self, ids) -> str:
        surface = self.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def document_key(seed: int, doc_id: int | None) -> int:
    value = np.array([0 if doc_id is None else doc_id & 2**64 - 1], dtype=np.uint64)
    return int(mix(value + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 2**64 - 1))[0])


def _eighths(dropout: float) -> int:
    if not 0 <= dropout < 1:
        raise ValueError("dropout must be at least 0 and below 1")
    return round(dropout * 256)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else np.array([], dtype=np.int32), pa.int32()))


def encode(df: DataFrame, dropout: float = DROPOUT, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text", model: str | None = None) -> DataFrame:
    """doc_id, ids and n_plain (ids without dropout) of every text.

    The chance of a skip is ``dropout`` to the nearest 1/256. A null text has null ids, an empty one none; repeated rows (same id and text) are
    segmented alike, a null id counts as 0. An empty table gives an empty result. Other columns are left out, so names cannot clash.
    """
    path, eighths = model or model_path(), _eighths(dropout)

    def run(batches):
        codec = Codec(path)
        for batch in batches:
            found = codec.encode_many([t or "" for t in batch["text"].to_pylist()], [document_key(seed, d) for d in batch["doc_id"].to_pylist()], eighths)
            plain = [n for _, n in found]
            lists = _lists([ids for ids, _ in found])
            lists = pa.ListArray.from_arrays(lists.offsets, lists.values, mask=batch["text"].is_null()) if batch["text"].null_count else lists
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists, pa.array(plain, pa.int64())], names=["doc_id", "ids", "n_plain"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_plain long")


def decode(df: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", model: str | None = None) -> DataFrame:
    """doc_id and text of every list of ids; null ids give a null text, control and unknown ids give nothing."""
    path = model or model_path()

    def run(batches):
        codec = Codec(path)
        for batch in batches:
            texts = [None if ids is None else codec.decode(ids) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def round_trip(df: DataFrame, dropout: float = DROPOUT, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text", model: str | None = None) -> DataFrame:
    """Encode and decode every text in one pass: token counts with and without dropout, checksum of the ids, and whether the decoded text is equal.

    Rows as in ``encode``; a null text has no ids and counts as empty.
    """
    path, eighths = model or model_path(), _eighths(dropout)
    names = ["doc_id", "n_tokens", "n_plain", "ids_crc32", "text_crc32", "lossless"]

    def run(batches):
        codec = Codec(path)
        for batch in batches:
            rows, texts, numbers = [], [t or "" for t in batch["text"].to_pylist()], batch["doc_id"].to_pylist()
            found = codec.encode_many(texts, [document_key(seed, d) for d in numbers], eighths)
            for doc_id, text, (ids, plain) in zip(numbers, texts, found, strict=True):
                back = codec.decode(ids.tolist())
                rows.append((doc_id, len(ids), plain, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(back.encode()), back == text))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if n == "lossless" else pa.int64()) for n, c in zip(names, columns, strict=True)], names=names)

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_plain long, ids_crc32 long, text_crc32 long, lossless boolean")


def op1(spark, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"))
