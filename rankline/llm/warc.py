"""WARC archives compressed record by record with Zstandard and a shared dictionary.

An archive is one skippable frame that holds the dictionary, then one Zstandard frame per record.
Pages are written by Spark tasks as such files in the shared folder, each bounded in size, and read
back through Spark's binary file source. Equal payloads are stored once; later pages revisit the first.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, stored, table

# Fixed values of the formats: magic numbers of skippable frames, frames and trained dictionaries.
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
TRAINED = 0xEC30A437
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = "WARC/1.1"

SALTS = 8


# ---- frames


def frame_length(data: memoryview, at: int) -> int:
    """Compressed length of the Zstandard frame at a place, from its block headers. Raises ValueError if it is cut short."""
    if len(data) - at < 6 or struct.unpack_from("<I", data, at)[0] != FRAME:
        raise ValueError("no Zstandard frame here")
    try:
        pos = at + zstandard.frame_header_size(bytes(data[at:at + 18]))
    except zstandard.ZstdError as exc:
        raise ValueError(str(exc)) from exc
    last = False
    while not last:
        if pos + 3 > len(data):
            raise ValueError("frame is cut short")
        head = int.from_bytes(data[pos:pos + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        if kind == 3:
            raise ValueError("reserved block type")
        pos += 3 + (1 if kind == 1 else size)
    pos += 4 * (data[at + 4] >> 2 & 1)  # content checksum
    if pos > len(data):
        raise ValueError("frame is cut short")
    return pos - at


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    packed = packed if len(packed) < len(dictionary) else dictionary
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


def as_dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    trained = len(content) > 8 and struct.unpack_from("<I", content)[0] == TRAINED
    return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def read_dictionary(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading skippable frame (plain or itself compressed) and the place after it."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        return None, 0
    end = 8 + struct.unpack_from("<I", data, 4)[0]
    if end > len(data):
        raise ValueError("dictionary frame is cut short")
    content = bytes(data[8:end])
    if len(content) > 4 and struct.unpack_from("<I", content)[0] == FRAME:
        content = zstandard.ZstdDecompressor().decompress(content)
    return (as_dictionary(content) if content else None), end


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary from the first records of an archive; their plain bytes where there are too few to train on."""
    if len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:size]


# ---- records


def _header(fields) -> bytes:
    return (VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def digest_text(hex_sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_sha1)).decode()


def record_bytes(page_id, url, payload: bytes, sha1: str, first_id, number: str, date: str) -> bytes:
    """A response record, or a revisit record where ``first_id`` names the page that holds the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = first_id is not None
    block = http if revisit else http + payload
    own = f"urn:page:{page_id}" if page_id is not None else f"urn:record:{number}"
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else own
    return _header([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{own}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + digest_text(sha1)),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", f"<urn:page:{first_id}>" if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]) + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of a record after all checks; raises ValueError naming the first that fails."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version line")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError("malformed header line")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"missing {name}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("content-length does not match the block")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP message")
    length = next((v for k, v in (x.split(b":", 1) for x in http.split(b"\r\n")[1:]) if k.lower() == b"content-length"), None)
    if length is None:
        raise ValueError("no HTTP content-length")
    found = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    refers = fields.get("warc-refers-to", "").strip("<>").removeprefix("urn:page:")
    if fields["warc-type"] == "response":
        if len(payload) != int(length):
            raise ValueError("payload length differs")
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != found:
            raise ValueError("payload digest differs")
    elif fields["warc-type"] == "revisit":
        if payload or not refers:
            raise ValueError("revisit with a payload or without a reference")
    else:
        raise ValueError("unexpected record type")
    own = fields["warc-record-id"].strip("<>")
    return {
        "page_id": int(own.removeprefix("urn:page:")) if own.startswith("urn:page:") else None,
        "url": fields.get("warc-target-uri"),
        "payload_bytes": int(length), "payload_digest": found, "record_type": fields["warc-type"],
        "refers_to": int(refers) if refers else None, "payload": payload if fields["warc-type"] == "response" else None,
    }


# ---- Spark


def _open_folder(folder: str):
    """File system and path of a folder that executors can write to; the scheme must be one that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def assigned(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Pages with payload hash and, for a revisit, the id of the page that holds the payload.

    Payloads never travel for this: pages are counted by hash, only hashes that occur twice or more are
    joined back, spread over salts, and that table's written size decides between broadcast and shuffle.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text.alias("html"), F.sha1(text.cast("binary")).alias("sha1"))
    groups = rows.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 AND first_id IS NOT NULL")
    groups = stored(groups.select("sha1", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = rows.join(groups, ["sha1", "salt"], "left")
    repeat = (F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "html", "sha1", F.when(repeat, F.col("first_id")).alias("first_id"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = 16 << 20, sample: int = 256, dictionary_bytes: int = 32 << 10,
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write every page to ``.warc.zst`` files in the folder; returns the files with their record counts.

    An archive takes ``archive_bytes`` of payload or less (a larger page has one alone). Its dictionary comes from its
    first ``sample`` payloads (a stated bound, 16 KB of each). A file's name has the attempt that wrote it, and only the names that a committed
    task returned are in the result: files of a task that was lost or ran twice are in the folder, and in no result.
    """
    datetime.datetime.fromisoformat(date.replace("Z", "+00:00"))

    def write(batches):
        place, path = _open_folder(folder)
        place.create_dir(path, recursive=True)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        number, waiting, size = 0, [], 0

        def flush():
            nonlocal number, waiting, size
            name = f"pages-{part:06d}-{number:06d}-{attempt}.warc.zst"
            dictionary = train([p[2][:16384] for p in waiting[:sample]], dictionary_bytes)
            packer = zstandard.ZstdCompressor(level=3, dict_data=as_dictionary(dictionary) if dictionary else None, write_content_size=True)
            with place.open_output_stream(f"{path}/.{name}", compression=None) as out:
                if dictionary:
                    out.write(dictionary_frame(dictionary))
                for i, (page_id, url, payload, sha1, first) in enumerate(waiting):
                    out.write(packer.compress(record_bytes(page_id, url, payload, sha1, first, f"{part}:{number}:{i}", date)))
            place.move(f"{path}/.{name}", f"{path}/{name}")
            done = (name, len(waiting), size)
            number, waiting, size = number + 1, [], 0
            return done

        for batch in batches:
            files = []
            for row in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "sha1", "first_id")), strict=True):
                payload = row[2].encode("utf-8")
                if waiting and size + len(payload) > archive_bytes:
                    files.append(flush())
                waiting.append((row[0], row[1], payload, row[3], row[4]))
                size += len(payload)
            yield pa.RecordBatch.from_pydict(dict(zip(("name", "records", "payload_bytes"), zip(*files) if files else ([], [], []), strict=True)), schema=shape)
        if waiting:
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in zip(("name", "records", "payload_bytes"), flush(), strict=True)}, schema=shape)

    shape = pa.schema([("name", pa.string()), ("records", pa.int64()), ("payload_bytes", pa.int64())])
    return stored(assigned(pages, min_bytes).mapInArrow(write, "name string, records long, payload_bytes long"))


_RECORD = "archive string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, problem string"


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_SHAPE = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in _RECORD.split(", ")])


def _rows(found, with_payload: bool) -> pa.RecordBatch:
    found = [r if with_payload else {**r, "payload": None} for r in found]
    return pa.RecordBatch.from_pydict({n: [r.get(n) for r in found] for n in _SHAPE.names}, schema=_SHAPE)


def records(name: str, content: bytes):
    """All records of one archive. A record that fails a check gives a row with ``problem``; a broken frame ends the archive with one."""
    data = memoryview(content)
    try:
        dictionary, at = read_dictionary(data)
    except (ValueError, zstandard.ZstdError) as exc:
        yield {"archive": name, "problem": str(exc)}
        return
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            length = frame_length(data, at)
        except ValueError as exc:
            yield {"archive": name, "problem": str(exc)}
            return
        try:
            yield {"archive": name, **parse_record(reader.decompress(data[at:at + length]))}
        except (ValueError, zstandard.ZstdError) as exc:
            yield {"archive": name, "problem": str(exc)}
        at += length


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the ``.warc.zst`` files in the folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    def read(batches):
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                yield _rows(records(path, content), with_payload)

    return files.select("path", "content").mapInArrow(read, _RECORD)


def read_written(written: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives that ``write_archives`` returned, and of no other file in the folder.

    An archive whose number of records is not the one written gives one more row, with ``problem``.
    """
    tasks = max(1, min(written.count(), 100_000))

    def read(batches):
        place, path = _open_folder(folder)
        for batch in batches:
            for name, count in zip(batch["name"].to_pylist(), batch["records"].to_pylist(), strict=True):
                with place.open_input_stream(f"{path}/{name}", compression=None) as source:
                    found = list(records(name, source.read()))
                if len(found) != count:
                    found.append({"archive": name, "problem": f"{len(found)} records of {count}"})
                yield _rows(found, with_payload)

    return written.select("name", "records").repartition(tasks).mapInArrow(read, _RECORD)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back.

    A null html is an empty payload. Of equal payloads, the pages with the smallest page_id are responses (a repeated row of that
    id too) and the others revisit it; a group without any id has responses only, and a page without id revisits like any other.
    A null or empty url is replaced by the record's own name. An empty table gives an empty result.
    Other columns are left out, so their names cannot clash. Very long payloads have an archive of their own.
    """
    folder = shared_folder(pages.sparkSession)
    place, path = _open_folder(folder)
    place.create_dir(path, recursive=True)
    return read_written(write_archives(pages, folder, min_bytes), folder, with_payload=False).drop("payload")


def op7(spark, folder: str) -> DataFrame:
    return archive_pages(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")
