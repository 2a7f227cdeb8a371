"""WARC archives compressed with Zstandard, one frame per record.

An archive begins with a skippable frame (magic number 0x184D2A5D) that holds
the dictionary of all its records, plain or compressed itself.  Each record is
a frame of its own, so one damaged record costs no other.  :func:`write` makes
archives, :func:`read` reads these and others of the format.

Writing takes one pass that groups payloads by digest and one that writes.
Only digests that occur more than once are joined to the rows; those of many
rows are few, at most ``HOT_SHARE`` of them, and are broadcast.  Each task
writes one archive by Spark's text writer, which commits whole files only:
record frames are its lines, and the line separator is an empty skippable
frame, which every reader passes over.  The dictionary is trained on the first
``SAMPLE_BYTES`` of the records of the archive, at most; this affects the size
of the files and nothing that is read from them.

A payload of at least ``revisit_bytes`` bytes that several rows have is written
once, with the smallest key, as a response; the other rows are revisits that
refer to it and hold no payload.  Rows that repeat the smallest key of their
payload are responses all.

Reading walks the frames by the sizes in their blocks, without decoding, and
decodes them one by one.  Of every record the version line, the fields that
WARC requires, the length, the end and the digests are validated; what is wrong
is told in ``error`` and such a record keeps what could be read.  Where no
frame begins, or the file ends inside one, the rest of the file is one row
with an error.

Defined cases: a null or empty payload has no bytes; a null key sorts last, is
written without the field and read back as null; a null address is likewise
left out, line breaks in an address are percent-encoded; other columns are
ignored; an empty table is no archive, an empty file has no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.values import col
from .common import Scratch

# Fixed values of the formats.
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
DICTIONARY_CONTENT = b"\x37\xa4\x30\xec"
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"  # skippable, magic number 0x184D2A50, no bytes
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

KEY_FIELD, REFERS_FIELD = "Page-Key", "Page-Refers-To"
DATE = "1970-01-01T00:00:00Z"
DICTIONARY_BYTES = 16_384
SAMPLE_BYTES = 1_000_000
LEAST_SAMPLES = 8
LEVEL = 3
HOT_SHARE = 200  # a digest of more than 1/200 of all rows is hot
SPREAD = 1 << 20
MEMORY = 1 << 31  # largest window that is decoded

RECORD = (
    "archive string, offset bigint, record_type string, record_id string, key string, url string, date string, payload_bytes bigint,"
    " payload_digest string, refers_to string, payload binary, error string"
)


# --------------------------------------------------------------------- writing
def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column, inside Spark: 32 characters, four for five hexadecimal digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def classified(pages: DataFrame, payload: str, key: str, url: str, revisit_bytes: int) -> DataFrame:
    """``(key, url, payload, digest, first)``; ``first`` is the smallest key of a payload that several rows have, else null."""
    data = F.coalesce(col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(col(key).alias("key"), col(url).cast("string").alias("url"), data.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    scratch = Scratch(pages.sparkSession)
    counted = rows.where(F.octet_length("payload") >= revisit_bytes).groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    several = scratch.keep(counted.where("n > 1"))
    total = several.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_SHARE > total
    hot = F.broadcast(several.where(is_hot).select("digest", F.col("first").alias("hot_first"), F.lit(True).alias("hot")))  # fewer than HOT_SHARE rows
    rest = several.where(~is_hot).select(F.col("digest").alias("join_digest"), F.col("first").alias("rest_first"))
    rows = rows.join(hot, "digest", "left")
    # rows settled already go to keys of their own, which are nobody's digest
    apart = F.when(F.col("hot"), F.concat(F.lit("-"), (F.rand(7) * SPREAD).cast("int").cast("string"))).otherwise(F.col("digest"))
    return rows.withColumn("join_digest", apart).join(rest, "join_digest", "left").select("key", "url", "payload", "digest", F.coalesce("hot_first", "rest_first").alias("first"))


def _record(kind: str, number: str, key: str | None, url: str | None, payload: bytes, digest: str, refers: str | None, date: str) -> bytes:
    """One record: WARC fields, HTTP fields and, for a response, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{number}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), (REFERS_FIELD, quote(refers))]
    if key is not None:
        fields.append((KEY_FIELD, quote(key)))
    fields += [
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def compressed(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of an archive: the dictionary, if there are records enough to train one, and one frame per record."""
    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    press = None
    if len(first) >= LEAST_SAMPLES:
        samples = [r[: SAMPLE_BYTES // len(first)] for r in first]
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        except zstandard.ZstdError:  # samples too much alike or too short to train on
            trained = None
        if trained:
            raw = trained.as_bytes()
            yield DICTIONARY_MAGIC + len(raw).to_bytes(4, "little") + raw
            press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
    press = press or zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
    for record in first:
        yield press.compress(record)
    first.clear()
    for record in records:
        yield press.compress(record)


def write(pages: DataFrame, path: str, payload: str = "html", key: str = "page_id", url: str = "url", revisit_bytes: int = 0, date: str = DATE) -> None:
    """Archives of all rows of ``pages`` below ``path``, one per task."""
    rows = classified(pages, payload, key, url, revisit_bytes)
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    number = F.regexp_replace(F.md5(F.concat_ws("|", F.spark_partition_id(), F.monotonically_increasing_id(), "digest")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    rows = rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("kind"), number.alias("number"), F.col("key").cast("string"), "url",
        "payload", "digest", F.when(revisit, F.col("first").cast("string")).alias("refers"),
    )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (_record(*(column[i].as_py() for column in batch.columns), date) for batch in batches for i in range(batch.num_rows))
        for frame in compressed(records):
            yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], names=["frame"])

    rows.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value")).write.options(lineSep=EMPTY_FRAME, compression="none", maxRecordsPerFile=0).text(path)


# --------------------------------------------------------------------- reading
def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, by its headers alone."""
    magic = int.from_bytes(data[at : at + 4], "little")
    if magic >> 4 == 0x184D2A5:
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
    elif data[at : at + 4] == ZSTD_MAGIC:
        checksum = zstandard.get_frame_parameters(data[at : at + 18]).has_checksum
        end, last = at + zstandard.frame_header_size(data[at : at + 18]), False
        while not last:
            head = data[end : end + 3]
            if len(head) < 3:
                raise ValueError("the file ends inside a frame")
            head = int.from_bytes(head, "little")
            last, kind, size = head & 1, head >> 1 & 3, head >> 3
            end += 3 + (1 if kind == 1 else size)
        end += 4 if checksum else 0
    else:
        raise ValueError("no frame begins here")
    if end > len(data):
        raise ValueError("the file ends inside a frame")
    return end


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    if content[:4] == ZSTD_MAGIC:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    if content[:4] != DICTIONARY_CONTENT:
        raise ValueError("the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(content)


def parsed(record: bytes) -> dict:
    """Fields, payload and faults of one record."""
    out: dict = {"faults": []}
    fault = out["faults"].append
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")  # folded fields
    if not gap:
        fault("the header has no end")
    if lines[0] not in VERSIONS:
        fault("no version line")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name.strip():
            fault(f"no field: {line[:40]!r}")
        else:
            fields.setdefault(name.strip().lower(), value.strip())
    for name in REQUIRED:
        if not fields.get(name):
            fault(f"{name} is missing")
    out["fields"] = fields
    size = fields.get("content-length", "")
    if size.isdecimal() and size.isascii():
        block, end = rest[: int(size)], rest[int(size) :]
        if end != b"\r\n\r\n" or len(block) < int(size):
            fault(f"content-length is {size}, the record holds {max(0, len(rest) - 4)}")
    else:
        block = rest.removesuffix(b"\r\n\r\n")
        if size:
            fault("content-length is no number")
    payload, length = block, len(block)
    if fields.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            fault("the HTTP header has no end")
        told = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", http)
        length = int(told[1]) if told else len(payload)
    revisit = fields.get("warc-type") == "revisit"
    if not revisit and length != len(payload):
        fault(f"the payload has {len(payload)} bytes of {length}")
        length = len(payload)
    for name, data in (("warc-block-digest", block), ("warc-payload-digest", None if revisit else payload)):
        kind, _, value = fields.get(name, "").partition(":")
        if value and data is not None and kind.lower() == "sha1" and value.upper() != base64.b32encode(hashlib.sha1(data).digest()).decode():
            fault(f"{name} differs")
    out |= {"payload": None if revisit else payload, "length": length}
    return out


def records(data: memoryview, archive: str) -> Iterator[tuple]:
    """Rows of the columns ``RECORD`` of one archive."""
    at, dictionary, decoder = 0, None, None
    blank = (None,) * 9
    while at < len(data):
        try:
            end = frame_end(data, at)
        except (ValueError, zstandard.ZstdError) as error:
            yield archive, at, *blank, f"{error}; the rest is not read"
            return
        if data[at : at + 4] != ZSTD_MAGIC:
            if at == 0 and data[:4] == DICTIONARY_MAGIC:
                try:
                    dictionary = _dictionary(bytes(data[8:end]))
                except (ValueError, zstandard.ZstdError) as error:
                    yield archive, 0, *blank, str(error)
            at = end
            continue
        frame, start, at = data[at:end], at, end
        try:
            if decoder is None:
                decoder = zstandard.ZstdDecompressor(dict_data=dictionary, max_window_size=MEMORY)
            needs = zstandard.get_frame_parameters(frame[:18]).dict_id
            if needs and (not dictionary or dictionary.dict_id() != needs):
                raise ValueError(f"dictionary {needs} is not there")
            found = parsed(decoder.decompressobj().decompress(frame))
        except (ValueError, zstandard.ZstdError) as error:
            yield archive, start, *blank, str(error)
            continue
        f = found["fields"]
        plain = lambda name: unquote(f[name.lower()]) if name.lower() in f else None
        yield (
            archive, start, f.get("warc-type"), f.get("warc-record-id"), plain(KEY_FIELD), f.get("warc-target-uri"), f.get("warc-date"), found["length"],
            f["warc-payload-digest"].partition(":")[2] if "warc-payload-digest" in f else None, plain(REFERS_FIELD), found["payload"], "; ".join(found["faults"]) or None,
        )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives at ``path`` (columns ``RECORD``), with what is wrong with it in ``error``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                held, size = [], 0
                for row in records(memoryview(content.as_buffer()).cast("B"), archive.as_py()):
                    held.append(row)
                    size += len(row[10] or b"")
                    if size > 4_000_000 or len(held) >= 5_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(decode, RECORD)
