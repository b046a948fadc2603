"""WARC archives compressed with Zstandard, one frame per record.

An archive begins with a skippable frame that holds the dictionary, as it is or compressed
itself; every record is a frame of its own.  Archives are written by Spark's text writer,
so in any storage that Spark can write to: a frame is a "line" of bytes, and what separates
lines is an empty skippable frame, which readers pass over.  There is one archive for each
partition.  They are read as binary files, which Spark packs into tasks by size; a task
holds its archives as compressed, and a few decoded records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandlex.llm.shared import settle
from bandlex.operators.lookup import fits_broadcast

# Fixed values of the formats.
FRAME = 0xFD2FB528  # magic number of a frame
SKIPPABLE = 0x184D2A50  # of skippable frames, with any value in the last four bits
DICTIONARY = 0x184D2A5D  # of the skippable frame with the dictionary
SEPARATOR = struct.pack("<II", SKIPPABLE, 0)
NEXT_FRAME = re.compile(re.escape(struct.pack("<I", FRAME)), re.DOTALL)
VERSIONS = ("WARC/1.0", "WARC/1.1")
REQUIRED = ("warc-record-id", "warc-type", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2020-01-01T00:00:00Z"
SAMPLES = 256  # pages the dictionary is trained on
SAMPLE_CHARS = 16_384  # of each
DICTIONARY_BYTES = 16_384
LEVEL = 3
READ = 1 << 16  # bytes given to the decoder at a time
DECODED = 16 << 20  # bytes of decoded payloads in a batch
MAX_RECORD = 1 << 30  # bytes of a decoded record; a longer one is an error, not a task out of memory

RECORD = (
    "archive string, position long, record_id string, record_type string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, refers_to string, payload binary, error string"
)


# records


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: Iterable[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def http_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, first_id: int | None, date: str) -> bytes:
    """A response with the page's payload, or a revisit of the page that has the same."""
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_uri(page_id)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        # a control character or a space would end the value
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Refers-To", record_uri(first_id)), ("WARC-Profile", REVISIT_PROFILE)]
    block = http_head(len(payload)) + (b"" if revisit else payload)
    headers.append(("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"))
    return record(headers, block)


def record_uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def parse_record(data: bytes) -> dict:
    """The fields of a decoded record; raises ValueError for anything that does not fit."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not blank or lines[0] not in VERSIONS:
        raise ValueError("no WARC header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:60]!r}")
        headers[name.strip().lower()] = value.strip()
    if missing := [name for name in REQUIRED if not headers.get(name)]:
        raise ValueError(f"without {', '.join(missing)}")
    length = headers["content-length"]
    if not length.isascii() or not length.isdigit():
        raise ValueError(f"bad Content-Length {length[:20]!r}")
    block, end = rest[: int(length)], rest[int(length) :]
    if len(block) != int(length) or end != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block has {max(0, len(rest) - 4)} bytes")
    _check_digest(headers.get("warc-block-digest"), block, "block")
    kind = headers["warc-type"]
    found = {
        "record_id": headers["warc-record-id"].strip("<>"),
        "record_type": kind,
        "target_uri": headers.get("warc-target-uri"),
        "date": headers["warc-date"],
        "payload_digest": headers.get("warc-payload-digest"),
        "refers_to": headers["warc-refers-to"].strip("<>") if headers.get("warc-refers-to") else None,
        "payload_bytes": len(block),
        "payload": block,
    }
    if kind in ("response", "revisit") and headers.get("content-type", "").startswith("application/http"):
        head, blank, payload = block.partition(b"\r\n\r\n")
        stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", head)
        if not blank or not head.startswith(b"HTTP/"):
            raise ValueError("no HTTP header")
        if kind == "response" and stated and int(stated[1]) != len(payload):
            raise ValueError(f"the HTTP Content-Length is {int(stated[1])}, the payload has {len(payload)} bytes")
        found["payload"] = payload if kind == "response" else None
        found["payload_bytes"] = len(payload) if kind == "response" or not stated else int(stated[1])
    if kind == "response":
        _check_digest(headers.get("warc-payload-digest"), found["payload"], "payload")
    if kind == "revisit" and not found["payload_digest"]:
        raise ValueError("a revisit without a payload digest")
    return found


def _check_digest(stated: str | None, data: bytes, what: str) -> None:
    if stated and stated.startswith("sha1:") and stated != f"sha1:{base32_sha1(data)}":
        raise ValueError(f"the {what} digest does not match")


# frames


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY, len(dictionary)) + dictionary


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes | None:
    """A dictionary, or None from too few or too small samples."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else None
    except zstandard.ZstdError:
        return None


def leading_dictionary(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of an archive's first frame, if it is one, and where that ends."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY:
        return None, 0
    end = 8 + struct.unpack_from("<I", data, 4)[0]
    if end > len(data):
        raise ValueError("the dictionary frame is cut off")
    content = bytes(data[8:end])
    if content[:4] == struct.pack("<I", FRAME):
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content), end


def frames(data: memoryview, max_record: int = MAX_RECORD) -> Iterator[tuple[int, bytes | None, str | None]]:
    """``position, content, error`` of each frame of an archive.

    After a frame that cannot be decoded, or has more than ``max_record`` bytes, reading
    goes on at the next that looks like one.
    """
    try:
        dictionary, at = leading_dictionary(data)
    except (ValueError, zstandard.ZstdError) as error:
        yield 0, None, str(error)
        return
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0] if at + 4 <= len(data) else None
        if magic is not None and magic & ~0xF == SKIPPABLE and at + 8 <= len(data):
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        try:
            if magic != FRAME:
                raise ValueError("not a frame")
            stated = zstandard.get_frame_parameters(data[at : at + 18])
            if stated.dict_id and (dictionary is None or stated.dict_id != dictionary.dict_id()):
                raise ValueError(f"needs dictionary {stated.dict_id}")
            decoder, parts, end = decompressor.decompressobj(), [], at
            size = 0
            while not decoder.eof and end < len(data):
                piece = data[end : end + READ]
                parts.append(decoder.decompress(piece))
                end += len(piece)
                size += len(parts[-1])
                if size > max_record:
                    raise ValueError(f"the frame has more than {max_record} bytes")
            if not decoder.eof:
                raise ValueError("the frame is cut off")
            content = b"".join(parts)
            if stated.content_size not in (zstandard.CONTENTSIZE_UNKNOWN, len(content)):
                raise ValueError(f"the frame states {stated.content_size} bytes and has {len(content)}")
            yield at, content, None
            at = end - len(decoder.unused_data)
        except (ValueError, zstandard.ZstdError) as error:
            yield at, None, str(error)
            after = NEXT_FRAME.search(data, at + 1)
            at = after.start() if after else len(data)


# tables


def payload(html: str = "html") -> Column:
    """The page in UTF-8; null counts as empty."""
    return F.coalesce(F.col(html), F.lit("")).cast("binary")


def write_archives(pages: DataFrame, path: str, min_payload: int = 0, date: str = DATE) -> None:
    """Writes a record for every row of ``pages`` (``page_id, url, html``).

    Of rows with equal payloads of at least ``min_payload`` bytes, those of the smallest
    ``page_id`` are responses and the others revisits of it; smaller payloads are all
    responses.  A null id comes after all others.  The dictionary is trained on at most
    ``SAMPLES`` pages, and left out where these are too few.
    """
    rows = pages.select("page_id", "url", payload().alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    keys = settle(rows.select("page_id", "key", F.octet_length("payload").alias("n"))).where(F.col("n") >= min_payload)
    firsts = keys.groupBy("key").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = keys.drop("n").join(firsts, "key").where(~F.col("page_id").eqNullSafe(F.col("first_id")))
    revisits = settle(revisits.select(F.col("key").alias("r_key"), F.col("page_id").alias("r_id"), "first_id").distinct())
    small = F.broadcast(revisits) if fits_broadcast(revisits, "r_key") else revisits
    rows = rows.join(small, (rows["key"] == small["r_key"]) & rows["page_id"].eqNullSafe(small["r_id"]), "left")
    rows = rows.select("page_id", "url", "payload", F.col("r_key").isNotNull().alias("revisit"), "first_id")
    samples = pages.select(F.substring(F.coalesce("html", F.lit("")), 1, SAMPLE_CHARS).alias("text")).limit(SAMPLES)
    dictionary = train_dictionary([r.text.encode() for r in samples.collect()])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        begun = dictionary is None
        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, content, revisit, first_id = (c[at].as_py() for c in batch.columns)
                found = page_record(page_id, url, content, base32_sha1(content), revisit, first_id, date)
                lines = [compressor.compress(found)]
                if not begun:
                    lines, begun = [dictionary_frame(dictionary), *lines], True
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["frame"])

    # a binary value cast to a string keeps its bytes
    lines = rows.mapInArrow(encode, "frame binary").select(F.col("frame").cast("string").alias("value"))
    lines.write.option("lineSep", SEPARATOR.decode("ascii")).text(path)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True, max_record: int = MAX_RECORD) -> DataFrame:
    """Every record of the archives at a path, as ``RECORD`` has it.

    ``error`` is null for a record whose frame, headers, lengths and digests are right, and
    else says what is not, as for one of more than ``max_record`` bytes; the other fields
    are null then.  ``payload_bytes`` of a revisit
    is the HTTP length it states.
    """
    names = [column.split()[0] for column in RECORD.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[column.split()[1]] for column in RECORD.split(", ")]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for position, data, error in frames(memoryview(content.as_buffer()), max_record):
                    row = {"archive": archive.as_py(), "position": position, "error": error}
                    if data is not None:
                        try:
                            row |= parse_record(data)
                        except ValueError as wrong:
                            row["error"] = str(wrong)
                        size += len(data)
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    if size > DECODED:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(decode, RECORD)


def page_id_of(uri: str) -> Column:
    """The page of a record's identifier."""
    return F.regexp_extract(F.col(uri), r"^urn:x-page:(-?\d+)$", 1).try_cast("long")


def archived_pages(pages: DataFrame, path: str, min_payload: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``, ``error``: what is
    read back from archives of ``pages`` written to ``path``, one row per row of ``pages``.

    Null and empty pages have empty payloads; repeated rows of the smallest id are all
    responses; a null ``page_id`` comes back as null; other columns are ignored; no rows
    give no rows.
    """
    write_archives(pages, path, min_payload)
    found = read_archives(pages.sparkSession, path, with_payload=False)
    return found.select(
        page_id_of("record_id").alias("page_id"),
        "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        page_id_of("refers_to").alias("refers_to"),
        "error",
    )
