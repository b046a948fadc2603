"""WARC archives: exact round trips, the format, and damaged archives."""

import base64
import hashlib
import struct

import pytest
import zstandard

from bandlex.llm import warc
from bandlex.llm.oracle import oracle_sql
from bandlex.llm.queries import op2_warc
from bandlex.llm.shared import new_path


def brute(pages, min_payload=0):
    first = {}
    for p in pages:
        if p.page_id is not None:
            text = p.html or ""
            first[text] = min(p.page_id, first.get(text, p.page_id))
    for p in pages:
        data = (p.html or "").encode()
        other = first.get(p.html or "")
        revisit = len(data) >= min_payload and other is not None and p.page_id != other
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        yield p.page_id, len(data), digest, "revisit" if revisit else "response", other if revisit else None


def test_query(spark, sf, sql):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    found = op2_warc(spark, sf).persist()
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute(pages)))
    expected = sql.execute(oracle_sql()["op2_warc"]).fetchall()
    columns = [d[0] for d in sql.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, found.select(columns).collect()))) == sorted(map(str, expected))


@pytest.fixture
def pages(spark):
    rows = [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", "")]
    rows += [(5, "u", "x" * 300_000), (6, "u", "x" * 300_000), (None, "u", "<p>é</p>"), (None, None, "alone"), (7, "u", "\r\n\r\nWARC/1.1\r\n")]
    rows += [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (-8, "é", "P*M\x18" + "\0" * 9)]
    return spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, payload string, key int")


@pytest.mark.parametrize("min_payload", [0, 10])
def test_odd_rows(spark, pages, min_payload):
    found = warc.archived_pages(pages, new_path(spark, "a"), min_payload).collect()
    assert {r.error for r in found} == {None}
    assert sorted(str(tuple(r)[:5]) for r in found) == sorted(map(str, brute(pages.collect(), min_payload)))
    assert warc.archived_pages(pages.limit(0), new_path(spark, "a")).collect() == []


def test_payloads_come_back(spark, pages, sf):
    for table in (pages, spark.read.parquet(f"{sf}/pages.parquet").repartition(3)):
        path = new_path(spark, "a")
        warc.write_archives(table, path)
        rows = warc.read_archives(spark, path).collect()
        texts = {}
        for r in table.collect():
            texts.setdefault(r.page_id, set()).add((r.html or "").encode())
        for r in rows:
            page = r.record_id.removeprefix("urn:x-page:")
            if r.record_type == "response":
                assert bytes(r.payload) in texts[int(page) if page else None]
            assert r.target_uri is None or not set("\r\n ") & set(r.target_uri)
        # the files are plain Zstandard: a dictionary in front, frames, skippable frames
        for file in spark.read.format("binaryFile").load(path).collect():
            data = bytes(file.content)
            if len(rows) > 100:
                assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY
            dictionary, at = warc.leading_dictionary(memoryview(data))
            reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
            whole = reader.stream_reader(data[at:], read_across_frames=True).read()
            assert whole.count(b"WARC/1.1\r\nWARC-Type") == sum(r.archive == file.path for r in rows)


def archive(contents, dictionary=None, compressed=False):
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(dict_data=trained)
    head = b""
    if dictionary:
        head = warc.dictionary_frame(zstandard.ZstdCompressor().compress(dictionary) if compressed else dictionary)
    return head, [compressor.compress(c) for c in contents]


def good(i):
    return warc.page_record(i, "u", b"some text %d" % i, warc.base32_sha1(b"some text %d" % i), False, None, warc.DATE)


@pytest.mark.parametrize("compressed", [False, True])
def test_dictionaries(compressed):
    dictionary = warc.train_dictionary([good(i) * 3 for i in range(500)])
    head, found = archive([good(1), good(2)], dictionary, compressed)
    data = head + found[0] + struct.pack("<II", warc.SKIPPABLE + 3, 4) + b"skip" + found[1]
    assert [c for _, c, _ in warc.frames(memoryview(data))] == [good(1), good(2)]
    # without the dictionary the frames name what they need
    assert all("dictionary" in e for _, _, e in warc.frames(memoryview(found[0])))
    assert [e for _, _, e in warc.frames(memoryview(head[:50]))] == ["the dictionary frame is cut off"]
    assert list(warc.frames(memoryview(b""))) == []


def test_damaged_archives_lose_no_good_record():
    _, found = archive([good(i) for i in range(4)])
    broken = bytearray(found[1])
    broken[len(broken) // 2] ^= 0xFF
    data = b"junk" + found[0] + bytes(broken) + found[2] + found[3][:-5]
    rows = []
    for _, content, error in warc.frames(memoryview(data)):
        try:
            rows.append(warc.parse_record(content)["record_id"] if content else error)
        except ValueError as wrong:
            rows.append(str(wrong))
    assert rows[0] == "not a frame" and "cut off" in rows[-1]
    assert [r for r in rows if r.startswith("urn")] == ["urn:x-page:0", "urn:x-page:2"]


def test_frames_that_are_too_long():
    """A long frame is reported, and those around it are read; so with one that states no size."""
    compressor = zstandard.ZstdCompressor().compressobj()
    unstated = compressor.compress(b"x" * 3_000_000) + compressor.flush()
    _, found = archive([good(1), b"y" * 3_000_000, good(2)])
    data = found[0] + found[1] + unstated + found[2]
    rows = list(warc.frames(memoryview(data), max_record=1_000_000))
    assert [content for _, content, _ in rows] == [good(1), None, None, good(2)]
    assert all("more than 1000000 bytes" in error for _, content, error in rows if content is None)
    assert all(error is None for _, _, error in warc.frames(memoryview(data)))


def test_many_damaged_frames_take_linear_time():
    frame = zstandard.ZstdCompressor().compress(good(1))
    data = (frame[:4] + b"\xff" * 60) * 40_000 + frame
    rows = list(warc.frames(memoryview(data)))
    assert len(rows) == 40_001 and [c for _, c, _ in rows if c is not None] == [good(1)]


@pytest.mark.parametrize(
    "change, says",
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARC/9"), "no WARC header"),
        (lambda r: r.replace(b"WARC-Date: ", b"Other: "), "without warc-date"),
        (lambda r: r.replace(b"WARC-Date: ", b"WARC-Date "), None),
        (lambda r: r.replace(b"some text", b"some teyt"), "block digest"),
        (lambda r: r[:-4], "Content-Length"),
        (lambda r: r + b"x", "Content-Length"),
        (lambda r: r.replace(b"some text", b"some texts"), "Content-Length"),
        (lambda r: b"", "no WARC header"),
    ],
)
def test_records_that_do_not_fit(change, says):
    assert warc.parse_record(good(3))["payload"] == b"some text 3"
    with pytest.raises(ValueError, match=says):
        warc.parse_record(change(good(3)))


def test_payload_digest_and_http_length():
    block = warc.http_head(5) + b"12345"
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", "<x>"), ("WARC-Date", "d"), ("Content-Type", "application/http")]
    with pytest.raises(ValueError, match="payload digest"):
        warc.parse_record(warc.record([*headers, ("WARC-Payload-Digest", "sha1:" + "A" * 32)], block))
    with pytest.raises(ValueError, match="HTTP Content-Length"):
        warc.parse_record(warc.record(headers, warc.http_head(6) + b"12345"))
