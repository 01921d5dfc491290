import base64
import gzip
import hashlib
import random

from searchlake.llm import warc
from searchlake.session import scratch_path


def pages_frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, refers_to string")


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, rows, split=warc.SPLIT_BYTES, **options):
    folder = scratch_path(spark, "warc-test")
    files = warc.write_archives(pages_frame(spark, rows), folder, **options)
    return warc.read_archives(spark, folder, files, split_bytes=split, with_payload=True).collect()


def rows_of_all_kinds():
    rnd = random.Random(8)
    noise = "".join(chr(rnd.randrange(32, 0x2000)) for _ in range(20_000))
    rows = [(i, f"http://a/{i}", f"<p>{i} {'é' * (i % 50)}</p>") for i in range(150)]
    rows += [(200 + i, f"http://b/{i}", "<b>same</b>") for i in range(70)]
    return rows + [(300, None, None), (301, "u\r\nX: y", ""), (302, "u", noise), (None, "u", "null id"), (None, "u", "null id"), (303, "", "null id")]


def test_round_trip_in_small_splits(spark):
    rows = rows_of_all_kinds()
    got = round_trip(spark, rows, split=997)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", i), i)
    for i, url, h in rows:
        r = by[i][0]
        html = h or ""
        first = i is None or largest[html] == i
        assert r["payload_bytes"] == len(html.encode()) and r["payload_digest"] == sha(html)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first else ("revisit", largest[html]))
        assert r["payload"] == (html.encode() if first else None)
        if url is not None and "\r" not in url:
            assert r["url"] == (url or "")
    assert len(by[None]) == 2


def test_small_payloads_are_not_deduplicated(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    got = {r["page_id"]: r["record_type"] for r in round_trip(spark, rows, min_bytes=3)}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archives_are_plain_warc(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archives(pages_frame(spark, [(1, "http://a/", "<p>")]), folder).collect()
    paths = spark.read.format("binaryFile").load(folder).collect()
    text = gzip.decompress(bytes(paths[0]["content"]))
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"\r\n\r\nHTTP/1.1 200 OK\r\n" in text and text.endswith(b"<p>\r\n\r\n")


def test_ranges_own_records_once(tmp_path):
    """Every cut of a file gives each record once; false magic and a broken tail are passed over."""
    rnd = random.Random(2)
    records = [warc.encode_record(i, "u", bytes(rnd.randrange(256) for _ in range(rnd.randrange(200))) + warc.MAGIC * 3, None) for i in range(40)]
    path = str(tmp_path / "a.warc.gz")
    data = b"".join(records) + warc.MAGIC + b"not a member" + records[0][:30]
    open(path, "wb").write(data)
    for step in (7, 50, 333, len(data)):
        assert [warc.parse_record(raw)["page_id"] for at in range(0, len(data), step)
                for _, raw in warc.records_in(path, at, at + step)] == list(range(40))


def test_empty_table(spark):
    folder = scratch_path(spark, "warc-test")
    files = warc.write_archives(pages_frame(spark, [(1, "u", "h")]).limit(0), folder)
    assert files.collect() == [] and warc.read_archives(spark, folder, files).collect() == []


def test_rows_that_share_an_id_are_records_of_their_own(spark):
    rows = [(1, "u", "A"), (1, "u", "B"), (5, "u", "A"), (6, "u", "B"), (7, "u", "c"), (7, "v", "c"), (5, "u", "D"), (9, "u", "D"), (1, "w", "A")]
    got = sorted((r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"] or 0) for r in round_trip(spark, rows))
    largest = {h: max(i for i, _, x in rows if x == h) for _, _, h in rows}
    assert got == sorted((i, sha(h), "response" if largest[h] == i else "revisit", 0 if largest[h] == i else largest[h]) for i, _, h in rows)


def test_a_very_large_payload(tmp_path):
    """Longer than many read blocks, and incompressible; the ranges inside it own no record."""
    payload = random.Random(3).randbytes(40 << 20)
    records = [warc.encode_record(1, "u", b"first", None), warc.encode_record(2, "u", payload, None), warc.encode_record(3, "u", b"last", None)]
    path = str(tmp_path / "a.warc.gz")
    data = b"".join(records)
    open(path, "wb").write(data)
    step = 16 << 20
    found = [warc.parse_record(raw) for at in range(0, len(data), step) for _, raw in warc.records_in(path, at, at + step)]
    assert [r["page_id"] for r in found] == [1, 2, 3] and found[1]["payload"] == payload
