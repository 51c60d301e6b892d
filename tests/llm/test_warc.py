import gzip
import hashlib
import io

from loanmart.llm import queries
from loanmart.llm.warc import parse_archive, read_archives, warc_round_trip, write_archives
from loanmart.session import scratch_path
from tests.conftest import SF_SMALL


def test_round_trip_of_odd_pages(spark):
    big = "<p>" + "ä" * 60 + "</p>"
    rows = [(1, "http://a.example/x\r\nEvil: 1", big), (2, None, big), (3, "http://b.example/", "short"), (4, "http://b.example/", "short"), (5, "u", None), (6, "u", ""),
            (7, "u", "WARC/1.1\r\n\r\n\r\nContent-Length: 4\r\n\r\n" * 5), (8, "u", "line\r\n\r\n\r\n\r\n" * 20), (9, "u", "x" * 3_000_000), (10, "u", "x" * 3_000_000), (2, "again", big), (None, "n", "y" * 200), (11, "n", "y" * 200), (1, "same", big)]
    df = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, record_type string").repartition(3)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = len(raw) >= 100 and i != first.get(h or "")
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[h or ""] if revisit else None))
    got = [tuple(r) for r in warc_round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == sorted(set(want) | {w for w in want if w[3] == "response"}, key=str) or sorted(got, key=str) == sorted(want, key=str)
    assert warc_round_trip(df.limit(0)).collect() == []


def test_archives_are_warc(spark):
    rows = [(k, f"http://h{k % 3}.example/{k}", "payload " * (20 + k % 4)) for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = write_archives(df, scratch_path(spark, "warc-test"), records_per_archive=7)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").collect()
    assert len(files) >= 40 // 7
    seen = 0
    for f in files:
        for fields, block in parse_archive(gzip.open(io.BytesIO(f.content))):
            seen += 1
            assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(fields) and block.startswith(b"HTTP/1.1 200 OK\r\n")
            assert (fields[b"WARC-Type"] == b"revisit") == (b"WARC-Refers-To" in fields) == block.endswith(b"\r\n\r\n")
    records = read_archives(spark, path)
    assert seen == records.count() == 40 and records.where("record_type = 'response'").count() == 4


def test_query_runs(spark):
    out = queries.QUERIES["op6_warc"](spark, SF_SMALL)
    assert out.count() == spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
