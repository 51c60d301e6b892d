"""WARC archives with revisit resolution.

Headers (page id, payload digest, length) are shuffled by digest, without payloads; the
smallest page id of each digest is the original response and the other records of
payloads of at least ``min_bytes`` become revisits of it. Archives are written once, with
fresh headers, by Spark's own text writer (gzip), so a lost executor's files are written
again by the commit protocol. Reading back parses each archive by Content-Length and
resolves revisits against their originals.

Defined results: a NULL payload is empty; a NULL or odd URL is left out of, or escaped
in, the header; pages with the same id and the same payload as the group's original are
all responses; a NULL page id never is an original unless the group has no other id (then
its records stay responses); an empty table gives empty archives.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import materialize, scratch_path

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
#: WARC 1.1 profile of a revisit with an identical payload digest (fixed by the format).
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digests are dealt over this many salts when headers meet their original.
SALTS = 16
#: Most records of one archive file; bounds what one task reads back.
RECORDS_PER_ARCHIVE = 1000


def headers(records: DataFrame, record_id: str, payload: str) -> DataFrame:
    """record_id, payload_bytes, payload_digest of each record, without payloads."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    return records.select(F.col(record_id).alias("record_id"), F.octet_length(body).cast("long").alias("payload_bytes"), F.sha2(body, 256).alias("payload_digest"))


def resolve_revisits(heads: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(record_id, payload_digest, refers_to) of the records that revisit another one.

    A digest may hold a third of all records: originals come from a grouped minimum, which
    combines before the shuffle, and headers meet them by digest and salt.
    """
    large = heads.where(F.col("payload_bytes") >= min_bytes)
    originals = (large.groupBy("payload_digest").agg(F.min("record_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1 and refers_to is not null"))
    salted = originals.select("payload_digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return (large.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
            .join(salted, ["payload_digest", "salt"])
            .where(F.col("record_id").isNull() | (F.col("record_id") != F.col("refers_to")))
            .select("record_id", "payload_digest", "refers_to").distinct())


def _uuid(*parts):
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def record_text(record_id, url, payload, digest, refers_to, refers_to_record, captured_at: str):
    """One WARC record without its closing blank lines: fresh named fields, then the HTTP block.

    A revisit keeps the HTTP header of its capture and no payload.
    """
    revisit = refers_to.isNotNull()
    size = F.octet_length(payload).cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(RECORD_END))
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.octet_length(payload))

    def field(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    clean_url = F.regexp_replace(F.regexp_replace(url, r"\r", "%0D"), r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", _uuid(F.lit("record"), record_id.cast("string"), digest)),
        field("WARC-Date", F.lit(captured_at)),
        field("WARC-Target-URI", clean_url),
        field("X-Page-ID", record_id.cast("string")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        field("WARC-Refers-To", F.when(revisit, refers_to_record)),
        field("X-Refers-To-Page", refers_to.cast("string")),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        field("Content-Length", block_bytes.cast("string")),
        F.lit(CRLF), http, F.when(revisit, F.lit("")).otherwise(payload),
    )


def write_archives(records: DataFrame, path: str, record_id: str = "page_id", url: str = "url", payload: str = "html",
                   min_bytes: int = 100, captured_at: str = "2024-01-01T00:00:00Z", records_per_archive: int = RECORDS_PER_ARCHIVE) -> str:
    """Write deduplicated archives (``*.txt.gz`` holding WARC 1.1 records) under ``path``."""
    revisits = materialize(resolve_revisits(headers(records, record_id, payload), min_bytes), "warc-revisits")
    body = F.coalesce(F.col(payload), F.lit(""))
    base = records.select(F.col(record_id).alias("record_id"), F.col(url).cast("string").alias("url"), body.alias("payload"),
                          F.sha2(body.cast("binary"), 256).alias("payload_digest"))
    # the written revisit table's size decides between a broadcast and a shuffle
    joined = base.join(revisits, (base["record_id"].eqNullSafe(revisits["record_id"])) & (base["payload_digest"] == revisits["payload_digest"]), "left").select(base["*"], revisits["refers_to"])
    text = record_text(F.col("record_id"), F.col("url"), F.col("payload"), F.col("payload_digest"), F.col("refers_to"),
                       _uuid(F.lit("record"), F.col("refers_to").cast("string"), F.col("payload_digest")), captured_at)
    joined.select(text.alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", records_per_archive).text(path)
    return path


_FIELD = re.compile(rb"([^:\r\n]+): ([^\r\n]*)\r\n")


def parse_archive(stream) -> "list[tuple[dict[bytes, bytes], bytes]]":
    """Records (named fields, block) of an open archive, one at a time, by Content-Length."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            m = _FIELD.match(line)
            if m:
                fields[m[1]] = m[2]
        block = stream.read(int(fields[b"Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record is not closed")
        yield fields, block


READ_SCHEMA = "record_id string, record_type string, page_id string, payload_digest string, refers_to string, refers_to_page string, stored_bytes long, stored_digest string, target_uri string"


def _read(batches):
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    text = lambda f, k: f[k].decode() if k in f else None
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            with gzip.open(io.BytesIO(content.as_buffer()), "rb") as stream:
                for f, block in parse_archive(stream):
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    revisit = f[b"WARC-Type"] == b"revisit"
                    rows.append((f[b"WARC-Record-ID"].decode(), f[b"WARC-Type"].decode(), text(f, b"X-Page-ID"), text(f, b"WARC-Payload-Digest").removeprefix("sha256:"),
                                 text(f, b"WARC-Refers-To"), text(f, b"X-Refers-To-Page"), None if revisit else len(payload), None if revisit else hashlib.sha256(payload).hexdigest(), text(f, b"WARC-Target-URI")))
            cols = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "stored_bytes" else pa.string()) for n, c in zip(names, cols)], names)


def read_archives(spark, path: str) -> DataFrame:
    """One row per record; length and digest of a response are those of its stored payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_read, READ_SCHEMA)


def resolve_read(records: DataFrame) -> DataFrame:
    """Payload facts of every record; revisits take theirs from the response they refer to."""
    responses = records.where("record_type = 'response'")
    # revisits of one original may be many: the pairs of originals and salts are the small side
    wanted = records.where("record_type = 'revisit'")
    salt = F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")
    named = wanted.select("refers_to").distinct().join(responses.select(F.col("record_id").alias("refers_to"), F.col("stored_bytes").alias("payload_bytes"), F.col("stored_digest").alias("found")), "refers_to").dropDuplicates(["refers_to"])
    salted = named.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    revisits = (wanted.withColumn("salt", salt).join(salted, ["refers_to", "salt"], "left")
                .select("page_id", "payload_bytes", F.col("found").alias("payload_digest"), "record_type", F.col("refers_to_page").alias("refers_to"), "target_uri"))
    return responses.select("page_id", F.col("stored_bytes").alias("payload_bytes"), F.col("stored_digest").alias("payload_digest"), "record_type", F.col("refers_to_page").alias("refers_to"), "target_uri").unionByName(revisits)


def warc_round_trip(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, read them back, one row per page."""
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType
    path = write_archives(pages.select("page_id", "url", "html"), scratch_path(spark, "warc"), min_bytes=min_bytes)
    out = resolve_read(materialize(read_archives(spark, path), "warc-records"))
    return out.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
