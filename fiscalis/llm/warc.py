"""WARC archives with revisit records: write each payload once, refer to it from its copies, read it all back.

Headers (identity, payload digest, length) are shuffled by digest to find the original of each payload; the payload
itself is shuffled once, to place records in files of bounded size. Spark's own writer makes the files, so any Hadoop
file system serves, and its commit protocol keeps out what lost or repeated tasks leave behind.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.llm.common import fields, materialize, scratch_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 100


def payload_headers(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """``(rec, page_id, payload_digest, payload_bytes)``; a null payload is empty. ``rec`` names page and payload."""
    data = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    digest = F.sha2(data, 256)
    page = F.col(f"`{id_col}`")
    return pages.select(
        F.concat(F.coalesce(page.cast("string"), F.lit("null")), F.lit("/"), digest).alias("rec"),
        page.alias("page_id"),
        digest.alias("payload_digest"),
        F.octet_length(data).cast("long").alias("payload_bytes"),
    )


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One row per distinct ``rec``, with ``original``: the smallest page with that payload, if another than the page.

    Payloads below ``min_bytes`` have no original. Repeated rows of one page with one payload are one record here.
    A page id of null comes after all others. A hot digest is the split side of a join with one row per digest.
    """
    one = headers.groupBy("rec", "page_id", "payload_digest", "payload_bytes").agg(F.count("*").alias("n"))
    long_ones = headers.filter(F.col("payload_bytes") >= min_bytes)
    first = long_ones.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    out = one.join(first.filter("copies > 1 and first is not null").drop("copies"), "payload_digest", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("rec", "page_id", "payload_digest", "payload_bytes", F.when(other, F.col("first")).alias("original"))


def _uuid(rec: Column) -> Column:
    h = F.md5(rec.cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    return F.concat(*[x for name, value in pairs for x in (F.lit(f"{name}: "), value, F.lit(CRLF))])


def warc_record(date: str) -> Column:
    """The record of a row as text, without the blank lines that end it."""
    revisit = F.col("original").isNotNull()
    size = F.col("payload_bytes").cast("string")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF + CRLF)
    )
    block = F.octet_length(http).cast("long") + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    uri = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]", "%0A")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _lines(
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", _uuid(F.col("rec"))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
            ("X-Page-Id", page),
        ),
        F.when(
            revisit,
            _lines(
                ("WARC-Profile", F.lit(PROFILE)),
                ("WARC-Refers-To", _uuid(F.concat(F.col("original").cast("string"), F.lit("/"), F.col("payload_digest")))),
            ),
        ).otherwise(F.lit("")),
        _lines(("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", block.cast("string"))),
        F.lit(CRLF),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.coalesce(F.col("payload").cast("string"), F.lit("")))
    return F.concat(head, http, body)


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
    file_bytes: int = 32 << 20,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write deduplicated archives below ``path``: one record per row, gzip-compressed, about ``file_bytes`` a file.

    Rows with null ids or payloads get a record too. Repeated rows of a page are written as the same record again.
    """
    headers = materialize(payload_headers(pages, id_col, payload_col), "warc-headers")
    resolved = resolve_revisits(headers, min_bytes).select("rec", "original")
    total = headers.agg(F.sum(F.col("payload_bytes") + 700)).first()[0] or 0
    files = max(1, -(-int(total) // file_bytes))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{payload_col}`").alias("payload")
    )
    keyed = rows.withColumn("bytes", F.coalesce(F.col("payload").cast("string"), F.lit("")).cast("binary"))
    keyed = keyed.withColumn("payload_digest", F.sha2("bytes", 256)).withColumn("payload_bytes", F.octet_length("bytes").cast("long"))
    rec = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit("/"), F.col("payload_digest"))
    keyed = keyed.drop("bytes").withColumn("rec", rec).repartition(files, "rec")
    records = keyed.join(resolved.hint("merge"), "rec", "left").select(warc_record(date).alias("value"))
    records.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)


def _parse(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers and block of each record of one archive."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    view, at = memoryview(data), 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        start = end + 4
        stop = start + int(head["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield head, view[start:stop]
        at = stop + 4


def read_archives(spark, path: str, id_type: str = "long", with_payload: bool = False) -> DataFrame:
    """Records of the archives below ``path``: ``page_id, record_type, target_uri, payload_digest, payload_bytes, refers_to``.

    The digest and the length of a response are computed from the payload that was read. A revisit record takes both,
    and the page that it refers to, from the original response, found by the record id that it names; a payload is
    given for responses only, if asked for. An archive is held by one task, which its bounded size allows.
    """
    schema = "page_id string, record_id string, record_type string, refers_to_record string, target_uri string, stated_digest string, payload_digest string, payload_bytes long"
    schema += ", payload binary" if with_payload else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        out = fields_arrow(with_payload)
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for head, block in _parse(content.as_py()):
                    raw = bytes(block)
                    payload = raw[raw.index(b"\r\n\r\n") + 4 :]
                    own = head["warc-type"] == "response"
                    row = (
                        head["x-page-id"], head["warc-record-id"], head["warc-type"], head.get("warc-refers-to"), head["warc-target-uri"],
                        head["warc-payload-digest"].partition(":")[2], hashlib.sha256(payload).hexdigest() if own else None,
                        len(payload) if own else None,
                    )
                    rows.append((*row, payload if own else None) if with_payload else row)
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in rows], out)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in rows], out)

    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = content.mapInArrow(run, fields(schema))
    found = found.withColumn("page_id", F.when(F.col("page_id") != "", F.col("page_id")).cast(id_type))
    return found


def resolve_read(records: DataFrame) -> DataFrame:
    """Join the revisit records of :func:`read_archives` to their original responses."""
    response = records.filter("record_type = 'response'")
    target = response.groupBy(F.col("record_id").alias("refers_to_record")).agg(
        F.first("page_id").alias("refers_to"), F.first("payload_digest").alias("d"), F.first("payload_bytes").alias("b")
    )
    back = records.filter("record_type <> 'response'").drop("payload_digest", "payload_bytes").join(target, "refers_to_record", "left")
    agree = F.when(F.col("stated_digest") == F.col("d"), F.col("d"))
    cols = ["page_id", "record_type", "target_uri"]
    return response.select(*cols, "payload_digest", "payload_bytes", F.lit(None).cast(response.schema["page_id"].dataType).alias("refers_to")).unionByName(
        back.select(*cols, agree.alias("payload_digest"), F.col("b").alias("payload_bytes"), "refers_to")
    )


def fields_arrow(with_payload: bool) -> pa.Schema:
    names = ["page_id", "record_id", "record_type", "refers_to_record", "target_uri", "stated_digest", "payload_digest"]
    out = [pa.field(n, pa.string()) for n in names] + [pa.field("payload_bytes", pa.int64())]
    return pa.schema(out + ([pa.field("payload", pa.binary())] if with_payload else []))


def op10_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """Write the whole ``pages`` table as archives with revisit records and read them back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    records = materialize(read_archives(spark, path, pages.schema["page_id"].dataType.simpleString()), "warc-read")
    return resolve_read(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_OP10 = """
with p as (select page_id, encode(coalesce(html, '')) as data from pages),
h as (select page_id, octet_length(data) as payload_bytes, sha256(data) as payload_digest from p),
f as (select payload_digest, min(page_id) as first from h where payload_bytes >= 100 group by 1)
select h.page_id, cast(h.payload_bytes as bigint) as payload_bytes, h.payload_digest,
 case when f.first < h.page_id then 'revisit' else 'response' end as record_type,
 case when f.first < h.page_id then f.first end as refers_to
from h left join f using (payload_digest)
"""
