"""WARC: converter of legacy ARC archives.

``pages_to_arc`` packs pages into ARC archives, alternately of version 1 and 2. ``convert`` parses any
ARC archives (name, content) - a ``binaryFile`` scan of real ones included - by the fields that each
file's version block declares and by declared lengths, and synthesises WARC identifiers, timestamps,
types and digests. ``deduplicate`` makes records of equal payloads revisits of the one with the smallest
page id. ``write_warc`` writes gzipped WARC files, ``read_warc`` reads such files back.

Defined cases: null html is an empty payload; a null or empty URL is ``-`` in the archive; a null page_id
stays null, sorts after every id and then by record id; rows with equal page_id are records of their
own (ties go to the smaller record id); a damaged archive yields its sound records and one row with
``error``; an archive's own description becomes ``warcinfo``, records without HTTP ``resource``; an empty
table gives an empty folder; other columns are ignored.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.llm import arc
from imlens.llm.common import prepare, schema, scratch, table

RECORD = (
    "record_id string, page_id long, date string, url string, ip string, kind string, record_type string, "
    "payload_digest string, payload_bytes long, http_head binary, payload binary, error string"
)


def pages_to_arc(pages: DataFrame, archive_bytes: int = 4_000_000, first_date: str = "2001-01-01 00:00:00") -> DataFrame:
    """(name, content): ARC archives of about ``archive_bytes``, a record for each page.

    The page id travels as an HTTP header of the record; the capture date is ``first_date`` plus as
    many seconds as the page id.
    """
    when = F.expr(f"timestamp_seconds(unix_timestamp('{first_date}') + coalesce(page_id, 0) % 1000000000)")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).cast("binary").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"),
    ).withColumn("date", F.date_format(when, "yyyyMMddHHmmss").cast("binary"))

    def run(batches):
        from pyspark import TaskContext

        part, count, held, size, name, version = TaskContext.get().partitionId(), 0, [], 0, "", 1
        for batch in batches:
            for page, url, html, date in zip(*(c.to_pylist() for c in batch.columns)):
                if not held:
                    version, name = 1 + count % 2, f"pages-{part:05d}-{count:05d}.arc"
                    held = [arc.arc_open(name, version, date)]
                    size, count = len(held[0]), count + 1
                mark = b"" if page is None else b"X-Page-Id: %d\r\n" % page
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n" % (mark, len(html))
                held.append(arc.arc_record(name, version, size, url, b"0.0.0.0", date, b"text/html", head + html))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(held)])], ["name", "content"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(held)])], ["name", "content"])

    return rows.mapInArrow(run, schema("name string, content binary"))


def _record(name: str, offset: int, fields, body) -> tuple:
    if body is None:
        return (arc.record_id(name, offset), None, None, None, None, None, "error", None, None, None, None, f"{name} at {offset}: {fields}")
    url = fields["URL"].decode("utf-8", "replace")
    kind = fields.get("Content-type", b"").decode("latin-1")
    parts = arc.http_parts(body)
    if url.startswith("filedesc://"):
        record_type, head, payload = "warcinfo", b"", body
    elif parts:
        record_type, (head, payload) = "response", parts
    else:
        record_type, head, payload = "resource", b"", body
    page = arc.http_field(head, b"X-Page-Id") if head else None
    return (
        arc.record_id(name, offset), int(page) if page else None, arc.warc_date(fields.get("Archive-date", b"")), url,
        fields.get("IP-address", b"").decode("latin-1") or None, kind, record_type, arc.digest(payload), len(payload), head, payload, None,
    )


def convert(archives: DataFrame) -> DataFrame:
    """The records (``RECORD``) of ARC archives given as (name, content)."""
    names, batch_bytes = [c.split()[0] for c in RECORD.split(", ")], 4_000_000
    kinds = pa.schema([
        (n, pa.int64() if t == "long" else pa.binary() if t == "binary" else pa.string()) for n, t in (c.split() for c in RECORD.split(", "))
    ])

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size = [], 0
                for offset, fields, body in arc.parse_arc(content):
                    rows.append(_record(name, offset, fields, body))
                    size += len(body or b"")
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], names)

    return archives.select("name", "content").mapInArrow(run, schema(RECORD))


def deduplicate(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` with ``refers_page``, ``refers_id``, ``refers_date``: null, or the response a revisit repeats.

    Only responses with payloads of at least ``min_bytes`` bytes take part. The first record of each digest is found by a
    map-side combined aggregate; the join back is an inner join, whose hot keys Spark splits.
    """
    key = F.when((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes), F.col("payload_digest"))
    records = records.withColumn("key", F.coalesce(key, F.col("record_id")))
    first = records.groupBy("key").agg(
        F.min(F.struct(F.col("page_id").isNull(), "page_id", "record_id", "date")).alias("first")
    )
    own = F.col("first.record_id") == F.col("record_id")
    out = records.join(first, "key").drop("key")
    for name, field in (("refers_page", "page_id"), ("refers_id", "record_id"), ("refers_date", "date")):
        out = out.withColumn(name, F.when(~own, F.col(f"first.{field}")))
    return out.withColumn("record_type", F.when(~own, "revisit").otherwise(F.col("record_type"))).drop("first")


def _warc(row: dict) -> bytes:
    kind, head, payload = row["record_type"], row["http_head"], row["payload"]
    revisit = kind == "revisit"
    block = head if revisit else head + payload
    media = {"warcinfo": "application/warc-fields", "resource": row["kind"] or "application/octet-stream"}
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", row["date"]),
        ("WARC-Target-URI", None if kind == "warcinfo" else row["url"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Block-Digest", f"sha1:{arc.digest(block)}"),
        ("X-Payload-Length", str(row["payload_bytes"])),
        ("Content-Type", media.get(kind, "application/http; msgtype=response")),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{row['refers_id']}>"),
            ("WARC-Refers-To-Date", row["refers_date"]),
            ("X-Refers-To-Page", None if row["refers_page"] is None else str(row["refers_page"])),
        ]
    return arc.warc_record(fields, block)


def write_warc(records: DataFrame, folder: str, max_records: int = 10_000, file_bytes: int = 32_000_000) -> None:
    """Gzipped WARC files, committed by Spark's text writer: a file ends with the record that reaches one of the bounds.

    A row is a whole file. A record ends with CR LF CR LF; the writer's own line end is the last LF.
    """

    def run(batches):
        held, size = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["records"])

        for batch in batches:
            for row in batch.to_pylist():
                held.append(_warc(row))
                size += len(held[-1])
                if size >= file_bytes or len(held) >= max_records:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    sound = records.filter("error IS NULL").drop("error")
    sound.mapInArrow(run, schema("records binary")).select(F.col("records").cast("string")).write.option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", 1).text(folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, record_type, date, url, page_id, payload_bytes, payload_digest, refers_page, payload) of WARC files.

    Digests of responses are computed from the payload read; a digest that differs from the record's
    own header is an error.
    """
    names = ["record_id", "record_type", "date", "url", "page_id", "payload_bytes", "payload_digest", "refers_page", "payload"]
    ddl = "record_id string, record_type string, date string, url string, page_id long, payload_bytes long, payload_digest string, refers_page long, payload binary"
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def row(fields, block):
        kind, told = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        parts = arc.http_parts(block) if kind in ("response", "revisit") else None
        head, payload = parts or (b"", block)
        if kind == "revisit":
            payload, length = None, int(fields["X-Payload-Length"])
        else:
            length = len(payload)
            if arc.digest(payload) != told:
                raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
        page, refers = arc.http_field(head, b"X-Page-Id") if head else None, fields.get("X-Refers-To-Page")
        return (
            fields["WARC-Record-ID"][1:-1], kind, fields["WARC-Date"], fields.get("WARC-Target-URI"), int(page) if page else None,
            length, told, int(refers) if refers else None, payload,
        )

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, size = [], 0
                for fields, block in arc.parse_warc(gzip.decompress(content)):
                    rows.append(row(fields, block))
                    size += len(block)
                    if size >= 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(run, schema(ddl))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from the archives read back."""
    prepare(spark)
    folder = scratch(spark, "warc")
    write_warc(deduplicate(convert(pages_to_arc(table(spark, sf_dir, "pages")))), folder)
    return (
        read_warc(spark, folder)
        .filter("record_type IN ('response', 'revisit')")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_page").alias("refers_to"))
    )


#: DuckDB has no base32: ten hex digits at a time give eight letters of the digest.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, html, strlen(html) AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT page_id, payload_bytes, h,
        list_reduce([''] || list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::INTEGER, 10))::BIGINT >> (35 - 5 * (i % 8))::INTEGER) & 31)::INTEGER, 1)),
            lambda x, y: x || y) AS payload_digest FROM h),
f AS (SELECT h, min(page_id) AS first_id FROM b GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM b JOIN f USING (h)
"""
