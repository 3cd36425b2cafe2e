"""Web archives: pages written as WARC records, and the records of a capture assembled again."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import scale
from panelkit.llm.common import written

#: Payloads below this many bytes are always stored in full.
MIN_REVISIT_BYTES = 1000
#: Most records in one archive file; a file is read by one task.
RECORDS_PER_FILE = 30_000
#: Date written into the records when none is given.
DATE = "2000-01-01T00:00:00Z"

# fixed values of the archive format
BREAK = "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
          "digest string, content_type string, fields map<string,string>, payload_bytes long, payload_sha1 string, payload binary")


# ---- writing -------------------------------------------------------------------------------------

def _urn(row: Column, kind: str, crawl: str) -> Column:
    """Record identifier of one part of a capture."""
    x = F.md5(F.concat_ws("/", F.lit(crawl), row.cast("string"), F.lit(kind)))
    return F.concat(F.lit("<urn:uuid:"), *[p for i, (a, n) in enumerate([(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)])
                                          for p in ([F.lit("-")] if i else []) + [F.substring(x, a, n)]], F.lit(">"))


def _record(kind: Column | str, record_id: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """Text of a record without its closing line breaks; headers without a value are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id),
             *[F.concat(F.lit(f"{name}: "), value) for name, value in headers], F.lit(f"Content-Type: {content_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(BREAK, *lines), F.lit(END), block)  # concat_ws skips what is null


def records(pages: DataFrame, crawl: str, date: str = DATE, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Three records for every page (needs page_id, url, html): response or revisit, request, metadata; column ``record``.

    Of the pages with equal payloads of at least ``min_revisit_bytes``, that with the largest page_id (null is
    the smallest; of repeated rows any one) holds the payload, the others are revisits that refer to it.
    """
    # numbered and written once: the numbers are the identity of a row, also of a repeated one
    payload = F.coalesce("html", F.lit(""))
    rows = written(pages.select(
        F.url_encode(F.col("page_id").cast("string")).alias("page"), F.col("page_id").alias("_id"), "url", payload.alias("html"),
        F.octet_length(payload).alias("_bytes"), F.sha2(payload.cast("binary"), 256).alias("_content"),
        F.monotonically_increasing_id().alias("_row")))
    chiefs = (rows.where(F.col("_bytes") >= min_revisit_bytes).groupBy("_content")
              .agg(F.max(F.struct("_id", "_row", "url")).alias("_chief"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    rows = scale.lookup_join(rows, chiefs, ["_content"])
    again = F.col("_chief").isNotNull() & (F.col("_chief._row") != F.col("_row"))
    uri = lambda c: F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    url, when, own = uri(F.col("url")), ("WARC-Date", F.lit(date)), _urn(F.col("_row"), "response", crawl)
    target, concurrent = ("WARC-Target-URI", url), ("WARC-Concurrent-To", own)
    rest = F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)([^#]*)", 1), F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)([^#]*)", 2)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
                    F.col("_bytes").cast("string"), F.lit(END))
    response = _record(
        F.when(again, "revisit").otherwise("response"), own,
        [when, target, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("html").cast("binary")))),
         ("WARC-Profile", F.when(again, PROFILE)),
         ("WARC-Refers-To", F.when(again, _urn(F.col("_chief._row"), "response", crawl))),
         ("WARC-Refers-To-Target-URI", F.when(again, uri(F.col("_chief.url"))))],
        "application/http; msgtype=response", F.concat(http, F.when(again, "").otherwise(F.col("html"))))
    request = _record("request", _urn(F.col("_row"), "request", crawl), [when, target, concurrent],
                      "application/http; msgtype=request",
                      F.concat(F.lit("GET "), F.when(F.coalesce(rest[1], F.lit("")) == "", "/").otherwise(rest[1]),
                               F.lit(f" HTTP/1.1{BREAK}Host: "), F.coalesce(rest[0], F.lit("")), F.lit(END)))
    metadata = _record("metadata", _urn(F.col("_row"), "metadata", crawl), [when, target, concurrent], "application/warc-fields",
                       F.coalesce(F.concat(F.lit("page_id: "), F.col("page"), F.lit(BREAK)), F.lit("")))
    return rows.select(F.explode(F.array(response, request, metadata)).alias("record"))


def write(pages: DataFrame, path: str, crawl: str | None = None, records_per_file: int = RECORDS_PER_FILE, **options) -> None:
    """Write the records of ``pages`` under ``path`` as compressed archives.

    Spark's text writer does it: the two line breaks that close a record are the line separator, and the bytes
    of a payload pass unchanged, whatever they are. Its commit keeps the files of finished tasks only.
    """
    # the name of the crawl is the same in every task and every rerun, so a record keeps its identifier
    (records(pages, crawl or uuid.uuid4().hex, **options).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


# ---- reading -------------------------------------------------------------------------------------

def _hex(digest: str | None) -> str | None:
    """Bare lower-case hex of a labelled SHA-1 digest, which archives give in hex or base 32."""
    kind, _, value = (digest or "").partition(":")
    if kind.strip().lower() != "sha1":
        return None
    value = value.strip()
    if len(value) == 32:
        try:
            return base64.b32decode(value.upper()).hex()
        except ValueError:
            return None
    return value.lower()


def _pairs(lines: list[bytes]) -> dict[str, str]:
    """Named fields of a header, names in lower case; the first of equal names counts."""
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _parse(head: bytes, block: bytes, keep: bool) -> tuple:
    h = _pairs(head.split(b"\r\n")[1:])
    kind, content = h.get("warc-type"), h.get("content-type", "")
    fields = _pairs(block.split(b"\r\n")) if content.startswith("application/warc-fields") else {}
    body = block
    if content.startswith("application/http"):
        body = block.partition(b"\r\n\r\n")[2]
    return (h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"),
            h.get("warc-date"), _hex(h.get("warc-payload-digest")), content or None, list(fields.items()), len(body),
            hashlib.sha1(body).hexdigest(), body if keep else None)


def _records(rows: Iterator[tuple[str, bytes]]) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of each record, from the pieces of files between two blank lines, file after file."""
    file, parts, have, need = None, [], 0, 0
    for name, piece in rows:
        if name != file:
            file, parts, have, need = name, [], 0, 0
        parts += [piece, b"\r\n\r\n"]
        have += len(piece) + 4
        while have >= need and have:
            data = b"".join(parts)
            head_at = 0
            while data.startswith(b"\r\n", head_at):  # what is left of line breaks between records
                head_at += 2
            head_end = data.find(b"\r\n\r\n", head_at)
            if head_end < 0:
                parts, have, need = ([data[head_at:]], len(data) - head_at, 0) if head_at < len(data) else ([], 0, 0)
                break
            size = _pairs(data[head_at:head_end].split(b"\r\n")).get("content-length", "")
            if not data.startswith(b"WARC/", head_at) or not size.isdigit():
                parts, have, need = [data[head_end + 4:]], len(data) - head_end - 4, 0  # no record begins here: look further on
                continue
            stop = head_end + 4 + int(size)
            if len(data) < stop:
                parts, have, need = [data[head_at:]], len(data) - head_at, stop - head_at
                break
            yield data[head_at:head_end], data[head_end + 4:stop]
            parts, have, need = [data[stop:]], len(data) - stop, 0


_ARROW = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
                    ("target_uri", pa.string()), ("date", pa.string()), ("digest", pa.string()), ("content_type", pa.string()),
                    ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string()),
                    ("payload", pa.binary())])


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of the compressed archives under ``path``, one row each; without ``payload`` only its length and SHA-1.

    The text reader hands over the pieces between blank lines in their order; a task joins those of its files
    and cuts records by their Content-Length, so blank lines inside a payload are part of it. A record that its
    file cuts short is left out, and so is what does not begin with a record header. Payloads of HTTP records
    are their bodies.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        out, size = [], 0
        for head, block in _records(pieces()):
            out.append(_parse(head, block, payload))
            size += len(block) if payload else 0
            if len(out) >= 4096 or size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)

    text = spark.read.option("lineSep", END).text(path)
    return text.select(F.col("_metadata.file_path"), F.col("value").cast("binary")).mapInArrow(cut, RECORD)


# ---- captures ------------------------------------------------------------------------------------

def captures(records: DataFrame) -> DataFrame:
    """One nested row for each response or revisit record: record_id, type, response, request, metadata, counts.

    Requests and metadata find their capture by the identifier they are concurrent to. Each side is reduced
    to one row per capture before the join (the record of the smallest identifier, and how many there were),
    so a capture with any number of them stays one row. Responses without a partner have null there; partners
    without a response make no capture; null identifiers match nothing; an empty table gives no rows.
    """
    part = ["record_id", "target_uri", "date", "content_type", "fields"]

    def side(kind: str) -> DataFrame:
        return (records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull()).groupBy(F.col("concurrent_to").alias("_id"))
                .agg(F.min_by(F.struct(*part), "record_id").alias(kind), F.count(F.lit(1)).alias(f"n_{kind}")))

    kept = ["target_uri", "date", "digest", "refers_to", "payload_bytes", "payload_sha1", "payload"]
    responses = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("_id"), "type", F.struct(*kept).alias("response"))
    none = F.lit(0).cast("long")
    return (responses.join(side("request"), "_id", "left").join(side("metadata"), "_id", "left")
            .select(F.col("_id").alias("record_id"), "type", "response", "request", "metadata",
                    F.coalesce("n_request", none).alias("n_request"), F.coalesce("n_metadata", none).alias("n_metadata")))


def resolve(captured: DataFrame) -> DataFrame:
    """Adds ``origin`` (record_id, fields, payload_bytes, payload_sha1) to revisits: the response they refer to.

    Many revisits may refer to one response; the join deals such a hot one out. ``captured`` should be a written table.
    """
    wanted = captured.where("type = 'revisit'").select(F.col("response.refers_to").alias("_ref")).where("_ref is not null").distinct()
    found = (captured.where("type = 'response'").select(F.col("record_id").alias("_ref"), F.struct(
        "record_id", "metadata.fields", "response.payload_bytes", "response.payload_sha1").alias("origin"))
        .join(wanted, "_ref", "left_semi").groupBy("_ref").agg(
            F.min_by("origin", F.struct("origin.payload_sha1", "origin.payload_bytes")).alias("origin")))
    return scale.lookup_join(captured.withColumn("_ref", F.col("response.refers_to")), found, ["_ref"]).drop("_ref")


def round_trip(pages: DataFrame, path: str, payload: bool = True, **options) -> DataFrame:
    """Pages written as archives under ``path`` and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    Needs page_id, url and html. Null html is an empty payload; a null url gives records without a target, and
    line breaks in one are percent-encoded; a null page_id comes back as null; repeated rows are captures of
    their own, one of which is the response; an empty table gives no rows; extra columns are left out. ``intact``
    says whether the payload that was read (for revisits: the one referred to) has the digest the record names.
    """
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    write(pages, path, **options)
    found = resolve(written(captures(written(read(spark, path, payload)))))  # archives are parsed once
    first = F.col("type") == "response"
    page = lambda fields: F.url_decode(fields["page_id"]).cast(kind)
    read_sha1 = F.when(first, F.col("response.payload_sha1")).otherwise(F.col("origin.payload_sha1"))
    return found.select(
        page(F.col("metadata.fields")).alias("page_id"),
        F.when(first, F.col("response.payload_bytes")).otherwise(F.col("origin.payload_bytes")).alias("payload_bytes"),
        F.when(first, read_sha1).otherwise(F.col("response.digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), page(F.col("origin.fields")).alias("refers_to"),
        (read_sha1 == F.col("response.digest")).alias("intact"))
