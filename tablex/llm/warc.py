"""WARC archives of pages: written by Spark's text writer, read record by record, assembled into captures.

A page gives three records: the response (or a revisit of an equal payload seen at a smaller page id), the request
and the metadata; the last two name the first as concurrent. Spark's text writer ends every row with a separator of
choice, and the separator of WARC records is two line ends: so archives are plain gzip files on any
storage that Spark can write. The reader goes by each record's length, never by what a payload looks like.

A NULL payload is empty. A NULL url gives a record without target; control characters in one become %20. Of
equal payloads the smallest page id (NULL last) is the response; rows with that very id are all responses, so
repeated rows are written twice and read twice. A NULL page id stays NULL.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablex.llm.batches import in_arrow
from tablex.llm.common import table
from tablex.session import work_folder

END = "\r\n"
DATE = "2020-01-01T00:00:00Z"
RECORDS_PER_FILE = 30_000
#: Copies of each repeated digest in the join that looks up its first page, so that a frequent one is spread.
SALTS = 16
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest(payload: Column) -> Column:
    """SHA-1 in base 32: ten hexadecimal digits are eight digits of base 32."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    hexes = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexes, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), digits, BASE32)


def record(kind: str | Column, record_id: Column, target: Column, headers: list[Column], media: str, block: Column) -> Column:
    """A record without its closing separator; NULL headers are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    named = [
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        *headers,
        F.lit(f"Content-Type: {media}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(END, F.lit("WARC/1.1"), *named), F.lit(END * 2), block)


def first_pages(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(w_digest, w_salt, w_first): the smallest page of each payload that stands twice, once for each salt."""
    groups = pages.where(F.col("w_bytes") >= min_bytes).groupBy("w_digest").agg(F.min("w_page").alias("w_first"), F.count("*").alias("n"))
    return groups.where((F.col("n") > 1) & F.col("w_first").isNotNull()).select(F.col("w_digest").alias("w_same"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("w_at"), "w_first")


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> None:
    """Writes gzip archives of the pages into a new folder."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).alias("w_page"), F.regexp_replace(F.col(url), r"[\x00-\x20\x7F]", "%20").alias("w_url"), body.alias("w_body"))
    rows = rows.withColumns({"w_digest": digest(F.col("w_body")), "w_bytes": F.octet_length("w_body").cast("long"), "w_salt": F.pmod(F.xxhash64("w_page"), F.lit(SALTS)).cast("int")})
    same = (F.col("w_digest") == F.col("w_same")) & (F.col("w_salt") == F.col("w_at")) & (F.col("w_bytes") >= min_bytes)
    rows = rows.join(first_pages(rows, min_bytes), same, "left")

    def name(page: Column, kind: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), F.col("w_digest"), F.lit(f":{kind}>"))

    revisit = F.coalesce(F.col("w_first").isNotNull() & ~F.col("w_first").eqNullSafe(F.col("w_page")), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("w_bytes").cast("string"), F.lit(END * 2))
    of_payload = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("w_digest"))
    refers = F.when(revisit, F.concat_ws(END, F.concat(F.lit("WARC-Refers-To: "), name(F.col("w_first"), "response")), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))
    kind, itself = F.when(revisit, "revisit").otherwise("response"), name(F.col("w_page"), "response")
    beside = F.concat(F.lit("WARC-Concurrent-To: "), itself)
    fields = F.concat(F.lit("page-id: "), F.coalesce(F.col("w_page").cast("string"), F.lit("")), F.lit(END))
    asked = F.concat(F.lit("GET "), F.coalesce("w_url", F.lit("/")), F.lit(f" HTTP/1.1{END * 2}"))
    records = F.array(
        record(kind, itself, F.col("w_url"), [of_payload, refers], "application/http; msgtype=response", F.when(revisit, http).otherwise(F.concat(http, F.col("w_body")))),
        record("request", name(F.col("w_page"), "request"), F.col("w_url"), [beside], "application/http; msgtype=request", asked),
        record("metadata", name(F.col("w_page"), "metadata"), F.col("w_url"), [beside], "application/warc-fields", fields),
    )
    out = rows.select(F.explode(records).alias("value"))
    out.write.option("compression", "gzip").option("lineSep", END * 2).option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


HEAD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record of a stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            found = HEAD.match(line)
            headers[found[1].decode().lower()] = found[2].decode()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("a WARC record ends early")
        yield headers, block


FIELDS = ["record_id", "record_type", "target_uri", "concurrent_to", "refers_to", "payload_digest", "payload_bytes", "intact", "block_text", "payload"]
SCHEMA = "record_id string, record_type string, target_uri string, concurrent_to string, refers_to string, payload_digest string, payload_bytes long, intact boolean, block_text string, payload binary"


def row_of(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind = headers["warc-type"]
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    length = intact = payload = text = None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        stated_length = next((int(m[2]) for m in HEAD.finditer(head) if m[1].strip().lower() == b"content-length"), None)
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            length, intact, stated = len(payload), found == (stated or found), found
        else:
            length, payload = stated_length, None
    else:
        text = block.decode("utf-8", "replace")
    return (headers["warc-record-id"], kind, headers.get("warc-target-uri"), headers.get("warc-concurrent-to"), headers.get("warc-refers-to"), stated, length, intact, text, payload if payloads else None)


def read_records(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record; digests and lengths of responses are taken from the payload, those of revisits from their headers."""

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for headers, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    rows.append(row_of(headers, block, payloads))
                    size += len(rows[-1][-1] or b"") + 200
                    if size > 8_000_000:
                        yield to_batch(rows)
                        rows, size = [], 0
                yield to_batch(rows)

    def to_batch(rows):
        kinds = [pa.string()] * 6 + [pa.int64(), pa.bool_(), pa.string(), pa.binary()]
        columns = [*zip(*rows)] or [()] * len(FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=FIELDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return in_arrow(files.select("content"), read, SCHEMA)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit, with the request and the metadata concurrent to it (NULL where there is none)."""

    def side(kind: str, fields: list[str]) -> DataFrame:
        rows = records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
        return rows.groupBy(F.col("concurrent_to").alias("record_id")).agg(F.min(F.struct(*fields)).alias(kind))

    capture = records.where(F.col("record_type").isin("response", "revisit"))
    response = F.struct("record_type", "refers_to", "payload_digest", "payload_bytes", "intact", "payload").alias("response")
    capture = capture.select("record_id", "target_uri", response)
    fields = [F.col("record_id").alias("id"), F.col("block_text").alias("text")]
    return capture.join(side("request", fields), "record_id", "left").join(side("metadata", fields), "record_id", "left")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    target = f"{work_folder(spark, 'warc')}/archives"
    write_warc(table(spark, folder, "pages"), target)
    found = captures(read_records(spark, target, payloads=False))
    page = F.nullif(F.regexp_extract("metadata.text", r"^page-id: ([^\r\n]*)", 1), F.lit("")).cast("long")
    refers = F.nullif(F.regexp_extract("response.refers_to", r"^<urn:page:([^:]*):", 1), F.lit("")).cast("long")
    return found.select(
        page.alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        refers.alias("refers_to"),
    )


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
  array_to_string([substr('{BASE32}', 1 + ((('0x' || substr(h, 1 + 10 * (k // 8), 10))::BIGINT >> (35 - 5 * (k % 8))) & 31)::INT, 1) for k in range(32)], '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""

QUERIES = {"op2_warc": op2_warc}
ORACLES = {"op2_warc": ORACLE}
