"""WARC archives: writing captures as records, reading records, and assembling transactions.

Spark writes and reads the files, so any store that it reaches will do: records are texts ended by
the two line ends that the format asks for, and files are read whole, framed by Content-Length.
"""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode
from collections.abc import Iterator
from io import BytesIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataroll.llm.common import saved, text_or_empty

END = "\r\n"
DATE = "2024-01-01T00:00:00Z"
#: Records of a file at most; it bounds what a reader holds.
FILE_RECORDS = 15_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURES = ("response", "revisit")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1, from its hexadecimal form: 20 bits at a time."""
    digest, parts = F.sha1(payload.cast("binary")), []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            parts.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*parts)


def record(kind: Column | str, fields: list[tuple[str, Column | str]], block: Column) -> Column:
    """A record's text, without the line ends after it. Fields whose value is null are left out."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    every = [("WARC-Type", kind), *fields, ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [
        F.coalesce(F.concat(F.lit(f"{name}: "), lit(value), F.lit(END)), F.lit("")) for name, value in every
    ]
    return F.concat(F.lit(f"WARC/1.1{END}"), *lines, F.lit(END), block)


def write_captures(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """A request, a response or revisit, and a metadata record for each row of ``pages``.

    ``pages`` has ``page_id, url, html``; null html is an empty payload, a null url an empty one,
    and a null id is written as an empty one. Of rows with equal payloads of ``least_bytes`` at
    least, the one with the smallest id (null last, then the first row) is the response.
    ``pages`` must be a stored table or another plan that gives its rows in the same places each
    time, as it is read twice.
    """
    html = text_or_empty("html")
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace(text_or_empty("url"), r"[\x00-\x20]", "%20").alias("url"),
        html.alias("html"),
        base32_sha1(html).alias("digest"),
    )
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")
    large = F.octet_length("html") >= least_bytes
    firsts = rows.filter(large).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    # Only payloads that repeat; written, so that a digest that many rows share is split in the join.
    firsts = saved(firsts.filter("n > 1").select("digest", "first"), "repeated-payloads")
    marked = rows.join(firsts, "digest", "left").withColumn("again", large & (F.col("first.row") != F.col("row")))

    name = lambda row, page, part: F.concat(
        F.lit("<urn:x-capture:"), row.cast("string"), F.lit(":"), F.coalesce(page.cast("string"), F.lit("")), F.lit(f":{part}>")
    )
    own = lambda part: name(F.col("row"), F.col("page_id"), part)
    again = F.coalesce("again", F.lit(False))
    status = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(END + END),
    )
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", DATE)]
    response = record(
        F.when(again, "revisit").otherwise("response"),
        [
            ("WARC-Record-ID", own("response")), *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("WARC-Refers-To", F.when(again, name(F.col("first.row"), F.col("first.page_id"), "response"))),
            ("Content-Type", "application/http;msgtype=response"),
        ],
        F.concat(status, F.when(again, "").otherwise(F.col("html"))),
    )
    request = record(
        "request",
        [
            ("WARC-Record-ID", own("request")), ("WARC-Concurrent-To", own("response")), *common,
            ("Content-Type", "application/http;msgtype=request"),
        ],
        F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{END}{END}")),
    )
    metadata = record(
        "metadata",
        [
            ("WARC-Record-ID", own("metadata")), ("WARC-Concurrent-To", own("response")), *common,
            ("Content-Type", "application/warc-fields"),
        ],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END)),
    )
    texts = marked.select(F.explode(F.array(request, response, metadata)).alias("value"))
    options = {"lineSep": END + END, "compression": "gzip", "maxRecordsPerFile": FILE_RECORDS}
    texts.write.options(**options).text(path)


def parse(content: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Header fields, names in lower case, and block of each record; raises on a broken one."""
    stream = gzip.GzipFile(fileobj=BytesIO(content)) if content[:2] == b"\x1f\x8b" else BytesIO(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"No WARC record begins with {line[:40]!r}")
        fields = []
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields.append((name.strip().lower(), value.strip()))
        size = int(dict(fields)["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("A record ends before its Content-Length")
        yield fields, block


RECORDS = pa.schema(
    [
        ("kind", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
    ]
)
RECORDS_SQL = (
    "kind string, record_id string, concurrent_to array<string>, refers_to string, target_uri string,"
    " payload_bytes bigint, payload_digest string, fields map<string, string>, payload binary"
)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row for each record of the archives under ``path``.

    The payload of a response follows its HTTP header, and its size and SHA-1 are of what is there.
    A revisit has none: size and digest are those it states. ``fields`` has the lines of a metadata
    record. Payloads can be left out where only digests are of interest.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def row(fields: list[tuple[str, str]], block: bytes) -> dict:
        named = dict(fields)
        kind = named.get("warc-type")
        found = {
            "kind": kind, "record_id": named.get("warc-record-id"), "refers_to": named.get("warc-refers-to"),
            "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"], "target_uri": named.get("warc-target-uri"),
        }
        head, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            found |= {"payload_bytes": len(payload), "payload_digest": b32encode(hashlib.sha1(payload).digest()).decode()}
            found["payload"] = payload if with_payload else None
        elif kind in ("revisit", "metadata"):
            lines = [x.partition(":") for x in head.decode("utf-8", "replace").split(END)]
            stated = {k.strip().lower(): v.strip() for k, _, v in lines if v}
            if kind == "revisit":
                size = stated.get("content-length", "")
                found["payload_bytes"] = int(size) if size.isdigit() else None
                found["payload_digest"] = named.get("warc-payload-digest", "").rpartition(":")[2] or None
            else:
                found["fields"] = list(stated.items())
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for fields, block in parse(content.as_py()):
                    held.append(row(fields, block))
                    size += len(block) if with_payload else 200
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(held, schema=RECORDS)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=RECORDS)

    return files.mapInArrow(run, RECORDS_SQL)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each response or revisit record.

    ``record_id, record_type, target_uri, payload_bytes, payload_digest, refers_to, payload, request,
    metadata``: requests and metadata records join it if they name it in WARC-Concurrent-To, if it
    names them, or if they name a request that does. ``request`` is the one of smallest id, null if
    there is none; ``metadata`` has all records, by id. Requests and metadata that no capture
    claims are not in the result. ``records`` is read several times and should be stored.
    """
    captures = records.filter(F.col("kind").isin(*CAPTURES))
    others = records.filter(F.col("kind").isin("request", "metadata"))
    names = records.select("record_id", "kind", F.explode("concurrent_to").alias("to"))
    is_capture = F.col("kind").isin(*CAPTURES)
    links = names.filter(~is_capture).select(F.col("record_id").alias("member"), F.col("to").alias("anchor"))
    links = links.union(names.filter(is_capture).select(F.col("to").alias("member"), F.col("record_id").alias("anchor")))
    direct = links.join(captures.select(F.col("record_id").alias("anchor")), "anchor", "left_semi")
    requests = records.filter(F.col("kind") == "request").select(F.col("record_id").alias("anchor"))
    through = links.join(requests, "anchor", "left_semi").withColumnRenamed("anchor", "request")
    hop = direct.select(F.col("member").alias("request"), "anchor")
    anchors = direct.select("member", "anchor").union(through.join(hop, "request").select("member", "anchor")).distinct()
    parts = others.join(anchors.withColumnRenamed("member", "record_id"), "record_id")
    part = F.struct("record_id", "target_uri", "fields")
    grouped = parts.groupBy("anchor").agg(
        F.min(F.when(F.col("kind") == "request", F.struct("record_id", "target_uri"))).alias("request"),
        F.collect_list(F.when(F.col("kind") == "metadata", part)).alias("metadata"),
    )
    by_id = lambda a, b: F.when(a["record_id"] < b["record_id"], -1).when(a["record_id"] > b["record_id"], 1).otherwise(0)
    joined = captures.join(grouped.withColumnRenamed("anchor", "record_id"), "record_id", "left")
    return joined.select(
        "record_id", F.col("kind").alias("record_type"), "target_uri", "payload_bytes", "payload_digest", "refers_to",
        "payload", "request", F.array_sort(F.coalesce("metadata", F.array()), by_id).alias("metadata"),
    )


def page_of(record_id: Column) -> Column:
    """The page id within an identifier that ``write_captures`` made, null if it has none."""
    return F.nullif(F.regexp_extract(record_id, r":(-?[0-9]*):response>$", 1), F.lit("")).cast("bigint")


def capture_digests(captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of assembled captures.

    The page's id is read from the metadata record that joined the capture.
    """
    stated = F.get(F.col("metadata"), F.lit(0))["fields"]["page-id"]
    return captures.select(
        stated.try_cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
