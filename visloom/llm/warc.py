"""Legacy web archives (ARC, versions 1 and 2) converted to WARC, and WARC archives read back.

``read_arc`` walks each file by the declared lengths of its header lines, whose fields depend on the
version that the file's first block states. ``to_warc`` synthesises record identifiers (a UUID made from
a hash of address, date and digest), ISO timestamps, record types and SHA-256 digests, and turns repeats
of a payload into revisit records. ``write_warc`` writes them through Spark's committing text writer
(one record a row, the record end as line end), so that a lost executor leaves no half archive, and any
file system that Spark knows will do. ``read_warc`` walks the archives by Content-Length again.

Files are read whole by one task each, so archives should stay at a few hundred MB, as the formats
themselves advise; ``write_*`` cut a file per partition.

Defined cases: a null payload is an empty one; a null address becomes ``http://unknown.invalid/``; white
space in addresses is escaped; rows with equal keys and payloads stay records of their own, all of type
response if theirs is the smallest key; a null key is larger than any other; a file that breaks off or
has a broken header line yields what precedes the break and one row with ``problem`` set; an empty table
writes and reads no record.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LEAST_REVISIT_BYTES = 100
UNKNOWN = "http://unknown.invalid/"
#: The field lists that the two versions of the format put into their first block.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_SCHEMA = "file string, offset long, version int, url string, ip string, date string, mime string, http string, payload binary, problem string"
WARC_SCHEMA = "file string, offset long, type string, id string, date string, uri string, key string, refers_to_key string, refers_to string, declared_digest string, declared_bytes long, http string, payload binary, problem string"
OUT_BYTES = 8 << 20
#: Up to so many revisits (some 300 bytes each) are broadcast to their records; more are joined by place, which no key makes hot.
BROADCAST_REVISITS = 50_000


# --- ARC --------------------------------------------------------------------------------------------


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Pages as legacy archives, a file a partition, of version 1 and 2 in turn. The key travels in the HTTP header."""
    address = F.regexp_replace(F.coalesce(F.col(url), F.lit(UNKNOWN)), r"[\x00-\x20\x7F]", "%20")
    rows = pages.select(F.col(key).cast("string").alias("key"), F.when(address == "", UNKNOWN).otherwise(address).alias("url"), common.text_or_empty(html).cast("binary").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"part-{part:05d}.arc"
        first = f"{version} 0 visloom\n{ARC_FIELDS[version]}\n".encode()
        head = f"filedesc://{name} 0.0.0.0 20240101000000 text/plain " + ("" if version == 1 else f"200 - - 0 {name} ")
        yield pa.RecordBatch.from_arrays([pa.array([head.encode() + f"{len(first)}\n".encode() + first], pa.binary())], ["value"])
        for batch in batches:
            records = []
            for k, address, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"X-Record-Key: {k}\r\n" if k is not None else "") + f"Content-Length: {len(payload)}\r\n\r\n"
                body = http.encode() + payload
                middle = "" if version == 1 else f"200 {hashlib.md5(payload).hexdigest()} - 0 {name} "
                records.append(f"{address} 0.0.0.0 20240101000000 text/html {middle}{len(body)}\n".encode() + body)
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["value"])

    common.map_arrow(rows, run, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def inflate(data: bytes) -> bytes:
    """All members of a gzip file, or the bytes themselves."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out) if out else data


def split_http(body: bytes) -> tuple[str | None, bytes]:
    """The HTTP header block and the payload; no header if the body does not begin with a status line."""
    if body[:5] != b"HTTP/":
        return None, body
    end, gap = body.find(b"\r\n\r\n"), 4
    if end == -1:
        end, gap = body.find(b"\n\n"), 2
    return (body.decode("latin-1"), b"") if end == -1 else (body[:end].decode("latin-1"), body[end + gap :])


def parse_arc(data: bytes) -> Iterator[dict]:
    """The records of an archive: its first block, then one for each header line."""
    at, version = 0, 1
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        fields = data[at : end if end != -1 else len(data)].rstrip(b"\r").split(b" ")
        first = fields[0].startswith(b"filedesc://")
        wanted = len(fields) if first else len(ARC_FIELDS[version].split())
        if end == -1 or len(fields) < wanted or len(fields) < 5 or not fields[-1].isdigit() or end + 1 + int(fields[-1]) > len(data):
            yield {"offset": at, "version": version, "problem": "broken header line or length"}
            return
        body = data[end + 1 : end + 1 + int(fields[-1])]
        if first and body[:1].isdigit():
            version = 2 if body[:1] == b"2" else 1
        tail = fields[len(fields) - wanted + 1 :]
        url = b" ".join(fields[: len(fields) - wanted + 1]).decode("utf-8", "replace")
        http, payload = (None, body) if first else split_http(body)
        yield {"offset": at, "version": version, "url": url, "ip": tail[0].decode("latin-1"), "date": tail[1].decode("latin-1"), "mime": tail[2].decode("latin-1"), "http": http, "payload": payload}
        at = end + 1 + len(body)


def _read(spark: SparkSession, path: str, parse, schema: str) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    kinds = [types[f.split()[1]] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, kinds, strict=True)], names)

        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for record in parse(inflate(content.as_py())):
                    rows.append(record | {"file": file.as_py()})
                    held += len(record.get("payload") or b"")
                    if held >= OUT_BYTES:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)

    files = spark.read.format("binaryFile").load(path)
    return common.map_arrow(files.select("path", "content"), run, schema)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, parse_arc, ARC_SCHEMA)


# --- ARC to WARC ------------------------------------------------------------------------------------


def _header(http: Column, name: str) -> Column:
    found = F.regexp_extract(http, rf"(?i)(?:^|\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def to_warc(arc: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Parsed ARC records to WARC records: type, id, date, uri, key, digest, payload_bytes, refers_to (key and id), http, payload."""
    digest = F.sha2(F.col("payload"), 256)
    date = F.regexp_replace(F.rpad(F.regexp_extract("date", r"^\d{4,14}", 0), 14, "0"), r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    kind = F.when(F.col("url").startswith("filedesc://"), "warcinfo").when(F.col("http").isNotNull(), "response").otherwise("resource")
    rows = arc.where(F.col("problem").isNull()).select(
        kind.alias("kind"),
        date.alias("date"),
        F.col("url").alias("uri"),
        F.col("ip"),
        _header(F.col("http"), "X-Record-Key").cast("long").alias("key"),
        digest.alias("digest"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.concat_ws(":", F.element_at(F.split("file", "/"), -1), "offset").alias("place"),
        "http",
        "payload",
    )
    named = lambda *parts: F.regexp_replace(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    key_text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = rows.withColumn("id", named(F.col("uri"), F.col("date"), F.col("digest"), key_text(F.col("key"))))
    # Pre-aggregated: a digest that a third of the records share is one row from each task.
    # Payloads stay where they are: the table is written once, by columns, and only places and digests are compared.
    rows = common.cut(rows)
    shared = rows.where((F.col("kind") == "response") & (F.col("payload_bytes") >= least_bytes)).select("digest", "key", "id", "uri", "date", "place")
    first = F.min(F.struct(F.coalesce("key", F.lit((1 << 63) - 1)), "id", "key", "uri", "date")).alias("first")
    firsts = common.cut(shared.groupBy("digest").agg(first, F.count("*").alias("n")).where("n > 1").select("digest", "first.*").withColumnsRenamed({"id": "first_id", "key": "first_key", "uri": "first_uri", "date": "first_date"}))
    later = (F.col("key").isNull() | (F.col("key") > F.col("first_key"))) & F.col("first_key").isNotNull()
    revisits = shared.select("digest", "key", "place").join(firsts, "digest").where(later).select("place", "first_key", "first_id", "first_uri", "first_date")
    revisits = common.cut(revisits)
    few = revisits.limit(BROADCAST_REVISITS + 1).count() <= BROADCAST_REVISITS
    out = rows.join(F.broadcast(revisits) if few else revisits, "place", "left")
    again = F.col("first_key").isNotNull()
    return out.select(
        F.when(again, "revisit").otherwise(F.col("kind")).alias("type"),
        "id", "date", "uri", "ip", "key", "digest", "payload_bytes",
        F.when(again, F.col("first_key")).alias("refers_to_key"),
        F.when(again, F.col("first_id")).alias("refers_to"),
        F.when(again, F.col("first_uri")).alias("refers_to_uri"),
        F.when(again, F.col("first_date")).alias("refers_to_date"),
        "http",
        F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        "place",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Each record a row; the writer's line end is the record's end."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))
    http = F.coalesce(F.concat(F.col("http"), F.lit("\r\n\r\n")), F.lit(""))
    block_type = F.when(F.col("type") == "warcinfo", "application/warc-fields").when(F.col("http").isNotNull(), "application/http; msgtype=response").otherwise("application/octet-stream")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", F.col("id")),
        line("WARC-Date", F.col("date")),
        F.when(F.col("type") == "warcinfo", F.lit("")).otherwise(line("WARC-Target-URI", F.col("uri"))),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("type") == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(F.lit("")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        line("WARC-Refers-To-Date", F.col("refers_to_date")),
        line("X-Record-Key", F.col("key")),
        line("X-Refers-To-Key", F.col("refers_to_key")),
        line("X-Payload-Length", F.col("payload_bytes")),
        line("Content-Type", block_type),
        line("Content-Length", F.octet_length(http) + F.octet_length("payload")),
        F.lit("\r\n"),
    )
    records.select(F.concat(head, http, F.col("payload").cast("string")).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def parse_warc(data: bytes) -> Iterator[dict]:
    """The records of a WARC file, by their declared lengths."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : max(end, at)].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = fields.get("content-length", "")
        if end == -1 or not lines[0].startswith("WARC/") or not size.isdigit() or end + 4 + int(size) > len(data):
            yield {"offset": at, "problem": "broken record head or length"}
            return
        body = data[end + 4 : end + 4 + int(size)]
        http, payload = split_http(body)
        declared = fields.get("x-payload-length", "")
        yield {
            "offset": at, "type": fields.get("warc-type"), "id": fields.get("warc-record-id"), "date": fields.get("warc-date"), "uri": fields.get("warc-target-uri"),
            "key": fields.get("x-record-key"), "refers_to_key": fields.get("x-refers-to-key"), "refers_to": fields.get("warc-refers-to"),
            "declared_digest": fields.get("warc-payload-digest", "").rpartition(":")[2] or None, "declared_bytes": int(declared) if declared.isdigit() else None, "http": http, "payload": payload,
        }
        at = end + 4 + len(body)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``. Digest and size of a revisit's payload are the declared ones."""
    rows = _read(spark, path, parse_warc, WARC_SCHEMA)
    again = F.col("type") == "revisit"
    return rows.select(
        "*",
        F.when(again, F.col("declared_digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        F.when(again, F.col("declared_bytes")).otherwise(F.length("payload")).cast("long").alias("payload_bytes"),
    )


def op10_warc(spark, sf_dir: str) -> DataFrame:
    arc, warc = common.fresh_path(spark, "arc"), common.fresh_path(spark, "warc")
    with common.scratch(spark):
        write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), arc)
        records = to_warc(read_arc(spark, arc))
        common.drop_path(spark, arc)
        write_warc(records, warc)
    back = read_warc(spark, warc).where("type in ('response', 'revisit')")
    return back.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_to_key").cast("long").alias("refers_to"))


SQL = f"""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_REVISIT_BYTES} AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_REVISIT_BYTES} AND page_id > first_id THEN first_id END AS refers_to
FROM f"""
