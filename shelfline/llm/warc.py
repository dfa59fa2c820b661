"""WARC archives: pages written as records, long ones in segments, and put together again.

A record is an HTTP response whose payload is framed in chunks. Chunks end where the payload would
show the record mark, so the mark stands in an archive at the start of records only, and no task holds
more than a record. Files are compressed whole and hold a bounded number of records. A message longer than `segment` goes on in
continuation records that name the first one; reading groups these by that name, orders them by
segment number, verifies the total length, and takes the chunk framing off.

Of pages with equal payloads of at least `least` bytes the one with the smallest id is the response;
the others are revisits without payload that name it. Null html is empty. A null page_id is written
as an empty name; it is never the one referred to unless all ids of its payload are null, and then
each row is a response. Rows that repeat id and payload are records of their own with a serial
number behind the shared part of their name. Control characters and spaces in a url are
percent-encoded; a null url is left out. No pages give no records. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.scratch import remove, shared_folder, shuffles_freed, written
from shelfline.llm.wordprints import slices

# Fixed values of the formats: record mark, line ends, base-32 digits.
MARK, LINE, RECORD_END = "WARC/1.1\r\n", "\r\n", "\r\n\r\n"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SEGMENT, CHUNK, LEAST = 1 << 20, 1 << 16, 0
#: Records of a compressed file at most.
RECORDS = 10_000
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def digest(payload: Column) -> Column:
    """Base-32 SHA-1: each 10 hex digits are 40 bits, so 8 digits of base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def framed(payload: bytes, size: int = CHUNK) -> bytes:
    """In chunks of at most `size`, none of which holds the record mark whole."""
    out, at = [], 0
    while at < len(payload):
        end = min(at + size, len(payload))
        mark = payload.find(b"WARC/", at, end)
        if mark >= 0:
            end = mark + 3
        out += (b"%x\r\n" % (end - at), payload[at:end], b"\r\n")
        at = end
    return b"".join([*out, b"0\r\n\r\n"])


def unframed(body: bytes) -> bytes | None:
    """The payload, or None where the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = re.match(rb"[0-9A-Fa-f]+", body[at:line]) if line >= 0 else None
        if size is None:
            return None
        n, at = int(size[0], 16), line + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def _record(headers: dict[str, object], block: bytes) -> bytes:
    lines = [f"{k}: {v}{LINE}" for k, v in headers.items() if v is not None]
    return (MARK + "".join(lines) + f"Content-Length: {len(block)}{LINE}{LINE}").encode() + block


def _written(name: str, refers_to: str | None, url: str | None, sha: str, payload: bytes, segment: int) -> list[bytes]:
    """The record of a page, in segments if its block is longer."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP + (framed(payload) if kind == "response" else b"")
    parts = [block[at : at + segment] for at in range(0, len(block), segment)]
    first = {"WARC-Type": kind, "WARC-Record-ID": f"<{name}>", "WARC-Date": DATE, "WARC-Target-URI": url,
             "WARC-Payload-Digest": f"sha1:{sha}", "Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        first["WARC-Refers-To"] = f"<{refers_to}>"
    if len(parts) > 1:
        first["WARC-Segment-Number"] = 1
    made = [_record(first, parts[0])]
    for k, part in enumerate(parts[1:], 2):
        more = {"WARC-Type": "continuation", "WARC-Record-ID": f"<{name}:{k}>", "WARC-Date": DATE,
                "WARC-Segment-Origin-ID": f"<{name}>", "WARC-Segment-Number": k}
        if k == len(parts):
            more["WARC-Segment-Total-Length"] = len(block)
        made.append(_record(more, part))
    return made


def _records(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, edges in slices(batch, "payload"):
                names = [batch[c].slice(low, high - low).to_pylist() for c in ("name", "refers_to", "url", "sha")]
                payloads = (data[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True))
                made = [r for row in zip(*names, payloads, strict=True) for r in _written(*row, segment)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])

    return run


def write(pages: DataFrame, path: str, least: int = LEAST, segment: int = SEGMENT) -> None:
    """Archives of all pages below `path`."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", digest(F.col("payload")))
    thin = written(rows.select("page_id", "sha", F.octet_length("payload").alias("n")).groupBy("page_id", "sha", "n").agg(F.count("*").alias("rows")))
    origin = thin.filter(F.col("n") >= least).groupBy("sha").agg(F.min("page_id").alias("origin"))
    told = thin.join(origin, "sha", "left").select(F.col("page_id").alias("of"), "sha", "rows", "origin")

    def name(page_id: str) -> Column:
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(":"), F.col("sha"))

    told = told.withColumnRenamed("sha", "of_sha")
    full = rows.join(told, F.col("page_id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("of_sha")))
    own = F.when(F.col("rows") > 1, F.concat(name("page_id"), F.lit(":row"), F.monotonically_increasing_id().cast("string"))).otherwise(name("page_id"))
    again = F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    made = full.select(own.alias("name"), F.when(again, name("origin")).alias("refers_to"), url.alias("url"), "sha", "payload").mapInArrow(_records(segment), "record binary")
    lines = made.select(F.col("record").cast("string").alias("value"))
    # A compressed file is read by one task, so none holds more than so many records.
    with shuffles_freed(pages.sparkSession):
        lines.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)
    remove(thin)


HEAD = ["type", "id", "refers_to", "digest", "url"]
PART = pa.schema([*[(c, pa.string()) for c in HEAD], ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("whole", pa.bool_()), ("block", pa.binary()), ("payload", pa.binary()), ("sha", pa.string())])
PARTS = "type string, id string, refers_to string, digest string, url string, origin string, number int, total bigint, whole boolean, block binary, payload binary, sha string"


def _payload(block: bytes) -> tuple[bytes | None, str | None]:
    """Of an HTTP message: its payload, with chunk framing taken off, and its digest; None where the framing is broken."""
    head, _, body = block.partition(b"\r\n\r\n")
    if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked", head):
        body = unframed(body)
    return body, None if body is None else base64.b32encode(hashlib.sha1(body).digest()).decode()


def _part(raw: bytes, decode: bool) -> dict:
    """A record's fields. With `decode`, one that is no segment has its payload in place of its block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode(errors="replace").split("\r\n"))}
    n = int(h.get("content-length", "-1"))
    number, total = h.get("warc-segment-number"), h.get("warc-segment-total-length")
    block = rest[: max(n, 0)]
    payload, sha = _payload(block) if decode and number is None else (None, None)
    return {
        "type": h.get("warc-type"), "id": h.get("warc-record-id", "").strip("<>"), "refers_to": h.get("warc-refers-to", "").strip("<>") or None,
        "digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None, "url": h.get("warc-target-uri"),
        "origin": h.get("warc-segment-origin-id", "").strip("<>") or None, "number": number and int(number), "total": total and int(total),
        "whole": n >= 0 and len(rest) >= n and rest[n:].strip(b"\r\n") == b"",
        "block": None if decode and number is None else block, "payload": payload, "sha": sha,
    }


def _parsed(decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, edges in slices(batch, "value"):
                parts = [_part(data[a:b].tobytes(), decode) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_pylist(parts, PART)

    return run


def _glued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ordered blocks as one block, its payload and the payload's digest."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            block = b"".join(row["blocks"][0].as_py())
            payload, sha = _payload(block)
            made = [pa.array([block], pa.binary()), pa.array([payload], pa.binary()), pa.array([sha], pa.string())]
            yield pa.RecordBatch.from_arrays([*row.drop_columns(["blocks"]).columns, *made], [*[n for n in row.schema.names if n != "blocks"], "block", "payload", "sha"])


def _read(spark: SparkSession, path: str, decode: bool) -> DataFrame:
    raw = spark.read.schema("value string").option("lineSep", MARK).text(path).filter(F.octet_length("value") > 0)
    parts = raw.select(F.col("value").cast("binary").alias("value")).mapInArrow(_parsed(decode), PARTS)
    out = [*HEAD, "block", "payload", "sha", "complete"]
    single = parts.filter("number is null").withColumn("complete", F.col("whole")).select(*out)
    joined = (
        parts.filter("number is not null").groupBy(F.coalesce("origin", "id").alias("id"))
        .agg(
            F.collect_list(F.struct("number", "block")).alias("parts"),
            *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in HEAD if c != "id"],
            F.max("total").alias("total"), F.bool_and("whole").alias("whole"),
            F.count("*").alias("n"), F.max("number").alias("last"), F.countDistinct("number").alias("numbers"),
        )
        .withColumn("sound", F.col("whole") & (F.col("n") == F.col("last")) & (F.col("numbers") == F.col("last")))
        .select(*HEAD, "sound", "total", F.transform(F.sort_array("parts"), lambda p: p["block"]).alias("blocks"))
    )
    glued = joined.mapInArrow(_glued, "type string, id string, refers_to string, digest string, url string, sound boolean, total bigint, block binary, payload binary, sha string")
    sound = F.col("sound") & (F.octet_length("block") == F.col("total"))
    return single.unionByName(glued.withColumn("complete", F.coalesce(sound, F.lit(False))).select(*out))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives at `path`, segments put together: type, id, refers_to, digest, url, block, complete.

    complete: every part has its declared length, segments are numbered 1 to n, and their lengths
    add up to the declared total.
    """
    return _read(spark, path, False).select(*HEAD, "block", "complete")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """records() with the payload in place of the block, its measured digest, and `complete` only if that is the declared one."""
    found = _read(spark, path, True)
    sound = F.col("complete") & ((F.col("type") == "revisit") | F.col("sha").eqNullSafe(F.col("digest")))
    return found.select(*HEAD, "payload", "sha", sound.alias("complete"))


def pages_read(spark: SparkSession, path: str) -> DataFrame:
    """Per record of archives written here: page_id, payload_bytes, payload_digest, record_type, refers_to, complete."""
    rows = payloads(spark, path)

    def page(name: str) -> Column:
        text = F.regexp_extract(name, r"^urn:page:(-?[0-9]+):", 1)
        return F.when(text != "", text.cast("long"))

    rows = written(rows.select(
        page("id").alias("page_id"), F.octet_length("payload").cast("long").alias("n"), F.coalesce("sha", "digest").alias("sha"), "digest",
        F.col("type").alias("record_type"), page("refers_to").alias("refers_to"), "complete"))
    first = rows.filter("record_type = 'response'").groupBy("digest").agg(F.max("n").alias("of_response"))
    again = F.col("record_type") == "revisit"
    return rows.join(first, "digest", "left").select(
        "page_id", F.when(again, F.col("of_response")).otherwise(F.col("n")).alias("payload_bytes"),
        F.when(again, F.col("digest")).otherwise(F.col("sha")).alias("payload_digest"), "record_type", "refers_to", "complete")


def round_trip(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Write archives of all pages into a new shared folder and read them back."""
    path = shared_folder(pages.sparkSession)
    write(pages, path, segment=segment)
    return pages_read(pages.sparkSession, path)


def oracle(least: int = LEAST) -> str:
    """Digests bit by bit from the SHA-1."""
    return f"""
with p as (
  select page_id, strlen(coalesce(html, ''))::bigint as n, sha1(coalesce(html, '')) as hex from pages
), d as (
  select *, list_reduce(list_transform(range(0, 20), lambda i: right(bin(('0x' || hex[2 * i + 1:2 * i + 2])::int + 256), 8)), lambda a, b: a || b) as bits from p
), b as (
  select *, list_reduce(list_transform(range(0, 32), lambda i: '{BASE32}'[1 +
    list_sum(list_transform(range(0, 5), lambda k: bits[5 * i + k + 1]::int * (16 >> k::int)))::int]), lambda a, b: a || b) as digest,
    min(page_id) over (partition by hex) as origin from d
)
select page_id, n as payload_bytes, digest as payload_digest,
  case when n < {least} or page_id = origin then 'response' else 'revisit' end as record_type,
  case when n >= {least} and page_id <> origin then origin end as refers_to, true as complete
from b"""
