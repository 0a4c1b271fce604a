"""WARC archives: written by Spark's text writer, read in parallel with boundary-chain verification.

A file is cut at every line that starts with the magic, wherever a task's range begins.  Each cut that
has a sound header is a candidate: its successor lies behind its header, its content and two line
ends.  A magic inside a payload makes candidates too; what is reachable from the file's first byte is a
record, all else is payload.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stemma.llm.common import materialize, own_path, scratch, table, trimmed

#: Fixed by the format.
CRLF, MAGIC, BLANK = "\r\n", "WARC/1.", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What files are cut at.  It cannot overlap itself, nor stand inside a header block.
CUT = f"\n{MAGIC}"
#: A payload with more than one row in so many is hot; there are fewer hot payloads than that.
HOT_SHARE = 1000


def _field(name: str, value: Column) -> Column:
    """One header line, none for null; line ends cannot enter the header."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A"), F.lit(CRLF)), F.lit(""))


def with_originals(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``pages(page_id, digest, bytes, ...)`` with ``original``: the smallest page_id of equal payloads, null where none.

    Only payloads that stand in several rows are looked up; the table of them is written first, so that
    the planner knows its size.  Hot payloads are broadcast, fewer than ``HOT_SHARE`` whatever the data,
    and their rows are dealt by hash afterwards.
    """
    seen = pages.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
    several = materialize(seen.where("n > 1"), "warc-repeats")
    total = several.agg(F.sum("n")).first()[0] or 0
    hot = several.where(F.col("n") * HOT_SHARE > total).select("digest", F.col("original").alias("hot_original"))
    cold = several.where(F.col("n") * HOT_SHARE <= total).select(F.col("digest").alias("key"), F.col("original").alias("cold_original"))
    rows = pages.join(F.broadcast(hot), "digest", "left")
    rows = rows.withColumn("key", F.when(F.col("hot_original").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id").cast("string"))))
    rows = rows.join(cold, "key", "left")
    return rows.withColumn("original", F.coalesce("hot_original", "cold_original")).drop("key", "hot_original", "cold_original")


def record_texts(pages: DataFrame, date: str, least_bytes: int) -> DataFrame:
    """One ``value`` for each page: header block and content of its record, without the line ends behind it."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha2("html", 256), "bytes": F.octet_length("html")})
    rows = with_originals(rows, least_bytes)
    revisit = F.coalesce((F.col("bytes") >= least_bytes) & F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.lit(False))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(BLANK))
    content = F.when(revisit, http).otherwise(F.concat(http, "html"))
    return rows.select(
        F.concat(
            F.lit(f"{MAGIC}1{CRLF}"),
            _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            _field("WARC-Record-ID", name),
            _field("WARC-Date", F.lit(date)),
            _field("WARC-Target-URI", F.col("url")),
            _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
            _field("WARC-Profile", F.when(revisit, PROFILE)),
            _field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("original").cast("string"), F.lit(">")))),
            _field("Content-Type", F.lit("application/http;msgtype=response")),
            _field("Content-Length", F.octet_length(content).cast("string")),
            F.lit(CRLF),
            content,
        ).alias("value")
    )


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", least_bytes: int = 100) -> None:
    """``pages(page_id, url, html)`` as WARC 1.1 files below ``path``: one record each.

    Of pages with equal payloads of at least ``least_bytes`` bytes that with the smallest page_id is a
    ``response``; the others are ``revisit`` records, which hold the HTTP header but not the payload,
    and name the response.  Equal pages that share the smallest page_id are all responses; a page
    without page_id revisits one that has a page_id, and is a response where there is none.  A null
    html is an empty payload; a null url gives no WARC-Target-URI; other columns are not read; an empty
    table gives files without records.  Spark's text writer puts two line ends behind each value,
    which is how a record ends.
    """
    with scratch(pages.sparkSession):
        record_texts(pages, date, least_bytes).write.option("lineSep", BLANK).text(path)


def _header(lines: list[bytes]) -> dict[str, str]:
    """Fields of a header block by lower-case name; lines that start with white space continue the one before."""
    fields: dict[str, str] = {}
    last = None
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in " \t" and last:
            fields[last] += " " + text.strip()
        elif ":" in text:
            last, value = text.split(":", 1)
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


VERSION = re.compile(rb"(?:WARC/1\.)?\d+\r\n")
SEGMENT = pa.schema(
    [
        ("path", pa.string()), ("size", pa.int64()), ("block", pa.int64()), ("rel", pa.int64()), ("length", pa.int64()),
        ("delta", pa.int64()), ("jump", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
        ("refers_to", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("whole", pa.bool_()), ("data", pa.binary()),
    ]
)
SEGMENT_KIND = (
    "path string, size bigint, block bigint, rel bigint, length bigint, delta bigint, jump bigint, type string, record_id string, target_uri string, "
    "refers_to string, digest string, payload_bytes bigint, payload_digest string, whole boolean, data binary"
)


def payload_of(fields: dict[str, str], content: bytes) -> tuple[int | None, bytes]:
    """(length that the HTTP header states, payload): of HTTP messages what follows their header, else all of the content."""
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return None, content
    head, _, body = content.partition(b"\r\n\r\n")
    stated = _header(head.split(b"\r\n")[1:]).get("content-length", "")
    return (int(stated) if stated.isdecimal() else None), body


def described(fields: dict[str, str], content: bytes | None) -> dict:
    """The columns of a record; without its content those that only the header gives."""
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest")
    found = {"type": kind, "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"), "digest": digest}
    if content is not None:
        stated, body = payload_of(fields, content)
        if kind == "revisit":  # the payload is with the record that it refers to
            found |= {"payload_bytes": stated, "payload_digest": (digest or "").rpartition(":")[2].lower() or None}
        else:
            found |= {"payload_bytes": len(body), "payload_digest": hashlib.sha256(body).hexdigest()}
    return found


def candidate(data: bytes, first: bool) -> tuple[dict[str, str], int, int] | None:
    """(fields, offset of the content, its length) of a segment that starts with a sound header, else None.

    The segment starts behind ``CUT``; the first of a file starts with its own bytes.
    """
    if not VERSION.match(data) or data.startswith(b"WARC/") != first:
        return None
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = _header(data[:end].split(b"\r\n")[1:])
    length = fields.get("content-length", "")
    return (fields, end + 4, int(length)) if length.isascii() and length.isdecimal() else None


def jumps(starts: list[int], nexts: list[int]) -> list[int]:
    """Where the chain from each start first leaves the starts; nexts are larger than their starts, starts ascend."""
    known: dict[int, int] = {}
    for start, after in zip(reversed(starts), reversed(nexts), strict=True):
        known[start] = known.get(after, after)
    return [known[s] for s in starts]


def _segments(lines: DataFrame, with_data: bool) -> DataFrame:
    """One row for each cut of the files; ``rel`` counts from the first segment that the task's range holds.

    Behind the segments of a range come rows of length 0 with the ``jump`` of each of its candidates.
    """

    def leaps(now: tuple | None, starts: list[int], nexts: list[int]) -> Iterator[pa.RecordBatch]:
        if starts:
            rows = [{"path": now[0], "block": now[1], "rel": s, "length": 0, "jump": to} for s, to in zip(starts, jumps(starts, nexts), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=SEGMENT)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, starts, nexts = None, 0, [], []
        for batch in batches:
            rows = []
            for data, path, size, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (path, block) != now:
                    yield from leaps(now, starts, nexts)
                    now, at, starts, nexts = (path, block), 0, [], []
                first = block == 0 and at == 0
                row = {"path": path, "size": size, "block": block, "rel": at if first else at - len(MAGIC), "length": len(data) + len(CUT), "whole": False}
                if found := candidate(data, first):
                    fields, begin, length = found
                    row["delta"] = begin + length + 4 + (0 if first else len(MAGIC))
                    row["whole"] = len(data) >= begin + length
                    row |= described(fields, data[begin : begin + length] if row["whole"] else None)
                    starts.append(row["rel"])
                    nexts.append(row["rel"] + row["delta"])
                if with_data:
                    row["data"] = data
                rows.append(row)
                at += row["length"]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=SEGMENT)
        yield from leaps(now, starts, nexts)

    return lines.mapInArrow(trimmed(scan), SEGMENT_KIND)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", CUT).text(path)
    return text.select(F.col("value").cast("binary"), F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.col("_metadata.file_block_start"))


def reachable(segments: DataFrame) -> DataFrame:
    """``segments`` with ``at``, their absolute offset, and ``record``, the offset of the record that each lies in.

    A task's range knows where its chains leave it (``jump``).  So only the offsets that some chain
    enters a range at are nodes of the table that is squared: in each round the reached nodes add
    where their jumps lead, and jumps are put behind one another, so that a file in r ranges takes
    log2(r) rounds.  A chain enters a range once; from there its records are followed inside.
    """
    order = Window.partitionBy("path").orderBy("block")
    ranges = segments.groupBy("path", "block").agg(F.sum("length").alias("held"))
    ranges = ranges.withColumn("base", F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranges = materialize(ranges, "warc-ranges")
    rows = segments.join(ranges.select("path", "block", "base"), ["path", "block"]).withColumn("at", F.col("base") + F.col("rel"))
    placed = rows.where("length > 0").drop("jump")
    nodes = rows.where("length = 0").select("path", "block", "at", (F.col("base") + F.col("jump")).alias("to"))
    start = ranges.select("path", F.lit(0).cast("bigint").alias("at")).distinct()
    entries = nodes.select("path", F.col("to").alias("at")).unionAll(start).distinct()
    hops = materialize(nodes.join(entries, ["path", "at"]), "warc-entries")
    reached, leap = start, hops.select("path", "at", "to")
    most = ranges.groupBy("path").count().agg(F.max("count")).first()[0] or 1
    for _ in range((most - 1).bit_length()):
        further = reached.join(leap, ["path", "at"]).select("path", F.col("to").alias("at"))
        reached = materialize(reached.unionAll(further).distinct(), "warc-reached")
        second = leap.select("path", F.col("at").alias("to"), F.col("to").alias("then"))
        leap = materialize(leap.join(second, ["path", "to"]).select("path", "at", F.col("then").alias("to")), "warc-leaps")
    entered = hops.join(reached, ["path", "at"]).select("path", "block", F.col("at").alias("entry"))

    def follow(held: pa.Table) -> pa.Table:
        held = held.sort_by("at")
        at, delta, entry = (held.column(c).to_pylist() for c in ("at", "delta", "entry"))
        due, record, records = entry[0] if at else None, None, []
        for a, d in zip(at, delta, strict=True):
            if due is not None and a == due and d is not None:
                record, due = a, a + d
            records.append(record)
        return held.append_column("record", pa.array(records, pa.int64())).select(["path", "block", "at", "record"])

    walked = placed.select("path", "block", "at", "delta").join(entered, ["path", "block"], "left")
    walked = walked.groupBy("path", "block").applyInArrow(follow, "path string, block bigint, at bigint, record bigint")
    walked = materialize(walked, "warc-chain")
    # what lies before a range's first record belongs to the last record of the ranges before
    last = walked.groupBy("path", "block").agg(F.max("record").alias("last"))
    carried = last.withColumn("carried", F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    owned = walked.join(carried.select("path", "block", "carried"), ["path", "block"])
    owned = owned.select("path", "at", F.coalesce("record", "carried").alias("record"))
    return placed.join(owned, ["path", "at"])


RECORD = ["path", "at", "type", "record_id", "target_uri", "refers_to", "digest", "payload_bytes", "payload_digest"]


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the WARC files below ``path`` (plain, WARC 1.x), files and ranges of files in parallel.

    Columns: path, at (the record's offset in its file), type, record_id, target_uri, refers_to, digest
    (as the header states it), payload_bytes and payload_digest (SHA-256, hexadecimal), with
    ``payloads`` also payload.  A payload that holds the magic, whole records even, is put together from
    its segments.  Of a revisit, payload_bytes and payload_digest are those that its headers state and
    the payload is empty.  A file whose chain of records does not end with its last byte raises
    ValueError: no record is left out silently.  Files without bytes have no records.
    """
    out = pa.schema([SEGMENT.field(c) if c != "at" else pa.field(c, pa.int64()) for c in RECORD] + ([pa.field("payload", pa.binary())] if payloads else []))
    kind = ", ".join(f"{f.name} {'bigint' if f.type == pa.int64() else 'binary' if f.type == pa.binary() else 'string'}" for f in out)
    with scratch(spark):
        found = materialize(_segments(_lines(spark, path), payloads), "warc-segments")
        owned = materialize(reachable(found), "warc-owned")
        heads = owned.where(F.col("at") == F.col("record"))
        ends = heads.groupBy("path").agg(F.max(F.col("at") + F.col("delta")).alias("end"))
        bad = owned.groupBy("path").agg(F.max("size").alias("size")).join(ends, "path", "left").where("end IS NULL OR end <> size").limit(5).collect()
        if bad:
            raise ValueError(f"records do not follow one another to the end of {', '.join(f'{r.path} (to {r.end} of {r.size})' for r in bad)}")
        if not payloads:
            if heads.where("NOT whole").isEmpty():
                return materialize(heads.select(*RECORD), "warc-records", outlive=1)
            # some payload holds the magic: its bytes are needed
            owned = materialize(reachable(materialize(_segments(_lines(spark, path), True), "warc-segments")), "warc-owned")
            heads = owned.where(F.col("at") == F.col("record"))

        def record(data: bytes, path: str, at: int) -> dict:
            fields, begin, length = candidate(data, at == 0)
            content = data[begin : begin + length]
            body = b"" if fields.get("warc-type") == "revisit" else payload_of(fields, content)[1]
            return described(fields, content) | {"path": path, "at": at} | ({"payload": body} if payloads else {})

        def join(held: pa.Table) -> pa.Table:
            held = held.sort_by("at")
            row = record(CUT.encode().join(held.column("data").to_pylist()), held.column("path")[0].as_py(), held.column("record")[0].as_py())
            return pa.Table.from_pylist([row], schema=out)

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [record(*r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
                yield pa.RecordBatch.from_pylist(rows, schema=out)

        broken = owned.join(heads.where("NOT whole").select("path", "record"), ["path", "record"])
        joined = broken.select("path", "record", "at", "data").groupBy("path", "record").applyInArrow(join, kind)
        whole = heads.where("whole")
        whole = whole.select("data", "path", "at").mapInArrow(alone, kind) if payloads else whole.select(*RECORD)
        return materialize(whole.unionAll(joined), "warc-records", outlive=1)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives in the shared folder and read back.

    payload_bytes and payload_digest come from the archives: of responses from the payload itself, of
    revisits from their headers.
    """
    path = own_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    number = r"<urn:page:(-?\d*)>"
    rows = read_warc(spark, path)
    return rows.select(
        F.regexp_extract("record_id", number, 1).try_cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.regexp_extract("refers_to", number, 1).try_cast("bigint").alias("refers_to"),
    )


OP11_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), s AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS original FROM p
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM s
"""
