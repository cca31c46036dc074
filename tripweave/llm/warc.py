"""WARC archives of pages: a deduplicating writer and a reader that salvages.

``write_archives`` renders one record per row with built-in functions and writes the records
as they stand through Spark's text sink, whose line separator is the blank line that ends a
record. So the archives go to any file system that Spark writes to, under its commit
protocol, and a task that runs twice leaves one copy. Of equal payloads the row with the
largest id becomes a response and the others revisit it. Only ids and digests are shuffled.

``read_archives`` checks every gzip member, record header, length and digest. After a failed
check it looks for the next member or version line, recovers the records behind it and
reports the bytes in between as gaps. The same goes for the inflated bytes of a member; what a
damaged one yields before its error counts if a digest confirms it. The reason of a gap inside
a member names the inflated bytes.

Defined results: a null payload is empty; null ids have empty record names and revisit like
others but are no keeper unless all ids of the payload are null; rows of the keeper's id and
payload are all responses; a null or empty url leaves its header out; control characters in
it are percent-encoded; further columns are ignored; an empty table gives no record.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm.frames import saved

END = "\r\n\r\n"
#: Keepers that may be sent to all executors: at some 60 bytes each, 30 MB.
MOST_BROADCAST = 500_000
#: Bytes of a record, and how many records of that size or more share an archive: the reader holds
#: an archive in a task, so one has some 64 MB at most, or a single record.
SIZES = ((0, 2_000), (32 << 10, 64), (1 << 20, 1))
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compressed bytes that are inflated at a time.
CHUNK = 1 << 16
BASE16 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

READ_SCHEMA = (
    "kind string, archive string, start bigint, end bigint, reason string, record_type string, "
    "record_id string, target_uri string, refers_to string, payload_digest string, "
    "payload_length bigint, payload binary"
)


def base32_of_hex(digest: Column) -> Column:
    """A hexadecimal SHA-1 digest in base 32: five digits make four letters."""
    groups = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), BASE16, BASE32)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _named(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def keepers(digests: DataFrame, least_bytes: int) -> DataFrame:
    """Per payload that occurs more than once, the largest id."""
    return (
        digests.filter(F.col("n_bytes") >= least_bytes)
        .groupBy("digest", "n_bytes")
        .agg(F.max("key").alias("keeper"), F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .drop("n")
    )


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
) -> None:
    """Write all rows as WARC files below ``path``.

    Payloads of fewer than ``least_bytes`` bytes are never replaced by revisits. Keepers are
    joined by broadcast while they are at most ``MOST_BROADCAST``; beyond that the ids that
    revisit are found by a join of digests, and pages are joined with them by id.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"),
        body.alias("payload"), F.octet_length(body).alias("n_bytes"), F.sha1(body).alias("digest"),
    )
    digests = rows.select("key", "n_bytes", "digest")
    kept = saved(keepers(digests, least_bytes), "warc-keepers")
    if kept.count() <= MOST_BROADCAST:
        joined = rows.join(F.broadcast(kept), ["digest", "n_bytes"], "left")
    else:
        again = digests.join(kept, ["digest", "n_bytes"]).distinct().withColumnsRenamed(
            {"key": "k", "digest": "d", "n_bytes": "b"}
        )
        same = F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d"))
        joined = rows.join(again, same, "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("key").eqNullSafe(F.col("keeper"))
    address = F.col("url")
    for code in (*range(32), 127):
        address = F.replace(address, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _named(F.col("key"))),
        _header("WARC-Date", F.lit(DATE)),
        F.when(F.length("url") > 0, _header("WARC-Target-URI", address)).otherwise(F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("digest")))),
        _header("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.sha1(block)))),
        F.when(
            revisit,
            F.concat(
                _header("WARC-Profile", F.lit(PROFILE)),
                _header("WARC-Refers-To", _named(F.col("keeper"))),
            ),
        ).otherwise(F.lit("")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    bytes_of = F.col("n_bytes") + 3 * F.coalesce(F.octet_length("url"), F.lit(0))
    size = F.lit(-1)
    for least, _ in SIZES:
        size = size + (bytes_of >= least).cast("int")
    present = sorted(r[0] for r in rows.select(size.alias("k")).distinct().collect())
    for k in present or [0]:  # mostly one write
        (
            joined.filter(size == k)
            .select(record.alias("value"))
            .write.mode("error" if k == (present or [0])[0] else "append")
            .option("lineSep", END)
            .option("maxRecordsPerFile", SIZES[k][1])
            .text(path)
        )


MAGIC = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
VERSION = re.compile(rb"WARC/1\.[01]\r\n")


def sha1_base32(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(data: bytes, at: int, confirmed: bool = False) -> tuple[dict, int]:
    """The record at a version line and where it ends; raises ``ValueError`` if unsound.

    ``confirmed`` asks for a digest that covers the payload.
    """
    version = VERSION.match(data, at)
    if version is None:
        raise ValueError("no version line")
    fields, place = {}, version.end()
    while (stop := data.find(b"\r\n", place)) != place:
        if stop < 0 or VERSION.match(data, place):
            raise ValueError("header without an end")
        name, colon, value = data[place:stop].decode("utf-8", "replace").partition(":")
        if not colon:
            raise ValueError("header line without a colon")
        fields[name.strip().lower()] = value.strip()
        place = stop + 2
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
        raise ValueError("no content length")
    first = stop + 2
    end = first + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    block = memoryview(data)[first:end]
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != sha1_base32(block):
        raise ValueError("block digest differs")
    payload, length = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        gap = data.find(b"\r\n\r\n", first, end)
        if gap < 0:
            raise ValueError("http header without an end")
        payload = block[gap + 4 - first :]
        size = re.search(rb"(?im)^content-length:\s*(\d{1,18})\r?$", data[first:gap])
        length = int(size[1]) if size else len(payload)
    digest, kind = fields.get("warc-payload-digest", ""), fields.get("warc-type", "")
    if confirmed and not stated.startswith("sha1:"):
        if kind == "revisit" or not digest.startswith("sha1:"):
            raise ValueError("no digest in a damaged member")
    if kind != "revisit":
        found = sha1_base32(payload)
        if digest.startswith("sha1:") and digest[5:] != found:
            raise ValueError("payload digest differs")
        digest, length = "sha1:" + found, len(payload)
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": digest.removeprefix("sha1:") or None,
        "payload_length": length,
        "payload": bytes(payload) if kind != "revisit" else None,
    }, end + 4


def _inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """The bytes in the gzip member at ``at``, where it ends, and what is wrong with it."""
    view, inflate, parts, place = memoryview(data), zlib.decompressobj(31), [], at
    try:
        while not inflate.eof and place < len(data):
            before = inflate.copy()
            parts.append(inflate.decompress(view[place : place + CHUNK]))
            place += CHUNK
    except zlib.error as error:
        reason = f"damaged member: {error}"
        with contextlib.suppress(zlib.error):  # byte by byte, up to the error
            for k in range(place, min(place + CHUNK, len(data))):
                parts.append(before.decompress(view[k : k + 1]))
        return b"".join(parts), len(data), reason
    if not inflate.eof:
        return b"".join(parts), len(data), "member without an end"
    return b"".join(parts), min(place, len(data)) - len(inflate.unused_data), None


def _read_for(data: bytes, at: int, n: int) -> int:
    """Where the bytes end that give the first ``n`` inflated bytes of the member at ``at``."""
    view, inflate, made, place = memoryview(data), zlib.decompressobj(31), 0, at
    while True:
        before, more = inflate.copy(), None
        with contextlib.suppress(zlib.error):
            more = len(inflate.decompress(view[place : place + CHUNK]))
        if more is None or made + more >= n:
            break
        made, place = made + more, place + CHUNK
    while made < n:
        made += len(before.decompress(view[place : place + 1]))
        place += 1
    return place


def _inside(plain: bytes, confirmed: bool) -> Iterator[dict]:
    """Records and gaps of inflated bytes, with their places there."""
    at, lost, reason = 0, None, None
    while at < len(plain):
        try:
            record, end = _record(plain, at, confirmed)
        except ValueError as error:
            if lost is None:
                lost, reason = at, str(error)
            following = VERSION.search(plain, at + 1)
            at = following.start() if following else len(plain)
            continue
        if lost is not None:
            yield {"kind": "gap", "start": lost, "end": at, "reason": reason}
            lost = None
        yield {"kind": "record", "start": at, "end": end} | record
        at = end
    if lost is not None:
        yield {"kind": "gap", "start": lost, "end": len(plain), "reason": reason}


def _member(data: bytes, at: int) -> tuple[list[dict], int, str | None]:
    """Records and gaps of the gzip member at ``at``, where they end, and what is wrong behind.

    Raises ``ValueError`` if a damaged member yields no record.
    """
    plain, end, wrong = _inflated(data, at)
    found = list(_inside(plain, wrong is not None))
    if wrong is not None:
        while found and found[-1]["kind"] == "gap":  # part of the gap behind
            found.pop()
        if not found:
            raise ValueError(wrong)
        end = _read_for(data, at, found[-1]["end"])
    for row in found:
        if row["kind"] == "gap":
            row["reason"] = f"inflated bytes {row['start']} to {row['end']}: {row['reason']}"
        row |= {"start": at, "end": end}
    return found, end, wrong


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of one archive in the order of their bytes."""
    at, lost, reason = 0, None, None
    while at < len(data):
        wrong = None
        try:
            if data.startswith(b"\x1f\x8b", at):
                found, end, wrong = _member(data, at)
            else:
                record, end = _record(data, at)
                found = [{"kind": "record", "start": at, "end": end} | record]
        except ValueError as error:
            if lost is None:
                lost, reason = at, str(error)
            following = MAGIC.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if lost is not None:
            yield {"kind": "gap", "start": lost, "end": at, "reason": reason}
            lost = None
        yield from found
        at = end
        if wrong is not None:
            lost, reason = at, wrong
            following = MAGIC.search(data, at)
            at = following.start() if following else len(data)
    if lost is not None:
        yield {"kind": "gap", "start": lost, "end": len(data), "reason": reason}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in READ_SCHEMA.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in READ_SCHEMA.split(", ")])
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows, held = [], 0
            for row in salvage(content.as_py()):
                rows.append({n: row.get(n) for n in names} | {"archive": path.as_py()})
                held += len(row.get("payload") or b"")
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps (``kind``) of all archives below ``path``, plain or gzip members.

    ``start`` and ``end`` are bytes of the archive; members hold their records and gaps together. An
    archive is read whole, and Spark refuses files of 2 GB and more.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.filter(F.col("length") > 0)
    return files.select("path", "content").mapInArrow(_read, READ_SCHEMA)


def records(read: DataFrame) -> DataFrame:
    return read.filter(F.col("kind") == "record").drop("kind", "reason")


def quarantined(read: DataFrame) -> DataFrame:
    """The byte ranges no record could be recovered from."""
    gaps = read.filter(F.col("kind") == "gap")
    return gaps.select("archive", "start", "end", (F.col("end") - F.col("start")).alias("n_bytes"),
                       "reason")


def id_of(name: Column) -> Column:
    """The number in a record name that ``write_archives`` gave."""
    return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")
