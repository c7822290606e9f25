"""WARC archives: writing with revisit records, reading back by boundary-chain verification.

Writing: of the pages with equal payloads (by SHA-1) that of the largest page_id is a response record, the
others are revisit records that name it. Each task fills archives of about ARCHIVE_BYTES; an archive is a row of a
binary table in the shared folder, so that Spark's commit protocol covers it.

Reading trusts no magic number by itself, since a payload may hold one. A task emits, for every place in an archive that
looks like the head of a record (the magic at the file's start or behind a record's end), the offset of its successor
(head + Content-Length + 4). Archives are split into
segments of SEGMENT bytes; within its segment a task already follows the chain to the first offset beyond (`leap`).
Pointer jumping over the leaps, in Spark, doubles the distance each round from offset 0 of each file; what the chain
reaches is a record, everything else is payload. A broken chain (truncated archive) ends there.

Null html is the empty payload; empty payloads are equal, too. A page_id may be on several rows; each row is decided by its
own payload, and rows of equal page_id and payload are all responses if no larger page_id has the payload. Rows without
page_id are responses that nothing refers to. Very long payloads are whole. Control characters and white space in a url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, slices, values

ARCHIVE_BYTES, SEGMENT = 8 << 20, 1 << 20
MAGIC = b"WARC/1.0\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, size: int, sha: str, payload: bytes, refers_to: int | None) -> bytes:
    target = _UNSAFE.sub(lambda m: quote(m[0]), url) if url else f"urn:page:{page_id}"
    block = _HTTP % size + payload
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Payload-Length: {size}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return MAGIC + "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _archives(archive_bytes: int):
    def run(batches):
        part, n, buffer = TaskContext.get().partitionId(), 0, bytearray()

        def flush():
            nonlocal n
            out = pa.RecordBatch.from_arrays([pa.array([part * (1 << 24) + n], pa.int64()), pa.array([bytes(buffer)], pa.binary())], names=["archive", "data"])
            n += 1
            buffer.clear()
            return out

        for batch in slices(batches):
            for page_id, url, html, code, size, ref in zip(*(values(batch, c) for c in ("page_id", "url", "html", "hex", "size", "refers_to")), strict=True):
                sha = base64.b32encode(bytes.fromhex(code)).decode()
                buffer += record("response" if ref is None else "revisit", page_id, url, size, sha, html.encode("utf-8", "surrogatepass") if ref is None else b"", ref)
                if len(buffer) >= archive_bytes:
                    yield flush()
        if buffer:
            yield flush()

    return run


def write_archives(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The written table of archives: archive, data."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumns({"hex": F.sha1("html"), "size": F.octet_length("html").cast("long")})
    light = saved(pages.select("page_id", "hex", "size"))
    kept = light.where(F.col("size") >= min_bytes).groupBy("hex").agg(F.max("page_id").alias("response"))
    revisits = light.where("page_id is not null").join(kept, "hex").where("page_id <> response").select("page_id", "hex", F.col("response").alias("refers_to")).distinct()
    rows = pages.join(saved(revisits), ["page_id", "hex"], "left").select("page_id", "url", "html", "hex", "size", "refers_to")
    return saved(rows.mapInArrow(_archives(archive_bytes), "archive long, data binary"))


def _head(data: bytes, at: int) -> tuple[dict, int, int] | None:
    """Fields, start of the block and offset of the successor, if a record could begin at `at`."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    fields = {}
    for line in data[at + len(MAGIC) : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    nxt = end + 4 + int(fields[b"content-length"]) + 4
    return (fields, end + 4, nxt) if nxt <= len(data) and data[nxt - 4 : nxt] == b"\r\n\r\n" else None


_FOUND = "archive long, size long, segment long, at long, next long, leap long, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _candidates(segment: int):
    def number(urn: bytes) -> int | None:
        m = re.fullmatch(rb"<urn:page:(-?\d+)>", urn)
        return int(m[1]) if m else None

    def after(data: bytes, at: int) -> int:
        """The next place behind a record's end at which the magic stands: heads do not overlap, so each byte is read once."""
        end = data.find(b"\r\n\r\n" + MAGIC, at)
        return end + 4 if end >= 0 else -1

    def scan(archive: int, data: bytes) -> list[tuple]:
        found, at = [], 0 if data.startswith(MAGIC) else after(data, 0)
        while at >= 0:
            if got := _head(data, at):
                fields, block, nxt = got
                kind = fields[b"warc-type"].decode("ascii", "replace")
                body = data.find(b"\r\n\r\n", block, nxt - 4) + 4
                if kind == "revisit" or body < 4:
                    length = fields.get(b"warc-payload-length", b"")
                    size, sha = int(length) if length.isdigit() else None, fields.get(b"warc-payload-digest", b"").decode("ascii", "replace").removeprefix("sha1:")
                else:
                    payload = data[body : nxt - 4]
                    size, sha = len(payload), digest(payload)
                found.append((archive, len(data), at // segment, at, nxt, number(fields.get(b"warc-record-id", b"")), kind, number(fields.get(b"warc-refers-to", b"")), size, sha))
            at = after(data, at)
        leap: dict[int, int] = {}
        for r in reversed(found):  # a successor in the same segment passes on its own leap
            leap[r[3]] = leap[r[4]] if r[4] // segment == r[2] and r[4] in leap else r[4]
        return [(*r[:5], leap[r[3]], *r[5:]) for r in found]

    def run(batches):
        names = [x.split() for x in _FOUND.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string()}
        for batch in batches:
            for i in range(batch.num_rows):
                rows = scan(batch.column("archive")[i].as_py(), batch.column("data")[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kinds[t]) for j, (_, t) in enumerate(names)], names=[n for n, _ in names])

    return run


def _chain(table: pa.Table) -> pa.Table:
    """The records of a segment that the chain reaches from the offsets at which it enters."""
    rows = table.to_pylist()
    at = {r["at"]: r for r in rows}
    keep = []
    for r in rows:
        if r["entered"]:
            x, seen = r, set()
            while x is not None and x["at"] not in seen:
                seen.add(x["at"])
                keep.append(x)
                x = at.get(x["next"])
    return pa.Table.from_pylist(keep, schema=table.schema).drop_columns(["entered"])


def read_archives(archives: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record on a boundary chain."""
    found = saved(archives.mapInArrow(_candidates(segment), _FOUND))
    leaps = found.select("archive", "at", "leap")
    reached = found.where("at = 0").select("archive", "at")
    while True:
        step = reached.join(leaps, ["archive", "at"]).select("archive", F.col("leap").alias("at"))
        wider = saved(reached.union(step).distinct())
        ahead = leaps.select("archive", F.col("at").alias("leap"), F.col("leap").alias("far"))
        leaps = saved(leaps.join(ahead, ["archive", "leap"], "left").select("archive", "at", F.coalesce("far", "leap").alias("leap"), F.col("far").isNotNull().alias("jumped")))
        reached, more = wider, leaps.where("jumped").limit(1).count()
        leaps = leaps.drop("jumped")
        if not more:
            break
    step = reached.join(leaps, ["archive", "at"]).select("archive", F.col("leap").alias("at"))
    entries = reached.union(step).distinct().withColumn("entered", F.lit(True))
    rows = found.join(entries, ["archive", "at"], "left").withColumn("entered", F.coalesce("entered", F.lit(False))).select(*found.columns, "entered")
    chain = rows.groupBy("archive", "segment").applyInArrow(_chain, _FOUND)
    return chain.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    return read_archives(write_archives(pages, min_bytes))
