"""Mixture-controlled packing into fixed windows by deficit round-robin over source queues.

Every source is a queue of its documents' ids. Without a given mixture its target is its share of all ids, under which all
queues run dry together. A given mixture (source to weight) sets the proportions: windows hold its sources by weight while all
last; when one runs dry, the others share its place by their weights, from the very id on; sources that the mixture does not
name follow, by their shares, when all named ones are dry. A weight gives two ids a window at least, or it is an error. So every id is packed under every mixture. A stretch between two
such moments is packed as follows, and a window that spans two stretches holds the end of one and the start of the next. A window of L ids credits each queue L * share and serves the queues in
turn; what rounding leaves over is the queue's deficit and is carried to the next window. Credits are cumulative
(queue q has been served floor(w * L * upto(q)) - floor(w * L * upto(q - 1)) ids by window w, upto being the cumulative
share), so every window is full, no queue is ever off its target by more than an id, and the deficit at any window is
known without running the windows before it: partitions pack independently and agree across their borders.

Sources with under one id a window share one queue (and join the largest queue if together they stay under one), so
there are at most L + 1 queues whatever the number of sources.

Only the last sequence may be short. A table without `source` is one source; other columns are not read. A null text is empty; each document has the end id at least, so no document is
lost. A null source is a source of its own. Repeated rows are packed as often as they occur; no rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import lean, saved, slices, values
from .tokens import encoder_of, vocabulary

LENGTH, END_ID = 2048, 1
MOST_OFFSETS = 200_000
_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string"


def _tokenised(path: str, end_id: int):
    @lean
    def run(batches):
        encoder, part, served = encoder_of(path), TaskContext.get().partitionId(), {}
        for batch in slices(batches):
            sources = values(batch, "source")
            ids = [np.append(np.frombuffer(x, np.uint32), np.uint32(end_id)) for x in encoder.batch(values(batch, "text"))]
            before = []
            for s, x in zip(sources, ids, strict=True):
                before.append(served.get(s, 0))
                served[s] = before[-1] + len(x)
            small = all(int(x.max()) < 65536 for x in ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int64()), pa.array(values(batch, "doc_id"), pa.int64()), pa.array(sources, pa.string()), pa.array([len(x) for x in ids], pa.int64()), pa.array(before, pa.int64()), pa.array([2 if small else 4] * len(ids), pa.int32()), pa.array([x.astype(np.uint16 if small else np.uint32).tobytes() for x in ids], pa.binary())],
                names=["part", "doc_id", "source", "n", "before", "width", "ids"],
            )

    return run


def _queues(sizes: list[tuple[str | None, int]], total: int, length: int) -> tuple[dict, dict]:
    """Queue of each large source, and (ids of earlier queues, own ids) of each queue; queue 0 is for all other sources."""
    large = sorted(((s, n) for s, n in sizes if n * length >= total), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    rest = total - sum(n for _, n in large)
    merged = bool(large) and rest * length < total
    queue_of = {s: i + (0 if merged else 1) for i, (s, _) in enumerate(large)}
    own = {0: rest} if not merged else {}
    for s, n in large:
        own[queue_of[s]] = own.get(queue_of[s], 0) + n
    if merged:
        own[0] += rest
    spans, upto = {}, 0
    for q in sorted(own):
        spans[q] = (upto, own[q])
        upto += own[q]
    return queue_of, spans


#: Of one queue in one stretch: its first place in the queue, the stretch's first place among all ids, the stretch's
#: length, the ids of earlier queues in the stretch, and the queue's own.
Stretch = tuple[int, int, int, int, int]


def _stretches(mixture: Mapping[str | None, float], sizes: Mapping[str | None, int], length: int) -> tuple[dict[str | None, list[Stretch]], int]:
    """Stretches of each named source until all are dry, and the number of ids in them."""
    if not mixture or any(not w > 0 for w in mixture.values()):
        raise ValueError("a mixture names sources with weights above 0")
    weight = {s: Fraction(w) for s, w in mixture.items()}
    if min(weight.values()) * length < 2 * sum(weight.values()):
        raise ValueError("a weight gives two ids a window at least")
    named = sorted(mixture, key=lambda s: (s is not None, s or ""))
    dry = {s: sizes.get(s, 0) / weight[s] for s in named}
    out: dict[str | None, list[Stretch]] = {s: [] for s in named}
    begin, last = 0, Fraction(0)
    for time in sorted({t for t in dry.values() if t}):
        places = {s: (int(weight[s] * last), int(weight[s] * time)) for s in named if dry[s] >= time}
        total, before = sum(b - a for a, b in places.values()), 0
        for s, (a, b) in places.items():
            if b > a:
                out[s].append((a, begin, total, before, b - a))
                before += b - a
        begin, last = begin + total, time
    return out, begin


def served(w: int, cum: int, total: int, length: int, begin: int = 0) -> int:
    return min(max(w * length - begin, 0), total) * cum // total


def cut(at: int, n: int, before: int, own: int, total: int, length: int, begin: int = 0) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of n ids that begin at place `at` of their queue's stretch."""
    def credit(w):
        low = served(w, before, total, length, begin)
        return served(w, before + own, total, length, begin) - low, low

    w = (begin + at * total // own) // length
    while w and credit(w)[0] > at:
        w -= 1
    (a, low), (b, high) = credit(w), credit(w + 1)
    out, pos, end = [], at, at + n
    while pos < end:
        if b > pos:
            stop = min(b, end)
            out.append((pos - at, stop - pos, w, max(begin - w * length, 0) + high - low + pos - a))
            pos = stop
        if pos < end:
            w += 1
            a, low = b, high
            b, high = credit(w + 1)
    return out


def pieces(at: int, n: int, stretches: list[Stretch], length: int) -> list[tuple[int, int, int, int]]:
    """The same over all stretches of the queue."""
    out = []
    for place, begin, total, before, own in stretches:
        low, high = max(at, place), min(at + n, place + own)
        if low < high:
            out += [(low - at + start, *rest) for start, *rest in cut(low - place, high - low, before, own, total, length, begin)]
    return out


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID, mixture: Mapping[str | None, float] | None = None) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source. `mixture`: target weights."""
    spark = docs.sparkSession
    path = path or vocabulary("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("source") if "source" in docs.columns else F.lit(None)).cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    ids = saved(rows.mapInArrow(_tokenised(path, end_id), "part long, doc_id long, source string, n long, before long, width int, ids binary"))
    sums = saved(ids.groupBy("part", "source").agg(F.sum("n").alias("n")))
    total = sums.agg(F.sum("n")).first()[0] or 0
    by_source, named = sums.groupBy("source").agg(F.sum("n").alias("n")), {}
    begin = 0
    if mixture is not None:
        wanted = spark.createDataFrame([(s,) for s in mixture], "s string")
        met = by_source.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("s")))
        named, begin = _stretches(mixture, {r.source: r.n for r in met.collect()}, length)  # a row per named source
        by_source = by_source.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("s")), "left_anti")
    rest = total - begin
    sizes = [(r.source, r.n) for r in by_source.where(F.col("n") * length >= rest).collect()]  # at most `length` of them
    queue_of, shares = _queues(sizes, rest, length)
    spans = {q: [(0, begin, rest, before, own)] for q, (before, own) in shares.items() if own}
    for q, (s, stretches) in enumerate(named.items(), max(shares) + 1):
        queue_of[s], spans[q] = q, stretches
    queues = spark.createDataFrame([(s, q) for s, q in queue_of.items()] or [(None, 0)], "source string, queue int")
    placed = saved(sums.join(F.broadcast(queues), sums.source.eqNullSafe(queues.source), "left").select("part", sums.source, "n", F.coalesce("queue", F.lit(0)).alias("queue")))
    parts = placed.groupBy("queue", "part").agg(F.sum("n").alias("n")).withColumn("skip", F.coalesce(F.sum("n").over(Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inner = placed.withColumn("inner", F.coalesce(F.sum("n").over(Window.partitionBy("queue", "part").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = saved(inner.join(parts, ["queue", "part"]).select(F.col("part").alias("p"), F.col("source").alias("s"), "queue", (F.col("skip") + F.col("inner")).alias("skip")))
    few = offsets.count() <= MOST_OFFSETS
    shared = spark.sparkContext.broadcast(spans)

    @lean
    def run(batches):
        spans = shared.value
        for batch in slices(batches):
            out = []
            for doc, source, n, before, width, blob, queue, skip in zip(*(values(batch, c) for c in ("doc_id", "source", "n", "before", "width", "ids", "queue", "skip")), strict=True):
                x = np.frombuffer(blob, np.uint16 if width == 2 else np.uint32).astype("<u4")
                for start, size, w, offset in pieces(skip + before, n, spans[queue], length):
                    out.append((doc, start, size, zlib.crc32(x[start : start + size].tobytes()), n, w, offset, source))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate([pa.int64()] * 7 + [pa.string()])], names=[x.split()[0] for x in _PIECE.split(", ")])

    met = ids.join(F.broadcast(offsets) if few else offsets, (ids.part == F.col("p")) & ids.source.eqNullSafe(F.col("s")))
    return met.select("doc_id", "source", "n", "before", "width", "ids", "queue", "skip").mapInArrow(run, _PIECE)
