"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

Words are runs of bytes other than \\x00-\\x2F, \\x3A-\\x60 and \\x7B-\\x7F after lower-casing A-Z. A window is N
consecutive words of an item; an item of fewer words is one window. Every hash hit is verified word by word. A document
word inside any occurrence of a window is hit.

The hash set is broadcast while the benchmark has at most MOST_WORDS words (a checked bound); beyond it the items are
dealt into blocks under the bound, each block scans all documents, and the blocks' hits are joined by row.

Null, empty and word-less texts have no words and no hits; items of that kind have no window. Repeated items count each
by its item_id (a repeated item_id once); items without an item_id hit words like any other, count as one item together and have no
name. Other columns of the documents are left as they are.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, extended_schema, lean, masked, replaced, saved, slices, values

N = 10
MOST_WORDS = 4_000_000
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_M = np.uint64(0x9E3779B97F4A7C15)
_ROW, _HIT = "__hourloom_row", "__hourloom_hit"
_HITS = "n_words bigint, hit_lo array<int>, hit_hi array<int>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def _rolled(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of `width` ids, by doubling."""
    if len(ids) < width:
        return np.empty(0, np.uint64)
    out, done, power, piece, span = None, 0, _M, ids.astype(np.uint64) + np.uint64(2), 1
    left = width
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                part = piece[done : done + len(ids) - width + 1]
                out = part.copy() if out is None else out * power + part
                done += span
            left >>= 1
            if left:
                piece = piece[:-span] * power + piece[span:]
                power, span = power * power, 2 * span
        return out ^ (out >> np.uint64(31))


class WindowIndex:
    """The windows of some items, for scanning texts."""

    def __init__(self, items: list[tuple[str, str]], n: int = N):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for item, text in items:
            words = words_of(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            width = min(n, len(ids))
            if width:
                for at, h in enumerate(_rolled(np.array(ids), width)):
                    self.windows[width][int(h)].append((item, ids[at : at + width]))
        self.widths = {}
        for width, found in self.windows.items():
            bits = np.zeros(1 << 16, bool)
            bits[(np.array([*found], np.uint64) >> np.uint64(48)).astype(np.int64)] = True
            self.widths[width] = (bits, dict(found))
        del self.windows

    def scan(self, text: str | None) -> tuple[int, list[int], list[int], list[str]]:
        """Number of words, starts and ends (exclusive) of hit runs in words, items that occur."""
        words = words_of(text)
        ids = np.array([self.vocabulary.get(w, -1) for w in words], dtype=np.int64)
        cover, items = None, set()
        for width, (bits, found) in self.widths.items():
            h = _rolled(ids, width)
            for at in np.flatnonzero(bits[(h >> np.uint64(48)).astype(np.int64)]):
                for item, window in found.get(int(h[at]), ()):
                    if ids[at : at + width].tolist() == window:
                        cover = np.zeros(len(words) + 1, np.int64) if cover is None else cover
                        cover[at] += 1
                        cover[at + width] -= 1
                        items.add(item)
        if cover is None:
            return len(words), [], [], []
        on = np.r_[0, (np.cumsum(cover) > 0).astype(np.int8), 0]
        step = np.diff(on)
        return len(words), np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), sorted(items, key=lambda x: (x is None, x))


def _scanned(docs: DataFrame, index) -> DataFrame:
    @lean
    def run(batches):
        for batch in slices(batches):
            got = [index.value.scan(t) for t in values(batch, "text")]
            yield extended(batch, {"n_words": ([x[0] for x in got], pa.int64()), "hit_lo": ([x[1] for x in got], pa.list_(pa.int32())), "hit_hi": ([x[2] for x in got], pa.list_(pa.int32())), "items": ([x[3] for x in got], pa.list_(pa.string()))})

    return docs.mapInArrow(run, extended_schema(docs, _HITS))


def _blocks(benchmark: DataFrame, most_words: int) -> tuple[DataFrame, int]:
    """The benchmark's items and texts, and the number of blocks that they need."""
    bench = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    return bench, -(-size // (2 * most_words)) or 1  # a word has two characters at least, with its separator


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, n: int = N, most_words: int = MOST_WORDS) -> DataFrame:
    """docs with n_words, hit_lo, hit_hi (hit runs of words, may touch or overlap between blocks) and items; older columns
    of these names give way."""
    spark = docs.sparkSession
    bench, blocks = _blocks(benchmark, most_words)
    if blocks == 1:
        return _scanned(docs, spark.sparkContext.broadcast(WindowIndex([(r.item, r.text) for r in bench.collect()], n)))
    rows = saved(docs.withColumn("_row", F.monotonically_increasing_id()))
    parts = []
    for k in range(blocks):
        block = bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        index = spark.sparkContext.broadcast(WindowIndex([(r.item, r.text) for r in block], n))
        parts.append(saved(_scanned(rows.select("_row", "text"), index).drop("text")))
    met = reduce(DataFrame.union, parts).groupBy("_row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hit_lo")).alias("hit_lo"), F.flatten(F.collect_list("hit_hi")).alias("hit_hi"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return rows.join(met, "_row").drop("_row")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, most_words: int = MOST_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""

    def run(batches):
        for batch in slices(batches):
            lo, hi, items = (values(batch, c) for c in ("hit_lo", "hit_hi", "items"))
            hit = []
            for a, b in zip(lo, hi, strict=True):
                total, end = 0, 0
                for x, y in sorted(zip(a, b, strict=True)):
                    total += max(0, y - max(x, end))
                    end = max(end, y)
                hit.append(total)
            yield extended(batch.select(["doc_id", "n_words"]), {"n_hit": (hit, pa.int64()), "n_items": ([len(x) for x in items], pa.int64()), "items_sha256": ([hashlib.sha256(",".join(sorted(i for i in x if i is not None)).encode()).hexdigest() for x in items], pa.string()), "contaminated": ([x > 0 for x in hit], pa.bool_())})

    kind = dict(docs.dtypes)["doc_id"]
    return scan_benchmark(docs.select("doc_id", "text"), benchmark, n, most_words).mapInArrow(run, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", n: int = N, most_words: int = MOST_WORDS) -> DataFrame:
    """docs without contaminated documents (mode documents), or with the hit words cut out of their texts (spans). All
    columns are kept as they are, whatever their names."""
    bench, blocks = _blocks(benchmark, most_words)
    if blocks == 1:
        index = docs.sparkSession.sparkContext.broadcast(WindowIndex([(r.item, r.text) for r in bench.collect()], n))
        rows, found = docs, lambda batch: [index.value.scan(t)[1:3] for t in values(batch, "text")]
    else:  # hits join by row, in one column of a name that documents don't have
        keyed = saved(docs.withColumn(_ROW, F.monotonically_increasing_id()))
        hits = scan_benchmark(keyed.select(_ROW, "text"), benchmark, n, most_words).select(_ROW, F.struct("hit_lo", "hit_hi").alias(_HIT))
        rows, found = keyed.join(hits, _ROW).select(*docs.columns, _HIT), lambda batch: [(x["hit_lo"], x["hit_hi"]) for x in values(batch, _HIT)]
    names = docs.columns

    @lean
    def run(batches):
        for batch in slices(batches):
            hits, batch = found(batch), batch.select(names)
            if mode == "documents":
                yield masked(batch, [not lo for lo, _ in hits])
                continue
            out = []
            for text, (lo, hi) in zip(values(batch, "text"), hits, strict=True):
                if lo:
                    raw = text.encode("utf-8", "surrogatepass")
                    plain, at, spans = raw.translate(_TABLE), 0, []
                    for w in plain.split():
                        at = plain.index(w, at)
                        spans.append((at, at := at + len(w)))
                    keep, pos = [], 0
                    for a, b in sorted(zip(lo, hi, strict=True)):
                        keep.append(raw[pos : max(pos, spans[a][0])])
                        pos = max(pos, spans[b - 1][1])
                    text = b"".join([*keep, raw[pos:]]).decode("utf-8", "surrogatepass")
                out.append(text)
            yield replaced(batch, {"text": out})

    return rows.mapInArrow(run, docs.schema)
