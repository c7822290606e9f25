"""N-gram Jaccard self-join by prefix filters under several global token orders.

A document's set holds its distinct word 5-shingles. Two sets whose Jaccard similarity is at least t share a token among
the first n - ceil(t * n) + 1 of each, under *any* order of all tokens. So candidates must share one under every order:

* The first order puts frequent tokens last (by a sketch of document frequencies over all rows), the rest by hash. Its
  prefix tokens travel to their token range as packed blobs, where each range builds its posting lists. A list names its
  members by its pivot, the member of the smallest hash; what shares a pivot is a group, so a pair that shares a token
  meets in a group, and near copies, which share many lists, meet in few.
* Groups are first screened by sizes and parity bitmaps of about a bit per token (a lower bound of the symmetric
  difference). Members without a partner leave; the others fall into parts that candidates connect.
* Under the further orders (hash orders) every class left has a short signature: 16 bits of each token of a prefix that is
  longer by least_shared - 1 tokens, so that linked sets share least_shared of them. Pairs that share fewer under one of
  the orders are no candidates; again members without a partner leave and parts split.
* From then on a pair is looked at in one group alone, that of the smallest pivot which both share.
* Only then sets move, once per part, and its candidates are intersected exactly. Every link is counted; a part writes a count per member and the links that join two components,
  fewer than it has members, but never a list of pairs.

Equal sets are one class from the start, so copies never meet as pairs; a class counts in links by the rows it stands for. A
group of more than BLOCK members, or BLOCK_TOKENS tokens, is dealt into blocks, and each two blocks meet once. Where only
components are asked for (`counts=False`), pairs of one component are not looked at: each block has the pivot, and members
that their block leaves outside the pivot's component are then held against all other members, in blocks again. Tokens of
over HOT documents are dealt by document, and only their pivots come together.

Nulls, empty texts and texts without words have the empty set and link with nothing. A text of fewer than five words is
one shingle; very long texts are read whole. Rows without doc_id take no part in links (component null). Repeated rows and
ties give equal components; columns besides id and text don't matter. No rows give no rows. Classes are named by 128-bit
hashes of their sets, shingles by 64-bit ones.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordIds, connected, lean, mixed, pylists, record_batch, saved

SKETCH_BITS, SEGMENTS = 22, 64
ORDERS = (1, 2)
RANGE_ENTRIES, LEAST_RANGES = 256_000, 64
BLOCK, BLOCK_TOKENS = 1024, 2_000_000
HOT = 100_000
BLOOM_BITS = (20, 28)  # of the filter of documents whose sets are needed: at least, at most
_M = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, ids: WordIds, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles. Words split at ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.array(list(map(ids.__getitem__, words)), dtype=np.uint64)
    if len(w) < k:
        return np.array([xxhash.xxh64_intdigest(w.tobytes(), seed=len(w))], dtype=np.uint64)
    h = w[: len(w) - k + 1].copy()
    for i in range(1, k):
        h = h * _M + w[i : len(w) - k + 1 + i]
    return np.unique(mixed(h))


def fingerprint(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def short(fp: bytes) -> int:
    """The 64 bits by which postings name a class; classes that share them are told apart by the rest later on."""
    return int.from_bytes(fp[:8], "little", signed=True)


def prefix_length(n, num: int, den: int):
    """For J >= num/den: n - ceil(num * n / den) + 1."""
    return n - -(-num * n // den) + 1


def least_shared(n, num: int, den: int):
    """Tokens that the longer prefixes of the further orders must share: about a sixteenth of the set."""
    return np.minimum(1 + n // 16, -(-num * n // den))


def signature(s: np.ndarray, salt: int, num: int, den: int) -> np.ndarray:
    """16 bits of each token of the prefix under the hash order `salt`, long enough that linked sets share least_shared."""
    h, p = mixed(s, salt), prefix_length(len(s), num, den) + int(least_shared(len(s), num, den)) - 1
    return ((h if p >= len(h) else np.partition(h, p - 1)[:p]) & np.uint64(0xFFFF)).astype(np.uint16)


def parity_bitmap(s: np.ndarray) -> bytes:
    """Parity of the number of tokens in each of about len(s) bins (a power of two): two bitmaps differ in at most
    |x - y| + |y - x| bits, and so do the halves of one, laid over each other, and one of half its size."""
    bits = max(64, 1 << (len(s) - 1).bit_length())
    at = (mixed(s, 7) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _signs(s: np.ndarray, num: int, den: int) -> bytes:
    return b"".join(signature(s, o, num, den).tobytes() for o in ORDERS)


def _profile(k: int):
    @lean
    def run(batches):
        ids, seen, size = WordIds(), set(), 1 << SKETCH_BITS
        sketch, wait, n_wait = np.zeros(size, np.uint8), [], 0

        def pour():
            if wait:
                at, n = np.unique(np.concatenate(wait), return_counts=True)
                sketch[at] = np.minimum(sketch[at] + n, 255)
                wait.clear()

        for rows in pylists(batches, "doc_id", "text"):
            out = []
            for doc, text in rows:
                s = shingle_set(text, ids, k)
                fp = fingerprint(s) if len(s) else None
                new = fp is not None and doc is not None and fp not in seen
                out.append((doc, len(s), fp, parity_bitmap(s) if new else None))
                if new:
                    seen.add(fp)
                    wait.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                    n_wait += len(s)
                    if n_wait > 500_000:
                        pour()
                        n_wait = 0
            yield record_batch({"doc_id": ([x[0] for x in out], pa.int64()), "n": ([x[1] for x in out], pa.int64()), "fp": ([x[2] for x in out], pa.binary()), "key": ([x[2] and short(x[2]) for x in out], pa.int64()), "segment": ([None] * len(out), pa.int32()), "salt": ([None] * len(out), pa.int32()), "blob": ([x[3] for x in out], pa.binary())})
        pour()
        if seen:
            parts, none, salt = [zlib.compress(x.astype(np.uint32).tobytes(), 1) for x in np.split(sketch, SEGMENTS)], [None] * SEGMENTS, TaskContext.get().partitionId() % 64
            yield record_batch({"doc_id": (none, pa.int64()), "n": (none, pa.int64()), "fp": (none, pa.binary()), "key": (none, pa.int64()), "segment": (list(range(SEGMENTS)), pa.int32()), "salt": ([salt] * SEGMENTS, pa.int32()), "blob": (parts, pa.binary())})

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of some tasks' counts of a segment."""
    total = 0
    for blob in table.column("blob"):
        total = total + np.frombuffer(zlib.decompress(blob.as_py()), np.uint32).astype(np.int64)
    return pa.table({"segment": table.column("segment").slice(0, 1), "blob": pa.array([zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)], pa.binary())})


def _code(count):
    """Half steps of the logarithm of a count."""
    return np.minimum(np.floor(2 * np.log2(1 + count)), 255)


def _levels(segments: DataFrame) -> np.ndarray:
    """The codes of the sketch's counts; pieces of tasks are added in two steps, so no group grows with all tasks."""
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    width = len(levels) // SEGMENTS
    some = segments.groupBy("segment", "salt").applyInArrow(_added, "segment int, blob binary")
    for r in some.groupBy("segment").applyInArrow(_added, "segment int, blob binary").toLocalIterator():
        levels[r.segment * width : (r.segment + 1) * width] = _code(np.frombuffer(zlib.decompress(r.blob), np.uint32).astype(np.int64))
    return levels


def _prefixes(k: int, num: int, den: int, levels, range_bits: int, hot: int):
    """Postings of the first order's prefixes, packed by token range; those of hot tokens by class, in parts below 0."""

    @lean
    def run(batches):
        ids, seen, wait, n_wait = WordIds(), set(), [], 0
        n_parts = 1 << range_bits

        def pour():
            tok, key, warm = (np.concatenate(x) for x in zip(*wait, strict=True))
            wait.clear()
            part = np.where(warm, (tok >> np.uint64(64 - range_bits)).astype(np.int64), -1 - key % n_parts)
            o = np.lexsort((tok, part))
            tok, key, part = tok[o], key[o], part[o]
            at = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
            own = ((tok << np.uint64(range_bits)) >> np.uint64(32)).astype(np.uint32)  # a clash only makes a candidate
            blobs = [(own if part[i] >= 0 else tok)[i:j].tobytes() + key[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
            return record_batch({"part": (part[at[:-1]], pa.int64()), "blob": (blobs, pa.binary())})

        for rows in pylists(batches, "doc_id", "text"):
            for doc, text in rows:
                if doc is None:
                    continue
                s = shingle_set(text, ids, k)
                if not len(s) or (fp := fingerprint(s)) in seen:
                    continue
                seen.add(fp)
                p = prefix_length(len(s), num, den)
                level = levels.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                at = np.lexsort((mixed(s), level))[:p]
                wait.append((s[at], np.full(p, short(fp), np.int64), level[at] < hot))
                n_wait += p
            if n_wait > 1_000_000:
                yield pour()
                n_wait = 0
        if wait:
            yield pour()

    return run


def _lists(table: pa.Table) -> pa.Table:
    """The groups of a token range: each member of a posting list with the list's pivot, every pair once. Postings of hot
    tokens are unpacked."""
    width = 4 if table.column("part")[0].as_py() >= 0 else 8
    toks, keys = [], []
    for blob in table.column("blob"):
        blob = blob.as_py()
        m = len(blob) // (width + 8)
        toks.append(np.frombuffer(blob, f"<u{width}", m))
        keys.append(np.frombuffer(blob, np.int64, m, width * m))
    tok, key = np.concatenate(toks), np.concatenate(keys)
    o = np.lexsort((key, tok))
    tok, key = tok[o], key[o]
    keep = np.r_[True, (tok[1:] != tok[:-1]) | (key[1:] != key[:-1])]
    tok, key = tok[keep], key[keep]
    if width == 8:
        return pa.table({"pivot": pa.nulls(len(tok), pa.int64()), "key": pa.array(key), "token": pa.array(tok.view(np.int64))})
    start = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]])
    size = np.diff(np.r_[start, len(tok)])
    many = np.repeat(size > 1, size)
    pairs = np.stack([key[np.repeat(start, size)][many], key[many]], 1)
    pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
    return pa.table({"pivot": pa.array(pairs[:, 0]), "key": pa.array(pairs[:, 1]), "token": pa.nulls(len(pairs), pa.int64())})


def _bloom(width: int):
    def run(table: pa.Table) -> pa.Table:
        bits = np.zeros(width, bool)
        bits[(mixed(table.column("rep").to_numpy().astype(np.uint64)) & np.uint64(width - 1)).astype(np.int64)] = True
        return pa.table({"part": table.column("part").slice(0, 1), "blob": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return run


def _sets_of(k: int, num: int, den: int, bloom, width: int):
    @lean
    def run(batches):
        ids, seen, bits = WordIds(), set(), None
        for batch in batches:
            if bits is None:
                bits = [np.zeros(width // 8, np.uint8) if x is None else np.frombuffer(x, np.uint8) for x in bloom.value]
            docs = batch.column(batch.schema.get_field_index("doc_id"))
            numbers = docs.fill_null(0).to_numpy().astype(np.int64)
            at = (mixed(numbers.astype(np.uint64)) & np.uint64(width - 1)).astype(np.int64)
            hit = np.array([bits[p][x >> 3] >> (7 - (x & 7)) & 1 for p, x in zip((numbers % 64).tolist(), at.tolist(), strict=True)], bool)
            for rows in pylists([batch.filter(pa.array(hit & docs.is_valid().to_numpy(zero_copy_only=False)))], "doc_id", "text"):
                out = [(fp, s) for _, text in rows if len(s := shingle_set(text, ids, k)) and (fp := fingerprint(s)) not in seen]
                seen.update(fp for fp, _ in out)
                yield record_batch({"fp": ([x[0] for x in out], pa.binary()), "signs": ([_signs(x[1], num, den) for x in out], pa.binary()), "tokens": ([x[1].tobytes() for x in out], pa.binary())})

    return run


class _Bitmaps:
    """Which members may be near a member, by their bitmaps."""

    def __init__(self, blobs: list[bytes], n: np.ndarray, num: int, den: int):
        self.n, self.num, self.den = n, num, den
        self.size = np.array([len(b) for b in blobs])
        self.rank, self.own, self.folded = np.zeros(len(blobs), np.int64), {}, {}
        for size in np.unique(self.size):
            at = np.flatnonzero(self.size == size)
            self.rank[at] = np.arange(len(at))
            self.own[size] = np.frombuffer(b"".join(blobs[i] for i in at), np.uint8).reshape(len(at), -1)
            self.folded[size] = self.own[size][:, : size // 2] ^ self.own[size][:, size // 2 :]

    def near(self, x: int, y: np.ndarray) -> np.ndarray:
        size, keep = self.size[x], np.ones(len(y), bool)
        for bits, of, at in ((self.own[size], self.own, size), (self.own[size], self.folded, 2 * size), (self.folded[size], self.own, size // 2)):
            some = np.flatnonzero(self.size[y] == at)
            if len(some):
                apart = np.bitwise_count(of[at][self.rank[y[some]]] ^ bits[self.rank[x]]).sum(1, dtype=np.int64)
                keep[some] = (self.num + self.den) * apart <= (self.den - self.num) * (self.n[y[some]] + self.n[x])
        return keep


class _Signatures:
    """Which members may be near a member: those that share enough of it under every further order."""

    def __init__(self, blobs: list[bytes], n: np.ndarray, num: int, den: int):
        signs = [np.split(np.frombuffer(b, np.uint16), len(ORDERS)) for b in blobs]
        self.values = [np.concatenate(x) for x in zip(*signs, strict=True)]
        self.start = np.r_[0, np.cumsum([len(x[0]) for x in signs])]
        self.mark, self.least = np.zeros(1 << 16, np.int32), least_shared(n, num, den)

    def near(self, x: int, y: np.ndarray) -> np.ndarray:
        keep = np.ones(len(y), bool)
        for v in self.values:
            self.mark[own := v[self.start[x] : self.start[x + 1]]] = 1
            shared = _shared(self.mark, v, self.start, y)
            self.mark[own] = 0
            keep &= shared >= np.minimum(self.least[y], self.least[x])
        return keep


class _Earlier:
    """Which members share no pivot before their group's own with a member: only there the pair is looked at."""

    def __init__(self, pivots: pa.ChunkedArray, own: int):
        lists = [np.array(sorted(p for p in x if p < own), np.int64) for x in pivots.to_pylist()]
        at = np.unique(np.concatenate(lists), return_inverse=True)[1] + 1
        self.start = np.r_[0, np.cumsum([len(x) + 1 for x in lists])]  # a 0 first in each list, so that none is empty
        self.values = np.zeros(self.start[-1], np.int64)
        self.values[np.delete(np.arange(len(self.values)), self.start[:-1])] = at
        self.mark = np.zeros(len(at) + 1, np.int32)

    def none(self, x: int, y: np.ndarray) -> np.ndarray:
        self.mark[own := self.values[self.start[x] + 1 : self.start[x + 1]]] = 1
        shared = _shared(self.mark, self.values, self.start, y)
        self.mark[own] = 0
        return shared == 0


def _shared(mark: np.ndarray, values: np.ndarray, start: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many values of each member y (ascending) are marked."""
    lo, hi = start[y[0]], start[y[-1] + 1]
    return np.add.reduceat(mark[values[lo:hi]], start[y[0] : y[-1] + 1] - lo)[y - y[0]]


class _Candidates:
    """The pairs of some members that may be links: by size, by `test`, of different sides (where sides are given), and of
    different components so far."""

    def __init__(self, table: pa.Table, n: np.ndarray, test, num: int, den: int):
        self.n, self.side, self.test, self.num, self.den = n, table.column("side").to_numpy(), test, num, den
        self.comp = table.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
        self.label = self.comp
        self.earlier = _Earlier(table.column("pivots"), table.column("pivot")[0].as_py()) if "pivots" in table.column_names else None

    def of(self, x: int) -> np.ndarray:
        """Candidates of x behind x."""
        n, rest = self.n[x + 1 :], slice(x + 1, None)
        ok = (self.label[rest] != self.label[x]) & (self.comp[rest] != self.comp[x]) & (self.den * np.minimum(n, self.n[x]) >= self.num * np.maximum(n, self.n[x])) & ((self.side[rest] != self.side[x]) | (self.side[x] == 2))
        y = np.flatnonzero(ok) + x + 1
        if self.earlier and len(y):
            y = y[self.earlier.none(x, y)]
        return y[self.test.near(x, y)] if len(y) else y

    def join(self, x: int, y) -> None:
        self.label = np.where(np.isin(self.label, self.label[y]), self.label[x], self.label)


def _screened(kind, num: int, den: int):
    """Members that have a candidate, with the part of their table that candidates connect."""

    def run(table: pa.Table) -> pa.Table:
        m, n = len(table), table.column("n").to_numpy()
        found = _Candidates(table, n, kind(table.column("blob").to_pylist(), n, num, den), num, den)
        found.label = np.arange(m)
        for x in range(m - 1):
            if len(y := found.of(x)):
                found.join(x, y)
        keep = pa.array(np.bincount(found.label, minlength=m)[found.label] > 1)
        part = found.label.astype(np.int64) + ((table.column("part")[0].as_py() << 24) if "part" in table.column_names else 0)
        return table.select([*_UNIT]).append_column("part", pa.array(part)).filter(keep)

    return run


def _verified(num: int, den: int):
    """Links of a part, by exact intersection of its candidates, that join two components. Where members come with the rows
    they stand for, all links, and of each member the rows that it is linked to (b null)."""

    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("tokens")]
        start = np.r_[0, np.cumsum([len(s) for s in sets])]
        names, at = np.unique(np.concatenate(sets), return_inverse=True)
        n, fp, every = np.diff(start), table.column("fp").to_pylist(), "copies" in table.column_names
        found = _Candidates(table, n, _Signatures([_signs(s, num, den) for s in sets], n, num, den), num, den)
        label = found.label
        if every:
            found.label, copies, linked = np.arange(len(sets)), table.column("copies").to_numpy(), np.zeros(len(sets), np.int64)
        mark, out = np.zeros(len(names), np.int32), []
        for x in range(len(sets) - 1):
            y = found.of(x)
            mark[own := at[start[x] : start[x + 1]]] = 1
            if every and len(y):
                both = _shared(mark, at, start, y)
                y = y[den * both >= num * (n[x] + n[y] - both)]
                linked[x] += copies[y].sum()
                linked[y] += copies[x]
            while len(y := y[label[y] != label[x]]):
                z, y = int(y[0]), y[1:]
                both = int(np.count_nonzero(mark[at[start[z] : start[z + 1]]]))
                if den * both >= num * (int(n[x] + n[z]) - both):
                    label = np.where(label == label[z], label[x], label)
                    out.append((fp[x], fp[z], None))
                    if not every:
                        found.label = label
            mark[own] = 0
        if every:
            out += [(fp[i], None, int(linked[i])) for i in np.flatnonzero(linked)]
        return pa.table({"a": pa.array([r[0] for r in out], pa.binary()), "b": pa.array([r[1] for r in out], pa.binary()), "n": pa.array([r[2] for r in out], pa.int64())})

    return run


_UNIT = {"pivot": "long", "block": "int", "other": "int", "fp": "binary", "n": "long", "side": "int", "comp": "binary"}


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4, block: int = BLOCK, hot: int = HOT, counts: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row of docs, for Jaccard >= num/den of k-word shingle sets.

    n_links: the number of other rows (with an id) that the row links with, its copies among them. Without `counts` there is
    no such column, and links inside a component that others made needless are not looked at."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = saved(docs.mapInArrow(_profile(k), "doc_id long, n long, fp binary, key long, segment int, salt int, blob binary"))
    profile = seen.where("segment is null").select("doc_id", "n", "fp", "key")
    classes = saved(profile.where("fp is not null and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("key").alias("key"), F.count("*").alias("copies")))
    n_prefix, total = classes.agg(F.sum(F.expr(f"n - cast(ceil({num} * n / {den}) as long) + 1")), F.sum("n")).first()
    levels = _levels(seen.where("segment is not null").select("segment", "salt", "blob"))
    usual = int(_code(8 + 4 * (total or 0) / len(levels)))
    ranks = spark.sparkContext.broadcast(np.maximum(levels.astype(np.int16) - usual, 0).astype(np.uint8))
    range_bits = max(math.ceil(math.log2(max((n_prefix or 0) / RANGE_ENTRIES, LEAST_RANGES))), 1)
    postings = docs.mapInArrow(_prefixes(k, num, den, ranks, range_bits, max(int(_code(hot)) - usual, 1)), "part long, blob binary")
    found = saved(postings.groupBy("part").applyInArrow(_lists, "pivot long, key long, token long"))
    ranks.unpersist()
    warm = found.where("token is not null").select("token", "key")
    heads = warm.groupBy("token").agg(F.min("key").alias("pivot"), F.count("*").alias("m")).where("m > 1")
    pairs = saved(found.where("token is null").select("pivot", "key").union(warm.join(heads, "token").select("pivot", "key")).distinct())

    live = pairs.select("key").distinct()
    marks = saved(seen.where("segment is null and blob is not null").join(live, "key", "left_semi").dropDuplicates(["fp"]).select("fp", "key", "n", "blob"))

    def sets_of(used: DataFrame) -> DataFrame:
        """fp, signs and tokens of these classes (and of a few others that the filter lets through)."""
        reps = saved(classes.join(used, "fp", "left_semi").select("rep", F.pmod("rep", F.lit(64)).alias("part")))
        bits = min(max(BLOOM_BITS[0], math.ceil(math.log2(16 * max(reps.count(), 1)))), BLOOM_BITS[1]) - 6
        blooms: list = [None] * 64
        for r in reps.groupBy("part").applyInArrow(_bloom(1 << bits), "part long, blob binary").toLocalIterator():
            blooms[r.part] = r.blob
        return saved(docs.mapInArrow(_sets_of(k, num, den, spark.sparkContext.broadcast(blooms), 1 << bits), "fp binary, signs binary, tokens binary"))

    def links_of(members: DataFrame) -> DataFrame:
        """The links that join components in the blocks of members."""
        schema = ", ".join(f"{n} {t}" for n, t in _UNIT.items()) + ", part long"
        near = members.select(*_UNIT).join(marks.select("fp", "blob"), "fp").select(*_UNIT, "blob").groupBy("pivot", "block", "other").applyInArrow(_screened(_Bitmaps, num, den), schema)
        near = saved(near)
        sets = sets_of(near.select("fp").distinct())
        signs, tokens = (sets.select("fp", c).dropDuplicates(["fp"]) for c in (F.col("signs").alias("blob"), "tokens"))
        pivots = saved(near.groupBy("fp").agg(F.collect_set("pivot").alias("pivots")))
        signs, tokens = signs.join(pivots, "fp"), tokens.join(pivots, "fp")
        if counts:
            tokens = tokens.join(classes.select("fp", "copies"), "fp")
        parts = near.join(signs, "fp").groupBy("pivot", "block", "other", "part").applyInArrow(_screened(_Signatures, num, den), schema)
        found = parts.join(tokens, "fp").groupBy("pivot", "block", "other", "part").applyInArrow(_verified(num, den), "a binary, b binary, n long")
        return saved(found)

    def dealt(rows: DataFrame, name: str) -> DataFrame:
        """Number of blocks that each group's rows need."""
        return rows.groupBy("pivot").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias(name))

    members = saved(pairs.join(marks.select("key", "fp", "n"), "key"))
    blocks = saved(dealt(members, "blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    first = members.join(blocks, "pivot").withColumn("block", own)
    each = F.expr("sequence(0, blocks - 1)")
    if counts:  # each two blocks meet once
        first = first.withColumn("with", F.explode(each)).withColumn("side", F.when(F.col("block") == F.col("with"), 2).otherwise((F.col("block") > F.col("with")).cast("int")))
        first = first.withColumns({"block": F.least("block", "with"), "other": F.greatest("block", "with")}).drop("with")
    else:
        first = first.withColumn("block", F.explode(F.when(F.col("key") == F.col("pivot"), each).otherwise(F.array("block")))).withColumns({"other": F.lit(0), "side": F.lit(2)})
    found = links_of(first.withColumn("comp", F.col("fp")))
    links = found.where("b is not null").select("a", "b")
    comps = connected(links)
    wide = blocks.where("blocks > 1")
    if not counts and wide.limit(1).count():
        # Links that single blocks can't see: members outside the pivot's component against all others.
        split = saved(members.join(wide, "pivot").join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("label", "fp")))
        tops = split.where("key = pivot").groupBy("pivot").agg(F.min("comp").alias("top"))
        strays = saved(split.join(tops, "pivot").where("comp <> top").drop("top", "label"))
        ways = dealt(strays, "ways")
        left = strays.join(ways, "pivot").withColumns({"block": F.pmod(F.xxhash64("fp"), F.col("ways")).cast("int"), "other": F.explode(F.expr("sequence(0, blocks - 1)")), "side": F.lit(0)})
        right = split.join(ways, "pivot").withColumns({"other": own, "block": F.explode(F.expr("sequence(0, ways - 1)")), "side": F.lit(1)})
        links = links.union(links_of(left.unionByName(right, allowMissingColumns=True)).select("a", "b"))
        comps = connected(links)
    reached = classes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", "copies", F.coalesce("label", "fp").alias("label"))
    least = reached.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = reached.join(least, "label").select("fp", "component_id", "copies")
    if counts:
        n_links = found.where("b is null").groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("n_links"))
        named = named.join(n_links, "fp", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1)
    there = F.col("doc_id").isNotNull()
    out = profile.join(named, "fp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(there, F.coalesce("component_id", "doc_id")).alias("component_id"), *([F.when(there, F.col("n_links")).alias("n_links")] if counts else []))
    return out.fillna(0, ["n_links"]) if counts else out


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that are linked to a smaller id; rows that share an id are one document and stay or go
    together. Same columns."""
    found = jaccard_components(docs, id_col, text_col, counts=False)
    gone = saved(found.where("component_id < doc_id").select(F.col("doc_id").alias(id_col)).distinct())
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
