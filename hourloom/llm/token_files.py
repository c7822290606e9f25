"""Token-id files with Re-Pair grammar compression.

Documents, in ascending doc_id order (nulls first), become one stream of ids, each document closed by the end id. The
stream is cut into shards of about SHARD_IDS ids at document borders. In a shard the most frequent pairs of symbols are
replaced by nonterminals, again and again until no pair occurs LEAST times; pairs with the end id are never replaced, so
that every document is its own piece of the compressed sequence.
A shard's file image holds

    magic "HLRP", version, counts | rules (left, right) | expansion length of each rule | doc ids | null flags |
    ids of each document | symbols of each document | symbols

so any run of ids of a document is decoded by walking expansion lengths (`decode_range`), without the rest. Images are
rows of a table in the shared folder, written by Spark's own commit protocol, so a lost executor leaves no half file.

Null texts are empty, very long ones whole; rows that share a doc_id come in the order of a hash of their texts; repeated rows are stored as often as they occur; no rows give no files.
"""

from __future__ import annotations

import gc
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, lean, roomy, saved, values
from .tokens import encoder_of, vocabulary

SHARD_IDS = 1 << 20
LEAST = 16
SHORT = 64  # ids of a rule that are looked up at once
PIECES = 1_200_000  # known pieces of a worker, about 200 bytes each
COLUMN = 1 << 23  # bytes of texts that are tokenised together
_HEAD = struct.Struct("<4sIIIIQ")  # magic, version, first nonterminal, rules, documents, symbols


def _grouped(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places `at` of pairs (left, right), grouped by pair and ascending inside a pair, of pairs of at least LEAST places:
    the places, and where each pair begins, and its number of places."""
    slot_bits = max(8, min(19, len(at).bit_length() + 1))
    slot = ((left * np.uint32(0x9E3779B1)) ^ (right * np.uint32(0x85EBCA77))) >> np.uint32(32 - slot_bits)
    often = np.flatnonzero((np.bincount(slot) >= LEAST).take(slot, mode="clip"))  # the others are of rare pairs
    at, left, right = at.take(often, mode="clip"), left.take(often, mode="clip"), right.take(often, mode="clip")
    bits, wide = int(at.max(initial=0)).bit_length(), int(right.max(initial=0)).bit_length()
    if int(left.max(initial=0)).bit_length() + wide + bits <= 64:
        pair = left.astype(np.uint64)
        pair <<= np.uint64(wide)
        pair |= right
        pair <<= np.uint64(bits)
        pair |= at.view(np.uint64)
        pair.sort()
        at = (pair & np.uint64((1 << bits) - 1)).view(np.int64)
        pair >>= np.uint64(bits)
    else:
        order = np.lexsort((at, right, left))
        at, pair = at[order], left[order].astype(np.uint64) << np.uint64(32) | right[order]
    start = np.flatnonzero(np.r_[len(pair) > 0, pair[1:] != pair[:-1]])
    n = np.diff(np.r_[start, len(pair)])
    often = n >= LEAST
    at = at[np.repeat(often, n)]
    n = n[often]
    return at, np.cumsum(n) - n, n


def _spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start[i] to start[i] + n[i] - 1, for each i."""
    out = np.repeat(start - np.cumsum(n) + n, n)
    out += np.arange(len(out))
    return out


def _chosen(p: np.ndarray, q: np.ndarray, n: np.ndarray) -> list[int]:
    """Of pairs (p, q) of n places each, those to replace together: of at least LEAST places and a quarter of the most
    frequent one's, most frequent first, as long as no symbol is left in one and right in another."""
    good = np.flatnonzero(n >= max(LEAST, int(n.max()) // 4))
    good = good[np.argsort(-n[good], kind="stable")]
    out, left, right = [], set(), set()
    for i, a, b in zip(good.tolist(), p[good].tolist(), q[good].tolist(), strict=True):
        if a in right or b in left or (a == b and (a in left or b in right)):
            continue
        left.add(a)
        right.add(b)
        out.append(i)
    return out


def compress(ids: np.ndarray, end_id: int, first: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Symbols and rules: symbol first + i stands for rules[i]. Every frequent pair has a list of its places. A pair's places
    only become fewer once they are listed, as each new neighbourhood holds a new symbol; so a pass looks at the places of
    the most frequent pairs alone, replaces them, and lists the pairs around the replaced places, until no pair occurs
    LEAST times. A pair of equal symbols is taken from the left of each run, without overlaps."""
    size, rules = len(ids), []
    if size < 2:
        return ids.astype(np.uint32), rules
    gone = np.uint32(0xFFFFFFFF)
    x = np.append(ids, np.uint32(end_id)).astype(np.uint32)  # a place's symbol; the right place of a replaced pair is gone
    after, before = np.arange(1, size + 2), np.arange(-1, size)
    after[size] = size
    of = lambda table, at: table.take(at, mode="clip")  # noqa: E731  faster than an index, and no place is out of range
    pool, used = np.empty(3 * size, np.int32), 0  # places of listed pairs; at most two are listed anew for one replaced
    low = np.uint64(32)
    pairs = x.astype(np.uint64) << low  # a place's symbol and the next one's, so that one look tells whether a pair is still there
    pairs[:size] |= x[1:]
    key = np.empty(0, np.uint64)
    start = n = np.empty(0, np.int64)
    fresh, a, b = np.arange(size), x[:-1], x[1:]
    while True:
        inner = np.flatnonzero((a != end_id) & (b != end_id))
        at, begin, count = _grouped(of(fresh, inner), of(a, inner), of(b, inner))
        pool[used : used + len(at)] = at
        live = n >= LEAST
        key = np.r_[key[live], of(pairs, of(at, begin)) if len(at) else key[:0]]
        start, n = np.r_[start[live], begin + used], np.r_[n[live], count]
        used += len(at)
        chosen = []
        while len(n) and (top := int(n.max())) >= LEAST and not chosen:
            hot = np.flatnonzero(n >= max(LEAST, top // 4))
            many, wanted = n[hot], key[hot]
            at = of(pool, _spans(start[hot], many)).astype(np.int64)
            still = np.flatnonzero(of(pairs, at) == np.repeat(wanted, many))
            at, pair = of(at, still), of(np.repeat(np.arange(len(hot)), many), still)
            n[hot] = left = np.bincount(pair, minlength=len(hot))
            pool[_spans(start[hot], left)] = at
            if int(left.max()) >= LEAST:
                p, q = wanted >> low, wanted & np.uint64(0xFFFFFFFF)
                chosen = _chosen(p, q, left)
        if not chosen:
            return x[:size][x[:size] != gone], rules
        rule = np.full(len(hot), -1)
        rule[chosen] = np.arange(len(chosen))
        rule = of(rule, pair)
        taken = np.flatnonzero(rule >= 0)
        at, rule = of(at, taken), of(rule, taken)
        right = of(after, at)
        run = np.flatnonzero(np.r_[True, right[:-1] != at[1:]])
        if len(run) < len(at):  # neighbours are of one run of equal symbols: every other place of it
            odd = (np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) & 1 == 0
            at, rule, right = at[odd], rule[odd], right[odd]
        n[hot[chosen]] = 0
        new = first + len(rules)
        rules += list(zip(p[chosen].tolist(), q[chosen].tolist(), strict=True))
        x[at] = new + rule
        x[right] = gone
        pairs[right] = ~np.uint64(0)
        right = of(after, right)
        after[at] = right
        before[right] = at
        back = before[at]
        back = back[back >= 0]
        fresh = np.concatenate([at, back[of(x, back) < new]])
        a, b = of(x, fresh), of(x, of(after, fresh))
        pairs[fresh] = a.astype(np.uint64) << low | b


def lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Expansion length of each rule; a rule's sides are older symbols."""
    out = []
    for p, q in rules.tolist():
        out.append((out[p - first] if p >= first else 1) + (out[q - first] if q >= first else 1))
    return np.array(out, np.int64)


class Expansion:
    """Expands symbols by one look into a table of the ids of every symbol. Rules of over SHORT ids are opened side by side
    first, so that the table holds an id of each terminal (they are below the vocabulary's size) and SHORT a rule at most."""

    def __init__(self, rules: np.ndarray, first: int, size: np.ndarray):
        self.rules, self.first = rules, first
        texts = []
        for (p, q), n in zip(rules.tolist(), size.tolist(), strict=True):
            texts.append([] if n > SHORT else (texts[p - first] if p >= first else [p]) + (texts[q - first] if q >= first else [q]))
        self.wide = np.r_[np.ones(first, np.int64), np.array([len(t) for t in texts], np.int64)]
        self.flat = np.r_[np.arange(first, dtype=np.uint32), np.array([i for t in texts for i in t], np.uint32)]
        self.at = np.cumsum(self.wide) - self.wide

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        x = symbols.astype(np.int64)
        while (long := self.wide.take(x) == 0).any():
            size = np.where(long, 2, 1)
            start = np.cumsum(size) - size
            out = np.empty(int(size.sum()), np.int64)
            out[start[~long]] = x[~long]
            out[start[long]], out[start[long] + 1] = self.rules[x[long] - self.first].T
            x = out
        wide = self.wide.take(x)
        at = np.repeat(self.at.take(x) - np.cumsum(wide) + wide, wide)
        at += np.arange(len(at))
        return self.flat.take(at, mode="clip")


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    return Expansion(rules, first, lengths(rules, first))(symbols)


def encode_file(docs: list[tuple[int | None, np.ndarray]], end_id: int) -> bytes:
    stream = np.concatenate([x for _, x in docs])
    first = int(stream.max()) + 1
    symbols, rules = compress(stream, end_id, first)
    r = np.array(rules, np.uint32).reshape(-1, 2)
    size = lengths(r, first)
    wide = np.r_[np.ones(first, np.int64), size].take(symbols)
    n = np.array([len(x) for _, x in docs], np.int64)
    ends = np.searchsorted(np.cumsum(wide), np.cumsum(n)) + 1
    n_symbols = np.diff(np.r_[0, ends])
    narrow = first + len(r) <= 65536
    return b"".join([
        _HEAD.pack(b"HLRP", 2 if narrow else 4, first, len(r), len(docs), len(symbols)), r.tobytes(), size.astype("<u4").tobytes(),
        np.array([d or 0 for d, _ in docs], "<i8").tobytes(), np.array([d is None for d, _ in docs], np.uint8).tobytes(), n.astype("<u4").tobytes(), n_symbols.astype("<u4").tobytes(), symbols.astype("<u2" if narrow else "<u4").tobytes(),
    ])


class TokenFile:
    def __init__(self, image: bytes):
        magic, width, self.first, n_rules, n_docs, n_symbols = _HEAD.unpack_from(image)
        if magic != b"HLRP":
            raise ValueError("not a token file")
        at = _HEAD.size

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(image, kind, count, at)
            at += out.nbytes
            return out

        self.rules, self.size = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules).astype(np.int64)
        ids, null = take("<i8", n_docs), take(np.uint8, n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null, strict=True)]
        self.n_ids, self.n_symbols = take("<u4", n_docs).astype(np.int64), take("<u4", n_docs).astype(np.int64)
        self.symbols = take(f"<u{width}", n_symbols)
        self.at = np.cumsum(self.n_symbols) - self.n_symbols
        self.expand = Expansion(self.rules, self.first, self.size)

    def all_ids(self) -> np.ndarray:
        return self.expand(self.symbols)

    def decode_range(self, doc: int, start: int, stop: int) -> np.ndarray:
        """ids[start:stop] of the doc-th document; only symbols that reach into the range are expanded."""
        s = self.symbols[self.at[doc] : self.at[doc] + self.n_symbols[doc]].astype(np.int64)
        wide = np.where(s >= self.first, self.size[np.maximum(s - self.first, 0)] if len(self.size) else 1, 1)
        end = np.cumsum(wide)
        lo, hi = np.searchsorted(end, start, "right"), np.searchsorted(end, min(stop, int(end[-1])), "left") + 1
        base = int(end[lo - 1]) if lo else 0
        return self.expand(s[lo:hi])[start - base : stop - base]


def _files(path: str, end_id: int):
    @lean
    def run(batches):
        roomy()
        encoder, end = encoder_of(path, PIECES, True), np.uint32(end_id)
        if not gc.get_freeze_count():
            gc.freeze()  # else each task's end walks all known pieces
        part, shard, docs, n = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal shard, docs, n
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((part, pa.int64()), (shard, pa.int64()), (n, pa.int64()), (encode_file(docs, end_id), pa.binary()))], names=["part", "shard", "n_ids", "image"])
            shard, docs, n = shard + 1, [], 0
            return out

        for batch in columns(batches, "text", COLUMN):
            for doc, ids in zip(values(batch, "doc_id"), encoder.column(batch.column("text")), strict=True):
                docs.append((doc, np.append(ids, end)))
                n += len(docs[-1][1])
                if n >= SHARD_IDS:
                    yield flush()
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, path: str | None = None, end_id: int = 0) -> DataFrame:
    """The written table of file images: part, shard (their order is that of the stream), n_ids, image."""
    path = path or vocabulary("byte_bpe_50k.json")
    order = ("doc_id", F.xxhash64("text"), "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Range partitioning reads its input twice, so texts are tokenised behind it, once, where their ids are packed.
    return saved(rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(_files(path, end_id), "part long, shard long, n_ids long, image binary"))


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the file images."""

    @lean
    def run(batches):
        roomy()
        for batch in batches:
            for i in range(batch.num_rows):
                f = TokenFile(batch.column("image")[i].as_py())
                ids = memoryview(f.all_ids().astype("<u4", copy=False))
                start = np.cumsum(f.n_ids) - f.n_ids
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(start.tolist(), f.n_ids.tolist(), strict=True)]
                k = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("part")[i].as_py()] * k, pa.int64()), pa.array([batch.column("shard")[i].as_py()] * k, pa.int64()), pa.array(f.doc_ids, pa.int64()), pa.array(start), pa.array(f.n_ids), pa.array(crc, pa.int64())], names=["part", "shard", "doc_id", "inner", "n_tokens", "ids_crc32"])

    sizes = saved(files.select("part", "shard", "n_ids"))
    before = Window.unboundedPreceding, -1
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("skip", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0)))  # a row per partition
    offsets = sizes.withColumn("own", F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(*before)), F.lit(0))).join(parts.select("part", "skip"), "part").select("part", "shard", (F.col("skip") + F.col("own")).alias("base"))
    docs = files.select("part", "shard", "image").mapInArrow(run, "part long, shard long, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return docs.join(offsets, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
