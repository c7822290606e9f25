"""Conversation structure repair by Knuth's lightest-derivation agenda.

Rows of a conversation, in order of turn, are to give role initials `(s?(ua)+)?`. A repair is a derivation in a weighted
hypergraph whose items are (start state, rows taken, state); deductions keep, rerole or delete the next row or insert one, and
join the items of two neighbouring segments. A derivation weighs (cost, audit), audit being the initials of its edits, compared
as text. Deductions add cost and append audit, so they are monotone and superior: an item popped from the agenda is final, and
the agenda ends when the goal items are final. (Of two derivations of one item and cost, neither audit is a prefix of the other,
as the longer would have inserted more and cost more; so appending keeps their order.)

Spark's part: rows without their texts (a digest in place of it) are counted by conversation, turn, role and digest, earlier
equal rows found by aggregation, and dealt out by ranges of (conversation, turn), so that one conversation may be many tasks'
work. A task cuts its runs of a conversation into segments of at most SEGMENT rows and derives each from every start state,
with a bounded memory of row patterns. Segments then meet the texts in order, in one pass over sorted rows that holds one
conversation's audit and no texts: it joins the segments' items, replays the edits and hashes the repaired text as it goes. (A
SHA-256 of a whole conversation is sequential by its nature; this pass alone takes a conversation in one task.)

Defined results: nulls of any column are one space as text; a null turn sorts first; conversations may have a null identifier.
Rows of one turn are ordered by role, then by the digest of role and text; equal rows count each. Conversations without a row
left have zeros, an empty audit and the hash of the empty text. Roles other than s, u, a by initial can't be kept. An empty
table gives no rows. Further columns are ignored, whatever their names. Texts are taken whole at any length.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import lean, record_batch, saved, slices

#: Most rows of a segment, and row patterns that a task remembers.
SEGMENT, REMEMBERED = 512, 50_000
#: State after the last row given out: nothing, system, user, assistant. What a kept initial leads to from a state.
BEGIN, S, U, A = range(4)
NEXT = {(BEGIN, "s"): S, (BEGIN, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
#: Costs: a rerole, a deletion, an insertion, a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
OPEN = "ua"
BLANK, MARKS = r"[^\x20\x09-\x0D]", "[.!?]"


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text and copies: rows damaged by crc32 of `conv:turn` modulo 20: 0 drops (no copies), 1 empties the
    text, 2 takes its end marks, 3 repeats, 4 makes it the user's."""
    word = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    how = F.crc32(F.concat(word(conv), F.lit(":"), word(turn)).cast("binary")) % 20
    return rows.select(
        rows[conv].alias("conv"), rows[turn].alias("turn"), F.when(how == 4, "user").otherwise(word(role)).alias("role"),
        F.when(how == 1, "").when(how == 2, F.regexp_replace(word(text), MARKS, "")).otherwise(word(text)).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def faults(rows: DataFrame) -> DataFrame:
    """conv, turn, role, digest, copies, code of the distinct rows left: code is the role's initial (`-` if none of s, u, a) and
    `b` blank, `d` seen in an earlier turn, `t` truncated or `o` none of these."""
    r = rows.where("copies > 0").select("conv", "turn", "role", _digest(F.col("role"), F.col("text")).alias("digest"), "copies", F.when(~F.col("text").rlike(BLANK), "b").when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "t").otherwise("o").alias("fault"))
    r = r.groupBy("conv", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.first("fault").alias("fault"))
    first = r.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min_by(F.struct("turn"), F.struct("turn")).alias("first"))
    met = r.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    code = F.when(F.col("fault") == "b", "b").when(~F.col("turn").eqNullSafe(F.col("first.turn")), "d").otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    return met.select("conv", "turn", "role", "digest", "copies", initial.alias("initial"), F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("-"), code).alias("code"))


def lightest(rows: tuple[str, ...], start: int) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the lightest derivation of every state after the rows (codes, as in `faults`) from the start state."""
    agenda, final, goals = [(0, "", 0, start)], set(), {}
    while agenda and len(goals) < 4:
        cost, audit, i, q = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == len(rows):
            goals[q] = (cost, audit)
        else:
            initial, fault = rows[i]
            heapq.heappush(agenda, (cost + DELETE, audit + "D", i + 1, q))
            if fault in "to":
                more = cost + TRUNCATED * (fault == "t")
                if (to := NEXT.get((q, initial))) is not None:
                    heapq.heappush(agenda, (more, audit + "K", i + 1, to))
                for x in OPEN:
                    if (to := NEXT.get((q, x))) is not None:
                        heapq.heappush(agenda, (more + REROLE, audit + "R", i + 1, to))
        for x in OPEN:
            if (to := NEXT.get((q, x))) is not None:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, to))
    return goals


class Derived(dict):
    """(rows, starts) to their lightest derivations; emptied when it holds REMEMBERED patterns."""

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        rows, known = key
        value = self[key] = [(p, q, *w) for p in ((BEGIN,) if known else (BEGIN, S, U, A)) for q, w in lightest(rows, p).items()]
        return value


class Summary:
    """Counts of a run of rows, such that those of neighbouring runs add up."""

    __slots__ = ("turns", "low", "high", "blank", "duplicate", "truncated", "illegal", "head", "tail")

    def __init__(self):
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.head = self.tail = None

    def add(self, low, high, turns, blank, duplicate, truncated, illegal, head, tail) -> None:
        if low is not None:
            self.turns += turns - (self.high is not None and self.high == low)
            self.low, self.high = low if self.low is None else self.low, high
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.illegal += illegal + (self.tail is not None and self.tail + head not in ("su", "ua", "au"))
        self.head, self.tail = head if self.head is None else self.head, tail

    def row(self) -> list:
        return [self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated, self.illegal, self.head, self.tail]


COUNTS = "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, head string, tail string"
ITEMS = "items array<struct<p:int, q:int, cost:long, audit:string>>"
_TYPES = [pa.int64()] * 7 + [pa.string()] * 2
_ITEM = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _tuples(batches, *names: str) -> Iterator[tuple]:
    for b in slices(batches):
        yield from zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def segments(rows: DataFrame, most: int = SEGMENT) -> DataFrame:
    """conv, place (partition, number), counts and items of every segment of the rows of `faults`."""
    ordered = rows.repartitionByRange("conv", "turn", "role", "digest").sortWithinPartitions("conv", "turn", "role", "digest").withColumn("part", F.spark_partition_id())

    def run(batches):
        known, out, number = Derived(), [], 0
        flat = ((c, t, i, k, p) for c, t, i, k, p, m in _tuples(batches, "conv", "turn", "initial", "code", "part", "copies") for k in _copies(k, m))
        for at, (conv, run_rows) in enumerate(groupby(flat, key=lambda r: r[0])):
            first = at > 0  # a run that begins inside the partition is its conversation's first
            while part := _taken(run_rows, most):
                s = Summary()
                for _, t, initial, k, _ in part:
                    s.add(t, t, 1, k[1] == "b", k[1] == "d", k[1] == "t", 0, initial, initial)
                out.append((conv, part[0][4], number, *s.row(), known[tuple(r[3] for r in part), first]))
                number, first = number + 1, False
                if len(out) >= 256:
                    yield _segment_batch(out, conv_type)
                    out = []
        if out:
            yield _segment_batch(out, conv_type)

    conv_type = to_arrow_type(rows.schema["conv"].dataType)
    return ordered.mapInArrow(lean(run), f"conv {dict(rows.dtypes)['conv']}, part int, number long, {COUNTS}, {ITEMS}")


def _copies(code: str, copies: int) -> Iterator[str]:
    """A row, and its copies, which are duplicates unless blank."""
    yield code
    again = code if code[1] == "b" else code[0] + "d"
    for _ in range(copies - 1):
        yield again


def _taken(rows: Iterator, most: int) -> list:
    out = []
    for r in rows:
        out.append(r)
        if len(out) == most:
            break
    return out


def _segment_batch(rows: list, conv: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    items = [[{"p": p, "q": q, "cost": c, "audit": a} for p, q, c, a in x] for x in cols[-1]]
    names = ["part", "number", *[x.split()[0] for x in COUNTS.split(", ")]]
    return record_batch({"conv": (list(cols[0]), conv)} | {n: (list(v), t) for n, v, t in zip(names, cols[1:-1], [pa.int32(), pa.int64(), *_TYPES], strict=True)} | {"items": (items, _ITEM)})


def _joined(best: dict[int, tuple[int, str]], items: list[dict]) -> dict[int, tuple[int, str]]:
    """Lightest derivations over one more segment: deductions with two items before them."""
    out: dict[int, tuple[int, str]] = {}
    for x in items:
        if (b := best.get(x["p"])) is not None:
            made = (b[0] + x["cost"], b[1] + x["audit"])
            if x["q"] not in out or made < out[x["q"]]:
                out[x["q"]] = made
    return out


class Replay:
    """Applies an audit to the rows, hashing the repaired `role:text` lines as they come."""

    NAMES = {"u": "user", "a": "assistant"}

    def __init__(self, audit: str):
        self.edits, self.state, self.sha, self.lines = iter(audit), BEGIN, hashlib.sha256(), 0

    def _put(self, initial: str, role: str, text: str) -> None:
        self.state = NEXT[self.state, initial]
        self.sha.update(("\n" * (self.lines > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _new(self) -> str:
        return "a" if self.state == U else "u"

    def row(self, role: str, text: str) -> None:
        for edit in self.edits:
            if edit == "I":
                self._put(x := self._new(), self.NAMES[x], "")
                continue
            if edit == "K":
                self._put(role[:1], role, text)
            elif edit == "R":
                self._put(x := self._new(), self.NAMES[x], text)
            return

    def end(self) -> str:
        for _ in self.edits:
            self._put(x := self._new(), self.NAMES[x], "")
        return self.sha.hexdigest()


def repaired(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of `damaged` rows: conv, gaps, faults, illegal, cost, audit and the repaired text's hash."""
    kind, conv_type = dict(rows.dtypes)["conv"], to_arrow_type(rows.schema["conv"].dataType)
    cuts = segments(faults(rows), segment).withColumn("order", F.lit(0))
    texts = rows.select("conv", F.lit(1).alias("order"), "turn", "role", "text", "copies", _digest(F.col("role"), F.col("text")).alias("digest"))
    both = texts.unionByName(cuts, allowMissingColumns=True)
    # A conversation's rows share a task here for its hash alone; only this pass reads texts, in order and one at a time.
    met = both.repartition("conv").sortWithinPartitions("conv", "order", "part", "number", "turn", "role", "digest")
    names = ["conv", "order", "role", "text", "copies", *[x.split()[0] for x in COUNTS.split(", ")], "items"]

    def run(batches):
        out = []
        for conv, group in groupby(_tuples(batches, *names), key=lambda r: r[0]):
            total, best, replay = Summary(), {BEGIN: (0, "")}, None
            for _, order, role, text, copies, *counts, items in group:
                if order == 0:
                    total.add(*counts)
                    best = _joined(best, items)
                    continue
                replay = replay or Replay(min(best[q] for q in (BEGIN, A) if q in best)[1])
                for _ in range(copies):
                    replay.row(role, text)
            cost, audit = min(best[q] for q in (BEGIN, A) if q in best)
            gaps = 0 if total.low is None else total.high - total.low + 1 - total.turns
            out.append((conv, gaps, total.blank, total.duplicate, total.truncated, total.illegal, cost, audit, replay.end() if replay else hashlib.sha256().hexdigest()))
            if len(out) >= 256:
                yield _result_batch(out, conv_type)
                out = []
        if out:
            yield _result_batch(out, conv_type)

    return met.mapInArrow(lean(run), f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _result_batch(rows: list, conv: pa.DataType) -> pa.RecordBatch:
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    cols = list(zip(*rows, strict=True))
    return record_batch({"conv": (list(cols[0]), conv)} | {n: (list(v), t) for n, v, t in zip(names, cols[1:], [pa.int64()] * 6 + [pa.string()] * 2, strict=True)})


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """`repaired` of the damaged rows, which are written once, as two passes take them in other orders."""
    return repaired(saved(damaged(rows, conv, turn, role, text)), segment).withColumnRenamed("conv", conv)
