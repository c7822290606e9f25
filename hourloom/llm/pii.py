"""Personal data by bootstrapped contextual extraction.

Base spans come from four fixed patterns (email, ip, card, phone). They are the seeds. Every seed, and every other token
that looks like an identifier, is an instance with lexical patterns: its two words to the left, its two words to the
right, and one word of either side. Spark scores the bipartite pattern-instance graph in rounds: a pattern's score for a
kind is the confidence of its instances over their number plus one (and 0 with fewer than SUPPORT distinct believed
values; at HIGH = 0.8 it takes four seeds and no other instance); a token's confidence is the noisy-or of its patterns'
scores. Seeds are believed from the start, tokens of a confidence of at least HIGH from the next round on, so that they
bring in patterns of their own. Patterns of at least HIGH after the last round discover tokens of that kind that no base
pattern knows. Base spans always stay.

Whole texts; null is empty. Repeated rows count once in a pattern's support, ties need no order. Discovered tokens never
overlap base spans of their document. Patterns are broadcast while there are at most MOST_PATTERNS (checked); beyond it
the same rows come from joins by pattern and by row.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, extended_schema, lean, replaced, saved, slices, values

KINDS = ("email", "ip", "card", "phone")
ROUNDS, SUPPORT, HIGH, SMALL = 3, 3, 0.8, 1e-9
REACH = 200
MOST_PATTERNS = 1_000_000
_KEY, _MORE = "__hourloom_key", "__hourloom_more"
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of these always ends with its run of digits, so that a start within a run never matches on its own.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_WORD = re.compile(r"\S+")
_EDGE = "\"'.,;:!?()[]{}<>"


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > end and (c := text[lo - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            lo -= 1
        if lo < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield lo, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    odd = digits[::-1]
    return (sum(map(int, odd[::2])) + sum(sum(divmod(2 * int(c), 10)) for c in odd[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) by kind, then start."""
    if not _MARK.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := re.sub(r"[ -]", "", m[0])) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def _normal(word: str) -> str:
    return re.sub(r"[0-9]", "0", word.strip(_EDGE).lower())[:64]


def _around(text: str, a: int, b: int) -> list[str]:
    """The lexical patterns of text[a:b], of the words that lie whole within REACH characters of it."""
    lo, hi = max(0, a - REACH), b + REACH
    left, right = _WORD.findall(text[lo:a]), _WORD.findall(text[b:hi])
    if left and lo and not (text[lo - 1].isspace() or text[lo].isspace()):
        left = left[1:]
    if right and hi < len(text) and not (text[hi - 1].isspace() or text[hi].isspace()):
        right = right[:-1]
    left = [w for w in map(_normal, left[-2:]) if w]
    right = [w for w in map(_normal, right[:2]) if w]
    out = []
    if len(left) == 2:
        out.append(f"{left[0]} {left[1]} _")
    if len(right) == 2:
        out.append(f"_ {right[0]} {right[1]}")
    if left and right:
        out.append(f"{left[-1]} _ {right[0]}")
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens with a digit or @ and at least five letters or digits, without outer punctuation, clear of base spans."""
    out, end = [], 0
    for m in _MARK.finditer(text):
        if m.start() < end:
            continue
        lo = m.start()
        while lo > end and not text[lo - 1].isspace():
            lo -= 1
        gap = _SPACE.search(text, m.start())
        end = gap.start() if gap else len(text)
        token = text[lo:end]
        a = lo + len(token) - len(token.lstrip(_EDGE))
        b = lo + len(token.rstrip(_EDGE))
        if b - a >= 5 and sum(map(str.isalnum, text[a:b])) >= 5 and not any(a < y and x < b for _, x, y in base):
            out.append((a, b))
    return out


@lean
def _instances(batches):
    """A row per instance: its value's hash, the seed's kind (null for a candidate), its patterns, and where it is."""
    for batch in slices(batches):
        keys, kinds, vals, pats, los, his = [], [], [], [], [], []
        for key, text in zip(values(batch, "_key"), values(batch, "text"), strict=True):
            base = base_spans(text) if text else []
            for kind, a, b in base + [(None, a, b) for a, b in candidates(text, base)] if text else ():
                keys.append(key)
                kinds.append(kind)
                vals.append(hashlib.md5(text[a:b].encode("utf-8", "surrogatepass")).hexdigest())
                pats.append(_around(text, a, b))
                los.append(a)
                his.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(kinds, pa.int32()), pa.array(vals, pa.string()), pa.array(pats, pa.list_(pa.string())), pa.array(los, pa.int64()), pa.array(his, pa.int64())], names=["_key", "kind", "value", "patterns", "lo", "hi"])


_INSTANCE = "_key long, kind int, value string, patterns array<string>, lo long, hi long"


def learned_patterns(docs: DataFrame, instances: DataFrame | None = None) -> DataFrame:
    """(pattern, kind, score) of the high-confidence patterns."""
    if instances is None:
        instances = saved(docs.select(F.lit(0).cast("long").alias("_key"), F.col("text").cast("string").alias("text")).mapInArrow(_instances, _INSTANCE))
    links = saved(instances.select("value", "kind", F.explode(F.array_distinct("patterns")).alias("pattern")).distinct())
    seeds = links.where("kind is not null").select("value", "pattern", F.col("kind").alias("for_kind"))
    believed, conf = seeds, None
    for turn in range(ROUNDS):
        # A pattern that fewer than SUPPORT believed values back cannot score; the graph of a round is cut to the rest.
        backed = believed.groupBy("pattern", "for_kind").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT).drop("n")
        graph = saved(links.join(backed, "pattern"))
        # A seed counts for its kind only, a candidate by its confidence in the kind.
        weighed = graph.withColumn("conf", F.when(F.col("kind") == F.col("for_kind"), 1.0).otherwise(0.0))
        if conf is not None:
            weighed = weighed.join(conf, ["value", "for_kind"], "left").withColumn("conf", F.when(F.col("kind").isNull(), F.coalesce("c", F.lit(0.0))).otherwise(F.col("conf")))
        scores = saved(weighed.groupBy("pattern", "for_kind").agg((F.sum("conf") / (F.count("*") + 1)).alias("score")))
        if turn + 1 < ROUNDS:
            conf = saved(graph.where("kind is null").join(scores, ["pattern", "for_kind"]).groupBy("value", "for_kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("score") + F.lit(SMALL))))).alias("c")))
            found = links.where("kind is null").join(conf.where(F.col("c") >= HIGH - 2 * SMALL), "value").select("value", "pattern", "for_kind")
            believed = seeds.unionByName(found).distinct()
    return scores.where(F.col("score") >= HIGH).select("pattern", F.col("for_kind").alias("kind"), "score")


def _found(text: str | None, known: dict[str, int]) -> tuple[list, list]:
    """Base spans and discovered spans."""
    if not text:
        return [], []
    base = base_spans(text)
    if not known or not _MARK.search(text):
        return base, []
    more = []
    for a, b in candidates(text, base):
        kinds = [known[p] for p in _around(text, a, b) if p in known]
        if kinds:
            more.append((min(kinds, key=lambda k: (-kinds.count(k), k)), a, b))
    return base, more


def _told(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_PII = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_discovered bigint"


def _columns(found: list[tuple[list, list]]) -> dict:
    counts = {f"n_{kind}": ([sum(s[0] == i for s in base) for base, _ in found], pa.int64()) for i, kind in enumerate(KINDS)}
    return counts | {"base_sha256": ([hashlib.sha256(_told(base).encode()).hexdigest() for base, _ in found], pa.string()), "spans": ([_told(base + more) for base, more in found], pa.string()), "n_discovered": ([len(more) for _, more in found], pa.int64())}


def _annotated(docs: DataFrame, most_patterns: int, emit, schema) -> DataFrame:
    """emit(batch of docs, base and discovered spans of its rows) over all rows."""
    spark = docs.sparkSession
    patterns = saved(learned_patterns(docs))
    if patterns.count() <= most_patterns:
        best: dict[str, tuple] = {}
        for r in patterns.collect():
            best[r.pattern] = max(best.get(r.pattern, (-1.0, 0)), (r.score, -r.kind))
        known = spark.sparkContext.broadcast({p: -k for p, (_, k) in best.items()})

        @lean
        def run(batches):
            for batch in slices(batches):
                yield emit(batch, [_found(t, known.value) for t in values(batch, "text")])

        return docs.mapInArrow(run, schema)
    rows = saved(docs.withColumn(_KEY, F.monotonically_increasing_id()))
    places = saved(rows.select(F.col(_KEY).alias("_key"), "text").mapInArrow(_instances, _INSTANCE)).where("kind is null")
    best = patterns.groupBy("pattern").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))
    votes = places.select("_key", "lo", "hi", F.explode("patterns").alias("pattern")).join(best, "pattern").groupBy("_key", "lo", "hi", "kind").count()
    more = votes.groupBy("_key", "lo", "hi").agg(F.max_by("kind", F.struct("count", -F.col("kind"))).alias("kind")).groupBy("_key").agg(F.collect_list(F.struct("kind", "lo", "hi")).alias(_MORE)).withColumnRenamed("_key", _KEY)

    def rest(batches):
        for batch in slices(batches):
            found = [(base_spans(t) if t else [], [(m["kind"], m["lo"], m["hi"]) for m in more or ()]) for t, more in zip(values(batch, "text"), values(batch, _MORE), strict=True)]
            yield emit(batch.drop_columns([_KEY, _MORE]), found)

    return rows.join(more, _KEY, "left").mapInArrow(rest, schema)


def find_pii(docs: DataFrame, most_patterns: int = MOST_PATTERNS) -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone, base_sha256, spans, n_discovered; older columns of these names give way."""
    return _annotated(docs, most_patterns, lambda batch, found: extended(batch, _columns(found)), extended_schema(docs, _PII))


def pii_spans(docs: DataFrame) -> DataFrame:
    """The digest of every row: doc_id, counts, base_sha256, spans, n_discovered."""
    return find_pii(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))).drop("text")


def redact(docs: DataFrame, size_col: str | None = "n_chars", most_patterns: int = MOST_PATTERNS) -> DataFrame:
    """docs with every found span replaced by its kind in brackets (overlapping spans by the first); size_col, if docs
    has it, is the new length in code points. Other columns are kept as they are, whatever their names."""

    names = docs.columns

    def emit(batch, found):
        texts = []
        for text, (base, more) in zip(values(batch, "text"), found, strict=True):
            out, at = [], 0
            for a, b, kind in sorted((a, b, kind) for kind, a, b in base + more):
                if a >= at:
                    out += [text[at:a], f"[{KINDS[kind].upper()}]"]
                at = max(at, b)
            texts.append("".join([*out, text[at:]]) if out else text)
        sizes = {size_col: [None if t is None else len(t) for t in texts]} if size_col in names else {}
        return replaced(batch, {"text": texts, **sizes})

    return _annotated(docs, most_patterns, emit, docs.schema)
