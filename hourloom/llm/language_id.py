"""Language identification: averaged hashed subword embeddings with a linear softmax.

Character 2- and 3-grams of the lower-cased whole text, anything between letters being one space, are hashed into BUCKETS; a text is the average of its buckets'
embeddings (shrunk a little for short texts), and a linear softmax on it gives the language. Embeddings and layer are
trained by stochastic gradient descent with numpy on a bounded sample of labelled rows: of every language the first rows
in the order of a hash of their id, up to PER_LANG and to an even share of SAMPLE_ROWS; of more languages than half of
SAMPLE_ROWS only the most frequent are learned, with two rows each (ties by name), so that the sample never holds more than
SAMPLE_ROWS rows. Only their bucket counts come to the driver, not their texts. A fifth of the sample is kept back to fit the
temperature (so that the score is a calibrated probability) and two limits of rejection:

* a score under the REJECT_QUANTILE of the kept back rows' (at most 1 / languages + REJECT_MOST);
* subwords that are foreign to the sample: a text's evidence is the sum over its subwords of log(share of the subword's bucket
  in the sample, smoothed, times BUCKETS), above 0 where the sample's languages explain the text better than chance does. A
  text is rejected where chance explains it 1 / REJECT_QUANTILE times better; where the kept back rows' evidence a subword has a
  REJECT_QUANTILE below 0, that is taken off first.

So at most about REJECT_QUANTILE of texts like the sample's are rejected by either limit. Other scripts, and strings of letters
unlike any learned language, fall under the second one; a language that shares most subwords with a learned one does not.

Prediction covers every row and whole texts. Text that is null or has no letter: `und`, score 0, rejected (letters are
Unicode's category L). The prediction of a rejected text is kept, with rejected = true. Without any labelled row
every prediction is `und`. Rows with equal texts get equal predictions; ties go to the first language by name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import extended, extended_schema, lean, masked, slices, values

BUCKETS, DIM, SHRINK = 4096, 16, 20
PER_LANG, SAMPLE_ROWS, LEAST_ROWS = 800, 12_800, 2
EPOCHS, BATCH, RATE = 40, 32, 0.3
REJECT_QUANTILE, REJECT_MOST = 0.001, 0.1
_OTHER = re.compile(r"[\W\d_]+")
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def subword_counts(text: str) -> np.ndarray:
    """Counts of the hashed 2- and 3-grams of the text's words, a space on either side of each."""
    c = np.frombuffer(f" {_OTHER.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    two = c[:-1] * _A + c[1:] * _B
    three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * _C + c[2:] * _A
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    return np.bincount((two * _C) >> shift, minlength=BUCKETS) + np.bincount((three * _B) >> shift, minlength=BUCKETS)


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # embeddings times the linear layer, over the temperature: BUCKETS x languages
    bias: np.ndarray
    threshold: float
    familiar: np.ndarray  # log of a bucket's smoothed share in the sample times BUCKETS
    least_known: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        z = counts @ self.table / (counts.sum(-1, keepdims=True) + SHRINK) + self.bias
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def foreign(self, counts: np.ndarray) -> bool:
        return bool(counts @ self.familiar < self.least_known * counts.sum() + np.log(REJECT_QUANTILE))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.langs or not has_letter(text):
            return "und", 0.0, True
        counts = subword_counts(text)
        p = self.scores(counts)
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] < self.threshold or self.foreign(counts))


def _packed(counts: np.ndarray) -> bytes:
    """Buckets and counts of those that occur: most texts hold a few hundred of them."""
    at = np.flatnonzero(counts)
    return np.concatenate([at, counts[at]]).astype(np.uint32).tobytes()


def _counted(batches):
    for batch in slices(batches):
        texts, langs, order = (values(batch, c) for c in ("text", "lang", "o"))
        rows = [(o, lang, _packed(subword_counts(t))) for o, lang, t in zip(order, langs, texts, strict=True) if has_letter(t)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.string(), pa.binary()))], names=["o", "lang", "counts"])


def sampled(docs: DataFrame) -> list[tuple[np.ndarray, str]]:
    """(packed bucket counts, lang) of the documented bounded sample of labelled rows."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("o", F.xxhash64(F.col("doc_id")))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE_ROWS // LEAST_ROWS).collect()  # a row per language
    if not counts:
        return []
    most = max(LEAST_ROWS, min(PER_LANG, SAMPLE_ROWS // len(counts)))
    # Somewhat more rows are let through, then cut by the same order.
    limits = [(r["lang"], min(int(-(2**63) + min(1.0, (1.3 * most + 20) / r["count"]) * 2**64), 2**63 - 1)) for r in counts]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, up_to long")
    near = rows.join(F.broadcast(limits), "lang").where("o <= up_to").select("o", "lang", "text")
    out, n = [], {}
    for r in sorted(near.mapInArrow(_counted, "o long, lang string, counts binary").collect(), key=lambda r: (r.o, r.lang, bytes(r.counts))):
        n[r.lang] = n.get(r.lang, 0) + 1
        if n[r.lang] <= most:
            out.append((np.frombuffer(r.counts, np.uint32), r.lang))
    return out


def _rows(packed: list[np.ndarray]) -> np.ndarray:
    """The counts of some rows of the sample, over all buckets."""
    out = np.zeros((len(packed), BUCKETS), np.uint32)
    for i, x in enumerate(packed):
        out[i, x[: len(x) // 2]] = x[len(x) // 2 :]
    return out


def _mean(counts: np.ndarray) -> np.ndarray:
    x = counts.astype(np.float32)
    return x / (x.sum(1, keepdims=True) + SHRINK)


def fit(rows: list[tuple[np.ndarray, str]], seed: int = 7) -> LanguageModel:
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, np.zeros(BUCKETS), 0.0)
    # Rows are opened a batch at a time: the whole sample over all buckets is hundreds of MB of the driver's memory.
    raw = [c for c, _ in rows]
    y = np.array([langs.index(lang) for _, lang in rows])
    held = np.arange(len(y)) % 5 == 4
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1, (BUCKETS, DIM)).astype(np.float32)
    lin, bias = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    train, yt = np.flatnonzero(~held), y[~held]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(yt))
        for lo in range(0, len(order), BATCH):
            i = order[lo : lo + BATCH]
            xt = _mean(_rows([raw[j] for j in train[i]]))
            mean = xt @ emb
            z = mean @ lin + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(i)), yt[i]] -= 1
            p /= len(i)
            back = xt.T @ (p @ lin.T)
            lin -= rate * (mean.T @ p)
            bias -= rate * p.sum(0)
            emb -= rate * 100 * back
    tried = [raw[j] for j in (np.flatnonzero(held) if held.any() else train)]
    parts = [_rows(tried[lo : lo + 256]) for lo in range(0, len(tried), 256)]
    z, t = np.concatenate([_mean(c) @ emb @ lin for c in parts]) + bias, y[held] if held.any() else y
    best, loss = 1.0, np.inf
    for temp in np.geomspace(0.05, 20, 60):
        q = z / temp
        nll = (np.log(np.exp(q - q.max(1, keepdims=True)).sum(1)) + q.max(1) - q[np.arange(len(t)), t]).mean()
        if nll < loss:
            best, loss = float(temp), nll
    q = np.exp(z / best - (z / best).max(1, keepdims=True))
    top = (q / q.sum(1, keepdims=True)).max(1)
    limit = min(float(np.quantile(top, REJECT_QUANTILE)), 1 / len(langs) + REJECT_MOST)
    seen = np.full(BUCKETS, 0.5)
    for j in train:
        half = len(raw[j]) // 2
        seen[raw[j][:half]] += raw[j][half:]
    familiar = np.log(seen / seen.sum() * BUCKETS)
    known = np.concatenate([c @ familiar / np.maximum(c.sum(1), 1) for c in parts])
    least_known = min(float(np.quantile(known, REJECT_QUANTILE)), 0.0)
    return LanguageModel(langs, (emb.astype(float) @ lin) / best, bias.astype(float) / best, limit, familiar, least_known)


def held_out_column() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs with lang_pred, score, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @lean
    def run(batches):
        for batch in slices(batches):
            got = [shared.value.predict(t) for t in values(batch, "text")]
            yield extended(batch, {"lang_pred": ([x[0] for x in got], pa.string()), "score": ([x[1] for x in got], pa.float64()), "rejected": ([x[2] for x in got], pa.bool_())})

    return docs.mapInArrow(run, extended_schema(docs, "lang_pred string, score double, rejected boolean"))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learns from rows whose crc32(doc_id) mod 5 is not 0."""
    model = fit(sampled(docs.where(~held_out_column()).select("doc_id", "text", "lang")))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out_column().alias("held_out"), "lang_pred", "score", "rejected")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """docs without the rows that the model rejects; all columns as they are, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(sampled(docs.where(~held_out_column()).select("doc_id", "text", "lang"))))

    @lean
    def run(batches):
        for batch in slices(batches):
            yield masked(batch, [not shared.value.predict(t)[2] for t in values(batch, "text")])

    return docs.mapInArrow(run, docs.schema)
