"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: lower-cased words and their first 4 to 6 letters, with the
document's language left out.  The score is a logistic function of a bias, a weight per term and the
inner products of the latent vectors of each pair of its terms, so that two harmless terms together (a
group's name, an insult's half) can count as much as one bad one; the pairs are summed in time
proportional to the terms.

Training: on at most ``TRAIN_ROWS`` labelled documents (up to half of them toxic, by hash of the id),
over all terms that ``LEAST_DF`` of them hold, weighed by their evidence, by mini-batches of AdaGrad
with fixed order and seed.  The sample is bounded, so it is fitted on the driver; the model has ``BUCKETS`` x
(1 + ``FACTORS``) numbers at most, whatever the corpus holds.  Scoring is one scan
without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import held_out, learnable, map_batches, spare_name

BUCKETS = 1 << 18
FACTORS = 4
TRAIN_ROWS = 16_000
LEAST_DF = 3
CHI2 = 15.0
SHRINK = 300
EPOCHS = 12
BATCH = 64
RATE = 0.1
L2 = 1e-4
SEED = 99
CUTOFF = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_BLOCK = 1 << 20


class _Terms(dict):
    """Word -> buckets of its terms; forgotten all at once when full."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= 300_000:
            self.clear()
        terms = ["w" + word] + [f"p{word[:n]}" for n in (4, 5, 6) if len(word) > n]
        got = self[word] = tuple(xxhash.xxh64_intdigest(t) & (BUCKETS - 1) for t in terms)
        return got


_TERMS = _Terms()


def terms_of(text: str | None) -> np.ndarray:
    """The distinct term buckets of a whole text, in order."""
    found: set[str] = set()
    at, text = 0, text or ""
    while at < len(text):            # blocks that end after a non-letter, so that no word is cut
        end = min(len(text), at + _BLOCK)
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        found.update(_WORD.findall(text[at:end].lower()))
        at = end
    out: set[int] = set()
    for w in found:
        out.update(_TERMS[w])
    return np.array(sorted(out), np.int64)


@dataclass
class Machine:
    """Bias, and per known bucket (sorted) a weight and a latent vector."""
    bias: float
    buckets: np.ndarray
    weight: np.ndarray
    latent: np.ndarray

    def margin(self, terms: np.ndarray) -> float:
        if not len(self.buckets):
            return self.bias
        place = np.searchsorted(self.buckets, terms)
        place[place == len(self.buckets)] = 0
        place = place[self.buckets[place] == terms]
        v = self.latent[place]
        pairs = 0.5 * float(((v.sum(axis=0) ** 2) - (v ** 2).sum(axis=0)).sum())
        return self.bias + float(self.weight[place].sum()) + pairs

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(terms_of(text)), -30, 30))))


def _evidence(hits: np.ndarray, df: np.ndarray, bad: int, rows: int) -> np.ndarray:
    """Per term the value, over 0 to 1, with which it enters a document's sums.  It is 1 where the share
    of toxic documents alone differs clearly from the average (chi square ``CHI2``) and falls with its
    square; but at least df / (df + ``SHRINK``), as a neutral term may count in pairs.  So the many rare
    terms that only tell single training documents apart learn slowly, and no term is left out."""
    expect = df * bad / rows
    spread = np.maximum(expect * (1 - bad / rows) * (1 - df / rows), 1e-9)
    chi2 = np.maximum(np.abs(hits - expect) - 0.5, 0) ** 2 / spread
    return np.maximum(df / (df + SHRINK), np.minimum(chi2 / CHI2, 1) ** 2)


def train(rows: list[tuple[np.ndarray, int]]) -> Machine:
    """Fit on (term buckets, label 0/1) in the given order, over all terms that ``LEAST_DF`` of the
    documents hold; one class alone gives a constant score."""
    y = np.array([t for _, t in rows], np.float64)
    rate = min(max((y.mean() if len(y) else 0.0), 1e-3), 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    none = Machine(start, np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)))
    if not len(rows) or y.min() == y.max():
        return none
    df, hits = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for terms, label in rows:
        df[terms] += 1
        if label:
            hits[terms] += 1
    buckets = np.flatnonzero(df >= LEAST_DF)
    if not len(buckets):
        return none
    value = _evidence(hits[buckets], df[buckets], int(y.sum()), len(rows))
    at = np.full(BUCKETS, -1, np.int32)
    at[buckets] = np.arange(len(buckets))
    docs = [at[terms][at[terms] >= 0] for terms, _ in rows]
    rng = np.random.default_rng(SEED)
    bias, w = start, np.zeros(len(buckets))
    v = rng.normal(0, 0.01, (len(buckets), FACTORS))
    gb, gw, gv = 1.0, np.full(len(buckets), 1.0), np.full((len(buckets), FACTORS), 1.0)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            some = order[begin:begin + BATCH]
            size = np.array([len(docs[i]) for i in some])
            flat = np.concatenate([docs[i] for i in some])
            owner = np.repeat(np.arange(len(some)), size)
            x = value[flat]
            vf = v[flat] * x[:, None]
            sums = np.stack([np.bincount(owner, vf[:, f], minlength=len(some)) for f in range(FACTORS)], axis=1)
            squares = np.bincount(owner, (vf ** 2).sum(axis=1), minlength=len(some))
            z = bias + np.bincount(owner, w[flat] * x, minlength=len(some)) + 0.5 * ((sums ** 2).sum(axis=1) - squares)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
            used, local = np.unique(flat, return_inverse=True)
            dw = np.bincount(local, err[owner] * x, minlength=len(used)) + L2 * w[used]
            per = (err[owner] * x)[:, None] * (sums[owner] - vf)
            dv = np.stack([np.bincount(local, per[:, f], minlength=len(used)) for f in range(FACTORS)], axis=1) + L2 * v[used]
            db = err.sum()
            gw[used] += dw ** 2 * len(some) ** 2
            gv[used] += dv ** 2 * len(some) ** 2
            gb += db ** 2 * len(some) ** 2
            w[used] -= RATE * dw * len(some) / np.sqrt(gw[used])
            v[used] -= RATE * dv * len(some) / np.sqrt(gv[used])
            bias -= RATE * db * len(some) / np.sqrt(gb)
    return Machine(bias, buckets, w * value, v * value[:, None])


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """A machine from labelled documents whose id may be learned from.  Half of ``rows`` at most are
    toxic, the others not; each the smallest hashes of its ids.  A document with both labels counts
    as toxic; null labels and ids are left out.

    The bias is set back to the share of toxic documents among all labelled ones afterwards.
    """
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(learnable()))
    shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    picked = known.where("toxic = 1").orderBy(*order).limit(rows // 2).union(
        known.where("toxic = 0").orderBy(*order).limit(rows // 2))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")

    def terms(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [terms_of(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array([t.astype(np.int32) for t in found], pa.list_(pa.int32()))],
            names=["doc_id", "toxic", "terms"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    label = labels.schema["toxic"].dataType.simpleString()
    found = map_batches(texts, terms, f"doc_id {kind}, toxic {label}, terms array<int>")
    # repeated rows of one id: one of them
    found = found.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("terms").alias("terms")).orderBy(*order)
    sample = [(np.array(r["terms"], np.int32), int(r["toxic"])) for r in found.toLocalIterator()]
    machine = train(sample)
    seen, toxic = sum(shares.values()), shares.get(1, 0)
    mine = sum(t for _, t in sample)
    if 0 < mine < len(sample) and 0 < toxic < seen:
        machine.bias += float(np.log(toxic / (seen - toxic)) - np.log(mine / (len(sample) - mine)))
    return machine


def score(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` without ``text``, with a score from 0 to 1 per row.  Null, empty and wordless texts
    get the bias alone; repeated rows the same score each."""
    work = spare_name(docs.columns, "text_of")

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [i for i, c in enumerate(batch.schema.names) if c != work]
        scores = pa.array([machine.score(t) for t in batch.column(work).to_pylist()], pa.float64())
        return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [scores],
                                          names=[batch.schema.names[i] for i in keep] + [out])

    rows = docs.withColumn(work, F.col(text).cast("string")).drop(text)
    return map_batches(rows, add, rows.drop(work).withColumn(out, F.lit(0.0)).schema, column=work)


def op8_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    machine = learn(docs, labels)
    rows = score(docs.select("doc_id", "text", held_out().alias("held_out")), machine)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
