"""Quality rules: surface counts, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word unigrams and bigrams are counted: one over trusted target texts,
one over the whole raw corpus.  A document's score is the mean over its n-grams (so length does not
count) of log p(target) - log p(raw).  Every document at or over the threshold is kept; nothing is
drawn at random.  The threshold is where ``KEEP`` of the trusted documents pass, less a margin.

Trusted are all documents labelled quality 1: a hash of the id deals each either to the target counts
(three quarters) or to the threshold, which has to be set on texts that the target has not seen.  The
raw counts cover every document.

Scale: two scans of the texts, of which the first is shuffled by id to meet the trusted ids, whose
number grows with the corpus; the second needs no labels.  Each task adds its n-grams into one table
of ``BUCKETS`` counts, the tables are added bucket by bucket with map-side aggregation, and 2 x
``BUCKETS`` numbers come to the driver, whatever the corpus holds.  The threshold is an exact quantile
of stored scores, found by histograms (``exact_quantiles``): no task holds them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import map_batches, stored
from ordermart.operators.quantiles import exact_quantiles

BUCKETS = 1 << 16
SMOOTHING = 1.0
KEEP = 0.999              # share of trusted documents over the threshold
MARGIN = 0.02
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50        # per cent of words in repeated windows
_BLOCK = 1 << 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACES = " \t\n\x0b\x0c\r"


class _Hashes(dict):
    """Word -> 64-bit hash; forgotten all at once when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def _blocks(data: bytes):
    """The words of ``data`` in lists of bounded total length, cut between words."""
    at = 0
    while at < len(data):
        end = min(len(data), at + _BLOCK)
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].split()
        at = end


def buckets_of(text: str | None, buckets: int = BUCKETS):
    """Arrays of the hash buckets of a text's word unigrams and bigrams (a few per long text)."""
    last = None
    for words in _blocks(text.encode("utf-8", "surrogatepass") if text else b""):
        if not words:
            continue
        h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
        pairs = h if last is None else np.concatenate(([last], h))
        both = np.concatenate((h, pairs[:-1] * np.uint64(3) + pairs[1:]))
        last = h[-1]
        yield ((both * _MIX) >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64)


def surface(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = [w for part in _blocks(text.encode("utf-8", "surrogatepass")) for w in part]
    spaces = sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    repeated = 0
    if len(words) >= 3:
        h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
        with np.errstate(over="ignore"):
            key = (h[:-2] * np.uint64(0xBF58476D1CE4E5B9) + h[1:-1]) * np.uint64(0x94D049BB133111EB) + h[2:]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(words), bool)
        for j in range(3):
            covered[j:len(key) + j] |= twice
        repeated = int(covered.sum())
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated


def count_ngrams(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Counts per bucket, over rows with ``trusted`` and over all rows of ``docs`` (text, trusted)."""
    def partial(batches):
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for text, trusted in zip(batch.column("text"), batch.column("trusted").to_pylist()):
                for b in buckets_of(text.as_py(), buckets):
                    n = np.bincount(b, minlength=0)
                    total[1, :len(n)] += n
                    if trusted:
                        total[0, :len(n)] += n
        seen = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[0, seen]), pa.array(total[1, seen])],
                                         names=["bucket", "target", "raw"])

    rows = (docs.select("text", "trusted").mapInArrow(partial, "bucket int, target long, raw long")
            .groupBy("bucket").agg(F.sum("target"), F.sum("raw")).collect())      # at most ``buckets`` rows
    out = np.zeros((2, buckets), np.int64)
    for b, target, raw in rows:
        out[:, b] = target, raw
    return out


def log_ratio(counts: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    p = (counts + smoothing) / (counts.sum(axis=1, keepdims=True) + smoothing * counts.shape[1])
    return np.log(p[0]) - np.log(p[1])


def measure(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` without ``text``, with the surface counts, base_failed and the score (0 without words)."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        counts = [surface(t) for t in texts]
        failed = [c[0] < LEAST_WORDS or 100 * c[4] > MOST_REPEATED * c[0] for c in counts]
        scores = []
        for t in texts:
            total, n = 0.0, 0
            for b in buckets_of(t, len(weights)):
                total, n = total + float(weights[b].sum()), n + len(b)
            scores.append(total / n if n else 0.0)
        keep = [i for i, c in enumerate(batch.schema.names) if c != "text"]
        return pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep] + [pa.array(c, pa.int64()) for c in zip(*counts)]
            + [pa.array(failed, pa.bool_()), pa.array(scores, pa.float64())],
            names=[batch.schema.names[i] for i in keep] + names + ["base_failed", "llr"])

    schema = docs.drop("text").select("*", *[F.lit(0).cast("long").alias(n) for n in names],
                                      F.lit(True).alias("base_failed"), F.lit(0.0).alias("llr")).schema
    return map_batches(docs, add, schema)


CALIBRATE = 4             # one of so many trusted documents sets the threshold, the others the target


def judge(docs: DataFrame, labels: DataFrame, keep: float = KEEP, margin: float = MARGIN) -> DataFrame:
    """doc_id, the five surface counts, base_failed, llr, threshold and kept, for every row.

    Null and empty texts have no words: they fail the base rules.  Labels with a null id or quality
    count as none; a document labelled twice is trusted if either label says so; repeated rows are
    counted and judged each on its own.  Without trusted documents the threshold keeps all that
    pass the base rules.
    """
    known = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    calibrates = F.pmod(F.xxhash64(F.lit(1), F.col("doc_id").cast("string")), F.lit(CALIBRATE)) == 0
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    target = known.where(~calibrates).withColumn("trusted", F.lit(True))
    rows = texts.join(target.hint("shuffle_hash"), "doc_id", "left")        # the same plan at any size, no sort of texts
    weights = log_ratio(count_ngrams(rows.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))))
    scored = stored(measure(texts, weights), "quality")
    held = scored.where("NOT base_failed").join(known.where(calibrates), "doc_id", "left_semi").select("llr")
    least = exact_quantiles(stored(held, "quality-held"), "llr", [1 - keep])[0]
    least = float("-inf") if least is None else least - margin
    return scored.withColumn("threshold", F.lit(least)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(least)))


def op4_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", "llr")
