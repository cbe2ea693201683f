"""Target-distribution importance resampling by bit-sliced aggregation.

Runs of words are hashed into ``buckets`` counters.  A bucket's gain is the floored log ratio of its
smoothed share in the target texts and in the raw corpus; a document's weight is the sum of the gains
over its features.  The sum is taken on bit planes: a document's bucket counts become one plane of
``buckets`` bits for each binary digit of the counts, the gains become planes for each digit of the
positive and of the negative ones, and

    weight = sum over i, j of 2^(i + j) * (popcount(C_j & P_i) - popcount(C_j & N_i)),

exact in whole numbers.  Documents are then drawn by weight plus Gumbel noise that follows from a
seed and the doc_id, so that the draw is one without replacement and the same on every run.

Scale: one pass over the texts writes each document's bucket numbers (2 bytes a feature); the corpus
counts are summed from that table, each task sending at most one number a bucket; only ``buckets``
gains reach the driver.  Ranks come from one range-partitioned sort of (score, doc_id) rows numbered
within their partition, plus the partitions' sizes: no task sees all documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import map_batches, slices, spare_name, stored

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

#: Bytes of words: 0-9, a-z (A-Z become these) and all of multi-byte characters; the rest is a space.
_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
                    else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of ``text``, A-Z in lower case, as UTF-8 (none for null)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def feature_buckets(found: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each run of 1 to ``longest`` consecutive words, repeats included."""
    runs = [found] + [[b" ".join(found[i:i + n]) for i in range(len(found) - n + 1)] for n in range(2, longest + 1)]
    hashes = [np.fromiter(map(zlib.crc32, run), np.uint32, len(run)) for run in runs]
    return (np.concatenate(hashes) % np.uint32(buckets)).astype("<u2" if buckets <= 1 << 16 else "<u4")


def _bucket_type(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def bucketed(docs: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` without ``text``, with n_words, n_features and bucket_ids (packed numbers)."""
    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.schema.names.index(text)
        counts, totals, packed = [], [], []
        for t in batch.column(place).to_pylist():
            found = words(t)
            ids = feature_buckets(found, longest, buckets)
            counts.append(len(found))
            totals.append(len(ids))
            packed.append(np.sort(ids).tobytes())
        keep = [i for i in range(batch.num_columns) if i != place]
        return pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep] + [pa.array(counts, pa.int64()), pa.array(totals, pa.int64()),
                                               pa.array(packed, pa.binary())],
            names=[batch.schema.names[i] for i in keep] + ["n_words", "n_features", "bucket_ids"])
    schema = (docs.drop(text).withColumns({"n_words": F.lit(0).cast("long"), "n_features": F.lit(0).cast("long"),
                                           "bucket_ids": F.lit(None).cast("binary")})).schema
    return map_batches(docs, add, schema, column=text)


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all ``rows`` (bucket_ids); a task sends each bucket at most once."""
    kind = _bucket_type(buckets)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "bucket_ids", 4096, 4 << 20):
                data = b"".join(part.column("bucket_ids").to_pylist())
                total += np.bincount(np.frombuffer(data, kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())],
                                         names=["bucket", "n"])
    return rows.select("bucket_ids").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from (bucket, n) of the raw corpus and of the target: ``buckets`` rows."""
    spark = raw.sparkSession
    total = [float(df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]) + buckets for df in (raw, target)]
    one = F.lit(1.0)
    s = F.coalesce(F.col("s").cast("double"), F.lit(0.0)) + one
    t = F.coalesce(F.col("t").cast("double"), F.lit(0.0)) + one
    rows = (spark.range(buckets).select(F.col("id").alias("bucket"))
            .join(raw.select("bucket", F.col("n").alias("s")), "bucket", "left")
            .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
            .select("bucket", F.floor(F.lit(1000.0) * F.log(t * F.lit(total[0]) / (s * F.lit(total[1]))))
                    .cast("long").alias("gain")).collect())
    gains = np.zeros(buckets, np.int64)
    for r in rows:
        gains[r.bucket] = r.gain
    return gains


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    width = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, width))), axis=1, bitorder="little").view("<u8")


def gain_planes(gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of the positive and of the negative gains, and the signed power of two of each."""
    planes, powers = [np.zeros((0, len(gains)), bool)], []
    for sign in (1, -1):
        size = np.maximum(sign * gains, 0)
        digits = int(size.max(initial=0)).bit_length()
        planes.append((size[None, :] >> np.arange(digits)[:, None] & 1).astype(bool))
        powers += [sign << i for i in range(digits)]
    return _packed(np.concatenate(planes)), np.array(powers, np.int64)


def plane_weights(lengths: np.ndarray, ids: np.ndarray, planes: np.ndarray, powers: np.ndarray,
                  buckets: int) -> np.ndarray:
    """Exact weights of documents whose bucket numbers lie one after the other in ``ids``."""
    docs = len(lengths)
    cells, counts = np.unique(np.repeat(np.arange(docs, dtype=np.int64), lengths) * buckets + ids, return_counts=True)
    out = np.zeros(docs, np.int64)
    for j in range(int(counts.max(initial=0)).bit_length()):
        at = cells[counts >> j & 1 == 1]
        owners = np.unique(at // buckets)              # only documents with a bit in this plane
        bits = np.zeros((len(owners), buckets), bool)
        bits[np.searchsorted(owners, at // buckets), at % buckets] = True
        ones = np.bitwise_count(_packed(bits)[:, None, :] & planes[None, :, :]).sum(axis=2, dtype=np.int64)
        out[owners] += (ones @ powers) << j
    return out


def weighed(rows: DataFrame, gains: np.ndarray, out: str = "weight") -> DataFrame:
    """``rows`` (bucket_ids and others) with the weight in place of the bucket numbers."""
    buckets = len(gains)
    planes, powers = gain_planes(gains)
    kind = _bucket_type(buckets)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.schema.names.index("bucket_ids")
        data = batch.column(place).to_pylist()
        lengths = np.array([len(d) // kind.itemsize for d in data], np.int64)
        found = plane_weights(lengths, np.frombuffer(b"".join(data), kind).astype(np.int64), planes, powers, buckets)
        keep = [i for i in range(batch.num_columns) if i != place]
        return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(found, pa.int64())],
                                          names=[batch.schema.names[i] for i in keep] + [out])
    schema = rows.drop("bucket_ids").withColumn(out, F.lit(0).cast("long")).schema
    return map_batches(rows, add, schema, column="bucket_ids", rows=64, size=1 << 20)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(`seed:doc_id`) (null id: '')."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` (doc_id, n_words, score) with rank 1, 2, 3 ... for the floor(percent N / 100) highest
    scores of the N rows with at least ``least_words`` words; null for the others."""
    small = F.col("n_words") < least_words
    order = [small.asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    numbered = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    sizes = sorted((r.part, r.n, r.fit) for r in numbered.groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.count_if(~small).alias("fit")).collect())     # one row a partition
    drawn, before, base = percent * sum(r[2] for r in sizes) // 100, 0, []
    for k, n, _ in sizes:
        base.append((k, before))
        before += n
    starts = F.broadcast(rows.sparkSession.createDataFrame(base, "part long, before long"))
    rank = F.col("before") + F.col("place") - F.shiftleft(F.col("part"), 33) + 1
    return (numbered.withColumn("part", part).join(starts, "part")
            .withColumn("rank", F.when(rank <= drawn, rank)).drop("part", "before", "place"))


def importance(docs: DataFrame, target: DataFrame, text: str = "text", longest: int = LONGEST,
               buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT,
               least_words: int = LEAST_WORDS) -> DataFrame:
    """The columns of ``docs`` but ``text``, with n_words, n_features, weight, score and rank (all long).

    Null and empty texts have no words, weight 0, and are drawn never (unless ``least_words`` is 0).
    Repeated rows each count and rank on their own; equal scores go to the smaller doc_id, a null
    doc_id comes last among them and takes its noise from the empty string.  An empty target makes
    all target counts 0; no rows in: no rows out.  Columns named like an added one are refused.
    """
    added = {"n_words", "n_features", "bucket_ids", "weight", "score", "rank", "place", "part", "before"}
    if clash := added & {c.lower() for c in docs.columns if c != text}:
        raise ValueError(f"columns with names that the result needs: {sorted(clash)}")
    as_text = F.col(text).cast("string").alias(text)
    rows = stored(bucketed(docs.select(*[c for c in docs.columns if c != text], as_text), text, longest, buckets),
                  "buckets")
    wanted = bucketed(target.select(as_text), text, longest, buckets)
    gains = bucket_gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets), buckets)
    scored = weighed(rows, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return ranked(scored, percent, least_words)


def resample(docs: DataFrame, target: DataFrame, text: str = "text", **params) -> DataFrame:
    """The drawn rows of ``docs``, all their columns (any names) kept."""
    row = spare_name(docs.columns, "source_row")
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    light = whole.select("doc_id", F.col(text).alias("text"), row)
    drawn = importance(light, target.select(F.col(text).alias("text")), **params).where("rank is not null").select(row)
    return whole.join(drawn, row, "left_semi").select(docs.columns)


def op11_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return (importance(docs.select("doc_id", "text"), benchmark)
            .select("doc_id", "n_features", "weight", "score", "rank"))
