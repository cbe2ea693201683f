"""Global shuffle into shards by a two-pass external shuffle.

Pass 1 scatters the rows uniformly into buckets that fit in memory, by a seeded hash of the id and
the row's place (so repeated rows and a hot id spread as well).  Pass 2 loads one bucket at a time,
shuffles it with Fisher-Yates and writes it.  A row's position in the whole order is its bucket's
first position plus its place in the bucket; positions are dealt to the shards in turn, so the
shards' row counts differ by one at most (law ``rows``).

Scale: the texts cross the network once.  The number of buckets follows from the total bytes, so a
task's memory does not grow with the corpus.  A bucket's result depends only on its rows and the
seed: they are put in order of place first, so a bucket redone after a lost executor is the same.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import spare_name, stored

SHARDS = 8
SEED = 1234
BUCKET_BYTES = 16 << 20
BROADCAST_BUCKETS = 1_000_000      # bucket starts sent to all tasks: two numbers each


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform permutation of n places: swap each place, from the last on, with one up to it."""
    order = np.arange(n)
    rng = np.random.default_rng([seed, bucket])
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist()):
        order[i], order[j] = order[j], order[i]
    return order


def shuffled(docs: DataFrame, text: str = "text", shards: int = SHARDS, seed: int = SEED,
             bucket_bytes: int = BUCKET_BYTES, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """``docs`` with each row's shard (0 to ``shards`` - 1) and its slot there (gapless from 0).

    Null texts count as no bytes and are dealt like others, as are rows with a null id; repeated
    rows get slots of their own.  Fewer rows than shards leave shards empty; no rows in, no rows out.
    Other columns pass through (any names); a column that has one of the two new names is refused.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    if clash := {shard_col.lower(), slot_col.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns with names that the result needs: {sorted(clash)}")
    bucket, place, rank = (spare_name(docs.columns + [shard_col, slot_col], n) for n in ("bucket", "place", "rank"))
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + F.lit(1)
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    scattered = docs.withColumn(place, F.monotonically_increasing_id()).withColumn(
        bucket, F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col(place)), F.lit(buckets)).cast("int"))
    schema = scattered.drop(place).withColumn(rank, F.lit(0).cast("long")).schema

    def shuffle(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        order = pa.compute.sort_indices(rows.column(place)).to_numpy()
        order = order[fisher_yates(rows.num_rows, seed, rows.column(bucket)[0].as_py())]
        return rows.take(pa.array(order)).drop_columns([place]).append_column(
            rank, pa.array(np.arange(rows.num_rows), pa.int64()))

    written = stored(scattered.groupBy(bucket).applyInArrow(shuffle, schema), "shuffled")
    counts = written.groupBy(bucket).agg(F.count("*").alias("n"))          # a row per bucket
    before = F.sum("n").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(bucket, F.coalesce(before, F.lit(0)).alias("n"))
    if buckets <= BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    first = spare_name(docs.columns + [shard_col, slot_col, bucket, rank], "first")
    position = F.col(first) + F.col(rank)
    return (written.join(starts.withColumnRenamed("n", first), bucket)
            .select(*docs.columns, F.pmod(position, F.lit(shards)).cast("int").alias(shard_col),
                    F.floor(position / F.lit(shards)).cast("long").alias(slot_col)))


def write_shards(docs: DataFrame, path: str, shard_col: str = "shard", slot_col: str = "slot") -> None:
    """One folder per shard; every file of it holds slots in rising order."""
    docs.sortWithinPartitions(shard_col, slot_col).write.partitionBy(shard_col).parquet(path)


def op3_query(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return shuffled(docs.select("doc_id", "text")).select(
        "doc_id", (F.octet_length(text).cast("long") + F.lit(1)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
