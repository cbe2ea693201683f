"""Exact top-k of counts without shuffling every key.

Each task counts its own rows; the lists stay where they are.  Then three small rounds: the heads of
the lists give a count that the k-th best reaches at least; entries below an m-th of it (m lists) can
be left out, since a key that is below it everywhere cannot be among the best; of the others, those
whose upper bound reaches the k-th best lower bound are counted exactly.  On a skewed distribution a
few keys of each list are moved, and never more than all of them (keys whose counts are all alike).
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.operators.joins import broadcast_if_small
from ordermart.session import scratch_path

LIST_KEYS = 1_000_000        # keys a task holds at once; more make a further list


def local_counts(rows: DataFrame, key: str) -> DataFrame:
    """(list, key, n): the counts of each task's rows, in lists of at most ``LIST_KEYS`` keys; NULL keys
    are left out."""
    def run(batches):
        counts, number = Counter(), TaskContext.get().partitionId() << 32

        def out():
            return pa.RecordBatch.from_arrays([pa.array([number] * len(counts), pa.int64()), pa.array(counts.keys(), pa.string()),
                                               pa.array(counts.values(), pa.int64())], names=["list", "key", "n"])
        for batch in batches:
            counts.update(k for k in batch.column(0).to_pylist() if k is not None)
            if len(counts) >= LIST_KEYS:
                yield out()
                counts, number = Counter(), number + 1
        if counts:
            yield out()
    return rows.select(F.col(key).cast("string")).mapInArrow(run, "list long, key string, n long")


def top_counts(rows: DataFrame, key: str, k: int, moved: dict | None = None) -> DataFrame:
    """(key, n) of the ``k`` most frequent values of ``key``, ties to the smaller key.  ``moved``
    (optional) receives how many list entries each round shuffles."""
    spark = rows.sparkSession
    path = scratch_path(spark, "lists", uuid.uuid4().hex)
    local_counts(rows, key).write.parquet(path)
    lists = spark.read.schema("list long, key string, n long").parquet(path)
    best = [F.col("n").desc(), F.col("key").asc()]

    def kth(df: DataFrame) -> int:
        top = [r.n for r in df.orderBy(F.desc("n")).limit(k).collect()]
        return top[-1] if len(top) == k else 0

    m = lists.agg(F.count_distinct("list")).first()[0]
    place = F.row_number().over(Window.partitionBy("list").orderBy(*best))
    heads = lists.withColumn("place", place).where(F.col("place") <= k)
    reached = kth(heads.groupBy("key").agg(F.sum("n").alias("n")))
    least = max(1, -(-reached // max(1, m)))
    strong = lists.where(F.col("n") >= least)
    low = strong.groupBy("key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("seen"))
    line = kth(low)
    candidates = low.where(F.col("n") + (F.lit(m) - F.col("seen")) * (least - 1) >= line).select("key")
    counted = lists.join(broadcast_if_small(candidates, 1_000_000), "key", "left_semi")
    if moved is not None:
        moved.update(lists=lists.count(), heads=heads.count(), strong=strong.count(), candidates=counted.count())
    return counted.groupBy("key").agg(F.sum("n").alias("n")).orderBy(*best).limit(k)
