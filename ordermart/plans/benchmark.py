"""Timing harness pieces: timed runs with measured job counts, benchmark_results rows, report.

Each timed run writes the full result to the ``noop`` sink.  The number of Spark jobs a
task starts is measured (job group + status tracker) instead of being a constant.
"""

from __future__ import annotations

import statistics
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart import schemas
from ordermart.sources.tables import append_log

# task key -> (task, engine): the SQL-text tasks and their line-oriented counterparts
TASKS = {
    "sql_revenue_by_category": ("revenue_by_category", "spark_sql"),
    "sql_monthly_orders": ("monthly_trend", "spark_sql"),
    "sql_top_products": ("top_products", "spark_sql"),
    "mr_category_sum": ("revenue_by_category", "spark_lines"),
    "mr_month_sum_count": ("monthly_trend", "spark_lines"),
    "mr_ranked_products": ("top_products", "spark_lines"),
}


@dataclass
class Timing:
    key: str
    seconds: list[float]
    jobs: int

    @property
    def min(self) -> float:
        return min(self.seconds)

    @property
    def mean(self) -> float:
        return statistics.mean(self.seconds)


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(spark: SparkSession, key: str, run, runs: int = 3, warmup: bool = True) -> Timing:
    """Run ``run()`` (builds and materialises one result) ``runs`` times; count its jobs once."""
    sc = spark.sparkContext
    if warmup:
        run()
    group = f"bench-{key}-{uuid.uuid4().hex[:8]}"
    sc.setJobGroup(group, key)
    secs = []
    try:
        for i in range(runs):
            t0 = time.perf_counter()
            run()
            secs.append(time.perf_counter() - t0)
            if i == 0:
                jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return Timing(key, secs, jobs)


def benchmark_rows(spark: SparkSession, timings: list[Timing]) -> DataFrame:
    """benchmark_results rows: one per (task, engine); failed runs (< 0 s) are skipped."""
    rows = []
    for t in timings:
        if t.key not in TASKS or t.min < 0:
            continue
        task, engine = TASKS[t.key]
        rows.append({"task": task, "engine": engine, "avg_seconds": round(t.mean, 3),
                     "min_seconds": round(t.min, 3), "n_jobs": t.jobs, "n_hdfs_writes": 0,
                     "runs": len(t.seconds), "created_at": None})
    import datetime as dt
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    data = [tuple(now if f.name == "created_at" else r[f.name] for f in schemas.BENCHMARK_RESULTS.fields)
            for r in rows]
    return spark.createDataFrame(data, schemas.BENCHMARK_RESULTS)


def append_benchmark_rows(spark: SparkSession, path: str, timings: list[Timing]) -> None:
    rows = benchmark_rows(spark, timings)
    rows.write.mode("append").parquet(path)


def report(results: DataFrame) -> DataFrame:
    """key,value lines: totals per engine, speedup (lines / SQL, -1 unless both > 0), per task."""
    per = results.select("engine", "task", F.col("min_seconds").alias("s"))
    totals = per.groupBy().pivot("engine", ["spark_lines", "spark_sql"]).agg(F.sum("s"))
    lines, sql = F.coalesce(F.col("spark_lines"), F.lit(0.0)), F.coalesce(F.col("spark_sql"), F.lit(0.0))
    head = totals.select(F.explode(F.array(
        F.struct(F.lit("lines_total_sec").alias("key"), lines.alias("value")),
        F.struct(F.lit("sql_total_sec").alias("key"), sql.alias("value")),
        F.struct(F.lit("speedup_ratio").alias("key"),
                 F.when((lines > 0) & (sql > 0), lines / sql).otherwise(F.lit(-1.0)).alias("value")))).alias("r"))
    tasks = per.select(F.concat_ws("_", "engine", "task").alias("key"), F.col("s").alias("value"))
    return head.select("r.*").unionByName(tasks).withColumn("value", F.format_string("%.2f", "value"))


__all__ = ["TASKS", "Timing", "timed", "noop", "benchmark_rows", "append_benchmark_rows", "report",
           "append_log"]
