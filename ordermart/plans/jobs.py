"""User-level jobs with explicit locations: clean, analytics, forecast.

Each job is one Spark application step, like the reference's scripts, but every
location is a parameter and every run appends a ``pipeline_runs`` row:

    run_clean(spark, feeds_root, out_root)        -> processed fact (+ JSON-lines export)
    run_analytics(spark, processed_path, out_root) -> six marts
    run_forecast(spark, seller_monthly_path, out_root) -> model, predictions, metrics

Intermediate tables (deduplicated orders, the seller x month aggregate) go to the
shared scratch folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermart import schemas
from ordermart.config import REFERENCE, Params
from ordermart.functions import category_bucket, product_bucket
from ordermart.operators import cleaning as C
from ordermart.operators import forecast as M
from ordermart.plans.analytics import MART_NAMES, write_marts
from ordermart.plans.clean import OrderPipeline
from ordermart.session import delete_path, own_session, scratch_path, size_shuffles_for
from ordermart.sources import tables as TB
from ordermart.sources import text as TX


def _log(spark: SparkSession, log_path: str | None, step: str, status: str, rows_in: int, rows_out: int,
         seconds: float) -> None:
    if log_path:
        TB.append_log(spark, log_path, [{"step": step, "status": status, "rows_in": int(rows_in),
                                         "rows_out": int(rows_out), "duration_seconds": round(seconds, 2)}],
                      schemas.PIPELINE_RUNS)


def run_clean(spark: SparkSession, feeds_root: str, out_root: str, params: Params = REFERENCE,
              jsonl_export: bool = True, log_path: str | None = None,
              size_shuffles: bool = True, quarantine: bool = True) -> dict:
    """feeds (``source=app/``, ``source=web/``) -> ``out_root/processed`` (by data_source).

    ``size_shuffles`` raises the shuffle partition count to the measured feed size first, so
    the dedup shuffle of a very large feed does not run with too few, oversized partitions.  The job
    runs in a session of its own: the caller's settings stay as they are, for other threads, too.
    """
    started = time.time()
    caller, spark = spark, own_session(spark)
    if size_shuffles:
        size_shuffles_for(spark, feeds_root)
    # a tag of its own: a run reads its feeds anew, whatever earlier runs left
    pipe = OrderPipeline(spark, "", params, feeds_root=feeds_root, run_tag=uuid.uuid4().hex)
    rows_in = rows_out = 0
    try:
        pipe.valid_table()
        rows_in = pipe.stage_counts.get("rows_in", 0)
        seen = Observation()
        final = pipe.final().observe(seen, F.count(F.lit(1)).alias("rows"))
        processed = f"{out_root.rstrip('/')}/processed"
        C.cluster_for_write(final).write.mode("overwrite").partitionBy("data_source").parquet(processed)
        rows_out = seen.get["rows"]
        out = {"processed": processed, "bounds": pipe.bounds(), "rows_in": rows_in, "rows_out": rows_out}
        if quarantine:              # broken feed lines, as they were read
            out["quarantine"] = TX.write_jsonl(C.malformed_lines(pipe.app_lines(), pipe.web_lines()),
                                               f"{out_root.rstrip('/')}/quarantine")
            out["malformed"] = {r.data_source: r.n for r in TX.read_jsonl(spark, out["quarantine"], schemas.MALFORMED)
                                .groupBy("data_source").agg(F.count("line").alias("n")).collect()}
        if jsonl_export:
            out["jsonl"] = TX.write_jsonl(spark.read.parquet(processed),
                                          f"{out_root.rstrip('/')}/processed_jsonl")
        _log(caller, log_path, "clean", "success", rows_in, rows_out, time.time() - started)
        return out
    except Exception:
        _log(caller, log_path, "clean", "failed", rows_in, rows_out, time.time() - started)
        raise
    finally:
        for path in (pipe.valid_path, f"{pipe.valid_path}_bounds"):
            delete_path(spark, path)


def sales_frame(spark: SparkSession, processed_path: str) -> DataFrame:
    df = spark.read.schema(schemas.PROCESSED).parquet(processed_path).select(*schemas.PROCESSED_COLUMNS)
    return (df.withColumn("category", category_bucket(F.col("seller_id")))
              .withColumn("product_id", product_bucket(F.col("order_id"))))


# serving-table verbs per mart, as the reference's serving layer applies them
SERVING_UPSERT_KEYS = {"monthly_trend": ["year_month"], "seller_monthly": ["seller_id", "year_month"]}
SERVING_REPLACE = ("revenue_by_category", "top_products", "kpi_summary", "seller_alerts")


def publish_serving(spark: SparkSession, mart_paths: dict, serving_root: str) -> dict:
    """Marts -> serving tables: truncate-insert for four, upsert of the touched months for two."""
    out = {}
    for name in SERVING_REPLACE:
        out[name] = f"{serving_root.rstrip('/')}/{name}"
        TB.replace_table(spark.read.parquet(mart_paths[name]), out[name])
    for name, keys in SERVING_UPSERT_KEYS.items():
        out[name] = f"{serving_root.rstrip('/')}/{name}"
        TB.upsert_table(spark.read.parquet(mart_paths[name]), out[name], keys, "year_month")
    return out


def run_analytics(spark: SparkSession, processed_path: str, out_root: str, params: Params = REFERENCE,
                  scratch: str | None = None, log_path: str | None = None,
                  serving_root: str | None = None) -> dict:
    """Six marts under ``out_root/<mart>`` from three scans of the fact; with ``serving_root``
    also the serving tables (truncate-insert / upsert)."""
    started = time.time()
    root = out_root.rstrip("/")
    try:
        sales = sales_frame(spark, processed_path)
        cube_path = scratch or scratch_path(spark, "cube", uuid.uuid4().hex)
        write_marts(spark, sales, root, params, cube_path=cube_path)
        cube = spark.read.parquet(cube_path)
        counts = {n: spark.read.parquet(f"{root}/{n}").count() for n in MART_NAMES}
        rows_in = int(cube.agg(F.sum("n_completed_rows")).first()[0] or 0)
        paths = {n: f"{root}/{n}" for n in MART_NAMES}
        serving = publish_serving(spark, paths, serving_root) if serving_root else {}
        if not scratch:
            delete_path(spark, cube_path)
        _log(spark, log_path, "analytics", "success", rows_in, sum(counts.values()), time.time() - started)
        return {"paths": paths, "rows": counts, "serving": serving}
    except Exception:
        _log(spark, log_path, "analytics", "failed", 0, 0, time.time() - started)
        raise


def run_forecast(spark: SparkSession, seller_monthly_path: str, out_root: str, params: Params = REFERENCE,
                 log_path: str | None = None, metrics_log: str | None = None, single_csv: bool = False) -> dict:
    """Fit, evaluate, save the model, write predictions (Parquet and CSV, in parallel unless
    ``single_csv``) and metrics."""
    started = time.time()
    root = out_root.rstrip("/")
    try:
        features = M.feature_frame(spark.read.parquet(seller_monthly_path))
        run = M.fit_forecast(features, params.forecast)
        preds = M.seller_predictions(run)
        preds.write.mode("overwrite").parquet(f"{root}/predictions")
        TX.write_csv(spark.read.parquet(f"{root}/predictions"), f"{root}/predictions_csv", single_file=single_csv)
        M.save_model(run.model, f"{root}/model")
        metrics = M.model_metrics_row(M.forecast_metrics(run))
        metrics.write.mode("append").parquet(metrics_log or f"{root}/model_metrics")
        row = spark.read.parquet(metrics_log or f"{root}/model_metrics").orderBy(F.desc("run_at")).first()
        _log(spark, log_path, "train", "success", row["n_train"] + row["n_test"], row["n_test"],
             time.time() - started)
        return {"model": f"{root}/model", "predictions": f"{root}/predictions", "metrics": row.asDict()}
    except Exception:
        _log(spark, log_path, "train", "failed", 0, 0, time.time() - started)
        raise


def run_benchmark(spark: SparkSession, processed_path: str, out_root: str, runs: int = 3,
                  jsonl_path: str | None = None) -> dict:
    """Time the three SQL-text tasks (and, given the JSON-lines export, the line-oriented
    ones) over a processed table; append benchmark_results rows and write the report."""
    from ordermart.operators import text_tasks as T
    from ordermart.plans import benchmark as B
    from ordermart.plans.sql_tasks import SQL_TASKS, register_view, run_sql_task
    root = out_root.rstrip("/")
    view = register_view(sales_frame(spark, processed_path), "sales")
    timings = [B.timed(spark, key, lambda k=key: B.noop(run_sql_task(spark, k, view)), runs)
               for key in SQL_TASKS]
    if jsonl_path:
        def guarded():
            lines = TX.read_jsonl(spark, jsonl_path, T.EXPORT_FIELDS, mode="DROPMALFORMED")
            return T.guarded_records(lines)
        line_tasks = {"mr_category_sum": lambda: T.category_sum(guarded()),
                      "mr_month_sum_count": lambda: T.month_sum_count(guarded()),
                      "mr_ranked_products": lambda: T.ranked_products(T.product_count(guarded()))}
        timings += [B.timed(spark, key, lambda f=fn: B.noop(f()), runs) for key, fn in line_tasks.items()]
    B.append_benchmark_rows(spark, f"{root}/benchmark_results", timings)
    rows = B.benchmark_rows(spark, timings)
    TX.write_csv(B.report(rows), f"{root}/benchmark_report", single_file=True)
    return {t.key: {"min": t.min, "mean": t.mean, "jobs": t.jobs} for t in timings}
