"""Explicit schemas: raw feeds, processed fact, marts and logs."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType, TimestampType,
)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


APP_FEED = _s(
    ("oid", StringType()), ("ts", StringType()), ("slr", StringType()), ("st", StringType()),
    ("usr", _s(("uid", StringType()), ("rgn", StringType()))),
    ("tot", StringType()),           # numbers are read as text and cast: quoted ones count, too
    ("items", ArrayType(_s(("pid", StringType()), ("q", IntegerType()),
                           ("p", DoubleType()), ("d", DoubleType())))),
    ("_dup", BooleanType()),
)

WEB_FEED = _s(
    ("order_id", StringType()), ("order_date", StringType()), ("seller_id", StringType()),
    ("status", StringType()), ("customer_id", StringType()), ("region", StringType()),
    ("total_amount", StringType()),
    ("metadata", _s(("source", StringType()), ("version", StringType()), ("_retry", BooleanType()))),
)

# lines of a feed that do not fit its schema
CORRUPT = "_corrupt_record"
FILE = "_feed_file"             # where a line stands
MALFORMED = _s(("data_source", StringType()), ("order_id", StringType()), ("line", StringType()), ("file", StringType()))

# canonical order row after parsing (before enrichment)
ORDER_COLUMNS = ("order_id", "seller_id", "status", "customer_id", "region",
                 "total_amount", "order_ts", "order_date", "data_source")

PROCESSED = _s(
    ("order_id", StringType()), ("seller_id", StringType()), ("status", StringType()),
    ("customer_id", StringType()), ("region", StringType()), ("total_amount", DoubleType()),
    ("order_ts", TimestampNTZType()), ("order_date", DateType()), ("seller_type", StringType()),
    ("year_month", StringType()), ("year", IntegerType()), ("month", IntegerType()),
    ("data_source", StringType()),
)
PROCESSED_COLUMNS = tuple(f.name for f in PROCESSED.fields)

REVENUE_BY_CATEGORY = _s(("category", StringType()), ("total_revenue", DoubleType()),
                         ("order_count", LongType()), ("avg_revenue", DoubleType()))
MONTHLY_TREND = _s(("year_month", StringType()), ("total_revenue", DoubleType()),
                   ("order_count", LongType()), ("mom_growth_pct", DoubleType()))
TOP_PRODUCTS = _s(("rank", IntegerType()), ("product_id", StringType()), ("product_name", StringType()),
                  ("order_count", LongType()), ("total_revenue", DoubleType()))
KPI_SUMMARY = _s(("metric_name", StringType()), ("metric_value", DoubleType()))
SELLER_ALERTS = _s(("seller_id", StringType()), ("year_month", StringType()), ("alert_type", StringType()),
                   ("prev_revenue", DoubleType()), ("curr_revenue", DoubleType()), ("drop_pct", DoubleType()))
SELLER_PREDICTIONS = _s(("seller_id", StringType()), ("year_month", StringType()),
                        ("actual_revenue", DoubleType()), ("predicted_revenue", DoubleType()))
MODEL_METRICS = _s(("rmse", DoubleType()), ("mae", DoubleType()), ("r2", DoubleType()),
                   ("train_rmse", DoubleType()), ("n_train", LongType()), ("n_test", LongType()),
                   ("feature_json", StringType()), ("run_at", TimestampType()))
BENCHMARK_RESULTS = _s(("task", StringType()), ("engine", StringType()), ("avg_seconds", DoubleType()),
                       ("min_seconds", DoubleType()), ("n_jobs", IntegerType()),
                       ("n_hdfs_writes", IntegerType()), ("runs", IntegerType()),
                       ("created_at", TimestampType()))
PIPELINE_RUNS = _s(("step", StringType()), ("status", StringType()), ("rows_in", LongType()),
                   ("rows_out", LongType()), ("duration_seconds", DoubleType()),
                   ("run_at", TimestampType()))

MART_SCHEMAS = {
    "revenue_by_category": REVENUE_BY_CATEGORY,
    "monthly_trend": MONTHLY_TREND,
    "top_products": TOP_PRODUCTS,
    "kpi_summary": KPI_SUMMARY,
    "seller_alerts": SELLER_ALERTS,
    "seller_predictions": SELLER_PREDICTIONS,
    "model_metrics": MODEL_METRICS,
    "benchmark_results": BENCHMARK_RESULTS,
    "pipeline_runs": PIPELINE_RUNS,
}
