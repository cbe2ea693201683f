"""Query catalog: every operator as ``(spark, sf_dir) -> DataFrame`` plus its DuckDB oracle.

Each query reads the driver tables (through the fixture feeds derived from ``orders``)
or tables Spark derived from them, over the whole input.  Keys follow the operator
inventory; keys without an oracle are model outputs or approximate sketches and get a
rows-only check.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ordermart import schemas
from ordermart.config import FIXTURE
from ordermart.constants import FEATURE_COLUMNS, LOWEST_TIER, N_SELLERS, TIER_LIMITS
from ordermart.functions import (
    category_bucket, money_sum, parse_wall_clock, product_name, ratio, round_half_up, strip_tz_suffix,
)
from ordermart.functions.status import normalize_status
from ordermart.operators import cleaning as C
from ordermart.operators import forecast as M
from ordermart.operators import marts as A
from ordermart.operators import text_tasks as T
from ordermart.operators import views as V
from ordermart.operators.quantiles import iqr_bounds, rank_errors
from ordermart.plans import oracle as O
from ordermart.plans.analytics import analytics
from ordermart.plans.clean import pipeline
from ordermart.plans.sql_tasks import SQL_TASKS, register_view, run_sql_task
from ordermart.session import committed, fingerprint, path_exists, scratch_path
from ordermart.sources import feeds
from ordermart.sources import tables as TB
from ordermart.sources import text as TX

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _p(spark: SparkSession, sf_dir: str):
    return pipeline(spark, sf_dir, FIXTURE)


def _a(spark: SparkSession, sf_dir: str):
    return analytics(_p(spark, sf_dir))


def _union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


W = O.with_chain
WM = O.with_marts

# --------------------------------------------------------------------------- step 1


@register("clean_orders", W("SELECT * FROM processed"))
def clean_orders(spark, sf_dir):
    """Flagship: feeds -> parse -> union -> dedup -> filters -> outliers -> enrich -> calendar."""
    return _p(spark, sf_dir).processed()


@register("parse_app_feed", W("SELECT * FROM app_rows"))
def parse_app_feed(spark, sf_dir):
    return _p(spark, sf_dir).parsed_app()


@register("parse_web_feed", W("SELECT * FROM web_rows"))
def parse_web_feed(spark, sf_dir):
    return _p(spark, sf_dir).parsed_web()


@register("nested_user_fields", W("SELECT order_id, customer_id, region FROM app_rows"))
def nested_user_fields(spark, sf_dir):
    return _p(spark, sf_dir).parsed_app().select("order_id", "customer_id", "region")


@register("drop_flagged_app", W("""SELECT order_id AS oid, date_diff('second', TIMESTAMP '1970-01-01', ts) AS ts,
    seller_id AS slr, st, amt AS tot FROM raw_app WHERE NOT flag"""))
def drop_flagged_app(spark, sf_dir):
    return C.drop_flagged_app(_p(spark, sf_dir).raw_app()).select(
        "oid", C.epoch_of(F.col("ts")).alias("ts"), "slr", "st", C.amount_of(F.col("tot")).alias("tot"))


_WEB_TEXT = ("strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN tz < 5 THEN '+07:00' "
             "WHEN tz < 7 THEN '+08:00' ELSE 'Z' END")


@register("drop_retry_web", W(f"""SELECT order_id, {_WEB_TEXT} AS order_date, seller_id, st AS status,
    cust AS customer_id, rgn AS region, amt AS total_amount FROM raw_web WHERE NOT flag"""))
def drop_retry_web(spark, sf_dir):
    return C.drop_retry_web(_p(spark, sf_dir).raw_web()).select(
        "order_id", "order_date", "seller_id", "status", "customer_id", "region",
        C.amount_of(F.col("total_amount")).alias("total_amount"))


@register("strip_tz_suffix", W(f"""SELECT order_id, {_WEB_TEXT} AS order_date_text,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stripped, ts AS order_ts FROM raw_web WHERE NOT flag"""))
def strip_tz_suffix_q(spark, sf_dir):
    raw = C.drop_retry_web(_p(spark, sf_dir).raw_web())
    stripped = strip_tz_suffix(F.col("order_date"))
    return raw.select("order_id", F.col("order_date").alias("order_date_text"),
                      stripped.alias("stripped"), parse_wall_clock(stripped).alias("order_ts"))


@register("normalize_status", W(f"""SELECT st AS raw_status, {O.status_case('st')} AS status,
    COUNT(*) AS n FROM raw WHERE NOT flag GROUP BY 1, 2"""))
def normalize_status_q(spark, sf_dir):
    p = _p(spark, sf_dir)
    raw = (C.drop_flagged_app(p.raw_app()).select(F.col("st").alias("raw_status"))
           .unionByName(C.drop_retry_web(p.raw_web()).select(F.col("status").alias("raw_status"))))
    return raw.groupBy("raw_status", normalize_status(F.col("raw_status")).alias("status")) \
              .agg(F.count(F.lit(1)).alias("n"))


@register("fill_unknown_customer", W("""SELECT data_source, COUNT(*) AS n_rows,
    COUNT(*) - COUNT(customer_id) AS n_null_customer,
    COUNT(CASE WHEN customer_id = 'UNKNOWN' THEN 1 END) AS n_unknown_customer
    FROM combined GROUP BY data_source"""))
def fill_unknown_customer(spark, sf_dir):
    return _p(spark, sf_dir).combined().groupBy("data_source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) - F.count("customer_id")).alias("n_null_customer"),
        F.count(F.when(F.col("customer_id") == "UNKNOWN", 1)).alias("n_unknown_customer"))


@register("union_sources", W("SELECT * FROM combined"))
def union_sources(spark, sf_dir):
    return _p(spark, sf_dir).combined()


@register("source_literal", W("SELECT data_source, COUNT(*) AS n_rows FROM combined GROUP BY data_source"))
def source_literal(spark, sf_dir):
    """Rows per constant ``data_source`` literal after the union."""
    return _p(spark, sf_dir).combined().groupBy("data_source").agg(F.count(F.lit(1)).alias("n_rows"))


@register("dedup_orders", W("SELECT * FROM deduped"))
def dedup_orders(spark, sf_dir):
    """One row per order id: amount present first, then the latest timestamp."""
    return _p(spark, sf_dir).deduped()


@register("valid_window_filter", W("SELECT * FROM valid"))
def valid_window_filter(spark, sf_dir):
    """Deduplicated orders inside the date window with a positive amount (P10)."""
    return _p(spark, sf_dir).valid()


_BOUNDS_SCHEMA = StructType([StructField(n, DoubleType(), True)
                             for n in ("q1", "q3", "iqr", "lower_bound", "upper_bound")])


def _bounds_frame(spark, b: dict) -> DataFrame:
    return spark.createDataFrame([(b["q1"], b["q3"], b["iqr"], b["lower"], b["upper"])], _BOUNDS_SCHEMA)


@register("iqr_bounds", W("SELECT q1, q3, iqr, lower_bound, upper_bound FROM bounds"))
def iqr_bounds_q(spark, sf_dir):
    """Exact quartiles by bounded-memory rank refinement (see operators.quantiles)."""
    return _bounds_frame(spark, _p(spark, sf_dir).bounds())


@register("iqr_bounds_approx", W(" UNION ALL ".join(
    f"SELECT '{m}' AS method, COUNT(*) AS n_values, TRUE AS q1_within, TRUE AS q3_within FROM valid WHERE total_amount > 0"
    for m in ("approx", "kll"))))
def iqr_bounds_approx(spark, sf_dir):
    """Quartiles by the reference's approxQuantile(0.01) and by a KLL sketch: whether the true ranks of
    the answers, counted over all values, lie within 1 % of the wanted ones (A9b)."""
    p = _p(spark, sf_dir)
    c, amount = p.params.clean, "total_amount"
    out = []
    for method in ("approx", "kll"):
        b = iqr_bounds(p.valid_table(), amount, c.iqr_factor, method, c.approx_relative_error)
        errors = rank_errors(p.valid_table().where(F.col(amount) > 0), amount, {0.25: b["q1"], 0.75: b["q3"]})
        out.append(errors.select(F.lit(method).alias("method"), F.col("n").alias("n_values"),
                                 (F.col("error0") <= 0.01).alias("q1_within"), (F.col("error1") <= 0.01).alias("q3_within")))
    return _union_all(out)


@register("outlier_filter", W("SELECT * FROM clean"))
def outlier_filter(spark, sf_dir):
    """Valid orders within the exact IQR x3 bounds (P11); bounds reach the scan as literals."""
    return _p(spark, sf_dir).clean()


@register("enrich_sellers", W("SELECT * FROM enriched"))
def enrich_sellers(spark, sf_dir):
    """Left join with the seller dimension (size-checked broadcast): tier, region fill."""
    return _p(spark, sf_dir).enriched()


@register("derive_calendar", W("SELECT order_id, order_date, year_month, year, month FROM processed"))
def derive_calendar(spark, sf_dir):
    return C.derive_calendar(_p(spark, sf_dir).enriched()).select(
        "order_id", "order_date", "year_month", "year", "month")


@register("stage_row_counts", W(" UNION ALL ".join(
    f"SELECT '{s}' AS stage, COUNT(*) AS n_rows FROM {t}" for s, t in (
        ("parsed_app", "app_rows"), ("parsed_web", "web_rows"), ("union", "combined"),
        ("dedup", "deduped"), ("window_filter", "valid"), ("outliers", "clean"),
        ("enriched", "enriched")))))
def stage_row_counts(spark, sf_dir):
    """Rows after each cleaning stage, all from one pass over the feeds."""
    return _p(spark, sf_dir).funnel()


@register("malformed_records", W(f"""SELECT src AS data_source, COUNT(CASE WHEN cp <> 2 THEN 1 END) AS n_sound,
    COUNT(CASE WHEN cp = 2 THEN 1 END) AS n_malformed, CAST(0 AS BIGINT) AS n_without_id,
    COUNT(CASE WHEN cp = 2 THEN 1 END) AS n_quarantined
    FROM (SELECT src, cp FROM copies UNION ALL SELECT src, 2 FROM b WHERE k % 250 = {feeds.BROKEN_TAG}) t GROUP BY src"""))
def malformed_records(spark, sf_dir):
    """Sound and broken lines of each feed, and the broken ones as the quarantine holds them."""
    p = _p(spark, sf_dir)
    path = scratch_path(spark, "quarantine", fingerprint(p.feeds_root))
    if not committed(spark, path):
        TX.write_jsonl(C.malformed_lines(p.app_lines(), p.web_lines()), path)
    kept = TX.read_jsonl(spark, path, schemas.MALFORMED).groupBy("data_source").agg(F.count("line").alias("n_quarantined"))
    return C.feed_quality(p.app_lines(), p.web_lines()).join(F.broadcast(kept), "data_source", "left").fillna(0, ["n_quarantined"])


# ------------------------------------------------------------------ sources / sinks


@register("scan_processed", W("SELECT * FROM processed"))
def scan_processed(spark, sf_dir):
    """Parquet scan of the written fact; ``data_source`` comes from partition discovery."""
    p = _p(spark, sf_dir)
    p.processed()
    return spark.read.parquet(p.processed_path)


@register("processed_by_source", W(f"""SELECT data_source, COUNT(*) AS n_rows,
    {O.msum('total_amount')} AS total_revenue, COUNT(DISTINCT seller_id) AS n_sellers
    FROM processed GROUP BY data_source"""))
def processed_by_source(spark, sf_dir):
    return _p(spark, sf_dir).processed().groupBy("data_source").agg(
        F.count(F.lit(1)).alias("n_rows"), money_sum("total_amount").alias("total_revenue"),
        F.count_distinct("seller_id").alias("n_sellers"))


def _export_path(spark, sf_dir) -> str:
    """JSON-lines copy of the processed fact (input of the line-oriented tasks)."""
    p = _p(spark, sf_dir)
    path = scratch_path(spark, "export_jsonl", fingerprint(p.processed_path))
    if not committed(spark, path):
        TX.write_jsonl(p.processed(), path)
    return path


@register("jsonl_roundtrip", W("SELECT * FROM processed"))
def jsonl_roundtrip(spark, sf_dir):
    return TX.read_jsonl(spark, _export_path(spark, sf_dir), schemas.PROCESSED)


def _task_lines(spark, sf_dir) -> DataFrame:
    """The lines that the line-oriented tasks read: the export, with records of an older layout that
    lack ``year_month`` and with broken lines in between."""
    path = scratch_path(spark, "task_lines", fingerprint(_p(spark, sf_dir).processed_path))
    if not committed(spark, path):
        TX.write_lines(T.older_layout(_p(spark, sf_dir).processed()), path)
    return TX.read_jsonl(spark, path, T.EXPORT_FIELDS, mode="DROPMALFORMED")


def _guarded(spark, sf_dir) -> DataFrame:
    return T.guarded_records(_task_lines(spark, sf_dir))


@register("mr_guard_filter", W("""SELECT order_id, seller_id, status, total_amount, year_month AS month_key
    FROM processed WHERE status = 'completed' AND total_amount > 0"""))
def mr_guard_filter(spark, sf_dir):
    return _guarded(spark, sf_dir)


@register("mr_category_sum", W(f"""SELECT {O.category_expr('seller_id')} AS category,
    {O.msum('total_amount')} AS total_revenue FROM processed
    WHERE status = 'completed' AND total_amount > 0 GROUP BY 1"""))
def mr_category_sum(spark, sf_dir):
    """Line-oriented task: completed revenue per category from the JSON-lines export."""
    return T.category_sum(_guarded(spark, sf_dir))


_MR_MONTH_SQL = f"""SELECT year_month, {O.msum('total_amount')} AS total_revenue, COUNT(*) AS order_count
    FROM processed WHERE status = 'completed' AND total_amount > 0 GROUP BY year_month"""


@register("mr_month_sum_count", W(_MR_MONTH_SQL))
def mr_month_sum_count(spark, sf_dir):
    """Line-oriented task: completed revenue and count per month key."""
    return T.month_sum_count(_guarded(spark, sf_dir))


@register("month_key_fallback", W("""SELECT year_month AS month_key, COUNT(*) AS n_records,
    COUNT(CASE WHEN CAST(order_id AS BIGINT) % 9 = 4 THEN 1 END) AS n_from_order_date FROM processed
    WHERE status = 'completed' AND total_amount > 0 GROUP BY year_month"""))
def month_key_fallback(spark, sf_dir):
    """Month key per guarded record: ``year_month``, else the first 7 characters of ``order_date``."""
    return (T.month_key_sources(_task_lines(spark, sf_dir)).groupBy("month_key")
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.count(F.when(F.col("from_order_date"), 1)).alias("n_from_order_date")))


_MR_PRODUCT_SQL = f"""SELECT {O.product_expr('order_id')} AS product_id, COUNT(*) AS order_count
    FROM processed WHERE status = 'completed' AND total_amount > 0 GROUP BY 1"""


@register("mr_product_count", W(_MR_PRODUCT_SQL))
def mr_product_count(spark, sf_dir):
    """Line-oriented task: completed orders per product."""
    return T.product_count(_guarded(spark, sf_dir))


@register("mr_ranked_products", W(f"""SELECT CAST(row_number() OVER (ORDER BY order_count DESC, product_id) AS INTEGER)
    AS rank, product_id, order_count FROM ({_MR_PRODUCT_SQL} ORDER BY order_count DESC, product_id LIMIT 10) t"""))
def mr_ranked_products(spark, sf_dir):
    """Line-oriented task: one global top-10 of the product counts."""
    return T.ranked_products(T.product_count(_guarded(spark, sf_dir)))


@register("mr_ranked_products_bounded", ORACLES["mr_ranked_products"])
def mr_ranked_products_bounded(spark, sf_dir):
    """The same top-10, moving only the counts that can be among the best."""
    return T.ranked_products_bounded(_guarded(spark, sf_dir))


_TSV_SCHEMA = StructType([StructField("year_month", StringType()),
                          StructField("total_revenue", DoubleType()),
                          StructField("order_count", LongType())])


@register("tsv_export", W(_MR_MONTH_SQL))
def tsv_export(spark, sf_dir):
    path = scratch_path(spark, "tsv", fingerprint(_export_path(spark, sf_dir)), "monthly_trend")
    if not committed(spark, path):
        TX.write_tsv(T.month_sum_count(_guarded(spark, sf_dir)), path)
    return TX.read_tsv(spark, path, _TSV_SCHEMA)


# --------------------------------------------------------------------------- step 2


@register("completed_orders", W("SELECT * FROM completed"))
def completed_orders(spark, sf_dir):
    return _a(spark, sf_dir).completed()


@register("category_bucket", W(f"SELECT DISTINCT seller_id, {O.category_expr('seller_id')} AS category FROM processed"))
def category_bucket_q(spark, sf_dir):
    return _p(spark, sf_dir).processed().select(
        "seller_id", category_bucket(F.col("seller_id")).alias("category")).distinct()


@register("product_bucket", W("SELECT order_id, product_id FROM sales"))
def product_bucket_q(spark, sf_dir):
    return _p(spark, sf_dir).sales().select("order_id", "product_id")


@register("product_display_name", W("SELECT DISTINCT product_id, 'Product ' || product_id AS product_name FROM completed"))
def product_display_name(spark, sf_dir):
    return _a(spark, sf_dir).completed().select(
        "product_id", product_name(F.col("product_id")).alias("product_name")).distinct()


@register("revenue_by_category", WM("SELECT * FROM revenue_by_category"))
def revenue_by_category(spark, sf_dir):
    """Completed orders per category: exact revenue, order count, average (A1)."""
    return _a(spark, sf_dir).revenue_by_category()


@register("monthly_totals", WM("SELECT * FROM monthly_totals"))
def monthly_totals(spark, sf_dir):
    return A.monthly_totals(_a(spark, sf_dir).completed())


@register("monthly_trend", WM("SELECT * FROM monthly_trend"))
def monthly_trend(spark, sf_dir):
    """Completed revenue and orders per month with month-over-month growth (A2 + W2)."""
    return _a(spark, sf_dir).monthly_trend()


@register("product_totals", WM("SELECT * FROM product_totals"))
def product_totals(spark, sf_dir):
    return A.product_totals(_a(spark, sf_dir).completed())


@register("top_products", WM("SELECT * FROM top_products"))
def top_products(spark, sf_dir):
    """Global top-10 products by completed orders, ranked, with display names (O1 + W7)."""
    return _a(spark, sf_dir).top_products()


@register("cancel_rate", WM("SELECT * FROM sm_cancel"))
def cancel_rate(spark, sf_dir):
    """Cancelled share per seller-month over all statuses (A4)."""
    return A.cancel_rate(_a(spark, sf_dir).sales())


@register("seller_month_base", WM("SELECT * FROM sm_base"))
def seller_month_base(spark, sf_dir):
    """Completed metrics per seller-month-tier, the reference's first aggregate (A5)."""
    return A.seller_month_base(_a(spark, sf_dir).completed())


@register("join_cancel_rate", WM("SELECT * FROM sm_joined"))
def join_cancel_rate(spark, sf_dir):
    """A5 left-joined with A4 on (seller, month), as the reference joins them."""
    a = _a(spark, sf_dir)
    return A.join_cancel_rate(A.seller_month_base(a.completed()), A.cancel_rate(a.sales()))


@register("seller_monthly", WM("SELECT * FROM seller_monthly"))
def seller_monthly(spark, sf_dir):
    """Seller-month features: revenue, AOV, cancel rate, distinct customers/days, lags, MA3, growth, label."""
    return _a(spark, sf_dir).seller_monthly()


@register("seller_monthly_bucketed", WM("SELECT * FROM seller_monthly"))
def seller_monthly_bucketed(spark, sf_dir):
    """The same features over the fact bucketed by seller: no exchange above the scan."""
    return A.seller_monthly(_a(spark, sf_dir).sales_by_seller())


@register("enrich_sellers_salted", W("SELECT * FROM enriched"))
def enrich_sellers_salted(spark, sf_dir):
    """Enrichment above the broadcast bound: a shuffle join that deals out the orders of hot sellers."""
    p = _p(spark, sf_dir)
    return C.enrich_sellers(p.clean(), p.sellers(), dim_rows=N_SELLERS, max_broadcast_rows=0)


@register("seller_lags", WM("""SELECT seller_id, year_month, monthly_revenue, lag1_revenue, lag2_revenue,
    lag3_revenue FROM seller_monthly"""))
def seller_lags(spark, sf_dir):
    return _a(spark, sf_dir).seller_monthly().select(
        "seller_id", "year_month", "monthly_revenue", "lag1_revenue", "lag2_revenue", "lag3_revenue")


@register("seller_lead_label", WM("SELECT seller_id, year_month, monthly_revenue, next_month_revenue FROM seller_monthly"))
def seller_lead_label(spark, sf_dir):
    return _a(spark, sf_dir).seller_monthly().select("seller_id", "year_month", "monthly_revenue",
                                                     "next_month_revenue")


@register("revenue_ma3", WM("SELECT seller_id, year_month, revenue_ma3 FROM seller_monthly"))
def revenue_ma3(spark, sf_dir):
    return _a(spark, sf_dir).seller_monthly().select("seller_id", "year_month", "revenue_ma3")


@register("growth_rate", WM("SELECT seller_id, year_month, growth_rate FROM seller_monthly"))
def growth_rate(spark, sf_dir):
    return _a(spark, sf_dir).seller_monthly().select("seller_id", "year_month", "growth_rate")


@register("year_month_parts", WM("SELECT seller_id, year_month, year, month FROM seller_monthly"))
def year_month_parts(spark, sf_dir):
    return _a(spark, sf_dir).seller_monthly().select("seller_id", "year_month", "year", "month")


@register("seller_alerts", WM("SELECT * FROM seller_alerts"))
def seller_alerts(spark, sf_dir):
    """Seller-months whose revenue dropped more than 20 % against the previous present month."""
    return _a(spark, sf_dir).seller_alerts()


@register("alert_threshold", WM(f"""SELECT seller_id, year_month, drop_pct,
    COALESCE(drop_pct > {float(FIXTURE.marts.alert_drop_pct)}, FALSE) AS alerted FROM alert_base"""))
def alert_threshold(spark, sf_dir):
    m = A.with_drop_pct(_a(spark, sf_dir).seller_monthly())
    return m.select("seller_id", "year_month", "drop_pct",
                    F.coalesce(A.drop_alert(FIXTURE.marts.alert_drop_pct), F.lit(False)).alias("alerted"))


@register("kpi_summary", WM("SELECT * FROM kpi_summary"))
def kpi_summary(spark, sf_dir):
    """Six KPI rows from the stored seller-month aggregate and customer bitmaps; no scan of the fact (A10)."""
    return _a(spark, sf_dir).kpi_summary()


@register("kpi_gmv", WM("SELECT total_gmv FROM kpi_wide"))
def kpi_gmv(spark, sf_dir):
    return A.kpi_sums(_a(spark, sf_dir).sales()).select("total_gmv")


@register("kpi_counts", WM("SELECT total_orders, total_all AS total_rows, cancelled AS cancelled_rows FROM kpi"))
def kpi_counts(spark, sf_dir):
    return A.kpi_sums(_a(spark, sf_dir).sales()).select(
        "total_orders", F.col("_all").alias("total_rows"), F.col("_cancelled").alias("cancelled_rows"))


@register("kpi_distinct", WM("SELECT unique_customers, active_sellers FROM kpi"))
def kpi_distinct(spark, sf_dir):
    """Distinct customers from the bitmaps, distinct sellers from the seller-month aggregate."""
    a = _a(spark, sf_dir)
    return A.distinct_counts(a.cube(), a.customer_bitmaps())


@register("customers_by_span", WM("""SELECT substr(year_month, 1, 4) AS year, CASE WHEN grouping(year_month) = 1 THEN NULL
    ELSE year_month END AS year_month, COUNT(DISTINCT customer_id) AS n_customers FROM completed
    GROUP BY GROUPING SETS ((substr(year_month, 1, 4), year_month), (substr(year_month, 1, 4)))"""))
def customers_by_span(spark, sf_dir):
    """Distinct customers of each month and of each year, exactly, from the stored monthly bitmaps."""
    return A.customers_by_span(_a(spark, sf_dir).customer_bitmaps())


def _content(columns, name: str, key: str) -> str:
    """SQL rows (mart, row_key, field, value) of a table, one a field, all as text."""
    fields = ", ".join(f"({O.q(c)}, {O.text(c, kind)})" for c, kind in columns)
    return (f"SELECT {O.q(name)} AS mart, {key} AS row_key, f.field AS field, f.val AS val FROM {name}, "
            f"LATERAL (VALUES {fields}) f(field, val)")


def _content_rows(df: DataFrame, name: str, columns, key) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), A.as_text(F.col(c), kind).alias("val")) for c, kind in columns])
    return df.select(F.lit(name).alias("mart"), key.alias("row_key"), F.explode(pairs).alias("x")).select("mart", "row_key", "x.*")


#: Every mart's columns as they are compared, and the columns that name a row.
MART_FIELDS = {
    "seller_monthly": ([("seller_type", "text"), *[(c, "number") for c in A.SELLER_MONTHLY_COLUMNS[3:]]], ("seller_id", "year_month")),
    "revenue_by_category": ([(c, "number") for c in ("total_revenue", "order_count", "avg_revenue")], ("category",)),
    "monthly_trend": ([(c, "number") for c in ("total_revenue", "order_count", "mom_growth_pct")], ("year_month",)),
    "top_products": ([("product_name", "text"), ("order_count", "number"), ("total_revenue", "number"), ("rank", "number")], ("product_id",)),
    "kpi_summary": ([("metric_value", "number")], ("metric_name",)),
    "seller_alerts": ([("alert_type", "text"), *[(c, "number") for c in ("prev_revenue", "curr_revenue", "drop_pct")]],
                      ("seller_id", "year_month")),
}


@register("build_marts", WM(" UNION ALL ".join(
    _content(columns, n, " || '/' || ".join(key)) for n, (columns, key) in MART_FIELDS.items())))
def build_marts(spark, sf_dir):
    """Write the six step-2 marts (Parquet) and return their whole content as read from the files, a
    row for each field."""
    paths = _a(spark, sf_dir).build()
    return _union_all([_content_rows(spark.read.parquet(paths[n]), n, columns, F.concat_ws("/", *key))
                       for n, (columns, key) in MART_FIELDS.items()])


def _serving_path(spark, sf_dir, name: str) -> str:
    return scratch_path(spark, "serving", fingerprint(_a(spark, sf_dir).marts_root), name)


@register("mart_truncate_insert", WM("SELECT * FROM revenue_by_category"))
def mart_truncate_insert(spark, sf_dir):
    """TRUNCATE + INSERT twice into a serving table: only the last content is visible."""
    mart, path = _a(spark, sf_dir).mart("revenue_by_category"), _serving_path(spark, sf_dir, "revenue_by_category")
    TB.replace_table(mart.limit(0), path)
    return TB.replace_table(mart, path, ["category"])


_UPSERT_FROM = 1999


@register("mart_upsert", O.with_chain(
    """SELECT * FROM old_sm o WHERE NOT EXISTS (SELECT 1 FROM new_sm n
          WHERE n.seller_id = o.seller_id AND n.year_month = o.year_month)
        UNION ALL SELECT * FROM new_sm""",
    O.mart_ctes() + [("sales_hist", f"SELECT * FROM sales WHERE year <= {_UPSERT_FROM}")]
    + O.seller_monthly_ctes("sales_hist", "hist")
    + [("old_sm", "SELECT * FROM hist_monthly"),
       ("new_sm", f"SELECT * FROM seller_monthly WHERE year >= {_UPSERT_FROM}")]))
def mart_upsert(spark, sf_dir):
    """Monthly refresh: history (data up to 1999), then the recomputed 1999-2000 seller-months upserted
    on (seller_id, year_month); earlier months are neither read nor rewritten (S10)."""
    a, path = _a(spark, sf_dir), _serving_path(spark, sf_dir, "seller_monthly")
    history = A.seller_monthly(a.sales().filter(F.col("year") <= _UPSERT_FROM))
    TB.replace_table(history, path, partition_by="year_month")
    return TB.upsert_table(a.mart("seller_monthly").filter(F.col("year") >= _UPSERT_FROM), path,
                           ["seller_id", "year_month"], "year_month")


@register("csv_roundtrip", WM("SELECT * FROM seller_alerts"))
def csv_roundtrip(spark, sf_dir):
    """The alerts as CSV files with header, written in parallel, read back with their schema."""
    a = _a(spark, sf_dir)
    path = scratch_path(spark, "csv", fingerprint(a.marts_root), "seller_alerts")
    if not committed(spark, path):
        TX.write_csv(a.mart("seller_alerts"), path, header=True)
    return TX.read_csv(spark, path, schemas.SELLER_ALERTS, header=True)


# ------------------------------------------------------------------- SQL-text tasks


def _sales_view(spark, sf_dir) -> str:
    return register_view(_p(spark, sf_dir).sales(), "sales")


for _task, _sql in SQL_TASKS.items():
    def _make(task):
        def run(spark, sf_dir):
            return run_sql_task(spark, task, _sales_view(spark, sf_dir))
        run.__name__ = task
        return run
    register(_task, W(_sql.format(view="sales")))(_make(_task))


_TASK_FIELDS = {"sql_revenue_by_category": ("category", ("total_revenue", "items")),
                "sql_monthly_orders": ("year_month", ("orders", "total_revenue")),
                "sql_top_products": ("product_id", ("total_revenue", "order_count"))}


@register("spark_sql_tasks", O.with_chain(" UNION ALL ".join(
    _content([(c, "number") for c in columns], t, key).replace("AS mart", "AS task")
    for t, (key, columns) in _TASK_FIELDS.items()), [(t, s.format(view="sales")) for t, s in SQL_TASKS.items()]))
def spark_sql_tasks(spark, sf_dir):
    """The whole results of the three SQL-text tasks, a row for each field."""
    view = _sales_view(spark, sf_dir)
    return _union_all([_content_rows(run_sql_task(spark, t, view), t, [(c, "number") for c in columns], F.col(key))
                       for t, (key, columns) in _TASK_FIELDS.items()]).withColumnRenamed("mart", "task")


# ------------------------------------------------------------------ serving views


_KPI_CARDS = ("SELECT " + ", ".join(f"CAST({k} AS DOUBLE) AS {k}" for k in A.KPI_NAMES) + " FROM kpi_wide")


@register("kpi_cards", WM(_KPI_CARDS))
def kpi_cards(spark, sf_dir):
    return V.kpi_cards(_a(spark, sf_dir).mart("kpi_summary"))


@register("kpi_fallback", WM(f"""SELECT COALESCE({O.msum('total_revenue')}, 0.0) AS total_gmv,
    CAST(COALESCE(SUM(order_count), 0) AS DOUBLE) AS total_orders, CAST(0.0 AS DOUBLE) AS active_sellers,
    CAST(0.0 AS DOUBLE) AS unique_customers,
    COALESCE(CAST(SUM(CAST(avg_revenue AS DECIMAL(28,6))) AS DOUBLE) / CAST(COUNT(avg_revenue) AS DOUBLE), 0.0)
      AS avg_order_value FROM revenue_by_category"""))
def kpi_fallback(spark, sf_dir):
    """KPIs recomputed from the category mart when the KPI mart is missing."""
    return V.kpi_fallback(_a(spark, sf_dir).mart("revenue_by_category"))


@register("yearly_trend", WM(f"""SELECT substr(year_month, 1, 4) AS year, {O.msum('total_revenue')} AS total_revenue,
    CAST(SUM(order_count) AS BIGINT) AS order_count, COUNT(*) AS months FROM monthly_trend GROUP BY 1"""))
def yearly_trend(spark, sf_dir):
    return V.yearly_trend(_a(spark, sf_dir).mart("monthly_trend"))


@register("alert_count", WM("SELECT COUNT(*) AS n_alerts FROM seller_alerts"))
def alert_count(spark, sf_dir):
    return V.alert_count(_a(spark, sf_dir).mart("seller_alerts"))


@register("recent_alerts", WM("""SELECT seller_id, year_month, prev_revenue, curr_revenue,
    '▼ ' || CAST(CAST(ROUND(CAST(drop_pct AS DECIMAL(28,10)), 1) AS DECIMAL(18,1)) AS VARCHAR) || '%' AS drop_pct
    FROM (SELECT * FROM seller_alerts ORDER BY year_month DESC, drop_pct DESC, seller_id LIMIT 10) t"""))
def recent_alerts(spark, sf_dir):
    """Ten most recent, largest drops with a '▼ x.x%' label."""
    return V.recent_alerts(_a(spark, sf_dir).mart("seller_alerts"))


@register("ranked_products_view", WM("SELECT * FROM top_products ORDER BY rank"))
def ranked_products_view(spark, sf_dir):
    return V.ranked_products_view(_a(spark, sf_dir).mart("top_products"))


@register("products_by_count", WM("SELECT product_name, order_count, rank FROM top_products ORDER BY order_count, product_id"))
def products_by_count(spark, sf_dir):
    """The best products by rising count, as horizontal bars are drawn."""
    return V.products_by_count(_a(spark, sf_dir).mart("top_products"))


@register("seller_pick_lists", WM("SELECT DISTINCT seller_type, seller_id FROM seller_monthly"))
def seller_pick_lists(spark, sf_dir):
    return V.seller_pick_lists(_a(spark, sf_dir).mart("seller_monthly"))


@register("default_sellers", WM("SELECT DISTINCT seller_id FROM seller_monthly ORDER BY seller_id LIMIT 3"))
def default_sellers(spark, sf_dir):
    return V.default_sellers(_a(spark, sf_dir).mart("seller_monthly"))


@register("sales_overview", WM("""SELECT k.*, (SELECT COUNT(*) FROM monthly_trend) AS months,
    (SELECT COUNT(*) FROM revenue_by_category) AS categories,
    (SELECT product_id FROM top_products WHERE rank = 1) AS top_product,
    (SELECT COUNT(*) FROM seller_alerts) AS n_alerts FROM kpi_cards k""", [("kpi_cards", _KPI_CARDS)]))
def sales_overview(spark, sf_dir):
    """Dashboard header in one row: KPI cards, mart sizes, best product, alert count.

    Every input is a small mart; the pieces are stacked as (key, number, text) rows and
    pivoted into one record (no join between them).
    """
    a = _a(spark, sf_dir)

    def item(key, num=None, txt=None):
        return [F.lit(key).alias("k"), (num if num is not None else F.lit(None)).cast("double").alias("num"),
                (txt if txt is not None else F.lit(None)).cast("string").alias("txt")]

    kpi = a.mart("kpi_summary")
    long = _union_all([
        kpi.select(F.col("metric_name").alias("k"), F.col("metric_value").alias("num"),
                   F.lit(None).cast("string").alias("txt")),
        a.mart("monthly_trend").agg(*item("months", F.count(F.lit(1)))),
        a.mart("revenue_by_category").agg(*item("categories", F.count(F.lit(1)))),
        a.mart("top_products").filter(F.col("rank") == 1).select(*item("top_product", txt=F.col("product_id"))),
        a.mart("seller_alerts").agg(*item("n_alerts", F.count(F.lit(1)))),
    ])
    keys = list(A.KPI_NAMES) + ["months", "categories", "top_product", "n_alerts"]
    wide = long.groupBy().pivot("k", keys).agg(F.first("num", ignorenulls=True).alias("n"),
                                                F.first("txt", ignorenulls=True).alias("t"))
    return wide.select(*[F.coalesce(F.col(f"{k}_n"), F.lit(0.0)).alias(k) for k in A.KPI_NAMES],
                       F.coalesce(F.col("months_n"), F.lit(0)).cast("long").alias("months"),
                       F.coalesce(F.col("categories_n"), F.lit(0)).cast("long").alias("categories"),
                       F.col("top_product_t").alias("top_product"),
                       F.coalesce(F.col("n_alerts_n"), F.lit(0)).cast("long").alias("n_alerts"))


# ------------------------------------------------------------------------- step 3

_FEATURE_SQL = O.FEATURE_SQL
WF = O.with_forecast


@register("feature_frame", WM("SELECT * FROM features", [("features", _FEATURE_SQL)]))
def feature_frame(spark, sf_dir):
    return _a(spark, sf_dir).features()


@register("encode_seller_tier", WM("SELECT DISTINCT seller_id, seller_type, seller_type_enc FROM features",
                                   [("features", _FEATURE_SQL)]))
def encode_seller_tier(spark, sf_dir):
    return M.encode_seller_tier(_a(spark, sf_dir).mart("seller_monthly")).filter(
        F.col("next_month_revenue").isNotNull()).select("seller_id", "seller_type", "seller_type_enc").distinct()


_SPLIT = FIXTURE.forecast.split_year

_FILLED_SQL = """SELECT * REPLACE (
      COALESCE(lag1_revenue, 0.0) AS lag1_revenue, COALESCE(lag2_revenue, 0.0) AS lag2_revenue,
      COALESCE(lag3_revenue, 0.0) AS lag3_revenue, COALESCE(revenue_ma3, 0.0) AS revenue_ma3,
      COALESCE(growth_rate, 0.0) AS growth_rate, COALESCE(cancel_rate, 0.0) AS cancel_rate)
    FROM seller_monthly"""


@register("fill_feature_nulls", WM(_FILLED_SQL))
def fill_feature_nulls(spark, sf_dir):
    """Lag / moving-average / growth / cancel features with NULL -> 0.0 (before the label filter)."""
    return M.fill_feature_nulls(_a(spark, sf_dir).mart("seller_monthly"))


_FEATURE_JSON = json.dumps(list(FEATURE_COLUMNS), separators=(",", ":"))


@register("labelled_rows", WM("""SELECT (SELECT COUNT(*) FROM seller_monthly) AS n_rows,
    (SELECT COUNT(*) FROM features) AS n_labelled""", [("features", _FEATURE_SQL)]))
def labelled_rows(spark, sf_dir):
    """Seller-months before and after keeping rows with a known next-month label."""
    a = _a(spark, sf_dir)
    counts = a.mart("seller_monthly").agg(F.count(F.lit(1)).alias("n_rows"))
    labelled = a.features().agg(F.count(F.lit(1)).alias("n_labelled"))
    return counts.unionByName(labelled, allowMissingColumns=True).agg(
        F.max("n_rows").alias("n_rows"), F.max("n_labelled").alias("n_labelled"))


@register("temporal_split", WM(f"""SELECT seller_id, year_month,
    CASE WHEN year < {_SPLIT} THEN 'train' ELSE 'test' END AS split
    FROM features WHERE year <= {_SPLIT}""", [("features", _FEATURE_SQL)]))
def temporal_split(spark, sf_dir):
    train, test = M.temporal_split(_a(spark, sf_dir).features(), _SPLIT)
    return (train.select("seller_id", "year_month", F.lit("train").alias("split"))
            .unionByName(test.select("seller_id", "year_month", F.lit("test").alias("split"))))


@register("assemble", WM(f"""SELECT seller_id, year_month, {", ".join(
    f"CAST({c} AS DOUBLE) AS f{i:02d}" for i, c in enumerate(FEATURE_COLUMNS))} FROM features""",
    [("features", _FEATURE_SQL)]))
def assemble(spark, sf_dir):
    """The 12-feature vector of every labelled row (VectorAssembler), unpacked to columns."""
    from pyspark.ml.functions import vector_to_array
    vec = M._assembler().transform(_a(spark, sf_dir).features())
    arr = vector_to_array(F.col("features_raw"))
    return vec.select("seller_id", "year_month", *[arr[i].alias(f"f{i:02d}") for i in range(len(FEATURE_COLUMNS))])


@register("split_counts", WM(f"""SELECT COUNT(CASE WHEN year < {_SPLIT} THEN 1 END) AS n_train,
    COUNT(CASE WHEN year = {_SPLIT} THEN 1 END) AS n_test FROM features""", [("features", _FEATURE_SQL)]))
def split_counts(spark, sf_dir):
    return M.split_counts(_a(spark, sf_dir).features(), _SPLIT)


def _stats_sql() -> str:
    parts = []
    for c in FEATURE_COLUMNS:
        mean = O.rnd(f"CAST(SUM(CAST({c} AS DECIMAL(28,4))) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE)", 6)
        std = O.rnd(f"stddev_samp(CAST({c} AS DOUBLE))", 4)
        parts.append(f"SELECT '{c}' AS feature, {mean} AS mean, {std} AS std FROM features WHERE year < {_SPLIT}")
    return " UNION ALL ".join(parts)


@register("feature_scaling_stats", WM(_stats_sql(), [("features", _FEATURE_SQL)]))
def feature_scaling_stats(spark, sf_dir):
    """Scaler statistics on the training years (mean and sample std per feature)."""
    train, _ = M.temporal_split(_a(spark, sf_dir).features(), _SPLIT)
    return M.feature_scaling_stats(train)


@register("gram_matrix", WF(" UNION ALL ".join(
    f"SELECT '{a}' AS row_term, '{b}' AS col_term, COUNT(*) AS n, " + O.rnd(
        f"CAST(SUM(CAST({O.gram_term(a)} AS DECIMAL(19,4)) * CAST({O.gram_term(b)} AS DECIMAL(19,4))) AS DOUBLE) / COUNT(*)", 2)
    + " AS mean_product FROM train" for a, b in M.gram_terms())))
def gram_matrix(spark, sf_dir):
    """Mean products of all pairs of features, label and intercept over the training years, one scan."""
    train, _ = M.temporal_split(_a(spark, sf_dir).features(), _SPLIT)
    return M.gram_matrix(train)


def _coefficients(spark, sf_dir) -> DataFrame:
    return spark.createDataFrame(M.coefficients(_a(spark, sf_dir).forecast().model), "feature string, coefficient double")


@register("train_forecast", WF(f"""SELECT feature, coefficient FROM importance
    UNION ALL SELECT 'intercept', {O.rnd(f'mean_{len(FEATURE_COLUMNS)}', 4)} FROM model"""))
def train_forecast(spark, sf_dir):
    """Fit the ridge regression; one row per coefficient plus the intercept, to 4 decimals (M4)."""
    run = _a(spark, sf_dir).forecast()
    rows = [("intercept", float(run.model.stages[-1].intercept))]
    both = _coefficients(spark, sf_dir).unionByName(spark.createDataFrame(rows, "feature string, coefficient double"))
    return both.withColumn("coefficient", round_half_up(F.col("coefficient"), 4))


@register("forecast_metrics", WF("SELECT * FROM metrics"))
def forecast_metrics(spark, sf_dir):
    """RMSE, MAE, R2 of the test year and RMSE of the training years, as they are logged (M5)."""
    return M.model_metrics_row(M.forecast_metrics(_a(spark, sf_dir).forecast())).drop("feature_json", "run_at")


@register("seller_predictions", WF("SELECT * FROM predictions"))
def seller_predictions(spark, sf_dir):
    return _a(spark, sf_dir).predictions()


@register("predictions_sorted", WF("SELECT * FROM predictions ORDER BY seller_id, year_month"))
def predictions_sorted(spark, sf_dir):
    return _a(spark, sf_dir).predictions()           # sorted by the library (O5)


@register("model_roundtrip", WF("SELECT seller_id, year_month, predicted_revenue, TRUE AS as_fitted FROM predictions"))
def model_roundtrip(spark, sf_dir):
    """Predictions of the saved and reloaded model, and whether the fitted one gives the same."""
    a = _a(spark, sf_dir)
    run = a.forecast()
    path = scratch_path(spark, "models", fingerprint(a.marts_root, "forecast"))
    if not path_exists(spark, path):
        M.save_model(run.model, path)
    again = run.model.transform(run.test).withColumnRenamed("predicted_revenue", "fitted").drop("features_raw", "features")
    loaded = M.load_model(path).transform(again)
    return loaded.select("seller_id", "year_month", round_half_up(F.col("predicted_revenue"), 2).alias("predicted_revenue"),
                         (F.col("predicted_revenue") == F.col("fitted")).alias("as_fitted"))


def _metrics_log(spark, sf_dir) -> str:
    return scratch_path(spark, "logs", fingerprint(_a(spark, sf_dir).marts_root), "model_metrics")


_STORED = WF(f"SELECT m.*, '{_FEATURE_JSON}' AS feature_json, TRUE AS is_latest FROM metrics m")


def _append_metrics(spark, sf_dir) -> str:
    path = _metrics_log(spark, sf_dir)
    M.model_metrics_row(M.forecast_metrics(_a(spark, sf_dir).forecast())).write.mode("append").parquet(path)
    return path


def _latest(spark, path) -> DataFrame:
    """The newest stored row, and that its time is the latest of the log."""
    log = spark.read.parquet(path)
    newest = log.agg(F.max("run_at").alias("last"))
    return (V.latest_model_metrics(log).join(F.broadcast(newest), F.col("run_at") == F.col("last"), "left")
            .withColumn("is_latest", F.col("last").isNotNull()).drop("run_at", "last"))


@register("append_model_metrics", _STORED)
def append_model_metrics(spark, sf_dir):
    """Append this run's metrics row to the model_metrics log and return it as stored there."""
    return _latest(spark, _append_metrics(spark, sf_dir))


@register("model_metrics_counts", WM(f"""SELECT COUNT(CASE WHEN year < {_SPLIT} THEN 1 END) AS n_train,
    COUNT(CASE WHEN year = {_SPLIT} THEN 1 END) AS n_test, '{_FEATURE_JSON}' AS feature_json FROM features""",
    [("features", _FEATURE_SQL)]))
def model_metrics_counts(spark, sf_dir):
    """The parts of the stored metrics row that SQL can recompute, read back from the log."""
    return _latest(spark, _append_metrics(spark, sf_dir)).select("n_train", "n_test", "feature_json")


@register("prediction_actuals", WM(f"""SELECT seller_id, year_month, next_month_revenue AS actual_revenue,
    TRUE AS predicted FROM features WHERE year = {_SPLIT}""", [("features", _FEATURE_SQL)]))
def prediction_actuals(spark, sf_dir):
    """Keys and actual revenue of all predictions, and that each has a prediction (M6)."""
    return _a(spark, sf_dir).predictions().select(
        "seller_id", "year_month", "actual_revenue", F.col("predicted_revenue").isNotNull().alias("predicted"))


@register("predictions_by_tier", WM(f"""SELECT s.seller_type, COUNT(*) AS n_predictions,
    COUNT(DISTINCT f.seller_id) AS n_sellers FROM features f JOIN sellers s ON f.seller_id = s.seller_id
    WHERE f.year = {_SPLIT} GROUP BY s.seller_type""", [("features", _FEATURE_SQL)]))
def predictions_by_tier(spark, sf_dir):
    """The tier selector of the forecast view: predictions and sellers left for each tier (P25)."""
    preds = _a(spark, sf_dir).predictions()
    dim = C.seller_dim(spark, N_SELLERS)
    tiers = [t for _, t in TIER_LIMITS] + [LOWEST_TIER]
    return _union_all([V.predictions_for_sellers(preds, dim, tier=t, dim_rows=N_SELLERS) for t in tiers]).groupBy(
        "seller_type").agg(F.count(F.lit(1)).alias("n_predictions"), F.count_distinct("seller_id").alias("n_sellers"))


@register("latest_model_metrics", _STORED)
def latest_model_metrics(spark, sf_dir):
    """The newest row of the model_metrics log."""
    path = _metrics_log(spark, sf_dir)
    if not path_exists(spark, path):
        _append_metrics(spark, sf_dir)
    return _latest(spark, path)


@register("feature_importance", WF("SELECT * FROM importance"))
def feature_importance(spark, sf_dir):
    """Standardised coefficients ranked by magnitude (M7)."""
    ranked = _coefficients(spark, sf_dir).withColumn("abs_rank", F.row_number().over(
        Window.orderBy(F.abs("coefficient").desc(), "feature")))
    return ranked.withColumn("coefficient", round_half_up(F.col("coefficient"), 4))


@register("residual_pct", WF("SELECT * FROM residuals"))
def residual_pct(spark, sf_dir):
    """Residual of each prediction in % of the actual revenue (M8)."""
    return M.residual_pct(_a(spark, sf_dir).predictions())


def _chosen(spark, sf_dir, seller_ids: list[str] | None = None, tier: str | None = None) -> DataFrame:
    preds = _a(spark, sf_dir).predictions()
    if seller_ids is None and tier is None:
        preds = preds.join(V.default_sellers(preds), "seller_id", "left_semi")
    return V.predictions_for_sellers(preds, C.seller_dim(spark, N_SELLERS), tier, seller_ids, dim_rows=N_SELLERS)


@register("predictions_for_sellers", WF("SELECT seller_id, year_month, actual_revenue, predicted_revenue, seller_type FROM chosen"))
def predictions_for_sellers(spark, sf_dir):
    """Default dashboard selection: the first three sellers, tier attached from the dimension (P25)."""
    return _chosen(spark, sf_dir)


_PICKED = ("S003", "S061", "S120", "S161", "S200")


@register("predictions_of_chosen_sellers", WF(f"""SELECT p.*, s.seller_type FROM predictions p
    LEFT JOIN sellers s ON p.seller_id = s.seller_id WHERE p.seller_id IN {_PICKED} AND s.seller_type = 'average_seller'"""))
def predictions_of_chosen_sellers(spark, sf_dir):
    """A choice of five sellers and of one tier among them (P25)."""
    return _chosen(spark, sf_dir, list(_PICKED), "average_seller")


@register("forecast_view", WF("""SELECT 'metric' AS section, name, CAST(NULL AS VARCHAR) AS seller_id,
    CAST(NULL AS VARCHAR) AS year_month, CAST(NULL AS VARCHAR) AS seller_type, value, CAST(NULL AS DOUBLE) AS actual_revenue,
    CAST(NULL AS DOUBLE) AS residual_pct FROM (SELECT 'rmse' AS name, rmse AS value FROM metrics UNION ALL
      SELECT 'mae', mae FROM metrics UNION ALL SELECT 'r2', r2 FROM metrics UNION ALL SELECT 'train_rmse', train_rmse FROM metrics) m
    UNION ALL SELECT 'importance', feature, NULL, NULL, NULL, coefficient, NULL, NULL FROM importance
    UNION ALL SELECT 'prediction', NULL, seller_id, year_month, seller_type, predicted_revenue, actual_revenue, residual_pct
      FROM chosen"""))
def forecast_view(spark, sf_dir):
    """The whole forecast tab as one long table: metrics cards, feature importance, and actual,
    predicted and residual % of the default sellers with their tier."""
    return V.forecast_view(latest_model_metrics(spark, sf_dir), feature_importance(spark, sf_dir),
                           M.residual_pct(predictions_for_sellers(spark, sf_dir)))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
