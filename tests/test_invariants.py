"""Invariants and differential checks over the sf0.001 pipeline."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermart.functions import money_sum
from ordermart.operators import marts as A
from ordermart.plans import catalog
from tests.conftest import SF_SMALL

Q = catalog.queries()


def _rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(map(repr, df.select(*cols).collect()))


def test_order_ids_unique_after_dedup(spark):
    p = Q["clean_orders"](spark, SF_SMALL)
    assert p.count() == p.select("order_id").distinct().count()


def test_stage_counts_never_increase(spark):
    order = ["union", "dedup", "window_filter", "outliers", "enriched"]
    counts = {r["stage"]: r["n_rows"] for r in Q["stage_row_counts"](spark, SF_SMALL).collect()}
    assert counts["parsed_app"] + counts["parsed_web"] == counts["union"]
    seq = [counts[s] for s in order]
    assert seq == sorted(seq, reverse=True)


def test_revenue_totals_agree(spark):
    cat = Q["revenue_by_category"](spark, SF_SMALL).agg(money_sum("total_revenue")).first()[0]
    month = Q["monthly_trend"](spark, SF_SMALL).agg(money_sum("total_revenue")).first()[0]
    kpi = {r["metric_name"]: r["metric_value"] for r in Q["kpi_summary"](spark, SF_SMALL).collect()}
    sm = Q["seller_monthly"](spark, SF_SMALL).agg(money_sum("monthly_revenue")).first()[0]
    gmv = kpi["total_gmv"]                          # each figure is rounded to cents once
    assert abs(cat - gmv) <= 0.005 * 10 and abs(month - gmv) <= 0.005 * 60 and abs(sm - gmv) <= 0.005 * 711


def test_lag_and_lead_are_inverse(spark):
    sm = Q["seller_monthly"](spark, SF_SMALL)
    w = Window.partitionBy("seller_id").orderBy("year_month")
    nxt = sm.select("seller_id", "year_month", "monthly_revenue", "next_month_revenue",
                    F.lead("lag1_revenue").over(w).alias("lag_of_next"),
                    F.lead("monthly_revenue").over(w).alias("rev_of_next"))
    bad = nxt.filter(~F.col("next_month_revenue").eqNullSafe(F.col("rev_of_next"))
                     | (F.col("rev_of_next").isNotNull() & (F.col("lag_of_next") != F.col("monthly_revenue")))
                     ).count()
    assert bad == 0


def test_line_tasks_equal_dataframe_marts(spark):
    by_cat = {r["category"]: r["total_revenue"] for r in Q["revenue_by_category"](spark, SF_SMALL).collect()}
    mr_cat = {r["category"]: r["total_revenue"] for r in Q["mr_category_sum"](spark, SF_SMALL).collect()}
    assert by_cat == mr_cat
    assert _rows(Q["monthly_totals"](spark, SF_SMALL)) == _rows(Q["mr_month_sum_count"](spark, SF_SMALL))
    top = Q["top_products"](spark, SF_SMALL).select("rank", "product_id", "order_count")
    assert _rows(top) == _rows(Q["mr_ranked_products"](spark, SF_SMALL))


def test_sql_text_equals_dataframe_api(spark):
    sales = catalog._p(spark, SF_SMALL).sales()
    api = sales.groupBy("category").agg(money_sum("total_amount").alias("total_revenue"),
                                        F.count(F.lit(1)).alias("items"))
    assert _rows(api) == _rows(Q["sql_revenue_by_category"](spark, SF_SMALL))
    api = sales.groupBy("year_month").agg(F.count_distinct("order_id").alias("orders"),
                                          money_sum("total_amount").alias("total_revenue"))
    assert _rows(api) == _rows(Q["sql_monthly_orders"](spark, SF_SMALL))
    api = (A.product_totals(sales).orderBy(F.desc("order_count"), "product_id").limit(10))
    assert _rows(api) == _rows(Q["sql_top_products"](spark, SF_SMALL))


def test_alerts_are_drops_above_threshold(spark):
    alerts = Q["seller_alerts"](spark, SF_SMALL)
    assert alerts.filter((F.col("drop_pct") <= 20) | (F.col("curr_revenue") >= F.col("prev_revenue"))).count() == 0
    flags = Q["alert_threshold"](spark, SF_SMALL)
    assert flags.filter("alerted").count() == alerts.count()


def test_approx_quantile_mode_end_to_end(spark):
    """The reference's approxQuantile(0.01) mode: bounds within the rank error of the exact ones."""
    from dataclasses import replace

    from ordermart.config import FIXTURE
    from ordermart.plans.clean import OrderPipeline
    exact = catalog._p(spark, SF_SMALL)
    params = replace(FIXTURE, clean=replace(FIXTURE.clean, quantile_method="approx"))
    approx = OrderPipeline(spark, SF_SMALL, params, feeds_root=exact.feeds_root)
    valid = exact.valid_table().where("total_amount > 0")
    n = valid.count()
    for q in ("q1", "q3"):
        v = approx.bounds()[q]
        rank = valid.where(F.col("total_amount") <= v).count()
        target = (0.25 if q == "q1" else 0.75) * n
        assert abs(rank - target) <= 0.01 * n + 1
    assert approx.processed().count() > 0


def test_month_key_falls_back_to_order_date(spark):
    from ordermart.operators import text_tasks as T
    lines = spark.createDataFrame(
        [("1", "S1", "completed", "5.0", "2023-01", "2023-01-02"),
         ("2", "S1", "completed", "5.0", "", "2023-02-03"),
         ("3", "S1", "completed", "5.0", None, "2023-03-04"),
         ("4", "S1", "completed", "abc", "2023-01", "2023-01-02"),     # amount not a number: skipped
         ("5", "S1", "pending", "5.0", "2023-01", "2023-01-02"),       # not completed: skipped
         ("6", "S1", "completed", "5.0", None, None)],                  # no key at all: skipped
        "order_id string, seller_id string, status string, total_amount string, year_month string, "
        "order_date string")
    got = sorted(tuple(r) for r in T.month_key_sources(lines).collect())
    assert got == [("2023-01", False), ("2023-02", True), ("2023-03", True)]
    months = {r["year_month"]: r["order_count"] for r in T.month_sum_count(T.guarded_records(lines)).collect()}
    assert months == {"2023-01": 1, "2023-02": 1, "2023-03": 1}


def test_quantile_head_observed_during_valid_write_equals_separate_pass(spark):
    import uuid

    from ordermart.config import FIXTURE
    from ordermart.operators.quantiles import iqr_bounds
    from ordermart.plans.clean import OrderPipeline
    base = catalog._p(spark, SF_SMALL)
    fresh = OrderPipeline(spark, SF_SMALL, FIXTURE, feeds_root=base.feeds_root, run_tag=uuid.uuid4().hex)
    fresh.valid_table()
    head = fresh._valid_head
    assert head is not None and head["n"] == fresh.valid_table().where("total_amount > 0").count()
    observed = fresh.bounds()
    separate = iqr_bounds(fresh.valid_table(), "total_amount", 3.0, "exact")
    assert observed == separate


def test_results_independent_of_ansi_mode_and_partition_count(spark):
    keys = ["clean_orders", "seller_monthly", "kpi_summary", "monthly_trend", "recent_alerts",
            "sql_monthly_orders"]
    before = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.shuffle.partitions")}
    seen = []
    try:
        for ansi, parts in (("true", "4"), ("false", "37")):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            seen.append({k: sorted(map(repr, Q[k](spark, SF_SMALL).collect())) for k in keys})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert seen[0] == seen[1]
