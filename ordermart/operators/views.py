"""Serving views: what the reference's dashboard reads from the marts, as DataFrames.

All inputs are marts (bounded by categories, months, sellers x months, top-n), so the
ordering/limit views below sort small frames only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.functions import money, money_sum, round_half_up
from ordermart.operators.joins import broadcast_if_small
from ordermart.operators.marts import KPI_NAMES


def kpi_cards(kpi_long: DataFrame) -> DataFrame:
    """KPI rows -> one wide record; a missing metric shows as 0."""
    wide = kpi_long.groupBy().pivot("metric_name", list(KPI_NAMES)).agg(F.first("metric_value"))
    return wide.select(*[F.coalesce(F.col(k), F.lit(0.0)).alias(k) for k in KPI_NAMES])


def kpi_fallback(revenue_by_category: DataFrame) -> DataFrame:
    """KPIs recomputed from the category mart when the KPI mart is missing.

    ``avg_order_value`` is the unweighted mean of the category averages, as the
    reference's fallback computes it; seller/customer counts are unknown there (0).
    """
    return revenue_by_category.agg(
        F.coalesce(money_sum("total_revenue"), F.lit(0.0)).alias("total_gmv"),
        F.coalesce(F.sum("order_count"), F.lit(0)).cast("double").alias("total_orders"),
        F.lit(0.0).alias("active_sellers"),
        F.lit(0.0).alias("unique_customers"),
        F.coalesce(F.try_divide(F.sum(money("avg_revenue")).cast("double"),
                                F.count("avg_revenue").cast("double")), F.lit(0.0)).alias("avg_order_value"))


def yearly_trend(monthly_trend: DataFrame) -> DataFrame:
    """Monthly revenue stacked per calendar year."""
    return (monthly_trend.groupBy(F.substring("year_month", 1, 4).alias("year"))
            .agg(money_sum("total_revenue").alias("total_revenue"),
                 F.sum("order_count").alias("order_count"),
                 F.count(F.lit(1)).alias("months")))


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("n_alerts"))


def drop_label(drop_pct) -> F.Column:
    """'▼ 23.4%' from the HALF_UP one-decimal value."""
    one_decimal = F.round(drop_pct.cast("decimal(28,10)"), 1).cast("decimal(18,1)").cast("string")
    return F.concat(F.lit("▼ "), one_decimal, F.lit("%"))


def recent_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    return (alerts.orderBy(F.col("year_month").desc(), F.col("drop_pct").desc(), F.col("seller_id").asc())
            .limit(n)
            .select("seller_id", "year_month", "prev_revenue", "curr_revenue",
                    drop_label(F.col("drop_pct")).alias("drop_pct")))


def ranked_products_view(top_products: DataFrame) -> DataFrame:
    return top_products.orderBy("rank")


def products_by_count(top_products: DataFrame) -> DataFrame:
    """The top products by rising order count (ties: product id), as the bar view shows them."""
    return top_products.orderBy("order_count", "product_id").select("product_name", "order_count", "rank")


def seller_pick_lists(seller_monthly: DataFrame) -> DataFrame:
    """Distinct (tier, seller) pairs for the selectors, sorted."""
    return (seller_monthly.select("seller_type", "seller_id").distinct()
            .orderBy(F.col("seller_type").asc_nulls_first(), "seller_id"))


def default_sellers(seller_ids: DataFrame, n: int = 3) -> DataFrame:
    return seller_ids.select("seller_id").distinct().orderBy("seller_id").limit(n)


def predictions_for_sellers(predictions: DataFrame, sellers_dim: DataFrame, tier: str | None = None,
                            seller_ids: list[str] | None = None, max_sellers: int = 5,
                            dim_rows: int | None = None, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Predictions with the seller tier attached, filtered by tier and chosen sellers."""
    if seller_ids is not None and len(seller_ids) > max_sellers:
        raise ValueError(f"at most {max_sellers} sellers can be selected")
    tiers = broadcast_if_small(sellers_dim.select("seller_id", "seller_type"), max_broadcast_rows, dim_rows)
    df = predictions.join(tiers, "seller_id", "left")
    if tier is not None:
        df = df.filter(F.col("seller_type") == tier)
    if seller_ids is not None:
        df = df.filter(F.col("seller_id").isin(seller_ids))
    return df


def forecast_view(metrics: DataFrame, importance: DataFrame, residuals: DataFrame) -> DataFrame:
    """section ``metric`` (name, value), ``importance`` (feature, coefficient) and ``prediction``
    (seller, month, tier, predicted value, actual, residual %)."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def rows(df, section, name, value, seller=text, month=text, tier=text, actual=number, residual=number):
        return df.select(F.lit(section).alias("section"), name.alias("name"), seller.alias("seller_id"), month.alias("year_month"),
                         tier.alias("seller_type"), value.cast("double").alias("value"), actual.alias("actual_revenue"),
                         residual.alias("residual_pct"))

    cards = metrics.select("rmse", "mae", "r2", "train_rmse").unpivot([], ["rmse", "mae", "r2", "train_rmse"], "name", "value")
    return (rows(cards, "metric", F.col("name"), F.col("value"))
            .unionByName(rows(importance, "importance", F.col("feature"), F.col("coefficient")))
            .unionByName(rows(residuals, "prediction", text, F.col("predicted_revenue"), F.col("seller_id"), F.col("year_month"),
                              F.col("seller_type"), F.col("actual_revenue"), F.col("residual_pct"))))


def latest_model_metrics(metrics_log: DataFrame) -> DataFrame:
    """Newest metrics row (``ORDER BY run_at DESC`` first row) without a global sort."""
    cols = [c for c in metrics_log.columns if c != "run_at"]
    best = metrics_log.agg(F.max_by(F.struct(*cols), F.col("run_at")).alias("m"), F.max("run_at").alias("run_at"))
    return best.select("m.*", "run_at")


def model_history(metrics_log: DataFrame) -> DataFrame:
    """All metrics rows, newest first, with the columns the history table shows."""
    cols = [c for c in ("run_at", "rmse", "mae", "r2", "train_rmse", "n_train", "n_test")
            if c in metrics_log.columns]
    return metrics_log.select(*cols).orderBy(F.col("run_at").desc())


def benchmark_history(results: DataFrame) -> DataFrame:
    return results.orderBy(F.col("created_at").desc(), F.col("task"))


def benchmark_speedup(results: DataFrame, slow: str = "spark_lines", fast: str = "spark_sql") -> DataFrame:
    """Per task: seconds of two engines side by side and their ratio (NULL when either is missing)."""
    wide = results.groupBy("task").pivot("engine", [slow, fast]).agg(F.avg("avg_seconds"))
    return wide.withColumn("speedup", F.when((F.col(slow) > 0) & (F.col(fast) > 0),
                                             round_half_up(F.col(slow) / F.col(fast), 2)))
