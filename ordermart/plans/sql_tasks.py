"""The three SQL-text tasks over a ``sales`` view (all statuses, as in the reference).

Sums are exact (DECIMAL(28,6), rounded once) so results do not depend on partitioning; top-n ties
break on product id.  Timings must materialise the full result (``noop`` sink), not
``count()``, which lets the optimizer drop the SUM and ORDER BY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW = "sales"

MONEY_SUM = "CAST(ROUND(SUM(CAST(total_amount AS DECIMAL(28,6))), 2) AS DOUBLE)"

SQL_TASKS = {
    "sql_revenue_by_category": f"""
        SELECT category, {MONEY_SUM} AS total_revenue, COUNT(*) AS items
        FROM {{view}} GROUP BY category ORDER BY total_revenue DESC""",
    "sql_monthly_orders": f"""
        SELECT year_month, COUNT(DISTINCT order_id) AS orders, {MONEY_SUM} AS total_revenue
        FROM {{view}} GROUP BY year_month ORDER BY year_month""",
    "sql_top_products": f"""
        SELECT product_id, {MONEY_SUM} AS total_revenue, COUNT(*) AS order_count
        FROM {{view}} GROUP BY product_id ORDER BY order_count DESC, product_id LIMIT 10""",
}


def register_view(sales: DataFrame, name: str = VIEW) -> str:
    sales.createOrReplaceTempView(name)
    return name


def run_sql_task(spark: SparkSession, task: str, view: str = VIEW) -> DataFrame:
    return spark.sql(SQL_TASKS[task].format(view=view))
