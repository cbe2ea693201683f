"""The three line-oriented batch tasks (category sum, month sum+count, product count)
re-expressed as Spark aggregations over the JSON-lines export of the processed fact.

Semantics kept from the line-by-line version: a record counts only when its status is
``completed`` and its amount parses to a number > 0; malformed lines are skipped; the
month key falls back to the first 7 characters of ``order_date``.  The per-reducer
top-10 of the original is replaced by one global top-n (its documented intent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ordermart.functions import category_bucket, money_sum, product_bucket
from ordermart.operators.topk import top_counts

# every field as text: a wrongly typed value must skip the record, not the line's parse
EXPORT_FIELDS = StructType([StructField(n, StringType(), True) for n in (
    "order_id", "seller_id", "status", "total_amount", "year_month", "order_date")])


def older_layout(processed: DataFrame) -> DataFrame:
    """JSON lines of the fact as a long-running export holds them: records whose order id leaves 4 when
    divided by 9 have no ``year_month`` yet, and after each whose id leaves 7 when divided by 50 stands a
    line that was cut off."""
    key = F.col("order_id").cast("bigint")
    old = processed.withColumn("year_month", F.when(key % 9 != 4, F.col("year_month")))
    line = F.to_json(F.struct(*old.columns))
    cut = F.substr(line, F.lit(1), F.floor(F.length(line) * 2 / 3).cast("int"))
    return old.select(F.explode(F.when(key % 50 == 7, F.array(line, cut)).otherwise(F.array(line))).alias("value"))


def guarded_records(lines: DataFrame) -> DataFrame:
    """Completed records with a positive numeric amount (``mr_guard_filter``)."""
    amount = F.col("total_amount").try_cast("double")
    return (lines.select(
                F.col("order_id"), F.coalesce(F.col("seller_id"), F.lit("")).alias("seller_id"),
                F.col("status"), amount.alias("total_amount"),
                F.coalesce(F.nullif(F.col("year_month"), F.lit("")),
                           F.substring(F.coalesce(F.col("order_date"), F.lit("")), 1, 7)).alias("month_key"))
            .where((F.col("status") == "completed") & F.col("total_amount").isNotNull()
                   & (F.col("total_amount") > 0)))


def month_key_sources(lines: DataFrame) -> DataFrame:
    """Month key of every guarded record and whether it came from ``order_date``."""
    ym = F.coalesce(F.col("year_month"), F.lit(""))
    from_date = ym == ""
    key = F.when(from_date, F.substring(F.coalesce(F.col("order_date"), F.lit("")), 1, 7)).otherwise(ym)
    amount = F.col("total_amount").try_cast("double")
    return (lines.where((F.col("status") == "completed") & amount.isNotNull() & (amount > 0))
            .select(key.alias("month_key"), from_date.alias("from_order_date"))
            .where(F.col("month_key") != ""))


def category_sum(records: DataFrame) -> DataFrame:
    return (records.groupBy(category_bucket(F.col("seller_id")).alias("category"))
            .agg(money_sum("total_amount").alias("total_revenue")))


def month_sum_count(records: DataFrame) -> DataFrame:
    return (records.where(F.col("month_key") != "")
            .groupBy(F.col("month_key").alias("year_month"))
            .agg(money_sum("total_amount").alias("total_revenue"),
                 F.count(F.lit(1)).alias("order_count")))


def product_count(records: DataFrame) -> DataFrame:
    return (records.where(F.col("order_id").isNotNull() & (F.col("order_id") != ""))
            .groupBy(product_bucket(F.col("order_id")).alias("product_id"))
            .agg(F.count(F.lit(1)).alias("order_count")))


def ranked_products_bounded(records: DataFrame, n: int = 10) -> DataFrame:
    """``ranked_products`` of ``product_count`` by the top-k that moves only what can be among the best."""
    own = records.where(F.col("order_id").isNotNull() & (F.col("order_id") != ""))
    top = top_counts(own.select(product_bucket(F.col("order_id")).alias("product_id")), "product_id", n)
    return ranked_products(top.select(F.col("key").alias("product_id"), F.col("n").alias("order_count")), n)


def ranked_products(counts: DataFrame, n: int = 10) -> DataFrame:
    order = (F.col("order_count").desc(), F.col("product_id").asc())
    top = counts.orderBy(*order).limit(n)
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("int").alias("rank"),
                      "product_id", "order_count")
