"""Cleaning operators: parse both feeds, union, dedup, filters, outliers, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart import schemas
from ordermart.constants import LOWEST_TIER, N_SELLERS, REGIONS, TIER_LIMITS
from ordermart.functions import (
    epoch_seconds_to_ntz, month_of, normalize_status, padded, parse_wall_clock, strip_tz_suffix,
    year_month, year_of,
)
from ordermart.operators.joins import bounded_rows, hot_keys, salted_join


def _canonical(df: DataFrame) -> DataFrame:
    return df.select(*schemas.ORDER_COLUMNS)


def amount_of(raw):
    """A feed's amount (number or quoted number, as text) as double; NULL if it is neither."""
    return F.trim(raw.cast("string")).try_cast("double")


def epoch_of(raw):
    """A feed's unix seconds (number, float text or quoted) as bigint; NULL if it is none."""
    text = F.trim(raw.cast("string"))
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(20,6)").try_cast("bigint"))


def unparsed_numbers(raw_app: DataFrame, raw_web: DataFrame) -> DataFrame:
    """How many amounts and timestamps are present but no numbers, per feed and field."""
    def bad(df, column, parse, source):
        c = F.col(column)
        return df.agg(F.count(F.when(c.isNotNull() & parse(c).isNull(), 1)).alias("n_unparsed")).select(
            F.lit(source).alias("data_source"), F.lit(column).alias("field"), "n_unparsed")
    return (bad(raw_app, "ts", epoch_of, "app").unionByName(bad(raw_app, "tot", amount_of, "app"))
            .unionByName(bad(raw_web, "total_amount", amount_of, "web")))


def sound_rows(raw: DataFrame) -> DataFrame:
    """Feed rows whose line fits the schema (all of them when the reader kept no broken lines)."""
    if schemas.CORRUPT not in raw.columns:
        return raw
    return raw.filter(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT, schemas.FILE)


def malformed_lines(raw_app: DataFrame, raw_web: DataFrame) -> DataFrame:
    """The broken lines of both feeds as read, with the order id where it could still be read and the
    file they stand in: what a quarantine keeps."""
    def of(raw, source, key):
        return raw.filter(F.col(schemas.CORRUPT).isNotNull()).select(
            F.lit(source).alias("data_source"), F.col(key).alias("order_id"), F.col(schemas.CORRUPT).alias("line"),
            F.col(schemas.FILE).alias("file"))
    return of(raw_app, "app", "oid").unionByName(of(raw_web, "web", "order_id"))


def feed_quality(raw_app: DataFrame, raw_web: DataFrame) -> DataFrame:
    """Per feed: sound records, broken lines, and sound records without an order id (one scan each)."""
    def of(raw, source, key):
        broken = F.col(schemas.CORRUPT).isNotNull()
        return raw.agg(F.count_if(~broken).alias("n_sound"), F.count_if(broken).alias("n_malformed"),
                       F.count_if(~broken & F.col(key).isNull()).alias("n_without_id")).withColumn("data_source", F.lit(source))
    return of(raw_app, "app", "oid").unionByName(of(raw_web, "web", "order_id"))


def drop_flagged_app(raw_app: DataFrame) -> DataFrame:
    """Keep records whose ``_dup`` flag is NULL or false."""
    return raw_app.filter(~F.coalesce(F.col("_dup"), F.lit(False))).drop("_dup")


def drop_retry_web(raw_web: DataFrame) -> DataFrame:
    """Keep records whose ``metadata._retry`` is NULL or false."""
    return raw_web.filter(~F.coalesce(F.col("metadata._retry"), F.lit(False)))


def parse_app(raw_app: DataFrame) -> DataFrame:
    """App layout -> canonical order rows (abbreviated keys, nested user, unix seconds)."""
    df = drop_flagged_app(sound_rows(raw_app)).select(
        F.col("oid").alias("order_id"),
        F.col("slr").alias("seller_id"),
        normalize_status(F.col("st")).alias("status"),
        F.col("usr.uid").alias("customer_id"),     # NULL struct -> NULL field
        F.col("usr.rgn").alias("region"),
        amount_of(F.col("tot")).alias("total_amount"),
        epoch_seconds_to_ntz(epoch_of(F.col("ts"))).alias("order_ts"),
        F.lit("app").alias("data_source"),
    )
    return _canonical(df.withColumn("order_date", F.to_date("order_ts")))


def parse_web(raw_web: DataFrame, strip_all_offsets: bool = False) -> DataFrame:
    """Web layout -> canonical order rows (offset suffix stripped, not applied)."""
    stripped = strip_tz_suffix(F.col("order_date"), strip_all_offsets)
    df = drop_retry_web(sound_rows(raw_web)).select(
        F.col("order_id"),
        F.col("seller_id"),
        normalize_status(F.col("status")).alias("status"),
        F.coalesce(F.col("customer_id"), F.lit("UNKNOWN")).alias("customer_id"),
        F.col("region"),
        amount_of(F.col("total_amount")).alias("total_amount"),
        parse_wall_clock(stripped).alias("order_ts"),
        F.lit("web").alias("data_source"),
    )
    return _canonical(df.withColumn("order_date", F.to_date("order_ts")))


def union_sources(app: DataFrame, web: DataFrame) -> DataFrame:
    return _canonical(app).unionByName(_canonical(web))


# Total order for choosing the surviving row of an order id: rows with an amount first,
# then the latest timestamp; the remaining keys only break exact ties deterministically.
def dedup_order():
    return (
    F.col("total_amount").isNull().asc(),
    F.col("order_ts").desc_nulls_last(),
    F.col("data_source").asc(),
    F.col("total_amount").desc_nulls_last(),
    F.col("seller_id").asc_nulls_first(),
    F.col("status").asc_nulls_first(),
    F.col("customer_id").asc_nulls_first(),
    F.col("region").asc_nulls_first(),
    )


def dedup_key():
    """``dedup_order`` as one comparable value: the smallest of an order id is the row that stays."""
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("order_ts"))
    amount = F.col("total_amount")
    return F.struct(amount.isNull(), F.col("order_ts").isNull(), -micros, "data_source", ~F.isnan(amount), -amount,
                    "seller_id", "status", "customer_id", "region")


def dedup_orders(df: DataFrame) -> DataFrame:
    """One row per ``order_id``.

    ``row_number() == 1`` lets Spark insert a partial WindowGroupLimit before the
    shuffle, so every map task forwards at most one row per order id: a hot id
    cannot pile up in one reducer.
    """
    w = Window.partitionBy("order_id").orderBy(*dedup_order())
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def in_valid_window(start_date: str, end_date: str):
    return ((F.col("order_date") >= F.lit(start_date).cast("date"))
            & (F.col("order_date") <= F.lit(end_date).cast("date"))
            & (F.col("total_amount") > 0))


def valid_window_filter(df: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """order_date within [start, end] and a positive amount (drops NULL dates/amounts)."""
    return df.filter(in_valid_window(start_date, end_date))


def within_bounds(lower: float | None, upper: float | None):
    if lower is None or upper is None:
        return F.lit(True)
    amt = F.col("total_amount")
    return amt.isNull() | amt.between(F.lit(float(lower)), F.lit(float(upper)))


def outlier_filter(df: DataFrame, lower: float, upper: float) -> DataFrame:
    """Keep NULL amounts and amounts within the inclusive bounds (literals -> pushed down)."""
    if lower is None or upper is None:       # no positive amount at all: nothing to bound
        return df
    return df.filter(within_bounds(lower, upper))


def seller_dim(spark: SparkSession, n: int = N_SELLERS) -> DataFrame:
    """Seller dimension generated from its rule: S001..Snnn, tier by number, region cycle."""
    i = F.col("id")
    tier = F.when(i <= TIER_LIMITS[0][0], TIER_LIMITS[0][1]) \
        .when(i <= TIER_LIMITS[1][0], TIER_LIMITS[1][1]).otherwise(LOWEST_TIER)
    region = F.element_at(F.array(*[F.lit(r) for r in REGIONS]), ((i - 1) % len(REGIONS) + 1).cast("int"))
    return spark.range(1, n + 1, numPartitions=1).select(
        F.concat(F.lit("S"), padded(i, 3)).alias("seller_id"),
        tier.alias("seller_type"), region.alias("seller_region"))


def enrich_sellers(df: DataFrame, dim: DataFrame, dim_rows: int | None = None,
                   max_broadcast_rows: int = 1_000_000, hot_share: float = 0.005) -> DataFrame:
    """Left join on seller_id: adds seller_type, fills a missing region from the dim.

    A dimension of at most ``max_broadcast_rows`` is broadcast; above that, orders are shuffled, and
    those of sellers with ``hot_share`` or more of all orders are dealt out over several tasks.
    """
    rows = dim_rows if dim_rows is not None else bounded_rows(dim, max_broadcast_rows)
    if rows <= max_broadcast_rows:
        joined = df.join(F.broadcast(dim), on="seller_id", how="left")
    else:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        # pieces of a quarter of a task's share: chance puts some of a seller's pieces into the same task
        joined = salted_join(df, dim, "seller_id", "order_id", hot_keys(df, "seller_id", "order_id", hot_share, 4 * parts))
    return joined.withColumn("region", F.coalesce(F.col("region"), F.col("seller_region"))) \
                 .drop("seller_region")


def derive_calendar(df: DataFrame) -> DataFrame:
    d = F.col("order_date")
    return (df.withColumn("year_month", year_month(d))
              .withColumn("year", year_of(d))
              .withColumn("month", month_of(d)))


def to_processed(df: DataFrame) -> DataFrame:
    return df.select(*schemas.PROCESSED_COLUMNS)


def cluster_for_write(df: DataFrame) -> DataFrame:
    """Local sort (no shuffle) by source, month and seller before a partitioned write: the
    writer's own sort by the partition column is then already satisfied, and Parquet row groups
    hold narrow month / seller ranges, so their min/max statistics let filtered scans skip them."""
    return df.sortWithinPartitions("data_source", "year_month", "seller_id")


def stage_funnel(combined: DataFrame, dim: DataFrame, start_date: str, end_date: str, lower: float | None,
                 upper: float | None, dim_rows: int | None = None, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """(stage, n_rows) of all cleaning stages after parsing, from one pass over the parsed rows.

    One aggregation by order id keeps the row that deduplication keeps and counts the rows of each
    source; the later stages are predicates of that row, and the enrichment join is made on it.  Rows
    that the join adds are counted per order id again, which needs no further shuffle.  The partial
    step of the aggregation sends one row per order id and map task, so a hot id is no hot task.
    """
    source = F.col("data_source")
    kept = F.min_by(F.struct("order_date", "total_amount", "seller_id", "region"), dedup_key())
    orders = combined.groupBy("order_id").agg(
        kept.alias("kept"), F.count_if(source == "app").alias("n_app"), F.count_if(source == "web").alias("n_web"),
        F.count(F.lit(1)).alias("n_union")).select("order_id", "n_app", "n_web", "n_union", "kept.*")
    valid = in_valid_window(start_date, end_date)
    flagged = (orders.withColumn("valid", F.coalesce(valid, F.lit(False)))
               .withColumn("clean", F.col("valid") & within_bounds(lower, upper)))
    joined = enrich_sellers(flagged, dim, dim_rows, max_broadcast_rows)
    once = [F.any_value(c).alias(c) for c in ("n_app", "n_web", "n_union", "valid", "clean")]
    per_order = joined.groupBy("order_id").agg(*once, F.count_if(F.col("clean")).alias("n_enriched"))
    counts = (("parsed_app", F.sum("n_app")), ("parsed_web", F.sum("n_web")), ("union", F.sum("n_union")),
              ("dedup", F.count(F.lit(1))), ("window_filter", F.count_if("valid")), ("outliers", F.count_if("clean")),
              ("enriched", F.sum("n_enriched")))
    total = per_order.agg(*[F.coalesce(c, F.lit(0)).alias(s) for s, c in counts])
    return total.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("n_rows"))
                                            for s, _ in counts])).alias("x")).select("x.*")
