"""Raw order feeds: the two JSON-lines layouts, derived deterministically from ``orders``.

The reference's generator is not rebuilt (it is a single-process simulator); instead
the same defect kinds are injected by rules over the driver's ``orders`` table, so the
feeds grow with the data and an SQL engine can reproduce them row for row:

* 3:2 app/web split; the 200 sellers of the dimension, and for every tenth order a small seller that
  is not in it, whose number grows with the customers (so seller tables grow with the input);
* status aliases incl. mixed case, 2 % NULL status, 3 % NULL customer;
* 4 % NULL amount, 1 % negative, 0.5 % x20 outliers, 6 % with fractions of a cent;
* per 100 orders one flagged duplicate, one unflagged later copy with NULL amount
  (original must win) and one unflagged copy one hour later (the copy must win);
* web timestamps as ISO text with ``+07:00`` / ``+08:00`` / ``Z`` suffixes;
* per 250 orders one broken line besides its record: cut off, no JSON at all, or a flag that is no
  boolean.

Both layouts are written in one distributed pass as text lines, partitioned by ``source`` into
``source=app/`` and ``source=web/``; NULL fields are omitted from the JSON, so e.g. ``_dup`` is
present only on duplicates.  Readers keep a line that does not fit the schema in
``_corrupt_record``; ``cleaning.sound_rows`` and ``cleaning.malformed_lines`` tell the two apart.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ordermart import schemas
from ordermart.constants import REGIONS
from ordermart.functions.buckets import padded
from ordermart.functions.timecols import ntz_to_epoch_seconds
from ordermart.session import MATERIALIZE_LOCK, committed, fingerprint, input_signature, scratch_path

FEED_RULES_VERSION = 3
COPY_TAGS = (42, 43, 44)     # k % 100: flagged copy, NULL-amount copy, later copy
BROKEN_TAG = 77              # k % 250: a broken line follows


def _pick(key: Column, values) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, F.lit(v)) if expr is None else expr.when(key == i, F.lit(v))
    return expr


def fixture_raw(orders: DataFrame) -> DataFrame:
    """One row per emitted feed record (originals plus injected copies)."""
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    base = orders.select(
        k.alias("k"), ck.alias("ck"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("od"),
        F.col("o_totalprice").cast("double").alias("px"),
        # one scan: every order emits itself, tagged orders also a copy
        F.explode(F.when((k % 100).isin(*COPY_TAGS), F.array(F.lit(0), F.lit(1)))
                  .when(k % 250 == BROKEN_TAG, F.array(F.lit(0), F.lit(2)))
                  .otherwise(F.array(F.lit(0)))).alias("cp"),
    )
    k, ck, cp = F.col("k"), F.col("ck"), F.col("cp")
    src = F.when(k % 5 < 3, "app").otherwise("web")
    seller = F.when(k % 10 == 9, F.lit(201) + F.floor(ck / 3).cast("bigint")).otherwise(F.lit(1) + (k * 7 + ck) % 200)
    h = (k * 31 + ck) % 100
    is_app = src == "app"
    status = (
        F.when(k % 50 == 0, F.lit(None).cast("string"))
        .when(h < 68, F.when(ck % 5 == 0, "completed").when(ck % 5 == 1, "done")
              .when(ck % 5 == 2, "success").when(ck % 5 == 3, "paid")
              .otherwise(F.when(is_app, "COMPLETED").otherwise("complete")))
        .when(h < 83, F.when(ck % 3 == 0, "pending").when(ck % 3 == 1, "processing")
              .otherwise("in_progress"))
        .when(h < 93, F.when(ck % 2 == 0, "cancelled").otherwise(F.when(is_app, "CANCEL").otherwise("cancel")))
        .when(h < 98, F.when(ck % 2 == 0, "returned").otherwise("refund"))
        .otherwise(F.when(ck % 2 == 0, "unknown").otherwise("other"))
    )
    amount = (
        F.when((k % 25 == 3) | ((cp == 1) & (k % 100 == 43)), F.lit(None).cast("double"))
        .when(k % 100 == 7, -F.col("px"))
        .when(k % 200 == 11, (F.col("px").cast("decimal(18,2)") * 20).cast("double"))
        .when(k % 16 == 5, (F.col("px").cast("decimal(28,6)") + F.lit(Decimal("0.0049"))).cast("double"))
        .otherwise(F.col("px"))
    )
    later = (cp == 1) & (k % 100 != 42)
    return base.select(
        k.cast("string").alias("order_id"),
        src.alias("src"),
        F.concat(F.lit("S"), padded(seller, 3)).alias("seller_id"),
        _pick((seller - 1) % 5, REGIONS).alias("rgn"),
        status.alias("st"),
        F.when(k % 33 == 5, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("C"), padded(ck, 6))).alias("cust"),
        amount.alias("amt"),
        F.when(later, F.timestamp_add("HOUR", F.lit(1), F.col("od"))).otherwise(F.col("od")).alias("ts"),
        ((cp == 1) & (k % 100 == 42)).alias("flag"),
        (ck % 10).alias("tz"),
        F.col("px"),
        F.when(cp == 2, F.floor(k / 250) % 3).cast("int").alias("broken"),      # kind of broken line
    )


def feed_lines(raw: DataFrame) -> DataFrame:
    """(value, source): one JSON text line per record in the layout of its source, NULL fields left
    out, and the broken lines."""
    app = F.col("src") == "app"
    flagged = F.when(F.col("flag"), F.lit(True))
    offset = F.when(F.col("tz") < 5, "+07:00").when(F.col("tz") < 7, "+08:00").otherwise("Z")
    user = F.when(F.col("cust").isNotNull(),
                  F.struct(F.col("cust").alias("uid"), F.col("rgn").alias("rgn")))
    key = F.col("order_id").cast("bigint")
    items = F.array(F.struct(
        F.when(key % 200 != 17, F.concat(F.lit("I"), (key % 997).cast("string"))).alias("pid"),
        (key % 3 + 1).cast("int").alias("q"), F.col("px").alias("p"), F.lit(0.0).alias("d")))
    app_line = F.to_json(F.struct(
        F.col("order_id").alias("oid"), ntz_to_epoch_seconds(F.col("ts")).alias("ts"), F.col("seller_id").alias("slr"),
        "st", user.alias("usr"), F.col("amt").alias("tot"), items.alias("items"), flagged.alias("_dup")))
    web_line = F.to_json(F.struct(
        "order_id", F.concat(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("order_date"), "seller_id",
        F.col("st").alias("status"), F.col("cust").alias("customer_id"), F.col("rgn").alias("region"),
        F.col("amt").alias("total_amount"),
        F.struct(F.lit("web").alias("source"), F.lit("2.1").alias("version"), flagged.alias("_retry")).alias("metadata")))
    line = F.when(app, app_line).otherwise(web_line)
    no_flag = F.when(app, F.concat(F.lit('{"oid":"'), "order_id", F.lit('","_dup":"maybe"}'))).otherwise(
        F.concat(F.lit('{"order_id":"'), "order_id", F.lit('","metadata":{"_retry":"maybe"}}')))
    broken = (F.when(F.col("broken") == 0, F.substr(line, F.lit(1), F.floor(F.length(line) / 2).cast("int")))
              .when(F.col("broken") == 1, F.concat(F.lit("no record at order "), "order_id"))
              .otherwise(no_flag))
    return raw.select(F.when(F.col("broken").isNull(), line).otherwise(broken).alias("value"), F.col("src").alias("source"))


def write_feeds(raw: DataFrame, root: str) -> str:
    feed_lines(raw).write.mode("overwrite").partitionBy("source").text(root)
    return root


def ensure_fixture_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Write (once) the raw JSON feeds derived from ``sf_dir/orders.parquet``."""
    orders_path = f"{sf_dir.rstrip('/')}/orders.parquet"
    root = scratch_path(spark, "feeds", fingerprint(input_signature(orders_path, spark), FEED_RULES_VERSION))
    with MATERIALIZE_LOCK:
        if not committed(spark, root):
            write_feeds(fixture_raw(spark.read.parquet(orders_path)), root)
    return root


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines by the whole schema, whichever columns a query goes on to use: a line is sound or
    broken for all queries alike (the JSON source would only look at the columns asked for).  A line is
    parsed once: ``explode`` of the one record keeps filters on its fields from being pushed below it,
    where each of them would parse the line again."""
    whole = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    lines = spark.read.text(path).where(F.trim("value") != "")
    record = F.explode(F.array(F.from_json("value", whole, options)))
    return lines.select(record.alias("record"), F.col("_metadata.file_name").alias(schemas.FILE)).select("record.*", schemas.FILE)


def read_app_feed(spark: SparkSession, root: str) -> DataFrame:
    """The app feed; a line that does not fit the schema stands in ``_corrupt_record``."""
    return _read(spark, f"{root}/source=app", schemas.APP_FEED)


def read_web_feed(spark: SparkSession, root: str) -> DataFrame:
    """The web feed; a line that does not fit the schema stands in ``_corrupt_record``."""
    return _read(spark, f"{root}/source=web", schemas.WEB_FEED)
