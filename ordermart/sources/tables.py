"""Parquet sinks: marts, the processed fact, serving tables, append-only logs; JDBC sinks.

Serving tables are plain Parquet folders, written by Spark's own committers:

* ``replace_table`` - TRUNCATE + INSERT: an overwrite of the folder;
* ``upsert_table``  - INSERT ... ON CONFLICT (pk) DO UPDATE SET <all other columns>: the table is
  partitioned by a column of its key, and a dynamic partition overwrite rewrites just the partitions
  (months) that the batch touches.  A key that is NULL or repeated inside one batch raises, as a
  primary key would.
"""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermart.operators.joins import broadcast_if_small
from ordermart.session import has_files, scratch_path


def write_mart(df: DataFrame, root: str, name: str) -> str:
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_parquet_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if has_files(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def _stored(df: DataFrame) -> DataFrame:
    """The rows, computed once however often they are used (in the shared scratch folder)."""
    path = scratch_path(df.sparkSession, "batch", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def check_keys(df: DataFrame, keys: list[str], where: str) -> None:
    """Raise if a key column is NULL or a key occurs twice, as a primary key would."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = df.groupBy(*keys).count().filter((F.col("count") > 1) | null).limit(1).collect()
    if bad:
        raise ValueError(f"a repeated or incomplete key {[bad[0][k] for k in keys]} for {where}")


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A serving table with its columns in order (the schema also types the partition column); empty
    where nothing was written yet."""
    if not has_files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def replace_table(df: DataFrame, path: str, keys: list[str] | None = None, partition_by: str | None = None) -> DataFrame:
    """TRUNCATE + INSERT; with ``keys`` a repeated or incomplete key is an error."""
    if keys:
        df = _stored(df)
        check_keys(df, keys, path)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def upsert_table(batch: DataFrame, path: str, keys: list[str], partition_by: str,
                 max_broadcast_keys: int = 1_000_000) -> DataFrame:
    """Rows of ``batch`` win on key conflicts, other existing rows stay; partitions without a row in
    the batch are neither read nor written.  ``partition_by`` is one of the key columns."""
    if partition_by not in keys:
        raise ValueError("the partition column must be part of the key")
    spark, batch = batch.sparkSession, _stored(batch)
    check_keys(batch, keys, path)
    touched = [r[0] for r in batch.select(partition_by).distinct().collect()]      # months, say: few by their nature
    merged = batch
    if has_files(spark, path) and touched:
        old = read_table(spark, path, batch.schema).where(F.col(partition_by).isin(touched))
        batch_keys = broadcast_if_small(batch.select(*keys), max_broadcast_keys)
        merged = old.join(batch_keys, keys, "left_anti").select(*batch.columns).unionByName(batch)
    (merged.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_by).parquet(path))
    return read_table(spark, path, batch.schema)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, sort_by: list[str], buckets: int) -> DataFrame:
    """``df`` as a table of ``buckets`` files by the hash of ``key``, sorted within: aggregations and
    windows by ``key`` (and more) then need no exchange.  A key's rows lie in one bucket, so this suits
    keys of which none holds a large share (see ``joins.hot_keys``)."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key, *sort_by).saveAsTable(table))
    return df.sparkSession.table(table)


def jdbc_replace(df: DataFrame, url: str, table: str, properties: dict | None = None,
                 num_partitions: int | None = None) -> None:
    """TRUNCATE + INSERT into a database table with Spark's JDBC writer.

    Rows go from the executors straight to the database (``truncate`` keeps the table
    definition); nothing passes through the driver.  Not exercised by the tests: no
    database may be started in this environment.
    """
    writer = df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table) \
        .option("truncate", "true")
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def upsert_statement(table: str, staging: str, columns: list[str], keys: list[str]) -> str:
    """One INSERT ... ON CONFLICT that moves a staging table into ``table``."""
    rest = [c for c in columns if c not in keys]
    action = "UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in rest) if rest else "NOTHING"
    listed = ", ".join(columns)
    return f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} ON CONFLICT ({', '.join(keys)}) DO {action}"


def jdbc_upsert(df: DataFrame, url: str, table: str, keys: list[str], properties: dict | None = None,
                num_partitions: int | None = None) -> None:
    """Keyed upsert into a database: executors write the rows to a staging table in JDBC batches, and
    one statement in the database moves them over.  Only the statement passes through the driver.
    Not exercised by the tests but for its statement: no database may be started in this environment.
    """
    batch = _stored(df)
    check_keys(batch, keys, table)
    staging = f"{table}_staging"
    jdbc_replace(batch, url, staging, properties, num_partitions)
    jvm = df.sparkSession.sparkContext._jvm
    login = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        login.setProperty(k, str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        connection.createStatement().executeUpdate(upsert_statement(table, staging, batch.columns, keys))
    finally:
        connection.close()


def append_log(spark: SparkSession, path: str, rows: list[dict], schema: StructType) -> None:
    """Append run-log rows (one per run; produced on the driver by nature: timings, counts)."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    filled = []
    for r in rows:
        r = dict(r)
        for f in schema.fields:
            if f.name in ("run_at", "created_at") and r.get(f.name) is None:
                r[f.name] = now
        filled.append(tuple(r.get(f.name) for f in schema.fields))
    spark.createDataFrame(filled, schema).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_parquet_or_empty(spark, path, schema)


def serving_read(spark: SparkSession, name: str, schema: StructType, parquet_root: str | None = None,
                 jdbc_options: dict | None = None) -> DataFrame:
    """Read a mart from the serving store, else from its Parquet copy, else an empty frame."""
    if jdbc_options:
        try:
            return spark.read.format("jdbc").options(dbtable=name, **jdbc_options).load()
        except Exception as exc:  # noqa: BLE001 - only a database error leads to the copy
            if "java.sql." not in str(exc) and "SQLException" not in type(exc).__name__:
                raise
            logging.getLogger(__name__).warning("serving store not read, using the copy of %s: %s", name, exc)
    if parquet_root:
        return read_table(spark, f"{parquet_root.rstrip('/')}/{name}", schema)
    return spark.createDataFrame([], schema)
