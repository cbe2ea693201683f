"""Row-oriented text sinks/sources: JSON lines, CSV, tab-separated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType



def write_jsonl(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_lines(lines: DataFrame, path: str) -> str:
    """One text column as it is, a line per row."""
    lines.write.mode("overwrite").text(path)
    return path


def read_jsonl(spark: SparkSession, path: str, schema: StructType, mode: str = "PERMISSIVE") -> DataFrame:
    return spark.read.schema(schema).option("mode", mode).option("multiLine", "false").json(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              single_file: bool = False) -> str:
    """CSV text, in parallel as several files; ``single_file`` writes one file by one task, which is
    the caller's choice for a small frame."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True,
             sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def write_tsv(df: DataFrame, path: str) -> str:
    return write_csv(df, path, header=False, sep="\t")


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_csv(spark, path, schema, header=False, sep="\t")
