"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.session import delete_path, scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders that this process wrote, in order (see ``clear``).
_WRITTEN: list[str] = []


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder under ``spark.checkpoint.dir``: every executor can read what another wrote."""
    return scratch_path(spark, "llm", f"{tag}-{uuid.uuid4().hex}")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and a lost
    executor costs no recomputation of what came before."""
    path = shared_folder(df.sparkSession, tag)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, row: str, tag: str) -> DataFrame:
    """``df``, stored with a number for each row (column ``row``).  The numbers are part of the table, so
    every later scan sees the same ones, however it cuts the files."""
    return stored(df.withColumn(row, F.monotonically_increasing_id()), tag)


_ROWS = 1 << 36           # more than the rows of a file


def placed(df: DataFrame, row: str, tag: str, most_files: int = 1_000_000) -> DataFrame:
    """``df`` with a number for each row (column ``row``).  Rows that are read straight from Parquet files
    are named by their file's number and their place in the file, which every scan finds alike however it
    cuts the files, so nothing but the list of files is stored; all others are ``numbered``."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    path, at, n = (spare_name([*df.columns, row], c) for c in ("file_path", "row_index", "file_number"))
    try:
        if plan.getClass().getSimpleName() != "LogicalRelation":
            return numbered(df, row, tag)
        found = df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(at))
    except AnalysisException:       # no files, or of a kind that does not number its rows
        return numbered(df, row, tag)
    files = stored(found.select(path).distinct().withColumn(n, F.row_number().over(Window.orderBy(path))), tag)
    if files.count() <= most_files:
        files = F.broadcast(files)
    return found.join(files, path).select(*df.columns, (F.col(n) * F.lit(_ROWS) + F.col(at)).alias(row))


def written() -> int:
    """How many folders ``stored`` has written so far: a mark for ``clear``."""
    return len(_WRITTEN)


def clear(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete the tables stored after the mark ``since``, but those named in ``keep``.  To be called when
    all results that read them are written."""
    for path in _WRITTEN[since:]:
        if path not in keep:
            delete_path(spark, path)
    _WRITTEN[since:] = [p for p in _WRITTEN[since:] if p in keep]


def last_written() -> str:
    return _WRITTEN[-1]


def held_out(doc_id: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """True for rows whose crc32(id as text) mod ``folds`` is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % F.lit(folds) == F.lit(fold), F.lit(False))


def learnable(doc_id: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """True for rows a model may learn from; false for a null id, whose remainder is unknown."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % F.lit(folds) != F.lit(fold), F.lit(False))


def spare_name(taken: list[str], wish: str) -> str:
    """``wish``, or with underscores in front when a column of that name exists (in any case)."""
    used = {c.lower() for c in taken}
    while wish.lower() in used:
        wish = "_" + wish
    return wish


def slices(batch: pa.RecordBatch, column: str, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that a piece has at most ``rows`` rows and, unless it is a single
    row, about ``size`` bytes in ``column``."""
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    begin = total = 0
    for i, n in enumerate(lengths):
        n = n or 0
        if i > begin and (i - begin >= rows or total + n > size):
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin, len(lengths) - begin)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema,
                column: str = "text", rows: int = 512, size: int = 4 << 20) -> DataFrame:
    """``mapInArrow`` with batches of bounded bytes."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, column, rows, size):
                yield fn(piece)
    return df.mapInArrow(run, schema)
