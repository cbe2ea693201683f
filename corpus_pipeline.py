"""Corpus pipeline: language ID, near-duplicate removal, decontamination, redaction, packing.

Each stage gets the documents its predecessor kept (Parquet, reread) and returns a DataFrame with
the same columns; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermart.llm import decontam, langid, packing, pii, simhash
from ordermart.llm.common import clear, last_written, read_table, stored, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID recognises.  Null, empty and letterless texts go; repeated rows stay
    both; columns of any name stay as they are; an empty table stays empty."""
    return langid.keep_known(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, that with the smallest doc_id (of rows with
    equal or null ids the first).  Null and empty texts count as one group; columns of any name stay as
    they are; an empty table stays empty."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window.  Null and empty texts and all documents of an empty benchmark
    stay; repeated rows are judged alike; columns of any name stay as they are."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in ``text`` alone.  Null texts stay null, empty ones
    empty; repeated rows stay; columns of any name stay as they are; an empty table stays empty."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents (repeated rows each on its own, null ids kept); a null or empty
    text is one piece, the end token; an empty table has none."""
    return packing.pack(docs)


STAGES = [("language_id", known_language), ("simhash_dedup", one_of_each_group),
          ("decontamination", without_benchmark), ("pii", redacted), ("packing", packed)]

#: No SQL expresses the stages (random letter vectors, hashes, boosted trees, a tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    docs, mark = read_table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear(spark, since=mark, keep=(last_written(),))       # what the stage read and wrote on its way
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
