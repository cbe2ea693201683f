from pyspark.sql import functions as F

from ordermart.llm import common


def test_places_in_files_are_unique_and_the_same_on_every_scan(spark, make_docs, texts, restless):
    docs = make_docs(texts * 3, 5).withColumn("file_path", F.lit("mine")).where("doc_id is not null")
    whole = common.placed(docs, "at", "documents")
    assert whole.columns == docs.columns + ["at"]
    first = {(r.at, r.doc_id) for r in whole.collect()}
    assert len(first) == len({a for a, _ in first}) == 3 * len(texts)
    restless()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    assert {(r.at, r.doc_id) for r in whole.select("doc_id", "at").collect()} == first
    files = common.last_written()
    assert spark.read.parquet(files).count() == 5                 # the list of files, not the rows


def test_other_tables_are_stored_with_their_numbers(spark, make_docs, texts):
    docs = make_docs(texts, 3)
    for df in (docs.union(docs), docs.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), spark.createDataFrame(
            [(i, t) for i, t in texts] * 2, "doc_id long, text string")):
        whole = common.placed(df, "at", "documents")
        assert len({r.at for r in whole.select("at").collect()}) == 2 * len(texts)
        assert spark.read.parquet(common.last_written()).count() == 2 * len(texts)
