import __spark_entry__ as entry

import corpus_pipeline
from ordermart.llm import decontam, langid, simhash

from .conftest import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_does_its_work(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = [r.doc_id for r in langid.op10_query(docs).collect() if r.lang_pred != "und"]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_dedup", "decontamination", "pii", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == COLUMNS
        if name == "language_id":
            assert sorted(r.doc_id for r in docs.collect()) == sorted(want)
        if name == "simhash_dedup":
            groups = {r.component_id for r in simhash.op9_query(before).collect()}
            assert sorted(r.doc_id for r in docs.collect()) == sorted(groups)
        if name == "decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            clean = [r.doc_id for r in decontam.op7_query(before, items).collect() if not r.contaminated]
            assert sorted(r.doc_id for r in docs.collect()) == sorted(clean) and 0 < len(clean) < before.count()
        if name == "pii":
            assert docs.count() == before.count()
            assert docs.where("text like '%[EMAIL]%' or text like '%[IP]%' or text like '%[CARD]%'").count() > 0
        if name == "packing":
            ends = {(r.doc_id, r.doc_tokens) for r in docs.collect()}
            assert len(ends) == before.count()


AWKWARD = ["doc_id", "text", "lang", "source", "n_chars", "fp", "place", "row_place", "lang_pred", "score"]


def test_run_over_awkward_rows_and_an_empty_benchmark(spark, tmp_path, texts):
    """Null texts and ids, repeated rows, clashing names, no benchmark item: every stage in turn."""
    rows = texts[:40] + [(1, None), (2, ""), (None, None), (None, texts[0][1]), texts[3], texts[3], (9000, "?! 12"),
                         (9001, "mail a.b@example.org " * 3 + texts[5][1]), (9002, texts[6][1] * 40)]
    full = [(i, t, None if k % 5 == 0 else "en", None, None, "x", 1, "y", 2.0, True) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(full, ", ".join(f"{c} {t}" for c, t in zip(AWKWARD, (
        "long", "string", "string", "string", "long", "string", "int", "string", "double", "boolean"))))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        if name != "packing":
            assert docs.columns == AWKWARD
            sizes.append(docs.count())
    assert len(rows) - 12 < sizes[0] <= len(rows) - 4 and sizes[1] <= sizes[0] - 3 and sizes[1] == sizes[2] == sizes[3]
    assert docs.select("doc_id", "start").count() > 0
    packed = corpus_pipeline.run(spark, str(tmp_path))
    key = ["doc_id", "start", "length", "doc_tokens", "sequence_id"]
    assert sorted(map(str, packed.select(key).collect())) == sorted(map(str, docs.select(key).collect()))


def test_run_leaves_its_result_alone(spark, texts, tmp_path):
    from ordermart.llm import common
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts[:20]], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    before = common.written()
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert common.written() == before + 1 and out.count() > 0          # all other tables are deleted
    common.clear(spark, before)
    assert common.written() == before


def test_run_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_once_each():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14)) and "pipeline" in names
    assert {"op6_warc", "op7_decontamination"} <= set(entry.oracle_sql())
