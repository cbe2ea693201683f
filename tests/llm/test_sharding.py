import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import sharding


def test_contract_on_awkward_rows(make_docs, texts):
    rows = texts[:150] + [(900, None), (901, ""), (None, "x"), (None, "x"), (5, "same")] + [(5, "same")] * 60
    docs = make_docs(rows, 4)
    got = sharding.op3_query(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_same_seed_same_order_in_many_buckets(make_docs, texts):
    docs = make_docs(texts, 4).select("doc_id", "text")
    runs = [{(r.doc_id, r.shard, r.slot) for r in sharding.shuffled(docs, seed=s, bucket_bytes=20_000).collect()} for s in (1, 1, 2)]
    assert runs[0] == runs[1] != runs[2]
    order = [i for _, _, i in sorted((t, s, i) for i, s, t in runs[0])]
    assert order != sorted(order)


def test_empty_table_few_rows_and_clashing_columns(spark, make_docs, tmp_path):
    docs = make_docs([(1, "a"), (2, "b")]).withColumn("bucket", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("place", F.lit(2))
    out = sharding.shuffled(docs)
    assert out.columns == docs.columns + ["shard", "slot"] and {(r.shard, r.slot) for r in out.collect()} == {(0, 0), (1, 0)}
    assert sharding.op3_query(docs.limit(0)).count() == 0
    sharding.write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2


def test_taken_names_are_refused(make_docs):
    import pytest
    with pytest.raises(ValueError):
        sharding.shuffled(make_docs([(1, "a")]).withColumn("Slot", F.lit(1)))


def test_very_long_texts(make_docs):
    rows = [(1, "word " * 800_000), (2, "é" * 2_000_000), (3, "x")]
    got = {r.doc_id: r for r in sharding.op3_query(make_docs(rows)).collect()}
    assert [got[i]["size"] for i in (1, 2, 3)] == [len(t.encode()) + 1 for _, t in rows]
    assert [got[i].text_crc32 for i in (1, 2)] == [zlib.crc32(t.encode()) for _, t in rows[:2]]


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding.fisher_yates(3, 7, b)) for b in range(6000))
    assert len(seen) == 6 and max(seen.values()) < 1.15 * min(seen.values())
    assert np.array_equal(np.sort(sharding.fisher_yates(50, 1, 2)), np.arange(50))
    assert len(sharding.fisher_yates(0, 1, 1)) == 0
