import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.llm import importance
from tests.llm.conftest import SF

AWKWARD = [(9001, None), (9002, ""), (9003, " .,;\n"), (9004, "A a É é 中文 x_y 0-9 " * 4), (None, "the and " * 15),
           (None, "the and " * 15), (9005, "the " * 70000), (9005, "the " * 70000), (9006, "\x00\x7f\x85 a b " * 20)]


def brute(docs, targets, longest=1, buckets=10000, seed=2024, percent=10, least=20):
    def features(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                        for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    raw, want = Counter(), Counter()
    for _, t in docs:
        raw.update(features(t)[1])
    for t in targets:
        want.update(features(t)[1])
    S, T = raw.total(), want.total()
    gain = [math.floor(1000 * math.log((want[b] + 1) * (S + buckets) / ((raw[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for d, t in docs:
        n, f = features(t)
        w = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = {id(r): i + 1 for i, r in enumerate(fit[:percent * len(fit) // 100])}
    return sorted(((r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in rows), key=repr)


@pytest.fixture(scope="module")
def bench_texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def test_equals_brute_force(spark, make_docs, texts, bench_texts):
    rows = texts + AWKWARD
    target = spark.createDataFrame([(t,) for t in bench_texts], "text string")
    got = importance.op11_query(make_docs(rows), target)
    assert [d for _, d in got.dtypes] == ["bigint"] * 5
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, bench_texts)


def test_other_parameters(spark, make_docs, texts, bench_texts):
    rows = texts[:30] + AWKWARD
    target = spark.createDataFrame([(t,) for t in bench_texts[:5]] + [(None,)], "text string")
    got = importance.importance(make_docs(rows).select("doc_id", "text"), target, longest=3, buckets=70_001, seed=7,
                                percent=33, least_words=0)
    got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, bench_texts[:5], 3, 70_001, 7, 33, 0)


def test_planes_give_the_sum_of_gains():
    rng = np.random.default_rng(1)
    gains = rng.integers(-9000, 9000, 1001)
    gains[:3] = 0, 1 << 40, -(1 << 41)
    planes, powers = importance.gain_planes(gains)
    lengths = np.array([0, 5, 100_000, 1, 0, 3000])
    ids = rng.zipf(1.2, lengths.sum()) % 1001
    ends = np.cumsum(lengths)
    want = [int(gains[ids[e - n:e]].sum()) for n, e in zip(lengths, ends)]
    assert importance.plane_weights(lengths, ids, planes, powers, 1001).tolist() == want
    none = importance.gain_planes(np.zeros(1001, np.int64))
    assert importance.plane_weights(lengths, ids, *none, 1001).tolist() == [0] * 6


def test_empty_tables(spark, make_docs, texts):
    docs, none = make_docs(texts[:5] + [(1, None)]), spark.createDataFrame([], "text string")
    assert importance.op11_query(docs.limit(0), none).count() == 0
    got = importance.op11_query(docs, none).collect()
    assert sorted(map(tuple, got), key=repr) == brute(texts[:5] + [(1, None)], [])


def test_result_does_not_depend_on_partitions(spark, make_docs, texts, bench_texts):
    target = spark.createDataFrame([(t,) for t in bench_texts], "text string")
    one, many = (sorted(map(tuple, importance.op11_query(make_docs(texts, p), target).collect())) for p in (1, 7))
    assert one == many


def test_resample_keeps_the_drawn_rows_whole(spark, make_docs, texts, bench_texts):
    docs = make_docs(texts).withColumn("rank", F.lit("mine")).withColumn("source_row", F.lit(1))
    target = spark.createDataFrame([(t,) for t in bench_texts], "text string")
    got = importance.resample(docs, target, percent=20)
    assert got.columns == docs.columns
    want = {r[0] for r in brute(texts, bench_texts, percent=20) if r[4]}
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)
    with pytest.raises(ValueError):
        importance.importance(docs, target)
