import numpy as np
import pytest

from ordermart.llm import ann

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=10):
    """Every usable query against every usable other row, in double precision."""
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    if not fine:
        return []
    sizes = [len(v) for _, v in fine]
    common = max(set(sizes), key=lambda n: (sizes.count(n), n))
    fine = [(i, v) for i, v in fine if len(v) == common]
    ids, x = np.array([i for i, _ in fine]), np.array([v for _, v in fine])
    out = []
    for at, (i, v) in enumerate(fine):
        if i % every == 0:
            d = np.sqrt(((x - v) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if j != at][:k]
            out += [(i, r + 1, int(ids[j]), d[j]) for r, j in enumerate(order)]
    return sorted(out)


def made(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS).repartition(parts)


def recall(got, want):
    return len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in want}) / len(want)


def clustered(n=4000, d=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(60, d)) * 2
    return [(i, v) for i, v in enumerate((centres[rng.integers(0, 60, n)] + rng.normal(size=(n, d)) * 0.3).astype(np.float32).tolist())]


def test_few_rows_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(300, 8)).astype(np.float32).tolist())]
    rows += [(700, rows[5][1]), (600, rows[100][1]), (None, rows[1][1]), (1000, None), (1100, []), (1200, [0.0] * 8),
             (1300, [1.0] * 7 + [float("nan")]), (1400, [1.0] * 7 + [float("inf")]), (1500, [1.0] * 7 + [None]), (1600, [1.0] * 5),
             (1700, [3e38] * 8), (1800, [1e-38] * 8), (800, rows[5][1]), (800, rows[5][1])]
    got = ann.op13_query(made(spark, rows))
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    got = sorted(map(tuple, got.collect()))
    assert got == brute(rows)


def test_fewer_candidates_than_asked_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [0.0, 0.0])]
    assert sorted(map(tuple, ann.op13_query(made(spark, rows)).collect())) == brute(rows) == [(0, 1, 1, 1.0)]
    assert ann.op13_query(made(spark, rows[2:])).count() == 0
    assert ann.op13_query(made(spark, rows).limit(0)).count() == 0


def test_partitions_reach_the_recall_with_few_probes(spark):
    rows = clustered()
    df = made(spark, rows).select("vec_id", "embedding")
    index = ann.build(df, per_partition=125)
    assert len(index.sizes) == 32 and index.sizes.sum() == len(rows)
    assert index.recall >= 0.95 and index.probes <= 8
    got = sorted(map(tuple, ann.search(index, df.where("vec_id % 20 = 0")).collect()))
    want = brute(rows, every=20)
    assert len(got) == len(want) and recall(got, want) >= 0.9
    exact = {(q, v): d for q, _, v, d in brute(rows, every=20, k=len(rows))}
    assert all(exact[q, v] == d for q, _, v, d in got)
    assert [r[1] for r in got] == list(range(1, 11)) * 200


def test_random_vectors_reach_the_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = [tuple(r) for r in ann.op13_query(table).collect()]
    want = brute([(r.vec_id, r.embedding) for r in table.collect()])
    assert len(got) == len(want) and recall(got, want) >= 0.9


def test_hot_copies_and_small_blocks(spark, monkeypatch):
    rows = clustered(2000) + [(i, [1.0] * 16) for i in range(2000, 3000)]
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "QUERIES", 7)
    df = made(spark, rows, 6).select("vec_id", "embedding")
    index = ann.build(df, per_partition=100)
    assert index.rows.count() == 2011                     # k + 1 of the copies can be answers
    got = sorted(map(tuple, ann.search(index, df.where("vec_id % 100 = 0")).collect()))
    want = brute(rows)
    assert recall(got, want) >= 0.9
    copies = [r for r in got if r[0] >= 2000]
    assert copies == [r for r in want if r[0] >= 2000] and {r[3] for r in copies} == {0.0}


def test_too_small_partitions_are_made_up_for(spark):
    rows = [(i, [float(i // 3 + 1), 1.0]) for i in range(60)]
    df = made(spark, rows).select("vec_id", "embedding")
    index = ann.build(df, per_partition=3, recall=0.01)
    got = ann.search(index, df.where("vec_id % 20 = 0")).collect()
    assert len(got) == 30


def test_partitions_are_balanced_and_cut_few_edges():
    x = np.array([v for _, v in clustered(1500)])
    graph = ann.neighbour_graph(x, 10)
    label, shares = ann.partitioned(x, graph, 12)
    size = np.bincount(label, minlength=12)
    assert size.min() >= 0.85 * 125 and size.max() <= 1.15 * 125
    start = ann._halved(x, 12)
    assert (label[graph] == label[:, None]).mean() > max(0.75, (start[graph] == start[:, None]).mean())
    assert shares.sum() == 2 * graph.size


def test_neighbour_graph_is_exact():
    x = np.random.default_rng(5).normal(size=(300, 6))
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2) + np.diag([np.inf] * 300)
    assert [set(r) for r in ann.neighbour_graph(x, 4)] == [set(r) for r in np.argsort(d, axis=1)[:, :4]]


@pytest.mark.parametrize("kind", ["array<double>", "array<int>"])
def test_other_component_types(spark, kind):
    df = spark.createDataFrame([(i, [i % 7 + 1, i // 7]) for i in range(40)], f"vec_id long, embedding {kind.replace('double', 'int')}")
    df = df.withColumn("embedding", df.embedding.cast(kind))
    assert [tuple(r) for r in ann.op13_query(df).orderBy("rank").limit(1).collect()] == [(0, 1, 1, 1.0)]
