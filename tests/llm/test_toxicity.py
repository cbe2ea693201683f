import zlib

import numpy as np

from ordermart.llm import toxicity as X


def test_pairs_count_that_single_terms_miss():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(3000):       # toxic exactly if both or neither of two terms are there
        a, b = rng.integers(0, 2, 2)
        other = np.unique(rng.integers(100, 140, 5))
        rows.append((np.array(sorted({10 * a, 20 + 10 * b} | set(other.tolist()))), int(a == b)))
    m = X.train(rows)
    right = sum((m.margin(t) > 0) == bool(y) for t, y in rows)
    assert right / len(rows) > 0.95


def test_margin_is_the_explicit_sum_over_pairs():
    rng = np.random.default_rng(4)
    buckets = np.sort(rng.choice(1000, 60, replace=False))
    m = X.Machine(0.3, buckets, rng.normal(size=60), rng.normal(size=(60, X.FACTORS)))
    for n in (0, 1, 2, 17, 200):
        terms = np.sort(rng.choice(1000, n, replace=False))
        known = [i for i, b in enumerate(buckets) if b in set(terms.tolist())]
        want = 0.3 + sum(m.weight[i] for i in known) + sum(
            float(m.latent[i] @ m.latent[j]) for a, i in enumerate(known) for j in known[a + 1:])
        assert abs(m.margin(terms) - want) < 1e-9


def _rare_pair(seed):
    """Half of 6,000 documents toxic by word 30, or by 10 and 20 together (54 documents each way, so
    that each alone is neutral and in under 2 %), 12 by word 40."""
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, 4001)
    rows = [set((1000 + rng.choice(4000, 60, p=share / share.sum())).tolist()) for _ in range(6000)]
    for i, row in enumerate(rows):
        if i < 3000:
            row |= {10, 20} if i < 54 else {40} if i < 66 else {30}
        elif i < 3108:
            row |= {10} if i < 3054 else {20}
    order = rng.permutation(6000)
    return [(np.array(sorted(rows[i])), int(i < 3000)) for i in order]


def test_rare_terms_count_that_are_neutral_alone():
    m = X.train(_rare_pair(0))
    test = [(set(t.tolist()), m.margin(t)) for t, _ in _rare_pair(1)]
    both = np.mean([z > 0 for t, z in test if {10, 20} <= t])
    one = np.mean([z > 0 for t, z in test if len(t & {10, 20}) == 1])
    assert both > 0.6 and one < 0.05
    # a word found in 12 toxic documents alone
    clean = [t for t, _ in _rare_pair(1) if not {10, 20, 30, 40} & set(t.tolist())]
    assert all(m.margin(np.append(t, 40)) > m.margin(t) + 1 for t in clean[:100])


def test_one_class_or_nothing_gives_a_constant():
    assert X.train([]).score("x") < 0.01
    assert X.train([(np.array([1]), 1)]).score(None) > 0.9


def test_terms_do_not_depend_on_blocks(texts, monkeypatch):
    want = [X.terms_of(t).tolist() for _, t in texts[:30]]
    monkeypatch.setattr(X, "_BLOCK", 64)
    assert want == [X.terms_of(t).tolist() for _, t in texts[:30]]
    assert not len(X.terms_of(None)) and not len(X.terms_of("1 2"))


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = X.op8_query(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
               and r.predicted == int(r.score >= 0.3) for r in got)
    out = [r for r in got if r.held_out and r.toxic is not None]
    pos, neg = np.array([r.score for r in out if r.toxic == 1]), np.array([r.score for r in out if r.toxic == 0])
    assert (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean() > 0.95
    assert (neg >= 0.3).mean() < 0.01


def test_awkward_rows_and_labels(spark, make_docs, texts):
    rows = texts[:40] + [(900, None), (901, ""), (None, "trash"), texts[0], texts[0]]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in texts[:40]] + [(texts[0][0], 0, 1), (None, 1, 1), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = X.op8_query(docs, labels).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id == texts[0][0]}) == 1
    none = X.op8_query(docs, labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1
    assert X.op8_query(docs.limit(0), labels).count() == 0
