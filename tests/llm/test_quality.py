import re
from collections import Counter

from ordermart.llm import quality

from .conftest import SF


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_surface_counts_equal_brute_force(texts, monkeypatch):
    sample = [t for _, t in texts] + [None, "", " \n\t", "a", "a a a a", "x\nx\r\nx\n \nx", "é|ü<> # \x1c \x85  b", "q r s q r s", "| | |"]
    for t in sample:
        assert quality.surface(t) == brute(t)
    monkeypatch.setattr(quality, "_BLOCK", 30)
    for t in sample:
        assert quality.surface(t) == brute(t)


def test_blocks_do_not_change_the_ngrams(texts, monkeypatch):
    whole = [Counter(b for part in quality.buckets_of(t) for b in part.tolist()) for _, t in texts[:20]]
    monkeypatch.setattr(quality, "_BLOCK", 50)
    assert whole == [Counter(b for part in quality.buckets_of(t) for b in part.tolist()) for _, t in texts[:20]]


def test_labelled_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.op4_query(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(got) == docs.count()
    passed = [r for r in got if not r.base_failed]
    good, bad = [r for r in passed if r.quality == 1], [r for r in passed if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good) and sum(r.kept for r in bad) <= 0.1 * len(bad)
    assert not any(r.kept for r in got if r.base_failed)


def test_verdict_equals_brute_force(spark, make_docs):
    """Log ratio of both multinomials, its mean per n-gram, the threshold and the verdict, anew."""
    import math

    import numpy as np
    import xxhash
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(70001, None), (70002, "")]
    docs = make_docs(rows)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    trusted = {r.doc_id: r.last for r in labels.where("quality = 1").select("doc_id", (F.pmod(F.xxhash64(
        F.lit(1), F.col("doc_id").cast("string")), F.lit(quality.CALIBRATE)) == 0).alias("last")).distinct().collect()}
    mask = (1 << 64) - 1

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        both = h + [(a * 3 + b) & mask for a, b in zip(h, h[1:])]
        return [(x * 0x9E3779B97F4A7C15 & mask) >> 48 for x in both]
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if trusted.get(i) is False:
            target.update(grams(t))
    n = quality.BUCKETS
    ratio = lambda b: math.log((target[b] + 1) / (target.total() + n)) - math.log((raw[b] + 1) / (raw.total() + n))
    want = {}
    for i, t in rows:
        words, _, _, _, repeated = brute(t)
        g = grams(t)
        want[i] = (words < 50 or 100 * repeated > 50 * words, sum(map(ratio, g)) / len(g) if g else 0.0)
    least = np.percentile([llr for i, (failed, llr) in want.items() if trusted.get(i) and not failed], 100 * (1 - quality.KEEP)) - quality.MARGIN
    got = quality.judge(docs, labels).collect()
    assert len(got) == len(rows) and abs(got[0].threshold - least) < 1e-9
    for r in got:
        failed, llr = want[r.doc_id]
        assert r.base_failed == failed and abs(r.llr - llr) < 1e-9
        assert r.kept == (not failed and llr >= least) or abs(llr - least) < 1e-9
    assert 0 < sum(r.kept for r in got) < sum(not r.base_failed for r in got) + 1


def test_awkward_rows_and_labels(spark, make_docs, texts):
    rows = texts[:30] + [(900, None), (901, ""), (None, texts[0][1]), texts[0], texts[0]]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in texts[:20]] + [(texts[0][0], 0, 0), (None, 1, 1), (texts[1][0], None, None)],
                                   "doc_id long, quality int, toxic int")
    got = quality.op4_query(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    none = quality.op4_query(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none)
    assert quality.op4_query(docs.limit(0), labels).count() == 0


def test_every_trusted_document_counts(spark):
    """More trusted documents than any bound of old: target counts and threshold come from all of them."""
    import math

    import numpy as np
    import xxhash
    from pyspark.sql import functions as F
    n = 20_800
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr(
        "array_join(transform(sequence(0, 51), i -> concat('w', (id * id + id * i + i * i * i) % 997)), ' ')").alias("text"))
    labels = docs.where("doc_id % 40 != 0").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    last = {r.doc_id for r in docs.where(F.pmod(F.xxhash64(F.lit(1), F.col("doc_id").cast("string")), F.lit(quality.CALIBRATE)) == 0)
            .select("doc_id").collect()}
    hashes = {f"w{i}": xxhash.xxh64_intdigest(f"w{i}".encode()) for i in range(997)}
    counts = np.zeros((2, quality.BUCKETS), np.int64)
    grams = {}
    for r in docs.collect():
        h = np.array([hashes[w] for w in r.text.split()], np.uint64)
        both = np.concatenate((h, h[:-1] * np.uint64(3) + h[1:])) * np.uint64(0x9E3779B97F4A7C15)
        grams[r.doc_id] = (both >> np.uint64(48)).astype(np.int64)
        np.add.at(counts[1], grams[r.doc_id], 1)
        if r.doc_id % 40 and r.doc_id not in last:
            np.add.at(counts[0], grams[r.doc_id], 1)
    p = (counts + 1) / (counts.sum(axis=1, keepdims=True) + quality.BUCKETS)
    want = {i: float((np.log(p[0]) - np.log(p[1]))[g].mean()) for i, g in grams.items()}
    got = quality.judge(docs, labels).collect()
    assert len(got) == n and all(math.isclose(r.llr, want[r.doc_id], abs_tol=1e-9) for r in got)
    held = [r.llr for r in got if not r.base_failed and r.doc_id % 40 and r.doc_id in last]
    assert len(held) > 5000
    assert abs(got[0].threshold - (np.percentile(held, 100 * (1 - quality.KEEP)) - quality.MARGIN)) < 1e-9
