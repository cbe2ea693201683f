import zlib

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import langid

from .conftest import SF


def brute_bundle(text, dim, seed):
    s = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    s = " " + " ".join(s.split()) + " "
    out = np.zeros(dim)
    for i in range(len(s) - 2):
        v = [langid.letter_vector(ord(c), dim, seed).astype(int) for c in s[i:i + 3]]
        out += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return out


def test_bundles_equal_brute_force_also_for_wide_alphabets(texts, monkeypatch):
    sample = [t for _, t in texts[:6]] + ["äö 中文字 abc", "a", "x\ty", "ß" * 50]
    want = np.stack([brute_bundle(t, 64, 5) for t in sample])
    assert np.array_equal(langid.bundles(sample, list(range(len(sample))), len(sample), 64, 5), want)
    monkeypatch.setattr(langid, "_DENSE", 10)       # count by sorting
    monkeypatch.setattr(langid, "_BLOCK", 100)      # long texts in blocks
    assert np.array_equal(langid.bundles(sample, list(range(len(sample))), len(sample), 64, 5), want)
    monkeypatch.setattr(langid, "_CELLS", 10)       # few counts at once
    monkeypatch.setattr(langid, "_COLUMNS", 7)
    assert np.array_equal(langid.bundles(sample, list(range(len(sample))), len(sample), 64, 5), want)


def test_many_letters_need_little_memory():
    """4 MB of text over 20,000 letters in one slice: the worker stays under 300 MB."""
    import subprocess
    import sys
    program = """
import resource, numpy as np
from ordermart.llm import langid
rng = np.random.default_rng(3)
texts = ["".join(map(chr, 0x4E00 + rng.zipf(1.3, 2800) % 20000)) for _ in range(512)]
assert sum(len(t.encode()) for t in texts) > 4 << 20
got = langid.bundles(texts, list(range(512)), 512, langid.DIM, 1)
assert got.any(axis=1).all()
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    out = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, check=True, env={"OMP_NUM_THREADS": "1", **__import__("os").environ})
    assert int(out.stdout.split()[-1]) < 300 << 10


def test_cosine_and_choice_equal_brute_force(texts):
    sample = [t for _, t in texts[:12]] + ["x", "zz qq"]
    proto = {"a": brute_bundle(" ".join(t for _, t in texts[:3]), 64, 5), "b": brute_bundle(texts[5][1], 64, 5)}
    unit = np.stack([v / np.linalg.norm(v) for v in proto.values()])
    langs, scores = langid.predict(sample, list(proto), unit, 64, 5)
    for t, lang, score in zip(sample, langs, scores):
        p = brute_bundle(t, 64, 5)
        cos = {k: float(p @ v / np.linalg.norm(p) / np.linalg.norm(v)) for k, v in proto.items()}
        assert lang == max(cos, key=cos.get) and abs(score - max(0, cos[lang])) < 1e-12


def test_expected_cosine_of_drawn_ngrams():
    rng = np.random.default_rng(2)
    vectors = rng.choice([-1.0, 1.0], (3000, 4096))
    share = 1 / np.arange(1, 3001) ** 0.9
    share /= share.sum()
    n = 200_000
    prototype = rng.multinomial(n, share) @ vectors
    variety = langid.variety_of(prototype, n)
    assert abs(variety * (share ** 2).sum() - 1) < 0.1
    for k in (5, 50, 1000):
        got = []
        for _ in range(30):
            p = rng.multinomial(k, share) @ vectors
            got.append(p @ prototype / np.linalg.norm(p) / np.linalg.norm(prototype))
        assert abs(np.mean(got) - langid.expected_cosine(k, variety)) < 0.05


def test_stage_rejects_strange_texts_of_any_length(spark, make_docs):
    """Languages made of their own words; random letters go from some length on, known texts never."""
    rng = np.random.default_rng(6)
    def text(words, n):
        return " ".join(rng.choice(words, n))
    words = {k: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 7))) for _ in range(60)] for k in range(2)}
    known = [(i, text(words[i % 2], n)) for i, n in enumerate([1, 2, 3, 5, 8, 12, 20, 50, 100, 400] * 30)]
    strange = [(1000 + i, "".join(rng.choice(list("αβγδεζηθικλμνξοπρστυφχψω "), n))) for i, n in enumerate([300, 600, 1200, 5000, 20000])]
    docs = make_docs(known + strange).withColumn("lang", F.when(F.col("doc_id") < 1000, F.concat(F.lit("l"), F.col("doc_id") % 2)))
    kept = {r.doc_id for r in langid.keep_known(docs).collect()}
    assert kept >= {i for i, _ in known} and not kept & {i for i, t in strange if len(t) >= 600}


def test_very_long_texts_in_one_go_and_in_blocks(texts):
    long = " ".join(t for _, t in texts) * 12
    assert len(long) > langid._BLOCK
    short = [" ".join(t for _, t in texts)]
    proto = {"a": brute_bundle(texts[0][1], 64, 5), "b": brute_bundle(texts[5][1], 64, 5)}
    unit = np.stack([v / np.linalg.norm(v) for v in proto.values()])
    a, b = langid.predict([long], list(proto), unit, 64, 5), langid.predict(short, list(proto), unit, 64, 5)
    assert a[0] == b[0] and abs(a[1][0] - b[1][0]) < 0.01


def test_letterless_texts_are_unknown():
    proto = {"a": np.ones(langid.DIM), "b": -np.ones(langid.DIM)}
    unit = np.stack([v / np.linalg.norm(v) for v in proto.values()])
    langs, scores = langid.predict([None, "", "12 34 !", "hello"], ["a", "b"], unit, langid.DIM, 1)
    assert langs[:3] == ["und"] * 3 and list(scores[:3]) == [0, 0, 0] and langs[3] in "ab"
    assert langid.predict(["hello"], [], np.zeros((0, 8)), 8, 1)[0] == ["und"]


def test_held_out_accuracy_and_contract(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.op10_query(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98


def test_labels_of_held_out_rows_do_not_matter(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "zz").otherwise(F.col("lang")))
    a = {tuple(r) for r in langid.op10_query(docs).collect()}
    assert a == {tuple(r) for r in langid.op10_query(changed).collect()}


def test_nulls_repeats_empty_table_and_clashing_columns(spark, make_docs):
    docs = make_docs([(1, "the cat and the dog"), (1, "the cat and the dog"), (None, "the end"), (2, None), (3, ""), (4, "??")])
    got = langid.op10_query(docs).collect()
    assert len(got) == 6 and not any(r.held_out is None for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (2, 3, 4)} == {"und"}
    extra = docs.withColumn("lang_pred", F.lit(7)).withColumn("score", F.lit("x")).withColumn("text_of", F.lit(1))
    kept = langid.keep_known(extra)
    assert kept.columns == extra.columns
    assert sorted(r.text for r in kept.collect()) == ["the cat and the dog"] * 2 + ["the end"]
    assert langid.op10_query(docs.limit(0)).count() == 0
    no_lang = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.op10_query(no_lang).collect()} == {"und"}
