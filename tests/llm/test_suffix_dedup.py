import hashlib
import random

import numpy as np

from ordermart.llm import suffix_dedup as S


def brute(rows, length=100):
    """rows in order of age: (doc_id, bytes removed, spans, hash of what is kept)."""
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            w = data[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def awkward(texts):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefg ") for _ in range(260))
    rows = [(i, t) for i, t in texts[:60]]
    rows += [(1000 + i, "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 150))) + passage[rng.randint(0, 60):rng.randint(150, 260)]
              + "".join(rng.choice("uvw ") for _ in range(rng.randint(0, 150)))) for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, "a" * 700), (2003, "ab" * 300 + "a" * 150), (2004, "é" * 120), (2005, passage[:99]),
             (2006, passage[:100]), (2007, passage[80:180] + passage[80:180]), (2008, "\0" * 130 + "b"), (2009, "\0" * 130)]
    rows += [(3000, passage * 12), (3001, passage * 12)]
    return rows


def test_against_brute_force(make_docs, texts):
    rows = awkward(texts)
    assert result(S.op5_query(make_docs(rows, 5))) == brute(sorted(rows))


def test_small_chunks_tasks_and_buckets_change_nothing(make_docs, texts, monkeypatch):
    rows = awkward(texts)
    monkeypatch.setattr(S, "BUCKET_SUFFIXES", 40)       # many splitters: most windows cross a boundary
    monkeypatch.setattr(S, "BUCKET_BYTES", 20_000)
    assert result(S.op5_query(make_docs(rows, 5))) == brute(sorted(rows))


def test_chunks_of_one_text():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 100, 3000).astype(np.uint8)
    whole = {(a, p) for _, _, at, b, e in [S.anchors(raw, 0, 2901, 100, 24)] for a, x, y in zip(at, b, e) for p in range(x, y + 1)}
    parts = set()
    for first in range(0, 2901, 500):
        _, _, at, b, e = S.anchors(raw, first, min(2901, first + 500), 100, 24)
        parts |= {(a, p) for a, x, y in zip(at, b, e) for p in range(x, y + 1)}
    assert whole == parts and {p for _, p in whole} == set(range(2901))


def test_repeated_ids_null_ids_and_empty_table(spark, make_docs):
    text = "some words that are long enough to be told apart from others by their hundred bytes, yes indeed they are so"
    docs = make_docs([(7, text), (None, text), (3, text), (7, text)], 1)
    got = result(S.op5_query(docs))
    assert [(r[0], r[2] > 0) for r in got] == [(3, False), (7, True), (7, True), (None, True)]
    assert S.op5_query(docs.limit(0)).count() == 0


def test_multikey_quicksort_and_prefixes():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 2, (500, 20)).astype(np.uint8)
    text[::7] = text[0]
    order = S.multikey_quicksort(text)
    rows = [bytes(text[i]) for i in order]
    assert rows == sorted(rows) and sorted(order) == list(range(500))
    prefix = S.common_prefix(text, order)
    for i in range(1, 500):
        n = prefix[i]
        assert rows[i][:n] == rows[i - 1][:n] and (n == 20 or rows[i][n] != rows[i - 1][n])


def test_row_numbers_survive_a_change_of_cores(make_docs, texts, restless):
    docs = make_docs(texts + texts[:30], 5)
    want = sorted(map(repr, S.op5_query(docs).collect()))
    restless(S)
    assert sorted(map(repr, S.op5_query(docs).collect())) == want
