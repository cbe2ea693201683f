import hashlib
import re

from ordermart.llm import decontam

from .conftest import SF


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - k + 1) if w else 0):
            grams.setdefault(tuple(w[i:i + k]), set()).add(item)
    lengths = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                g = grams.get(tuple(w[i:i + n]))
                if g:
                    hit |= set(range(i, i + n))
                    found |= g
        ids = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted((x + (n,) for x, n in zip(out, brute_near(docs, items))), key=repr)


def brute_near(docs, items, k=10, slop=5):
    """Documents' numbers of items with every term of a window near an occurrence of its rarest term."""
    count = {}
    for _, t in docs:
        for w in words(t):
            count[w] = count.get(w, 0) + 1
    out = []
    for _, text in docs:
        w, found = words(text), set()
        for item, t in items:
            v = words(t)
            for i in range(max(1, len(v) - k + 1) if v else 0):
                terms = v[i:i + k]
                rare = min(range(len(terms)), key=lambda j: (count.get(terms[j], 0), j))
                reach = len(terms) - 1 + slop
                if any(x == terms[rare] and set(terms) <= set(w[max(0, p - reach):p + reach + 1]) for p, x in enumerate(w)):
                    found.add(item)
                    break
        out.append(len(found))
    return out


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ITEMS = [("b1", "The quick brown fox, jumps over the lazy dog today and again"), ("b2", "short one"), ("b3", None), ("b4", "..."),
         (None, "no id"), ("b10", "SHORT one"), ("b5", "Élan vital über alles"), ("b6", "a a a a a a a a a a a a")]


def test_against_brute_force(spark, make_docs, monkeypatch):
    docs = [(1, "x THE quick brown fox jumps, over the lazy dog TODAY y"), (1, "short"), (2, "a short-one b short one"), (3, None),
            (4, ""), (None, "élan vital über alles"), (5, "Élan vital über alles"), (6, "a " * 40), (7, "one short"),
            (8, "the quick brown fox jumps over the lazy dog"), (9, "w " * 30000 + "short one")]
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    want = brute(docs, [x for x in ITEMS if x[0] and x[1]])
    table = make_docs(docs)
    assert result(decontam.op7_query(table, items)) == want
    # several benchmark blocks and small segments give the same
    parts = decontam.matches(table.select("doc_id", "text"), items, block_bytes=20)
    got = sorted(((r.doc_id, r.n_words, len(r["items"]), bool(r.spans)) for r in parts.collect()), key=repr)
    assert got == sorted(((d, n, m, c) for d, n, _, m, _, c, _ in want), key=repr)
    hits = parts.select("doc_id", decontam.n_hit(parts.spans).alias("n")).collect()
    assert sorted(r.n for r in hits) == sorted(w[2] for w in want)
    assert result(decontam.op7_query(table, items.limit(0))) == brute(docs, [])
    assert decontam.op7_query(table.limit(0), items).count() == 0


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(str(r.item_id), r.text) for r in items.collect()])
    assert result(decontam.op7_query(docs, items)) == want
    clean = {w[0] for w in want if not w[5]}
    assert {r.doc_id for r in decontam.drop_contaminated(docs, items).collect()} == clean


def test_proximity_matches(spark, make_docs):
    items = spark.createDataFrame([("i", "alpha beta gamma")], "item_id string, text string")
    docs = make_docs([(1, "beta x alpha gamma"), (2, "alpha q q q q q beta gamma"), (3, "alpha beta"), (4, "alpha beta gamma")])
    near = {r.doc_id: (list(r["items"]), list(r.near)) for r in
            decontam.matches(docs.select("doc_id", "text"), items, slop=2).collect()}
    assert near == {1: ([], ["i"]), 2: ([], []), 3: ([], []), 4: (["i"], ["i"])}


def test_a_segment_visits_only_windows_filed_under_its_terms():
    import numpy as np
    queries = decontam.windows_of([("a", "common common rare0"), ("b", "common common rare1"), ("c", "common other")])
    number = {w.decode(): n for w, n in queries.vocabulary.items()}
    rarity = {number["common"]: 100, number["rare0"]: 1, number["rare1"]: 2, number["other"]: 50}
    filed = {}
    for k, w in enumerate(queries.windows):
        filed.setdefault(min(w, key=rarity.get), []).append(k)
    flat = [number[w] for w in "common common rare0 common".split()]
    terms = np.unique(flat)
    lists = [np.flatnonzero(np.array(flat) == t) for t in terms]
    seg = decontam.Segment(np.array([4]), terms, np.array([len(x) for x in lists]), np.concatenate(lists).astype("<i4"))
    assert list(seg.visited(filed)) == [0]                      # of three windows with a common term
    assert seg.phrase(queries.windows[0], [2, 0, 1]).tolist() == [0]
    assert seg.phrase(queries.windows[0], [2, 0, 1]).tolist() == seg.phrase(queries.windows[0], [0, 1, 2]).tolist()


def test_row_numbers_survive_a_change_of_cores(spark, make_docs, texts, restless):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = make_docs(texts + texts[:20], 5)
    want = sorted(map(repr, decontam.drop_contaminated(docs, items).collect()))
    assert 0 < len(want) < len(texts) + 20
    restless(decontam)
    assert sorted(map(repr, decontam.drop_contaminated(docs, items).collect())) == want
