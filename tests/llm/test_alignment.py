import hashlib
import os
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ordermart.llm import alignment

os.environ["TOKENIZERS_PARALLELISM"] = "false"

AWKWARD = ["", " ", "  a", "a  ", "x \n y\n  z \t\t w", "it's  we're 'll  ", "<|endoftext|> <s> a </s> <unk> <0x41>", "中文 \U0001F600    x é",
           "a▁b", "a" * 300 + "  " + " b" * 50 + " " * 70 + "c", "a 　 b\xa0 c  d", "\x00\x01 y", "Ünïcödé ñandú " * 5,
           "ﬁne ½ ①", "1234567890 12 345.67 x_y-z", "\u0085 a b", "abc" * 400]


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_level():
    """The 256 characters that byte-level tokens are written in, and their bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def brute(rows, both):
    a_tok, b_tok = both
    alphabet = byte_level()
    held, per_doc = Counter(), []
    for doc, text in rows:
        groups, links = [], Counter()
        if text:
            a = a_tok.encode(" " + text, add_special_tokens=False).ids
            b = b_tok.encode(text)
            bytes_a = [bytes(alphabet[c] for c in a_tok.id_to_token(i)) for i in a]
            names = [b_tok.id_to_piece(i) for i in b]
            bytes_b = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names)]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
                i = j = 0
                for e in sorted(set(ends_a) & set(ends_b)):
                    x, y = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
                    groups.append((a[i:x], b[j:y]))
                    links.update((u, v) for u in a[i:x] for v in b[j:y])
                    i, j = x, y
        held.update(links.keys())
        per_doc.append((doc, groups, links))
    best = {}
    for (u, _), n in held.items():
        best[u] = max(best.get(u, 0), n)
    out = []
    for doc, groups, links in per_doc:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), links.total(),
                    sum(n for p, n in links.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows(texts):
    return texts[:60] + [(5000 + i, t) for i, t in enumerate(AWKWARD)] + [(None, None), (None, "x y"), (7, "x y"), (7, "x y"), (6000, " ".join(
        t for _, t in texts[:20]))]


def test_equals_brute_force(make_docs, rows, both):
    got = alignment.op12_query(make_docs(rows))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, both)


@pytest.mark.parametrize("block, group, memory, large", [(40, 100, 5, 2), (300, 1 << 20, 50, 1 << 12)])
def test_small_blocks_and_memory_change_nothing(rows, both, monkeypatch, block, group, memory, large):
    """Token ids of cut texts equal those of whole texts, and what is forgotten is found again."""
    for name, value in (("_GROUP", group), ("_WINDOWS", memory), ("_LARGE", large)):
        monkeypatch.setattr(alignment, name, value)
    monkeypatch.setattr(alignment.blocks, "__defaults__", (block,))
    own = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))
    found = own.documents([t for _, t in rows])
    want = {(d, t): r for (d, t), r in zip(rows, [brute([x], both)[0] for x in rows])}
    for (doc, text), x in zip(rows, found):
        r = want[doc, text]
        assert (x and (x[0], x[1], x[2], int(x[5].sum()), x[3])) == (r[1:5] + (r[7],) if r[7] else None)


def test_small_chunks_change_nothing(make_docs, rows, both, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 1)      # in this process: the dictionary rows are its own
    docs = make_docs(rows, 2)
    one = sorted(map(tuple, alignment.op12_query(docs.coalesce(1)).collect()), key=repr)
    many = sorted(map(tuple, alignment.op12_query(docs.repartition(9)).collect()), key=repr)
    assert one == many == brute(rows, both)


def test_chunk_dictionaries():
    chunk = alignment.Chunk(3)
    first, second = chunk.add([np.array([10, 5000, 7]), np.array([7, 11])])
    assert len(set(first)) == 3 and second[0] == first[2]
    third, = chunk.add([np.arange(9000)])
    codes = list(chunk.place)
    assert [codes[i] for i in third] == list(range(9000)) and chunk.docs[chunk.place[7]] == 3 and chunk.docs[chunk.place[11]] == 2
    assert chunk.add([]) == []


def test_windows_with_equal_hashes_stay_apart(both, monkeypatch):
    own = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))
    want = own.documents(["one two three two one two"])
    again = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))
    unique = np.unique

    def colliding(x, *args, **more):
        return unique(np.zeros_like(x) if x.dtype == np.uint64 else x, *args, **more)
    monkeypatch.setattr(np, "unique", colliding)
    got = again.documents(["one two three two one two"])
    assert got[0][:4] == want[0][:4] and got[0][4].tolist() == want[0][4].tolist() and got[0][5].tolist() == want[0][5].tolist()


def test_windows_are_aligned_once(both, monkeypatch):
    own = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))
    text = "winter summer " * 500
    own.documents([text, text])
    assert len(own.memory.texts) == len(own.memory.number) <= 4


def test_no_rows_and_other_columns(make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    assert alignment.op12_query(docs.limit(0)).count() == 0
    assert alignment.op12_query(docs.where("text is null")).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "")
    got = alignment.align(docs.withColumn("row", F.lit("mine")))
    assert set(got.columns) >= {"row", "lang", "n_links"} and {r.row for r in got.collect()} == {"mine"}
    with pytest.raises(ValueError):
        alignment.align(docs.withColumn("Chunk", F.lit(1)))
