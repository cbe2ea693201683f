import os
import zlib

import numpy as np
import public_tokenizers
import pytest

from ordermart.llm import packing

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


AWKWARD = ["", "  a", " ", " \n x", "x \x1cy", "x\n\n  y \t z ", "it's  we're 'll  ", " <|endoftext|> a", "中文 \U0001F600    x",
           "a" * 5000 + "  " + " b" * 3000 + " " * 3000 + "c", "a 　 b  c  d", " éa  ñb \u0085 c"]


def test_ids_equal_the_tokenizers_library(tokenizer, texts, monkeypatch):
    sample = [t for _, t in texts[:60]] + AWKWARD
    tokens = packing.tokens_for(packing.default_ranks())
    for block in (100, 1 << 20):
        monkeypatch.setattr(packing, "_BLOCK", block)
        for t in sample:
            assert np.frombuffer(tokens.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_piece_lengths_are_powers_of_two_that_add_up():
    for n in range(0, 5000, 7):
        lengths = packing.piece_lengths(n)
        assert sum(lengths) == n and all(x & (x - 1) == 0 and 0 < x <= 2048 for x in lengths)
        assert lengths == sorted(lengths, reverse=True)
        small = [x for x in lengths if x < 2048]
        assert len(set(small)) == len(small)


def test_every_id_in_one_piece(tokenizer, make_docs, texts):
    rows = texts[:40] + [(900, None), (901, ""), (902, "word " * 9000), (None, "x"), (902, "word " * 9000), (None, "x")]
    docs = make_docs(rows)
    got = packing.op2_query(docs).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.offset for r in got} == {0}
    want = []
    for doc, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for n in packing.piece_lengths(len(ids)):
            want.append((doc, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids)))
            at += n
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got), key=repr) == sorted(want, key=repr)
    ids = sorted((r.sequence_id, r.length) for r in got)
    assert [n for _, n in ids] == sorted((n for _, n in ids), reverse=True)      # equal lengths lie together
    assert packing.op2_query(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, longest=100)


def test_buckets_are_written_by_length(spark, make_docs, tmp_path):
    packed = packing.pack(make_docs([(1, "one two three"), (2, "four")]))
    packing.write_buckets(packed, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == packed.count()
