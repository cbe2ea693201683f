"""Packing token sequences by power-of-two decomposition.

A document's tokens (with the end token) are cut into pieces whose lengths are powers of two: as
many of the full length as fit, then the binary digits of the rest, longest first.  Pieces of equal
length form a bucket; a sequence is one piece, so it never crosses documents and needs no padding.

Scale: one scan tokenizes and cuts; nothing is shuffled.  Pieces are written once, numbered within
their task and length; the number of pieces per (length, task) - a few numbers per task - then gives
every bucket a contiguous range of sequence ids from 0 on.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import slices, stored

LENGTH = 2048
END = 1
_BLOCK = 1 << 16          # characters of one text handled at once
_OUT = 1 << 20            # bytes of ids in one batch handed on
_TASKS = 200_000          # tasks whose offsets (13 numbers each at most) are broadcast


def default_ranks() -> str:
    """The rank file of the vocabulary ``byte_bpe_50k.json`` (same ids; read by a faster library), where
    this process runs."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Tokens:
    """Token ids of whole texts, with the vocabulary's rank file."""

    def __init__(self, ranks: str):
        import public_tokenizers
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                          special_tokens={})

    def ids_of(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=())

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers (none for null or empty).  Long texts are cut
        before a space that a non-space character follows: the split pattern always starts a piece there."""
        out, at, text = [], 0, text or ""
        while at < len(text):
            end = min(len(text), at + _BLOCK)
            while end < len(text) and not (text[end] == " " and end + 1 < len(text) and not text[end + 1].isspace()):
                end = text.find(" ", end + 1)
                end = len(text) if end < 0 else end
            out.append(self.ids_of(text[at:end]).astype("<u4", copy=False).tobytes())
            at = end
        return b"".join(out)


@lru_cache(maxsize=2)
def tokens_for(ranks: str | None = None) -> Tokens:
    """The task's tokenizer; None: the public vocabulary, found where the task runs."""
    return Tokens(ranks or default_ranks())


def piece_lengths(total: int, longest: int = LENGTH) -> list[int]:
    """Powers of two that add up to ``total``: full pieces, then the binary digits of the rest."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


_PIECES = "doc_id {id}, start long, length long, tokens binary, doc_tokens long, task int, rank long"


def cut(docs: DataFrame, ranks: str | None = None, longest: int = LENGTH, end: int = END) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text), each with its ids, its task and its place there among
    pieces of its length.  A task holds one text's ids and about ``_OUT`` bytes of pieces."""
    tail = np.array([end], "<u4").tobytes()
    names = ["doc_id", "start", "length", "tokens", "doc_tokens", "task", "rank"]

    def run(batches):
        encode, task = tokens_for(ranks).encode, TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
            for part in slices(batch, "text", 64, 1 << 18):
                rows, size = [], 0
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    data = encode(text.as_py()) + tail
                    at, total = 0, len(data) // 4
                    for n in piece_lengths(total, longest):
                        rows.append((doc, at, n, data[4 * at:4 * (at + n)], total, task, seen.get(n, 0)))
                        seen[n] = rows[-1][-1] + 1
                        at += n
                        size += 4 * n
                        if size >= _OUT:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return docs.mapInArrow(run, _PIECES.format(id=docs.schema["doc_id"].dataType.simpleString()))


def pack(docs: DataFrame, ranks: str | None = None, text: str = "text", longest: int = LENGTH,
         end: int = END) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, tokens (binary), doc_tokens, sequence_id, offset.

    ``longest`` is a power of two.  A null or empty text is the end token alone.  Repeated rows are
    packed each on its own, a null doc_id stays null.  Ids run from 0 without a gap, longest
    sequences first; each sequence is one piece, at offset 0.  No rows in: no rows out.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    pieces = stored(cut(docs.select("doc_id", F.col(text).cast("string").alias("text")),
                        ranks, longest, end), "pieces")
    counts = stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n"))           # at most 1 + log2(longest) rows
    before = F.sum("n").over(Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1))
    buckets = totals.select("length", F.coalesce(before, F.lit(0)).alias("bucket"))
    inside = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    base = (counts.withColumn("inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(buckets), "length")
            .select("length", "task", (F.col("bucket") + F.col("inside")).alias("base")))
    if counts.agg(F.count_distinct("task")).first()[0] <= _TASKS:      # else the pieces are shuffled
        base = F.broadcast(base)
    return (pieces.join(base, ["length", "task"])
            .select("doc_id", "start", "length", "tokens", "doc_tokens",
                    (F.col("base") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences as Parquet, one folder per length."""
    packed.write.partitionBy("length").parquet(path)


def op2_query(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"),
                             "doc_tokens", "sequence_id", "offset")
