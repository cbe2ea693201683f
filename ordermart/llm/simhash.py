"""Near duplicates by SimHash fingerprints, found through a byte-position inverted index.

A fingerprint is 64 bits = 8 bytes.  Two fingerprints that differ in at most ``max_bits`` = 2 bits
share at least 6 of their 8 bytes at the same positions.  The index posts each distinct fingerprint
under positional bytes, four of them at a time so that posting lists stay short: the 14 sets of four
positions whose numbers cancel out under XOR.  Any six positions hold exactly three of these sets, any
seven hold seven, and any five only one.  So the number of lists that two fingerprints share tells
whether they agree in six bytes: pairs are tallied over all lists, those with fewer than three are
dropped, the rest is verified by Hamming distance.

Long lists never become all pairs.  The fingerprints of a list of more than ``LIST`` are posted again
under six positional bytes (any 6 of the 8 bytes again cover every link); what is still long - over
``LIST`` distinct fingerprints that agree on 6 bytes - is linked through shared midpoints: two values of
the remaining 16 bits differ in at most 2 bits exactly if some value is at most 1 bit from both, so each
fingerprint names its 17 such values and all that name one are linked to the smallest of them.  A pair
that shares a long list is found this way, one that shares none by its tally.  Rows grow in proportion
to the fingerprints on every way, and no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import map_batches, placed, spare_name, stored
from ordermart.llm.graph import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
LIST = 64
_BLOCK = 1 << 22


def _shingle_hashes(data: bytes, words: int):
    """Arrays of XXH64 values of the word shingles of ``data``; long texts come in blocks that
    share ``words`` - 1 words."""
    h = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    at, any_full = 0, False
    while at < len(data):
        end = min(len(data), at + _BLOCK)
        if end < len(data):     # cut only between words
            cut = max(data.rfind(c, at, end) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
            while cut < at and end < len(data):     # one word longer than a block
                end = min(len(data), end + _BLOCK)
                cut = max(data.rfind(c, at, end) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
            if end < len(data):
                end = cut + 1
        found = carry + data[at:end].split()
        at = end
        if len(found) >= words:
            any_full = True
            line = b" ".join(found)
            lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
            stops = np.cumsum(lengths) - 1
            starts = (stops + 1 - lengths)[:len(found) - words + 1].tolist()
            yield np.array([h(line[s:e], SEED) for s, e in zip(starts, stops[words - 1:].tolist())], np.uint64)
            carry = found[-(words - 1):] if words > 1 else []
        else:
            carry = found
    if carry and not any_full:
        yield np.array([h(b" ".join(carry), SEED)], np.uint64)


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """SimHash as a signed 64-bit number; 0 for a text without words (or null)."""
    if not text:
        return 0
    ones, total = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes(text.encode("utf-8", "surrogatepass").lower(), words):   # bytes: A-Z only
        total += len(hashes)
        for i in range(0, len(hashes), 1 << 16):
            bits = np.unpackbits(hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8), bitorder="little")
            ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    if not total:
        return 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", words: int = SHINGLE) -> DataFrame:
    """``docs`` without ``text``, with the fingerprint of each row (null text: 0)."""
    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.schema.names.index(text)
        fps = pa.array([fingerprint(t, words) for t in batch.column(place).to_pylist()], pa.int64())
        keep = [i for i in range(batch.num_columns) if i != place]
        return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [fps],
                                          names=[batch.schema.names[i] for i in keep] + [out])
    schema = docs.drop(text).withColumn(out, F.lit(0).cast("long")).schema
    return map_batches(docs, add, schema, column=text)


def _mask(positions) -> int:
    """The 64-bit number with all bits set in the bytes at ``positions``, as a signed value."""
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >= 1 << 63 else value


def _masked(fp: Column, positions) -> Column:
    return fp.bitwiseAND(F.lit(_mask(positions)).cast("long"))


#: Sets of four positions whose numbers cancel out: any six positions hold three of them.
QUADS = [q for q in combinations(range(8), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0]
#: Lists that two fingerprints share at least when they differ in so many bits.
LEAST = {1: 7, 2: 3}


def _posted(rows: DataFrame, keys: list[tuple[int, ...]], out: str) -> DataFrame:
    """One posting per fingerprint and set of positions, with the length of its list."""
    options = F.array(*[F.struct(F.lit(i).alias("which"), _masked(F.col("fp"), k).alias("bytes"))
                        for i, k in enumerate(keys)])
    posts = rows.select("fp", F.explode(options).alias(out)).distinct()
    lists = posts.groupBy(out).agg(F.count("*").alias("n")).where("n > 1")
    return posts.join(lists, out)


def _pairs(posts: DataFrame, key: str) -> DataFrame:
    """Pairs within short lists, one row a list: at most ``LIST`` / 2 a posting."""
    a, b = posts.select(key, F.col("fp").alias("a")), posts.select(key, F.col("fp").alias("b"))
    return a.join(b, key).where("a < b").select("a", "b")


def tallied(posts: DataFrame, key: str, least: int) -> DataFrame:
    """Pairs that share at least ``least`` lists."""
    return _pairs(posts, key).groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("a", "b")


def links(fps: DataFrame, max_bits: int = MAX_BITS, longest: int = LIST) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all pairs at
    ``max_bits`` or fewer differing bits; every row is such a pair, or two that a chain of such
    pairs connects.  Supports up to 2 bits, for which the index guarantees common lists."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the index finds every pair only up to 2 differing bits")
    if max_bits == 0:                       # distinct fingerprints differ
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    sixes = list(combinations(range(8), 6))
    posts = stored(_posted(fps.select("fp"), QUADS, "quad"), "postings")
    found = tallied(posts.where(F.col("n") <= longest), "quad", LEAST[max_bits]).where(near)
    long = posts.where(F.col("n") > longest).select("fp").distinct()
    deep = stored(_posted(long, sixes, "six"), "postings")
    found = found.union(_pairs(deep.where(F.col("n") <= longest), "six").where(near))
    hot = deep.where(F.col("n") > longest).select("fp", "six")
    bits = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(64)])
    free = F.element_at(F.array(*[F.lit(_mask(set(range(8)) - set(s))).cast("long") for s in sixes]),
                        F.col("six.which") + 1)
    flips = F.explode(F.filter(bits, lambda x: x.bitwiseAND(free) == x)).alias("flip")
    if max_bits == 2:
        middles = hot.select("fp", flips).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
        low = middles.groupBy("middle").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
        return found.union(middles.join(low, "middle").where("fp <> a").select("a", F.col("fp").alias("b")))
    # one bit: a fingerprint and the one that has this bit, too
    less = (hot.select("fp", flips).where((F.col("flip") != 0) & (F.col("fp").bitwiseAND(F.col("flip")) == F.col("flip")))
            .select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("flip")).alias("b")))
    return found.union(less.join(fps.select(F.col("fp").alias("b")).distinct(), "b", "left_semi").select("a", "b"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def classes(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) for each distinct fingerprint of ``rows`` (doc_id, fp): the smallest
    fingerprint and the smallest doc_id reachable over links (id null where all of them are)."""
    first = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(first, max_bits)).select(F.col("node").alias("fp"), "root")
    linked = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return linked.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", words: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long), component_id for every row of ``docs``.

    Null and empty texts and texts without words have fingerprint 0 and are linked like any other.
    Rows with a null doc_id are kept and linked, but never name a component; a component of such
    rows alone has a null id.  Repeated rows stay.  No rows in: no rows out.
    """
    rows = stored(fingerprints(docs.select("doc_id", F.col(text).cast("string").alias("text")), "text",
                               words=words), "fingerprints")
    return rows.join(classes(rows, max_bits), "fp").select("doc_id", "fp", "component_id")


def op9_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Pipeline stage: one document of each component stays, the one with its smallest doc_id; of
    repeated rows with that id the first stays, as of rows without any id.  Null and empty texts form
    one component with all texts of fingerprint 0.  Other columns (any names) stay as they were; no rows
    in: no rows out."""
    place = spare_name(docs.columns, "row_place")
    whole = placed(docs, place, "documents")
    light = whole.select("doc_id", F.col("text").cast("string").alias("text"), F.col(place).alias("place"))
    rows = stored(fingerprints(light), "fingerprints")
    chosen = (rows.join(classes(rows), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
              .groupBy("root").agg(F.min("place").alias(place)).select(place))
    return whole.join(chosen, place, "left_semi").select(docs.columns)
