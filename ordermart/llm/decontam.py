"""Benchmark decontamination with a distributed positional inverted index.

The documents are indexed in segments of about ``SEGMENT`` words.  A segment holds, for each term,
the sorted list of its word positions (documents lie one after the other, a free position between
them), and is one row of the index table.  Only terms that the benchmark has are stored: no query
asks for others.  A benchmark window (``window`` consecutive words of an item, or a shorter item as a
whole) is filed under its term that is rarest in the corpus (ties: the first); a segment visits only
the windows filed under terms that it has.  It answers them by intersecting the posting lists of the
window's terms, each shifted by the term's offset in the window, from the rarest on; the survivors are
exact phrase matches.  Proximity matches (an occurrence of the rarest term with every other term of the
window at most its length - 1 + ``slop`` words away in the same document) start from that list, too.

Scale: two scans' worth of work and no shuffle of postings, since a segment answers for its own
documents.  The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` of item text, one
index and one pass per block, so the broadcast is bounded however large the benchmark is.  A
benchmark item or document that is very common costs no more than its postings.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import placed, slices, spare_name, stored

WINDOW = 10
SLOP = 5                       # words that may stand between the terms of a proximity match
SEGMENT = 1 << 20              # words of a segment, exceeded only by a longer document
BLOCK_BYTES = 16 << 20         # benchmark text sent to tasks at once

#: Bytes of words (0-9, a-z and all of non-ASCII characters), A-Z lower-cased; others become spaces.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
               for b in range(256))

_INDEX = ("place long, doc_id array<{id}>, places array<long>, n_words array<int>, terms array<int>, "
          "counts array<int>, positions binary")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else []


@dataclass
class Windows:
    """The distinct windows of a block of items: term numbers, and the items that have each."""
    vocabulary: dict[bytes, int]
    windows: list[tuple[int, ...]]
    items: list[list[str]]


def windows_of(items: list[tuple[str, str | None]], window: int = WINDOW) -> Windows:
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(tuple(ids[i:i + window]), set()).add(item)
    return Windows(vocabulary, list(found), [sorted(x) for x in found.values()])


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], segment: int = SEGMENT) -> DataFrame:
    """The index table over ``docs`` (doc_id, text, place): a row per segment."""
    schema = _INDEX.format(id=docs.schema["doc_id"].dataType.simpleString())

    def row(id_type, ids, places, lengths, words):
        flat = np.full(sum(lengths) + len(lengths), -1, np.int32)
        at = 0
        for n, w in zip(lengths, words):
            flat[at:at + n] = w
            at += n + 1
        where = np.flatnonzero(flat >= 0)
        order = np.argsort(flat[where], kind="stable")
        terms, counts = np.unique(flat[where], return_counts=True)
        return pa.RecordBatch.from_arrays([
            pa.array([places[0]], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([places], pa.list_(pa.int64())),
            pa.array([lengths], pa.list_(pa.int32())), pa.array([terms], pa.list_(pa.int32())),
            pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([where[order].astype("<i4").tobytes()], pa.binary())],
            names=["place", "doc_id", "places", "n_words", "terms", "counts", "positions"])

    def run(batches):
        get = vocabulary.get
        ids, places, lengths, words, total = [], [], [], [], 0
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for piece in slices(batch, "text", 256, 4 << 20):
                for i, p, text in zip(piece.column("doc_id").to_pylist(), piece.column("place").to_pylist(),
                                      piece.column("text").to_pylist()):
                    found = words_of(text)
                    if total and total + len(found) > segment:
                        yield row(id_type, ids, places, lengths, words)
                        ids, places, lengths, words, total = [], [], [], [], 0
                    ids.append(i)
                    places.append(p)
                    lengths.append(len(found))
                    words.append(np.fromiter((get(w, -1) for w in found), np.int32, len(found)))
                    total += len(found) + 1
        if ids:
            yield row(id_type, ids, places, lengths, words)

    return docs.mapInArrow(run, schema)


def term_counts(index: DataFrame) -> dict[int, int]:
    """How often each benchmark term occurs in the corpus (as many numbers as the block has terms)."""
    rows = (index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
            .groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("n")).collect())
    return {r["term"]: r["n"] for r in rows}


class Segment:
    """Posting lists of one index row."""

    def __init__(self, n_words: np.ndarray, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray):
        ends = np.cumsum(counts)
        self.lists = {int(t): positions[e - c:e] for t, c, e in zip(terms, counts, ends)}
        self.begins = np.concatenate(([0], np.cumsum(n_words + 1)))
        self.size = int(self.begins[-1])

    def visited(self, filed: dict[int, list[int]]):
        """The windows filed under a term of this segment."""
        fewer, more = (filed, self.lists) if len(filed) < len(self.lists) else (self.lists, filed)
        for term in fewer:
            if term in more:
                yield from filed[term]

    def phrase(self, window: tuple[int, ...], by_rarity: list[int]) -> np.ndarray:
        """Start positions of the window: the rarest term's list, shifted by its offset, intersected
        with each other term's shifted list."""
        lists = [self.lists.get(window[j]) for j in by_rarity]
        if any(x is None for x in lists):
            return np.empty(0, np.int64)
        start = lists[0].astype(np.int64) - by_rarity[0]
        for j, other in zip(by_rarity[1:], lists[1:]):
            if not len(start):
                break
            place = np.minimum(np.searchsorted(other, start + j), len(other) - 1)
            start = start[other[place] == start + j]
        return start              # the free positions between documents are in no list

    def near(self, window: tuple[int, ...], by_rarity: list[int], slop: int) -> np.ndarray:
        """Positions of the rarest term with every other term of the window within
        len(window) - 1 + slop words of it, in the same document."""
        here = self.lists.get(window[by_rarity[0]])
        if here is None:
            return np.empty(0, np.int64)
        here = here.astype(np.int64)
        reach = len(window) - 1 + slop
        doc = np.searchsorted(self.begins, here, side="right") - 1
        low, high = np.maximum(here - reach, self.begins[doc]), np.minimum(here + reach, self.begins[doc + 1] - 2)
        for term in dict.fromkeys(window[j] for j in by_rarity[1:]):
            other = self.lists.get(term)
            if other is None or not len(here):
                return np.empty(0, np.int64)
            found = np.searchsorted(other, low, "left") < np.searchsorted(other, high, "right")
            here, low, high = here[found], low[found], high[found]
        return here


_FOUND = "place long, doc_id {id}, n_words int, spans array<struct<begin:int,end:int>>, items array<string>, near array<string>"


def search(index: DataFrame, queries: Windows, rarity: dict[int, int], slop: int | None = None) -> DataFrame:
    """One row per indexed document: place, doc_id, n_words, spans (hit words [begin, end), merged),
    items (with an exact window), near (items with a proximity match; empty unless ``slop`` is set)."""
    id_type = index.schema["doc_id"].dataType.elementType.simpleString()
    orders = [sorted(range(len(w)), key=lambda j: (rarity.get(w[j], 0), j)) for w in queries.windows]

    filed: dict[int, list[int]] = {}
    for k, (w, order) in enumerate(zip(queries.windows, orders)):
        filed.setdefault(w[order[0]], []).append(k)

    def answer(ids, places, n_words, terms, counts, positions):
        seg = Segment(n_words, terms, counts, positions)
        edge = np.zeros(seg.size + 1, np.int32)
        items: dict[int, set[str]] = {}
        near: dict[int, set[str]] = {}
        for k in seg.visited(filed):
            window, order, names = queries.windows[k], orders[k], queries.items[k]
            start = seg.phrase(window, order)
            if len(start):
                np.add.at(edge, start, 1)
                np.add.at(edge, start + len(window), -1)
                for d in np.unique(np.searchsorted(seg.begins, start, side="right") - 1).tolist():
                    items.setdefault(d, set()).update(names)
            if slop is not None:
                here = seg.near(window, order, slop)
                for d in np.unique(np.searchsorted(seg.begins, here, side="right") - 1).tolist():
                    near.setdefault(d, set()).update(names)
        hit = np.concatenate(([0], (np.cumsum(edge) > 0).astype(np.int8)))
        change = np.diff(hit)
        begins, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        spans: dict[int, list] = {}
        for d, b, e in zip((np.searchsorted(seg.begins, begins, side="right") - 1).tolist(), begins.tolist(), ends.tolist()):
            spans.setdefault(d, []).append({"begin": b - int(seg.begins[d]), "end": e - int(seg.begins[d])})
        n = len(n_words)
        return [places, ids, n_words.tolist(), [spans.get(d, []) for d in range(n)],
                [sorted(items.get(d, ())) for d in range(n)], [sorted(near.get(d, ())) for d in range(n)]]

    def run(batches):
        for batch in batches:
            inner = batch.schema.field("doc_id").type.value_type
            names = ["place", "doc_id", "n_words", "spans", "items", "near"]
            types = [pa.int64(), inner, pa.int32(),
                     pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])),
                     pa.list_(pa.string()), pa.list_(pa.string())]
            for i in range(batch.num_rows):
                cell = lambda c: batch.column(c)[i]
                numbers = lambda c: np.array(cell(c).values.to_numpy(zero_copy_only=False))
                got = answer(cell("doc_id").as_py(), cell("places").as_py(), numbers("n_words").astype(np.int64),
                             numbers("terms"), numbers("counts"), np.frombuffer(cell("positions").as_py(), "<i4"))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(got, types)], names=names)

    return index.select("doc_id", "places", "n_words", "terms", "counts", "positions").mapInArrow(
        run, _FOUND.format(id=id_type))


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark items, in lists of at most ``block_bytes`` of text (or a single item)."""
    rows = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
            .where("item_id IS NOT NULL AND text IS NOT NULL").distinct())
    block, size = [], 0
    for r in rows.toLocalIterator():
        n = len(r["text"])
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    yield block


def _answers(docs: DataFrame, items: list[tuple[str, str]], window: int, slop: int | None) -> DataFrame:
    queries = windows_of(items, window)
    index = stored(build_index(docs, queries.vocabulary), "postings")
    return search(index, queries, term_counts(index), slop)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = None,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """place, doc_id, n_words, spans, items, near for every row of ``docs`` (doc_id, text, and an
    optional unique ``place``).

    Null and empty texts have no words and no hits.  A null item id or item text is no item; items
    with equal ids count once.  Repeated rows are answered each on its own.  An empty benchmark
    gives no hits, an empty document table no rows.
    """
    if "place" not in docs.columns:
        docs = docs.withColumn("place", F.monotonically_increasing_id())
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), "place")
    parts = []
    waiting = None
    for items in _blocks(benchmark, block_bytes):
        if waiting is not None and not parts:      # several blocks: every scan must see the same places
            docs = stored(docs, "documents")
        if waiting is not None:
            parts.append(_answers(docs, waiting, window, slop))
        waiting = items
    parts.append(_answers(docs, waiting, window, slop))
    if len(parts) == 1:
        return parts[0]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    return whole.groupBy("place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def n_hit(spans):
    """Words covered by at least one span (spans of several blocks may overlap)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(F.array_sort(spans), start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["begin"], acc["upto"]))).alias("n"),
        F.greatest(acc["upto"], s["end"]).alias("upto")), lambda acc: acc["n"])


def op7_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = matches(docs.select("doc_id", "text"), benchmark, slop=SLOP)
    hits = n_hit(F.col("spans"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near"))


ORACLE = r"""
WITH items AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
words AS (
  SELECT doc_id, row_number() OVER () AS r,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
lengths AS (SELECT DISTINCT k FROM grams),
starts AS (
  SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, lengths WHERE len(w) >= k)),
found AS (SELECT s.r, s.k, s.i, g.item_id FROM starts s JOIN grams g ON s.g = g.g AND s.k = g.k),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, k, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
windows AS (
  SELECT DISTINCT item_id, w[i : i + least(10, len(w)) - 1] AS terms
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (SELECT r, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS p FROM words),
counted AS (SELECT term, count(*) AS n FROM places GROUP BY term),
ranked AS (
  SELECT item_id, terms, t.term, t.j, coalesce(c.n, 0) AS n
  FROM (SELECT item_id, terms, unnest(terms) AS term, unnest(range(1, len(terms) + 1)) AS j FROM windows) t
  LEFT JOIN counted c ON t.term = c.term),
rarest AS (
  SELECT item_id, terms, arg_min(term, n * 100 + j) AS term FROM ranked GROUP BY item_id, terms),
close AS (
  SELECT r, count(DISTINCT item_id) AS n_near
  FROM (SELECT p.r, x.item_id, x.terms, p.p, w.w FROM rarest x JOIN places p ON p.term = x.term JOIN words w ON w.r = p.r)
  WHERE list_has_all(w[greatest(1, p - len(terms) + 1 - 5) : p + len(terms) - 1 + 5], terms) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM words LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN close USING (r)
"""


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: documents without any benchmark window stay, all their columns (any names) as they
    were.  Null and empty texts have no window and stay; repeated rows and null ids are judged each on its
    own; an empty benchmark drops nothing; no rows in: no rows out."""
    place = spare_name(docs.columns, "row_place")
    whole = placed(docs, place, "documents")
    light = whole.select("doc_id", "text", F.col(place).alias("place"))
    bad = matches(light, benchmark).where(F.size("spans") > 0).select(F.col("place").alias(place))
    return whole.join(bad, place, "left_anti").select(docs.columns)
