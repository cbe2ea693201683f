"""Removal of repeated byte strings with a distributed, sparse suffix array.

Every byte covered by a ``length``-byte string (a window) that also starts earlier - in a document
with a smaller id, or earlier in the same one - is removed; windows are judged on the input.

A suffix for each byte is too much to move, so suffixes start at anchors only: each window names its
``GRAM``-byte string of least hash (the leftmost of equals).  Equal windows name the same string at the
same offset, so two windows are equal exactly if their anchors' suffixes agree for the rest of the
window and the bytes before the anchors agree back to its start.  About 1 byte in 39 is an anchor.

1. Each task hashes the stretch that an anchor's windows cover, and compares the bytes of stretches
   with equal hashes: those that equal an earlier one of the task are removed whole.  Each other whose
   gram occurs again is a suffix to sort: within the task this is known, and one stretch of each gram
   is sent to be counted by the gram's hash over all tasks.  Hashes tell only what is worth sorting.
2. Suffixes (with the bytes before them) are range-partitioned by their leading bytes with sampled
   splitters.  Each bucket sorts its suffixes by multikey quicksort (eight bytes a key), takes the
   common prefix of neighbours, and finds for every window the earliest suffix that shares it.
3. Windows that agree with the suffix at either end of a bucket may go on in other buckets.  The
   suffixes that are first in their bucket for such a window are compared across boundaries: range-
   partitioned and sorted again, now by the bytes before them.  What reaches a bucket's end in both
   orders is shared by very many or has few bytes before its anchor; it is compared by the window's
   hash in a Spark aggregation.
4. The spans of each document are gathered and cut out.

Scale: hot passages shrink to one row per task in 1, and a gram with very many
different surroundings is spread over buckets by the splitters.  No task holds more than its bucket,
whose size is set; texts are moved compressed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import map_batches, numbered, slices, stored

LENGTH = 100
GRAM = 24
BUCKET_BYTES = 24 << 20        # of text per range partition of step 1
BUCKET_SUFFIXES = 150_000      # suffixes per range partition of step 2
_CHUNK = 2 << 20               # bytes handled at once, also of one document
_TASK = 32 << 20               # bytes within which equal stretches are merged before they are sent
_LAST = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64, at least n of them."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        both = []
        for x in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, x, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[0] = tuple(both)
    return _POWERS[0]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def anchors(data: np.ndarray, first: int, last: int, length: int, gram: int):
    """For the windows that start at ``first`` to ``last`` - 1 of ``data``: arrays of the gram's hash,
    the stretch's hash, the anchor, and the first and last window start that name it."""
    n = last - first + length - 1
    raw = data[first:first + n]
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[raw] * down[:n], out=total[1:])
    hashes = _mixed((total[gram:] - total[:-gram]) * up[:n - gram + 1])
    # hash and place in one number, so that the least also tells where it is
    low = (hashes & ~np.uint64((1 << 23) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    window, width = length - gram + 1, 1
    least = low
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[:len(least) - (window - width)], least[window - width:])
    place = (least & np.uint64((1 << 23) - 1)).astype(np.int64)
    begin = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    end = np.concatenate((begin[1:], [len(place)])) - 1
    at = place[begin]
    stretch = (total[end + length] - total[begin]) * up[begin]
    stretch = _mixed(stretch + ((at - begin) * 128 + (end - at)).astype(np.uint64) * np.uint64(_BASE))
    return hashes[at], stretch, at + first, begin + first, end + first


def _pack(at, begin, end):
    """Anchor, and the distances to its first and last window start, in one number."""
    return (at << 16) | ((at - begin) << 8) | (end - begin)


def _unpack(packed):
    at = packed >> 16
    begin = at - ((packed >> 8) & 255)
    return at, begin, begin + (packed & 255)


class _Merger:
    """Collects anchors of many texts; tells first stretches from repeats."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.parts, self.size, self.texts = [], 0, {}

    def add(self, age: int, row: int, data: bytes) -> None:
        raw = np.frombuffer(data, np.uint8)
        starts = len(raw) - self.length + 1
        for first in range(0, max(0, starts), _CHUNK):
            last = min(starts, first + _CHUNK)
            kh, sh, at, begin, end = anchors(raw, first, last, self.length, self.gram)
            self.parts.append((kh.view(np.int64), sh.view(np.int64), np.full(len(at), age), np.full(len(at), row),
                               _pack(at, begin, end)))
        if starts > 0:
            self.texts[row] = raw
        self.size += len(raw)

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The collected columns in order of (gram, stretch, age), and which rows come first."""
        if not self.parts:
            return [np.empty(0, np.int64)] * 5, np.empty(0, bool)
        cols, self.parts = [np.concatenate(c) for c in zip(*self.parts)], []
        cols, first = _ordered(cols)
        again = np.flatnonzero(~first)
        lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        first[again[~self._same(cols, again, lead[again])]] = True        # equal hashes, other bytes
        self.size = 0
        return cols, first

    def _same(self, cols: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the stretches at places ``a`` of the columns have the bytes of those at ``b``."""
        rows = np.fromiter(self.texts, np.int64, len(self.texts))
        order, sizes = np.argsort(rows), np.array([len(t) for t in self.texts.values()])
        flat, base = np.concatenate(list(self.texts.values())), np.cumsum(sizes) - sizes
        self.texts = {}
        _, begin, end = _unpack(cols[4])
        where = base[order][np.searchsorted(rows[order], cols[3])] + begin
        size, out = end - begin + self.length, np.zeros(len(a), bool)
        for i in range(0, len(a), 1 << 11):
            x, y = a[i:i + (1 << 11)], b[i:i + (1 << 11)]
            step = np.arange(size[x].max())[None, :]
            inside = step < size[x][:, None]
            at = np.where(inside, step, 0)
            same = flat[where[x][:, None] + at] == flat[where[y][:, None] + at]
            out[i:i + (1 << 11)] = same.all(axis=1) & (size[x] == size[y])
        return out


def _ordered(cols: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    order = np.lexsort((cols[4], cols[3], cols[2], cols[1], cols[0]))
    cols = [c[order] for c in cols]
    first = np.ones(len(order), bool)
    first[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
    return cols, first


#: How a stretch of a task is sent on: the only one of its gram there, the first of several, another
#: of these, or a repeat of an equal one.
_ALONE, _FIRST, _OTHER, _REPEAT = range(4)
_STRETCH = "gram long, age long, row long, packed long, state int"
_SPAN = "row long, begin long, stop long"


def _stretches(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The stretches of all rows, each with what its task knows of it."""
    def out(merger):
        cols, first = merger.take()
        kept = np.flatnonzero(first)
        hashes = cols[0][kept]
        opens = np.ones(len(kept), bool)
        opens[1:] = hashes[1:] != hashes[:-1]
        several = np.bincount(np.cumsum(opens) - 1, minlength=1) > 1
        state = np.full(len(first), _REPEAT, np.int32)
        state[kept] = np.where(opens, np.where(several[np.cumsum(opens) - 1], _FIRST, _ALONE), _OTHER) if len(kept) else 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (cols[0], cols[2], cols[3], cols[4], state)],
                                          names=["gram", "age", "row", "packed", "state"])

    def run(batches):
        merger = _Merger(length, gram)
        for batch in batches:
            for part in slices(batch, "data", 512, 4 << 20):
                for age, row, data in zip(part.column("age").to_pylist(), part.column("row").to_pylist(),
                                          part.column("data")):
                    merger.add(age, row, data.as_py())
                if merger.size >= _TASK:
                    yield out(merger)
        yield out(merger)

    return rows.mapInArrow(run, _STRETCH)


def _sift(stretches: DataFrame, length: int) -> DataFrame:
    """Of stretches dealt by the hash of their gram (others and repeats anywhere): the spans of repeats
    (begin, stop), and the suffixes to sort (packed): those whose gram occurs again.  A task counts one
    stretch a gram and chunk of 32 MB, however common the gram is."""
    names, kinds = ["row", "age", "packed", "begin", "stop"], [pa.int64()] * 5

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        gram, age, row, packed, state = (table.column(c).to_numpy() for c in ("gram", "age", "row", "packed", "state"))
        counted = np.flatnonzero(state <= _FIRST)
        _, number, often = np.unique(gram[counted], return_inverse=True, return_counts=True)
        sort = (state == _FIRST) | (state == _OTHER)
        sort[counted] |= often[number] > 1
        none = lambda n: pa.nulls(n, pa.int64())
        n = int(sort.sum())
        yield pa.RecordBatch.from_arrays([pa.array(row[sort]), pa.array(age[sort]), pa.array(packed[sort]), none(n), none(n)], names=names)
        again = state == _REPEAT
        _, begin, end = _unpack(packed[again])
        n = int(again.sum())
        yield pa.RecordBatch.from_arrays([pa.array(row[again]), none(n), none(n), pa.array(begin), pa.array(end + length)], names=names)

    return stretches.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _squeezed(rows: DataFrame) -> DataFrame:
    """``rows`` with the bytes of ``data`` compressed (z), to be moved."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3).compress
        keep = [i for i, c in enumerate(batch.schema.names) if c != "data"]
        return pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep] + [pa.array([pack(d.as_py()) for d in batch.column("data")], pa.binary())],
            names=[batch.schema.names[i] for i in keep] + ["z"])
    return map_batches(rows, run, rows.drop("data").withColumn("z", F.lit(b"")).schema, column="data")


def _unsqueezed(z) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


_SUFFIX = "suffix binary, before binary, age long, row long, at long, least int, most int"


def _suffixes(rows: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """For each wanted anchor: the suffix, the bytes before it backwards, and which windows name it
    (as distances of their starts from the anchor)."""
    back = length - gram

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "z", 64, 1 << 20):
                out = [[] for _ in range(7)]
                for row, z, asked in zip(part.column("row").to_pylist(), part.column("z"), part.column("asked").to_pylist()):
                    data = _unsqueezed(z.as_py())
                    for x in asked:
                        at, begin, end = _unpack(x["packed"])
                        for o, v in zip(out, (data[at:at + length], data[max(0, at - back):at][::-1], x["age"], row, at,
                                              at - end, at - begin)):
                            o.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
                                                          pa.int32(), pa.int32()))],
                    names=["suffix", "before", "age", "row", "at", "least", "most"])

    per_row = wanted.groupBy("row").agg(F.collect_list(F.struct("age", "packed")).alias("asked"))
    return _squeezed(rows.select("row", "data")).join(per_row, "row").mapInArrow(cut, _SUFFIX)


def multikey_quicksort(text: np.ndarray) -> np.ndarray:
    """Order of the rows of a byte matrix: sort by the first eight bytes, then each run of equal rows
    by the next eight, and so on."""
    n, width = text.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = text
    keys = padded.view(">u8")
    order = np.arange(n)
    run = np.zeros(n, np.int64)            # rows of one run are equal so far
    open_ = np.arange(n)                   # places in the order that lie in a run of two or more
    for d in range(keys.shape[1]):
        if not len(open_):
            break
        key = keys[order[open_], d].astype(np.uint64)
        inner = np.lexsort((key, run[open_]))
        order[open_] = order[open_[inner]]
        key, r = key[inner], run[open_]    # runs lie together and keep their places
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (r[1:] != r[:-1])))
        run[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        alone = new & np.concatenate((new[1:], [True]))
        open_ = open_[~alone]
    return order


def common_prefix(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before it in the order (0 for the first)."""
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    out = np.zeros(len(order), np.int64)
    for i in range(1, len(order), 1 << 16):
        j = min(len(order), i + (1 << 16))
        differ = text[order[i:j]] != text[order[i - 1:j - 1]]
        out[i:j] = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
    return out


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Byte strings as rows, padded with zeros (no window reads the padding)."""
    return np.frombuffer(b"".join(x.as_py().ljust(width, b"\0") for x in column), np.uint8).reshape(-1, width)


_COMPARED = _SPAN + ", window binary, " + _SUFFIX.replace("row long", "owner long")


def _classes(order: np.ndarray, prefix: np.ndarray, depth: int) -> np.ndarray:
    """A number per row, equal for rows that agree in their first ``depth`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(prefix < depth)
    return out


def compare_bucket(suffix: np.ndarray, before: np.ndarray, age, row, at, least, most, length: int, by_suffix: bool = True):
    """Within one bucket, of suffixes that lie between two others in the order of ``suffix`` (or of
    ``before``): (rows, distances) of windows with an earlier equal one here; and of windows that are
    the first here but may occur in other buckets."""
    n, back = len(suffix), before.shape[1]
    right = multikey_quicksort(suffix)
    right_prefix = common_prefix(suffix, right)
    left = multikey_quicksort(before)
    left_prefix = common_prefix(before, left)
    ends = (right if by_suffix else left)[[0, -1]]
    rank = np.empty(n, np.int64)
    rank[np.lexsort((at, row, age))] = np.arange(n)
    again, first = [], []
    for o in range(back + 1):
        here = np.flatnonzero((least <= o) & (o <= most))
        if not len(here):
            continue
        behind, ahead = _classes(left, left_prefix, o), _classes(right, right_prefix, length - o)
        main = ahead if by_suffix else behind
        touches = (main == main[ends[0]]) | (main == main[ends[1]])
        here = here[(np.bincount(ahead[here], minlength=n + 1)[ahead[here]] > 1) | touches[here]]
        here = here[np.lexsort((rank[here], behind[here], ahead[here]))]
        if not len(here):
            continue
        new = np.concatenate(([True], (ahead[here][1:] != ahead[here][:-1]) | (behind[here][1:] != behind[here][:-1])))
        again.append((here[~new], np.full((~new).sum(), o)))
        outer = new & touches[here]
        first.append((here[outer], np.full(outer.sum(), o)))
    join = lambda parts: [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 2
    return join(again), join(first)


def _compare(suffixes: DataFrame, length: int, gram: int, by_suffix: bool) -> DataFrame:
    """Spans found in each bucket, and what to compare across boundaries: suffixes (with the range of
    windows in question) after the order of the suffixes, hashes of windows after that of the bytes
    before them."""
    back = length - gram
    names = [c.split(" ")[0] for c in _COMPARED.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.binary()] * 3 + [pa.int64()] * 3 + [pa.int32()] * 2

    def out(n, **columns):
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names=names)

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        suffix, before = _matrix(table.column("suffix"), length), _matrix(table.column("before"), back)
        age, row, at, least, most = (table.column(c).to_numpy() for c in ("age", "row", "at", "least", "most"))
        (i, o), (j, q) = compare_bucket(suffix, before, age, row, at, least, most, length, by_suffix)
        # consecutive windows of one suffix are one span
        order = np.lexsort((-o, i))
        i, start = i[order], (at[i] - o)[order]
        if len(i):
            new = np.concatenate(([True], (i[1:] != i[:-1]) | (start[1:] != start[:-1] + 1)))
            begin, stop = start[new], start[np.concatenate((new[1:], [True]))] + length
            yield out(len(begin), row=pa.array(row[i[new]]), begin=pa.array(begin), stop=pa.array(stop))
        if by_suffix and len(j):
            asked, lows = np.unique(j, return_inverse=True)
            low, high = np.full(len(asked), back), np.zeros(len(asked), np.int64)
            np.minimum.at(low, lows, q)
            np.maximum.at(high, lows, q)
            picked = table.take(pa.array(asked)).combine_chunks()
            column = lambda c: picked.column(c).combine_chunks()
            yield out(len(asked), suffix=column("suffix"), before=column("before"), age=column("age"), owner=column("row"),
                      at=column("at"), least=pa.array(low, pa.int32()), most=pa.array(high, pa.int32()))
        for b in range(0, 0 if by_suffix else len(j), 1 << 16):
            jj, qq = j[b:b + (1 << 16)], q[b:b + (1 << 16)]
            digest = [xxhash.xxh3_128_digest(before[x, :d][::-1].tobytes() + suffix[x, :length - d].tobytes())
                      for x, d in zip(jj.tolist(), qq.tolist())]
            yield out(len(jj), row=pa.array(row[jj]), begin=pa.array(at[jj] - qq), stop=pa.array(at[jj] - qq + length),
                      window=pa.array(digest, pa.binary()), age=pa.array(age[jj]))

    return suffixes.mapInArrow(run, _COMPARED)


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, begin, stop): spans whose union is what to remove.  ``rows``: row (unique), age (order
    of documents), data (bytes)."""
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    parts = max(1, math.ceil(total / BUCKET_BYTES))
    found = _stretches(rows, length, gram)
    dealt = F.when(F.col("state") <= _FIRST, F.col("gram")).otherwise(F.xxhash64("row", "packed"))
    sifted = stored(_sift(found.repartition(parts, dealt), length), "stretches")
    wanted = sifted.where("packed IS NOT NULL").select("row", "age", "packed")
    suffixes = stored(_suffixes(rows, wanted, length, gram), "suffixes")
    def buckets(of):
        return max(1, math.ceil(of.count() / BUCKET_SUFFIXES))

    compared = stored(_compare(suffixes.repartitionByRange(buckets(suffixes), "suffix", "before"), length, gram, True), "compared")
    crossing = compared.where("suffix IS NOT NULL").select("suffix", "before", "age", F.col("owner").alias("row"), "at", "least", "most")
    second = stored(_compare(crossing.repartitionByRange(buckets(crossing), "before", "suffix"), length, gram, False), "compared")
    outer = second.where("window IS NOT NULL").select("window", "age", "row", "begin", "stop")
    earliest = outer.groupBy("window").agg(F.min(F.struct("age", "row", "begin")).alias("first"), F.count("*").alias("n")).where("n > 1")
    across = outer.join(earliest, "window").where(F.struct("age", "row", "begin") != F.col("first"))
    spans = ["row", "begin", "stop"]
    return (sifted.where("begin IS NOT NULL").select(spans)
            .union(compared.where("suffix IS NULL").select(spans))
            .union(second.where("window IS NULL").select(spans)).union(across.select(spans)))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, spans (the maximal removed runs, begin and stop), kept (the other bytes).

    ``doc_id`` is a whole number; rows with equal ids follow each other as they lie in the table,
    rows with a null id come after all others.  Null texts are empty; texts shorter than ``length``
    lose nothing.  Copies of a text, and repeated rows, lose all but the first (if long enough).  No
    rows in: no rows out.
    """
    if not 8 <= gram < length <= 250:
        raise ValueError("need 8 <= gram < length <= 250")
    rows = numbered(docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("data"),
                                F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("age")), "row", "documents")
    spans = repeated_spans(rows.select("row", "age", "data"), length, gram)
    gathered = spans.groupBy("row").agg(F.collect_list(F.struct("begin", "stop")).alias("cut"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, runs, kept = [], [], []
        for z, cuts in zip(batch.column("z"), batch.column("cut").to_pylist()):
            data = _unsqueezed(z.as_py())
            edge = np.zeros(len(data) + 1, np.int32)
            if cuts:
                np.add.at(edge, [c["begin"] for c in cuts], 1)
                np.add.at(edge, [c["stop"] for c in cuts], -1)
            out = np.cumsum(edge[:-1]) > 0
            change = np.diff(np.concatenate(([0], out.astype(np.int8), [0])))
            sizes.append(len(data))
            runs.append([{"begin": b, "stop": e} for b, e in zip(np.flatnonzero(change == 1).tolist(),
                                                                np.flatnonzero(change == -1).tolist())])
            kept.append(np.frombuffer(data, np.uint8)[~out].tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()),
             pa.array(runs, pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = _squeezed(rows.select("row", "doc_id", "data")).join(gathered, "row", "left")
    return map_batches(whole, cut, f"doc_id {kind}, n_bytes long, spans array<struct<begin:long,stop:long>>, kept binary",
                       column="z", rows=64, size=1 << 20)


def op5_query(docs: DataFrame) -> DataFrame:
    got = remove_repeats(docs.select("doc_id", "text"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
