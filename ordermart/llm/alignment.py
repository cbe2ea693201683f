"""Alignment of two tokenizers' tokens over the same texts, by whitespace-token anchors.

Both tokenizers encode a whole text; byte offsets where tokens of both end cut the tokens into
groups, and all pairs of tokens of a group are linked.  To find the groups, shared ends that lie
before a space-marked token of both sides are the anchors; between two anchors lies a window, a pair
of id tuples, whose groups follow from the ids alone and are remembered by them, so that each
distinct window is aligned once in a task (until its memory is full and starts anew).

Corpus counts (in how many documents an id pair is linked) need every document's distinct pairs.
These never leave a document one by one: the documents of a *chunk* - what one task reads, until
``CHUNK_PAIRS`` distinct pairs or ``CHUNK_BYTES`` of text are seen - share a dictionary of pairs with
the number of documents of each, and refer to it by place.  The dictionaries alone are shuffled and
summed by pair; then each chunk's documents meet their dictionary again, now with the corpus counts.
No pair is hot: it occurs once a chunk.  The highest count of each id of the first tokenizer is a
table of at most its vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ordermart.llm.common import slices, stored

CHUNK_PAIRS = 1 << 18
CHUNK_BYTES = 16 << 20
_BLOCK = 1 << 16           # characters of a text encoded at once
_WINDOWS = 1 << 17         # windows remembered
_GROUP = 1 << 20           # characters aligned at once
_LARGE = 1 << 12           # pairs of a group that are not listed one by one
_SPREAD = 1 << 32          # pair code: first id * _SPREAD + second id

#: Where a text may be cut without changing either tokenizer's tokens: before a space that stands
#: behind something else than a space and before something else than white space.
_CUT = re.compile(r"(?<=[^ ])(?= \S)")


def blocks(data: str, longest: int = _BLOCK):
    """``data`` in parts of about ``longest`` characters, cut only where ``_CUT`` allows."""
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > longest:
            found = _CUT.search(data, at + longest)
            end = found.start() if found else end
        yield data[at:end]
        at = end


class Pieces:
    """Ids of a sentencepiece model.  Its pieces hold the space mark at their start only, so the
    pieces of a text are those of its blocks."""

    def __init__(self, model: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in names):
            raise ValueError("a piece of this model goes on behind a space mark")
        self.bytes = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]

    def ids_of(self, parts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space (which the model adds itself)."""
        return self.model.encode([p[1:] for p in parts], num_threads=1)


class Remembered:
    """What is known of the windows so far, by number: the text of the groups, their number, and the
    codes of linked pairs with how often each is linked (all windows' in one array)."""

    def __init__(self):
        self.number: dict[tuple[bytes, bytes], int] = {}
        self.texts: list[bytes] = []
        self.groups = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.codes = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int64)

    def add(self, texts: list[bytes], groups: np.ndarray, sizes: np.ndarray, codes: np.ndarray, times: np.ndarray) -> None:
        self.texts += texts
        self.groups = np.concatenate([self.groups, groups])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.codes = np.concatenate([self.codes, codes])
        self.times = np.concatenate([self.times, times])


class Aligner:
    """Groups and linked pairs of texts; remembers windows."""

    def __init__(self, ranks: str, model: str):
        import public_tokenizers
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(b): int(n) for b, n in map(bytes.split, f)}
        self.first = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                       special_tokens={}).encode_to_numpy
        self.second, named = Pieces(model), {n: b for b, n in table.items()}
        self.bytes_a = [named.get(i, b"") for i in range(max(named) + 1)]
        self.bytes_b = self.second.bytes
        self.length_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.length_b = np.array([len(b) for b in self.bytes_b], np.int64)
        self.flat_a, self.flat_b = _flat(self.bytes_a, self.length_a), _flat(self.bytes_b, self.length_b)
        self.space_a = np.array([b.startswith(b" ") for b in self.bytes_a])
        self.space_b = np.array([b.startswith(b" ") for b in self.bytes_b])
        #: An id with the sign behind it, at the place of the sign (by kind) plus the id.
        self.names = [b"%d%s" % (i, sign) for signs, n in ((b",|", len(self.bytes_a)), (b",;", len(self.bytes_b)))
                      for sign in (signs[:1], signs[1:]) for i in range(n)]
        self.memory = Remembered()

    def tokens(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the first kind, of the second kind, how many of each in every block); blocks whose
        bytes are not those of their tokens have none."""
        found_b = self.second.ids_of(parts)
        found_a = [self.first(part, disallowed_special=()) for part in parts]
        size_a, size_b = np.array([len(x) for x in found_a]), np.array([len(x) for x in found_b])
        a = np.concatenate(found_a).astype(np.int64)
        b = np.fromiter(chain.from_iterable(found_b), np.int64, size_b.sum())
        data = [part.encode() for part in parts]
        if not (self.same(a, self.flat_a, b"".join(data)) and self.same(b, self.flat_b, b"".join(data))):
            sound = np.array([self.same(np.array(x, np.int64), self.flat_a, d) and self.same(np.array(y, np.int64), self.flat_b, d)
                              for x, y, d in zip(found_a, found_b, data)])
            a, b = a[np.repeat(sound, size_a)], b[np.repeat(sound, size_b)]
            size_a, size_b = size_a * sound, size_b * sound
        return a, b, size_a, size_b

    @staticmethod
    def same(ids: np.ndarray, flat: tuple[np.ndarray, np.ndarray, np.ndarray], data: bytes) -> bool:
        """Whether the joined bytes of the tokens are ``data``."""
        table, begin, size = flat
        if size[ids].sum() != len(data):
            return False
        return bool((table[_ranges(begin[ids], begin[ids] + size[ids])] == np.frombuffer(data, np.uint8)).all())

    def aligned(self, a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> None:
        """Remember new windows, given one after the other; ``starts``: the first token (of ``a``) of each."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        n_a, n_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
        from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        # text: the tokens of a group in order, each with the sign that follows
        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        shown = np.zeros(len(a) + len(b), np.int64)
        last_a = np.zeros(len(a), bool)
        last_b = np.zeros(len(b), bool)
        last_a[from_a + n_a - 1], last_b[from_b + n_b - 1] = True, True
        shown[np.arange(len(a)) + from_b[group_a]] = a + size_a * last_a
        shown[np.arange(len(b)) + (from_a + n_a)[group_b]] = b + 2 * size_a + size_b * last_b
        words = [self.names[i] for i in shown.tolist()]
        first = group_a[starts]                                 # group of each window's first token
        cuts = (starts + from_b[first]).tolist() + [len(words)]
        texts = [b"".join(words[i:j]) for i, j in zip(cuts, cuts[1:])]
        window = np.repeat(np.arange(len(starts)), np.diff(np.append(first, len(shared))))      # of each group
        # pairs: all of a group; a large group by its different ids
        many = n_a * n_b > _LARGE
        wide = np.where(many, 0, n_b)[group_a]
        left = np.repeat(np.arange(len(a)), wide)
        right = from_b[group_a[left]] + np.arange(len(left)) - np.repeat(np.cumsum(wide) - wide, wide)
        codes, times, owner = [a[left] * _SPREAD + b[right]], [np.ones(len(left), np.int64)], [window[group_a[left]]]
        for g in np.flatnonzero(many).tolist():
            u, m = np.unique(a[from_a[g]:from_a[g] + n_a[g]], return_counts=True)
            v, n = np.unique(b[from_b[g]:from_b[g] + n_b[g]], return_counts=True)
            codes.append((u[:, None] * _SPREAD + v[None, :]).ravel())
            times.append((m[:, None] * n[None, :]).ravel())
            owner.append(np.full(len(codes[-1]), window[g]))
        owner, codes, times = _summed(np.concatenate(owner), np.concatenate(codes), np.concatenate(times))
        self.memory.add(texts, np.bincount(window, minlength=len(starts)), np.bincount(owner, minlength=len(starts)), codes, times)

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each window, its first token of ``a``) for tokens that begin with a space-marked
        one on both sides; new windows are aligned and remembered."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        before_a, before_b = ends_a[:-1][self.space_a[a[1:]]], ends_b[:-1][self.space_b[b[1:]]]
        anchors = np.intersect1d(before_a, before_b, assume_unique=True)
        cuts_a = np.concatenate([[0], np.searchsorted(ends_a, anchors) + 1, [len(a)]])
        cuts_b = np.concatenate([[0], np.searchsorted(ends_b, anchors) + 1, [len(b)]])
        one, which = self.distinct(a, b, cuts_a, cuts_b)
        packed_a, packed_b = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
        number = self.memory.number
        known = len(number)
        ends = (4 * x[one + k] for x in (cuts_a, cuts_b) for k in (0, 1))
        out = np.array([number.setdefault((packed_a[i:j], packed_b[k:m]), len(number))
                        for i, j, k, m in zip(*(x.tolist() for x in ends))], np.int64)
        new = one[out >= known]                             # in the order of their numbers
        if len(new):
            sizes = cuts_a[new + 1] - cuts_a[new]
            self.aligned(a[_ranges(cuts_a[new], cuts_a[new + 1])], b[_ranges(cuts_b[new], cuts_b[new + 1])],
                         np.cumsum(sizes) - sizes)
        return out[which], cuts_a[:-1]

    def distinct(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One window of each pair of id tuples, and which of these each window is: by a hash of the
        ids, then by the ids (should hashes of different windows agree, each window is its own)."""
        total = np.zeros(len(cuts_a) - 1, np.uint64)
        for ids, cuts, salt in ((a, cuts_a, 1), (b, cuts_b, 1 << 20)):
            place = np.arange(len(ids)) - np.repeat(cuts[:-1], np.diff(cuts))
            mixed = (ids + salt).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            total += np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), cuts[:-1])
        one, which = np.unique(total, return_index=True, return_inverse=True)[1:]
        for ids, cuts in ((a, cuts_a), (b, cuts_b)):
            size, begin = np.diff(cuts), cuts[:-1][one][which]
            if not (size == size[one][which]).all() or not (ids == ids[_ranges(begin, begin + size)]).all():
                return np.arange(len(total)), np.arange(len(total))
        return one, which

    def documents(self, texts: list[str | None]) -> list[tuple | None]:
        """For each text (tokens of the first and second kind, groups, hash of the groups' text,
        distinct codes of linked pairs, how often each); None for a text without tokens."""
        states = [_State() if t else None for t in texts]
        todo, size = [], 0
        for k, text in enumerate(texts):
            for part in blocks(" " + text) if text else ():
                todo.append((k, part))
                size += len(part)
                if size >= _GROUP:
                    self._take(todo, states)
                    todo, size = [], 0
        if todo:
            self._take(todo, states)
        return [s.result() if s and s.sound else None for s in states]

    def _take(self, todo: list[tuple[int, str]], states: list) -> None:
        """Align some blocks, and add what they give to their documents."""
        if len(self.memory.number) > _WINDOWS:
            self.memory = Remembered()
        a, b, size_a, size_b = self.tokens([part for _, part in todo])
        owners = np.array([k for k, _ in todo])
        for k in owners[size_a == 0].tolist():
            states[k].sound = False
        if not len(a):
            return
        wins, starts = self.windows(a, b)
        memory = self.memory
        at = np.searchsorted(starts, np.concatenate([[0], np.cumsum(size_a)]))       # a block begins a window
        names = [memory.texts[w] for w in wins.tolist()]
        groups = memory.groups[wins]
        for k, x, y, i, j in zip(owners.tolist(), size_a.tolist(), size_b.tolist(), at.tolist(), at[1:].tolist()):
            states[k].add(x, y, int(groups[i:j].sum()), b"".join(names[i:j]))
        owner = np.repeat(owners, np.diff(at))
        cells, often = np.unique(owner * len(memory.texts) + wins, return_counts=True)
        owner, wins = cells // len(memory.texts), cells % len(memory.texts)
        begin, end = memory.starts[wins], memory.starts[wins + 1]
        some = _ranges(begin, end)
        owner, codes, times = _summed(np.repeat(owner, end - begin), memory.codes[some],
                                      memory.times[some] * np.repeat(often, end - begin))
        cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
        for i, j in zip(cut.tolist(), cut[1:].tolist()):
            states[int(owner[i])].pairs.append((codes[i:j], times[i:j]))


class _State:
    """A document while its blocks come in."""

    def __init__(self):
        self.sound, self.n_a, self.n_b, self.groups, self.pairs = True, 0, 0, 0, []
        self.digest = hashlib.sha256()

    def add(self, n_a: int, n_b: int, groups: int, text: bytes) -> None:
        self.digest.update((b";" if self.n_a else b"") + text[:-1])
        self.n_a, self.n_b, self.groups = self.n_a + n_a, self.n_b + n_b, self.groups + groups

    def result(self) -> tuple:
        codes, times = (np.concatenate(x) for x in zip(*self.pairs))
        if len(self.pairs) > 1:
            _, codes, times = _summed(np.zeros(len(codes), np.int64), codes, times)
        return self.n_a, self.n_b, self.groups, self.digest.hexdigest(), codes, times


def _flat(tokens: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, where each begins and how long it is."""
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    size = end - begin
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)


def _summed(owner: np.ndarray, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, code) in order, and the sums of their numbers."""
    order = np.lexsort((codes, owner))
    owner, codes, times = owner[order], codes[order], times[order]
    first = np.flatnonzero(np.concatenate([[len(owner) > 0], (owner[1:] != owner[:-1]) | (codes[1:] != codes[:-1])]))
    return owner[first], codes[first], np.add.reduceat(times, first) if len(first) else times


@lru_cache(maxsize=2)
def aligner(ranks: str | None, model: str | None) -> Aligner:
    """The task's aligner; None: the public vocabularies, found where the task runs."""
    import public_tokenizers
    return Aligner(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"),
                   model or public_tokenizers.path("piece_bpe_32k.model"))


#: Fields of stored rows beside the documents' own columns; ``kind`` 0: a document, 1: a dictionary.
_FIELDS = {"kind": ("int", pa.int32()), "chunk": ("long", pa.int64()), "n_a": ("long", pa.int64()), "n_b": ("long", pa.int64()),
           "n_groups": ("long", pa.int64()), "n_links": ("long", pa.int64()), "groups_sha256": ("string", pa.string()),
           "places": ("binary", pa.binary()), "times": ("binary", pa.binary()), "codes": ("binary", pa.binary()),
           "docs": ("binary", pa.binary())}


class Chunk:
    """The distinct pairs of some documents, numbered, and in how many of the documents each is."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.place: dict[int, int] = {}
        self.docs = np.zeros(1 << 12, np.int64)

    def add(self, documents: list[np.ndarray]) -> list[np.ndarray]:
        """The places of the (distinct) codes of each document."""
        codes, which = np.unique(np.concatenate([np.zeros(0, np.int64), *documents]), return_inverse=True)
        place = self.place
        places = np.array([place.setdefault(c, len(place)) for c in codes.tolist()], np.int64)
        while len(place) > len(self.docs):
            self.docs = np.concatenate([self.docs, np.zeros_like(self.docs)])
        self.docs[places] += np.bincount(which, minlength=len(codes))
        return np.split(places[which], np.cumsum([len(d) for d in documents])[:-1]) if documents else []

    def row(self, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
        """The dictionary as one row; the documents' own columns are null."""
        codes = np.fromiter(self.place, "<i8", len(self.place))
        values = {"kind": 1, "chunk": self.number, "codes": codes.tobytes(), "docs": self.docs[:len(codes)].astype("<i8").tobytes()}
        return pa.RecordBatch.from_arrays([pa.array([values.get(c)], t) for c, t in zip(names, kinds)], names=names)


def _small(numbers: np.ndarray) -> bytes:
    """Positive numbers, packed as narrow as the largest allows."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}" if n else "<u1").astype(np.int64)


def encoded(docs: DataFrame, text: str, ranks: str | None = None, model: str | None = None) -> DataFrame:
    """A row for each document (``docs`` without ``text``, tokens and groups, linked pairs as places in
    the dictionary of its chunk) and a row for each dictionary (pair codes, documents holding each)."""
    kept = [c for c in docs.columns if c != text]

    def run(batches):
        own, task, n = aligner(ranks, model), TaskContext.get().partitionId(), 0
        chunk, names, kinds = Chunk(task << 32), [*kept, *_FIELDS], None
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in kept] + [t for _, t in _FIELDS.values()]
            for part in slices(batch, text, 256, 1 << 20):
                if len(chunk.place) > CHUNK_PAIRS or chunk.place and chunk.size > CHUNK_BYTES:
                    yield chunk.row(names, kinds)
                    n += 1
                    chunk = Chunk(task << 32 | n)
                values = part.column(text).to_pylist()
                found = own.documents(values)
                places = iter(chunk.add([x[4] for x in found if x]))
                chunk.size += sum(len(v or "") for v in values)
                rows = []
                for x in found:
                    if x is None:
                        rows.append((0, chunk.number, 0, 0, 0, 0, "", b"", b"", None, None))
                    else:
                        n_a, n_b, groups, digest, _, times = x
                        rows.append((0, chunk.number, n_a, n_b, groups, int(times.sum()), digest,
                                     next(places).astype("<u4").tobytes(), _small(times), None, None))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS.values())],
                    names=names)
        if chunk.place:
            yield chunk.row(names, kinds)
    schema = docs.drop(text).withColumns({c: F.lit(None).cast(t) for c, (t, _) in _FIELDS.items()}).schema
    return docs.mapInArrow(run, StructType([StructField(f.name, f.dataType) for f in schema]))     # all may be null


def _unpacked(batches):
    """Dictionary rows as one row a pair."""
    for batch in batches:
        for chunk, codes, docs in zip(*(batch.column(c).to_pylist() for c in ("chunk", "codes", "docs"))):
            code, docs = np.frombuffer(codes, "<i8"), np.frombuffer(docs, "<i8")
            for at in range(0, len(code), 1 << 16):
                some = code[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), chunk)), pa.array(np.arange(at, at + len(some))), pa.array(some // _SPREAD),
                     pa.array(some % _SPREAD), pa.array(docs[at:at + (1 << 16)])], names=["chunk", "place", "a", "b", "docs"])


def _counted(documents: pa.Table, dictionary: pa.Table) -> pa.Table:
    """The documents of a chunk with n_best and count_sum in place of their pairs."""
    count = np.zeros(len(dictionary), np.int64)
    best = np.zeros(len(dictionary), bool)
    place = dictionary.column("place").to_numpy()
    count[place] = dictionary.column("count").to_numpy()
    best[place] = dictionary.column("is_best").to_numpy()
    n_best, total = [], []
    for p, t in zip(documents.column("places"), documents.column("times")):
        p = np.frombuffer(p.as_buffer(), "<u4")
        t = _wide(t.as_py(), len(p))
        n_best.append(int(t[best[p]].sum()))
        total.append(int((t * count[p]).sum()))
    out = documents.drop_columns(["chunk", "places", "times"])
    return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def pair_counts(dictionary: DataFrame) -> DataFrame:
    """(a, b, count, is_best) from (a, b, docs): in how many documents the pair is linked, and whether
    that is the highest count of its ``a``."""
    counts = stored(dictionary.groupBy("a", "b").agg(F.sum("docs").alias("count")), "counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))       # at most a row a first-tokenizer id
    return counts.join(F.broadcast(highest), "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("is_best"))


def align(docs: DataFrame, text: str = "text", ranks: str | None = None, model: str | None = None) -> DataFrame:
    """The columns of ``docs`` but ``text``, with n_a, n_b, n_groups, n_links, n_best, count_sum (long)
    and groups_sha256.

    Texts that are null, empty or not given back by both tokenizers' bytes have no tokens: zeros and
    ''.  Each row is a document of its own, repeated ones and those with a null doc_id included.  No
    rows in: no rows out.  Columns named like an added one are refused.
    """
    added = {*_FIELDS, "n_best", "count_sum"}
    if clash := added & {c.lower() for c in docs.columns if c != text}:
        raise ValueError(f"columns with names that the result needs: {sorted(clash)}")
    rows = stored(encoded(docs.withColumn(text, F.col(text).cast("string")), text, ranks, model), "encoded")
    dictionary = stored(rows.where("kind = 1").select("chunk", "codes", "docs")
                        .mapInArrow(_unpacked, "chunk long, place long, a long, b long, docs long"), "pairs")
    known = dictionary.join(pair_counts(dictionary), ["a", "b"]).select("chunk", "place", "count", "is_best")
    out = [c for c in docs.columns if c != text] + ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    zeros = {"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")}
    documents = rows.where("kind = 0")
    empty = documents.where("n_a = 0").select(out).withColumns(zeros)
    held = documents.where("n_a > 0").select("chunk", *out, "places", "times")
    sums = held.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_counted, empty.schema)
    return sums.union(empty)


def op12_query(docs: DataFrame) -> DataFrame:
    return align(docs.select("doc_id", "text")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                                       "groups_sha256")
