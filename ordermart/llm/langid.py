"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a random vector of +1/-1 drawn from a seed and its code point.  A letter
n-gram is the product (binding) of its letters' vectors, each rotated (permuted) by its place
in the n-gram.  A document's profile is the sum (bundle) of the vectors of all its n-grams; a
language's prototype is the sum of the profiles of its training documents.  A document gets the
language whose prototype has the largest cosine with its profile.

Scale: training is one scan.  Each task bundles its documents into one vector per language
(n-gram counts first, so the vectors are added once per distinct n-gram), and the partial
vectors are added per (language, dimension) with map-side aggregation.  Only the prototypes come
to the driver: languages x dimensions numbers, independent of the corpus.  Prediction is a
second scan without a shuffle.  All sums are of integers, so results do not depend on how rows
are partitioned.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import held_out, learnable, map_batches, slices, spare_name

DIM = 512
NGRAM = 3
SEED = 20231
UNKNOWN = "und"
_SPACE = np.array([32], np.uint32)
_BLOCK = 1 << 20          # n-grams handled at once, also within one long document
_DENSE = 1 << 22          # up to so many possible n-grams are counted in a table, more by sorting
_COLUMNS = 1 << 13        # distinct n-grams whose vectors are made at once
_CELLS = 1 << 22          # up to so many (row, n-gram) counts are held in a table, more as sorted cells


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """For every code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=65536)
def letter_vector(code_point: int, dim: int, seed: int) -> np.ndarray:
    bits = np.random.default_rng([seed, code_point]).integers(0, 2, dim, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def letters_of(text: str | None) -> np.ndarray:
    """Lower-cased code points: letters kept, each run of other characters one space, and one
    space at either end.  Empty if there is no letter."""
    if not text:
        return np.empty(0, np.uint32)
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[cps]
    if not letter.any():
        return np.empty(0, np.uint32)
    cps = np.concatenate((_SPACE, np.where(letter, cps, _SPACE), _SPACE))
    keep = np.ones(len(cps), bool)
    keep[1:] = (cps[1:] != 32) | (cps[:-1] != 32)
    return cps[keep]


def ngram_vectors(keys: np.ndarray, letters: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """One bound vector per trigram (float32 rows of +1/-1); ``keys`` number the trigrams over
    ``letters`` as digits to the base of their count."""
    base = len(letters)
    table = np.stack([letter_vector(int(c), dim, seed) for c in letters])
    out = np.roll(table, NGRAM - 1, axis=1)[keys // base ** (NGRAM - 1)]
    for j in range(1, NGRAM):
        out *= np.roll(table, NGRAM - 1 - j, axis=1)[keys // base ** (NGRAM - 1 - j) % base]
    return out.astype(np.float32)


def _numbered(parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct letters of the arrays, and the arrays with each letter replaced by its place."""
    seen = np.zeros(0x110000, bool)
    for p in parts:
        seen[p] = True
    letters = np.flatnonzero(seen)
    place = np.zeros(0x110000, np.int32)
    place[letters] = np.arange(len(letters), dtype=np.int32)
    return letters, [place[p] for p in parts]


def _distinct(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with inverse; by counting where the keys are small numbers."""
    if size > _DENSE:
        return np.unique(key, return_inverse=True)
    found = np.flatnonzero(np.bincount(key, minlength=size))
    place = np.zeros(size, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place[key]


def _count_blocks(at: np.ndarray, owner: np.ndarray, n_grams: int, n_rows: int):
    """(first n-gram, counts of each row for up to ``_COLUMNS`` n-grams), block by block: memory grows
    neither with the alphabet nor with rows times n-grams."""
    if n_grams * n_rows <= _CELLS:
        cells = np.bincount(owner * n_grams + at, minlength=n_rows * n_grams).reshape(n_rows, n_grams)
        for begin in range(0, n_grams, _COLUMNS):
            yield begin, cells[:, begin:begin + _COLUMNS].astype(np.float32)
        return
    cells, often = np.unique(at.astype(np.int64) * n_rows + owner, return_counts=True)
    for begin in range(0, n_grams, _COLUMNS):
        width = min(_COLUMNS, n_grams - begin)
        i, j = np.searchsorted(cells, [begin * n_rows, (begin + width) * n_rows])
        out = np.zeros((n_rows, width), np.float32)
        out[cells[i:j] % n_rows, cells[i:j] // n_rows - begin] = often[i:j]
        yield begin, out


def bundles(texts: list[str | None], groups: list[int], n_groups: int, dim: int, seed: int) -> np.ndarray:
    """Sum of n-gram vectors per group: ``groups[i]`` is the row that text i is added to."""
    total = np.zeros((n_groups, dim), np.float64)
    parts, rows, waiting = [], [], 0

    def flush():
        nonlocal parts, rows, waiting
        if waiting:
            letters, local = _numbered(parts)
            base, keys = len(letters), []
            for p in local:
                n = len(p) - NGRAM + 1
                key = p[:n].astype(np.int64)
                for j in range(1, NGRAM):
                    key = key * base + p[j:j + n]
                keys.append(key)
            groups_here, row = np.unique(rows, return_inverse=True)
            found, at = _distinct(np.concatenate(keys), base ** NGRAM)
            owner = np.repeat(row, [len(k) for k in keys])
            del keys
            for begin, counts in _count_blocks(at, owner, len(found), len(groups_here)):
                vectors = ngram_vectors(found[begin:begin + counts.shape[1]], letters, dim, seed)
                total[groups_here] += counts @ vectors
        parts, rows, waiting = [], [], 0

    for text, group in zip(texts, groups):
        cps = letters_of(text)
        for begin in range(0, max(0, len(cps) - NGRAM + 1), _BLOCK):
            part = cps[begin:begin + _BLOCK + NGRAM - 1]
            parts.append(part)
            rows.append(group)
            waiting += len(part)
            if waiting >= _BLOCK:
                flush()
    flush()
    return total


def learn_prototypes(docs: DataFrame, dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Language -> prototype vector, from all rows of (text, lang) with a non-null lang."""
    return {k: v for k, (v, _) in learn_profiles(docs, dim, seed).items()}


def learn_profiles(docs: DataFrame, dim: int = DIM, seed: int = SEED) -> dict[str, tuple[np.ndarray, int]]:
    """Language -> prototype vector and number of n-grams in it."""
    def partial(batches):
        sums: dict[str, np.ndarray] = {}
        grams: dict[str, int] = {}
        for batch in batches:
            for piece in slices(batch, "text", 512, 4 << 20):
                langs = piece.column("lang").to_pylist()
                names = sorted(set(langs))
                place = {name: i for i, name in enumerate(names)}
                got = bundles(piece.column("text").to_pylist(), [place[x] for x in langs], len(names), dim, seed)
                for name, row in zip(names, got):
                    sums[name] = sums.get(name, 0) + np.rint(row).astype(np.int64)
                for name, n in zip(langs, n_grams(piece.column("text").to_pylist())):
                    grams[name] = grams.get(name, 0) + n
        for name in sorted(sums):       # dimension -1: the number of n-grams
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * (dim + 1), pa.string()), "dim": pa.array(range(-1, dim), pa.int32()),
                "value": pa.array(np.concatenate(([grams[name]], sums[name])), pa.int64())})

    rows = (docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
            .where("text IS NOT NULL AND lang IS NOT NULL")
            .mapInArrow(partial, "lang string, dim int, value long")
            .groupBy("lang", "dim").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
            .collect())   # languages x dimensions numbers
    out = {r["lang"]: np.array([x["value"] for x in r["v"]], np.float64) for r in rows}
    return {k: (out[k][1:], int(out[k][0])) for k in sorted(out) if np.any(out[k][1:])}


def n_grams(texts: list[str | None]) -> list[int]:
    """How many n-grams each text has."""
    return [max(0, len(letters_of(t)) - NGRAM + 1) for t in texts]


def expected_cosine(n, variety: float):
    """The cosine that ``n`` n-grams drawn from a language have with its prototype on average, where
    ``variety`` is 1 / the sum of its squared n-gram shares: sqrt(n / (n - 1 + variety))."""
    return np.sqrt(n / (n - 1 + variety)) if np.isscalar(n) else F.sqrt(n / (n - F.lit(1.0) + F.lit(variety)))


def variety_of(prototype: np.ndarray, n: int) -> float:
    """1 / the sum of the squared n-gram shares of a prototype made of ``n`` n-grams."""
    return max(1.0, len(prototype) * float(n) ** 2 / float(prototype @ prototype))


def predict(texts: list[str | None], names: list[str], prototypes: np.ndarray, dim: int, seed: int):
    """Predicted language and cosine (0 if negative) per text; ``prototypes`` have length 1."""
    got = bundles(texts, list(range(len(texts))), len(texts), dim, seed)
    norm = np.sqrt((got * got).sum(axis=1))
    known = np.array([len(letters_of(t[:4096])) > 0 or len(letters_of(t)) > 0 if t else False for t in texts], bool)
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    cosine = (got @ prototypes.T) / np.where(norm > 0, norm, 1)[:, None]
    best = cosine.argmax(axis=1)          # ties: the first name in order
    score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
    langs = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
    return langs, np.where(known, score, 0.0)


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text",
             lang_col: str = "lang_pred", score_col: str = "score",
             dim: int = DIM, seed: int = SEED, grams_col: str | None = None) -> DataFrame:
    """``docs`` with two more columns: the language and its cosine.

    Null, empty or letterless text: ``und`` with score 0.  No prototypes: ``und`` everywhere.
    Equal cosines: the first language in alphabetical order.  Repeated rows stay, each with the
    same answer; other columns pass through untouched (the new names must be free).  ``grams_col``: a further
    column with the number of n-grams.
    """
    names = sorted(prototypes)
    unit = np.stack([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names]) if names else np.zeros((0, dim))
    taken = {c.lower() for c in docs.columns}
    if lang_col.lower() in taken or score_col.lower() in taken:
        raise ValueError(f"{lang_col} or {score_col} is already a column")
    work = spare_name(docs.columns, "text_of")

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(work).to_pylist()
        langs, scores = predict(texts, names, unit, dim, seed)
        new = {lang_col: pa.array(langs, pa.string()), score_col: pa.array(scores, pa.float64())}
        if grams_col:
            new[grams_col] = pa.array(n_grams(texts), pa.int64())
        keep = [i for i, n in enumerate(batch.schema.names) if n != work]
        return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + list(new.values()),
                                          names=[batch.schema.names[i] for i in keep] + list(new))

    added = {lang_col: F.lit(""), score_col: F.lit(0.0)} | ({grams_col: F.lit(0).cast("long")} if grams_col else {})
    schema = docs.withColumns(added).schema
    return map_batches(docs.withColumn(work, F.col(text).cast("string")), add, schema, column=work)


def op10_query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; learns from the other folds only."""
    prototypes = learn_prototypes(docs.where(learnable()))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(rows, prototypes).select("doc_id", "held_out", "lang_pred", "score")


#: ``keep_known`` rejects a text below this share of the cosine its length makes expect ...
SHARE = 0.25
#: ... by more than so many standard deviations of the cosine of random vectors.
DEVIATIONS = 3.0


def keep_known(docs: DataFrame, share: float = SHARE, deviations: float = DEVIATIONS, dim: int = DIM) -> DataFrame:
    """Pipeline stage: documents with a recognised language, all their columns (any names) as they were.

    Rejected are texts without a letter (null and empty ones, too), and those whose cosine with the best
    language lies more than ``deviations`` / sqrt(dim) (the noise of random vectors) below ``share`` of
    what a text with as many n-grams of that language has on average: few of their n-grams are of any
    known language.  One rule for all lengths: for short texts the expected cosine is itself within the
    noise, so these are kept.  Repeated rows are judged alike.  Without any labelled document there is no
    known language and nothing stays; no rows in: no rows out.
    """
    names = {}
    for c in ("lang_pred", "lang_score", "lang_grams"):
        names[c] = spare_name([*docs.columns, *names.values()], c)
    lang, score, grams = names.values()
    profiles = learn_profiles(docs.where(learnable()), dim)
    found = identify(docs, {k: v for k, (v, _) in profiles.items()}, lang_col=lang, score_col=score, grams_col=grams, dim=dim)
    least = F.lit(0.0)
    for name, (prototype, n) in profiles.items():
        wanted = F.lit(share) * expected_cosine(F.col(grams), variety_of(prototype, n)) - F.lit(deviations / dim ** 0.5)
        least = F.when(F.col(lang) == F.lit(name), wanted).otherwise(least)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(docs.columns)
