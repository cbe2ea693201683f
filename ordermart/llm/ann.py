"""Approximate nearest neighbours (Euclidean) through learned partitions.

Fit, on a bounded sample of distinct vectors: the exact neighbour graph of the sample is cut into
balanced partitions (halves along principal directions, then vertices move to the partition of most
of their neighbours while sizes stay within bounds), and a small classifier - one hidden layer,
trained on the share of each vertex's neighbourhood that lies in each partition - learns to name the
partitions of any vector.

Index: every vector goes to the classifier's most probable partition.  Search: a query goes to its
``probes`` most probable partitions and is compared there with all vectors, exactly and in double
precision.  ``probes`` is the smallest number that found the wanted share of the true neighbours of a
bounded calibration set, whose true neighbours come from a scan of all indexed vectors; that measured
recall is kept in ``Index.recall``.

Scale: a partition's vectors are dealt into blocks of at most about ``BLOCK`` and its queries into
blocks of ``QUERIES``, so a task holds one block of each whatever a partition's size.  Of equal
vectors only the k + 1 smallest ids can be anyone's answer (a map-side limit drops the others), and
equal queries are searched once, so a group of copies is never compared with itself.  The driver sees
the model (``MAX_PARTITIONS`` outputs), partition sizes and the calibration answers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import stored

NEIGHBOURS = 10
EVERY = 100                # queries: rows whose id is divisible by this
ROWS = 500                 # vectors that a partition aims at
MAX_PARTITIONS = 1024
SAMPLED = 32               # fitted vectors a partition: at most 32,768 in all
CALIBRATION = 200          # vectors whose true neighbours set the number of probes
RECALL = 0.95              # share of these to find (aim; 0.9 is asked for)
HIDDEN = 128
BLOCK = 1 << 15
QUERIES = 1 << 13


# --- numbers inside a task ----------------------------------------------------------------------

def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and distances of the ``k`` nearest points of each query, ties to the smaller id.
    Products only preselect (with a margin above their rounding); distances are direct."""
    out = []
    with np.errstate(over="ignore", invalid="ignore"):
        norms = np.einsum("ij,ij->i", points, points)
        for at in range(0, len(queries), 128):
            block = queries[at:at + 128]
            own = np.einsum("ij,ij->i", block, block)[:, None]
            rough = np.nan_to_num(own + norms - 2 * (block @ points.T), nan=-np.inf)   # overflow: keep, decide below
            last = min(k, len(points)) - 1
            bound = np.partition(rough, last, axis=1)[:, last] + 1e-12 * (own[:, 0] + norms.max(initial=0))
            for q, row, most in zip(block, rough, bound):
                some = np.flatnonzero(row <= most)
                d = np.sqrt(((points[some] - q) ** 2).sum(axis=1))
                best = np.lexsort((ids[some], d))[:k]
                out.append((some[best], d[best]))
    return out


def neighbour_graph(points: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The ``k`` nearest other points of each point (positions)."""
    k = min(k, len(points) - 1)
    norms, out = np.einsum("ij,ij->i", points, points), np.zeros((len(points), k), np.int64)
    for at in range(0, len(points), 256):
        rough = norms[None, :] - 2 * (points[at:at + 256] @ points.T)
        rough[np.arange(len(rough)), np.arange(at, at + len(rough))] = np.inf
        out[at:at + 256] = np.argpartition(rough, k - 1, axis=1)[:, :k] if k else 0
    return out


def _halved(points: np.ndarray, parts: int) -> np.ndarray:
    """Balanced start: cut along the principal direction, again and again."""
    label, todo = np.zeros(len(points), np.int64), [(np.arange(len(points)), 0, parts)]
    while todo:
        ids, first, n = todo.pop()
        label[ids] = first
        if n == 1 or len(ids) < 2:
            continue
        centred = points[ids] - points[ids].mean(axis=0)
        axis = np.ones(points.shape[1]) + 0.01 * np.arange(points.shape[1])
        for _ in range(12):
            axis = centred.T @ (centred @ axis)
            size = np.linalg.norm(axis)
            axis = axis / size if size > 0 else np.ones(points.shape[1])
        order, half = ids[np.argsort(centred @ axis, kind="stable")], n // 2
        cut = len(ids) * half // n
        todo += [(order[:cut], first, half), (order[cut:], first + half, n - half)]
    return label


def partitioned(points: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12,
                slack: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(partition of each vertex, neighbours of each vertex in each partition): few edges are cut and
    no partition leaves (1 +- ``slack``) times its fair size."""
    n = len(points)
    label = _halved(points, parts)
    source, target = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    size = np.bincount(label, minlength=parts)
    most, least = max(int(np.ceil(n / parts * (1 + slack))), size.max()), min(int(n / parts * (1 - slack)), size.min())

    def shares() -> np.ndarray:
        return np.bincount(source * parts + label[target], minlength=n * parts).reshape(n, parts)

    for step in range(rounds):
        near = shares()
        best = near.argmax(axis=1)
        gain = near[np.arange(n), best] - near[np.arange(n), label]
        movers = np.flatnonzero((gain > 0) & (np.arange(n) % 2 == step % 2))   # half at a time: no swapping back and forth
        moved = 0
        for v in movers[np.argsort(-gain[movers], kind="stable")]:
            if size[best[v]] < most and size[label[v]] > least:
                size[label[v]] -= 1
                size[best[v]] += 1
                label[v] = best[v]
                moved += 1
        if not moved and step:
            break
    return label, shares()


@dataclass
class Router:
    """A classifier with one hidden layer: scores of the partitions for rows of vectors."""
    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, points: np.ndarray) -> np.ndarray:
        x = (points - self.mean) / self.scale
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def trained(points: np.ndarray, wanted: np.ndarray, hidden: int = HIDDEN, epochs: int = 40, seed: int = 7) -> Router:
    """Fit the router to the wanted shares (rows add up to 1) by Adam on cross entropy."""
    rng = np.random.default_rng(seed)
    mean = points.mean(axis=0)
    scale = float(np.sqrt(((points - mean) ** 2).mean())) or 1.0
    x, parts = (points - mean) / scale, wanted.shape[1]
    p = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
         rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            some = order[at:at + 128]
            h = np.maximum(x[some] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (e / e.sum(axis=1, keepdims=True) - wanted[some]) / len(some)
            dh = (dz @ p[2].T) * (h > 0)
            t += 1
            rate = 3e-3 * (1 - epoch / epochs)
            for i, g in enumerate((x[some].T @ dh + 1e-4 * p[0], dh.sum(axis=0), h.T @ dz + 1e-4 * p[2], dz.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return Router(mean, scale, *p)


def fit(points: np.ndarray, parts: int) -> Router:
    """The router for ``parts`` balanced partitions of the neighbour graph of ``points``."""
    label, shares = partitioned(points, neighbour_graph(points), parts)
    shares = shares.astype(np.float64)
    shares[np.arange(len(points)), label] += 1
    return trained(points, shares / shares.sum(axis=1, keepdims=True))


# --- Spark jobs ---------------------------------------------------------------------------------

@dataclass
class Index:
    rows: DataFrame              # vec_id, embedding, part: every vector that can be an answer
    router: Router | None        # None: a single partition
    sizes: np.ndarray            # vectors of each partition
    dimension: int
    k: int                       # copies kept: enough for this many neighbours
    probes: int = 1
    recall: float = 1.0          # measured on the calibration vectors


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows with an id and a vector that is not null, empty or zero and has finite components only."""
    kind = dict(vectors.dtypes)[column]
    whole = vectors if kind == "array<float>" else vectors.withColumn(column, F.col(column).cast("array<double>"))
    fine = F.forall(column, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))     # NaN is above all
    return whole.where(F.col("vec_id").isNotNull() & F.coalesce(fine & F.exists(column, lambda x: x != 0), F.lit(False)))


def _key(column: str = "embedding") -> dict:
    """Two 64-bit hashes that name a vector."""
    return {"k1": F.xxhash64(column), "k2": F.xxhash64(F.lit("second"), column)}


def _parted(df: DataFrame, router: Router | None) -> DataFrame:
    """``df`` (vec_id, embedding) with each vector's most probable partition."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                piece = batch.slice(at, 2048)
                parts = router.scores(matrix(piece.column("embedding"))).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(parts)], names=[*piece.schema.names, "part"])
    if router is None:
        return df.withColumn("part", F.lit(0))
    return df.mapInArrow(run, df.withColumn("part", F.lit(0)).schema)


def _true_neighbours(rows: DataFrame, points: np.ndarray, k: int) -> list:
    """For each of the (few) ``points`` its ``k`` nearest rows of all: (d, vec_id, part), nearest first."""
    def run(batches):
        best = [[] for _ in points]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                ids, parts = piece.column("vec_id").to_numpy(), piece.column("part").to_numpy()
                for q, (some, d) in enumerate(nearest(matrix(piece.column("embedding")), ids, points, k)):
                    best[q] = sorted(best[q] + list(zip(d.tolist(), ids[some].tolist(), parts[some].tolist())))[:k]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(points)), pa.int32()), pa.array(
            [[dict(zip(("d", "vec_id", "part"), x)) for x in b] for b in best],
            pa.list_(pa.struct([("d", pa.float64()), ("vec_id", pa.int64()), ("part", pa.int32())])))], names=["q", "found"])
    found = rows.mapInArrow(run, "q int, found array<struct<d:double,vec_id:long,part:int>>")
    top = found.groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    return [r.found for r in top.orderBy("q").collect()]


def build(vectors: DataFrame, k: int = NEIGHBOURS, per_partition: int = ROWS, recall: float = RECALL) -> Index | None:
    """Index every usable row of ``vectors`` (vec_id long, embedding); None if there is none.

    Vectors of another length than the most common (ties: the longest) take no part, as null, empty
    and zero ones and those with a null or non-finite component or a null vec_id.  Repeated rows are
    rows of their own.
    """
    fine = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    common = fine.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return None
    keyed = fine.where(F.size("embedding") == common.d).withColumns(_key())
    copy = F.row_number().over(Window.partitionBy("k1", "k2", "embedding").orderBy("vec_id"))
    kept = stored(keyed.withColumn("copy", copy).where(F.col("copy") <= k + 1), "vectors")
    single = kept.where("copy = 1")
    total = single.count()
    parts = min(MAX_PARTITIONS, max(1, total // per_partition))
    router, tried = None, np.zeros((0, common.d))
    if parts > 1:
        picked = stored(single.orderBy(F.xxhash64("k2", F.lit("sample")), "vec_id").select("embedding")
                        .limit(parts * SAMPLED + CALIBRATION).withColumn("place", F.monotonically_increasing_id()), "sample")
        order = picked.orderBy("place")
        trials = min(CALIBRATION, picked.count() // 5)
        tried = np.array([r.embedding for r in order.limit(trials).collect()], np.float64).reshape(trials, -1)

        def learn(batches):
            points = np.concatenate([matrix(b.column("embedding")) for b in batches])[trials:]
            r = fit(points, parts)
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(x, np.float64).tobytes()], pa.binary()) for x in
                                              (r.mean, r.scale, r.w1, r.b1, r.w2, r.b2)], names=list("abcdef"))
        learnt = order.coalesce(1).mapInArrow(learn, ", ".join(f"{c} binary" for c in "abcdef")).first()
        mean, scale, w1, b1, w2, b2 = (np.frombuffer(bytes(x)) for x in learnt)
        router = Router(mean, float(scale[0]), w1.reshape(len(mean), -1), b1, w2.reshape(len(b1), -1), b2)
    rows = stored(_parted(kept.select("vec_id", "embedding"), router), "partitions")
    sizes = np.zeros(parts, np.int64)
    for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect():
        sizes[r.part] = r.n
    index = Index(rows, router, sizes, common.d, k)
    if parts > 1:
        ranks = []
        order = np.argsort(-router.scores(tried), axis=1, kind="stable")
        for own, found in zip(order, [] if not trials else _true_neighbours(rows, tried, k + 1)):
            place = np.empty(parts, np.int64)
            place[own] = np.arange(parts)
            others = found[1:] if found and found[0].d == 0 else found[:k]      # its own row comes first
            ranks += [place[x.part] for x in others]
        ranks = ranks or [0]
        found_by = np.searchsorted(np.sort(ranks), np.arange(1, parts + 1)) / len(ranks)
        index.probes = int(np.argmax(found_by >= recall)) + 1
        index.recall = float(found_by[index.probes - 1])
    return index


def _routed(queries: DataFrame, index: Index) -> DataFrame:
    """A row for each query (k1, k2, embedding) and partition to look in; more partitions than
    ``probes`` where these hold too few rows."""
    router, sizes, probes, least = index.router, index.sizes, index.probes, index.k + 1

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                order = np.argsort(-router.scores(matrix(piece.column("embedding"))), axis=1, kind="stable")
                enough = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1) + 1
                counts = np.minimum(np.maximum(probes, enough), len(sizes))
                taken = np.concatenate([row[:n] for row, n in zip(order, counts)]) if len(order) else np.zeros(0)
                again = piece.take(pa.array(np.repeat(np.arange(len(order)), counts)))
                yield pa.RecordBatch.from_arrays([*again.columns, pa.array(taken.astype(np.int32))],
                                                 names=[*again.schema.names, "part"])
    if router is None:
        return queries.withColumn("part", F.lit(0))
    return queries.mapInArrow(run, queries.withColumn("part", F.lit(0)).schema)


_FOUND = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("d", pa.list_(pa.float64())), ("id", pa.list_(pa.int64()))])


def _compared(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest of a block of vectors for each of a block of queries."""
    if not len(left) or not len(right):
        return _FOUND.empty_table()
    ids = left.column("vec_id").to_numpy()
    found = nearest(matrix(left.column("embedding")), ids, matrix(right.column("embedding")), k)
    return pa.table([right.column("k1").combine_chunks(), right.column("k2").combine_chunks(),
                     pa.array([d for _, d in found], pa.list_(pa.float64())),
                     pa.array([ids[some] for some, _ in found], pa.list_(pa.int64()))], schema=_FOUND)


def search(index: Index, queries: DataFrame) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score for each row of ``queries`` (vec_id long,
    embedding): its ``index.k`` nearest found, ties to the smaller vec_id.  Its own row (the same
    vec_id and vector) is no answer.  Unusable queries and those of another length give no rows."""
    spark, k = queries.sparkSession, index.k
    asked = usable(queries).where(F.size("embedding") == index.dimension).withColumns(_key())
    different = asked.groupBy("k1", "k2").agg(F.first("embedding").alias("embedding"))
    probes = stored(_routed(different, index), "probes")
    wanted = {r.part: r.n for r in probes.groupBy("part").agg(F.count("*").alias("n")).collect()}
    plan = [(p, max(1, -(-int(n) // BLOCK)), max(1, -(-wanted.get(p, 0) // QUERIES))) for p, n in enumerate(index.sizes)]
    blocks = F.broadcast(spark.createDataFrame(plan, "part int, blocks int, turns int"))       # a row a partition
    every = lambda n: F.explode(F.sequence(F.lit(0), n - F.lit(1)))
    mine = lambda key, n: F.pmod(F.xxhash64(*key), n).cast("int")
    left = (index.rows.join(blocks, "part").withColumn("block", mine(["vec_id"], F.col("blocks")))
            .withColumn("turn", every(F.col("turns"))).select("part", "block", "turn", "vec_id", "embedding"))
    right = (probes.join(blocks, "part").withColumn("turn", mine(["k1", "k2"], F.col("turns")))
             .withColumn("block", every(F.col("blocks"))).select("part", "block", "turn", "k1", "k2", "embedding"))
    group = ["part", "block", "turn"]
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        lambda a, b: _compared(a, b, k + 1), "k1 long, k2 long, d array<double>, id array<long>")
    best = found.groupBy("k1", "k2").agg(F.slice(F.array_sort(F.flatten(F.collect_list(
        F.arrays_zip("d", "id")))), 1, k + 1).alias("best"))
    own = F.array_position("best", F.struct(F.lit(0.0).alias("d"), F.col("query_id").alias("id")))
    others = F.slice(F.filter("best", lambda x, i: i + F.lit(1) != F.col("own")), 1, k)
    return (asked.select(F.col("vec_id").alias("query_id"), "k1", "k2").join(best, ["k1", "k2"])
            .withColumn("own", own).select("query_id", F.posexplode(others).alias("place", "x"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
                    F.col("x.d").alias("score")))


def op13_query(embeddings: DataFrame) -> DataFrame:
    index = build(embeddings)
    if index is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
                  .where(F.col("vec_id") % EVERY == 0))
