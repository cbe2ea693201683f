"""Quantiles of one numeric column.

``exact_quantiles`` returns the linearly interpolated quantile (the definition of
SQL ``percentile_cont`` / Spark ``percentile``) without ever holding the column, or
its distinct values, in one task.  It narrows each wanted rank by passes over the
data, each pass a small distributed aggregation:

1. one pass: ``count``, ``min``, ``max`` and a GK sketch (``percentile_approx``)
   that brackets every wanted rank in a narrow value interval;
2. per pass, one hash aggregation over (region, bin): overlapping intervals are merged,
   every row falls in exactly one region (a gap between intervals, or an interval with
   one of ``buckets`` equal-width bins), so the rows below an interval are the sum of
   the regions before it.  The bin that holds the rank becomes the next interval; it is
   resolved when its min equals its max, or collected (sorted, at most
   ``collect_limit`` values) when it is small.

The bracket of step 1 is verified by the counts of step 2; when it does not hold the
rank (sketch guarantees violated) the interval falls back to [min, max].  Every pass ends or
strictly narrows each interval (its least and greatest value fall into different bins), so
the passes end on any data.  Only
histograms of at most ``intervals x buckets`` rows reach the driver.

``approx_quantiles`` is the reference's Greenwald-Khanna ``approxQuantile``; ``kll_quantiles`` uses
a KLL sketch, which also merges over time: a stored sketch per day gives the quantiles of any span.
``rank_errors`` counts how far the true ranks of given answers lie from the wanted ones.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# small on purpose: each task sends its sketch to the driver when it is observed (a few KB)
SKETCH_ACCURACY = 200


def _sketch_probs(probs) -> list[float]:
    delta = 3.0 / SKETCH_ACCURACY
    return sorted({min(1.0, max(0.0, float(p) + s * delta)) for p in probs for s in (-1, 1)})


def head_aggregates(value, probs) -> list:
    """count / min / max / GK sketch of ``value`` (NULL = not counted) as aggregate columns.

    They can ride along with another job, e.g. as observed metrics of a table write, to
    save ``exact_quantiles`` its first pass (metrics of a write's result stage count each
    partition once, so the count is exact).
    """
    return [F.count(value).alias("n"), F.min(value).alias("mn"), F.max(value).alias("mx"),
            F.percentile_approx(value, _sketch_probs(probs), SKETCH_ACCURACY).alias("q")]


def _values(df: DataFrame, column: str) -> DataFrame:
    x = F.col(column).cast("double")
    return df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))


def _bucket_expr(a: float, b: float, buckets: int):
    """Bin of a value known to lie in [a, b]; monotone in the value."""
    x = F.col("x")
    if b <= a:
        return F.lit(0)
    if not math.isfinite(b - a):
        # an infinite end: keep the order with three bins (low end, finite values, high end)
        return (F.when(x == F.lit(b), F.lit(buckets - 1)).when(x == F.lit(a), F.lit(0))
                .otherwise(F.lit(buckets // 2)))
    pos = F.floor((x - F.lit(a)) / F.lit(b - a) * F.lit(float(buckets))).cast("int")
    return F.least(pos, F.lit(buckets - 1))


def _merge(intervals):
    """Sorted, pairwise disjoint cover of the given closed intervals."""
    out: list[list[float]] = []
    for a, b in sorted(set(intervals)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(iv) for iv in out]


def _histograms(values: DataFrame, intervals: list[tuple[float, float]], buckets: int):
    """One hash aggregation: every row gets ONE region id -- gap ``2i`` below interval i,
    interval ``2i+1`` (with its bin), or the gap ``2n`` above the last -- so the rows below an
    interval are the sum of the regions before it.  Returns {i: (below, [(bin, cnt, lo, hi)])}."""
    x = F.col("x")
    region = bucket = None
    for i, (a, b) in enumerate(intervals):
        for cond, reg, bkt in ((x < F.lit(a), 2 * i, None), (x <= F.lit(b), 2 * i + 1, _bucket_expr(a, b, buckets))):
            region = F.when(cond, F.lit(reg)) if region is None else region.when(cond, F.lit(reg))
            bkt_col = bkt if bkt is not None else F.lit(None).cast("int")
            bucket = F.when(cond, bkt_col) if bucket is None else bucket.when(cond, bkt_col)
    region = region.otherwise(F.lit(2 * len(intervals)))
    bucket = bucket.otherwise(F.lit(None).cast("int"))
    rows = (values.groupBy(region.alias("r"), bucket.alias("bkt"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.min("x").alias("lo"), F.max("x").alias("hi"))
            .collect())
    per_region: dict[int, int] = {}
    bins: dict[int, list] = {i: [] for i in range(len(intervals))}
    for r in rows:
        per_region[r["r"]] = per_region.get(r["r"], 0) + r["cnt"]
        if r["r"] % 2 == 1:
            bins[r["r"] // 2].append((r["bkt"], r["cnt"], r["lo"], r["hi"]))
    out = {}
    for i in range(len(intervals)):
        below = sum(c for reg, c in per_region.items() if reg < 2 * i + 1)
        out[i] = (below, sorted(bins[i]))
    return out


def exact_quantiles(df: DataFrame, column: str, probs, buckets: int = 4096,
                    collect_limit: int = 4096,
                    stats: dict | None = None, head: dict | None = None) -> list[float | None]:
    """``stats`` (optional) receives the number of histogram passes and collected values;
    ``head`` (optional) is ``head_aggregates`` already computed over the same values."""
    probs = [float(p) for p in probs]
    stats = stats if stats is not None else {}
    stats.update(passes=0, collected=0, head_pass=head is None)
    values = _values(df, column)
    delta = 3.0 / SKETCH_ACCURACY
    sketch_probs = _sketch_probs(probs)
    if head is None:
        head = values.agg(*head_aggregates(F.col("x"), probs)).first().asDict()
    n, mn, mx = head["n"], head["mn"], head["mx"]
    if not n:
        return [None for _ in probs]
    approx = dict(zip(sketch_probs, head["q"]))

    # wanted ranks (0-based) and the interval each starts from
    state: dict[int, tuple[float, float]] = {}
    for p in probs:
        h = p * (n - 1)
        lo = math.floor(h)
        ranks = [lo] + ([lo + 1] if h > lo and lo + 1 <= n - 1 else [])
        a = approx[min(1.0, max(0.0, p - delta))]
        b = approx[min(1.0, max(0.0, p + delta))]
        for r in ranks:
            state.setdefault(r, (a, b))
    found: dict[int, float] = {}
    passes = 0
    while state:
        passes += 1
        stats["passes"] = passes
        intervals = _merge(state.values())
        hist = _histograms(values, intervals, buckets)
        to_collect: dict[tuple[float, float], tuple[int, list[tuple[int, int]]]] = {}
        for r, iv in list(state.items()):
            k = next(j for j, (a, b) in enumerate(intervals) if a <= iv[0] and iv[1] <= b)
            below, inside = hist[k]
            total = sum(c for _, c, _, _ in inside)
            if not (below <= r < below + total):
                state[r] = (mn, mx)          # bracket missed: restart from the full range
                continue
            cum = below
            for _, c, lo, hi in inside:
                if r < cum + c:
                    break
                cum += c
            if lo == hi:
                found[r] = lo
                del state[r]
            elif c <= collect_limit:
                to_collect.setdefault((lo, hi), (c, []))[1].append((r, cum))
                del state[r]
            else:
                state[r] = (lo, hi)
        for (lo, hi), (size, wanted) in to_collect.items():
            # the bin's values are exactly those in [lo, hi] (monotone binning): size <= limit
            xs = [row["x"] for row in values.where(F.col("x").between(lo, hi)).orderBy("x").collect()]
            if len(xs) != size:
                raise RuntimeError(f"bin [{lo}, {hi}] changed between passes ({size} -> {len(xs)} rows)")
            stats["collected"] += len(xs)
            for r, cum in wanted:
                found[r] = xs[r - cum]
    result = []
    for p in probs:
        h = p * (n - 1)
        lo = math.floor(h)
        frac = h - lo
        v_lo = found[lo]
        if frac > 0 and lo + 1 <= n - 1:
            v_hi = found[lo + 1]
            result.append(v_lo + (v_hi - v_lo) * frac)
        else:
            result.append(v_lo)
    return result


def approx_quantiles(df: DataFrame, column: str, probs, relative_error: float = 0.01) -> list[float | None]:
    out = df.where(F.col(column).isNotNull()).approxQuantile(column, list(probs), relative_error)
    return list(out) if out else [None for _ in probs]


KLL_K = 400                  # normalised rank error about 0.7 %; a sketch is a few KB


def kll_quantiles(df: DataFrame, column: str, probs, k: int = KLL_K) -> list[float | None]:
    """Quantiles from one KLL sketch: each task sketches its rows, the sketches are merged."""
    x = F.col(column).cast("double")
    sketch = df.where(x.isNotNull() & ~F.isnan(x)).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, F.lit(k)).alias("s"))
    row = sketch.select("n", *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(float(p)))).alias(f"q{i}")
                               for i, p in enumerate(probs)]).first()
    return [row[f"q{i}"] if row["n"] else None for i in range(len(probs))]


def rank_errors(df: DataFrame, column: str, answers: dict[float, float]) -> DataFrame:
    """(n, and per wanted probability the distance of the answer's true rank from it, as a share of n):
    one counting pass.  The ranks of an answer that occurs are those of all its equals, so the distance
    is 0 where the wanted one is among them."""
    x = F.col(column).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x))
    counts = [F.count(F.lit(1)).alias("n")]
    for i, (_, value) in enumerate(answers.items()):
        counts += [F.count_if(x < F.lit(value)).alias(f"below{i}"), F.count_if(x <= F.lit(value)).alias(f"upto{i}")]
    out = [F.col("n")]
    for i, p in enumerate(answers):
        least, most = F.col(f"below{i}") / F.col("n"), F.col(f"upto{i}") / F.col("n")
        out.append(F.greatest(least - F.lit(p), F.lit(p) - most, F.lit(0.0)).alias(f"error{i}"))
    return rows.agg(*counts).select(*out)


IQR_PROBS = (0.25, 0.75)


def positive_values(c):
    """The values the IQR bounds are computed from (NULL otherwise)."""
    return F.when(c.isNotNull() & ~F.isnan(c) & (c > 0), c.cast("double"))


def iqr_bounds(df: DataFrame, column: str = "total_amount", factor: float = 3.0,
               method: str = "exact", relative_error: float = 0.01, head: dict | None = None) -> dict:
    """Q1/Q3 of the positive values and the bounds ``Q1 - k*IQR``, ``Q3 + k*IQR``.

    ``head``: ``head_aggregates(positive_values(col), IQR_PROBS)`` computed elsewhere.
    """
    positive = df.where(F.col(column).isNotNull() & (F.col(column) > 0))
    if method == "exact":
        q1, q3 = exact_quantiles(positive, column, list(IQR_PROBS), head=head)
    elif method == "approx":
        q1, q3 = approx_quantiles(positive, column, [0.25, 0.75], relative_error)
    elif method == "kll":
        q1, q3 = kll_quantiles(positive, column, [0.25, 0.75])
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    if q1 is None or q3 is None:
        return {"q1": None, "q3": None, "iqr": None, "lower": None, "upper": None}
    iqr = q3 - q1
    return {"q1": q1, "q3": q3, "iqr": iqr, "lower": q1 - factor * iqr, "upper": q3 + factor * iqr}
