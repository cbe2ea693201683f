"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, spread: str, share: float, parts: int) -> dict:
    """Keys that hold at least ``share`` of the rows, by a sample (a fixed hundredth of the values of
    ``spread``, or all rows where that finds fewer than 1,000), with the number of salts that deals each
    out in pieces of about a ``parts``-th of the rows.  At most 1 / ``share`` keys reach the driver."""
    for every in (100, 1):
        sample = df.where(F.pmod(F.xxhash64(spread), F.lit(every)) == 0)
        counts = sample.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if total >= 1000:
            break
    rows = counts.where((F.col("n") >= share * total) & F.col(key).isNotNull()).collect()
    return {r[key]: max(1, min(parts, -(-r["n"] * parts // total))) for r in rows}


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str, salts: dict, how: str = "left") -> DataFrame:
    """``left`` join ``right`` on ``key`` by a shuffle in which the keys of ``salts`` go to as many tasks:
    a left row's salt follows from its ``spread`` column (the same when a task runs again), and the
    right rows of such a key are repeated for each salt.  ``how``: inner, left or left_semi / left_anti."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}: right rows are repeated")
    many = {k: n for k, n in salts.items() if n > 1}
    if not many:
        return left.join(right, key, how)
    n = F.lit(1)
    for value, count in many.items():
        n = F.when(F.col(key) == F.lit(value), F.lit(count)).otherwise(n)
    # left rows without a key match nothing: they are dealt out as well
    own = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(1 << 20))).otherwise(F.pmod(F.xxhash64(spread), n))
    dealt = left.withColumn("_salt", own.cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1)))
    return dealt.join(copies, [key, "_salt"], how).drop("_salt")


def bounded_rows(df: DataFrame, limit: int) -> int:
    """Row count capped at ``limit + 1`` (a bounded check, not a full count)."""
    return df.limit(limit + 1).count()


def broadcast_if_small(df: DataFrame, max_rows: int, known_rows: int | None = None) -> DataFrame:
    """Broadcast hint only when the side is proven to hold at most ``max_rows`` rows.

    ``known_rows`` is used when the size is known by construction (e.g. a generated
    dimension); otherwise a bounded count runs.  Above the bound the plain frame is
    returned and the join stays a shuffle join (AQE may still switch it at run time
    from measured sizes).
    """
    rows = known_rows if known_rows is not None else bounded_rows(df, max_rows)
    return F.broadcast(df) if rows <= max_rows else df
