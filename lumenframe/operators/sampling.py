"""Exact-size samples, the same on every run of a seed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sample(df: DataFrame, k: int, key: str = "event", seed: int = 0) -> DataFrame:
    """``k`` rows without replacement (all if there are fewer): the first by a seeded hash of the key."""
    return df.withColumn("_h", F.xxhash64(F.lit(seed), key)).orderBy("_h", key).limit(k).drop("_h")


def sample_with_replacement(df: DataFrame, k: int, key: str = "event", seed: int = 0) -> DataFrame:
    """``k`` draws from all rows; ``_draw`` numbers them. ``k`` may exceed the number of rows.

    Only keys are ranked: by hash bucket, plus the rows of the buckets before, so no window holds all.
    """
    buckets = 256
    keys = df.select(key, F.pmod(F.xxhash64(F.lit(seed), key), F.lit(buckets)).alias("_b"))
    counts = {r["_b"]: r["n"] for r in keys.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, first = 0, []
    for b in range(buckets):
        first.append(n)
        n += counts.get(b, 0)
    if not n:
        return df.withColumn("_draw", F.lit(0)).limit(0)
    ranked = keys.withColumn("_i", F.get(F.array(*map(F.lit, first)), F.col("_b").cast("int")) + F.row_number().over(W.partitionBy("_b").orderBy(key)) - 1)
    draws = df.sparkSession.range(k).select(F.col("id").cast("int").alias("_draw"), F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(n)).alias("_i"))
    chosen = draws.join(ranked, "_i").select("_draw", F.col(key).alias("_key"))
    return df.join(chosen, F.col(key) == F.col("_key")).drop("_key")
