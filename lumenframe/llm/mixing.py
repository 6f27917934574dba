"""Mixing sources to target weights: token sums by source, repetition rates, seeded copies.

Edge cases: a null text has size 0; a null source is a source of its own, last in order; a row without
doc_id draws by its text; repeated rows, and rows that repeat a doc_id, draw alike; an empty table gives no
rows; a source of size 0 has target 0 and takes nothing. Columns other than doc_id, text and source pass
through ``emit`` untouched, whatever their names; in ``mix``, those named as an added one give way to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, carry, sized, stage, table, unit_hash

SEED = "mix-1"


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Add ``target`` to (source, source_size): shares of the total by weight, no more than ``cap`` sizes.

    Capping the sources in order of cap/weight raises the common level (what is left / weights left)
    until the first source that stays below its cap, and lowers it beyond; so the level is the largest
    of these quotients. One row a source goes through the unpartitioned windows, never documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    s = sources.withColumn("_w", weight.cast("long")).withColumn("_cap", F.col("source_size") * cap)
    order = [F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()]
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy(*order).rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    s = s.withColumn("_level", left.cast("double") / F.sum("_w").over(after).cast("double"))
    s = s.withColumn("_level", F.max("_level").over(everything))
    return s.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w"))).drop("_w", "_cap", "_level")


ADDED = ("_size", "_source_size", "_target", "_copies")


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: str = SEED) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_copies``.

    Sources are summed with partial aggregation; their table is broadcast only after its size is
    measured, and beyond the bound joined on (source, salt), so that a hot source spreads out.
    """
    sums = docs.select("source", word_count(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stage(targets(stage(sums, "mix-sums"), weights, cap), "mix-targets").withColumnsRenamed({"source": "_source", "source_size": "_source_size", "target": "_target"})
    d = carry(docs, "doc_id", "text", "source").withColumn("_size", word_count(F.col("text")))
    if (small := sized(plan, "_source")) is not None:
        d = d.join(small, d["source"].eqNullSafe(small["_source"]))
    else:
        salts = 64
        d = d.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "_size"), F.lit(salts)).cast("int"))
        plan = plan.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        d = d.join(plan.hint("shuffle_hash"), d["source"].eqNullSafe(plan["_source"]) & (d["_salt"] == plan["_salt_of"])).drop("_salt", "_salt_of")
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    draw = F.when(F.col("doc_id").isNull(), unit_hash(seed, "doc_id", "text")).otherwise(unit_hash(seed, "doc_id"))
    copies = F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")
    return d.withColumn("_copies", copies).select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in ADDED), *ADDED)


def emit(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it."""
    mixed = mix(carry(docs, "doc_id", "text", "source").withColumnRenamed("_row", "row"), weights, cap, seed).where(F.col("_copies") > 0)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).select("row.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))


#: Weights of the mix by name of the table that it reads, for op1 and the pipeline.
def mix_sql(documents: str) -> str:
    """DuckDB SQL: rows (doc_id, source, size, source_size, target, copies) of a mix of ``documents``."""
    return f"""
    SELECT d.*, s.source_size, s.target,
      CASE WHEN source_size > 0 THEN floor(target / source_size) + CASE WHEN
        CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), ':' || coalesce(text, ''))), 1, 13) AS BIGINT) / 4503599627370496.0
        < target / source_size - floor(target / source_size) THEN 1 ELSE 0 END ELSE 0 END::BIGINT AS copies
    FROM (SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM {documents}) d
    JOIN (
      SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * w) AS target FROM (
        SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
          / CAST(sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
        FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
              FROM (SELECT source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM {documents}) GROUP BY source))) s
    ON d.source IS NOT DISTINCT FROM s.source"""


OP1_SQL = f"SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken FROM ({mix_sql('documents')})"
