"""Image rows from the fixture tables, and the same pixels as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import image_rows

SIDE, FLAGS = 16, ("A", "N", "R")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_images(spark: SparkSession, sf_dir: str, planes: bool = False) -> DataFrame:
    """event = supplier, group = its nation, channel = return flag, pixel = (order, part) modulo 16,
    value = quantity; with ``planes`` also z = line number - 1 (7 planes)."""
    li = _table(spark, sf_dir, "lineitem")
    flag = F.array_position(F.array(*map(F.lit, FLAGS)), F.col("l_returnflag")).cast("int") - 1
    at = flag * 7 + F.col("l_linenumber") - 1 if planes else flag
    i = (at * SIDE + (F.col("l_orderkey") % SIDE).cast("int")) * SIDE + (F.col("l_partkey") % SIDE).cast("int")
    sparse = li.select(F.col("l_suppkey").alias("event"), i.alias("i"), "l_quantity").groupBy("event", "i").agg(F.sum("l_quantity").alias("v"))
    out = image_rows(sparse, (3, 7, SIDE, SIDE) if planes else (3, SIDE, SIDE))
    s = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("event"), F.col("s_nationkey").alias("group"))
    return out.join(s, "event")


def embedding_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One channel of 8 x 8: an embedding; group = its label."""
    e = _table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("event"), F.col("label").alias("group"), F.array(F.lit(1), F.lit(8), F.lit(8)).alias("shape"), F.col("embedding").cast("array<double>").alias("pixels"))


#: px(event, grp, channel, r, c, v): the pixels of line_images.
PX = f"""ev AS (SELECT DISTINCT l_suppkey AS event, s_nationkey AS grp FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
sums AS (SELECT l_suppkey AS event, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS channel,
  l_orderkey % {SIDE} AS r, l_partkey % {SIDE} AS c, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
px AS (SELECT event, grp, channel, r, c, coalesce(v, 0.0) AS v FROM ev CROSS JOIN range(3) a(channel) CROSS JOIN range({SIDE}) b(r)
  CROSS JOIN range({SIDE}) d(c) LEFT JOIN sums USING (event, channel, r, c))"""
#: pz: the same with planes.
PZ = f"""ev AS (SELECT DISTINCT l_suppkey AS event, s_nationkey AS grp FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
sums AS (SELECT l_suppkey AS event, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS channel, l_linenumber - 1 AS z,
  l_orderkey % {SIDE} AS r, l_partkey % {SIDE} AS c, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
pz AS (SELECT event, grp, channel, z, r, c, coalesce(v, 0.0) AS v FROM ev CROSS JOIN range(3) a(channel) CROSS JOIN range(7) f(z)
  CROSS JOIN range({SIDE}) b(r) CROSS JOIN range({SIDE}) d(c) LEFT JOIN sums USING (event, channel, z, r, c))"""
#: The circle of 16 x 16.
IN_CIRCLE = "((c - 8) * (c - 8) + (r - 8) * (r - 8) <= 25)"
#: Joins px a with its neighbours b, mirrored at the borders, at offsets dy and dx.
NEAR = f"JOIN range(-1, 2) y(dy) ON true JOIN range(-1, 2) x(dx) ON true JOIN px b ON b.event = a.event AND b.channel = a.channel AND b.r = greatest(0, least({SIDE - 1}, a.r + dy)) AND b.c = greatest(0, least({SIDE - 1}, a.c + dx))"
