"""The data model: one row an event, with flattened pixels and their shape.

``pixels`` is row-major over ``shape`` = (channels, [planes,] rows, columns). A rejected event keeps its
row and loses ``pixels`` and ``mask``; everything computed from them is then null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.arrays import let

BBOX = "struct<minr:int,minc:int,maxr:int,maxc:int>"


def rows_of(shape: Column) -> Column:
    return F.element_at(shape, -2)


def columns_of(shape: Column) -> Column:
    return F.element_at(shape, -1)


def frame(shape: Column) -> Column:
    """Pixels of one plane."""
    return rows_of(shape) * columns_of(shape)


def channel(pixels: Column, shape: Column, k: int | Column) -> Column:
    return F.slice(pixels, F.lit(k) * frame(shape) + 1 if isinstance(k, int) else k * frame(shape) + 1, frame(shape))


def channels(images: DataFrame, *more: str) -> DataFrame:
    """One row an event and channel: event, ``more``, channel, v, h, w. No shuffle."""
    each = F.transform(F.sequence(F.lit(0), F.element_at("shape", 1) - 1), lambda k: F.struct(k.alias("channel"), channel(F.col("pixels"), F.col("shape"), k).alias("v")))
    out = images.where("pixels IS NOT NULL").select("event", *more, rows_of(F.col("shape")).alias("h"), columns_of(F.col("shape")).alias("w"), F.explode(each).alias("_c"))
    return out.select("event", *more, "_c.channel", "_c.v", "h", "w")


def pixel_rows(images: DataFrame, *more: str) -> DataFrame:
    """One row a pixel: event, ``more``, channel, r, c, v."""
    each = channels(images, *more).select("event", *more, "channel", "w", F.posexplode("v").alias("i", "v"))
    return each.select("event", *more, "channel", F.expr("i div w").cast("int").alias("r"), F.expr("i % w").cast("int").alias("c"), "v")


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` computed once a row.

    Through a generator, so that the optimizer doesn't copy a costly array expression into the
    functions that later read it element by element.
    """
    one = F.struct(*(x.alias(n) for n, x in columns.items()))
    out = df.select(*df.columns, F.explode(F.array(one)).alias("_held"))
    return out.select(*(F.col(f"_held.{c}") if c in columns else F.col(c) for c in df.columns), *(F.col(f"_held.{n}") for n in columns if n not in df.columns))


def image_rows(sparse: DataFrame, shape: tuple[int, ...]) -> DataFrame:
    """Image rows (event, shape, pixels) from (event, i, v), i the place in the flat array.

    Values of one place add up; absent places are 0, a place beyond the image raises. A group gathers as many
    rows as an image has pixels. Images are filled in the JVM, a row at a time: a batch of large frames would
    be many times the memory of the values that fill them.
    """
    size = math.prod(shape)

    def dense(s):
        runs = F.transform(s, lambda x, k: F.concat(F.array_repeat(F.lit(0.0), x.i - F.coalesce(F.get(s, k - 1).i, F.lit(-1)) - 1), F.array(F.coalesce(x.v, F.lit(0.0)))))
        first, last = F.get(s, F.lit(0)).i, F.element_at(s, -1).i
        beyond = F.raise_error(F.concat(F.lit("a pixel beyond the image of event "), F.col("event").cast("string")))
        return F.when((first >= 0) & (last < size), F.concat(F.flatten(runs), F.array_repeat(F.lit(0.0), size - 1 - last))).otherwise(beyond.cast("array<double>"))

    each = sparse.groupBy("event", F.col("i").cast("int").alias("i")).agg(F.sum(F.col("v").cast("double")).alias("v"))
    g = each.groupBy("event").agg(F.collect_list(F.struct("i", "v")).alias("s"))
    return held(g, shape=F.array(*map(F.lit, shape)), pixels=let(F.sort_array("s"), dense)).drop("s")
