"""Per-group, per-channel extremes and the rescaling by them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import inside, quantile
from ..model import channel, channels, frame, held


def extremes(images: DataFrame, group: str = "group", lower: float = 0.0, upper: float = 1.0) -> DataFrame:
    """(group, channel, lo, hi) of the masked pixels if there is a mask, else of all.

    For 0 and 1 each event gives its own extremes first, so two numbers an event and channel are
    shuffled; other quantiles need the distinct values and their counts.
    """
    if "mask" in images.columns:
        n = frame(F.col("shape"))
        each = F.transform(F.sequence(F.lit(0), F.element_at("shape", 1) - 1), lambda k: F.struct(k.alias("channel"), inside(channel(F.col("pixels"), F.col("shape"), k), F.slice("mask", k * n + 1, n)).alias("v")))
        d = images.where("pixels IS NOT NULL").select(group, F.explode(each).alias("_c")).select(group, "_c.channel", "_c.v")
    else:
        d = channels(images, group)
    if (lower, upper) == (0.0, 1.0):
        return d.groupBy(group, "channel").agg(F.min(F.array_min("v")).alias("lo"), F.max(F.array_max("v")).alias("hi"))
    # equal values are counted first, dealt by value, so that a hot group's pixels don't meet in one task
    counted = d.select(group, "channel", F.explode("v").alias("x")).groupBy(group, "channel", "x").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(group, "channel").agg(F.percentile("x", F.lit(lower), F.col("n")).alias("lo"), F.percentile("x", F.lit(upper), F.col("n")).alias("hi"))


def normalize(images: DataFrame, group: str = "group", lower: float = 0.0, upper: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """All pixels as (p - lo) / (hi - lo) of their group and channel, unclipped; and the extremes.

    An empty range gives null. The extremes join by group: Spark broadcasts them when they are small.
    """
    ext = extremes(images, group, lower, upper)
    # as many entries a group as channels
    by_group = ext.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct("channel", F.struct("lo", "hi")))).alias("_ext"))
    n = frame(F.col("shape"))
    each = F.transform(
        F.sequence(F.lit(0), F.element_at("shape", 1) - 1),
        lambda k: F.transform(channel(F.col("pixels"), F.col("shape"), k), lambda p: F.try_divide(p - F.try_element_at("_ext", k)["lo"], F.try_element_at("_ext", k)["hi"] - F.try_element_at("_ext", k)["lo"])),
    )
    out = held(images.join(by_group, group, "left"), pixels=F.when(F.col("pixels").isNotNull(), F.flatten(each))).drop("_ext")
    return out.select(*images.columns), ext


def channel_boundaries(ext: DataFrame, names: list[str], group: str = "group") -> DataFrame:
    """One row a group with {name}_min and {name}_max of each channel."""
    columns = [F.max(F.when(F.col("channel") == k, F.col(c))).alias(f"{name}_{suffix}") for k, name in enumerate(names) for c, suffix in (("lo", "min"), ("hi", "max"))]
    return ext.groupBy(group).agg(*columns)


__all__ = ["channel_boundaries", "extremes", "normalize", "quantile"]
