"""Quality filters. A rejected event keeps its row and loses its pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import normality, statistics, total
from ..model import channel, held
from ..plugins import resolve

#: K-squared above which a channel is not normal at 5 %, and the 5 % point of the standard normal.
K2_LIMIT, Z05 = 5.991464547107979, -1.6448536269514722


def std(v: Column, threshold: float) -> Column:
    return F.coalesce(statistics(v)["std"] > threshold, F.lit(False))


def value_range(v: Column, threshold: float) -> Column:
    return F.coalesce(F.array_max(v) - F.array_min(v) > threshold, F.lit(False))


def normaltest(v: Column) -> Column:
    return F.coalesce(normality(v) > K2_LIMIT, F.lit(False))


FILTERS = {"std": std, "value_range": value_range, "normaltest": normaltest}


def mask_filters(images: DataFrame, filters: list[dict], main_channel: int, n_channels: int) -> DataFrame:
    """Add ``mask_filter``, a flag a channel; drop the pixels where the main channel fails.

    ``filters``: [{"method": name, "channel_indices": [...], "settings": {...}}].
    """
    flags = [F.lit(True) for _ in range(n_channels)]
    for f in filters or []:
        test, wanted = resolve(FILTERS, f["method"], "mask filter"), f.get("channel_indices")
        for k in range(n_channels) if wanted is None else wanted:
            flags[k] = flags[k] & test(channel(F.col("pixels"), F.col("shape"), k), **(f.get("settings") or {}))
    out = held(images, mask_filter=F.when(F.col("pixels").isNotNull(), F.array(*flags)))
    return out.withColumn("pixels", F.when(F.get("mask_filter", F.lit(main_channel)), F.col("pixels")))


def threshold(images: DataFrame) -> DataFrame:
    """Keep events whose first channel's sum exceeds the 5 % point of a normal fit over all events.

    The fit is one row, so its broadcast has a fixed size.
    """
    d = images.withColumn("filter_sum", F.when(F.col("pixels").isNotNull(), total(channel(F.col("pixels"), F.col("shape"), 0))))
    fit = d.agg(F.avg("filter_sum").alias("_mu"), F.stddev_pop("filter_sum").alias("_sd"))
    d = d.crossJoin(F.broadcast(fit)).withColumn("_keep", F.col("filter_sum") > F.col("_mu") + F.col("_sd") * Z05)
    for c in {"pixels", "mask"} & set(d.columns):
        d = d.withColumn(c, F.when(F.col("_keep"), F.col(c)))
    return d.drop("_mu", "_sd", "_keep")
