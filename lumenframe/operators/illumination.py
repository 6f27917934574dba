"""Illumination correction: the mean image of each key, smoothed, divides its events."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..kernels.filters import medfilt, median_square
from ..model import held


#: Values of the partial sums that a task holds at most, over all keys.
HELD = 32 << 20


def _sums(batches):
    """(key, shape, sum of pixels, images) of what a partition has, let go of when it grows large."""
    sums: dict[tuple, list] = {}
    held = 0

    def rows():
        return pd.DataFrame([(*k[:1], list(k[1]), s, n) for k, (s, n) in sums.items()], columns=["_key", "shape", "pixels", "n"])

    for pdf in batches:
        for key, shape, pixels in zip(pdf["_key"], pdf["shape"], pdf["pixels"]):
            at = (key, tuple(shape))
            if at in sums:
                sums[at][0] += np.asarray(pixels, float)
                sums[at][1] += 1
            else:
                sums[at] = [np.array(pixels, float), 1]
                held += len(pixels)
        if held > HELD:
            yield rows()
            sums.clear()
            held = 0
    if sums:
        yield rows()


def mean_images(images: DataFrame, key: str) -> DataFrame:
    """(key, shape, avg): sums of images in each partition first, then by pixel place, then one array a key."""
    d = images.where("pixels IS NOT NULL").select(F.col(key).alias("_key"), "shape", "pixels")
    d = d.mapInPandas(_sums, d.select("_key", "shape", "pixels", F.lit(0).cast("long").alias("n")).schema)
    d = d.select(F.col("_key").alias(key), "shape", "n", F.posexplode("pixels").alias("i", "v"))
    m = d.groupBy(key, "shape", "i").agg((F.sum("v") / F.sum("n")).alias("m"))
    g = m.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s.m).alias("avg"), F.min("shape").alias("shape"), F.count_distinct("shape").alias("_n"))
    return g.withColumn("avg", F.when(F.col("_n") > 1, F.raise_error(F.lit("images of one key differ in shape"))).otherwise(F.col("avg"))).drop("_n")


def finish(avg: np.ndarray, size: int, downscale: int = 1) -> np.ndarray:
    """A mean image (channels, rows, columns): block means, medians, no zeros, and back to full size."""
    c, h, w = avg.shape
    if downscale > 1:
        ph, pw = -h % downscale, -w % downscale
        a = np.pad(avg, ((0, 0), (0, ph), (0, pw)))
        avg = a.reshape(c, (h + ph) // downscale, downscale, (w + pw) // downscale, downscale).mean(axis=(2, 4))
    f = medfilt if size > 150 else median_square
    out = np.stack([f(x, size) for x in avg])
    out[out == 0] = 1
    if downscale > 1:
        rows = np.clip((np.arange(h) + 0.5) / downscale - 0.5, 0, out.shape[1] - 1)
        cols = np.clip((np.arange(w) + 0.5) / downscale - 0.5, 0, out.shape[2] - 1)
        r0, c0 = np.floor(rows).astype(int), np.floor(cols).astype(int)
        r1, c1 = np.minimum(r0 + 1, out.shape[1] - 1), np.minimum(c0 + 1, out.shape[2] - 1)
        fr, fc = (rows - r0)[None, :, None], (cols - c0)[None, None, :]
        top = out[:, r0][:, :, c0] * (1 - fc) + out[:, r0][:, :, c1] * fc
        low = out[:, r1][:, :, c0] * (1 - fc) + out[:, r1][:, :, c1] * fc
        out = top * (1 - fr) + low * fr
    return out


def smoothed(means: DataFrame, key: str, size: int = 50, downscale: int = 1) -> DataFrame:
    """The finished correction images, one row a key."""

    def run(batches):
        for pdf in batches:
            pdf["avg"] = [finish(np.asarray(a, float).reshape(tuple(s)), size, downscale).ravel() for a, s in zip(pdf["avg"], pdf["shape"])]
            yield pdf

    return means.select(key, "shape", "avg").mapInPandas(run, means.select(key, "shape", "avg").schema)


def divide(images: DataFrame, means: DataFrame, key: str) -> DataFrame:
    """Each pixel over its key's correction image; a key without one raises."""
    m = means.select(F.col(key).alias("_key"), F.col("avg").alias("_avg"))
    d = images.join(m, F.col(key) == F.col("_key"), "left")
    missing = F.raise_error(F.concat(F.lit("no correction image for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    checked = F.when(F.col("_avg").isNull(), missing.cast("array<double>")).otherwise(F.col("_avg"))
    return held(d, pixels=F.when(F.col("pixels").isNotNull(), F.zip_with("pixels", checked, lambda p, a: F.try_divide(p, a)))).select(*images.columns)


def correct(images: DataFrame, key: str, median_filter_size: int = 50, downscale: int = 1, output: str | None = None, precomputed: str | None = None) -> DataFrame:
    """Divide by the finished mean images, computed here or read from ``precomputed`` (parquet)."""
    spark = images.sparkSession
    if precomputed:
        means = spark.read.parquet(precomputed)
    else:
        means = smoothed(mean_images(images, key), key, median_filter_size, downscale)
        if output:
            means.write.mode("overwrite").parquet(f"{output}/correction_images")
            means = spark.read.parquet(f"{output}/correction_images")
    return divide(images, means, key)
