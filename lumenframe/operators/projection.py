"""Z-projection of stacks by maximum, mean or median of each pixel's planes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..model import frame, held
from ..plugins import resolve

#: Functions of (array, axis).
OPS = {"max": np.max, "mean": np.mean, "median": np.median}


def _maximum(pixels: Column, shape: Column) -> Column:
    """The largest of each pixel's planes, in the JVM; by places, as a slice would read the whole stack each time."""

    def each(s):
        upto = lambda n: F.sequence(F.lit(0), n - 1)
        starts = lambda k: F.transform(upto(s.planes), lambda z: (k * s.planes + z) * s.n)
        largest = lambda at: F.transform(upto(s.n), lambda i: F.array_max(F.transform(at, lambda o: F.get(pixels, o + i))))
        return F.flatten(F.transform(upto(s.channels), lambda k: let(starts(k), largest)))

    return let(F.struct(F.get(shape, F.lit(0)).alias("channels"), F.get(shape, F.lit(1)).alias("planes"), frame(shape).alias("n")), each)


def project(images: DataFrame, op: str = "max") -> DataFrame:
    """(channels, planes, rows, columns) to (channels, rows, columns), in the row.

    ``op`` is one of OPS, or ``module:function`` of (array, axis). The maximum needs no Python, to which whole
    stacks would go in batches.
    """
    each, s = resolve(OPS, op, "projection"), F.col("shape")
    flat = F.array(F.get(s, F.lit(0)), F.get(s, F.lit(2)), F.get(s, F.lit(3)))
    if op == "max":
        return held(images, pixels=F.when(F.col("pixels").isNotNull(), _maximum(F.col("pixels"), s)), shape=flat)

    @F.pandas_udf("array<double>")
    def run(pixels: pd.Series, shape: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else each(np.asarray(p, float).reshape(tuple(k)), axis=1).ravel() for p, k in zip(pixels, shape)])

    d = images.withColumn("_p", run("pixels", "shape"))
    return held(d, pixels=F.col("_p"), shape=flat).drop("_p")
