"""Column functions over flat pixel arrays: statistics, masks and neighbourhoods, all in the JVM.

An event's arithmetic stays in its row, so none of these shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The statistics of an intensity view, in output order.
STATISTICS = ("mean", "max", "min", "sum", "mad", "skewness", "kurtosis", "std", "median", "lower_quartile", "upper_quartile")


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once, however often f reads it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def quantile(ordered: Column, q: float) -> Column:
    """Of a sorted array, interpolated linearly; null if it is empty."""

    def at(o):
        place = (F.size(o) - 1) * F.lit(q)
        low = F.floor(place).cast("int")
        a, b = F.get(o, low), F.get(o, F.ceil(place).cast("int"))
        return F.when(F.size(o) > 0, a + (b - a) * (place - low))

    return let(ordered, at)


def moment(a: Column, mean: Column, k: int) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + F.pow(x - mean, F.lit(float(k)))) / F.size(a)


def statistics(a: Column) -> Column:
    """Struct of STATISTICS of an array of doubles; all null if it is null or empty, skewness and
    kurtosis also where all values are equal."""
    base = F.transform(F.array(a), lambda v: F.when(F.size(v) > 0, F.struct(v.alias("v"), F.array_sort(v).alias("o"), (total(v) / F.size(v)).alias("m"))))
    base = F.transform(base, lambda s: F.struct(s.v.alias("v"), s.o.alias("o"), s.m.alias("m"), quantile(s.o, 0.5).alias("q"), moment(s.v, s.m, 2).alias("m2")))

    def every(s):
        varied = s.m2 > 0
        return F.struct(
            s.m.alias("mean"),
            F.array_max(s.v).alias("max"),
            F.array_min(s.v).alias("min"),
            total(s.v).alias("sum"),
            quantile(F.array_sort(F.transform(s.v, lambda x: F.abs(x - s.q))), 0.5).alias("mad"),
            F.when(varied, moment(s.v, s.m, 3) / F.pow(s.m2, F.lit(1.5))).alias("skewness"),
            F.when(varied, moment(s.v, s.m, 4) / (s.m2 * s.m2) - 3).alias("kurtosis"),
            F.sqrt(s.m2).alias("std"),
            s.q.alias("median"),
            quantile(s.o, 0.25).alias("lower_quartile"),
            quantile(s.o, 0.75).alias("upper_quartile"),
        )

    return F.get(F.transform(base, lambda s: F.when(s.v.isNotNull(), every(s))), F.lit(0))


def inside(a: Column, mask: Column) -> Column:
    pairs = F.filter(F.zip_with(a, mask, lambda x, m: F.struct(x.alias("x"), m.alias("m"))), lambda p: p.m)
    return F.transform(pairs, lambda p: p.x)


def per_pixel(h: Column, w: Column, f: Callable[[Column, Column, Column], Column]) -> Column:
    """An array of f(i, r, c) over a frame."""
    return F.transform(F.sequence(F.lit(0), h * w - 1), lambda i: f(i, F.floor(i / w).cast("int"), F.pmod(i, w).cast("int")))


def circle(h: Column, w: Column) -> Column:
    """The disk about (int(h/2), int(w/2)) of a third of the shorter side."""
    cy, cx, radius = F.floor(h / 2), F.floor(w / 2), F.floor(F.least(h, w) / 3)
    return per_pixel(h, w, lambda i, r, c: (c - cx) * (c - cx) + (r - cy) * (r - cy) <= radius * radius)


def normality(a: Column) -> Column:
    """The K-squared statistic of skewness and kurtosis; null for fewer than 8 or equal values."""
    return let(F.struct(F.size(a).cast("double").alias("n"), statistics(a).alias("s")), lambda x: _k2(x.n, x.s))


def _k2(n: Column, s: Column) -> Column:
    g, b2 = s["skewness"], s["kurtosis"] + 3
    y = g * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    z1 = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(F.log(w2) / 2)
    e = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - e) / F.sqrt(var)
    sb = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    big = 6 + 8 / sb * (2 / sb + F.sqrt(1 + 4 / (sb * sb)))
    z2 = (1 - 2 / (9 * big) - F.cbrt((1 - 2 / big) / (1 + x * F.sqrt(2 / (big - 4))))) / F.sqrt(2 / (9 * big))
    return F.when((n >= 8) & (s["std"] > 0), z1 * z1 + z2 * z2)
