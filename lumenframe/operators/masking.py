"""Masks: one flat boolean array an event, with region counts, backgrounds and a bounding box."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import circle
from ..kernels import filters as K
from ..kernels import labels as L
from ..model import columns_of, held, rows_of
from ..plugins import resolve


def _li(a: np.ndarray, smooth: float) -> tuple[np.ndarray, int]:
    x = K.gaussian(K.sobel(K.gaussian(a, smooth)), 2 * smooth)
    m = L.drop_small(L.fill_small(x > L.li(x), a.size / 4), 20)
    return m, L.label(m)[1]


def _otsu(a: np.ndarray) -> tuple[np.ndarray, int]:
    if a.max() > 512:
        edges = np.histogram_bin_edges(a, 512)
        a = np.digitize(a, edges).astype(float)
    x = K.sobel(K.gaussian(a - K.rank_median(np.floor(a), 5), 0.5))
    top, span = a.max(), x.max() - x.min()
    # to whole numbers by cutting off, as a conversion does
    x = ((x - x.min()) / span * top).astype(int) if span > 0 else np.zeros(x.shape, int)
    x = K.rank_median(x, 5).astype(int)
    m = L.drop_small(L.fill_small(x > L.otsu(x), a.size / 4), 20)
    return m, L.label(m)[1]


def _sobel(a: np.ndarray) -> tuple[np.ndarray, int]:
    x = K.closing(K.sobel(a), 2)
    return L.post_process(x > np.quantile(x, 0.9))


def _spot(a: np.ndarray, spotsize: int = 5) -> tuple[np.ndarray, int]:
    x = K.white_tophat(a, spotsize)
    m = x > np.quantile(x, 0.99)
    return m, L.label(m)[1]


def _watershed(a: np.ndarray, noisy: bool = False) -> tuple[np.ndarray, int]:
    a = K.nl_means(a) if noisy else a
    x = K.closing(K.sobel(a), 2)
    t = L.otsu(x)
    markers = np.where(x > 1.5 * t, 2, np.where(x < 0.5 * t, 1, 0))
    if not markers.any():
        return np.zeros(a.shape, bool), 0
    # the gradient sets the markers, the image itself is flooded
    lab = L.watershed(a, markers, 1.0)
    return L.post_process(lab == lab.max())


KERNELS: dict[str, Callable] = {"li": _li, "threshold": _li, "otsu": _otsu, "sobel": _sobel, "spot": _spot, "watershed": _watershed}
#: Kernels that run on every channel, whether it passed its mask filter or not.
UNFILTERED = ("sobel", "watershed")


def _by_channel(method: str, settings: dict) -> Callable[[int], dict]:
    """The settings of each channel: ``smooth`` is a number for all or a list, ``noisy_channels`` a list."""
    if method in ("li", "threshold"):
        smooth = settings.pop("smooth", 0.75)
        return lambda k: {**settings, "smooth": float(smooth[k] if isinstance(smooth, (list, tuple)) else smooth)}
    if method == "watershed":
        noisy = set(settings.pop("noisy_channels", None) or ())
        return lambda k: {**settings, "noisy": k in noisy}
    return lambda k: settings


def make(images: DataFrame, method: str, border: bool = True, main_channel: int = 0, **settings) -> DataFrame:
    """Add ``mask`` and ``regions``. A channel that failed its mask filter is empty with 0 regions.

    The circle is built in the JVM; the others are NumPy kernels on batches of events, and so is a method
    ``module:function``, which gives (mask, number of regions) of a channel.
    """
    if method == "circle":
        h, w = rows_of(F.col("shape")), columns_of(F.col("shape"))
        n = F.element_at("shape", 1)
        one = circle(h, w)
        return held(images, mask=F.when(F.col("pixels").isNotNull(), F.flatten(F.array_repeat(one, n))), regions=F.when(F.col("pixels").isNotNull(), F.array_repeat(F.lit(1), n)))
    kernel, of = resolve(KERNELS, method, "mask"), _by_channel(method, settings)
    flagged = "mask_filter" in images.columns and method not in UNFILTERED
    args = [F.col("pixels"), F.col("shape"), F.col("mask_filter") if flagged else F.lit(None).cast("array<boolean>")]

    @F.pandas_udf("struct<mask:array<boolean>,regions:array<int>>")
    def run(pixels: pd.Series, shape: pd.Series, flags: pd.Series) -> pd.DataFrame:
        out = []
        for p, s, f in zip(pixels, shape, flags):
            if p is None:
                out.append((None, None))
                continue
            masks, counts = [], []
            for k, a in enumerate(np.asarray(p, float).reshape(tuple(s))):
                if f is not None and not f[k]:
                    m, n = np.zeros(a.shape, bool), 0
                else:
                    m, n = kernel(a, **of(k))
                    if border:
                        m, n = L.border_regions(m)
                masks.append(m)
                counts.append(n)
            out.append((np.stack(masks).ravel(), counts))
        return pd.DataFrame(out, columns=["mask", "regions"])

    out = images.withColumn("_m", run(*args))
    out = held(out, mask=F.col("_m.mask"), regions=F.col("_m.regions")).drop("_m")
    lost = F.get("regions", F.lit(main_channel)) == 0
    return out.withColumns({c: F.when(~lost, F.col(c)) for c in ("pixels", "mask")})


_BOX = T.StructType([T.StructField(c, T.IntegerType()) for c in ("minr", "minc", "maxr", "maxc")])
_APPLIED = T.StructType([T.StructField("combined_mask", T.ArrayType(T.BooleanType())), *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("background", "combined_background")), T.StructField("bbox", _BOX)])


@F.pandas_udf(_APPLIED)
def _applied(pixels: pd.Series, masks: pd.Series, shape: pd.Series, combined: pd.Series) -> pd.DataFrame:
    out = []
    for p, m, s, wanted in zip(pixels, masks, shape, combined):
        if p is None or m is None:
            out.append((None, None, None, None))
            continue
        x, own = np.asarray(p, float).reshape(tuple(s)), np.asarray(m, bool).reshape(tuple(s))
        joint = (own if wanted is None else own[list(wanted)]).any(0)
        mean = lambda v, bare: float(v.mean()) if v.size else bare
        r, c = np.nonzero(own.any(0))
        box = (int(r.min()), int(c.min()), int(r.max()) + 1, int(c.max()) + 1) if len(r) else (s[1], s[2], 0, 0)
        out.append((joint.ravel(), [mean(a[~b], 0.0) for a, b in zip(x, own)], [mean(a[~joint], None) for a in x], dict(zip(("minr", "minc", "maxr", "maxc"), box))))
    return pd.DataFrame(out, columns=["combined_mask", "background", "combined_background", "bbox"])


def apply(images: DataFrame, n_channels: int, combined: list[int] | None = None) -> DataFrame:
    """Add combined_mask (of the channels ``combined``), background, combined_background and bbox.

    A background is the mean of a channel outside the mask: 0 if nothing is outside its own, null
    if nothing is outside the combined one. A box without pixels is (rows, columns, 0, 0).
    """
    wanted = F.lit(None).cast("array<int>") if combined is None else F.array(*map(F.lit, combined))
    out = images.withColumn("_a", _applied("pixels", "mask", "shape", wanted))
    return held(out, **{c: F.col(f"_a.{c}") for c in ("combined_mask", "background", "combined_background", "bbox")}).drop("_a")
