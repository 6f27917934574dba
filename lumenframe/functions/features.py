"""Feature groups as arrays or structs a row, and their column names.

Names: ``meta_`` for loader columns, ``meta_{prefix}_`` for boxes and region counts, ``feat_{prefix}_``
for the rest; by where a column comes from, not by how its name starts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..kernels.intensity import EDGE, edge, statistics, views
from ..kernels.regions import SHAPE, TEXTURE, glcm_row, shape_row
from ..model import held
from .arrays import STATISTICS

#: Prefixes of the eight views, in output order.
VIEWS = ("", "bgcorr_", "edge_", "bgcorr_edge_", "combined_", "combined_bgcorr_", "combined_edge_", "combined_bgcorr_edge_")
_ROWS = T.ArrayType(T.ArrayType(T.DoubleType()))
TYPES = ("regions", "bbox", "shape", "raw", "intensity", "texture")


def _rows(*rows: np.ndarray) -> list:
    """Rows as they are, NaN being null to Arrow: lists of Python's numbers would be three times as large."""
    return [np.asarray(r, float) for r in rows]


@F.pandas_udf(_ROWS)
def raw_features(pixels: pd.Series, shape: pd.Series) -> pd.Series:
    """STATISTICS of each whole channel."""
    return pd.Series([None if p is None else _rows(*(statistics(a) for a in np.asarray(p, float).reshape(s[0], -1))) for p, s in zip(pixels, shape)])


def intensity_features(radius: int = EDGE):
    """A function of (pixels, mask, combined_mask, background, combined_background, shape): the eight
    VIEWS of STATISTICS of each channel, null for rejected rows; ``radius`` is the edges'."""

    @F.pandas_udf(T.ArrayType(_ROWS))
    def run(pixels: pd.Series, masks: pd.Series, combined: pd.Series, background: pd.Series, joint_background: pd.Series, shape: pd.Series) -> pd.Series:
        out = []
        for p, m, c, b, jb, s in zip(pixels, masks, combined, background, joint_background, shape):
            if p is None or m is None:
                out.append(None)
                continue
            joint = np.asarray(c, bool).reshape(s[1], s[2])
            joint_edge = edge(joint, radius)
            channels = zip(np.asarray(p, float).reshape(tuple(s)), np.asarray(m, bool).reshape(tuple(s)), b, jb)
            out.append([_rows(*views(x, own, joint, joint_edge, y, z, radius)) for x, own, y, z in channels])
        return pd.Series(out)

    return run


@F.pandas_udf(_ROWS)
def shape_features(masks: pd.Series, combined: pd.Series, shape: pd.Series) -> pd.Series:
    """Combined first, then each channel; null for rejected rows."""
    out = []
    for m, c, s in zip(masks, combined, shape):
        if m is None:
            out.append(None)
            continue
        every = [np.asarray(c, bool).reshape(s[1], s[2]), *np.asarray(m, bool).reshape(tuple(s))]
        out.append(_rows(*map(shape_row, every)))
    return pd.Series(out)


@F.pandas_udf(_ROWS)
def texture_features(pixels: pd.Series, masks: pd.Series, combined: pd.Series, shape: pd.Series) -> pd.Series:
    """Own mask of each channel, then the combined mask of each; null where the own mask is empty."""
    out = []
    for p, m, c, s in zip(pixels, masks, combined, shape):
        if p is None or m is None:
            out.append(None)
            continue
        x, own = np.asarray(p, float).reshape(tuple(s)), np.asarray(m, bool).reshape(tuple(s))
        joint = np.asarray(c, bool).reshape(s[1], s[2])
        rows = [glcm_row(a, k) for a, k in zip(x, own)] + [glcm_row(a, joint if k.any() else k) for a, k in zip(x, own)]
        out.append(_rows(*rows))
    return pd.Series(out)


def feature_columns(names: list[str], types: list[str], tag: str = "") -> list[tuple[str, str, str]]:
    """(kind, name, SQL) of all features in fixed order, from the columns that ``feature_arrays`` made with ``tag``."""
    out: list[tuple[str, str, str]] = []

    def at(group: str, *places: int) -> str:
        x = f"_{tag}_{group}"
        for k in places:
            x = f"get({x}, {k})"
        return x

    if "regions" in types:
        out += [("meta", f"regions_{c}", at("regions", k)) for k, c in enumerate(names)]
    if "bbox" in types:
        out += [("meta", f"bbox_{f}", f"cast({at('bbox')}.{f} AS double)") for f in ("minr", "minc", "maxr", "maxc")]
    if "shape" in types:
        for k, c in enumerate(["combined", *names]):
            out += [("feat", f"{p}_{c}", at("shape", k, i)) for i, p in enumerate(SHAPE)]
    if "raw" in types:
        for k, c in enumerate(names):
            out += [("feat", f"{p}_{c}", at("raw", k, i)) for i, p in enumerate(STATISTICS)]
    if "intensity" in types:
        for k, c in enumerate(names):
            for i, view in enumerate(VIEWS):
                out += [("feat", f"{view}{p}_{c}", at("intensity", k, i, j)) for j, p in enumerate(STATISTICS)]
    if "texture" in types:
        for j, view in enumerate(("", "combined_")):
            for k, c in enumerate(names):
                out += [("feat", f"{view}{p}_{c}", at("texture", j * len(names) + k, i)) for i, p in enumerate(TEXTURE)]
    return out


def feature_arrays(images: DataFrame, types: list[str], meta: list[str] = ("event",), tag: str = "") -> DataFrame:
    """``meta`` (as meta_...) and one column a feature group of ``types``, arrays or a box, for image rows.

    Masked rows, unless only ``raw`` is asked for. Each group is computed once a row; rejected rows keep
    their meta columns and nulls.
    """
    unknown = set(types) - set(TYPES)
    if unknown:
        raise ValueError(f"unknown feature types {sorted(unknown)}; among {TYPES}")
    if "mask" not in images.columns and set(types) - {"raw"}:
        raise ValueError("without masks only raw features can be computed")
    groups = {
        "regions": lambda: F.col("regions"),
        "bbox": lambda: F.col("bbox"),
        "shape": lambda: shape_features("mask", "combined_mask", "shape"),
        "raw": lambda: raw_features("pixels", "shape"),
        "intensity": lambda: intensity_features()("pixels", "mask", "combined_mask", "background", "combined_background", "shape"),
        "texture": lambda: texture_features("pixels", "mask", "combined_mask", "shape"),
    }
    made = {f"_{tag}_{g}": groups[g]() for g in TYPES if g in types}
    d = images.select(*(F.col(c).alias(f"meta_{c}") for c in meta), *(f.alias(f"u{name}") for name, f in made.items()))
    return held(d, **{name: F.col(f"u{name}") for name in made}).drop(*(f"u{name}" for name in made)) if made else d


def spread(arrays: DataFrame, names: list[str], branches: list[tuple[str, str, list[str]]]) -> DataFrame:
    """The wide table: meta columns, then for each (prefix, tag, types) the features of its arrays.

    One projection from SQL text: a column object for each of thousands of features would cost the driver
    more than their analysis.
    """
    out = [f"`{c}`" for c in arrays.columns if c.startswith("meta_")]
    for prefix, tag, types in branches:
        p = f"{prefix}_" if prefix else ""
        out += [f"{sql} AS `{kind}_{p}{name}`" for kind, name, sql in feature_columns(names, types, tag)]
    return arrays.selectExpr(*out)


def features(images: DataFrame, names: list[str], types: list[str], meta: list[str] = ("event",), prefix: str = "") -> DataFrame:
    """The wide table of ``types`` for image rows: meta columns, then features with ``prefix``."""
    return spread(feature_arrays(images, types, meta), names, [(prefix, "", types)])
