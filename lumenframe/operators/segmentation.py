"""Segmentation: label images, and one row an object of the parent channel."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..kernels import filters as K
from ..kernels import labels as L
from ..plugins import resolve
from ..sinks import tables


def _nuclei(x: np.ndarray, cell_diameter: float, dapi_channel_index: int = 0, expansion_factor: float = 0.1) -> np.ndarray:
    """Watershed of the distance to the background from its peaks, filling the frame."""
    dapi = K.nl_means(x[dapi_channel_index], 3, 2)
    d = L.distance_transform(dapi > L.otsu(dapi))
    lab = L.watershed(-d, L.local_peaks(d, int(cell_diameter)))
    wide = L.expand(lab, cell_diameter * expansion_factor)
    return np.stack([lab if k == dapi_channel_index else wide for k in range(len(x))])


def children_of(parents: np.ndarray, children: np.ndarray, share: float = 0.1) -> np.ndarray:
    """Inside each parent, the pixels of the children that overlap more than ``share`` of its area."""
    out = np.zeros_like(parents)
    for k in np.unique(parents[parents > 0]):
        at = parents == k
        ids, counts = np.unique(children[at], return_counts=True)
        kept = ids[(ids > 0) & (counts / at.sum() > share)]
        out[at & np.isin(children, kept)] = k
    return out


def _model(x: np.ndarray, parent_channel_index: int = 0, dapi_channel_index: int = 0, channel_indices=None, cell_diameter=None, flow_threshold: float = 0.4, gpu: bool = False) -> np.ndarray:
    """Cells by a pretrained network, if its library is there; children of the other channels (all if
    ``channel_indices`` is None) go to their parents. Each channel is seen beside the nuclei."""
    try:
        from cellpose import models
    except ImportError as e:
        raise RuntimeError("the neural backend isn't installed; use watershed_dapi or register a method") from e
    global _net
    _net = globals().get("_net") or models.Cellpose(gpu=gpu, model_type="cyto2")
    return family(x, lambda pair: _net.eval(pair, channels=[1, 2], diameter=cell_diameter, flow_threshold=flow_threshold)[0], parent_channel_index, dapi_channel_index, channel_indices)


def family(x: np.ndarray, cells: Callable[[np.ndarray], np.ndarray], parent: int, nuclei: int, wanted: list[int] | None = None) -> np.ndarray:
    """Labels a channel: ``cells`` of (channel, nuclei) gives the parents, and children in other channels."""
    parents = cells(x[[parent, nuclei]]).astype(int)
    out = np.stack([parents] * len(x))
    for k in range(len(x)) if wanted is None else wanted:
        if k != parent:
            out[k] = children_of(parents, cells(x[[k, nuclei]]).astype(int))
    return out


METHODS: dict[str, Callable] = {"watershed_dapi": _nuclei, "cellpose": _model}


def label_masks(images: DataFrame, method: str, **settings) -> DataFrame:
    """Add ``label_mask``, a flat array of labels for all channels."""
    f = resolve(METHODS, method, "segmentation")

    @F.pandas_udf("array<int>")
    def run(pixels: pd.Series, shape: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else f(np.asarray(p, float).reshape(tuple(s)), **settings).ravel().astype(np.int32) for p, s in zip(pixels, shape)])

    return images.withColumn("label_mask", run("pixels", "shape"))


def subtract(left: Column, right: Column) -> Column:
    """Label difference of two channels, as integers."""
    return F.zip_with(left, right, lambda a, b: a - b)


def subtract_mask(images: DataFrame, left_index: int, right_index: int, for_channel_index: int) -> DataFrame:
    n = F.element_at("shape", -1) * F.element_at("shape", -2)
    cut = lambda k: F.slice("label_mask", F.lit(k) * n + 1, n)
    new = subtract(cut(left_index), cut(right_index))
    head = F.slice("label_mask", F.lit(1), F.lit(for_channel_index) * n)
    tail = F.slice("label_mask", F.lit(for_channel_index + 1) * n + 1, F.size("label_mask"))
    return images.withColumn("label_mask", F.concat(head, new, tail))


def to_events(images: DataFrame, group_keys: list[str] = (), parent_channel_index: int = 0) -> DataFrame:
    """One row an object: pixels and masks cropped to its box, frame coordinates, zero backgrounds."""
    kept = [f for f in images.schema.fields if f.name not in ("pixels", "shape", "label_mask", "mask", "regions", "bbox", "group", "id", "event", "background", "combined_background", "combined_mask")]
    more = T.StructType.fromDDL("event string, id int, group string, shape array<int>, pixels array<double>, mask array<boolean>, combined_mask array<boolean>, regions array<int>, background array<double>, combined_background array<double>, bbox struct<minr:int,minc:int,maxr:int,maxc:int>")
    schema = T.StructType([*kept, *more.fields])

    def run(batches):
        for pdf in batches:
            rows = []
            for row in pdf.to_dict("records"):
                if row["pixels"] is None:
                    continue
                s = tuple(row["shape"])
                x, lab = np.asarray(row["pixels"], float).reshape(s), np.asarray(row["label_mask"]).reshape(s)
                parent = lab[parent_channel_index]
                for k in np.unique(parent[parent > 0]).tolist():
                    r, c = np.nonzero(parent == k)
                    box = (int(r.min()), int(c.min()), int(r.max()) + 1, int(c.max()) + 1)
                    cut = np.s_[:, box[0] : box[2], box[1] : box[3]]
                    m = lab[cut] == k
                    n = len(m)
                    rows.append([*(row[f.name] for f in kept), f"{row['event']}_{k}", k, "_".join(str(row[g]) for g in group_keys), list(m.shape), x[cut].ravel(), m.ravel(), m.any(0).ravel(), [int(y.any()) for y in m], [0.0] * n, [0.0] * n, dict(zip(("minr", "minc", "maxr", "maxc"), box))])
            yield pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    return images.mapInPandas(run, schema)


def segment(images: DataFrame, method: str, settings: dict | None = None, group_keys: list[str] = (), export: str | None = None) -> DataFrame:
    """Labels, optional subtraction and export of label images, then one row an object."""
    settings = dict(settings or {})
    cut = settings.pop("substract", None)
    parent = settings.get("parent_channel_index", settings.get("dapi_channel_index", 0))
    out = label_masks(images, method, **settings)
    if cut:
        out = subtract_mask(out, **cut)
    if export:
        tables.label_masks(out, export, list(group_keys))
    return to_events(out, list(group_keys), parent)
