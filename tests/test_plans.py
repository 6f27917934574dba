"""Configurations, kernels against brute force, and operators named in configurations."""

import itertools

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from lumenframe.functions.arrays import STATISTICS
from lumenframe.kernels import filters as K
from lumenframe.kernels import intensity
from lumenframe.kernels import labels as L
from lumenframe.operators import masking, segmentation
from lumenframe.plans.pipeline import build, validate
from lumenframe.session import settings

CONFIG = """
load:
  format: zarr
  channels: [0, 1]
  channel_names: [BF1, PI]
  kwargs:
    regex: x
segment:
project:
illumination_correction:
mask:
  combined_indices: [0, 1]
  main_channel_index: 0
  filters:
    - {method: std, channel_indices: [1], settings: {threshold: 2.0}}
  methods:
    - {method: circle, name: circle-1, export: false, kwargs: }
    - {method: circle, name: circle-2, export: false, kwargs: }
    - {method: spot, name: spot, export: false, kwargs: {spotsize: 5}}
    - {method: li, name: li, export: false, kwargs: {smooth: [1, 1]}}
filter:
normalization:
feature_extraction:
  circle-1: [shape, intensity, bbox, regions]
  circle-2: [shape, intensity, bbox, regions]
  spot: [shape, intensity, bbox, regions]
  li: [shape, intensity, regions]
export: {format: parquet, filename: features}
"""
META = ("event", "path", "zarr_idx", "group")


@pytest.fixture
def frames(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(10):
        y, x = np.mgrid[:24, :24]
        a = np.stack([80 * np.exp(-((y - 12) ** 2 + (x - 11) ** 2) / s) + rng.random((24, 24)) for s in (30, 12)])
        rows.append((k, f"p{k}", k, "g", [2, 24, 24], a.ravel().tolist()))
    return spark.createDataFrame(rows, "event long, path string, zarr_idx int, `group` string, shape array<int>, pixels array<double>")


def test_masks_have_types_and_arguments_of_their_own(frames):
    config = yaml.safe_load(CONFIG)
    out = build(config, frames, list(META)).features
    # shape 59 x 3, intensity 88 x 2, box 4, regions 2; li without box; raw 11 x 2
    assert len(out.columns) == 3 * 359 + 355 + 22 + len(META) == 1458
    rows = out.collect()
    same = [(a, a.replace("circle-1", "circle-2")) for a in out.columns if "circle-1" in a]
    assert len(rows) == 10 and len(same) == 359 and all(r[a] == r[b] for r in rows for a, b in same)
    assert sum("regions" in c for c in out.columns) == 8 and all(r["feat_raw_mean_PI"] is not None for r in rows)


@pytest.mark.parametrize("limit,replace,expected", [(2, False, 2), (8, False, 8), (-1, False, 10), (20, True, 20)])
def test_limits(frames, limit, replace, expected):
    config = yaml.safe_load(CONFIG) | {"mask": None, "feature_extraction": ["raw"]}
    assert build(config, frames, list(META), limit, replace).features.count() == expected


def test_unknown_keys_raise_at_every_level():
    good = yaml.safe_load(CONFIG)
    validate(good)
    for path, key in (((), "masking"), (("load",), "chanels"), (("mask",), "channel"), (("mask", "methods", 0), "kwarg"), (("mask", "filters", 0), "index"), (("export",), "name"), (("feature_extraction",), "circle-3")):
        bad = yaml.safe_load(CONFIG)
        at = bad
        for p in path:
            at = at[p]
        at[key] = ["raw"]
        with pytest.raises(ValueError, match=key):
            validate(bad)
    for changed in ({"feature_extraction": {"spot": ["bbox"]}}, {"feature_extraction": ["colour"]}, {"filter": {"name": "other"}}, {"mask": None}):
        with pytest.raises(ValueError):
            validate(good | changed)


def test_projection_by_setting_and_by_name(spark):
    stack = spark.createDataFrame([(1, [1, 2, 1, 2], [1.0, 5.0, 3.0, 2.0])], "event long, shape array<int>, pixels array<double>")
    base = {"load": {"channel_names": ["a"]}, "feature_extraction": ["raw"]}
    for step, want in (({"method": "op", "settings": {"op": "mean"}}, 2.75), ({"method": "max"}, 4.0), ({"method": "op", "kwargs": {"op": "numpy:min"}}, 1.5)):
        assert build(base | {"project": step}, stack).features.first()["feat_mean_a"] == want
    with pytest.raises(ValueError, match="projection"):
        build(base | {"project": {"method": "none"}}, stack)


def test_mask_by_name_and_smooth_a_channel(frames):
    named = masking.make(frames, "lumenframe.operators.masking:_spot", spotsize=3).first()
    assert named == masking.make(frames, "spot", spotsize=3).first()
    with pytest.raises(ValueError, match="imported"):
        masking.make(frames, "lumenframe.operators.masking:nothing")
    one = masking.make(frames, "li", smooth=[0.5, 2.0]).first()
    each = [masking.make(frames, "li", smooth=s).first() for s in (0.5, 2.0)]
    n = 24 * 24
    assert one["mask"] == each[0]["mask"][:n] + each[1]["mask"][n:] and each[0]["mask"] != each[1]["mask"]


def test_persisted_rows_are_released(frames):
    result = build(yaml.safe_load(CONFIG) | {"feature_extraction": ["bbox"]}, frames, list(META), persist=True)
    assert result.features.count() == 10 and result.persisted[0].is_cached
    result.release()
    assert not result.persisted[0].is_cached


def test_rank_median_is_the_upper_one():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 50, (9, 11)).astype(float)
    want = np.empty_like(a)
    for r, c in itertools.product(range(9), range(11)):
        v = sorted(a[y, x] for y in range(9) for x in range(11) if (y - r) ** 2 + (x - c) ** 2 <= 4)
        want[r, c] = next(x for x in v if sum(y <= x for y in v) > len(v) / 2)
    assert (K.rank_median(a, 2) == want).all()


def test_erosion_and_views_equal_brute_force():
    rng = np.random.default_rng(4)
    m = rng.random((20, 23)) > 0.03
    want = np.array([[all(m[y, x] for y in range(20) for x in range(23) if (y - r) ** 2 + (x - c) ** 2 <= 9) for c in range(23)] for r in range(20)])
    assert (intensity.eroded(m, 3) == want).all() and (intensity.eroded(m, 3) == K.binary_erosion(m, 3)).all()
    a = rng.random((20, 23)) * 9
    out = intensity.views(a, m, m, intensity.edge(m, 3), 0.5, None, 3)
    for k, v in ((0, a[m]), (1, a[m] - 0.5), (2, a[m & ~want]), (3, a[m & ~want] - 0.5), (4, a[m])):
        assert np.allclose(out[k], intensity.statistics(v)), k
        assert np.isclose(out[k][STATISTICS.index("mad")], np.median(abs(v - np.median(v))))
    assert np.isnan(out[5]).all() and (intensity.views(a, m & False, m, m & False, 1.0, 1.0)[[0, 1, 2, 3, 6, 7]] == 0).all()


def test_watershed_floods_the_image():
    a = np.zeros((12, 12))
    a[3:9, 3:9] = 100.0
    marks = np.zeros((12, 12), int)
    marks[0, 0], marks[5, 5] = 1, 2
    # cost of a place: its value and the way from its marker; the lowest front goes first
    got = L.watershed(a, marks, 1.0)
    assert set(np.unique(got)) == {1, 2} and got[5, 5] == 2 and (got[0] == 1).all()
    m, n = masking.KERNELS["watershed"](a + np.random.default_rng(0).random((12, 12)))
    assert m.shape == (12, 12) and n >= 0


def test_children_stay_inside_their_parents():
    parents = np.zeros((4, 8), int)
    parents[:, :2], parents[:, 6:] = 1, 2
    everywhere = np.full((4, 8), 7)
    assert (segmentation.children_of(parents, everywhere) == parents).all()
    rng = np.random.default_rng(5)
    p, c = rng.integers(0, 4, (9, 9)), rng.integers(0, 6, (9, 9))
    want = np.zeros_like(p)
    for y, x in itertools.product(range(9), range(9)):
        if p[y, x] and c[y, x]:
            share = ((p == p[y, x]) & (c == c[y, x])).sum() / (p == p[y, x]).sum()
            want[y, x] = p[y, x] if share > 0.1 else 0
    assert (segmentation.children_of(p, c) == want).all()


def test_all_channels_get_children_beside_the_nuclei():
    x = np.arange(3 * 4).reshape(3, 2, 2).astype(float)
    seen = []

    def cells(pair):
        seen.append(pair.copy())
        return np.ones((2, 2))

    out = segmentation.family(x, cells, 1, 0)
    assert out.shape == x.shape and [int(s[0, 0, 0]) for s in seen] == [4, 0, 8] and all((s[1] == x[0]).all() for s in seen)
    assert len(segmentation.family(x, cells, 1, 0, [2])) == 3


def test_cluster_settings():
    assert settings(4, 8, 2, 1, None, "/log", ["a.b=c=d"])["a.b"] == "c=d"
    with pytest.raises(ValueError):
        settings(extra=["nothing"])


def test_lost_events_keep_their_rows(frames):
    lost = frames.withColumn("pixels", F.when(F.col("event") > 0, F.col("pixels")))
    rows = build(yaml.safe_load(CONFIG), lost, list(META)).features.orderBy("meta_event").collect()
    assert len(rows) == 10 and rows[0]["feat_circle-1_mean_BF1"] is None and rows[1]["feat_circle-1_mean_BF1"] is not None
