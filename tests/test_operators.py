import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenframe.functions.arrays import normality, statistics
from lumenframe.functions.features import features, intensity_features, raw_features, shape_features, texture_features
from lumenframe.kernels.intensity import edge
from lumenframe.model import image_rows
from lumenframe.operators import filters, illumination, masking, normalization, projection, sampling, segmentation
from lumenframe.plans.pipeline import build, validate

SHAPE = [3, 10, 10]
FLAT = list(map(float, range(100))) * 3


@pytest.fixture
def images(spark):
    rows = [(i, "one" if i < 5 else "two", SHAPE, FLAT) for i in range(10)]
    return spark.createDataFrame(rows, "event long, group string, shape array<int>, pixels array<double>")


def test_statistics(spark):
    row = spark.range(1).select(statistics(F.array(*(F.lit(float(x)) for x in range(100)))).alias("s")).first().s
    assert (row["mean"], row["median"], row["mad"], row["lower_quartile"], row["upper_quartile"], row["sum"]) == (49.5, 49.5, 25, 24.75, 74.25, 4950)
    assert abs(row["std"] - 28.86607) < 1e-5 and abs(row.skewness) < 1e-9 and abs(row.kurtosis + 1.200240024) < 1e-9
    empty = spark.range(1).select(statistics(F.expr("cast(array() as array<double>)")).alias("s"), statistics(F.array(F.lit(1.0), F.lit(1.0))).alias("t")).first()
    assert empty.s is None and empty.t.skewness is None and empty.t["std"] == 0


def test_extremes_of_all_and_of_the_mask(images):
    assert {(r.lo, r.hi) for r in normalization.extremes(images).collect()} == {(0, 99)}
    inner = [2 <= i // 10 < 8 and 2 <= i % 10 < 8 for i in range(100)] * 3
    masked = images.withColumn("mask", F.array(*map(F.lit, inner)))
    assert {(r.lo, r.hi) for r in normalization.extremes(masked).collect()} == {(22, 77)}
    out, _ = normalization.normalize(images)
    assert all(min(r.pixels) == 0 and max(r.pixels) == 1 for r in out.collect())


def test_masks_boxes_and_backgrounds(images):
    row = masking.apply(masking.make(images, "circle"), 3).first()
    r, c = np.nonzero(np.array(row.combined_mask).reshape(10, 10))
    assert tuple(row.bbox) == (r.min(), c.min(), r.max() + 1, c.max() + 1)
    assert abs(row.background[0] - np.arange(100)[~np.array(row.combined_mask)].mean()) < 1e-9
    assert set(masking.KERNELS) == {"li", "threshold", "otsu", "sobel", "spot", "watershed"}
    with pytest.raises(ValueError):
        masking.make(images, "nothing")


def test_edge_of_a_small_mask_is_the_mask():
    m = np.zeros((5, 5), bool)
    m[2, 2] = True
    assert (edge(m) == m).all()


def test_rejected_rows_keep_their_place(images):
    out = filters.mask_filters(images, [{"method": "std", "settings": {"threshold": 1000.0}}], 0, 3)
    assert out.count() == 10 and out.where("pixels IS NULL").count() == 10
    wide = features(masking.apply(masking.make(out, "circle"), 3), list("abc"), ["regions", "bbox", "intensity"])
    assert wide.count() == 10 and wide.where("feat_mean_a IS NOT NULL").count() == 0


def test_projection_and_illumination(spark, images):
    stack = spark.createDataFrame([(1, [1, 2, 1, 2], [1.0, 5.0, 3.0, 2.0])], "event long, shape array<int>, pixels array<double>")
    assert projection.project(stack, "max").first().pixels == [3, 5]
    assert projection.project(stack, "median").first().pixels == [2, 3.5]
    same = illumination.divide(images, illumination.mean_images(images, "group"), "group").first().pixels
    assert same[0] is None and set(same[1:100]) == {1.0}
    with pytest.raises(Exception, match="no correction image"):
        illumination.divide(images, illumination.mean_images(images.where("group = 'one'"), "group"), "group").collect()


def test_images_are_filled_and_projected_without_python(spark):
    sparse = spark.createDataFrame([(1, 0, 2.0), (1, 11, 5.0), (1, 11, 1.0), (1, 4, None), (2, 7, -3.0)], "event long, i int, v double")
    stacks = image_rows(sparse, (2, 3, 1, 2))
    d = projection.project(stacks)
    # batches of whole stacks in Python's workers took most of an executor's memory
    assert "Python" not in d._jdf.queryExecution().toString()
    got = {r.event: (r.shape, r.pixels) for r in stacks.collect()}
    assert got == {1: ([2, 3, 1, 2], [2.0] + [0.0] * 10 + [6.0]), 2: ([2, 3, 1, 2], [0.0] * 7 + [-3.0] + [0.0] * 4)}
    assert {r.event: (r.shape, r.pixels) for r in d.collect()} == {1: ([2, 1, 2], [2, 0, 0, 6]), 2: ([2, 1, 2], [0, 0, 0, 0])}
    for place in (-1, 12):
        with pytest.raises(Exception, match="beyond the image of event 1"):
            image_rows(spark.createDataFrame([(1, 3, 1.0), (1, place, 1.0)], "event long, i int, v double"), (2, 3, 1, 2)).collect()


def test_projections_equal_numpy(spark):
    rng = np.random.default_rng(6)
    shapes = [[3, 7, 4, 5], [1, 1, 2, 3], [2, 4, 3, 3]]
    stacks = [rng.integers(-50, 50, s).astype(float) for s in shapes]
    stacks[0][1, 2, 3, 4] = np.inf
    d = spark.createDataFrame([(k, s, a.ravel().tolist()) for k, (s, a) in enumerate(zip(shapes, stacks))] + [(9, shapes[0], None)], "event long, shape array<int>, pixels array<double>")
    for op in ("max", "mean", "median"):
        got = {r.event: (r.shape, r.pixels) for r in projection.project(d, op).collect()}
        assert got.pop(9) == ([3, 4, 5], None)
        for k, a in enumerate(stacks):
            want = projection.OPS[op](a, axis=1)
            assert got[k][0] == list(want.shape) and np.allclose(got[k][1], want.ravel()), (op, k)


def test_features_stay_numpy_rows_with_null_for_nan():
    """Lists of Python's numbers, three times as large, stayed in the workers' memory."""
    pixels, mask = pd.Series([np.ones(100), None]), pd.Series([np.arange(100) < 30, None])
    shape, back = pd.Series([[1, 10, 10]] * 2), pd.Series([[1.0], None])
    raw = raw_features.func(pixels, shape)
    wide = intensity_features().func(pixels, mask, mask, back, back, shape)
    shaped, texture = shape_features.func(mask, mask, shape), texture_features.func(pixels, mask, mask, shape)
    assert all(x[1] is None for x in (raw, wide, shaped, texture))
    assert all(isinstance(r, np.ndarray) for x in (raw[0], wide[0][0], shaped[0], texture[0]) for r in x)


def test_undefined_features_are_null(images):
    flat = images.withColumn("pixels", F.transform("pixels", lambda x: x * 0 + 1))
    row = features(masking.apply(masking.make(flat, "circle"), 3), list("abc"), ["shape", "raw", "intensity", "texture"]).first().asDict()
    assert row["feat_skewness_a"] is None and row["feat_bgcorr_kurtosis_b"] is None and row["feat_mean_a"] == 1
    assert not any(x != x for x in row.values() if isinstance(x, float))


def test_sampling_sizes(images):
    assert [sampling.sample(images, k).count() for k in (2, 8, 50)] == [2, 8, 10]
    assert sampling.sample_with_replacement(images, 20).count() == 20
    assert sampling.sample_with_replacement(images.limit(0), 20).count() == 0


def test_segmentation_gives_objects(spark):
    a = np.zeros((1, 24, 24))
    a[0, 4:9, 4:9] = 100
    a[0, 14:20, 14:20] = 100
    d = spark.createDataFrame([(1, "p", [1, 24, 24], a.ravel().tolist())], "event long, plate string, shape array<int>, pixels array<double>")
    out = segmentation.segment(d, "watershed_dapi", {"cell_diameter": 4}, ["plate"]).collect()
    assert len(out) == 2 and {r.group for r in out} == {"p"}
    parents, children = np.array([[1, 1], [1, 1]]), np.array([[7, 0], [0, 0]])
    assert segmentation.children_of(parents, children).tolist() == [[1, 0], [0, 0]]


def test_normal_values_are_normal(spark):
    x = np.random.default_rng(0).normal(size=256)
    row = spark.range(1).select(normality(F.array(*(F.lit(float(v)) for v in x))).alias("k")).first()
    assert 0 <= row.k < 12


def test_plans(images):
    with pytest.raises(ValueError):
        validate({"loading": {}})
    with pytest.raises(ValueError):
        validate({"load": {"channel_names": ["a"], "channels": [0, 1]}})
    config = {"load": {"channel_names": list("abc")}, "mask": {"methods": [{"method": "circle", "name": "x"}, {"method": "circle", "name": "y"}]}, "normalization": {}, "feature_extraction": ["raw", "regions", "bbox"]}
    result = build(config, images, ["event", "group"], limit=4)
    row = result.features.collect()
    assert len(row) == 4 and row[0].meta_x_bbox_minr == row[0].meta_y_bbox_minr and row[0].feat_raw_max_a == 1
    assert result.boundaries["x"].count() == 2
