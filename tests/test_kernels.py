import numpy as np

from lumenframe.kernels import filters as K
from lumenframe.kernels import labels as L
from lumenframe.kernels import regions as R


def test_label_connects_diagonals_only_with_eight():
    m = np.array([[1, 0, 0], [0, 1, 0], [0, 0, 0]])
    assert L.label(m)[1] == 1 and L.label(m, eight=False)[1] == 2


def test_distance_is_exact():
    rng = np.random.default_rng(1)
    m = rng.random((9, 12)) > 0.2
    r, c = np.nonzero(~m)
    want = np.array([[np.sqrt(((r - y) ** 2 + (c - x) ** 2).min()) for x in range(12)] for y in range(9)])
    assert np.allclose(L.distance_transform(m), want)


def test_small_objects_and_holes():
    m = np.zeros((12, 12), bool)
    m[1:9, 1:9] = True
    m[4, 4] = False
    m[11, 11] = True
    assert L.fill_small(m, 5)[4, 4] and not L.drop_small(m, 5)[11, 11]


def test_watershed_fills_the_frame():
    marks = np.zeros((8, 8), int)
    marks[1, 1], marks[6, 6] = 1, 2
    assert set(np.unique(L.watershed(np.zeros((8, 8)), marks))) == {1, 2}


def test_thresholds_part_two_levels():
    a = np.r_[np.full(50, 1.0), np.full(50, 9.0)]
    assert 1 <= L.otsu(a) < 9 and 1 <= L.li(a) < 9


def test_square_properties():
    m = np.zeros((14, 14), bool)
    m[2:12, 2:12] = True
    p = dict(zip(R.SHAPE, R.shape_row(m)))
    assert len(R.SHAPE) == 59 and p["area"] == 100 and p["extent"] == 1 and p["euler_number"] == 1 and p["perimeter"] == 36
    empty = R.shape_row(np.zeros((4, 4), bool))
    assert (empty[: R.EMPTY] == 0).all() and np.isnan(empty[R.EMPTY :]).all()


def test_sobel_and_medians_of_a_constant():
    a = np.full((7, 7), 3.0)
    assert not K.sobel(a).any() and (K.median_square(a, 4) == 3).all() and np.allclose(K.gaussian(a, 1), 3)
