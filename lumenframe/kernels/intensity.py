"""Statistics of pixel values, and the masks that they are taken in, on NumPy arrays."""

from __future__ import annotations

import numpy as np

from ..functions.arrays import STATISTICS

#: Radius of the disk that parts a mask from its edge.
EDGE = 6


def statistics(v: np.ndarray) -> np.ndarray:
    """STATISTICS of some values: NaN where undefined, one sort for all quantiles."""
    n = len(v)
    if not n:
        return np.full(len(STATISTICS), np.nan)
    ordered = np.sort(v)
    mean = v.sum() / n
    d = v - mean
    square = d * d
    m2 = square.sum() / n
    low, mid, high = np.quantile(ordered, (0.25, 0.5, 0.75))
    skewness = kurtosis = np.nan
    if m2 > 0:
        skewness, kurtosis = (square * d).sum() / n / m2**1.5, (square * square).sum() / n / (m2 * m2) - 3
    return np.array([mean, ordered[-1], ordered[0], v.sum(), np.median(np.abs(v - mid)), skewness, kurtosis, np.sqrt(m2), mid, low, high])


def eroded(mask: np.ndarray, radius: int = EDGE) -> np.ndarray:
    """Binary erosion by a disk, a run a row of the disk; places outside the frame count as set."""
    h, w = mask.shape
    holes = np.zeros((h + 2 * radius, w + 2 * radius + 1), np.int32)
    holes[radius : radius + h, radius + 1 : radius + 1 + w] = ~mask
    np.cumsum(holes, axis=1, out=holes)
    out = np.ones(mask.shape, bool)
    for y in range(-radius, radius + 1):
        half = int(np.sqrt(radius * radius - y * y))
        rows = holes[radius + y : radius + y + h]
        out &= rows[:, radius + half + 1 : radius + half + 1 + w] == rows[:, radius - half : radius - half + w]
    return out


def edge(mask: np.ndarray, radius: int = EDGE) -> np.ndarray:
    return mask & ~eroded(mask, radius)


def views(a: np.ndarray, mask: np.ndarray, joint: np.ndarray, joint_edge: np.ndarray, background: float | None, joint_background: float | None, radius: int = EDGE) -> np.ndarray:
    """The eight views of one channel, in pairs of as it is and less its background.

    Values of an empty own mask are 0 in the first four views, of an empty edge in the edge views. Less a
    background, places move and spreads stay; an unknown background leaves nothing known.
    """
    moved = np.isin(STATISTICS, ("mean", "max", "min", "median", "lower_quartile", "upper_quartile")).astype(float)
    out = np.empty((8, len(STATISTICS)))
    for k, (m, back, bare) in enumerate(((mask, background, 0.0), (edge(mask, radius), background, 0.0), (joint, joint_background, np.nan), (joint_edge, joint_background, 0.0))):
        x = a[m]
        out[2 * k] = statistics(x) if x.size else bare
        if not x.size:
            out[2 * k + 1] = bare
        else:
            back = np.nan if back is None else back
            out[2 * k + 1] = out[2 * k] - moved * back if back == back else np.nan
            out[2 * k + 1, STATISTICS.index("sum")] -= len(x) * back
    return out
