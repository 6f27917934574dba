"""Neighbourhood filters on two-dimensional NumPy arrays."""

from __future__ import annotations

import numpy as np


def windows(a: np.ndarray, radius: int, mode: str, **kw) -> np.ndarray:
    """All (2r+1) x (2r+1) windows, as a view."""
    return np.lib.stride_tricks.sliding_window_view(np.pad(a, radius, mode=mode, **kw), (2 * radius + 1,) * 2)


def disk(radius: int) -> np.ndarray:
    y, x = np.ogrid[-radius : radius + 1, -radius : radius + 1]
    return x * x + y * y <= radius * radius


def sobel(a: np.ndarray) -> np.ndarray:
    w = windows(np.asarray(a, float), 1, "symmetric")
    k = np.array([[1, 2, 1], [0, 0, 0], [-1, -2, -1]]) / 4
    return np.sqrt(((w * k).sum((2, 3)) ** 2 + (w * k.T).sum((2, 3)) ** 2) / 2)


def gaussian(a: np.ndarray, sigma: float) -> np.ndarray:
    a = np.asarray(a, float)
    if sigma <= 0:
        return a
    r = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()
    for axis in (0, 1):
        p = np.pad(a, [(r, r) if i == axis else (0, 0) for i in (0, 1)], mode="edge")
        a = np.lib.stride_tricks.sliding_window_view(p, 2 * r + 1, axis=axis) @ k
    return a


def rank_median(a: np.ndarray, radius: int) -> np.ndarray:
    """Median over the pixels of a disk that are in the frame; the upper one of an even number."""
    w = windows(np.asarray(a, float), radius, "constant", constant_values=np.nan)[:, :, disk(radius)]
    ordered, n = np.sort(w, axis=2), (~np.isnan(w)).sum(2)
    return np.take_along_axis(ordered, (n // 2)[:, :, None], 2)[:, :, 0]


def median_square(a: np.ndarray, size: int) -> np.ndarray:
    """Median of size x size windows, mirrored borders; the upper one and a left-up origin for even sizes."""
    lo = size // 2
    p = np.pad(np.asarray(a, float), (lo, size - 1 - lo), mode="symmetric")
    w = np.lib.stride_tricks.sliding_window_view(p, (size, size)).reshape(*a.shape, -1)
    return np.partition(w, size * size // 2, axis=2)[:, :, size * size // 2]


def medfilt(a: np.ndarray, size: int) -> np.ndarray:
    """The same with zeros beyond the frame, row by row to bound memory; size is made odd."""
    size |= 1
    p = np.pad(np.asarray(a, float), size // 2)
    out = np.empty(a.shape)
    for r in range(a.shape[0]):
        w = np.lib.stride_tricks.sliding_window_view(p[r : r + size], (size, size)).reshape(a.shape[1], -1)
        out[r] = np.median(w, axis=1)
    return out


def grey(a: np.ndarray, radius: int, op: str) -> np.ndarray:
    """Grey erosion or dilation by a disk; beyond the frame nothing counts."""
    fill = np.inf if op == "erode" else -np.inf
    w = windows(np.asarray(a, float), radius, "constant", constant_values=fill)[:, :, disk(radius)]
    return w.min(2) if op == "erode" else w.max(2)


def closing(a: np.ndarray, radius: int) -> np.ndarray:
    return grey(grey(a, radius, "dilate"), radius, "erode")


def white_tophat(a: np.ndarray, radius: int) -> np.ndarray:
    return a - grey(grey(a, radius, "erode"), radius, "dilate")


def binary_erosion(m: np.ndarray, radius: int) -> np.ndarray:
    return windows(np.asarray(m, bool), radius, "constant", constant_values=True)[:, :, disk(radius)].all(2)


def nl_means(a: np.ndarray, patch: int = 2, distance: int = 1, h: float = 0.1) -> np.ndarray:
    """Mean weighted by patch likeness."""
    a = np.asarray(a, float)
    r = max(1, patch // 2)
    p = np.pad(a, distance, mode="symmetric")
    out, weights = np.zeros_like(a), np.zeros_like(a)
    for dy in range(2 * distance + 1):
        for dx in range(2 * distance + 1):
            other = p[dy : dy + a.shape[0], dx : dx + a.shape[1]]
            d = windows((a - other) ** 2, r, "symmetric").mean((2, 3))
            w = np.exp(-d / (h * h))
            out += w * other
            weights += w
    return out / weights
