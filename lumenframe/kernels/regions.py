"""Properties of regions, by component and averaged."""

from __future__ import annotations

import numpy as np

from .labels import label

#: The 59 scalars, in output order.
SHAPE = [
    *"area convex_area eccentricity equivalent_diameter euler_number feret_diameter_max filled_area major_axis_length minor_axis_length orientation perimeter perimeter_crofton solidity extent".split(),
    *(f"inertia_tensor-{i}-{j}" for i in range(2) for j in range(2)),
    *(f"inertia_tensor_eigvals-{i}" for i in range(2)),
    *(f"moments-{i}-{j}" for i in range(4) for j in range(4)),
    *(f"moments_central-{i}-{j}" for i in range(4) for j in range(4)),
    *(f"moments_hu-{i}" for i in range(7)),
]
#: What an empty channel mask has: the first properties 0, the others null.
EMPTY = 11


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull by monotone chain, counter-clockwise."""
    p = sorted(set(map(tuple, points)))
    if len(p) < 3:
        return np.array(p)

    def half(points):
        out: list = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def filled(m: np.ndarray) -> np.ndarray:
    lab, _ = label(np.pad(~m, 1, constant_values=True), eight=False)
    return (lab != lab[0, 0])[1:-1, 1:-1]


def euler(m: np.ndarray) -> int:
    """Objects less holes, eight-connected objects."""
    holes = label(np.pad(~m, 1, constant_values=True), eight=False)[1] - 1
    return label(m)[1] - holes


def perimeter(m: np.ndarray) -> float:
    p = np.pad(m, 1)
    inner = p[1:-1, 1:-1] & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    b = np.pad((m & ~inner).astype(int), 1)
    codes = np.zeros(m.shape, int)
    for y in range(3):
        for x in range(3):
            codes += (1 if (y, x) == (1, 1) else 2 if 1 in (y, x) else 10) * b[y : y + m.shape[0], x : x + m.shape[1]]
    n = np.bincount(codes.ravel(), minlength=50)
    return float(n[[5, 7, 15, 17, 25, 27]].sum() + np.sqrt(2) * n[[21, 33]].sum() + (1 + np.sqrt(2)) / 2 * n[[13, 23]].sum())


def crofton(m: np.ndarray) -> float:
    """Cauchy-Crofton over four directions: crossings from inside to outside along each."""
    p = np.pad(m, 1).astype(int)
    straight = ((p[:, 1:] != p[:, :-1]).sum() + (p[1:] != p[:-1]).sum()) / 2
    slanted = ((p[1:, 1:] != p[:-1, :-1]).sum() + (p[1:, :-1] != p[:-1, 1:]).sum()) / 2
    return float(np.pi / 4 * (straight + slanted / np.sqrt(2)))


def properties(m: np.ndarray) -> np.ndarray:
    """The 59 scalars of one component."""
    rows, cols = np.nonzero(m)
    m = m[rows.min() : rows.max() + 1, cols.min() : cols.max() + 1]
    r, c = (x.astype(float) for x in np.nonzero(m))
    area = float(len(r))
    raw = np.array([[(r**i * c**j).sum() for j in range(4)] for i in range(4)])
    yc, xc = r - r.mean(), c - c.mean()
    central = np.array([[(yc**i * xc**j).sum() for j in range(4)] for i in range(4)])
    a, b, d = central[0, 2] / area, -central[1, 1] / area, central[2, 0] / area
    mid, gap = (a + d) / 2, np.hypot((a - d) / 2, b)
    l1, l2 = max(mid + gap, 0.0), max(mid - gap, 0.0)
    orientation = (np.pi / 4 if b < 0 else -np.pi / 4) if a == d else 0.5 * np.arctan2(-2 * b, d - a)
    corners = np.concatenate([np.c_[r + y, c + x] for y, x in ((-0.5, 0), (0.5, 0), (0, -0.5), (0, 0.5))])
    outline = hull(corners)
    gy, gx = np.mgrid[: m.shape[0], : m.shape[1]]
    convex = np.ones(m.shape, bool)
    for p, q in zip(outline, np.roll(outline, -1, axis=0)):
        convex &= (q[0] - p[0]) * (gx - p[1]) - (q[1] - p[1]) * (gy - p[0]) >= -1e-9
    convex_area = float(convex.sum())
    feret = float(np.sqrt(((outline[:, None] - outline[None]) ** 2).sum(2).max()))
    eta = np.array([[central[i, j] / area ** ((i + j) / 2 + 1) if i + j >= 2 else 0 for j in range(4)] for i in range(4)])
    p, q, s, t = eta[3, 0] + eta[1, 2], eta[2, 1] + eta[0, 3], eta[3, 0] - 3 * eta[1, 2], 3 * eta[2, 1] - eta[0, 3]
    hu = [
        eta[2, 0] + eta[0, 2],
        (eta[2, 0] - eta[0, 2]) ** 2 + 4 * eta[1, 1] ** 2,
        s**2 + t**2,
        p**2 + q**2,
        s * p * (p**2 - 3 * q**2) + t * q * (3 * p**2 - q**2),
        (eta[2, 0] - eta[0, 2]) * (p**2 - q**2) + 4 * eta[1, 1] * p * q,
        t * p * (p**2 - 3 * q**2) - s * q * (3 * p**2 - q**2),
    ]
    full = filled(m)
    return np.array(
        [area, convex_area, np.sqrt(1 - l2 / l1) if l1 else 0.0, np.sqrt(4 * area / np.pi), euler(m), feret, full.sum(), 4 * np.sqrt(l1), 4 * np.sqrt(l2), orientation, perimeter(m), crofton(m), area / convex_area, area / m.size, a, b, b, d, l1, l2, *raw.ravel(), *central.ravel(), *hu],
        float,
    )


def shape_row(mask: np.ndarray) -> np.ndarray:
    """Mean over the mask's components; 0 and NaN (null) for an empty mask."""
    lab, n = label(mask)
    if not n:
        return np.r_[np.zeros(EMPTY), np.full(len(SHAPE) - EMPTY, np.nan)]
    return np.mean([properties(lab == k) for k in range(1, n + 1)], axis=0)


def glcm_row(a: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """28 texture numbers: six co-occurrence properties as mean and deviation over angles for two
    distances, and the mean, deviation, maximum and minimum of the gradient in the mask."""
    from .filters import sobel

    if not mask.any():
        return np.full(28, np.nan)
    v = np.where(mask, a, np.nan)
    lo, hi = np.nanmin(v), np.nanmax(v)
    edges = np.linspace(lo, hi, 16) if hi > lo else np.linspace(lo - 0.5, hi + 0.5, 16)
    levels = np.where(mask, np.digitize(np.where(mask, a, lo), edges, right=True), 16).astype(int)
    i, j = np.mgrid[:16, :16]
    props = []
    for step in (2, 4):
        per = []
        for dy, dx in ((step, step), (step, -step)):
            h, w = levels.shape
            if h <= step or w <= step:
                m = np.zeros((16, 16))
            else:
                x = levels[: h - dy, max(0, -dx) : w - max(0, dx)]
                y = levels[dy:, max(0, dx) : w + min(0, dx)]
                m = np.zeros((17, 17))
                np.add.at(m, (x.ravel(), y.ravel()), 1)
                m = (m + m.T)[:16, :16]
            m = m / m.sum() if m.sum() else m
            mi, mj = (i * m).sum(), (j * m).sum()
            si, sj = np.sqrt((m * (i - mi) ** 2).sum()), np.sqrt((m * (j - mj) ** 2).sum())
            asm = (m * m).sum()
            correlation = 1.0 if si < 1e-15 or sj < 1e-15 else (m * (i - mi) * (j - mj)).sum() / (si * sj)
            per.append([(m * (i - j) ** 2).sum(), (m * abs(i - j)).sum(), (m / (1 + (i - j) ** 2)).sum(), np.sqrt(asm), correlation, asm])
        props.append(np.array(per))
    s = sobel(np.where(mask, a, np.nan))
    s = s[~np.isnan(s)]
    gradient = [s.mean(), s.std(), s.max(), s.min()] if s.size else [np.nan] * 4
    out = [x for k in range(6) for p in props for x in (p[:, k].mean(), p[:, k].std())]
    return np.array([*out, *gradient], float)


#: The 28 texture numbers, in output order.
TEXTURE = [f"{p}_{m}_{d}" for p in "contrast dissimilarity homogeneity energy correlation ASM".split() for d in (3, 5) for m in ("mean", "std")] + [f"sobel_{m}" for m in ("mean", "std", "max", "min")]
