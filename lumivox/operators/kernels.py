"""Dense numeric kernels (numpy) and their application to block rows.

A volume too large for one task is held as blocks; a stencil kernel reads a block with
a halo of its neighbours' voxels, so blocks are computed apart from each other and
agree at their seams.  Only watershed needs a whole field of view in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.tables import keep

Kernel = Callable[[np.ndarray], np.ndarray]


def gaussian(size: int, sigma: float) -> np.ndarray:
    """Weights of ``size`` places, centred (between two places for an even size), of sum 1."""
    at = np.arange(size) - (size - 1) / 2
    w = np.exp(-(at**2) / (2 * sigma**2))
    return w / w.sum()


def separable(volume: np.ndarray, weights: Sequence[np.ndarray], mode: str = "symmetric") -> np.ndarray:
    """Convolution with a product of one-axis kernels; an even kernel's centre is its place size // 2."""
    out = volume.astype(float)
    for axis, w in enumerate(weights):
        n = len(w)
        left, right = n // 2, (n - 1) - n // 2
        pad = [(0, 0)] * out.ndim
        pad[axis] = (left, right)
        padded = np.pad(out, pad, mode=mode)
        total = np.zeros_like(out)
        for k, share in enumerate(w):
            cut = [slice(None)] * out.ndim
            cut[axis] = slice(k, k + out.shape[axis])
            total += share * padded[tuple(cut)]
        out = total
    return out


def fft_convolve(a: np.ndarray, b: np.ndarray, shape: str = "full") -> np.ndarray:
    """Linear convolution by FFT: ``full``, ``same`` (centre, as large as ``a``) or ``valid``."""
    full = [x + y - 1 for x, y in zip(a.shape, b.shape)]
    axes = range(a.ndim)
    out = np.fft.irfftn(np.fft.rfftn(a, full, axes) * np.fft.rfftn(b, full, axes), full, axes)
    if shape == "full":
        return out
    if shape == "same":
        start = [int(np.ceil((y - 1) / 2)) for y in b.shape]
        return out[tuple(slice(s, s + n) for s, n in zip(start, a.shape))]
    return out[tuple(slice(y - 1, x) for x, y in zip(a.shape, b.shape))]


def dog(volume: np.ndarray, size: int = 6, narrow: float = 3.0, wide: float = 4.0, mode: str = "symmetric") -> np.ndarray:
    """Difference of two Gaussians."""
    return separable(volume, [gaussian(size, narrow)] * volume.ndim, mode) - separable(volume, [gaussian(size, wide)] * volume.ndim, mode)


def _sphere(radius: int, ndim: int) -> list[tuple[int, ...]]:
    grid = np.indices((2 * radius + 1,) * ndim).reshape(ndim, -1).T - radius
    return [tuple(o) for o in grid[(grid**2).sum(axis=1) <= radius**2].tolist()]


def _extreme(volume: np.ndarray, offsets: list[tuple[int, ...]], take: Callable, edge: float) -> np.ndarray:
    reach = max((max(map(abs, o)) for o in offsets), default=0)
    padded = np.pad(volume.astype(float), reach, constant_values=edge)
    out = np.full(volume.shape, edge)
    for o in offsets:
        out = take(out, padded[tuple(slice(reach + d, reach + d + n) for d, n in zip(o, volume.shape))])
    return out


def open_sphere(volume: np.ndarray, radius: int = 5) -> np.ndarray:
    """Grey opening by a ball; places outside don't count."""
    ball = _sphere(radius, volume.ndim)
    return _extreme(_extreme(volume, ball, np.minimum, np.inf), ball, np.maximum, -np.inf)


def close_disk(image: np.ndarray, radius: int = 10) -> np.ndarray:
    """Grey closing by a disk (or ball)."""
    disk = _sphere(radius, image.ndim)
    return _extreme(_extreme(image, disk, np.maximum, -np.inf), disk, np.minimum, np.inf)


def pchip(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shape-preserving cubic interpolation of the last axis (Fritsch-Carlson slopes), no extrapolation beyond the ends."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    if len(x) == 1:
        return np.repeat(y, len(at), axis=-1)
    h, d = np.diff(x), np.diff(y, axis=-1) / np.diff(x)
    if len(x) == 2:
        return y[..., :1] + d[..., :1] * (np.clip(at, x[0], x[-1]) - x[0])
    slope = np.zeros_like(y)
    a, b = d[..., :-1], d[..., 1:]
    w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        slope[..., 1:-1] = np.where(a * b > 0, (w1 + w2) / (w1 / a + w2 / b), 0.0)

    def end(h0: float, h1: float, d0: np.ndarray, d1: np.ndarray) -> np.ndarray:
        s = ((2 * h0 + h1) * d0 - h0 * d1) / (h0 + h1)
        s = np.where(np.sign(s) != np.sign(d0), 0.0, s)
        return np.where((np.sign(d0) != np.sign(d1)) & (np.abs(s) > 3 * np.abs(d0)), 3 * d0, s)

    slope[..., 0] = end(h[0], h[1], d[..., 0], d[..., 1])
    slope[..., -1] = end(h[-1], h[-2], d[..., -1], d[..., -2])
    at = np.clip(at, x[0], x[-1])
    k = np.clip(np.searchsorted(x, at, "right") - 1, 0, len(x) - 2)
    t, step = (at - x[k]) / h[k], h[k]
    p, q, m, n = y[..., k], y[..., k + 1], slope[..., k] * step, slope[..., k + 1] * step
    return (1 + 2 * t) * (1 - t) ** 2 * p + t * (1 - t) ** 2 * m + t * t * (3 - 2 * t) * q + t * t * (t - 1) * n


def otsu(counts: np.ndarray, centres: np.ndarray) -> float:
    """The threshold between two classes of a histogram of largest variance between them (the mean of equals)."""
    counts = counts.astype(float)
    weight = np.cumsum(counts)
    mass = np.cumsum(counts * centres)
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mass[-1] * weight / weight[-1] - mass) ** 2 / (weight * (weight[-1] - weight))
    between[~np.isfinite(between)] = -1
    best = np.flatnonzero(between == between.max())
    return float(centres[best].mean())


_FACES = ((1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1))
_CUBE = tuple((a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) != (0, 0, 0))


def components(mask: np.ndarray, faces: bool = True) -> np.ndarray:
    """Labels from 1 of connected true voxels (6- or 26-connected), in the order of their first voxel; 0 elsewhere."""
    labels = np.zeros(mask.shape, np.int64)
    around, number = (_FACES if faces else _CUBE), 0
    for start in map(tuple, np.argwhere(mask)):
        if labels[start]:
            continue
        number += 1
        labels[start] = number
        stack = [start]
        while stack:
            at = stack.pop()
            for o in around:
                to = tuple(a + b for a, b in zip(at, o))
                if all(0 <= a < n for a, n in zip(to, mask.shape)) and mask[to] and not labels[to]:
                    labels[to] = number
                    stack.append(to)
    return labels


def watershed(height: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Labels of catchment basins of ``height`` inside ``mask`` by priority flood; voxels where basins meet are 0.

    Basins grow from regional minima (26-connected plateaus without a lower neighbour).
    """
    shape = height.shape
    inside = lambda p: all(0 <= a < n for a, n in zip(p, shape))
    near = lambda p: [q for o in _CUBE if inside(q := tuple(a + b for a, b in zip(p, o))) and mask[q]]
    labels = np.zeros(shape, np.int64)
    seen = ~mask
    number = 0
    for start in map(tuple, np.argwhere(mask)):
        if seen[start]:
            continue
        plateau, stack, lowest = [start], [start], True
        seen[start] = True
        while stack:
            at = stack.pop()
            for q in near(at):
                if height[q] < height[at]:
                    lowest = False
                elif height[q] == height[at] and not seen[q]:
                    seen[q] = True
                    plateau.append(q)
                    stack.append(q)
        if lowest:
            number += 1
            for p in plateau:
                labels[p] = number
    queue: list[tuple[float, int, tuple[int, ...]]] = []
    queued = labels > 0
    order = 0
    for p in map(tuple, np.argwhere(labels > 0)):
        for q in near(p):
            if not queued[q]:
                queued[q] = True
                heapq.heappush(queue, (height[q], order, q))
                order += 1
    while queue:
        _, _, p = heapq.heappop(queue)
        found = {labels[q] for q in near(p)} - {0}
        if len(found) == 1:
            labels[p] = found.pop()
            for q in near(p):
                if not queued[q]:
                    queued[q] = True
                    heapq.heappush(queue, (height[q], order, q))
                    order += 1
    return labels


def phase_shift(base: np.ndarray, move: np.ndarray, reach: Sequence[int]) -> tuple[int, ...]:
    """The whole-voxel shift of ``move`` against ``base``, within +-reach, by phase-only correlation under a radial window."""
    grid = np.meshgrid(*[np.linspace(-1, 1, n) if n > 1 else np.zeros(1) for n in base.shape], indexing="ij")
    radius = np.minimum(np.sqrt(sum(g**2 for g in grid)), 1)
    window = 0.5 * (1 + np.cos(np.pi * radius))
    cross = np.fft.fftn(base * window) * np.conj(np.fft.fftn(move * window))
    size = np.abs(cross)
    surface = np.fft.ifftn(np.divide(cross, size, out=np.zeros_like(cross), where=size > 1e-12)).real
    lags = [np.fft.fftfreq(n, 1 / n).round().astype(int) for n in base.shape]
    allowed = np.ones(base.shape, bool)
    for axis, (lag, most) in enumerate(zip(lags, reach)):
        shape = [1] * base.ndim
        shape[axis] = -1
        allowed &= (np.abs(lag) <= most).reshape(shape)
    peak = np.unravel_index(np.where(allowed, surface, -np.inf).argmax(), base.shape)
    return tuple(int(lag[k]) for lag, k in zip(lags, peak))


def subpixel_shift(base: np.ndarray, move: np.ndarray, factor: int = 10) -> tuple[float, ...]:
    """The shift of ``move`` against ``base`` to 1 / ``factor`` of a voxel, by the peak of their cross-correlation.

    The whole-voxel peak comes from one inverse transform; around it, within one voxel,
    the correlation is evaluated on the finer grid by one small matrix an axis.
    """
    cross = np.fft.fftn(base) * np.conj(np.fft.fftn(move))
    surface = np.fft.ifftn(cross).real
    coarse = [int(np.fft.fftfreq(n, 1 / n).round()[k]) for n, k in zip(base.shape, np.unravel_index(surface.argmax(), base.shape))]
    grids, fine = [], cross
    for n, c in zip(base.shape, coarse):
        at = c + np.arange(-factor, factor + 1) / factor if n > 1 else np.array([float(c)])
        waves = np.exp(2j * np.pi * np.outer(at, np.fft.fftfreq(n)))
        # the axis in front is used up, its finer grid goes to the end
        fine = np.tensordot(fine, waves, axes=(0, 1))
        grids.append(at)
    peak = np.unravel_index(fine.real.argmax(), fine.shape)
    return tuple(float(g[k]) for g, k in zip(grids, peak))


def correlation_shift(base: np.ndarray, move: np.ndarray, reach: int = 20) -> tuple[int, ...]:
    """The whole-pixel shift of ``move`` against ``base``, within +-reach, of the highest normalised correlation.

    Places outside ``base`` count 0; a window without variance correlates 0.
    """
    template = move - move.mean()
    n, turned = template.size, template[(slice(None, None, -1),) * move.ndim]
    ones = np.ones(move.shape)
    total, squares = fft_convolve(base, ones), fft_convolve(base.astype(float) ** 2, ones)
    spread = np.maximum(squares - total**2 / n, 0) * (template**2).sum()
    score = fft_convolve(base, turned)
    score = np.divide(score, np.sqrt(spread), out=np.zeros_like(score), where=spread > 1e-9 * max(float(spread.max()), 1e-300))
    lags = np.indices(score.shape) - np.array([m - 1 for m in move.shape]).reshape(-1, *[1] * move.ndim)
    score = np.where((np.abs(lags) <= reach).all(axis=0), score, -np.inf)
    peak = np.unravel_index(score.argmax(), score.shape)
    return tuple(int(k) - (m - 1) for k, m in zip(peak, move.shape))


def harris_response(volume: np.ndarray, blur: int = 5, kappa: float = 1 / 27) -> np.ndarray:
    """det - kappa trace^2 of the smoothed products of the gradient."""
    derive, smooth = np.array([-0.5, 0, 0.5]), np.array([0.25, 0.5, 0.25])
    gradient = [separable(volume, [derive if a == b else smooth for b in range(3)]) for a in range(3)]
    weights = [gaussian(blur, blur / 2 / 2.354)] * 3
    p = {(i, j): separable(gradient[i] * gradient[j], weights) for i in range(3) for j in range(i, 3)}
    xx, yy, zz, xy, xz, yz = p[0, 0], p[1, 1], p[2, 2], p[0, 1], p[0, 2], p[1, 2]
    det = xx * (yy * zz - yz**2) - xy * (xy * zz - yz * xz) + xz * (xy * yz - yy * xz)
    return det - kappa * (xx + yy + zz) ** 2


def harris_reach(blur: int) -> int:
    """Half the width of the window in which a corner must be the largest."""
    return int(np.ceil(blur / 2 / 2.354))


def harris(volume: np.ndarray, blur: int = 5, kappa: float = 1 / 27, quantile: float = 0.99, share: float = 0.01) -> np.ndarray:
    """(y, x, z) from 0 of corners: places of largest response in their window, above a share of its quantile."""
    response = harris_response(volume, blur, kappa)
    margin = int(0.1 * volume.shape[2])
    if margin:
        response[:, :, :margin] = response[:, :, -margin:] = 0
    reach = harris_reach(blur)
    cube = [tuple(o) for o in (np.indices((2 * reach + 1,) * 3).reshape(3, -1).T - reach).tolist()]
    top = _extreme(response, cube, np.maximum, -np.inf)
    return np.argwhere((response == top) & (response > share * np.quantile(response, quantile)))


def icosphere() -> np.ndarray:
    """Unit directions of the 80 faces of a once-divided icosahedron."""
    g = (1 + 5**0.5) / 2
    corners = np.array([(s, t * g, 0) for s in (-1, 1) for t in (-1, 1)], float)
    corners = np.vstack([corners, np.roll(corners, 1, axis=1), np.roll(corners, 2, axis=1)])
    corners /= np.linalg.norm(corners, axis=1)[:, None]
    near = np.linalg.norm(corners[:, None] - corners[None], axis=2)
    edge = near[near > 1e-9].min() * 1.01
    faces = [(i, j, k) for i in range(12) for j in range(i + 1, 12) for k in range(j + 1, 12) if max(near[i, j], near[j, k], near[i, k]) < edge]
    out = []
    for i, j, k in faces:
        a, b, c = corners[[i, j, k]]
        ab, bc, ca = ((p + q) / np.linalg.norm(p + q) for p, q in ((a, b), (b, c), (c, a)))
        out += [(a + ab + ca), (b + ab + bc), (c + bc + ca), (ab + bc + ca)]
    out = np.array(out)
    return out / np.linalg.norm(out, axis=1)[:, None]


_DIRECTIONS = icosphere()


def descriptor(volume: np.ndarray, key: Sequence[int], half: int = 8, bins: int = 2, clip: float = 0.2) -> np.ndarray:
    """Gradient histograms over bins^3 cells around ``key`` and 80 directions: clipped unit vector, scaled to 0..255."""
    padded = np.pad(volume.astype(float), half + 1, mode="edge")
    y, x, z = (int(k) + half + 1 for k in key)
    patch = padded[y - half - 1 : y + half + 1, x - half - 1 : x + half + 1, z - half - 1 : z + half + 1]
    gradient = np.stack([np.gradient(patch, axis=a)[1:-1, 1:-1, 1:-1] for a in range(3)], axis=-1)
    side = gradient.shape[0]
    offset = np.indices((side,) * 3).reshape(3, -1).T - (side - 1) / 2
    weight = np.exp(-(offset**2).sum(axis=1) / (2 * (half / 1.5) ** 2))
    flat = gradient.reshape(-1, 3)
    size = np.linalg.norm(flat, axis=1)
    facing = (flat @ _DIRECTIONS.T).argmax(axis=1)
    cell = np.minimum(((offset + side / 2) / side * bins).astype(int), bins - 1)
    place = ((cell[:, 0] * bins + cell[:, 1]) * bins + cell[:, 2]) * len(_DIRECTIONS) + facing
    out = np.bincount(place, weights=size * weight, minlength=bins**3 * len(_DIRECTIONS))
    norm = np.linalg.norm(out)
    if norm == 0:
        return out.astype(np.int16)
    out = np.minimum(out / norm, clip)
    return np.minimum(np.rint(512 * out / np.linalg.norm(out)), 255).astype(np.int16)


BLOCK = ("by", "bx", "bz")


def spread_blocks(voxels: DataFrame, size: Sequence[int], halo: int) -> DataFrame:
    """Voxels with the numbers (by, bx, bz) of each block that holds them, or has them in its halo."""
    for a, n in zip("yxz", size):
        low, high = F.floor((F.col(a) - 1 - halo) / n), F.floor((F.col(a) - 1 + halo) / n)
        voxels = voxels.withColumn(f"b{a}", F.explode(F.sequence(low.cast("int"), high.cast("int"))))
    return voxels


def dense_block(
    group: pd.DataFrame, number: Sequence[int], size: Sequence[int], halo: int, fill: float, extent: Sequence[int] | None
) -> tuple[np.ndarray, np.ndarray]:
    """A block with its halo as an array, cut where the volume of ``extent`` ends, and the position of its first voxel."""
    origin = np.array(number) * np.array(size) + 1 - halo
    end = origin + np.array(size) + 2 * halo
    if extent is not None:
        origin, end = np.maximum(origin, 1), np.minimum(end, np.array(extent) + 1)
    block = np.full(np.maximum(end - origin, 0), fill)
    at = group[["y", "x", "z"]].to_numpy() - origin
    inside = ((at >= 0) & (at < block.shape)).all(axis=1)
    block[tuple(at[inside].T)] = group["value"].to_numpy()[inside]
    return block, origin


def _kinds(df: DataFrame, names: Sequence[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in names)


def _cells(voxels: DataFrame, *names: str) -> DataFrame:
    # aliases keep the columns of two tables of one origin apart
    return voxels.select(*(F.col(c).alias(c) for c in names), *(F.col(a).cast("int").alias(a) for a in "yxz"), F.col("value").cast("double").alias("value"))


def map_blocks(
    voxels: DataFrame, kernel: Kernel, size: tuple[int, int, int], halo: int, keys: Sequence[str] = (), fill: float = 0.0,
    extent: tuple[int, int, int] | None = None,
) -> DataFrame:
    """(keys, y, x, z, value): ``kernel`` over every block with its halo, the halo's own results left out.

    Absent voxels read ``fill``.  Beyond the volume's border the kernel sees ``fill``, too,
    unless ``extent`` (ny, nx, nz) is given: then its arrays end there and it pads by its own rule.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        number = np.array([group[b].iloc[0] for b in BLOCK])
        block, origin = dense_block(group, number, size, halo, fill, extent)
        at = group[["y", "x", "z"]].to_numpy()
        own = ((at - 1) // np.array(size) == number).all(axis=1)
        if extent is not None:
            own &= ((at >= 1) & (at <= np.array(extent))).all(axis=1)
        out = group.loc[own, [*keys, "y", "x", "z"]].copy()
        out["value"] = kernel(block)[tuple((at[own] - origin).T)] if own.any() else 0.0
        return out

    rows = _cells(spread_blocks(voxels, size, halo), *keys, *BLOCK)
    return rows.groupBy(*keys, *BLOCK).applyInPandas(run, f"{_kinds(voxels, keys)}y int, x int, z int, value double")


def corners(
    voxels: DataFrame, extent: tuple[int, int, int], size: tuple[int, int, int] = (128, 128, 32), keys: Sequence[str] = (), blur: int = 5,
    kappa: float = 1 / 27, quantile: float = 0.99, share: float = 0.01,
) -> DataFrame:
    """(keys, y, x, z, value): corners of every dense volume, as ``harris`` finds them in one array.

    Responses come block by block, each volume's quantile by one aggregation, the largest of a window axis by axis.
    """
    response = map_blocks(voxels, lambda b: harris_response(b, blur, kappa), size, blur // 2 + 2, keys, extent=extent)
    margin = int(0.1 * extent[2])
    if margin:
        response = response.withColumn("value", F.when(F.col("z").between(margin + 1, extent[2] - margin), F.col("value")).otherwise(0.0))
    response = keep(response)
    least = response.groupBy(*keys).agg((share * F.percentile("value", quantile)).alias("_least"))
    reach, top = harris_reach(blur), response.withColumn("_top", F.col("value"))
    for a in "yxz":
        line = W.partitionBy(*keys, *(b for b in "yxz" if b != a)).orderBy(a).rangeBetween(-reach, reach)
        top = top.withColumn("_top", F.max("_top").over(line))
    top = top.filter(F.col("value") == F.col("_top"))
    met = top.join(least, list(keys)) if keys else top.join(F.broadcast(least))
    return met.filter(F.col("value") > F.col("_least")).drop("_top", "_least")


def descriptors(
    points: DataFrame, voxels: DataFrame, extent: tuple[int, int, int], size: tuple[int, int, int] = (64, 64, 32), keys: Sequence[str] = (),
    half: int = 8, bins: int = 2, clip: float = 0.2,
) -> DataFrame:
    """(keys, y, x, z, ivec): the descriptor of every point, each computed in the block that holds it."""
    home = points.select(*(F.col(c).alias(c) for c in keys), *(F.col(a).cast("int").alias(a) for a in "yxz")).distinct()
    home = home.withColumns({f"b{a}": F.floor((F.col(a) - 1) / n).cast("int") for a, n in zip("yxz", size)})
    rows = _cells(spread_blocks(voxels, size, half + 1), *keys, *BLOCK).join(home.select(*keys, *BLOCK).distinct(), [*keys, *BLOCK], "left_semi")

    def run(own: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        number = [own[b].iloc[0] for b in BLOCK] if len(own) else []
        out = own[[*keys, "y", "x", "z"]].copy()
        if len(own):
            block, origin = dense_block(group, number, size, half + 1, 0.0, extent)
            places = own[["y", "x", "z"]].to_numpy() - origin
            out["ivec"] = [descriptor(block, p, half, bins, clip).astype(float).tolist() for p in places]
        else:
            out["ivec"] = []
        return out

    schema = f"{_kinds(points, keys)}y int, x int, z int, ivec array<double>"
    return home.groupBy(*keys, *BLOCK).cogroup(rows.groupBy(*keys, *BLOCK)).applyInPandas(run, schema)


def volume_shifts(
    base: DataFrame, move: DataFrame, by: Sequence[str], extent: tuple[int, int, int], shift: Callable[[np.ndarray, np.ndarray], Sequence[float]]
) -> DataFrame:
    """(by, dy, dx, dz): ``shift`` (such as ``phase_shift``) of the two volumes of each group; groups in one table only are left out.

    A transform needs its whole volume, so one task takes one pair of volumes.
    """

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame(columns=[*by, "dy", "dx", "dz"])
        one, two = (dense_block(g, (0, 0, 0), extent, 0, 0.0, extent)[0] for g in (a, b))
        found = shift(one, two)
        return pd.DataFrame([{c: a[c].iloc[0] for c in by} | {f"d{k}": float(v) for k, v in zip("yxz", found)}])

    pair = _cells(base, *by).groupBy(*by).cogroup(_cells(move, *by).groupBy(*by))
    return pair.applyInPandas(run, f"{_kinds(base, by)}dy double, dx double, dz double")


def otsu_threshold(voxels: DataFrame, bins: int = 256, value: str = "value") -> float | None:
    """Otsu's threshold of the positive values; only the histogram reaches the driver (None without such values)."""
    positive = voxels.filter(F.col(value) > 0)
    low, high = positive.agg(F.min(value), F.max(value)).first()
    if low is None:
        return None
    low, high = float(low), float(high)
    if high == low:
        return low
    step = (high - low) / bins
    place = F.least(F.floor((F.col(value) - low) / step), F.lit(bins - 1)).cast("int")
    counts = np.zeros(bins)
    for k, n in positive.groupBy(place.alias("k")).agg(F.count("*")).collect():
        counts[k] = n
    return otsu(counts, low + (np.arange(bins) + 0.5) * step)


def segment(voxels: DataFrame, keys: Sequence[str] = ("fov",), threshold: float | None = None) -> DataFrame:
    """(keys, y, x, z, value, label): watershed of the negated values above the threshold (Otsu's if None).

    One task floods one field of view, as basins may run through all of it.
    """
    cut = otsu_threshold(voxels) if threshold is None else threshold

    def run(group: pd.DataFrame) -> pd.DataFrame:
        at = group[["y", "x", "z"]].to_numpy() - group[["y", "x", "z"]].to_numpy().min(axis=0)
        block = np.zeros(at.max(axis=0) + 1)
        block[tuple(at.T)] = group["value"]
        labels = watershed(-block, block > (cut or 0.0))
        out = group[[*keys, "y", "x", "z", "value"]].copy()
        out["label"] = labels[tuple(at.T)]
        return out[out["label"] > 0]

    kinds = "".join(f"{k} {voxels.schema[k].dataType.simpleString()}, " for k in keys)
    rows = voxels.select(*keys, F.col("y").cast("int"), F.col("x").cast("int"), F.col("z").cast("int"), F.col("value").cast("double"))
    grouped = rows.groupBy(*keys) if keys else rows.groupBy(F.lit(0).alias("all"))
    return grouped.applyInPandas(run, f"{kinds}y int, x int, z int, value double, label long")


def upsample_z(voxels: DataFrame, factor: float, depth: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, y, x, z, value): every z line interpolated (pchip) to floor(depth * factor) planes; lines of zeros have none."""
    lines = voxels.groupBy(*keys, "y", "x").agg(F.sort_array(F.collect_list(F.struct("z", "value"))).alias("line"), F.max("value").alias("top"))
    planes = int(depth * factor)
    at = np.linspace(1, depth, planes) if planes > 1 else np.ones(1)

    def run(frames):
        for frame in frames:
            rows = []
            for own, line in zip(frame[[*keys, "y", "x"]].itertuples(index=False), frame["line"]):
                y = np.zeros(depth)
                for cell in line:
                    y[int(cell["z"]) - 1] = cell["value"]
                rows += [(*own, k + 1, float(v)) for k, v in enumerate(pchip(np.arange(1, depth + 1), y, at))]
            yield pd.DataFrame(rows, columns=[*keys, "y", "x", "z", "value"])

    kinds = "".join(f"{k} {voxels.schema[k].dataType.simpleString()}, " for k in keys)
    return lines.filter("top > 0").select(*keys, F.col("y").cast("int"), F.col("x").cast("int"), "line").mapInPandas(run, f"{kinds}y int, x int, z int, value double")
