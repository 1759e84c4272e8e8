"""Transforms from correspondences: affine least squares, RANSAC and thin-plate splines."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOVING, FIXED = ("my", "mx", "mz"), ("fy", "fx", "fz")
IDENTITY = (1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0)
#: Correspondences of one group that a robust fit takes into one task.
MOST_MATCHES = 200_000


def fit_affine(matches: DataFrame) -> list[float]:
    """The 3 x 4 transform (row major) from moving to fixed points of least squared error.

    The normal equations come from one aggregate; only their 4 x 4 solution is found on
    the driver.
    """
    terms = [*(F.col(c).cast("double") for c in MOVING), F.lit(1.0)]
    sums = {f"a{i}{j}": F.sum(terms[i] * terms[j]) for i in range(4) for j in range(i, 4)}
    sums |= {f"b{i}{k}": F.sum(terms[i] * F.col(FIXED[k])) for i in range(4) for k in range(3)}
    row = matches.agg(*(v.alias(k) for k, v in sums.items())).first()
    a = np.array([[row[f"a{min(i, j)}{max(i, j)}"] or 0.0 for j in range(4)] for i in range(4)])
    b = np.array([[row[f"b{i}{k}"] or 0.0 for k in range(3)] for i in range(4)])
    return np.linalg.lstsq(a, b, rcond=None)[0].T.ravel().tolist()


def fit_scale_shift(matches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, scale_*, shift_*): a scale and a shift for each axis by simple regression."""
    fits = []
    for axis, m, f in zip("yxz", MOVING, FIXED):
        fits += [F.regr_slope(f, m).alias(f"scale_{axis}"), F.regr_intercept(f, m).alias(f"shift_{axis}")]
    return matches.groupBy(*by).agg(*fits)


def _solve(moving: np.ndarray, fixed: np.ndarray, full: bool) -> np.ndarray:
    if full:
        return np.linalg.lstsq(np.column_stack([moving, np.ones(len(moving))]), fixed, rcond=None)[0].T
    out = np.zeros((3, 4))
    for k in range(3):
        (out[k, k], out[k, 3]), *_ = np.linalg.lstsq(np.column_stack([moving[:, k], np.ones(len(moving))]), fixed[:, k], rcond=None)
    return out


def ransac(
    moving: np.ndarray, fixed: np.ndarray, voxel: Sequence[float], reach: float = 2.0, seed: int = 0, sample: int = 6,
    least: int = 1000, most: int = 10_000, confidence: float = 0.99, full: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """The transform with most inliers over random samples, refitted on them, and the inliers' mask.

    An inlier lies within ``reach`` in units of ``voxel``.  Trials end once four inliers
    have been drawn together with the given confidence, after ``least`` at least; each
    better transform starts their count anew, so that no more than ``most`` follow the
    last one.
    """
    rng = np.random.default_rng(seed)
    n, best = len(moving), np.zeros(len(moving), bool)
    if n < sample:
        return np.array(IDENTITY).reshape(3, 4), best
    home = np.column_stack([moving, np.ones(n)])
    scale = np.asarray(voxel, float)
    trial, needed = 0, most
    while trial < min(max(needed, least), most):
        pick = rng.choice(n, sample, replace=False)
        guess = _solve(moving[pick], fixed[pick], full)
        inside = (((home @ guess.T - fixed) * scale) ** 2).sum(axis=1) <= reach**2
        if inside.sum() > best.sum():
            best = inside
            share = min(inside.mean(), 1 - 1e-9)
            needed = int(np.ceil(np.log(1 - confidence) / np.log(1 - share**4))) if share > 0 else most
            trial = 0
        trial += 1
    return (_solve(moving[best], fixed[best], full) if best.sum() >= 4 else np.array(IDENTITY).reshape(3, 4)), best


def fit_robust(
    matches: DataFrame, by: Sequence[str], voxel: Sequence[float] = (0.165, 0.165, 0.4), reach: float = 2.0,
    least_matches: int = 10, seed: int = 0, full: bool = True,
) -> DataFrame:
    """(by, matrix, n, inliers) for each group of at least ``least_matches``; every group has its own seeded draws.

    Correspondences of one group number some thousands (bounded by its keypoints);
    groups beyond MOST_MATCHES raise instead of silently thinning.
    """
    kept = matches.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least_matches)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) > MOST_MATCHES:
            raise ValueError(f"{len(group)} correspondences in one group")
        group = group.sort_values([*MOVING, *FIXED])
        matrix, inside = ransac(group[list(MOVING)].to_numpy(float), group[list(FIXED)].to_numpy(float), voxel, reach, seed, full=full)
        row = {c: group[c].iloc[0] for c in by} | {"matrix": matrix.ravel().tolist(), "n": len(group), "inliers": int(inside.sum())}
        return pd.DataFrame([row])

    kinds = ", ".join(f"{c} {matches.schema[c].dataType.simpleString()}" for c in by)
    rows = matches.join(kept, list(by), "left_semi").select(*by, *MOVING, *FIXED)
    return rows.groupBy(*by).applyInPandas(fit, f"{kinds}, matrix array<double>, n long, inliers long")


def warp_points(points: DataFrame, transforms: DataFrame, by: Sequence[str], size: tuple[int, int, int]) -> DataFrame:
    """Points moved by their group's matrix; those that leave the volume are dropped."""
    m = F.col("matrix")
    y, x, z = F.col("y"), F.col("x"), F.col("z")
    moved = [m[4 * k] * y + m[4 * k + 1] * x + m[4 * k + 2] * z + m[4 * k + 3] for k in range(3)]
    out = points.join(transforms.select(*by, "matrix"), list(by))
    out = out.select(*[c for c in points.columns if c not in "yxz"], *(e.alias(a) for e, a in zip(moved, "yxz")))
    return out.filter(F.col("y").between(1, size[0]) & F.col("x").between(1, size[1]) & F.col("z").between(1, size[2]))


class ThinPlate:
    """A 3-D thin-plate spline through control points (kernel: distance)."""

    def __init__(self, source: np.ndarray, target: np.ndarray):
        self.source = np.asarray(source, float)
        n = len(self.source)
        bend = np.linalg.norm(self.source[:, None] - self.source[None], axis=2)
        flat = np.column_stack([np.ones(n), self.source])
        system = np.block([[bend, flat], [flat.T, np.zeros((4, 4))]])
        self.weights = np.linalg.pinv(system) @ np.vstack([target, np.zeros((4, 3))])

    def __call__(self, points: np.ndarray) -> np.ndarray:
        bend = np.linalg.norm(points[:, None] - self.source[None], axis=2)
        return np.column_stack([bend, np.ones(len(points)), points]) @ self.weights


def warp_voxels_tps(voxels: DataFrame, spline: ThinPlate, size: tuple[int, int, int], value: str = "value") -> DataFrame:
    """Voxels scattered to the nearest position that the spline maps theirs to; the mean where several meet."""
    keys = [c for c in voxels.columns if c not in ("y", "x", "z", value)]
    names = [*keys, "y", "x", "z", value]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                points = np.column_stack([part.column(a).to_numpy().astype(float) for a in "yxz"])
                to = np.rint(spline(points)).astype(np.int32)
                inside = pa.array(((to >= 1) & (to <= np.array(size))).all(axis=1))
                columns = [*(part.column(k) for k in keys), *(pa.array(to[:, k]) for k in range(3)), part.column(value)]
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(inside)

    kinds = ", ".join(f"{c} {voxels.schema[c].dataType.simpleString()}" for c in keys)
    schema = f"{kinds + ', ' if kinds else ''}y int, x int, z int, {value} {voxels.schema[value].dataType.simpleString()}"
    return voxels.select(*names).mapInArrow(run, schema).groupBy(*keys, "y", "x", "z").agg(F.avg(value).alias(value))


def warp_voxels_affine(voxels: DataFrame, matrix: Sequence[float], size: tuple[int, int, int], value: str = "value") -> DataFrame:
    """The volume seen through the inverse transform: each target takes the linear mean of its eight source voxels.

    ``matrix`` maps source to target.  Sources outside the volume count 0.  Every source
    voxel gives its share to the targets whose preimage lies within one voxel of it, so
    the whole is one expansion and one pre-aggregated sum.
    """
    m = np.vstack([np.asarray(matrix, float).reshape(3, 4), [0, 0, 0, 1]])
    back = np.linalg.inv(m)
    # targets of a source voxel: around its image, as far as the transform stretches one voxel
    stretch = np.abs(m[:3, :3]).sum(axis=1) + 1e-9
    keys = [c for c in voxels.columns if c not in ("y", "x", "z", value)]
    spread = voxels
    for k, a in enumerate("yxz"):
        at = float(m[k, 0]) * F.col("y") + float(m[k, 1]) * F.col("x") + float(m[k, 2]) * F.col("z") + float(m[k, 3])
        spread = spread.withColumn(f"_t{a}", F.sequence(F.ceil(at - float(stretch[k])).cast("int"), F.floor(at + float(stretch[k])).cast("int")))
    for a, n in zip("yxz", size):
        spread = spread.withColumn(f"_t{a}", F.explode(f"_t{a}")).filter(F.col(f"_t{a}").between(1, n))
    share = F.lit(1.0)
    for k, a in enumerate("yxz"):
        origin = float(back[k, 0]) * F.col("_ty") + float(back[k, 1]) * F.col("_tx") + float(back[k, 2]) * F.col("_tz") + float(back[k, 3])
        share = share * F.greatest(F.lit(0.0), 1 - F.abs(origin - F.col(a)))
    spread = spread.withColumn("_share", share).filter("_share > 0")
    return spread.groupBy(*keys, *(F.col(f"_t{a}").alias(a) for a in "yxz")).agg(F.sum(F.col(value) * F.col("_share")).alias(value))
