"""Small maps, filters and counts between the stages."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scale_shift(shift: Column, rate: float) -> Column:
    """A shift found on a down-sampled image, in voxels of the full one (rounded half away from zero)."""
    return F.round(shift * rate)


def subtract_background(volume: DataFrame, background: DataFrame, keys: Sequence[str], least: int = 0, value: str = "value") -> DataFrame:
    """``volume`` less ``background``, ``least`` where the difference is lower; a voxel without background loses nothing."""
    under = background.select(*keys, F.col(value).alias("_under"))
    left = F.col(value) - F.coalesce("_under", F.lit(0))
    return volume.join(under, list(keys), "left").withColumn(value, F.greatest(left, F.lit(least))).drop("_under")


def job_round(job: Column, per_round: int) -> tuple[Column, Column]:
    """Round and place inside it of a job numbered from 1."""
    return F.ceil(job / per_round).cast("int"), (F.pmod(job - 1, F.lit(per_round)) + 1).cast("int")


def split_axis(size: int, chunk: int) -> list[tuple[int, int]]:
    """First and last index (from 1) of the chunks of an axis; a tail below half a chunk joins the chunk before it."""
    starts = list(range(1, size + 1, chunk))
    if len(starts) > 1 and 2 * (size - starts[-1] + 1) < chunk:
        starts.pop()
    return list(zip(starts, [s - 1 for s in starts[1:]] + [size]))


def chunk_of(index: Column, size: int, chunk: int) -> Column:
    """Number (from 0) of the chunk of ``split_axis`` that holds an index."""
    last = len(split_axis(size, chunk)) - 1
    return F.least(F.floor((index - 1) / chunk), F.lit(last)).cast("int")


def drop_zero_positions(reads: DataFrame, rate: float, axes: Sequence[str] = ("y", "x", "z")) -> DataFrame:
    """Reads none of whose down-sampled, rounded coordinates is 0."""
    for a in axes:
        reads = reads.filter(F.round(F.col(a) / rate) != 0)
    return reads


def inside_region(points: DataFrame, offset: Sequence[float], end: Sequence[float], axes: Sequence[str] = ("y", "x", "z")) -> DataFrame:
    """Points beyond the offset and up to the end on every axis."""
    for a, low, high in zip(axes, offset, end):
        points = points.filter((F.col(a) > low) & (F.col(a) <= high))
    return points


def downsample_labels(labels: DataFrame, planes: int, kept: int, axis: str = "z") -> DataFrame:
    """Labels at ``kept`` evenly spaced of ``planes`` planes, each from its nearest plane, so no new label arises."""
    nearest = [int(np.floor((k - 0.5) * planes / kept + 0.5)) or 1 for k in range(1, kept + 1)]
    spark = labels.sparkSession
    table = spark.createDataFrame([(p, k) for k, p in enumerate(nearest, 1)], "_plane int, _kept int")
    moved = labels.join(F.broadcast(table), F.col(axis) == F.col("_plane"))
    return moved.withColumn(axis, F.col("_kept")).drop("_plane", "_kept")


def average_count(rows: DataFrame, by: str) -> DataFrame:
    """One row: mean number of rows of a group (keypoints of a round)."""
    return rows.groupBy(by).agg(F.count("*").alias("n")).agg(F.avg("n").alias("average"))


def region_sizes(regions: DataFrame, by: Sequence[str], least: int = 1) -> DataFrame:
    """One row: smallest, largest and mean number of voxels of the regions of at least ``least``."""
    sizes = regions.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return sizes.agg(F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("average"))


def prefix_count(reads: DataFrame, prefix: Sequence[int], bases: str = "bases") -> DataFrame:
    """One row: reads, and those whose first calls are ``prefix``."""
    begins = F.slice(bases, 1, len(prefix)) == F.array(*(F.lit(b) for b in prefix)).cast("array<int>")
    return reads.agg(F.count("*").alias("reads"), F.count_if(begins).alias("with_prefix"))


def top_bins(histogram: DataFrame, by: Sequence[str], bin_: str, weight: str, n: int = 2, share: float = 0.8) -> DataFrame:
    """The highest bin of each histogram and, of the next up to ``n``, those of at least ``share`` of it; ties to the smaller bin."""
    order = W.partitionBy(*by).orderBy(F.desc(weight), bin_)
    ranked = histogram.withColumn("rank", F.row_number().over(order)).withColumn("_best", F.max(weight).over(W.partitionBy(*by)))
    return ranked.filter((F.col("rank") <= n) & (F.col(weight) >= share * F.col("_best"))).drop("_best")


def projection_difference(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("y", "x"), value: str = "value") -> DataFrame:
    """(keys, difference, absolute) of two projections; a pixel that one lacks is 0 there."""
    left, right = a.select(*keys, F.col(value).alias("_a")), b.select(*keys, F.col(value).alias("_b"))
    gap = F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0))
    return left.join(right, list(keys), "full").select(*keys, gap.alias("difference"), F.abs(gap).alias("absolute"))


def viewer_points(reads: DataFrame, colours: DataFrame, axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """One line a read for a point viewer: its position and its gene's colour; genes without one are left out."""
    joined = reads.join(F.broadcast(colours), "name")
    return joined.select(F.concat_ws(",", *(F.col(a).cast("string") for a in axes), "red", "green", "blue").alias("line"))


def rotation_matrix(axis: Sequence[float], angle: float) -> np.ndarray:
    """The 3 x 3 rotation about ``axis`` by ``angle``."""
    x, y, z = np.asarray(axis, float) / np.linalg.norm(axis)
    cross = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + np.sin(angle) * cross + (1 - np.cos(angle)) * cross @ cross


def leading_axis(points: DataFrame, axes: Sequence[str] = ("y", "x", "z")) -> np.ndarray:
    """Leading right singular vector of the points, its largest part positive; only their products are gathered."""
    pairs = [(i, k) for i in range(len(axes)) for k in range(i, len(axes))]
    row = points.agg(*(F.sum(F.col(axes[i]).cast("double") * F.col(axes[k])).alias(f"p{i}{k}") for i, k in pairs)).first()
    gram = np.zeros((len(axes), len(axes)))
    for i, k in pairs:
        gram[i, k] = gram[k, i] = row[f"p{i}{k}"] or 0.0
    vector = np.linalg.eigh(gram)[1][:, -1]
    return vector * np.sign(vector[np.abs(vector).argmax()])


def random_affine(seed: int, jitter: float = 0.05, shift: float = 5.0) -> np.ndarray:
    """A 3 x 4 transform near the identity, drawn by seed."""
    rng = np.random.default_rng(seed)
    return np.hstack([np.eye(3) + rng.uniform(-jitter, jitter, (3, 3)), rng.uniform(-shift, shift, (3, 1))])
