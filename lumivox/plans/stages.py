"""Stages composed of the operators: segmentation, spot calling, channel masks and registration.

Each is a function of tables; ``segmentation_stages`` names the first for the stage runner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.tables import keep
from ..operators import kernels, maps, match, normalize, puncta, register, volume

Size = tuple[int, int, int]
AXES = volume.AXES


def usable_volume(voxels: DataFrame, max_zeros: int = 0, percentile: float = 0.999) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """The clamped rounds summed over all (fov, y, x, z, value), voxels with too many empty rounds 0, cropped; and the bounds.

    All fields of view are cropped alike.  Without any usable voxel the result has no rows and no bounds.
    """
    clamped = volume.clamp_percentile(voxels, ["fov", "round"], percentile)
    counts = keep(volume.zero_counts(volume.sum_channels(clamped, ["fov", "round", *AXES]), ["fov", *AXES]))
    ends = volume.crop_bounds(counts, max_zeros).first()
    summed = counts.select("fov", *AXES, F.when(F.col("zeros") <= max_zeros, F.col("total")).otherwise(0).cast("double").alias("value"))
    if ends["y0"] is None:
        return summed.limit(0), {}
    bounds = {a: (ends[f"{a}0"], ends[f"{a}1"]) for a in AXES}
    return volume.crop(summed, bounds), bounds


def segmentation(
    voxels: DataFrame, background: DataFrame | None = None, max_zeros: int = 0, least: int = 30, most: int = 2000, block: Size = (128, 128, 64),
    smooth: tuple[int, float, float] = (6, 3.0, 4.0), percentile: float = 0.999,
) -> tuple[DataFrame, DataFrame]:
    """Puncta of (fov, round, channel, y, x, z, value): (puncta, their voxels).

    Rounds are clamped and summed, empty voxels masked, the usable box cropped, the
    background (fov, y, x, z, value; counted as the input) taken off, differences of
    Gaussians thresholded after Otsu, basins flooded, and regions outside least..most
    voxels dropped.  Positions count as those of the input.
    """
    summed, bounds = usable_volume(voxels, max_zeros, percentile)
    extent = tuple(high - low + 1 for low, high in bounds.values()) if bounds else (1, 1, 1)
    if background is not None and bounds:
        summed = maps.subtract_background(summed, volume.crop(background, bounds), ["fov", *AXES])
    size, narrow, wide = smooth
    sharp = keep(kernels.map_blocks(summed, lambda b: kernels.dog(b, size, narrow, wide), block, size, ["fov"], extent=extent))
    found = keep(volume.uncrop(kernels.segment(sharp.filter("value > 0"), ["fov"], kernels.otsu_threshold(sharp)), bounds))
    sizes = found.groupBy("fov", "label").agg(F.count("*").alias("n_voxels"), *(F.avg(a).alias(f"c{a}") for a in AXES))
    kept = puncta.filter_by_size(sizes, least, most)
    return kept, found.join(kept.select("fov", "label"), ["fov", "label"], "left_semi")


def segmentation_stages() -> list:
    """Segmentation for ``runner.Pipeline``, after a stage that leaves a table ``voxels``."""

    def run(spark, tables, params):
        regions, cells = segmentation(tables["voxels"])
        return {"puncta": regions, "puncta_voxels": cells}

    return [("segmentation", ("puncta", "puncta_voxels"), run)]


def spots(volume_: DataFrame, channels: DataFrame, extent: Size, before: int = 5, after: int = 5, threshold: float = 0.0) -> DataFrame:
    """(fov, y, x, z, round, channel, intensity, n_peak): mean intensities of the boxes around strict maxima above ``threshold``.

    ``volume_``: (fov, y, x, z, value), one row a voxel; ``channels``: (fov, round, channel,
    y, x, z, value).  ``n_peak`` counts the voxels of the box that there are.
    """
    peaks = volume.local_maxima(volume_, extent, ["fov"]).filter(F.col("value") > threshold).select("fov", *AXES)
    boxes = peaks
    for a, n in zip(AXES, extent):
        low, high = F.greatest(F.col(a) - before, F.lit(1)), F.least(F.col(a) + after, F.lit(n))
        boxes = boxes.withColumn(f"_{a}", F.explode(F.sequence(low.cast("int"), high.cast("int"))))
    seen = channels.select("fov", "round", "channel", *(F.col(a).alias(f"_{a}") for a in AXES), "value")
    met = boxes.join(seen, ["fov", "_y", "_x", "_z"])
    return met.groupBy("fov", *AXES, "round", "channel").agg(F.avg("value").alias("intensity"), F.count("*").alias("n_peak"))


def channel_regions(voxels: DataFrame, extent: Size, block: Size = (128, 128, 64), least: int = 1, smooth: tuple[int, float, float] = (6, 3.0, 4.0)) -> DataFrame:
    """(round, channel, y, x, z, label): watershed of every channel over the voxels that it wins.

    A channel's differences of Gaussians are z-scored over its positive part; a voxel is
    won by the channel of the highest score (the smaller channel of equals), and only
    scores above 0 take part.
    """
    size, narrow, wide = smooth
    keys = ["round", "channel"]
    sharp = keep(kernels.map_blocks(voxels, lambda b: kernels.dog(b, size, narrow, wide), block, size, keys, extent=extent).filter("value > 0"))
    # the score is named z, as the third coordinate is
    scored = normalize.zscore(sharp.withColumnRenamed("z", "_z"), "value", keys).drop("value").withColumnsRenamed({"z": "value", "_z": "z"})
    rank = F.row_number().over(W.partitionBy("round", *AXES).orderBy(F.desc("value"), "channel"))
    won = scored.filter("value > 0").withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    found = keep(kernels.segment(won, keys, 0.0))
    sizes = found.groupBy(*keys, "label").agg(F.count("*").alias("_n")).filter(F.col("_n") >= least)
    return found.join(sizes.select(*keys, "label"), [*keys, "label"], "left_semi").select(*keys, *AXES, "label")


def registration(
    fixed: DataFrame, moving: DataFrame, extent: Size, block: Size = (64, 64, 32), ratio: float = 1.5, half: int = 8, blur: int = 5,
    voxel: Sequence[float] = (0.165, 0.165, 0.4), reach: float = 2.0, seed: int = 0, full: bool = True,
) -> DataFrame:
    """(fov, matrix, n, inliers): the transform from ``moving`` to ``fixed`` volumes (fov, y, x, z, value) of each field of view.

    Corners, their descriptors, nearest descriptors by ratio without ambiguous ones, then a robust fit.
    Matching meets a field's keypoints only with each other; fields without matches enough have no row.
    """
    keys = ["fov"]
    sides = []
    for side in (fixed, moving):
        points = kernels.corners(side, extent, block, keys, blur)
        vectors = kernels.descriptors(points, side, extent, block, keys, half)
        number = F.concat_ws(":", "fov", *AXES)
        sides.append(keep(vectors.withColumn("key_id", F.xxhash64(number))))
    home, away = sides
    near = match.drop_ambiguous(match.ratio_test(match.two_nearest(away, home, by=keys), ratio))
    pairs = near.select("m_id", "f_id")
    start = away.select(F.col("key_id").alias("m_id"), "fov", *(F.col(a).cast("double").alias(c) for a, c in zip(AXES, register.MOVING)))
    end = home.select(F.col("key_id").alias("f_id"), *(F.col(a).cast("double").alias(c) for a, c in zip(AXES, register.FIXED)))
    return register.fit_robust(pairs.join(start, "m_id").join(end, "f_id"), keys, voxel, reach, seed=seed, full=full)
