"""Relational operators over puncta, their voxels and pixels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import CHANNELS, euclid
from .normalize import melt


def gather_pixels(puncta_voxels: DataFrame, voxels: DataFrame, on: Sequence[str] = ("y", "x", "z"), small: bool = False) -> DataFrame:
    """Volume values at every punctum voxel, round and channel; voxels without a value read 0.

    ``puncta_voxels``: puncta_id and position; ``voxels``: position, round, channels.
    ``small``: the puncta voxels' size has been checked and allows a broadcast.
    """
    rounds = voxels.select("round").distinct()
    wanted = puncta_voxels.join(F.broadcast(rounds))
    side = F.broadcast(wanted) if small else wanted
    return side.join(voxels, [*on, "round"], "left").select(
        "puncta_id", *on, "round", *(F.coalesce(c, F.lit(0)).alias(c) for c in CHANNELS)
    )


def filter_by_size(puncta: DataFrame, least: int = 30, most: int = 2000, size: str = "n_voxels") -> DataFrame:
    """Puncta of least..most voxels, both ends included."""
    return puncta.filter(F.col(size).between(least, most))


def guard_count(puncta: DataFrame, n_voxels: int, edge: int = 10) -> DataFrame:
    """``puncta``; raises where there are more than one for each cube of ``edge`` voxels."""
    most = n_voxels / edge**3
    count = puncta.count()
    if count > most:
        raise ValueError(f"{count} puncta in a volume that holds {most:g} at most")
    return puncta


def signal_complete(pixels: DataFrame, max_missing: int = 2, skip_round: int | None = None) -> DataFrame:
    """(puncta_id, missing): puncta with at most ``max_missing`` rounds whose channels all have median 0."""
    rows = pixels if skip_round is None else pixels.filter(F.col("round") != skip_round)
    by_round = rows.groupBy("puncta_id", "round").agg(
        sum(((F.percentile(c, 0.5) == 0).cast("int") for c in CHANNELS), F.lit(0)).alias("zero")
    )
    missing = F.sum((F.col("zero") > 3).cast("int"))
    return by_round.groupBy("puncta_id").agg(missing.alias("missing")).filter(F.col("missing") <= max_missing)


def drop_artifacts(pixels: DataFrame, channels: Sequence[str] = CHANNELS, limit: float = 1000) -> DataFrame:
    """Puncta ids without any round in which all monitored channels' means top ``limit``."""
    by_round = pixels.groupBy("puncta_id", "round").agg(*(F.avg(c).alias(c) for c in channels))
    bright = F.least(*(F.col(c) for c in channels)) > limit if len(channels) > 1 else F.col(channels[0]) > limit
    return by_round.groupBy("puncta_id").agg(F.bool_or(bright).alias("bad")).filter(~F.col("bad")).select("puncta_id")


def apply_filter(reads: DataFrame, keep: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The user's filter, a function from reads to reads; none keeps all."""
    return reads if keep is None else keep(reads)


def nonzero_mask(pixels: DataFrame, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Pixels with a signal in every channel."""
    return pixels.filter(F.least(*(F.col(c) for c in channels)) > 0)


def junk_mask(pixels: DataFrame, thresholds: Sequence[float], most: int, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Pixels with fewer than ``most`` channels above their thresholds."""
    above = sum(((F.col(c) > t).cast("int") for c, t in zip(channels, thresholds)), F.lit(0))
    return pixels.filter(above < most)


def channel_stats(pixels: DataFrame, keys: Sequence[str] = ("puncta_id", "round"), channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Median and maximum of each channel: med1.., max1.. ."""
    stats = [f(c).alias(f"{name}{k}") for k, c in enumerate(channels, 1) for name, f in (("med", F.median), ("max", F.max))]
    return pixels.groupBy(*keys).agg(*stats)


def top_mean(pixels: DataFrame, n: int, keys: Sequence[str] = ("puncta_id", "round"), channels: Sequence[str] = CHANNELS) -> DataFrame:
    """(keys, channel, top): mean of the ``n`` brightest pixels of each channel (all, if fewer)."""
    long = melt(pixels, keys, channels)
    rank = F.row_number().over(W.partitionBy(*keys, "channel").orderBy(F.desc("value")))
    return long.withColumn("rank", rank).filter(F.col("rank") <= n).groupBy(*keys, "channel").agg(F.avg("value").alias("top"))


def centroids(voxels: DataFrame, key: str = "puncta_id", weight: Column | None = None) -> DataFrame:
    """(key, n_voxels, cy, cx, cz): means of the positions, weighted by intensity if ``weight`` is given."""
    if weight is None:
        means = [F.avg(a).alias(f"c{a}") for a in "yxz"]
    else:
        means = [F.try_divide(F.sum(F.col(a) * weight), F.sum(weight)).alias(f"c{a}") for a in "yxz"]
    return voxels.groupBy(key).agg(F.count("*").alias("n_voxels"), *means)


def label_puncta(voxels: DataFrame, index: str = "lin_idx", weight: str = "value", key: str = "label") -> DataFrame:
    """One row for each label: weighted centroid and the sorted list of its voxels."""
    found = centroids(voxels, key, F.col(weight))
    lists = voxels.groupBy(key).agg(F.sort_array(F.collect_list(index)).alias("voxels"))
    return found.join(lists, key)


def correlated_mean(traces: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(peak, corr_sum, n): per peak, the summed value of neighbours whose traces correlate above ``threshold``.

    ``traces``: id, step, value; ``pairs``: peak, neighbour.
    """
    a = traces.select(F.col("id").alias("peak"), "step", F.col("value").alias("pv"))
    b = traces.select(F.col("id").alias("neighbour"), "step", F.col("value").alias("nv"))
    joined = pairs.join(a, "peak").join(b, ["neighbour", "step"])
    each = joined.groupBy("peak", "neighbour").agg(F.corr("pv", "nv").alias("r"), F.sum("nv").alias("s"))
    good = F.col("r") > threshold
    return each.groupBy("peak").agg(F.sum(F.when(good, F.col("s")).otherwise(0)).alias("corr_sum"), F.count_if(good).alias("n"))


def sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` rows without replacement: those of the least hashes of (seed, key)."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key)).cast("binary"))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def near_points(points: DataFrame, centre: tuple[float, float, float], radius: float) -> DataFrame:
    """Points within ``radius`` of ``centre``, the rim included."""
    return points.filter(euclid([F.col(a) for a in "yxz"], [F.lit(v) for v in centre]) <= radius)


def brightest_peaks(peaks: DataFrame, n_voxels: int, threshold: float, least_volume: float) -> DataFrame:
    """Peaks above ``threshold``; if there are more than one for ``least_volume`` voxels, those above the N-th brightest.

    N is how many peaks the volume holds.
    """
    found = peaks.filter(F.col("value") > threshold)
    most = int(n_voxels // least_volume)
    nth = found.orderBy(F.desc("value")).limit(most).agg(F.min("value").alias("cut"), F.count("*").alias("kept"))
    total = found.agg(F.count("*").alias("total"))
    limits = nth.join(total)
    crowded = F.col("total") > most
    return found.join(F.broadcast(limits)).filter(~crowded | (F.col("value") > F.col("cut"))).drop("cut", "kept", "total")
