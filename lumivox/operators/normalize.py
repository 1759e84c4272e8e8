"""Quantile normalisation and its kin.

Ranks are taken on value histograms: one pre-aggregated pass counts each value of each
channel, and everything about ranks happens on those counts.  Stored intensities have
at most 65,536 values, so the ranked tables stay small however many voxels there are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import CHANNELS

#: Up to this many (group, channel, value) rows the normalised values are broadcast; beyond, they join by shuffle.
BROADCAST_VALUES = 500_000


def melt(pixels: DataFrame, keys: Sequence[str], channels: Sequence[str] = CHANNELS) -> DataFrame:
    """(keys, channel number from 1, value): one row for each channel."""
    return pixels.select(*keys, F.posexplode(F.array(*channels)).alias("pos", "value")).select(
        *keys, (F.col("pos") + 1).alias("channel"), "value"
    )


def rank_values(pixels: DataFrame, by: Sequence[str], channels: Sequence[str] = CHANNELS, ties: str = "median") -> DataFrame:
    """(by, channel, value, norm): the value that quantile normalisation gives each value of each channel.

    The k-th smallest values of all channels are averaged; a value takes the average of
    its rank.  A run of equal values takes the median of its ranks' averages
    (``ties="median"``) or their mean (``ties="mean"``).
    """
    by, n = list(by), len(channels)
    counts = melt(pixels, by, channels).groupBy(*by, "channel", "value").agg(F.count("*").alias("n"))
    order = W.partitionBy(*by, "channel").orderBy("value")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    runs = counts.withColumn("end", F.sum("n").over(upto)).withColumn("begin", F.col("end") - F.col("n"))
    runs = runs.withColumn("below", F.sum(F.col("n") * F.col("value")).over(upto) - F.col("n") * F.col("value"))
    if ties == "median":
        ranks = F.array(F.floor((F.col("begin") + F.col("end") - 1) / 2), F.floor((F.col("begin") + F.col("end")) / 2))
    else:
        ranks = F.array(F.col("begin"), F.col("end"))
    probes = runs.select(*by, F.col("channel").alias("own"), F.col("value").alias("own_value"), F.explode(ranks).alias("rank"))
    probes = probes.distinct().withColumn("channel", F.explode(F.sequence(F.lit(1), F.lit(n))))
    # each probe meets the run of the other channel that its rank falls in: the last run that begins at or before it
    steps = runs.select(*by, "channel", F.col("begin").alias("rank"), F.struct("value", "below", "begin").alias("run"))
    asof = W.partitionBy(*by, "channel").orderBy("rank", F.col("run").isNull()).rowsBetween(W.unboundedPreceding, 0)
    met = (
        steps.unionByName(probes.withColumn("run", F.lit(None)), allowMissingColumns=True)
        .withColumn("found", F.last("run", ignorenulls=True).over(asof))
        .filter(F.col("own").isNotNull())
    )
    if ties == "median":
        at_rank = met.groupBy(*by, "own", "own_value", "rank").agg((F.sum("found.value") / n).alias("mean"))
        norm = at_rank.groupBy(*by, "own", "own_value").agg(F.avg("mean").alias("norm"))
    else:  # sums of the sorted values below both ends of the run
        below = F.col("found.below") + (F.col("rank") - F.col("found.begin")) * F.col("found.value")
        sums = met.groupBy(*by, "own", "own_value", "rank").agg(F.sum(below).alias("total"))
        norm = sums.groupBy(*by, "own", "own_value").agg(
            ((F.max("total") - F.min("total")) / (F.max("rank") - F.min("rank")) / n).alias("norm")
        )
    return norm.withColumnsRenamed({"own": "channel", "own_value": "value"})


def quantile_normalize(
    pixels: DataFrame, by: Sequence[str], channels: Sequence[str] = CHANNELS, ties: str = "median", small: bool | None = None
) -> DataFrame:
    """``pixels`` with norm1..normN, normalised within each group of ``by`` (all rows together if empty).

    ``small``: whether the table of values may be broadcast; None counts it first.
    """
    by = list(by)
    values = rank_values(pixels, by, channels, ties)
    if small is None:
        small = values.count() <= BROADCAST_VALUES
    out = pixels
    for k, channel in enumerate(channels, 1):
        own = values.filter(F.col("channel") == k).select(
            *(F.col(c).alias(f"_{c}") for c in by), F.col("value").alias("_value"), F.col("norm").alias(f"norm{k}")
        )
        match = F.col(channel) == F.col("_value")
        for c in by:
            match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
        out = out.join(F.broadcast(own) if small else own, match, "left").drop("_value", *(f"_{c}" for c in by))
    return out


def zscore(df: DataFrame, value: str, by: Sequence[str], mask: Column | None = None) -> DataFrame:
    """``df`` with ``z``: deviation from the group's mean in sample standard deviations, over rows where ``mask`` holds."""
    kept = F.col(value) if mask is None else F.when(mask, F.col(value))
    stats = df.groupBy(*by).agg(F.avg(kept).alias("_mean"), F.stddev_samp(kept).alias("_std"))
    z = F.try_divide(kept - F.col("_mean"), F.col("_std"))
    return df.join(stats, list(by)).withColumn("z", z).drop("_mean", "_std")


def exponential_cutoff(df: DataFrame, channels: Sequence[str] = CHANNELS, factor: float = 2.0) -> DataFrame:
    """One row: ``factor`` times the mean of each channel (the scale of a fitted exponential)."""
    return df.agg(*((factor * F.avg(c)).alias(f"cut_{c}") for c in channels))


def whiten(pixels: DataFrame, channels: Sequence[str] = CHANNELS, epsilon: float = 1e-4) -> DataFrame:
    """``pixels`` with white1..whiteN: centred and decorrelated channels.

    One aggregate gives means and products of all channel pairs; the small eigenproblem
    is solved on the driver and applied as linear expressions.
    """
    n = len(channels)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    row = pixels.agg(
        F.count("*").alias("rows"),
        *(F.avg(c).alias(f"m{i}") for i, c in enumerate(channels)),
        *(F.sum(F.col(channels[i]).cast("double") * F.col(channels[j])).alias(f"p{i}_{j}") for i, j in pairs),
    ).first()
    rows = row["rows"]
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(n)])
    gram = np.zeros((n, n))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = (row[f"p{i}_{j}"] or 0.0) - rows * mean[i] * mean[j]
    size, vectors = np.linalg.eigh(gram)
    matrix = np.sqrt(max(rows - 1, 0)) * vectors @ np.diag(1 / np.sqrt(np.maximum(size, 0) + epsilon)) @ vectors.T
    out = pixels
    for j in range(n):
        terms = [(F.col(c) - float(mean[i])) * float(matrix[i, j]) for i, c in enumerate(channels)]
        out = out.withColumn(f"white{j + 1}", sum(terms[1:], terms[0]))
    return out
