"""From pixel intensities to base calls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import CHANNELS, linear_percentile, midpoint_percentile


def channel_percentiles(
    pixels: DataFrame, keys: Sequence[str], values: Sequence[str] = CHANNELS, p: float = 0.9, method: str = "linear"
) -> DataFrame:
    """(keys, p1..pN): the percentile of each channel's pixels; ``linear`` runs over n - 1 steps, ``midpoint`` over n.

    The pixels of one punctum and round (one group of ``keys``) stand in arrays, one for each channel.
    """
    percentile = midpoint_percentile if method == "midpoint" else linear_percentile
    names = [f"p{k}" for k in range(1, len(values) + 1)]
    lists = pixels.groupBy(*keys).agg(*(F.sort_array(F.collect_list(F.col(v).cast("double"))).alias(n) for v, n in zip(values, names)))
    return lists.select(*keys, *(percentile(F.col(n), p).alias(n) for n in names))


def argmax_call(values: Sequence[Column]) -> Column:
    """Number of the largest channel, the first of equals; 0 if a channel is 0 or missing or all are equal."""
    array = F.array(*values)
    usable = ~F.exists(array, lambda v: v.isNull() | F.isnan(v.cast("double")) | (v == 0)) & (F.array_max(array) > F.array_min(array))
    return F.when(usable, F.array_position(array, F.array_max(array)).cast("int")).otherwise(0)


def base_calls(
    pixels: DataFrame, keys: Sequence[str] = ("puncta_id", "round"), values: Sequence[str] = CHANNELS, p: float = 0.9, method: str = "linear"
) -> DataFrame:
    """(keys, p1..pN, base): one call for each punctum and round; a missing key (null) is one, too.

    A missing pixel value (null) in any channel makes the call 0.
    """
    junk = pixels.filter(F.exists(F.array(*values), lambda v: v.isNull())).select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    called = channel_percentiles(pixels, keys, values, p, method).join(junk.withColumn("__junk", F.lit(True)), same, "left")
    base = argmax_call([F.col(f"p{k}") for k in range(1, len(values) + 1)])
    return called.withColumn("base", F.when(F.col("__junk"), 0).otherwise(base)).drop("__junk", *(f"__{k}" for k in keys))


def cutoff_calls(pixels: DataFrame, cutoffs: Sequence[float], keys: Sequence[str] = ("puncta_id", "round"), p: float = 0.99) -> DataFrame:
    """Calls from channels whose percentile tops its cut-off: the largest such channel, 0 if none does."""
    found = channel_percentiles(pixels, keys, CHANNELS, p)
    cut = [F.when(F.col(f"p{k}") > c, F.col(f"p{k}")).otherwise(0.0) for k, c in enumerate(cutoffs, 1)]
    array = F.array(*cut)
    return found.withColumn("base", F.when(F.array_max(array) > 0, F.array_position(array, F.array_max(array)).cast("int")).otherwise(0))


def bleed_correction(calls: DataFrame, fraction: float) -> DataFrame:
    """Call 1 becomes 2 where channel 2 is within ``fraction`` of channel 1's value below it (negative: off)."""
    if fraction < 0:
        return calls
    close = F.try_divide(F.abs(F.col("p2") - F.col("p1")), F.col("p2")) < fraction
    return calls.withColumn("base", F.when((F.col("base") == 1) & close, 2).otherwise(F.col("base")))


def assemble_reads(calls: DataFrame, rounds: int, key: str = "puncta_id") -> DataFrame:
    """(key, bases): calls of rounds 1..rounds in order, 0 where a round has none."""
    by_round = F.map_from_entries(F.collect_list(F.struct("round", "base")))
    one = calls.groupBy(key, "round").agg(F.max("base").alias("base"))
    return one.groupBy(key).agg(by_round.alias("m")).select(
        key, F.transform(F.sequence(F.lit(1), F.lit(rounds)), lambda r: F.coalesce(F.try_element_at("m", r), F.lit(0))).alias("bases")
    )


def complete_reads(reads: DataFrame) -> DataFrame:
    """Reads called in every round."""
    return reads.filter(F.forall("bases", lambda b: b > 0))


def base_percentages(calls: DataFrame, by: Sequence[str] = ("round",)) -> DataFrame:
    """(by, base, n, fraction): share of each base among calls above 0; a missing ``by`` (null) is a group, too."""
    counted = calls.filter(F.col("base") > 0).groupBy(*by, "base").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(*by))
    return counted.select(*by, "base", "n", (F.col("n") / total).alias("fraction"))


def entropy(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, entropy): Shannon entropy in bits of the values' frequencies."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    # H = log2 N - (1/N) sum n log2 n, so one further aggregate suffices
    n = F.sum("n")
    return counts.groupBy(*by).agg((F.log2(n) - F.sum(F.col("n") * F.log2(F.col("n"))) / n).alias("entropy"))
