"""Simulated experiments; every random number is a function of the seed and the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def uniform(seed: int, *keys: Column | str) -> Column:
    """A number in [0, 1) from the md5 of seed and keys, alike in every engine and partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / float(16**8)


def normal(seed: int, *keys: Column | str) -> Column:
    """A standard normal number by the polar form."""
    radius = F.sqrt(-2 * F.log(1 - uniform(seed, *keys, F.lit("r"))))
    return radius * F.cos(2 * 3.141592653589793 * uniform(seed, *keys, F.lit("t")))


def puncta(spark: SparkSession, n: int, size: tuple[int, int, int], seed: int) -> DataFrame:
    """(puncta_id, y, x, z): random positions from 1 to size."""
    at = [(1 + uniform(seed, "id", F.lit(a)) * (s - 1)).alias(a) for a, s in zip("yxz", size)]
    return spark.range(n).select(F.col("id").alias("puncta_id"), *at)


def grid_puncta(spark: SparkSession, size: tuple[int, int, int], step: int) -> DataFrame:
    """Positions on a grid, numbered from 0."""
    ny, nx, nz = (max(0, (s - 1) // step) for s in size)
    i = F.col("id")
    at = [F.floor(i / (nx * nz)) + 1, F.floor(i / nz) % nx + 1, i % nz + 1]
    return spark.range(ny * nx * nz).select(i.alias("puncta_id"), *((c * step).cast("double").alias(a) for a, c in zip("yxz", at)))


def assign_codes(places: DataFrame, codebook: DataFrame, seed: int) -> DataFrame:
    """``places`` with a code drawn for each from a codebook of code_id 0..K-1."""
    k = codebook.count()
    drawn = places.withColumn("code_id", F.floor(uniform(seed, "puncta_id", F.lit("code")) * k).cast("long"))
    return drawn.join(codebook.select("code_id", "name", "codes"), "code_id")


def render(
    truth: DataFrame, rounds: int, size: tuple[int, int, int], sigma: tuple[float, float, float] = (1.5, 1.5, 2.5), reach: int = 4,
    crosstalk: Sequence[Sequence[float]] | None = None, brightness: float = 1000.0, seed: int = 0,
) -> DataFrame:
    """(round, channel, y, x, z, value): Gaussian blobs with jittered sizes, mixed between channels, clipped at the border."""
    mix = crosstalk or [[1.0 if a == b else 0.0 for b in range(4)] for a in range(4)]
    lit = truth.select("puncta_id", "y", "x", "z", F.posexplode("codes").alias("r", "base")).filter(F.col("r") < rounds).filter("base > 0")
    jitter = 0.8 + 0.4 * uniform(seed, "puncta_id", F.lit("size"))
    grown = lit.withColumn("_j", jitter)
    for a, n in zip("yxz", size):
        low, high = F.greatest(F.round(a).cast("int") - reach, F.lit(1)), F.least(F.round(a).cast("int") + reach, F.lit(n))
        grown = grown.withColumn(f"_{a}", F.explode(F.sequence(low, high)))
    fall = sum((((F.col(f"_{a}") - F.col(a)) / (s * F.col("_j"))) ** 2 for a, s in zip("yxz", sigma)), F.lit(0.0))
    glow = grown.select((F.col("r") + 1).alias("round"), "base", *(F.col(f"_{a}").alias(a) for a in "yxz"), (brightness * F.exp(-fall / 2)).alias("g"))
    table = F.array(*(F.array(*map(F.lit, row)) for row in mix))
    spread = glow.select("round", "y", "x", "z", "g", F.posexplode(F.element_at(table, F.col("base"))).alias("c", "share")).filter("share > 0")
    return spread.groupBy("round", (F.col("c") + 1).alias("channel"), "y", "x", "z").agg(F.sum(F.col("g") * F.col("share")).alias("value"))


def add_noise(voxels: DataFrame, background: float, mean: float = 10.0, deviation: float = 5.0, seed: int = 0) -> DataFrame:
    """Voxels with background and normal noise, not below 0."""
    noise = mean + deviation * normal(seed, "round", "channel", "y", "x", "z")
    return voxels.withColumn("value", F.greatest(F.lit(0.0), F.col("value") + background + noise))


def drift(truth: DataFrame, rounds: int, deviation: float, limit: float, seed: int, reference: int = 1) -> DataFrame:
    """(round, puncta...) with each round but the reference moved by a clamped random shift."""
    out = truth.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    for a in "yxz":
        shift = F.greatest(F.lit(-limit), F.least(F.lit(limit), deviation * normal(seed, "round", F.lit(a))))
        out = out.withColumn(a, F.when(F.col("round") == reference, F.col(a)).otherwise(F.col(a) + shift))
    return out


def recovery(truth: DataFrame, found: DataFrame) -> DataFrame:
    """(name, n_truth, n_found): simulated and recovered counts on the union of genes."""
    a = truth.groupBy("name").agg(F.count("*").alias("n_truth"))
    b = found.groupBy("name").agg(F.count("*").alias("n_found"))
    return a.join(b, "name", "full").fillna(0, ["n_truth", "n_found"])
