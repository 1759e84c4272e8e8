"""Connected regions of voxels and the reads assembled from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.tables import keep

AXES = ("y", "x", "z")
_BITS = 21


def place() -> Column:
    """A voxel's position as one number, in the order of (y, x, z); each coordinate has 21 bits."""
    y, x, z = (F.col(a).cast("long") for a in AXES)
    return F.shiftleft(y, 2 * _BITS) + F.shiftleft(x, _BITS) + z


def connected(voxels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, y, x, z, region): 6-connected regions of voxels that agree in ``by``, named by their first ``place``.

    Every pass takes the least name along each unbroken line of an axis, then lets all
    voxels of one name take the least that any of them met, so names travel by whole
    regions and not by voxels.  Voxels listed twice count once; nulls in ``by`` are a value.
    """
    now = keep(voxels.select(*by, *AXES).distinct().withColumn("region", place()))
    while True:
        after = now.withColumnRenamed("region", "_old").withColumn("region", F.col("_old"))
        for axis in AXES:
            rest = [*by, *(a for a in AXES if a != axis)]
            island = F.col(axis) - F.row_number().over(W.partitionBy(*rest).orderBy(axis))
            after = after.withColumn("_island", island).withColumn("region", F.min("region").over(W.partitionBy(*rest, "_island"))).drop("_island")
        after = keep(after)
        # names that met a smaller one; a name belongs to one region, so it alone is the key
        better = after.groupBy("_old", *by).agg(F.min("region").alias("_best")).filter(F.col("_best") < F.col("_old"))
        better = better.select(F.col("_old").alias("_name"), *(F.col(c).alias(f"_by{k}") for k, c in enumerate(by)), "_best")
        if better.isEmpty():
            return after.drop("_old")
        same = F.col("_old") == F.col("_name")
        for k, c in enumerate(by):
            same = same & F.col(c).eqNullSafe(F.col(f"_by{k}"))
        least = F.least("region", F.coalesce("_best", "region"))
        now = keep(after.join(better, same, "left").select(*by, *AXES, least.alias("region")))


def voxel_codes(calls: DataFrame, first: int, base: str = "base") -> DataFrame:
    """(y, x, z, code): the bases of a voxel's rounds as one decimal number, round ``first`` at the ones; 0 where none is called."""
    digit = F.coalesce(F.col(base), F.lit(0)).cast("long") * F.pow(F.lit(10.0), F.col("round") - first).cast("long")
    return calls.filter(F.col("round") >= first).groupBy(*AXES).agg(F.sum(digit).alias("code"))


def region_reads(codes: DataFrame, least: int = 1) -> DataFrame:
    """(region, code, n_voxels, cy, cx, cz): 6-connected regions of equal code other than 0, of at least ``least`` voxels."""
    found = connected(codes.filter("code <> 0"), ["code"])
    means = [F.avg(a).alias(f"c{a}") for a in AXES]
    return found.groupBy("region", "code").agg(F.count("*").alias("n_voxels"), *means).filter(F.col("n_voxels") >= least)
