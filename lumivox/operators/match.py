"""Nearest neighbours of descriptors and points, and what is kept of the matches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import euclid
from ..functions.tables import keep

#: Fixed descriptors of a block; queries meet the blocks one at a time.
FIXED_BLOCK = 4096


def two_nearest(moving: DataFrame, fixed: DataFrame, vector: str = "ivec", key: str = "key_id", by: Sequence[str] = ()) -> DataFrame:
    """(m_id, f_id, d1, d2): the nearest fixed descriptor of each moving one and the two least squared distances.

    Both sides are packed into blocks; each pair of blocks is a task row that a matrix
    product answers, and only two candidates a descriptor and block travel on.  Ties go
    to the smaller id; d2 is null where there is one fixed descriptor only.  With ``by``
    descriptors meet those of their own group; keys are unique over all groups.
    """

    def packed(df: DataFrame, name: str) -> DataFrame:
        largest = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        blocks = max(1, -(-largest // FIXED_BLOCK))
        spread = df.select(*by, F.col(key).cast("long").alias("id"), F.transform(vector, lambda v: v.cast("double")).alias("v"))
        spread = spread.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(blocks)))
        return spread.groupBy(*by, name).agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias(f"rows_{name}")), blocks

    left, n_left = packed(moving, "m")
    right, _ = packed(fixed, "f")
    pairs = right.withColumn("m", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_left - 1).cast("long")))).join(left, [*by, "m"])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("rows_m").to_pylist(), batch.column("rows_f").to_pylist()):
                x, y = (np.array([r["v"] for r in side]) for side in (a, b))
                ids = np.array([r["id"] for r in b])
                d = np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)
                order = np.argsort(d, axis=1, kind="stable")[:, :2]
                m = np.repeat([r["id"] for r in a], order.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m, pa.int64()), pa.array(ids[order].ravel()), pa.array(np.take_along_axis(d, order, 1).ravel())],
                    names=["m_id", "f_id", "d"],
                )

    found = pairs.select("rows_m", "rows_f").mapInArrow(nearest, "m_id long, f_id long, d double")
    rank = F.row_number().over(W.partitionBy("m_id").orderBy("d", "f_id"))
    best = found.withColumn("rank", rank).filter("rank <= 2")
    return best.groupBy("m_id").agg(
        F.max(F.when(F.col("rank") == 1, F.col("f_id"))).alias("f_id"),
        F.max(F.when(F.col("rank") == 1, F.col("d"))).alias("d1"),
        F.max(F.when(F.col("rank") == 2, F.col("d"))).alias("d2"),
    )


def ratio_test(matches: DataFrame, ratio: float = 1.5) -> DataFrame:
    """Matches whose squared distance, times ``ratio``, is below the second's."""
    return matches.filter(F.col("d1") * ratio < F.col("d2"))


def drop_ambiguous(matches: DataFrame) -> DataFrame:
    """Matches whose fixed key is claimed once."""
    single = matches.groupBy("f_id").agg(F.count("*").alias("n")).filter("n = 1").select("f_id")
    return matches.join(single, "f_id", "left_semi")


def nearest_point(points: DataFrame, targets: DataFrame, cell: float, axes: Sequence[str] = ("y", "x", "z")) -> DataFrame:
    """(p_id, t_id, distance): the nearest target within ``cell`` of each point; the smaller id of equals.

    Targets are spread over the cells around theirs, so a point meets candidates in one
    equi-join on its own cell.
    """
    corner = lambda a: F.floor(F.col(a) / cell).cast("long")
    t = targets.select(F.col("id").alias("t_id"), *(F.col(a).alias(f"t_{a}") for a in axes), *(corner(a).alias(f"g_{a}") for a in axes))
    for a in axes:
        t = t.withColumn(f"g_{a}", F.explode(F.sequence(F.col(f"g_{a}") - 1, F.col(f"g_{a}") + 1)))
    p = points.select(F.col("id").alias("p_id"), *axes, *(corner(a).alias(f"g_{a}") for a in axes))
    met = p.join(t, [f"g_{a}" for a in axes]).withColumn("distance", euclid([F.col(a) for a in axes], [F.col(f"t_{a}") for a in axes]))
    met = met.filter(F.col("distance") <= cell)
    return met.groupBy("p_id").agg(F.min(F.struct("distance", "t_id")).alias("b")).select("p_id", "b.t_id", "b.distance")


def nearest_any(points: DataFrame, targets: DataFrame, cell: float, axes: Sequence[str] = ("y", "x", "z")) -> DataFrame:
    """(p_id, t_id, distance): the nearest target of each point, however far; the smaller id of equals.

    Points are searched in ever coarser grids: what lies within one cell's width is the
    nearest of all, and only points without such a target go on to cells of twice the
    width.  The first width should be about the targets' spacing.  No rows without targets.
    """
    bounds = [f(F.col(a)).alias(f"{n}_{a}") for a in axes for n, f in (("low", F.min), ("high", F.max))]
    span = points.select(*axes).unionByName(targets.select(*axes)).agg(*bounds).first()
    if targets.isEmpty() or points.isEmpty():
        return nearest_point(points, targets, cell, axes)
    reach = sum((float(span[f"high_{a}"]) - float(span[f"low_{a}"])) ** 2 for a in axes) ** 0.5
    open_, found = points.select("id", *axes), None
    while True:
        near = keep(nearest_point(open_, targets, cell, axes))
        found = near if found is None else found.unionByName(near)
        open_ = keep(open_.join(near.select(F.col("p_id").alias("id")), "id", "left_anti"))
        if cell > reach or open_.isEmpty():
            return found
        cell *= 2


def below_mean(matches: DataFrame, distance: str = "d1") -> DataFrame:
    """Matches nearer than the mean distance."""
    mean = matches.agg(F.avg(distance).alias("_mean"))
    return matches.join(F.broadcast(mean)).filter(F.col(distance) < F.col("_mean")).drop("_mean")


def drop_far(matches: DataFrame, distance: str = "d1", deviations: float = 2.0) -> DataFrame:
    """Matches not beyond the mean plus ``deviations`` sample standard deviations."""
    stats = matches.agg(F.avg(distance).alias("_m"), F.stddev_samp(distance).alias("_s"))
    kept = F.col(distance) <= F.col("_m") + deviations * F.coalesce("_s", F.lit(0.0))
    return matches.join(F.broadcast(stats)).filter(kept).drop("_m", "_s")


def shape_context(points: DataFrame, reach: float = 100.0, hollow: float = 3.0, bins: int = 10) -> DataFrame:
    """(id, b_r, b_t, b_p, n): histograms of the other points around each by radius and the two angles."""
    cell = reach
    corner = lambda a: F.floor(F.col(a) / cell).cast("long")
    left = points.select("id", *"yxz", *(corner(a).alias(f"g_{a}") for a in "yxz"))
    right = points.select(*(F.col(a).alias(f"o_{a}") for a in "yxz"), *(corner(a).alias(f"g_{a}") for a in "yxz"))
    for a in "yxz":
        right = right.withColumn(f"g_{a}", F.explode(F.sequence(F.col(f"g_{a}") - 1, F.col(f"g_{a}") + 1)))
    met = left.join(right, ["g_y", "g_x", "g_z"])
    dy, dx, dz = (F.col(f"o_{a}") - F.col(a) for a in "yxz")
    met = met.withColumn("r", F.sqrt(dy * dy + dx * dx + dz * dz)).filter((F.col("r") > hollow) & (F.col("r") < reach))
    turn = F.atan2(dy, dx)
    tilt = F.acos(dz / F.col("r"))
    pi = 3.141592653589793
    level = lambda share: F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    return met.select(
        "id",
        level((F.col("r") - hollow) / (reach - hollow)).alias("b_r"),
        level((turn + pi) / (2 * pi)).alias("b_t"),
        level(tilt / pi).alias("b_p"),
    ).groupBy("id", "b_r", "b_t", "b_p").agg(F.count("*").alias("n"))
