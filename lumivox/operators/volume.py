"""Operators over voxel tables (fov, round, channel, y, x, z, value and the like).

Neighbourhoods are taken axis by axis: a cube's maximum, minimum or sum is that along
y, then x, then z, each a range-framed window inside the lines along that axis.  Lines
are short (an image's edge), so no window grows with the number of volumes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import U16, sat_u16

AXES = ("y", "x", "z")
MAX_SHIFTS = 100_000


def sum_channels(voxels: DataFrame, keys: Sequence[str] = ("round", *AXES), value: str = "value") -> DataFrame:
    """Sum over channels."""
    return voxels.groupBy(*keys).agg(F.sum(value).alias(value))


def mean_volumes(voxels: DataFrame, keys: Sequence[str] = AXES, value: str = "value") -> DataFrame:
    return voxels.groupBy(*keys).agg(F.avg(value).alias(value))


def clamp_percentile(voxels: DataFrame, by: Sequence[str] = ("round",), p: float = 0.999, value: str = "value") -> DataFrame:
    """Values above the group's percentile become it."""
    cut = voxels.groupBy(*by).agg(F.percentile(value, p).alias("_cut"))
    return voxels.join(cut, list(by)).withColumn(value, F.least(F.col(value), F.col("_cut"))).drop("_cut")


def rescale(voxels: DataFrame, by: Sequence[str] = ("round",), value: str = "value") -> DataFrame:
    """Values less the group's least, scaled so that its largest maps to the end of the stored range."""
    ends = voxels.groupBy(*by).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    scaled = F.try_divide(F.col(value) - F.col("_low"), F.col("_high")) * U16
    return voxels.join(ends, list(by)).withColumn(value, scaled).drop("_low", "_high")


def store_u16(voxels: DataFrame, value: str = "value") -> DataFrame:
    return voxels.withColumn(value, sat_u16(F.col(value)))


def zero_counts(voxels: DataFrame, keys: Sequence[str] = AXES, value: str = "value") -> DataFrame:
    """(keys, total, zeros): running sum over rounds and how many of them are 0."""
    return voxels.groupBy(*keys).agg(F.sum(value).alias("total"), F.count_if(F.col(value) == 0).alias("zeros"))


def crop_bounds(counts: DataFrame, max_zeros: int = 0) -> DataFrame:
    """One row: first and last index of usable voxels along each axis."""
    usable = counts.filter(F.col("zeros") <= max_zeros)
    return usable.agg(*(f(a).alias(f"{a}{k}") for a in AXES for k, f in ((0, F.min), (1, F.max))))


def crop(voxels: DataFrame, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """Voxels inside inclusive bounds, counted from 1 there."""
    for axis, (low, high) in bounds.items():
        voxels = voxels.filter(F.col(axis).between(low, high)).withColumn(axis, F.col(axis) - low + 1)
    return voxels


def uncrop(points: DataFrame, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """The inverse of ``crop`` for positions."""
    for axis, (low, _) in bounds.items():
        points = points.withColumn(axis, F.col(axis) + low - 1)
    return points


def usable_fraction(counts: DataFrame, max_zeros: int = 0) -> DataFrame:
    """One row: share of voxels with at most ``max_zeros`` empty rounds."""
    return counts.agg(F.avg((F.col("zeros") <= max_zeros).cast("double")).alias("usable"))


def project_max(voxels: DataFrame, axis: str = "z", keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Maximum-intensity projection along ``axis``."""
    rest = [a for a in AXES if a != axis]
    return voxels.groupBy(*keys, *rest).agg(F.max(value).alias(value))


def max_combine(*volumes: DataFrame, keys: Sequence[str] = AXES, value: str = "value") -> DataFrame:
    """Overlapping volumes merged by their maxima."""
    out = volumes[0].select(*keys, value)
    for other in volumes[1:]:
        out = out.unionByName(other.select(*keys, value))
    return out.groupBy(*keys).agg(F.max(value).alias(value))


def translate(voxels: DataFrame, shift: tuple[int, int, int], size: tuple[int, int, int]) -> DataFrame:
    """Every voxel moved; what leaves the volume is gone, what enters is absent (0)."""
    for axis, d, n in zip(AXES, shift, size):
        voxels = voxels.withColumn(axis, F.col(axis) + d).filter(F.col(axis).between(1, n))
    return voxels


def flip(voxels: DataFrame, n: int, axis: str = "y") -> DataFrame:
    return voxels.withColumn(axis, n + 1 - F.col(axis))


def downsample(voxels: DataFrame, factor: int, keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Means of blocks of factor^3 voxels (those that are there)."""
    block = [(F.floor((F.col(a) - 1) / factor) + 1).cast("int").alias(a) for a in AXES]
    return voxels.groupBy(*keys, *block).agg(F.avg(value).alias(value))


def downsample_nearest(voxels: DataFrame, factor: int) -> DataFrame:
    """The first voxel of each block of factor^3."""
    for a in AXES:
        voxels = voxels.filter((F.col(a) - 1) % factor == 0).withColumn(a, ((F.col(a) - 1) / factor + 1).cast("int"))
    return voxels


def _along(axis: str, keys: Sequence[str], axes: Sequence[str] = AXES):
    return W.partitionBy(*keys, *(a for a in axes if a != axis)).orderBy(axis)


def densify(voxels: DataFrame, size: tuple[int, int, int], keys: Sequence[str] = ()) -> DataFrame:
    """A row for every position of every volume (of each combination of ``keys``); values that aren't there are null."""
    grid = voxels.select(*keys).distinct() if keys else voxels.sparkSession.range(1).drop("id")
    for axis, n in zip(AXES, size):
        grid = grid.withColumn(axis, F.explode(F.sequence(F.lit(1), F.lit(n))))
    return grid.join(voxels, [*keys, *AXES], "left")


def box_sum(voxels: DataFrame, before: int, after: int, keys: Sequence[str] = (), axes: Sequence[str] = ("y", "x"), value: str = "value") -> DataFrame:
    """``value`` summed over the box from ``before`` below to ``after`` above along the given axes, voxels outside counting 0.

    The image must be dense (see ``densify``), with one value for each position.
    """
    for axis in axes:
        frame = _along(axis, keys, [a for a in AXES if a in voxels.columns]).rangeBetween(-before, after)
        voxels = voxels.withColumn(value, F.sum(value).over(frame))
    return voxels


def local_maxima(voxels: DataFrame, size: tuple[int, int, int], keys: Sequence[str] = (), value: str = "value", top: int | None = None) -> DataFrame:
    """Voxels strictly above those of their 26 neighbours that are there; the border of the volume of ``size`` has none.

    The largest value of the cube and how often it occurs come from three one-axis
    windows; a strict maximum equals the cube's largest value and holds it alone.
    """
    peak = "_max"
    found = densify(voxels, size, keys).withColumn(peak, F.struct(F.col(value).alias("v"), F.lit(1).alias("n")))
    for axis in AXES:
        frame = _along(axis, keys).rangeBetween(-1, 1)
        high = F.max(f"{peak}.v").over(frame)
        found = found.withColumn("_high", high)
        near = F.collect_list(peak).over(frame)  # three values at most
        count = F.aggregate(near, F.lit(0), lambda s, p: s + F.when(p["v"] == F.col("_high"), p["n"]).otherwise(0))
        found = found.withColumn(peak, F.struct(F.col("_high").alias("v"), count.alias("n"))).drop("_high")
    inner = [F.col(a).between(2, n - 1) for a, n in zip(AXES, size)]
    found = found.filter((F.col(value) == F.col(f"{peak}.v")) & (F.col(f"{peak}.n") == 1) & inner[0] & inner[1] & inner[2])
    found = found.drop(peak).orderBy(F.desc(value), *keys, *AXES) if top else found.drop(peak)
    return found.limit(top) if top else found


def morphology(voxels: DataFrame, radius: int, shape: str = "box", opening: bool = True, keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Grey opening (or closing) of a dense volume; ``box`` goes axis by axis, ``sphere`` by block kernels elsewhere."""
    if shape != "box":
        raise ValueError("spheres are opened by kernels.open_sphere")
    steps = (F.min, F.max) if opening else (F.max, F.min)
    for f in steps:
        for axis in AXES:
            voxels = voxels.withColumn(value, f(value).over(_along(axis, keys).rangeBetween(-radius, radius)))
    return voxels


def fill_holes(voxels: DataFrame, size: tuple[int, int, int], radius: int = 2, keys: Sequence[str] = (), value: str = "value", hole: str = "hole") -> DataFrame:
    """Holes take the mean of the other voxels in the smallest cube, of half-width 1..radius, that holds any."""
    out = densify(voxels, size, keys).withColumn("_value", F.when(~F.col(hole), F.col(value)))
    filled = F.col("_value")
    for r in range(1, radius + 1):
        total, count = F.coalesce(F.col("_value"), F.lit(0.0)), F.col("_value").isNotNull().cast("long")
        out = out.withColumn("_sum", total).withColumn("_count", count)
        for axis in AXES:
            frame = _along(axis, keys).rangeBetween(-r, r)
            out = out.withColumn("_sum", F.sum("_sum").over(frame)).withColumn("_count", F.sum("_count").over(frame))
        out = out.withColumn(f"_fill{r}", F.try_divide(F.col("_sum"), F.col("_count")))
        filled = F.coalesce(filled, F.col(f"_fill{r}"))
    there = out.filter(F.col(hole).isNotNull())
    return there.withColumn(value, F.coalesce(filled, F.lit(0.0))).drop("_value", "_sum", "_count", *(f"_fill{r}" for r in range(1, radius + 1)))


def heat_map(points: DataFrame, radius: int, size: tuple[int, int], step: int = 1, keys: Sequence[str] = (), disk: bool = False) -> DataFrame:
    """(keys, y, x, heat): every point adds ``step`` to its box (or disk) of +-radius, clamped to the image."""
    y0, x0 = F.round("y").cast("int"), F.round("x").cast("int")
    span = lambda c, n: F.sequence(F.greatest(c - radius, F.lit(1)), F.least(c + radius, F.lit(n)))
    inside = points.select(*keys, y0.alias("y0"), x0.alias("x0")).filter(
        (F.col("y0") + radius >= 1) & (F.col("y0") - radius <= size[0]) & (F.col("x0") + radius >= 1) & (F.col("x0") - radius <= size[1])
    )
    # equal points are counted before they spread over their boxes
    counted = inside.groupBy(*keys, "y0", "x0").agg(F.count("*").alias("n"))
    spread = counted.withColumn("y", F.explode(span(F.col("y0"), size[0]))).withColumn("x", F.explode(span(F.col("x0"), size[1])))
    if disk:
        spread = spread.filter((F.col("y") - F.col("y0")) ** 2 + (F.col("x") - F.col("x0")) ** 2 <= radius**2)
    return spread.groupBy(*keys, "y", "x").agg((F.sum("n") * step).alias("heat"))


def best_shift(fixed: DataFrame, moving: DataFrame, reach: int, axes: Sequence[str] = AXES, value: str = "value") -> DataFrame:
    """(d_<axis>..., score): the offset, within +-reach along each axis, of the largest product sum; the first of equals.

    The moving voxels are spread over the offsets, so both sides meet in an equi-join.
    """
    if (2 * reach + 1) ** len(axes) > MAX_SHIFTS:
        raise ValueError("too many offsets; correlate by phase instead")
    spread = moving.select(*axes, F.col(value).alias("_moving"))
    for a in axes:
        spread = spread.withColumn(f"d_{a}", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn(a, F.col(a) + F.col(f"d_{a}"))
    offsets = [f"d_{a}" for a in axes]
    scores = fixed.select(*axes, value).join(spread, list(axes)).groupBy(*offsets).agg(F.sum(F.col(value) * F.col("_moving")).alias("score"))
    return scores.orderBy(F.desc("score"), *offsets).limit(1)


def winner_masks(pixels: DataFrame, channels: Sequence[str]) -> DataFrame:
    """``pixels`` with win_<channel>: whether the channel has the largest value (all of equals do)."""
    top = F.greatest(*(F.col(c) for c in channels))
    return pixels.withColumns({f"win_{c}": F.col(c) == top for c in channels})


def compare_volumes(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """One row: voxels of either volume, mean and largest absolute difference, in units of the stored range."""
    joined = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), list(keys), "full")
    error = F.abs(F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0))) / U16
    return joined.agg(F.count("*").alias("n"), F.avg(error).alias("mean_error"), F.max(error).alias("max_error"))


def composite_rgb(pixels: DataFrame, weights: Sequence[Sequence[float]], channels: Sequence[str]) -> DataFrame:
    """``pixels`` with red, green, blue as linear combinations of the channels, clamped to 0..1."""
    colour = lambda row: F.greatest(F.lit(0.0), F.least(F.lit(1.0), sum((F.col(c) * float(w) for c, w in zip(channels, row)), F.lit(0.0))))
    return pixels.withColumns({name: colour(row) for name, row in zip(("red", "green", "blue"), weights)})


def quality_ratio(good: Column, bad: Column, mistaken: Column) -> Column:
    """good / max(bad + mistaken, 1)."""
    return good / F.greatest(bad + mistaken, F.lit(1))


def tile_is_empty(voxels: DataFrame, limit: float, keys: Sequence[str] = ("fov",), value: str = "value") -> DataFrame:
    """(keys, empty): whether more than ``limit`` of the (y, x) columns have a mean below 1."""
    columns = voxels.groupBy(*keys, "y", "x").agg(F.avg(value).alias("mean"))
    return columns.groupBy(*keys).agg((F.avg((F.col("mean") < 1).cast("double")) > limit).alias("empty"))
