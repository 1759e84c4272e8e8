"""Registered queries of the composed stages, connected regions and block operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kernels, regions, volume
from ..sources import readers
from . import stages
from .catalog import VOXELS, query, rounded
from .fixtures import frame

#: The fixture's volume.
EXTENT = (50, 12, 7)
BLOCK = (25, 12, 7)
_SUM = f"SELECT y, x, z, CAST(sum(value) AS BIGINT) AS value FROM {VOXELS} GROUP BY ALL"


def _volumes(spark, d):
    """(fov, y, x, z, value): one dense volume for each round."""
    v = frame(spark, d, "voxels").groupBy(F.col("round").alias("fov"), *volume.AXES).agg(F.sum("value").cast("double").alias("value"))
    return volume.densify(v, EXTENT, ["fov"]).fillna(0.0, ["value"])


def _dog_oracle(size: int, narrow: float, wide: float) -> str:
    """Difference of Gaussians, axis after axis, the volume mirrored at its border."""
    ny, nx, nz = EXTENT
    steps = [
        f"v AS ({_SUM})",
        f"""g AS (SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, CAST(z AS INT) AS z, CAST(coalesce(value, 0) AS DOUBLE) AS v
  FROM unnest(range(1, {ny + 1})) AS a(y) CROSS JOIN unnest(range(1, {nx + 1})) AS b(x) CROSS JOIN unnest(range(1, {nz + 1})) AS c(z) LEFT JOIN v USING (y, x, z))""",
    ]
    for name, sigma in (("n", narrow), ("w", wide)):
        weights = ", ".join(f"({k - size // 2}, {w!r}::DOUBLE)" for k, w in enumerate(kernels.gaussian(size, sigma).tolist()))
        steps.append(f"k{name} AS (SELECT * FROM (VALUES {weights}) AS t(k, w))")
        of = "g"
        for a, n in zip(volume.AXES, EXTENT):
            p = f"(o.{a} + k.k)"
            mirrored = f"CASE WHEN {p} < 1 THEN 1 - {p} WHEN {p} > {n} THEN {2 * n + 1} - {p} ELSE {p} END"
            same = " AND ".join(f"i.{b} = " + (mirrored if b == a else f"o.{b}") for b in volume.AXES)
            steps.append(f"{name}{a} AS (SELECT o.y, o.x, o.z, sum(k.w * i.v) AS v FROM {of} o CROSS JOIN k{name} k JOIN {of} i ON {same} GROUP BY ALL)")
            of = f"{name}{a}"
    return f"WITH {', '.join(steps)} SELECT y, x, z, round(nz.v - wz.v, 2) AS value FROM nz JOIN wz USING (y, x, z) JOIN v USING (y, x, z)"


@query(_dog_oracle(6, 3.0, 4.0))
def dog_blocks(spark, d):
    """Difference of Gaussians over haloed blocks, mirrored at the border of the volume."""
    v = volume.sum_channels(frame(spark, d, "voxels"), volume.AXES)
    return rounded(kernels.map_blocks(v, kernels.dog, (20, 5, 4), 6, extent=EXTENT), "value", digits=2)


@query(f"SELECT round, max(y) AS ny, max(x) AS nx, max(z) AS nz FROM {VOXELS} GROUP BY round")
def image_dimensions(spark, d):
    return readers.image_dimensions(frame(spark, d, "voxels"), ["round"])


def _regions_oracle(cells: str, result: str) -> str:
    """Regions of equal code among ``cells`` (y, x, z, code), each named by its least place, by reachability."""
    return f"""WITH RECURSIVE c AS ({cells}),
p AS (SELECT *, CAST(y AS BIGINT) * 4398046511104 + CAST(x AS BIGINT) * 2097152 + z AS p FROM c),
e AS (SELECT a.p AS a, b.p AS b FROM p a JOIN p b ON a.code = b.code AND abs(a.y - b.y) + abs(a.x - b.x) + abs(a.z - b.z) = 1),
r AS (SELECT p AS a, p AS b FROM p UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
n AS (SELECT a AS p, min(b) AS region FROM r GROUP BY a)
{result}"""


@query(_regions_oracle(f"SELECT y, x, z, value % 5 AS code FROM ({_SUM})", "SELECT code, y, x, z, region FROM p JOIN n USING (p)"))
def connected_regions(spark, d):
    """6-connected regions of equal last digit (in base five) of the summed voxels."""
    v = volume.sum_channels(frame(spark, d, "voxels"), volume.AXES)
    return regions.connected(v.withColumn("code", F.col("value") % 5), ["code"])


_CALLS = f"SELECT y, x, z, round, CAST(max(value) % 3 AS INT) AS base FROM {VOXELS} GROUP BY ALL"
_VOXEL_CODES = f"SELECT y, x, z, CAST(sum(base * CAST(pow(10, round - 3) AS BIGINT)) AS BIGINT) AS code FROM ({_CALLS}) WHERE round >= 3 GROUP BY ALL"


def _calls(spark, d):
    return frame(spark, d, "voxels").groupBy("round", *volume.AXES).agg((F.max("value") % 3).cast("int").alias("base"))


@query(_VOXEL_CODES)
def voxel_codes(spark, d):
    """Bases of each voxel from the third round on, as one decimal number."""
    return regions.voxel_codes(_calls(spark, d), 3)


@query(
    _regions_oracle(
        f"SELECT * FROM ({_VOXEL_CODES}) WHERE code <> 0",
        """SELECT region, code, count(*) AS n_voxels, round(avg(y), 6) AS cy, round(avg(x), 6) AS cx, round(avg(z), 6) AS cz
FROM p JOIN n USING (p) GROUP BY region, code HAVING count(*) >= 2""",
    )
)
def region_reads(spark, d):
    """Reads assembled from connected voxels of equal code, two voxels at least."""
    return rounded(regions.region_reads(regions.voxel_codes(_calls(spark, d), 3), 2), "cy", "cx", "cz")


_SPOTS = f"""WITH v AS ({_SUM}),
peaks AS (SELECT a.y, a.x, a.z FROM v a JOIN v b ON abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND abs(a.z - b.z) <= 1
  WHERE a.y BETWEEN 2 AND {EXTENT[0] - 1} AND a.x BETWEEN 2 AND {EXTENT[1] - 1} AND a.z BETWEEN 2 AND {EXTENT[2] - 1}
  GROUP BY a.y, a.x, a.z, a.value HAVING a.value = max(b.value) AND count(*) FILTER (WHERE b.value = a.value) = 1 AND a.value > 1000),
c AS (SELECT round, channel, y, x, z, CAST(sum(value) AS DOUBLE) AS value FROM {VOXELS} GROUP BY ALL)
SELECT CAST(0 AS INT) AS fov, p.y, p.x, p.z, c.round, c.channel, round(avg(c.value), 4) AS intensity, count(*) AS n_peak
FROM peaks p JOIN c ON abs(p.y - c.y) <= 5 AND abs(p.x - c.x) <= 5 AND abs(p.z - c.z) <= 5 GROUP BY ALL"""


@query(_SPOTS)
def spot_intensities(spark, d):
    """Mean intensities of every round and channel in the 11-voxel boxes around strict maxima of the summed volume."""
    v = frame(spark, d, "voxels").withColumn("fov", F.lit(0))
    summed = volume.sum_channels(v, ["fov", *volume.AXES])
    each = v.groupBy("fov", "round", "channel", *volume.AXES).agg(F.sum("value").cast("double").alias("value"))
    return rounded(stages.spots(summed, each, EXTENT, threshold=1000), "intensity", digits=4)


@query(f"SELECT DISTINCT round AS fov, 2::DOUBLE AS dy, -1::DOUBLE AS dx, 0::DOUBLE AS dz FROM {VOXELS}")
def volume_shifts(spark, d):
    """Shifts of every round's volume, turned by two and one voxels: the truth is known by construction."""
    v = _volumes(spark, d)
    turned = v.withColumn("y", F.pmod(F.col("y") - 3, F.lit(EXTENT[0])) + 1).withColumn("x", F.col("x") % EXTENT[1] + 1)
    return kernels.volume_shifts(v, turned, ["fov"], EXTENT, lambda a, b: kernels.subpixel_shift(a - a.mean(), b - b.mean()))


@query()
def corner_points(spark, d):
    """3-D corners of every round's volume."""
    return rounded(kernels.corners(_volumes(spark, d), EXTENT, BLOCK, ["fov"]), "value", digits=2)


@query()
def corner_descriptors(spark, d):
    """Gradient descriptors of the corners."""
    v = _volumes(spark, d)
    return kernels.descriptors(kernels.corners(v, EXTENT, BLOCK, ["fov"]), v, EXTENT, BLOCK, ["fov"], half=3)


@query()
def register_volumes(spark, d):
    """Every round's volume registered to itself, moved by two rows."""
    v = _volumes(spark, d)
    moved = v.withColumn("y", F.col("y") - 2).filter("y >= 1")
    moved = volume.densify(moved, EXTENT, ["fov"]).fillna(0.0, ["value"])
    found = stages.registration(v, moved, EXTENT, BLOCK, ratio=1.2, half=3, blur=3, reach=0.4, full=False)
    return found.withColumn("matrix", F.transform("matrix", lambda x: F.round(x, 2)))


@query()
def segmentation_stage(spark, d):
    """From channels to puncta: clamp, sum, crop, sharpen, threshold, flood and filter by size."""
    v = frame(spark, d, "voxels").withColumn("fov", F.lit(0)).groupBy("fov", "round", "channel", *volume.AXES).agg(F.sum("value").cast("double").alias("value"))
    found, _ = stages.segmentation(v, max_zeros=6, least=2, block=BLOCK)
    return rounded(found, "cy", "cx", "cz")


@query()
def channel_regions(spark, d):
    """Watershed of every round's channels over the voxels that each wins."""
    v = frame(spark, d, "voxels").groupBy("round", "channel", *volume.AXES).agg(F.sum("value").cast("double").alias("value"))
    return stages.channel_regions(v, EXTENT, BLOCK)
