"""Registered queries of the small maps, the point search and the table steps of the runner."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import maps, match, register, volume
from ..sources import readers
from . import runner
from .catalog import PIXELS, POINTS, POSITIONS, READS, TILES, VOXELS, query, rounded
from .fixtures import frame


@query(f"SELECT id, round(y * 2.5) AS y, round(x * 2.5) AS x, round(z * 2.5) AS z FROM {POINTS}")
def full_resolution_shift(spark, d):
    return frame(spark, d, "points").select("id", *(maps.scale_shift(F.col(a), 2.5).alias(a) for a in "yxz"))


@query(
    f"""WITH a AS (SELECT y, x, z, CAST(sum(value) AS BIGINT) AS value FROM {VOXELS} WHERE channel <> 'R' GROUP BY ALL),
b AS (SELECT y, x, z, CAST(sum(value) AS BIGINT) AS under FROM {VOXELS} WHERE channel = 'R' GROUP BY ALL)
SELECT y, x, z, greatest(value - coalesce(under, 0), 0) AS value FROM a LEFT JOIN b USING (y, x, z)"""
)
def background_subtract(spark, d):
    v = frame(spark, d, "voxels")
    one = lambda f: volume.sum_channels(v.filter(f), volume.AXES)
    return maps.subtract_background(one("channel <> 'R'"), one("channel = 'R'"), volume.AXES)


@query(f"SELECT fov + 1 AS job, CAST(ceil((fov + 1) / 4.0) AS INT) AS round, CAST((fov % 4 + 4) % 4 + 1 AS INT) AS place FROM {TILES}")
def job_rounds(spark, d):
    job = F.col("fov") + 1
    round_, place = maps.job_round(job, 4)
    return frame(spark, d, "tiles").select(job.alias("job"), round_.alias("round"), place.alias("place"))


@query(f"SELECT CAST(least((y - 1) // 12, 3) AS INT) AS chunk, count(*) AS n FROM {VOXELS} GROUP BY ALL")
def axis_chunks(spark, d):
    """50 planes in chunks of 12: the tail of two joins the fourth."""
    return frame(spark, d, "voxels").groupBy(maps.chunk_of(F.col("y"), 50, 12).alias("chunk")).agg(F.count("*").alias("n"))


@query(f"SELECT event_id FROM {POSITIONS} WHERE round(y / 3.0) <> 0 AND round(x / 3.0) <> 0 AND round(z / 3.0) <> 0")
def drop_zero_positions(spark, d):
    return maps.drop_zero_positions(frame(spark, d, "positions"), 3.0).select("event_id")


@query(f"SELECT event_id FROM {POSITIONS} WHERE y > 10 AND y <= 40 AND x > 2 AND x <= 20 AND z > 5 AND z <= 25")
def inside_region(spark, d):
    return maps.inside_region(frame(spark, d, "positions"), (10, 2, 5), (40, 20, 25)).select("event_id")


@query(
    f"""WITH k AS (SELECT CAST(k AS INT) AS k, CAST(greatest(floor((k - 0.5) * 7 / 3 + 0.5), 1) AS INT) AS p FROM unnest(range(1, 4)) AS t(k))
SELECT y, x, k AS z, value FROM {VOXELS} JOIN k ON z = p"""
)
def label_downsample(spark, d):
    return maps.downsample_labels(frame(spark, d, "voxels"), 7, 3).select("y", "x", "z", "value")


@query(f"SELECT round(avg(n), 6) AS average FROM (SELECT name, count(*) AS n FROM {POSITIONS} GROUP BY name)")
def average_keypoints(spark, d):
    return rounded(maps.average_count(frame(spark, d, "positions"), "name"), "average")


@query(
    f"SELECT min(n) AS least, max(n) AS most, round(avg(n), 6) AS average FROM (SELECT y, x, z, count(*) AS n FROM {VOXELS} GROUP BY ALL) WHERE n >= 2"
)
def region_pixel_stats(spark, d):
    return rounded(maps.region_sizes(frame(spark, d, "voxels"), volume.AXES, 2), "average")


@query(f"SELECT count(*) AS reads, count(*) FILTER (bases[1] = 3 AND bases[2] = 2) AS with_prefix FROM {READS}")
def prefix_count(spark, d):
    return maps.prefix_count(frame(spark, d, "reads"), (3, 2))


@query(
    f"""WITH h AS (SELECT name, x, count(*) AS n FROM {POSITIONS} GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, x) AS rank, max(n) OVER (PARTITION BY name) AS best FROM h)
SELECT name, x, n, CAST(rank AS INT) AS rank FROM r WHERE rank <= 2 AND n >= 0.8 * best"""
)
def top_orientation_bins(spark, d):
    h = frame(spark, d, "positions").groupBy("name", "x").agg(F.count("*").alias("n"))
    return maps.top_bins(h, ["name"], "x", "n")


@query(
    f"""WITH a AS (SELECT y, x, max(value) AS v FROM {VOXELS} WHERE channel = 'A' GROUP BY ALL), b AS (SELECT y, x, max(value) AS v FROM {VOXELS} WHERE channel <> 'A' GROUP BY ALL)
SELECT y, x, coalesce(a.v, 0) - coalesce(b.v, 0) AS difference, abs(coalesce(a.v, 0) - coalesce(b.v, 0)) AS absolute FROM a FULL JOIN b USING (y, x)"""
)
def projection_difference(spark, d):
    v = frame(spark, d, "voxels")
    return maps.projection_difference(volume.project_max(v.filter("channel = 'A'")), volume.project_max(v.filter("channel <> 'A'")))


@query(
    f"""SELECT concat_ws(',', x, y, z, length(name) * 20, 255 - length(name) * 20, 0) AS line FROM {POSITIONS} WHERE name IS NOT NULL"""
)
def viewer_points(spark, d):
    p = frame(spark, d, "positions")
    red = (F.length("name") * 20).cast("int")
    colours = p.select("name").distinct().select("name", red.alias("red"), (255 - red).alias("green"), F.lit(0).alias("blue"))
    return maps.viewer_points(p, colours)


@query(f"SELECT puncta_id, round, round(c / nullif(c1 + c2 + c3 + c4, 0), 6) AS share, CAST(k AS INT) AS channel FROM (SELECT *, unnest([c1, c2, c3, c4]) AS c, unnest([1, 2, 3, 4]) AS k FROM {PIXELS})")
def l1_shares(spark, d):
    p = frame(spark, d, "pixels_base")
    shares = p.select("puncta_id", "round", F.posexplode(X.l1_normalize(F.array(*X.CHANNELS))).alias("k", "share"))
    return shares.select("puncta_id", "round", F.round("share", 6).alias("share"), (F.col("k") + 1).alias("channel"))


@query(f"SELECT id, greatest(-15, least(15, y)) AS y, greatest(-15, least(15, x)) AS x FROM {POINTS}")
def clamp_shifts(spark, d):
    return frame(spark, d, "points").select("id", *(X.clamp_shift(F.col(a), 15.0).alias(a) for a in "yx"))


@query(
    f"""WITH m AS (SELECT id, label, round(0.5 * y + 20, 6) AS y, round(x + 0.25 * z + 10, 6) AS x, round(z + 30, 6) AS z FROM {POINTS})
SELECT * FROM m WHERE y BETWEEN 1 AND 30 AND x BETWEEN 1 AND 40 AND z BETWEEN 1 AND 50"""
)
def warp_points_inside(spark, d):
    """Points moved by their group's transform; those that leave the volume are dropped."""
    p = frame(spark, d, "points").select("id", "label", *(F.col(a).cast("double").alias(a) for a in "yxz"))
    matrix = F.array(*(F.lit(float(v)) for v in (0.5, 0, 0, 20, 0, 1, 0.25, 10, 0, 0, 1, 30)))
    moved = register.warp_points(p, p.select("label").distinct().withColumn("matrix", matrix), ["label"], (30, 40, 50))
    return rounded(moved.select("id", "label", "y", "x", "z"), "y", "x", "z")


_NEAREST = f"""WITH p AS (SELECT id, y, x, z FROM {POINTS})
SELECT a.id AS p_id, arg_min(b.id, (sqrt((a.y - b.y) ** 2 + (a.x - b.x) ** 2 + (a.z - b.z) ** 2), b.id)) AS t_id,
  round(min(sqrt((a.y - b.y) ** 2 + (a.x - b.x) ** 2 + (a.z - b.z) ** 2)), 6) AS distance
FROM p a, p b WHERE a.id % 2 = 0 AND b.id % 10 = 1 GROUP BY a.id"""


@query(_NEAREST)
def nearest_any(spark, d):
    """The nearest target of every point, however far it is."""
    p = frame(spark, d, "points")
    return rounded(match.nearest_any(p.filter("id % 2 = 0"), p.filter("id % 10 = 1"), 5.0), "distance")


@query(f"SELECT y, x, z, channel, round, CASE WHEN round = 2 THEN value + 1 ELSE value END AS value FROM {VOXELS}")
def replaced_round(spark, d):
    v = frame(spark, d, "voxels")
    return runner.replace_round(v, v.filter("round = 2").withColumn("value", F.col("value") + 1), 2)


@query(
    f"""WITH f AS (SELECT DISTINCT round, channel, 'raw' AS stage, concat('raw/', round, '/', channel) AS path FROM {VOXELS})
SELECT stage, round, channel, path FROM f UNION ALL SELECT 'corrected', round, channel, path FROM f WHERE round = 1"""
)
def passed_through(spark, d):
    v = frame(spark, d, "voxels").select("round", "channel").distinct()
    files = v.select(F.lit("raw").alias("stage"), "round", "channel", F.concat(F.lit("raw/"), "round", F.lit("/"), "channel").alias("path"))
    return runner.pass_through(files, "raw", "corrected", F.col("round") == 1)


@query(
    f"""SELECT CAST(t.least AS INT) AS least, count(s.n) AS regions, CAST(coalesce(sum(s.n), 0) AS BIGINT) AS voxels
FROM unnest([1, 2, 4, 8]) AS t(least) LEFT JOIN (SELECT y, x, z, count(*) AS n FROM {VOXELS} GROUP BY ALL) s ON s.n >= t.least GROUP BY t.least"""
)
def size_sweep(spark, d):
    """Regions and voxels that stay at each least size."""
    sizes = frame(spark, d, "voxels").groupBy(*volume.AXES).agg(F.count("*").alias("n"))
    kept = lambda least: sizes.filter(F.col("n") >= least).agg(
        F.count("*").alias("regions"), F.coalesce(F.sum("n"), F.lit(0)).alias("voxels")
    )
    return runner.sweep({"least": [1, 2, 4, 8]}, kept)


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in ("nation", "orders", "lineitem", "events")))
def table_sizes(spark, d):
    """Rows of stored tables, from their footers."""
    return readers.table_sizes(spark, {t: f"{d}/{t}.parquet" for t in ("nation", "orders", "lineitem", "events")})
