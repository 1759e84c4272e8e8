"""Fields of view: tile maps, neighbourhoods, merging and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def snake_position(fov: Column, rows: int) -> tuple[Column, Column]:
    """(row, col) from 0 of a field number from 0 on a snake of ``rows`` a column: down even columns, up odd ones."""
    col = F.floor(fov / rows).cast("int")
    step = (fov % rows).cast("int")
    return F.when(col % 2 == 0, step).otherwise(rows - step - 1), col


def turned(row: Column, col: Column, rows: int) -> tuple[Column, Column]:
    """Transpose of the map, then a flip from left to right: the new (row, col)."""
    return col, rows - 1 - row


def tile_map(fovs: DataFrame, rows: int, turn: bool = False, fov: str = "fov") -> DataFrame:
    """(fov, row, col), distinct."""
    row, col = snake_position(F.col(fov), rows)
    if turn:
        row, col = turned(row, col, rows)
    return fovs.select(F.col(fov), row.alias("row"), col.alias("col")).distinct()


def neighbours(tiles: DataFrame) -> DataFrame:
    """(fov, near): fields of the 3 x 3 neighbourhood, the field itself included.

    Every tile is spread over the nine places it is a neighbour of: an equi-join instead
    of a range join.
    """
    around = tiles.select(F.col("fov").alias("near"), "row", "col")
    for a in ("row", "col"):
        around = around.withColumn(a, F.explode(F.sequence(F.col(a) - 1, F.col(a) + 1)))
    return tiles.join(around, ["row", "col"]).select("fov", "near")


def lift(points: DataFrame, tiles: DataFrame, width: int, height: int, factor: float = 1.0) -> DataFrame:
    """Positions in the whole sample: scaled, and moved by the tile's place."""
    placed = points.join(tiles, "fov")
    return placed.withColumn("y", F.col("y") * factor + height * F.col("row")).withColumn("x", F.col("x") * factor + width * F.col("col")).drop("row", "col")


def split_fovs(fovs: DataFrame, instances: int, skip: DataFrame | None = None) -> DataFrame:
    """(fov, instance): the fields dealt out in order, the first instances taking one more where it doesn't divide."""
    kept = fovs.select("fov").distinct()
    if skip is not None:
        kept = kept.join(skip.select("fov"), "fov", "left_anti")
    return kept.select("fov", F.ntile(instances).over(W.orderBy("fov")).alias("instance"))


def match_lists(pairs: DataFrame, tiles: DataFrame, least: int) -> DataFrame:
    """(fixed, moving): fields with at least ``least`` matches; every field is matched with itself."""
    counted = pairs.groupBy("fixed", "moving").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("fixed", "moving")
    return counted.unionByName(tiles.select(F.col("fov").alias("fixed"), F.col("fov").alias("moving"))).distinct()


def completion(fovs: DataFrame, puncta: DataFrame, complete: DataFrame, usable: DataFrame) -> DataFrame:
    """(fov, n_centroids, n_complete, frac_usable): null where a field has no such result."""
    count = lambda df, name: df.groupBy("fov").agg(F.count("*").alias(name))
    return (
        fovs.select("fov").distinct()
        .join(count(puncta, "n_centroids"), "fov", "left")
        .join(count(complete, "n_complete"), "fov", "left")
        .join(usable, "fov", "left")
    )


def expected_files(rounds: DataFrame, channels: DataFrame, catalog: DataFrame) -> DataFrame:
    """(round, channel) that the catalog lacks."""
    return rounds.join(F.broadcast(channels)).join(catalog, ["round", "channel"], "left_anti")


def mosaic(tiles: DataFrame, pixels: DataFrame, height: int, width: int, overlap: float = 0.0) -> DataFrame:
    """(y, x, value): tiles laid out by row and column; where they overlap, the later field wins."""
    step_y, step_x = int(height * (1 - overlap)), int(width * (1 - overlap))
    placed = pixels.join(tiles, "fov").select(
        (F.col("y") + step_y * F.col("row")).alias("y"), (F.col("x") + step_x * F.col("col")).alias("x"), "fov", "value"
    )
    return placed.groupBy("y", "x").agg(F.max_by("value", "fov").alias("value"))


def parse_names(paths: DataFrame, path: str = "path") -> DataFrame:
    """``paths`` with base, scale, round, channel, variant and extension read from file names."""
    grammar = r"([^/]+?)(-downsample)?_round(\d{3})_([A-Za-z0-9]+)(?:_(affine|registered))?\.([A-Za-z0-9]+)$"
    part = lambda k: F.regexp_extract(path, grammar, k)
    return paths.select(
        path,
        part(1).alias("base"),
        F.when(part(2) != "", "downsample").otherwise("full").alias("scale"),
        part(3).cast("int").alias("round"),
        part(4).alias("channel"),
        F.nullif(part(5), F.lit("")).alias("variant"),
        part(6).alias("extension"),
    )


def scope_round(name: Column, primers: int = 5) -> Column:
    """Round from a scope file name: marks ``C`` count whole ligations, ``n-K`` gives the primer."""
    marks = F.length(name) - F.length(F.replace(name, F.lit("C"), F.lit("")))
    offset = F.when(name.rlike(r"n-\d"), -F.regexp_extract(name, r"n-(\d)", 1).cast("int")).otherwise(0)
    return marks * primers + (primers - 1 + offset) + 1


def nearest_distances(pairs: DataFrame, width: float, by: str = "hamming") -> DataFrame:
    """(by, bucket, n): histogram of distances in buckets of ``width`` from 0."""
    return pairs.groupBy(by, F.floor(F.col("distance") / width).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def spacing_quality(pairs: DataFrame) -> DataFrame:
    """(distance, good, bad): reads by the exact spacing of their neighbours."""
    return pairs.groupBy("distance").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))


def aligned_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """(name, n_a, n_b): counts on the union of names, missing ones 0."""
    left = a.groupBy("name").agg(F.count("*").alias("n_a"))
    right = b.groupBy("name").agg(F.count("*").alias("n_b"))
    return left.join(right, "name", "full").fillna(0, ["n_a", "n_b"])


def valid_by_label(reads: DataFrame, truth: DataFrame, valid: bool = True) -> DataFrame:
    """Reads whose name the truth has (or lacks)."""
    return reads.join(truth.select("name").distinct(), "name", "left_semi" if valid else "left_anti")


def assign_cells(reads: DataFrame, labels: DataFrame, factor: float) -> DataFrame:
    """Reads with the cell of their down-sampled place; those outside cells (0) are dropped."""
    at = reads.withColumn("_y", F.round(F.col("y") / factor).cast("int")).withColumn("_x", F.round(F.col("x") / factor).cast("int"))
    cells = labels.filter("cell_id > 0").select(F.col("y").alias("_y"), F.col("x").alias("_x"), "cell_id")
    return at.join(cells, ["_y", "_x"]).drop("_y", "_x")


def round_votes(tracked: DataFrame) -> DataFrame:
    """(ref_id, votes): in how many rounds each reference punctum was found."""
    return tracked.groupBy("ref_id").agg(F.count_distinct("round").alias("votes"))
