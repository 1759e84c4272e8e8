"""Sinks: tables in the text formats of downstream tools, and volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ind2sub, sat_u16

#: Letters of the calls 0..4 and quality characters from 0 to 40.
BASES = "NACGT"
QUALITIES = "".join(chr(33 + k) for k in range(41))


def gene_positions(reads: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """gene, x, y, z (rounded) and extra columns."""
    return reads.select(F.col("name").alias("gene"), *(F.round(a).cast("long").alias(a) for a in ("x", "y", "z")), *extra)


def gene_counts(reads: DataFrame, least: int = 1) -> DataFrame:
    """gene, count of at least ``least``."""
    return reads.groupBy(F.col("name").alias("gene")).agg(F.count("*").alias("count")).filter(F.col("count") >= least)


def tsv_line(reads: DataFrame) -> DataFrame:
    """One tab-separated line a read: its name (whose own tabs part it), its bases and position."""
    return reads.select(
        F.concat_ws("\t", F.col("name"), F.array_join("bases", ""), *(F.round(a, 2).cast("string") for a in "xyz")).alias("line")
    )


def fastq_text(bases: Column, confidence: Column) -> tuple[Column, Column]:
    """The letters of the calls and the characters of their rounded confidences (0 to 40)."""
    letters = F.array_join(F.transform(bases, lambda b: F.substring(F.lit(BASES), b + 1, F.lit(1))), "")
    level = lambda c: F.greatest(F.lit(0), F.least(F.round(c).cast("int"), F.lit(40)))
    quality = F.array_join(F.transform(confidence, lambda c: F.substring(F.lit(QUALITIES), level(c) + 1, F.lit(1))), "")
    return letters, quality


def fastq(reads: DataFrame, header: Column) -> DataFrame:
    """Four-line records, one row each."""
    letters, quality = fastq_text(F.col("bases"), F.col("confidence"))
    return reads.select(F.concat(F.lit("@"), header, F.lit("\n"), letters, F.lit("\n+\n"), quality).alias("record"))


def read_xml_rows(reads: DataFrame) -> DataFrame:
    """One XML element a read; x is the second coordinate, y the first."""
    row = F.struct(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("z").alias("_z"), F.col("name").alias("gene"))
    return reads.select(F.to_xml(row, {"rowTag": "read"}).alias("xml"))


def point_cloud(puncta: DataFrame, ny: int, nx: int, colours: DataFrame, alpha: float = 1.0) -> DataFrame:
    """x, y, z, r, g, b, a, round: a row for each voxel of each punctum and round, coloured by base.

    ``puncta``: round, base, voxels (linear indices); ``colours``: base, r, g, b (a handful of rows).
    """
    each = puncta.select("round", "base", F.explode("voxels").alias("i"))
    y, x, z = ind2sub(ny, nx, F.col("i"))
    placed = each.select("round", "base", y.alias("y"), x.alias("x"), z.alias("z"))
    return placed.join(F.broadcast(colours), "base").select("x", "y", "z", "r", "g", "b", F.lit(alpha).alias("a"), "round")


def label_volume(puncta: DataFrame, value: int = 100) -> DataFrame:
    """(lin_idx, value): a mask of all puncta voxels."""
    return puncta.select(F.explode("voxels").alias("lin_idx")).distinct().withColumn("value", F.lit(value))


def write_volume(voxels: DataFrame, path: str, value: str = "value") -> dict[str, int]:
    """Store voxels (Parquet, one folder a round where there is one); returns how many values had to be clamped."""
    from pyspark.sql import Observation

    seen = Observation()
    clipped = F.count_if((F.col(value) < 0) | (F.round(value) > 65535)).alias("clamped")
    out = voxels.observe(seen, clipped).withColumn(value, sat_u16(F.col(value)))
    writer = out.write.mode("overwrite")
    (writer.partitionBy("round") if "round" in voxels.columns else writer).parquet(path)
    return {"clamped": seen.get["clamped"]}


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("overwrite").option("sep", separator).option("header", True).csv(path)
