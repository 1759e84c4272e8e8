"""Imaging tables derived from the driver's tables, in expressions that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (source table, select expressions). A fixture may select from another one.
FIXTURES: dict[str, tuple[str, list[str]]] = {
    "pixels_base": (
        "lineitem",
        [
            "l_orderkey AS puncta_id",
            "CAST((l_linenumber - 1) % 4 + 1 AS INT) AS round",
            "CAST(floor(l_quantity * 20) AS BIGINT) AS c1",
            "CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS c2",
            "CAST(floor(l_discount * 100 + 0.5) AS BIGINT) * 90 AS c3",
            "CAST(floor(l_tax * 100 + 0.5) AS BIGINT) * 110 AS c4",
        ],
    ),
    "codebook": (
        "part",
        [
            "p_partkey AS code_id",
            "p_brand AS name",
            "array(CAST(p_partkey % 4 + 1 AS INT), CAST(CAST(floor(p_partkey / 4) AS BIGINT) % 4 + 1 AS INT), "
            "CAST(CAST(floor(p_partkey / 16) AS BIGINT) % 4 + 1 AS INT), CAST(CAST(floor(p_partkey / 64) AS BIGINT) % 4 + 1 AS INT), "
            "CAST(CAST(floor(p_partkey / 256) AS BIGINT) % 4 + 1 AS INT), CAST((p_partkey * 7 + p_size) % 4 + 1 AS INT)) AS codes",
        ],
    ),
    "reads": (
        "lineitem",
        [
            "l_orderkey * 10 + l_linenumber AS puncta_id",
            "array("
            + ", ".join(f"CAST((l_partkey * 31 + l_suppkey * 7 * {r} + l_linenumber) % 5 AS INT)" for r in range(1, 7))
            + ") AS bases",
        ],
    ),
    "voxels": (
        "lineitem",
        [
            "CAST(l_quantity AS INT) AS y",
            "CAST(month(l_shipdate) AS INT) AS x",
            "CAST(l_linenumber AS INT) AS z",
            "l_returnflag AS channel",
            "CAST(year(l_shipdate) - 1994 AS INT) AS round",
            "CAST(floor(l_extendedprice) AS BIGINT) AS value",
        ],
    ),
    "positions": (
        "events",
        [
            "event_id",
            "event_type AS name",
            "CAST(user_id % 60 + 1 AS INT) AS y",
            "CAST(hour(ts) + 1 AS INT) AS x",
            "CAST(day(ts) AS INT) AS z",
            "CAST(event_id % 4 AS INT) AS hamming",
        ],
    ),
    "points": (
        "embeddings",
        [
            "vec_id AS id",
            "CAST(floor(embedding[0] * 200) AS DOUBLE) AS y",
            "CAST(floor(embedding[1] * 200) AS DOUBLE) AS x",
            "CAST(floor(embedding[2] * 200) AS DOUBLE) AS z",
            "label",
        ],
    ),
    "tiles": ("supplier", ["CAST(s_suppkey - 1 AS INT) AS fov"]),
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture, or a driver table."""
    if name not in FIXTURES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    source, exprs = FIXTURES[name]
    return frame(spark, sf_dir, source).selectExpr(*exprs)


def sql(name: str) -> str:
    """The fixture as a DuckDB subquery (whose lists count from 1 and are made by another name)."""
    source, exprs = FIXTURES[name]
    text = ", ".join(exprs).replace("array(", "list_value(")
    for k in (2, 1, 0):
        text = text.replace(f"embedding[{k}]", f"embedding[{k + 1}]")
    return f"(SELECT {text} FROM {source})"
