"""Calls of puncta whose channels tie between two pixels: the interpolated percentiles must equal DuckDB's to the last bit."""

import random

import duckdb
import pytest

import __spark_entry__
from lumivox.operators import basecall

#: l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
ROWS = [
    (34905, 5, 22.0, 35727.02, 0.05, 0.02),
    (34905, 1, 36.0, 78377.86, 0.06, 0.0),
    (1063456, 5, 13.0, 62191.35, 0.06, 0.0),
    (1063456, 5, 30.0, 72550.77, 0.1, 0.01),
    (1063456, 1, 33.0, 96370.93, 0.05, 0.03),
    (1063456, 5, 13.0, 8745.92, 0.07, 0.02),
    (1063456, 5, 44.0, 1643.54, 0.07, 0.03),
    (3051958, 7, 30.0, 86327.97, 0.07, 0.08),
    (3051958, 3, 44.0, 93595.21, 0.06, 0.01),
    (3051958, 7, 33.0, 24590.21, 0.1, 0.04),
    (3051958, 3, 29.0, 52708.44, 0.05, 0.03),
    (3051958, 3, 29.0, 90222.02, 0.0, 0.01),
    (7, 1, 19.0, 281.5, 0.0, 0.0),
    (7, 5, 26.0, 521.5, 0.0, 0.0),
]
NAMES = ["base_call", "base_percentages_overall", "bleed_correction", "cutoff_calls", "base_percentages"]


@pytest.mark.parametrize("name", NAMES)
def test_ties_between_channels_are_called_as_in_sql(spark, tmp_path, name):
    columns = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(ROWS, columns).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    got = __spark_entry__.queries()[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("name", NAMES)
def test_puncta_without_a_key_are_called_as_in_sql(spark, tmp_path, name):
    rows = [*ROWS, (None, 1, 36.0, 78377.86, 0.06, 0.01), (None, 1, 30.0, 72550.77, 0.1, 0.01), (None, 3, 29.0, 52708.44, 0.05, 0.03), (8, None, 13.0, 8745.92, 0.07, 0.02)]
    columns = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    got = __spark_entry__.queries()[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("p", [0.0, 0.3, 0.9, 0.99, 1.0])
def test_percentiles_equal_sql_to_the_last_bit(spark, p):
    rng = random.Random(5)
    rows = [(k, rng.choice([rng.randrange(65536), 0, rng.random() * 1e3])) for k in range(300) for _ in range(rng.randrange(1, 40))]
    rows += [(300, None), (301, 1e300), (301, 1.5e300), (302, float("inf")), (302, 1.0), (303, -5.25), (303, -0.1)]
    rows = [(k, None if v is None else float(v)) for k, v in rows]
    got = basecall.channel_percentiles(spark.createDataFrame(rows, "k int, v double"), ["k"], ["v"], p).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest(?::INT[]) AS k, unnest(?::DOUBLE[]) AS v", [list(c) for c in zip(*rows)])
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(f"SELECT k, quantile_cont(v, {p}) FROM t GROUP BY k").fetchall()))


def test_a_missing_pixel_makes_the_call_0(spark):
    rows = [(1, 1, 5, 1, 1, 1), (1, 1, None, 1, 1, 1), (2, 1, 5, 1, 1, 1), (None, 1, 1, 7, None, 1), (None, 2, 1, 7, 1, 1)]
    got = basecall.base_calls(spark.createDataFrame(rows, "puncta_id long, round int, c1 long, c2 long, c3 long, c4 long"))
    assert sorted(map(str, map(tuple, got.select("puncta_id", "round", "base").collect()))) == ["(1, 1, 0)", "(2, 1, 1)", "(None, 1, 0)", "(None, 2, 2)"]
    assert got.columns == ["puncta_id", "round", "p1", "p2", "p3", "p4", "base"]


def test_a_tie_among_five_pixels_is_called_as_in_sql(spark, tmp_path):
    rows = [(117273, 4, 44.0, 70591.86, 0.03, 0.02), (117273, 4, 15.0, 24836.01, 0.05, 0.02), (117273, 4, 15.0, 49881.85, 0.03, 0.01)]
    rows += [(117273, 4, 43.0, 87018.24, 0.05, 0.06), (117273, 4, 39.0, 103439.05, 0.08, 0.05)]
    columns = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    got = __spark_entry__.queries()["cutoff_calls"](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({__spark_entry__.oracle_sql()['cutoff_calls']})").fetchall()
    assert list(map(tuple, got.collect())) == want
