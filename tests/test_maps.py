import numpy as np
from lumivox.operators import maps, match
from lumivox.plans import runner
from lumivox.sources import readers
from pyspark.sql import functions as F


def test_axis_chunks_cover_the_axis_and_merge_short_tails():
    assert maps.split_axis(50, 12) == [(1, 12), (13, 24), (25, 36), (37, 50)]
    assert maps.split_axis(54, 12)[-1] == (49, 54) and maps.split_axis(5, 12) == [(1, 5)]


def test_rotation_and_random_affine():
    turn = maps.rotation_matrix((0, 0, 2), np.pi / 2)
    assert np.allclose(turn @ [1, 0, 0], [0, 1, 0]) and np.allclose(turn @ turn.T, np.eye(3))
    assert maps.random_affine(3).shape == (3, 4) and np.array_equal(maps.random_affine(3), maps.random_affine(3))


def test_leading_axis(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(500, 3)) * [1, 5, 0.3] @ maps.rotation_matrix((1, 2, 3), 0.7)
    want = np.linalg.svd(points)[2][0]
    got = maps.leading_axis(spark.createDataFrame(points.tolist(), "y double, x double, z double"))
    assert np.allclose(got, want * np.sign(want[np.abs(want).argmax()]))


def test_nearest_of_far_and_missing_targets(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 900.0, -900.0, 5.0), (3, 3.0, 0.0, 0.0)], "id long, y double, x double, z double")
    targets = spark.createDataFrame([(7, 1.0, 0.0, 0.0), (8, 400.0, 0.0, 0.0), (6, 5.0, 0.0, 0.0)], "id long, y double, x double, z double")
    got = {r["p_id"]: (r["t_id"], r["distance"]) for r in match.nearest_any(points, targets, 0.5).collect()}
    assert got[1] == (7, 1.0) and got[3] == (6, 2.0) and got[2][0] == 8
    assert match.nearest_any(points, targets.limit(0), 1.0).isEmpty() and match.nearest_any(points.limit(0), targets, 1.0).isEmpty()


def test_natural_order_of_several_numbers(spark):
    names = ["a10b2", "a2b10", "a2b2", "a1", "b1", "a2"]
    df = spark.createDataFrame([(n,) for n in names], "n string").orderBy(readers.natural_order("n"))
    assert [r[0] for r in df.collect()] == ["a1", "a2", "a2b2", "a2b10", "a10b2", "b1"]


def test_only_the_redone_round_is_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(12).select("id", (F.col("id") % 3).cast("int").alias("round"))
    table.write.partitionBy("round").parquet(path)
    runner.rewrite_round(table.filter("round = 1").withColumn("id", F.col("id") + 100), path)
    got = {r["round"]: r["n"] for r in spark.read.parquet(path).groupBy("round").agg(F.min("id").alias("n")).collect()}
    assert got == {0: 0, 1: 101, 2: 2}
