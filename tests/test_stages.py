"""Composed stages and the block operators beneath them, against one array or a simulated truth."""

import numpy as np
import pytest
from lumivox.operators import kernels as k
from lumivox.operators import regions
from lumivox.plans import runner, stages
from lumivox.plans.params import Params
from pyspark.sql import functions as F

EXTENT = (24, 20, 12)


def dense(seed=0, extent=EXTENT):
    """Smooth blobs on a floor of noise."""
    rng = np.random.default_rng(seed)
    v = np.zeros(extent)
    for _ in range(14):
        at = [rng.uniform(2, n - 3) for n in extent]
        g = sum((np.indices(extent)[a] - at[a]) ** 2 for a in range(3))
        v += rng.uniform(300, 900) * np.exp(-g / rng.uniform(2, 5))
    return v + rng.uniform(0, 3, extent)


def rows(v, *front):
    return [(*front, *(int(i) + 1 for i in at), float(v[at])) for at in np.ndindex(v.shape)]


def table(spark, v, fov=1):
    return spark.createDataFrame(rows(v, fov), "fov int, y int, x int, z int, value double")


def array(df, extent=EXTENT):
    out = np.full(extent, np.nan)
    for r in df.collect():
        out[r["y"] - 1, r["x"] - 1, r["z"] - 1] = r["value"]
    return out


def test_blocks_with_an_extent_mirror_the_border(spark):
    v = dense()
    got = k.map_blocks(table(spark, v), lambda b: k.dog(b), (9, 8, 5), 6, ["fov"], extent=EXTENT)
    assert np.allclose(array(got), k.dog(v))


def test_corners_of_blocks_are_those_of_the_array(spark):
    v = dense(1)
    got = k.corners(table(spark, v), EXTENT, (9, 8, 5), ["fov"])
    found = {(r["y"] - 1, r["x"] - 1, r["z"] - 1) for r in got.collect()}
    assert found == set(map(tuple, k.harris(v).tolist())) and found


def test_descriptors_of_blocks_are_those_of_the_array(spark):
    v = dense(2)
    keys = [(2, 3, 2), (9, 8, 5), (10, 9, 6), (24, 20, 12), (1, 1, 1)]
    points = spark.createDataFrame([(1, *p) for p in keys], "fov int, y int, x int, z int")
    got = k.descriptors(points, table(spark, v), EXTENT, (9, 8, 5), ["fov"], half=3)
    found = {(r["y"], r["x"], r["z"]): r["ivec"] for r in got.collect()}
    assert found.keys() == set(keys)
    for p in keys:
        assert found[p] == k.descriptor(v, [i - 1 for i in p], 3).astype(float).tolist()


def test_shifts_of_volumes(spark):
    v, moved = dense(3), np.roll(dense(3), (-2, 1, 0), (0, 1, 2))
    pair = table(spark, v), table(spark, moved).union(table(spark, v, 2))
    for shift in (lambda a, b: k.phase_shift(a, b, (4, 4, 4)), lambda a, b: k.subpixel_shift(a, b)):
        got = k.volume_shifts(*pair, ["fov"], EXTENT, shift).collect()
        assert [tuple(r) for r in got] == [(1, 2.0, -1.0, 0.0)]


def test_subpixel_shift_of_a_band_limited_signal():
    at = np.indices((32, 32))
    wave = lambda dy, dx: sum(np.cos(2 * np.pi * (a * (at[0] - dy) + b * (at[1] - dx)) / 32 + a) for a in range(4) for b in range(4))
    assert np.allclose(k.subpixel_shift(wave(0, 0), wave(-1.3, 2.6), 10), (1.3, -2.6))


def test_correlation_shift_is_the_best_coefficient():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 28))
    move = np.zeros_like(base)
    move[:-4, 3:] = base[4:, :-3]
    assert k.correlation_shift(base, move, 8) == (4, -3)
    assert k.correlation_shift(base, base, 8) == (0, 0)


@pytest.mark.parametrize("by", [[], ["code"]])
def test_connected_regions(spark, by):
    rng = np.random.default_rng(5)
    code = rng.integers(0, 3, (9, 8, 7))
    code[0, :, 0], code[:, 0, 0] = 1, 1
    listed = [(int(code[p]) or None, *(int(i) + 1 for i in p)) for p in np.ndindex(code.shape) if code[p] < 2]
    df = spark.createDataFrame(listed + listed[:3], "code int, y int, x int, z int")
    got = regions.connected(df, by).collect()
    assert len(got) == len(listed)
    want = {}
    for masks in [[code == 0, code == 1] if by else [code < 2]]:
        for m in masks:
            labels = k.components(m)
            for n in range(1, labels.max() + 1):
                cells = [tuple(int(i) + 1 for i in p) for p in np.argwhere(labels == n)]
                want |= dict.fromkeys(cells, min((y << 42) + (x << 21) + z for y, x, z in cells))
    assert {(r["y"], r["x"], r["z"]): r["region"] for r in got} == want


def test_a_snake_is_one_region(spark):
    snake = [(y, x, 1) for y in range(1, 20, 2) for x in range(1, 12)] + [(y, 11 if y % 4 == 2 else 1, 1) for y in range(2, 19, 2)]
    df = spark.createDataFrame(snake, "y int, x int, z int")
    assert regions.connected(df).select("region").distinct().count() == 1
    assert regions.connected(df.limit(0)).count() == 0


def test_reads_of_regions(spark):
    calls = [(r, y, 1, 1, b) for y in (1, 2, 3, 5) for r, b in ((3, 4), (4, 2), (5, 1 if y < 3 else 3))] + [(4, 9, 1, 1, None)]
    df = spark.createDataFrame(calls, "round int, y int, x int, z int, base int")
    got = regions.region_reads(regions.voxel_codes(df, 4), 1).orderBy("cy").collect()
    assert [(r["code"], r["n_voxels"], r["cy"]) for r in got] == [(12, 2, 1.5), (32, 1, 3.0), (32, 1, 5.0)]
    assert regions.region_reads(regions.voxel_codes(df, 4), 2).count() == 1


CENTRES = [(8, 8, 6), (8, 24, 6), (24, 8, 6), (24, 24, 10)]
WIDE = (32, 32, 14)


def blobs(spark, fov=1):
    listed = []
    for round_ in (1, 2):
        for channel in (1, 2):
            v = np.full(WIDE, 10.0)
            for i, c in enumerate(CENTRES):
                if i % 2 == channel % 2:
                    v += 1000 * np.exp(-sum((np.indices(WIDE)[a] + 1 - c[a]) ** 2 for a in range(3)) / 8)
            listed += rows(v, fov, round_, channel)
    return spark.createDataFrame(listed, "fov int, round int, channel int, y int, x int, z int, value double")


def test_segmentation_recovers_simulated_puncta(spark, tmp_path):
    voxels = blobs(spark)
    pipeline = runner.Pipeline([("load", ("voxels",), lambda s, t, p: {"voxels": voxels}), *stages.segmentation_stages()], str(tmp_path / "out"))
    report = pipeline.run(spark, Params())
    assert [r[1] for r in report.rows] == ["done", "done"]
    got = spark.read.parquet(str(tmp_path / "out" / "puncta")).collect()
    near = sorted(tuple(round(r[f"c{a}"]) for a in "yxz") for r in got)
    assert len(near) == 4 and all(max(abs(a - b) for a, b in zip(p, c)) <= 1 for p, c in zip(near, sorted(CENTRES)))


def test_segmentation_of_odd_input(spark):
    voxels = blobs(spark)
    empty, cells = stages.segmentation(voxels.limit(0))
    assert empty.count() == 0 and cells.count() == 0
    dark, _ = stages.segmentation(voxels.withColumn("value", F.lit(0.0)))
    assert dark.count() == 0


def test_spots_take_the_mean_of_their_box(spark):
    voxels = blobs(spark)
    summed = voxels.groupBy("fov", "y", "x", "z").agg(F.sum("value").alias("value"))
    got = stages.spots(summed, voxels, WIDE, 1, 1, 500).collect()
    assert {(r["y"], r["x"], r["z"]) for r in got} == set(CENTRES) and len(got) == 16
    lit = {(r["y"], r["x"], r["channel"]): r["intensity"] for r in got if r["round"] == 1}
    assert all(lit[c[0], c[1], 2 if i % 2 == 0 else 1] > 500 for i, c in enumerate(CENTRES)) and {r["n_peak"] for r in got} == {27}


def test_channel_regions_follow_the_winner(spark):
    got = stages.channel_regions(blobs(spark).drop("fov"), WIDE, (20, 20, 14), 5)
    found = got.groupBy("round", "channel", "label").agg(*(F.avg(a).alias(a) for a in "yxz")).collect()
    for i, c in enumerate(CENTRES):
        hits = [r for r in found if max(abs(r[a] - p) for a, p in zip("yxz", c)) <= 2]
        assert {(r["round"], r["channel"]) for r in hits} == {(1, 2 if i % 2 == 0 else 1), (2, 2 if i % 2 == 0 else 1)}


def test_registration_recovers_a_shift(spark):
    extent = (40, 40, 20)
    rng = np.random.default_rng(6)
    large = np.zeros((46, 46, 20))
    for _ in range(60):
        at = [rng.uniform(0, n) for n in large.shape]
        large += rng.uniform(300, 900) * np.exp(-sum((np.indices(large.shape)[a] - at[a]) ** 2 for a in range(3)) / rng.uniform(2, 6))
    fixed, moving = large[3:43, 3:43], large[5:45, 0:40]
    got = stages.registration(table(spark, fixed), table(spark, moving), extent, (24, 24, 20), half=4, full=False).collect()
    assert len(got) == 1 and got[0]["inliers"] >= 10
    # every position within half a voxel: keypoints are whole voxels, and inliers may lie two microns (twelve voxels) off
    m = np.array(got[0]["matrix"]).reshape(3, 4)
    at = np.indices(extent).reshape(3, -1).T + 1
    assert np.abs(at @ m[:, :3].T + m[:, 3] - (at + [2, -3, 0])).max() < 0.5
