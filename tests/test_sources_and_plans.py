import numpy as np
import pytest
from lumivox.operators import decode, normalize, puncta, simulate, volume
from lumivox.plans.params import Params
from lumivox.plans.runner import Pipeline
from lumivox.sources import readers, sinks
from lumivox.streaming import ingest
from pyspark.sql import functions as F


def test_volumes_round_trip(spark, tmp_path):
    a = np.random.default_rng(0).integers(0, 65536, (4, 3, 2)).astype(np.uint16)
    np.save(tmp_path / "exp_round001_ch00.npy", a)
    (tmp_path / "exp_round002_ch00.raw").write_bytes(np.array(a.shape, "<i4").tobytes() + a.astype("<u2").tobytes())
    got = readers.read_volumes(spark, str(tmp_path)).collect()
    assert len(got) == 2 * a.size and all(a[r["y"] - 1, r["x"] - 1, r["z"] - 1] == r["value"] for r in got)
    assert readers.read_volumes(spark, str(tmp_path), planes=(2, 2)).count() == a.size
    dims = readers.image_dimensions(readers.read_volumes(spark, str(tmp_path))).first()
    assert (dims["ny"], dims["nx"], dims["nz"]) == a.shape
    catalog = readers.read_catalog(spark, str(tmp_path)).orderBy("round").collect()
    assert [(r["base"], r["round"], r["channel"], r["scale"]) for r in catalog] == [("exp", 1, "ch00", "full"), ("exp", 2, "ch00", "full")]
    out = spark.createDataFrame([(1, 1, 1, -3.0), (1, 1, 2, 70000.0), (1, 2, 1, 2.5)], "y int, x int, z int, value double")
    assert sinks.write_volume(out, str(tmp_path / "v")) == {"clamped": 2}
    assert sorted(r["value"] for r in spark.read.parquet(str(tmp_path / "v")).collect()) == [0, 3, 65535]


def test_unknown_and_missing_formats():
    with pytest.raises(ValueError):
        readers.decode_volume("a.xyz", b"")
    with pytest.raises(RuntimeError):
        readers.decode_volume("a.tif", b"")


def test_small_text_formats(spark, tmp_path):
    (tmp_path / "codes.fa").write_text(">gene1_a\nACGT\n>gene2\nNNTA\n")
    codes = decode.codebook_from_fasta(readers.numbered_lines(spark, str(tmp_path / "codes.fa"))).orderBy("code_id").collect()
    assert [(r["name"], r["codes"]) for r in codes] == [("gene1_a", [1, 2, 3, 4]), ("gene2", [0, 0, 4, 1])]
    (tmp_path / "t.txt").write_text("Colors: red one\nLocation: 1 2 3\nLocation: 4, 5, 6\nColors: blue\nLocation: 7 8 9\n")
    tokens = readers.read_tokens(readers.numbered_lines(spark, str(tmp_path / "t.txt"))).collect()
    assert [(r["gene"], r["y"]) for r in tokens] == [("red one", 1.0), ("red one", 4.0), ("blue", 7.0)]
    (tmp_path / "x.xml").write_text("<a><row><k>1</k></row><row><k>2</k></row></a>")
    assert readers.read_xml(spark, str(tmp_path / "x.xml"), "row").agg(F.sum("k")).first()[0] == 3
    assert readers.read_flat_yaml("a: 1\nb: [1, x]  # c\nc: 'q'\n# d: 2\ne: true") == {"a": 1, "b": [1, "x"], "c": "q", "e": True}
    assert readers.read_assignments("% x = 1;\na.b = 'c';\nn=4;") == {"a.b": "'c'", "n": "4"}
    stacks = spark.createDataFrame([(0, "x_F001.tif", 3, 4), (1, "y_F001.tif", 9, 9)], "n int, pattern string, row int, col int")
    assert tuple(readers.stack_position(stacks, 1).first()) == (3, 4) and tuple(readers.stack_position(stacks, 2).first()) == (-1, -1)


def test_parameters():
    p = Params.override("rounds=7,ties=mean,CLAMP_PERCENTILE=0.5", seed=3)
    assert (p.rounds, p.ties, p.clamp_percentile, p.seed) == (7, "mean", 0.5, 3)
    with pytest.raises(KeyError):
        Params.override("nonsense=1")


def test_runner_keeps_skips_and_fails(spark, tmp_path):
    calls = []

    def first(session, tables, params):
        calls.append("first")
        return {"a": session.range(params.rounds)}

    def second(session, tables, params):
        calls.append("second")
        return {"b": tables["a"].selectExpr("id * 2 AS id")}

    plan = Pipeline([("one", ("a",), first), ("two", ("b",), second)], str(tmp_path))
    assert [r[1] for r in plan.run(spark, Params()).rows] == ["done", "done"]
    assert [r[1] for r in plan.run(spark, Params()).rows] == ["kept", "kept"] and calls == ["first", "second"]
    assert [r[1] for r in plan.run(spark, Params(rounds=2), only=["two"], overwrite=True).rows] == ["skipped", "done"]
    assert [r[1] for r in plan.run(spark, Params(rounds=2), skip=["two"], overwrite=True).rows] == ["done", "skipped"]
    with pytest.raises(ValueError):
        plan.run(spark, Params(), only=["one"], skip=["two"])
    with pytest.raises(KeyError):
        plan.run(spark, Params(), only=["three"])
    broken = Pipeline([("bad", ("z",), lambda *_: {"z": spark.range(1).selectExpr("raise_error('x')")})], str(tmp_path))
    with pytest.raises(Exception, match="x"):
        broken.run(spark, Params())
    assert plan.run(spark, Params()).frame(spark).count() == 2


def test_incremental_ingest(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    seen = []
    for _ in range(2):
        q = ingest.watch(spark, str(tmp_path / "in"), "id long", lambda df, n: seen.append(df.count()), str(tmp_path / "cp"))
        q.awaitTermination(60)
    assert sum(seen) == 5
    spark.range(5, 8).write.mode("append").parquet(str(tmp_path / "in"))
    ingest.watch(spark, str(tmp_path / "in"), "id long", lambda df, n: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination(60)
    assert sum(seen) == 8


def test_guards_and_hooks(spark):
    df = spark.range(5).toDF("puncta_id")
    assert puncta.guard_count(df, 5000).count() == 5
    with pytest.raises(ValueError):
        puncta.guard_count(df, 4000)
    assert puncta.apply_filter(df, None) is df and puncta.apply_filter(df, lambda x: x.filter("puncta_id < 2")).count() == 2


def test_quantile_normalisation_of_one_small_table(spark):
    rows = [(1, 5, 4, 3, 1), (1, 2, 1, 4, 2), (1, 3, 4, 6, 3), (1, 4, 2, 8, 4)]
    df = spark.createDataFrame(rows, "round int, c1 int, c2 int, c3 int, c4 int")
    for small in (True, False, None):
        got = normalize.quantile_normalize(df, ["round"], small=small).orderBy("c4").collect()
        ranks = np.sort(np.array(rows)[:, 1:], axis=0).mean(axis=1)
        assert [r["norm4"] for r in got] == ranks.tolist()
        assert got[0]["norm2"] == got[2]["norm2"] == ranks[2:].mean()


def test_simulation_is_decoded_again(spark):
    codes = spark.createDataFrame([(0, "g0", [1, 2, 3, 4]), (1, "g1", [4, 3, 2, 1])], "code_id long, name string, codes array<int>")
    places = simulate.grid_puncta(spark, (40, 40, 8), 10).filter("puncta_id < 5")
    truth = simulate.assign_codes(places, codes, 1)
    voxels = simulate.render(truth, 4, (40, 40, 8), seed=1)
    peaks = truth.select("puncta_id", *(F.round(a).cast("int").alias(a) for a in "yxz"))
    called = voxels.join(peaks, ["y", "x", "z"]).groupBy("puncta_id", "round").agg(F.max_by("channel", "value").alias("base"))
    from lumivox.operators.basecall import assemble_reads

    reads = assemble_reads(called, 4)
    hits = decode.decode_min_unique(reads, codes, 4, 1)
    assert simulate.recovery(truth, hits).filter("n_truth <> n_found").count() == 0
    again = simulate.render(truth.repartition(5), 4, (40, 40, 8), seed=1)
    assert again.join(voxels, ["round", "channel", "y", "x", "z", "value"]).count() == voxels.count()


def test_translate_and_crop_undo(spark):
    df = spark.createDataFrame([(5, 6, 2, 1.0), (1, 1, 1, 2.0)], "y int, x int, z int, value double")
    bounds = {"y": (3, 9), "x": (2, 9)}
    back = volume.uncrop(volume.crop(df, bounds), bounds).collect()
    assert [(r["y"], r["x"]) for r in back] == [(5, 6)]
    assert volume.translate(df, (-1, 0, 0), (9, 9, 9)).count() == 1
