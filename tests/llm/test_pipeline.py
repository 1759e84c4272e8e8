import pathlib

import corpus_pipeline
from lumivox.llm import common, decontamination, quality, secrets
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def test_stages_and_their_decisions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = {r[0] for r in docs.select("doc_id").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, DATA).cache()
        ids = [r[0] for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= kept
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        seen[name] = (before, docs)
        kept = set(ids)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "mixing"]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.fit(seen["quality"][0], labels)
    accepted = quality.score_quality(seen["quality"][0], model).filter("predicted = 1").count()
    assert seen["quality"][1].count() == accepted
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    hits = decontamination.find_contamination(seen["decontamination"][1], bench)
    assert hits.filter("n_hit > 0").count() == 0
    assert secrets.find_secrets(seen["secrets"][1]).filter("size(secrets) > 0").count() == 0


def test_run_writes_between_stages_and_cleans_up(spark):
    folder = pathlib.Path(common.shared_folder(spark).removeprefix("file:"))
    before = {p for p in folder.rglob("*") if p.is_dir()}
    out = corpus_pipeline.run(spark, DATA)
    assert out.count() > 50 and {"doc_id", "text", "taken"} <= set(out.columns)
    made = [p for p in folder.rglob("*") if p.is_dir() and p not in before]
    assert sorted(p.name for p in made if p.parent.name.startswith("corpus_pipeline-")) == ["mixing"]
    assert not [p for p in made if p.name.startswith("rdd-")]


def test_stages_with_odd_rows_and_clashing_names(spark, tmp_path):
    """Repeated and missing ids, missing texts, and columns named as the operators' own."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = ("score", "predicted", "size", "secrets", "node", "component", "taken", "items", "key", "epochs")
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (1, "A wholly different text under a known id, and of good quality, too.", "en", "web", 69),
         (None, "A text without an id that is told in some words.", "en", None, 48), (5, "", "en", "web", 0), (5, "", "en", "web", 0)],
        docs.schema,
    )
    docs = docs.unionByName(odd)
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept = [n for n in names if n not in ("size", "taken")] if k == 4 else names
        assert docs.count() > 50 and docs.filter(" or ".join(f"{n} <> '{n}'" for n in kept)).isEmpty()


def test_empty_documents(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
