"""The pipeline's stages on planted rows, and the whole of it on the smallest tables."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from loanmart.llm import decontamination, jaccard, quality
from loanmart.session import materialize
from tests.conftest import SF_SMALL


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "language", "near_duplicates", "decontamination", "tokens"]
    inputs, now = {}, docs
    for name, stage in P.STAGES:
        inputs[name] = now
        out = materialize(stage(spark, now, SF_SMALL), "pipeline-test")
        assert out.count() <= now.count() and set(out.select("doc_id").toPandas().doc_id) <= set(now.select("doc_id").toPandas().doc_id)
        if name != "tokens":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        now = out
    # each decision against its operator, on that stage's own input
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scores = quality.score(inputs["quality"], quality.fit(inputs["quality"], quality.grades_of(labels)))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(inputs["language"]) == ids(scores.where("selected"))
    parts = jaccard.jaccard_components(inputs["near_duplicates"])
    assert ids(inputs["decontamination"]) == ids(parts.where("doc_id = component_id"))
    assert not decontamination.scan(inputs["tokens"], spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).where("n_hit > 0").count()
    assert ids(now) == ids(inputs["tokens"]) == sorted(r.doc_id for r in P.run(spark, SF_SMALL).collect())


def test_stages_take_odd_and_empty_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words", "en", None, 10), (3, "some words", "xx", "s", 10), (3, "some words", "xx", "s", 10), (4, "z " * 40_000, "en", "s", 80_000)]
    for data in (rows, []):
        now = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES:
            now = materialize(stage(spark, now, SF_SMALL), "pipeline-odd")
        assert now.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and now.count() <= len(data)


def test_clashing_columns_pass_all_stages(spark):
    names = ["_id", "_hash", "_tie", "_text", "_y", "hash", "row", "key", "kept", "selected", "spans", "component"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plain, now = docs, docs
    for k, n in enumerate(names):
        now = now.withColumn(n, F.concat(F.lit(f"{k}-"), F.col("doc_id").cast("string")))
    wide = now.columns
    for name, stage in P.STAGES:
        plain, now = (materialize(stage(spark, d, SF_SMALL), "pipeline-clash") for d in (plain, now))
        rows = lambda d: sorted(map(tuple, d.select(*plain.columns).drop("ids").collect()), key=str)
        assert rows(now) == rows(plain), name
        if name != "tokens":
            assert now.columns == wide
            assert all(r[n] == f"{k}-{r.doc_id}" for r in now.collect() for k, n in enumerate(names))
