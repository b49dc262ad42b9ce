"""The pipeline's stages against brute force over their own inputs."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from calloom.llm import line_quality, mixing, simhash
from calloom.session import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, made = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, docs, SF))
        made.append((name, docs, out))
        docs = out
    return {name: (before, after) for name, before, after in made}


def test_stages_keep_the_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns, name
        assert 0 < after.count() <= before.count()


def test_quality(stages):
    before, after = stages["quality_rules"]
    kept = {r.doc_id: r.cleaned for r in line_quality.judge(before).collect() if r.kept}
    assert {r.doc_id: r.text for r in after.collect()} == kept
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_language_keeps_clean_documents(stages):
    before, after = stages["language_id"]
    assert after.count() >= 0.98 * before.count()


def test_one_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    classes = simhash.near_duplicates(before).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in classes})


def test_sample(stages):
    before, after = stages["mixing_weights"]
    mixed = mixing.mix(mixing.measure(before)).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in mixed if r.kept)
    tokens = sum(r.n_tokens for r in mixed)
    assert sum(r.n_tokens * r.probability for r in mixed) == pytest.approx(mixing.BUDGET * tokens, rel=1e-6)


def test_digests(stages, word_vocabulary):
    before, after = stages["encode_and_decode"]
    library, texts = Tokenizer.from_file(word_vocabulary), {r.doc_id: r.text for r in before.collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = after.collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert (row.n_tokens, row.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert row.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_a_task_of_the_last_stage_has_one_python_worker(spark, hard):
    plan = corpus_pipeline.encode_and_decode(spark, hard, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1, plan


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["encode_and_decode"][1].collect()))


def test_hard_documents_pass_through(spark, hard, none):
    for docs in (hard.withColumn("n_chars", F.length("text").cast("long")), none.withColumn("n_chars", F.lit(0).cast("long"))):
        for _, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, SF))
        assert docs.count() >= 0
