"""The pipeline's stages take effect and keep the columns of documents."""

import corpus_pipeline as P


def test_stages(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120)
    passage = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first()["text"]
    base = docs.first()
    text = " ".join(f"word{i}" for i in range(80))
    extra = [(10_001, None, "en", "s", 0), (10_002, "12 34", "en", "s", 5),
             (10_003, base["text"], "en", "s", 1), (10_004, f"{text} {passage} tail", "en", "s", 1),
             (10_005, "mail me at jo.doe@mail.example.com about the weather in the north today", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).cache()
    seen = {}
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == before.columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not {10_001, 10_002} & set(seen["language_id"]) and base["doc_id"] in seen["language_id"]
    assert 10_003 not in seen["ngram_jaccard_join"] and base["doc_id"] in seen["ngram_jaccard_join"]
    assert passage[:60] not in seen["benchmark_decontamination"][10_004]
    assert "word79" in seen["benchmark_decontamination"][10_004]
    assert "[EMAIL]" in seen["personal_data"][10_005] and "jo.doe" not in seen["personal_data"][10_005]
    pieces = P.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r["doc_id"] for r in pieces} == set(seen["personal_data"])


def test_a_task_of_the_pipeline_holds_one_python_worker(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    for name, stage in P.STAGES[2:]:
        plan = stage(spark, docs, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1, name
