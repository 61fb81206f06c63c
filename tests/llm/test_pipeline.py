"""The corpus pipeline stage by stage: what goes, what stays and what changes."""

import re

import corpus_pipeline
from custgraph.llm import secrets
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        out = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(out)
        after = spark.read.parquet(out)
        if name != "mixing":
            assert after.columns == list(corpus_pipeline.COLUMNS)
        if name == "toxicity":
            toxic = docs.join(labels.where("toxic = 1"), "doc_id", "left_semi").count()
            left = after.join(labels.where("toxic = 1"), "doc_id", "left_semi").count()
            lost = docs.join(labels.where("toxic = 0"), "doc_id").count() - after.join(labels.where("toxic = 0"), "doc_id").count()
            assert left <= 0.3 * toxic and lost <= 0.02 * before
        elif name == "near_duplicates":
            assert after.groupBy(F.trim("text")).count().where("count > 1 and `trim(text)` <> ''").count() == 0
        elif name == "decontamination":
            holds = lambda t: any(i in (t or "") for i in items)
            dirty = {r["doc_id"] for r in docs.collect() if holds(r["text"])}
            gone = {r["doc_id"] for r in docs.join(after, "doc_id", "left_anti").collect()}
            assert dirty <= gone and len(gone) <= len(dirty) + 5
        elif name == "secrets":
            assert after.count() == before
            old = {r["doc_id"]: r["text"] for r in docs.collect()}
            for r in after.collect():
                assert r["text"] == secrets.redact(old[r["doc_id"]]) and r["n_chars"] == len(r["text"])
                assert not re.search(r"AKIA[A-Z0-9]{16}", r["text"])
        else:
            assert after.count() == before
        docs = after


def test_run_repeats(spark):
    first, second = (sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) for _ in range(2))
    assert first == second and first
