"""The pipeline, stage by stage."""

import random

from pyspark.sql import functions as F

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_odd_rows(spark, docs, no_docs):
    for frame in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, frame, FOLDER)
            assert found.columns == frame.columns, name
            assert found.count() <= frame.count()
        packed = corpus_pipeline.packing(spark, frame, FOLDER)
        assert packed.select("doc_id").distinct().count() == frame.select("doc_id").distinct().count()


def test_each_stage_works_on_what_the_one_before_kept(spark):
    folder = "/root/testdata/sf0.01"  # enough labels to learn from
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    ids = {r.doc_id for r in frame.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder).cache()
        now = {r.doc_id for r in frame.collect()}
        assert now <= ids
        ids = now
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, folder)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids
    assert sum(labels[d].toxic for d in ids if d in labels) <= 0.3 * sum(r.toxic for r in labels.values())


def test_every_distinct_text_of_a_repeated_id_stays(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(900)], k=60)) for _ in range(25)]
    near = [t + " more" for t in texts]
    rows = [(rng.choice([None, *range(12)]), rng.choice(texts + near), rng.choice("ab")) for _ in range(120)] + [(50, texts[0], "a"), (51, "", "a"), (51, None, "b"), (51, "", "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    results = []
    for order in (frame, frame.repartition(7, "text"), frame.orderBy(F.desc("text"))):
        found = corpus_pipeline.near_dedup(spark, order, FOLDER)
        assert found.columns == frame.columns
        results.append(sorted(map(str, found.collect())))
    assert results[0] == results[1] == results[2]
    kept = corpus_pipeline.near_dedup(spark, frame, FOLDER).collect()
    assert sorted(str(r) for r in kept if r.doc_id is None) == sorted(str(r) for r in frame.collect() if r.doc_id is None)
    named = [r for r in kept if r.doc_id is not None]
    groups = [t.removesuffix(" more") for t in (r.text for r in named) if t]
    assert sorted(groups) == sorted({t.removesuffix(" more") for d, t, _ in rows if d is not None and t})
    assert {(r.doc_id, r.text) for r in named} <= {(d, t) for d, t, _ in rows}
    assert sum(not r.text for r in named) == 1  # the empty text and the null of id 51


def test_the_smallest_of_unique_ids_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(9, text), (4, text + " x"), (7, text), (7, "other words altogether"), (1, "one")]
    found = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER)
    assert sorted(map(tuple, found.collect())) == [(1, "one"), (4, text + " x"), (7, "other words altogether")]
    full = [*rows, ((1 << 63) - 1, "last")]  # no room above: one of the group stays all the same
    found = corpus_pipeline.near_dedup(spark, spark.createDataFrame(full, "doc_id long, text string"), FOLDER)
    assert sorted(r.text[:5] for r in found.collect()) == ["last", "one", "other", "w0 w1"]
