"""Exact duplicates against brute force, chunks against a byte-by-byte cut."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from extractkit.llm import exact_dedup
from extractkit.llm.exact_dedup import as_recipes, chunk_store, cuts, equal_recipes, exact_duplicates, one_space, texts_of

SCHEMA = "doc_id long, text string"


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(plain(text), []).append(doc_id)
    return sorted((d, min(groups[plain(t)]), len(groups[plain(t)]), d == min(groups[plain(t)])) for d, t in rows)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"wörd{i}" for i in range(500)] + [" ", " x"]
    long = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 3000))) for _ in range(12)] + ["a" * 70_000, "", " ", "a"]
    rows = []
    for i in range(150):
        text = rng.choice(long)
        roll = rng.random()
        if roll < 0.2:
            text = text.replace(" ", rng.choice(["\n", "\t \r", "  ", "\x0b\x0c"]))
        elif roll < 0.4:
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(["!", " ", "\x1f"]) + text[at:]
        elif roll < 0.5:
            text = rng.choice(long) + text
        rows.append((i, text))
    return rows + [(150, None), (-7, "a")]


def answers(frame):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in frame.collect())


def test_equals_brute_force(spark):
    rows = corpus(1)
    assert answers(exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_recipes_and_chunks_give_the_texts_back(spark):
    rows = corpus(2)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: bytes(r.text).decode() for r in texts_of(as_recipes(frame, 3), chunk_store(frame, 3)).collect()}
    assert got == {d: plain(t) for d, t in rows}
    assert {r.doc_id: bytes(r.text).decode() for r in as_recipes(frame, 3).collect()} == got


def test_cuts_depend_on_the_text_alone():
    texts = [plain(t).encode() for _, t in corpus(3)]
    together = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    starts, ends = cuts(together, offsets)
    assert (starts[1:] == ends[:-1]).all() and (ends - starts <= exact_dedup.MOST).all()
    for i, text in enumerate(texts):
        alone = cuts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        mine = (starts >= offsets[i]) & (starts < offsets[i + 1])
        assert (starts[mine] - offsets[i]).tolist() == alone[0].tolist() and (ends[mine] - offsets[i]).tolist() == alone[1].tolist()


def test_cuts_by_a_plain_loop(monkeypatch):
    monkeypatch.setattr(exact_dedup, "SEGMENT", 1000)
    data = np.random.default_rng(4).integers(0, 256, 60_000).astype(np.uint8)
    gear = exact_dedup._GEAR.tolist()
    asked, h = [], 0
    for i, b in enumerate(data.tolist()):
        h = ((h << 1) + gear[b]) & 0xFFFFFFFF
        if h >> 22 == 0:
            asked.append(i)
    assert [i for i in exact_dedup.asked_cuts(data).tolist() if i >= 31] == [i for i in asked if i >= 31]
    assert 30 < len(asked) < 100


def test_a_passage_in_other_surroundings_gives_the_same_chunks(spark):
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randrange(9999)}" for _ in range(3000))
    rows = [(1, passage), (2, "other words before " + passage), (3, passage + " and after")]
    chunks = chunk_store(spark.createDataFrame(rows, SCHEMA)).count()
    assert chunks < 1.4 * chunk_store(spark.createDataFrame(rows[:1], SCHEMA)).count() + 4


def test_a_seed_that_gives_two_contents_one_identifier_is_passed_over(spark, monkeypatch):
    strong = exact_dedup.identifier
    monkeypatch.setattr(exact_dedup, "identifier", lambda chunk, seed: bytes(16) if seed < 2 else strong(chunk, seed))
    rows = corpus(6)[:40]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert exact_dedup.verified_seed(frame) == 2
    assert answers(exact_duplicates(frame)) == brute(rows)


def test_odd_rows(docs, no_docs):
    found = exact_duplicates(docs, carry=("source", "rank")).collect()
    assert len(found) == docs.count() and {r.rank for r in found} == {"clash"}
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [(r.keep_id, r.group_size, r.kept) for r in by_id[1]] == [(1, 3, True)]
    assert [(r.keep_id, r.group_size, r.kept) for r in by_id[3]] == [(1, 3, False)] * 2
    assert by_id[4][0].group_size == 2 and by_id[5][0].keep_id == 4 and by_id[6][0].group_size == 1
    assert exact_duplicates(no_docs).count() == 0


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a"), (None, "a"), (5, "b"), (5, "b"), (None, "b"), (3, "b ")]
    got = exact_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    of_a = [r for r in got if r.group_size == 2]
    assert len(of_a) == 2 and all(r.keep_id is None for r in of_a) and sum(r.kept for r in of_a) == 1
    of_b = [r for r in got if r.group_size == 3]
    assert {r.keep_id for r in of_b} == {5} and sum(r.kept for r in of_b) == 1 and all(r.doc_id == 5 for r in of_b if r.kept)


def test_a_taken_name_is_refused(docs):
    with pytest.raises(ValueError, match="recipe"):
        as_recipes(docs.withColumn("recipe", F.lit(1)), 0, ("recipe",))


def test_a_group_of_most_rows_is_dealt_to_many_tasks(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(b"0123456789abcdef").alias("recipe"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = equal_recipes(rows)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 4 and max(sizes) < 8_000 and found.where("kept").count() == 1


def test_white_space_at_the_edges_of_texts():
    data = np.frombuffer(b" a  " + b"  " + b"\t\nb" + b"", np.uint8)
    got, offsets = one_space(data, np.array([0, 4, 6, 9, 9]))
    assert got.tobytes() == b" a " + b" " + b" b" and offsets.tolist() == [0, 3, 4, 6, 6]
