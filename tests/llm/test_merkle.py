"""The Merkle manifest against a plain recursive one."""

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from extractkit.llm import merkle
from extractkit.llm.merkle import fold, leaf, manifest
from extractkit.llm.queries import merkle_report

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(nodes):
    """The root and, for each node, its siblings from below to above."""
    proofs, at, members = [[] for _ in nodes], list(nodes), [[i] for i in range(len(nodes))]
    while len(at) > 1:
        upper, groups = [], []
        for start in range(0, len(at), 16):
            run = at[start : start + 16]
            for i in range(len(run)):
                for m in members[start + i]:
                    proofs[m].append((run[:i], run[i + 1 :]))
            upper.append(H("".join(run)))
            groups.append([m for g in members[start : start + 16] for m in g])
        at, members = upper, groups
    return at[0], proofs


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        members = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = (members, *tree_of([plain_leaf(r) for r in members]))
    root, tops = tree_of([trees[n][1] for n in names]) if names else (None, [])
    out = []
    for name, top in zip(names, tops):
        members, subroot, proofs = trees[name]
        for row, proof in zip(members, proofs):
            path = proof + top
            changed = row
            if row[0] is not None and crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                changed = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            folded = plain_leaf(changed)
            for left, right in path:
                folded = H("".join(left) + folded + "".join(right))
            told = "".join("".join(left) + "".join(right) for left, right in path)
            out.append((row[0], plain_leaf(row), subroot, root, H(told), folded, folded == root))
    return sorted(out, key=repr)


def answers(frame):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def corpus():
    rows = [(i, "hot", "en", i, f"Text {i} É") for i in range(700)]
    rows += [(i, "just", None, 0, "") for i in range(1000, 1256)] + [(i, "more", "en", 1, None) for i in range(2000, 2257)]
    rows += [(i, "run", "en", 1, "A") for i in range(3000, 3016)] + [(i, "rest", "en", 1, "B") for i in range(3100, 3117)]
    rows += [(5000, None, None, None, None), (5001, "", "x", 1, "One"), (5002, "Z", "x", 1, "Two"), (5003, "é", "x", 1, "Three"), (5004, "a", "x", 1, "Four")]
    return rows + [(6000 + i, f"s{i}", "de", 1, "Lone") for i in range(30)]


def test_equals_brute_force(spark):
    rows = corpus()
    got = answers(merkle_report(spark.createDataFrame(rows, SCHEMA).repartition(6)))
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_around_a_round(spark, n):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(n)]
    assert answers(merkle_report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_repeated_rows_and_null_ids_are_leaves_of_their_own(spark):
    rows = [(None, "s", None, None, None)] * 20 + [(3, "s", "en", 1, "Same")] * 20 + [(3, "s", "en", 1, "Other")]
    got, wanted = answers(merkle_report(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert got == wanted


def test_odd_rows(docs, no_docs):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert answers(merkle_report(docs)) == brute(rows)
    assert merkle_report(no_docs).count() == 0


def test_a_path_leads_to_the_root_and_a_changed_leaf_does_not(spark):
    rows = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"))
    found = manifest(rows.withColumn("leaf", leaf(F.col("doc_id"))).withColumn("note", F.col("doc_id") * 2), carry=("note", "doc_id"))
    checked = found.select((fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("good"), (fold(F.sha2("leaf", 256), F.col("path")) == F.col("root")).alias("bad"), "note", "doc_id")
    assert {(r.good, r.bad, r.note == 2 * r.doc_id) for r in checked.collect()} == {(True, False, True)}
    with pytest.raises(ValueError, match="path"):
        manifest(rows.withColumns({"leaf": F.lit("ab"), "path": F.lit(1)}), carry=("path",))


def test_a_hot_tree_is_swept_by_many_tasks(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("source"), F.lit(7).alias("doc_id"), F.lit("ab" * 32).alias("leaf"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in manifest(rows).groupBy(F.spark_partition_id()).count().collect()]
        nodes = merkle.forest(rows.select(F.col("source").alias("tree"), F.col("doc_id").alias("key"), F.unhex("leaf").alias("digest"))).rounds
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 6_000
    assert [n.count() for n in nodes] == [20_000, 79, 1]
