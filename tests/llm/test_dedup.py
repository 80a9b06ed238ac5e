"""Near-duplicates against brute force."""

import random
from itertools import combinations

import pytest

from extractkit.llm import minhash
from extractkit.llm.components import connected_components
from extractkit.llm.minhash import near_duplicates, shingle_set, sketch


def brute(rows, width, percent):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        shingles = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        sets[doc_id] = shingles
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def corpus(seed, n=260):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 90))] for _ in range(25)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.1 else w for w in text)))
    return rows


def answers(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_equals_brute_force(spark):
    rows = corpus(1)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert answers(near_duplicates(frame, 4, 80)) == brute(rows, 4, 80)


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 3)
    monkeypatch.setattr(minhash, "BLOCK", 5)
    rows = corpus(2)
    assert answers(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80)) == brute(rows, 4, 80)


def test_odd_rows(docs):
    found = near_duplicates(docs, 5, 80).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].component_id == by_id[2].component_id == by_id[3].component_id == 1 and by_id[8].component_id == 7
    assert all(by_id[d].n_shingles == 0 and by_id[d].component_id == d and by_id[d].kept for d in (4, 5, 6))
    assert by_id[None].component_id is None and by_id[None].kept and not by_id[2].kept


def test_rows_of_one_id_count_as_one_document(spark):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, one), (5, two), (3, one), (9, two), (7, "c d e f g")]
    assert {d: c for d, (_, c) in answers(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))).items()} == {5: 3, 3: 3, 9: 3, 7: 7}


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_sketch_estimates_similarity():
    one, other = shingle_set(b" ".join(b"a%d" % i for i in range(400)), 1), shingle_set(b" ".join(b"a%d" % i for i in range(100, 500)), 1)
    assert abs((sketch(one) == sketch(other)).mean() - 0.6) < 0.15
    assert (sketch(one[:1]) != 0).all()


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "a long, b long")
    found = {r.id: r.component for r in connected_components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 90: 90, 100: 90}


def test_a_percent_that_the_bands_do_not_cover_is_refused(docs):
    for percent in (50, 79, 101):
        with pytest.raises(ValueError, match="percent"):
            near_duplicates(docs, 5, percent)
