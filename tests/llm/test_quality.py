"""Quality rules against brute force, the classifier by held-out accuracy."""

import collections
import random
import re
import string

import numpy as np
from pyspark.sql import functions as F

from extractkit.llm import quality_classifier as qc
from extractkit.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, own=None):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    marks = [c for c in text if c in string.punctuation]
    lone = [w for w in words if all(c in string.punctuation for c in w)]
    assert own is None or (own.n_marks, own.n_lone) == (len(marks), len(lone))
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(inside), n < 20 or 100 * len(inside) > 30 * n


def check(frame):
    for r in qr.judged(frame).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text, r)
        assert not (r.base_failed and r.kept)


def test_counts_equal_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(120):
        words = [rng.choice(["a", "bb", "é#", "x|y", "|", "-!", "\n", "\t", "\x0b", "\x1c", " "]) for _ in range(rng.randint(0, 90))]
        texts.append((rng.choice([" ", "  ", "\n"]).join(words) * rng.randint(1, 2),))
    check(spark.createDataFrame(texts, "text string"))


def test_odd_rows(docs):
    check(docs)
    assert qr.judged(docs).count() == docs.count()


def test_no_rows(no_docs):
    assert qr.judged(no_docs).count() == 0


def test_junk_of_one_kind_goes_and_prose_stays(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(500)]
    prose = [(i, 1, " ".join(rng.choices(words, k=80)) + ".") for i in range(300)]
    junk = [(i, 0, " ".join(w + "***" for w in rng.choices(words, k=80))) for i in range(300, 330)]
    kept = {r.doc_id: r.kept for r in qr.judged(spark.createDataFrame(prose + junk, "doc_id long, good int, text string")).collect()}
    assert all(kept[i] for i, _, _ in prose) and not any(kept[i] for i, _, _ in junk)


def planted(accuracies, good=0.7, n=20_000, abstain=0.2, seed=9):
    """Documents by (hidden quality, votes), with rules of the given accuracies on good and bad documents."""
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        q = rng.random() < good
        right = [rng.random() < on_good if q else rng.random() < on_bad for on_good, on_bad in accuracies]
        found.append((q, tuple(0 if rng.random() < abstain else 1 if r == q else -1 for r in right)))
    return found


PLANTED = [(0.9, 0.7), (0.8, 0.8), (0.95, 0.4), (0.7, 0.9), (0.85, 0.6), (0.9, 0.5)]
NAMES = list("abcdef")


def patterns_of(found):
    return sorted(collections.Counter(votes for _, votes in found).items())


def test_planted_accuracies_are_found():
    model = qr.expectation_maximisation(NAMES, patterns_of(planted(PLANTED)))
    assert abs(model.good - 0.7) < 0.05
    for name, want in zip(NAMES, PLANTED):
        assert np.allclose(model.accuracies[name], want, atol=0.05)


def test_no_single_rule_gives_the_verdict():
    found = planted(PLANTED)
    model = qr.expectation_maximisation(NAMES, patterns_of(found))
    verdict = [model.odds(dict(zip(NAMES, votes))) >= 0 for _, votes in found]
    right = np.mean([v == q for v, (q, _) in zip(verdict, found)])
    for k in range(len(NAMES)):
        alone = [votes[k] >= 0 for _, votes in found]
        assert np.mean(np.array(alone) != verdict) > 0.05
        assert right > np.mean([a == q for a, (q, _) in zip(alone, found)])


def log_posterior(x, patterns):
    """Of the share of good documents and accuracies, by the plain formula."""
    good, rates = x[0], x[1:].reshape(-1, 2)
    prior = qr.PRIORS[:2]
    value = 5 * np.log(good) + 5 * np.log(1 - good) + sum(r * np.log(p) + w * np.log(1 - p) for pair in rates for (r, w), p in zip(prior, pair))
    for votes, n in patterns:
        on = [good, 1 - good]
        for v, (g, b) in zip(votes, rates):
            if v:
                on = [on[0] * (g if v > 0 else 1 - g), on[1] * (b if v < 0 else 1 - b)]
        value += n * np.log(sum(on))
    return value


def test_no_other_model_is_more_probable():
    patterns = patterns_of(planted(PLANTED[:4], n=3000))
    model = qr.expectation_maximisation(NAMES[:4], patterns, rounds=5000, close=1e-12)
    best = np.array([model.good, *(p for name in NAMES[:4] for p in model.accuracies[name])])
    value, rng = log_posterior(best, patterns), np.random.default_rng(10)
    for size in (0.3, 0.03, 0.003):
        for _ in range(300):
            other = np.clip(best + rng.normal(0, size, best.shape), 1e-6, 1 - 1e-6)
            if all(g + b >= 1 for g, b in other[1:].reshape(-1, 2)):
                assert log_posterior(other, patterns) <= value + 1e-6
    for _ in range(3):  # a climb from elsewhere ends no higher
        x = np.concatenate([[0.5], np.full(8, 0.5) + rng.uniform(0.1, 0.45, 8)])
        at, step = log_posterior(x, patterns), 0.1
        while step > 1e-4:
            tries = [np.clip(x + rng.normal(0, step, x.shape), 1e-6, 1 - 1e-6) for _ in range(40)]
            tries = [t for t in tries if all(g + b >= 1 for g, b in t[1:].reshape(-1, 2))]
            top = max(((log_posterior(t, patterns), k) for k, t in enumerate(tries)), default=(at, -1))
            if top[0] > at:
                at, x = top[0], tries[top[1]]
            else:
                step /= 2
        assert at <= value + 1e-6


def test_copies_of_a_rule_are_one_opinion():
    found = planted(PLANTED)
    twice = [(q, (*votes, votes[0], votes[0])) for q, votes in found]
    one, three = (qr.expectation_maximisation(n, patterns_of(f)) for n, f in ((NAMES, found), ([*NAMES, "g", "h"], twice)))
    assert ("a", "g", "h") in three.opinions and len(three.opinions) == 6
    assert all(np.allclose(one.accuracies[n], three.accuracies[n], atol=1e-6) for n in NAMES)


def test_a_rule_worse_than_chance_has_no_weight():
    model = qr.expectation_maximisation(NAMES, patterns_of(planted([*PLANTED[:5], (0.3, 0.3)])))
    assert all(abs(w) < 1e-9 for w in model.weights()["f"])
    assert qr.expectation_maximisation(NAMES, []).opinions == tuple((n,) for n in NAMES)


def test_posterior_in_sql_is_that_of_the_model(spark):
    names = list(qr.RULES)
    rows = [("word " * 30 + "end.\n" + "a|b " * k + "\n" + "%% " * (k // 2),) for k in range(0, 60, 3)]
    counted = qr.with_counts(spark.createDataFrame(rows, "text string"))
    opinions = (tuple(names[:3]), *((n,) for n in names[3:]))
    model = qr.RuleModel(0.8, {n: (0.9, 0.3 + k / 20) for k, n in enumerate(names)}, opinions)
    for r in counted.select(*[F.expr(e).alias(n) for n, e in qr.RULES.items()], model.posterior().alias("p")).collect():
        assert abs(r.p - 1 / (1 + np.exp(-model.odds(r.asDict())))) < 1e-12


def labelled(spark, n=900):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(800)]
    rows, labels = [], []
    for i in range(n):
        kind = rng.choice("gggggtl")
        text = rng.choices(words, k=60)
        if kind == "t":
            text[5:8] = rng.sample(["nasty", "awful", "vile", "rotten"], 3)
        if kind == "l":
            text = [w + "%%%" for w in text]
        rows.append((i, " ".join(text), rng.choice(["en", "de"]), rng.choice(["s1", "s2"]), 400))
        labels.append((i, int(kind != "l"), int(kind == "t")))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame, labels


def test_classifier_on_held_out_documents(spark):
    frame, labels = labelled(spark)
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int")
    scores = {r.doc_id: r.kept for r in qc.score(frame, qc.fit(frame, known)).collect()}
    held = [(scores[d], q == 1 and t == 0) for d, q, t in labels if d % 3 == 0]
    good = [s for s, g in held if g]
    bad = [s for s, g in held if not g]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_classifier_takes_odd_rows_and_too_few_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    found = qc.score(docs, qc.fit(docs, labels))
    assert found.count() == docs.count() and found.where("not kept").count() == 0 and dict(found.dtypes)["kept"] == "boolean"
    assert qc.score(no_docs, qc.fit(no_docs, labels.where("false"))).count() == 0


def test_toxic_words_of_a_rare_language_count_at_a_few_hundred_labels():
    rng = random.Random(8)
    words = {g: [f"{g}{i}" for i in range(600)] for g in ("en", "de")}
    bad = {g: [f"{g}bad{i}" for i in range(6)] for g in words}

    def document(lang, toxic):
        return " ".join(rng.choices(words[lang], k=40) + (rng.sample(bad[lang], 3) if toxic else []))

    rows = [("en", 0)] * 220 + [("de", 0)] * 40 + [("en", 1)] * 36 + [("de", 1)] * 8
    rng.shuffle(rows)
    text = qc.Examples([qc.text_slots(document(*x).encode()) for x in rows])
    page = qc.Examples([qc.page_slots("s", x[0], 400) for x in rows])
    model = qc.cotrain(text, page, np.array([2 if toxic else 1 for _, toxic in rows]))
    for lang in words:
        for toxic in (0, 1):
            held = qc.Examples([qc.text_slots(document(lang, toxic).encode()) for _ in range(100)])
            kept = model.scores(held, qc.Examples([qc.page_slots("s", lang, 400)] * 100))[2] >= qc.THRESHOLD
            assert kept.mean() < 0.2 if toxic else kept.mean() > 0.95, (lang, toxic)


def test_words_of_unlabelled_documents_only_get_weight(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(6000):
        bad, known = i % 4 == 0, i < 600
        text = rng.choices(words, k=25) + (["nasty"] if bad and known else ["vile"] if bad else [])
        # Documents of one source and language are all bad, so the page view is sure of them.
        rows.append((i, " ".join(text), "de" if bad else "en", "bad" if bad else "good", 150))
        if known:
            labels.append((i, 1, int(bad)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = qc.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    weight = {w: model.text[qc.text_slots(w.encode())].min() for w in ("vile", "nasty", "w1")}
    assert weight["vile"] < -0.5 and weight["nasty"] < -0.5 and abs(weight["w1"]) < 0.3


def test_one_row_of_a_repeated_id_counts(spark):
    frame, labels = labelled(spark, 300)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    first = frame.where("doc_id = 0")
    assert labels[0][0] == 0  # a labelled one: repeated unlabelled rows are documents of their own
    again = first.crossJoin(spark.range(400).select("id")).drop("id")
    once, many = qc.fit(frame, known), qc.fit(frame.unionByName(again), known)
    assert np.allclose(once.text, many.text) and np.allclose(once.both, many.both)


def test_of_clashing_labels_toxic_wins(spark):
    frame, labels = labelled(spark, 300)
    clash = [(d, 1, 0) for d, q, t in labels if t] + [(d, 1, 0) for d, q, t in labels if not q and not t]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    both = known.unionByName(spark.createDataFrame(clash, known.schema))
    one, two = qc.fit(frame, known), qc.fit(frame, both)
    assert np.allclose(one.text, two.text) and np.allclose(one.both, two.both)


def test_the_text_view_is_fitted_as_a_plain_loop_does():
    """A small exact check of the gradient steps, documents one by one."""
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(40)]
    labels, values = rng.integers(0, 2, 40), rng.random(12)
    fit = qc.ViewFit(qc.Examples(rows), labels, values)
    inner, squares = [0.0] * 13, [1e-6] * 13
    for _ in range(120):
        gradient = [0.0] * 13
        for row, label in zip(rows, labels.tolist()):
            p = 1 / (1 + np.exp(-(sum(inner[s] * values[s] for s in row) + inner[12])))
            for s in row:
                gradient[s] += (p - label) * values[s]
            gradient[12] += p - label
        for s in range(13):
            g = gradient[s] / 40 + (1e-4 * inner[s] if s < 12 else 0)
            squares[s] += g * g
            inner[s] -= 0.3 * g / np.sqrt(squares[s])
    assert np.allclose(fit.inner, inner, atol=1e-9)
