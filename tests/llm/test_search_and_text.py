"""Top-k, URLs, licenses and chat format against brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from extractkit.llm import topk, urls
from extractkit.llm.chat import ChatFormat
from extractkit.llm.licenses import SHARE, TEMPLATES, WORDINGS, LicenseScanner, differences, scan_licenses, words_of
from extractkit.llm.topk import quantised, top_k


def vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=20).round(2)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 330)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 20), (403, [float("inf")] * 20), (None, rows[1][1]), (404, [1.0, 2.0]), (500, [3.0, 4.0])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))


def test_top_k_equals_brute_force(spark, monkeypatch):
    rows, frame = vectors(spark)
    usable = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    wanted = set()
    for q in (i for i in usable if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
        wanted |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:10])}
    for blocks in ((1024, 16_384), (3, 40)):
        monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
        monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
        found = top_k(frame.withColumn("values", quantised(F.col("embedding"))), F.col("vec_id") % 50 == 0, 10)
        assert {tuple(r) for r in found.collect()} == wanted


def test_every_row_of_a_repeated_id_counts(spark):
    rows = [(0, [3, 0]), (0, [0, 2]), (1, [6, 0]), (1, [1, 9]), (1, [6, 0]), (2, [2, 2]), (50, [1, 1]), (None, [9, 9])]
    frame = spark.createDataFrame(rows, "vec_id long, values array<long>")
    found = [tuple(r) for r in top_k(frame, F.col("vec_id") % 50 == 0, 4).orderBy("query_id", "rank").collect()]
    wanted = []
    for query in (0, 50):
        pairs = [(-(a[0] * b[0] + a[1] * b[1]), c) for q, a in rows if q == query for c, b in rows if c is not None and c != query]
        wanted += [(query, n + 1, c, -s) for n, (s, c) in enumerate(sorted(pairs)[:4])]
    assert found == wanted


def test_top_k_of_large_numbers_and_of_nothing(spark):
    frame = spark.createDataFrame([(0, [1 << 28, 3]), (1, [(1 << 28) + 1, 5]), (2, [1 << 28, 7])], "vec_id long, values array<long>")
    found = [tuple(r) for r in top_k(frame, F.col("vec_id") == 0, 2).orderBy("rank").collect()]
    assert found == [(0, 1, 1, (1 << 28) * ((1 << 28) + 1) + 15), (0, 2, 2, (1 << 56) + 21)]
    assert top_k(frame.where("false"), F.lit(True)).count() == 0


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


def test_urls(spark):
    given = [
        None, "", "no scheme", "http://EXAMPLE.com/en/a?b#c", "https://www.Example.com/en/", "http://x.www.example.com/en/1", "http://notexample.com/en/", "http://com",
        "http://a.net/es/x", "http://a.net?x=/es/", "http://a.net#/es/", "ftp://É.NET/es/", "a://b://c/d", "http://x.net/" + "y" * 60_000, "http://line\nbreak.com/z",
    ]
    frame = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(given)], "page_id long, url string, host string")
    for r in urls.judged(frame, RULES, [0.0] * ((1 << urls.BITS) + 1)).collect():
        host = path = ""
        if r.url and "://" in r.url:
            rest = r.url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == (max(fits)[2] if fits else "block" if r.block_score >= 0.5 else "allow")


def test_url_regression_learns(spark):
    rng = random.Random(10)
    made = [(f"http://{rng.choice(['casino', 'pills', 'bets'])}-{rng.randint(0, 99)}.org/x", 1) for _ in range(40)]
    made += [(f"http://{rng.choice(['school', 'library', 'museum'])}-{rng.randint(0, 99)}.org/x", 0) for _ in range(40)] + [(None, 1), ("http://a.org", None)]
    weights = urls.train(spark.createDataFrame(made, "url string, block int"))
    test = spark.createDataFrame([("http://my-casino.org/x",), ("http://city-library.org/x",)], "url string")
    assert [r.verdict for r in urls.judged(test, [], weights).collect()] == ["block", "allow"]
    assert set(urls.train(spark.createDataFrame([], "url string, block int"))) == {0.0}


def test_license_notices(spark, docs, no_docs):
    rows = [
        (1, "Foo. " + TEMPLATES["MIT"][0] + "\n" + TEMPLATES["CC-BY-NC-4.0"][0]), (2, "released UNDER the the mit license"), (3, "Licensed under CC BY-NC-ND 4.0."),
        (4, "Licenced under the Apache License, Version 2.0."), (5, "Licensed under the Apache License, Version 3.0."), (6, "x " * 30_000 + TEMPLATES["GPL-3.0"][0]), (7, None),
    ]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.n_changes) for r in found) == [(1, "CC-BY-NC-4.0", 0), (1, "MIT", 0), (2, "MIT", 1), (4, "Apache-2.0", 1), (6, "GPL-3.0", 0)]
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start : r.end].lower().startswith(("rel", "lic", "this")) for r in found)
    assert differences(["a", "b", "c"], ["x", "a", "d", "c", "y"]) == (1, 4, ["b>d"])
    assert scan_licenses(docs).count() == scan_licenses(no_docs).count() == 0


def test_license_notices_as_in_use(spark):
    bsd = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
# 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
# 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
#    disclaimer in the documentation and/or other materials provided with the distribution.
"""
    gnu = "This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU {} as published by\n * the Free Software Foundation, either version {} of the License, or\n * (at your option) any later version."
    rows = {
        "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of\nthis software and associated documentation files (the 'Software'), to deal in\nthe Software without restriction, including without limitation the rights to\nuse, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of\nthe Software, and to permit persons to whom the Software is furnished to do so,\nsubject to the following conditions:",
        "BSD-2-Clause": bsd,
        "BSD-3-Clause": bsd + "# 3. Neither the name of Foo Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "BSD-style": "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.",
        "GPL-3.0-or-later": gnu.format("General Public License", 3), "GPL-2.0-or-later": gnu.format("General Public License", 2),
        "LGPL-2.1-or-later": gnu.format("Lesser General Public License", "2.1"), "AGPL-3.0-or-later": gnu.format("Affero General Public License", 3),
        "ISC": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "CC-BY-SA-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Zlib": "/* SPDX-License-Identifier: Zlib */",
    }
    frame = spark.createDataFrame([(i, f"Some words before.\n{text}\nAnd after.") for i, text in enumerate(rows.values())], "doc_id long, text string")
    assert [(r.doc_id, r.license) for r in scan_licenses(frame).orderBy("doc_id", "start").collect()] == list(enumerate(rows))
    lines = spark.createDataFrame([(1, "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 import os"), (2, "Permission to use this is granted.")], "doc_id long, text string")
    assert [(r.license, r.kind, r.saved_bytes) for r in scan_licenses(lines).orderBy("start").collect()] == [(x, "spdx", None) for x in ("MIT", "Apache-2.0", "GPL-2.0-only")]


def test_license_rank_against_all_templates():
    """Changed wordings among words of their own kind: found if and only if some template, compared word by word with the whole text, is there."""
    rng, scanner = random.Random(3), LicenseScanner(TEMPLATES, WORDINGS)
    wordings = [text for text, _ in TEMPLATES.values()] + [text for _, text, _ in WORDINGS]
    others = "alpha beta of the license software public under".split()
    n_found = 0
    for _ in range(300):
        k = rng.randrange(len(wordings))
        words = wordings[k].split()
        for _ in range(rng.randint(0, int(SHARE * len(words)))):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1, 1])] = rng.choice([[], [rng.choice(others)]])
        text = " ".join(rng.choices(others, k=20) + words + rng.choices(others, k=20))
        plain = [w for w, _, _ in words_of(text)]
        every = {scanner.licenses[t] for t in range(len(scanner.templates)) if scanner.confirmed(t, plain)}
        found = {notice[0] for notice in scanner.scan(text)}
        assert found <= every and bool(found) == bool(every), (text, found, every)
        assert not every or any(word in text.lower() for word in scanner.needed())
        n_found += bool(found)
    assert n_found > 100


def test_license_rank_decides(monkeypatch):
    """Where several templates pass the word comparison, the bytes saved choose among them."""
    scanner = LicenseScanner(TEMPLATES, WORDINGS)
    affero = next(text for name, text, _ in WORDINGS if name.startswith("AGPL"))
    endorse = next(text for name, text, _ in WORDINGS if name == "BSD-3-Clause").replace("the names of", "names of")
    texts = {"AGPL-3.0-or-later": affero, "BSD-3-Clause": endorse}
    for name, text in texts.items():
        passed = {scanner.licenses[k] for k in range(len(scanner.templates)) if scanner.confirmed(k, [w for w, _, _ in words_of(text)])}
        assert passed - {name} and [x[0] for x in scanner.scan(text)] == [name]
    sizes = scanner.sizes
    monkeypatch.setattr(scanner, "sizes", lambda block: [2 * min(sizes(block)) - x for x in sizes(block)])  # the least similar first
    assert all([x[0] for x in scanner.scan(text)] != [name] for name, text in texts.items())
    monkeypatch.setattr(scanner, "sizes", lambda block: [10] * len(scanner.templates))
    assert [x[0] for x in scanner.scan(endorse)] != ["BSD-3-Clause"]


def test_license_blocks_are_blind_to_names():
    """A block is found without the words that name the license; the word comparison then refuses it."""
    scanner = LicenseScanner(TEMPLATES, WORDINGS)
    for name, (text, _) in TEMPLATES.items():
        if name in ("Apache-2.0", "GPL-3.0", "BSD-3-Clause"):
            plain = [w for w, _, _ in words_of(text.replace("Apache", "Foo").replace("GNU", "Foo").replace("BSD", "Foo"))]
            assert scanner.blocks(plain) and not scanner.scan(" ".join(plain))


def test_chat_round_trip(spark):
    rng = random.Random(11)
    parts = ["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "|end|>", "é\n", " ", "$1", ""]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "<s>", None]), rng.choice([text(), text(), None])) for c in range(150) for t in range(rng.randint(1, 6))]
    rows += [(None, 0, "user", "hi"), (None, None, "user", "first"), (1000, 0, "user", "x" * 80_000), (1000, 1, "assistant", "y" * 80_000), (1000, 1, "assistant", "y" * 80_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("segments", F.lit("clash"))
    chat = ChatFormat()
    out = chat.format(frame)
    read = out.select("conv_id", chat.read(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    wanted = {}
    for conv, turn, role, content in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(conv, []).append((role or "", content or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in read} == wanted
    assert {r.conv_id: r.loss for r in read} == {c: "".join(t for role, t in turns if role == "assistant") for c, turns in wanted.items()}
    assert chat.format(frame.where("false")).count() == 0


def test_turn_order(spark):
    orders = {0: "ua", 1: "sua", 2: "us", 3: "au", 4: "u", 5: "uaua", 6: "ss"}
    names = {"u": "user", "a": "assistant", "s": "system"}
    rows = [(c, i, names[x], "t") for c, order in orders.items() for i, x in enumerate(order)]
    found = {r.conv_id: r.error_turn for r in ChatFormat().format(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert found == {0: None, 1: None, 2: 1, 3: 0, 4: 1, 5: None, 6: 1}
