"""BPE against its library, the rollup against a recount."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from extractkit.llm import bpe
from extractkit.llm.token_counts import TokenRollup, deleted, inserted, revised

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_refuses_others():
    tokens = bpe.read_ranks(PATH)
    words = bpe.WordIds(tokens, *bpe.perfect_hash(tokens))
    assert sorted(words.slots) == list(range(len(tokens)))
    assert all(words.whole(token) == rank for rank, token in enumerate(tokens))
    assert words.whole(b"surely not a token of this file") == -1


def test_encode_and_decode(spark, docs, library):
    rng = random.Random(8)
    letters = "aB'é́ Σς\n\t   \x0b\x1c\x85\xa0<|endoftext|>01²½한‍😀-!?s'tlrve"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    wanted = {(r.doc_id, r.text): library.encode_ordinary(r.text or "") for r in frame.collect()}
    found = bpe.decode(bpe.encode(frame, PATH, PATTERN), PATH).collect()
    assert len(found) == frame.count()
    for r in found:
        text = bytes(r.decoded).decode()
        assert r.ids == wanted.get((r.doc_id, text), wanted.get((r.doc_id, None)))


def test_long_pre_token(library):
    ranks = {token: rank for rank, token in enumerate(bpe.read_ranks(PATH))}
    text = "abcab" * 4000 + "é" * 3000
    assert bpe.merged(text.encode(), ranks) == library.encode_ordinary(text)


def test_no_rows(no_docs):
    assert bpe.decode(bpe.encode(no_docs, PATH, PATTERN), PATH).count() == 0
    assert bpe.count_tokens(no_docs, PATH, PATTERN).count() == 0


def test_rollup(spark, docs, tmp_path, library):
    counts = bpe.count_tokens(docs.select("doc_id", "source", "lang", "n_chars", "text"), PATH, PATTERN).withColumn("tokenizer", F.lit("v1")).cache()
    rollup = TokenRollup(spark, str(tmp_path / "rollup"))
    assert rollup.totals().count() == 0
    assert rollup.commit("load", inserted(counts)) and not rollup.commit("load", inserted(counts))
    texts = {}
    for r in docs.collect():
        n, tokens = texts.get((r.source, r.lang), (0, 0))
        texts[r.source, r.lang] = (n + 1, tokens + len(library.encode_ordinary(r.text or "")))
    assert {(r.source, r.lang): (r.documents, r.tokens) for r in rollup.totals().collect()} == texts
    longer = counts.withColumn("n_tokens", F.col("n_tokens") + 1)
    rollup.commit("revise", revised(counts, longer))
    assert sum(r.tokens for r in rollup.totals().collect()) == sum(t + n for n, t in texts.values())
    rollup.commit("empty", inserted(counts.where("false")))
    assert rollup.commit("all", deleted(longer)) and rollup.totals().count() == 0
    with pytest.raises(ValueError):
        rollup.commit("../x", inserted(counts))
