"""Packing: exact ids, whole results, close to the least number of sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from extractkit.llm import packing
from extractkit.llm.packing import WordIds, pack_documents, pack_lengths

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_equal_the_tokenizer():
    tokenizer, words = Tokenizer.from_file(PATH), WordIds(open(PATH, encoding="utf-8").read())
    rng = random.Random(3)
    letters = "aB'é́ ΣςΟΔ\n\t   \x0b\x1c\x85<|endoftext|>01²½ﬁİǅ한‍😀-!?s't"
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(words.text(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def counted(monkeypatch, words):
    """The words that ``words`` hands to the merges and to the whole tokenizer, a list for each call."""
    calls = {"merged": [], "whole": []}
    for name, seen in calls.items():
        monkeypatch.setattr(words, name, lambda new, encode=getattr(words, name), seen=seen: seen.append(list(new)) or encode(new))
    return calls


def test_new_words_of_a_batch_are_encoded_together(monkeypatch):
    tokenizer, words = Tokenizer.from_file(PATH), WordIds(open(PATH, encoding="utf-8").read())
    calls = counted(monkeypatch, words)
    stems = [a + b + c for a in ("thon", "Äer", "πη") for b in ("ing", "é", "ou") for c in ("ly", "ß", "tion")]
    texts = [None, "", *[f"{stem}, {stem.upper()}### {stem}.\n{stem} x-{stem} 1{stem}" for stem in stems], " \n"]
    for _ in range(2):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in words.texts(pa.array(texts))]
        assert found == [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert len(calls["merged"]) == len(calls["whole"]) == 1
    assert all(word.isalpha() and word == word.lower() for word in calls["merged"][0])
    assert {",", "###", "."} < set(calls["whole"][0]) and not any(word.endswith((",", "#")) and len(word) > 3 for word in calls["whole"][0])


def test_a_vocabulary_without_ends_of_words():
    words, other = (WordIds(open(PATH, encoding="utf-8").read()) for _ in range(2))
    other.last[:] = False
    text = "Some words, of é and ñandú, thonting."
    assert words.text(text) == other.text(text)


def test_frequent_words_outlive_a_full_memory(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    tokenizer, words = Tokenizer.from_file(PATH), WordIds(open(PATH, encoding="utf-8").read())
    calls = counted(monkeypatch, words)
    letters = "abcdefghij"
    for n in range(30):
        text = "often " + " ".join(letters[n // 10] + letters[n % 10] + a + b for a in letters[:6] for b in letters) + " The"
        assert np.frombuffer(words.text(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(words.recent) <= 200 and len(words.older) <= 200
    seen = [word for call in calls["merged"] for word in call]
    assert seen.count("often") == seen.count("the") == 1 and len(seen) == 30 * 60 + 2


def test_joined_batches_keep_all_rows():
    batches = [pa.record_batch([pa.array(["x" * n] * 3)], ["text"]) for n in (10, 20, 5000, 10, 0)]
    found = list(packing.joined(iter(batches), 300))
    assert pa.Table.from_batches(found) == pa.Table.from_batches(batches)
    assert [batch.num_rows for batch in found] == [6, 3, 6]
    assert list(packing.joined(iter([]), 300)) == []


def test_best_two_fit_replaces_the_smallest():
    assert [sorted(x) for x in pack_lengths([6, 3, 2, 2], 10)] == [[0, 2, 3], [1]]


def test_packing_is_whole_and_tight():
    rng = random.Random(4)
    lengths = [min(2048, max(1, int(rng.lognormvariate(6, 1)))) for _ in range(5000)]
    bins = list(pack_lengths(lengths, 2048))
    assert sorted(at for chosen in bins for at in chosen) == list(range(5000))
    assert max(sum(lengths[at] for at in chosen) for chosen in bins) <= 2048
    assert len(bins) <= -(-sum(lengths) // 2048) * 1.01 + 1


def test_documents(docs):
    tokenizer = Tokenizer.from_file(PATH)
    rows = pack_documents(docs, PATH, length=64).collect()
    wanted = []
    for doc in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [0]
        wanted += [(doc.doc_id, i // 64, i, len(p := ids[i : i + 64]), zlib.crc32(np.array(p, "<u4").tobytes())) for i in range(0, len(ids), 64)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=key) == sorted(wanted, key=key)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for place in places.values():
        end = 0
        for offset, length in sorted(place):
            assert offset == end
            end += length
        assert end <= 64


def test_no_documents(no_docs):
    assert pack_documents(no_docs, PATH).count() == 0


def test_equal_rows_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_TASK", 50)
    rows = spark.range(2000).selectExpr("cast(null as long) AS doc_id", "cast(null as string) AS text")
    found = packing.pack_documents(rows, PATH).collect()
    tasks = {}
    for r in found:
        tasks[r.sequence_id >> 40] = tasks.get(r.sequence_id >> 40, 0) + 1
    assert len(found) == 2000 and len(tasks) == 40 and max(tasks.values()) <= 100
    places = {(r.sequence_id, r.offset) for r in found}
    assert len(places) == 2000 and {r.length for r in found} == {1}
