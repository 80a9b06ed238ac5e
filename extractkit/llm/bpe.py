"""Byte-level BPE with two tiers: a minimal perfect hash for whole words, a heap for the rest.

A text is split by the vocabulary's pattern.  A pre-token that is in the vocabulary is found
by one probe of a minimal perfect hash (hash and displace: keys fall into small groups, and
each group, largest first, takes the first displacement that sends its keys to free slots, of
which there are as many as keys; the token in the slot is compared).  Any other pre-token is a doubly linked list of bytes; a
heap of (rank, place) gives the pair to merge next, lowest rank and then leftmost first;
the ranks of pairs are read from a plain dictionary of the vocabulary.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from xxhash import xxh3_64_intdigest

from extractkit.llm.common import remembered, small_batches
from extractkit.session import spread

GROUP = 4
_MASK = (1 << 64) - 1
#: Pre-tokens a Python worker remembers with their ids.
REMEMBERED = 400_000


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank) by rank, which must be 0, 1, 2 and so on."""
    with open(path, "rb") as file:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(bytes.strip, file)))
    if [rank for rank, _ in pairs] != list(range(len(pairs))) or len({token for _, token in pairs}) != len(pairs):
        raise ValueError("ranks must be 0, 1, 2 and so on, of different tokens")
    return [token for _, token in pairs]


def _slot(key: int, displacement: int, n: int) -> int:
    x = ((key ^ (displacement * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93) & _MASK
    return (x ^ (x >> 32)) % n


def perfect_hash(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The displacement of each group and the key of each slot.

    A group of one key takes any free slot, kept as a negative number, so the search stays
    short until the last slot.
    """
    n, groups = len(keys), max(1, len(keys) // GROUP)
    hashes = [xxh3_64_intdigest(key) for key in keys]
    members: list[list[int]] = [[] for _ in range(groups)]
    for at, h in enumerate(hashes):
        members[h % groups].append(at)
    displacements, slots = np.zeros(groups, np.int64), [-1] * n
    free = None
    for group in sorted(range(groups), key=lambda g: -len(members[g])):
        own = members[group]
        if len(own) > 1:
            displacement = 1
            while True:
                places = [_slot(hashes[at], displacement, n) for at in own]
                if all(slots[p] < 0 for p in places) and len(set(places)) == len(places):
                    break
                displacement += 1
        elif own:
            free = free or [p for p in range(n) if slots[p] < 0]
            places = [free.pop()]
            displacement = -1 - places[0]
        else:
            break
        displacements[group] = displacement
        for at, place in zip(own, places):
            slots[place] = at
    return displacements, np.array(slots, np.int32)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a pre-token by merging its bytes.

    ``pair[i]`` is the rank of what starts at i together with what follows it, -1 without one;
    a heap entry that no longer agrees with it is out of date.
    """
    n, get = len(word), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [get(word[i : i + 2], -1) for i in range(n - 1)]
    pair.append(-1)
    heap = [r << 40 | i for i, r in enumerate(pair) if r >= 0]
    heapq.heapify(heap)
    while heap:
        entry = heapq.heappop(heap)
        i = entry & 0xFFFFFFFFFF
        if pair[i] != entry >> 40:
            continue
        j = after[i]
        end = after[i] = after[j]
        pair[j], before[j] = -1, -2
        r = -1
        if end < n:
            before[end] = i
            r = get(word[i : after[end]], -1)
            if r >= 0:
                heapq.heappush(heap, r << 40 | i)
        pair[i] = r
        p = before[i]
        if p >= 0:
            pair[p] = r = get(word[p:end], -1)
            if r >= 0:
                heapq.heappush(heap, r << 40 | p)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : after[i]]])
        i = after[i]
    return ids


class WordIds(dict):
    """A pre-token's ids, found when first asked for: by the perfect hash, else by merging."""

    def __init__(self, tokens: list[bytes], displacements: np.ndarray, slots: np.ndarray):
        super().__init__()
        self.tokens, self.displacements, self.slots = tokens, displacements.tolist(), slots.tolist()
        self.ranks = {token: rank for rank, token in enumerate(tokens)}

    def whole(self, key: bytes) -> int:
        """The rank of a pre-token of the vocabulary, or -1."""
        h = xxh3_64_intdigest(key)
        displacement = self.displacements[h % len(self.displacements)]
        at = self.slots[-1 - displacement if displacement < 0 else _slot(h, displacement, len(self.slots))]
        return at if self.tokens[at] == key else -1

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        key = word.encode()
        rank = self.whole(key)
        self[word] = ids = (rank,) if rank >= 0 else tuple(merged(key, self.ranks))
        return ids


def _vocabulary(tokens: bytes, lengths: bytes) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(lengths, np.int32)).tolist()
    return [tokens[a:b] for a, b in zip([0, *ends], ends)]


def _packed(tokens: list[bytes]) -> tuple[bytes, bytes]:
    return b"".join(tokens), np.array([len(t) for t in tokens], np.int32).tobytes()


def encode(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` of every row, whole text, without special tokens.

    A null or empty text has no ids; repeated rows stay; a null ``doc_id`` stays null; no rows
    give no rows; other columns are ignored.  The rank file need be on the driver only: the
    tokens, some hundred kB, go to the tasks.
    """
    small_batches(documents.sparkSession)
    tokens = read_ranks(ranks_path)
    packed, table = _packed(tokens), perfect_hash(tokens)
    del tokens
    key = ("bpe", zlib.crc32(packed[0]), zlib.crc32(packed[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = remembered(key, lambda: WordIds(_vocabulary(*packed), *table))
        split = regex.compile(pattern).findall
        for batch in batches:
            found = [np.fromiter(chain.from_iterable(map(words.__getitem__, split(text))), np.int32) if text else np.empty(0, np.int32) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return spread(docs, "doc_id").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with ``decoded``, the bytes that the ids stand for."""
    packed = _packed(read_ranks(ranks_path))
    key = ("tokens", zlib.crc32(packed[0]), zlib.crc32(packed[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = remembered(key, lambda: np.array(_vocabulary(*packed), object))
        for batch in batches:
            column = batch.column("ids")
            values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [b"".join(tokens[values[a:b]].tolist()) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column, pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def count_tokens(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``documents`` without ``text``, with ``n_tokens`` (long) of it; a null text has none.

    A column ``n_tokens`` is replaced; others pass through.  Ids are counted in the tasks and
    never leave them.
    """
    small_batches(documents.sparkSession)
    tokens = read_ranks(ranks_path)
    packed, table = _packed(tokens), perfect_hash(tokens)
    del tokens
    key = ("bpe", zlib.crc32(packed[0]), zlib.crc32(packed[1]))
    documents = documents.drop("n_tokens")
    others = [c for c in documents.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = remembered(key, lambda: WordIds(_vocabulary(*packed), *table))
        split = regex.compile(pattern).findall
        for batch in batches:
            counts = [sum(map(len, map(words.__getitem__, split(text)))) if text else 0 for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(counts, pa.int64())], [*others, "n_tokens"])

    schema = StructType([documents.schema[c] for c in others]).add("n_tokens", "long")
    return spread(documents, others[0]).mapInArrow(run, schema)
