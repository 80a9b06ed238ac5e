"""Exact duplicates by content-defined chunk recipes.

Two texts are equal when they are the same after each run of ASCII white space is made one
space.  A null text is an empty one.

*Chunks.*  A rolling hash of the last 32 bytes cuts the text where its ten highest bits are
zero, so a cut depends on the bytes around it only and shared passages give the same chunks
wherever they stand.  A cut less than ``LEAST`` bytes after another place that asks for
one is passed over, and a chunk of ``MOST`` bytes is cut in any case.

*Verified identifiers.*  A chunk's identifier is a 128-bit hash with a seed.  The contents of
all chunks are deduplicated, in each task first, and if one identifier stands for two
contents the seed is changed until none does.  So over these documents equal
identifiers are equal bytes, shown by comparing the bytes and not by trust in the hash.  A
chunk moves once for each task that has it, however many documents repeat it, and it is the
only time that text moves.

*Recipes.*  From there on a document is its ordered list of identifiers, 16 bytes a chunk, and
equal documents are those with equal lists.  Group sizes and survivors are found for each list and
salt, then for each list.  There are about as many salts as the square root of the number of
documents, so no task meets more than that many rows of one list beside its fair share.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from extractkit.llm.common import mixed, small_batches, stored
from extractkit.session import spread

#: Bytes that the rolling hash sees, and bytes of text hashed at once.
WINDOW, SEGMENT = 32, 1 << 22
#: Least and most bytes from one cut to the next; the mean is about 1,024.
LEAST, MOST = 64, 16_384
_CUT = np.uint32(0xFFC00000)
_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def identifier(chunk: bytes, seed: int) -> bytes:
    """16 bytes that stand for a chunk."""
    return xxh3_128_digest(chunk, seed)


def one_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of several texts with each run of white space as one space, and where the texts start and end now."""
    space = _SPACE[data]
    again = np.zeros(len(data), bool)
    again[1:] = space[1:] & space[:-1]
    again[offsets[:-1][offsets[:-1] < len(data)]] = False
    stays = ~again
    moved = np.concatenate(([0], np.cumsum(stays)))[offsets]
    return np.where(space, np.uint8(32), data)[stays], moved


def asked_cuts(data: np.ndarray) -> np.ndarray:
    """Positions behind which the rolling hash of the last :data:`WINDOW` bytes asks for a cut."""
    found = []
    for start in range(0, len(data), SEGMENT):
        before = min(start, WINDOW - 1)
        h = _GEAR[data[start - before : start + SEGMENT]]
        width = 1
        while width < WINDOW:  # h sees twice as many bytes after each turn
            h[width:] = h[width:] + (h[:-width] << np.uint32(width))
            width *= 2
        found.append(np.flatnonzero((h[before:] & _CUT) == 0) + start)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of several texts, in order.  A text's cuts depend on the text alone."""
    at = asked_cuts(data)
    text = np.searchsorted(offsets, at, "right") - 1
    inside = at - offsets[text] >= LEAST - 1
    at, text = at[inside], text[inside]
    apart = np.ones(len(at), bool)
    apart[1:] = (np.diff(at) >= LEAST) | (np.diff(text) > 0)
    edges = np.unique(np.concatenate((offsets, at[apart] + 1)))
    starts, length = edges[:-1], np.diff(edges)
    pieces = -(-length // MOST)
    first = np.repeat(starts, pieces)
    nth = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begins = first + nth * MOST
    return begins, np.minimum(begins + MOST, np.repeat(edges[1:], pieces))


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("text").fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return one_space(data, offsets - offsets[0])


def _cut_documents(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _texts(batch)
            starts, ends = cuts(data, offsets)
            whole = data.tobytes()
            names = [identifier(whole[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())]
            first = np.searchsorted(starts, offsets).tolist()
            recipes = [b"".join(names[a:b]) for a, b in zip(first, first[1:])]
            texts = [whole[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            out = batch.drop_columns(["text"])
            yield out.append_column("text", pa.array(texts, pa.binary())).append_column("recipe", pa.array(recipes, pa.binary()))

    return run


def _chunks(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _texts(batch)
            starts, ends = cuts(data, offsets)
            whole = data.tobytes()
            found = {(identifier(chunk, seed), chunk) for a, b in zip(starts.tolist(), ends.tolist()) if (chunk := whole[a:b])}
            names, contents = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(contents, pa.binary())], ["chunk_id", "content"])

    return run


def _plain(documents: DataFrame, *columns: str) -> DataFrame:
    small_batches(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *[F.col(f"`{c}`") for c in columns])
    return spread(docs, "doc_id")


def chunk_store(documents: DataFrame, seed: int = 0) -> DataFrame:
    """``(chunk_id, content)``: every chunk of all documents once.  An empty text has none."""
    return _plain(documents).mapInArrow(_chunks(seed), "chunk_id binary, content binary").distinct()


def verified_seed(documents: DataFrame) -> int:
    """The first seed with which every identifier stands for one content in these documents."""
    for seed in count():
        chunks = chunk_store(documents, seed)
        if chunks.groupBy("chunk_id").count().where("count > 1").isEmpty():
            return seed
    raise AssertionError


def as_recipes(documents: DataFrame, seed: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, text, recipe)`` and the columns named in ``carry``, a row for each row.

    ``text`` is the whole text in UTF-8 with one space for each run of white space; ``recipe`` the
    identifiers of its chunks in order.  Other columns are ignored, so their names cannot clash.
    """
    if clash := {"doc_id", "text", "recipe"} & set(carry):
        raise ValueError(f"these names are taken: {sorted(clash)}")
    docs = _plain(documents, *carry)
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("text", T.BinaryType()), T.StructField("recipe", T.BinaryType())])
    return docs.mapInArrow(_cut_documents(seed), schema).select("doc_id", "text", "recipe", *[F.col(f"`{c}`") for c in carry])


def equal_recipes(recipes: DataFrame) -> DataFrame:
    """``recipes`` with ``keep_id``, ``group_size`` and ``kept``: one row of each group of equal lists stays.

    It is the row with the smallest ``doc_id``, nulls last; of several such rows exactly one, and
    ``keep_id`` is null only if all ids of the group are.  No rows give no rows.  The rows are
    written to the shared scratch folder first, so that each has a place of its own.
    """
    rows = stored(recipes.withColumn("_row", F.monotonically_increasing_id()), "recipes")
    salts = max(1, isqrt(rows.count()))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    parts = rows.groupBy("recipe", "_salt").agg(F.min(first).alias("_first"), F.count("*").alias("_n"))
    groups = parts.groupBy("recipe").agg(F.min("_first").alias("_first"), F.sum("_n").alias("group_size"))
    found = parts.select("recipe", "_salt").join(groups, "recipe")
    return rows.join(found, ["recipe", "_salt"]).select(
        *[F.col(f"`{c}`") for c in recipes.columns],
        F.col("_first.doc_id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_first._row")).alias("kept"),
    )


def exact_duplicates(documents: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, recipe, keep_id, group_size, kept)`` and the columns named in ``carry``, a row for each row of ``documents``.

    See :func:`as_recipes` and :func:`equal_recipes`.  A null and an empty text are equal to each other only.
    """
    return equal_recipes(as_recipes(documents, verified_seed(documents), carry).drop("text"))


def texts_of(recipes: DataFrame, chunks: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the texts that recipes and a :func:`chunk_store` of the same seed stand for; ids must be unique."""
    names = F.expr("transform(sequence(1, length(recipe) DIV 16), i -> substring(recipe, (i - 1) * 16 + 1, 16))")
    listed = recipes.select("doc_id", F.when(F.length("recipe") > 0, names).alias("names"))
    placed = listed.select("doc_id", F.posexplode_outer("names").alias("at", "chunk_id")).join(chunks, "chunk_id", "left")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.hex("content").alias("content")))), lambda x: x["content"]), "")
    return placed.groupBy("doc_id").agg(F.unhex(whole).alias("text"))
