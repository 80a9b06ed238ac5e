"""MinHash near-duplicates: fast similarity sketches, banding, exact verification, components.

A document's set holds the distinct shingles (``width`` words) of its text with A-Z
lower-cased; words are runs without ASCII white space.  Fewer words than ``width`` make one
shingle; no words make an empty set that is linked with nothing.  Two documents are linked
when ``100 * intersection >= percent * union``.

*Sketch.*  Round i throws every shingle into one of ``COORDINATES`` bins and a bin keeps the
smallest hash of the first round that reaches it; after as many rounds as there are bins,
round ``COORDINATES + j`` throws everything into bin j.  So each coordinate is filled after
a bounded number of rounds, mostly two or three, and agrees between two sets with
probability equal to their similarity, with the concentration bounds of independent
sampling.

*Banding.*  32 bands of 4 coordinates.  A pair of similarity 0.8 shares none of them with
probability ``(1 - 0.8 ** 4) ** 32``, below 5e-8.

*Verification.*  Equal sets are one class beforehand.  Within a bucket the smallest id is
tested against all others; links are then merged to components, and only pairs of different
components that no test has covered remain.  A bucket of at most ``SMALL_BUCKET`` documents
tests these by a join.  A larger one is cut into blocks of about ``BLOCK`` documents, and
each two blocks meet in a task of their own, which compares signatures of four bits a
coordinate, then the full sets, and emits links only.  There a pair is taken in the first
band it shares, and passed over if more than ``MOST_DIFFERENT`` of its coordinates differ:
a pair of similarity 0.8 does so with probability below 1e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from extractkit.llm.common import mixed, odd_words, small_batches, stored
from extractkit.llm.components import connected_components
from extractkit.session import spread

COORDINATES, BAND = 128, 4
SMALL_BUCKET, BLOCK = 64, 1024
MOST_DIFFERENT = 53
#: The least similarity that the bands and MOST_DIFFERENT are made for.
LEAST_PERCENT = 80
_ROUNDS = odd_words(2 * COORDINATES, 1)
_PLACES = odd_words(64, 2)
_BANDS = odd_words(COORDINATES, 3)
_BIN_BITS = np.uint64(COORDINATES.bit_length() - 1)
_BIN = np.uint64(COORDINATES - 1)


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text."""
    words = text.lower().split() if text else []  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < width:
        return mixed((hashes * _PLACES[: len(words)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(words)))
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += hashes[i : i + n] * _PLACES[i]
    return np.unique(mixed(total))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The ``COORDINATES`` values of a non-empty set."""
    out, empty = np.zeros(COORDINATES, np.uint64), np.ones(COORDINATES, bool)
    for i in range(2 * COORDINATES):
        hashes = mixed(shingles ^ _ROUNDS[i])
        if i < COORDINATES:
            keys = np.sort((hashes & _BIN) << (np.uint64(64) - _BIN_BITS) | hashes >> _BIN_BITS)
            bins = (keys >> (np.uint64(64) - _BIN_BITS)).astype(np.int64)
            first = np.flatnonzero(np.diff(bins, prepend=-1))
            first = first[empty[bins[first]]]
            at, values = bins[first], keys[first]
        else:
            at = np.array([i - COORDINATES])
            at, values = at[empty[at]], hashes.min(keepdims=True)
        if at.size:
            out[at] = values + np.uint64(i)
            empty[at] = False
            if not empty.any():
                break
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    return mixed((values * _BANDS).reshape(-1, BAND).sum(axis=1, dtype=np.uint64) + np.arange(COORDINATES // BAND, dtype=np.uint64)).view(np.int64)


def signature(values: np.ndarray) -> np.ndarray:
    """Four bits of each coordinate, sixteen to a 64-bit word."""
    nibbles = (mixed(values) & np.uint64(15)).reshape(-1, 16)
    return (nibbles << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64).view(np.int64)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The 64-bit words of each list of a column."""
    out = []
    for chunk in column.chunks:
        values = chunk.values.to_numpy(zero_copy_only=False).view(np.uint64)
        ends = chunk.offsets.to_numpy()
        out += [values[a:b] for a, b in zip(ends, ends[1:])]
    return out


def _block_links(percent: int):
    def run(group: pa.Table) -> pa.Table:
        bucket = np.int64(group.column("bucket")[0].as_py()).view(np.uint64)
        reps, sizes, components, block = (group.column(c).to_numpy() for c in ("rep", "n", "component", "block"))
        keys = np.array(_lists(group.column("bands")))
        words = np.array(_lists(group.column("signature")))
        nibbles = ((words[:, :, None] >> (np.arange(16, dtype=np.uint64) * np.uint64(4))) & np.uint64(15)).reshape(len(words), -1).astype(np.uint8)
        sets = _lists(group.column("shingles"))
        low, high = block.min(), block.max()
        others = np.flatnonzero(block == high)
        found = []
        for i in np.flatnonzero(block == low):
            at = others[(components[others] != components[i]) & (reps[others] > reps[i] if low == high else True)]
            at = at[100 * np.minimum(sizes[at], sizes[i]) >= percent * np.maximum(sizes[at], sizes[i])]
            shared = keys[at] == keys[i]
            at = at[keys[i][shared.argmax(axis=1)] == bucket]
            at = at[(nibbles[at] != nibbles[i]).sum(axis=1) <= MOST_DIFFERENT]
            if at.size:
                theirs = np.concatenate([sets[j] for j in at])
                places = np.minimum(np.searchsorted(sets[i], theirs), sets[i].size - 1)
                starts = np.cumsum([0, *(sets[j].size for j in at[:-1])])
                common = np.add.reduceat((sets[i][places] == theirs).astype(np.int64), starts)
                at = at[100 * common >= percent * (sizes[at] + sizes[i] - common)]
                found += [(reps[i], reps[j]) for j in at]
        return pa.table({"a": pa.array([int(min(x)) for x in found], pa.int64()), "b": pa.array([int(max(x)) for x in found], pa.int64())})

    return run


def _described(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, keys, signatures = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_set(text, width)
                counts.append(found.size)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if found.size else None)
                values = sketch(found) if found.size else None
                keys.append(bands(values) if found.size else None)
                signatures.append(signature(values) if found.size else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in (keys, signatures))],
                ["doc_id", "n_shingles", "digest", "bands", "signature"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text, width).view(np.int64) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are linked.  ``a`` may be a hot pivot, so its set is joined last."""
    with_b = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = with_b.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    counted = both.select("a", "b", common.alias("n"), (F.size("set_a") + F.size("set_b")).alias("sum"))
    return counted.where((100 * F.col("n") >= percent * (F.col("sum") - F.col("n")))).select("a", "b").distinct()


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``documents`` (``doc_id``, ``text``).

    Null and wordless texts: 0 shingles, linked with nothing.  Rows that repeat a ``doc_id``
    count as one document that is linked if any of its texts is.  A null ``doc_id`` is linked
    with nothing: its component is null and it is kept.  No rows give no rows; other columns
    are ignored.  A ``percent`` below 80 is refused: bands and signature test would miss pairs.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100")
    spark = documents.sparkSession
    small_batches(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    told = stored(
        spread(texts, "doc_id").mapInArrow(_described(width), "doc_id long, n_shingles long, digest binary, bands array<long>, signature array<long>"), "sketches"
    )
    own = told.where("doc_id is not null and n_shingles > 0")
    classes = own.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    members = stored(own.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep"), "members")
    by_id = members.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("other"))
    reps = members.where("doc_id = rep").select("doc_id").distinct()
    banded = stored(
        own.join(reps, "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")), "bands"
    )

    # Buckets of several documents; most rows are alone in theirs and end here.
    star = banded.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("p"), F.max("rep").alias("most")).where("p.rep < most")
    hits = stored(banded.join(star.select("bucket", F.col("p.rep").alias("pivot"), F.col("p.n").alias("np")), "bucket").where("rep <> pivot"), "hits")
    tested = stored(hits.select(F.col("pivot").alias("a"), F.col("rep").alias("b"), F.col("np").alias("na"), F.col("n").alias("nb")).distinct(), "pairs")
    similar_size = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    ids = tested.select(F.col("a").alias("doc_id")).unionByName(tested.select(F.col("b").alias("doc_id"))).distinct()
    # The ids grow with the data, so the same shuffle join at every size.
    sets = stored(texts.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets(width), "doc_id long, shingles array<long>"), "sets")
    same_id = members.withColumnRenamed("rep", "b").join(by_id.where("rep < other"), "doc_id").where("b <> rep").select(F.col("rep").alias("a"), "b")
    links = stored(_linked(tested.where(similar_size).select("a", "b"), sets, percent).unionByName(same_id), "links")
    found = stored(connected_components(links), "components")

    # What no test has covered: pairs of different components in a bucket, without its pivot.
    rest = stored(_unsettled(hits.select("bucket", "rep", "n"), found), "rest")
    small = rest.where(F.col("size") <= SMALL_BUCKET)
    other = small.select("bucket", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    pairs = small.select("bucket", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca")).join(other, "bucket")
    pairs = pairs.where("a < b and ca <> cb").where(similar_size).select("a", "b").distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
    more = stored(_linked(stored(pairs, "pairs"), sets, percent), "links")
    large = rest.where(F.col("size") > SMALL_BUCKET)
    if not large.isEmpty():
        blocks = F.ceil(F.col("size") / BLOCK)
        described = own.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bands", "signature")
        rows = large.join(described, ["rep", "n"]).join(sets.withColumnRenamed("doc_id", "rep"), "rep").where(F.size("shingles") == F.col("n"))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), blocks)).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        meetings = rows.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with")).drop("with", "size")
        more = more.unionByName(stored(meetings.groupBy("bucket", "low", "high").applyInArrow(_block_links(percent), "a long, b long").distinct(), "links"))
    if not more.isEmpty():
        found = stored(connected_components(links.unionByName(more)), "components")

    names = by_id.select("doc_id", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    return (
        told.select("doc_id", "n_shingles").join(names, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _unsettled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, with component and bucket size."""
    named = rows.join(found.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    several = named.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count("*").alias("size")).where("c1 < c2")
    return named.join(several.select("bucket", "size"), "bucket")
