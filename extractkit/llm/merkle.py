"""Merkle dataset manifest by time-forward processing.

The rows of a tree (a source) are its leaves, in order.  Every 16 consecutive nodes make one
node of the next level until one is left, the subroot; the subroots, in the order of their trees,
make the root in the same way.  A digest is the SHA-256, in lower-case hex, of what is below it, joined
as hex text; a run of one node is hashed as well.

*Forward.*  A node's label is its tree, level and index, and a child sends its digest to
its parent's label.  What waits for delivery lies in a priority queue ordered by label.  The external
part of the queue is Spark's sorted shuffle: one round brings the messages of ``BLOCK`` = 16 x 16
leaves of a tree to one place in label order, and inside it a small heap delivers over two levels.
The nodes that come out are the leaves of the next round, 256 times fewer.  So no task holds more than
256 nodes of a tree at a time, however large that tree is.

*Reversed.*  The same rounds run back from the root with labels in descending order: a
node gets the proof suffix of its parent, puts its own siblings before it, and sends the result to its
children.  A suffix travels once for each 256 nodes.

Places in a tree come from a range partitioning by (tree, order): rows are counted within each
partition, and partitions of one tree are shifted by the rows before them.  Equal rows are told apart by a row
number, so not even a tree of equal rows is bound to one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from heapq import heappop, heappush
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from extractkit.llm.common import stored

FAN_OUT, LEVELS = 16, 2
BLOCK = FAN_OUT**LEVELS
#: Rows of an output batch; a row has some KB of siblings.
_BATCH = 2_000


def leaf(*columns: Column) -> Column:
    """The digest of one row: each value as its length in UTF-8 bytes, ``:`` and its text, ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path (see :func:`manifest`) lead to."""
    levels = F.sequence(F.lit(1), (F.size(path) / 2).cast("int"))
    up = F.aggregate(levels, digest, lambda at, n: F.sha2(F.concat(F.get(path, n * 2 - 2), at, F.get(path, n * 2 - 1)).cast("binary"), 256))
    return F.when(F.size(path) > 0, up).otherwise(digest)


def levels_of(size: int) -> int:
    """Levels that one round climbs in a tree that has ``size`` nodes left."""
    return 0 if size == 1 else 1 if size <= FAN_OUT else LEVELS


def climb(digests: list[str], levels: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """The node ``levels`` above a block, and the child digests of each label (level, index) on the way."""
    queue: list[tuple[int, int, int, str]] = []
    for at, digest in enumerate(digests):
        heappush(queue, (1, at // FAN_OUT, at, digest))
    runs: dict[tuple[int, int], list[str]] = {}
    digest = digests[0]
    while levels:
        level, index = label = queue[0][:2]
        runs[label] = run = []
        while queue and queue[0][:2] == label:
            run.append(heappop(queue)[3])
        digest = sha256("".join(run).encode()).hexdigest()
        if level == levels:
            break
        heappush(queue, (level + 1, index // FAN_OUT, index, digest))
    return digest, runs


def descend(size: int, levels: int, runs: dict[tuple[int, int], list[str]], suffix: list[str]) -> list[list[str]]:
    """The proof suffix of each node of a block: left and right siblings in turn, its own level first."""
    found: list[list[str]] = [suffix] * size
    queue = [(-levels, 0, suffix)] if levels else []
    while queue:
        level, index, above = heappop(queue)
        run = runs[-level, -index]
        for at, _ in enumerate(run):
            own = ["".join(run[:at]), "".join(run[at + 1 :]), *above]
            child = -index * FAN_OUT + at
            if level == -1:
                found[child] = own
            else:
                heappush(queue, (level + 1, -child, own))
    return found


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _written(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) == _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)
            kept = []
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order with their place among the rows of their tree in this partition."""
    part, last, n = TaskContext.get().partitionId(), (), 0
    for batch in batches:
        places = []
        for tree in batch.column("tree").to_pylist():
            n = n + 1 if (tree,) == last else 0
            last = (tree,)
            places.append(n)
        yield batch.append_column("part", pa.array([part] * len(places), pa.int32())).append_column("pos", pa.array(places, pa.int64()))


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.binary())])

    def out() -> Iterator[tuple]:
        for (tree, block), rows in groupby(_rows(batches, ["tree", "block", "size", "digest"]), itemgetter(0, 1)):
            rows = list(rows)
            levels = levels_of(rows[0][2])
            digest, _ = climb([row[3].hex() for row in rows], levels)
            yield tree, block, -(-rows[0][2] // FAN_OUT**levels), bytes.fromhex(digest)

    return _written(out(), schema)


def _down(carry: pa.Schema):
    fixed = ["tree", "block", "kind", "pos", "size", "digest", "path", "subroot"]
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("digest", pa.binary()), ("path", pa.list_(pa.string())), ("subroot", pa.string()), *carry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for _, rows in groupby(_rows(batches, [*fixed, *carry.names]), itemgetter(0, 1)):
                message, *rows = rows
                levels = levels_of(rows[0][4])
                _, runs = climb([row[5].hex() for row in rows], levels)
                for row, path in zip(rows, descend(len(rows), levels, runs, message[6])):
                    yield row[0], row[3], row[5], path, message[7], *row[len(fixed) :]

        return _written(out(), schema)

    return run


def _carried(df: DataFrame, names: tuple[str, ...]) -> tuple[list[T.StructField], pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [df.schema[n] for n in names]
    fields = [T.StructField(f.name, f.dataType) for f in fields]
    return fields, to_arrow_schema(T.StructType(fields))


@dataclass
class Forest:
    """The nodes of each round of the forward sweep; those of the first are the leaves."""

    rounds: list[DataFrame]
    #: (tree, digest, done): the subroots and the round they were left in.
    subroots: DataFrame
    carry: tuple[str, ...]

    def deliver(self, messages: DataFrame) -> DataFrame:
        """The leaves with what the reversed sweep brings them; ``messages`` has tree, path, subroot and done."""
        below = None
        for at in range(len(self.rounds) - 1, -1, -1):
            carry = () if at else self.carry
            nodes = self.rounds[at]
            fields, arrow = _carried(nodes, carry)
            sent = messages.where(F.col("done") == at).select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot")
            if below is not None:
                sent = sent.unionByName(below.select("tree", F.col("pos").alias("block"), "path", "subroot"))
            sent = sent.withColumn("kind", F.lit(0))
            queue = nodes.withColumns({"kind": F.lit(1), "block": F.expr(f"pos DIV {BLOCK}")}).unionByName(sent, allowMissingColumns=True)
            ordered = queue.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "pos")
            kinds = [("tree", T.StringType()), ("pos", T.LongType()), ("digest", T.BinaryType()), ("path", T.ArrayType(T.StringType())), ("subroot", T.StringType())]
            below = ordered.mapInArrow(_down(arrow), T.StructType([*[T.StructField(*k) for k in kinds], *fields]))
            below = stored(below, "suffixes") if at else below
        return below


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (tree, key, digest, …) with ``pos``, the place in its tree, and ``size``, the number of its rows."""
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema], T.StructField("part", T.IntegerType()), T.StructField("pos", T.LongType())])
    order = ["tree", "key", "digest", "_row"]
    numbered = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_number, schema), "numbered")
    parts = numbered.groupBy("part", "tree").agg(F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = parts.select(F.col("part").alias("_part"), F.col("tree").alias("_tree"), before.alias("_shift"), F.sum("n").over(tree).alias("size"))
    found = numbered.join(shifts, (F.col("part") == F.col("_part")) & F.col("tree").eqNullSafe(F.col("_tree")))
    return found.withColumn("pos", F.col("pos") + F.col("_shift")).drop("part", "key", "_row", "_part", "_tree", "_shift")


def forest(rows: DataFrame, carry: tuple[str, ...] = ()) -> Forest:
    """The forward sweep over ``rows``: (tree string, key, digest binary) and the columns of ``carry``."""
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    rounds = [stored(_placed(rows), "placed")]
    most = rounds[0].agg(F.max("size")).first()[0] or 1
    while most > 1:
        nodes = rounds[-1].where("size > 1").select("tree", "pos", "size", "digest", F.expr(f"pos DIV {BLOCK}").alias("block"))
        ordered = nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
        rounds.append(stored(ordered.mapInArrow(_up, "tree string, pos long, size long, digest binary"), "nodes"))
        most = -(-most // FAN_OUT ** levels_of(most))
    done = [nodes.where("size = 1").select("tree", "digest", F.lit(at).alias("done")) for at, nodes in enumerate(rounds)]
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.unionByName(more)
    return Forest(rounds, subroots, carry)


def manifest(leaves: DataFrame, tree: str = "source", key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``(tree, leaf, subroot, root, path)`` and the columns named in ``carry``, for each row of ``leaves``.

    ``leaves`` has ``leaf`` (see :func:`leaf`), the string column ``tree`` and the column ``key``.
    Trees are in the order of their names, null first, UTF-8 bytewise; the leaves of one by ``key``, null first,
    then by digest.  ``path`` lists the digests left and right of the row, of its parent, and so on up to the root,
    two joined texts for each level; a level without siblings has two empty ones.  Repeated rows are leaves
    of their own.  A table of one row has its leaf as its root and an empty path; no rows give none.  Other
    columns are ignored; a carried one must not have the name of one of these or of ``tree``.
    """
    taken = {"leaf", "subroot", "root", "path", "tree", "pos", "size", "digest", "block", "kind", "part", "key", "_row", "done"}
    if clash := taken & set(carry):
        raise ValueError(f"these names are taken: {sorted(clash)}")
    trees = forest(leaves.select(F.col(f"`{tree}`").cast("string").alias("tree"), F.col(f"`{key}`").alias("key"), F.unhex("leaf").alias("digest"), *[F.col(f"`{c}`") for c in carry]), carry)
    subroots = trees.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.col("tree").alias("name"), "done")
    top = forest(subroots.withColumnRenamed("done", "was_done"), ("name", "was_done"))
    root = top.subroots.select("digest").first()
    hexed = F.lower(F.hex(F.lit(bytes(root[0])))) if root else F.lit(None).cast("string")
    start = top.subroots.select("tree", F.array().cast("array<string>").alias("path"), hexed.alias("subroot"), "done")
    messages = top.deliver(start).select(F.col("name").alias("tree"), "path", F.lower(F.hex("digest")).alias("subroot"), F.col("was_done").alias("done"))
    found = trees.deliver(stored(messages, "messages"))
    return found.select("tree", F.lower(F.hex("digest")).alias("leaf"), "subroot", hexed.alias("root"), "path", *[F.col(f"`{c}`") for c in carry])
