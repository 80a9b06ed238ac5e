"""Conversation prefix trie from padded turn-id matrices.

*Turn ids.*  A turn (role and text) is 120 bits of the SHA-256 of both, as two longs.  Only ids and lengths
move, never a text; equal ids are taken for equal turns.

*Shards.*  Conversations are range-partitioned by (ids, conversation id), so each shard holds one
stretch of the trie in depth-first order, and equal conversations can lie in several.  A shard
fills padded matrices of ``COLUMNS`` turns at a time, with the rows that are so long; ``numpy.lexsort`` orders them,
a column-wise OR of the changes from row to row marks where nodes start, and ``reduceat`` aggregates every
depth.  Sums over subtrees run from the deepest depth up.

*Boundaries.*  Only the nodes on the path of a shard's first and last row can go on in a neighbour.
They leave as partial sums over what is complete in the shard.  ``SHARDS_AT_ONCE`` neighbours are recombined at a time, which
completes all nodes but those on the outer two paths, and so on until one stretch is left.  A complete child
of a boundary node gets its parent's number by a join on (shard, parent), which no node can make hot.

A conversation is one row, 20 bytes a turn, so its length bounds a task; so do the conversations that end at one node
and lie in several shards, whose ids are read in order, not kept, for their digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.llm.common import stored

#: Conversations of a shard, turns of a matrix, shards that are recombined in one task.
SHARD_ROWS, COLUMNS, SHARDS_AT_ONCE = 16_384, 16, 64

_PARTIAL = (
    "kind string, shard long, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, chars long, is_first boolean, is_last boolean"
)
_SCHEMA = pa.schema([
    ("kind", pa.string()), ("shard", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("chars", pa.int64()), ("is_first", pa.bool_()), ("is_last", pa.bool_()),
])
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def assembled(turns: DataFrame) -> DataFrame:
    """``(conv_id, ids, chars)``: the turns of each conversation in order, two longs and a length in code points for each.

    Null roles and texts are empty ones.  Turns are ordered by ``turn``, null first, ties by role and then by turn id.
    Rows without ``conv_id`` belong to no conversation and are left out.  Other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    named = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("d"), F.length(text).alias("chars"))
    halves = [F.conv(F.substring("d", start, 15), 16, 10).cast("long").alias(name) for start, name in ((1, "hi"), (16, "lo"))]
    one = F.struct("turn", "role", *halves, "chars")
    rows = named.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))  # a null turn sorts first inside a struct
    ids = F.flatten(F.transform("t", lambda t: F.array(t["hi"], t["lo"])))
    return rows.select("conv_id", ids.alias("ids"), F.transform("t", lambda t: t["chars"]).alias("chars"))


def with_shared_heads(conversations: DataFrame, span: int = 100, most: int = 6) -> DataFrame:
    """Each conversation c with the first h turns of conversation ``c - c % span`` in place of its own first h.

    ``h`` is the unsigned CRC-32 of the decimal ``conv_id``, modulo ``most``.  All turns are taken if there are fewer,
    none if there is no such conversation; so a conversation can be left without turns.
    """
    c = F.col("conv_id")
    heads = conversations.where(c % span == 0).select(c.alias("base"), F.slice("ids", 1, 2 * (most - 1)).alias("head_ids"), F.slice("chars", 1, most - 1).alias("head_chars"))
    own = conversations.withColumns({"base": c - c % span, "h": (F.crc32(c.cast("string").cast("binary")) % most).cast("int")})
    joined = own.join(heads, "base", "left")

    def swapped(head: str, own: str, width: int):
        first = F.coalesce(F.slice(head, F.lit(1), F.col("h") * width), F.expr("array()"))
        rest = F.slice(own, F.col("h") * width + 1, F.size(own))
        return F.concat(first, rest)

    return joined.select("conv_id", swapped("head_ids", "ids", 2).alias("ids"), swapped("head_chars", "chars", 1).alias("chars"))


def _sorted_block(rows: np.ndarray, node: np.ndarray, matrix: np.ndarray, convs: np.ndarray) -> np.ndarray:
    """The order of rows by (node, ids, conversation id); shorter rows come before those they begin."""
    return np.lexsort((convs[rows], *matrix.T[::-1], node))


def shard_nodes(convs: np.ndarray, ids: np.ndarray, chars: np.ndarray, offsets: np.ndarray) -> list[dict[str, np.ndarray]]:
    """For each depth, the nodes of a shard in order.

    ``ids`` holds the two longs of every turn, ``offsets`` the first turn of each row and the end.  A depth has ``first`` (the
    row that is first in order), ``parent`` (place in the depth above), ``conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved`` (of the subtree), ``chars`` and ``ends``, the rows that end there, with ``ends_at``, the node of each.
    """
    length = np.diff(offsets)
    rows = np.argsort(convs, kind="stable")
    node = np.zeros(len(rows), np.int64)
    depths = []

    def depth_of(rows: np.ndarray, starts: np.ndarray, parent: np.ndarray, depth: int) -> np.ndarray:
        """Note the nodes that begin at ``starts`` of the rows in order; the node of each row."""
        node = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
        ended = length[rows] == depth
        first = rows[starts]
        depths.append({
            "first": first, "parent": parent, "conv_id": np.minimum.reduceat(convs[rows], starts), "n_convs": np.diff(np.append(starts, len(rows))),
            "chars": chars[offsets[first] + depth - 1] if depth else np.zeros(1, np.int64), "ends": rows[ended], "ends_at": node[ended],
        })
        return node

    node = depth_of(rows, np.zeros(1, np.int64), np.zeros(1, np.int64), 0)
    depth = 0
    while len(rows):
        alive = length[rows] > depth
        rows, node = rows[alive], node[alive]
        if not len(rows):
            break
        width = min(COLUMNS, int(length[rows].max()) - depth)
        places = offsets[rows][:, None] + depth + np.arange(width)
        there = depth + np.arange(width) < length[rows][:, None]
        matrix = np.where(there[:, :, None], ids[np.where(there, places, 0)], -1).reshape(len(rows), 2 * width)
        order = _sorted_block(rows, node, matrix, convs)
        rows, node, matrix, there = rows[order], node[order], matrix[order], there[order]
        changed = np.ones((len(rows), width + 1), bool)
        changed[1:, 0] = node[1:] != node[:-1]
        changed[1:, 1:] = (matrix[1:] != matrix[:-1]).reshape(len(rows) - 1, width, 2).any(axis=2)
        changed = np.logical_or.accumulate(changed, axis=1)
        for column in range(width):
            stays = there[:, column]
            at = np.flatnonzero(stays)
            starts = np.flatnonzero(changed[at, column + 1])
            above = node[at[starts]]
            node = np.zeros_like(node)
            node[at] = depth_of(rows[at], starts, above, depth + column + 1)
        depth += width
    for at, now in enumerate(depths):
        below = depths[at + 1]["parent"] if at + 1 < len(depths) else np.zeros(0, np.int64)
        now["n_children"] = np.bincount(below, minlength=len(now["first"]))
    for at in range(len(depths) - 1, -1, -1):
        now = depths[at]
        now["n_leaves"] = (now["n_children"] == 0).astype(np.int64)
        now["saved"] = (now["n_convs"] - 1) * now["chars"]
        if at + 1 < len(depths):
            below = depths[at + 1]
            np.add.at(now["n_leaves"], below["parent"], below["n_leaves"])
            np.add.at(now["saved"], below["parent"], below["saved"])
    return depths


def _paths(depths: list[dict[str, np.ndarray]]) -> tuple[list[int], list[int]]:
    """The places, depth by depth, of the nodes above a shard's first and last row."""
    first, last = [0], [0]
    for at, now in enumerate(depths[1:]):
        if len(first) == at + 1 and now["parent"][0] == first[at] and not (depths[at]["ends_at"] == first[at]).any():
            first.append(0)
        if len(last) == at + 1 and now["parent"][-1] == last[at]:
            last.append(len(now["first"]) - 1)
    return first, last


def _keys(row_ids: np.ndarray, depth: int) -> list[bytes]:
    """The keys of the nodes on a row's path: digests of its first 0, 1, … turns."""
    digest, found = sha256(), [sha256().digest()[:16]]
    for turn in row_ids[:depth]:
        digest.update(turn.tobytes())
        found.append(digest.copy().digest()[:16])
    return found


def _digest(convs: list[int]) -> str:
    return sha256(",".join(map(str, convs)).encode()).hexdigest()


def _of_shard(shard: int, convs: np.ndarray, ids: np.ndarray, chars: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """Rows of ``_PARTIAL``: complete nodes, boundary nodes ("edge"), and conversations that end at a boundary node ("end")."""
    depths = shard_nodes(convs, ids, chars, offsets)
    first, last = _paths(depths)
    keys: list[dict[int, bytes]] = [{} for _ in depths]
    for path in (first, last):
        row = depths[len(path) - 1]["first"][path[-1]]
        for depth, (at, key) in enumerate(zip(path, _keys(ids[offsets[row] : offsets[row + 1]], len(path) - 1))):
            keys[depth][at] = key
    inner = [{name: now[name].copy() for name in ("n_children", "n_leaves", "saved")} for now in depths]
    for depth, marked in enumerate(keys):  # a boundary node keeps what is complete below it
        for at in marked:
            inner[depth]["saved"][at] -= (depths[depth]["n_convs"][at] - 1) * depths[depth]["chars"][at]
            inner[depth]["n_leaves"][at] -= depths[depth]["n_children"][at] == 0
            if depth:
                up = depths[depth]["parent"][at]
                inner[depth - 1]["n_children"][up] -= 1
                inner[depth - 1]["n_leaves"][up] -= depths[depth]["n_leaves"][at]
                inner[depth - 1]["saved"][up] -= depths[depth]["saved"][at]
    for depth, now in enumerate(depths):
        ends = now["ends"][np.lexsort((convs[now["ends"]], now["ends_at"]))]
        bounds = np.searchsorted(np.sort(now["ends_at"]), np.arange(len(now["first"]) + 1)).tolist()
        ended = convs[ends].tolist()
        columns = [now[n].tolist() for n in ("conv_id", "parent", "n_convs", "chars")] + [inner[depth][n].tolist() for n in ("n_children", "n_leaves", "saved")]
        above = depths[depth - 1]["conv_id"].tolist() if depth else []
        for at, (conv, parent, n, length, children, leaves, saved) in enumerate(zip(*columns)):
            mine = ended[bounds[at] : bounds[at + 1]]
            up = keys[depth - 1].get(parent) if depth else None
            if key := keys[depth].get(at):
                yield "edge", shard, key, up, depth, conv, None, n, children, leaves, saved, None, length, len(first) > depth and first[depth] == at, len(last) > depth and last[depth] == at
                for c in mine:
                    yield "end", shard, key, None, depth, c, *[None] * 9
            else:
                yield "node", shard, None, up, depth, conv, None if up else above[parent], n, children, leaves, saved, _digest(mine), None, None, None


def _batches(rows: Iterator[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), _SCHEMA)], schema=_SCHEMA)
            kept = []
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), _SCHEMA)], schema=_SCHEMA)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    convs = table.column("conv_id").to_numpy()
    chars, ids = (table.column(c).combine_chunks() for c in ("chars", "ids"))
    lengths = chars.value_lengths().to_numpy()
    offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)
    yield from _batches(_of_shard(TaskContext.get().partitionId(), convs, flat, chars.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets))


def recombined(edges: list[dict], whole: bool) -> tuple[list[dict], list[dict]]:
    """Boundary nodes of neighbouring shards, in order, as (complete ones, those on the outer two paths); none is outer if this is the ``whole``."""
    low, high = min(e["shard"] for e in edges), max(e["shard"] for e in edges)
    nodes: dict[bytes, dict] = {}
    for edge in edges:
        edge = edge | {"is_first": edge["shard"] == low and edge["is_first"], "is_last": edge["shard"] == high and edge["is_last"]}
        if edge["key"] in nodes:
            node = nodes[edge["key"]]
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                node[name] += edge[name]
            node["conv_id"] = min(node["conv_id"], edge["conv_id"])
            node["is_first"] |= edge["is_first"]
            node["is_last"] |= edge["is_last"]
        else:
            nodes[edge["key"]] = edge
    done, outer = [], []
    for node in sorted(nodes.values(), key=itemgetter("depth"), reverse=True):
        if not whole and (node["is_first"] or node["is_last"]):
            outer.append(node)
            continue
        node["n_leaves"] += node["n_children"] == 0
        node["saved_tokens"] += (node["n_convs"] - 1) * node["chars"]
        done.append(node)
        if node["parent_key"] is not None:
            up = nodes[node["parent_key"]]
            up["n_children"] += 1
            up["n_leaves"] += node["n_leaves"]
            up["saved_tokens"] += node["saved_tokens"]
    return done, outer


def _recombine(whole: bool):
    def run(group: pa.Table) -> pa.Table:
        to = group.column("to")[0].as_py()
        done, outer = recombined(group.drop_columns(["to"]).to_pylist(), whole)
        rows = [n | {"kind": "done"} for n in done] + [n | {"kind": "edge", "shard": to} for n in outer]
        return pa.Table.from_pylist(rows, _SCHEMA)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the conversation ids of each key; rows come ordered by key and id."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist())

    for key, found in groupby(rows(), itemgetter(0)):
        digest = sha256()
        for n, (_, conv) in enumerate(found):
            digest.update(f",{conv}".encode() if n else str(conv).encode())
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``conversations`` (``conv_id``, ``ids``, ``chars``; see :func:`assembled`).

    A node is a distinct sequence of first turns; the root, of depth 0, has none.  The columns: ``conv_id``, the smallest
    member; ``depth``; ``parent_conv_id``, that of the node above, null for the root; ``n_convs``, the conversations that
    start like this; ``n_children``; ``n_leaves``, the childless nodes at or below; ``saved_tokens``, the sum of
    ``(n_convs - 1) * chars`` at or below, which is what storing each turn once saves; and ``ends_sha256``, of the ids of those that
    end here, ascending, with commas between.  Each ``conv_id`` must be there once.  Conversations without turns belong to
    the root; no conversations give no nodes.
    """
    rows = stored(conversations.select("conv_id", "ids", "chars"), "conversations")
    n = rows.count()
    shards = max(1, -(-n // SHARD_ROWS))
    dealt = rows.repartitionByRange(shards, "ids", "conv_id")
    found = stored(dealt.mapInArrow(_shard, _PARTIAL), "trie")
    pieces = found.where("kind = 'edge'")
    first_edges, done = pieces, []
    while True:
        shards = -(-shards // SHARDS_AT_ONCE)
        to = F.expr(f"shard DIV {SHARDS_AT_ONCE}")
        step = stored(pieces.withColumn("to", to).groupBy("to").applyInArrow(_recombine(shards == 1), _PARTIAL), "boundaries")
        done.append(step.where("kind = 'done'"))
        if shards == 1:
            break
        pieces = step.where("kind = 'edge'")
    edges = done[0]
    for more in done[1:]:
        edges = edges.unionByName(more)
    told = found.where("kind = 'end'").select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_ends, "key binary, ends_sha256 string")
    numbers = edges.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
    complete = edges.drop("ends_sha256", "parent_conv_id").join(told, "key", "left").join(numbers, F.col("parent_key") == F.col("up"), "left")
    complete = complete.withColumns({"parent_conv_id": F.col("up_conv"), "ends_sha256": F.coalesce("ends_sha256", F.lit(_digest([])))}).select(*_NODE)
    placed = first_edges.select("shard", "key").join(numbers, F.col("key") == F.col("up")).select("shard", F.col("key").alias("parent_key"), "up_conv")
    inner = found.where("kind = 'node'").join(placed, ["shard", "parent_key"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv")).select(*_NODE)
    return inner.unionByName(complete)
