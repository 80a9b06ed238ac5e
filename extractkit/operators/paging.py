"""Pages, row caps, and row numbers of a totally ordered result.

``row_number()`` over one global window runs in a single task, and a range
repartitioning is sampled anew by every action.  Here a sample of the order key
is turned into literal boundaries once, so that a row's bucket is a pure
expression; buckets are then numbered in parallel and shifted by the rows before
them.  Only boundaries and per-bucket counts reach the driver.
"""

from __future__ import annotations

import math
import re
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..errors import DuplicateKeyError
from ..functions.naming import check_identifier

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 8_192
MAX_COMPILED_TESTS = 12
SAMPLES_PER_BUCKET = 20
COPIES_PER_BLOCK = 10_000
SHALLOW_ROWS = 100_000
DEFAULT_CHUNK_ROWS = 10_000
MAX_AUTO_CHUNKS = 50_000


# --- order keys ---------------------------------------------------------------


@dataclass(frozen=True)
class OrderKey:
    name: str
    descending: bool = False

    def sort(self) -> Column:
        """NULL counts as the largest value: last when ascending, first when descending."""
        column = F.col(self.name)
        return column.desc_nulls_first() if self.descending else column.asc_nulls_last()


def order_keys(order_by) -> list[OrderKey]:
    """Parse ``"a, b desc"``, a list of such terms, or ready keys."""
    if isinstance(order_by, str):
        order_by = order_by.split(",")
    keys = []
    for term in order_by or ():
        if isinstance(term, OrderKey):
            keys.append(term)
            continue
        words = re.split(r"\s+", str(term).strip())
        if len(words) > 2 or (len(words) == 2 and words[1].lower() not in {"asc", "desc"}):
            raise ValueError(f"Order term not understood: {term!r}")
        descending = len(words) == 2 and words[1].lower() == "desc"
        keys.append(OrderKey(check_identifier(words[0], "order column"), descending))
    if not keys:
        raise ValueError("order_by is required for a repeatable order.")
    return keys


def sort_columns(order_by) -> list[Column]:
    return [key.sort() for key in order_keys(order_by)]


def _whole_number(value, label: str, least: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < least:
        raise ValueError(f"{label} must be an integer of at least {least}.")
    return value


# --- pages and caps -------------------------------------------------------------


def content_hashes(df: DataFrame, columns=None) -> list[Column]:
    """Two hashes of a row's columns, all of them by default: rows that agree in both are equal, for all practical purposes.

    Maps cannot be hashed; their JSON can.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    values = [F.to_json(F.struct(f"`{n}`")) if "map<" in kinds[n] else F.col(f"`{n}`") for n in (kinds if columns is None else columns)]
    return [F.xxhash64(*values), F.xxhash64(F.lit("second"), *values)]


def page(df: DataFrame, order_by, offset: int, limit: int, *, shallow: int | None = None) -> DataFrame:
    """Rows ``[offset, offset + limit)``.

    Tied rows follow a content hash, so pages of one order neither lose nor repeat
    rows.  A shallow page is a top-k.  A top-k gathers everything before its end in
    one place, so a deep page is cut out of the distributed row numbers, which have
    the same order.
    """
    _whole_number(offset, "offset", 0)
    _whole_number(limit, "limit", 1)
    if offset + limit <= (SHALLOW_ROWS if shallow is None else shallow):
        return df.orderBy(*sort_columns(order_by), *content_hashes(df)).offset(offset).limit(limit)
    place = F.col("_page_row")
    numbered = number_rows(df, order_by, column="_page_row", break_ties=True)
    return numbered.where((place >= offset) & (place < offset + limit)).orderBy(place).drop(place)


def row_cap(df: DataFrame, max_rows: int, order_by=None, *, shallow: int | None = None) -> DataFrame:
    """At most ``max_rows`` rows; the first ones, in order, when an order is given.

    A top-k or a limit gathers its rows in one task, so it serves up to ``shallow`` rows only
    (:data:`SHALLOW_ROWS`).  Beyond, rows are counted by ranges of the order key, or of a content hash
    without one; ranges before the cut stay whole where they are, and only the range that holds
    the cut is numbered.
    """
    _whole_number(max_rows, "max_rows", 1)
    if max_rows <= (SHALLOW_ROWS if shallow is None else shallow):
        return (df if order_by is None else df.orderBy(*sort_columns(order_by))).limit(max_rows)
    return _cut_by_hash(df, max_rows) if order_by is None else _cut_by_key(df, max_rows, order_by)


def _boundary(counts: list[tuple[int, int]], max_rows: int) -> tuple[int, int] | None:
    """The range that holds the cut and the rows wanted of it; None if there are no more rows than wanted."""
    before = 0
    for place, rows in sorted(counts):
        if before + rows > max_rows:
            return place, max_rows - before
        before += rows
    return None


def _cut_by_hash(df: DataFrame, max_rows: int) -> DataFrame:
    place = F.shiftright(content_hashes(df)[0], 48)
    placed = df.withColumn("_bucket", place)
    counts = [tuple(r) for r in placed.groupBy("_bucket").count().collect()]
    found = _boundary(counts, max_rows)
    if found is None:
        return df
    edge, rest = found
    whole = placed.where(F.col("_bucket") < edge).drop("_bucket")
    if not rest:
        return whole
    cores = df.sparkSession.sparkContext.defaultParallelism
    cut = _order_copies(placed.where(F.col("_bucket") == edge), max(cores, bucket_count(dict(counts)[edge], cores)), F.lit(0))
    return whole.unionByName(cut.where(F.col("_row_no") < rest).drop("_row_no"))


def _cut_by_key(df: DataFrame, max_rows: int, order_by) -> DataFrame:
    keys = order_keys(order_by)
    total = df.count()
    edges = sample_buckets(df, keys, bucket_count(total, df.sparkSession.sparkContext.defaultParallelism), total)
    placed = df.withColumn("_bucket", edges.column())
    found = _boundary([tuple(r) for r in placed.groupBy("_bucket").count().collect()], max_rows)
    sort = [key.sort() for key in keys]
    if found is None:
        return df.orderBy(*sort)
    edge, rest = found
    kept = placed.where(F.col("_bucket") < edge).drop("_bucket")
    if rest:
        own = placed.where(F.col("_bucket") == edge)
        if edge % 2:  # a frequent key: its rows tie
            cut = _order_copies(own, len(edges.boundaries) + 1, F.lit(0))
        else:
            window = Window.partitionBy("_bucket").orderBy(*sort, *content_hashes(df))
            cut = own.withColumn("_row_no", F.row_number().over(window) - 1).drop("_bucket")
        kept = kept.unionByName(cut.where(F.col("_row_no") < rest).drop("_row_no"))
    return kept.orderBy(*sort)


def count_query(df: DataFrame) -> DataFrame:
    """One row ``row_count``; sorts are dropped by the optimizer, limits are kept."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def digest_terms(df: DataFrame) -> list[Column]:
    """Aggregates that tell a table's contents whatever the order of its rows: a count and two sums of hashes."""
    return [F.count(F.lit(1)).alias("rows"), *[F.sum(h.cast("decimal(38,0)")).alias(n) for h, n in zip(content_hashes(df), ("one", "two"))]]


def survey(df: DataFrame, order_by, folder: str) -> tuple[dict, DataFrame]:
    """Count and digest of the source, and its order key alone, from one evaluation.

    The totals are observed while the narrow key is written; whatever else a plan needs is read from there.
    """
    seen = Observation()
    names = list(dict.fromkeys(key.name for key in order_keys(order_by)))
    df.observe(seen, *digest_terms(df)).select(*[F.col(n) for n in names]).write.mode("overwrite").parquet(folder)
    return seen.get, df.sparkSession.read.schema(df.select(*names).schema).parquet(folder)


# --- chunk plan -----------------------------------------------------------------


@dataclass(frozen=True)
class ChunkPlan:
    total_rows: int
    planned_rows: int
    chunk_size: int
    total_chunks: int
    start_offset: int = 0

    def to_dict(self) -> dict:
        return asdict(self)


def plan_chunks(
    total_rows: int,
    chunk_size: int | str = "auto",
    *,
    max_rows: int | None = None,
    max_file_rows: int | None = None,
    start_offset: int = 0,
) -> ChunkPlan:
    """Chunk sizes for a result of ``total_rows`` rows."""
    _whole_number(start_offset, "start_offset", 0)
    planned = max(0, total_rows - start_offset)
    if max_rows is not None:
        planned = min(planned, _whole_number(max_rows, "max_rows", 1))
    if chunk_size == "auto":
        size = max(DEFAULT_CHUNK_ROWS, math.ceil(planned / MAX_AUTO_CHUNKS))
    else:
        size = _whole_number(chunk_size, "chunk_size", 1)
    if max_file_rows is not None:
        size = min(size, _whole_number(max_file_rows, "max_file_rows", 1))
    return ChunkPlan(total_rows, planned, size, math.ceil(planned / size), start_offset)


def among(column: str, numbers) -> Column:
    """Is a whole number one of these?  They may be many, so they are handed over as one text."""
    return F.expr(f"`{column}` IN ({', '.join(f'{number}L' for number in sorted(numbers))})")


def chunk_table(spark, plan: ChunkPlan) -> DataFrame:
    """One row per planned chunk: ``chunk_id, row_offset, row_limit``."""
    size = F.lit(plan.chunk_size).cast("bigint")
    done = F.col("id") * size
    return spark.range(plan.total_chunks).select(
        F.col("id").alias("chunk_id"),
        (done + F.lit(plan.start_offset)).alias("row_offset"),
        F.least(size, F.lit(plan.planned_rows) - done).alias("row_limit"),
    )


def with_chunks(numbered: DataFrame, plan: ChunkPlan, row_column: str = "row_no") -> DataFrame:
    """Keep the planned rows of a numbered result and add their ``chunk_id``."""
    position = F.col(row_column) - F.lit(plan.start_offset)
    kept = numbered.where((position >= 0) & (position < F.lit(plan.planned_rows)))
    return kept.withColumn("chunk_id", F.floor(position / F.lit(plan.chunk_size)).cast("bigint"))


# --- distributed row numbers ------------------------------------------------------


def _encoded(df: DataFrame, key: OrderKey) -> str:
    """SQL for the key in a form that survives the trip through Python literals."""
    kind = df.schema[key.name].dataType
    column = f"`{key.name}`"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"unix_micros(CAST({column} AS TIMESTAMP))"
    if isinstance(kind, T.DateType):
        return f"unix_date({column})"
    if isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.BinaryType)):
        return column
    raise TypeError(f"Cannot order by {key.name}: {kind.simpleString()}")


def sql_literal(value, kind: T.DataType) -> str:
    """SQL text of one collected value."""
    if isinstance(kind, T.StringType):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if isinstance(kind, T.BinaryType):
        return f"X'{bytes(value).hex()}'"
    return f"CAST('{value}' AS {kind.simpleString()})"


class Buckets:
    """Literal boundaries of an order key and the bucket expression they give.

    Bucket ``2 * p`` holds the rows after the p-th boundary.  A boundary that the
    sample met more than once marks a frequent key; its rows get the odd bucket
    ``2 * p - 1`` to themselves.
    """

    def __init__(self, df: DataFrame, keys: list[OrderKey], boundaries: list[tuple], frequent: list[bool]):
        self.keys = keys
        self.boundaries = boundaries
        self.frequent = frequent
        self._rows = [_encoded(df, key) for key in keys]
        kinds = df.select(*[F.expr(row) for row in self._rows]).schema
        self._kinds = [field.dataType for field in kinds.fields]

    def _at_or_after(self, edge: tuple) -> str:
        """Is the row at or after one boundary, NULL being the largest value?"""
        result = None
        for i in range(len(self.keys) - 1, -1, -1):
            row, value, down = self._rows[i], edge[i], self.keys[i].descending
            if value is None:
                rest = "true" if result is None else result
                result = f"({row} IS NOT NULL OR {rest})" if down else f"({row} IS NULL AND {rest})"
                continue
            bound, sign = sql_literal(value, self._kinds[i]), "<" if down else ">"
            past = f"{row} {sign}= {bound}"
            if result is not None:
                past = f"{row} {sign} {bound} OR ({row} = {bound} AND {result})"
            result = f"({past})" if down else f"({row} IS NULL OR {past})"
        return result

    def _equals(self, edge: tuple) -> str:
        terms = []
        for row, value, kind in zip(self._rows, edge, self._kinds):
            terms.append(f"{row} <=> " + ("NULL" if value is None else sql_literal(value, kind)))
        return " AND ".join(terms)

    def _leaf(self, position: int) -> str:
        if position and self.frequent[position - 1]:
            hot = self._equals(self.boundaries[position - 1])
            return f"CASE WHEN {hot} THEN {2 * position - 1} ELSE {2 * position} END"
        return str(2 * position)

    def _search(self, low: int, high: int) -> str:
        """Decision tree over the boundaries numbered ``low + 1`` to ``high``."""
        if low == high:
            return self._leaf(low)
        middle = (low + high + 1) // 2
        passed = self._at_or_after(self.boundaries[middle - 1])
        return f"CASE WHEN {passed} THEN {self._search(middle, high)} ELSE {self._search(low, middle - 1)} END"

    def column(self) -> Column:
        """Bucket number of a row; a row meets only one path of the tree."""
        tree = F.expr(self._search(0, len(self.boundaries)))
        if len(self.boundaries) * len(self.keys) <= MAX_COMPILED_TESTS:
            return tree
        # A large tree makes the generated method too long for the JIT compiler, or
        # for the class file.  Lambda bodies are evaluated without code generation,
        # which keeps the rest of the stage fast.
        return F.get(F.transform(F.array(F.lit(0)), lambda _: tree), F.lit(0))


def bucket_count(total_rows: int, parallelism: int) -> int:
    """How many buckets a result of this size deserves."""
    by_size = math.ceil(total_rows / ROWS_PER_BUCKET)
    by_cores = min(parallelism, math.ceil(total_rows / 20_000))
    return max(1, min(MAX_BUCKETS, max(by_size, by_cores)))


def sample_buckets(df: DataFrame, order_by, buckets: int, total_rows: int) -> Buckets:
    """Boundaries from a key sample of at most a fixed number of rows per bucket."""
    keys = order_keys(order_by)
    if buckets <= 1 or total_rows == 0:
        return Buckets(df, keys, [], [])
    narrow = df.select(*[key.name for key in keys])
    wanted = buckets * SAMPLES_PER_BUCKET
    if total_rows > wanted:
        narrow = narrow.sample(fraction=wanted / total_rows, seed=17)
    ordered = narrow.orderBy(*[key.sort() for key in keys])
    rows = ordered.select(*[F.expr(_encoded(df, key)).alias(f"k{i}") for i, key in enumerate(keys)]).collect()
    boundaries, frequent = [], []
    for step in range(1, buckets):
        position = len(rows) * step // buckets
        if position >= len(rows):
            continue
        edge = tuple(rows[position])
        if boundaries and boundaries[-1] == edge:
            frequent[-1] = True
        else:
            boundaries.append(edge)
            frequent.append(False)
    return Buckets(df, keys, boundaries, frequent)


def _starts(counts: list[tuple], width: int) -> list[int]:
    """Rows before each bucket."""
    sizes = [0] * width
    for bucket, rows in counts:
        sizes[bucket] += rows
    starts, before = [], 0
    for size in sizes:
        starts.append(before)
        before += size
    return starts


def _start_column(starts: list[int], bucket: Column) -> Column:
    return F.get(F.expr("array(" + ", ".join(f"{start}L" for start in starts) + ")"), bucket)


def _bucketed(df: DataFrame, edges: Buckets) -> tuple[DataFrame, Column]:
    """Rows with their bucket, and the number of rows before it."""
    bucketed = df.withColumn("_bucket", edges.column())
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    starts = _starts([(row["_bucket"], row["n"]) for row in counts], 2 * len(edges.boundaries) + 1)
    return bucketed, _start_column(starts, F.col("_bucket"))


def _one_task_each(bucketed: DataFrame, edges: Buckets) -> DataFrame:
    """Send the rows between two boundaries to a task of their own, ``_place``.

    Hashing the bucket number instead would put several buckets into some tasks.
    """
    placed = bucketed.withColumn("_place", F.floor(F.col("_bucket") / 2).cast("int"))
    return placed.repartitionById(len(edges.boundaries) + 1, "_place")


def _order_copies(df: DataFrame, spread: int, bucket_starts: Column) -> DataFrame:
    """Number the rows of frequent keys.

    Such rows tie on the order key, so any repeatable order among them will do:
    by a content hash, which also splits them over tasks.  Equal rows are counted
    before the shuffle, numbered as one weighted row and laid out again in blocks.
    """
    columns = [name for name in df.columns if name != "_bucket"]
    grouped = (
        df.groupBy("_bucket", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumns(dict(zip(("_hash", "_second"), content_hashes(df, columns))))
        # Slots are ranges of the hash, so slot after slot is hash order.
        .withColumn("_slot", F.floor((F.shiftright("_hash", 32) + F.lit(1 << 31)) * F.lit(spread) / F.lit(1 << 32)))
    )
    slots = grouped.groupBy("_bucket", "_slot").agg(F.sum("_copies").alias("_rows"))
    slot_start = slots.select(
        "_bucket",
        "_slot",
        (
            F.sum("_rows").over(
                Window.partitionBy("_bucket").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
            )
            - F.col("_rows")
        ).alias("_before_slot"),
    )
    within = Window.partitionBy("_bucket", "_slot").orderBy("_hash", "_second")
    before = F.sum("_copies").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_copies")
    placed = (
        grouped.withColumn("_before", before)
        .join(slot_start, ["_bucket", "_slot"])
        .withColumn("_first", bucket_starts + F.col("_before_slot") + F.col("_before"))
    )
    zero, step = F.lit(0).cast("bigint"), F.lit(COPIES_PER_BLOCK).cast("bigint")
    blocks = placed.withColumn("_block", F.explode(F.sequence(zero, F.col("_copies") - 1, step)))
    # By number: blocks are few and small until they are laid out, so left to its sizes Spark would put all of them in one task.
    blocks = blocks.repartition(spread, F.col("_first") + F.col("_block"))
    last = F.least(F.col("_copies"), F.col("_block") + COPIES_PER_BLOCK) - 1
    return blocks.select(
        *columns, F.explode(F.sequence(F.col("_first") + F.col("_block"), F.col("_first") + last)).alias("_row_no")
    )


def number_rows(
    df: DataFrame,
    order_by,
    *,
    column: str = "row_no",
    buckets: int | None = None,
    total_rows: int | None = None,
    break_ties: bool = False,
) -> DataFrame:
    """Add the 0-based global row number of a total order.

    Reads the order key twice (a sample, then bucket counts) and the whole rows
    once.  Repeatable when the key is unique; otherwise ask for ``break_ties``,
    which orders tied rows by a content hash.
    """
    keys = order_keys(order_by)
    total = df.count() if total_rows is None else total_rows
    wanted = buckets or bucket_count(total, df.sparkSession.sparkContext.defaultParallelism)
    edges = sample_buckets(df, keys, wanted, total)
    bucketed, start = _bucketed(df, edges)
    sort = [key.sort() for key in keys]
    if break_ties:
        sort += content_hashes(df)
    even = bucketed if not any(edges.frequent) else bucketed.where(F.col("_bucket") % 2 == 0)
    window = Window.partitionBy("_place").orderBy(*sort)
    numbered = _one_task_each(even, edges).select(*df.columns, (start + F.row_number().over(window) - 1).alias(column))
    if any(edges.frequent):
        odd = bucketed.where(F.col("_bucket") % 2 != 0)
        numbered = numbered.unionByName(_order_copies(odd, wanted, start).withColumnRenamed("_row_no", column))
    return numbered


def chunk_boundaries(df: DataFrame, order_by, plan: ChunkPlan, groups: int) -> tuple[Buckets, int] | None:
    """Exact key of every ``m``-th chunk start, so that buckets hold whole chunks.

    Ranks the order key alone (``df`` may hold nothing else), so the wide rows need only one shuffle afterwards.
    Returns the buckets and the chunks per bucket, or None when the key is not
    unique (chunk starts would then fall inside a tie).
    """
    keys = order_keys(order_by)
    narrow = df.select(*[key.name for key in keys])
    buckets = bucket_count(plan.total_rows, df.sparkSession.sparkContext.defaultParallelism)
    edges = sample_buckets(narrow, keys, buckets, plan.total_rows)
    if any(edges.frequent):
        return None
    bucketed, start = _bucketed(narrow, edges)
    window = Window.partitionBy("_place").orderBy(*[key.sort() for key in keys])
    row_key = F.struct(*[F.expr(_encoded(df, key)).alias(f"k{i}") for i, key in enumerate(keys)])
    ranked = _one_task_each(bucketed, edges).select(
        (start + F.row_number().over(window) - 1 - F.lit(plan.start_offset)).alias("_rank"),
        row_key.alias("_key"),
        F.lag(row_key).over(window).alias("_before"),
    )
    chunks_per_group = max(1, math.ceil(plan.total_chunks / max(1, groups)))
    rows_per_group = chunks_per_group * plan.chunk_size
    rank, stop = F.col("_rank"), F.lit(plan.planned_rows)
    is_edge = ((rank >= 0) & (rank < stop) & (rank % rows_per_group == 0)) | (rank == stop)
    # Edges are as few as the groups; ties are only counted.
    found = ranked.agg(
        F.collect_list(F.when(is_edge, F.struct("_rank", "_key"))).alias("edges"),
        F.count_if(F.col("_key").eqNullSafe(F.col("_before")) & F.col("_before").isNotNull()).alias("ties"),
    ).first()
    if found["ties"]:
        return None
    exact = [tuple(edge["_key"]) for edge in sorted(found["edges"], key=lambda edge: edge["_rank"])]
    return Buckets(df, keys, exact, [False] * len(exact)), chunks_per_group


def first_duplicate(df: DataFrame, keys):
    """One key value that occurs more than once, or None."""
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    return rows[0] if rows else None


def require_unique_order(df: DataFrame, order_by) -> None:
    """Raise when the order key does not identify rows."""
    names = [key.name for key in order_keys(order_by)]
    row = first_duplicate(df, names)
    if row is not None:
        raise DuplicateKeyError(f"The order key is not unique: {row.asDict()}")


class ChunkLayout:
    """Where the rows of a chunk plan belong; worked out once, used for any of its chunks.

    Unique key: exact chunk-aligned boundaries, so wide rows are shuffled once.
    Otherwise the rows are numbered first and then moved to their chunk.  ``key_rows``, if given,
    holds the order key of all rows, which saves evaluations of ``df``; for the same reason rows that have to be
    numbered are first put ``aside``, a folder.
    """

    def __init__(self, df: DataFrame, order_by, plan: ChunkPlan, key_rows: DataFrame | None = None, aside: str | None = None):
        self.df, self.plan = df, plan
        self.keys = order_keys(order_by)
        self.parallelism = df.sparkSession.sparkContext.defaultParallelism
        self.groups = bucket_count(plan.planned_rows, self.parallelism)
        self.exact = self.numbered = None
        if plan.total_chunks:
            self.exact = chunk_boundaries(df if key_rows is None else key_rows, self.keys, plan, self.groups)
        if plan.total_chunks and self.exact is None:
            if aside is not None:
                df.write.mode("overwrite").parquet(aside)
                df = df.sparkSession.read.schema(df.schema).parquet(aside)
            numbered = number_rows(df, self.keys, column="_row_no", total_rows=plan.total_rows, break_ties=True)
            self.numbered = with_chunks(numbered, plan, "_row_no")

    def rows(self, only: set[int] | None = None) -> DataFrame:
        """Planned rows with ``chunk_id`` and ``_row_no``, chunks whole and sorted.

        ``only`` restricts the result to some chunks before the shuffle.
        """
        chunk, row_no = F.col("chunk_id"), F.col("_row_no")
        if not self.plan.total_chunks or (only is not None and not only):
            none = F.lit(0).cast("bigint")
            return self.df.limit(0).withColumn("chunk_id", none).withColumn("_row_no", none)
        if self.exact is None:
            chunked = self.numbered if only is None else self.numbered.where(among("chunk_id", only))
            parts = min(self.plan.total_chunks, max(self.groups, self.parallelism))
            return chunked.repartition(parts, "chunk_id").sortWithinPartitions("chunk_id", "_row_no")
        edges, per_group = self.exact
        # Boundary p (from 1) opens group p - 1; rows before the first boundary or
        # after the last planned row fall outside.
        group = F.col("_group")
        grouped = self.df.withColumn("_bucket", edges.column())
        grouped = grouped.withColumn("_group", (F.floor(F.col("_bucket") / 2) - 1).cast("int"))
        groups = math.ceil(self.plan.total_chunks / per_group)
        if only is None:
            grouped = grouped.where((group >= 0) & (group < groups))
        else:
            grouped = grouped.where(group.isin(sorted({c // per_group for c in only})))
        grouped = grouped.repartitionById(groups, "_group")
        window = Window.partitionBy("_group").orderBy(*[key.sort() for key in self.keys])
        position = group.cast("bigint") * (per_group * self.plan.chunk_size) + F.row_number().over(window) - 1
        placed = grouped.withColumn("_row_no", position).withColumn(
            "chunk_id", F.floor(row_no / self.plan.chunk_size).cast("bigint")
        )
        if only is not None:
            placed = placed.where(among("chunk_id", only))
        placed = placed.withColumn("_row_no", row_no + F.lit(self.plan.start_offset).cast("bigint"))
        return placed.drop("_bucket", "_group").sortWithinPartitions("chunk_id", "_row_no")


def into_chunks(df: DataFrame, order_by, plan: ChunkPlan) -> DataFrame:
    """All planned rows of :class:`ChunkLayout`."""
    return ChunkLayout(df, order_by, plan).rows()
