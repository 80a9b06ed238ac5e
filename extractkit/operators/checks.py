"""Checks of an extract: counts, keys, order, schemas, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import RowCountError, SchemaMismatchError
from ..session import stored
from .filters import require_columns


def reconcile(planned: DataFrame, actual: DataFrame, id_column: str = "chunk_id") -> DataFrame:
    """Planned against written rows per chunk.

    ``planned`` holds ``chunk_id`` and ``row_limit``; ``actual`` holds one row per
    written row.  A chunk nobody planned shows up as ``over``.
    """
    written = actual.groupBy(id_column).agg(F.count(F.lit(1)).alias("written_rows"))
    both = planned.select(id_column, F.col("row_limit").alias("planned_rows")).join(written, id_column, "full")
    planned_rows = F.coalesce("planned_rows", F.lit(0)).cast("bigint")
    written_rows = F.coalesce("written_rows", F.lit(0)).cast("bigint")
    status = (
        F.when(written_rows < planned_rows, F.lit("short"))
        .when(written_rows > planned_rows, F.lit("over"))
        .otherwise(F.lit("ok"))
    )
    return both.select(
        id_column, planned_rows.alias("planned_rows"), written_rows.alias("written_rows"), status.alias("status")
    )


def require_reconciled(report: DataFrame) -> None:
    """Raise when any chunk of a :func:`reconcile` report is not ``ok``."""
    row = report.where("status <> 'ok'").limit(1).collect()
    if row:
        raise RowCountError(f"Rows written differ from rows planned: {row[0].asDict()}")


def remaining(planned: DataFrame, done: DataFrame, id_column: str = "chunk_id") -> DataFrame:
    """Planned chunks that are not yet complete."""
    return planned.join(done.select(id_column), id_column, "left_anti")


def _empty_key(df: DataFrame, keys: list[str]) -> Column:
    empty = F.lit(False)
    for key in keys:
        column = F.col(key)
        empty = empty | column.isNull()
        if df.schema[key].dataType.simpleString() == "string":
            empty = empty | (column == "")
    return empty


_SUMS = ("rows", "empty_keys", "malformed_rows", "adjacent_duplicates", "order_violations", "chunks")
#: Neighbouring segments that one task puts together.
SEGMENTS_AT_ONCE = 1_024


def _merged(segments: DataFrame) -> DataFrame:
    """Neighbouring segments put together: sums, and what their seams add, with the outer first and last key.

    Associative, so it can be done in any number of steps as long as the order is kept.
    """
    place = F.expr(f"_segment DIV {SEGMENTS_AT_ONCE}")
    runs = segments.groupBy(place.alias("_segment")).agg(
        *[F.sum(name).alias(name) for name in _SUMS],
        F.array_sort(F.collect_list(F.struct("_segment", "first_key", "last_key"))).alias("_run"),
    )
    pairs = F.zip_with(F.slice("_run", F.lit(1), F.size("_run") - 1), F.slice("_run", F.lit(2), F.size("_run")), lambda a, b: F.struct(a["last_key"].alias("a"), b["first_key"].alias("b")))
    count = lambda test: F.size(F.filter("_pairs", test))
    return runs.withColumn("_pairs", pairs).select(
        "_segment",
        *[F.col(name) for name in _SUMS if name not in ("adjacent_duplicates", "order_violations")],
        (F.col("adjacent_duplicates") + count(lambda p: p["a"] == p["b"])).alias("adjacent_duplicates"),
        (F.col("order_violations") + count(lambda p: p["a"] > p["b"])).alias("order_violations"),
        F.get("_run", F.lit(0))["first_key"].alias("first_key"),
        F.element_at("_run", -1)["last_key"].alias("last_key"),
    )


def validate_extract(
    df: DataFrame,
    keys,
    *,
    chunk_column: str = "chunk_id",
    row_column: str = "row_no",
    malformed: Column | None = None,
) -> DataFrame:
    """One row of counts about a chunked extract.

    ``df`` is evaluated once: its keys and places are put aside.  A chunk is summed up in one task
    by comparing each row with the one before, and sums of neighbouring chunks are put together by their
    first and last keys, some at a time, so no task sees more than one chunk or a run of chunk sums.
    """
    names = require_columns(df, keys)
    bad = malformed if malformed is not None else F.lit(False)
    rows = stored(df.select(*dict.fromkeys([*names, chunk_column, row_column]), bad.alias("_bad")), "validate")
    key = F.struct(*[F.struct(F.col(n).isNull().alias("n"), F.col(n).alias("v")).alias(n) for n in names])
    marked = rows.withColumn("_key", key).withColumn("_empty", _empty_key(rows, names))
    window = Window.partitionBy(chunk_column).orderBy(row_column)
    marked = marked.withColumn("_previous", F.lag("_key").over(window))
    segments = marked.groupBy(F.col(chunk_column).alias("_segment")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("_empty").alias("empty_keys"),
        F.count_if("_bad").alias("malformed_rows"),
        F.count_if(F.col("_previous") == F.col("_key")).alias("adjacent_duplicates"),
        F.count_if(F.col("_previous") > F.col("_key")).alias("order_violations"),
        F.min_by("_key", row_column).alias("first_key"),
        F.max_by("_key", row_column).alias("last_key"),
        F.lit(1).cast("bigint").alias("chunks"),
    )
    whole = _merged(_merged(_merged(segments)))  # one row for up to 2 ** 30 chunks
    repeated = (
        rows.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .agg(
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("surplus_rows"),
        )
    )
    total = whole.select("rows", "chunks", "empty_keys", "malformed_rows", "adjacent_duplicates", "order_violations")
    # Two aggregate rows become one.
    both = total.unionByName(repeated, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


def dataset_diff(left: DataFrame, right: DataFrame, *, left_only="only_left", right_only="only_right") -> DataFrame:
    """Rows of one side the other lacks, copies counted, tagged by ``side``.

    Both sides are counted per distinct row before the shuffle, so many copies of
    a row cost no more than one.
    """
    if set(left.columns) != set(right.columns):
        raise SchemaMismatchError(f"Columns differ: {left.columns} and {right.columns}")
    columns = left.columns
    tagged = left.withColumn("_l", F.lit(1)).unionByName(right.withColumn("_l", F.lit(-1)))
    counts = tagged.groupBy(*columns).agg(F.sum("_l").alias("_surplus")).where("_surplus <> 0")
    return counts.select(
        *columns,
        F.when(F.col("_surplus") > 0, F.lit(left_only)).otherwise(F.lit(right_only)).alias("side"),
        F.abs("_surplus").alias("copies"),
    )


def key_diff(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Keys present on one side only: ``side`` is ``only_left`` or ``only_right``."""
    names = require_columns(left, keys)
    require_columns(right, keys)
    a, b = left.select(*names).distinct(), right.select(*names).distinct()
    same = [a[n].eqNullSafe(b[n]) for n in names]
    back = [b[n].eqNullSafe(a[n]) for n in names]
    only_a = a.join(b, same, "left_anti").withColumn("side", F.lit("only_left"))
    only_b = b.join(a, back, "left_anti").withColumn("side", F.lit("only_right"))
    return only_a.unionByName(only_b)


def compare_part_schemas(columns: DataFrame, part_column: str = "part") -> DataFrame:
    """Every part against the first: names and their order must be equal.

    ``columns`` holds one row per part with ``columns array<string>``.
    """
    columns = stored(columns, "part-columns")  # the files are looked at once
    expected = columns.agg(F.min_by("columns", part_column)).scalar()
    return columns.withColumn("_expected", expected).select(
        part_column,
        F.array_join("_expected", ",").alias("expected"),
        F.array_join("columns", ",").alias("actual"),
        (F.col("columns") == F.col("_expected")).alias("matches"),
    )


def require_same_columns(left: DataFrame, right: DataFrame, what: str = "Source and target") -> None:
    """Column sets must be equal, order free; the error lists both differences."""
    missing_right = sorted(set(left.columns) - set(right.columns))
    missing_left = sorted(set(right.columns) - set(left.columns))
    if missing_right or missing_left:
        raise SchemaMismatchError(
            f"{what} schemas differ. Missing in target: {missing_right}; missing in source: {missing_left}."
        )
