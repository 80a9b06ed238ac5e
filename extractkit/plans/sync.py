"""Keep a managed table in step with a query or a source table."""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame

from ..functions.naming import key_list
from ..operators.filters import (
    DEFAULT_CHANGE_COLUMN,
    DEFAULT_ROW_KEY,
    all_string,
    incremental,
    with_row_key,
)
from ..sinks.tables import ManagedTables


@dataclass(frozen=True)
class SyncResult:
    """What a sync did; ``row_count_matches`` is a warning, not an error."""

    target_table: str
    source_rows: int
    target_rows: int
    version: int
    primary_key: tuple[str, ...]
    elapsed_seconds: float
    rows_per_second: float

    @property
    def row_count_matches(self) -> bool:
        return self.source_rows == self.target_rows

    def to_dict(self) -> dict:
        return {**asdict(self), "row_count_matches": self.row_count_matches}


def sync_query(
    tables: ManagedTables,
    query: DataFrame,
    target_table: str,
    *,
    primary_key=None,
    replace_target: bool = False,
    all_varchar: bool = True,
    on_duplicate: str = "error",
    order_col: str | None = None,
    newer_than: str | None = None,
) -> SyncResult:
    """Upsert a query into a table, or replace the table by it.

    Without a key only a replace is possible.  The whole source goes through one
    join; there is no page loop.
    """
    started = time.perf_counter()
    keys = key_list(primary_key) if primary_key is not None else []
    if not keys and not replace_target:
        raise ValueError("primary_key is required unless replace_target is True.")
    rows = all_string(query) if all_varchar else query
    if replace_target or not tables.exists(target_table):
        before = None
        version = tables.create(target_table, rows, replace=True)
    else:
        before = tables.version(target_table)
        version = tables.upsert(
            target_table, rows, keys, on_duplicate=on_duplicate, order_col=order_col, newer_than=newer_than
        )
    target_rows = tables.read(target_table).count()
    source_rows = target_rows if before is None else query.count()
    elapsed = max(time.perf_counter() - started, 0.001)
    return SyncResult(
        target_table, source_rows, target_rows, version.number, tuple(keys), elapsed, source_rows / elapsed
    )


def table_extract(
    source: DataFrame,
    *,
    primary_key=None,
    row_key: str = DEFAULT_ROW_KEY,
    since=None,
    change_column: str = DEFAULT_CHANGE_COLUMN,
    extra: str | None = None,
) -> DataFrame:
    """The filtered rows of a source table, with a row key when it has no key."""
    if primary_key is None:
        source = with_row_key(source, row_key)
    return incremental(source, since, change_column, extra)


def copy_table(
    tables: ManagedTables,
    source: DataFrame,
    target_table: str,
    *,
    primary_key=None,
    row_key: str = DEFAULT_ROW_KEY,
    since=None,
    change_column: str = DEFAULT_CHANGE_COLUMN,
    extra: str | None = None,
    replace_target: bool = True,
    all_varchar: bool = True,
    **options,
) -> SyncResult:
    """Copy a source table into a managed table of any name."""
    rows = table_extract(
        source, primary_key=primary_key, row_key=row_key, since=since, change_column=change_column, extra=extra
    )
    return sync_query(
        tables,
        rows,
        target_table,
        primary_key=primary_key if primary_key is not None else row_key,
        replace_target=replace_target,
        all_varchar=all_varchar,
        **options,
    )


def jdbc_table(spark, url: str, table: str, *, partition_column: str, lower, upper, partitions: int, **options) -> DataFrame:
    """A database table read in parallel ranges; filters put on it reach the database."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    return reader.options(
        partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
    ).load()


