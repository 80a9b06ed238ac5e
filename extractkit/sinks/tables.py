"""Managed tables: immutable Parquet files and one small JSON per version.

A change writes new files and then publishes the next version, so readers see the
old table or the new one.  Updates, deletes and upserts rewrite only the files
that hold affected rows; all other files are carried over by name.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConcurrentCommitError, ToolkitError
from ..functions.naming import check_identifier
from ..operators.checks import require_same_columns
from ..operators.filters import require_columns
from ..operators.merge import MergeSpec, matched_rows, new_rows, require_single_match, touched_rows
from ..operators.upsert import (
    delete_where,
    has_null_key,
    inserted_rows,
    latest_per_key,
    require_unambiguous,
    source_matches,
    update_where,
    updated_rows,
)
from ..session import scratch_path
from .filesystem import Files


@dataclass(frozen=True)
class Version:
    """One published state of a table."""

    number: int
    operation: str
    columns: T.StructType
    files: tuple[str, ...]
    batches: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> dict:
        return {
            "version": self.number,
            "operation": self.operation,
            "schema": json.loads(self.columns.json()),
            "files": list(self.files),
            "batches": self.batches,
        }

    @staticmethod
    def from_json(value: dict) -> "Version":
        return Version(
            value["version"],
            value["operation"],
            T.StructType.fromJson(value["schema"]),
            tuple(value["files"]),
            dict(value.get("batches") or {}),
        )


class ManagedTables:
    """Tables below one folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.files = Files(spark)
        self.root = self.files.qualified(root).rstrip("/")

    # --- versions ---------------------------------------------------------------

    def _folder(self, name: str) -> str:
        return f"{self.root}/{check_identifier(name, 'table name').lower()}"

    def _version_path(self, name: str, number: int) -> str:
        return f"{self._folder(name)}/_versions/{number:010d}.json"

    def names(self) -> list[str]:
        return [n for n, _, folder in self.files.list(self.root) if folder and self.exists(n)]

    def version(self, name: str) -> Version | None:
        """The newest version; None for a table that does not exist."""
        found = [n for n, _, _ in self.files.list(f"{self._folder(name)}/_versions") if n.endswith(".json")]
        if not found:
            return None
        current = Version.from_json(self.files.read_json(f"{self._folder(name)}/_versions/{found[-1]}"))
        return None if current.operation == "drop" else current

    def _last_number(self, name: str) -> int:
        found = [n for n, _, _ in self.files.list(f"{self._folder(name)}/_versions") if n.endswith(".json")]
        return int(found[-1].split(".")[0]) if found else 0

    def exists(self, name: str) -> bool:
        return self.version(name) is not None

    def _current(self, name: str) -> Version:
        current = self.version(name)
        if current is None:
            raise ToolkitError(f"No such table: {name}")
        return current

    def _publish(self, name: str, base: int, operation: str, schema, files, batches=None) -> Version:
        new = Version(base + 1, operation, schema, tuple(files), dict(batches or {}))
        self.files.make_folder(f"{self._folder(name)}/_versions")
        path = self._version_path(name, new.number)
        try:
            published = self.files.write_json(path, new.to_json(), overwrite=False)
        except OSError as error:
            raise ConcurrentCommitError(f"{name} changed during the write.") from error
        if not published:
            raise ConcurrentCommitError(f"{name} changed during the write.")
        return new

    def _write(self, name: str, df: DataFrame) -> list[str]:
        """Write rows as new files; their names relative to the table folder."""
        part = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self._folder(name)}/{part}", compression="zstd")
        return [f"{part}/{file}" for file, _ in self.files.walk(f"{self._folder(name)}/{part}")]

    def _open(self, name: str, schema: T.StructType, files) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        folder = self._folder(name)
        return self.spark.read.schema(schema).parquet(*[f"{folder}/{file}" for file in files])

    # --- reading ----------------------------------------------------------------

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """The table as of its newest version, or of an earlier one."""
        if number is None:
            current = self._current(name)
        else:
            current = Version.from_json(self.files.read_json(self._version_path(name, number)))
        return self._open(name, current.columns, current.files)

    # --- whole-table changes ------------------------------------------------------

    def create(self, name: str, df: DataFrame, *, replace: bool = False) -> Version:
        if not replace and self.exists(name):
            raise ToolkitError(f"Table already exists: {name}")
        base = self._last_number(name)
        return self._publish(name, base, "create", _nullable(df.schema), self._write(name, df))

    def append(self, name: str, df: DataFrame, *, batch: tuple[str, int] | None = None) -> Version:
        """Add rows; nothing that is already stored is read or rewritten."""
        current = self._current(name)
        if self._seen(current, batch):
            return current
        aligned = self._aligned(df, current)
        files = self._write(name, aligned)
        return self._publish(
            name, current.number, "append", current.columns, (*current.files, *files), self._batches(current, batch)
        )

    def truncate(self, name: str) -> Version:
        current = self._current(name)
        return self._publish(name, current.number, "truncate", current.columns, (), current.batches)

    def drop(self, name: str) -> None:
        current = self._current(name)
        self._publish(name, current.number, "drop", current.columns, ())

    def add_columns(self, name: str, fields: T.StructType) -> Version:
        """New columns read as NULL from the stored files; no data is rewritten."""
        current = self._current(name)
        taken = {f.name.lower() for f in current.columns.fields}
        clash = [f.name for f in fields.fields if f.name.lower() in taken]
        if clash:
            raise ToolkitError(f"Columns already exist: {clash}")
        schema = T.StructType([*current.columns.fields, *_nullable(fields).fields])
        return self._publish(name, current.number, "add columns", schema, current.files, current.batches)

    def reshape(self, name: str, df: DataFrame, operation: str) -> Version:
        """Replace content and schema together (rename or drop of a column)."""
        current = self._current(name)
        return self._publish(
            name, current.number, operation, _nullable(df.schema), self._write(name, df), current.batches
        )

    # --- row changes --------------------------------------------------------------

    def update(self, name: str, assignments: dict, condition: Column | str | None = None) -> Version:
        return self._rewrite(name, condition, "update", lambda df: update_where(df, assignments, condition))

    def delete(self, name: str, condition: Column | str | None = None) -> Version:
        if condition is None:
            return self.truncate(name)
        return self._rewrite(name, condition, "delete", lambda df: delete_where(df, condition))

    def _rewrite(self, name: str, condition, operation: str, change) -> Version:
        current = self._current(name)
        table = self._open(name, current.columns, current.files)
        hit = F.lit(True) if condition is None else F.expr(condition) if isinstance(condition, str) else condition
        touched = self._touched(table.where(hit)) if current.files else set()
        stay = [f for f in current.files if f.rsplit("/", 1)[-1] not in touched]
        redo = [f for f in current.files if f.rsplit("/", 1)[-1] in touched]
        files = self._write(name, change(self._open(name, current.columns, redo))) if redo else []
        return self._publish(name, current.number, operation, current.columns, (*stay, *files), current.batches)

    def _touched(self, rows: DataFrame) -> set[str]:
        """Base names of the files these rows come from (unique per write)."""
        found = rows.select(F.col("_metadata.file_name").alias("file")).distinct().collect()
        return {row["file"] for row in found}

    def upsert(
        self,
        name: str,
        source: DataFrame,
        keys,
        *,
        on_duplicate: str = "error",
        order_col: str | None = None,
        newer_than: str | None = None,
        batch: tuple[str, int] | None = None,
    ) -> Version:
        """Keyed upsert of ``source``; creates the table when it is absent.

        ``batch`` names a stream and its batch number: a batch that is already in
        the table is skipped, so a replay changes nothing.
        """
        names = require_columns(source, keys)
        if on_duplicate not in {"error", "latest"}:
            raise ValueError("on_duplicate must be 'error' or 'latest'.")
        if on_duplicate == "latest" and order_col is None:
            raise ValueError("on_duplicate='latest' needs order_col.")
        current = self.version(name)
        if current is not None and self._seen(current, batch):
            return current
        if on_duplicate == "latest":
            source = latest_per_key(source, names, order_col)
        if current is None:
            if source.isEmpty():
                raise ToolkitError(f"No rows to create {name} from.")
            base = self._last_number(name)
            return self._publish(
                name, base, "create", _nullable(source.schema), self._write(name, source), self._batches(None, batch)
            )
        # The source is read several times below; write it once, where every
        # executor can reach it.
        base = scratch_path(self.spark, f"staged-{name}")
        self._aligned(source, current).write.parquet(f"{base}/source")
        try:
            staged = self.spark.read.schema(current.columns).parquet(f"{base}/source")
            if staged.isEmpty():
                return current
            return self._upsert_staged(name, current, staged, f"{base}/matches", names, on_duplicate, newer_than, batch)
        finally:
            self.files.delete(base)

    def _upsert_staged(self, name, current, staged, matches_path, names, on_duplicate, newer_than, batch) -> Version:
        table = self._open(name, current.columns, current.files)
        keyed = table.select(*names, F.col("_metadata.file_name").alias("_file") if current.files else F.lit("").alias("_file"))
        matches = source_matches(keyed, staged, names, within="_file")
        matches.write.parquet(matches_path)
        matches = self.spark.read.schema(matches.schema).parquet(matches_path)
        if on_duplicate == "error":
            require_unambiguous(matches, names)
        others = [c for c in current.columns.names if c not in names]
        touched = {row["_file"] for row in matches.select("_file").distinct().collect()} if others else set()
        stay = [f for f in current.files if f.rsplit("/", 1)[-1] not in touched]
        redo = [f for f in current.files if f.rsplit("/", 1)[-1] in touched]
        added = inserted_rows(matches, staged, names)
        if redo:
            added = updated_rows(self._open(name, current.columns, redo), staged, names, newer_than).unionByName(added)
        files = self._write(name, added)
        return self._publish(
            name, current.number, "upsert", current.columns, (*stay, *files), self._batches(current, batch)
        )

    def merge(self, name: str, source: DataFrame, spec: MergeSpec) -> Version:
        """General merge; only files that hold a matched row are rewritten."""
        current = self._current(name)
        table = self._open(name, current.columns, current.files)
        staged_path = scratch_path(self.spark, f"staged-{name}")
        source.write.parquet(staged_path)
        try:
            staged = self.spark.read.schema(source.schema).parquet(staged_path)
            touched: set[str] = set()
            if current.files and spec.matched:
                position = F.struct(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
                require_single_match(table, staged, spec, position)
                named = table.select("*", F.col("_metadata.file_name").alias("_file"))
                found = touched_rows(named, staged, spec).select("_file").distinct().collect()
                touched = {row["_file"] for row in found}
            stay = [f for f in current.files if f.rsplit("/", 1)[-1] not in touched]
            redo = [f for f in current.files if f.rsplit("/", 1)[-1] in touched]
            parts = [matched_rows(self._open(name, current.columns, redo), staged, spec)] if redo else []
            added = new_rows(table, staged, spec)
            if added is not None:
                parts.append(added)
            files = self._write(name, reduce(DataFrame.unionByName, parts)) if parts else []
            return self._publish(name, current.number, "merge", current.columns, (*stay, *files), current.batches)
        finally:
            self.files.delete(staged_path)

    # --- helpers --------------------------------------------------------------------

    @staticmethod
    def _seen(current: Version, batch) -> bool:
        return batch is not None and current.batches.get(batch[0], -1) >= batch[1]

    @staticmethod
    def _batches(current: Version | None, batch) -> dict[str, int]:
        known = dict(current.batches) if current else {}
        if batch is not None:
            known[batch[0]] = batch[1]
        return known

    def _aligned(self, df: DataFrame, current: Version) -> DataFrame:
        """Rows in the table's column order and types."""
        require_same_columns(df, self.spark.createDataFrame([], current.columns))
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in current.columns.fields])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
