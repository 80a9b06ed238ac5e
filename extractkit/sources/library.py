"""A folder of CSV, TSV and Parquet files as a SQL library.

Files become temporary views of a session of their own and are read-only.
Managed tables live next to them (:mod:`extractkit.sinks.tables`) and take DML.
Statements are told apart by Spark's own parser, never by their first word.
"""

from __future__ import annotations

import re
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import FileFormatError, NameConflictError, ReadOnlyError, StatementError, ToolkitError
from ..functions.naming import safe_alias
from ..session import configure
from ..sinks.delimited import csv_options
from ..sinks.filesystem import Files
from ..sinks.tables import ManagedTables
from .delimited import read_delimited
from .statements import Statement, parse_statement

FORMATS = ("csv", "tsv", "parquet")
LISTING = "library_files"
_SUFFIX = r"(?i)\.(csv|tsv|parquet)$"
LISTING_SCHEMA = (
    "table_name string, exact_name string, relative_path string, absolute_path string, "
    "file_type string, size_bytes bigint, readable boolean, error string"
)


@dataclass(frozen=True)
class LibraryFile:
    table_name: str
    exact_name: str
    relative_path: str
    absolute_path: str
    file_type: str
    size_bytes: int
    readable: bool = True
    error: str | None = None


@dataclass(frozen=True)
class StatementResult:
    statement_type: str
    dataframe: DataFrame | None
    duration_ms: float
    committed: bool

    def to_dict(self) -> dict:
        return {
            "statement_type": self.statement_type,
            "duration_ms": self.duration_ms,
            "transaction_committed": self.committed,
        }


def discover_files(spark: SparkSession, folder: str, recursive: bool = True, without: str | None = None) -> DataFrame:
    """``relative_path, absolute_path, file_type, size_bytes`` of the data files.

    A folder named like a file (``orders.parquet/part-…``) counts as one dataset.
    Only names and sizes are listed; no content is read.  What lies below ``without``,
    the library's own tables, is left out.
    """
    root = Files(spark).qualified(folder).rstrip("/")
    listing = spark.read.format("binaryFile")
    if recursive:
        listing = listing.option("recursiveFileLookup", "true")
    # The listing prints local paths as file:/x or file:///x.
    plain = F.regexp_replace(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), r"^file:/+", "/")
    base = root.removeprefix("file:")
    base = "/" + base.lstrip("/") if root.startswith("file:") else base
    relative = F.expr(f"substring(_plain, {len(base) + 2})")
    found = listing.load(folder).select(plain.alias("_plain"), "length").withColumn("_relative", relative)
    if without:
        own = re.sub(r"^file:/+", "/", Files(spark).qualified(without)).rstrip("/") + "/"
        found = found.where(~F.col("_plain").startswith(own))
    entry = F.regexp_extract("_relative", r"(?i)^(.*?\.(?:csv|tsv|parquet))(?:/.*)?$", 1)
    return (
        found.withColumn("relative_path", entry)
        .where("relative_path <> ''")
        .groupBy("relative_path")
        .agg(F.sum("length").alias("size_bytes"))
        .select(
            "relative_path",
            F.concat(F.lit(base + "/"), "relative_path").alias("absolute_path"),
            F.lower(F.regexp_extract("relative_path", _SUFFIX, 1)).alias("file_type"),
            "size_bytes",
        )
    )


def assign_aliases(paths: list[str]) -> dict[str, tuple[str, str]]:
    """``path -> (safe alias, exact alias)`` by the library's naming rules.

    All safe aliases are settled before any exact one, so an exact alias can
    never take the name of another file.
    """
    ordered = sorted(paths, key=str.casefold)
    stems: dict[str, int] = {}
    for path in ordered:
        stem = _stem(path).casefold()
        stems[stem] = stems.get(stem, 0) + 1
    used: set[str] = set()
    aliases = {}
    for path in ordered:
        unique = stems[_stem(path).casefold()] == 1
        exact = _stem(path) if unique else path.rsplit(".", 1)[0]
        base = safe = safe_alias(exact)
        number = 2
        while safe in used:
            safe = f"{base}_{number}"
            number += 1
        used.add(safe)
        aliases[path] = (safe, exact)
    return aliases


def _stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


class DataLibrary:
    """SQL over a folder of files, plus managed tables for changes."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        database: str | None = None,
        *,
        recursive: bool = True,
        read_only: bool = False,
        schemas: dict | None = None,
    ):
        self.spark = configure(spark.newSession())
        self._files = Files(self.spark)
        if not self._files.is_folder(folder):
            raise FileFormatError(f"Data folder does not exist: {folder}")
        self.folder = folder.rstrip("/")
        self.recursive = bool(recursive)
        self.read_only = bool(read_only)
        self.schemas = schemas or {}
        self.tables = ManagedTables(self.spark, database or f"{self.folder}/_managed")
        self._listing: list[LibraryFile] = []
        self._views: set[str] = set()
        self._managed: set[str] = set()
        self.clashes: list[str] = []
        self.refresh()

    # --- registration -------------------------------------------------------------

    def refresh(self) -> DataFrame:
        """List the folder again and re-create all views; vanished files lose theirs."""
        for name in self._views | self._managed:
            self.spark.sql(f"DROP VIEW IF EXISTS {_quoted(name)}")
        self._views, self._managed, self.clashes = set(), set(), []
        found = {r["relative_path"]: r for r in discover_files(self.spark, self.folder, self.recursive, self.tables.root).collect()}
        aliases = assign_aliases(list(found))
        reserved = {safe for safe, _ in aliases.values()}
        records = []
        for path in sorted(found, key=str.casefold):
            safe, exact = aliases[path]
            row, error = found[path], None
            try:
                df = self._scan(safe, row["absolute_path"], row["file_type"])
                self._register(safe, df)
                if exact.lower() != safe:
                    if exact.lower() in reserved:
                        self.clashes.append(exact)
                    else:
                        self._register(exact, df)
            except Exception as failure:
                error = _first_line(failure)
            records.append(
                LibraryFile(safe, exact, path, row["absolute_path"], row["file_type"], row["size_bytes"], error is None, error)
            )
        self._listing = records
        for name in self.tables.names():
            self._show_managed(name)
        self.list_files().createOrReplaceTempView(LISTING)
        return self.list_files()

    def _scan(self, alias: str, path: str, kind: str) -> DataFrame:
        if kind == "parquet":
            return self.spark.read.parquet(path)
        delimiter = "\t" if kind == "tsv" else ","
        return read_delimited(self.spark, path, delimiter, self.schemas.get(alias))

    def _register(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(_quoted(name))
        self._views.add(name.lower())

    def _show_managed(self, name: str) -> None:
        if name.lower() in self._views:
            return
        self.tables.read(name).createOrReplaceTempView(name)
        self._managed.add(name.lower())

    # --- metadata -------------------------------------------------------------------

    def list_files(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(asdict(f).values()) for f in self._listing], LISTING_SCHEMA)

    files = list_files

    def list_tables(self) -> DataFrame:
        """Every name a query can use, with its kind."""
        rows = [(n, "file") for n in sorted(self._views)] + [(n, "managed") for n in sorted(self._managed)]
        return self.spark.createDataFrame([*rows, (LISTING, "listing")], "name string, kind string")

    def describe_table(self, name: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE {_quoted(name)}")

    def table(self, name: str) -> DataFrame:
        return self.spark.sql(f"SELECT * FROM {_quoted(name)}")

    def preview(self, name: str, limit: int = 100) -> DataFrame:
        if isinstance(limit, bool) or not isinstance(limit, int) or limit < 1:
            raise ValueError("limit must be a positive integer")
        return self.table(name).limit(limit)

    def count(self, name: str) -> int:
        return self.table(name).count()

    # --- SQL --------------------------------------------------------------------------

    def query(self, sql: str, parameters=None) -> DataFrame:
        """Run one read-only statement; the result stays lazy."""
        statement = parse_statement(self.spark, sql)
        if statement.kind == "SUMMARIZE":
            from ..operators.profile import summarize

            return summarize(self.table(statement.target))
        if not statement.is_query:
            raise StatementError("query() takes read-only SQL; use execute() for changes.")
        return self._run(sql, parameters)

    def execute(self, sql: str, parameters=None) -> StatementResult:
        """Run one statement.  A failed change leaves the old table version."""
        started = time.perf_counter()
        statement = parse_statement(self.spark, sql, parameters)
        self._guard(statement)
        if statement.is_query or statement.kind == "SUMMARIZE":
            frame = self.query(sql, parameters)
            return StatementResult(statement.kind, frame, (time.perf_counter() - started) * 1000, True)
        try:
            self._change(statement)
        except ToolkitError:
            raise
        except Exception as error:
            raise StatementError(str(error)) from error
        return StatementResult(statement.kind, None, (time.perf_counter() - started) * 1000, True)

    def _run(self, sql: str, parameters=None) -> DataFrame:
        try:
            return self.spark.sql(sql, args=parameters) if parameters else self.spark.sql(sql)
        except Exception as error:
            raise StatementError(str(error)) from error

    def _guard(self, statement: Statement) -> None:
        if statement.kind == "BLOCKED":
            raise StatementError(f"Statement is not allowed: {statement.text[:80]}")
        if statement.is_query or statement.kind == "SUMMARIZE":
            return
        if self.read_only:
            raise ReadOnlyError("The library is open in read-only mode.")
        name = statement.target.lower()
        if name in self._views or name == LISTING:
            raise ReadOnlyError(f"'{statement.target}' is file-backed. Materialize it before changing it.")

    def _change(self, statement: Statement) -> None:
        kind, name = statement.kind, statement.target
        if kind == "CREATE":
            if statement.if_not_exists and self.tables.exists(name):
                return
            rows = self._rows(statement) if statement.query else self.spark.createDataFrame([], statement.columns)
            self.tables.create(name, rows, replace=statement.replace)
        elif kind == "INSERT":
            self._insert(statement)
        elif kind == "UPDATE":
            self.tables.update(name, statement.assignments, statement.condition)
        elif kind == "DELETE":
            self.tables.delete(name, statement.condition)
        elif kind == "MERGE":
            self.tables.merge(name, self._rows(statement), statement.merge)
        elif kind == "TRUNCATE":
            self.tables.truncate(name)
        elif kind == "DROP":
            if not (statement.if_exists and not self.tables.exists(name)):
                self.tables.drop(name)
            self.spark.catalog.dropTempView(name)
            self._managed.discard(name.lower())
            return
        elif kind == "ALTER":
            self._alter(statement)
        self._show_managed(name)

    def _insert(self, statement: Statement) -> None:
        current = self.tables.read(statement.target)
        rows = self._rows(statement)
        names = statement.insert_columns or current.columns
        if len(names) != len(rows.columns):
            raise StatementError(f"INSERT gives {len(rows.columns)} values for {len(names)} columns.")
        given = dict(zip((n.lower() for n in names), rows.columns))
        unknown = set(given) - {c.lower() for c in current.columns}
        if unknown:
            raise StatementError(f"No such columns: {sorted(unknown)}")
        rows = rows.toDF(*[n.lower() for n in names])
        filled = rows.select(
            *[
                (F.col(f"`{f.name.lower()}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in current.schema.fields
            ]
        )
        if statement.replace:
            self.tables.create(statement.target, filled, replace=True)
        else:
            self.tables.append(statement.target, filled)

    def _rows(self, statement: Statement) -> DataFrame:
        try:
            return statement.query.frame()
        except Exception as error:
            raise StatementError(str(error)) from error

    def _alter(self, statement: Statement) -> None:
        name = statement.target
        current = self.tables.read(name)
        if statement.alter == "add":
            self.tables.add_columns(name, statement.columns)
        elif statement.alter == "drop":
            gone = {c.lower() for c in statement.dropped}
            self.tables.reshape(name, current.drop(*[c for c in current.columns if c.lower() in gone]), "drop columns")
        else:
            old, new = statement.renamed
            self.tables.reshape(name, current.withColumnRenamed(old, new), "rename column")

    # --- copies out ---------------------------------------------------------------------

    def materialize(self, source: str, as_table: str | None = None, *, replace: bool = False) -> str:
        """Copy a file-backed view into a managed table."""
        target = as_table or f"managed_{safe_alias(source)}"
        if target.lower() in self._views:
            raise NameConflictError("A managed table cannot take the name of a file-backed alias.")
        if self.read_only:
            raise ReadOnlyError("The library is open in read-only mode.")
        self.tables.create(target, self.table(source), replace=replace)
        self._show_managed(target)
        return target

    def export(self, source: str, output: str, *, format: str | None = None, compression: str = "zstd") -> str:
        """Write a table or a SELECT to CSV, TSV or Parquet (a folder of part files)."""
        kind = (format or output.rsplit(".", 1)[-1]).lower()
        if kind not in FORMATS:
            raise FileFormatError("Export format must be csv, tsv, or parquet.")
        known = source.lower() in self._views | self._managed
        df = self.table(source) if known else self.query(source)
        if kind == "parquet":
            df.write.mode("overwrite").parquet(output, compression=compression)
        else:
            df.write.mode("overwrite").options(**csv_options("\t" if kind == "tsv" else ",")).csv(output)
        return output

    def export_csv(self, source: str, output: str) -> str:
        return self.export(source, output, format="csv")

    def export_tsv(self, source: str, output: str) -> str:
        return self.export(source, output, format="tsv")

    def export_parquet(self, source: str, output: str, compression: str = "zstd") -> str:
        return self.export(source, output, format="parquet", compression=compression)

    def close(self) -> None:
        for name in self._views | self._managed | {LISTING}:
            self.spark.sql(f"DROP VIEW IF EXISTS {_quoted(name)}")

    def __enter__(self) -> "DataLibrary":
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def _first_line(failure: Exception) -> str:
    """The cause of a Java error rather than the name of the failed call."""
    java = getattr(failure, "java_exception", None)
    while java is not None and java.getCause() is not None:
        java = java.getCause()
    return str(java.getMessage() if java is not None else failure).splitlines()[0]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def open_data_library(spark, folder, database=None, *, recursive=True, read_only=False, **options) -> DataLibrary:
    return DataLibrary(spark, folder, database, recursive=recursive, read_only=read_only, **options)
