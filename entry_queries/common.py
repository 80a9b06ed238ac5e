"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from extractkit.session import configure, scratch_path, spread
from extractkit.sinks.tables import ManagedTables
from extractkit.sources.library import DataLibrary

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load(spark: SparkSession, folder: str, table: str, spread_by: str | None = None) -> DataFrame:
    """One given table; ``spread_by`` names its key where the work per row is heavy."""
    configure(spark)
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    # The rows of a plain scan are counted from file footers.
    return spread(df, spread_by, rows=df.count()) if spread_by else df


def library(spark: SparkSession, folder: str) -> DataLibrary:
    """The data folder as a library; managed tables go to scratch space."""
    configure(spark)
    return DataLibrary(spark, folder, scratch_path(spark, "library"))


def tables(spark: SparkSession) -> ManagedTables:
    configure(spark)
    return ManagedTables(spark, scratch_path(spark, "tables"))
