"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from extractkit.session import scratch_path

#: Rows of an Arrow batch; texts may be very long, so batches hold few of them.
BATCH_ROWS = 512


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of at most :data:`BATCH_ROWS`."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read again.

    This cuts the lineage: what is read back survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remembered(key: tuple, make: Callable):
    """``make()``, once for each key in a Python worker, which keeps it from task to task."""
    store = sys.modules.setdefault("extractkit_llm_remembered", ModuleType("extractkit_llm_remembered")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row.

    Spark puts an expression in place of each of its uses; a lambda variable is bound once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


_ONE, _TWO, _THREE = np.uint64(30), np.uint64(27), np.uint64(31)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit words whose bits look random."""
    x = (x ^ (x >> _ONE)) * _A
    x = (x ^ (x >> _TWO)) * _B
    return x ^ (x >> _THREE)


def odd_words(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)
