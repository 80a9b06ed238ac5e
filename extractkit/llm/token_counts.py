"""Token counts as a rollup that signed changes keep up to date.

A change is a row ``(source, lang, tokenizer, sign, n_tokens, n_chars)``: sign 1 adds a document,
-1 takes it out, and a revised count is the old row with -1 and the new one with 1.  A commit
sums a batch's changes by source, language and tokenizer version and publishes these sums as
one folder whose name is the batch's; totals are the sums over all batches.  Sums of sums do
not depend on order, so batches may come in any order, and a batch that is committed again,
by a retry or a second writer, changes nothing.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
SUMS = ("documents", "tokens", "chars")
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long, chars long"


def inserted(counts: DataFrame) -> DataFrame:
    """``counts`` (keys, ``n_tokens``, ``n_chars``) as changes that add."""
    return counts.select(*KEYS, F.lit(1).alias("sign"), "n_tokens", "n_chars")


def deleted(counts: DataFrame) -> DataFrame:
    """``counts`` as changes that take out; they must state what was added."""
    return counts.select(*KEYS, F.lit(-1).alias("sign"), "n_tokens", "n_chars")


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    return deleted(before).unionByName(inserted(after))


class TokenRollup:
    """The committed batches below a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def committed(self, batch: str) -> bool:
        return self._fs.exists(self._hadoop(f"{self.path}/batches/batch={_checked(batch)}"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Publish the batch; false if it was there already, in which case ``changes`` is not read.

        Null keys are values of their own; null counts are 0; a null sign is an error.  Groups
        whose sums are all 0 are left out.  The sums are written aside and renamed, so a batch is
        there as a whole or not at all.
        """
        target = self._hadoop(f"{self.path}/batches/batch={_checked(batch)}")
        if self._fs.exists(target):
            return False
        sign = F.coalesce(F.col("sign").cast("long"), F.raise_error("sign is null").cast("long"))
        sums = changes.groupBy(*KEYS).agg(
            F.sum(sign).alias("documents"),
            F.sum(sign * F.coalesce("n_tokens", F.lit(0)).cast("long")).alias("tokens"),
            F.sum(sign * F.coalesce("n_chars", F.lit(0)).cast("long")).alias("chars"),
        )
        aside = f"{self.path}/aside/{uuid.uuid4().hex}"
        sums.where("documents <> 0 or tokens <> 0 or chars <> 0").write.parquet(aside)
        self._fs.mkdirs(target.getParent())
        if not self._fs.exists(target) and self._fs.rename(self._hadoop(aside), target):
            # A rename onto a folder that another writer has just made ends inside it.
            nested = self._hadoop(f"{target}/{aside.rpartition('/')[2]}")
            if not self._fs.exists(nested):
                return True
            self._fs.delete(nested, True)
        return False

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, documents, tokens, chars)`` over all batches, without groups of no documents and tokens."""
        folder = f"{self.path}/batches"
        if not self._fs.exists(self._hadoop(folder)):
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(f"{folder}/*")
        return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where("documents <> 0 or tokens <> 0 or chars <> 0")


def _checked(batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError("a batch id has letters, digits, '_', '.' and '-'")
    return batch
