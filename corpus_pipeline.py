"""A training corpus from raw documents, in four stages.

1. quality rules: documents that the weighed rules reject go;
2. quality classifier: documents that the co-trained classifier rejects go (junk, toxic ones);
3. near-duplicates: one document of each group stays;
4. packing: the tokens of what is left, placed into sequences.

Every stage but the last returns the columns of ``documents``.  Rows with a null ``doc_id``
are documents of their own everywhere; rows that agree in ``doc_id`` and text are one document from
the third stage on, and rows that share a ``doc_id`` only are several.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from extractkit.llm import quality_classifier, quality_rules
from extractkit.llm.common import load, stored
from extractkit.llm.minhash import near_duplicates
from extractkit.llm.packing import pack_documents


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and are probably good by the votes of all rules.

    The model is fitted over all documents in one pass and applied in a second, so no text is shuffled.
    """
    model = quality_rules.fit(quality_rules.with_counts(docs.select("text")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), quality_rules.count_columns(F.col("text")))
    return rows.where(model.kept()).select("_doc.*")


def classifier_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier scores above its threshold."""
    model = quality_classifier.fit(docs, load(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).where("kept").select(docs.columns)


def _own_keys(named: DataFrame, shared: DataFrame) -> DataFrame:
    """One row for each text of an id, with ``_key``: ids that no other row has, numbers above all ids for the others (below them if there is no room above).

    Of rows that agree in id and text, the one whose columns come first as JSON stays.
    """
    text = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    others = [F.col(f"`{c}`") for c in named.columns if c not in ("doc_id", "text")]
    same = named.join(shared, "doc_id", "left_semi").groupBy("doc_id", text.alias("_digest"))
    whole = F.struct(*[F.col(f"`{c}`") for c in named.columns])
    rows = same.agg(F.min_by(whole, F.to_json(F.struct(F.col("text").isNull(), *others))).alias("_row"))
    numbered = stored(rows.orderBy("doc_id", "_digest").withColumn("_n", F.monotonically_increasing_id()), "shared-texts")
    low, high = named.agg(F.min("doc_id"), F.max("doc_id")).first()
    key = F.col("_n") + F.lit(high + 1) if high < 1 << 62 else F.col("_n") + F.lit(low - (1 << 62))
    alone = named.join(shared, "doc_id", "left_anti").withColumn("_key", F.col("doc_id"))
    return alone.unionByName(numbered.select("_row.*", key.alias("_key")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id.

    An id that several rows have names a document for each of its texts.  Those come after all others, in the order of
    id and text digest; rows that agree in id and text are one document.  Rows without an id are all kept.
    """
    named = docs.where("doc_id is not null")
    shared = stored(named.groupBy("doc_id").count().where("count > 1").select("doc_id"), "shared-ids")
    keyed = named.withColumn("_key", F.col("doc_id")) if shared.isEmpty() else stored(_own_keys(named, shared), "keyed")
    found = near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), width=5, percent=80)
    keep = found.where("kept").select(F.col("doc_id").alias("_key"))
    return keyed.join(keep, "_key", "left_semi").unionByName(docs.where("doc_id is null"), allowMissingColumns=True).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rule_filter),
    ("quality_classifier", classifier_filter),
    ("minhash_dedup", near_dedup),
    ("packing", packing),
]

#: The classifier, the components and the packing cannot be said in SQL; tests/llm checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet before the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
