"""Column sketches that are kept for each part of a dataset and merged for the whole.

A HyperLogLog sketch tells how many values a column has, a KLL sketch its quantiles.  Both merge
without loss of their bounds, so a part that is added or written again costs a look at that part only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.parts import read_parts
from ..sinks.filesystem import Files

#: Where the sketches of a part dataset lie; readers of the dataset pass over the name.
FOLDER = "_sketches"
#: Sizes of the sketches, and three standard errors of what they tell: of the distinct count (relative), of a rank (share of rows).
LG_K, K = 12, 400
DISTINCT_BOUND, RANK_BOUND = 0.05, 0.015
QUANTILES = (0.25, 0.5, 0.75)


def column_sketches(df: DataFrame, columns=None, part: str | None = None) -> DataFrame:
    """``[part,] column_name, rows, filled, distinct_sketch, quantile_sketch`` from one scan.

    ``part`` names a column whose values get sketches of their own.  Quantiles are for numbers;
    other columns have a null there.
    """
    names = [n for n in (columns or df.columns) if n != part]
    figures, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, name in enumerate(names):
        column = F.col(f"`{name}`")
        number = isinstance(df.schema[name].dataType, T.NumericType)
        figures += [
            F.count(column).alias(f"n{i}"),
            F.hll_sketch_agg(F.when(column.isNotNull(), F.xxhash64(column)), LG_K).alias(f"d{i}"),
            (F.kll_sketch_agg_double(column.cast("double"), K) if number else F.lit(None).cast("binary")).alias(f"q{i}"),
        ]
        rows.append(F.struct(F.lit(name).alias("column_name"), F.col("_rows").alias("rows"), F.col(f"n{i}").alias("filled"), F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("quantile_sketch")))
    found = (df.groupBy(F.col(f"`{part}`").alias("part")) if part else df).agg(*figures)
    return found.select(*(["part"] if part else []), F.inline(F.array(*rows)))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row for each column from the sketches of all parts; nothing of the data is read."""
    return sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def sketch_figures(sketches: DataFrame) -> DataFrame:
    """``column_name, rows, filled, distinct_values, q25, q50, q75`` as the sketches tell them."""
    known = F.when(F.kll_sketch_get_n_double("quantile_sketch") > 0, F.col("quantile_sketch"))
    at = [F.kll_sketch_get_quantile_double(known, F.lit(q)).alias(f"q{int(100 * q)}") for q in QUANTILES]
    return sketches.select("column_name", "rows", "filled", F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"), *at)


def sketch_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of each part of a Parquet part dataset, written beside it; parts that have some already are not read again."""
    place = f"{folder.rstrip('/')}/{FOLDER}"
    rows = read_parts(spark, folder).withColumn("_part", F.col("_metadata.file_path"))
    if Files(spark).exists(place):
        rows = rows.join(spark.read.parquet(place).select(F.col("part").alias("_part")).distinct(), "_part", "left_anti")
    column_sketches(rows, [c for c in rows.columns if c not in ("_part", "chunk_id")], "_part").write.mode("append").parquet(place)
    return spark.read.parquet(place)


def sketch_errors(df: DataFrame, figures: DataFrame) -> DataFrame:
    """``column_name, distinct_ok, ranks_ok``: whether exact counts and ranks stay within the bounds of :func:`sketch_figures`.

    A quantile is right if its share of rows lies between those of smaller and of equal values, but for
    :data:`RANK_BOUND`.  ``ranks_ok`` is null for columns without quantiles.
    """
    told = figures.collect()  # one row for each column
    checks = []
    for row in told:
        # Each column by itself: distinct counts of many columns in one aggregate would copy every row for each of them.
        values = df.groupBy(F.col(f"`{row.column_name}`").alias("v")).agg(F.count(F.lit(1)).alias("n")).where(F.col("v").isNotNull())
        terms, ranks = [F.count(F.lit(1)).alias("d")], F.lit(None).cast("boolean")
        if row["q50"] is not None:
            ranks = F.lit(True)
            for q in QUANTILES:
                name = f"q{int(100 * q)}"
                for kind, within in (("b", F.col("v") < row[name]), ("e", F.col("v") <= row[name])):
                    terms.append(F.try_divide(F.sum(F.when(within, F.col("n")).otherwise(0)), F.sum("n")).alias(f"{kind}_{name}"))
                ranks = ranks & (F.col(f"b_{name}") <= q + RANK_BOUND) & (F.col(f"e_{name}") >= q - RANK_BOUND)
        near = F.abs(F.lit(row.distinct_values) - F.col("d")) <= F.ceil(F.col("d") * DISTINCT_BOUND)
        checks.append(values.agg(*terms).select(F.lit(row.column_name).alias("column_name"), near.alias("distinct_ok"), ranks.alias("ranks_ok")))
    return reduce(DataFrame.unionByName, checks)
