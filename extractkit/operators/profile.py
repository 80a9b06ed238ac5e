"""Column summary and page-log metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def summarize(df: DataFrame, *, approximate: bool = True) -> DataFrame:
    """One row per column: type, min, max, distinct, mean, deviation, quartiles,
    row count and share of NULLs.

    All figures come from one aggregation over one scan.  Distinct counts and
    quartiles are sketches, so memory stays fixed whatever the data holds.
    ``approximate=False`` leaves them out.
    """
    figures, layout = [F.count(F.lit(1)).alias("_rows")], []
    nothing = F.lit(None)
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        orderable = isinstance(field.dataType, _ORDERABLE)
        numeric = isinstance(field.dataType, T.NumericType)
        entry = {
            "min": F.min(column).cast("string") if orderable else nothing.cast("string"),
            "max": F.max(column).cast("string") if orderable else nothing.cast("string"),
            "avg": F.avg(column).cast("double") if numeric else nothing.cast("double"),
            "std": F.stddev(column).cast("double") if numeric else nothing.cast("double"),
            "filled": F.count(column),
        }
        if approximate:
            entry["approx_unique"] = F.approx_count_distinct(column) if orderable else nothing.cast("bigint")
            quartiles = F.percentile_approx(column, [0.25, 0.5, 0.75], 10_000)
            entry["quartiles"] = (
                F.transform(quartiles, lambda q: q.cast("string")) if numeric else nothing.cast("array<string>")
            )
        figures.extend(value.alias(f"{key}{i}") for key, value in entry.items())
        layout.append((field.name, field.dataType.simpleString(), i))
    one = df.agg(*figures)

    rows = []
    for name, kind, i in layout:
        share = F.when(F.col("_rows") > 0, F.lit(100.0) * (F.col("_rows") - F.col(f"filled{i}")) / F.col("_rows"))
        values = [
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.col(f"min{i}").alias("min"),
            F.col(f"max{i}").alias("max"),
        ]
        if approximate:
            values.append(F.col(f"approx_unique{i}").alias("approx_unique"))
        values += [F.col(f"avg{i}").alias("avg"), F.col(f"std{i}").alias("std")]
        if approximate:
            values += [
                F.get(f"quartiles{i}", F.lit(p)).alias(label) for p, label in enumerate(("q25", "q50", "q75"))
            ]
        values += [F.col("_rows").alias("count"), F.round(share, 2).alias("null_percentage")]
        rows.append(F.struct(*values))
    return one.select(F.inline(F.array(*rows)))


def page_metrics(
    log: DataFrame,
    *,
    group_by=(),
    started: str = "started",
    seconds: str = "seconds",
    rows: str = "rows",
    failed: str = "failed",
    retries: str = "retries",
) -> DataFrame:
    """Throughput of a page log: counts, page times, rows per second, concurrency.

    Effective concurrency is the sum of page times over the elapsed time.  Page
    times enter the exact percentiles in whole milliseconds, so equal times fold
    together before the shuffle.
    """
    begin = F.unix_micros(F.col(started).cast("timestamp"))
    millis = F.round(F.col(seconds) * 1000).cast("bigint")
    page_log = log.select(
        *group_by,
        begin.alias("_begin"),
        (begin + F.round(F.col(seconds) * 1_000_000).cast("bigint")).alias("_end"),
        F.col(seconds).alias("_seconds"),
        millis.alias("_ms"),
        F.col(rows).cast("bigint").alias("_rows"),
        F.col(failed).cast("int").alias("_failed"),
        F.col(retries).cast("bigint").alias("_retries"),
    )
    marks = [0.5, 0.9, 0.95]
    totals = page_log.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("_rows").alias("rows"),
        F.sum("_failed").cast("bigint").alias("failures"),
        F.sum("_retries").alias("retries"),
        F.sum("_ms").alias("_busy"),
        F.avg("_ms").alias("_mean"),
        F.percentile("_ms", marks).alias("_marks"),
        F.min("_begin").alias("_first"),
        F.max("_end").alias("_last"),
    )
    elapsed = F.greatest((F.col("_last") - F.col("_first")) / 1_000_000, F.lit(0.001))
    return totals.select(
        *group_by,
        "pages",
        "rows",
        "failures",
        "retries",
        F.round(elapsed, 3).alias("elapsed_seconds"),
        F.round(F.col("rows") / elapsed, 3).alias("rows_per_second"),
        F.round(F.col("_mean") / 1000, 6).alias("page_seconds_avg"),
        *[
            F.round(F.get("_marks", F.lit(i)) / 1000, 6).alias(f"page_seconds_{label}")
            for i, label in enumerate(("p50", "p90", "p95"))
        ],
        F.round(F.col("_busy") / 1000 / elapsed, 6).alias("effective_concurrency"),
    )


def usage_rollup(log: DataFrame, body: str = "body", *, group_by=("provider", "model"), duration_ms: str = "duration_ms") -> DataFrame:
    """Requests, tokens and time per group of a response log with JSON bodies.

    ``prompt_tokens`` and ``completion_tokens`` win over ``input_tokens`` and
    ``output_tokens`` whenever they are present, even when empty.
    """
    usage = F.from_json(F.get_json_object(body, "$.usage"), "map<string,string>")

    def tokens(first: str, second: str | None = None):
        value = F.try_element_at("_usage", F.lit(first)).try_cast("bigint")
        if second is not None:
            other = F.try_element_at("_usage", F.lit(second)).try_cast("bigint")
            value = F.when(F.map_contains_key("_usage", first), value).otherwise(other)
        return F.coalesce(value, F.lit(0)).cast("bigint")

    return (
        log.withColumn("_usage", usage)
        .groupBy(*group_by)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.sum(tokens("prompt_tokens", "input_tokens")).alias("input_tokens"),
            F.sum(tokens("completion_tokens", "output_tokens")).alias("output_tokens"),
            F.sum(tokens("total_tokens")).alias("total_tokens"),
            F.sum(F.col(duration_ms)).alias("duration_ms"),
        )
    )
