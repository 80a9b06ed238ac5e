"""Jobs over tables of SQL texts, errors and streamed answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.redaction import count_secrets, redact_text
from ..functions.sqltext import extract_sql, referenced_tables, with_classification, with_local_classification
from ..functions.triage import error_code, error_message, is_missing_object, is_payload_failure, is_retryable

POSITIONS_PER_RUN = 4_096


def classify_log(log: DataFrame, sql: str = "sql", *, read_only: bool = True) -> DataFrame:
    """Statement class, permission, reasons and risk of every text."""
    return with_classification(log, sql, read_only=read_only)


def classify_local_log(log: DataFrame, sql: str = "sql") -> DataFrame:
    """Statement effects of every text for a target that allows all of them."""
    return with_local_classification(log, sql)


def risk_rollup(classified: DataFrame) -> DataFrame:
    """Queries per statement type and risk."""
    return classified.groupBy("statement_type", "risk_level").agg(
        F.count(F.lit(1)).alias("queries"),
        F.count_if("allowed").alias("allowed_queries"),
        F.count_if("multiple_statements").alias("multiple_statements"),
    )


def table_references(log: DataFrame, query_id: str = "query_id", sql: str = "sql") -> DataFrame:
    """One row per query and referenced table, with its place in the query."""
    names = referenced_tables(F.col(sql))
    # The outer form keeps the optimizer from computing the names twice.
    exploded = log.select(query_id, F.posexplode_outer(names).alias("position", "table_name"))
    exploded = exploded.where("position >= 0")
    return exploded.withColumn("position", F.col("position").cast("bigint"))


def table_usage(log: DataFrame, query_id: str = "query_id", sql: str = "sql") -> DataFrame:
    """Queries per referenced table."""
    references = table_references(log, query_id, sql)
    return references.groupBy("table_name").agg(F.count(F.lit(1)).alias("queries"))


def check_allowlist(
    references: DataFrame, allowlist: DataFrame, query_id: str = "query_id", *, log: DataFrame | None = None
) -> DataFrame:
    """Unknown tables per query; ``valid`` when there are none.

    With ``log``, its queries without any reference are in the report too, as valid.

    A table is allowed when the list holds it exactly, or when exactly one entry
    has its unqualified name.
    """
    entries = allowlist.select(F.upper("table_name").alias("table_name")).distinct()
    exact = entries.withColumn("_exact", F.lit(True))
    last = F.substring_index("table_name", ".", -1)
    lone = entries.groupBy(last.alias("_last")).agg(F.count(F.lit(1)).alias("_entries"))
    # Judge each distinct name once; queries then only look it up.
    judged = (
        references.select("table_name")
        .distinct()
        .withColumn("_last", last)
        .join(exact, "table_name", "left")
        .join(lone, "_last", "left")
        .select(
            "table_name",
            (F.coalesce("_exact", F.lit(False)) | (F.coalesce("_entries", F.lit(0)) == 1)).alias("_allowed"),
        )
    )
    found = references.join(judged, "table_name").select(query_id, "table_name", "_allowed")
    if log is not None:
        # One row more for each query, which counts as no table.
        found = found.unionByName(log.select(query_id).distinct(), allowMissingColumns=True)
    return (
        found.groupBy(query_id)
        .agg(
            F.count("table_name").alias("referenced_tables"),
            F.array_sort(F.collect_set(F.when(~F.col("_allowed"), F.col("table_name")))).alias("unknown_tables"),
        )
        .withColumn("valid", F.size("unknown_tables") == 0)
    )


def extract_statements(answers: DataFrame, text: str = "text", *, column: str = "sql") -> DataFrame:
    """Answers that hold SQL, with the extracted statement."""
    return answers.withColumn(column, extract_sql(F.col(text))).where(F.col(column).isNotNull())


def redact_table(df: DataFrame, text: str = "text", *, rules: str = "service", hits: str = "redactions") -> DataFrame:
    """Redact a text column and report the number of places."""
    counted = df.withColumn(hits, F.coalesce(count_secrets(F.col(text), rules), F.lit(0).cast("bigint")))
    return counted.withColumn(text, redact_text(F.col(text), rules))


def parse_errors(log: DataFrame, text: str = "text") -> DataFrame:
    """Add the database error code and the redacted message."""
    return log.withColumn("error_code", error_code(F.col(text))).withColumn("error_message", error_message(F.col(text)))


def error_counts(log: DataFrame, text: str = "text") -> DataFrame:
    """Errors per database code; NULL gathers the texts without one."""
    coded = log.select(error_code(F.col(text)).alias("error_code"))
    return coded.groupBy("error_code").agg(F.count(F.lit(1)).alias("errors"))


def triage_errors(log: DataFrame, text: str = "text", status: str | None = None) -> DataFrame:
    """Add ``retryable``, ``payload_failure`` and ``missing_object``."""
    code = F.col(status) if status else None
    return log.withColumns(
        {
            "retryable": is_retryable(F.col(text), code),
            "payload_failure": is_payload_failure(F.col(text)),
            "missing_object": is_missing_object(F.col(text)),
        }
    )


def assemble_stream(lines: DataFrame, response: str = "response_id", position: str = "seq", line: str = "line") -> DataFrame:
    """Text of each streamed answer from its ``data:`` lines.

    Lines after the first ``[DONE]`` do not count.  Runs of positions are joined
    first and the runs after that, so a very long answer is put together by many
    tasks and only its finished runs meet in one row.
    """
    data = lines.where(F.col(line).startswith("data:")).select(
        response, position, F.btrim(F.substring(line, 6, 2**31 - 1), F.lit(" \t\r\n")).alias("_data")
    )
    ends = data.where("_data = '[DONE]'").groupBy(response).agg(F.min(position).alias("_end"))
    content = F.from_json("_data", "choices array<struct<delta:struct<content:string>>>")
    pieces = data.where("_data <> '[DONE]'").withColumn("_text", content.getField("choices")[0]["delta"]["content"])
    kept = pieces.join(ends, response, "left").where(F.col("_end").isNull() | (F.col(position) < F.col("_end")))
    filled = F.col("_text") != ""
    runs = kept.groupBy(response, F.floor(F.col(position) / POSITIONS_PER_RUN).alias("_run")).agg(
        _joined(F.when(filled, F.struct(position, "_text"))).alias("_text"), F.count_if(filled).alias("_pieces")
    )
    return runs.groupBy(response).agg(
        _joined(F.struct("_run", "_text")).alias("text"), F.sum("_pieces").alias("pieces")
    )


def _joined(pairs: Column) -> Column:
    """Texts of ``(place, text)`` pairs in the order of their places."""
    ordered = F.array_sort(F.collect_list(pairs))
    return F.array_join(F.transform(ordered, lambda pair: pair["_text"]), "")
