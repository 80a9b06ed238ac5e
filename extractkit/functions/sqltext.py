"""Column expressions over SQL text: masking, extraction, classification.

All of it stays in the JVM as regular expressions; the patterns use possessive
or lazy repeats so that long texts neither backtrack nor recurse deeply.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import null_if_empty, strip

# Statement words per class.
QUERY_WORDS = ("SELECT", "WITH")
WRITE_WORDS = ("INSERT", "UPDATE", "DELETE", "MERGE", "UPSERT", "REPLACE")
DDL_WORDS = ("ALTER", "CREATE", "DROP", "TRUNCATE", "RENAME", "COMMENT", "GRANT", "REVOKE")
PROCEDURE_WORDS = ("BEGIN", "DECLARE", "CALL", "EXEC", "EXECUTE")
TRANSACTION_WORDS = ("COMMIT", "ROLLBACK", "SAVEPOINT", "SET")

# Clauses and packages that make a query unsafe.
UNSAFE_CLAUSES = (
    (r"\bDBMS_SCHEDULER\b", "scheduler package"),
    (r"\bDBMS_JOB\b", "job package"),
    (r"\bUTL_HTTP\b", "network package"),
    (r"\bUTL_FILE\b", "file package"),
    (r"\bDBMS_PIPE\b", "pipe package"),
    (r"\bEXECUTE\s+IMMEDIATE\b", "dynamic SQL"),
    (r"\bFOR\s+UPDATE\b", "row-locking clause"),
    (r"\bINTO\s+OUTFILE\b", "file output clause"),
)

# Word classes of the permissive (local table) target.
LOCAL_DDL = ("CREATE", "ALTER", "DROP", "TRUNCATE", "RENAME", "COMMENT")
LOCAL_DML = ("INSERT", "UPDATE", "DELETE", "MERGE", "REPLACE")
LOCAL_TRANSACTION = ("BEGIN", "COMMIT", "ROLLBACK", "SAVEPOINT")
LOCAL_QUERY = ("SELECT", "WITH", "SHOW", "DESCRIBE", "EXPLAIN")
LOCAL_DESTRUCTIVE = ("DROP", "TRUNCATE")

_COMMENT = r"--[^\r\n]*+|/\*(?s:.*?)(?:\*/|\z)"
# A doubled quote ends one literal and opens the next, which masks the same text.
_SINGLE_QUOTED = r"'[^']*+(?:'|\z)"
_DOUBLE_QUOTED = r"\"[^\"]*+(?:\"|\z)"
_BRACKET_QUOTED = "|".join(
    rf"[qQ]'\{opening}(?s:.*?)(?:\{closing}'|\z)" for opening, closing in ("[]", "{}", "()", "<>")
)
_CHAR_QUOTED = r"[qQ]'(?s:(.).*?)(?:\1'|\z)"
_MASKED = "|".join((_COMMENT, _BRACKET_QUOTED, _CHAR_QUOTED, _SINGLE_QUOTED, _DOUBLE_QUOTED))
# Without the open-ended forms: an unclosed quote hides no table.
_CLOSED = "|".join((r"--[^\r\n]*+", r"/\*(?s:.*?)\*/", _BRACKET_QUOTED, _CHAR_QUOTED, r"'[^']*+'")).replace(r"|\z)", ")")

_FENCE = r"(?is)```(?:sql|oracle|plsql)?\s*(.*?)```"
_STATEMENT = (
    r"(?imsd)^\s*((?:WITH|SELECT|INSERT|UPDATE|DELETE|MERGE|ALTER|CREATE|DROP|"
    r"TRUNCATE|BEGIN|DECLARE|CALL|EXEC(?:UTE)?)\b.*)"
)
_TABLE_REFERENCE = (
    r"(?i)\b(?:FROM|JOIN)\s+((?:[A-Za-z][A-Za-z0-9_$#]*\.)?[A-Za-z][A-Za-z0-9_$#]*)"
)


def mask_literals(sql: Column) -> Column:
    """Blank out comments and quoted text, q-quotes included."""
    return F.regexp_replace(sql, _MASKED, " ")


def _statement_in(text: Column) -> Column:
    found = F.regexp_extract(text, _STATEMENT, 1)
    return strip(F.regexp_replace(found, r"\s*(?:```\s*)+\z", ""))


def extract_sql(text: Column) -> Column:
    """First SQL statement of a text (fenced blocks first); NULL when there is none."""
    text = strip(text)
    blocks = F.regexp_extract_all(text, F.lit(_FENCE), F.lit(1))
    candidates = F.when(F.size(blocks) > 0, blocks).otherwise(F.array(text))
    statements = F.filter(F.transform(candidates, lambda c: _statement_in(strip(c))), lambda s: s != "")
    return F.get(statements, F.lit(0))


def first_word(masked: Column) -> Column:
    """First plain word, upper case; ``UNKNOWN`` when there is none."""
    word = F.upper(F.regexp_extract(masked, r"\b([A-Za-z]+)\b", 1))
    return F.when(word == "", F.lit("UNKNOWN")).otherwise(word)


def has_several_statements(masked: Column) -> Column:
    return masked.rlike(r"(?s);\s*\S")


def statement_class(word: Column) -> Column:
    return (
        F.when(word.isin(*QUERY_WORDS), F.lit("QUERY"))
        .when(word.isin(*WRITE_WORDS), F.lit("DML"))
        .when(word.isin(*DDL_WORDS), F.lit("DDL"))
        .when(word.isin(*PROCEDURE_WORDS), F.lit("PLSQL"))
        .when(word.isin(*TRANSACTION_WORDS), F.lit("TRANSACTION"))
        .otherwise(F.lit("UNKNOWN"))
    )


def _class_reason(kind: Column, word: Column) -> Column:
    return (
        F.when(kind == "DML", F.concat(word, F.lit(" changes data")))
        .when(kind == "DDL", F.concat(word, F.lit(" changes database objects or privileges")))
        .when(kind == "PLSQL", F.concat(word, F.lit(" may execute procedural operations")))
        .when(kind == "TRANSACTION", F.concat(word, F.lit(" changes transaction or session state")))
        .when(kind == "UNKNOWN", F.lit("statement type is not recognized"))
    )


def with_classification(df, sql_column: str, *, read_only: bool = True, prefix: str = ""):
    """Add the classification columns of a strict (read-only by default) target.

    Every step is its own projection so that each regular expression is written
    once; Catalyst keeps them in one stage.  Rows without SQL get NULLs.
    """
    if not isinstance(read_only, bool):
        raise ValueError("read_only must be True or False.")
    col = F.col
    out = df.withColumn("_sql", extract_sql(col(sql_column)))
    out = out.withColumn("_masked", mask_literals(col("_sql")))
    out = out.withColumn("_word", F.when(col("_sql").isNotNull(), first_word(col("_masked"))))
    out = out.withColumn("_kind", F.when(col("_word").isNotNull(), statement_class(col("_word"))))
    any_unsafe = col("_masked").rlike("(?i)" + "|".join(pattern for pattern, _ in UNSAFE_CLAUSES))
    unsafe = [
        F.when(col("_any_unsafe") & col("_masked").rlike("(?i)" + pattern), F.lit(f"contains {label}"))
        for pattern, label in UNSAFE_CLAUSES
    ]
    # A WITH statement may still end in a data change.
    unsafe.append(
        F.when(
            (col("_word") == "WITH") & col("_masked").rlike(r"(?i)\)\s*(?:INSERT|UPDATE|DELETE|MERGE)\b"),
            F.lit("WITH statement changes data"),
        )
    )
    out = out.withColumn("_any_unsafe", any_unsafe)
    out = out.withColumn("_unsafe", F.filter(F.array(*unsafe), lambda r: r.isNotNull()))
    out = out.withColumn("_many", has_several_statements(col("_masked")))
    out = out.withColumn(f"{prefix}statement_type", col("_kind"))
    out = out.withColumn(
        f"{prefix}read_only",
        (col("_kind") == "QUERY") & (F.size("_unsafe") == 0),
    )
    permitted = col(f"{prefix}read_only") if read_only else col("_word") != "UNKNOWN"
    out = out.withColumn(f"{prefix}allowed", ~col("_many") & permitted)
    out = out.withColumn(f"{prefix}multiple_statements", col("_many"))
    out = out.withColumn(f"{prefix}has_comments", col("_sql").rlike(r"--|/\*"))
    reasons = F.filter(
        F.concat(
            F.array(_class_reason(col("_kind"), col("_word"))),
            col("_unsafe"),
            F.array(F.when(col("_many"), F.lit("contains multiple statements"))),
        ),
        lambda r: r.isNotNull(),
    )
    out = out.withColumn(f"{prefix}reasons", F.when(col("_kind").isNotNull(), reasons))
    out = out.withColumn(
        f"{prefix}risk_level",
        F.when(col(f"{prefix}allowed") & (F.size(f"{prefix}reasons") == 0), F.lit("LOW"))
        .when((col("_kind") == "QUERY") & ~col(f"{prefix}allowed"), F.lit("MEDIUM"))
        .when(col("_kind").isNotNull(), F.lit("HIGH")),
    )
    return out.drop("_sql", "_masked", "_word", "_kind", "_any_unsafe", "_unsafe", "_many")


def with_local_classification(df, sql_column: str, *, prefix: str = ""):
    """Add the classification columns of a target that allows every statement."""
    col = F.col
    text = null_if_empty(strip(col(sql_column)))
    out = df.withColumn("_masked", mask_literals(text))
    out = out.withColumn("_word", F.when(col("_masked").isNotNull(), first_word(col("_masked"))))
    destructive = col("_word").isin(*LOCAL_DESTRUCTIVE)
    schema = col("_word").isin(*LOCAL_DDL)
    dml = col("_word").isin(*LOCAL_DML)
    out = out.withColumns(
        {
            f"{prefix}statement_type": col("_word"),
            f"{prefix}read_only": col("_word").isin(*LOCAL_QUERY),
            f"{prefix}changes_data": dml | destructive,
            f"{prefix}changes_schema": schema,
            f"{prefix}transaction_control": col("_word").isin(*LOCAL_TRANSACTION),
            f"{prefix}multiple_statements": has_several_statements(col("_masked")),
            f"{prefix}destructive": destructive,
            f"{prefix}allowed": F.when(col("_word").isNotNull(), F.lit(True)),
            f"{prefix}risk_level": F.when(destructive, F.lit("HIGH"))
            .when(schema | dml, F.lit("MEDIUM"))
            .when(col("_word").isNotNull(), F.lit("LOW")),
        }
    )
    return out.drop("_masked", "_word")


def referenced_tables(text: Column) -> Column:
    """Distinct upper-case names after FROM and JOIN, in order of appearance."""
    bare = F.regexp_replace(extract_sql(text), _CLOSED, " ")
    names = F.regexp_extract_all(bare, F.lit(_TABLE_REFERENCE), F.lit(1))
    return F.array_distinct(F.transform(names, F.upper))
