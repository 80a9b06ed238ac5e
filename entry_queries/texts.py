"""Query logs, references, redaction, errors and streamed answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from extractkit.functions import redaction
from extractkit.functions.naming import document_account, safe_name, submission_job_name
from extractkit.operators import profile, querylog

from .common import load

QUERIES = {}


def query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = (function, sql)
        return function

    return keep


# A query log: each order gives one text, its kind set by the key's remainder.
# ``type, allowed, several, comments, risk, reasons`` state what the text is.
_LOG = (
    ("SELECT * FROM hr.emp e JOIN Dept d ON d.id = {k}", "QUERY", True, False, False, "LOW", ""),
    ("-- note\nWITH a AS (SELECT 1 FROM hr.emp) SELECT * FROM a WHERE x = '; DROP TABLE {k}'", "QUERY", True, False, False, "LOW", ""),
    ("DELETE FROM orders WHERE id = {k}", "DML", False, False, False, "HIGH", "DELETE changes data"),
    ("Here you are:\n```sql\nSELECT {k} FROM dual; SELECT 2 FROM dual\n```", "QUERY", False, True, False, "MEDIUM", "contains multiple statements"),
    ("update t set a = {k} -- done;", "DML", False, False, True, "HIGH", "UPDATE changes data"),
    ("DROP TABLE old_{k}", "DDL", False, False, False, "HIGH", "DROP changes database objects or privileges"),
    ("BEGIN utl_http.request({k}); END", "PLSQL", False, True, False, "HIGH",
     "BEGIN may execute procedural operations|contains network package|contains multiple statements"),
    ("SELECT id FROM stock /* {k} */ FOR  UPDATE", "QUERY", False, False, True, "MEDIUM", "contains row-locking clause"),
    ("SELECT q'[it's; {k}]' FROM \"a;b\", x JOIN y ON 1 = 1;", "QUERY", True, False, False, "LOW", ""),
    ("order {k} has no statement in it", None, None, None, None, None, None),
    ("WITH a AS (SELECT {k} FROM src.x) INSERT INTO t SELECT * FROM a", "QUERY", False, False, False, "MEDIUM", "WITH statement changes data"),
    ("MERGE INTO t USING s ON t.id = {k}", "DML", False, False, False, "HIGH", "MERGE changes data"),
)


def _query_log(spark, folder):
    kind, key = F.col("o_orderkey") % len(_LOG), F.col("o_orderkey").cast("string")
    text = F.lit(None).cast("string")
    for number, entry in enumerate(_LOG):
        text = F.when(kind == number, F.replace(F.lit(entry[0]), F.lit("{k}"), key)).otherwise(text)
    orders = load(spark, folder, "orders", "o_orderkey")
    return orders.select(F.col("o_orderkey").alias("query_id"), text.alias("sql"))


def _constant(value) -> str:
    if value is None:
        return "NULL"
    return str(value).lower() if isinstance(value, bool) else "'" + value.replace("'", "''") + "'"


def _by_kind(position: int, alias: str) -> str:
    cases = " ".join(f"WHEN {n} THEN {_constant(entry[position])}" for n, entry in enumerate(_LOG))
    return f"CASE o_orderkey % {len(_LOG)} {cases} END AS {alias}"


_CLASSES = "SELECT o_orderkey AS query_id, " + ", ".join(
    _by_kind(p, a)
    for p, a in ((1, "statement_type"), (2, "allowed"), (3, "multiple_statements"), (4, "comments"), (5, "risk_level"), (6, "reasons"))
) + " FROM orders"


@query(f"SELECT query_id, statement_type, allowed, multiple_statements, risk_level, reasons FROM ({_CLASSES})")
def classify_log(spark, folder):
    rows = querylog.classify_log(_query_log(spark, folder))
    reasons = F.array_join("reasons", "|")
    return rows.select("query_id", "statement_type", "allowed", "multiple_statements", "risk_level", reasons.alias("reasons"))


@query(
    f"""
    SELECT statement_type, risk_level, CAST(count(*) AS BIGINT) AS queries, CAST(count(*) FILTER (WHERE allowed) AS BIGINT) AS allowed_queries,
           CAST(count(*) FILTER (WHERE multiple_statements) AS BIGINT) AS multiple_statements FROM ({_CLASSES}) GROUP BY 1, 2
    """
)
def classify_rollup(spark, folder):
    return querylog.risk_rollup(querylog.classify_log(_query_log(spark, folder)))


_LOCAL_TYPES = ("SELECT", "WITH", "DELETE", "HERE", "UPDATE", "DROP", "BEGIN", "SELECT", "SELECT", "ORDER", "WITH", "MERGE")
_LOCAL_MANY = (3, 6)


@query(
    "SELECT query_id, statement_type, statement_type IN ('SELECT', 'WITH') AS read_only, "
    "statement_type IN ('DELETE', 'UPDATE', 'MERGE', 'DROP') AS changes_data, statement_type = 'DROP' AS changes_schema, "
    "statement_type = 'BEGIN' AS transaction_control, statement_type = 'DROP' AS destructive, multiple_statements, "
    "CASE WHEN statement_type = 'DROP' THEN 'HIGH' WHEN statement_type IN ('DELETE', 'UPDATE', 'MERGE') THEN 'MEDIUM' ELSE 'LOW' END AS risk_level "
    "FROM (SELECT o_orderkey AS query_id, CASE o_orderkey % 12 "
    + " ".join(f"WHEN {n} THEN '{word}'" for n, word in enumerate(_LOCAL_TYPES))
    + f" END AS statement_type, o_orderkey % 12 IN {_LOCAL_MANY} AS multiple_statements FROM orders)"
)
def classify_log_local(spark, folder):
    rows = querylog.classify_local_log(_query_log(spark, folder))
    return rows.drop("sql", "allowed")


_REFERENCES = {
    0: ("HR.EMP", "DEPT"), 1: ("HR.EMP", "A"), 2: ("ORDERS",), 3: ("DUAL",), 7: ("STOCK",), 8: ("Y",), 10: ("SRC.X", "A"),
}
_REFERENCE_ROWS = " UNION ALL ".join(
    f"SELECT o_orderkey AS query_id, CAST({place} AS BIGINT) AS position, '{name}' AS table_name FROM orders WHERE o_orderkey % 12 = {kind}"
    for kind, names in _REFERENCES.items()
    for place, name in enumerate(names)
)


@query(_REFERENCE_ROWS)
def table_references(spark, folder):
    return querylog.table_references(_query_log(spark, folder))


@query(f"SELECT table_name, CAST(count(*) AS BIGINT) AS queries FROM ({_REFERENCE_ROWS}) GROUP BY table_name")
def table_usage(spark, folder):
    return querylog.table_usage(_query_log(spark, folder))


# Allowed: two EMP entries (so only the exact names pass), one DEPT, X and DUAL.
@query(
    f"""
    SELECT q.query_id, CAST(count(table_name) AS BIGINT) AS referenced_tables,
           coalesce(string_agg(table_name, ',' ORDER BY table_name) FILTER (WHERE table_name IN ('A', 'ORDERS', 'STOCK', 'Y')), '') AS unknown_tables,
           count(*) FILTER (WHERE table_name IN ('A', 'ORDERS', 'STOCK', 'Y')) = 0 AS valid
    FROM (SELECT o_orderkey AS query_id FROM orders) q LEFT JOIN ({_REFERENCE_ROWS}) r ON q.query_id = r.query_id GROUP BY q.query_id
    """
)
def allowlist_violations(spark, folder):
    names = ("HR.EMP", "ADM.EMP", "CORE.DEPT", "other.x", "dual")
    nation = load(spark, folder, "nation").select(F.upper("n_name").alias("table_name"))
    listed = nation.select(F.explode(F.array(F.col("table_name"), *[F.lit(n) for n in names])).alias("table_name"))
    log = _query_log(spark, folder)
    report = querylog.check_allowlist(querylog.table_references(log), listed, log=log)
    return report.withColumn("unknown_tables", F.array_join("unknown_tables", ","))


@query(
    """
    SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'select ' || CAST(turn AS VARCHAR) || ' from t' ELSE 'DELETE FROM t' END AS sql
    FROM conversations WHERE role IN ('user', 'assistant')
    """
)
def extract_sql_turns(spark, folder):
    """Turns with a fenced statement, or with one on a line of its own, after prose."""
    turns = load(spark, folder, "conversations")
    fenced = F.concat("text", F.lit("\n```sql\n  select "), F.col("turn").cast("string"), F.lit(" from t\n```\n"), "text")
    line = F.concat(F.lit("- "), F.regexp_replace("text", r"\s+", " "), F.lit("\n  DELETE FROM t  "))
    text = F.when(F.col("role") == "user", fenced).when(F.col("role") == "assistant", line).otherwise(F.lit("nothing"))
    return querylog.extract_statements(turns.select("conv_id", "turn", text.alias("text"))).select("conv_id", "turn", "sql")


# --- redaction ------------------------------------------------------------------------------

# DuckDB's \\b knows ASCII letters only, so the left context is spelled out.
_EDGE = r"(^|[^\p{L}\p{N}_])"
_SECRET = rf"{_EDGE}(password|token|secret|cookie|api[_-]?key)\s*[:=]\s*[^\s,;]+"


def _redacted_sql(table: str, key: str, text: str) -> str:
    return rf"""
        SELECT {key}, regexp_replace(regexp_replace({text}, '(authorization\s*:\s*)(?:bearer|basic)\s+\S+', '\1[REDACTED]', 'gi'),
                                     '{_SECRET}', '\1\2=[REDACTED]', 'gi') AS {text},
               CAST(len(regexp_extract_all({text}, '(?i)authorization\s*:\s*(?:bearer|basic)\s+\S+'))
                    + len(regexp_extract_all({text}, '(?i){_SECRET}')) AS BIGINT) AS redactions
        FROM {table}
    """


@query(_redacted_sql("documents", "doc_id", "text"))
def redact_documents(spark, folder):
    return querylog.redact_table(load(spark, folder, "documents", "doc_id").select("doc_id", "text"))


@query(_redacted_sql("pages", "page_id", "html"))
def redact_pages(spark, folder):
    return querylog.redact_table(load(spark, folder, "pages", "page_id").select("page_id", "html"), "html")


@query(
    """
    SELECT c_custkey, 'Authorization: Bearer abc' || CAST(c_custkey AS VARCHAR) AS raw,
           'Authorization: [REDACTED] then password=[REDACTED], and /x?key=[REDACTED]&b=1' AS clean FROM customer
    """
)
def redact_credentials(spark, folder):
    key = F.col("c_custkey").cast("string")
    raw = F.concat(F.lit("Authorization: Bearer abc"), key)
    text = F.concat(raw, F.lit(" then password : s"), key, F.lit(", and /x?key=k"), key, F.lit("&b=1"))
    rows = load(spark, folder, "customer").select("c_custkey", raw.alias("raw"), text.alias("clean"))
    return rows.withColumn("clean", redaction.redact_text(F.col("clean")))


@query(
    """
    SELECT c_custkey, '[REDACTED]' AS api_key, '[REDACTED]' AS login_password, c_name AS login_user,
           'secret=[REDACTED]' AS login_note, '[REDACTED]' AS map_token, c_mktsegment AS map_segment,
           '[REDACTED]' AS first_cookie, 'path' AS first_path FROM customer
    """
)
def redact_nested(spark, folder):
    name = F.col("c_name")
    rows = load(spark, folder, "customer").select(
        "c_custkey",
        name.alias("api_key"),
        F.struct(
            name.alias("password"), name.alias("user"), F.concat(F.lit("secret: "), F.col("c_custkey").cast("string")).alias("note")
        ).alias("login"),
        F.create_map(F.lit("nested.Token"), name, F.lit("segment"), F.col("c_mktsegment")).alias("extra"),
        F.array(F.struct(name.alias("cookie_jar"), F.lit("path").alias("path"))).alias("parts"),
    )
    clean = redaction.redact_columns(rows)
    return clean.select(
        "c_custkey",
        "api_key",
        F.col("login.password").alias("login_password"),
        F.col("login.user").alias("login_user"),
        F.col("login.note").alias("login_note"),
        F.col("extra")["nested.Token"].alias("map_token"),
        F.col("extra")["segment"].alias("map_segment"),
        F.col("parts")[0]["cookie_jar"].alias("first_cookie"),
        F.col("parts")[0]["path"].alias("first_path"),
    )


@query(
    """
    SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN NULL WHEN c_nationkey < 10 THEN '[MASKED]'
                           ELSE substr(c_name, 1, 1) || '***@example.com' END AS masked FROM customer
    """
)
def mask_recipients(spark, folder):
    nation = F.col("c_nationkey")
    recipients = (
        F.when(nation < 3, F.lit(""))
        .when(nation < 5, F.lit(None).cast("string"))
        .when(nation < 10, F.concat("c_name", F.lit(",b@example.com")))
        .otherwise(F.concat(F.lit(" "), "c_name", F.lit("@example.com , other@example.org")))
    )
    rows = load(spark, folder, "customer")
    return rows.select("c_custkey", redaction.mask_recipient(recipients).alias("masked"))


# --- errors ------------------------------------------------------------------------------------

_ERROR_TEXTS = (
    ("call failed\nora-00942: table or view {k} missing\nat line 1", "ORA-00942", "table or view {k} missing", False, False, False),
    ("HTTP 503 service unavailable {k}", None, "HTTP 503 service unavailable {k}", True, False, False),
    ("HTTP 401 authentication failed: password={k}", None, "HTTP 401 authentication failed: password=[REDACTED]", False, False, False),
    ("Connection reset by peer\n{k}", None, "Connection reset by peer", True, False, False),
    ("Missing reportBytes in answer {k}", None, "Missing reportBytes in answer {k}", True, True, False),
    ("Report object not found: /a/{k}", None, "Report object not found: /a/{k}", False, False, True),
    ("ORA-01013:  user requested cancel, timeout; cancelled", "ORA-01013", "user requested cancel, timeout; cancelled", False, False, False),
    ("Invalid SOAP XML: no element found {k}", None, "Invalid SOAP XML: no element found {k}", False, True, False),
)


def _error_log(spark, folder):
    kind, key = F.col("event_id") % len(_ERROR_TEXTS), F.concat(F.lit("k"), F.col("event_id").cast("string"))
    text = F.lit(None).cast("string")
    for number, entry in enumerate(_ERROR_TEXTS):
        text = F.when(kind == number, F.replace(F.lit(entry[0]), F.lit("{k}"), key)).otherwise(text)
    return load(spark, folder, "events", "event_id").select("event_id", text.alias("text"))


def _error_case(position: int) -> str:
    key = "'k' || CAST(event_id AS VARCHAR)"
    cases = " ".join(
        f"WHEN {n} THEN " + (f"replace({_constant(e[position])}, '{{k}}', {key})" if isinstance(e[position], str) else _constant(e[position]))
        for n, e in enumerate(_ERROR_TEXTS)
    )
    return f"CASE event_id % {len(_ERROR_TEXTS)} {cases} END"


@query(f"SELECT event_id, {_error_case(1)} AS error_code, {_error_case(2)} AS error_message FROM events")
def error_messages(spark, folder):
    return querylog.parse_errors(_error_log(spark, folder)).select("event_id", "error_code", "error_message")


@query(f"SELECT {_error_case(1)} AS error_code, CAST(count(*) AS BIGINT) AS errors FROM events GROUP BY 1")
def error_codes(spark, folder):
    return querylog.error_counts(_error_log(spark, folder))


@query(
    f"SELECT event_id, {_error_case(3)} AS retryable, {_error_case(4)} AS payload_failure, {_error_case(5)} AS missing_object FROM events"
)
def error_triage(spark, folder):
    rows = querylog.triage_errors(_error_log(spark, folder))
    return rows.select("event_id", "retryable", "payload_failure", "missing_object")


@query(
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE false END AS retryable FROM events"
)
def error_triage_status(spark, folder):
    """A status of its own decides before the text does."""
    kind = F.col("event_id") % 5
    status = F.when(kind == 0, 429).when(kind == 1, 404).when(kind == 3, 418)
    text = F.when(kind == 1, F.lit("timeout")).when(kind == 2, F.lit("Bad Gateway")).otherwise(F.lit("authorization timed out"))
    rows = load(spark, folder, "events").select("event_id", status.alias("status"), text.alias("text"))
    return querylog.triage_errors(rows, "text", "status").select("event_id", "retryable")


# --- names, usage, streams ------------------------------------------------------------------------


@query(
    r"""
    SELECT url, CASE WHEN name = '' THEN 'file' WHEN regexp_matches(name, '^[0-9]') THEN 't_' || name ELSE name END AS alias
    FROM (SELECT url, trim(regexp_replace(lower(regexp_replace(url, '^https?://[^/]+/[a-z]+/', '')), '[^0-9a-z]+', '_', 'g'), '_') AS name FROM pages)
    """
)
def safe_names(spark, folder):
    pages = load(spark, folder, "pages").select("url")
    return pages.select("url", safe_name(F.regexp_replace("url", "^https?://[^/]+/[a-z]+/", "")).alias("alias"))


@query(
    """
    SELECT p_partkey, 'fin$/' || lower(p_brand) || '$/import$' AS document_account,
           'oracle/apps;' || lower(p_type) || ',Import' AS job_name FROM part
    """
)
def registry_derived(spark, folder):
    account = F.concat(F.lit("fin/"), F.lower("p_brand"), F.lit("/import"))
    job = F.concat(F.lit("//oracle/apps;"), F.lower("p_type"), F.lit(";Import"))
    return load(spark, folder, "part").select(
        "p_partkey", document_account(account).alias("document_account"), submission_job_name(job).alias("job_name")
    )


@query(
    """
    SELECT event_type AS provider, 'm' || CAST(user_id % 3 AS VARCHAR) AS model, CAST(count(*) AS BIGINT) AS requests,
           CAST(sum(event_id % 100) AS BIGINT) AS input_tokens, CAST(sum(event_id % 7) AS BIGINT) AS output_tokens,
           CAST(sum(CASE WHEN event_id % 2 = 0 THEN event_id % 100 + event_id % 7 ELSE 0 END) AS BIGINT) AS total_tokens,
           CAST(sum(event_id % 1000) AS BIGINT) AS duration_ms
    FROM events GROUP BY 1, 2
    """
)
def usage_rollup(spark, folder):
    asked, answered = F.col("event_id") % 100, F.col("event_id") % 7
    new = F.format_string('{"usage":{"prompt_tokens":%d,"completion_tokens":%d,"total_tokens":%d}}', asked, answered, asked + answered)
    old = F.format_string('{"usage":{"input_tokens":%d,"output_tokens":%d}}', asked, answered)
    log = load(spark, folder, "events").select(
        F.col("event_type").alias("provider"),
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model"),
        F.when(F.col("event_id") % 2 == 0, new).otherwise(old).alias("body"),
        (F.col("event_id") % 1000).alias("duration_ms"),
    )
    return profile.usage_rollup(log)


@query(
    """
    SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text, CAST(count(*) AS BIGINT) AS pieces FROM conversations
    WHERE text <> '' GROUP BY conv_id
    """
)
def assemble_stream(spark, folder):
    """Each conversation as a streamed answer: one line per turn, then the end mark and stray lines."""
    turns = load(spark, folder, "conversations")
    content = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("delta"))).alias("choices")))
    pieces = turns.select("conv_id", "turn", F.concat(F.lit("data: "), content).alias("line"))
    ends = turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("turn")).withColumn("line", F.lit("data: [DONE]"))
    stray = ends.select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit('data: {"choices":[{"delta":{"content":"late"}}]}').alias("line"))
    notes = ends.select("conv_id", (F.col("turn") - 1000).alias("turn"), F.lit(": keep-alive").alias("line"))
    lines = pieces.unionByName(ends).unionByName(stray).unionByName(notes)
    return querylog.assemble_stream(lines, "conv_id", "turn", "line")
