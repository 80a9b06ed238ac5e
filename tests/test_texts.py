import pytest
from pyspark.sql import functions as F

from extractkit.functions import redaction as red
from extractkit.functions.sqltext import extract_sql, mask_literals, referenced_tables, with_classification, with_local_classification
from extractkit.functions.triage import error_code, error_message, is_missing_object, is_payload_failure, is_retryable
from extractkit.operators.profile import usage_rollup
from extractkit.operators.querylog import assemble_stream, check_allowlist, table_references


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("sql, kind, allowed, risk", [
    ("SELECT * FROM dual", "QUERY", True, "LOW"),
    ("WITH x AS (SELECT 1 FROM dual) SELECT * FROM x", "QUERY", True, "LOW"),
    ("DELETE FROM t", "DML", False, "HIGH"),
    ("UPDATE t SET a = 1", "DML", False, "HIGH"),
    ("DROP TABLE t", "DDL", False, "HIGH"),
    ("BEGIN NULL; END;", "PLSQL", False, "HIGH"),
    ("SELECT * FROM t FOR UPDATE", "QUERY", False, "MEDIUM"),
    ("SELECT 1 FROM dual; DELETE FROM t", "QUERY", False, "MEDIUM"),
    ("SELECT ';' FROM dual -- ; x", "QUERY", True, "LOW"),
    ("SELECT q'[it's; here]' FROM dual;", "QUERY", True, "LOW"),
    ("SELECT q'!a;'b!' FROM dual", "QUERY", True, "LOW"),
    ("SELECT DBMS_SCHEDULER.x FROM dual", "QUERY", False, "MEDIUM"),
    ("WITH x AS (SELECT 1) DELETE FROM t", "QUERY", False, "MEDIUM"),
    ("CALL p()", "PLSQL", False, "HIGH"),
    ("hello there", None, None, None),
    ("", None, None, None),
])
def test_classification(spark, sql, kind, allowed, risk):
    row = with_classification(spark.createDataFrame([(sql,)], "sql string"), "sql").first()
    assert (row.statement_type, row.allowed, row.risk_level) == (kind, allowed, risk)


def test_classification_of_a_writable_target(spark):
    row = with_classification(spark.createDataFrame([("DELETE FROM t -- x",)], "sql string"), "sql", read_only=False).first()
    assert (row.allowed, row.read_only, row.has_comments, row.risk_level) == (True, False, True, "HIGH")
    with pytest.raises(ValueError):
        with_classification(spark.range(1), "id", read_only=1)


@pytest.mark.parametrize("sql, kind, schema, destructive, data", [
    ("CREATE TABLE t (a int)", "CREATE", True, False, False),
    ("ALTER TABLE t ADD a int", "ALTER", True, False, False),
    ("DROP TABLE t", "DROP", True, True, True),
    ("TRUNCATE t", "TRUNCATE", True, True, True),
    ("INSERT INTO t VALUES (1)", "INSERT", False, False, True),
    ("/* c */ select 1; select 2", "SELECT", False, False, False),
])
def test_local_classification(spark, sql, kind, schema, destructive, data):
    row = with_local_classification(spark.createDataFrame([(sql,)], "sql string"), "sql").first()
    assert (row.statement_type, row.changes_schema, row.destructive, row.changes_data) == (kind, schema, destructive, data)
    assert row.allowed and row.multiple_statements == (";" in sql)


def test_long_quotes_do_not_overflow(spark):
    text = "SELECT '" + "''" * 200_000 + "' || \"" + '""' * 100_000 + "\" FROM t /*" + "*" * 200_000 + "*/ WHERE q'{" + "'" * 100_000 + "}' = 1"
    assert one(spark, text, mask_literals).split() == ["SELECT", "||", "FROM", "t", "WHERE", "=", "1"]


@pytest.mark.parametrize("text, sql", [
    ("Answer:\n```sql\nSELECT 1\n```\nbye", "SELECT 1"),
    ("```\nnothing\n```\n```SQL\nDELETE FROM t```", "DELETE FROM t"),
    ("  select a\nfrom b  ", "select a\nfrom b"),
    ("text\n  WITH a AS (SELECT 1) SELECT 2\n```", "WITH a AS (SELECT 1) SELECT 2"),
    ("selection of words", None),
    (None, None),
])
def test_extract_sql(spark, text, sql):
    assert one(spark, text, extract_sql) == sql


@pytest.mark.parametrize("sql, tables", [
    ("SELECT * FROM hr.a p JOIN b t ON 1 = 1", ["HR.A", "B"]),
    ("SELECT 'FROM x' FROM y -- JOIN z\nJOIN Y ON 1 = 1 /* FROM w */", ["Y"]),
    ("SELECT 1", []),
])
def test_referenced_tables(spark, sql, tables):
    assert one(spark, sql, referenced_tables) == tables


def test_allowlist(spark):
    log = spark.createDataFrame([(1, "SELECT * FROM a.t JOIN u ON 1=1"), (2, "SELECT * FROM x.only JOIN nope ON 1=1"), (3, "SELECT * FROM dup"), (4, "SELECT * FROM A.dup"), (5, "SELECT 1")], "query_id int, sql string")
    allowed = spark.createDataFrame([("A.T",), ("B.U",), ("only",), ("A.DUP",), ("B.DUP",), ("a.t",)], "table_name string")
    report = {r.query_id: (r.valid, r.unknown_tables) for r in check_allowlist(table_references(log), allowed).collect()}
    assert report == {1: (True, []), 2: (False, ["NOPE"]), 3: (False, ["DUP"]), 4: (True, [])}
    whole = {r.query_id: (r.valid, r.referenced_tables) for r in check_allowlist(table_references(log), allowed, log=log).collect()}
    assert whole == {1: (True, 2), 2: (False, 2), 3: (False, 1), 4: (True, 1), 5: (True, 0)}


@pytest.mark.parametrize("text, clean", [
    ("Authorization: Bearer abc.def next", "Authorization: [REDACTED] next"),
    ("api-key = x1, PASSWORD:y; z", "api-key=[REDACTED], PASSWORD=[REDACTED]; z"),
    ("http://h/p?key=v1&access_token=v2", "http://h/p?key=[REDACTED]&access_token=[REDACTED]"),
    ("my_password_x = 1 and étoken = a", "my_password_x = 1 and étoken = a"),
    ("paſſword = a", "paſſword=[REDACTED]"),
    ("nothing", "nothing"),
    (None, None),
])
def test_credentials(spark, text, clean):
    assert one(spark, text, red.redact_text) == clean


def test_service_rules_and_counts(spark):
    text = "token = a; <x:reportBytes>QUJD</x:reportBytes> cookie: c AUTHORIZATION: basic q"
    clean = one(spark, text, lambda c: red.redact_text(c, "service"))
    assert clean == "token=[REDACTED]; <x:reportBytes>[REDACTED]</x:reportBytes> cookie=[REDACTED] AUTHORIZATION: [REDACTED]"
    assert one(spark, text, lambda c: red.count_secrets(c, "service")) == 4
    with pytest.raises(ValueError):
        red.redact_text(F.col("v"), "other")


def test_nested_redaction(spark):
    df = spark.createDataFrame(
        [("s", {"P_B64_CONTENT": "b", "sql": "password=x"}, [{"token": 1, "path": "p"}], None)],
        "db_password string, m map<string,string>, l array<struct<token:int,path:string>>, s struct<a:string>",
    )
    row = red.redact_columns(df).first()
    assert row.db_password == "[REDACTED]" and row.m == {"P_B64_CONTENT": "[REDACTED]", "sql": "password=[REDACTED]"}
    assert row.l[0].asDict() == {"token": "[REDACTED]", "path": "p"} and row.s is None
    assert red.redact_columns(df, text_rules=None).first().m["sql"] == "password=x"


@pytest.mark.parametrize("value, masked", [
    ("ann@example.com, b@x.org", "a***@example.com"), (" @x.org", "****@x.org"), ("nobody", "[MASKED]"), ("", None), (None, None), ("a@b@c", "a***@b@c"),
])
def test_recipients(spark, value, masked):
    assert one(spark, value, red.mask_recipient) == masked


@pytest.mark.parametrize("text, status, retry", [
    ("HTTP 503 service unavailable", None, True), ("HTTP 401 authentication failed", None, False), ("read timed out", None, True),
    ("timeout", 403, False), ("authentication", 500, True), ("protected, timeout", None, False), ("odd", None, False), (None, 429, True), (None, None, False),
])
def test_retry(spark, text, status, retry):
    df = spark.createDataFrame([(text, status)], "t string, s int")
    assert df.select(is_retryable(F.col("t"), F.col("s")).alias("r")).first().r is retry


def test_error_parts(spark):
    text = " x\nora-00942 : table missing password=abc\nmore"
    assert one(spark, text, error_code) == "ORA-00942"
    assert one(spark, text, error_message) == "table missing password=[REDACTED]"
    assert one(spark, "first\nsecond", error_message) == "first"
    assert one(spark, "first", error_code) is None
    assert one(spark, "No element found", is_payload_failure) and one(spark, "X does not exist", is_missing_object)


def test_usage_prefers_new_names(spark):
    bodies = ['{"usage":{"prompt_tokens":3,"input_tokens":9,"completion_tokens":null,"output_tokens":5,"total_tokens":7}}', '{"usage":{"input_tokens":2}}', "{}", "bad"]
    log = spark.createDataFrame([("p", "m", b, 1.5) for b in bodies], "provider string, model string, body string, duration_ms double")
    row = usage_rollup(log).first()
    assert (row.requests, row.input_tokens, row.output_tokens, row.total_tokens, row.duration_ms) == (4, 5, 0, 7, 6.0)


def test_stream_stops_at_done(spark):
    lines = [(1, 1, 'data: {"choices":[{"delta":{"content":"He"}}]}'), (1, 3, "data: [DONE]"), (1, 2, 'data:{"choices":[{"delta":{"content":"y"}}]}'), (1, 4, 'data: {"choices":[{"delta":{"content":"!"}}]}'), (1, 0, "event: x"), (2, 1, 'data: {"choices":[{"delta":{}}]}')]
    got = assemble_stream(spark.createDataFrame(lines, "response_id int, seq int, line string"))
    assert {r.response_id: (r.text, r.pieces) for r in got.collect()} == {1: ("Hey", 2), 2: ("", 0)}
