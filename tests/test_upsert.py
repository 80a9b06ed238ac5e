import pytest
from pyspark.sql import functions as F

from extractkit.errors import ConcurrentCommitError, DuplicateKeyError, MissingKeyError, SchemaMismatchError, ToolkitError
from extractkit.operators.upsert import delete_where, latest_per_key, source_matches, update_where, upsert, upsert_outcomes
from extractkit.plans.sync import copy_table, sync_query
from extractkit.sinks.tables import ManagedTables

SCHEMA = "id string, v string"
TARGET = [("1", "a"), ("1", "b"), (None, "n"), ("7", "k")]
SOURCE = [("1", "X"), (None, "M"), ("2", "P"), ("2", "Q"), ("7", None)]
MERGED = [("1", "X"), ("1", "X"), ("2", "P"), ("2", "Q"), ("7", None), (None, "M"), (None, "n")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def tables(spark, tmp_path):
    return ManagedTables(spark, str(tmp_path / "tables"))


def test_upsert_edge_cases(spark):
    assert rows(upsert(frame(spark, TARGET), frame(spark, SOURCE), "id")) == sorted(MERGED, key=repr)


def test_table_upsert_edge_cases(spark, tables):
    tables.create("t", frame(spark, TARGET))
    tables.upsert("t", frame(spark, SOURCE).select("v", "id"), "id")
    assert rows(tables.read("t")) == sorted(MERGED, key=repr)
    assert rows(tables.read("t", 1)) == sorted(TARGET, key=repr)


def test_upsert_refusals(spark, tables):
    target = frame(spark, TARGET)
    with pytest.raises(DuplicateKeyError):
        upsert(target, frame(spark, [("1", "x"), ("1", "y")]), "id")
    with pytest.raises(MissingKeyError):
        upsert(target, frame(spark, SOURCE), "nope")
    with pytest.raises(SchemaMismatchError, match="other"):
        upsert(target, frame(spark, [("1", "x")], "id string, other string"), "id")
    tables.create("t", target)
    with pytest.raises(DuplicateKeyError):
        tables.upsert("t", frame(spark, [("1", "x"), ("1", "y")]), "id")
    assert tables.version("t").number == 1


def test_outcomes_equal_what_the_upsert_does(spark):
    target, source = frame(spark, TARGET), frame(spark, SOURCE)
    assert upsert_outcomes(target, source, "id").first().asDict() == {"updated": 3, "kept": 1, "inserted": 3, "ambiguous": 0}
    assert upsert(target, source, "id").count() == 7
    twice = frame(spark, [("1", "x"), ("1", "y"), ("2", "z")])
    assert upsert_outcomes(target, twice, "id").first().asDict() == {"updated": 2, "kept": 2, "inserted": 1, "ambiguous": 1}
    assert upsert_outcomes(frame(spark, []), frame(spark, []), "id").first().asDict() == {"updated": 0, "kept": 0, "inserted": 0, "ambiguous": 0}
    pairs = "id string, line int, v string"  # a key of two columns, NULL in one of them
    left, right = frame(spark, [("1", 1, "a"), ("1", None, "b")], pairs), frame(spark, [("1", 1, "A"), ("1", None, "B")], pairs)
    assert rows(upsert(left, right, ["id", "line"])) == sorted([("1", 1, "A"), ("1", None, "B"), ("1", None, "b")], key=repr)
    assert upsert_outcomes(left, right, ["id", "line"]).first().asDict() == {"updated": 1, "kept": 1, "inserted": 1, "ambiguous": 0}


def test_frequent_keys_are_counted_before_they_meet(spark):
    """10,000 target and 10,000 source rows of one key are one row of matches; the target's other columns are not read for it."""
    target = spark.range(10_000).select(F.lit("1").alias("id"), F.col("id").cast("string").alias("v"))
    found = source_matches(target, target, "id")
    assert rows(found) == [("1", 10_000, 10_000)]
    assert "AS v#" not in found._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(DuplicateKeyError):
        upsert(target, target, "id")


def test_empty_source_and_key_only_table(spark, tables):
    tables.create("t", frame(spark, TARGET))
    assert tables.upsert("t", frame(spark, []), "id").number == 1
    keys = frame(spark, [("1",), ("2",)], "id string")
    assert rows(upsert(keys, frame(spark, [("2",), ("3",)], "id string"), "id")) == [("1",), ("2",), ("3",)]


def test_absent_target_is_created_without_dedupe(spark, tables):
    tables.upsert("t", frame(spark, [("1", "a"), ("1", "b")]), "id")
    assert rows(tables.read("t")) == [("1", "a"), ("1", "b")]


def test_latest_and_newer_than(spark):
    schema = "id int, at int, v string"
    source = frame(spark, [(1, 5, "new"), (1, 4, "mid"), (None, 1, "x"), (None, 1, "x")], schema)
    assert rows(latest_per_key(source, "id", "at")) == [(1, 5, "new"), (None, 1, "x"), (None, 1, "x")]
    target = frame(spark, [(1, 9, "kept"), (2, 1, "old")], schema)
    late = frame(spark, [(1, 3, "late"), (2, 2, "fresh")], schema)
    assert rows(upsert(target, late, "id", newer_than="at")) == [(1, 9, "kept"), (2, 2, "fresh")]
    assert rows(upsert(target, late, "id")) == [(1, 3, "late"), (2, 2, "fresh")]


def test_only_touched_files_are_rewritten(spark, tables):
    tables.create("t", spark.range(0, 1000, 1, 8).select("id", F.lit("a").alias("v")))
    before = set(tables.version("t").files)
    tables.upsert("t", frame(spark, [(3, "b"), (5000, "c")], "id bigint, v string"), "id")
    assert len(before & set(tables.version("t").files)) == 7
    tables.update("t", {"v": "'z'"}, "id = 999")
    tables.delete("t", "id = 999")
    assert len(before & set(tables.version("t").files)) == 6
    assert tables.read("t").count() == 1000
    tables.append("t", tables.read("t"))
    assert tables.read("t").count() == 2000


def test_failed_write_keeps_the_table(spark, tables):
    tables.create("t", frame(spark, TARGET))
    with pytest.raises(Exception):
        tables.update("t", {"v": "raise_error('no')"}, "id = '1'")
    assert rows(tables.read("t")) == sorted(TARGET, key=repr)


def test_second_writer_of_a_version_fails(spark, tables):
    tables.create("t", frame(spark, TARGET))
    current = tables.version("t")
    tables.append("t", frame(spark, [("8", "x")]))
    with pytest.raises(ConcurrentCommitError):
        tables._publish("t", current.number, "append", current.columns, current.files)


def test_batches_are_applied_once(spark, tables):
    tables.create("t", frame(spark, TARGET))
    for _ in range(2):
        tables.append("t", frame(spark, [("8", "x")]), batch=("s", 0))
        tables.upsert("t", frame(spark, [(None, "y")]), "id", batch=("s", 1))
    assert tables.read("t").count() == len(TARGET) + 2


def test_conditions_with_null(spark):
    df = frame(spark, [("1", "a"), ("2", None)])
    assert rows(delete_where(df, "v = 'a'")) == [("2", None)]
    assert rows(delete_where(df)) == []
    assert rows(update_where(df, {"V": "'z'"}, "v <> 'b'")) == [("1", "z"), ("2", None)]
    with pytest.raises(ValueError):
        update_where(df, {"w": "1"})


def test_drop_and_recreate(spark, tables):
    tables.create("t", frame(spark, TARGET))
    with pytest.raises(ToolkitError):
        tables.create("t", frame(spark, TARGET))
    tables.drop("t")
    assert not tables.exists("t") and tables.names() == []
    tables.create("t", frame(spark, SOURCE))
    assert tables.read("t").count() == len(SOURCE)


def test_sync_rules(spark, tables):
    source = frame(spark, [("1", "a"), ("2", "b")])
    with pytest.raises(ValueError):
        sync_query(tables, source, "t")
    result = sync_query(tables, source, "t", replace_target=True)
    assert (result.source_rows, result.target_rows, result.row_count_matches) == (2, 2, True)
    result = sync_query(tables, frame(spark, [("2", "c")]), "t", primary_key="id")
    assert (result.source_rows, result.target_rows, result.row_count_matches) == (1, 2, False)
    with pytest.raises(ValueError):
        sync_query(tables, source, "bad name", replace_target=True)


def test_copy_table_uses_a_row_key(spark, tables, tmp_path):
    spark.range(20).select("id", F.current_timestamp().alias("LAST_UPDATE_DATE")).write.parquet(str(tmp_path / "src"))
    source = spark.read.parquet(str(tmp_path / "src"))
    copy_table(tables, source, "t", since="2020-01-01", extra="id < 10 OR id = 15")
    copy_table(tables, source, "t", since="2020-01-01", extra="id < 12", replace_target=False)
    assert tables.read("t").count() == 13
    assert tables.read("t").columns[0] == "SOURCE_ROWID"
    with pytest.raises(ValueError):
        copy_table(tables, source, "t", extra="1 = 1; DROP TABLE t")
    with pytest.raises(ValueError):
        copy_table(tables, source, "t", since="not a date")
    with pytest.raises(MissingKeyError):
        copy_table(tables, frame(spark, TARGET), "t")
