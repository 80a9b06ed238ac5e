import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from extractkit.errors import DuplicateKeyError
from extractkit.operators import paging
from extractkit.operators.filters import incremental
from extractkit.operators.paging import (
    into_chunks,
    number_rows,
    order_keys,
    page,
    plan_chunks,
    require_unique_order,
    row_cap,
    sample_buckets,
)


@pytest.mark.parametrize("total, options, size, chunks", [
    (600_000, {"chunk_size": 10_000}, 10_000, 60),
    (600_000, {"chunk_size": 10_000, "max_rows": 10_000}, 10_000, 1),
    (200_000, {"chunk_size": 10_000}, 10_000, 20),
    (9, {"chunk_size": 2}, 2, 5),
    (9, {"chunk_size": 100, "max_file_rows": 3}, 3, 3),
    (0, {"chunk_size": 10}, 10, 0),
])
def test_plan_sizes(total, options, size, chunks):
    plan = plan_chunks(total, **options)
    assert (plan.chunk_size, plan.total_chunks) == (size, chunks)


@pytest.mark.parametrize("bad", [{"chunk_size": 0}, {"chunk_size": True}, {"max_rows": 0}, {"start_offset": -1}, {"max_file_rows": 0}])
def test_plan_refuses(bad):
    with pytest.raises(ValueError):
        plan_chunks(10, **bad)


def test_page_arguments(spark):
    df = spark.range(10)
    assert [r.id for r in page(df, "id desc", 2, 3).collect()] == [7, 6, 5]
    for offset, limit in ((-1, 1), (0, 0), (True, 1), (0, True)):
        with pytest.raises(ValueError):
            page(df, "id", offset, limit)
    with pytest.raises(ValueError):
        page(df, "", 0, 1)
    with pytest.raises(ValueError):
        page(df, "id sideways", 0, 1)
    assert row_cap(df, 4, "id").count() == 4


def test_deep_page(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") * 7 % 501).alias("k"))
    shallow = [r.k for r in page(df, "k desc", 333, 50).collect()]
    monkeypatch.setattr(paging, "SHALLOW_ROWS", 10)
    deep = page(df, "k desc", 333, 50)
    assert [r.k for r in deep.collect()] == shallow and deep.columns == ["k"]


def test_pages_of_ties_are_whole_across_both_plans(spark, monkeypatch):
    df = spark.range(400).select(F.col("id"), (F.col("id") % 3).alias("k"))
    monkeypatch.setattr(paging, "SHALLOW_ROWS", 150)
    monkeypatch.setattr(paging, "bucket_count", lambda total, cores: 8)
    pages = [r.id for start in range(0, 400, 50) for r in page(df, "k", start, 50).collect()]
    assert sorted(pages) == list(range(400))


def test_change_bound_keeps_microseconds_and_odd_text_fails(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.2",), ("2024-01-01 00:00:00.5",), (None,)], "at string")
    assert [r.at for r in incremental(df, "2024-01-01T00:00:00.5Z", "at").collect()] == ["2024-01-01 00:00:00.5"]
    assert incremental(df.selectExpr("CAST(at AS timestamp) AS at"), "2024-01-01 00:00:00.5", "at").count() == 1
    with pytest.raises(Exception, match="no timestamp"):
        incremental(df.unionByName(spark.createDataFrame([("02-JAN-2024",)], "at string")), "2024-01-01", "at").collect()


def test_cap_is_the_smaller_limit(spark):
    assert row_cap(spark.range(100).limit(50), 10).count() == 10
    assert row_cap(spark.range(100).limit(5), 10).count() == 5


def _expected(rows, keys):
    """Row order by a plain sort; NULL is the largest value."""
    for key in reversed(keys):
        i = int(key.name[1:])
        rows = sorted(rows, key=lambda r: (r[i] is None, r[i] or 0), reverse=key.descending)
    return rows


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.integers(-50, 50))), max_size=60),
    st.booleans(), st.booleans(), st.integers(1, 9),
)
def test_row_numbers_follow_the_order(spark, rows, first_down, second_down, buckets):
    keys = order_keys([f"c0 {'desc' if first_down else 'asc'}", f"c1 {'desc' if second_down else 'asc'}"])
    df = spark.createDataFrame(rows, "c0 int, c1 int")
    got = number_rows(df, keys, buckets=buckets).collect()
    assert sorted(r.row_no for r in got) == list(range(len(rows)))
    in_order = [(r.c0, r.c1) for r in sorted(got, key=lambda r: r.row_no)]
    assert in_order == _expected(rows, keys)


@pytest.mark.parametrize("kind, values", [
    ("string", ["b'\\x", "a", None, "é", "a b", ""]),
    ("double", [1.5, float("nan"), -2.0, None, 0.0, float("inf")]),
    ("decimal(10,2)", ["1.10", "-3.00", None, "2.50", "0.00", "9.99"]),
    ("date", ["2024-01-02", "1999-12-31", None, "2024-01-01", "1960-05-05", "2100-01-01"]),
    ("timestamp", ["2024-01-02 01:02:03.5", "1999-12-31", None, "2024-01-01", "1960-05-05", "2100-01-01"]),
    ("timestamp_ntz", ["2024-01-02 01:02:03.5", "1999-12-31", None, "2024-01-01", "1960-05-05", "2100-01-01"]),
    ("boolean", [True, False, None, True, False, None]),
    ("binary", ["b", "a", None, "c", "ab", ""]),
])
def test_row_numbers_of_every_type(spark, kind, values):
    df = spark.createDataFrame([(None if v is None else str(v), i) for i, v in enumerate(values)], "v string, i int")
    df = df.select(F.col("v").cast(kind).alias("v"), "i")
    got = [r.i for r in number_rows(df, "v, i", buckets=5).orderBy("row_no").collect()]
    assert got == [r.i for r in df.orderBy(F.col("v").asc_nulls_last(), "i").collect()]


def test_frequent_key_and_equal_rows(spark):
    """One row value holds most rows: numbers stay complete and its rows leave one task."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.lit("x").alias("v"))
    edges = sample_buckets(df, "k", 8, 30_000)
    assert any(edges.frequent)
    got = number_rows(df, "k", buckets=8)
    span = got.agg(F.count_distinct("row_no"), F.min("row_no"), F.max("row_no")).first()
    assert tuple(span) == (30_000, 0, 29_999)
    hot = got.where("k = -1").agg(F.min("row_no"), F.max("row_no"), F.count("*")).first()
    assert tuple(hot) == (0, 19_999, 20_000)


def test_many_boundaries_use_the_same_buckets(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_003).alias("k"))
    wrong = number_rows(df, "k desc", buckets=200).select(
        (F.col("row_no") != F.count("k").over(Window.orderBy(F.col("k").desc())) - 1).alias("bad")
    )
    assert wrong.where("bad").count() == 0


def test_row_numbers_repeat(spark):
    df = spark.range(9_000).select((F.col("id") * 31 % 9_001).alias("k"), (F.col("id") % 7).alias("v"))
    one = number_rows(df, "v", buckets=8, break_ties=True)
    two = number_rows(df.repartition(5), "v", buckets=8, break_ties=True)
    assert one.exceptAll(two).count() == 0


def test_no_single_partition_exchange(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/orders.parquet")
    plan = number_rows(df, "o_orderkey", buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    plan = into_chunks(df, "o_orderkey", plan_chunks(150_000, 1_000))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("n, size, start, cap", [(0, 3, 0, None), (1, 3, 0, None), (9, 3, 0, None), (10, 3, 0, None), (100, 7, 5, 40), (100, 7, 98, 40)])
def test_chunks_hold_the_planned_rows(spark, n, size, start, cap):
    df = spark.range(n).select((F.col("id") * 37 % 101).alias("k"))
    plan = plan_chunks(n, size, start_offset=start, max_rows=cap)
    rows = sorted((r.chunk_id, r._row_no, r.k) for r in into_chunks(df, "k", plan).collect())
    keys = sorted(i * 37 % 101 for i in range(n))[start:][: cap or n]
    assert rows == [(i // size, start + i, k) for i, k in enumerate(keys)]


def test_chunks_with_ties(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_chunks(100, 8)
    rows = into_chunks(df, "k", plan).collect()
    assert sorted(r._row_no for r in rows) == list(range(100))
    ordered = [r.k for r in sorted(rows, key=lambda r: r._row_no)]
    assert ordered == sorted(ordered)
    sizes = [len(list(g)) for _, g in itertools.groupby(sorted(r.chunk_id for r in rows))]
    assert sizes == [8] * 12 + [4]


def test_unique_order_guard(spark):
    require_unique_order(spark.range(5), "id")
    with pytest.raises(DuplicateKeyError):
        require_unique_order(spark.range(5).select(F.lit(1).alias("k")), "k")


@pytest.mark.parametrize("key", ["k desc", "k", "v, k desc"])
@pytest.mark.parametrize("n", [1, 137, 500, 999, 1000, 5000])
def test_a_deep_cap_equals_a_sort(spark, monkeypatch, key, n):
    monkeypatch.setattr(paging, "bucket_count", lambda total, cores: 6)
    data = [(None if i % 50 == 0 else i * 37 % 101, "same" if i % 3 else f"v{i % 7}") for i in range(1000)]
    df = spark.createDataFrame(data, "k int, v string").repartition(5)
    wanted = df.orderBy(*paging.sort_columns(key)).limit(n).select(*[k.name for k in paging.order_keys(key)]).collect()
    assert row_cap(df, n, key, shallow=0).select(*[k.name for k in paging.order_keys(key)]).collect() == wanted
    free = row_cap(df, n, shallow=0)
    assert free.count() == min(n, 1000) and free.exceptAll(df).isEmpty()


def test_a_deep_cap_has_no_task_for_all_rows(spark):
    df = spark.range(300_000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("v"))
    for capped in (row_cap(df, 200_000, "k", shallow=1000), row_cap(df, 200_000, shallow=1000)):
        plan = capped._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "GlobalLimit" not in plan


def test_seams_of_many_chunks(spark, monkeypatch):
    """Sums of neighbouring chunks, put together three at a time."""
    from extractkit.operators import checks

    monkeypatch.setattr(checks, "SEGMENTS_AT_ONCE", 3)
    values = [i * 31 % 17 for i in range(26)]
    df = spark.createDataFrame([(i, i // 2, v) for i, v in enumerate(values)], "row_no long, chunk_id long, k int")
    found = checks.validate_extract(df, "k").first()
    steps = list(itertools.pairwise(values))
    assert found.order_violations == sum(a > b for a, b in steps) and found.adjacent_duplicates == sum(a == b for a, b in steps)
    assert (found.rows, found.chunks, found.duplicate_keys) == (26, 13, sum(values.count(v) > 1 for v in set(values)))


def test_copies_of_a_frequent_key_are_laid_out_by_many_tasks(spark):
    rows = spark.range(400_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 3).alias("v"))
    numbered = number_rows(rows, "k", buckets=8)
    held = numbered.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count"), F.sum("count")).first()
    assert held[1] == 400_000 and held[0] < 250_000  # one task held all of them
    assert numbered.agg(F.count_distinct("row_no")).first()[0] == 400_000
