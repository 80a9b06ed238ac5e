"""Upserts, syncs, managed-table changes and differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from extractkit.operators import checks, upsert as up
from extractkit.plans.sync import copy_table, sync_query
from extractkit.session import scratch_path
from extractkit.streaming.copies import read_folder_stream, stream_upsert

from .common import library, load, tables

QUERIES = {}


def query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = (function, sql)
        return function

    return keep


# Orders of status F come with a new price and no priority; orders of status P
# come as new keys.
_CHANGES = """
    SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey + 100000000, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'P'
"""
_UPSERTED = f"""
    WITH changes AS ({_CHANGES})
    SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)
    UNION ALL SELECT * FROM changes
"""


def _orders_and_changes(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    changed = orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderpriority")
    )
    added = orders.where("o_orderstatus = 'P'").select(
        (F.col("o_orderkey") + 100000000).alias("o_orderkey"), "o_totalprice", "o_orderpriority"
    )
    return orders.drop("o_orderstatus"), changed.unionByName(added)


@query(_UPSERTED)
def upsert_orders(spark, folder):
    target, source = _orders_and_changes(spark, folder)
    return up.upsert(target, source, "o_orderkey")


@query(_UPSERTED)
def upsert_table(spark, folder):
    """The same upsert into a managed table; only touched files are rewritten."""
    target, source = _orders_and_changes(spark, folder)
    store = tables(spark)
    sync_query(store, target, "orders_copy", replace_target=True, all_varchar=False)
    sync_query(store, source, "orders_copy", primary_key="o_orderkey", all_varchar=False)
    return store.read("orders_copy")


@query(
    """
    WITH target AS (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS id, c_name FROM customer),
    source AS (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS id, 'new ' || c_name AS c_name
               FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
    SELECT t.id, t.c_name FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.id = t.id)
    UNION ALL SELECT s.id, s.c_name FROM source s
    """
)
def upsert_null_keys(spark, folder):
    """Rows with a NULL key never match: old ones stay and new ones are added."""
    customer = load(spark, folder, "customer")
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("id")
    target = customer.select(key, "c_name")
    changed = customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    source = changed.select(key, F.concat(F.lit("new "), "c_name").alias("c_name"))
    return up.upsert(target, source, "id")


@query(
    """
    SELECT l_orderkey, 'seen' AS note, CAST(count(*) AS BIGINT) AS row_count FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY l_orderkey
    UNION ALL
    SELECT l_orderkey, 'kept', CAST(count(*) AS BIGINT) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY l_orderkey
    UNION ALL
    SELECT o_orderkey, 'seen', CAST(1 AS BIGINT) FROM orders
    WHERE o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """
)
def upsert_duplicate_targets(spark, folder):
    """Every target row of a matched key is overwritten."""
    target = load(spark, folder, "lineitem").select("l_orderkey", F.lit("kept").alias("note"))
    source = load(spark, folder, "orders").where("o_orderstatus = 'O'")
    source = source.select(F.col("o_orderkey").alias("l_orderkey"), F.lit("seen").alias("note"))
    merged = up.upsert(target, source, "l_orderkey")
    return merged.groupBy("l_orderkey", "note").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    WITH source AS (
      SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'O'
      UNION ALL SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT o_orderkey + 100000000 FROM orders WHERE o_orderstatus = 'P'
      UNION ALL SELECT CAST(NULL AS BIGINT) FROM orders WHERE o_orderstatus = 'P'),
    target AS (SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS k FROM lineitem)
    SELECT CAST((SELECT count(*) FROM target WHERE k IN (SELECT k FROM source WHERE k IS NOT NULL)) AS BIGINT) AS updated,
      CAST((SELECT count(*) FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.k = t.k)) AS BIGINT) AS kept,
      CAST((SELECT count(*) FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE s.k = t.k)) AS BIGINT) AS inserted,
      CAST((SELECT count(*) FROM (SELECT k FROM source WHERE k IN (SELECT k FROM target WHERE k IS NOT NULL) GROUP BY k HAVING count(*) > 1)) AS BIGINT) AS ambiguous
    """
)
def upsert_outcomes(spark, folder):
    """How many rows an upsert would update, keep and insert, and the keys it would be refused for."""
    orders = load(spark, folder, "orders")
    pending = orders.where("o_orderstatus = 'P'")
    sources = [
        orders.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("k")),
        orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("k")),
        pending.select((F.col("o_orderkey") + 100000000).alias("k")),
        pending.select(F.lit(None).cast("long").alias("k")),
    ]
    target = load(spark, folder, "lineitem").select(F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("k"))
    return up.upsert_outcomes(target, reduce(lambda a, b: a.unionByName(b), sources), "k")


_LATEST = """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events) WHERE place = 1
"""


@query(_LATEST)
def upsert_latest(spark, folder):
    """Many source rows per key; the newest wins."""
    events = load(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    target = up.latest_per_key(events.where("event_type = 'view'"), "user_id", "event_id")
    return up.upsert(target, events, "user_id", on_duplicate="latest", order_col="event_id")


@query(_LATEST)
def stream_upsert_events(spark, folder):
    """The same through a file stream of several micro-batches."""
    events = load(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    base = scratch_path(spark, "stream")
    events.repartition(6, "event_id").write.parquet(f"{base}/in")
    store = tables(spark)
    stream = read_folder_stream(spark, f"{base}/in", events.schema, max_files=2)
    running = stream_upsert(
        stream, store, "latest_events", "user_id", f"{base}/checkpoint",
        stream_name="events", order_col="event_id", newer_than="event_id",
    )
    running.awaitTermination()
    return store.read("latest_events")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sync_replace(spark, folder):
    """Full refresh, then appended parts."""
    customer = load(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    store = tables(spark)
    sync_query(store, customer, "customers", replace_target=True, all_varchar=False)
    sync_query(store, customer.where("c_mktsegment = 'BUILDING'"), "customers", replace_target=True, all_varchar=False)
    store.append("customers", customer.where("c_mktsegment <> 'BUILDING'"))
    return store.read("customers")


@query(
    """
    SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) AS BIGINT) AS row_keys FROM orders
    WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' AND (o_totalprice > 1000) GROUP BY o_orderstatus
    """
)
def copy_table_rowkey(spark, folder):
    """A keyless table copied twice by its row key: the second copy changes nothing."""
    orders = load(spark, folder, "orders")
    store = tables(spark)
    filters = {"since": "2000-01-01", "change_column": "o_orderdate", "extra": "o_totalprice > 1000"}
    copy_table(store, orders, "copied", **filters)
    copy_table(store, orders, "copied", replace_target=False, **filters)
    counted = store.read("copied").groupBy("o_orderstatus")
    return counted.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("SOURCE_ROWID").alias("row_keys"))


# --- managed tables by SQL -------------------------------------------------------------


_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _materialized(spark, folder):
    lib = library(spark, folder)
    lib.materialize("customer", "customers")
    return lib


@query(_CUSTOMER)
def materialize_customer(spark, folder):
    return _materialized(spark, folder).query("SELECT * FROM customers")


@query(f"{_CUSTOMER} UNION ALL SELECT s_suppkey + 1000000000, s_name, NULL, s_acctbal, NULL FROM supplier")
def dml_insert(spark, folder):
    lib = _materialized(spark, folder)
    lib.execute(
        "INSERT INTO customers (c_custkey, c_name, c_acctbal) SELECT s_suppkey + 1000000000, s_name, s_acctbal FROM supplier"
    )
    return lib.query("SELECT * FROM customers")


@query(
    """
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 1000 THEN 0 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_acctbal < 1000 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment FROM customer
    """
)
def dml_update(spark, folder):
    lib = _materialized(spark, folder)
    lib.execute("UPDATE customers SET c_acctbal = 0, c_mktsegment = lower(c_mktsegment) WHERE c_acctbal < ?", [1000])
    return lib.query("SELECT * FROM customers")


@query(f"{_CUSTOMER} WHERE NOT (c_mktsegment = 'BUILDING' AND c_acctbal > 500)")
def dml_delete(spark, folder):
    lib = _materialized(spark, folder)
    lib.execute("DELETE FROM customers WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 500")
    return lib.query("SELECT * FROM customers")


@query(
    """
    WITH spent AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY o_custkey)
    SELECT c.c_custkey, CASE WHEN s.o_custkey IS NULL THEN c.c_name ELSE 'buyer ' || c.c_name END AS c_name,
           CASE WHEN s.o_custkey IS NULL THEN c.c_acctbal ELSE s.total END AS c_acctbal
    FROM customer c LEFT JOIN spent s ON s.o_custkey = c.c_custkey
    WHERE s.o_custkey IS NULL OR s.total <= 2000000
    UNION ALL
    SELECT -1 - s.s_suppkey, s.s_name, s.s_acctbal FROM supplier s
    """
)
def dml_merge(spark, folder):
    lib = _materialized(spark, folder)
    lib.execute(
        """
        MERGE INTO customers AS t
        USING (SELECT o_custkey AS id, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total, '' AS name
               FROM orders GROUP BY o_custkey
               UNION ALL SELECT -1 - s_suppkey, s_acctbal, s_name FROM supplier) AS s
        ON t.c_custkey = s.id
        WHEN MATCHED AND s.total > 2000000 THEN DELETE
        WHEN MATCHED THEN UPDATE SET c_acctbal = s.total, c_name = 'buyer ' || t.c_name
        WHEN NOT MATCHED THEN INSERT (c_custkey, c_name, c_acctbal) VALUES (s.id, s.name, s.total)
        """
    )
    return lib.query("SELECT c_custkey, c_name, c_acctbal FROM customers")


@query("SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'high' END AS band FROM customer")
def dml_alter(spark, folder):
    lib = _materialized(spark, folder)
    lib.execute("ALTER TABLE customers ADD COLUMN tier STRING")
    lib.execute("UPDATE customers SET tier = 'high' WHERE c_acctbal > 5000")
    lib.execute("ALTER TABLE customers RENAME COLUMN tier TO band")
    lib.execute("ALTER TABLE customers DROP COLUMN c_name")
    return lib.query("SELECT c_custkey, band FROM customers")


@query("SELECT 'truncated' AS state, CAST(0 AS BIGINT) AS row_count UNION ALL SELECT 'before', CAST(count(*) AS BIGINT) FROM customer")
def dml_truncate(spark, folder):
    lib = _materialized(spark, folder)
    before = lib.tables.read("customers").agg(F.lit("before").alias("state"), F.count(F.lit(1)).alias("row_count"))
    lib.execute("TRUNCATE TABLE customers")
    after = lib.query("SELECT 'truncated' AS state, count(*) AS row_count FROM customers")
    return after.unionByName(before)


# --- differences ------------------------------------------------------------------------


@query(
    """
    SELECT o_orderkey, o_totalprice, 'only_left' AS side, CAST(1 AS BIGINT) AS copies FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_totalprice + 1, 'only_right', CAST(1 AS BIGINT) FROM orders WHERE o_orderstatus = 'F'
    """
)
def dataset_diff(spark, folder):
    orders = load(spark, folder, "orders")
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    left = orders.select("o_orderkey", "o_totalprice")
    return checks.dataset_diff(left, orders.select("o_orderkey", price.alias("o_totalprice")))


@query(
    """
    SELECT l_returnflag, l_linestatus, CASE WHEN n > 0 THEN 'only_left' ELSE 'only_right' END AS side, abs(n) AS copies
    FROM (SELECT l_returnflag, l_linestatus,
                 CAST(count(*) FILTER (WHERE l_quantity < 25) AS BIGINT) - CAST(count(*) FILTER (WHERE l_quantity >= 25) AS BIGINT) AS n
          FROM lineitem GROUP BY l_returnflag, l_linestatus) WHERE n <> 0
    """
)
def dataset_diff_copies(spark, folder):
    """A few row values with very many copies on both sides."""
    rows = load(spark, folder, "lineitem")
    left = rows.where("l_quantity < 25").select("l_returnflag", "l_linestatus")
    right = rows.where("l_quantity >= 25").select("l_returnflag", "l_linestatus")
    return checks.dataset_diff(left, right)


@query(
    """
    SELECT c_custkey AS custkey, 'only_left' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
    UNION ALL
    SELECT DISTINCT o_custkey, 'only_right' FROM orders WHERE o_totalprice > 450000 AND o_custkey NOT IN (SELECT c_custkey FROM customer)
    """
)
def key_diff(spark, folder):
    left = load(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"))
    right = load(spark, folder, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("custkey"))
    return checks.key_diff(left, right, "custkey")
