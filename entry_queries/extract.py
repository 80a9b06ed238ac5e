"""Scans, filters, pages, chunks, checks and publication."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.errors import FingerprintError
from extractkit.operators import checks, filters, paging, profile, sketches
from extractkit.session import scratch_path
from extractkit.sinks.delimited import csv_options, write_single_csv
from extractkit.sinks.filesystem import Files
from extractkit.sinks.parts import compare_parts, manifest_parts, part_columns, part_hashes, read_manifest, read_parts, write_parts
from extractkit.sources.delimited import read_delimited
from extractkit.streaming.copies import read_folder_stream, stream_parts

from .common import TABLES, library, load

QUERIES = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that states its result."""

    def keep(function):
        QUERIES[function.__name__] = (function, sql)
        return function

    return keep


# --- library --------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def scan_orders(spark, folder):
    return load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in TABLES))
def lib_count_all(spark, folder):
    lib = library(spark, folder)
    counts = [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM `{t}`" for t in TABLES]
    return lib.query(" UNION ALL ".join(counts))


@query(
    """
    SELECT c.c_custkey, c.c_name, CAST(count(DISTINCT o.o_orderkey) AS BIGINT) AS order_count,
           CAST(sum(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
    FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    GROUP BY c.c_custkey, c.c_name
    """
)
def lib_revenue_by_customer(spark, folder):
    return library(spark, folder).query(
        """
        SELECT c.c_custkey, c.c_name, count(DISTINCT o.o_orderkey) AS order_count,
               CAST(sum(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
        FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        GROUP BY c.c_custkey, c.c_name ORDER BY revenue DESC
        """
    )


@query(
    """
    SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS orders FROM orders
    WHERE o_totalprice >= 250000 AND o_orderstatus <> 'P' GROUP BY o_orderpriority
    """
)
def lib_query_parameters(spark, folder):
    return library(spark, folder).query(
        "SELECT o_orderpriority, count(*) AS orders FROM orders "
        "WHERE o_totalprice >= ? AND o_orderstatus <> ? GROUP BY o_orderpriority",
        [250000, "P"],
    )


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, '{t}.parquet' AS relative_path, 'parquet' AS file_type, true AS readable" for t in TABLES))
def lib_files(spark, folder):
    files = library(spark, folder).query("SELECT table_name, relative_path, file_type, readable FROM library_files")
    return files.where(F.col("table_name").isin(*TABLES))


@query(
    """
    SELECT column_name AS col_name FROM (DESCRIBE orders)
    """
)
def lib_describe(spark, folder):
    return library(spark, folder).describe_table("orders").select("col_name")


@query("SELECT 'orders' AS table_name, least(100, CAST(count(*) AS BIGINT)) AS preview_rows FROM orders")
def lib_preview(spark, folder):
    rows = library(spark, folder).preview("orders", 100)
    return rows.agg(F.lit("orders").alias("table_name"), F.count(F.lit(1)).alias("preview_rows")).select(
        "table_name", "preview_rows"
    )


# --- projections and filters ------------------------------------------------------


@query(
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
    "CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"
)
def all_string_orders(spark, folder):
    return filters.all_string(load(spark, folder, "orders"))


@query(
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND (o_orderstatus = 'F' OR o_totalprice > 300000)
    """
)
def incremental_orders(spark, folder):
    rows = filters.incremental(
        load(spark, folder, "orders"), "1998-01-01", "o_orderdate", "o_orderstatus = 'F' OR o_totalprice > 300000"
    )
    return rows.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query("SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) AS BIGINT) AS distinct_keys FROM lineitem")
def rowkey_unique(spark, folder):
    keyed = filters.with_row_key(load(spark, folder, "lineitem"))
    counted = keyed.groupBy("SOURCE_ROWID").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_keys"))


# --- pages and chunks -----------------------------------------------------------------


@query(
    """
    SELECT 'ordered' AS kind, CAST(count(*) AS BIGINT) AS row_count FROM (SELECT * FROM orders ORDER BY o_orderdate)
    UNION ALL
    SELECT 'limited', CAST(count(*) AS BIGINT) FROM (SELECT * FROM orders ORDER BY o_orderdate LIMIT 5000)
    """
)
def count_query(spark, folder):
    ordered = load(spark, folder, "orders").orderBy("o_orderdate")
    whole = paging.count_query(ordered).withColumn("kind", F.lit("ordered"))
    limited = paging.count_query(ordered.limit(5000)).withColumn("kind", F.lit("limited"))
    return whole.unionByName(limited).select("kind", "row_count")


@query(
    """
    SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
    ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey NULLS LAST LIMIT 500 OFFSET 1000
    """
)
def page_orders(spark, folder):
    rows = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return paging.page(rows, "o_totalprice desc, o_orderkey", 1000, 500)


@query("SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders FROM orders")
def page_through_ties(spark, folder):
    """All pages of an order with few distinct values hold every order once."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    size = max(1, orders.count() // 4)
    # The first two pages are top-k queries, the later ones are cut out of numbered rows.
    pages = [paging.page(orders, "o_orderstatus", start, size, shallow=2 * size) for start in range(0, 5 * size, size)]
    return reduce(DataFrame.unionByName, pages).agg(F.count("*").alias("rows"), F.countDistinct("o_orderkey").alias("orders"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_orders(spark, folder):
    rows = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return paging.row_cap(rows, 100, "o_totalprice desc, o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= (SELECT count(*) FROM orders) * 2 // 3")
def top_orders_deep(spark, folder):
    """Two thirds of all rows, the first by price: cut at a boundary range, without one task for all of them."""
    rows = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return paging.row_cap(rows, rows.count() * 2 // 3, "o_totalprice desc, o_orderkey", shallow=1000)


@query("SELECT status, least(n, 1) * (SELECT count(*) FROM orders) // 2 AS rows, true AS all_known FROM (SELECT 'capped' AS status, count(*) AS n FROM orders)")
def cap_orders(spark, folder):
    """Half of all rows, any of them, without an order: exactly so many, and none that is not there."""
    rows = load(spark, folder, "orders").select("o_orderstatus", "o_orderpriority")
    capped = paging.row_cap(rows, rows.count() // 2, shallow=1000)
    counts = capped.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("got"))
    there = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("had"))
    known = counts.join(there, rows.columns, "left")
    return known.agg(F.sum("got").alias("rows"), F.bool_and(F.col("got") <= F.coalesce("had", F.lit(0))).alias("all_known")).select(F.lit("capped").alias("status"), "rows", "all_known")


@query(
    """
    SELECT i AS chunk_id, i * 1000 + 500 AS row_offset, least(1000, n - i * 1000) AS row_limit
    FROM (SELECT CAST(count(*) AS BIGINT) - 500 AS n FROM orders) t, LATERAL (SELECT unnest(range(0, (n + 999) // 1000)) AS i)
    """
)
def chunk_plan(spark, folder):
    total = load(spark, folder, "orders").count()
    return paging.chunk_table(spark, paging.plan_chunks(total, 1000, start_offset=500))


@query(
    """
    SELECT o_orderkey, row_no, row_no // 1000 AS chunk_id FROM (
      SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_no FROM orders)
    """
)
def chunk_rows(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    numbered = paging.number_rows(orders, "o_totalprice desc, o_orderkey")
    plan = paging.plan_chunks(orders.count(), 1000)
    return paging.with_chunks(numbered, plan).select("o_orderkey", "row_no", "chunk_id")


@query(
    """
    SELECT l_returnflag, CAST(min(row_no) AS BIGINT) AS first_row, CAST(max(row_no) AS BIGINT) AS last_row,
           CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT row_no) AS BIGINT) AS row_numbers
    FROM (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS row_no FROM lineitem)
    GROUP BY l_returnflag
    """
)
def number_frequent_keys(spark, folder):
    """Three key values hold all rows; each is split over many tasks."""
    rows = load(spark, folder, "lineitem").select("l_returnflag", "l_quantity")
    numbered = paging.number_rows(rows, "l_returnflag")
    return numbered.groupBy("l_returnflag").agg(
        F.min("row_no").alias("first_row"),
        F.max("row_no").alias("last_row"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("row_no").alias("row_numbers"),
    )


@query(
    """
    SELECT chunk_id, CAST(min(o_orderkey) AS BIGINT) AS first_key, CAST(max(o_orderkey) AS BIGINT) AS last_key,
           CAST(count(*) AS BIGINT) AS row_count
    FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk_id FROM orders)
    GROUP BY chunk_id
    """
)
def chunk_layout(spark, folder):
    orders = load(spark, folder, "orders")
    chunks = paging.into_chunks(orders, "o_orderkey", paging.plan_chunks(orders.count(), 1000))
    return chunks.groupBy("chunk_id").agg(
        F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.count(F.lit(1)).alias("row_count")
    )


_WRITTEN = "SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk_id, o_totalprice FROM orders"
_COUNTS = f"""
    SELECT chunk_id, CAST(count(*) AS BIGINT) AS planned_rows,
           CAST(count(*) FILTER (WHERE o_totalprice < 495000) AS BIGINT) AS written_rows
    FROM ({_WRITTEN}) GROUP BY chunk_id
"""


def _reconciled(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    plan = paging.plan_chunks(orders.count(), 1000)
    numbered = paging.with_chunks(paging.number_rows(orders, "o_orderkey", total_rows=plan.total_rows), plan)
    planned = paging.chunk_table(spark, plan)
    return planned, checks.reconcile(planned, numbered.where("o_totalprice < 495000"))


@query(f"SELECT *, CASE WHEN written_rows < planned_rows THEN 'short' ELSE 'ok' END AS status FROM ({_COUNTS})")
def chunk_reconcile(spark, folder):
    return _reconciled(spark, folder)[1]


@query(
    f"SELECT chunk_id, chunk_id * 1000 AS row_offset, planned_rows AS row_limit FROM ({_COUNTS}) WHERE written_rows < planned_rows"
)
def resume_remaining(spark, folder):
    planned, report = _reconciled(spark, folder)
    return checks.remaining(planned, report.where("status = 'ok'"))


@query(
    """
    SELECT CAST(n AS BIGINT) AS rows, CAST((n + 4999) // 5000 AS BIGINT) AS chunks, CAST(0 AS BIGINT) AS empty_keys,
           CAST(0 AS BIGINT) AS malformed_rows, CAST(n - d AS BIGINT) AS adjacent_duplicates,
           CAST(0 AS BIGINT) AS order_violations, CAST(r AS BIGINT) AS duplicate_keys, CAST(n - d AS BIGINT) AS surplus_rows
    FROM (SELECT sum(c) AS n, count(*) AS d, count(*) FILTER (WHERE c > 1) AS r
          FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber))
    """
)
def validate_extract(spark, folder):
    rows = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    plan = paging.plan_chunks(rows.count(), 5000)
    numbered = paging.number_rows(
        rows, "l_orderkey, l_linenumber, l_partkey", total_rows=plan.total_rows, break_ties=True
    )
    return checks.validate_extract(paging.with_chunks(numbered, plan), ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE o_custkey < before) AS BIGINT) AS order_violations,
           CAST(count(*) FILTER (WHERE o_custkey = before) AS BIGINT) AS adjacent_duplicates
    FROM (SELECT o_custkey, lag(o_custkey) OVER (ORDER BY o_orderdate, o_orderkey) AS before FROM orders)
    """
)
def validate_disorder(spark, folder):
    """Rows in date order, checked against another key: violations inside and between chunks."""
    rows = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    plan = paging.plan_chunks(rows.count(), 700)
    numbered = paging.number_rows(rows, "o_orderdate, o_orderkey", total_rows=plan.total_rows)
    report = checks.validate_extract(paging.with_chunks(numbered, plan), "o_custkey")
    return report.select("rows", "order_violations", "adjacent_duplicates")


# --- publication -------------------------------------------------------------------------


_ORDER_TOTALS = """
    SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price_sum
    FROM orders GROUP BY o_orderstatus
"""


def _order_totals(df):
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("price_sum"),
    )


@query(_ORDER_TOTALS)
def parts_roundtrip(spark, folder):
    orders = load(spark, folder, "orders")
    target = scratch_path(spark, "parts")
    write_parts(orders, target, "o_orderkey", chunk_size=5000, all_varchar=False)
    return _order_totals(read_parts(spark, target, orders.columns))


@query(_ORDER_TOTALS)
def parts_roundtrip_csv(spark, folder):
    orders = load(spark, folder, "orders")
    target = scratch_path(spark, "parts")
    write_parts(orders, target, "o_orderdate desc, o_orderkey", chunk_size=4000, output_format="csv", delimiter="|")
    return _order_totals(read_parts(spark, target, orders.columns, "csv", delimiter="|"))


@query(
    """
    SELECT i AS chunk_id, least(1000, n - i * 1000) AS rows, i * 1000 AS row_offset, least(1000, n - i * 1000) AS row_limit
    FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM orders) t, LATERAL (SELECT unnest(range(0, (n + 999) // 1000)) AS i)
    """
)
def manifest(spark, folder):
    target = scratch_path(spark, "parts")
    write_parts(load(spark, folder, "orders"), target, "o_orderkey", chunk_size=1000)
    return manifest_parts(spark, read_manifest(spark, target)).select("chunk_id", "rows", "row_offset", "row_limit")


@query(
    """
    SELECT 'missing' AS status, CAST(1 AS BIGINT) AS parts UNION ALL SELECT 'changed', CAST(1 AS BIGINT)
    UNION ALL SELECT 'ok', CAST((count(*) + count(*) // 10 - 1) // (count(*) // 10) - 2 AS BIGINT) FROM orders
    """
)
def verify_parts(spark, folder):
    """One part deleted and one overwritten after publication."""
    target = scratch_path(spark, "parts")
    orders = load(spark, folder, "orders")
    write_parts(orders, target, "o_orderkey", chunk_size=orders.count() // 10)
    parts = [item["part"] for item in read_manifest(spark, target)["files"]]
    files = Files(spark)
    files.delete(f"{target}/{parts[0]}")
    files.write_json(f"{target}/{parts[1]}", {})
    report = compare_parts(manifest_parts(spark, read_manifest(spark, target)), part_hashes(spark, target))
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("parts"))


@query(
    """
    SELECT true AS matches, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS actual,
           CAST((count(*) + 499) // 500 AS BIGINT) AS parts FROM customer
    UNION ALL SELECT false, 'c_custkey,c_label,c_nationkey,c_acctbal,c_mktsegment', CAST(1 AS BIGINT)
    """
)
def part_schema_check(spark, folder):
    """A part with a renamed column among the parts of a dataset."""
    customer = load(spark, folder, "customer")
    target = scratch_path(spark, "parts")
    write_parts(customer, target, "c_custkey", chunk_size=500, output_format="csv")
    renamed = customer.withColumnRenamed("c_name", "c_label")
    renamed.coalesce(1).write.options(**csv_options()).csv(f"{target}/chunk_id=999999999")
    report = checks.compare_part_schemas(part_columns(spark, target))
    return report.groupBy("matches", "actual").agg(F.count(F.lit(1)).alias("parts"))


@query("SELECT p_partkey, p_name, p_brand, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part")
def single_csv_roundtrip(spark, folder):
    part = load(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    target = f"{scratch_path(spark, 'single')}.csv"
    write_single_csv(part, target, "p_partkey", delimiter=";", chunk_size=300)
    read = spark.read.options(**csv_options(";")).schema(
        "p_partkey bigint, p_name string, p_brand string, p_retailprice string"
    )
    return read.csv(target)


@query("SELECT doc_id, text, lang FROM documents")
def single_csv_texts(spark, folder):
    """Whole texts with line breaks, quotes and accents through one CSV file."""
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    target = f"{scratch_path(spark, 'single')}.csv"
    write_single_csv(docs, target, "doc_id", chunk_size=200)
    return read_delimited(spark, target, schema="doc_id bigint, text string, lang string")


@query("SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer GROUP BY c_mktsegment")
def export_roundtrip(spark, folder):
    lib = library(spark, folder)
    target = f"{scratch_path(spark, 'export')}.tsv"
    lib.export("customer", target)
    read = spark.read.options(**csv_options("\t")).schema(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )
    return read.csv(target).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("key_sum")
    )


@query("SELECT doc_id, nullif(text, '') AS text, lang, lpad(CAST(n_chars % 1000 AS VARCHAR), 3, '0') AS code, n_chars FROM documents")
def lib_csv_scan(spark, folder):
    """Whole texts with quotes, line breaks and empty lines, and numbers with leading zeros, from a CSV file by alias."""
    docs = load(spark, folder, "documents").withColumn("code", F.lpad((F.col("n_chars") % 1000).cast("string"), 3, "0"))
    base = scratch_path(spark, "csv-library")
    write_single_csv(docs.select("doc_id", "text", "lang", "code", "n_chars"), f"{base}/North/Docs Export.csv", "doc_id", chunk_size=200)
    return library(spark, base).query("SELECT doc_id, text, lang, code, n_chars FROM `Docs Export`")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, round(o_totalprice, 2) AS o_totalprice FROM orders")
def lib_tsv_scan(spark, folder):
    """Numbers and times from a TSV file by its safe alias, types inferred."""
    orders = load(spark, folder, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    base = scratch_path(spark, "tsv-library")
    write_single_csv(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice"), f"{base}/2024 orders.TSV", "o_orderkey", delimiter="\t", chunk_size=2000)
    return library(spark, base).query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, round(o_totalprice, 2) AS o_totalprice FROM t_2024_orders")


@query("SELECT alias, rows FROM (VALUES ('sales_data', 'North/Sales Data'), ('sales_data_2', 'South/sales_data')) t(alias, path), (SELECT count(*) AS rows FROM nation)")
def lib_aliases(spark, folder):
    """Two files of one stem: both get safe aliases of their own, and the exact name is each one's path."""
    nation = load(spark, folder, "nation")
    base = scratch_path(spark, "alias-library")
    for path in ("North/Sales Data.csv", "South/sales_data.csv"):
        write_single_csv(nation, f"{base}/{path}", "n_nationkey", chunk_size=10)
    lib = library(spark, base)
    return lib.query("SELECT 'sales_data' AS alias, count(*) AS rows FROM sales_data UNION ALL SELECT 'sales_data_2', count(*) FROM sales_data_2")


@query(_ORDER_TOTALS.replace("FROM orders", "FROM orders WHERE o_orderstatus = 'F'"))
def publish_failure_keeps_old(spark, folder):
    """A run that fails half way leaves the dataset that was there, and readers see that one."""
    orders = load(spark, folder, "orders")
    target = scratch_path(spark, "publish")
    write_parts(orders.where("o_orderstatus = 'F'"), target, "o_orderkey", chunk_size=2000, all_varchar=False)
    broken = orders.withColumn("o_orderpriority", F.expr("if(o_orderkey % 1000 = 999, raise_error('unreadable'), o_orderpriority)"))
    try:
        write_parts(broken, target, "o_orderkey", chunk_size=2000, all_varchar=False)
    except PySparkException:
        return _order_totals(read_parts(spark, target, orders.columns))
    raise AssertionError("the run should have failed")


@query("SELECT CAST((count(*) + 999) // 1000 AS BIGINT) AS parts, CAST(((count(*) + 999) // 1000) // 2 AS BIGINT) AS kept, true AS other_input_refused, true AS overwrite_refused, CAST(count(*) AS BIGINT) AS rows FROM orders")
def publish_resume(spark, folder):
    """A run that stopped half way is resumed with its own input only; a finished dataset is not overwritten unasked."""
    orders = load(spark, folder, "orders")
    target = scratch_path(spark, "publish")
    files = Files(spark)
    write_parts(orders, target, "o_orderkey", chunk_size=1000)
    whole = read_manifest(spark, target)
    base, _, name = files.qualified(target).rpartition("/")
    work = f"{base}/.{name}.extract-work"
    files.make_folder(work)
    files.rename(files.qualified(target), f"{work}/parts")  # as if the run had stopped after half of its parts
    half = whole["files"][: len(whole["files"]) // 2]
    files.write_json(f"{work}/checkpoint.json", {"status": "failed", "fingerprint": whole["fingerprint"], "plan": whole["plan"], "files": half})
    refused = []
    for error, changed in ((FingerprintError, orders.where("o_orderkey <> 7")), (FileExistsError, None)):
        if changed is None:
            result = write_parts(orders, target, "o_orderkey", chunk_size=1000)
        try:
            write_parts(orders if changed is None else changed, target, "o_orderkey", chunk_size=1000, overwrite=False)
            refused.append(False)
        except error:
            refused.append(True)
    found = read_parts(spark, target).select(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("keys")).where("rows = keys")
    return found.select(
        F.lit(result.part_count).cast("bigint").alias("parts"), F.lit(result.resumed_parts).cast("bigint").alias("kept"),
        F.lit(refused[0]).alias("other_input_refused"), F.lit(refused[1]).alias("overwrite_refused"), "rows",
    )


@query(_ORDER_TOTALS)
def stream_copy(spark, folder):
    orders = load(spark, folder, "orders")
    base = scratch_path(spark, "stream")
    orders.repartition(4, "o_orderkey").write.parquet(f"{base}/in")
    stream = read_folder_stream(spark, f"{base}/in", orders.schema, max_files=2)
    stream_parts(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _order_totals(spark.read.parquet(f"{base}/out"))


# --- summaries ---------------------------------------------------------------------------------


def _summary_sql(table: str, columns: dict[str, str]) -> str:
    parts = []
    for name, kind in columns.items():
        number = kind in {"bigint", "int", "double"}
        parts.append(
            f"SELECT '{name}' AS column_name, '{kind}' AS column_type, CAST(min({name}) AS VARCHAR) AS min, "
            f"CAST(max({name}) AS VARCHAR) AS max, "
            + (f"round(avg({name}), 4) AS avg, round(stddev_samp({name}), 4) AS std, " if number else "NULL AS avg, NULL AS std, ")
            + f"CAST(count(*) AS BIGINT) AS count, round(100.0 * (count(*) - count({name})) / count(*), 2) AS null_percentage FROM {table}"
        )
    return " UNION ALL ".join(parts)


@query(
    _summary_sql(
        "lineitem",
        {
            "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
            "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
            "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
        },
    )
)
def summarize_lineitem(spark, folder):
    summary = profile.summarize(load(spark, folder, "lineitem"), approximate=False)
    return summary.withColumns({"avg": F.round("avg", 4), "std": F.round("std", 4)})


@query(None)
def summarize_sketches(spark, folder):
    """Distinct counts and quartiles are sketches, so there is no exact SQL."""
    return library(spark, folder).query("SUMMARIZE lineitem")


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST(count(*) AS BIGINT) AS rows, true AS distinct_ok, {ranks} AS ranks_ok FROM lineitem"
        for name, ranks in {"l_orderkey": "true", "l_quantity": "true", "l_extendedprice": "true", "l_discount": "true", "l_returnflag": "CAST(NULL AS BOOLEAN)", "l_shipdate": "CAST(NULL AS BOOLEAN)"}.items()
    )
)
def sketch_bounds(spark, folder):
    """Sketches of each part of a dataset, merged: exact ranks and distinct counts stay within the stated bounds."""
    rows = load(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    target = scratch_path(spark, "sketches")
    write_parts(rows, target, "l_orderkey, l_extendedprice", chunk_size=10_000, all_varchar=False)
    figures = sketches.sketch_figures(sketches.merged_sketches(sketches.sketch_parts(spark, target)))
    return sketches.sketch_errors(rows, figures).join(figures.select("column_name", "rows"), "column_name")


@query(
    """
    SELECT event_type, CAST(count(*) AS BIGINT) AS pages, CAST(sum(user_id) AS BIGINT) AS rows,
           CAST(count(*) FILTER (WHERE value > 100) AS BIGINT) AS failures, CAST(sum(event_id % 3) AS BIGINT) AS retries,
           round((max(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT)) - min(epoch_us(ts))) / 1000000.0, 3) AS elapsed_seconds,
           round(sum(user_id) / ((max(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT)) - min(epoch_us(ts))) / 1000000.0), 3) AS rows_per_second,
           round(avg(CAST(round(value * 1000) AS BIGINT)) / 1000, 6) AS page_seconds_avg,
           round(quantile_cont(round(value * 1000), 0.5) / 1000, 6) AS page_seconds_p50,
           round(quantile_cont(round(value * 1000), 0.9) / 1000, 6) AS page_seconds_p90,
           round(quantile_cont(round(value * 1000), 0.95) / 1000, 6) AS page_seconds_p95,
           round(sum(CAST(round(value * 1000) AS BIGINT)) / 1000.0
                 / ((max(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT)) - min(epoch_us(ts))) / 1000000.0), 6) AS effective_concurrency
    FROM events GROUP BY event_type
    """
)
def page_metrics(spark, folder):
    log = load(spark, folder, "events").select(
        "event_type",
        F.col("ts").alias("started"),
        F.col("value").alias("seconds"),
        F.col("user_id").alias("rows"),
        (F.col("value") > 100).alias("failed"),
        (F.col("event_id") % 3).alias("retries"),
    )
    return profile.page_metrics(log, group_by=["event_type"])
