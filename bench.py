"""Headline timings as one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  Each job runs once
to warm the JVM on the smallest tables, then once for the clock.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time
from pathlib import Path

from entry_queries import all_queries
from entry_queries.common import load, tables
from extractkit.operators import paging
from extractkit.operators.profile import summarize
from extractkit.operators.querylog import redact_table
from extractkit.plans.sync import sync_query
from extractkit.session import local_session, scratch_path, spread
from extractkit.sinks.delimited import write_single_csv
from extractkit.sinks.parts import write_parts

SMALL = "/root/testdata/sf0.001"


def drain(df) -> None:
    """Compute every row and column without storing anything."""
    df.write.format("noop").mode("overwrite").save()


def write_lineitem_parts(spark, folder) -> int:
    """Ordered, hashed, verified part dataset with a manifest."""
    rows = load(spark, folder, "lineitem")
    keys = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity"
    return write_parts(rows, scratch_path(spark, "bench"), keys, chunk_size=50_000, all_varchar=False).rows


def write_orders_csv(spark, folder) -> int:
    return write_single_csv(load(spark, folder, "orders"), f"{scratch_path(spark, 'bench')}.csv", "o_orderkey")["rows"]


def number_orders(spark, folder) -> int:
    orders = load(spark, folder, "orders")
    total = orders.count()
    drain(paging.number_rows(orders, "o_orderkey", total_rows=total))
    return total


def upsert_orders(spark, folder) -> int:
    """A managed table takes one tenth changed rows and one tenth new rows."""
    orders = load(spark, folder, "orders")
    store = tables(spark)
    sync_query(store, orders, "orders", replace_target=True, all_varchar=False)
    changed = orders.where("o_orderkey % 10 = 3")
    source = changed.selectExpr("o_orderkey", "o_custkey", "'X' AS o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    new = orders.where("o_orderkey % 10 = 7").withColumn("o_orderkey", orders.o_orderkey + 100_000_000)
    return sync_query(store, source.unionByName(new), "orders", primary_key="o_orderkey", all_varchar=False).target_rows


def summarize_lineitem(spark, folder) -> int:
    rows = load(spark, folder, "lineitem")
    drain(summarize(rows))
    return rows.count()


def redact_documents(spark, folder) -> int:
    docs = spread(load(spark, folder, "documents"), "doc_id")
    drain(redact_table(docs, "text"))
    return docs.count()


def _query(name: str):
    def run(spark, folder) -> int:
        drain(all_queries()[name][0](spark, folder))
        return 0

    return run


JOBS = {
    "write_lineitem_parts": write_lineitem_parts,
    "write_orders_csv": write_orders_csv,
    "number_orders": number_orders,
    "upsert_orders_table": upsert_orders,
    "summarize_lineitem": summarize_lineitem,
    "redact_documents": redact_documents,
    **{
        name: _query(name)
        for name in (
            "lib_revenue_by_customer", "upsert_orders", "number_frequent_keys", "validate_extract", "selector_match",
            "resolve_config", "xml_rows", "job_children", "classify_log", "table_usage", "page_metrics", "stream_upsert_events",
        )
    },
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"), **{"spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    seconds, rates = {}, {}
    with contextlib.redirect_stdout(sys.stderr):
        for name, job in JOBS.items():
            job(spark, SMALL)
            started = time.perf_counter()
            rows = job(spark, folder)
            seconds[name] = round(time.perf_counter() - started, 3)
            if rows:
                rates[name] = round(rows / seconds[name])
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                "rows_per_second": rates, "sf": float(Path(folder).name.removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
