"""Registry, catalog, XML, JSON and archive queries.

The given tables are dressed as registries, catalogs and payloads by plain
projections, so every query grows with them.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from extractkit.functions.naming import is_protected_path
from extractkit.operators import catalog, registry
from extractkit.session import scratch_path
from extractkit.sinks.delimited import csv_options
from extractkit.sinks.load_files import write_load_files
from extractkit.sources import archives, payloads

from .common import load

QUERIES = {}


def query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = (function, sql)
        return function

    return keep


# --- registry ---------------------------------------------------------------------------

# Four parts share a business object; parts of size 26 and above have no details.
_OPTIONS = """
    SELECT CAST(p_partkey AS VARCHAR) AS erp_interface_options_id, ' ' || p_type || ' ' AS erp_family,
           CAST(p_size AS VARCHAR) AS application_id,
           p_name || ' ' || CAST(p_partkey // 4 AS VARCHAR) || CASE WHEN p_size < 10 THEN ' entries' ELSE ' jobs' END AS business_object,
           'fin/' || lower(p_brand) || '/import' AS ucm_account, '/load;' || p_type AS load_job_name,
           '/oracle/apps;' || lower(p_type) || ';Import' || CAST(p_size AS VARCHAR) AS import_job_name FROM part
"""
_DETAILS = """
    SELECT CAST(p_partkey AS VARCHAR) AS erp_interface_options_id,
           'Ctl' || CAST(p_partkey AS VARCHAR) || '.ctl' AS control_file_name,
           'GL_' || upper(p_type) || '_' || CAST(p_partkey // 2 AS VARCHAR) || '_INT, ' || p_brand || '_LINES' AS interface_table_names
    FROM part WHERE p_size < 26
"""
_REGISTRY = f"""
    SELECT o.erp_family, o.application_id, o.business_object, o.erp_interface_options_id, o.ucm_account,
           replace(o.ucm_account, '/', '$/') || '$' AS document_account, o.load_job_name, o.import_job_name,
           d.control_file_name, d.interface_table_names
    FROM ({_OPTIONS}) o LEFT JOIN ({_DETAILS}) d ON d.erp_interface_options_id = o.erp_interface_options_id
"""
_NORMAL = f"""
    SELECT trim(erp_family) AS "ERP_FAMILY", application_id AS "APPLICATION_ID", business_object AS "BUSINESS_OBJECT",
           erp_interface_options_id AS "ERP_INTERFACE_OPTIONS_ID", ucm_account AS "UCM_ACCOUNT",
           document_account AS "DOCUMENT_ACCOUNT", load_job_name AS "LOAD_JOB_NAME", import_job_name AS "IMPORT_JOB_NAME",
           coalesce(control_file_name, '') AS "CONTROL_FILE_NAME", coalesce(interface_table_names, '') AS "INTERFACE_TABLE_NAMES"
    FROM ({_REGISTRY})
"""


def _registry(spark, folder):
    part = load(spark, folder, "part")
    key, block = F.col("p_partkey").cast("string"), lambda n: F.floor(F.col("p_partkey") / n).cast("string")
    ending = F.when(F.col("p_size") < 10, F.lit(" entries")).otherwise(F.lit(" jobs"))
    options = part.select(
        key.alias("erp_interface_options_id"),
        F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("erp_family"),
        F.col("p_size").cast("string").alias("application_id"),
        F.concat("p_name", F.lit(" "), block(4), ending).alias("business_object"),
        F.concat(F.lit("fin/"), F.lower("p_brand"), F.lit("/import")).alias("ucm_account"),
        F.concat(F.lit("/load;"), "p_type").alias("load_job_name"),
        F.concat(F.lit("/oracle/apps;"), F.lower("p_type"), F.lit(";Import"), F.col("p_size").cast("string")).alias("import_job_name"),
    )
    details = part.where("p_size < 26").select(
        key.alias("erp_interface_options_id"),
        F.concat(F.lit("Ctl"), key, F.lit(".ctl")).alias("control_file_name"),
        F.concat(F.lit("GL_"), F.upper("p_type"), F.lit("_"), block(2), F.lit("_INT, "), "p_brand", F.lit("_LINES")).alias("interface_table_names"),
    )
    return registry.build_registry(options, details)


@query(_REGISTRY)
def registry_left_join(spark, folder):
    return _registry(spark, folder)


@query(_NORMAL)
def registry_normalized(spark, folder):
    return registry.normalize_registry(_registry(spark, folder)).orderBy(*registry.registry_order())


@query(
    f"""SELECT "ERP_INTERFACE_OPTIONS_ID", "BUSINESS_OBJECT", "INTERFACE_TABLE_NAMES" FROM ({_NORMAL})
        WHERE lower("ERP_FAMILY") = 'economy' AND list_contains(list_transform(string_split("INTERFACE_TABLE_NAMES", ','), lambda t: lower(trim(t))), 'brand#3_lines')"""
)
def registry_filter(spark, folder):
    rows = registry.normalize_registry(_registry(spark, folder))
    found = registry.filter_registry(rows, erp_family=" Economy ", interface_table="BRAND#3_lines ")
    return found.select("ERP_INTERFACE_OPTIONS_ID", "BUSINESS_OBJECT", "INTERFACE_TABLE_NAMES")


@query(
    f"""SELECT "ERP_INTERFACE_OPTIONS_ID", "SOURCE", "REFRESH_ERROR" IS NOT NULL AS has_error
        FROM (SELECT *, 'fallback' AS "SOURCE", 'x' AS "REFRESH_ERROR" FROM ({_NORMAL}))"""
)
def registry_fallback(spark, folder):
    """The live registry lacks a column, so the fallback answers."""
    rows = _registry(spark, folder)
    source = registry.RegistrySource(lambda: rows.drop("control_file_name"), lambda: rows)
    return source.rows().select("ERP_INTERFACE_OPTIONS_ID", "SOURCE", F.col("REFRESH_ERROR").isNotNull().alias("has_error"))


# Selectors of a request: a part asks for its object in the singular, a large part
# also for its own control file, a part of size 20 to 25 for a shared table.
_SELECTORS = """
    SELECT p_partkey AS request_id, upper(p_name) || '-' || CAST(p_partkey // 4 AS VARCHAR) || CASE WHEN p_size < 10 THEN '-Entry' ELSE ' job' END AS selector FROM part
    UNION ALL SELECT p_partkey, 'dir/CTL' || CAST(p_partkey AS VARCHAR) || '.csv' FROM part WHERE p_size >= 15
    UNION ALL SELECT p_partkey, 'gl_' || p_type || '_' || CAST(p_partkey // 2 AS VARCHAR) || '_int' FROM part WHERE p_size BETWEEN 20 AND 25
"""


def _selectors(spark, folder):
    part = load(spark, folder, "part")
    block = lambda n: F.floor(F.col("p_partkey") / n).cast("string")
    ending = F.when(F.col("p_size") < 10, F.lit("-Entry")).otherwise(F.lit(" job"))
    request = F.col("p_partkey").alias("request_id")
    objects = part.select(request, F.concat(F.upper("p_name"), F.lit("-"), block(4), ending).alias("selector"))
    controls = part.where("p_size >= 15").select(
        request, F.concat(F.lit("dir/CTL"), F.col("p_partkey").cast("string"), F.lit(".csv")).alias("selector")
    )
    shared = part.where("p_size BETWEEN 20 AND 25").select(
        request, F.concat(F.lit("gl_"), "p_type", F.lit("_"), block(2), F.lit("_int")).alias("selector")
    )
    return objects.unionByName(controls).unionByName(shared)


# Independent statement: every selector names one column of the parts it came from.
_MATCHES = """
    WITH base AS (SELECT p_partkey, p_name, p_type, p_size, lower(regexp_replace(p_name, '[^a-zA-Z0-9]', '', 'g')) AS n,
                         CASE WHEN p_size < 10 THEN 'entry' ELSE 'job' END AS e FROM part),
    objects AS (SELECT DISTINCT upper(p_name) || '-' || CAST(p_partkey // 4 AS VARCHAR) || CASE WHEN p_size < 10 THEN '-Entry' ELSE ' job' END AS selector,
                       n, e, p_partkey // 4 AS b FROM base)
    SELECT o.selector, p.p_partkey AS part, 50 AS score, 'business_object_friendly' AS match_type
    FROM objects o JOIN base p ON p.n = o.n AND p.e = o.e AND p.p_partkey // 4 = o.b
    UNION ALL
    SELECT 'dir/CTL' || CAST(p_partkey AS VARCHAR) || '.csv', p_partkey, 90, 'control_file_exact' FROM part WHERE p_size BETWEEN 15 AND 25
    UNION ALL
    SELECT DISTINCT 'gl_' || a.p_type || '_' || CAST(a.p_partkey // 2 AS VARCHAR) || '_int', p.p_partkey, 80, 'interface_table_exact'
    FROM part a JOIN part p ON p.p_type = a.p_type AND p.p_partkey // 2 = a.p_partkey // 2
    WHERE a.p_size BETWEEN 20 AND 25 AND p.p_size < 26
"""


@query(_MATCHES)
def selector_match(spark, folder):
    rows = registry.normalize_registry(_registry(spark, folder))
    found = registry.match_selectors(_selectors(spark, folder), rows)
    return found.select("selector", F.col("ERP_INTERFACE_OPTIONS_ID").cast("bigint").alias("part"), "score", "match_type")


_RESOLVED = f"""
    WITH asked AS ({_SELECTORS}), matches AS ({_MATCHES}),
    needed AS (SELECT request_id, count(*) AS selectors FROM asked GROUP BY request_id),
    hits AS (SELECT a.request_id, a.selector, m.part FROM asked a JOIN matches m ON m.selector = a.selector),
    matched AS (SELECT request_id, count(DISTINCT selector) AS n FROM hits GROUP BY request_id),
    common AS (SELECT h.request_id, h.part FROM hits h JOIN needed d ON d.request_id = h.request_id
               GROUP BY h.request_id, h.part, d.selectors HAVING count(*) = d.selectors),
    counts AS (SELECT request_id, count(*) AS n, min(part) AS part FROM common GROUP BY request_id)
    SELECT d.request_id, CAST(d.selectors AS BIGINT) AS selectors, CAST(coalesce(c.n, 0) AS BIGINT) AS common_configurations,
           CASE WHEN coalesce(m.n, 0) < d.selectors THEN 'NO_MATCH' WHEN coalesce(c.n, 0) = 0 THEN 'CONFLICT'
                WHEN c.n > 1 THEN 'AMBIGUOUS' ELSE 'RESOLVED' END AS status, c.part
    FROM needed d LEFT JOIN matched m ON m.request_id = d.request_id LEFT JOIN counts c ON c.request_id = d.request_id
"""


@query(
    f"""
    SELECT r.request_id, r.selectors, r.common_configurations, r.status,
           CASE WHEN r.status = 'RESOLVED' THEN CAST(r.part AS VARCHAR) END AS interface_options_id,
           CASE WHEN r.status = 'RESOLVED' THEN 'fin$/' || lower(p.p_brand) || '$/import$' END AS document_account,
           CASE WHEN r.status = 'RESOLVED' THEN 'oracle/apps;' || lower(p.p_type) || ',Import' || CAST(p.p_size AS VARCHAR) END AS job_name
    FROM ({_RESOLVED}) r LEFT JOIN part p ON p.p_partkey = r.part
    """
)
def resolve_config(spark, folder):
    rows = registry.normalize_registry(_registry(spark, folder))
    resolved = registry.resolve_requests(_selectors(spark, folder), rows)
    return resolved.drop("business_object")


@query(
    f"""
    WITH resolved AS (SELECT request_id, part FROM ({_RESOLVED}) WHERE status = 'RESOLVED'), asked AS ({_SELECTORS}), matches AS ({_MATCHES})
    SELECT a.request_id, a.selector, CAST(r.part AS VARCHAR) AS interface_options_id, CAST(1 AS BIGINT) * (CASE WHEN p.p_size < 26 THEN 1 ELSE 0 END) AS control_files,
           CASE WHEN p.p_size < 26 THEN 'Ctl' || CAST(r.part AS VARCHAR) || '.ctl' END AS control_file,
           CASE WHEN p.p_size < 26 THEN 'RESOLVED' ELSE 'NOT_ONE' END AS status,
           CASE WHEN p.p_size < 26 THEN 'Ctl' || CAST(r.part AS VARCHAR) || '.csv' END AS load_file
    FROM asked a JOIN resolved r ON r.request_id = a.request_id JOIN part p ON p.p_partkey = r.part
    """
)
def resolve_control_file(spark, folder):
    rows = registry.normalize_registry(_registry(spark, folder))
    asked = _selectors(spark, folder)
    return registry.resolve_control_files(asked, registry.resolve_requests(asked, rows), rows)


@query(
    """
    SELECT 'Customers.csv' AS load_file, CAST(c_custkey AS VARCHAR) AS k, c_name AS v, NULL AS w FROM customer
    UNION ALL SELECT 'Parts.csv', CAST(p_partkey AS VARCHAR), p_name, p_brand FROM part
    """
)
def load_file_rows(spark, folder):
    """Header-less load files, written and read back."""
    target = scratch_path(spark, "load")
    customer, part = load(spark, folder, "customer"), load(spark, folder, "part")
    nothing = F.lit(None).cast("string").alias("w")
    write_load_files(
        target,
        {
            "Customers.ctl": customer.select("c_custkey", "c_name", nothing),
            "dir/Parts.ctl": part.select("p_partkey", "p_name", "p_brand"),
        },
    )
    read = spark.read.options(**csv_options(header=False)).schema("k string, v string, w string")
    return read.csv([f"{target}/Customers.csv", f"{target}/Parts.csv"]).select(
        F.col("_metadata.file_name").alias("load_file"), "k", "v", "w"
    )


# --- catalog -------------------------------------------------------------------------------

_PATH = "regexp_replace(url, '^https?://[^/]+', '')"


def _catalog_path():
    return F.regexp_replace("url", "^https?://[^/]+", "")


@query(
    """
    SELECT DISTINCT '/shared/' || c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR) AS absolute_path, 'N' || CAST(c_nationkey AS VARCHAR) AS display_name,
           CASE WHEN c_nationkey < 5 THEN 'Folder' ELSE 'Report' END AS type FROM customer
    """
)
def catalog_listing(spark, folder):
    """Listing documents with many copies of each item, with and without namespaces."""
    nation = F.col("c_nationkey").cast("string")
    path = F.concat(F.lit("/shared/"), "c_mktsegment", F.lit("/"), nation)
    kind = F.when(F.col("c_nationkey") < 5, F.lit("Folder")).otherwise(F.lit("Report"))
    plain = F.format_string(
        "<r><item><absolutePath>%s</absolutePath><displayName>N%s</displayName><type>%s</type></item></r>", path, nation, kind
    )
    spaced = F.format_string(
        '<n:r xmlns:n="u"><n:catalogItem><n:type>%s</n:type><n:displayName> N%s </n:displayName><n:absolutePath>%s</n:absolutePath></n:catalogItem></n:r>',
        kind, nation, path,
    )
    docs = load(spark, folder, "customer").select(F.when(F.col("c_acctbal") < 4000, plain).otherwise(spaced).alias("xml"))
    items = catalog.catalog_items(docs, "xml").orderBy(*catalog.listing_order())
    return items.select("absolute_path", "display_name", "type")


@query(
    f"""
    WITH paths AS (SELECT page_id, {_PATH} AS path, html LIKE '%lang="en"%' AS en FROM pages),
    source AS (SELECT DISTINCT regexp_replace(path, '/+$', '') AS p FROM paths WHERE en),
    destination AS (SELECT DISTINCT '/copy' || regexp_replace(path, '/+$', '') AS p FROM paths WHERE path LIKE '%5%'),
    requests AS (SELECT page_id, CASE WHEN path = '/' THEN path ELSE regexp_replace(path, '/+$', '') END AS src,
                        '/copy' || regexp_replace(path, '/+$', '') AS dst, path LIKE '%#%' AS overwrite FROM paths),
    joined AS (SELECT r.*, s.p IS NOT NULL AS source_exists, d.p IS NOT NULL AS destination_exists
               FROM requests r LEFT JOIN source s ON s.p = r.src LEFT JOIN destination d ON d.p = r.dst)
    SELECT page_id, src AS source_path, dst AS destination_path, overwrite,
           'unknown' AS object_type,
           source_exists, destination_exists,
           CASE WHEN NOT source_exists THEN 'SOURCE_MISSING' WHEN destination_exists AND NOT overwrite THEN 'BLOCKED_DESTINATION_EXISTS'
                WHEN destination_exists THEN 'REPLACE' ELSE 'CREATE' END AS action,
           source_exists AND NOT (destination_exists AND NOT overwrite) AS success
    FROM joined
    """
)
def copy_plan(spark, folder):
    pages = load(spark, folder, "pages").select("page_id", _catalog_path().alias("path"), F.col("html").contains('lang="en"').alias("en"))
    requests = pages.select(
        "page_id",
        F.col("path").alias("source_path"),
        F.concat(F.lit("/copy"), "path").alias("destination_path"),
        F.col("path").contains("#").alias("overwrite"),
    )
    source = pages.where("en").select(F.col("path").alias("absolute_path"))
    destination = pages.where("path LIKE '%5%'").select(F.concat(F.lit("copy"), "path", F.lit("/")).alias("absolute_path"))
    return catalog.plan_copies(requests, source, destination)


_ENDINGS = ("", ".xdo", ".XDM", ".xss/", ".zip", ".xdo.bak", ".xdo/x")
_ENDED = "CASE p_partkey % 7 " + " ".join(f"WHEN {i} THEN '{ending}'" for i, ending in enumerate(_ENDINGS)) + " END"


@query(
    f"""
    WITH objects AS (SELECT 'Shared/' || p_partkey || '.' || p_name || {_ENDED} AS asked, p_partkey, p_size FROM part),
    paths AS (SELECT '/' || CASE WHEN asked LIKE '%/' THEN left(asked, length(asked) - 1) ELSE asked END AS path, p_partkey, p_size FROM objects)
    SELECT object_type, action, CAST(count(*) AS BIGINT) AS requests, min(source_path) AS first_path FROM (
      SELECT path AS source_path,
        CASE p_partkey % 7 WHEN 1 THEN 'xdoz' WHEN 2 THEN 'xdmz' WHEN 3 THEN 'xssz' ELSE 'unknown' END AS object_type,
        CASE WHEN p_size <= 10 THEN 'SOURCE_MISSING' WHEN p_size > 40 AND p_partkey % 2 = 1 THEN 'BLOCKED_DESTINATION_EXISTS'
             WHEN p_size > 40 THEN 'REPLACE' ELSE 'CREATE' END AS action FROM paths)
    GROUP BY object_type, action
    """
)
def copy_plan_archives(spark, folder):
    """Copies of archives of each kind, of other files, and of names that only look like archives."""
    asked = F.concat(F.lit("Shared/"), F.col("p_partkey").cast("string"), F.lit("."), "p_name", F.expr(_ENDED))
    objects = load(spark, folder, "part").select(asked.alias("source_path"), F.concat(F.lit("/backup/"), asked).alias("destination_path"), "p_partkey", "p_size")
    requests = objects.select("source_path", "destination_path", (F.col("p_partkey") % 2 == 0).alias("overwrite"))
    source = objects.where("p_size > 10").select(F.col("source_path").alias("absolute_path"))
    destination = objects.where("p_size > 40").select(F.col("destination_path").alias("absolute_path"))
    planned = catalog.plan_copies(requests, source, destination)
    return planned.groupBy("object_type", "action").agg(F.count(F.lit(1)).alias("requests"), F.min("source_path").alias("first_path"))


@query(
    """
    SELECT path, path IN ('/', '/Custom/', '/shared folders') OR path LIKE '/~%' AS protected FROM (
      SELECT CASE WHEN c_nationkey = 0 THEN '/' WHEN c_nationkey < 4 THEN '/Custom/' WHEN c_nationkey < 8 THEN '/~' || c_name
                  WHEN c_nationkey < 10 THEN '/shared folders' ELSE '/shared folders/' || c_name END AS path FROM customer)
    """
)
def protected_paths(spark, folder):
    nation = F.col("c_nationkey")
    path = (
        F.when(nation == 0, F.lit("/"))
        .when(nation < 4, F.lit("/Custom/"))
        .when(nation < 8, F.concat(F.lit("/~"), "c_name"))
        .when(nation < 10, F.lit("/shared folders"))
        .otherwise(F.concat(F.lit("/shared folders/"), "c_name"))
    )
    rows = load(spark, folder, "customer").select(path.alias("path"))
    return rows.withColumn("protected", is_protected_path(F.col("path")))


# --- payloads ---------------------------------------------------------------------------------

# The kind of payload follows the last digit of the key: 0 empty, 1 no rows, 2 a
# child missing, 3 bad Base64, 4 cut off, 5 byte order mark, 6 two rows, else one.


def _xml_payloads(spark, folder):
    orders = load(spark, folder, "orders", "o_orderkey")
    digit = F.col("o_orderkey") % 10
    row = F.format_string(
        "<G_1><KEY>%08d</KEY><STATUS>%s</STATUS><NOTE>a &amp; %s</NOTE></G_1>", "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    short = F.format_string("<G_1><KEY>%08d</KEY><NOTE>a &amp; %s</NOTE></G_1>", "o_orderkey", "o_orderpriority")
    open_tag, close_tag = F.lit("<?xml version='1.0'?><DATA_DS>"), F.lit("</DATA_DS>")
    document = (
        F.when(digit == 1, F.lit("<DATA_DS/>"))
        .when(digit == 2, F.concat(open_tag, short, close_tag))
        .when(digit == 4, F.concat(open_tag, row))
        .when(digit == 5, F.concat(F.lit("﻿"), open_tag, row, close_tag))
        .when(digit == 6, F.concat(open_tag, row, row, close_tag))
        .otherwise(F.concat(open_tag, row, close_tag))
    )
    encoded = F.base64(F.encode(document, "UTF-8"))
    payload = F.when(digit == 0, F.lit("")).when(digit == 3, F.lit("@@not base64@@")).otherwise(F.replace(encoded, F.lit("\r\n"), F.lit("")))
    return orders.select("o_orderkey", payload.alias("payload"))


@query(
    """
    SELECT o_orderkey, printf('%08d', o_orderkey) AS "KEY", CASE WHEN o_orderkey % 10 <> 2 THEN o_orderstatus END AS "STATUS",
           'a & ' || o_orderpriority AS "NOTE" FROM orders WHERE o_orderkey % 10 IN (2, 5, 6, 7, 8, 9)
    UNION ALL
    SELECT o_orderkey, printf('%08d', o_orderkey), o_orderstatus, 'a & ' || o_orderpriority FROM orders WHERE o_orderkey % 10 = 6
    """
)
def xml_rows(spark, folder):
    decoded = payloads.with_result_xml(_xml_payloads(spark, folder), "payload")
    return payloads.result_rows(decoded, "xml", ["KEY", "STATUS", "NOTE"], keep=["o_orderkey"])


@query(
    """
    SELECT n_regionkey, CASE WHEN n_nationkey % 3 < 2 THEN printf('%03d', n_nationkey) END AS id, n_name AS "Name", CASE WHEN n_nationkey % 3 = 2 THEN n_name || '!' END AS "Only",
           CASE WHEN n_nationkey % 3 = 0 THEN CAST(n_nationkey AS VARCHAR) END AS seen FROM nation
    """
)
def xml_any_rows(spark, folder):
    """One document for each region, its nations under two element names, ids as attributes or children, columns not stated."""
    nation = load(spark, folder, "nation")
    code, kind = F.lpad(F.col("n_nationkey").cast("string"), 3, "0"), F.col("n_nationkey") % 3
    row = (
        F.when(kind == 0, F.format_string('<G_1 id="%s"><Name> %s </Name><seen>%d</seen></G_1>', code, "n_name", "n_nationkey"))
        .when(kind == 1, F.format_string("<x:ROW><x:id>%s</x:id><x:Name>%s</x:Name></x:ROW>", code, "n_name"))
        .otherwise(F.format_string("<ROW><Only>%s!</Only><Name>%s</Name></ROW>", "n_name", "n_name"))
    )
    documents = nation.groupBy("n_regionkey").agg(F.concat(F.lit('<DATA xmlns:x="u">'), F.array_join(F.collect_list(row), ""), F.lit("</DATA>")).alias("xml"))
    return payloads.any_result_rows(documents, "xml", keep=["n_regionkey"])


@query(
    """
    SELECT CASE o_orderkey % 10 WHEN 0 THEN 'empty' WHEN 3 THEN 'invalid_base64' WHEN 4 THEN 'invalid_xml' ELSE 'ok' END AS status,
           CAST(count(*) AS BIGINT) AS payloads FROM orders GROUP BY 1
    """
)
def xml_status(spark, folder):
    decoded = payloads.with_result_xml(_xml_payloads(spark, folder), "payload")
    return decoded.groupBy("status").agg(F.count(F.lit(1)).alias("payloads"))


def _envelopes(spark, folder):
    orders = load(spark, folder, "orders", "o_orderkey")
    digit = F.col("o_orderkey") % 8
    code = F.base64(F.encode(F.concat(F.lit("<A>"), "o_orderpriority", F.lit("</A>")), "UTF-8"))
    body = (
        F.when(digit == 0, F.lit("<ns:reportBytes/>"))
        .when(digit == 1, F.concat(F.lit("<ns:reportBytes>\n "), code, F.lit("\n</ns:reportBytes>")))
        .when(digit == 2, F.lit("<reportBytes>#</reportBytes>"))
        .when(digit == 3, F.lit("<ns:other>1</ns:other>"))
        .when(digit == 4, F.format_string("<!-- <faultstring>no</faultstring> --><s:Fault><faultcode>x</faultcode><faultstring> order %d &lt;bad&gt; <![CDATA[<&>]]>&#169;</faultstring></s:Fault>", "o_orderkey"))
        .when(digit == 5, F.format_string('<s:Fault><s:Reason><s:Text xml:lang="en">text %d</s:Text></s:Reason></s:Fault>', "o_orderkey"))
        .otherwise(F.concat(F.lit("<ReportBytes>"), code, F.lit("</ReportBytes>")))
    )
    close = F.when(digit == 7, F.lit("")).otherwise(F.lit("</s:Body></s:Envelope>"))
    text = F.concat(F.lit('<s:Envelope xmlns:s="http://s" xmlns:ns="http://n"><s:Body>'), body, close)
    return orders.select("o_orderkey", "o_orderpriority", text.alias("envelope"))


@query(
    """
    SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'empty' WHEN 2 THEN 'invalid_base64' WHEN 3 THEN 'missing' WHEN 4 THEN 'missing'
                          WHEN 5 THEN 'missing' WHEN 7 THEN 'invalid_xml' ELSE 'ok' END AS status,
           CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN to_base64(encode('<A>' || o_orderpriority || '</A>'))
                               WHEN 6 THEN to_base64(encode('<A>' || o_orderpriority || '</A>')) END AS report_base64
    FROM orders
    """
)
def soap_payload_status(spark, folder):
    return payloads.with_report_bytes(_envelopes(spark, folder), "envelope").select("o_orderkey", "status", "report_base64")


@query(
    """
    SELECT o_orderkey, CASE o_orderkey % 8 WHEN 4 THEN 'order ' || CAST(o_orderkey AS VARCHAR) || ' <bad> <&>©'
                                           WHEN 5 THEN 'text ' || CAST(o_orderkey AS VARCHAR) END AS fault FROM orders
    """
)
def soap_faults(spark, folder):
    rows = _envelopes(spark, folder)
    return rows.select("o_orderkey", payloads.soap_fault(F.col("envelope")).alias("fault"))


def _job_responses(spark, folder):
    """Status as JSON text or object, CHILD as object, array or absent."""
    events = load(spark, folder, "events", "event_id")
    digit = F.col("event_id") % 3
    state = (
        F.when(F.col("event_type") == "purchase", F.lit("SUCCEEDED"))
        .when(F.col("event_type") == "error", F.lit("ERROR"))
        .otherwise(F.lit("RUNNING"))
    )
    child = F.format_string('{"REQUESTID":%d,"JOBNAME":"c%d","STATUS":"%s"}', F.col("event_id") * 2, "user_id", state)
    second = F.format_string('{"REQUESTID":%d,"JOBPATH":"/p"}', F.col("event_id") * 2 + 1)
    children = (
        F.when(digit == 0, F.concat(F.lit(',"CHILD":'), child))
        .when(digit == 1, F.concat(F.lit(',"child":['), child, F.lit(","), second, F.lit("]")))
        .otherwise(F.lit(""))
    )
    job = F.format_string('{"%s":{"REQUESTID":%d,"JOBNAME":"j%d","STATUS":"%s"%s}}',
                          F.when(digit == 2, F.lit("jobs")).otherwise(F.lit("JOBS")), "event_id", "user_id", state, children)
    quoted = F.concat(F.lit('"'), F.replace(job, F.lit('"'), F.lit('\\"')), F.lit('"'))
    status = F.when(F.col("user_id") % 2 == 0, quoted).otherwise(job)
    return events.select("event_id", F.format_string('{"items":[{"ReqstId":9,"RequestStatus":%s}]}', status).alias("response"))


@query(
    """
    SELECT event_id, CAST(event_id AS VARCHAR) AS request_id, 'j' || CAST(user_id AS VARCHAR) AS job_name,
           CASE event_type WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'ERROR' ELSE 'RUNNING' END AS status,
           event_type IN ('purchase', 'error') AS terminal, event_type = 'purchase' AS succeeded,
           CAST(CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS BIGINT) AS child_count
    FROM events
    """
)
def job_status(spark, folder):
    rows = payloads.job_status(_job_responses(spark, folder), "response")
    return rows.select("event_id", "request_id", "job_name", "status", "terminal", "succeeded", "child_count")


@query(
    """
    SELECT event_id, CAST(event_id AS VARCHAR) AS parent_request_id, CAST(event_id * 2 AS VARCHAR) AS request_id,
           'c' || CAST(user_id AS VARCHAR) AS job_name, NULL AS job_path,
           CASE event_type WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'ERROR' ELSE 'RUNNING' END AS status
    FROM events WHERE event_id % 3 IN (0, 1)
    UNION ALL
    SELECT event_id, CAST(event_id AS VARCHAR), CAST(event_id * 2 + 1 AS VARCHAR), NULL, '/p', NULL FROM events WHERE event_id % 3 = 1
    """
)
def job_children(spark, folder):
    return payloads.job_children(_job_responses(spark, folder), "response", keep=["event_id"])


@query(
    """
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'no_items' WHEN 2 THEN 'no_status' WHEN 3 THEN 'no_status'
                                       WHEN 4 THEN 'invalid_json' ELSE 'ok' END AS answer,
           CASE WHEN event_id % 6 = 5 THEN CAST(event_id AS VARCHAR) WHEN event_id % 6 IN (2, 3) THEN '9' END AS request_id
    FROM events
    """
)
def job_answers(spark, folder):
    """Damaged and empty answers are told from good ones."""
    rows, kind = _job_responses(spark, folder), F.col("event_id") % 6
    damaged = (
        F.when(kind == 0, F.concat(F.lit("Service unavailable "), F.col("event_id").cast("string")))
        .when(kind == 1, F.lit('{"items":[]}'))
        .when(kind == 2, F.lit('{"items":[{"ReqstId":9}]}'))
        .when(kind == 3, F.lit('{"items":[{"ReqstId":9,"RequestStatus":"{oops"}]}'))
        .when(kind == 4, F.lit(None).cast("string"))
        .otherwise(F.col("response"))
    )
    return payloads.job_status(rows.withColumn("response", damaged), "response").select("event_id", "answer", "request_id")


def _zip_documents(batches):
    """Each document as a ZIP: its text, an XML note that is broken for short texts, a folder."""
    import io
    import zipfile

    import pyarrow as pa

    def packed(paths, contents):
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    when = datetime.datetime(2024, 1, 1).timetuple()[:6]
    for batch in batches:
        paths, contents, held = [], [], 0
        for path, text, lang in zip(*batch.columns):
            text, lang = text.as_py(), lang.as_py()
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(zipfile.ZipInfo(f"text/{lang}.txt", when), text.encode("utf-8"))
                note = f"<n>{lang}</n>" if len(text) >= 500 else f"<n>{lang}"
                archive.writestr(zipfile.ZipInfo("note.XML", when), note)
                archive.writestr(zipfile.ZipInfo("empty/", when), b"")
            paths.append(path.as_py())
            contents.append(buffer.getvalue())
            held += len(contents[-1])
            if held >= 1 << 20:  # a few archives at a time, whatever the size of a batch
                yield packed(paths, contents)
                paths, contents, held = [], [], 0
        if paths:
            yield packed(paths, contents)


def _archives(spark, folder):
    docs = load(spark, folder, "documents", "doc_id").select(F.col("doc_id").cast("string").alias("path"), "text", "lang")
    return docs.mapInArrow(_zip_documents, "path string, content binary")


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS archive, 'text/' || lang || '.txt' AS member, CAST(strlen(text) AS BIGINT) AS size_bytes,
           false AS is_xml, false AS unsafe_path, NULL AS xml_valid, text FROM documents
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 'note.XML', CAST(strlen('<n>' || lang || CASE WHEN length(text) >= 500 THEN '</n>' ELSE '' END) AS BIGINT),
           true, false, length(text) >= 500, '<n>' || lang || CASE WHEN length(text) >= 500 THEN '</n>' ELSE '' END FROM documents
    """
)
def archive_members(spark, folder):
    return archives.explode_archives(_archives(spark, folder)).drop("error")


@query(
    """
    SELECT 'readable' AS status, CAST(count(*) AS BIGINT) AS archives,
           CAST(count(*) FILTER (WHERE length(text) < 500) AS BIGINT) AS invalid_xml FROM documents
    """
)
def archive_report(spark, folder):
    report = archives.archive_report(archives.explode_archives(_archives(spark, folder)))
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("archives"), F.sum("invalid_xml").alias("invalid_xml"))
