import base64
import io
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entry_queries.metadata import _zip_documents
from extractkit import session
from extractkit.errors import ResolutionError, SchemaMismatchError
from extractkit.functions.naming import archive_type, catalog_path, document_account, is_protected_path, selector_key, singular_key, submission_job_name
from extractkit.operators.catalog import catalog_items, listing_order, plan_copies
from extractkit.operators.profile import summarize
from extractkit.operators.registry import (
    REGISTRY_COLUMNS,
    RegistrySource,
    duplicate_load_files,
    filter_registry,
    match_selectors,
    normalize_registry,
    configuration_lists,
    require_resolved,
    resolve_control_files,
    resolve_requests,
)
from extractkit.sinks.tables import ManagedTables
from extractkit.sources import archives, payloads
from extractkit.sources.archives import archive_report, explode_archives
from extractkit.sources.payloads import any_result_rows, job_children, job_status, result_columns, result_shape, result_rows, soap_fault, with_report_bytes, with_result_xml
from extractkit.streaming.copies import read_folder_stream, stream_upsert


def b64(text):
    return base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()


def values(spark, items, expression):
    df = spark.createDataFrame([(v,) for v in items], "v string")
    return [r.r for r in df.select(expression(F.col("v")).alias("r")).collect()]


REGISTRY = [
    ("Projects", "1", "Project Budgets", "10", "prj/in", "", "/l", "/a/b;c;D", "PjoBudget.ctl", "PJO_PLAN_INT, PJO_PLANS"),
    ("Payables", "2", "Invoices", "20", "fin/ap", "x$", "/l", "job;E", "ApInvoices.ctl", "AP_INVOICES_INT"),
    ("Payables", "2", "Invoices", "20", "fin/ap", "x$", "/l", "job;E", "ApLines.ctl", "AP_LINES_INT"),
    ("Payables", "2", "Invoice", "30", "fin/ap", "y$", "/l", "job;F", "Other.ctl", "SHARED_INT"),
    ("Ledger", "3", "Journals", "40", "fin/gl", "z$", "/l", "job;G", None, "SHARED_INT"),
    ("Ledger", "3", "Entries", "50", "fin/gl", "z$", "/l", "job;G", "", ""),
]


@pytest.fixture(scope="module")
def registry(spark):
    return normalize_registry(spark.createDataFrame(REGISTRY, ", ".join(f"{c.lower()} string" for c in REGISTRY_COLUMNS)))


def test_registry_rules(spark, registry):
    assert registry.where("CONTROL_FILE_NAME = ''").count() == 2
    with pytest.raises(SchemaMismatchError, match="CONTROL_FILE_NAME"):
        normalize_registry(registry.drop("CONTROL_FILE_NAME"))
    assert filter_registry(registry, erp_family="PAYABLES ", control_file_name="aplines.CTL").count() == 1
    assert filter_registry(registry, interface_table="pjo_plans").count() == 1
    assert filter_registry(registry, interface_table="shared_int", application_id="3").count() == 1


def test_fallback(registry):
    source = RegistrySource(lambda: registry.drop("UCM_ACCOUNT"), lambda: registry.limit(2))
    row = source.rows().first()
    assert (row.SOURCE, row.REFRESHED_AT, source.rows().count()) == ("fallback", None, 2) and "UCM_ACCOUNT" in row.REFRESH_ERROR
    live = RegistrySource(lambda: registry)
    assert live.rows(force=True).first().SOURCE == "live" and live.rows().first().REFRESHED_AT is not None
    with pytest.raises(ResolutionError):
        RegistrySource(lambda: registry.drop("UCM_ACCOUNT")).rows()
    with pytest.raises(ValueError):
        live.rows(force=1)


@pytest.mark.parametrize("selector, score, options", [
    ("project-budgets", 100, {"10"}), ("x/APINVOICES.csv", 90, {"20"}), ("ap_lines_int", 80, {"20"}), ("Project Budget", 50, {"10"}),
    ("PjoBudgets", 40, {"10"}), ("PJO_PLAN", 30, {"10"}), ("invoices", 100, {"20"}), ("shared int", 80, {"30", "40"}), ("entry", 50, {"50"}),
])
def test_selector_scores(spark, registry, selector, score, options):
    found = match_selectors(spark.createDataFrame([(selector,), (selector,)], "selector string"), registry).collect()
    assert {r.score for r in found} == {score} and {r.ERP_INTERFACE_OPTIONS_ID for r in found} == options


def test_resolution(spark, registry):
    asked = [
        (1, "Invoices"), (1, "ApLines.csv"), (2, "Invoices"), (2, "Journals"), (3, "shared_int"), (4, "nope"), (4, "Invoices"),
        (5, "Project Budgets"), (6, "shared_int"), (6, "Journals"), (7, " "), (7, "Invoices"),
    ]
    requests = spark.createDataFrame(asked, "request_id int, selector string")
    resolved = resolve_requests(requests, registry)
    status = {r.request_id: r for r in resolved.collect()}
    assert {k: v.status for k, v in status.items()} == {1: "RESOLVED", 2: "CONFLICT", 3: "AMBIGUOUS", 4: "NO_MATCH", 5: "RESOLVED", 6: "RESOLVED", 7: "RESOLVED"}
    assert (status[5].document_account, status[5].job_name) == ("prj$/in$", "a/b;c,D")
    assert status[1].document_account == "x$" and status[6].interface_options_id == "40"
    with pytest.raises(ResolutionError):
        require_resolved(resolved)
    files = {(r.request_id, r.selector): (r.status, r.load_file) for r in resolve_control_files(requests, resolved, registry).collect()}
    assert files[(1, "ApLines.csv")] == ("RESOLVED", "ApLines.csv")
    assert files[(1, "Invoices")] == ("NOT_ONE", None) and files[(6, "Journals")] == ("NOT_ONE", None)
    assert files[(5, "Project Budgets")] == ("RESOLVED", "PjoBudget.csv")
    twice = spark.createDataFrame([(1, "ApLines.csv"), (1, "ap_lines_int")], "request_id int, selector string")
    both = resolve_control_files(twice, resolve_requests(twice, registry), registry)
    assert [r.load_file for r in duplicate_load_files(both).collect()] == ["ApLines.csv"]


def test_a_form_that_all_requests_name_is_never_paired(spark, registry):
    """One list of 300 entries, named by 200 requests: candidates come from the short lists."""
    columns = registry.columns
    base = registry.first().asDict()
    rows = [tuple({**base, "ERP_INTERFACE_OPTIONS_ID": str(i), "BUSINESS_OBJECT": f"Thing Number {i}", "CONTROL_FILE_NAME": f"Own{i}.ctl", "INTERFACE_TABLE_NAMES": "COMMON_INT"}[c] for c in columns) for i in range(300)]
    wide = spark.createDataFrame(rows, registry.schema)
    asked = [(r, s) for r in range(200) for s in ("common_int", f"own{r % 150}.ctl")]
    requests = spark.createDataFrame(asked, "request_id int, selector string")
    found = {r.request_id: (r.status, r.interface_options_id) for r in resolve_requests(requests, wide).collect()}
    assert found == {r: ("RESOLVED", str(r % 150)) for r in range(200)}
    forms = requests.select(selector_key(F.col("selector")).alias("_form")).distinct()
    lists = configuration_lists(forms, wide)
    signatures = requests.groupBy("request_id").agg(F.array_sort(F.collect_set(selector_key(F.col("selector")))).alias("_forms")).select("_forms", F.lit("").alias("_only")).distinct()
    assert signatures.count() == 150 and lists.count() == 450
    one_list = resolve_requests(spark.createDataFrame([(1, "common_int"), (2, "COMMON-INT")], "request_id int, selector string"), wide).collect()
    assert {(r.status, r.common_configurations) for r in one_list} == {("AMBIGUOUS", 300)}


def test_required_option(spark, registry):
    requests = spark.createDataFrame([(1, "shared_int", "30"), (2, "shared_int", "99"), (3, "shared_int", None)], "request_id int, selector string, option string")
    status = {r.request_id: r.status for r in resolve_requests(requests, registry, option="option").collect()}
    assert status == {1: "RESOLVED", 2: "NO_MATCH", 3: "AMBIGUOUS"}


def test_name_forms(spark):
    names = ["Dir/Sub/Ap Invoices.CSV", "x.ctl", ".csv", " a-b/ ", None]
    assert values(spark, names, selector_key) == ["apinvoices", "x", "csv", "ab", ""]
    assert values(spark, ["entries", "ies", "jobs", "s", "job", ""], singular_key) == ["entry", "ie", "job", "s", "job", ""]
    assert values(spark, [" a/b/ ", "/", "", "/x//"], catalog_path) == ["/a/b", "/", None, "/x"]
    paths = ["/", "/Custom/", "/shared folders", "/~ann", "/~ann/x", "/x", "/custom/y"]
    assert values(spark, paths, is_protected_path) == [True, True, True, True, False, False, False]
    assert values(spark, ["/a/b.XDO", "/a.b/c", "/x.xss", "/x.zip"], archive_type) == ["xdoz", "unknown", "xssz", "unknown"]
    assert values(spark, ["a/b/c"], document_account) == ["a$/b$/c$"]
    assert values(spark, ["//p;q;r", "p"], submission_job_name) == ["p;q,r", "p"]


def test_copy_plan(spark):
    requests = spark.createDataFrame(
        [(1, "/a.xdo", "/d1", False), (2, "a.xdo/", "/d2/", False), (3, "/a.xdo", "/d2", True), (4, "/no", "/d2", False)],
        "id int, source_path string, destination_path string, overwrite boolean",
    )
    source = spark.createDataFrame([("/a.xdo",), ("/a.xdo/",)], "absolute_path string")
    target = spark.createDataFrame([("/d2",)], "absolute_path string")
    plan = {r.id: (r.action, r.success, r.object_type) for r in plan_copies(requests, source, target).collect()}
    assert plan == {
        1: ("CREATE", True, "xdoz"), 2: ("BLOCKED_DESTINATION_EXISTS", False, "xdoz"), 3: ("REPLACE", True, "xdoz"), 4: ("SOURCE_MISSING", False, "unknown"),
    }


def test_listing(spark):
    item = "<{0}><absolutePath>{1}</absolutePath><displayName>{2}</displayName><type>{3}</type></{0}>"
    xml = "<r>" + item.format("item", "/z", "zReport", "Report") * 2 + item.format("catalogItem", "/a", "aFolder", "Folder") + "<item/></r>"
    df = spark.createDataFrame([(xml,)], "x string")
    assert [r.display_name for r in catalog_items(df, "x").orderBy(*listing_order()).collect()] == ["aFolder", "zReport"]
    assert catalog_items(df, "x", item_type=" report ").count() == 1


def test_result_documents(spark):
    docs = [
        ("rows", b64("<D><G_1><A>007</A><B> x &amp; y </B></G_1><G_1><A/></G_1></D>")), ("bom", b64("﻿<D><G_1><B>b</B></G_1></D>")), ("empty", ""),
        ("null", None), ("root", b64("<D/>")), ("base64", "@@"), ("utf8", b64(b"<D>\xff</D>")), ("cut", b64("<D><G_1>")), ("blank", b64(" \n")),
    ]
    df = with_result_xml(spark.createDataFrame(docs, "id string, p string"), "p")
    assert {r.id: r.status for r in df.collect()} == {
        "rows": "ok", "bom": "ok", "empty": "empty", "null": "empty", "root": "ok", "base64": "invalid_base64", "utf8": "invalid_utf8", "cut": "invalid_xml", "blank": "empty",
    }
    rows = sorted((tuple(r) for r in result_rows(df, "xml", ["A", "B"], keep=["id"]).collect()), key=repr)
    assert rows == [("bom", None, "b"), ("rows", "007", "x & y"), ("rows", None, None)]
    assert result_columns(df, "xml") == ["A", "B"]


def test_large_payload(spark):
    text = "<D>" + "<G_1><A>value</A></G_1>" * 150_000 + "</D>"
    df = with_result_xml(spark.createDataFrame([(b64(text),)], "p string"), "p")
    assert result_rows(df, "xml", ["A"]).count() == 150_000


def test_envelopes(spark):
    wrap = '<s:E xmlns:s="x" xmlns:n="y"><s:B>{}</s:B></s:E>'.format
    rows = [
        ("ok", wrap("<n:reportBytes> QUJD\n RA== </n:reportBytes>")), ("self", wrap("<reportBytes/>")), ("none", wrap("<n:reportBytes></n:reportBytes>")),
        ("bad", wrap("<reportBytes>@</reportBytes>")), ("miss", wrap("<a/>")), ("cut", "<a><b>"), ("fault", wrap("<s:Fault><faultstring> a &lt; b </faultstring></s:Fault>")),
        ("text", wrap("<s:Fault><s:Text xml:lang='en'>why</s:Text></s:Fault>")),
        ("comment", wrap("<!-- <faultstring>no</faultstring><reportBytes>bm8=</reportBytes> --><s:Fault><faultstring>yes</faultstring></s:Fault>")),
        ("cdata", wrap("<s:Fault><faultstring><![CDATA[a <b> & c]]></faultstring></s:Fault>")), ("number", wrap("<faultstring>&#169;&#xE9; &amp;lt;</faultstring>")),
    ]
    df = with_report_bytes(spark.createDataFrame(rows, "id string, e string"), "e").withColumn("fault", soap_fault(F.col("e")))
    got = {r.id: (r.status, r.report_base64, r.fault) for r in df.collect()}
    assert got["ok"] == ("ok", "QUJDRA==", None) and got["self"][:2] == got["none"][:2] == ("empty", "")
    assert (got["bad"][0], got["miss"][0], got["cut"][0]) == ("invalid_base64", "missing", "invalid_xml")
    assert (got["fault"][2], got["text"][2]) == ("a < b", "why")
    assert got["comment"] == ("missing", None, "yes") and (got["cdata"][2], got["number"][2]) == ("a <b> & c", "©é &lt;")


def test_job_documents(spark):
    texts = [
        '{"items":[{"ReqstId":5,"OperationName":"op","RequestStatus":"{\\"JOBS\\":{\\"REQUESTID\\":1,\\"STATUS\\":\\"Succeeded\\",\\"CHILD\\":{\\"REQUESTID\\":2}}}"}]}',
        '{"items":[{"ReqstId":5,"RequestStatus":{"jobs":{"STATUS":"RUNNING","child":[{"REQUESTID":7,"STATUS":"ERROR"},{"JOBNAME":"c"}]}}}]}',
        '{"items":[]}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, r string")
    got = [tuple(r) for r in job_status(df, "r").select("found", "operation", "request_id", "status", "terminal", "succeeded", "child_count").orderBy("i").collect()]
    assert got == [
        (True, "op", "1", "Succeeded", True, True, 1), (True, "getESSExecutionDetails", "5", "RUNNING", False, False, 2), (False, None, None, None, False, False, 0),
    ]
    children = [(r.i, r.request_id, r.job_name, r.status) for r in job_children(df, "r", keep=["i"]).collect()]
    assert sorted(children, key=repr) == sorted([(0, "2", None, None), (1, "7", None, "ERROR"), (1, None, "c", None)], key=repr)


def test_archives(spark):
    def pack(*members):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            for name, data in members:
                archive.writestr(name, data)
        return buffer.getvalue()

    bomb = '<!DOCTYPE x [<!ENTITY a "aa">]><x>&a;</x>'
    rows = [
        ("good", pack(("a.XDO", "﻿<x/>"), ("d/", ""), ("b.bin", b"\xff"))), ("bad", pack(("../a.txt", "t"), ("c.xml", "<x>"))),
        ("bomb", pack(("c.xml", bomb))), ("none", pack()), ("junk", b"junk"),
    ]
    members = explode_archives(spark.createDataFrame(rows, "path string, content binary"))
    got = {(r.archive, r.member): (r.size_bytes, r.is_xml, r.unsafe_path, r.xml_valid, r.text) for r in members.collect()}
    assert got[("good", "a.XDO")] == (7, True, False, True, "<x/>") and got[("good", "b.bin")] == (1, False, False, None, None)
    assert got[("bad", "../a.txt")][2] and got[("bad", "c.xml")][3] is False and got[("bomb", "c.xml")][3] is False
    assert {r.archive: r.status for r in archive_report(members).collect()} == {"good": "readable", "bad": "unsafe_path", "bomb": "readable", "none": "empty", "junk": "not_an_archive"}


def test_summary(spark):
    df = spark.createDataFrame([(1, "a", None), (3, None, None)], "n int, s string, z double")
    got = {r.column_name: r for r in summarize(df).collect()}
    assert (got["n"].min, got["n"].max, got["n"].avg, got["n"].q50, got["n"].approx_unique, got["n"]["count"]) == ("1", "3", 2.0, "1", 2, 2)
    assert (got["s"].null_percentage, got["z"].null_percentage, got["z"].min) == (50.0, 100.0, None)
    assert summarize(df.limit(0)).first()["count"] == 0


def test_stream_restarts_and_replays(spark, tmp_path):
    schema = "id int, at int, v string"
    tables = ManagedTables(spark, str(tmp_path / "t"))

    def add(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(checkpoint="c", name="s"):
        stream = read_folder_stream(spark, str(tmp_path / "in"), schema)
        stream_upsert(stream, tables, "t", "id", str(tmp_path / checkpoint), stream_name=name, order_col="at").awaitTermination()
        return sorted(tuple(r) for r in tables.read("t").collect())

    add([(1, 1, "a"), (1, 2, "b"), (2, 1, "x")])
    assert run() == [(1, 2, "b"), (2, 1, "x")]
    add([(1, 0, "late"), (3, 1, "n")])
    assert run() == [(1, 0, "late"), (2, 1, "x"), (3, 1, "n")]
    version = tables.version("t").number
    assert run() and tables.version("t").number == version
    # A new checkpoint counts its batches from 0 again; its rows are applied, not taken for old ones.
    assert run("c2") == [(1, 2, "b"), (2, 1, "x"), (3, 1, "n")] and tables.version("t").number == version + 1


def test_rows_of_any_element(spark):
    documents = [
        (1, '<DATA_DS><G_1 id="007"><A>007</A><B> x </B></G_1><G_1><A>2</A><C> </C></G_1></DATA_DS>'),
        (2, '<R about="all"><ROW><A>1</A><D>a&amp;b</D></ROW></R>'), (3, "<DATA_DS/>"), (4, '<D><p:G_1 xmlns:p="u"><p:B>ns</p:B></p:G_1><H z="1">t</H><H>u</H></D>'), (5, None),
        (6, '<D><ROW id="attribute"><id>child</id></ROW></D>'),
    ]
    frame = spark.createDataFrame(documents, "k int, x string")
    shape = result_shape(frame, "x")
    assert set(shape) == {"G_1", "ROW", "H"} and {"A", "B", "@id"} <= set(shape["G_1"]) and shape["H"] == ["#", "@z"]
    rows = any_result_rows(frame, "x", keep=["k"])
    got = sorted((r.asDict() for r in rows.collect()), key=lambda r: (r["k"], str(r["A"]), str(r["H"])))
    told = [{n: v for n, v in r.items() if v is not None and n != "p"} for r in got]
    assert told == [
        {"k": 1, "A": "007", "B": "x", "id": "007"}, {"k": 1, "A": "2"}, {"k": 2, "A": "1", "D": "a&b"}, {"k": 4, "B": "ns"}, {"k": 4, "H": "t", "z": "1"},
        {"k": 4, "H": "u"}, {"k": 6, "id": "child"},
    ]
    assert any_result_rows(frame.where("k = 3"), "x", keep=["k"]).count() == 0


def test_a_fault_is_read_by_one_parse_of_its_document(spark):
    cases = {
        "<e><faultstring> a &lt; b </faultstring><Fault><Text>no</Text></Fault></e>": "a < b",
        "<e><FaultString> </FaultString><x:Fault xmlns:x='u'><x:Text>second</x:Text></x:Fault></e>": "second",
        "<e><faultstring/><Text>outside</Text></e>": None,
        "<e><!-- <faultstring>no</faultstring> --></e>": None,
        "<e><faultstring>cut off</e>": None,
        "<e>plain</e>": None,
        None: None,
    }
    rows = spark.createDataFrame([(i, xml) for i, xml in enumerate(cases)], "id int, xml string")
    faults = rows.select("id", payloads.soap_fault(F.col("xml")).alias("fault"))
    assert [r.fault for r in faults.orderBy("id").collect()] == list(cases.values())
    parses = str(payloads.soap_fault(F.col("xml")))
    assert parses.count("xpath") == 1 and parses.count("from_xml") == 1


def test_heavy_rows_are_split_into_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    assert session.spread(spark.range(0, 1000, 1, 16), "id", rows=1000).rdd.getNumPartitions() == 100
    assert session.spread(spark.range(0, 100, 1, 16), "id", rows=100).rdd.getNumPartitions() == 16


def test_members_of_small_archives_share_a_batch_and_large_ones_do_not():
    def packed(text):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("a.txt", text)
            archive.writestr("b.xml", "<b/>")
        return buffer.getvalue()

    def batches(texts):
        return archives._member_batches(iter([pa.record_batch([[f"z{i}" for i in range(len(texts))], [packed(t) for t in texts]], ["archive", "content"])]))

    small = list(batches(["t"] * 200))
    assert [b.num_rows for b in small] == [400]
    assert small[0].column(1).to_pylist()[:2] == ["a.txt", "b.xml"] and small[0].column(7).to_pylist()[:2] == ["t", "<b/>"]
    assert [b.num_rows for b in batches(["x" * 5_000_000] * 3)] == [1, 2, 2, 1]


def test_archives_are_built_a_few_at_a_time():
    texts = [random.Random(i).randbytes(40_000).hex() for i in range(100)]
    built = list(_zip_documents(iter([pa.record_batch([[str(i) for i in range(100)], texts, ["en"] * 100], ["path", "text", "lang"])])))
    assert sum(b.num_rows for b in built) == 100 and max(b.nbytes for b in built) < 1_200_000
