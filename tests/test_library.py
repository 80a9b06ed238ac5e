import csv
import io
import random
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from extractkit.errors import FileFormatError, NameConflictError, ReadOnlyError, StatementError
from extractkit.functions.naming import safe_alias, safe_name
from extractkit.sources import delimited
from extractkit.sources.delimited import infer_types, line_end, quote_blocks, read_checked, read_delimited, records, text_columns
from extractkit.sources.library import assign_aliases, open_data_library
from extractkit.sources.statements import bind


@pytest.fixture
def folder(spark, tmp_path):
    (tmp_path / "Sales Data.csv").write_text("id,amount\n1,10\n2,20\n")
    (tmp_path / "Customers.tsv").write_text("id\tname\n1\tA\n2\tB\n")
    spark.createDataFrame([(1, "N"), (2, "Y")], "id int, status string").coalesce(1).write.parquet(str(tmp_path / "Orders.parquet"))
    return tmp_path


def test_aliases_and_queries(spark, folder):
    with open_data_library(spark, str(folder)) as lib:
        assert lib.count("sales_data") == lib.count("Sales Data") == 2
        assert [r.name for r in lib.query("SELECT c.name FROM customers c JOIN `Sales Data` s ON s.id = c.id WHERE amount > ?", [15]).collect()] == ["B"]
        assert {r.file_type for r in lib.list_files().collect()} == {"csv", "tsv", "parquet"}
        assert {r.table_name for r in lib.query("SELECT table_name FROM library_files WHERE readable").collect()} == {"sales_data", "customers", "orders"}
        assert [r.col_name for r in lib.describe_table("orders").collect()] == ["id", "status"]
        assert lib.preview("orders", 1).count() == 1
        for bad in (0, True, "1"):
            with pytest.raises(ValueError):
                lib.preview("orders", bad)


def test_file_backed_tables_are_read_only(spark, folder):
    lib = open_data_library(spark, str(folder))
    for sql in (
        "UPDATE sales_data SET amount = 1", "DELETE FROM `Sales Data`", "INSERT INTO orders VALUES (3, 'X')",
        "MERGE INTO customers t USING orders s ON t.id = s.id WHEN MATCHED THEN DELETE", "DROP TABLE orders",
        "TRUNCATE TABLE orders", "UPDATE main.orders SET status = 'Z'", "DROP VIEW orders", "/* x */ DELETE FROM ORDERS",
        "ALTER TABLE orders ADD COLUMN z int", "CREATE OR REPLACE TABLE orders AS SELECT 1 AS id",
    ):
        with pytest.raises(ReadOnlyError):
            lib.execute(sql)
    assert lib.count("orders") == 2


@pytest.mark.parametrize("sql", [
    "INSTALL x", "ATTACH 'x'", "PRAGMA y", "LOAD DATA INPATH 'x' INTO TABLE t", "SET a = 1", "CACHE TABLE orders",
    "SELECT 1; DROP TABLE orders", "", "CREATE TABLE t (a int) USING csv LOCATION '/tmp/x'",
    "INSERT OVERWRITE DIRECTORY '/tmp/x' USING csv SELECT 1", "WITH x AS (SELECT 1) DELETE FROM t", "nonsense",
])
def test_refused_statements(spark, folder, sql):
    lib = open_data_library(spark, str(folder))
    with pytest.raises(StatementError):
        lib.execute(sql)
    with pytest.raises(StatementError):
        lib.query("DELETE FROM orders")


@pytest.mark.parametrize("sql", [
    "FROM orders INSERT OVERWRITE DIRECTORY '{0}' USING parquet SELECT *",
    "FROM orders INSERT INTO a SELECT * INSERT INTO b SELECT *",
    "WITH x AS (SELECT 1 AS id) FROM x INSERT OVERWRITE DIRECTORY '{0}' USING parquet SELECT *",
    "CREATE VIEW v AS SELECT 1", "SET a = 1", "CACHE TABLE orders",
])
@pytest.mark.parametrize("read_only", [True, False])
def test_a_query_never_writes(spark, folder, tmp_path, sql, read_only):
    lib = open_data_library(spark, str(folder), read_only=read_only)
    with pytest.raises(StatementError):
        lib.query(sql.format(tmp_path / "written"))
    assert not (tmp_path / "written").exists()


def test_own_tables_are_not_data_files(spark, folder):
    lib = open_data_library(spark, str(folder), str(folder / "managed"))
    before = lib.list_files().count()
    lib.materialize("orders")
    assert lib.refresh().count() == before


def test_managed_tables(spark, folder):
    lib = open_data_library(spark, str(folder))
    assert lib.materialize("Sales Data") == "managed_sales_data"
    with pytest.raises(NameConflictError):
        lib.materialize("customers", "Orders")
    result = lib.execute("UPDATE managed_sales_data SET amount = amount + 1 WHERE id = 1")
    assert result.to_dict()["transaction_committed"] and result.statement_type == "UPDATE"
    with pytest.raises(StatementError):
        lib.execute("UPDATE managed_sales_data SET nope = 1")
    assert sorted(r.amount for r in lib.table("managed_sales_data").collect()) == [11, 20]
    lib.execute("INSERT INTO managed_sales_data (amount) VALUES (5)")
    assert lib.query("SELECT id FROM managed_sales_data WHERE amount = 5").first().id is None
    lib.execute("CREATE TABLE IF NOT EXISTS small (a int, b varchar(3))")
    lib.execute("CREATE TABLE IF NOT EXISTS small (a int)")
    assert lib.table("small").columns == ["a", "b"]
    lib.execute("INSERT OVERWRITE small SELECT 1, 'x'")
    lib.execute("DROP TABLE small")
    lib.execute("DROP TABLE IF EXISTS small")
    assert "small" not in [r.name for r in lib.list_tables().collect()]
    # A new library over the same folder finds the managed table again.
    again = open_data_library(spark, str(folder), read_only=True)
    assert again.count("managed_sales_data") == 3
    with pytest.raises(ReadOnlyError):
        again.execute("DELETE FROM managed_sales_data")
    with pytest.raises(ReadOnlyError):
        again.materialize("orders")


def test_refresh_forgets_deleted_files(spark, folder):
    lib = open_data_library(spark, str(folder))
    (folder / "Customers.tsv").unlink()
    (folder / "broken.parquet").write_text("no parquet")
    listing = {r.table_name: r.readable for r in lib.refresh().collect()}
    assert listing == {"sales_data": True, "orders": True, "broken": False}
    with pytest.raises(Exception):
        lib.count("customers")
    with pytest.raises(FileFormatError):
        open_data_library(spark, str(folder / "nowhere"))


def test_recursion_and_export(spark, folder, tmp_path):
    for name in ("North", "South"):
        (folder / name).mkdir()
        (folder / name / "Sales Data+1.csv").write_text("x\n1\n")
    lib = open_data_library(spark, str(folder))
    assert lib.count("north_sales_data_1") == 1 and lib.count("South/Sales Data+1") == 1
    assert "north_sales_data_1" not in [r.table_name for r in open_data_library(spark, str(folder), recursive=False).list_files().collect()]
    for kind in ("csv", "tsv", "parquet"):
        lib.export("SELECT id, amount FROM sales_data WHERE id > 1", str(tmp_path / f"out_{kind}.{kind}"))
    lib.refresh()
    assert [lib.query(f"SELECT id, amount FROM out_{k}").first()[1] for k in ("csv", "tsv", "parquet")] == [20] * 3
    with pytest.raises(FileFormatError):
        lib.export("orders", str(tmp_path / "x.json"))


def test_alias_rules(spark):
    assert assign_aliases(["Sales Data.csv", "sales_data.csv"]) == {"Sales Data.csv": ("sales_data", "Sales Data"), "sales_data.csv": ("sales_data_2", "sales_data")}
    assert assign_aliases(["N/a.csv", "S/A.csv"]) == {"N/a.csv": ("n_a", "N/a"), "S/A.csv": ("s_a", "S/A")}
    names = ["1st file", "select", "___", "A--B", "é", "x__y_"]
    assert [safe_alias(n) for n in names] == ["t_1st_file", "file_select", "file", "a_b", "file", "x_y"]
    column = spark.createDataFrame([(n,) for n in names], "n string").select(safe_name(F.col("n")).alias("a"))
    assert [r.a for r in column.collect()] == [safe_alias(n) for n in names]


def test_types_of_delimited_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text('code,n,x,d,t,flag,note,none\n007,1,1.5,2024-01-01,2024-01-01 10:00:00,true,"a, ""b""\nc",\n008,,2e3,2024-02-30,2024-01-01 10:00:01,false,z,\n')
    df = read_delimited(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "bigint", "double", "string", "timestamp", "boolean", "string", "string"]
    assert df.collect()[0].note == 'a, "b"\nc'
    assert infer_types(spark.createDataFrame([("99999999999999999999",)], "v string")) == {"v": "double"}


@pytest.fixture
def tiny_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "100b", "spark.sql.files.openCostInBytes": "1b"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def python_rows(text, delimiter):
    return [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=delimiter) if r]


@pytest.mark.parametrize("delimiter", [",", "\t"])
def test_records_over_blocks(spark, tmp_path, tiny_blocks, delimiter):
    rng = random.Random(ord(delimiter))
    values = ["007", "x", "", 'a "quoted" word', "two\nlines", "\n\n", f"a{delimiter}b", 'ends with "', '"', "é" * 20, "long\n" * 60, " "]
    rows = [[str(i), rng.choice(values), rng.choice(values), "end"] for i in range(70)]
    text = io.StringIO(newline="")
    csv.writer(text, delimiter=delimiter, lineterminator="\n").writerows([["id", "a\nb", "c", "d"], *rows])
    path = tmp_path / "in.csv"
    path.write_text(text.getvalue(), newline="")
    assert len(next(iter(quote_blocks(spark, str(path), delimiter).values()))) > 30
    got = text_columns(spark, str(path), delimiter)
    assert got.columns == ["id", "a\nb", "c", "d"] and got.rdd.getNumPartitions() > 10
    assert sorted(map(list, got.fillna("").collect()), key=lambda r: int(r[0])) == rows
    bare = records(spark, str(path), delimiter, header=False)
    found = [next(csv.reader(io.StringIO(r.record, newline=""), delimiter=delimiter)) for r in bare.collect()]
    assert sorted(found) == sorted([["id", "a\nb", "c", "d"], *rows])


def test_quotes_inside_plain_fields_and_files_that_end_inside_quotes(spark, tmp_path, tiny_blocks):
    text = 'a,b\r\n5" pipe,"x\ny"\r\n\r\n7" pipe,"it ""is"" so\n' + "more\n" * 40 + '"\r\nlast,"no end\nhere'
    path = tmp_path / "in.csv"
    path.write_text(text, newline="")
    assert [r.record.split(",")[0] for r in records(spark, str(path)).collect()].count("last") == 1
    got = {r.a: r.b for r in read_delimited(spark, str(path)).collect()}
    assert got['5" pipe'] == "x\ny" and got['7" pipe'] == 'it "is" so\n' + "more\n" * 40 and len(got) == 3


def test_the_state_behind_a_line():
    for line, outside, inside in [
        ("a,b", False, True), ('"a', True, False), ('a,"b', True, False), ('a"b', False, False), ('""', False, True), ('"a""b', True, False), ('"', True, False),
        ('x","y', True, True), ('"a"b,"', True, False), ("", False, True), ('a,""', False, True), ('"""', True, False),
    ]:
        by_csv = []
        for before in ("", '"'):
            closed = list(csv.reader(io.StringIO(before + line + "\nZ\n", newline="")))
            by_csv.append(len(closed) < 2)
        assert line_end(line, False, ",") == by_csv[0] == outside, line
        assert line_end(line, True, ",") == by_csv[1], line


def test_a_changed_block_size_is_noticed(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n" + '1,"x\ny"\n' * 200)
    frame = text_columns(spark, str(path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        with pytest.raises(Exception, match="size of its blocks"):
            frame.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_plain_and_broken_lines_give_the_same_types(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('a,b\n1,"x ""y"""\n007,\n')
    (tmp_path / "broken.csv").write_text('a,b\n1,"x\ny"\n007,\n')
    (tmp_path / "typed.csv").write_text('a,b\n1,"x\ny"\nx,z\n')
    plain, broken = (read_delimited(spark, str(tmp_path / f"{n}.csv")) for n in ("plain", "broken"))
    assert plain.schema == broken.schema and [tuple(r) for r in plain.collect()] == [("1", 'x "y"'), ("007", None)]
    assert [tuple(r) for r in broken.collect()] == [("1", "x\ny"), ("007", None)]
    assert {tuple(r) for r in read_delimited(spark, str(tmp_path / "typed.csv"), schema="n int, s string").collect()} == {(1, "x\ny"), (None, "z")}
    assert {(r.n, r._malformed) for r in read_checked(spark, str(tmp_path / "typed.csv"), "n int, s string").collect()} == {(1, False), (None, True)}


def test_parameters():
    assert bind("a = ? AND b = '?' -- ?\n AND c = ?", [1, "o'x"]) == "a = 1 AND b = '?' -- ?\n AND c = 'o\\'x'"
    for values in ([1, 2], []):
        if values:
            with pytest.raises(StatementError):
                bind("a = ?", values)
    with pytest.raises(StatementError):
        bind("a = ? AND b = ?", [1])


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_records_are_put_together_across_batches(size):
    wanted = [[str(i), random.Random(i).choice(["plain", 'q"q', "line\nbreak", "a\n\nb", ",", ""])] for i in range(120)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([["a", "b"], *wanted])
    lines = text.getvalue().split("\n")[:-1]

    def batch(part):
        return pa.record_batch([["f"] * len(part), pa.array([0] * len(part), pa.int64()), part], ["path", "block", "value"])

    runs = [(f, b, len(v)) for f, b, v in delimited._runs(iter([batch(lines[:5])]))]
    assert runs == [("f", 0, 5)]
    read = delimited._records({"f": {0: (False, 0)}}, ",", True, False)
    found = [r for b in read(iter([batch(lines[i : i + size]) for i in range(0, len(lines), size)])) for r in b.column(3).to_pylist()]
    assert [next(csv.reader(io.StringIO(r))) for r in found] == wanted
