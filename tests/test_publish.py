import json

import pytest
from pyspark.sql import functions as F

from extractkit.errors import FingerprintError, NameConflictError, RowCountError, SourceChangedError
from extractkit.operators import checks, paging, sketches
from extractkit.operators.paging import plan_chunks
from extractkit.plans.copy import copy_query
from extractkit.sinks import delimited, parts
from extractkit.sinks.delimited import join_files, write_single_csv
from extractkit.sinks.filesystem import Files
from extractkit.sinks.load_files import load_file_name, write_load_files
from extractkit.sinks.parts import read_manifest, read_parts, verify_parts, write_parts
from extractkit.sources.delimited import read_checked
from extractkit.streaming.copies import read_folder_stream, stream_parts


def status(spark, folder):
    return {r.status: r["count"] for r in verify_parts(spark, folder).groupBy("status").count().collect()}


def test_parts_and_manifest(spark, tmp_path):
    df = spark.range(9).select(F.col("id").alias("ID"))
    out = str(tmp_path / "out")
    result = write_parts(df, out, "ID", chunk_size=2)
    assert (result.rows, result.part_count, result.plan.total_chunks) == (9, 5, 5)
    manifest = read_manifest(spark, out)
    assert [(f["row_offset"], f["row_limit"], f["rows"]) for f in manifest["files"]] == [(0, 2, 2), (2, 2, 2), (4, 2, 2), (6, 2, 2), (8, 1, 1)]
    assert all(len(f["sha256"]) == 64 for f in manifest["files"])
    assert manifest["written_rows"] == 9 and manifest["columns"] == ["ID"]
    assert status(spark, out) == {"ok": 5}
    assert sorted(r.ID for r in read_parts(spark, out, ["ID"]).collect()) == [str(i) for i in range(9)]
    assert not list(tmp_path.glob(".*"))


def test_row_order_inside_parts(spark, tmp_path):
    df = spark.range(50).select((F.col("id") * 7 % 53).alias("k"))
    out = str(tmp_path / "out")
    write_parts(df, out, "k desc", chunk_size=20, output_format="csv", start_offset=3, max_rows=45)
    found = []
    for item in read_manifest(spark, out)["files"]:
        text = (tmp_path / "out" / item["part"]).read_text().splitlines()
        assert text[0] == "k"
        found += [int(v) for v in text[1:]]
    assert found == sorted((i * 7 % 53 for i in range(50)), reverse=True)[3:48]


def test_resume_keeps_verified_parts(spark, tmp_path, monkeypatch):
    df = spark.range(40).select("id")
    out, work = str(tmp_path / "out"), tmp_path / ".out.extract-work"
    real, calls = parts._write, []

    def fail_on_third(*args):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("disk gone")
        real(*args)

    monkeypatch.setattr(parts, "_write", fail_on_third)
    with pytest.raises(OSError):
        write_parts(df, out, "id", chunk_size=10, chunks_per_wave=1, query="q")
    state = json.loads((work / "checkpoint.json").read_text())
    assert state["status"] == "failed" and len(state["files"]) == 2
    monkeypatch.setattr(parts, "_write", real)
    with pytest.raises(FingerprintError):
        write_parts(df, out, "id", chunk_size=10, query="another")
    for other in ({"df": df.select((F.col("id") + 1).alias("id"))}, {"df": df, "output_format": "csv"}, {"df": df, "all_varchar": False}):
        with pytest.raises(FingerprintError):
            write_parts(**{"output_directory": out, "order_by": "id", "chunk_size": 10, "query": "q", **other})
    # A damaged part is written again, the other one is kept.
    (work / "parts" / state["files"][0]["part"]).write_bytes(b"broken")
    result = write_parts(df, out, "id", chunk_size=10, query="q")
    assert result.resumed_parts == 1 and result.rows == 40
    assert status(spark, out) == {"ok": 4}
    assert read_parts(spark, out).select("id").distinct().count() == 40


def counted(spark, df):
    """``df`` and a counter of the rows that evaluations of it give."""
    reads = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), reads


@pytest.mark.parametrize("waves", [None, 2])
@pytest.mark.parametrize("key", ["id", "id % 7"])
def test_the_source_is_evaluated_twice(spark, tmp_path, key, waves):
    rows = spark.range(600).select(F.expr(key).alias("k"), F.col("id").alias("v"))
    source, reads = counted(spark, rows)
    out = str(tmp_path / "out")
    assert write_parts(source, out, "k", chunk_size=50, chunks_per_wave=waves).part_count == 12
    assert reads.value <= 2 * 600
    assert status(spark, out) == {"ok": 12} and read_parts(spark, out).select("v").distinct().count() == 600


def test_a_source_that_changes_is_not_published(spark, tmp_path):
    changing = spark.range(100).select("id", F.expr("uuid()").alias("v"))
    other = changing.withColumn("v", F.udf(lambda: __import__("uuid").uuid4().hex).asNondeterministic()())
    with pytest.raises(SourceChangedError):
        write_parts(other, str(tmp_path / "out"), "id", chunk_size=10)
    assert not (tmp_path / "out").exists()


def test_parts_without_a_checkpoint_are_cleared(spark, tmp_path):
    out, work = str(tmp_path / "out"), tmp_path / ".out.extract-work"
    (work / "parts" / "chunk_id=0").mkdir(parents=True)
    (work / "parts" / "chunk_id=0" / "part-left.parquet").write_bytes(b"left over")
    assert write_parts(spark.range(10).select("id"), out, "id", chunk_size=5).part_count == 2
    assert status(spark, out) == {"ok": 2}


def test_a_swap_that_was_cut_off_is_undone(spark, tmp_path):
    out = tmp_path / "out"
    write_parts(spark.range(10).select("id"), str(out), "id", chunk_size=5)
    out.rename(tmp_path / ".out.old")  # the process died between the two renames
    assert status(spark, str(out)) == {"ok": 2} and not (tmp_path / ".out.old").exists()
    (tmp_path / ".out.old").mkdir()  # it died before the old folder was deleted
    assert write_parts(spark.range(20).select("id"), str(out), "id", chunk_size=5).part_count == 4
    assert not (tmp_path / ".out.old").exists() and status(spark, str(out)) == {"ok": 4}


def test_sketches_of_parts(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id"), (F.col("id") % 700).cast("double").alias("x"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 90)).alias("t"), F.lit(None).cast("int").alias("none"))
    out = str(tmp_path / "out")
    write_parts(rows, out, "id", chunk_size=3000, all_varchar=False)
    parts_of = sketches.sketch_parts(spark, out)
    assert parts_of.count() == 7 * 4 and sketches.sketch_parts(spark, out).count() == 7 * 4  # the second time nothing is new
    assert status(spark, out) == {"ok": 7}
    figures = sketches.sketch_figures(sketches.merged_sketches(parts_of))
    told = {r.column_name: r for r in figures.collect()}
    assert told["t"].filled == 13_333 and told["none"].distinct_values == 0 and told["none"].q50 is None and told["t"].q50 is None
    assert abs(told["x"].distinct_values - 700) <= 35 and abs(told["id"].q50 - 10_000) <= 300
    found = {r.column_name: (r.distinct_ok, r.ranks_ok) for r in sketches.sketch_errors(rows, figures).collect()}
    assert found == {"id": (True, True), "x": (True, True), "t": (True, None), "none": (True, None)}
    wrong = figures.withColumns({"q50": F.col("q50") * 1.2, "distinct_values": F.col("distinct_values") * 2})
    assert {r.column_name: (r.distinct_ok, r.ranks_ok) for r in sketches.sketch_errors(rows, wrong).collect()}["id"] == (False, False)


def test_map_columns(spark, tmp_path):
    rows = spark.range(10).select("id", F.create_map(F.lit("a"), "id").alias("m"))
    assert write_parts(rows, str(tmp_path / "out"), "id", chunk_size=4, all_varchar=False).rows == 10
    assert paging.page(rows, "id", 3, 2).count() == 2


def test_resume_off_starts_again(spark, tmp_path, monkeypatch):
    df = spark.range(10).select("id")
    monkeypatch.setattr(parts, "_check_counts", lambda *a: (_ for _ in ()).throw(RowCountError("short")))
    with pytest.raises(RowCountError):
        write_parts(df, str(tmp_path / "out"), "id", chunk_size=5)
    monkeypatch.undo()
    assert write_parts(df, str(tmp_path / "out"), "id", chunk_size=2, resume=False).resumed_parts == 0


def test_failure_keeps_the_old_destination(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    write_parts(spark.range(3).select("id"), out, "id", chunk_size=2)
    monkeypatch.setattr(parts, "_describe", lambda *a: [])
    with pytest.raises(RowCountError):
        write_parts(spark.range(30).select("id"), out, "id", chunk_size=10)
    monkeypatch.undo()
    assert status(spark, out) == {"ok": 2}
    with pytest.raises(FileExistsError):
        write_parts(spark.range(3).select("id"), out, "id", overwrite=False)


def test_verify_finds_every_state(spark, tmp_path):
    out = str(tmp_path / "out")
    write_parts(spark.range(8).select("id"), out, "id", chunk_size=2)
    first, second = [tmp_path / "out" / f["part"] for f in read_manifest(spark, out)["files"][:2]]
    first.unlink()
    second.write_bytes(b"x")
    (first.parent / "part-other.parquet").write_bytes(b"y")
    assert status(spark, out) == {"missing": 1, "changed": 1, "ok": 2, "unexpected": 1}


def test_ties_and_empty_results(spark, tmp_path):
    ties = spark.range(30).select((F.col("id") % 2).alias("k"), F.lit("same").alias("v"))
    assert write_parts(ties, str(tmp_path / "ties"), "k", chunk_size=4).part_count == 8
    empty = write_parts(ties.limit(0), str(tmp_path / "none"), "k")
    assert (empty.rows, empty.part_count, empty.columns) == (0, 0, 2)


def test_single_file_text(spark, tmp_path):
    data = [(1, "A|B"), (2, ' x"y '), (3, "l1\nl2"), (4, ""), (5, None), (6, "é")]
    df = spark.createDataFrame(data, "ID bigint, TEXT string")
    path = tmp_path / "one.csv"
    write_single_csv(df, str(path), "ID", delimiter="|", chunk_size=2)
    assert path.read_bytes() == '﻿ID|TEXT\n1|"A|B"\n2|" x""y "\n3|"l1\nl2"\n4|\n5|\n6|é\n'.encode("utf-8")
    write_single_csv(df, str(path), "ID desc", encoding="utf-8", include_header=False, max_rows=2, quote_all=True)
    assert path.read_text() == '"6","é"\n"5",""\n'
    write_single_csv(df.select("TEXT").where("ID > 3"), str(path), encoding="utf-8")
    assert path.read_text() == 'TEXT\n""\n""\né\n'
    with pytest.raises(FileExistsError):
        write_single_csv(df, str(path), overwrite=False)
    for bad in ({"delimiter": "||"}, {"delimiter": "\n"}, {"quote": ""}, {"encoding": "klingon"}):
        with pytest.raises(ValueError):
            write_single_csv(df, str(path), **bad)


def test_single_file_failure_keeps_the_old_one(spark, tmp_path):
    path = tmp_path / "one.csv"
    write_single_csv(spark.range(2), str(path), encoding="utf-8")
    with pytest.raises(Exception):
        write_single_csv(spark.range(2).select(F.raise_error(F.lit("no")).alias("x")), str(path))
    assert path.read_text() == "id\n0\n1\n"
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["one.csv"]


def test_copy_query_modes(spark, tmp_path):
    with pytest.raises(ValueError):
        copy_query(spark.range(2), str(tmp_path / "x"), output_mode="many")
    with pytest.raises(ValueError):
        copy_query(spark.range(2), str(tmp_path / "x"), output_mode="part_files")
    assert copy_query(spark.range(2), str(tmp_path / "x"), order_by="id", output_mode="part_files").rows == 2


def test_load_files(spark, tmp_path):
    assert [load_file_name(n) for n in ("a/Gl.ctl", "Gl", "x.y.ctl")] == ["Gl.csv", "Gl.csv", "x.y.csv"]
    df = spark.createDataFrame([("a", None), ('b"c', "d,e")], "x string, y string")
    out = write_load_files(str(tmp_path), {"Gl.ctl": df, "Ap.ctl": df.limit(1)}, order_by="x")
    assert out["rows"] == 3
    assert (tmp_path / "Gl.csv").read_text() == 'a,\n"b""c","d,e"\n'
    with pytest.raises(NameConflictError):
        write_load_files(str(tmp_path), {"a/Gl.ctl": df, "b/Gl.ctl": df})


def test_stream_with_manifest(spark, tmp_path):
    spark.range(100).select("id").repartition(4, "id").write.parquet(str(tmp_path / "in"))

    def run():
        stream = read_folder_stream(spark, str(tmp_path / "in"), "id bigint", max_files=2)
        stream_parts(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
        return parts.write_dataset_manifest(spark, str(tmp_path / "out"))

    assert run()["written_rows"] == 100 and status(spark, str(tmp_path / "out")).keys() == {"ok"}
    spark.range(100, 150).select("id").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run()["written_rows"] == 150
    assert spark.read.parquet(str(tmp_path / "out")).distinct().count() == 150


def test_malformed_rows_of_a_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,v\n1,a\n2,b,c\nx,d\n,e\n1,f\n")
    rows = read_checked(spark, str(tmp_path / "in.csv"), "id int, v string")
    rows = rows.withColumn("row_no", F.monotonically_increasing_id()).withColumn("chunk_id", F.lit(0))
    report = checks.validate_extract(rows, "id", malformed=F.col("_malformed")).first()
    assert (report.rows, report.malformed_rows, report.duplicate_keys) == (5, 2, 2)
    assert report.empty_keys == 2


def test_reconcile_raises(spark):
    planned = spark.createDataFrame([(0, 2), (1, 1)], "chunk_id int, row_limit int")
    actual = spark.createDataFrame([(0,), (1,), (1,), (5,)], "chunk_id int")
    report = {r.chunk_id: r.status for r in checks.reconcile(planned, actual).collect()}
    assert report == {0: "short", 1: "over", 5: "over"}
    with pytest.raises(RowCountError):
        checks.require_reconciled(checks.reconcile(planned, actual))
    assert plan_chunks(3, 2).to_dict()["total_chunks"] == 2


def test_pieces_of_one_file_are_as_few_as_its_tasks(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(delimited, "join_files", lambda s, pieces, *rest: (seen.extend(pieces), join(s, pieces, *rest)))
    join = join_files
    result = write_single_csv(spark.range(5_000).selectExpr("4999 - id AS a"), str(tmp_path / "n.csv"), "a", chunk_size=10, encoding="utf-8")
    assert result["chunks"] == 500 and len(seen) <= 4 * 4
    assert (tmp_path / "n.csv").read_text().split() == ["a", *map(str, range(5_000))]


def test_ties_keep_their_pieces_in_order(spark, tmp_path):
    write_single_csv(spark.range(5_000).selectExpr("id % 7 AS a", "id"), str(tmp_path / "t.csv"), "a", chunk_size=10, encoding="utf-8")
    found = [int(line.split(",")[0]) for line in (tmp_path / "t.csv").read_text().split()[1:]]
    assert found == sorted(found) and len(found) == 5_000


def test_whole_texts_of_one_file_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    from entry_queries.extract import single_csv_texts

    odd = ['a,b\n"c"\n', "x\r\ny", "x\ry", "\n", '"', "é\n" * 50]
    rows = [(i, odd[i % len(odd)] + "w" * 500, "en") for i in range(600)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        found = single_csv_texts(spark, str(tmp_path))
        assert sorted(map(tuple, found.collect())) == rows
        assert found.groupBy(F.spark_partition_id()).count().count() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parts_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    calls = []
    monkeypatch.setattr(Files, "walk", lambda self, path, prefix="": calls.append(path) or [])
    target = str(tmp_path / "d")
    write_parts(spark.range(100), target, "id", chunk_size=10)
    work = tmp_path / ".d.extract-work"
    whole = read_manifest(spark, target)
    work.mkdir()
    (tmp_path / "d").rename(work / "parts")
    (work / "parts" / "stray.txt").write_text("x")
    state = {"status": "failed", "fingerprint": whole["fingerprint"], "plan": whole["plan"], "files": whole["files"][:4]}
    Files(spark).write_json(str(work / "checkpoint.json"), state)
    assert write_parts(spark.range(100), target, "id", chunk_size=10).resumed_parts == 4
    assert read_parts(spark, target).count() == 100 and not calls
    assert not (tmp_path / "d" / "stray.txt").exists()


def test_errors_of_sketches_copy_no_rows(spark):
    rows = spark.range(2_000).selectExpr("id % 500 AS a", "IF(id % 3 = 0, NULL, id / 7.0D) AS b", "CAST(NULL AS STRING) AS c")
    figures = sketches.sketch_figures(sketches.column_sketches(rows))
    errors = sketches.sketch_errors(rows, figures)
    assert "Expand" not in errors._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in errors.collect()} == {("a", True, True), ("b", True, True), ("c", True, None)}
    wrong = figures.withColumn("distinct_values", F.lit(9).cast("bigint")).withColumn("q50", F.when(F.col("q50").isNotNull(), F.lit(-1.0)))
    assert {tuple(r) for r in sketches.sketch_errors(rows, wrong).collect()} == {("a", False, False), ("b", False, False), ("c", False, None)}
