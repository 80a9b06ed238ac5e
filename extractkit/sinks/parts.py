"""Part datasets: one file per chunk, a manifest, verification, resume, swap."""

from __future__ import annotations

import hashlib
import time
from dataclasses import asdict, dataclass

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import FingerprintError, RowCountError, SourceChangedError
from ..operators.checks import remaining
from ..operators.paging import ChunkLayout, ChunkPlan, among, chunk_table, digest_terms, order_keys, plan_chunks, survey
from .delimited import chunk_of, csv_options, with_chunk_column
from .filesystem import Files

FORMATS = ("parquet", "csv")
MANIFEST = "manifest.json"
PART_SCHEMA = (
    "part string, chunk_id bigint, rows bigint, row_offset bigint, row_limit bigint, "
    "bytes bigint, sha256 string"
)


@dataclass(frozen=True)
class PartsResult:
    output_directory: str
    manifest_file: str
    rows: int
    columns: int
    part_count: int
    resumed_parts: int
    output_format: str
    elapsed_seconds: float
    rows_per_second: float
    plan: ChunkPlan

    def to_dict(self) -> dict:
        return asdict(self)


def fingerprint(query: str, contents: str, order_by, plan: ChunkPlan, **options) -> str:
    """What a resumed run must share with the run that left the work folder: input, order, plan and writer options."""
    terms = [(key.name, key.descending) for key in order_keys(order_by)]
    parts = [query.strip(), contents, repr(terms), repr(plan), repr(sorted(options.items()))]
    return hashlib.sha256("\0".join(parts).encode("utf-8")).hexdigest()


def _part_name(path: str):
    """Part name relative to the dataset folder, from a full URI column."""
    return F.regexp_extract(F.url_decode(path), r"((?:chunk_id=\d+/)?[^/]+)$", 1)


def part_hashes(spark: SparkSession, folder: str | list[str], *, tolerant: bool = True) -> DataFrame:
    """``part, bytes, sha256`` of every part file, hashed by the tasks that read it.

    A file that is listed but cannot be read has the hash ``unreadable``, unless
    ``tolerant`` is off, as for files just written: then the job fails.
    """
    found = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="part-*")
    if not tolerant:
        hashed = found.load(folder)
        return hashed.select(_part_name("path").alias("part"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    listed = found.load(folder).select(_part_name("path").alias("part"), F.col("length").alias("bytes"))
    hashed = found.option("ignoreCorruptFiles", "true").load(folder)
    hashed = hashed.select(_part_name("path").alias("part"), F.sha2("content", 256).alias("_hash"))
    both = listed.join(hashed, "part", "left")
    return both.select("part", "bytes", F.coalesce("_hash", F.lit("unreadable")).alias("sha256"))


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names of all files of a dataset; listed by Spark's tasks, as there is a folder for each chunk."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return [row["part"] for row in found.select(_part_name("path").alias("part")).collect()]


def read_parts(spark: SparkSession, folder: str | list[str], columns: list[str] | None = None, output_format: str = "parquet",
               *, delimiter: str = ",", include_header: bool = True) -> DataFrame:
    """The rows of a part dataset, without the chunk column unless asked for."""
    if output_format == "parquet":
        df = spark.read.parquet(*([folder] if isinstance(folder, str) else folder))
    else:
        schema = ", ".join(f"`{name}` string" for name in columns or ())
        reader = spark.read.options(**csv_options(delimiter, header=include_header)).option("multiLine", "true")
        df = (reader.schema(schema) if schema else reader).csv(folder)
    return df if columns is None else df.select(*[f"`{name}`" for name in columns])


def part_rows(spark: SparkSession, folder: str | list[str], output_format: str, columns: list[str], **text) -> DataFrame:
    """``part, rows``; for Parquet only footers are read."""
    rows = read_parts(spark, folder, columns, output_format, **text)
    counted = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(_part_name("path").alias("part"), "rows")


def part_columns(spark: SparkSession, folder: str, delimiter: str = ",") -> DataFrame:
    """``part, columns array<string>`` taken from each file itself.

    Only a Parquet file's footer or a text file's first line goes to Python.
    """

    def names(batches):
        import csv
        import io

        for batch in batches:
            out = []
            for path, head in zip(batch["path"], batch["head"]):
                if path.endswith(".parquet"):
                    out.append(pq.read_schema(io.BytesIO(b"PAR1" + head)).names)
                else:
                    out.append(next(csv.reader([head.decode("utf-8-sig")], delimiter=delimiter)))
            yield batch[["path"]].assign(columns=out)

    content = F.col("content")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    # The four bytes before the closing mark hold the footer's length, lowest byte first.
    size = F.conv(F.hex(F.reverse(F.substring(content, -8, 4))), 16, 10).cast("int")
    footer = F.substring(content, -(size + 8), size + 8)
    line = F.substring_index(content.cast("string"), "\n", 1).cast("binary")
    return (
        found.option("pathGlobFilter", "part-*").load(folder)
        .select(F.url_decode("path").alias("path"), F.when(F.col("path").endswith(".parquet"), footer).otherwise(line).alias("head"))
        .mapInPandas(names, "path string, columns array<string>")
        .select(F.col("path").alias("part"), "columns")
    )


def manifest_parts(spark: SparkSession, manifest: dict) -> DataFrame:
    """The part entries of a manifest as rows."""
    names = [field.split()[0] for field in PART_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(item[n] for n in names) for item in manifest["files"]], PART_SCHEMA)


def read_manifest(spark: SparkSession, folder: str) -> dict:
    files = Files(spark)
    target = files.qualified(folder).rstrip("/")
    restore(files, target)
    return files.read_json(f"{target}/{MANIFEST}")


def write_dataset_manifest(
    spark: SparkSession, folder: str, output_format: str = "parquet", columns: list[str] | None = None, **text
) -> dict:
    """Record the files of a dataset written by other means, such as a stream.

    Only files a read of the dataset sees are listed, so leftovers of failed
    batches stay out.
    """
    names = columns or read_parts(spark, folder).columns
    counted = part_rows(spark, folder, output_format, names, **text)
    counts = {row["part"]: row["rows"] for row in counted.collect()}
    unset = {"chunk_id": None, "row_offset": None, "row_limit": None}
    found = [
        {**item.asDict(), "rows": counts[item["part"]], **unset}
        for item in part_hashes(spark, folder).orderBy("part").collect()
        if item["part"] in counts
    ]
    manifest = {
        "status": "complete",
        "written_rows": sum(item["rows"] for item in found),
        "columns": names,
        "output_format": output_format,
        "files": found,
    }
    Files(spark).write_json(f"{folder.rstrip('/')}/{MANIFEST}", manifest)
    return manifest


def compare_parts(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """``part, status``: ok, missing, changed, or unexpected."""
    a = recorded.select("part", F.col("sha256").alias("recorded"))
    b = found.select("part", F.col("sha256").alias("actual"))
    status = (
        F.when(F.col("actual").isNull(), F.lit("missing"))
        .when(F.col("recorded").isNull(), F.lit("unexpected"))
        .when(F.col("recorded") != F.col("actual"), F.lit("changed"))
        .otherwise(F.lit("ok"))
    )
    return a.join(b, "part", "full").select("part", status.alias("status"))


def verify_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Check a published dataset against its manifest."""
    return compare_parts(manifest_parts(spark, read_manifest(spark, folder)), part_hashes(spark, folder))


def _describe(spark, folder: str, wave: set[int], plan: ChunkPlan, output_format: str, columns, text) -> list[dict]:
    """Manifest entries of the chunks a wave has written."""
    folders = folder
    if len(wave) < plan.total_chunks:  # beside parts that are described already
        present = {chunk_of(path) for path in listed(spark, folder)}
        folders = [f"{folder}/chunk_id={chunk}" for chunk in sorted(wave & present)]
    hashes = part_hashes(spark, folders, tolerant=False).collect() if folders else []
    if not hashes:
        return []
    # Two small results, put together here: a join would have the optimizer test
    # the part name of every row before they are counted.
    counts = {row["part"]: row["rows"] for row in part_rows(spark, folders, output_format, columns, **text).collect()}
    described = []
    for entry in hashes:
        done = chunk_of(entry["part"]) * plan.chunk_size
        described.append(
            {
                "part": entry["part"],
                "chunk_id": chunk_of(entry["part"]),
                "rows": counts.get(entry["part"], 0),
                "row_offset": plan.start_offset + done,
                "row_limit": min(plan.chunk_size, plan.planned_rows - done),
                "bytes": entry["bytes"],
                "sha256": entry["sha256"],
            }
        )
    return described


def write_parts(
    df: DataFrame,
    output_directory: str,
    order_by,
    *,
    query: str = "",
    chunk_size: int | str = "auto",
    start_offset: int = 0,
    max_rows: int | None = None,
    max_file_rows: int | None = None,
    output_format: str = "parquet",
    delimiter: str = ",",
    include_header: bool = True,
    encoding: str = "utf-8",
    all_varchar: bool = True,
    overwrite: bool = True,
    resume: bool = True,
    chunks_per_wave: int | None = None,
) -> PartsResult:
    """Publish an ordered result as one file per chunk with a manifest.

    The source is evaluated twice: once for its count, digest and order key, once for the rows,
    which are shuffled to their chunks and written by one job.  What the second evaluation gives is
    observed as it is written and must be what the first one saw.  A later run with the same fingerprint keeps the parts that still
    verify and writes the others.  ``chunks_per_wave`` makes what is finished safe more
    often: rows are then put aside in their chunks first, and each wave of parts is hashed and recorded
    before the next begins.  The old destination stays in place until everything has been counted and checked.
    """
    spark = df.sparkSession
    started = time.perf_counter()
    files = Files(spark)
    if output_format not in FORMATS:
        raise ValueError("output_format must be 'csv' or 'parquet'.")
    target = files.qualified(output_directory).rstrip("/")
    restore(files, target)
    if files.exists(target) and not overwrite:
        raise FileExistsError(f"Destination already exists: {output_directory}")
    text = {"delimiter": delimiter, "include_header": include_header}
    columns = df.columns
    folder, _, name = target.rpartition("/")
    work = f"{folder}/.{name}.extract-work"
    parts, checkpoint = f"{work}/parts", f"{work}/checkpoint.json"
    if files.exists(work) and not (resume and files.exists(checkpoint)):
        files.delete(work)  # parts that no checkpoint knows cannot be told from whole ones
    totals, keys = survey(df, order_by, f"{work}/keys")
    plan = plan_chunks(
        totals["rows"], chunk_size, max_rows=max_rows, max_file_rows=max_file_rows, start_offset=start_offset
    )
    contents = f"{df.schema.json()} {totals['one']} {totals['two']}"
    mark = fingerprint(query, contents, order_by, plan, format=output_format, encoding=encoding, all_varchar=all_varchar, **text)

    done: list[dict] = []
    if files.exists(checkpoint):
        state = files.read_json(checkpoint)
        if state["fingerprint"] != mark:
            raise FingerprintError("The work folder belongs to another query or plan.")
        done = _verified(spark, files, parts, state)
    files.make_folder(parts)
    resumed = len(done)

    def save(status: str) -> None:
        files.write_json(checkpoint, {"status": status, "fingerprint": mark, "plan": plan.to_dict(), "files": done})

    save("running")
    try:
        recorded = manifest_parts(spark, {"files": done})
        todo = sorted(row["chunk_id"] for row in remaining(chunk_table(spark, plan), recorded).select("chunk_id").collect())
        for wave, chunks in _waves(df, order_by, plan, keys, todo, chunks_per_wave, totals, work):
            _write(with_chunk_column(chunks, columns, all_varchar), parts, output_format, text, encoding)
            done.extend(_describe(spark, parts, wave, plan, output_format, columns, text))
            save("running")
        done.sort(key=lambda item: (item["chunk_id"], item["part"]))
        _check_counts(done, plan)
        manifest = {
            "status": "complete",
            "total_source_rows": plan.total_rows,
            "planned_rows": plan.planned_rows,
            "written_rows": sum(item["rows"] for item in done),
            "columns": columns,
            "output_format": output_format,
            "order_by": [f"{k.name}{' desc' if k.descending else ''}" for k in order_keys(order_by)],
            "plan": plan.to_dict(),
            "fingerprint": mark,
            "resumed_parts": resumed,
            "files": done,
        }
        files.write_json(f"{parts}/{MANIFEST}", manifest)
        swap_in(files, parts, target)
        files.delete(work)
    except Exception:
        save("failed")
        raise
    elapsed = max(time.perf_counter() - started, 0.001)
    rows = manifest["written_rows"]
    return PartsResult(
        target, f"{target}/{MANIFEST}", rows, len(columns), len(done), resumed, output_format, elapsed, rows / elapsed, plan
    )


def _waves(df, order_by, plan: ChunkPlan, keys: DataFrame, todo: list[int], size: int | None, totals: dict, work: str):
    """``(chunks, their rows)`` of each job; whoever takes them writes the rows before asking for more."""
    if not todo:
        return
    spark, wanted = df.sparkSession, set(todo)
    only = None if len(todo) == plan.total_chunks else wanted
    layout = ChunkLayout(df, order_by, plan, keys, aside=f"{work}/rows")
    seen = Observation()
    rows = layout.rows(only)
    rows = rows.observe(seen, *digest_terms(rows.select(*df.columns)))
    if size is None or size >= len(todo):
        yield wanted, rows
    else:
        rows.write.mode("overwrite").partitionBy("chunk_id").parquet(f"{work}/chunks")
        staged = spark.read.schema(rows.schema).parquet(f"{work}/chunks")
        for start in range(0, len(todo), size):
            wave = todo[start : start + size]
            tasks = min(len(wave), 4 * spark.sparkContext.defaultParallelism)
            yield set(wave), staged.where(among("chunk_id", wave)).repartition(tasks, "chunk_id").sortWithinPartitions("chunk_id", "_row_no")
    again = seen.get
    expected = sum(min(plan.chunk_size, plan.planned_rows - c * plan.chunk_size) for c in todo)
    whole = only is None and plan.planned_rows == plan.total_rows
    if again["rows"] != expected or (whole and again != totals):
        raise SourceChangedError("The source gave other rows when it was read again; write it to a table first.")


def _write(body: DataFrame, parts: str, output_format: str, text: dict, encoding: str) -> None:
    writer = body.write.mode("append").partitionBy("chunk_id")
    if output_format == "parquet":
        writer.option("compression", "zstd").parquet(parts)
    else:
        options = csv_options(text["delimiter"], header=text["include_header"], encoding=encoding)
        writer.options(**options).csv(parts)


def _verified(spark, files: Files, parts: str, state: dict) -> list[dict]:
    """Recorded parts that still have their hash; everything else is removed."""
    present = set(listed(spark, parts))
    good: set[str] = set()
    if present and state["files"]:
        checked = compare_parts(manifest_parts(spark, state), part_hashes(spark, parts))
        good = {row["part"] for row in checked.where("status = 'ok'").collect()}
    files.delete_all([f"{parts}/{path}" for path in present - good])
    return [item for item in state["files"] if item["part"] in good]


def _check_counts(done: list[dict], plan: ChunkPlan) -> None:
    wrong = [item for item in done if item["rows"] != item["row_limit"]]
    written = sum(item["rows"] for item in done)
    if wrong or written != plan.planned_rows:
        raise RowCountError(
            f"Expected {plan.planned_rows} rows, parts hold {written}; parts that differ: {[w['part'] for w in wrong[:5]]}"
        )


def swap_in(files: Files, source: str, target: str) -> None:
    """Put a finished folder in the place of the old one by renames alone.

    A folder cannot be renamed over another, so for a moment the old one stands aside;
    :func:`restore` puts it back if the process dies just then.
    """
    restore(files, target)
    folder, _, name = target.rpartition("/")
    old = f"{folder}/.{name}.old"
    files.make_folder(folder)
    if files.exists(target):
        files.rename(target, old)
        try:
            files.rename(source, target)
        except Exception:
            files.rename(old, target)
            raise
        files.delete(old)
    else:
        files.rename(source, target)


def restore(files: Files, target: str) -> None:
    """Undo a swap that was cut off: the old folder comes back if nothing has taken its place."""
    folder, _, name = target.rpartition("/")
    old = f"{folder}/.{name}.old"
    if files.exists(old):
        if files.exists(target):
            files.delete(old)
        else:
            files.rename(old, target)
