"""Delimited text: writer options and one ordered file."""

from __future__ import annotations

import csv
import io
import math
import os
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import all_string
from ..operators.paging import ChunkLayout, ChunkPlan, bucket_count, plan_chunks, survey
from ..session import scratch_path
from .filesystem import Files

# Byte order mark and the encodings a file can be asked for.
BOM = b"\xef\xbb\xbf"
ENCODINGS = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "ascii": "US-ASCII", "latin-1": "ISO-8859-1"}
_COPY_BYTES = 8 * 1024 * 1024


def check_delimiter(delimiter: str) -> str:
    if not isinstance(delimiter, str) or len(delimiter) != 1 or delimiter in "\r\n\0":
        raise ValueError("delimiter must be one non-newline character.")
    return delimiter


def csv_options(
    delimiter: str = ",", *, header: bool = True, quote: str = '"', quote_all: bool = False, encoding: str = "utf-8"
) -> dict:
    """Writer options: doubled quotes, no trimming, NULL as an empty field."""
    if not isinstance(quote, str) or len(quote) != 1:
        raise ValueError("quote must be exactly one character.")
    if encoding.lower() not in ENCODINGS:
        raise ValueError(f"encoding must be one of {sorted(ENCODINGS)}.")
    return {
        "sep": check_delimiter(delimiter),
        "header": str(header).lower(),
        "quote": quote,
        "escape": quote,
        "quoteAll": str(quote_all).lower(),
        "nullValue": "",
        "emptyValue": "",
        "lineSep": "\n",
        "encoding": ENCODINGS[encoding.lower()],
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def _header_bytes(columns, delimiter: str, quote: str, quote_all: bool, encoding: str) -> bytes:
    text = io.StringIO()
    rule = csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL
    csv.writer(text, delimiter=delimiter, quotechar=quote, quoting=rule, lineterminator="\n").writerow(columns)
    return text.getvalue().encode("utf-8" if encoding.startswith("utf-8") else encoding)


def _copy_pieces(target: str):
    """Task code: put every piece at its offset of the target file."""

    def run(batches):
        for batch in batches:
            for path, offset in zip(batch["path"], batch["offset"]):
                handle = os.open(target, os.O_WRONLY)
                try:
                    with open(path, "rb") as piece:
                        at = int(offset)
                        while block := piece.read(_COPY_BYTES):
                            at += os.pwrite(handle, block, at)
                finally:
                    os.close(handle)
            yield batch

    return run


def join_files(spark: SparkSession, pieces: list[tuple[str, int]], target: str, head: bytes = b"") -> None:
    """Concatenate ``(path, size)`` pieces into one file, after the ``head`` bytes.

    HDFS does this by moving block lists.  On a mounted file system the tasks copy
    their pieces side by side; writing a piece twice gives the same bytes, so a
    retried task does no harm.  Other stores cannot join files without passing
    everything through one process, which is refused.
    """
    files = Files(spark)
    system = files.system(target)
    stream = system.create(files._path(target), True)
    try:
        if head:
            stream.write(bytearray(head))
    finally:
        stream.close()
    pieces = [piece for piece in pieces if piece[1] > 0]
    if not pieces:
        return
    scheme = files.scheme(target)
    if scheme == "file":
        if not spark.sparkContext.master.startswith("local") and not files.on_shared_mount(target):
            raise NotImplementedError("A machine-local path is not seen by all executors; name a shared one in extractkit.sharedMounts.")
        offsets, at = [], len(head)
        for path, size in pieces:
            offsets.append((_local(path), at))
            at += size
        tasks = min(len(offsets), 4 * spark.sparkContext.defaultParallelism)
        plan = spark.createDataFrame(offsets, "path string, offset bigint").repartition(tasks, "offset")
        plan.mapInPandas(_copy_pieces(_local(target)), plan.schema).agg(F.count(F.lit(1))).collect()
        # Hadoop's checksum file describes the head only; Spark made it, drop it.
        folder, _, name = target.rpartition("/")
        files.delete(f"{folder}/.{name}.crc")
    elif scheme in {"hdfs", "viewfs"}:
        gateway = spark.sparkContext._gateway
        kind = spark._jvm.org.apache.hadoop.fs.Path
        sources = gateway.new_array(kind, len(pieces))
        for i, (path, _) in enumerate(pieces):
            sources[i] = files._path(path)
        system.concat(files._path(target), sources)
    else:
        raise NotImplementedError(f"{scheme} cannot join files in place; write a part dataset instead.")


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def write_single_csv(
    df: DataFrame,
    filename: str,
    order_by=None,
    *,
    delimiter: str = ",",
    chunk_size: int | str = "auto",
    start_offset: int = 0,
    max_rows: int | None = None,
    max_file_rows: int | None = None,
    all_varchar: bool = True,
    encoding: str = "utf-8-sig",
    overwrite: bool = True,
    include_header: bool = True,
    quote: str = '"',
    quote_all: bool = False,
) -> dict:
    """Publish one delimited file, in the given order, header once.

    Ordered pieces are written in parallel and joined; the destination changes
    only by the final rename.
    """
    spark = df.sparkSession
    files = Files(spark)
    target = files.qualified(filename)
    if files.exists(target) and not overwrite:
        raise FileExistsError(f"Destination already exists: {filename}")
    options = csv_options(delimiter, header=False, quote=quote, quote_all=quote_all, encoding=encoding)
    if len(df.columns) == 1:
        # An empty line would not be read back as a row.
        options["nullValue"] = options["emptyValue"] = quote * 2
    pieces_path = scratch_path(spark, "single-file")
    if order_by is None:
        if start_offset:
            raise ValueError("start_offset needs order_by.")
        rows = df if max_rows is None else df.limit(max_rows)
        plan = None
        (all_string(rows) if all_varchar else rows).write.options(**options).csv(pieces_path)
    else:
        aside = scratch_path(spark, "single-file-rows")
        totals, keys = survey(df, order_by, f"{aside}/keys")
        plan = plan_chunks(
            totals["rows"], chunk_size, max_rows=max_rows, max_file_rows=max_file_rows, start_offset=start_offset
        )
        chunks = ChunkLayout(df, order_by, _in_pieces(plan, spark.sparkContext.defaultParallelism), keys, aside=f"{aside}/rows").rows()
        body = with_chunk_column(chunks, df.columns, all_varchar)
        body.write.options(**options).partitionBy("chunk_id").csv(pieces_path)
        files.delete(aside)
    pieces = files.walk(pieces_path)
    pieces.sort(key=lambda p: (chunk_of(p[0]), p[0]))
    head = BOM if encoding.lower() == "utf-8-sig" else b""
    if include_header:
        head += _header_bytes(df.columns, delimiter, quote, quote_all, encoding.lower())
    folder, _, name = target.rpartition("/")
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    files.make_folder(folder)
    try:
        join_files(spark, [(f"{pieces_path}/{path}", size) for path, size in pieces], temporary, head)
        files.replace(temporary, target)
    finally:
        if files.exists(temporary):
            files.delete(temporary)
        files.delete(pieces_path)
    return {
        "filename": target,
        "columns": len(df.columns),
        "chunks": plan.total_chunks if plan else len(pieces),
        "rows": plan.planned_rows if plan else None,
    }


def _in_pieces(plan: ChunkPlan, parallelism: int) -> ChunkPlan:
    """The plan with whole chunks put together to a few pieces for each task: one file has no use for a piece for each chunk."""
    together = max(1, math.ceil(plan.total_chunks / (4 * bucket_count(plan.planned_rows, parallelism))))
    return replace(plan, chunk_size=together * plan.chunk_size, total_chunks=math.ceil(plan.total_chunks / together))


def with_chunk_column(chunks: DataFrame, columns: list[str], as_text: bool) -> DataFrame:
    """The named columns, as text if asked, and the chunk to partition by."""
    kept = [F.col(f"`{c}`").cast("string").alias(c) if as_text else F.col(f"`{c}`") for c in columns]
    return chunks.select(*kept, "chunk_id")


def chunk_of(path: str) -> int:
    folder = path.split("/", 1)[0]
    return int(folder.split("=", 1)[1]) if folder.startswith("chunk_id=") else 0
