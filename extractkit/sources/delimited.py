"""CSV and TSV scans, in parallel wherever lines break, with types inferred from the whole file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text forms of each type, tried from the narrowest to the widest.
# A number with a leading zero is a code, so it stays text.
TYPE_PATTERNS = (
    ("boolean", r"(?i)^(?:true|false)$"),
    ("bigint", r"^[+-]?(?:0|[1-9][0-9]{0,17})$"),
    ("double", r"^[+-]?(?:0|[1-9][0-9]*)?(?:\.[0-9]+|(?<=[0-9])\.)?(?:[eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?$"),
)


def line_end(line: str, quoted: bool, delimiter: str) -> bool:
    """Is the place behind a line inside a quoted field, given whether the place before it is?

    A quote opens a field only at its start; doubled quotes inside are text; what stands behind
    a closing quote up to the delimiter is text as well.
    """
    at = 0
    while True:
        if not quoted:
            while not line.startswith('"', at):  # fields without quotes
                at = line.find(delimiter, at) + 1
                if not at:
                    return False
            at += 1
        while True:
            at = line.find('"', at) + 1
            if not at:
                return True
            if not line.startswith('"', at):
                break
            at += 1
        at = line.find(delimiter, at) + 1
        if not at:
            return False
        quoted = False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the block they are in; a task gets the lines of a block in order."""
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Task code: ``(file, block, lines)`` of the stretches of each batch that lie in one block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column(0).dictionary_encode()
        places = np.stack([files.indices.to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)])
        cuts = [0, *(np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield batch.column(0)[start].as_py(), batch.column(1)[start].as_py(), batch.column(2).slice(start, stop - start)


def quote_blocks(spark: SparkSession, path: str, delimiter: str = ",") -> dict[str, dict[int, tuple[bool, int]]]:
    """``{file: {block: (starts inside a quoted field, block where that record starts)}}``.

    Every task sums a block up as what it makes of either state before it; the sums of the
    blocks, one row for each, are composed in order.  Only lines with quotes go to Python.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        for file, block, lines in _runs(batches):
            state = found.setdefault((file, block), [False, True, False, False])
            for line in lines.to_pylist():
                for i in (0, 1):  # the state after the lines so far if the block starts outside, inside; is the open record one of its own?
                    after = line_end(line, state[i], delimiter)
                    state[i + 2] = after and (state[i + 2] or not state[i])
                    state[i] = after
        rows = [(*key, *state) for key, state in found.items()]
        if rows:
            kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "block", "out", "inside", "own_out", "own_inside"])

    lines = _lines(spark, path)
    quoted = lines.where(F.contains("value", F.lit('"')))
    sums = quoted.mapInArrow(run, "path string, block long, out boolean, inside boolean, own_out boolean, own_inside boolean").collect()
    known = {(r.path, r.block): r for r in sums}
    blocks: dict[str, dict[int, tuple[bool, int]]] = {}
    file, quoted_before, origin = None, False, 0
    for row in lines.select("path", "block").distinct().orderBy("path", "block").collect():
        if row.path != file:
            file, quoted_before, origin = row.path, False, row.block
        blocks.setdefault(file, {})[row.block] = (quoted_before, origin)
        if it := known.get((row.path, row.block)):
            own = it.own_inside if quoted_before else it.own_out
            origin = row.block if own else origin
            quoted_before = it.inside if quoted_before else it.out
    return blocks


def _records(blocks: dict[str, dict[int, tuple[bool, int]]], delimiter: str, header: bool, pieces: bool):
    """Task code: put lines together to records.

    A record that runs over the end of its block is left out, unless ``pieces`` asks for just those: then its
    part in each block comes with the block it starts in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(lines: list[str]) -> str:
            return "\n".join(lines)

        def flush(last: bool) -> Iterator[tuple]:
            """The record at hand; ``last`` if its block ends with it."""
            broken = last and inside and block != ends[file]  # a file that ends inside a quoted field ends its record
            if held and (foreign or broken):
                if pieces:
                    yield file, origin if foreign else block, block, joined(held)
            elif held and not pieces and not (header and block == 0 and number == 0):
                yield file, block, block, joined(held)

        def sent(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        names = ["path", "origin", "block", "record"]
        ends = {name: max(known) for name, known in blocks.items()}
        file = block = None
        held: list[str] = []
        inside = foreign = False
        number = origin = 0
        for name, start, lines in _runs(batches):
            if (name, start) != (file, block):
                yield from sent([*flush(True)])
                file, block, held, number = name, start, [], 0
                if start not in blocks.get(name, {}):
                    raise RuntimeError("The file or the size of its blocks has changed since it was opened.")
                inside, origin = blocks[name][start]
                foreign = inside
            # Only lines with quotes change the state; all others take that of the line before.
            before, at = np.empty(len(lines), bool), 0
            for i in np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist():
                before[at : i + 1] = inside
                inside, at = line_end(lines[i].as_py(), inside, delimiter), i + 1
            before[at:] = inside
            first = np.flatnonzero(~before)
            if not len(first):
                held += lines.to_pylist()
                continue
            held += lines.slice(0, first[0]).to_pylist()
            out = [*flush(False)]
            number, foreign = number + bool(held and not foreign), False
            if len(first) > 1:  # records that are whole in this batch
                skip = int(header and block == 0 and number == 0)
                if not pieces and len(first) - 1 > skip:
                    yield from sent(out)
                    out = []
                    lists = pa.ListArray.from_arrays(pa.array(first[skip:], pa.int32()), lines)
                    texts = pc.binary_join(lists, "\n")
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(file), len(texts)), *[pa.repeat(pa.scalar(block, pa.int64()), len(texts))] * 2, texts], names)
                number += len(first) - 1
            yield from sent(out)
            held = lines.slice(first[-1]).to_pylist()
        yield from sent([*flush(True)])

    return run


def records(spark: SparkSession, path: str, delimiter: str = ",", *, header: bool = True) -> DataFrame:
    """``record``: each record of delimited files as one text, quoted line breaks and all, without the header.

    Files are read in parallel whatever their size and wherever their lines break: a block's first true record is known from
    the blocks before it.  Empty lines are no records.
    """
    blocks = quote_blocks(spark, path, delimiter)
    kinds = "path string, origin long, block long, record string"
    whole = _lines(spark, path).mapInArrow(_records(blocks, delimiter, header, False), kinds).select("record")
    # A record that runs over blocks: all blocks that begin inside it, and the one it begins in.
    touched = {(f, b) for f, known in blocks.items() for b, (inside, _) in known.items() if inside}
    touched |= {(f, known[b][1]) for f, known in blocks.items() for b in known if known[b][0]}
    if touched:
        folded = _lines(spark, path).where(F.struct("path", "block").isin([F.struct(F.lit(f), F.lit(b).cast("long")) for f, b in sorted(touched)]))
        parts = folded.mapInArrow(_records(blocks, delimiter, header, True), kinds)
        texts = F.transform(F.array_sort(F.collect_list(F.struct("block", "record"))), lambda x: x["record"])
        whole = whole.unionByName(parts.groupBy("path", "origin").agg(F.array_join(texts, "\n").alias("record")).select("record"))
    return whole.select(F.regexp_replace("record", r"\r\z", "").alias("record")).where("record <> ''")


def has_broken_lines(spark: SparkSession, path: str, delimiter: str = ",") -> bool:
    """Does any quoted field run over a line end?  Lines with quotes, an odd number of them or one line end more, are candidates; the rest is quick."""
    quotes = F.length(F.regexp_replace("value", '[^"]', ""))
    candidates = spark.read.option("lineSep", "\n").text(path).where(F.contains("value", F.lit('"')))
    return not candidates.where((quotes % 2 == 1) | F.rlike("value", F.lit("(?s)\r."))).isEmpty()


def parser_options(delimiter: str) -> dict:
    return {"sep": delimiter, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def text_columns(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """The columns of a delimited file with a header, as text; an empty field is NULL."""
    options = {**parser_options(delimiter), "nullValue": ""}
    first = spark.read.options(**options, header="true", multiLine="true", enforceSchema="true").csv(path)
    names = [name.removesuffix("\r") for name in first.columns]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    if not has_broken_lines(spark, path, delimiter):
        return spark.read.options(**options, header="true").schema(schema).csv(path)
    plain = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = records(spark, path, delimiter).select(F.from_csv("record", plain, options).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(name) for i, name in enumerate(names)])


def infer_types(df: DataFrame) -> dict[str, str]:
    """The narrowest type that holds every value of each text column; one pass."""
    checks = []
    for i, name in enumerate(df.columns):
        value = F.col(f"`{name}`")
        filled = F.when(value != "", value)
        checks.append(F.count(filled).alias(f"c{i}"))
        for kind, pattern in TYPE_PATTERNS:
            fits = filled.rlike(pattern) & filled.try_cast(kind).isNotNull()
            checks.append(F.count_if(fits).alias(f"c{i}_{kind}"))
    found = df.agg(*checks).first()
    types = {}
    for i, name in enumerate(df.columns):
        filled = found[f"c{i}"]
        fitting = [kind for kind, _ in TYPE_PATTERNS if filled and found[f"c{i}_{kind}"] == filled]
        types[name] = fitting[0] if fitting else "string"
    return types


def read_delimited(spark: SparkSession, path: str, delimiter: str = ",", schema=None) -> DataFrame:
    """A delimited file with a header; types from ``schema`` or from its content.

    The same rows and types whatever the size of the file, and always in parallel.
    """
    text = text_columns(spark, path, delimiter)
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        types = {f.name: f.dataType.simpleString() for f in wanted.fields}
        text = text.toDF(*types)
    else:
        types = infer_types(text)
    return text.select(
        *[
            F.col(f"`{name}`") if kind == "string" else F.col(f"`{name}`").try_cast(kind).alias(name)
            for name, kind in types.items()
        ]
    )


def read_checked(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> DataFrame:
    """A delimited file with a header and a fixed schema, plus ``_malformed``.

    Rows with too many or too few fields, or with a value that does not fit its
    type, are kept and marked.
    """
    options = {**parser_options(delimiter), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"}
    rows = records(spark, path, delimiter).select(F.from_csv("record", f"{schema}, _record string", options).alias("r"))
    return rows.select("r.*").withColumn("_malformed", F.col("_record").isNotNull()).drop("_record")
