"""Members of ZIP archives as rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Member extensions that hold XML.
XML_EXTENSIONS = (".xdo", ".xdm", ".xpt", ".xss", ".cfg", ".meta", ".sec", ".xml")

# Text held before rows are sent off, and what a row counts beside its text.
_BATCH_BYTES, _ROW_BYTES = 4 * 1024 * 1024, 256

MEMBER_SCHEMA = (
    "archive string, member string, size_bytes bigint, is_xml boolean, unsafe_path boolean, "
    "xml_valid boolean, error string, text string"
)


def _member_rows(archive: str, content: bytes):
    """Rows of one archive; a broken archive is one row with an error."""
    import io
    import posixpath
    import zipfile
    from xml.parsers import expat

    try:
        handle = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile as error:
        yield archive, None, None, None, None, None, f"not a ZIP archive: {error}", None
        return
    with handle:
        items = [item for item in handle.infolist() if not item.is_dir()]
        if not items:
            yield archive, None, None, None, None, None, "archive is empty", None
        for item in items:
            is_xml = posixpath.splitext(item.filename)[1].lower() in XML_EXTENSIONS
            unsafe = item.filename.startswith(("/", "\\")) or ".." in item.filename.replace("\\", "/").split("/")
            data = text = valid = error = None
            try:
                data = handle.read(item)
                text = data.decode("utf-8-sig")
            except UnicodeDecodeError:
                pass
            except Exception as failure:
                error = f"corrupt member: {failure}"
            if is_xml and data is not None:
                try:
                    parser = expat.ParserCreate()
                    # Entity declarations are refused: they can expand without end.
                    parser.EntityDeclHandler = _refuse_entity
                    parser.Parse(data, True)
                    valid = True
                except Exception as failure:
                    valid, error = False, str(failure)
            yield archive, item.filename, None if data is None else len(data), is_xml, unsafe, valid, error, text


def _refuse_entity(*_):
    raise ValueError("entity declarations are not allowed")


def explode_archives(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """One row per member of the ZIP bytes in ``content``."""
    narrow = df.select(F.col(path).alias("archive"), F.col(content).alias("content"))
    return narrow.mapInArrow(_member_batches, MEMBER_SCHEMA)


def _member_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: members of many small archives share a batch; what holds much text is sent off at once."""
    rows, held = [], 0
    for batch in batches:
        for archive, data in zip(batch.column(0), batch.column(1)):
            for row in _member_rows(archive.as_py(), bytes(data.as_py())):
                rows.append(row)
                held += _ROW_BYTES + len(row[-1] or "")
                if held >= _BATCH_BYTES:
                    yield _member_batch(rows)
                    rows, held = [], 0
    if rows:
        yield _member_batch(rows)


def _member_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.string())
    names = [field.split()[0] for field in MEMBER_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names)


def read_archives(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Members of all archives below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return explode_archives(found.load(folder).select("path", "content"))


def archive_report(members: DataFrame) -> DataFrame:
    """Readability per archive: member counts and a status."""
    counted = members.groupBy("archive").agg(
        F.count("member").alias("member_count"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("size_bytes"),
        F.count_if(F.col("is_xml")).alias("xml_members"),
        F.count_if(~F.col("xml_valid")).alias("invalid_xml"),
        F.count_if(F.col("unsafe_path")).alias("unsafe_paths"),
        F.count_if(F.col("error").startswith("not a ZIP")).alias("_broken"),
        F.count_if(F.col("error").startswith("corrupt member")).alias("_corrupt"),
    )
    status = (
        F.when(F.col("_broken") > 0, F.lit("not_an_archive"))
        .when(F.col("_corrupt") > 0, F.lit("corrupt_member"))
        .when(F.col("unsafe_paths") > 0, F.lit("unsafe_path"))
        .when(F.col("member_count") == 0, F.lit("empty"))
        .otherwise(F.lit("readable"))
    )
    return counted.withColumn("status", status).drop("_broken", "_corrupt")
