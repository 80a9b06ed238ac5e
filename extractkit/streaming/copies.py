"""Folder streams: upsert into a managed table, or append to a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.naming import key_list
from ..operators.filters import all_string
from ..sinks.tables import ManagedTables


def read_folder_stream(
    spark: SparkSession, folder: str, schema, file_format: str = "parquet", *, max_files: int | None = None, **options
) -> DataFrame:
    """A stream of the files that appear in a folder."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def stream_upsert(
    stream: DataFrame,
    tables: ManagedTables,
    target_table: str,
    keys,
    checkpoint: str,
    *,
    stream_name: str,
    order_col: str | None = None,
    newer_than: str | None = None,
    all_varchar: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert every micro-batch of a stream.

    The table records the last batch of each stream and checkpoint next to its files, in one
    commit; a batch that Spark replays after a failure is therefore skipped.  With
    ``order_col`` the latest row of a key wins within a batch.  A late row still
    overwrites unless ``newer_than`` names a column to compare.
    """
    names = key_list(keys)
    duplicates = {"on_duplicate": "latest", "order_col": order_col} if order_col else {}

    def apply(batch: DataFrame, number: int) -> None:
        # Batch numbers count from 0 in each checkpoint, so they are kept by its query id.
        query = tables.files.read_json(f"{checkpoint}/metadata")["id"]
        rows = all_string(batch) if all_varchar else batch
        if rows.isEmpty():
            return
        tables.upsert(
            target_table, rows, names, newer_than=newer_than, batch=(f"{stream_name}:{query}", number), **duplicates
        )

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_parts(
    stream: DataFrame, destination: str, checkpoint: str, *, output_format: str = "parquet", available_now: bool = True
) -> StreamingQuery:
    """Append a stream to a dataset, each source row exactly once.

    After the run, :func:`extractkit.sinks.parts.write_dataset_manifest` records it.
    """
    writer = stream.writeStream.format(output_format).outputMode("append").option("checkpointLocation", checkpoint)
    if output_format == "parquet":
        writer = writer.option("compression", "zstd")
    return (writer.trigger(availableNow=True) if available_now else writer).start(destination)
