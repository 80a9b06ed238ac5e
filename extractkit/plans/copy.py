"""Copy a query to files: one ordered file or a part dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sinks.delimited import write_single_csv
from ..sinks.parts import write_parts

OUTPUT_MODES = ("single_file", "part_files")


def copy_query(df: DataFrame, destination: str, *, order_by=None, output_mode: str = "single_file", **options):
    """Publish ``df``; ``options`` are those of the chosen writer.

    ``part_files`` needs ``order_by``.  ``single_file`` without it keeps the
    source order.
    """
    if output_mode not in OUTPUT_MODES:
        raise ValueError("output_mode must be 'single_file' or 'part_files'.")
    if output_mode == "part_files":
        if not order_by:
            raise ValueError("order_by is required for part_files output.")
        return write_parts(df, destination, order_by, **options)
    return write_single_csv(df, destination, order_by, **options)
