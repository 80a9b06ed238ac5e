"""Header-less CSV files named after registry control files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..errors import NameConflictError
from .delimited import write_single_csv


def load_file_name(control_file: str) -> str:
    """``dir/Name.ctl`` becomes ``Name.csv``."""
    name = control_file.strip().rstrip("/").rsplit("/", 1)[-1]
    stem, dot, _ = name.rpartition(".")
    return f"{stem if dot and stem else name}.csv"


def write_load_files(folder: str, queries: dict[str, DataFrame], *, order_by=None) -> dict:
    """One file per control file: no header, UTF-8, NULL as an empty field.

    ``queries`` maps control files to their rows.  Two control files with one
    output name are refused before anything is written.
    """
    names: dict[str, str] = {}
    for control_file in queries:
        name = load_file_name(control_file)
        if name in names.values():
            raise NameConflictError(f"Duplicate load-file name: {name}")
        names[control_file] = name
    written = []
    for control_file, df in queries.items():
        path = f"{folder.rstrip('/')}/{names[control_file]}"
        write_single_csv(df, path, order_by, encoding="utf-8", include_header=False, all_varchar=False)
        written.append({"control_file": control_file, "file": path, "rows": df.count()})
    return {"files": written, "rows": sum(item["rows"] for item in written)}
