"""Name normalisers: table aliases, registry selectors, catalog paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Words an alias may not be.
RESERVED_WORDS = (
    "all", "alter", "and", "as", "by", "case", "create", "delete", "describe",
    "drop", "from", "group", "having", "insert", "into", "join", "limit",
    "merge", "not", "null", "on", "or", "order", "select", "set", "show",
    "table", "update", "where", "with",
)

# Roots that must never be changed, archive kind per extension.
PROTECTED_PATHS = ("/", "/custom", "/shared folders")
ARCHIVE_TYPES = {".xdo": "xdoz", ".xdm": "xdmz", ".xss": "xssz"}

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$#]*")


def check_identifier(name: str, label: str = "identifier") -> str:
    """Return the trimmed identifier or raise ``ValueError``."""
    text = name.strip() if isinstance(name, str) else ""
    if not _IDENTIFIER.fullmatch(text):
        raise ValueError(
            f"Invalid {label}: {name!r}. Letters, digits, _, $ and # are allowed; "
            "a letter or underscore comes first."
        )
    return text


def key_list(keys) -> list[str]:
    """A key given as one name or a list of names, checked."""
    names = [keys] if isinstance(keys, str) else list(keys or ())
    if not names:
        raise ValueError("At least one key column is required.")
    return [check_identifier(name, "key column") for name in names]


def safe_name(value: Column) -> Column:
    """Turn any text into a plain lower-case table alias."""
    base = F.lower(F.btrim(F.regexp_replace(value, r"[^0-9A-Za-z_]+", "_"), F.lit("_")))
    base = F.regexp_replace(base, r"_+", "_")
    base = F.when(base == "", F.lit("file")).otherwise(base)
    base = F.when(base.rlike(r"^[0-9]"), F.concat(F.lit("t_"), base)).otherwise(base)
    return F.when(base.isin(*RESERVED_WORDS), F.concat(F.lit("file_"), base)).otherwise(base)


def safe_alias(value: str) -> str:
    """:func:`safe_name` for one file name held by the driver."""
    words = [word for word in re.split(r"[^0-9A-Za-z]+", value) if word]
    alias = "_".join(words).lower() or "file"
    if alias[0].isdigit():
        alias = f"t_{alias}"
    return f"file_{alias}" if alias in RESERVED_WORDS else alias


def selector_key(value: Column) -> Column:
    """Normalised selector: file name without .csv/.ctl, letters and digits only."""
    name = F.regexp_replace(strip(F.coalesce(value, F.lit(""))), r"/+$", "")
    name = F.lower(F.substring_index(name, "/", -1))
    name = F.regexp_replace(name, r"(?s)^(.+)\.(?:csv|ctl)$", "$1")
    return F.regexp_replace(name, r"[^a-z0-9]+", "")


def singular_key(key: Column) -> Column:
    """Cautious singular of a :func:`selector_key`."""
    size = F.length(key)
    return (
        F.when(key.endswith("ies") & (size > 3), F.concat(key.substr(F.lit(1), size - 3), F.lit("y")))
        .when(key.endswith("s") & (size > 1), key.substr(F.lit(1), size - 1))
        .otherwise(key)
    )


def catalog_path(value: Column) -> Column:
    """Leading slash added, trailing slashes dropped; NULL for an empty path."""
    text = strip(value)
    path = F.when(text.startswith("/"), text).otherwise(F.concat(F.lit("/"), text))
    path = F.when(path == "/", path).otherwise(F.regexp_replace(path, r"/+$", ""))
    return F.when(text != "", path)


def is_protected_path(path: Column) -> Column:
    """True for catalog roots and for a bare user folder such as ``/~name``."""
    bare = F.regexp_replace(path, r"/+$", "")
    bare = F.when(bare == "", F.lit("/")).otherwise(bare)
    return F.lower(bare).isin(*PROTECTED_PATHS) | bare.rlike(r"^/*~[^/]*$")


def archive_type(path: Column) -> Column:
    """Archive kind by file extension, ``unknown`` for anything else."""
    suffix = F.lower(F.regexp_extract(path, r"[^/.](\.[^./]*)$", 1))
    kind = F.lit("unknown")
    for extension, name in ARCHIVE_TYPES.items():
        kind = F.when(suffix == extension, F.lit(name)).otherwise(kind)
    return kind


def document_account(ucm_account: Column) -> Column:
    """``a/b`` becomes ``a$/b$``."""
    return F.concat(F.regexp_replace(ucm_account, "/", r"\$/"), F.lit("$"))


def submission_job_name(import_job_name: Column) -> Column:
    """Leading slashes dropped, the last ``;`` turned into a comma."""
    name = F.ltrim(strip(import_job_name), F.lit("/"))
    return F.regexp_replace(name, r"(?s);([^;]*)$", ",$1")
