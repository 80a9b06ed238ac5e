"""Projections and predicates of a table extract."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import MissingKeyError
from ..functions.naming import check_identifier, key_list

DEFAULT_CHANGE_COLUMN = "LAST_UPDATE_DATE"
DEFAULT_ROW_KEY = "SOURCE_ROWID"


def all_string(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])


def change_bound(value) -> datetime:
    """The lower bound as an instant, to the microsecond; without a zone it is UTC."""
    if isinstance(value, datetime):
        moment = value
    elif isinstance(value, date):
        moment = datetime(value.year, value.month, value.day)
    else:
        try:
            moment = datetime.fromisoformat(str(value).strip())
        except ValueError as error:
            raise ValueError(f"{value!r} is no date such as 2024-01-31 or 2024-01-31 13:45:00.5") from error
    return moment.astimezone(timezone.utc) if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def check_predicate(predicate: str | None) -> str | None:
    """The trimmed extra predicate; a semicolon is refused."""
    text = str(predicate or "").strip()
    if ";" in text:
        raise ValueError("The extra predicate must be one condition and cannot contain a semicolon.")
    return text or None


def incremental(
    df: DataFrame,
    since=None,
    column: str = DEFAULT_CHANGE_COLUMN,
    extra: str | None = None,
) -> DataFrame:
    """Rows changed at or after ``since`` that also meet the ``extra`` condition.

    The bound takes the column's own type, so the comparison stays bare and
    reaches the Parquet reader as a pushed filter.  A text that is no timestamp
    fails the query: leaving its row out would lose it unseen.
    """
    if since is not None:
        name = check_identifier(column, "change column")
        kind = df.schema[name].dataType if name in df.columns else T.TimestampType()
        bound = F.lit(change_bound(since).strftime("%Y-%m-%d %H:%M:%S.%f"))
        if isinstance(kind, T.TimestampNTZType):
            df = df.where(F.col(name) >= bound.cast("timestamp_ntz"))
        elif isinstance(kind, T.StringType):
            read = F.try_to_timestamp(F.col(name))
            message = F.concat(F.lit(f"{name} holds a text that is no timestamp: "), F.col(name))
            unread = F.col(name).isNotNull() & read.isNull()
            df = df.where(F.when(unread, F.raise_error(message).cast("boolean")).otherwise(read >= bound.cast("timestamp")))
        else:
            df = df.where(F.col(name) >= bound.cast("timestamp"))
    condition = check_predicate(extra)
    return df.where(F.expr(condition)) if condition else df


def with_row_key(df: DataFrame, name: str = DEFAULT_ROW_KEY) -> DataFrame:
    """Add a stable key made of file path and row position as the first column.

    Works on a DataFrame that reads Parquet files: the position survives retries
    and repeated runs, which a generated id does not.
    """
    check_identifier(name, "row key column")
    try:
        return df.select(
            F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(name), "*"
        )
    except Exception as error:
        raise MissingKeyError(
            "Rows of this source have no stable position; name a key, or use with_content_key()."
        ) from error


def with_content_key(df: DataFrame, name: str = DEFAULT_ROW_KEY) -> DataFrame:
    """Add a key computed from the row content, for sources without positions.

    Equal rows share a key, so this suits a replace and not an upsert of copies.
    """
    check_identifier(name, "row key column")
    return df.select(F.sha2(F.to_json(F.struct(*df.columns)), 256).alias(name), "*")


def require_columns(df: DataFrame, keys) -> list[str]:
    """The checked key names; raises when the data lacks one."""
    names = key_list(keys)
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise MissingKeyError("Key columns are missing from the data: " + ", ".join(missing))
    return names
