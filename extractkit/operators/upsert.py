"""Keyed upsert and general merge of one DataFrame into another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DuplicateKeyError
from ..session import stored
from .checks import require_same_columns
from .filters import require_columns


def has_null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def latest_per_key(df: DataFrame, keys, order_col: str) -> DataFrame:
    """One row per key, the one with the largest ``order_col``.

    A plain aggregate, so copies of a frequent key are reduced before the
    shuffle.  Ties go to the largest remaining values; rows with a NULL key never
    match anything and are all kept.
    """
    names = require_columns(df, keys)
    rest = [name for name in df.columns if name not in names and name != order_col]
    value = F.struct(*([F.col(order_col)] if order_col not in names else []), *[F.col(name) for name in rest])
    null_key = has_null_key(names)
    best = df.where(~null_key).groupBy(*names).agg(F.max(value).alias("_best"))
    picked = best.select(*names, "_best.*").select(*df.columns)
    return picked.unionByName(df.where(null_key))


def _per_key(df: DataFrame, names: list[str], count: str) -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias(count))


def source_matches(target: DataFrame, source: DataFrame, keys, within: str | None = None) -> DataFrame:
    """The source's keys that the target holds, with ``_n_source`` and ``_n_target`` rows of each.

    Reads the key columns only, each side once.  Copies of a source key are counted before the
    join, so a frequent key meets the target's rows once; the answer is no larger than the keys
    of the source.  With ``within`` (a column of the target) rows are counted by it as well.
    """
    names = require_columns(source, keys)
    extra = [within] if within else []
    counted = _per_key(source.where(~has_null_key(names)), names, "_n_source")
    hits = target.where(~has_null_key(names)).select(*names, *extra).join(counted, names)
    return _per_key(hits, [*names, *extra, "_n_source"], "_n_target")


def require_unambiguous(matches: DataFrame, keys: list[str]) -> None:
    """``matches`` of :func:`source_matches` with several source rows for one key are refused."""
    row = matches.where("_n_source > 1").select(*keys).limit(1).collect()
    if row:
        raise DuplicateKeyError(f"Several source rows match one target key: {row[0].asDict()}")


def upsert_outcomes(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """What an upsert would do, as one row of counts, without doing it.

    ``updated`` and ``kept`` target rows, ``inserted`` source rows, and ``ambiguous`` keys, for
    which the upsert would be refused.  Rows with a NULL key are kept or inserted.  Both sides are
    counted per key before one full join of the counts, so no frequent key meets another.
    """
    names = require_columns(source, keys)
    require_columns(target, names)
    both = _per_key(target, names, "_n_target").join(_per_key(source, names, "_n_source"), names, "full_outer")
    old, new = F.col("_n_target"), F.col("_n_source")
    counts = {
        "updated": F.when(new.isNotNull(), old),
        "kept": F.when(new.isNull(), old),
        "inserted": F.when(old.isNull(), new),
        "ambiguous": F.when(old.isNotNull() & (new > 1), 1),
    }
    return both.agg(*[F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(name) for name, value in counts.items()])


def updated_rows(target: DataFrame, source: DataFrame, keys, newer_than: str | None = None) -> DataFrame:
    """The target rows with matched ones overwritten, NULL source values included.

    A presence marker tells a match from a miss; rows with a NULL key cannot match
    and pass by the join, so they never pile up in one task.
    """
    names = require_columns(source, keys)
    others = [name for name in target.columns if name not in names]
    null_key = has_null_key(names)
    incoming = source.where(~null_key).select(
        *names, F.struct(*[F.col(n) for n in others], F.lit(True).alias("_hit")).alias("_new")
    )
    joined = target.where(~null_key).join(incoming, names, "left")
    replace = F.col("_new").isNotNull()
    if newer_than is not None:
        new, old = F.col("_new").getField(newer_than), F.col(newer_than)
        replace = replace & (old.isNull() | F.coalesce(new > old, F.lit(False)))
    values = [
        F.when(replace, F.col("_new").getField(name)).otherwise(F.col(name)).alias(name)
        if name in others
        else F.col(name)
        for name in target.columns
    ]
    return joined.select(*values).unionByName(target.where(null_key))


def inserted_rows(matches: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Source rows whose key is not in ``matches``; rows with a NULL key always belong here."""
    names = require_columns(source, keys)
    null_key = has_null_key(names)
    fresh = source.where(~null_key).join(matches.select(*names).distinct(), names, "left_anti")
    return fresh.unionByName(source.where(null_key))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys,
    *,
    on_duplicate: str = "error",
    order_col: str | None = None,
    newer_than: str | None = None,
) -> DataFrame:
    """The target after the keyed upsert.

    Matched rows take all non-key values of the source, unmatched source rows are
    added, other target rows stay.  ``on_duplicate='latest'`` first reduces the
    source to one row per key by ``order_col``; the default refuses a source with
    several rows for one matched key.  ``newer_than`` overwrites only when the
    source value of that column is larger.

    The matched keys are found first, from the key columns alone, and put aside; refusals and
    insertions are read from them, so whole target rows are read once, for the update.
    """
    require_columns(source, keys)
    require_same_columns(source, target)
    if on_duplicate == "latest":
        if order_col is None:
            raise ValueError("on_duplicate='latest' needs order_col.")
        source = latest_per_key(source, keys, order_col)
    elif on_duplicate != "error":
        raise ValueError("on_duplicate must be 'error' or 'latest'.")
    source = source.select(*target.columns)
    matches = stored(source_matches(target, source, keys), "upsert-matches")
    if on_duplicate == "error":
        require_unambiguous(matches, require_columns(source, keys))
    return updated_rows(target, source, keys, newer_than).unionByName(inserted_rows(matches, source, keys))


# --- row changes by condition ---------------------------------------------------


def update_where(df: DataFrame, assignments: dict[str, Column | str], condition: Column | str | None = None) -> DataFrame:
    """Assign new values where the condition is true; NULL counts as not true."""
    hit = F.lit(True) if condition is None else F.expr(condition) if isinstance(condition, str) else condition
    by_name = {name.lower(): name for name in df.columns}
    values = {}
    for name, value in assignments.items():
        column = by_name.get(name.lower())
        if column is None:
            raise ValueError(f"No such column: {name}")
        values[column] = F.expr(value) if isinstance(value, str) else value
    return df.select(
        *[
            F.when(hit, values[f.name].cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
            if f.name in values
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def delete_where(df: DataFrame, condition: Column | str | None = None) -> DataFrame:
    """Drop rows where the condition is true; NULL keeps the row."""
    if condition is None:
        return df.limit(0)
    hit = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(~F.coalesce(hit, F.lit(False)))
