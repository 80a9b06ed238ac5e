"""General merge: any join condition, several conditional actions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DuplicateKeyError


@dataclass(frozen=True)
class MergeAction:
    """``kind`` is update, delete or insert; ``values`` None means all columns by name."""

    kind: str
    condition: Column | str | None = None
    values: dict[str, Column | str] | None = None


@dataclass(frozen=True)
class MergeSpec:
    condition: Column | str
    target_alias: str
    source_alias: str
    matched: tuple[MergeAction, ...] = ()
    not_matched: tuple[MergeAction, ...] = ()


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _when(action: MergeAction) -> Column:
    return F.lit(True) if action.condition is None else F.coalesce(_expr(action.condition), F.lit(False))


def _value(action: MergeAction, spec: MergeSpec, column: str) -> Column | None:
    """The new value of a column under an action; None when it keeps its value."""
    if action.values is None:
        return F.col(f"{spec.source_alias}.`{column}`")
    by_name = {name.lower(): text for name, text in action.values.items()}
    text = by_name.get(column.lower())
    return None if text is None else _expr(text)


def _joined(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    marked = source.withColumn("_hit", F.lit(True)).alias(spec.source_alias)
    return target.alias(spec.target_alias).join(marked, _expr(spec.condition), "left")


def touched_rows(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Target rows with at least one match."""
    return target.alias(spec.target_alias).join(source.alias(spec.source_alias), _expr(spec.condition), "left_semi")


def require_single_match(target: DataFrame, source: DataFrame, spec: MergeSpec, row_id: Column) -> None:
    """Raise when a target row matches several source rows."""
    rows = target.withColumn("_row_id", row_id)
    matches = _joined(rows, source, spec).where("_hit").groupBy("_row_id").agg(F.count(F.lit(1)).alias("n"))
    if matches.where("n > 1").limit(1).collect():
        raise DuplicateKeyError("Several source rows match one target row.")


def matched_rows(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """All target rows after the first matched action that applies to each."""
    joined = _joined(target, source, spec)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    chosen = F.lit(-1)
    for number, action in reversed(list(enumerate(spec.matched))):
        chosen = F.when(hit & _when(action), F.lit(number)).otherwise(chosen)
    joined = joined.withColumn("_action", chosen)
    deletes = [n for n, action in enumerate(spec.matched) if action.kind == "delete"]
    if deletes:
        joined = joined.where(~F.col("_action").isin(deletes))
    columns = []
    for field in target.schema.fields:
        value = F.col(f"{spec.target_alias}.`{field.name}`")
        for number, action in enumerate(spec.matched):
            new = _value(action, spec, field.name) if action.kind == "update" else None
            if new is not None:
                value = F.when(F.col("_action") == number, new.cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return joined.select(*columns)


def new_rows(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame | None:
    """Rows inserted for unmatched source rows; None without an insert action."""
    if not spec.not_matched:
        return None
    fresh = source.alias(spec.source_alias).join(target.alias(spec.target_alias), _expr(spec.condition), "left_anti")
    taken = F.lit(False)
    parts = []
    for action in spec.not_matched:
        mine = ~taken & _when(action)
        columns = []
        for field in target.schema.fields:
            value = _value(action, spec, field.name)
            columns.append((F.lit(None) if value is None else value).cast(field.dataType).alias(field.name))
        parts.append(fresh.where(mine).select(*columns))
        taken = taken | _when(action)
    return reduce(DataFrame.unionByName, parts)


def merge_rows(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """The target after the merge."""
    kept, added = matched_rows(target, source, spec), new_rows(target, source, spec)
    return kept if added is None else kept.unionByName(added)
