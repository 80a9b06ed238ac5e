"""What a SQL statement does and to which table, told by Spark's own parser.

Spark cannot run UPDATE, DELETE or MERGE on plain files, so the pieces of such a
statement are read off the parsed plan and carried out on managed tables.
"""

from __future__ import annotations

import datetime
import decimal
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import StatementError
from ..operators.merge import MergeAction, MergeSpec

_TOKEN = re.compile(r"(?s)'(?:[^'\\]|\\.|'')*'|\"[^\"]*\"|`[^`]*`|/\*.*?\*/|--[^\r\n]*|\?")
_SHOWING = (
    "ShowTables", "ShowViews", "ShowColumns", "ShowFunctions", "ShowNamespaces", "ShowCreateTable",
    "DescribeRelation", "DescribeColumn", "DescribeQueryCommand", "DescribeFunction",
)


@dataclass
class Statement:
    """One parsed statement; only the fields of its kind are filled."""

    text: str
    kind: str
    is_query: bool = False
    target: str = ""
    query: "LazyQuery | None" = None
    insert_columns: tuple[str, ...] = ()
    condition: Column | None = None
    assignments: dict[str, Column] = field(default_factory=dict)
    columns: T.StructType | None = None
    replace: bool = False
    if_exists: bool = False
    if_not_exists: bool = False
    alter: str = ""
    dropped: tuple[str, ...] = ()
    renamed: tuple[str, str] = ("", "")
    merge: MergeSpec | None = None


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(sql: str, parameters) -> str:
    """Put literal values in the place of ``?`` markers outside quotes and comments."""
    values = list(parameters or ())
    if not values:
        return sql
    waiting = iter(values)

    def put(found):
        if found.group() != "?":
            return found.group()
        try:
            return _literal(next(waiting))
        except StopIteration:
            raise StatementError("The statement has more ? markers than parameters.") from None

    bound = _TOKEN.sub(put, sql)
    if next(waiting, waiting) is not waiting:
        raise StatementError("The statement has fewer ? markers than parameters.")
    return bound


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _column(spark: SparkSession, expression) -> Column:
    """A parsed expression as a column."""
    return Column(spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(expression))


def _option(spark: SparkSession, option) -> Column | None:
    return _column(spark, option.get()) if option.isDefined() else None


def _name(parts) -> str:
    """The table name; a schema in front names nothing here."""
    names = parts.mkString("\0").split("\0")
    return names[-1]


def _relation(node) -> tuple[str, str]:
    """``(table name, alias)`` of a target relation."""
    alias = ""
    if node.getClass().getSimpleName() == "SubqueryAlias":
        alias = node.alias()
        node = node.child()
    name = _name(node.multipartIdentifier())
    return name, alias or name


def _frame(spark: SparkSession, plan) -> DataFrame:
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)


def _fields(columns, name) -> T.StructType:
    kinds = [(name(c), T._parse_datatype_json_string(c.dataType().json())) for c in columns]
    plain = [T.StringType() if isinstance(k, (T.VarcharType, T.CharType)) else k for _, k in kinds]
    return T.StructType([T.StructField(n, k, True) for (n, _), k in zip(kinds, plain)])


def _assignments(spark: SparkSession, action) -> dict[str, Column] | None:
    """Column to value; None for the star forms."""
    if "Star" in action.getClass().getSimpleName():
        return None
    pairs = {}
    for item in _items(action.assignments()):
        pairs[item.key().sql().split(".")[-1].strip("`")] = _column(spark, item.value())
    return pairs


def parse_statement(spark: SparkSession, sql: str, parameters=None) -> Statement:
    """Parse exactly one statement; anything not known to be harmless is BLOCKED."""
    if not isinstance(sql, str) or not sql.strip():
        raise StatementError("SQL cannot be empty.")
    summarize = re.fullmatch(r"\s*SUMMARIZE\s+(?:`([^`]+)`|\"([^\"]+)\"|([^\s;]+))\s*;?\s*", sql, re.I)
    if summarize:
        return Statement(sql, "SUMMARIZE", target=next(g for g in summarize.groups() if g))
    sql = bind(sql, parameters)
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as error:
        raise StatementError(str(error)) from error
    return _describe(spark, sql, plan)


def _describe(spark: SparkSession, sql: str, plan) -> Statement:
    kind = plan.getClass().getSimpleName()
    if kind == "UnresolvedWith" and "Insert" not in (inner := plan.child().getClass().getSimpleName()):
        if inner in {"DeleteFromTable", "UpdateTable", "MergeIntoTable"}:
            raise StatementError("A WITH clause in front of a change is not supported.")
        if _acts(spark, plan):
            return Statement(sql, "BLOCKED")
        return Statement(sql, "WITH", is_query=True)
    if kind == "UnresolvedWith":
        raise StatementError("Put the WITH clause after INSERT INTO.")
    if kind == "ExplainCommand":
        return Statement(sql, "EXPLAIN", is_query=True)
    if kind in _SHOWING:
        return Statement(sql, "SHOW" if kind.startswith("Show") else "DESCRIBE", is_query=True)
    if kind == "UpdateTable":
        name, _ = _relation(plan.table())
        return Statement(
            sql, "UPDATE", target=name, assignments=_assignments(spark, plan), condition=_option(spark, plan.condition())
        )
    if kind == "DeleteFromTable":
        name, _ = _relation(plan.table())
        whole = plan.condition().sql() == "true"
        return Statement(sql, "DELETE", target=name, condition=None if whole else _column(spark, plan.condition()))
    if kind == "InsertIntoStatement":
        name, _ = _relation(plan.table())
        names = tuple(_items(plan.userSpecifiedCols()))
        return Statement(
            sql, "INSERT", target=name, insert_columns=names, query=LazyQuery(spark, plan.query()), replace=plan.overwrite()
        )
    if kind == "MergeIntoTable":
        return _merge(spark, sql, plan)
    if kind in {"CreateTableAsSelect", "ReplaceTableAsSelect"}:
        replace = kind.startswith("Replace")
        quiet = not replace and plan.ignoreIfExists()
        return Statement(
            sql, "CREATE", target=_name(plan.name().nameParts()), query=LazyQuery(spark, plan.query()),
            replace=replace, if_not_exists=quiet,
        )
    if kind in {"CreateTable", "ReplaceTable"}:
        spec = plan.tableSpec()
        if spec.location().isDefined():
            return Statement(sql, "BLOCKED")
        columns = _fields(_items(plan.columns()), lambda c: c.name())
        replace = kind.startswith("Replace")
        return Statement(
            sql, "CREATE", target=_name(plan.name().nameParts()), columns=columns, replace=replace,
            if_not_exists=not replace and plan.ignoreIfExists(),
        )
    if kind == "TruncateTable":
        return Statement(sql, "TRUNCATE", target=_name(plan.table().multipartIdentifier()))
    if kind == "DropTable":
        return Statement(sql, "DROP", target=_name(plan.child().nameParts()), if_exists=plan.ifExists())
    if kind == "DropView":
        return Statement(sql, "DROP", target=_name(plan.child().nameParts()), if_exists=plan.ifExists())
    if kind in {"AddColumns", "DropColumns", "RenameColumn"}:
        return _alter(sql, kind, plan)
    return Statement(sql, "BLOCKED") if _acts(spark, plan) else Statement(sql, "SELECT", is_query=True)


def _acts(spark: SparkSession, plan) -> bool:
    """Is there a command or an insert anywhere in the plan?  Only plans without one are queries."""
    command = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command")
    if command.isInstance(plan) or plan.getClass().getSimpleName().startswith("Insert"):
        return True
    return any(_acts(spark, child) for child in _items(plan.children()))


def _alter(sql: str, kind: str, plan) -> Statement:
    name = _name(plan.table().multipartIdentifier())
    if kind == "AddColumns":
        fields = _fields(_items(plan.columnsToAdd()), lambda c: c.colName())
        return Statement(sql, "ALTER", target=name, alter="add", columns=fields)
    if kind == "DropColumns":
        gone = tuple(c.name().mkString(".") for c in _items(plan.columnsToDrop()))
        return Statement(sql, "ALTER", target=name, alter="drop", dropped=gone)
    renamed = (plan.column().name().mkString("."), plan.newName())
    return Statement(sql, "ALTER", target=name, alter="rename", renamed=renamed)


def _merge(spark: SparkSession, sql: str, plan) -> Statement:
    if plan.notMatchedBySourceActions().size():
        raise StatementError("WHEN NOT MATCHED BY SOURCE is not supported.")
    name, alias = _relation(plan.targetTable())
    source = plan.sourceTable()
    source_alias = source.alias() if source.getClass().getSimpleName() == "SubqueryAlias" else _relation(source)[1]

    def action(item) -> MergeAction:
        kind = item.getClass().getSimpleName()
        what = "delete" if kind.startswith("Delete") else "insert" if kind.startswith("Insert") else "update"
        values = {} if what == "delete" else _assignments(spark, item)
        return MergeAction(what, _option(spark, item.condition()), values)

    spec = MergeSpec(
        _column(spark, plan.mergeCondition()),
        alias,
        source_alias,
        tuple(action(a) for a in _items(plan.matchedActions())),
        tuple(action(a) for a in _items(plan.notMatchedActions())),
    )
    return Statement(sql, "MERGE", target=name, query=LazyQuery(spark, source), merge=spec)


class LazyQuery:
    """A query that is analysed only after the statement passed the guard."""

    def __init__(self, spark: SparkSession, plan):
        self.spark, self.plan = spark, plan

    def frame(self) -> DataFrame:
        return _frame(self.spark, self.plan)
