"""Tables of XML and JSON payloads turned into rows.

Errors become a status column, so one bad payload never stops a job over many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import SchemaMismatchError
from ..functions.text import explode_filled, null_if_empty, strip

# States in which a job has ended.
TERMINAL_STATES = ("SUCCEEDED", "ERROR", "WARNING", "CANCELLED", "EXPIRED")

_CORRUPT = "_corrupt_record"
_CHILD_TYPE = "array<struct<REQUESTID:string,JOBNAME:string,JOBPATH:string,STATUS:string>>"


def decode_base64(text: Column) -> Column:
    """Bytes of strict Base64 (padding included), NULL when it is not valid."""
    shaped = text.rlike(r"^(?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$")
    return F.when(shaped, F.unbase64(text))


def _is_well_formed(xml: Column) -> Column:
    """Does the parser accept the whole document?"""
    parsed = F.from_xml(
        xml,
        f"_none string, {_CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "ignoreNamespace": "true"},
    )
    return xml.isNotNull() & parsed.getField(_CORRUPT).isNull()


def _named(name: str) -> str:
    """XPath of the elements of a local name, any prefix and letter case."""
    return f"//*[translate(local-name(), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') = '{name.lower()}']"


def element_texts(xml: Column, *paths: str) -> Column:
    """Texts of the first element on each path, as an array; see :func:`element_text`.

    One parse tells whether the document is whole and one more reads all paths, however many there are.
    """
    # NUL, which no document can hold, ends each text; one that is there has an x before it.
    found = ", ".join(f"substring('x', 2 - number(boolean({path}))), string(({path})[1]), '\0'" for path in paths)
    joined = F.when(_is_well_formed(xml), F.xpath_string(xml, F.lit(f"concat({found})")))
    texts = F.transform(F.split(joined, "\\x00", -1), lambda text: F.when(text != "", F.substr(text, F.lit(2))))
    return F.slice(texts, 1, len(paths))


def _path(name: str, inside: str | None = None) -> str:
    return (_named(inside) if inside else "") + _named(name)


def element_text(xml: Column, name: str, inside: str | None = None) -> Column:
    """Text of the first element of that local name, perhaps only below one named ``inside``.

    The document is parsed, so comments do not count and entities and CDATA are read.
    ``''`` for an element without content, NULL when it is absent or the document is broken.
    """
    return F.get(element_texts(xml, _path(name, inside)), F.lit(0))


def with_report_bytes(df: DataFrame, envelope: str, *, column: str = "report_base64", status: str = "status") -> DataFrame:
    """Add the payload of a response envelope and its status.

    ``ok``, ``empty`` (a valid answer without data), ``invalid_base64``,
    ``missing`` (no such element) or ``invalid_xml``.
    """
    out = df.withColumn("_raw", element_text(F.col(envelope), "reportBytes"))
    out = out.withColumn("_raw", F.regexp_replace("_raw", r"\s+", ""))
    state = (
        F.when(~_is_well_formed(F.col(envelope)) | F.col(envelope).isNull(), F.lit("invalid_xml"))
        .when(F.col("_raw").isNull(), F.lit("missing"))
        .when(F.col("_raw") == "", F.lit("empty"))
        .when(decode_base64(F.col("_raw")).isNull(), F.lit("invalid_base64"))
        .otherwise(F.lit("ok"))
    )
    out = out.withColumn(status, state)
    return out.withColumn(column, F.when(F.col(status).isin("ok", "empty"), F.col("_raw"))).drop("_raw")


def soap_fault(envelope: Column) -> Column:
    """Fault message: ``faultstring``, else the ``Text`` inside ``Fault``."""
    # An element's name stands in the text as it is, unless declarations build it; without either there is nothing to parse.
    likely = F.when(F.lower(envelope).rlike("faultstring|text|<!"), envelope)
    texts = element_texts(likely, _path("faultstring"), _path("Text", inside="Fault"))
    # A lambda variable is bound once, so the first filled text is found without another parse.
    filled = F.filter(F.transform(texts, lambda text: null_if_empty(strip(text))), lambda text: text.isNotNull())
    return F.get(filled, F.lit(0))


def with_result_xml(df: DataFrame, payload: str, *, column: str = "xml", status: str = "status") -> DataFrame:
    """Decode a Base64 result document.

    Status: ``empty``, ``invalid_base64``, ``invalid_utf8``, ``invalid_xml``, or
    ``ok``.
    """
    text = strip(F.col(payload))
    out = df.withColumn("_bytes", decode_base64(text))
    utf8 = F.decode("_bytes", "UTF-8")
    valid = F.is_valid_utf8(F.col("_bytes").cast("string"))
    out = out.withColumn("_xml", strip(F.regexp_replace(F.when(valid, utf8), r"^\uFEFF", "")))
    empty = F.col(payload).isNull() | (text == "") | (F.col("_xml") == "")
    state = (
        F.when(empty, F.lit("empty"))
        .when(F.col("_bytes").isNull(), F.lit("invalid_base64"))
        .when(~valid, F.lit("invalid_utf8"))
        .when(~_is_well_formed(F.col("_xml")), F.lit("invalid_xml"))
        .otherwise(F.lit("ok"))
    )
    out = out.withColumn(status, state)
    return out.withColumn(column, F.when(F.col(status) == "ok", F.col("_xml"))).drop("_bytes", "_xml")


def result_rows(df: DataFrame, xml: str, columns: list[str], *, keep=(), row_element: str = "G_1") -> DataFrame:
    """One output row per row element; values are trimmed text, NULL if absent or empty.

    Documents without row elements give no rows.  Attributes are not read.
    """
    fields = ",".join(f"`{name}`:string" for name in columns)
    parsed = F.from_xml(
        F.col(xml), f"`{row_element}` array<struct<{fields}>>", {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
    )
    exploded = explode_filled(df, keep, parsed.getField(row_element), "_row")
    return exploded.select(*keep, *[null_if_empty(strip(F.col("_row").getField(n))).alias(n) for n in columns])


def result_columns(df: DataFrame, xml: str, *, row_element: str = "G_1") -> list[str]:
    """Names of all row children in the data, by first position.

    One distributed pass; only distinct names reach the driver.
    """
    rows = F.regexp_extract_all(xml, F.lit(rf"(?s)<{row_element}(?:\s[^>]*)?>(.*?)</{row_element}>"), F.lit(1))
    names = F.regexp_extract_all(F.col("_row"), F.lit(r"<([A-Za-z_][\w.-]*)"), F.lit(1))
    found = explode_filled(df, [], rows, "_row").select(F.posexplode_outer(names).alias("at", "name")).where("at >= 0")
    ordered = found.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name")
    return [row["name"] for row in ordered.collect()]


# No XML name has these signs, so attributes and text cannot be taken for elements.
_XML = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "attributePrefix": "@", "valueTag": "#"}


def result_shape(df: DataFrame, xml: str) -> dict[str, list[str]]:
    """``{row element: names}`` over all documents: rows are the children of the root, whatever they are called.

    Names are those of a row's children, of its attributes with ``@`` before them, and ``#`` for the text of a row
    without children.  Each document is read without a schema and told by its names alone; the distinct pairs reach the driver.
    """
    shapes = df.select(F.from_xml(F.col(xml), "variant", _XML).alias("v"))
    children = F.from_json(F.to_json("v"), "map<string,string>")
    found = shapes.select(F.explode_outer(children).alias("element", "rows")).where("element not like '@%' and element <> '#'")
    each = F.when(F.col("rows").startswith("["), F.from_json("rows", "array<string>")).otherwise(F.array("rows"))
    names = F.transform(each, lambda row: F.when(row.startswith("{"), F.json_object_keys(row)).otherwise(F.array(F.lit("#"))))
    pairs = found.select("element", F.explode(F.array_distinct(F.flatten(names))).alias("name")).distinct()
    out: dict[str, list[str]] = {}
    for row in pairs.orderBy("element", "name").collect():
        out.setdefault(row["element"], []).append(row["name"])
    return out


def any_result_rows(df: DataFrame, xml: str, *, keep=(), shape: dict[str, list[str]] | None = None) -> DataFrame:
    """One output row per child of each document's root, with every column that occurs anywhere.

    The schema is merged over all documents first (:func:`result_shape`), so values are the trimmed text as it stands,
    leading zeros and all; NULL if absent or empty.  Attributes are columns by their name, after children of that name; the text of a row
    without children is a column of the row's name.  Documents without rows give none.
    """
    shape = result_shape(df, xml) if shape is None else shape
    if not shape:
        return df.select(*keep).limit(0)

    def column(element: str, name: str) -> str:
        return element if name == "#" else name.removeprefix("@")

    for element, names in shape.items():
        if len({n.lower() for n in names}) < len(names):
            raise SchemaMismatchError(f"Names of {element} differ in letter case only: {names}")
    # Names of different rows that differ in case only are one column, as Spark's names are.
    columns = list({c.lower(): c for c in sorted({column(e, n) for e, names in shape.items() for n in names}, reverse=True)}.values())[::-1]
    schema = ", ".join(f"`{element}` array<struct<{', '.join(f'`{n}`: string' for n in names)}>>" for element, names in shape.items())
    parsed = df.select(*keep, F.from_xml(F.col(xml), schema, _XML).alias("_parsed"))

    def unified(element: str):
        def of(row: Column) -> Column:
            values = []
            for wanted in columns:
                sources = [null_if_empty(strip(row.getField(n))) for n in sorted(shape[element], reverse=True) if column(element, n).lower() == wanted.lower()]
                values.append((F.coalesce(*sources) if sources else F.lit(None).cast("string")).alias(wanted))
            return F.struct(*values)

        return of

    lists = [F.coalesce(F.transform(F.col("_parsed").getField(element), unified(element)), F.array()) for element in shape]
    rows = explode_filled(parsed, [F.col(k) if isinstance(k, str) else k for k in keep], F.concat(*lists), "_row")
    return rows.select(*[k if isinstance(k, str) else k for k in keep], *[F.col("_row").getField(c).alias(c) for c in columns])


def with_job(df: DataFrame, response: str) -> DataFrame:
    """Parent columns of a job-status response; its children stay as ``_children``.

    The status document may be an object or a JSON text, its top key ``JOBS`` or
    ``jobs``, and ``CHILD`` one object, an array, or absent.  A nested object read
    into a text field keeps its JSON, so each document is parsed once.  ``answer`` says
    what came: ``ok``, ``invalid_json`` (of the response), ``no_items`` or ``no_status``
    (absent, or no JSON).
    """
    col = F.col
    item = F.from_json(response, "items array<struct<OperationName:string,ReqstId:string,RequestStatus:string>>")
    job = F.coalesce(F.get_json_object("_status", "$.JOBS"), F.get_json_object("_status", "$.jobs"), F.lit("{}"))
    out = df.withColumn("_item", F.get(item.getField("items"), F.lit(0)))
    out = out.withColumn("_status", col("_item.RequestStatus")).withColumn("_text", job)
    parsed = F.from_json("_text", "REQUESTID string, JOBNAME string, JOBPATH string, STATUS string, CHILD string")
    out = out.withColumn("_job", parsed)
    lower_child = F.when(col("_job.CHILD").isNull(), F.get_json_object("_text", "$.child"))
    upper = F.upper(F.coalesce(col("_job.STATUS"), F.lit("")))
    operation = F.coalesce(col("_item.OperationName"), F.lit("getESSExecutionDetails"))
    return out.select(
        *df.columns,
        col("_item").isNotNull().alias("found"),
        F.when(F.try_parse_json(response).isNull(), F.lit("invalid_json")).when(col("_item").isNull(), F.lit("no_items"))
        .when(F.try_parse_json("_status").isNull(), F.lit("no_status")).otherwise(F.lit("ok")).alias("answer"),
        F.when(col("_item").isNotNull(), operation).alias("operation"),
        F.coalesce(col("_job.REQUESTID"), col("_item.ReqstId")).alias("request_id"),
        col("_job.JOBNAME").alias("job_name"),
        col("_job.JOBPATH").alias("job_path"),
        col("_job.STATUS").alias("status"),
        upper.isin(*TERMINAL_STATES).alias("terminal"),
        (upper == "SUCCEEDED").alias("succeeded"),
        F.from_json(F.coalesce(col("_job.CHILD"), lower_child), _CHILD_TYPE).alias("_children"),
    )


def job_status(df: DataFrame, response: str) -> DataFrame:
    """One row per response."""
    out = with_job(df, response)
    count = F.coalesce(F.size("_children"), F.lit(0))
    return out.withColumn("child_count", F.greatest(count, F.lit(0)).cast("bigint")).drop("_children")


def job_children(df: DataFrame, response: str, *, keep=()) -> DataFrame:
    """One row per child job."""
    out = with_job(df, response)
    kept = [*keep, F.col("request_id").alias("parent_request_id")]
    child = explode_filled(out, kept, F.col("_children"), "_child")
    return child.select(
        *keep,
        "parent_request_id",
        F.col("_child.REQUESTID").alias("request_id"),
        F.col("_child.JOBNAME").alias("job_name"),
        F.col("_child.JOBPATH").alias("job_path"),
        F.col("_child.STATUS").alias("status"),
    )
