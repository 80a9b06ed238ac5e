"""Catalog listings and copy planning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import archive_type, catalog_path
from ..functions.text import explode_filled, null_if_empty, strip

# Listing elements and the columns they become.
LISTING_FIELDS = {
    "absolutePath": "absolute_path",
    "creationDate": "creation_date",
    "displayName": "display_name",
    "fileName": "file_name",
    "lastModified": "last_modified",
    "lastModifier": "last_modifier",
    "owner": "owner",
    "parentAbsolutePath": "parent_absolute_path",
    "type": "type",
}
_ITEM = r"(?s)<(?:[\w.-]+:)?(item|catalogItem)(?:\s[^>]*)?>(.*?)</(?:[\w.-]+:)?\1\s*>"


def catalog_items(df: DataFrame, xml: str, *, keep=(), item_type: str | None = None) -> DataFrame:
    """Distinct items of listing documents, optionally of one type."""
    schema = ", ".join(f"`{name}` string" for name in LISTING_FIELDS)
    bodies = F.regexp_extract_all(xml, F.lit(_ITEM), F.lit(2))
    items = explode_filled(df, keep, bodies, "_body").withColumn(
        "_item",
        F.from_xml(
            F.concat(F.lit("<item>"), F.col("_body"), F.lit("</item>")),
            schema,
            {"ignoreNamespace": "true", "mode": "PERMISSIVE"},
        ),
    )
    columns = [
        null_if_empty(strip(F.col("_item").getField(name))).alias(alias) for name, alias in LISTING_FIELDS.items()
    ]
    listed = items.select(*keep, *columns).where(
        F.coalesce(*[F.col(alias) for alias in LISTING_FIELDS.values()]).isNotNull()
    )
    if item_type is not None:
        listed = listed.where(F.lower("type") == item_type.strip().lower())
    return listed.dropDuplicates()


def listing_order():
    """Folders first, then by name without regard to case."""
    return [
        F.when(F.lower("type") == "folder", 0).otherwise(1).asc(),
        F.lower(F.coalesce("display_name", "file_name", F.lit(""))).asc(),
    ]


def plan_copies(
    requests: DataFrame,
    source_catalog: DataFrame,
    destination_catalog: DataFrame,
    *,
    catalog_column: str = "absolute_path",
) -> DataFrame:
    """What copying each request would do; nothing is written.

    ``requests`` has ``source_path, destination_path, overwrite``.  Catalog paths
    are reduced to distinct normal forms first, so copies in a listing cost nothing.
    """
    planned = requests.withColumn("source_path", catalog_path(F.col("source_path")))
    planned = planned.withColumn("destination_path", catalog_path(F.col("destination_path")))

    def existing(catalog: DataFrame, key: str, marker: str) -> DataFrame:
        paths = catalog.select(catalog_path(F.col(catalog_column)).alias(key)).where(F.col(key).isNotNull())
        return paths.distinct().withColumn(marker, F.lit(True))

    planned = planned.join(existing(source_catalog, "source_path", "_source"), "source_path", "left")
    planned = planned.join(existing(destination_catalog, "destination_path", "_target"), "destination_path", "left")
    source_exists = F.coalesce("_source", F.lit(False))
    destination_exists = F.coalesce("_target", F.lit(False))
    action = (
        F.when(~source_exists, F.lit("SOURCE_MISSING"))
        .when(destination_exists & ~F.col("overwrite"), F.lit("BLOCKED_DESTINATION_EXISTS"))
        .when(destination_exists, F.lit("REPLACE"))
        .otherwise(F.lit("CREATE"))
    )
    return planned.select(
        *requests.columns,
        archive_type(F.col("source_path")).alias("object_type"),
        source_exists.alias("source_exists"),
        destination_exists.alias("destination_exists"),
        action.alias("action"),
        action.isin("CREATE", "REPLACE").alias("success"),
    )
