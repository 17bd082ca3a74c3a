"""Entity catalog from the query text of source results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.functions.literals import first_literal_item

# Type codes of the source system.
TYPE_CODES = {"PM": "MORAL", "PF": "FISICA"}
CATALOG = ("entity_id", "entity_name", "entity_type", "country_code")


def parsed_queries(df: DataFrame, literal: str = "query_used") -> DataFrame:
    """Add the catalog columns of the first item of each literal; rows that cannot be read are dropped."""
    out = df.selectExpr("*", f"{first_literal_item(literal)} AS _item").where(f"{literal} IS NOT NULL AND _item IS NOT NULL")
    # A present but empty metadata value makes the row unreadable, a missing one does not.
    nested = "CASE WHEN map_contains_key(_item, 'metadata') THEN try_element_at(_item, 'metadata') ELSE '{}' END"
    out = out.selectExpr("*", f"from_json({nested}, 'map<string,string>') AS _meta").where("_meta IS NOT NULL")

    def meta(key: str) -> str:
        return f"CASE WHEN map_contains_key(_meta, '{key}') THEN try_element_at(_meta, '{key}') ELSE '' END"

    known = " ".join(f"WHEN '{short}' THEN '{name}'" for short, name in TYPE_CODES.items())
    code = meta("entity_type")
    return out.selectExpr(
        *df.columns,
        "try_element_at(_item, 'entity_id') AS entity_id",
        "try_element_at(_item, 'query_value') AS entity_name",
        f"CASE {code} {known} ELSE {code} END AS entity_type",
        f"{meta('country_code')} AS country_code",
    )


def first_per_entity(df: DataFrame, order: str) -> DataFrame:
    """First row by ``order`` for each entity that has an id and a name; partial aggregation, no window."""
    usable = df.where((F.col("entity_id").cast("string") != "") & (F.col("entity_name") != ""))
    rest = [c for c in CATALOG if c != "entity_id"]
    first = F.min_by(F.struct(*rest), F.col(order))
    return usable.groupBy("entity_id").agg(first.alias("_first")).select("entity_id", "_first.*")


def entity_catalog(sources: DataFrame, order: str, literal: str = "query_used") -> DataFrame:
    """One row per entity: id, name, type and country of the first item by the column ``order``.

    A table has no order of its own, and partitions do not follow the order of files; the readers in ``sources.tables`` give
    the place of each row as a column.
    """
    return first_per_entity(parsed_queries(sources.select(literal, order), literal), order)
