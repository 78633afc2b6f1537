"""Concept documents: JSON bodies in their several encodings as typed columns, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def listed(v: Column, path: str) -> Column:
    """A collection as an array of variants: array, the only member 'items', or a single value; nulls and empty objects are none."""
    whole = _get(v, path, "variant")
    inner = _get(v, f"{path}.items", "array<variant>")
    many = F.coalesce(inner, _get(v, path, "array<variant>"))
    empty = F.array().cast("array<variant>")
    is_null = F.is_variant_null(whole) | whole.isNull()
    none = _get(whole, "$", "map<string,variant>").isNotNull() & (F.size(_get(whole, "$", "map<string,variant>")) == 0)
    return F.when(is_null | none, empty).when(many.isNotNull(), F.filter(many, lambda x: ~F.is_variant_null(x))).otherwise(F.array(whole))


def alias_of(x: Column) -> Column:
    """An alias as (name, distance): an object, or a plain string at distance 0."""
    return F.struct(F.coalesce(_get(x, "$.name", "string"), _get(x, "$", "string")).alias("name"), F.coalesce(_get(x, "$.distance", "int"), F.lit(0)).alias("distance"))


def descriptor_of(x: Column) -> Column:
    """A descriptor's scalar members."""
    s = lambda n: _get(x, f"$.{n}", "string").alias(n)
    return F.struct(s("relationship_category"), s("relationship_subcategory"), s("snippet"), s("source_name"), s("source_URL"), _get(x, "$.distance", "int").alias("distance"))


def parse_concepts(df: DataFrame, key: str = "concept_key", body: str = "body") -> DataFrame:
    """``df`` with typed columns for its bodies.

    Adds common_name, aliases (name, distance), edges (name, distance, descriptors), descriptions (texts), web_sites,
    nomenclature, last_updates (maps) and entity. Bodies that are no valid JSON objects are dropped; missing parts are null
    or empty. Aliases without a name are left out.
    """
    rows = df.withColumn("_v", F.try_parse_json(body)).filter(F.col("_v").isNotNull())
    v = F.col("_v")
    text_map = lambda n: _get(v, f"$.{n}", "map<string,string>").alias(n)
    rows = rows.filter(_get(v, "$", "map<string,variant>").isNotNull())
    edges = F.transform(
        F.filter(F.map_entries(F.coalesce(_get(v, "$.edges", "map<string,variant>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")))), lambda e: ~F.is_variant_null(e["value"])),
        lambda e: F.struct(e["key"].alias("name"), _get(e["value"], "$.distance", "int").alias("distance"), F.transform(listed(e["value"], "$.descriptors"), descriptor_of).alias("descriptors")),
    )
    return rows.select(
        *df.columns,
        _get(v, "$.common_name", "string").alias("common_name"),
        F.filter(F.transform(listed(v, "$.aliases"), alias_of), lambda a: a["name"].isNotNull()).alias("aliases"),
        edges.alias("edges"),
        F.filter(F.transform(listed(v, "$.descriptions"), lambda x: _get(x, "$.text", "string")), lambda t: t.isNotNull()).alias("descriptions"),
        text_map("web_sites"), text_map("nomenclature"), text_map("last_updates"),
        _get(v, "$.notes.entity", "string").alias("entity"),
    )
