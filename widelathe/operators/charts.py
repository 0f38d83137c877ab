"""JSON chart documents to long observations, and JSON registries to rows, on the variant type."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHART = "struct<title:string,info:string,note:string,categories:array<string>,series:array<struct<name:string,data:variant,y:variant>>>"


def _is_list(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))


def _text(v: Column) -> Column:
    """A scalar as text; null for JSON's null."""
    return F.when(~F.is_variant_null(v), F.try_variant_get(v, "$", "string"))


def as_variant(docs: DataFrame, body: str) -> Column:
    """The document in ``body``, which is a variant or JSON text; null if it is no JSON."""
    return F.col(body) if dict(docs.dtypes)[body] == "variant" else F.try_parse_json(body)


def chart_rows(docs: DataFrame, body: str = "body", keep: tuple[str, ...] = ("entity_id", "endpoint_key")) -> DataFrame:
    """(keep, title, series_index, series_name, category_index, category, value, info, note, kind) of every chart.

    ``by_categories``: there is a list of categories and some series has a list; values past
    the categories have a null category. ``by_name_scalar``: no categories and only scalars; the
    series' name is the category, and ``y`` counts where ``data`` is absent. ``index_only``: no
    categories, and lists. Any other shape, and text that is no JSON, gives no rows. ``body`` is JSON text or a variant.
    """
    parsed = docs.select(*keep, F.try_variant_get(as_variant(docs, body), "$", CHART).alias("c")).where("c.series IS NOT NULL")
    lists = F.exists("c.series", lambda s: _is_list(s["data"]))
    named = F.coalesce(F.size("c.categories") > 0, F.lit(False))
    kind = F.when(named & lists, F.lit("by_categories")).when(~named & ~lists, F.lit("by_name_scalar")).when(~named & lists, F.lit("index_only"))
    series = parsed.select(*keep, "c", kind.alias("kind")).where("kind IS NOT NULL").select("*", F.posexplode("c.series").alias("series_index", "s"))
    # a scalar is a list of one
    values = F.when(_is_list(F.col("s.data")), F.try_variant_get("s.data", "$", "array<variant>"))
    single = F.array(F.when(F.col("s.data").isNull() | F.is_variant_null("s.data"), F.col("s.y")).otherwise(F.col("s.data")))
    cells = series.withColumn("_values", F.when(F.col("kind") == "by_name_scalar", single).otherwise(values)).select("*", F.posexplode("_values").alias("at", "v"))
    by_name = F.col("kind") == "by_name_scalar"
    return cells.select(
        *keep,
        F.col("c.title").alias("title"),
        "series_index",
        F.col("s.name").alias("series_name"),
        F.when(~by_name, F.col("at")).alias("category_index"),
        F.when(by_name, F.col("s.name")).when(F.col("kind") == "by_categories", F.get("c.categories", F.col("at"))).alias("category"),
        _text(F.col("v")).alias("value"),
        F.col("c.info").alias("info"),
        F.col("c.note").alias("note"),
        "kind",
    )


def observations(docs: DataFrame, skip: tuple[str, ...] = ("anagrafica_base",), **options) -> DataFrame:
    """``chart_rows`` of all documents but those of the registry's endpoint."""
    return chart_rows(docs.where(~F.col("endpoint_key").isin(*skip)), **options)


def record_schema(rows: DataFrame, record: str) -> dict[str, str]:
    """The fields of all records of a variant column and their types, in order of name: one aggregate, of which the driver gets the schema."""
    found = rows.agg(F.schema_of_variant_agg(record)).first()[0]
    if not found.startswith("OBJECT<"):
        return {}
    made = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", found))
    return {f.name: f.dataType.simpleString() for f in sorted(made.fields, key=lambda f: f.name)}


def registry_rows(docs: DataFrame, body: str = "body", keep: tuple[str, ...] = ("entity_id",), fields: list[str] | None = None, mode: str = "union", order: list[Column] | None = None, typed: bool = False) -> DataFrame:
    """A wide row for each registry document: the fields of its first record, its outcome and its number of elements.

    ``mode="union"`` takes the keys of all documents, ``"first"`` those of the first in ``order``. ``fields`` states them. Fields are text; ``typed`` gives those that
    are found by ``union`` the type that all documents agree on. ``body`` is JSON text or a variant.
    """
    v = as_variant(docs, body)
    rows = docs.select(*keep, *[c.alias(f"_o{k}") for k, c in enumerate(order or [])], F.try_variant_get(v, "$.scuole[0]", "variant").alias("record"), F.try_variant_get(v, "$.esito", "string").alias("esito"), F.try_variant_get(v, "$.numeroTotaleElementi", "bigint").alias("n_elements"))
    rows = rows.withColumn("m", F.try_variant_get("record", "$", "map<string,string>")).where("m IS NOT NULL")
    types: dict[str, str] = {}
    if fields is None and mode == "first":
        first = rows.orderBy(*[f"_o{k}" for k in range(len(order or []))]).select(F.map_keys("m")).first()
        fields = list(first[0]) if first else []
    elif fields is None:
        types = record_schema(rows, "record")
        fields = list(types)
    plain = lambda f: not typed or types.get(f, "string") in ("string", "void", "variant") or types[f].startswith(("array", "struct", "map"))
    value = lambda f: F.try_element_at("m", F.lit(f)) if plain(f) else F.try_element_at("m", F.lit(f)).try_cast(types[f])
    return rows.select(*keep, *[value(f).alias(f) for f in fields], "esito", "n_elements")
