"""Lookups on normalised keys, with fallbacks, defaults and reports of what found no match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import place_key, place_key_spaced
from .dedup import keep_first, keep_preferred

#: The class of a place that the class lookup doesn't have.
DEFAULT_CLASS = "A - Polo o B - Polo intercomunale"
#: Lookups are broadcast up to this many rows.
BROADCAST_ROWS = 500_000


def lookup_side(lookup: DataFrame) -> DataFrame:
    """Marks a lookup for broadcast if it is checked to be small; else adaptive execution picks the join."""
    return F.broadcast(lookup) if lookup.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else lookup


def lookup_with_default(df: DataFrame, lookup: DataFrame, key: str, value: str, default: str, collation: str | None = None) -> DataFrame:
    """Left join of ``value`` by ``key``; ``default`` where nothing matches.

    With a ``collation``, such as ``UNICODE_CI_AI``, keys are compared by it, so that neither side is folded; of keys of the
    lookup that are the same by it the smallest counts.
    """
    if collation:
        same = F.collate(F.col(key), collation)
        side = lookup.where(F.col(key).isNotNull()).groupBy(same.alias("_same")).agg(F.min_by(value, F.collate(F.col(key), "UTF8_BINARY")).alias(value))
        joined = df.withColumn("_same", same).join(lookup_side(side), "_same", "left").drop("_same")
        return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))
    joined = df.join(lookup_side(lookup.select(key, value)), key, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def lookup_two_stage(df: DataFrame, lookup: DataFrame, place: Column, province: Column, values: list[str], order: list[Column]) -> DataFrame:
    """Adds ``values`` by (place, province), or by the place alone where that gives nothing; empty if neither does.

    ``lookup`` has place_key, prov_key, the values and the columns of ``order``, by which the
    first row of a place counts. ``df`` gains ``place_key`` and ``prov_key`` too.
    """
    keyed = df.withColumn("place_key", place).withColumn("prov_key", province)
    exact = keep_first(lookup.where(F.coalesce("prov_key", F.lit("")) != ""), ["place_key", "prov_key"], order)
    exact = exact.select("place_key", "prov_key", *[F.col(v).alias(f"_exact_{v}") for v in values])
    loose = keep_first(lookup, ["place_key"], order).select("place_key", *[F.col(v).alias(f"_loose_{v}") for v in values])
    joined = keyed.join(lookup_side(exact), ["place_key", "prov_key"], "left").join(lookup_side(loose), "place_key", "left")
    hit = F.coalesce(F.trim(f"_exact_{values[0]}"), F.lit("")) != ""
    out = {v: F.coalesce(F.when(hit, F.col(f"_exact_{v}")).otherwise(F.col(f"_loose_{v}")), F.lit("")) for v in values}
    return joined.withColumns(out).drop(*[f"_{k}_{v}" for k in ("exact", "loose") for v in values])


def unmatched(df: DataFrame, lookup: DataFrame, key: str, show: list[str]) -> DataFrame:
    """Distinct ``show`` of the rows whose key isn't empty and not in the lookup."""
    full = df.where(F.coalesce(F.col(key), F.lit("")) != "")
    return full.join(lookup.select(key), key, "left_anti").select(*show).distinct()


def class_lookup(lookup: DataFrame, place: str, value: str, order: list[Column]) -> DataFrame:
    """(place_key, class): the first row of each place in order; rows without a place go."""
    named = lookup.withColumn("place_key", F.upper(F.trim(F.col(place)))).withColumn("class", F.trim(F.col(value)))
    named = named.where(F.coalesce("place_key", F.lit("")) != "")
    return keep_first(named.select("place_key", "class", F.struct(*order).alias("_ord")), ["place_key"], [F.col("_ord")]).drop("_ord")


def class_lookup_smallest(lookup: DataFrame, place: str, value: str, order: list[Column]) -> DataFrame:
    """(place_key, class): the smallest class of each place under the spaced key, nulls last."""
    named = lookup.withColumn("place_key", place_key_spaced(F.col(place))).withColumn("class", F.col(value)).where("place_key != ''")
    named = named.select("place_key", "class", F.struct(*order).alias("_ord"))
    return keep_preferred(named, ["place_key"], [F.col("class").asc_nulls_last()], [F.col("_ord")]).drop("_ord")


def municipality_lookup(lookup: DataFrame, place: str, province: str | None, region: str, area: str, order: list[Column]) -> DataFrame:
    """(place_key, prov_key, region, macroarea): one row for each place and province, in source order."""
    prov = F.upper(F.trim(F.col(province))) if province else F.lit("")
    named = lookup.select(place_key(F.col(place)).alias("place_key"), F.coalesce(prov, F.lit("")).alias("prov_key"), F.trim(F.col(region)).alias("region"), F.trim(F.col(area)).alias("macroarea"), F.struct(*order).alias("src_ord"))
    return keep_first(named.where("place_key != ''"), ["place_key", "prov_key"], [F.col("src_ord")])
