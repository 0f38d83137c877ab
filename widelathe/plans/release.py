"""Releases: packages of the wide table, for all entities and for each area, with manifests and unmatched rows.

    root/version/long             the long table, by area and endpoint
    root/version/ALL/…            wide.parquet, wide.csv, unmatched.csv, manifest
    root/version/areas/…          the same, each with a folder package_area=X for every area
    root/version/files            the observation files, by area
    root/version/manifest         the packages of the release
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import place_key
from ..operators.blocks import Block, summarize
from ..sources.csv import area_of
from ..sources.sinks import sanitize_columns, write_csv, write_parquet
from .wide import RELEASE_BLOCKS, Sides, build_wide

AREA = "package_area"
#: Areas whose counts are observed while they are written; beyond that many they are taken from what was written.
OBSERVED_AREAS = 64
_BITS = 60


def _filled(columns: list[str]) -> dict[str, Column]:
    """Numbers whose bits tell which of the columns a row fills, ``_BITS`` columns in each."""
    words = [columns[k : k + _BITS] for k in range(0, len(columns), _BITS)]
    bit = lambda c, k: F.when(F.col(f"`{c}`").isNotNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
    return {f"_filled{j}": reduce(Column.bitwiseOR, [bit(c, k) for k, c in enumerate(word)]) for j, word in enumerate(words)}


def _names(columns: list[str]) -> Column:
    """The columns whose bits are set."""
    bits = [(c, F.col(f"_filled{k // _BITS}").bitwiseAND(F.lit(1 << (k % _BITS)).cast("long")) != 0) for k, c in enumerate(columns)]
    return F.array_compact(F.array(*[F.when(is_set, F.lit(c)) for c, is_set in bits]))


def write_counted(wide: DataFrame, path: str, areas: list[str] | None = None) -> DataFrame:
    """Writes ``wide`` as Parquet and returns (area, rows, columns): what was counted while it was written.

    ``columns`` are those in which any row has a value. Without ``areas`` the one row has a null area, else the table has the column
    ``package_area`` and a folder for each of its values; more than ``OBSERVED_AREAS`` are counted in what was written.
    """
    spark, columns = wide.sparkSession, [c for c in wide.columns if c != AREA]
    filled = _filled(columns)
    writer = lambda df: df.write.mode("overwrite").option("compression", "zstd").partitionBy(*([AREA] if areas is not None else []))
    if areas is not None and len(areas) > OBSERVED_AREAS:
        writer(wide).parquet(path)
        counts = spark.read.parquet(path).withColumns(filled).groupBy(F.col(AREA).alias("area")).agg(F.count(F.lit(1)).alias("rows"), *[F.bit_or(w).alias(w) for w in filled])
        return counts.select("area", "rows", _names(columns).alias("columns"))
    seen, metrics = Observation(), []
    for k, area in enumerate([None] if areas is None else areas):
        here = F.lit(True) if areas is None else F.col(AREA) == area
        metrics += [F.count(F.when(here, F.lit(1))).alias(f"rows{k}"), *[F.bit_or(F.when(here, F.col(w))).alias(f"{w}_{k}") for w in filled]]
    if not metrics:
        writer(wide).parquet(path)
        return spark.createDataFrame([], "area string, rows long, columns array<string>")
    writer(wide.withColumns(filled).observe(seen, *metrics).drop(*filled)).parquet(path)
    got = seen.get
    rows = [(area, got[f"rows{k}"], *[got[f"{w}_{k}"] or 0 for w in filled]) for k, area in enumerate([None] if areas is None else areas)]
    counts = spark.createDataFrame(rows, ", ".join(["area string", "rows long", *[f"{w} long" for w in filled]]))
    return counts.select("area", "rows", _names(columns).alias("columns"))


def unmatched_places(wide: DataFrame) -> DataFrame:
    """The entities of a wide table with a place that its lookup gave no region: (area, if there is one, entity_id, comune, provincia)."""
    shown = [c for c in (AREA, "entity_id", "comune", "provincia") if c in wide.columns]
    if "region" not in wide.columns or "comune" not in wide.columns:
        return wide.select(*shown).limit(0)
    lost = (place_key(F.coalesce("comune", F.lit(""))) != "") & (F.trim(F.coalesce("region", F.lit(""))) == "")
    return wide.where(lost).select(*shown).distinct()


def _sides_used(sides: Sides | None) -> dict[str, bool]:
    return {f"merge_{name}": getattr(sides, name, None) is not None for name in ("registry", "figures", "reports", "classes", "places")}


def write_package(wide: DataFrame, path: str, *, unmatched: DataFrame | None = None, **facts) -> DataFrame:
    """Writes a package (Parquet, CSV, unmatched rows, manifest) and returns its manifest, one row with ``json``.

    Written again it replaces itself. Rows and filled columns are counted while the table is written; CSV and unmatched rows are taken from what was.
    """
    spark = wide.sparkSession
    counts = write_counted(wide, f"{path}/wide.parquet")
    written = spark.read.parquet(f"{path}/wide.parquet")
    write_csv(written, f"{path}/wide.csv")
    lost = unmatched_places(written) if unmatched is None else unmatched
    n_lost = Observation()
    write_csv(lost.observe(n_lost, F.count(F.lit(1)).alias("rows")), f"{path}/unmatched.csv")
    known = {k: F.array(*map(F.lit, v)).cast("array<string>") if isinstance(v, (list, tuple)) else F.lit(v) for k, v in facts.items()}
    out = counts.drop("area").withColumns({"column_names": F.col("columns"), "columns": F.size("columns"), "unmatched": F.lit(n_lost.get["rows"]), **known})
    out = out.select("*", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
    out.select("json").write.mode("overwrite").text(f"{path}/manifest")
    return out


def _write_areas(wide: DataFrame, path: str, areas: list[str], facts: DataFrame, known: dict) -> DataFrame:
    """Writes the packages of all areas in one job and returns (area, rows, json)."""
    spark = wide.sparkSession
    counts = write_counted(wide.hint("rebalance", AREA), f"{path}/wide.parquet", areas)
    written = spark.read.schema(wide.schema).parquet(f"{path}/wide.parquet")
    to_csv = lambda df: sanitize_columns(df).write.mode("overwrite").options(header=True, escape='"', emptyValue="").partitionBy(AREA)
    to_csv(written).csv(f"{path}/wide.csv")
    lost = unmatched_places(written)
    write_parquet(lost, f"{path}/unmatched.parquet")
    lost = spark.read.schema(lost.schema).parquet(f"{path}/unmatched.parquet")
    to_csv(lost).csv(f"{path}/unmatched.csv")
    n_lost = lost.groupBy(F.col(AREA).alias("area")).agg(F.count(F.lit(1)).alias("unmatched"))
    out = counts.join(facts, "area", "left").join(n_lost, "area", "left").fillna(0, ["unmatched"])
    out = out.withColumns({"package": F.concat(F.lit("areas/"), "area"), "column_names": F.col("columns"), "columns": F.size("columns"), **known})
    out = out.select("area", "package", "rows", F.to_json(F.struct(*[c for c in out.columns if c != "area"]), {"ignoreNullFields": "false"}).alias("json"))
    out.select("json", F.col("area").alias(AREA)).write.mode("overwrite").partitionBy(AREA).text(f"{path}/manifest")
    return out


def release(obs: DataFrame, root: str, version: str, blocks: list[Block] = RELEASE_BLOCKS, sides: Sides | None = None, *, area: str | None = "area", inputs: tuple[str, ...] = (), slopes: str = "year") -> DataFrame:
    """Writes a release and returns (package, rows).

    The area of a row is its column ``area``; where there is none, that which the path in ``src_file`` names; rows without one are in ALL only. ``area=None``
    makes ALL alone. The long table is written first, and all packages are built out of one summary of it: scopes, categories and years are decided for ALL and
    for each area by its own rows. A package's manifest names the columns in which it has values, the rows, files and parts of its long table, the sides that were merged, the unmatched
    rows and ``inputs``; ``read_package`` gives these columns alone.
    """
    spark: SparkSession = obs.sparkSession
    path = f"{root}/{version}"
    if area and area not in obs.columns:
        obs = obs.withColumn(area, area_of(F.col("src_file")) if "src_file" in obs.columns else F.lit(None).cast("string"))
    own = F.col(area) if area else F.lit(None).cast("string")
    long = obs.withColumn(AREA, own).drop(*({area} - {AREA, None}))
    long.hint("rebalance", AREA, "endpoint_key").write.mode("overwrite").option("compression", "zstd").partitionBy(AREA, "endpoint_key").parquet(f"{path}/long")
    written = spark.read.schema(long.schema).parquet(f"{path}/long")
    source = F.col("src_file") if "src_file" in long.columns else F.lit(None).cast("string")
    files = written.select(AREA, F.col("_metadata.file_path").alias("part"), source.alias("file")).groupBy(AREA, "part", "file").agg(F.count(F.lit(1)).alias("rows"))
    write_parquet(files, f"{path}/files")
    files = spark.read.parquet(f"{path}/files")
    counted = [F.sum("rows").alias("long_rows"), F.count_distinct("part").alias("long_parts"), F.count_distinct("file").alias("files")]
    all_facts = files.agg(*counted).first().asDict()
    summary = summarize(written, blocks, by=(AREA,))
    used = _sides_used(sides)
    write_package(build_wide(None, blocks, sides, slopes=slopes, summary=summary), f"{path}/ALL", package="ALL", version=version, inputs=inputs, **{k: v or 0 for k, v in all_facts.items()}, **used)
    manifests = spark.read.text(f"{path}/ALL/manifest").select(F.lit(None).cast("string").alias("area"), F.lit("ALL").alias("package"), F.get_json_object("value", "$.rows").cast("long").alias("rows"))
    if area:
        areas = sorted(r[0] for r in files.where(F.col(AREA).isNotNull()).select(AREA).distinct().limit(OBSERVED_AREAS + 1).collect())
        facts = files.groupBy(F.col(AREA).alias("area")).agg(*counted)
        known = {"version": F.lit(version), "inputs": F.array(*map(F.lit, inputs)).cast("array<string>"), **{k: F.lit(v) for k, v in used.items()}}
        wide = build_wide(None, blocks, sides, slopes=slopes, by=(AREA,), summary=summary.where(F.col(AREA).isNotNull()))
        manifests = manifests.unionByName(_write_areas(wide, f"{path}/areas", areas, facts, known).select("area", "package", "rows"))
    packages = manifests.agg(F.array_sort(F.collect_list("package")).alias("packages"))  # a row for each area
    packages.select(F.to_json(F.struct(F.lit(version).alias("release_id"), F.current_timestamp().alias("created_at"), "packages")).alias("json")).write.mode("overwrite").text(f"{path}/manifest")
    return manifests.select("package", "rows")


def read_manifests(spark: SparkSession, root: str, version: str, schema: str) -> DataFrame:
    """The manifests of a release's packages, one row each, as far as ``schema`` names their fields."""
    at = [spark.read.text(f"{root}/{version}/{place}").select("value") for place in ("ALL/manifest", "areas/manifest")]
    return at[0].unionByName(at[1]).select(F.from_json("value", schema).alias("m")).select("m.*")


def read_package(spark: SparkSession, root: str, version: str, area: str | None = None) -> DataFrame:
    """The wide table of a package with the columns that it has values for."""
    path = f"{root}/{version}/" + ("ALL" if area is None else "areas")
    rows, manifest = spark.read.parquet(f"{path}/wide.parquet"), spark.read.text(f"{path}/manifest")
    if area is not None:
        rows, manifest = rows.where(F.col(AREA) == area), manifest.where(F.col(AREA) == area)
    names = manifest.select(F.from_json("value", "column_names array<string>").alias("m")).select("m.column_names").first()[0]
    return rows.select(*[F.col(f"`{c}`") for c in names])
