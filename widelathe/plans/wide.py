"""The wide table: one row for each entity, from the long table and its side tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import place_key, town_key
from ..operators.blocks import EXAM_BINS, MIDDLE_BINS, MIDDLE_LOW, MIDDLE_TOP, Bins, Block, Outcomes, Shares, Single, Total, Years, aggregate_summary, row_mean, slope_by_position, summarize
from ..operators.columns import order_columns, place_after, rename_collisions, rename_reports, star_computed
from ..operators.dedup import first_by, is_empty
from ..operators.enrich import DEFAULT_CLASS, lookup_side, lookup_two_stage

REPORT_BASE = "80_rav_22a1_invalsipunteggiomedio_superiori_"
# Report columns of which a mean is added, by the name of the mean.
REPORT_MEANS = {
    "media_punteggiomedio_superiori_classiseconde": [f"{REPORT_BASE}classiseconde_{s}_punteggio_medio_" for s in ("italiano", "matematica")],
    "media_punteggiomedio_superiori_classiquinteultimoanno": [f"{REPORT_BASE}classiquinteultimoanno_{s}_punteggio_medio_" for s in ("italiano", "matematica", "inglesereading", "ingleselistening")],
}

# The blocks of a release, in the order of their prefixes, with their endpoints and names.
RELEASE_BLOCKS = [
    Years("abbandoni_24_25", "10_", label="abbandoni"),
    Years("studenti_ripetenti", "11_", label="ripetenti"),
    Years("trasferimenti_24_25", "12_", label="trasferimenti"),
    Total("assenze_docenti", "13_", name="assenze_docenti_sum"),
    Total("assenze_ata", "14_", name="assenze_ata_sum"),
    Shares("entrate_fonti_finanziamento", "20_", name="entrate_{}_pct"),
    Outcomes("esiti_giugno_24_25", "21_", label="esiti_giugno"),
    Outcomes("esiti_giugno_settembre_24_25", "22_", label="esiti_settembre"),
    Single("docenti_pensionati", "30_", name="docenti_pensionati_pct"),
    Single("docenti_trasferiti", "30_", name="docenti_trasferiti_pct"),
    Bins("distribuzione_votazioni_esame_24_25", "40_", label="esame_voto", mids=EXAM_BINS),
    Bins("rav_24c5", "50_", label="medie_voto", mids=MIDDLE_BINS, low=MIDDLE_LOW, top=MIDDLE_TOP),
]


@dataclass
class Sides:
    """Side tables, each keyed by ``entity_id`` or, for lookups, by the place."""

    registry: DataFrame | None = None
    figures: DataFrame | None = None
    reports: DataFrame | None = None
    classes: DataFrame | None = None  # place_key, class
    places: DataFrame | None = None  # place_key, prov_key, region, macroarea, src_ord
    keep_first: list[str] = field(default_factory=lambda: ["entity_id"])


def forced_slopes(wide: DataFrame, blocks: list[Block], by_position: bool = False) -> DataFrame:
    """Replaces each year block's slope by that over its year columns: the year, or with ``by_position`` the place among those with any value."""
    for b in blocks:
        if isinstance(b, Years):
            names = [f"{b.prefix}{b.label}_y{k}" for k in range(1, 6) if f"{b.prefix}{b.label}_y{k}" in wide.columns]
            if by_position and names:
                some = wide.agg(*[F.bool_or(F.col(f"`{n}`").isNotNull()).alias(str(k)) for k, n in enumerate(names)]).first()
                names = [n for n, full in zip(names, some, strict=True) if full]
            wide = wide.withColumn(f"{b.prefix}{b.label}_slope_y", slope_by_position([F.col(f"`{n}`") for n in names]) if names else F.lit(None).cast("double"))
    return wide


def add_report_means(wide: DataFrame, means: dict[str, list[str]] = REPORT_MEANS) -> DataFrame:
    """Row means over those of the listed columns that exist; null without any."""
    return wide.withColumns({name: row_mean([F.col(f"`{c}`") for c in columns if c in wide.columns]) for name, columns in means.items()})


def build_wide(obs: DataFrame | None, blocks: list[Block], sides: Sides | None = None, *, star: bool = True, slopes: str = "year", by: tuple[str, ...] = (), summary: DataFrame | None = None) -> DataFrame:
    """Joins one aggregation of all blocks with the side tables, marks computed columns and orders all.

    ``slopes`` is ``year`` (index), ``position`` or ``none`` (as the block says). Every side table has
    one row for a key, so no join adds rows. A ``summary`` of the blocks, by ``by`` or more, saves the pass over ``obs``.
    """
    sides = sides or Sides()
    summary = summarize(obs, blocks, by=by) if summary is None else summary
    wide = aggregate_summary(summary, blocks, by=by)
    names = summary.groupBy("entity_id", *by).agg(first_by(F.col("entity_name"), F.col("_seen"), ~is_empty(F.col("entity_name"))).alias("entity_name"))
    wide = wide.join(names, ["entity_id", *by])
    if slopes != "none":
        wide = forced_slopes(wide, blocks, slopes == "position")
    for side, suffix in ((sides.registry, "_ana"), (sides.figures, "_sicstu")):
        if side is not None:
            wide = wide.join(rename_collisions(side, wide.columns, ["entity_id"], suffix), "entity_id", "left")
    if sides.reports is not None:
        wide = add_report_means(wide.join(rename_reports(sides.reports), "entity_id", "left"))
    if sides.classes is not None and "comune" in wide.columns:
        classes = sides.classes.withColumnRenamed("place_key", "_town")
        wide = wide.withColumn("_town", town_key(F.col("comune"))).join(lookup_side(classes), "_town", "left").drop("_town")
        wide = wide.withColumn("class", F.coalesce("class", F.lit(DEFAULT_CLASS)))
    if sides.places is not None and "comune" in wide.columns:
        province = F.upper(F.trim(F.coalesce(F.col("provincia"), F.lit("")))) if "provincia" in wide.columns else F.lit("")
        wide = lookup_two_stage(wide, sides.places, place_key(F.col("comune")), province, ["region", "macroarea"], [F.col("src_ord")]).drop("place_key", "prov_key")
        wide = place_after(wide, ["provincia", "cap", "comune"], ["region", "macroarea"])
    if star:
        wide = star_computed(wide)
    first = ["entity_id", *by, *(c for c in (sides.registry.columns if sides.registry is not None else []) if c != "entity_id"), *(c for c in (sides.figures.columns if sides.figures is not None else []) if c != "entity_id"), "entity_name"]
    return order_columns(wide, first)
