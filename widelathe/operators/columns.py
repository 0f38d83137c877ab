"""Column names: resolution, prefixes, marks, order and collisions. All work on names alone, before anything runs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Endings and names of computed columns, and replacements in report column names, in this order.
COMPUTED_SUFFIXES = ("_mean_y", "_mean_y1y2", "_slope_y", "_sum_scuola", "_tasso_non_ammessi_pct", "_share_top_pct", "_share_low_pct", "_share_mean")
COMPUTED_NAMES = ("media_punteggiomedio_superiori_classiseconde", "media_punteggiomedio_superiori_classiquinteultimoanno")
REPORT_RENAMES = (
    ("scuola_secondaria_di_ii_grado", "superiori"),
    ("scuola_secondaria_di_i_grado", "medie"),
    ("dentro_le_classi_", "dentroleclassi"),
    ("tra_le_classi_", "traleclassi"),
    ("classi_seconde", "classiseconde"),
    ("classi_quinte_ultimo_anno", "classiquinteultimoanno"),
    ("inglese_reading", "inglesereading"),
    ("inglese_listening", "ingleselistening"),
    ("licei_scientifici_classici_e_linguistici", "liceiscientificiclassicilinguistici"),
    ("istituto_nel_suo_complesso", "istituto"),
    ("scuola_primaria", "primaria"),
    ("altri_licei_diversi_da_scientifici_classici_e_linguistici", "altrilicei"),
)


def pick_column(df: DataFrame, candidates: list[str], required: bool = False) -> str | None:
    """The first candidate that is a column, as written or else in any case."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    for c in candidates:
        if c in df.columns:
            return c
    for c in candidates:
        if c.lower() in lower:
            return lower[c.lower()]
    if required:
        raise ValueError(f"none of the columns {candidates} in {df.columns}")
    return None


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` itself, or an error that names the columns it lacks."""
    lacking = [n for n in names if n not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df


def prefix_columns(df: DataFrame, prefix: str, keep: tuple[str, ...] = ("entity_id",)) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep and not c.startswith(prefix)})


def star_computed(df: DataFrame, suffixes: tuple[str, ...] = COMPUTED_SUFFIXES, names: tuple[str, ...] = COMPUTED_NAMES) -> DataFrame:
    """Marks computed columns with ``*``; marked ones stay as they are."""
    return df.withColumnsRenamed({c: "*" + c for c in df.columns if not c.startswith("*") and (c in names or c.endswith(suffixes))})


def column_order(columns: list[str], first: list[str]) -> list[str]:
    """``first``, then the others by their leading number and name; starred ones lead within a number, unnumbered ones come last."""

    def place(c: str):
        m = re.match(r"\*?(\d+)_", c)
        return (0, int(m[1]), not c.startswith("*"), c) if m else (1, 0, False, c)

    head = [c for c in dict.fromkeys(first) if c in columns]
    return head + sorted((c for c in columns if c not in head), key=place)


def order_columns(df: DataFrame, first: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in column_order(df.columns, first)])


def rename_reports(df: DataFrame, replacements: tuple[tuple[str, str], ...] = REPORT_RENAMES) -> DataFrame:
    """Shortens report column names; columns that come to share a name become one, the first value that isn't null counting."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        new = c
        for old, by in replacements:
            new = new.replace(old, by)
        groups.setdefault(new, []).append(c)
    return df.select(*[(F.coalesce(*[F.col(f"`{c}`") for c in own]) if len(own) > 1 else F.col(f"`{own[0]}`")).alias(new) for new, own in groups.items()])


def rename_collisions(right: DataFrame, left_columns: list[str], keys: list[str], suffix: str) -> DataFrame:
    """Renames columns of ``right`` that ``left_columns`` has too, but for the keys."""
    return right.withColumnsRenamed({c: c + suffix for c in right.columns if c in left_columns and c not in keys})


def drop_named(df: DataFrame, name: str) -> DataFrame:
    """Drops columns called ``name`` in any case."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()])


def place_after(df: DataFrame, anchors: list[str], new: list[str]) -> DataFrame:
    """Moves ``new`` behind the first of ``anchors`` that exists; to the end if none does."""
    rest = [c for c in df.columns if c not in new]
    at = next((rest.index(a) + 1 for a in anchors if a in rest), len(rest))
    return df.select(*[F.col(f"`{c}`") for c in [*rest[:at], *[n for n in new if n in df.columns], *rest[at:]]])
