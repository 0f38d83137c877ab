"""Labels of reports and registries: dictionaries, splits and slugs."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import slug, squeeze, strip_text

# Codes of school types and their labels; of a code given twice the last counts.
SCHOOL_TYPES = {
    "AA": "Scuola dell'infanzia",
    "EE": "Scuola primaria",
    "MM": "Scuola secondaria di I grado",
    "SD": "Scuola secondaria di I grado (annessa convitto)",
    "PC": "Liceo classico",
    "PS": "Liceo scientifico",
    "PM": "Liceo scientifico opz. scienze applicate",
    "PL": "Liceo linguistico",
    "PP": "Liceo delle scienze umane",
    "PQ": "Liceo delle scienze umane opz. economico-sociale",
    "PR": "Liceo musicale",
    "PT": "Liceo coreutico",
    "PB": "Liceo artistico",
    "RS": "Liceo scientifico europeo",
    "RV": "Liceo scientifico (annesso convitto)",
    "SL": "Liceo (annesso convitto)",
    "TA": "Istituto tecnico agrario",
    "TB": "Istituto tecnico per geometri (Costruzioni, ambiente e territorio)",
    "TD": "Istituto tecnico commerciale (Amministrazione, finanza e marketing)",
    "TE": "Istituto tecnico industriale",
    "TF": "Istituto tecnico (Informatica e telecomunicazioni)",
    "TH": "Istituto tecnico nautico (Trasporti e logistica)",
    "TL": "Istituto tecnico per il turismo",
    "TM": "Istituto tecnico (Meccanica, meccatronica ed energia)",
    "TN": "Istituto tecnico (Elettronica ed elettrotecnica)",
    "TG": "Istituto tecnico (Grafica e comunicazione)",
    "TI": "Istituto tecnico (Sistema moda)",
    "TJ": "Istituto tecnico (Agraria, agroalimentare e agroindustria)",
    "TK": "Istituto tecnico (Costruzioni, ambiente e territorio)",
    "RA": "Istituto professionale (Servizi per l'agricoltura e lo sviluppo rurale)",
    "RB": "Istituto professionale (Servizi socio-sanitari)",
    "RC": "Istituto professionale (Servizi commerciali)",
    "RD": "Istituto professionale (Manutenzione e assistenza tecnica)",
    "RE": "Istituto professionale (Produzioni industriali e artigianali)",
    "RF": "Istituto professionale (Pesca commerciale e produzioni ittiche)",
    "RH": "Istituto professionale (Enogastronomia e ospitalità alberghiera)",
    "RI": "Istituto professionale (Servizi culturali e dello spettacolo)",
    "RJ": "Istituto professionale (Arti ausiliarie delle professioni sanitarie)",
    "RM": "Corso serale",
    "VC": "Convitto nazionale",
    "VE": "Educandato statale",
}


def map_label(c: Column, labels: dict[str, str] = SCHOOL_TYPES) -> Column:
    """The label of a code, trimmed and in upper case; codes without a label stay as they are."""
    code = F.upper(strip_text(c))
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(table, code), code)


def split_label_a(c: Column) -> Column:
    """``left - middle | right`` as a struct (a1, a2, a3, error); the first separators count."""
    pattern = r"(?s)^(.*?) - (.*?) \| (.*)$"
    s = F.coalesce(c, F.lit(""))
    error = F.when(~s.contains(" - "), F.lit('missing " - "')).when(~s.rlike(pattern), F.lit('missing " | " after " - "'))
    part = lambda k: F.when(error.isNull(), squeeze(F.regexp_extract(s, pattern, k)))
    return F.struct(part(1).alias("a1"), part(2).alias("a2"), part(3).alias("a3"), error.alias("error"))


def strip_prefix(c: Column) -> Column:
    """Single spaces, and no leading ``variabilità dei punteggi -`` however its accent was mangled."""
    s = squeeze(F.coalesce(c, F.lit("")))
    return F.trim(F.regexp_replace(s, r"(?i)^variabilit.*?dei\s+punteggi\s*-\s*", ""))


def split_label_b(c: Column) -> Column:
    """``b1 - b2 - b3 | b4 | b5`` as a struct (b1 to b5, error); further separators stay in the last part."""
    dashes = F.split(strip_prefix(c), " - ", 3)
    bars = F.split(F.get(dashes, F.lit(2)), r" \| ", 3)
    error = F.when(F.size(dashes) < 3, F.lit('not enough " - "')).when(F.size(bars) < 3, F.lit('not enough " | "'))
    parts = [F.get(dashes, F.lit(0)), F.get(dashes, F.lit(1)), *[F.get(bars, F.lit(k)) for k in range(3)]]
    return F.struct(*[F.when(error.isNull(), squeeze(p)).alias(f"b{k}") for k, p in enumerate(parts, 1)], error.alias("error"))


def column_name(prefix: str, *parts: Column) -> Column:
    """The name of a wide column: the prefix and the slugs of the parts that aren't empty, each followed by ``_``."""
    slugs = [F.nullif(slug(p), F.lit("")) for p in parts]
    return F.concat(F.concat_ws("_", F.lit(prefix.rstrip("_")), *slugs), F.lit("_"))


def slash_slug(c: Column) -> Column:
    """``slug`` of report labels; null becomes empty."""
    return slug(F.coalesce(c, F.lit("")))


def variable_slug(c: Column) -> Column:
    """Slug of a label ``segment - scuola … - classi … | subject | dimension``, made of its parts.

    Labels with fewer bars are slugged as a whole; ``label`` stays; null becomes empty.
    """
    s = strip_text(F.coalesce(c, F.lit("")))
    parts = F.split(s, r"\|")
    prefix = F.trim(parts[0])
    segment = F.regexp_replace(F.trim(F.replace(F.lower(prefix), F.lit("variabilità dei punteggi -"), F.lit(""))), r"(?s)\s-\s*scuola\s.*$", "")
    grade = F.regexp_extract(prefix, r"(?i)scuola\s+(primaria|secondaria\s+di\s+i\s+grado|secondaria\s+di\s+ii\s+grado)", 1)
    cohort = F.regexp_extract(prefix, r"(?i)classi\s+(seconde|quinte(?:/ultimo anno)?|quarte|terze|prime)", 1)
    made = [segment, grade, cohort, F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))]
    full = F.concat_ws("_", F.lit("var"), *[F.nullif(slash_slug(x), F.lit("")) for x in made])
    return F.when(s == "label", s).when(F.size(parts) < 3, slash_slug(s)).otherwise(full)


def column_label(c: Column) -> Column:
    """Single spaces, lower case, no institute codes or school prefix; ``scuola`` if nothing is left, empty for null."""
    s = F.lower(squeeze(c))
    s = F.regexp_replace(F.regexp_replace(s, "(?i)rmi[cps][0-9]{6,}", ""), r"^situazione della scuola\b\s*[:\-–—]?\s*", "")
    s = F.when(s == "", F.lit("scuola")).otherwise(s)
    s = F.replace(F.replace(s, F.lit(", ,"), F.lit(",")), F.lit(",,"), F.lit(","))
    return F.coalesce(F.regexp_replace(F.regexp_replace(s, "_+", "_"), "^_|_$", ""), F.lit(""))


# Abbreviations of the short form, in this order; patterns first, then plain words.
SHORT_PATTERNS = (
    (r"(?i)scuola[_ ]+secondaria[_ ]+di[_ ]+i[_ ]+grado", "medie"),
    (r"(?i)scuola[_ ]+secondaria[_ ]+di[_ ]+ii[_ ]+grado", "superiori"),
    (r"(?i)istituti[_ ]+tecnici", "tec"),
    (r"(?i)istituti[_ ]+professionali", "prof"),
    (r"(?i)licei[_ ]+scientifici[_ ]+classici[_ ]+e[_ ]+linguistici", "licei"),
    (r"(?i)classi[_ ]+prime($|_)", "i"),
    (r"(?i)classi[_ ]+seconde", "ii"),
    (r"(?i)classi[_ ]+terze", "iii"),
    (r"(?i)classi[_ ]+quarte", "iv"),
    (r"(?i)classi[_ ]+quinte", "v"),
)
OWN_MODALITY = ("1.1.a.2_std_dis", "1.1.a.3_std_dsa")
SHORT_WORDS = (("matematica", "mat"), ("italiano", "ita"), ("inglese", "ing"), ("reading", "r"), ("listening", "l"), ("percentuale di studenti", "%"))


def readable_label(c: Column, short: bool = False) -> Column:
    """A label for readers: separators become spaces; ``short`` also abbreviates, and splits at slashes."""
    s = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("_|_|"), F.lit("")), F.lit("_|_"), F.lit(""))
    s = F.regexp_replace(s, "(?i)situazione[_ ]+della[_ ]+scuola", "")
    if short:
        for pattern, word in SHORT_PATTERNS:
            s = F.regexp_replace(s, pattern, word)
        for word, brief in SHORT_WORDS:
            s = F.replace(s, F.lit(word), F.lit(brief))
    return squeeze(F.regexp_replace(s, r"[|_\\/\-–—]+" if short else r"[|_\\\-–—]+", " "))


def readable_report_label(descriptor: Column, column: Column, short: bool = False) -> Column:
    """``readable_label`` of a column label. With the descriptor 2.4.c.1 only what follows its second bar counts."""
    tail = F.when((descriptor == "2.4.c.1") & (F.size(F.split(column, r"\|")) > 2), F.get(F.split(column, r"\|", 3), F.lit(2))).otherwise(column)
    return readable_label(tail, short)


def report_modality(descriptor: Column, modality: Column) -> Column:
    """The modality of a report row; empty for the descriptors that state theirs in their name."""
    return F.when(descriptor.isin(*OWN_MODALITY), F.lit("")).otherwise(modality)


def heading_or_default(heading: Column, table_index: Column) -> Column:
    """``valore`` where a row stands outside any table."""
    return F.when(table_index == -1, F.lit("valore")).otherwise(heading)


def blank_special(heading: Column, value: Column) -> Column:
    """Empty where the heading starts with ``sezione_2`` or ``sezione_5``."""
    return F.when(F.lower(F.coalesce(heading, F.lit(""))).rlike("^sezione_[25]"), F.lit("")).otherwise(value)
