"""Text functions as columns. Null stays null unless a docstring says otherwise."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = " "


def _latin_folds() -> tuple[str, str]:
    """Latin letters that decompose into one letter and marks, and those letters."""
    pairs = []
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c))
        if len(plain) == 1 and plain != chr(point):
            pairs.append((chr(point), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_MARKED, _PLAIN = _latin_folds()


def squeeze(c: Column) -> Column:
    """Runs of any white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_text(c: Column) -> Column:
    """Less any white space at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_text(c: Column, lower: bool = False) -> Column:
    """Single spaces, optionally lower case; null becomes empty."""
    out = F.coalesce(squeeze(c), F.lit(""))
    return F.lower(out) if lower else out


def slug(c: Column, limit: int | None = None) -> Column:
    """Lower case, every run of other than ``[a-z0-9_]`` an underscore, none at the ends.

    Letters with accents are such runs too: ``variabilità`` becomes ``variabilit``.
    """
    out = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9_]+", "_"), "_+", "_")
    out = F.regexp_replace(out, "^_|_$", "")
    return F.substring(out, 1, limit) if limit else out


def slug_or(c: Column, blank: str, limit: int) -> Column:
    """``slug`` cut at ``limit``; ``blank`` for blank or null."""
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.lit(blank)).otherwise(slug(c, limit))


def strip_accents(c: Column) -> Column:
    """Latin letters less their marks, and no combining marks."""
    return F.regexp_replace(F.translate(c, _MARKED, _PLAIN), r"\p{Mn}+", "")


def strip_accents_exact(c: Column) -> Column:
    """Compatibility decomposition less combining marks, for every script; runs in Python."""
    @F.arrow_udf("string")
    def fold(texts: pa.Array) -> pa.Array:
        folded = [None if t is None else "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x)) for t in texts.to_pylist()]
        return pa.array(folded, pa.string())

    return fold(c)


def town_key(c: Column) -> Column:
    """Upper case with single spaces; accents stay."""
    return F.upper(squeeze(c))


def plain_upper(c: Column, exact: bool = False) -> Column:
    """Upper case without accents, the text that place keys are made of; where several are wanted of one text it is worth a column of its own."""
    return F.upper((strip_accents_exact if exact else strip_accents)(c))


def place_key(c: Column, exact: bool = False, plain: bool = False) -> Column:
    """Key of a place name: no accents, upper case, no apostrophe after a vowel, other punctuation a space. ``plain``: ``c`` is ``plain_upper`` already."""
    out = F.replace(c if plain else plain_upper(c, exact), F.lit("’"), F.lit("'"))
    return F.trim(F.regexp_replace(F.regexp_replace(out, "([AEIOU])'", "$1"), "[^A-Z0-9']+", " "))


def place_key_spaced(c: Column, plain: bool = False) -> Column:
    """As ``place_key``, with every apostrophe, hyphen and slash a space."""
    return F.trim(F.regexp_replace(c if plain else plain_upper(c), "[^A-Z0-9]+", " "))


def postal_code(c: Column) -> Column:
    """Up to five digits, filled with zeros at the left; empty for anything else, null included."""
    s = strip_text(c)
    return F.when(s.rlike("^[0-9]{1,5}$"), F.lpad(s, 5, "0")).otherwise(F.lit(""))


def canonical_code(c: Column) -> Column:
    """The first code of two letters and eight letters or digits; else all letters and digits. Empty for null."""
    s = F.upper(strip_text(F.coalesce(c, F.lit(""))))
    return F.coalesce(F.nullif(F.regexp_extract(s, r"\b([A-Z]{2}[A-Z0-9]{8})\b", 1), F.lit("")), F.regexp_replace(s, "[^A-Z0-9]", ""))


def truncate(c: Column, n: int) -> Column:
    """At most ``n`` characters, the last an ellipsis if some are cut."""
    s = F.coalesce(c, F.lit(""))
    return F.when(F.char_length(s) > n, F.concat(F.substring(s, 1, n - 1), F.lit("…"))).otherwise(s)


def sanitize(c: Column) -> Column:
    """Line breaks and tabs become spaces, runs of white space one space; for single-line CSV fields."""
    return F.regexp_replace(F.regexp_replace(c, "[\r\n\t]", " "), r"\s{2,}", " ")


def safe_name(c: Column) -> Column:
    """A file name: runs of other than letters, digits and ``_.-`` become ``_``; at most 180 characters; ``x`` for nothing."""
    out = F.substring(F.regexp_replace(strip_text(F.coalesce(c, F.lit(""))), r"[^A-Za-z0-9_.\-]+", "_"), 1, 180)
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("x"))


def request_url(template: Column, code: Column, name: Column | None = None) -> Column:
    """Fills ``{CODE}`` and ``{NAME}`` of a template; the name is percent-encoded."""
    out = F.replace(template, F.lit("{CODE}"), code)
    return out if name is None else F.replace(out, F.lit("{NAME}"), F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")))


def looks_like_json(content_type: Column, body: Column) -> Column:
    """Says json in its type, or starts with a bracket."""
    return F.lower(F.coalesce(content_type, F.lit(""))).contains("json") | F.coalesce(body, F.lit("")).rlike(r"^\s*[\[{]")


def canonical_json(body: Column) -> Column:
    """The same JSON value written anew; null if it can't be parsed."""
    return F.to_json(F.try_parse_json(body))


def flag_text(c: Column) -> Column:
    """``1``, ``0`` or, for null, empty."""
    return F.when(c, F.lit("1")).when(~c, F.lit("0")).otherwise(F.lit(""))


def has_word(c: Column, word: str) -> Column:
    """Whether the word occurs, in any case, as a word of its own."""
    return F.coalesce(c, F.lit("")).rlike(rf"(?i)\b{word}\b")


def has_part(c: Column, part: str) -> Column:
    return F.lower(F.coalesce(c, F.lit(""))).contains(part)
