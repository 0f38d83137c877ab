"""Numbers out of text in several locales, and year indices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NBSP, slug, strip_text

_NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _double(c: Column) -> Column:
    """A plain decimal number, else null; no suffixes, infinities or hexadecimals."""
    return F.when(c.rlike(_NUMERIC), c.try_cast("double"))


def parse_number(c: Column, mode: str = "eu") -> Column:
    """A number written in one of these ways, else null.

    ``eu``: with dot and comma the dots group thousands; a comma alone is the decimal sign; a dot
    alone is one too; ``%`` and spaces go anywhere. ``decimal_comma``: the comma is the
    decimal sign, nothing groups, one ``%`` may follow. ``it_first``: the first number in Italian
    format within the text. ``it_first_compat``: the same, of whose ungrouped digits
    only the first three count.
    """
    s = strip_text(F.replace(c, F.lit(NBSP), F.lit(" ")))
    if mode == "eu":
        s = F.when(~s.isin("", "nan", "None", "NA"), F.replace(s, F.lit("%"), F.lit("")))
        dotless = F.when(s.contains(",") & s.contains("."), F.replace(s, F.lit("."), F.lit(""))).otherwise(s)
        return _double(F.replace(F.replace(dotless, F.lit(","), F.lit(".")), F.lit(" "), F.lit("")))
    if mode == "decimal_comma":
        s = F.when(~F.lower(s).isin("", "n.d.", "nd", "nan", "none"), strip_text(F.regexp_replace(s, "%$", "")))
        return _double(F.replace(s, F.lit(","), F.lit(".")))
    if mode in ("it_first", "it_first_compat"):
        grouped = r"-?[0-9]{1,3}(?:\.[0-9]{3})+(?:,[0-9]+)?" if mode == "it_first" else r"-?[0-9]{1,3}(?:\.[0-9]{3})*(?:,[0-9]+)?"
        found = F.regexp_extract(c, rf"({grouped}|-?[0-9]+(?:,[0-9]+)?)", 1)
        return _double(F.replace(F.replace(found, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    raise ValueError(f"unknown mode {mode}")


def parse_int(c: Column) -> Column:
    """The first run of digits once dots and commas are gone: ``1.234`` is 1234, ``23,4`` is 234."""
    plain = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(""))
    return F.regexp_extract(plain, "([0-9]+)", 1).try_cast("bigint")


def split_value(c: Column, mode: str = "eu") -> tuple[Column, Column]:
    """(number or null, the text if it is no number, else empty)."""
    number = parse_number(c, mode)
    return number, F.when(number.isNull(), F.coalesce(c, F.lit(""))).otherwise(F.lit(""))


def year_index(label: Column) -> Column:
    """The year that a label names: ``y1`` to ``y6`` and the like, a lone digit 1 to 6, or a calendar year."""
    s = slug(label)
    first = F.regexp_extract(s, "(?:^|_)(?:y|anno|year|a)([1-6])(?:_|$)", 1)
    alone = F.regexp_extract(s, "(?:^|_)([1-6])(?:_|$)", 1)
    calendar = F.regexp_extract(label, "((?:19|20)[0-9]{2})", 1)
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (first, alone, calendar)]).try_cast("int")
