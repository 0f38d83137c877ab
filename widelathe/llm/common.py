"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize, new_path, small_enough

__all__ = ["materialize", "new_path", "small_enough"]

#: The six ASCII white-space characters of ``[\x20\x09-\x0D]``.
ASCII_SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: Words of the white-space kind, as a Java pattern.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, one for each of ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less its columns called as one of ``names``, in any case."""
    gone = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def stripped(text: Column) -> Column:
    """``text`` less its ASCII white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in ASCII_SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of ``text``; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def join_checked(big: DataFrame, side: DataFrame, on: list[str], how: str, rows: int) -> DataFrame:
    """Joins ``side`` by broadcast if it has at most ``rows`` rows, else by a shuffle that adaptive execution can split."""
    return big.join(F.broadcast(side) if small_enough(side, rows) else side, on, how)
