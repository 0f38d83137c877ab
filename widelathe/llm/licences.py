"""Licence notices and licence expressions in texts.

One Aho-Corasick automaton over normalised words finds notice phrases ("under the
mit license") and identifier tags ("spdx license identifier"). What stands after
a tag in the original text is read as an expression of licences joined by
``and``, ``or`` and ``with``: a shunting-yard parser brings it into postfix order and evaluates
it at once, to one spelling of the expression and to the obligation it leaves.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, without
from .words import letter_words, utf8, word_bounds

#: The phrases whose places are counted, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Further notices. One that lies inside a longer one doesn't count, so that a version makes its family more exact.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache",
    "licensed under the apache license version 2": "apache-2",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "released into the public domain": "public-domain",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu lesser general public license version 2": "lgpl-2",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license": "agpl",
    "gnu affero general public license version 3": "agpl-3",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0 1 0": "cc0",
    "all rights reserved": "all-rights-reserved",
}

#: Words of tags after which, and a colon or an equals sign, an expression stands.
TAGS = ("spdx license identifier", "license expression", "license", "licence")

#: What a licence asks of those who pass the text on, mildest first.
OBLIGATIONS = ("permissive", "weak-copyleft", "copyleft", "non-commercial", "reserved")
#: Families of licences by obligation; a version after the family doesn't matter.
FAMILIES = {
    "permissive": ("mit", "apache", "bsd", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "bsl", "unlicense", "public-domain", "cc0", "cc-by", "0bsd", "python"),
    "weak-copyleft": ("lgpl", "mpl", "epl", "cc-by-sa", "cc-by-nd"),
    "copyleft": ("gpl", "agpl", "gfdl"),
    "non-commercial": ("cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd"),
    "reserved": ("all-rights-reserved",),
}
_RANK = {family: rank for rank, name in enumerate(OBLIGATIONS) for family in FAMILIES[name]}
#: How sure one label makes that the text carries a licence: by an expression, by a notice, and by a reservation of rights.
SURE = {"expression": 0.95, "notice": 0.8, "reserved": 0.5}

_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_EXPRESSIONS = pa.list_(pa.struct([("expression", pa.string()), ("obligation", pa.string())]))
_COUNTS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
_RESULT = pa.struct([*_COUNTS, ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("places", _PLACES), ("expressions", _EXPRESSIONS), ("obligation", pa.string()), ("score", pa.float64())])
RESULT = (
    "struct<n_words:long,n_base:long,first_word:long,last_word:long,base_labels:array<string>,labels:array<string>,"
    "places:array<struct<label:string,start:int,end:int>>,expressions:array<struct<expression:string,obligation:string>>,obligation:string,score:double>"
)
OUTPUTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "places", "expressions", "obligation", "score")

_TOKEN = re.compile(rb"[ \t\"']*([()]|[A-Za-z0-9][A-Za-z0-9.+-]*)")
_SIGN = re.compile(rb"[\"' \t]*[:=]")
#: Binding of the operators; ``with`` is the tightest.
_BINDS = {"or": 1, "and": 2, "with": 3}


def licence_name(identifier: str) -> str:
    """An identifier in lower case, without ``only``, ``or later``, ``+`` and a version's zeros; versions of Creative Commons licences go."""
    name = re.sub(r"(\+|-only|-or-later)$", "", identifier.lower().rstrip("."))
    name = re.sub(r"(\.0)+$", "", name)
    return re.sub(r"^(cc-by(?:-nc)?(?:-sa|-nd)?|cc0)-[\d.]+$", r"\1", name)


def rank_of(name: str) -> int | None:
    """The place of a licence's obligation in ``OBLIGATIONS``; none for an unknown licence."""
    return _RANK.get(name, _RANK.get(re.sub(r"-[\d.]+$", "", name)))


@dataclass(frozen=True)
class Term:
    """A licence, an exception or an expression that was put together: its spelling, its licences, its obligation and the operator on top."""

    text: str
    names: tuple[str, ...]
    rank: int
    binds: int = 4

    def under(self, binds: int) -> str:
        return f"({self.text})" if self.binds < binds else self.text


def _apply(op: str, a: Term, b: Term) -> Term:
    """``or`` leaves the choice of the milder side, ``and`` asks for both, ``with`` grants an exception to copyleft."""
    if op == "with":
        return Term(f"{a.text} with {b.text}", a.names, min(a.rank, 1) if a.rank == 2 else a.rank, 3)
    rank = min(a.rank, b.rank) if op == "or" else max(a.rank, b.rank)
    return Term(f"{a.under(_BINDS[op])} {op} {b.under(_BINDS[op])}", a.names + b.names, rank, _BINDS[op])


def _tokens(raw: bytes, at: int) -> list[str]:
    """The tokens from ``at`` as long as an expression can go on, less operators at its end and what they would join."""
    out: list[str] = []
    operand, exception = True, False
    while m := _TOKEN.match(raw, at):
        token = m[1].decode()
        kind = token.lower()
        if operand:
            if token == "(" and not exception:
                out.append(token)
            elif token in "()" or kind in _BINDS or not exception and rank_of(licence_name(token)) is None:
                break
            else:
                out.append(token)
                operand = exception = False
        elif token == ")":
            out.append(token)
        elif kind in _BINDS:
            out.append(kind)
            operand, exception = True, kind == "with"
        else:
            break
        at = m.end()
    while out and (out[-1] in _BINDS or out[-1] == "("):
        out.pop()
    return out


def parse_expression(raw: bytes, at: int = 0) -> Term | None:
    """The licence expression that starts at ``at``, evaluated; none if no licence that is known stands there or its brackets don't match.

    What comes after the expression doesn't matter: "MIT or Apache-2.0, see below" ends before the comma. A closing bracket
    that none opened ends it too.
    """
    out: list[Term] = []
    waiting: list[str] = []

    def settle(least: int) -> None:
        while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= least:
            b, a = out.pop(), out.pop()
            out.append(_apply(waiting.pop(), a, b))

    exception = False
    for token in _tokens(raw, at):
        if token == "(":
            waiting.append(token)
        elif token == ")":
            settle(0)
            if not waiting:
                break
            waiting.pop()
        elif token in _BINDS:
            settle(_BINDS[token])
            waiting.append(token)
            exception = token == "with"
        elif exception:
            out.append(Term(token.lower(), (), 0))
            exception = False
        else:
            name = licence_name(token)
            out.append(Term(name, (name,), rank_of(name)))
    settle(0)
    return out[0] if len(out) == 1 and not waiting else None


@lru_cache(4)
def _automaton(base: tuple, notices: tuple, tags: tuple) -> ahocorasick.Automaton:
    """Phrases with a space at either end; the value of one has its number of words and what it stands for."""
    roles: dict[str, list[tuple[str, str]]] = {}
    for kind, phrases in (("base", base), ("notice", notices), ("tag", [(t, "") for t in tags])):
        for phrase, label in phrases:
            words = b" ".join(letter_words(phrase.encode())).decode()
            if words:
                roles.setdefault(words, []).append((kind, label))
    automaton = ahocorasick.Automaton()
    for words, found in roles.items():
        automaton.add_word(f" {words} ", (words.count(" ") + 1, tuple(found)))
    automaton.make_automaton()
    return automaton


def _outermost(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans (first, last, label) less those that lie inside another, longer one."""
    out: list[tuple[int, int, str]] = []
    for span in sorted(set(spans), key=lambda s: (s[0], -s[1], s[2])):
        if not out or span[1] > out[-1][1] or span[:2] == out[-1][:2]:
            out.append(span)
    return out


def _found(raw: bytes | None, automaton: ahocorasick.Automaton) -> dict:
    words = letter_words(raw)
    out = dict(n_words=len(words), n_base=0, first_word=None, last_word=None, base_labels=[], labels=[], places=[], expressions=[], obligation=None, score=0.0)
    text = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} " if words and len(automaton) else ""
    hits = list(automaton.iter(text)) if text else []
    if not hits:
        return out
    # a match ends with the space after its last word: as many spaces stand before as the words up to it
    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4") == 32)
    last = (np.searchsorted(spaces, [end for end, _ in hits]) - 1).tolist()
    base, notices, tagged = [], [], []
    for stop, (_, (count, roles)) in zip(last, hits, strict=True):
        for kind, label in roles:
            {"base": base, "notice": notices, "tag": tagged}[kind].append((stop - count + 1, stop, label))
    starts, ends = word_bounds(raw)
    terms: list[tuple[int, int, Term]] = []
    for first, stop, _ in _outermost(tagged):
        if (sign := _SIGN.match(raw, ends[stop])) and (term := parse_expression(raw, sign.end())):
            terms.append((first, stop, term))
    named = base + _outermost(base + notices)
    labels = {label for _, _, label in named} | {n for _, _, t in terms for n in t.names}
    sure = dict.fromkeys((label for _, _, label in named), SURE["notice"])
    sure |= {label: SURE["reserved"] for label in sure if rank_of(label) == len(OBLIGATIONS) - 1}
    sure |= {n: SURE["expression"] for _, _, t in terms for n in t.names}
    ranks = [r for _, _, label in named if (r := rank_of(label)) is not None] + [t.rank for _, _, t in terms]
    # for each byte of UTF-8 the number of characters before it
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
    places = sorted({*named, *((first, stop, t.text) for first, stop, t in terms)})
    return out | {
        "n_base": len(base),
        "first_word": min((b[0] for b in base), default=None),
        "last_word": max((b[0] for b in base), default=None),
        "base_labels": sorted({label for _, _, label in base}),
        "labels": sorted(labels),
        "places": [{"label": label, "start": int(chars[starts[a]]), "end": int(chars[ends[b]])} for a, b, label in places],
        "expressions": [{"expression": t.text, "obligation": OBLIGATIONS[t.rank]} for _, _, t in terms],
        "obligation": OBLIGATIONS[max(ranks)] if ranks else None,
        "score": 1.0 - float(np.prod([1.0 - s for s in sure.values()])) if sure else 0.0,
    }


def _scanned(text: Column, base: tuple, notices: tuple, tags: tuple) -> Column:
    @F.arrow_udf(RESULT)
    def scanned(texts: pa.Array) -> pa.Array:
        automaton = _automaton(base, notices, tags)
        return pa.array([_found(raw, automaton) for raw in utf8(texts)], _RESULT)

    return scanned(text)


def scan(docs: DataFrame, *, base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES, tags: Sequence[str] = TAGS, text_col: str = "text") -> DataFrame:
    """Adds what licences every row's text names.

    ``n_words``; of the phrases ``base`` all places ``n_base``, the smallest and largest word they start at ``first_word``
    and ``last_word`` (from 0), and ``base_labels``; ``labels``, these and those of ``notices`` and of expressions after ``tags``; ``places``, the
    character ranges of the original text; ``expressions`` with the obligation each leaves; ``obligation``, the strictest of all;
    ``score``, 1 less the product over the labels of how unsure each leaves it (``SURE``). Arrays of labels are distinct and in code-point order.

    Phrases are words, so that "CC BY-NC" is "cc by nc"; places that overlap all count. A notice inside a longer one names nothing.
    Null and empty texts have no words and the score 0. Very long texts are scanned whole, one row at a time. Repeated rows
    each get the same result. An empty table stays empty; input columns called like an output column are replaced.
    """
    docs = without(docs, *OUTPUTS)
    (name,) = fresh(docs, "licence_result")
    out = docs.withColumn(name, _scanned(F.col(text_col), tuple(base.items()), tuple(notices.items()), tuple(tags)))
    return out.withColumns({c: F.col(f"`{name}`.{c}") for c in OUTPUTS}).drop(name)
