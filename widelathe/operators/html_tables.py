"""HTML pages and tables: key figures by class, and report tables cut into rows for SQL.

A small tag reader turns each page into rows of cells inside a task; which rows and
columns count is then said in DataFrame terms.
"""

from __future__ import annotations

from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import parse_int, parse_number
from ..functions.text import has_part, has_word
from ..shared import materialize
from .stats import first_flag

CELL = "struct<text:string,header:boolean,colspan:int,rowspan:int,tick:boolean>"
ROWS = f"array<struct<table_idx:int,row_idx:int,headings:array<string>,title:string,cells:array<{CELL}>>>"
TICK_COLUMNS = ["basso", "medio_basso", "medio", "medio_alto", "alto"]
# Class names that mark a ticked cell.
TICK_CLASSES = frozenset("check spunta selected active on img".split())


class _Tables(HTMLParser):
    """Collects the rows of tables of one class, with the bold ``classi`` paragraphs before each."""

    def __init__(self, table_class: str):
        super().__init__(convert_charrefs=True)
        self.wanted, self.rows, self.pending = table_class, [], []
        self.table, self.row, self.cell, self.text, self.count = None, None, None, [], -1
        self.paragraph, self.bold = None, False

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = (a.get("class") or "").lower().split()
        if tag == "table":
            self._end_row()
            if self.wanted in (a.get("class") or "").split():
                self.count += 1
                self.table = {"idx": self.count, "rows": 0, "headings": list(dict.fromkeys(self.pending)), "title": None}
            self.pending = []
        elif self.table is not None and tag == "tr":
            self._end_row()
            self.row = []
        elif self.table is not None and tag in ("td", "th") and self.row is not None:
            self._end_cell()
            number = lambda k: int(a[k]) if (a.get(k) or "").isdigit() else 1
            style = (a.get("style") or "").lower()
            tick = bool(TICK_CLASSES.intersection(classes)) or "url(" in style and "background" in style
            self.cell = {"text": "", "header": tag == "th", "colspan": number("colspan"), "rowspan": number("rowspan"), "tick": tick}
            self.title = "titleTableDsc" in (a.get("class") or "").split()
            self.text = []
        elif self.cell is not None and (tag in ("img", "svg") or tag == "input" and "checked" in a):
            self.cell["tick"] = True
        elif tag == "p" and self.table is None:
            self.paragraph, self.bold = [], False
        elif tag in ("b", "strong") and self.paragraph is not None:
            self.bold = True
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag == "table":
            self._end_row()
            self.table = None
        elif tag == "tr":
            self._end_row()
        elif tag in ("td", "th"):
            self._end_cell()
        elif tag == "p" and self.paragraph is not None:
            text = " ".join("".join(self.paragraph).split())
            if self.bold and "classi" in text.lower():
                self.pending.append(text)
            self.paragraph = None

    def handle_data(self, data):
        if self.cell is not None:
            self.text.append(data + " ")
        elif self.paragraph is not None:
            self.paragraph.append(data + " ")

    def close(self):
        super().close()
        self._end_row()

    def _end_cell(self):
        if self.cell is not None:
            self.cell["text"] = " ".join("".join(self.text).split())
            if self.title and self.table["title"] is None:
                self.table["title"] = self.cell["text"]
            self.row.append(self.cell)
            self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.table is not None and self.row:
            t = self.table
            self.rows.append({"table_idx": t["idx"], "row_idx": t["rows"], "headings": t["headings"], "title": t["title"], "cells": self.row})
            t["rows"] += 1
        self.row = None


def table_rows(docs: DataFrame, html: str = "html", table_class: str = "tableDsc", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep, table_idx, row_idx, headings, title, cells, error): a row for each row of the tables of a class.

    Scripts are passed over. A page that can't be read gives one row with its error; a page without such tables none.
    """

    @F.arrow_udf(f"struct<rows:{ROWS},error:string>")
    def parse(pages: pa.Array) -> pa.Array:
        out = []
        for page in pages.to_pylist():
            reader = _Tables(table_class)
            try:
                reader.feed(page or "")
                reader.close()
                out.append({"rows": reader.rows, "error": None if page is not None else "no document"})
            except Exception as e:  # one broken page must not end the job
                out.append({"rows": [], "error": f"{type(e).__name__}: {e}"})
        cell = pa.struct([("text", pa.string()), ("header", pa.bool_()), ("colspan", pa.int32()), ("rowspan", pa.int32()), ("tick", pa.bool_())])
        row = pa.struct([("table_idx", pa.int32()), ("row_idx", pa.int32()), ("headings", pa.list_(pa.string())), ("title", pa.string()), ("cells", pa.list_(cell))])
        return pa.array(out, pa.struct([("rows", pa.list_(row)), ("error", pa.string())]))

    parsed = docs.select(*keep, parse(html).alias("_p"))
    rows = parsed.select(*keep, F.explode_outer("_p.rows").alias("_r"), F.col("_p.error").alias("error")).where("_r IS NOT NULL OR error IS NOT NULL")
    return rows.select(*keep, "_r.*", "error")


def _with_first_label(rows: DataFrame, keep: tuple[str, ...], data: Column) -> DataFrame:
    """The first row of each table for which ``data`` holds."""
    best = rows.where(data).groupBy(*keep, "table_idx").agg(F.min_by(F.struct("row_idx", "headings", "title", "cells"), "row_idx").alias("_d"))
    return best.select(*keep, "table_idx", "_d.*")


def header_names(cells_of_rows: list[list[dict]]) -> list[str]:
    """Column names of header rows: the texts above a column from the top, joined by `` | ``; ``colN`` if there are none.

    A cell covers ``colspan`` columns and ``rowspan`` rows.
    """
    depth = len(cells_of_rows)
    width = max((sum(c["colspan"] for c in row) for row in cells_of_rows), default=0)
    held: dict[tuple[int, int], str] = {}
    for r, row in enumerate(cells_of_rows):
        at = 0
        for cell in row:
            while (r, at) in held and at < width:
                at += 1
            for c in range(at, min(width, at + cell["colspan"])):
                held.update({(k, c): cell["text"] for k in range(r, min(depth, r + cell["rowspan"]))})
            at += cell["colspan"]
    names = []
    for c in range(width):
        texts = dict.fromkeys(t for r in range(depth) if (t := held.get((r, c))))
        names.append(" | ".join(texts) or f"col{c + 1}")
    return names


def situation_rows(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep, table_idx, heading, row_label, column_label, value) of the first row of each table that starts with ``Situazione``.

    The columns are called by the header rows above the first data row. Missing cells are empty; cells past the
    header are ``extra_N``.
    """
    is_data = ~F.forall("cells", lambda c: c["header"])
    first_data = F.min(F.when(is_data, F.col("row_idx"))).over(Window.partitionBy(*keep, "table_idx"))
    heads = rows.withColumn("_first", first_data).where(F.col("row_idx") < F.coalesce("_first", F.lit(1 << 30)))
    heads = heads.groupBy(*keep, "table_idx").agg(F.array_sort(F.collect_list(F.struct("row_idx", "cells"))).alias("_h"))  # a table's header rows

    @F.arrow_udf("array<string>")
    def names(tables: pa.Array) -> pa.Array:
        return pa.array([header_names([r["cells"] for r in t]) for t in tables.to_pylist()], pa.list_(pa.string()))

    data = _with_first_label(rows, keep, is_data & has_word(F.col("cells")[0]["text"], "situazione"))
    joined = data.join(heads.select(*keep, "table_idx", names("_h").alias("_names"), "_h"), [*keep, "table_idx"])
    wide = F.greatest(F.size("_names"), F.size("cells"))
    cell = lambda k: F.struct(
        F.coalesce(F.get("_names", k), F.concat(F.lit("extra_"), (k + 1).cast("string"))).alias("column_label"),
        F.coalesce(F.get("cells", k)["text"], F.lit("")).alias("value"),
    )
    in_head = F.filter(F.transform("_h", lambda r: F.array_join(F.transform(r["cells"], lambda c: c["text"]), " ")), lambda t: F.lower(t).contains("classi"))
    heading = F.array_join(F.array_distinct(F.concat(F.coalesce("headings", F.array().cast("array<string>")), in_head)), " | ")
    return joined.select(*keep, "table_idx", heading.alias("heading"), F.col("cells")[0]["text"].alias("row_label"), F.explode(F.transform(F.sequence(F.lit(0), wide - 1), cell)).alias("_c")).select(*keep, "table_idx", "heading", "row_label", "_c.*")


def class_rows(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep, table_idx, heading, institute, score, diff) of the first ``classi`` row below the header of each score table."""
    text = F.transform("cells", lambda c: F.lower(c["text"]))
    is_head = F.exists(text, lambda t: t.contains("istituto/plesso/indirizzo")) & F.exists(text, lambda t: t.contains("punteggio medio"))
    head = _with_first_label(rows, keep, is_head).select(*keep, "table_idx", F.col("row_idx").alias("_at"), F.transform("cells", lambda c: F.lower(c["text"])).alias("_t"))
    place = lambda f: F.array_position(F.transform("_t", f), True).cast("int") - 1
    head = head.select("*", place(lambda t: t.contains("istituto/plesso/indirizzo")).alias("_i"), place(lambda t: t.contains("punteggio medio")).alias("_p"), place(lambda t: t.contains("diff") & t.contains("escs")).alias("_d"))
    below = rows.join(head, [*keep, "table_idx"]).where((F.col("row_idx") > F.col("_at")) & has_part(F.col("cells")[0]["text"], "classi"))
    best = below.groupBy(*keep, "table_idx").agg(F.min_by(F.struct("headings", "title", "cells", "_i", "_p", "_d"), "row_idx").alias("r"))
    at = lambda k: F.when(F.col(f"r.{k}") >= 0, F.coalesce(F.get("r.cells", F.col(f"r.{k}"))["text"], F.lit(""))).otherwise(F.lit(""))
    heading = F.coalesce("r.title", F.array_join("r.headings", " | "))
    return best.select(*keep, "table_idx", heading.alias("heading"), at("_i").alias("institute"), at("_p").alias("score"), at("_d").alias("diff"))


def tick_rows(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), names: list[str] = TICK_COLUMNS) -> DataFrame:
    """(keep, table_idx, row_label, one column for each name) of the first ``Situazione`` row: ``1`` at the first ticked cell."""
    data = _with_first_label(rows, keep, has_word(F.col("cells")[0]["text"], "situazione"))
    flags = first_flag([F.coalesce(F.get("cells", F.lit(k + 1))["tick"], F.lit(False)) for k in range(len(names))], names)
    return data.select(*keep, "table_idx", F.col("cells")[0]["text"].alias("row_label"), flags.alias("_f")).select(*keep, "table_idx", "row_label", "_f.*")


def dispatch(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "descriptor"), html: str = "html") -> DataFrame:
    """(keep, table_idx, heading, column_label, value, error) of pages of mixed descriptors, each read its own way.

    2.2.a.1 and 2.4.a.4: score tables. 2.2.b.2: situation tables. 2.2.b.1: tick tables. Other descriptors and broken pages give a row with an error.
    """
    # every reader takes its rows from what was parsed once
    rows = materialize(table_rows(docs, html, keep=keep), "html-rows")
    of = lambda *names: rows.where(F.col("descriptor").isin(*names) & F.col("error").isNull())
    cells = lambda names: F.inline(F.array(*[F.struct(F.lit(n).alias("column_label"), F.col(n).alias("value")) for n in names]))
    none = F.lit(None).cast("string").alias("error")
    a = class_rows(of("2.2.a.1", "2.4.a.4"), keep).select(*keep, "table_idx", "heading", cells(["institute", "score", "diff"]), none)
    b = situation_rows(of("2.2.b.2"), keep).select(*keep, "table_idx", "heading", "column_label", "value", none)
    c = tick_rows(of("2.2.b.1"), keep).select(*keep, "table_idx", F.col("row_label").alias("heading"), cells(TICK_COLUMNS), none)
    empty = lambda error: [F.lit(-1).alias("table_idx"), *[F.lit("").alias(n) for n in ("heading", "column_label", "value")], error.alias("error")]
    broken = rows.where(F.col("error").isNotNull()).select(*keep, *empty(F.col("error")))
    known = ("2.2.a.1", "2.4.a.4", "2.2.b.2", "2.2.b.1")
    other = docs.where(~F.col("descriptor").isin(*known)).select(*keep, *empty(F.lit("unknown descriptor")))
    return a.unionByName(b).unionByName(c).unionByName(broken).unionByName(other)


def key_figures(docs: DataFrame, figure_class: str, last_class: str, html: str = "html", status: Column | None = None, named: list[Column] | None = None) -> DataFrame:
    """Adds ``figure`` (whole number), ``figure_last`` (Italian number) and ``error`` from the elements of two classes.

    Errors: ``missing_nome_or_codice`` if one of ``named`` is blank, else ``http_status_N`` for a status other than 200, else ``selectors_not_found_or_no_digits`` if neither figure is there.
    """
    def inner(name: str) -> Column:
        found = F.regexp_extract(html, rf"""(?s)class\s*=\s*["'][^"']*(?<![\w-]){name}(?![\w-])[^"']*["'][^>]*>([^<]*)""", 1)
        return F.nullif(F.trim(found), F.lit(""))

    figure, last = parse_int(inner(figure_class)), parse_number(inner(last_class), "it_first")
    failed = F.when(status != 200, F.concat(F.lit("http_status_"), status.cast("string"))) if status is not None else F.lit(None)
    blank = [F.trim(F.coalesce(c, F.lit(""))) == "" for c in named or []]
    unnamed = F.when(reduce(Column.__or__, blank), F.lit("missing_nome_or_codice")) if blank else F.lit(None)
    error = F.coalesce(unnamed, failed, F.when(figure.isNull() & last.isNull(), F.lit("selectors_not_found_or_no_digits")))
    return docs.withColumns({"figure": figure, "figure_last": last, "error": error})
