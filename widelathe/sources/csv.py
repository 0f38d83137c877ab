"""Tolerant text sources: broken CSV, unknown dialects, registries and lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import map_label
from ..functions.numbers import split_value
from ..functions.text import canonical_code, postal_code, strip_text
from ..operators.columns import pick_column, require_columns
from ..operators.combine import union_all
from ..operators.dedup import first_nonempty, keep_first, source_order
from ..shared import materialize, small_enough

#: What is no UTF-8 is read as Latin-1, and the codes that Windows gives other characters are replaced after.
ENCODINGS = ("UTF-8", "ISO-8859-1")
_WINDOWS = {chr(b): c for b in range(0x80, 0xA0) if (c := bytes([b]).decode("cp1252", "ignore"))}
DELIMITERS = ("\t", ";", ",")
#: Lines and bytes of the sample in which delimiters are counted ``by_count``; encoding, quoting and header are taken from the whole file.
SAMPLE_LINES, SAMPLE_BYTES = 1000, 4096
#: Lines that an open quote may join at most.
MAX_GLUED = 10
#: Lists of files or of their blocks are broadcast up to this many.
BROADCAST_FILES = 100_000
#: Characters that no text has: a line break inside a record, and a text that is never met.
_BREAK, _NEVER = "\ufdd0", "\ufdd1"
# Columns that every cleaned report has.
REPORT_COLUMNS = ["CODICE_SCUOLA", "DESCRITTORE", "VALORE", "COLONNA"]
# Header names by which each column of an input is known, in order of preference.
CODE_NAMES = ["CODICE_SCUOLA", "codice_scuola", "CODICE_MECCANOGRAFICO", "codice_meccanografico", "CODICE", "codice"]
OBSERVATION_NAMES = {
    "entity_id": ["CODICE_SCUOLA", "codice_scuola", "school_code", "entity_id"],
    "entity_name": ["NOME_SCUOLA", "nome_scuola", "entity_name"],
    "endpoint_key": ["endpoint_key", "ENDPOINT_KEY", "endpoint"],
    "category": ["category", "CATEGORY"],
    "level": ["level", "LEVEL", "scope"],
    "value": ["value", "VALUE"],
}
AREAS = ("NORD_EST", "NORD_OVEST", "CENTRO", "SUD", "ISOLE")


def discover(spark: SparkSession, roots: list[str], pattern: str) -> DataFrame:
    """(path, length) of the files below the roots whose names match, each once."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(roots)
    return files.select("path", "length").distinct()


def area_of(path: Column, areas: tuple[str, ...] = AREAS) -> Column:
    """The area named by the folder nearest to a file; null if no folder names one."""
    parts = F.split(F.replace(F.upper(path), F.lit("%20"), F.lit(" ")), "/")  # file paths come with their spaces encoded
    folders = F.reverse(F.slice(parts, 1, F.size(parts) - 1))
    named = F.transform(folders, lambda f: F.coalesce(*[F.when(f.contains(a), F.lit(a)) for a in areas]))
    return F.get(F.filter(named, lambda a: a.isNotNull()), F.lit(0))


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(value, path, block, row, quotes) of the lines of files; ``block`` and ``row`` order the lines of a file. Large files are split."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), quotes.alias("quotes"))


def _joined(lines: list[str]) -> list[str]:
    """A record of several lines; if its quotes still don't balance, each of its lines without quotes."""
    whole = "\n".join(lines)
    return [whole] if whole.count('"') % 2 == 0 else [line.replace('"', "") for line in lines]


class _Held:
    """How many lines an open quote holds, and whether a record has ended yet, after some lines of a file."""

    def __init__(self, held: int, ended: bool, glued: int):
        self.held, self.ended, self.glued = held, ended, glued

    def even(self, lines: int) -> None:
        """Lines without an open quote."""
        if self.held and self.held + lines < self.glued:
            self.held += lines
        elif lines:
            self.held, self.ended = 0, True

    def odd(self) -> None:
        """A line that opens or closes a quote."""
        if self.held or self.glued <= 1:
            self.held, self.ended = 0, True
        else:
            self.held = 1

    def over(self, odd: np.ndarray) -> "_Held":
        at = -1
        for k in np.flatnonzero(odd).tolist():
            self.even(k - at - 1)
            self.odd()
            at = k
        self.even(len(odd) - at - 1)
        return self


_BLOCK_FACTS = "path string, block long, held array<int>, ended array<boolean>, tail array<string>"


def _block_facts(glued: int):  # noqa: ANN202
    """What each block of a file does to an open quote: for each number of lines that may be held before it how many are after it, and its last lines."""

    def facts(batches):  # noqa: ANN001, ANN202
        key, odd, tail = None, [], []

        def done() -> pa.RecordBatch:
            ends = [_Held(h, False, glued).over(np.concatenate(odd)) for h in range(glued)]
            made = {"path": [key[0]], "block": [key[1]], "held": [[e.held for e in ends]], "ended": [[e.ended for e in ends]], "tail": [tail]}
            return pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(made.items(), (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.string())), strict=True)})

        for batch in batches:
            for part, own in _by_block(batch):
                if part != key:
                    if key:
                        yield done()
                    key, odd, tail = part, [], []
                odd.append(own.column("odd").to_numpy(zero_copy_only=False))
                tail = (tail + own.column("value").slice(max(0, own.num_rows - glued)).to_pylist())[-glued:]
        if key:
            yield done()

    return facts


def _by_block(batch: pa.RecordBatch):  # noqa: ANN202
    """((path, block), rows) of the blocks in a batch, in which they stand together."""
    blocks = batch.column("block").to_numpy()
    paths = batch.column("path").dictionary_encode().indices.to_numpy()
    edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(paths) != 0)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        if b > a:
            yield (batch.column("path")[int(a)].as_py(), int(blocks[a])), batch.slice(a, b - a)


_STARTS = "path string, block long, carry array<string>, headless boolean, last boolean"


def _starts(glued: int):  # noqa: ANN202
    """With the blocks of each file in order: the lines that an open quote holds before a block, and whether the block is the file's last. Blocks that start and end without any are left out."""

    def fold(batches):  # noqa: ANN001, ANN202
        held, ended, lines, before = 0, False, [], None

        def row(last: bool) -> list[tuple]:
            path, block, carry, headless, open_ = before
            return [(path, block, carry, headless, last)] if carry or (last and open_) else []

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if before and before[0] != r["path"]:
                    out += row(True)
                    held, ended, lines, before = 0, False, [], None
                elif before:
                    out += row(False)
                carry = lines[len(lines) - held :] if held else []
                held, ended, headless = r["held"][held], ended or r["ended"][held], not ended
                before = (r["path"], r["block"], carry, headless, held > 0)
                lines = (lines + r["tail"])[-glued:]
            yield _rows_of(out)
        if before:
            yield _rows_of(row(True))

    return fold


def _rows_of(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.bool_())
    names = ("path", "block", "carry", "headless", "last")
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def _glue(glued: int):  # noqa: ANN202
    """The records that end in each block, less the first of each file."""

    def glue(batches):  # noqa: ANN001, ANN202
        key, held, skip, last = None, [], False, False

        def done(records: list[str]) -> list[str]:
            nonlocal skip
            first, skip = int(skip and bool(records)), skip and not records
            return records[first:]

        for batch in batches:
            for part, own in _by_block(batch):
                if part != key:
                    if key and last and held:
                        yield pa.RecordBatch.from_pydict({"value": pa.array(done(_joined(held)), pa.string())})
                    key = part
                    carry, headless, last = (own.column(c)[0].as_py() for c in ("carry", "headless", "last"))
                    held, skip = list(carry or []), part[1] == 0 or bool(headless)
                odd = own.column("odd").to_numpy(zero_copy_only=False)
                if not held and not odd.any():
                    yield pa.RecordBatch.from_arrays([own.column("value").slice(int(skip))], ["value"])
                    skip = False
                    continue
                out: list[str] = []
                open_ = bool(held)
                for value, is_odd in zip(own.column("value").to_pylist(), odd.tolist(), strict=True):
                    held.append(value)
                    open_ ^= is_odd
                    if not open_ or len(held) >= glued:
                        out += done(_joined(held))
                        held, open_ = [], False
                yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
        if key and last and held:
            yield pa.RecordBatch.from_pydict({"value": pa.array(done(_joined(held)), pa.string())})

    return glue


def records(spark: SparkSession, paths: str | list[str], glued: int = MAX_GLUED) -> DataFrame:
    """(value) of every record after the first one of each file.

    A line with an open quote goes on in the next lines, at most ``glued`` lines in all; if the quotes don't balance by
    then, they are taken off these lines and each is a record. Files stay split: each block tells what it does to an open quote, whatever number
    of lines is held before it, and its last lines; a fold over a file's blocks, small rows in order, then tells each block what it starts with. A record belongs to the block that it ends in.
    """
    lines = text_lines(spark, paths)
    if lines.where("quotes % 2 = 1").isEmpty():
        first = lines.where("block = 0").groupBy("path").agg(F.min("row").alias("first"))
        first = F.broadcast(first) if small_enough(first, BROADCAST_FILES) else first
        return lines.join(first, "path", "left").where(~F.col("row").eqNullSafe(F.col("first"))).select("value")
    odd = lines.select("value", "path", "block", "row", (F.col("quotes") % 2 == 1).alias("odd"))
    facts = odd.mapInArrow(_block_facts(glued), _BLOCK_FACTS).repartition("path").sortWithinPartitions("path", "block")
    starts = materialize(facts.mapInArrow(_starts(glued), _STARTS), "csv-starts")
    if small_enough(starts, BROADCAST_FILES):
        # a broadcast keeps the lines of a block together and in order
        placed = odd.join(F.broadcast(starts), ["path", "block"], "left")
    else:
        placed = odd.join(starts, ["path", "block"], "left").repartition("path", "block").sortWithinPartitions("path", "block", "row")
    return placed.select("value", "path", "block", "odd", "carry", "headless", "last").mapInArrow(_glue(glued), "value string")


def read_tolerant(spark: SparkSession, paths: str | list[str], columns: list[str], sep: str = ",") -> DataFrame:
    """All columns as text; fields may hold line breaks. Each file starts with a header.

    Quotes that stay open are repaired as in ``records``. Records with more fields than ``columns`` are dropped;
    fields that lack at a record's end, and empty ones, are null. Blank lines are no records. An empty file has no rows.
    """
    rows = records(spark, paths).where(F.trim("value") != "")
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_more"])
    options = {"sep": sep, "mode": "PERMISSIVE", "escape": '"', "nullValue": _NEVER, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    # a line break inside a record travels under another character
    fields = F.from_csv(F.replace("value", F.lit("\n"), F.lit(_BREAK)), schema, options)
    whole = rows.select(fields.alias("f")).select("f.*").where("_more IS NULL")
    return whole.select(*[F.nullif(F.replace(f"`{c}`", F.lit(_BREAK), F.lit("\n")), F.lit("")).alias(c) for c in columns])


def read_clean_reports(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """Cleaned report rows, all columns as text, under their canonical code (``entity_id``); rows without a code go.

    ``columns`` are those of the files' header. A ``ValueError`` names columns that every report needs and that lack.
    """
    rows = require_columns(read_tolerant(spark, paths, columns), REPORT_COLUMNS)
    return rows.select(canonical_code(F.coalesce(REPORT_COLUMNS[0], F.lit(""))).alias("entity_id"), *[F.coalesce(f"`{c}`", F.lit("")).alias(c) for c in columns if c != REPORT_COLUMNS[0]]).where("entity_id != ''")


def detect_delimiter(head: str, by_count: bool = False) -> str:
    """The delimiter with the most uses: in the first line, or with ``by_count`` in the whole sample; a comma if none has any."""
    sample = head if by_count else head.split("\n", 1)[0]
    return max(DELIMITERS if not by_count else (",", ";", "\t"), key=sample.count) if any(map(sample.count, DELIMITERS)) else ","


def _dialect(valid: Column, line: Column, sample: Column, by_count: bool) -> Column:
    """(delimiter, header) by whether the file is UTF-8, its first line and a sample of lines."""

    @F.udf("struct<sep:string,header:array<string>>")
    def dialect(valid, line, sample):  # noqa: ANN001, ANN202
        first = bytes(line).decode("utf-8-sig" if valid else "cp1252", "replace")
        # delimiters are ASCII in either encoding
        sep = detect_delimiter(b"\n".join(map(bytes, sample))[:SAMPLE_BYTES].decode("latin-1") if by_count else first, by_count)
        return sep, [h.strip().strip('"').strip().lstrip("\ufeff").upper() for h in first.strip("\r").split(sep)]

    return dialect(valid, line, sample)


def _unclosed(line: Column, sep: str) -> Column:
    """Of a line with an odd number of quotes: 1 if it can only open a field that goes on in the next line, -1 if it could close one, else 0 (quotes inside a field without quotes)."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    return F.when(single.rlike(f'^[^"]*"(?:{sep}|$)'), -1).when(single.rlike(f'(?:^|{sep})"[^"]*$'), 1).otherwise(0)


def dialects(spark: SparkSession, paths: list[str], by_count: bool = False) -> dict[tuple[str, str, str, tuple[str, ...]], list[str]]:
    """(delimiter, encoding, quoting, header) -> files.

    Encoding and quoting are judged by all lines of a file, in tasks that share large files. Quoting is ``plain`` where no line
    leaves a quote open, ``lines`` where some do, and ``off`` where the quotes of the whole file don't balance: their number is odd, or
    more lines open a field than there are lines that could close one, which no quoted text that goes on does. The driver gets
    each dialect once, with its paths.
    """
    lines = text_lines(spark, paths)
    odd = F.col("quotes") % 2 == 1
    unclosed = [F.sum(F.when(odd, _unclosed(F.col("value"), sep)).otherwise(0)).alias(f"unclosed_{k}") for k, sep in enumerate(DELIMITERS)]
    whole = lines.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("valid"), F.bool_or(odd).alias("open"), (F.sum("quotes") % 2 == 1).alias("odd"), *unclosed)
    tops = lines.where("block = 0").groupBy("path").agg(F.min("row").alias("first"))
    top = lines.join(tops, "path").where(F.col("row") < F.col("first") + F.lit(SAMPLE_LINES if by_count else 1))
    heads = top.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", F.col("value").cast("binary").alias("v")))), lambda x: x["v"]).alias("sample"))
    more = F.coalesce(*[F.when(F.col("d.sep") == sep, F.col(f"unclosed_{k}") > 0) for k, sep in enumerate(DELIMITERS)])
    quoting = F.when(~F.col("open"), F.lit("plain")).when(F.col("odd") | more, F.lit("off")).otherwise(F.lit("lines"))
    own = whole.join(heads, "path").withColumn("d", _dialect(F.col("valid"), F.col("sample")[0], F.col("sample"), by_count)).select("path", "valid", quoting.alias("quoting"), "d")
    found = own.groupBy("d", "valid", "quoting").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return {(r["d"]["sep"], ENCODINGS[0 if r["valid"] else 1], r["quoting"], tuple(r["d"]["header"])): r["paths"] for r in found.toLocalIterator()}


def read_flexible(spark: SparkSession, paths: list[str], by_count: bool = False, order: str | None = None, file: str | None = None) -> DataFrame:
    """CSV files of any of the known delimiters and encodings, united by their upper-case header names.

    Files whose quotes don't balance are read without quoting. ``order`` names a column for the place of each row in the files, ``file`` one for the file's path.
    """
    frames = []
    for (sep, encoding, quoting, header), files in sorted(dialects(spark, paths, by_count).items()):
        names, seen = [], set()
        for k, h in enumerate(header):
            names.append(h if h and h not in seen else f"_{k}")
            seen.add(h)
        quotes = {"quote": "", "escape": "\\"} if quoting == "off" else {"escape": '"'}
        rows = spark.read.schema(text_schema(names)).options(header=True, sep=sep, encoding=encoding, multiLine=quoting == "lines", enforceSchema=True, **quotes).csv(files)
        rows = rows.withColumn(file, F.col("_metadata.file_path")) if file else rows
        rows = source_order(rows, order) if order else rows
        if encoding != ENCODINGS[0]:
            rows = rows.withColumns({c: F.translate(f"`{c}`", "".join(_WINDOWS), "".join(_WINDOWS.values())) for c in names})
        frames.append(rows)
    if not frames:
        raise ValueError(f"no files below {paths}")
    return union_all(frames)


def normalize_long(df: DataFrame, order: Column | None = None) -> DataFrame:
    """The long table: entity_id, entity_name, endpoint_key, category, level, value_num, value_text and src_ord, and ``src_file`` and ``area`` if ``df`` has them.

    Columns are found under any of their known names; rows without a code go. The order is ``order``, else a column ``src_ord``
    that ``df`` has, else the place in the files that ``df`` is read from; without any of them a ``ValueError`` asks for one.
    """
    if order is None and "src_ord" not in df.columns:
        try:
            df = source_order(df)
        except AnalysisException as e:
            raise ValueError("no files are read here: name the order of the rows") from e
    found = {k: pick_column(df, names, required=k in ("entity_id", "endpoint_key", "value")) for k, names in OBSERVATION_NAMES.items()}
    text = lambda k: strip_text(F.coalesce(F.col(f"`{found[k]}`").cast("string"), F.lit(""))) if found[k] else F.lit("")
    number, rest = split_value(text("value"))
    columns = [canonical_code(text("entity_id")).alias("entity_id"), *[text(k).alias(k) for k in ("entity_name", "endpoint_key", "category", "level")]]
    at = order if order is not None else F.col("src_ord")
    return df.select(*columns, number.alias("value_num"), rest.alias("value_text"), at.alias("src_ord"), *[c for c in ("src_file", "area") if c in df.columns]).where("entity_id != ''")


def read_school_list(df: DataFrame, order: list[Column], required: tuple[str, ...] = ("CODICESCUOLA", "DENOMINAZIONESCUOLA")) -> DataFrame:
    """(entity_id, entity_name and further columns) of a list of entities: names without quotes, trimmed, first row of each code."""
    clean = df.toDF(*[c.strip().strip('"').strip() for c in df.columns])
    require_columns(clean, list(required))
    named = clean.withColumnsRenamed(dict(zip(required, ("entity_id", "entity_name"), strict=True)))
    at = F.struct(*order).alias("_ord")
    named = named.select(*[strip_text(F.col(f"`{c}`").cast("string")).alias(c) for c in named.columns], at).where("coalesce(entity_id, '') != ''")
    return keep_first(named, ["entity_id"], [F.col("_ord")]).drop("_ord")


def three_columns(lines: DataFrame, names: tuple[str, str, str], value: str = "value") -> DataFrame:
    """Each line split at its first two commas; what lacks is empty."""
    parts = F.split(F.regexp_replace(value, "\r$", ""), ",", 3)
    return lines.select(*[F.coalesce(F.get(parts, F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)])


def load_key_figures(rows: DataFrame, order: Column, names: list[str] | None = None) -> DataFrame:
    """One row for each code with the first value of every column that isn't empty."""
    code = pick_column(rows, names or CODE_NAMES, required=True)
    keyed = rows.withColumn("entity_id", canonical_code(F.col(f"`{code}`"))).withColumn("src_ord", order).where("entity_id != ''")
    return first_nonempty(keyed.drop(code) if code != "entity_id" else keyed, ["entity_id"], F.col("src_ord"))


def load_registry(frames: list[DataFrame], order: str) -> DataFrame:
    """One row for each code of several registries: columns united, postal codes and type labels normalised, first value that isn't empty.

    Earlier frames come before later ones; ``order`` is the column of the order inside a frame.
    """
    keyed = []
    for k, frame in enumerate(frames):
        code = pick_column(frame, CODE_NAMES, required=True)
        rows = frame.withColumn("entity_id", canonical_code(F.col(f"`{code}`"))).withColumn("src_ord", F.struct(F.lit(k).alias("file"), F.col(order).alias("row"))).drop(code, order)
        for name, known, f in (("cap", ["cap"], postal_code), ("tipoDiIstruzione", ["tipoDiIstruzione", "tipo_di_istruzione", "tipoIstruzione"], map_label)):
            if c := pick_column(rows, known):
                rows = rows.withColumnRenamed(c, name).withColumn(name, f(F.col(name)))
        keyed.append(rows.where("entity_id != ''"))
    return first_nonempty(union_all(keyed), ["entity_id"], F.col("src_ord"))


def read_catalogue(df: DataFrame) -> DataFrame:
    """(endpoint_key, name, url_template, …) of a catalogue; rows without a code or URL go; header names in any case."""
    code, url = pick_column(df, ["CODICE_EP"], required=True), pick_column(df, ["URL"], required=True)
    return df.withColumnsRenamed({code: "endpoint_key", url: "url_template"}).where("trim(coalesce(endpoint_key, '')) != '' AND trim(coalesce(url_template, '')) != ''")


def repair_catalogue(lines: DataFrame, columns: list[str], value: str = "value") -> DataFrame:
    """Lines that were quoted as a whole and whose UTF-8 was read as Latin-1, as (columns)."""
    inner = F.replace(F.regexp_replace(value, '^"|"\\s*$', ""), F.lit('""'), F.lit('"'))
    mangled = inner.rlike("[ÃÂâ]") & inner.rlike(r"^[\x00-\xFF]*$")
    mended = F.when(mangled, F.try_validate_utf8(F.encode(F.when(mangled, inner), "ISO-8859-1"))).otherwise(inner)
    schema = ", ".join(f"`{c}` string" for c in columns)
    return lines.select(F.from_csv(F.coalesce(mended, inner), schema).alias("f")).select("f.*")


def read_documents(spark: SparkSession, root: str, suffix: str = ".json") -> DataFrame:
    """(entity_id, endpoint_key, body, ok) of files called ``entity/endpoint.json``; bodies that are no JSON aren't ok, empty files have no row."""
    # whole files as bytes: the text source makes a new configuration for each file
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root)
    path = F.split("_metadata.file_path", "/")
    name = F.regexp_replace(F.element_at(path, -1), rf"\{suffix}$", "")
    body = F.col("content").cast("string")
    return rows.select(F.url_decode(F.element_at(path, -2)).alias("entity_id"), name.alias("endpoint_key"), body.alias("body"), F.try_parse_json(body).isNotNull().alias("ok"))
