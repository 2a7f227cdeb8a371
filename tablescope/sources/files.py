"""Reading delimited text files with missing tokens and inferred column types."""

from __future__ import annotations

import codecs
import csv
import io
from collections.abc import Iterator
from functools import reduce
from pathlib import PurePosixPath

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..errors import EmptyDatasetError, FileValidationError, UnsupportedFileFormatError
from ..functions.values import INFINITY_PATTERN, INTEGER_PATTERN, NUMBER_PATTERN, col, text_to_double

# ---------------------------------------------------------------- fixed values
SEPARATORS = {".csv": ",", ".tsv": "\t", ".txt": ","}
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")
OVERFLOW, DAMAGED = "_overflow_cells", "_damaged_row"
UNDECODED = "\ufffd"  # what the reader puts in place of bytes it cannot decode
# Python codec names and the names the reader knows them by.
CHARSETS = {"iso8859-1": "ISO-8859-1", "ascii": "US-ASCII", "utf-8": "UTF-8", "utf-16": "UTF-16", "utf-16-be": "UTF-16BE", "utf-16-le": "UTF-16LE"}
# Options of the reader that concern lines or files.
WHOLE_FILE_OPTIONS = {"comment", "lineSep", "charToEscapeQuoteEscaping", "unescapedQuoteHandling", "maxColumns", "maxCharsPerColumn", "pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter"}
# -----------------------------------------------------------------------------


def file_suffix(source: str) -> str:
    return PurePosixPath(str(source).rstrip("/")).suffix.lower()


def missing_to_null(df: DataFrame) -> DataFrame:
    """Every text cell that spells a missing value becomes NULL."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~col(c).isin(*MISSING_TOKENS), col(c)) for c in texts}) if texts else df


def _fits(value: Column) -> dict[str, Column]:
    """Per physical type, whether a text is a literal of it.

    Missing cells fit every type but bigint: whole numbers with gaps are read
    as double, as data-frame libraries without integer gaps do.
    """
    whole = value.rlike(INTEGER_PATTERN) & F.trim(value).try_cast("bigint").isNotNull()
    return {
        "bigint": F.coalesce(whole, F.lit(False)),
        "double": value.rlike(NUMBER_PATTERN) | value.rlike(INFINITY_PATTERN),
        "boolean": value.isin(*TRUE_TOKENS, *FALSE_TOKENS),
    }


def examine(df: DataFrame, overflow: str | None = None) -> tuple[dict[str, str], bool, int]:
    """Column types that hold every value, whether bytes failed to decode, and the rows with cells in ``overflow``.

    One aggregate over the table: the narrowest of bigint, double, boolean and
    string per column; a column without any value counts as double.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name != overflow]
    cells = [
        F.struct(
            *[F.bool_and(fit).alias(t) for t, fit in _fits(col(c)).items()],
            F.count(col(c)).alias("n"),
            F.bool_or(F.contains(col(c), F.lit(UNDECODED))).alias("damaged"),
        ).alias(f"_{i}")
        for i, c in enumerate(texts)
    ]
    longer = F.count(col(overflow)) if overflow else F.lit(0)
    row = df.agg(longer.alias("longer"), *cells).first()
    found = [row[f"_{i}"] for i in range(len(texts))]
    types = {c: "double" if r["n"] == 0 else next((t for t in ("bigint", "double", "boolean") if r[t]), "string") for c, r in zip(texts, found)}
    return types, any(r["damaged"] for r in found), row["longer"]


def cast_inferred(df: DataFrame, types: dict[str, str]) -> DataFrame:
    def converted(c: str) -> Column:
        kind = types.get(c, "string")
        if kind == "bigint":
            return F.trim(col(c)).cast("bigint").alias(c)
        if kind == "double":
            return text_to_double(col(c)).alias(c)
        return (F.lower(col(c)) == "true").alias(c) if kind == "boolean" else col(c)

    return df.select(*[converted(c) for c in df.columns])


def require_content(df: DataFrame, name: str) -> DataFrame:
    """The frame itself, or an error when it has no rows or no columns."""
    if not df.columns or df.isEmpty():
        raise EmptyDatasetError(f"'{name}' holds no data (rows or columns).")
    return df


def column_names(header: list[str | None]) -> list[str]:
    """Names of a header row: blanks are numbered, repeats (also by case) get a number of their own."""
    names: list[str] = []
    taken: set[str] = set()
    for i, given in enumerate(header):
        base = given if given not in (None, "") else f"Unnamed: {i}"
        name, n = base, 0
        while name.lower() in taken:
            n += 1
            name = f"{base}.{n}"
        taken.add(name.lower())
        names.append(name)
    return names


# --------------------------------------------------------- records over splits
RECORD = "path string, block bigint, kind int, first boolean, record string"
WHOLE, TAIL, HEAD, MIDDLE = range(4)  # a record, its beginning in a split, its end, and a split inside it


def _joined(lines: list[str]) -> str:
    text = "\n".join(lines)
    return text[:-1] if text.endswith("\r") else text


def _split_records(starts: dict[tuple[str, int], bool]):
    """Task that turns lines ``(value, path, block)`` into records (``RECORD``); a line break inside quotes ends none.

    ``starts`` tells of each split whether it begins inside quotes.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_, kind, held, first = None, False, WHOLE, [], False

        def left() -> list[tuple]:
            """What a split leaves unfinished; at the end of a file it is the last record."""
            if not held:
                return []
            path, block = at
            last = (path, block) in ends
            return [(path, block, {WHOLE: TAIL, HEAD: MIDDLE}[kind] if not last else kind, first, _joined(held) if last else "\n".join(held))]

        ends = _last_blocks(starts)
        for batch in batches:
            quotes = pc.count_substring(batch.column(0), '"').to_pylist()
            out = []
            for value, path, block, n in zip(*(c.to_pylist() for c in batch.columns), quotes):
                if (path, block) != at:
                    out += left()
                    at = (path, block)
                    if at not in starts:
                        raise RuntimeError("The splits of the files changed while they were read; set spark.sql.files.minPartitionNum.")
                    open_ = starts[at]
                    kind, held, first = (HEAD if open_ else WHOLE), [], block == 0
                held.append(value)
                open_ ^= n % 2 == 1
                if not open_:
                    record = _joined(held)
                    if record.strip() or kind != WHOLE:
                        out.append((path, block, kind, first, record))
                        first = False
                    kind, held = WHOLE, []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), RECORD_TYPES)], names=RECORD_NAMES)
        out = left()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), RECORD_TYPES)], names=RECORD_NAMES)

    return read


RECORD_NAMES = [c.split()[0] for c in RECORD.split(", ")]
RECORD_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]


def _last_blocks(starts: dict[tuple[str, int], bool]) -> set[tuple[str, int]]:
    last: dict[str, int] = {}
    for path, block in starts:
        last[path] = max(block, last.get(path, 0))
    return set(last.items())


def records(spark: SparkSession, name: str) -> DataFrame:
    """``(path, first, record)``: the records of delimited UTF-8 files; ``first`` marks the first of each file.

    Files are read in splits, like any text.  A first pass counts the quotes
    of each split; from their running sum every split knows whether it begins
    inside quotes.  The second puts lines together to records, and what lies
    across splits, at most two pieces of each, is joined in order.
    """
    lines = spark.read.option("lineSep", "\n").text(name).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    counted = lines.groupBy("path", "block").agg(quotes.alias("n"), F.bool_and(F.is_valid_utf8("value")).alias("valid")).collect()  # one row per split
    if not all(r["valid"] for r in counted):
        raise FileValidationError(f"'{name}' could not be decoded; try encoding='latin-1'.")
    starts, inside = {}, False
    for i, r in enumerate(rows := sorted(counted, key=lambda r: (r["path"], r["block"]))):
        inside = inside if i and rows[i - 1]["path"] == r["path"] else False
        starts[r["path"], r["block"]] = inside
        inside ^= r["n"] % 2 == 1
    found = lines.mapInArrow(_split_records(starts), RECORD)
    if not any(starts.values()):
        return found.select("path", "first", "record")
    # pieces of one record follow each other; each begins with a tail
    pieces = found.where(F.col("kind") != WHOLE).withColumn("order", F.struct("block", F.col("kind") == TAIL))
    chain = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("path").orderBy("order"))  # at most two rows per split
    texts = F.array_sort(F.collect_list(F.struct("order", "record", "first")))
    whole = pieces.withColumn("chain", chain).groupBy("path", "chain").agg(texts.alias("t"))
    whole = whole.select("path", F.col("t")[0]["first"].alias("first"), F.array_join(F.transform("t", lambda p: p["record"]), "\n").alias("record"))
    return found.where(F.col("kind") == WHOLE).select("path", "first", "record").unionByName(whole)


def _parsed(spark: SparkSession, name: str, settings: dict) -> tuple[DataFrame, list[str]]:
    """``(record, names)``: the records below the header of each file, and the names in the order of the first file.

    ``record`` is brought to the order of these names.  Files whose headers
    have other names are refused.
    """
    every = records(spark, name)
    headers = every.where("first").select("path", "record").collect()  # one row per file
    orders: dict[tuple, list[str]] = {}
    for path, header in sorted(headers):
        fields = next(csv.reader(io.StringIO(header, newline=""), delimiter=settings["sep"], doublequote=True), [])
        orders.setdefault(tuple(column_names(fields)), []).append(path)
    if not orders:
        return every.select(F.struct("record").alias("cells")).limit(0), []
    names = list(next(iter(orders)))
    for other, paths in orders.items():
        if sorted(other) != sorted(names):
            raise FileValidationError(f"'{paths[0]}' has other columns than the rest of '{name}': {sorted(set(other) ^ set(names))}.")
    kept = {k: str(v) for k, v in settings.items() if k not in ("header", "inferSchema", "encoding")}
    body, frames = every.where(~F.col("first")), []
    for other, paths in orders.items():
        mine = body if len(orders) == 1 else body.join(F.broadcast(spark.createDataFrame([(p,) for p in paths], "path string")), "path")
        schema = ", ".join(f"c{i} string" for i in range(len(names))) + f", {OVERFLOW} string"
        cells = F.from_csv("record", schema, kept)
        frames.append(mine.select(cells.alias("c")).select(*[F.col(f"c.c{other.index(n)}").alias(f"c{i}") for i, n in enumerate(names)], f"c.{OVERFLOW}"))
    return reduce(DataFrame.unionByName, frames), names


# ------------------------------------------------------------- whole files read
def _whole_files(spark: SparkSession, name: str, settings: dict) -> tuple[DataFrame, list[str]]:
    """As :func:`_parsed`, by the reader of whole files, for other encodings and quotes; headers have to be the same."""
    plain = settings | {"inferSchema": False, "header": False}
    rows = spark.read.options(**plain).csv(name)
    paths = [r[0] for r in spark.read.format("binaryFile").load(name).select("path").sort("path").collect()]
    found = {}
    for path in paths:
        first = spark.read.options(**plain).csv(path).first()
        if first is not None:
            found.setdefault(tuple(column_names(list(first))), path)
    if not found:
        return rows.limit(0), []
    if len(found) > 1:
        raise FileValidationError(f"The files of '{name}' have different headers: {list(found.values())[:2]}.")
    names = list(next(iter(found)))
    wider = T.StructType([T.StructField(n, T.StringType()) for n in [*[f"c{i}" for i in range(len(names))], OVERFLOW]])
    return spark.read.options(**(plain | {"header": True, "enforceSchema": True})).schema(wider).csv(name), names


def _typed(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Column]:
    """The first columns of text cells as the declared types, and whether a row has a cell that does not fit."""
    casts = [F.col(f"c{i}").try_cast(f.dataType) if not isinstance(f.dataType, T.BooleanType) else F.lower(f"c{i}").try_cast("boolean") for i, f in enumerate(schema)]
    bad = [F.col(f"c{i}").isNotNull() & (F.trim(f"c{i}") != "") & x.isNull() for i, x in enumerate(casts)]
    return df.select(*[F.when(F.trim(f"c{i}") != "", x).alias(f.name) if not isinstance(f.dataType, T.StringType) else F.col(f"c{i}").alias(f.name) for i, (f, x) in enumerate(zip(schema, casts))]), reduce(lambda a, b: a | b, bad)


def load_dataset(spark: SparkSession, source: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Delimited file, folder or glob as a DataFrame.

    The suffix picks the separator (an explicit ``sep`` wins) and other reader
    options pass through, e.g. ``encoding``.  Without a ``schema`` cells are
    read as text, missing tokens become NULL and the types are inferred.

    Quoted fields may span lines; files are split over tasks all the same.
    Several files may have their columns in different orders.  Other encodings
    than UTF-8, and other quotes than doubled ones, keep a file in one task.
    """
    name = str(source)
    suffix = file_suffix(name)
    if suffix not in SEPARATORS:
        supported = ", ".join(sorted(SEPARATORS))
        raise UnsupportedFileFormatError(f"Unsupported format '{suffix}'; use one of: {supported}.")
    settings = {"header": True, "sep": SEPARATORS[suffix], "multiLine": True, "quote": '"', "escape": '"', "inferSchema": False}
    settings.update(options)
    if "encoding" in settings:
        settings["encoding"] = CHARSETS.get(codecs.lookup(settings["encoding"]).name, settings["encoding"])
    split = all(str(settings[k]) == '"' for k in ("quote", "escape")) and settings.get("encoding", "UTF-8") == "UTF-8" and len(settings["sep"]) == 1 and not set(settings) & WHOLE_FILE_OPTIONS
    try:
        if str(settings["header"]).lower() != "true":
            cells = spark.read.options(**settings).csv(name)
            names = cells.columns
            cells = cells.toDF(*[f"c{i}" for i in range(len(names))]).withColumn(OVERFLOW, F.lit(None).cast("string"))
        else:
            cells, names = (_parsed if split else _whole_files)(spark, name, settings)
        if not names:
            raise EmptyDatasetError(f"'{name}' holds no data (rows or columns).")
        if schema is not None:
            declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            if len(declared) > len(names):
                raise FileValidationError(f"'{name}' has {len(names)} columns, {len(declared)} are declared.")
            df, misfit = _typed(cells, declared)
            longer, bad = cells.agg(F.count(OVERFLOW), F.count_if(misfit)).first()
        else:
            texts = missing_to_null(cells.toDF(*names, OVERFLOW))
            types, damaged, longer = examine(texts, OVERFLOW)
            if damaged and "encoding" not in settings:
                raise FileValidationError(f"'{name}' could not be decoded; try encoding='latin-1'.")
            df, bad = cast_inferred(texts.drop(OVERFLOW), types), 0
        if longer:
            raise FileValidationError(f"'{name}' has {longer} rows with more fields than its header of {len(names)}.")
        if bad:
            raise FileValidationError(f"'{name}' has {bad} rows with cells that do not fit the declared types.")
        return require_content(df, name)
    except AnalysisException as error:
        raise FileValidationError(f"'{name}' does not exist or cannot be read: {error.getCondition()}") from error
    except PySparkException as error:
        raise FileValidationError(f"'{name}' cannot be read: {error.getCondition()}") from error
