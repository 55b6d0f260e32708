"""Delimited files: typed scans under a contract, many files, headerless files, blank first headers."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.errors import IngestError
from wattline.functions.names import quote
from wattline.functions.numeric import to_number
from wattline.operators.contracts import Contract
from wattline.storage import attach, materialize

# Separator of the meter files, and the name other tools give a blank header.
SEPARATOR = ";"
BLANK_NAME = "Unnamed: 0"
TIMESTAMP = "timestamp"
# Names that readers give a blank header.
_BLANK = ("", "_c0")


def _reader(spark: SparkSession, sep: str):
    return spark.read.option("sep", sep).option("quote", '"').option("mode", "PERMISSIVE")


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def read_header(spark: SparkSession, path: str | Sequence[str], sep: str = SEPARATOR) -> list[str]:
    """Column names; a blank first one gets the name contracts know it by. Reads one line."""
    try:
        names = _reader(spark, sep).option("header", True).csv(path).columns
    except AnalysisException as error:
        if _missing(error):
            raise IngestError(f"no file at {path!r}") from error
        raise
    return _known_names(names)


def _known_names(names: list[str]) -> list[str]:
    return [BLANK_NAME, *names[1:]] if names and names[0] in _BLANK else names


def _file_schema(schema: T.StructType) -> T.StructType:
    """The schema under the names the file itself has; the header is checked against them."""
    return T.StructType([T.StructField("" if f.name == BLANK_NAME else f.name, f.dataType) for f in schema.fields])


def _checked_scan(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, sep: str) -> DataFrame:
    """A file whose header differs fails the job; Spark would otherwise bind its columns by position."""
    reader = _reader(spark, sep).option("header", True).option("enforceSchema", False)
    return reader.schema(_file_schema(schema)).csv(paths)


def scan_delimited(
    spark: SparkSession, path: str | Sequence[str], contract: Contract | None = None, sep: str = SEPARATOR
) -> DataFrame:
    """Typed read: the header decides the columns, the contract their types, all else is text.

    One header line is probed; the data is read once, when a job runs. A column named
    ``timestamp`` is read as a timestamp.
    """
    names = read_header(spark, path, sep)
    expected = (contract or Contract({})).read_schema(names)
    typed = [T.StructField(f.name, T.TimestampNTZType()) if f.name == TIMESTAMP else f for f in expected.fields]
    return _checked_scan(spark, path, T.StructType(typed), sep).toDF(*names)


def parse_timestamp(cell: Column, data_type: T.DataType, strict: bool = True) -> Column:
    """TIMESTAMP without zone at microseconds; strict text parsing fails on a bad cell, else it gives NULL."""
    if isinstance(data_type, T.StringType):
        return F.to_timestamp_ntz(cell) if strict else cell.try_cast("timestamp_ntz")
    return cell.cast("timestamp_ntz")


def ingest_timestamp(df: DataFrame, strict: bool = True) -> DataFrame:
    """The first column, whatever its name, becomes ``timestamp``."""
    first = df.schema.fields[0]
    stamp = parse_timestamp(F.col(quote(first.name)), first.dataType, strict)
    return df.select(stamp.alias(TIMESTAMP), *[F.col(quote(c)) for c in df.columns[1:]])


def header_mapping(schema: T.StructType) -> dict[str, str]:
    """Column of a scan to its clean name: no quotes, and ``timestamp`` for a first column without a name of its own."""
    mapping = {f.name: f.name.strip('"') for f in schema.fields}
    lead = schema.fields[0].name
    if mapping[lead] in _BLANK or mapping[lead].lower().startswith("unnamed"):
        mapping[lead] = TIMESTAMP
    return mapping


def normalize_header(df: DataFrame, strict: bool = True) -> DataFrame:
    """One select: each column under its clean name, the ``timestamp`` parsed."""
    mapping = header_mapping(df.schema)
    if TIMESTAMP not in mapping.values():
        raise IngestError("no timestamp column in the header")
    columns = {
        old: parse_timestamp(F.col(quote(old)), df.schema[old].dataType, strict) if new == TIMESTAMP else F.col(quote(old))
        for old, new in mapping.items()
    }
    return df.select(*[columns[old].alias(new) for old, new in mapping.items()])


def field_count(line: Column, sep: str) -> Column:
    """Cells of a line: separators outside quotes, and one more."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return ((F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / F.lit(len(sep)) + 1).cast("int")


def first_lines(spark: SparkSession, paths: str | Sequence[str], sep: str = SEPARATOR) -> DataFrame:
    """``file, line, width``: the first line of every file that is not blank, as the delimited reader counts them, and the most cells of any of
    its lines, in one distributed job.

    A file of blank lines has none.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("place")
    )
    # a file's first line is the first row of its first block, and ids rise with the rows of a block
    first = F.min_by("value", F.when(F.col("at") == 0, F.col("place")))
    told = lines.where(F.col("value").rlike(r"[^\x00-\x20]")).groupBy("file").agg(first.alias("line"), F.max(field_count(F.col("value"), sep)).alias("width"))
    return told.where("line is not null")


def _present(spark: SparkSession, folder: str, endings: Sequence[str]) -> list[str]:
    """The patterns that match a file."""
    found = []
    for pattern in (f"{folder.rstrip('/')}/*.{ending}" for ending in endings):
        try:
            spark.read.text(pattern)
            found.append(pattern)
        except AnalysisException as error:
            if not _missing(error):
                raise
    return found


def scan_directory(spark: SparkSession, path: str, sep: str = SEPARATOR, source: str = "source_file") -> DataFrame | None:
    """All ``*.txt`` and ``*.csv`` of a directory as one table of text with its source file; None if there are none.

    Files may order their columns differently. One job reads every first line, and one scan all rows, whatever the number of headers: a
    row finds the places of its file's columns in a small table of files. Files are never listed on the driver; headers are, one per
    kind of file.
    """
    patterns = _present(spark, path, ("txt", "csv"))
    if not patterns:
        return None
    lines = materialize(first_lines(spark, patterns, sep), "headers")
    kinds = [r["line"] for r in lines.select("line").distinct().orderBy("line").collect()] or [""]
    headers = [_known_names(next(csv.reader([line], delimiter=sep), [""])) for line in kinds]
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(max(map(len, headers)))])
    scan = _reader(spark, sep).option("header", True).schema(schema).csv(patterns)
    # the hidden file columns have to be taken before the columns get new names
    if len(kinds) == 1:
        return scan.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(headers[0])], F.col("_metadata.file_name").alias(source))
    names = list(dict.fromkeys(n for header in headers for n in header))
    places = [(line, [header.index(n) if n in header else None for n in names]) for line, header in zip(kinds, headers, strict=True)]
    known = spark.createDataFrame(places, "line string, _places array<int>")
    of_file = lines.join(F.broadcast(known), "line").select(F.col("file").alias("_file"), "_places")
    cells = F.array(*[F.col(c) for c in schema.names]).alias("_cells")
    rows = scan.select(cells, F.col("_metadata.file_name").alias(source), F.col("_metadata.file_path").alias("_file"))
    met = attach(rows, materialize(of_file, "header-places"), ["_file"], ["_cells"])
    return met.select(*[F.get("_cells", F.get("_places", F.lit(j))).alias(n) for j, n in enumerate(names)], source)


def scan_headerless(
    spark: SparkSession, path: str | Sequence[str], sep: str = SEPARATOR, prefix: str = "client_"
) -> DataFrame:
    """Timestamp, then numbers named ``client_1`` and up; cells that do not convert are missing.

    There are as many columns as the widest line of any file has; shorter rows lack the last ones. A header line that is there all the
    same is left out: the first line of a file, if its first cell is no timestamp and no other cell is a number. All other rows stay,
    whatever their cells are.
    """
    try:
        lines = materialize(first_lines(spark, path, sep), "first-lines")
    except AnalysisException as error:
        if _missing(error):
            raise IngestError(f"no file at {path!r}") from error
        raise
    width = lines.agg(F.max("width")).first()[0] or 1
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    # the reader passes over each file's first line; those come from their own job and are judged one by one
    rest = _reader(spark, sep).option("header", True).schema(cells).csv(path)
    parsed = F.from_csv("line", F.lit(cells.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), {"sep": sep, "quote": '"'})
    first = lines.select(parsed.alias("row")).select("row.*")
    stamp = F.col("c0").try_cast("timestamp_ntz")
    numbers = [to_number(F.col(f"c{i}"), T.StringType()) for i in range(1, width)]
    is_header = stamp.isNull() & F.coalesce(*numbers, F.lit(None).cast("double")).isNull()
    rows = rest.unionByName(first.where(~is_header))
    return rows.select(stamp.alias(TIMESTAMP), *[n.alias(f"{prefix}{i}") for i, n in enumerate(numbers, 1)])


def write_delimited(df: DataFrame, path: str, sep: str = SEPARATOR) -> str:
    """Delimited files with header."""
    df.write.mode("errorifexists").option("header", True).option("sep", sep).csv(path)
    return path
