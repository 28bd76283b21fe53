"""Flights from a folder of headed CSV files, for example one file per year.

Bad input never stops a run and never changes a type: a value that does not parse becomes null, and the rest of its
line stays. What stops a run is a file whose header has its columns in another order. ``NaN`` and infinite numbers are no delays and become null too. Blanks around values are dropped, quoted commas
are kept. All files of a folder are read, whatever their names; folders inside it are not, so results may be written there.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.sources.schema import BAD_LINE, DATE_COLUMN, FLIGHT_COLUMNS, FLIGHT_SCHEMA, schema_for_header

_PARSE_OPTIONS = {
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}

# What the CSV parser takes for blank around a value: control characters, too.
_BLANKS = "".join(map(chr, range(33)))


def _chosen_by(pattern: str | None) -> dict[str, str]:
    return {} if pattern is None else {"pathGlobFilter": pattern}


def _tell_what_is_left_out(spark: SparkSession, path: str | list[str], pattern: str | None) -> None:
    """Warn when a pattern leaves files out, so that none is lost in silence."""
    if pattern is not None:
        every = set(spark.read.text(path).inputFiles())
        left_out = sorted(every.difference(spark.read.options(**_chosen_by(pattern)).text(path).inputFiles()))
        if left_out:
            warnings.warn(f"{pattern} leaves out {len(left_out)} files, the first is {left_out[0]}", stacklevel=3)


def _finite(column: str):
    """The column without NaN, which is greater than any number, and without infinities."""
    return F.when(F.abs(F.col(column)) < float("inf"), F.col(column)).alias(column)


def _cleaned(flights: DataFrame) -> list:
    doubles = {f.name for f in FLIGHT_SCHEMA if isinstance(f.dataType, T.DoubleType)}
    return [_finite(c) if c in doubles else F.col(f"`{c}`") for c in flights.columns]


def read_header(spark: SparkSession, path: str, *, pattern: str | None = None) -> list[str]:
    """Column names from the first line of one file; nothing else is read."""
    reader = spark.read.options(header=True, ignoreLeadingWhiteSpace=True, **_chosen_by(pattern))
    return reader.csv(path).columns


def load_flights(
    spark: SparkSession,
    path: str | list[str],
    *,
    pattern: str | None = None,
    header: list[str] | None = None,
    keep_bad: bool = False,
) -> DataFrame:
    """Flights of all files, with the declared columns only. ``pattern`` reads the files whose names match it, and warns
    of those that it leaves out.

    Types are declared, so nothing is scanned to infer them and one bad value cannot turn a column into text. All files
    need the columns in the same order; a file that differs is an error, not silently swapped values.

    ``header`` gives the column names of the files; without it they are taken from one file, for which the folder is
    listed once more. ``keep_bad`` adds the column ``_bad`` with the whole line where a value did not parse. It is
    filled in when that value is read, so land such a frame (``sinks.land_flights``) before counting bad lines.
    """
    _tell_what_is_left_out(spark, path, pattern)
    if header is None:
        header = read_header(spark, path if isinstance(path, str) else path[0], pattern=pattern)
    reader = (
        spark.read.schema(schema_for_header(header, keep_bad=keep_bad))
        .options(**_PARSE_OPTIONS)
        .options(header=True, enforceSchema=False, **_chosen_by(pattern))
    )
    if keep_bad:
        reader = reader.option("columnNameOfCorruptRecord", BAD_LINE)
    flights = reader.csv(path).select(*FLIGHT_COLUMNS, *([BAD_LINE] if keep_bad else []))
    return flights.select(*_cleaned(flights))


def parse_lines(
    lines: DataFrame,
    header: list[str],
    *,
    column: str = "value",
    columns: Sequence[str] = FLIGHT_COLUMNS,
    keep_bad: bool = False,
) -> DataFrame:
    """Flights from raw lines already held as text, with the given ``columns``; the others stay unconverted.

    Header lines are dropped wherever they stand, as they do in the middle of concatenated files, and so are empty lines. A
    line is a header if a whole field of it is the name of the date column. One that has the flight columns in other places
    than ``header`` is an error: its file would be read with swapped columns.

    A line without a quote is cut at its commas, up to the last column that is wanted, and only the wanted fields are
    converted. Lines with a quote, which may hold commas inside of a value, are cut by Spark's CSV parser. ``keep_bad`` adds
    ``_bad``, the whole line where one of the wanted values does not parse.
    """
    schema = schema_for_header(header)
    places = {h.strip(): i for i, h in enumerate(header)}
    line = F.col(column)
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    last = max([places[c] for c in columns], default=0)
    # Both columns are named more than once below, so Spark computes them once per line.
    cut = lines.filter(_holds_flight(line, [h.strip() for h in header])).select(
        line.alias("line"),
        F.split(line, ",", last + 2).alias("fields"),
        F.when(F.contains(line, F.lit('"')), F.from_csv(line, texts.toDDL(), _PARSE_OPTIONS)).alias("quoted"),
    )
    wanted, unparsed = [], F.lit(False)
    for c in columns:
        text = F.when(F.col("quoted").isNull(), F.get("fields", F.lit(places[c]))).otherwise(F.col(f"quoted.c{places[c]}"))
        kind = schema[c].dataType
        if isinstance(kind, T.StringType):
            bare = F.btrim(text, F.lit(_BLANKS))
            wanted.append(F.when(bare != "", bare).alias(c))
        else:
            # Conversions drop blanks themselves, and nothing but blanks is null to them.
            wanted.append(text.try_cast(kind).alias(c))
            unparsed = unparsed | (text.try_cast(kind).isNull() & (F.btrim(text, F.lit(_BLANKS)) != ""))
    if keep_bad:
        wanted.append(F.when(unparsed, F.col("line")).alias(BAD_LINE))
    flights = cut.select(*wanted)
    return flights.select(*_cleaned(flights))


def _holds_flight(line: Column, names: list[str]) -> Column:
    """Whether a line is neither empty nor a header. A header with its columns in other places than ``names`` is an error."""
    places = F.array(*[F.lit(names.index(c)) for c in FLIGHT_COLUMNS])
    misplaced = F.raise_error(F.concat(F.lit("a header has its columns in another order: "), line)).cast("boolean")

    def is_data(fields: Column) -> Column:
        in_place = F.array_join(F.transform(places, lambda i: F.coalesce(F.get(fields, i), F.lit(""))), ",") == ",".join(FLIGHT_COLUMNS)
        return F.when(~F.array_contains(fields, DATE_COLUMN), F.lit(True)).when(in_place, F.lit(False)).otherwise(misplaced)

    fields = F.transform(F.split(F.replace(line, F.lit('"'), F.lit("")), ","), lambda x: F.btrim(x, F.lit(_BLANKS)))
    # Nearly all lines end the test at its first branch, without being split. The rest is one small expression: where it is
    # spelled out column by column, the code generated for the filter is too large to be compiled.
    header_test = F.get(F.transform(F.array(fields), is_data), F.lit(0))
    return F.when(~F.contains(line, F.lit(DATE_COLUMN)), F.trim(line) != "").otherwise(header_test)


def load_flight_lines(spark: SparkSession, path: str, *, pattern: str | None = None, keep_bad: bool = False) -> DataFrame:
    """Flights of all files by way of raw text, for files with header lines in the middle."""
    _tell_what_is_left_out(spark, path, pattern)
    header = read_header(spark, path, pattern=pattern)
    return parse_lines(spark.read.options(**_chosen_by(pattern)).text(path), header, keep_bad=keep_bad)
