"""The declared schema of a flight table."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns the reports use. Tables may have others; they are never read.
FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("FL_DATE", T.DateType()),
        T.StructField("OP_CARRIER", T.StringType()),
        T.StructField("ORIGIN", T.StringType()),
        T.StructField("DEST", T.StringType()),
        T.StructField("DEP_DELAY", T.DoubleType()),
        T.StructField("ARR_DELAY", T.DoubleType()),
        T.StructField("CANCELLED", T.DoubleType()),
        T.StructField("CANCELLATION_CODE", T.StringType()),
        T.StructField("CARRIER_DELAY", T.DoubleType()),
        T.StructField("WEATHER_DELAY", T.DoubleType()),
        T.StructField("NAS_DELAY", T.DoubleType()),
        T.StructField("SECURITY_DELAY", T.DoubleType()),
        T.StructField("LATE_AIRCRAFT_DELAY", T.DoubleType()),
    ]
)

FLIGHT_COLUMNS = tuple(FLIGHT_SCHEMA.names)

# The column by whose name a header line is told from data.
DATE_COLUMN = "FL_DATE"

BAD_LINE = "_bad"


def schema_for_header(header: list[str], *, keep_bad: bool = False) -> T.StructType:
    """The schema of a file with this header: known columns typed, unknown ones text, in file order.

    Delimited files bind a schema by position, so every column of the file needs its place in it.
    """
    names = [h.strip() for h in header]
    missing = [c for c in FLIGHT_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"the header lacks {', '.join(missing)}")
    fields = [FLIGHT_SCHEMA[n] if n in FLIGHT_COLUMNS else T.StructField(n, T.StringType()) for n in names]
    if keep_bad:
        fields.append(T.StructField(BAD_LINE, T.StringType()))
    return T.StructType(fields)
