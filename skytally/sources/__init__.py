"""Where flights come from."""

from skytally.sources.binding import bind_flights
from skytally.sources.csv_folder import load_flight_lines, load_flights, parse_lines, read_header
from skytally.sources.landed import read_landed
from skytally.sources.schema import FLIGHT_COLUMNS, FLIGHT_SCHEMA

__all__ = [
    "FLIGHT_COLUMNS",
    "FLIGHT_SCHEMA",
    "bind_flights",
    "load_flight_lines",
    "load_flights",
    "parse_lines",
    "read_header",
    "read_landed",
]
