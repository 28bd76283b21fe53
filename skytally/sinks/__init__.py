"""Where flights and reports are written."""

from skytally.sinks.parquet import PUBLISHED, land_flights, publish_reports

__all__ = ["PUBLISHED", "land_flights", "publish_reports"]
