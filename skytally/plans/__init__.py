"""The reports, as DataFrames and as SQL text."""
