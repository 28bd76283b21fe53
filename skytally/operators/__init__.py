"""General operators on DataFrames: grouped reports, ranks, shares, changes."""

from skytally.operators.grouped import grouped_report, wide_to_long
from skytally.operators.windows import change_over_periods, share_of_total, top_k_per_group

__all__ = ["change_over_periods", "grouped_report", "share_of_total", "top_k_per_group", "wide_to_long"]
