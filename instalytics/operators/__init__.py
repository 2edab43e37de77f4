"""Reusable DataFrame operators: top-1 per key, as-of / anti / presence / star
joins, exact global percent rank, day-offset pivot, aligned unions."""

from .dedup import latest_per_key, number_in_group, previous_value
from .joins import anti_join, asof_latest, assert_unique, left_join_residual, presence_flag, star_join, star_union
from .rank import percent_rank_global
from .reshape import pivot_day_offsets, union_aligned

__all__ = [
    "latest_per_key", "number_in_group", "previous_value", "anti_join", "asof_latest", "assert_unique",
    "left_join_residual", "presence_flag", "star_join", "star_union", "percent_rank_global", "pivot_day_offsets",
    "union_aligned",
]
