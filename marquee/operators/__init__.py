"""Reusable DataFrame operators (pure compositions of built-in functions)."""

from marquee.operators.nest import nest_ordered, nest_topk  # noqa: F401
from marquee.operators.unnest import any_match, unnest, unnest_fields, unnest_with_pos  # noqa: F401
from marquee.operators.person_stats import career_stats, person_movie_rows  # noqa: F401
