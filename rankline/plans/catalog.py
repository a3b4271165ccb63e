"""All registered queries."""

from . import q_cells, q_clean, q_items, q_join, q_links, q_lookup, q_search, q_stats, q_text  # noqa: F401
from .registry import checks, queries  # noqa: F401
