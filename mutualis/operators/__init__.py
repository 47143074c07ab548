"""Operators with more than one step: graph edges and shared-neighbour counts, top-k, profile
lookup for ranked pairs, and the rating jobs. Single-step operators are plain DataFrame calls."""

from .edges import (  # noqa: F401
    clean_edges, edges_from_adjacency, out_degrees, reciprocal_pairs, reciprocal_pairs_by_self_join,
)
from .lists import list_blocks, whole_lists  # noqa: F401
from .mutual import DEFAULT_HUB_DEGREE, Graph, mutual_counts, prepare_graph  # noqa: F401
from .profiles import attach_profiles, pair_members, top_pairs, top_pairs_with_profiles  # noqa: F401
from .ratings import address_match, mean_ratings, of_top_keys, ratings_for, top_rated  # noqa: F401
from .topk import sort_desc, top_k  # noqa: F401
