"""Column expressions: line builders, pair/list expressions, and the UDF surface."""

from .lines import pair_line, tab_line  # noqa: F401
from .pairs import canonical_pair, is_reciprocal, shared_count  # noqa: F401
from .records import filter_records, flat_map_records, map_records, reduce_by_key  # noqa: F401
