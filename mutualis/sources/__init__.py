"""Sources: header-less text-line formats (``text``), their schemas, and table-backed inputs."""

from . import schemas, tables, text  # noqa: F401
from .text import (  # noqa: F401
    id_list, inline_rows, named, parse_adjacency, parse_businesses, parse_profiles,
    parse_records, parse_reviews, read_lines, split_fields,
)
