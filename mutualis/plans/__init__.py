"""Query plans: the registry of every operator's query with its SQL oracle, and end-to-end jobs."""

from . import q_functions, q_io, q_jobs, q_records, q_relational  # noqa: F401  (register queries)
from .catalog import ORACLES, QUERIES  # noqa: F401
