"""Query registry: each entry is a Spark query ``(spark, sf_dir) -> DataFrame`` and, where the
result is expressible in SQL, the DuckDB oracle over the driver's tables.

Also holds what several queries read: the text forms of the inputs and the prepared graphs. Each is
written once per application and table directory into the shared checkpoint folder, kept until
``release`` (or ``Graph.release``), and made anew when it is asked for after that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import Graph, edges_from_adjacency, prepare_graph
from ..session import Scratch, app_id, is_live, scratch_path
from ..sinks import write_lines
from ..sources import tables, text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query (and its oracle SQL, if any) under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


_TEXT_FORMS = {
    "profiles": tables.profile_lines,
    "adjacency": tables.adjacency_lines,
    # Every list cut into lines of 8 ids, far below the largest id.
    "adjacency_narrow": lambda spark, sf_dir: tables.adjacency_lines(spark, sf_dir, 8),
    "businesses": tables.business_lines,
    "reviews": tables.review_lines,
}
_GRAPHS = {
    "supplies": tables.supplies,
    "cosupply": tables.cosupply,
    "mixed": tables.mixed,
    "text": lambda spark, sf_dir: edges_from_adjacency(adjacency(spark, sf_dir)),
}
_KEPT = Scratch()  # folders of the text forms
_WRITTEN: dict[tuple[str, str, str], str] = {}
_PREPARED: dict[tuple[str, str, str], Graph] = {}


def text_form(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Path of the text form ``name`` of the inputs at ``sf_dir`` (written on first use)."""
    key = (app_id(spark), sf_dir, name)
    if not is_live(_WRITTEN.get(key, "")):
        path = scratch_path(spark, f"{name}.txt", _KEPT)
        write_lines(_TEXT_FORMS[name](spark, sf_dir), path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def graph(spark: SparkSession, sf_dir: str, name: str) -> Graph:
    """The prepared graph ``name`` over the inputs at ``sf_dir`` (prepared on first use)."""
    key = (app_id(spark), sf_dir, name)
    if key not in _PREPARED or not _PREPARED[key].scratch.folders:
        _PREPARED[key] = prepare_graph(_GRAPHS[name](spark, sf_dir))
    return _PREPARED[key]


def release_graphs(spark: SparkSession) -> int:
    """Delete the prepared graphs; returns how many folders were deleted."""
    done = sum(g.release(spark) for g in _PREPARED.values())
    _PREPARED.clear()
    return done


def release(spark: SparkSession) -> int:
    """Delete the text forms and the prepared graphs; returns how many folders were deleted."""
    _WRITTEN.clear()
    return _KEPT.release(spark) + release_graphs(spark)


def lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return text.read_lines(spark, text_form(spark, sf_dir, name))


def adjacency(spark: SparkSession, sf_dir: str, form: str = "adjacency") -> DataFrame:
    """Parsed adjacency lines of ``supplies``: ``(userid, friend_list)``, one row per line (a user
    can have several)."""
    return text.parse_adjacency(lines(spark, sf_dir, form))


def ids_text(arr: Column | str, sep: str = ",") -> Column:
    """An id array as text (for comparing list results across engines)."""
    c = F.col(arr) if isinstance(arr, str) else arr
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)
