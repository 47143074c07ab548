"""SQL forms of the inputs (see ``sources.tables``), for the DuckDB oracles.

Each is a CTE body over the driver's views; the oracles combine them with ``WITH``.
"""

SUPPLIES = "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem"

# Clean edges: distinct, no self-listing.
EDGES = "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem WHERE l_partkey <> l_suppkey"

COSUPPLY_EDGES = """
SELECT DISTINCT src, dst FROM (
  SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem
  UNION ALL SELECT l_suppkey AS src, l_partkey AS dst FROM lineitem) u
WHERE src <> dst"""

# Reciprocated pairs over the CTE ``e``.
PAIRS = """
SELECT a.src AS id1, a.dst AS id2 FROM e a JOIN e b ON a.src = b.dst AND a.dst = b.src
WHERE a.src < a.dst"""

# Shared-neighbour counts over CTEs ``e`` and ``p`` (n > 0 only).
COUNTS = """
SELECT p.id1, p.id2, CAST(COUNT(*) AS BIGINT) AS n
FROM p JOIN e x ON x.src = p.id1 JOIN e y ON y.src = p.id2 AND y.dst = x.dst
GROUP BY p.id1, p.id2"""


def mutual(edges_sql: str = EDGES, before: str = "") -> str:
    """``WITH e, p, c`` prefix: edges, pairs, counts (after other CTEs, if given)."""
    return f"WITH {before}e AS ({edges_sql}), p AS ({PAIRS}), c AS ({COUNTS})"


PROFILES = """
SELECT p_partkey AS userid, p_name AS firstname, p_brand AS lastname, p_type AS address,
       CAST(p_size AS VARCHAR) AS city, '' AS state, printf('%.2f', p_retailprice) AS zipcode,
       upper(p_type) AS country, 'user' || CAST(p_partkey AS VARCHAR) AS username, '' AS dob
FROM part"""

BUSINESSES = """
SELECT CAST(p_partkey AS VARCHAR) AS businessid, p_name AS address, p_brand AS categories FROM part"""

_REVIEW_COLS = """
CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS reviewid,
CAST(l_suppkey AS VARCHAR) AS userid, CAST(l_partkey AS VARCHAR) AS businessid, l_quantity AS stars"""

REVIEWS = f"SELECT {_REVIEW_COLS} FROM lineitem"

REVIEWS_DUP = f"{REVIEWS} UNION ALL SELECT {_REVIEW_COLS} FROM lineitem WHERE l_returnflag = 'R'"

MIXED_EDGES = """
SELECT DISTINCT src, dst FROM (
  SELECT a AS src, b AS dst FROM m UNION ALL SELECT b AS src, a AS dst FROM m) u
WHERE src <> dst"""

# The links of ``mixed`` in one direction.
MIXED = """
SELECT l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS b
FROM lineitem QUALIFY b IS NOT NULL
UNION ALL SELECT l_partkey AS a, l_suppkey + 1000000000 AS b FROM lineitem"""

# A user's whole list: distinct ids ascending; a part with no lineitem has an empty one.
ADJACENCY = """
SELECT p_partkey AS userid,
       COALESCE(list_sort(list(DISTINCT l_suppkey) FILTER (WHERE l_suppkey IS NOT NULL)),
                CAST([] AS BIGINT[])) AS friend_list
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey
GROUP BY p_partkey"""
