"""Oracle-side (DuckDB) text of the stand-in fixtures, used as CTEs.

These mirror ``fixtures.py`` and exist only so that ``oracle_sql()`` can
state every query independently of Spark.
"""

from tabulon.plans.fixtures import REGIONS, region_rows

F_TRIPS = """
SELECT event_id, user_id AS license, event_type, ts AS pickup,
       ts + to_microseconds(CAST(FLOOR(value * 60000000) AS BIGINT)) AS dropoff,
       CASE WHEN event_id % 97 = 0 THEN 0.0::DOUBLE ELSE (event_id % 100) / 10.0::DOUBLE + 0.05::DOUBLE END AS lon,
       CASE WHEN event_id % 97 = 0 THEN 0.0::DOUBLE ELSE (FLOOR(event_id / 100) % 100) / 10.0::DOUBLE + 0.05::DOUBLE END AS lat
FROM events"""

F_RATINGS = """
SELECT o_custkey AS user_id, l_partkey AS item_id, SUM(l_quantity) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey"""

F_ITEMS = "SELECT p_partkey AS item_id, p_name AS name FROM part"

F_ALIAS = """
SELECT p_partkey AS alias_id, item_id FROM
 (SELECT p_partkey, MIN(p_partkey) OVER (PARTITION BY p_name, p_brand) AS item_id FROM part) z
WHERE p_partkey <> item_id"""

F_LABELED = "SELECT vec_id, CAST(label AS DOUBLE) AS label, embedding FROM embeddings"

F_MIXED = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, p_brand, p_type AS label
FROM lineitem JOIN part ON l_partkey = p_partkey"""

F_ARTICLES = """
SELECT doc_id,
       CASE WHEN doc_id % 13 = 0 THEN CONCAT('Doc ', CAST(doc_id AS VARCHAR), ' (disambiguation)')
            ELSE CONCAT('Doc ', CAST(doc_id AS VARCHAR)) END AS title,
       CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS ns,
       CASE WHEN doc_id % 11 = 0 THEN CONCAT('#REDIRECT ', text) ELSE text END AS text
FROM documents"""

F_TOPICS_SUPP = "SELECT DISTINCT l_orderkey AS doc_id, CAST(l_suppkey AS VARCHAR) AS topic FROM lineitem"
F_TOPICS_PART = "SELECT DISTINCT l_orderkey AS doc_id, CAST(l_partkey AS VARCHAR) AS topic FROM lineitem"

F_PRICES = """
SELECT c_mktsegment AS series, CAST(o_orderdate AS DATE) AS dt, ROUND(AVG(o_totalprice), 6) AS value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, CAST(o_orderdate AS DATE)"""

F_FACTORS = """
SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS dt, ROUND(AVG(o_totalprice), 6) AS value
FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)"""


def region_edges_sql() -> str:
    """(code, name, area, x1, y1, x2, y2) rows of the F-regions edge table."""
    rows = []
    for code, name, area, *_bbox, edges in region_rows():
        for e in edges:
            rows.append(f"({code}, '{name}', {area!r}, {e['x1']!r}, {e['y1']!r}, {e['x2']!r}, {e['y2']!r})")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) +
            ") AS r(code, name, area, x1, y1, x2, y2)")


def kept(sql: str) -> str:
    """A CTE that is computed once, however often it is read."""
    return "MATERIALIZED " + sql


def with_ctes(body: str, **ctes: str) -> str:
    parts = ",\n".join(f"{k} AS MATERIALIZED ({v.removeprefix('MATERIALIZED ')})" if v.startswith("MATERIALIZED ") else f"{k} AS ({v})"
                       for k, v in ctes.items())
    return f"WITH {parts}\n{body}"


assert REGIONS  # keep the import explicit: the oracle reads the same polygon list
