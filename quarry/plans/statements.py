"""SQL statements ``execute_sql`` must run, one per query category.

Each key maps to the Spark SQL text; ``DUCKDB`` holds the text for the
DuckDB check where its dialect differs (JSON path, array unnest, maps).
The texts name the tables unqualified; ``execute_sql`` runs them with the
source database as the current database.
"""

from __future__ import annotations

# The statement texts (Spark dialect).
SPARK = {
    "sql_inner_join": "SELECT n.n_name, count(*) AS n_orders, sum(o.o_totalprice) AS revenue FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name",
    "sql_left_join": "SELECT c.c_custkey, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey",
    "sql_full_join": "SELECT d.doc_id AS d_id, l.doc_id AS l_id, l.quality FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id",
    "sql_semi_join": "SELECT d.doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)",
    "sql_anti_join": "SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "sql_theta_join": "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
    "sql_range_join": "SELECT p.p_partkey, count(*) AS n FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey AND l.l_extendedprice BETWEEN p.p_retailprice AND p.p_retailprice * 10 GROUP BY p.p_partkey",
    "sql_distinct": "SELECT count(DISTINCT o_custkey) AS n_cust, count(DISTINCT o_orderstatus) AS n_status FROM orders",
    "sql_having": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15",
    "sql_rollup": "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS q, CAST(grouping(l_returnflag) AS INT) AS g1, CAST(grouping(l_linestatus) AS INT) AS g2 FROM lineitem GROUP BY ROLLUP(l_returnflag, l_linestatus)",
    "sql_cube": "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY CUBE(c_mktsegment, c_nationkey)",
    "sql_grouping_sets": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
    "sql_rank": "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS rn, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS INT) AS dr FROM orders",
    "sql_frame": "SELECT event_id, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s3, lag(value, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events",
    "sql_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5",
    "sql_union": "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey AS k FROM supplier",
    "sql_intersect": "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey AS k FROM supplier",
    "sql_except": "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
    "sql_cte": "WITH t AS (SELECT o_custkey, sum(o_totalprice) AS s FROM orders GROUP BY o_custkey) SELECT o_custkey, s FROM t WHERE s > (SELECT avg(s) FROM t)",
    "sql_correlated": "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT avg(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)",
    "sql_predicate": "SELECT p_partkey FROM part WHERE p_type IN ('ECONOMY','STANDARD') AND p_name LIKE '%widget' AND p_size BETWEEN 10 AND 20",
    "sql_case_null": "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN 'hi' ELSE 'lo' END AS b, coalesce(nullif(l_returnflag, 'N'), '-') AS rf FROM lineitem",
    "sql_string": "SELECT c_custkey, upper(c_mktsegment) AS u, substring(c_name, 10, 9) AS s, concat(c_name, '-', c_mktsegment) AS c, CAST(length(c_name) AS INT) AS n FROM customer",
    "sql_date": "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(year(o_orderdate) AS INT) AS y, count(*) AS n FROM orders GROUP BY 1, 2",
    "sql_math": "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, abs(l_tax - l_discount) AS a, CAST(floor(l_quantity) AS BIGINT) AS f FROM lineitem",
    "sql_json": "SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k FROM events",
    "sql_array": "SELECT vec_id, CAST(e.pos AS INT) AS i, e.col AS x FROM embeddings LATERAL VIEW posexplode(embedding) e AS pos, col",
    "sql_map": "SELECT l_returnflag, map_from_entries(array(struct('n', count(*))))['n'] AS n FROM lineitem GROUP BY l_returnflag",
}

# DuckDB texts where the dialect differs.
DUCKDB = {
    "sql_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "sql_array": "SELECT vec_id, CAST(i - 1 AS INT) AS i, embedding[i] AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) t(i)",
    "sql_map": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
}


def duckdb_text(key: str) -> str:
    return DUCKDB.get(key, SPARK[key])
