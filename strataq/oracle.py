"""SQL that gives the same rows as each builder query, for engines that read the same Parquet tables."""

_SIZES = """(SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' || p_size WHEN 2 THEN CAST(p_size AS VARCHAR) ELSE 'none' END AS s FROM part) t"""
_NAMES = """(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '' WHEN 'P' THEN NULL ELSE o_orderpriority END AS n FROM orders) t"""
_MARKED = """(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN replace(o_orderpriority, '-', '_') WHEN 'P' THEN o_orderpriority || '%' ELSE o_orderpriority END AS x FROM orders) t"""

ORACLE = {
    "scan_all": 'SELECT * FROM nation',
    "project_columns": 'SELECT o_orderkey, o_totalprice FROM orders',
    "catalog_override": 'SELECT n_name FROM nation',
    "system_columns": 'SELECT n_name, n_nationkey AS id, n_regionkey AS "createdAt" FROM nation',
    "select_all_system": 'SELECT *, n_nationkey AS id FROM nation',
    "project_alias": 'SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer',
    "filter_eq": "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'",
    "filter_ne": "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'",
    "filter_gt_lt": 'SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_totalprice < 200000',
    "filter_date_range": "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1998-12-31 00:00:00'",
    "filter_col_to_col": 'SELECT p_partkey, p_size FROM part WHERE p_size > p_partkey',
    "filter_or_nested": "SELECT o_orderkey FROM orders WHERE (o_totalprice > 400000 AND o_orderstatus = 'F') OR o_orderpriority = '5-LOW'",
    "filter_not": "SELECT o_orderkey FROM orders WHERE NOT (o_totalprice > 100000 AND o_orderstatus = 'F')",
    "filter_not_unknown": "SELECT o_orderkey FROM (SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS p FROM orders) t WHERE NOT (p = '3-MEDIUM')",
    "filter_in": "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "filter_not_in": "SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'P')",
    "filter_in_empty": 'SELECT o_orderkey FROM orders WHERE 1 = 0',
    "filter_not_in_empty": "SELECT o_orderkey FROM (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS s FROM orders) t WHERE s IS NOT NULL",
    "filter_not_in_with_null": "SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', NULL)",
    "filter_between": 'SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000',
    "filter_like_prefix": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'",
    "filter_like_underscore": "SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '_-H%'",
    "filter_like_escape": f"SELECT o_orderkey, x FROM {_MARKED} WHERE x LIKE '1!_U%' ESCAPE '!' OR x LIKE '%!%' ESCAPE '!'",
    "filter_ilike": "SELECT c_custkey FROM customer WHERE c_mktsegment ILIKE '%build%'",
    "filter_is_empty": f"SELECT o_orderkey, n FROM {_NAMES} WHERE n IS NULL OR n = ''",
    "filter_is_not_empty": f"SELECT o_orderkey, n FROM {_NAMES} WHERE n IS NOT NULL AND n <> ''",
    "filter_true": 'SELECT p_partkey FROM part',
    "filter_boolean_text": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "filter_boolean_number": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'",
    "filter_numeric_text": f"SELECT p_partkey, s FROM {_SIZES} WHERE CASE WHEN s = 'none' THEN s > '9' ELSE TRY_CAST(s AS DOUBLE) > 9 END",
    "filter_numeric_text_in": f"SELECT p_partkey FROM {_SIZES} WHERE s = 'none' OR TRY_CAST(s AS DOUBLE) IN (7, 12)",
    "filter_number_against_text": 'SELECT p_partkey FROM part WHERE p_size < 9',
    "scan_budget": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "topk": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 40 ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 10",
    "limit_offset": 'SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal ASC NULLS LAST, c_custkey LIMIT 20 OFFSET 30',
    "sort_nulls_last_asc": "SELECT o_orderkey, p FROM (SELECT o_orderkey, NULLIF(o_orderpriority, '1-URGENT') AS p FROM orders) t ORDER BY p ASC NULLS LAST, o_orderkey",
    "sort_nulls_first_desc": "SELECT o_orderkey, p FROM (SELECT o_orderkey, NULLIF(o_orderpriority, '1-URGENT') AS p FROM orders) t ORDER BY p DESC NULLS FIRST, o_orderkey",
    "agg_count_star": "SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F'",
    "agg_count_col_vs_star": "SELECT COUNT(*) AS n_rows, COUNT(p) AS n_vals FROM (SELECT NULLIF(o_orderpriority, '5-LOW') AS p FROM orders) t",
    "agg_count_distinct": 'SELECT COUNT(DISTINCT o_custkey) AS n FROM orders',
    "agg_sum_avg_min_max": 'SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s, ROUND(AVG(o_totalprice), 4) AS a, MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders',
    "agg_sum_distinct": 'SELECT CAST(SUM(DISTINCT p_size) AS BIGINT) AS s, ROUND(AVG(DISTINCT p_size), 6) AS a FROM part',
    "agg_min_max_text": 'SELECT MIN(c_mktsegment) AS lo, MAX(c_mktsegment) AS hi FROM customer',
    "agg_empty": 'SELECT COUNT(*) AS n, SUM(o_totalprice) AS s, AVG(o_totalprice) AS a, MIN(o_totalprice) AS lo FROM orders WHERE o_totalprice < 0',
    "group_one": 'SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY o_orderstatus',
    "group_many": 'SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY l_returnflag, l_linestatus',
    "group_null_bucket": "SELECT p, COUNT(*) AS n FROM (SELECT NULLIF(o_orderpriority, '5-LOW') AS p FROM orders) t GROUP BY p",
    "group_keys_only": 'SELECT p_type FROM part GROUP BY p_type',
    "group_order_limit": 'SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY c_nationkey ORDER BY n DESC NULLS FIRST, c_nationkey LIMIT 5',
    "group_empty": 'SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_totalprice < 0 GROUP BY o_orderstatus',
    "join_inner": 'SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey',
    "join_left": 'SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id',
    "join_right": 'SELECT l.quality, d.doc_id FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id',
    "join_full": 'SELECT l.l_orderkey, l.l_linenumber, o.o_orderkey FROM lineitem l FULL JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_shipdate = o.o_orderdate',
    "join_dup_keys": 'SELECT n.n_name, s.s_suppkey FROM nation n JOIN supplier s ON n.n_nationkey = s.s_nationkey',
    "join_null_keys": 'SELECT a.c_custkey, b.s_suppkey FROM (SELECT c_custkey, NULLIF(c_nationkey, 3) AS k FROM customer) a LEFT JOIN (SELECT s_suppkey, NULLIF(s_nationkey, 3) AS k FROM supplier) b ON a.k = b.k',
    "join_composite": 'SELECT l.l_orderkey, o.o_orderdate FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_shipdate = o.o_orderdate',
    "join_chain": 'SELECT r.r_name, n.n_name, s.s_suppkey FROM region r JOIN nation n ON r.r_regionkey = n.n_regionkey JOIN supplier s ON n.n_nationkey = s.s_nationkey',
    "join_where_driving": "SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'F'",
    "join_where_spanning": "SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'F' AND c.c_mktsegment = 'BUILDING'",
    "join_left_anti_idiom": 'SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL',
    "join_right_where_is_null": 'SELECT d.doc_id FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id WHERE l.quality IS NULL',
    "join_order_limit": 'SELECT o.o_orderkey, c.c_name, o.o_totalprice FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey ORDER BY o.o_totalprice DESC NULLS FIRST, o.o_orderkey LIMIT 10',
    "join_select_all": 'SELECT r.r_regionkey AS "r.r_regionkey", r.r_name AS "r.r_name", n.n_nationkey AS "n.n_nationkey", n.n_name AS "n.n_name", n.n_regionkey AS "n.n_regionkey" FROM region r JOIN nation n ON r.r_regionkey = n.n_regionkey',
    "join_group": 'SELECT c.c_mktsegment, COUNT(*) AS n, MAX(o.o_totalprice) AS most FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment',
    "join_offset": 'SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey ORDER BY o.o_orderkey LIMIT 20 OFFSET 30',
    "group_offset": 'SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY c_nationkey ORDER BY n DESC NULLS FIRST, c_nationkey LIMIT 5 OFFSET 7',
    "union_distinct": 'SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier',
    "union_all": 'SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier',
    "intersect_distinct": 'SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 5000',
    "intersect_all": 'SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier',
    "except_distinct": 'SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000',
    "except_all": 'SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer',
    "setop_null_match": 'SELECT NULLIF(c_nationkey, 3) AS k FROM customer INTERSECT SELECT NULLIF(s_nationkey, 3) FROM supplier',
    "setop_left_fold": '(SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region) INTERSECT SELECT c_nationkey FROM customer WHERE c_nationkey < 10',
    "setop_order_limit": 'SELECT k FROM (SELECT o_custkey AS k FROM orders WHERE o_totalprice > 400000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0) u ORDER BY k DESC NULLS FIRST LIMIT 10',
    "setop_offset": 'SELECT k FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) u ORDER BY k LIMIT 6 OFFSET 9',
    "setop_then_where": 'SELECT k FROM (SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer) u WHERE k > 50 AND k <= 900',
    "setop_then_group": 'SELECT k, COUNT(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) u GROUP BY k',
    "setop_then_join": 'SELECT u.k, n.n_name FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) u JOIN nation n ON u.k = n.n_nationkey',
    "setop_limit_then_where": 'SELECT k FROM (SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer ORDER BY k LIMIT 40) u WHERE k > 20',
    "refusals": "SELECT request, TRUE AS refused FROM (VALUES ('aggregate of an expression'), ('aggregate without alias'), ('computed column'), ('cross join'), ('delete not allowed'), ('distinct'), ('having'), ('like without text'), ('limit that is no whole number'), ('median'), ('order by expression'), ('raw SQL'), ('set operation of other types'), ('subquery'), ('transaction'), ('two tables in FROM')) AS t(request)",
    "write_affected": "SELECT 'insert' AS write, CAST(2 AS BIGINT) AS affected UNION ALL SELECT 'update', COUNT(*) FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'delete', COUNT(*) FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'again', 0",
    "write_updated_rows": "SELECT c_custkey, 'OVERDRAWN' AS c_mktsegment FROM customer WHERE c_acctbal < 0",
    "write_delete": 'SELECT c_custkey, c_mktsegment AS status FROM customer WHERE NOT COALESCE(c_acctbal < 0, FALSE)',
    "write_insert": "SELECT r_regionkey, r_name FROM region UNION ALL SELECT 99, 'NOWHERE'",
    "write_update": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'OVERDRAWN' ELSE c_mktsegment END AS c_mktsegment FROM customer",
    "write_archive": 'SELECT c_custkey FROM customer WHERE NOT (COALESCE(c_acctbal < 0, FALSE))',
}
