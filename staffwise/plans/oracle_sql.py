"""ANSI SQL twins (DuckDB dialect) of the driver queries, over the
pre-registered views ``region nation customer supplier part orders lineitem
events documents embeddings pages benchmark labels conversations``.
Queries without a twin (sampling, model fitting) are checked on row counts."""

from __future__ import annotations

_ORDERS = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders)"

_TREE = """(SELECT c_custkey,
    CASE WHEN c_custkey = 0 THEN NULL
         WHEN c_nationkey = 7 AND c_mktsegment = 'BUILDING' THEN c_custkey + 1000000
         WHEN c_custkey = 100 THEN CAST(101 AS BIGINT)
         WHEN c_custkey = 101 THEN CAST(100 AS BIGINT)
         ELSE CAST(floor(c_custkey / 3) AS BIGINT) END AS mgr
  FROM customer)"""

_DQ = """(SELECT o_orderkey, o_orderstatus,
    NULLIF(o_orderpriority, '5-LOW') AS prio,
    CASE WHEN o_totalprice < 50000 THEN '' ELSE 'ok' END AS note,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS odate
  FROM orders)"""

_DQ_ERR = f"""(SELECT *, NULLIF(
      COALESCE(CASE WHEN (prio IS NULL OR trim(prio) = '') OR (note IS NULL OR trim(note) = '') THEN 'Cat A error; ' END, '')
   || COALESCE(CASE WHEN o_orderstatus = 'F' AND ((note IS NULL OR trim(note) = '') OR odate IS NULL) THEN 'Cat B error; ' END, '')
   || COALESCE(CASE WHEN o_orderstatus = 'O' AND (prio IS NULL OR trim(prio) = '') THEN 'Cat C error; ' END, ''),
   '') AS error FROM {_DQ})"""


def _norm(expr: str) -> str:
    e = f"lower(trim({expr}))"
    e = f"regexp_replace({e}, '[ \\-\\n]', '_', 'g')"
    e = f"regexp_replace({e}, '[''():.]', '', 'g')"
    e = f"regexp_replace({e}, '[^a-z0-9_]', '_', 'g')"
    return f"regexp_replace({e}, '_+', '_', 'g')"


_ATTRITION = f"""WITH o AS {_ORDERS},
per AS (SELECT o_custkey, count(*) AS n_orders, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100 AS total_spend,
               round(sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*)) / 100 AS avg_price, CAST(sum(CAST(o_orderpriority = '1-URGENT' AS INTEGER)) AS BIGINT) AS n_urgent,
               max(o_orderdate) AS last_order FROM o GROUP BY 1)
SELECT c.c_custkey, n_orders, total_spend, avg_price, n_urgent,
  CAST(COALESCE(c.c_nationkey IN (1, 2), false) AS INTEGER) AS local,
  CAST(c.c_mktsegment = 'BUILDING' AS INTEGER) AS seg_building,
  round(c.c_acctbal, 2) AS acctbal, c.c_mktsegment AS segment, CAST(c.c_nationkey AS VARCHAR) AS nation,
  CAST(datediff('day', last_order, (SELECT max(o_orderdate) FROM o)) <= 365 AS INTEGER) AS active
FROM per JOIN customer c ON per.o_custkey = c.c_custkey
WHERE c.c_nationkey IS NOT NULL AND c.c_mktsegment IS NOT NULL AND c.c_acctbal IS NOT NULL
  AND total_spend IS NOT NULL AND avg_price IS NOT NULL AND n_urgent IS NOT NULL AND last_order IS NOT NULL"""

ORACLE_SQL: dict[str, str] = {
    "snapshot_consolidation": f"""
WITH o AS {_ORDERS},
snap AS (
  SELECT o.* FROM o JOIN (SELECT date_trunc('month', o_orderdate) AS m, max(o_orderdate) AS d FROM o GROUP BY 1) x
    ON date_trunc('month', o.o_orderdate) = x.m AND o.o_orderdate = x.d),
listing AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, upper(trim(o_orderpriority)) AS o_orderpriority, 'closed' AS src FROM snap WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, upper(trim(o_orderpriority)), 'open' FROM snap WHERE o_orderstatus <> 'F'),
firsts AS (SELECT o_custkey, min(o_orderdate) AS first_date FROM o GROUP BY 1),
x AS (
  SELECT l.*, last_day(l.o_orderdate) AS eom, r.r_name, f.first_date
  FROM listing l
  LEFT JOIN customer c ON l.o_custkey IS NOT DISTINCT FROM c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey IS NOT DISTINCT FROM n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey IS NOT DISTINCT FROM r.r_regionkey
  LEFT JOIN firsts f ON l.o_custkey = f.o_custkey),
y AS (
  SELECT *, round_even(datediff('day', first_date, eom) / 365.25, 2) AS tenure,
         row_number() OVER (PARTITION BY o_custkey ORDER BY eom, o_orderkey) = 1 AS joiner_mark
  FROM x)
SELECT eom, r_name, src, count(DISTINCT o_custkey) AS headcount,
       CAST(sum(CAST(joiner_mark AS INTEGER)) AS BIGINT) AS joiners, round(avg(tenure), 4) AS avg_tenure
FROM y GROUP BY eom, r_name, src""",
    "month_end_snapshot": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM o
QUALIFY rank() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC) = 1""",
    "headcount_by_month": f"""
WITH o AS {_ORDERS}
SELECT last_day(o_orderdate) AS eom, o_orderstatus, count(DISTINCT o_custkey) AS headcount
FROM o WHERE last_day(o_orderdate) IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2""",
    "current_snapshot": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey, o_custkey, o_orderdate FROM o WHERE o_orderdate = (SELECT max(o_orderdate) FROM o)""",
    "first_snapshot_rows": f"""
WITH o AS {_ORDERS}
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM o
JOIN (SELECT o_custkey, min(o_orderdate) AS d FROM o GROUP BY 1) f ON o.o_custkey = f.o_custkey AND o.o_orderdate = f.d""",
    "latest_two_slices": f"""
WITH o AS {_ORDERS}
SELECT o_custkey, o_orderstatus FROM o WHERE o_orderdate = (SELECT max(o_orderdate) FROM o)
UNION
SELECT o_custkey, o_orderstatus FROM o
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM o) - INTERVAL 90 DAY AND o_orderstatus = 'F'""",
    "distinct_all_columns": """
SELECT o_orderpriority, count(DISTINCT o_orderkey) AS n_o_orderkey, count(DISTINCT o_custkey) AS n_o_custkey,
       count(DISTINCT o_orderstatus) AS n_o_orderstatus, count(DISTINCT o_totalprice) AS n_o_totalprice,
       count(DISTINCT o_orderdate) AS n_o_orderdate
FROM orders GROUP BY o_orderpriority""",
    "value_counts_desc": """
SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand""",
    "five_number_summary": """
SELECT l_returnflag, count(l_extendedprice) AS n, round(min(l_extendedprice), 4) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, round(max(l_extendedprice), 4) AS max
FROM lineitem GROUP BY l_returnflag""",
    "null_profile": """
WITH c AS (
  SELECT c_custkey, NULLIF(c_name, '') AS c_name, CASE WHEN c_nationkey <> 0 THEN c_nationkey END AS c_nationkey,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, NULLIF(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment
  FROM customer),
p AS (
  SELECT 'c_custkey' AS "column", 'bigint' AS dtype, count(c_custkey) AS non_null, count(*) AS n FROM c
  UNION ALL SELECT 'c_name', 'string', count(c_name), count(*) FROM c
  UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey), count(*) FROM c
  UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal), count(*) FROM c
  UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment), count(*) FROM c)
SELECT "column", dtype, non_null, n - non_null AS nulls, n > non_null AS any_null FROM p""",
    "scalar_aggs": f"""
WITH o AS {_ORDERS}
SELECT count(DISTINCT o_custkey) AS n_customers, round(sum(o_totalprice), 2) AS total,
       round(avg(o_totalprice), 4) AS mean_total, CAST(sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS BIGINT) AS n_closed,
       max(o_orderdate) AS last_date, min(o_orderdate) AS first_date
FROM o WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
    "grouped_aggs": """
WITH li AS (SELECT *, CASE WHEN l_linenumber <> 2 THEN CAST(l_shipdate AS DATE) END AS ship FROM lineitem)
SELECT l_returnflag, count(ship) AS n_shipped, round(sum(l_quantity), 2) AS sum_qty, min(ship) AS first_ship,
       count(DISTINCT l_suppkey) AS n_suppliers
FROM li GROUP BY l_returnflag""",
    "distinct_pairs": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "top_n_sorted": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10""",
    "canonical_id": """
WITH p AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % 5 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0')
         WHEN p_partkey % 5 = 1 THEN CAST(p_partkey AS VARCHAR) || '.0'
         WHEN p_partkey % 5 = 2 THEN CAST(p_partkey AS VARCHAR) || '.5'
         WHEN p_partkey % 5 = 3 THEN ' ' || CAST(p_partkey AS VARCHAR) || ' '
         WHEN p_partkey % 25 = 4 THEN CAST(9007199254740993 + p_partkey AS VARCHAR) || '.0'
         ELSE p_name END AS raw
  FROM part)
SELECT p_partkey, raw,
  CASE WHEN p_partkey % 25 = 4 THEN CAST(9007199254740993 + p_partkey AS VARCHAR) ELSE
    COALESCE(CAST(TRY_CAST(round_even(TRY_CAST(trim(raw) AS DOUBLE), 0) AS DECIMAL(38,0)) AS VARCHAR), raw) END AS canonical
FROM p""",
    "fiscal_label": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey,
  CASE WHEN month(o_orderdate) < 4
       THEN CAST(year(o_orderdate) % 100 - 1 AS VARCHAR) || CAST(year(o_orderdate) % 100 AS VARCHAR)
       ELSE CAST(year(o_orderdate) % 100 AS VARCHAR) || CAST(year(o_orderdate) % 100 + 1 AS VARCHAR) END AS fy
FROM o""",
    "fiscal_label_padded": f"""
WITH o AS {_ORDERS},
y AS (SELECT o_orderkey, CASE WHEN month(o_orderdate) < 4 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS ly FROM o)
SELECT o_orderkey, lpad(CAST(ly % 100 AS VARCHAR), 2, '0') || lpad(CAST((ly + 1) % 100 AS VARCHAR), 2, '0') AS fy FROM y""",
    "calendar_from_fiscal": f"""
WITH o AS {_ORDERS},
y AS (SELECT o_orderkey, month(o_orderdate) AS m,
        CASE WHEN month(o_orderdate) < 4 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS ly FROM o),
f AS (SELECT o_orderkey, m, lpad(CAST(ly % 100 AS VARCHAR), 2, '0') || lpad(CAST((ly + 1) % 100 AS VARCHAR), 2, '0') AS fy FROM y)
SELECT o_orderkey, fy, '20' || CASE WHEN m < 4 THEN substr(fy, 3, 2) ELSE substr(fy, 1, 2) END AS cal_year FROM f""",
    "age_tenure": """
WITH x AS (
  SELECT l.l_orderkey, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS birth,
         COALESCE(CASE WHEN l.l_linenumber <> 1 THEN CAST(l.l_shipdate AS DATE) END, DATE '2002-12-31') AS as_of_d
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT l_orderkey, l_linenumber,
  COALESCE(CAST(trunc(datediff('day', birth, as_of_d) / 365.25) AS INTEGER), 0) AS age,
  round_even(datediff('day', birth, as_of_d) / 365.25, 2) AS tenure
FROM x""",
    "eom_makedate_fill": f"""
WITH o AS {_ORDERS},
f AS (SELECT o_orderkey, COALESCE(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END,
                                  make_date(year(o_orderdate), month(o_orderdate), 1)) AS filled FROM o)
SELECT o_orderkey, filled, last_day(filled) AS eom FROM f""",
    "parse_dates_multi": f"""
WITH o AS {_ORDERS},
t AS (SELECT o_orderkey,
  CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
       WHEN 2 THEN '31/02/' || CAST(year(o_orderdate) AS VARCHAR) ELSE 'not a date' END AS raw FROM o)
SELECT o_orderkey, raw, CAST(try_strptime(trim(raw), '%d/%m/%Y') AS DATE) AS strict,
  CAST(COALESCE(try_strptime(trim(raw), '%d/%m/%Y'), try_strptime(trim(raw), '%Y-%m-%d')) AS DATE) AS either
FROM t""",
    "epoch_text_parse": """
WITH e AS (SELECT event_id, 946684800000 + event_id * 3600123 AS ms FROM events)
SELECT event_id, '/Date(' || CAST(ms AS VARCHAR) || ')/' AS raw, make_timestamp(ms * 1000) AS parsed FROM e""",
    "date_parts": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(year(o_orderdate) AS INTEGER) AS y,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
  CAST(datediff('day', o_orderdate, last_day(o_orderdate)) AS INTEGER) AS days_to_eom
FROM o""",
    "load_stamp": """
SELECT o_orderkey, date_trunc('minute', o_orderdate + to_seconds(o_orderkey * 37) + INTERVAL 8 HOUR) AS stamp FROM orders""",
    "ascii_strip": """
WITH d AS (SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS t FROM documents)
SELECT doc_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS md5 FROM d""",
    "punct_strip": """
WITH d AS (SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9_ \\t\\n\\x0B\\f\\r]', '', 'g') AS t FROM documents)
SELECT doc_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS md5 FROM d""",
    "split_parts": """
WITH p AS (SELECT page_id, url, string_split(url, '/')[3] AS host FROM pages)
SELECT page_id,
  CASE WHEN strpos(url, '?') > 0 THEN substr(url, 1, strpos(url, '?') - 1) ELSE url END AS head,
  CASE WHEN strpos(url, '?') > 0 THEN substr(url, strpos(url, '?') + 1) END AS query,
  string_split(url, '/')[-1] AS last_seg,
  array_to_string(string_split(host, '.')[1:2], '.') AS host2,
  string_split(host, '.')[1] AS h1, string_split(host, '.')[2] AS h2,
  string_split(host, '.')[3] AS h3, string_split(host, '.')[4] AS h4
FROM p""",
    "text_extract": """
SELECT c_custkey, substr(c_name, 1, 8) AS prefix8, contains(c_name, '#00000') AS has_zeros,
  COALESCE(regexp_extract(c_name, '#0*(\\d+)', 1), '') AS num, replace(c_name, '#', '-') AS dashed,
  COALESCE(c_name, '') || COALESCE('/' || c_mktsegment, '') AS appended
FROM customer""",
    "name_normaliser": f"""
SELECT p_partkey, {_norm("' ' || p_name || ' (' || p_type || ').Type-' || p_brand")} AS norm FROM part""",
    "conditional_grade": """
SELECT p_partkey,
  CASE WHEN contains(p_name, 'ring') AND p_brand IS NOT NULL AND NOT contains(p_brand, 'Brand#1') THEN p_brand ELSE p_name END AS grade,
  COALESCE(p_size IS NOT NULL AND p_size <> 10, false) AS on_shift,
  COALESCE(p_type IN ('ECONOMY', 'SMALL'), false) AS flexi,
  COALESCE(p_brand IN ('Brand#2', 'Brand#4'), false) AS local_flag,
  NULLIF(p_size, 1) AS size_or_null
FROM part""",
    "percent_numeric_coerce": """
WITH x AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS raw FROM lineitem)
SELECT l_orderkey, l_linenumber, raw, round(TRY_CAST(trim(raw) AS DOUBLE) * 0.01, 4) AS frac FROM x""",
    "derived_flags": """
SELECT l_orderkey, l_linenumber,
  (CASE WHEN l_linenumber <> 1 THEN l_shipdate END) IS NOT NULL AS left_flag,
  NULLIF(l_returnflag, 'N') = l_linestatus AS one_way,
  CAST(l_linestatus = 'F' AS INTEGER) AS is_f
FROM lineitem""",
    "dict_mapping": f"""
WITH o AS {_ORDERS},
m(k, v) AS (VALUES ('jan', 1), ('feb', 2), ('mar', 3), ('apr', 4), ('may', 5), ('jun', 6),
                   ('jul', 7), ('aug', 8), ('sep', 9), ('oct', 10), ('nov', 11), ('dec', 12)),
x AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Smarch' ELSE strftime(o_orderdate, '%B') END AS month_name FROM o)
SELECT x.o_orderkey, x.month_name, CAST(m.v AS INTEGER) AS month_no
FROM x LEFT JOIN m ON lower(substr(trim(x.month_name), 1, 3)) = m.k""",
    "contract_typing": """
WITH r AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber = 4 THEN 'x' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS qty,
  CASE WHEN l_linenumber = 5 THEN '31/02/1999' ELSE strftime(l_shipdate, '%d/%m/%Y') END AS ship,
  CASE WHEN l_linenumber = 6 THEN 'yes' ELSE 'FALSE' END AS flag,
  CASE WHEN l_linenumber <> 3 THEN 9007199254740993 + l_orderkey END AS big
  FROM lineitem)
SELECT l_orderkey, TRY_CAST(qty AS DOUBLE) AS qty, CAST(try_strptime(trim(ship), '%d/%m/%Y') AS DATE) AS ship,
  CASE WHEN upper(trim(flag)) IN ('TRUE', 'T', 'YES', 'Y', '1') THEN true
       WHEN upper(trim(flag)) IN ('FALSE', 'F', 'NO', 'N', '0') THEN false END AS flag,
  CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(big AS BIGINT) AS big,
  round_even(TRY_CAST(qty AS DOUBLE) / 2, 0) AS half_qty
FROM r""",
    "filter_mix": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM o
WHERE (o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
       AND o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND o_totalprice IS NOT NULL)
   OR (o_orderpriority LIKE '%SPECIFIED' AND o_totalprice > 400000)""",
    "left_lookup_chain": """
WITH c AS (SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END AS nk FROM customer),
n AS (SELECT CASE WHEN n_nationkey <> 24 THEN n_nationkey END AS nk, n_name AS name, n_regionkey FROM nation)
SELECT c.c_custkey, c.name, c.nk, n.name AS name_ref, n.n_regionkey, r.r_regionkey, r.r_name
FROM c LEFT JOIN n ON c.nk IS NOT DISTINCT FROM n.nk
LEFT JOIN region r ON n.n_regionkey IS NOT DISTINCT FROM r.r_regionkey""",
    "outer_merge": """
WITH s AS (SELECT s_nationkey AS k, count(*) AS n_sup FROM supplier GROUP BY 1),
n AS (SELECT n_nationkey + 10 AS k, n_name FROM nation)
SELECT COALESCE(s.k, n.k) AS k, s.n_sup, n.n_name FROM s FULL OUTER JOIN n ON s.k = n.k""",
    "overlay_update": """
WITH u AS (SELECT CASE WHEN p_size = 50 THEN p_partkey + 1000000 ELSE p_partkey END AS k,
                  'Brand#X' || CAST(p_size AS VARCHAR) AS b, CAST(NULL AS DOUBLE) AS rp
           FROM part WHERE p_size > 45)
SELECT p.p_partkey, p.p_name, COALESCE(u.b, p.p_brand) AS p_brand, p.p_size, COALESCE(u.rp, p.p_retailprice) AS p_retailprice
FROM part p LEFT JOIN u ON p.p_partkey = u.k""",
    "two_key_left_join": f"""
WITH o AS (SELECT *, last_day(o_orderdate) AS eom FROM {_ORDERS}),
pay AS (SELECT o_custkey, eom, round(sum(o_totalprice), 2) AS total FROM o GROUP BY 1, 2),
listing AS (SELECT DISTINCT o_custkey, eom FROM o WHERE o_orderstatus = 'F')
SELECT l.o_custkey, l.eom, p.total FROM listing l LEFT JOIN pay p ON l.o_custkey = p.o_custkey AND l.eom = p.eom""",
    "detail_left_fanout": """
SELECT o.o_orderkey, l.l_linenumber, o.o_totalprice FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
    "distinct_key_enrich": """
SELECT c_nationkey, c_custkey, 'zone-' || CAST(c_nationkey % 7 AS VARCHAR) AS zone
FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey % 5 <> 0""",
    "latest_attribute": f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS prio FROM {_ORDERS}),
l AS (SELECT o_custkey, arg_max(prio, (o_orderdate, o_orderkey)) AS latest_prio FROM o
      WHERE prio IS NOT NULL AND o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT o.o_orderkey, o.o_custkey, l.latest_prio FROM o LEFT JOIN l ON o.o_custkey = l.o_custkey""",
    "dedupe_first": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM o
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate ASC NULLS LAST, o_orderkey ASC NULLS LAST) = 1""",
    "dedupe_last": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM o
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1""",
    "duplicates_only": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey, o_custkey, o_orderdate FROM o
QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderdate) > 1""",
    "latest_per_key_nulls": """
WITH li AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 2 THEN CAST(l_shipdate AS DATE) END AS d FROM lineitem),
a AS (SELECT *, 'pass' AS variant FROM li
      QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY d DESC NULLS LAST, l_linenumber DESC NULLS LAST) = 1),
b AS (SELECT *, 'pay' AS variant FROM li
      QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY d DESC NULLS FIRST, l_linenumber DESC NULLS FIRST) = 1)
SELECT * FROM a UNION ALL SELECT * FROM b""",
    "joiner_mark": f"""
WITH o AS {_ORDERS}
SELECT o_orderkey,
  row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) = 1 AS joiner_mark
FROM o""",
    "equals_group_max": """
SELECT o_orderkey, COALESCE(o_totalprice = max(o_totalprice) OVER (PARTITION BY o_custkey), false) AS is_max FROM orders""",
    "dayrange_explode": f"""
WITH o AS {_ORDERS},
x AS (SELECT o_orderkey, o_orderdate AS s, CAST(o_orderdate + CAST(o_orderkey % 5 - 1 AS INTEGER) AS DATE) AS e FROM o)
SELECT o_orderkey, CAST(unnest(CASE WHEN s <= e THEN generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)
                                    ELSE [CAST(NULL AS TIMESTAMP)] END) AS DATE) AS day
FROM x""",
    "gaps_islands": """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
g AS (SELECT user_id, day, CAST(datediff('day', lag(day) OVER (PARTITION BY user_id ORDER BY day), day) AS INTEGER) AS gap_days FROM d),
r AS (SELECT *, COALESCE(gap_days > 1, false) AS gap,
        CAST(sum(CASE WHEN gap_days IS NULL OR gap_days > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id
      FROM g)
SELECT user_id, day, gap_days, gap, run_id,
  CAST(row_number() OVER (PARTITION BY user_id, run_id ORDER BY day) - 1 AS INTEGER) AS streak
FROM r""",
    "timeoff_runs": """
WITH l AS (
  SELECT DISTINCT o_custkey AS persno, o_orderpriority AS leave_type_code, CAST(o_orderdate AS DATE) AS startdate,
         CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER) AS DATE) AS enddate
  FROM orders),
x AS (
  SELECT *, CAST(unnest(generate_series(CAST(startdate AS TIMESTAMP), CAST(enddate AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS leave_day
  FROM l),
dd AS (SELECT persno, leave_day FROM x GROUP BY 1, 2),
g AS (SELECT persno, leave_day,
             CAST(datediff('day', lag(leave_day) OVER (PARTITION BY persno ORDER BY leave_day), leave_day) AS INTEGER) AS gap
      FROM dd),
r AS (SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap > 1 THEN 1 ELSE 0 END)
                     OVER (PARTITION BY persno ORDER BY leave_day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM g),
k AS (
  SELECT x.*, r.gap, r.run_id,
    row_number() OVER (PARTITION BY x.persno, r.run_id
                       ORDER BY x.leave_day, x.leave_type_code NULLS FIRST, x.startdate NULLS FIRST, x.enddate NULLS FIRST) - 1 AS streak,
    row_number() OVER (PARTITION BY x.persno, x.leave_day
                       ORDER BY x.leave_type_code NULLS FIRST, x.startdate NULLS FIRST, x.enddate NULLS FIRST) AS rn_day
  FROM x JOIN r ON x.persno = r.persno AND x.leave_day = r.leave_day)
SELECT persno, leave_type_code, startdate, enddate, leave_day,
  CASE WHEN rn_day = 1 THEN gap ELSE 0 END AS gap_days,
  COALESCE(CASE WHEN rn_day = 1 THEN gap ELSE 0 END > 1, false) AS gap,
  run_id, CAST(streak AS INTEGER) AS streak
FROM k""",
    "unpivot_single": """
WITH li AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax, l_quantity FROM lineitem)
SELECT l_orderkey, l_linenumber, measure, amount
FROM li UNPIVOT INCLUDE NULLS (amount FOR measure IN (l_extendedprice, l_discount, l_tax, l_quantity))""",
    "unpivot_groups": f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax, l_quantity FROM lineitem),
u AS (SELECT * FROM li UNPIVOT INCLUDE NULLS (amount FOR measure IN (l_extendedprice, l_discount, l_tax, l_quantity)))
SELECT l_orderkey, l_linenumber, {_norm("regexp_replace(measure, '^l_', 'L ')")} AS measure, amount,
  CASE measure WHEN 'l_extendedprice' THEN 'price' WHEN 'l_discount' THEN 'rates' WHEN 'l_tax' THEN 'rates'
               WHEN 'l_quantity' THEN 'volume' END AS grp
FROM u""",
    "union_by_name_missing": """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, CAST(NULL AS DOUBLE) AS bal FROM customer
UNION ALL
SELECT s_suppkey, s_name, CAST(NULL AS INTEGER), s_acctbal FROM supplier""",
    "span_of_control": f"""
WITH t AS {_TREE},
r AS (SELECT mgr, count(DISTINCT c_custkey) AS span FROM t WHERE mgr IS NOT NULL GROUP BY mgr)
SELECT t.c_custkey, r.span FROM t LEFT JOIN r ON t.c_custkey = r.mgr""",
    "layer_depth": f"""
WITH RECURSIVE t AS {_TREE},
d(id, depth) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT t.c_custkey, d.depth + 1 FROM t JOIN d ON t.mgr = d.id WHERE t.c_custkey <> 0)
SELECT t.c_custkey, d.depth AS layer FROM t LEFT JOIN d ON t.c_custkey = d.id""",
    "snapshot_diff": f"""
WITH o AS (SELECT *, last_day(o_orderdate) AS eom FROM {_ORDERS}),
pm AS (SELECT o_custkey, eom, o_orderkey, o_orderpriority, o_orderstatus FROM o
       QUALIFY row_number() OVER (PARTITION BY o_custkey, eom ORDER BY o_orderkey DESC) = 1),
s AS (SELECT eom, lead(eom) OVER (ORDER BY eom) AS nxt FROM (SELECT DISTINCT eom FROM pm WHERE eom IS NOT NULL)),
j AS (
  SELECT a.o_custkey, a.eom AS eom_old, b.eom,
         a.o_orderpriority AS o_orderpriority_old, b.o_orderpriority AS o_orderpriority_new,
         a.o_orderstatus AS o_orderstatus_old, b.o_orderstatus AS o_orderstatus_new,
         a.o_orderkey AS o_orderkey_old, b.o_orderkey AS o_orderkey_new
  FROM pm a JOIN s ON a.eom = s.eom JOIN pm b ON a.o_custkey = b.o_custkey AND b.eom = s.nxt
  WHERE a.o_custkey IS NOT NULL),
c AS (
  SELECT *, 'o_orderpriority' AS field,
    CASE WHEN o_orderpriority_old IS NULL AND o_orderpriority_new IS NOT NULL THEN 'added'
         WHEN o_orderpriority_old IS NOT NULL AND o_orderpriority_new IS NULL THEN 'deleted'
         WHEN o_orderpriority_old <> o_orderpriority_new THEN 'modified' END AS change FROM j
  UNION ALL
  SELECT *, 'o_orderstatus',
    CASE WHEN o_orderstatus_old IS NULL AND o_orderstatus_new IS NOT NULL THEN 'added'
         WHEN o_orderstatus_old IS NOT NULL AND o_orderstatus_new IS NULL THEN 'deleted'
         WHEN o_orderstatus_old <> o_orderstatus_new THEN 'modified' END FROM j)
SELECT o_custkey, eom_old, eom, field, change, o_orderpriority_old, o_orderpriority_new, o_orderstatus_old, o_orderstatus_new,
    o_orderkey_old, o_orderkey_new, CAST(1 AS BIGINT) AS n_old, CAST(1 AS BIGINT) AS n_new
FROM c WHERE change IS NOT NULL""",
    # each group of a customer in two adjacent months: one distinct row a side is compared, else values are counted
    "joiner_mark_ties": f"""
SELECT o_orderstatus, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_marks, min(last_day(o_orderdate)) AS marked_month
FROM {_ORDERS} GROUP BY o_orderstatus""",
    # the expected names are written out, not derived
    "value_name_join": """
SELECT n.name, n.header_no, count(*) AS n
FROM customer c JOIN (VALUES ('cafe_fee', 0), ('pramie_netto', 1), ('ano_salario', 2), ('date_joined_ddmm', 3), ('employees_grade', 4),
    ('uberstunden_std', 5)) n(name, header_no) ON c.c_custkey % 6 = n.header_no
GROUP BY 1, 2""",
    "snapshot_diff_repeated": f"""
WITH o AS (SELECT o_custkey AS k, last_day(o_orderdate) AS eom, o_orderpriority AS p, o_orderstatus AS st FROM {_ORDERS}
           WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL),
s AS (SELECT eom, lead(eom) OVER (ORDER BY eom) AS nxt FROM (SELECT DISTINCT eom FROM o)),
h AS (SELECT k, eom, count(*) AS n, count(DISTINCT coalesce(p, '~') || '|' || coalesce(st, '~')) AS nd,
             any_value(p) AS p, any_value(st) AS st FROM o GROUP BY k, eom),
g AS (SELECT a.k, a.eom AS eom_old, b.eom, a.nd = 1 AND b.nd = 1 AS single, a.n AS na, b.n AS nb,
             a.p AS po, b.p AS pn, a.st AS so, b.st AS sn
      FROM h a JOIN s ON a.eom = s.eom JOIN h b ON a.k = b.k AND b.eom = s.nxt),
one AS (
  SELECT k, eom_old, eom, 'o_orderpriority' AS field, po AS x, pn AS y, po, pn, so, sn, na, nb FROM g WHERE single
  UNION ALL
  SELECT k, eom_old, eom, 'o_orderstatus', so, sn, po, pn, so, sn, na, nb FROM g WHERE single),
v AS (
  SELECT g.k, g.eom_old, g.eom, f.field, CASE f.field WHEN 'o_orderpriority' THEN o.p ELSE o.st END AS val,
         count(*) FILTER (WHERE o.eom = g.eom_old) AS n_old, count(*) FILTER (WHERE o.eom = g.eom) AS n_new
  FROM g JOIN o ON o.k = g.k AND o.eom IN (g.eom_old, g.eom), (VALUES ('o_orderpriority'), ('o_orderstatus')) f(field)
  WHERE NOT g.single GROUP BY ALL)
SELECT k AS o_custkey, eom_old, eom, field,
    CASE WHEN x IS NULL THEN 'added' WHEN y IS NULL THEN 'deleted' ELSE 'modified' END AS change,
    po AS o_orderpriority_old, pn AS o_orderpriority_new, so AS o_orderstatus_old, sn AS o_orderstatus_new, na AS n_old, nb AS n_new
FROM one WHERE x IS DISTINCT FROM y
UNION ALL
SELECT k, eom_old, eom, field,
    CASE WHEN n_old = 0 THEN 'value_added' WHEN n_new = 0 THEN 'value_removed' ELSE 'value_count' END,
    CASE WHEN field = 'o_orderpriority' AND n_old > 0 THEN val END, CASE WHEN field = 'o_orderpriority' AND n_new > 0 THEN val END,
    CASE WHEN field = 'o_orderstatus' AND n_old > 0 THEN val END, CASE WHEN field = 'o_orderstatus' AND n_new > 0 THEN val END,
    n_old, n_new
FROM v WHERE n_old <> n_new""",
    "snapshot_diff_aligned": f"""
WITH o AS (SELECT o_custkey AS k, last_day(o_orderdate) AS eom, o_orderpriority AS p, o_orderstatus AS st, o_orderkey AS ok FROM {_ORDERS}
           WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL),
s AS (SELECT eom, lead(eom) OVER (ORDER BY eom) AS nxt FROM (SELECT DISTINCT eom FROM o)),
h AS (SELECT DISTINCT k, eom FROM o),
g AS (SELECT a.k, a.eom AS eom_old, b.eom FROM h a JOIN s ON a.eom = s.eom JOIN h b ON a.k = b.k AND b.eom = s.nxt),
sides AS (
  SELECT g.k, g.eom_old, g.eom, 0 AS side, o.p, o.st, o.ok FROM g JOIN o ON o.k = g.k AND o.eom = g.eom_old
  UNION ALL SELECT g.k, g.eom_old, g.eom, 1, o.p, o.st, o.ok FROM g JOIN o ON o.k = g.k AND o.eom = g.eom),
n AS (
  SELECT *, row_number() OVER (PARTITION BY k, eom_old, side, p, st ORDER BY ok NULLS FIRST) AS nth,
    count(*) FILTER (WHERE side = 0) OVER (PARTITION BY k, eom_old, p, st) AS n_old,
    count(*) FILTER (WHERE side = 1) OVER (PARTITION BY k, eom_old, p, st) AS n_new FROM sides),
r AS (
  SELECT *, row_number() OVER (PARTITION BY k, eom_old, side ORDER BY p NULLS FIRST, st NULLS FIRST, ok NULLS FIRST) AS rank
  FROM n WHERE nth > least(n_old, n_new)),
j AS (
  SELECT coalesce(a.k, b.k) AS k, coalesce(a.eom_old, b.eom_old) AS eom_old, coalesce(a.eom, b.eom) AS eom, a.rank AS ra, b.rank AS rb,
    a.p AS po, b.p AS pn, a.st AS so, b.st AS sn, a.ok AS oo, b.ok AS onew
  FROM (SELECT * FROM r WHERE side = 0) a FULL JOIN (SELECT * FROM r WHERE side = 1) b ON a.k = b.k AND a.eom_old = b.eom_old AND a.rank = b.rank),
c AS (
  SELECT *, 'o_orderpriority' AS field, CASE WHEN po IS NULL THEN 'added' WHEN pn IS NULL THEN 'deleted' ELSE 'modified' END AS change
  FROM j WHERE ra IS NOT NULL AND rb IS NOT NULL AND po IS DISTINCT FROM pn
  UNION ALL SELECT *, 'o_orderstatus', CASE WHEN so IS NULL THEN 'added' WHEN sn IS NULL THEN 'deleted' ELSE 'modified' END
  FROM j WHERE ra IS NOT NULL AND rb IS NOT NULL AND so IS DISTINCT FROM sn
  UNION ALL SELECT *, NULL, CASE WHEN rb IS NULL THEN 'row_removed' ELSE 'row_added' END FROM j WHERE ra IS NULL OR rb IS NULL)
SELECT k AS o_custkey, eom_old, eom, field, change, po AS o_orderpriority_old, pn AS o_orderpriority_new, so AS o_orderstatus_old,
  sn AS o_orderstatus_new, oo AS o_orderkey_old, onew AS o_orderkey_new FROM c""",
    # the expected types are written out; the counts come from the table
    "type_inference": f"""
WITH o AS {_ORDERS}, n AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 <> 0 AND o_orderdate IS NOT NULL) AS d,
  count(o_orderdate) AS dates, count(o_totalprice) AS prices FROM o)
SELECT c."column", c.type, c.format, CAST(CASE c.kind WHEN 'd' THEN d WHEN 'i' THEN dates WHEN 'p' THEN prices WHEN '0' THEN 0 ELSE n END AS BIGINT) AS n_values,
  CAST(n - CASE c.kind WHEN 'd' THEN d WHEN 'i' THEN dates WHEN 'p' THEN prices WHEN '0' THEN 0 ELSE n END AS BIGINT) AS n_empty
FROM n, (VALUES ('plain_id', 'bigint', NULL, 'n'), ('zero_id', 'string', NULL, 'n'), ('day_first', 'date', 'dd/MM/yyyy', 'd'), ('iso', 'date', 'yyyy-MM-dd', 'i'),
  ('flag', 'boolean', NULL, 'n'), ('price', 'double', NULL, 'p'), ('mixed', 'string', NULL, 'n'), ('nothing', 'string', NULL, '0'),
  ('big', 'bigint', NULL, 'n'), ('o_orderkey', 'bigint', NULL, 'n')) c("column", type, format, kind)""",
    "date_votes": f"""
WITH o AS (SELECT o_orderkey, o_orderdate AS d, o_orderstatus AS f FROM {_ORDERS} WHERE o_orderdate IS NOT NULL AND o_orderstatus IS NOT NULL),
t AS (
  SELECT f, 'text' AS col, CASE f WHEN 'F' THEN strftime(d, '%m/%d/%Y') WHEN 'O' THEN strftime(d, '%d/%m/%Y') ELSE strftime(d, '%-d-%b-%y') END AS v FROM o
  UNION ALL SELECT f, 'due', CASE WHEN o_orderkey % 10 = 0 THEN 'soon' ELSE strftime(d, '%d/%m/%Y') END FROM o),
m AS (SELECT * FROM (VALUES ('dd/MM/yyyy', 1), ('MM/dd/yyyy', 2), ('yyyy-MM-dd', 3), ('d-MMM-yy', 4), ('d MMM yyyy', 5)) x(format, place)),
c AS (
  SELECT f, col, format, place, count(*) AS n_values, count(CASE place WHEN 1 THEN try_strptime(v, '%d/%m/%Y') WHEN 2 THEN try_strptime(v, '%m/%d/%Y')
    WHEN 3 THEN try_strptime(v, '%Y-%m-%d') WHEN 4 THEN try_strptime(v, '%d-%b-%y') ELSE try_strptime(v, '%d %b %Y') END) AS n_read
  FROM t, m GROUP BY ALL),
b AS (SELECT *, max(n_read) OVER (PARTITION BY f, col) AS best FROM c)
SELECT f AS _file, col AS "column", format, n_values, n_read,
  best > 0 AND n_read = best AND place = min(CASE WHEN n_read = best THEN place END) OVER (PARTITION BY f, col) AS chosen,
  best > 0 AND n_read = best AND count(CASE WHEN n_read = best THEN 1 END) OVER (PARTITION BY f, col) > 1 AS tie FROM b""",
    "voted_dates": f"""
SELECT o_orderkey, o_orderstatus AS _file,
  CAST(CASE WHEN o_orderstatus NOT IN ('F', 'O') AND year(o_orderdate) < 2000 THEN o_orderdate + INTERVAL 100 YEAR ELSE o_orderdate END AS DATE) AS "text",
  CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS due
FROM {_ORDERS} WHERE o_orderdate IS NOT NULL AND o_orderstatus IS NOT NULL""",
    "page_chain": f"""
WITH RECURSIVE p AS (
  SELECT k AS page, CASE WHEN k % 50 = 49 THEN CASE WHEN (k // 50) % 3 = 0 THEN k - 49 END WHEN k % 50 = 7 THEN k + 2 ELSE k + 1 END AS next
  FROM (SELECT DISTINCT o_custkey AS k FROM {_ORDERS} WHERE o_custkey IS NOT NULL)),
i AS (SELECT next AS page, count(*) AS links FROM p WHERE next IS NOT NULL GROUP BY next),
c AS (
  SELECT p.page, p.page AS chain, CAST(0 AS BIGINT) AS position, p.next FROM p LEFT JOIN i USING (page) WHERE coalesce(links, 0) <> 1
  UNION ALL SELECT p.page, c.chain, c.position + 1, p.next FROM c JOIN p ON p.page = c.next JOIN i ON i.page = p.page WHERE i.links = 1)
SELECT p.page, c.chain, c.position, CASE WHEN c.page IS NULL THEN 'loop' WHEN i.links > 1 THEN 'fork'
  WHEN p.next IS NOT NULL AND p.next NOT IN (SELECT page FROM p) THEN 'gap' END AS problem
FROM p LEFT JOIN c USING (page) LEFT JOIN i ON i.page = p.page""",
    "kept_answers": """
SELECT DISTINCT CAST(c_nationkey AS INTEGER) AS key, CASE WHEN c_nationkey % 7 <> 0 AND c_nationkey % 5 <> 0 THEN 'zone-' || (c_nationkey % 4) END AS zone,
  CASE WHEN c_nationkey % 7 = 0 THEN 'failed' WHEN c_nationkey % 5 = 0 THEN 'none' ELSE 'found' END AS status,
  CASE WHEN c_nationkey % 7 = 0 THEN 3 ELSE 1 END AS tries,
  CASE WHEN c_nationkey % 7 = 0 THEN 'ValueError: no service for ' || c_nationkey END AS error, CAST(1 AS BIGINT) AS asked
FROM customer WHERE c_nationkey IS NOT NULL""",
    "sketch_rollup": f"""
WITH o AS (SELECT * FROM {_ORDERS} WHERE o_orderdate IS NOT NULL)
SELECT 'year' AS level, CAST(year(o_orderdate) AS VARCHAR) AS value, count(*) AS rows, count(DISTINCT o_custkey) AS n_exact, true AS close FROM o GROUP BY 2
UNION ALL SELECT 'status', o_orderstatus, count(*), count(DISTINCT o_custkey), true FROM o WHERE o_orderstatus IS NOT NULL GROUP BY 2""",
    "delimited_rows": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 = 0
  THEN 'said "' || o_orderpriority || '",' || chr(10) || 'then ' || o_orderstatus || chr(10) || chr(10) || o_orderkey ELSE o_orderpriority END AS note
FROM {_ORDERS}""",
    "dq_rules": f"SELECT o_orderkey, error FROM {_DQ_ERR}",
    "dq_report": f"""
SELECT o_orderstatus, error, count(error) AS n_errors FROM {_DQ_ERR} WHERE error IS NOT NULL GROUP BY 1, 2""",
    "dq_list": f"SELECT o_orderkey, prio, note, error FROM {_DQ_ERR} WHERE error IS NOT NULL",
    "validation_table": f"""
WITH o AS {_ORDERS},
f AS (SELECT o_custkey, min(o_orderdate) AS first_date FROM o GROUP BY 1),
x AS (SELECT o.*, f.first_date, o.o_orderdate BETWEEN DATE '1997-04-01' AND DATE '1998-03-31' AS in_fy
      FROM o JOIN f ON o.o_custkey = f.o_custkey)
SELECT * FROM (VALUES
  ('headcount', (SELECT CAST(count(DISTINCT o_custkey) AS DOUBLE) FROM x)),
  ('leavers_fy', (SELECT CAST(count(DISTINCT CASE WHEN in_fy AND o_orderstatus = 'F' THEN o_custkey END) AS DOUBLE) FROM x)),
  ('orders_fy', (SELECT CAST(sum(CAST(in_fy AS INTEGER)) AS DOUBLE) FROM x)),
  ('joiners_by_first_date', (SELECT CAST(count(DISTINCT CASE WHEN in_fy AND o_orderdate = first_date THEN o_custkey END) AS DOUBLE) FROM x)),
  ('joiners_by_first_in_fy', (SELECT CAST(count(DISTINCT CASE WHEN first_date BETWEEN DATE '1997-04-01' AND DATE '1998-03-31' THEN o_custkey END) AS DOUBLE) FROM x))
) v("check", value)""",
    "drop_null_rows": """
WITH p AS (SELECT NULLIF(c_mktsegment, 'HOUSEHOLD') AS seg, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal,
                  CASE WHEN c_nationkey % 4 <> 0 THEN c_nationkey END AS nat FROM customer)
SELECT COALESCE(seg, CAST(nat AS VARCHAR)) AS seg, COALESCE(bal, 0.0) AS bal, nat FROM p
WHERE NOT (seg IS NULL AND bal IS NULL AND nat IS NULL) AND nat IS NOT NULL""",
    "drop_null_columns": """
SELECT c_custkey, c_name, NULLIF(c_mktsegment, 'HOUSEHOLD') AS part_null, CAST(NULL AS VARCHAR) AS note FROM customer""",
    "drop_any_null_columns": """
SELECT c_custkey, c_name, c_acctbal AS tmp_bal FROM customer""",
    "trim_upper_all": """
SELECT c_custkey, upper(trim('  ' || lower(c_name) || ' ')) AS name, trim(lower(c_mktsegment) || chr(9), ' ' || chr(9)) AS segment,
       'SF' AS source FROM customer""",
    "json_records": """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "attrition_features": _ATTRITION,
    "sample_rows": """
SELECT least(200, count(*)) AS n_rows, least(200, count(*)) AS n_orders, least(200, count(*)) AS n_known FROM orders""",
    "json_record_arrays": """
SELECT o_orderkey, o_orderstatus AS info_status, o_orderpriority AS info_priority FROM orders""",
    "json_pages": """
SELECT o_orderkey, o_orderstatus AS meta_o_orderstatus, 'page-' || (o_custkey + 1) AS next_page FROM orders""",
    "attrition_set": f"""
WITH l AS (
  SELECT o_custkey AS persno, last_day(o_orderdate) AS eom, o_orderstatus <> 'F' AS active,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS date_left,
         CASE o_custkey % 5 WHEN 0 THEN 'Other' WHEN 1 THEN 'SF DIRECT ' ELSE 'SF Direct' END AS source,
         o_orderpriority = '5-LOW' AS flexi,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Central Provident Fund ' WHEN 'MACHINERY' THEN 'SCHEME FOR PERMANENT RESIDENT'
              WHEN 'HOUSEHOLD' THEN NULL ELSE 'NA' END AS fund_type,
         CAST(o_custkey % 45 + 20 AS INT) AS age, c_mktsegment AS industry, CAST(c_nationkey % 4 AS VARCHAR) AS business,
         CAST(c_nationkey % 9 AS VARCHAR) AS business_unit, ' D' || c_nationkey AS parent_department,
         CASE WHEN c_acctbal >= 0 THEN CAST(CAST(floor(c_acctbal / 2500) AS BIGINT) AS VARCHAR) END AS grade,
         CAST(o_custkey % 6 AS VARCHAR) AS job_grade, o_custkey % 2 = 0 AS on_shift,
         CASE WHEN o_custkey % 3 > 0 THEN CAST(o_custkey % 3 AS VARCHAR) END AS marital_status,
         CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender_key, CAST(c_nationkey AS VARCHAR) AS nationality,
         o_orderstatus AS employee_group, o_orderpriority AS job
  FROM {_ORDERS} JOIN customer ON o_custkey = c_custkey),
u AS (
  SELECT * FROM l WHERE eom = (SELECT max(eom) FROM l) AND active AND upper(trim(source)) = 'SF DIRECT' AND NOT flexi
  UNION
  SELECT * FROM l WHERE date_left >= DATE '1997-01-01' AND NOT active AND upper(trim(source)) = 'SF DIRECT' AND NOT flexi)
SELECT persno, CAST(active AS INT) AS active, age,
       CASE WHEN upper(trim(fund_type)) IN ('CENTRAL PROVIDENT FUND', 'SCHEME FOR PERMANENT RESIDENT') THEN 1 ELSE 0 END AS local,
       industry, business, business_unit, trim(parent_department) AS parent_department, grade, job_grade, CAST(on_shift AS INT) AS on_shift,
       coalesce(marital_status, '') AS marital_status, gender_key, nationality, employee_group, job
FROM u WHERE grade IS NOT NULL""",
    "model_sets": f"""
WITH f AS ({_ATTRITION}),
p AS (SELECT *, CASE WHEN CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 4 = 0 THEN 'test' ELSE 'train' END AS part FROM f),
g AS (SELECT part, active, count(*) AS n FROM p GROUP BY 1, 2)
SELECT part, active, n, round(sum(n) OVER (PARTITION BY part) / (count(*) OVER (PARTITION BY part) * n), 9) AS weight FROM g""",
}
