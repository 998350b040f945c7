"""DuckDB SQL that must return the same rows as each registered query.

Written independently of the Spark code, as plain SQL over the driver views
(``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations``).
"""

from __future__ import annotations

# similarity pieces shared by the fuzzy-match oracles
_NORM = "lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"
_TSORT = "array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def _ratio(a: str, b: str) -> str:
    length = f"greatest(length({a}), length({b}))"
    return f"(CASE WHEN {length} = 0 THEN 100 ELSE (200 * ({length} - levenshtein({a}, {b})) + {length}) // (2 * {length}) END)"


def _similarity(a: str, b: str) -> str:
    sorted_ratio = _ratio(_TSORT.format(x=a), _TSORT.format(x=b))
    return f"greatest({_ratio(a, b)}, ({sorted_ratio} * 95 + 50) // 100)"


_SEGMENT_LOOKUP = """
seg AS (
  SELECT name AS lk_name, substring(name, 1, 3) AS lk_code,
         row_number() OVER (ORDER BY name) AS lk_pos
  FROM (SELECT DISTINCT c_mktsegment AS name FROM customer)
)"""

_PERTURBED = """
CASE c_custkey % 6
  WHEN 0 THEN c_mktsegment
  WHEN 1 THEN lower(concat(substring(c_mktsegment, 1, CAST(c_custkey % length(c_mktsegment) AS INTEGER)),
                           substring(c_mktsegment, CAST(c_custkey % length(c_mktsegment) AS INTEGER) + 2)))
  WHEN 2 THEN concat(c_mktsegment, ' CO')
  WHEN 3 THEN concat('THE  ', c_mktsegment)
  WHEN 4 THEN reverse(c_mktsegment)
  ELSE concat(substring(c_mktsegment, 1, length(c_mktsegment) - 1), 'X')
END"""

_FUZZY_BEST = f"""
unmatched AS (
  SELECT DISTINCT name FROM names
  WHERE {_NORM.format(x="name")} NOT IN (SELECT lower(lk_name) FROM seg)
),
scored AS (
  SELECT u.name, lower(s.lk_name) AS match_name, s.lk_code, s.lk_pos,
         {_similarity(_NORM.format(x="u.name"), "lower(s.lk_name)")} AS match_score
  FROM unmatched u, seg s
),
best AS (
  SELECT name, match_name, match_score, lk_code AS code FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY match_score DESC, lk_pos ASC) AS rn FROM scored
  ) WHERE rn = 1 AND match_score >= 75
)"""

_ORDERS_STAR = """
star AS (
  SELECT o.*, CAST(o.o_orderdate AS DATE) AS order_date, c.c_custkey, c.c_nationkey, c.c_mktsegment,
         n.n_nationkey, n.n_name, r.r_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

ORACLE_SQL: dict[str, str] = {
    "g1_date_dim": """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
c AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1)
SELECT d.date,
       CAST(year(d.date) AS INTEGER) AS year, CAST(month(d.date) AS INTEGER) AS month,
       monthname(d.date) AS month_name, CAST(day(d.date) AS INTEGER) AS day, dayname(d.date) AS day_name,
       CAST(weekofyear(d.date) AS INTEGER) AS week,
       isodow(d.date) = 1 AS start_of_week, isodow(d.date) = 7 AS end_of_week,
       coalesce(c.n, 0) AS n_orders
FROM d LEFT JOIN c ON d.date = c.date
""",
    "f2_iso_week": """
WITH l AS (
  SELECT CASE WHEN starts_with(o_orderpriority, '1') THEN strftime(CAST(o_orderdate AS DATE), '%G-%V')
              ELSE strftime(CAST(o_orderdate AS DATE), '%G-W%V') END AS year_week
  FROM orders
),
p AS (
  SELECT year_week,
         TRY_CAST(split_part(year_week, '-', 1) AS INTEGER) AS iso_year,
         TRY_CAST(right(split_part(year_week, '-', 2), 2) AS INTEGER) AS iso_week
  FROM l
)
SELECT year_week, iso_year, iso_week,
       CAST(date_trunc('week', make_date(iso_year, 1, 4)) + (iso_week - 1) * INTERVAL 7 DAY AS DATE) AS week_start_date,
       CAST(date_trunc('week', make_date(iso_year, 1, 4)) + (iso_week - 1) * INTERVAL 7 DAY + INTERVAL 6 DAY AS DATE) AS week_end_date,
       iso_week BETWEEN 1 AND weekofyear(make_date(iso_year, 12, 28)) AS valid_week,
       count(*) AS n_orders
FROM p GROUP BY ALL
""",
    "j7_role_date": """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
k AS (SELECT date, CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS dim_date_key FROM d),
f AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
         CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS ws,
         CAST(date_trunc('week', CAST(o_orderdate AS DATE)) + INTERVAL 6 DAY AS DATE) AS we
  FROM orders
)
SELECT f.o_orderkey,
       CAST(coalesce(k1.dim_date_key, -1) AS INTEGER) AS dim_date_key,
       CAST(coalesce(k2.dim_date_key, -1) AS INTEGER) AS dim_week_start_date_key,
       CAST(coalesce(k3.dim_date_key, -1) AS INTEGER) AS dim_week_end_date_key
FROM f
LEFT JOIN k k1 ON f.date = k1.date
LEFT JOIN k k2 ON f.ws = k2.date
LEFT JOIN k k3 ON f.we = k3.date
""",
    "a1_keep_first": """
SELECT user_id,
       min(event_id) AS first_event_id,
       arg_min(event_type, event_id) AS first_event_type,
       arg_min(value, event_id) AS first_value
FROM events GROUP BY user_id
""",
    "a3_group_sizes": """
WITH e AS (SELECT *, CAST(ts AS DATE) AS event_date FROM events),
s AS (SELECT user_id, event_type, event_date, count(*) AS n FROM e GROUP BY ALL),
j AS (SELECT e.event_type, s.n FROM e JOIN s ON e.user_id IS NOT DISTINCT FROM s.user_id
        AND e.event_type IS NOT DISTINCT FROM s.event_type AND e.event_date IS NOT DISTINCT FROM s.event_date)
SELECT event_type,
       count(*) FILTER (WHERE n = 1) AS n_unique_rows,
       count(*) FILTER (WHERE n > 1) AS n_dupe_rows
FROM j GROUP BY event_type
""",
    "a4_first_non_null": """
WITH e AS (SELECT user_id, event_id, event_type, CASE WHEN value >= 10 THEN value END AS value FROM events)
SELECT user_id,
       arg_min(value, event_id) FILTER (WHERE event_type = 'purchase' AND value IS NOT NULL) AS purchase_value,
       arg_min(value, event_id) FILTER (WHERE event_type = 'error' AND value IS NOT NULL) AS error_value,
       arg_min(value, event_id) FILTER (WHERE event_type = 'click' AND value IS NOT NULL) AS click_value,
       arg_min(value, event_id) FILTER (WHERE event_type = 'view' AND value IS NOT NULL) AS view_value,
       arg_min(value, event_id) FILTER (WHERE event_type = 'signup' AND value IS NOT NULL) AS signup_value,
       arg_min(value, event_id) FILTER (WHERE value IS NOT NULL) AS first_any_value
FROM e GROUP BY user_id
""",
    "a5_suffix_rules": """
WITH e AS (
  SELECT event_type, CAST(ts AS DATE) AS event_date, event_id, hour(ts) AS h, props,
         CASE WHEN value >= 10 THEN value END AS value
  FROM events
)
SELECT event_type, event_date,
       CAST(CASE WHEN count(*) > 1 THEN coalesce(sum(CAST(value AS DECIMAL(18,2))), 0)
                 ELSE sum(CAST(value AS DECIMAL(18,2))) END AS DECIMAL(18,2)) AS value_sum,
       round(avg(value), 4) AS value_mean,
       max(value) AS value_max,
       min(value) AS value_min,
       array_to_string(list_sort(list(DISTINCT h) FILTER (WHERE h IS NOT NULL)), ',') AS hour_set,
       arg_min(props, event_id) FILTER (WHERE props IS NOT NULL) AS first_props
FROM e GROUP BY event_type, event_date
""",
    "u1_union": """
SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL BY NAME
SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
""",
    "p1_rename": """
SELECT c_custkey AS customer_key, c_mktsegment AS c_name, c_name AS c_mktsegment, c_acctbal AS account_balance
FROM customer
""",
    "p8_conditional": """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN l_quantity END AS qty_returned,
       CASE WHEN l_returnflag = 'A' THEN l_quantity END AS qty_accepted,
       CASE WHEN l_returnflag = 'N' THEN l_quantity END AS qty_none,
       CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS price_final
FROM lineitem
""",
    "p10_map": """
SELECT o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status_text,
       lower(o_orderpriority) AS priority,
       count(*) AS n_orders
FROM orders GROUP BY ALL
""",
    "p16_coerce": """
SELECT event_id,
       coalesce(CAST(TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a'
                                   ELSE regexp_extract(props, ':\\s*([^,}]*)', 1) END AS DOUBLE) AS BIGINT), 0) AS k,
       CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS label
FROM events
""",
    "f8_age_band": """
WITH g AS (
  SELECT CASE c_custkey % 9
           WHEN 0 THEN concat('Age', c_nationkey, '_', c_nationkey + 4)
           WHEN 1 THEN concat('Age<', c_nationkey + 1)
           WHEN 2 THEN concat('Age', c_nationkey, '+')
           WHEN 3 THEN concat('1_Age', c_nationkey, '+')
           WHEN 4 THEN concat('1_Age<', c_nationkey + 1)
           WHEN 5 THEN 'AgeUNK'
           WHEN 6 THEN 'ALL'
           WHEN 7 THEN 'HCW'
           ELSE 'LTCF' END AS target_group
  FROM customer
),
b AS (
  SELECT target_group,
         CASE WHEN starts_with(target_group, 'Age') THEN substring(target_group, 4)
              WHEN starts_with(target_group, '1_Age') THEN substring(target_group, 6) END AS body
  FROM g
)
SELECT target_group,
       CAST(CASE WHEN body LIKE '%\\_%' ESCAPE '\\' THEN TRY_CAST(split_part(body, '_', 1) AS INTEGER)
                 WHEN body LIKE '%<%' THEN 0
                 WHEN body LIKE '%+%' THEN TRY_CAST(replace(body, '+', '') AS INTEGER)
                 ELSE 0 END AS INTEGER) AS age_lower_limit,
       CAST(CASE WHEN body LIKE '%\\_%' ESCAPE '\\' THEN TRY_CAST(split_part(body, '_', 2) AS INTEGER)
                 WHEN body LIKE '%<%' THEN TRY_CAST(replace(body, '<', '') AS INTEGER)
                 WHEN body LIKE '%+%' THEN 200
                 ELSE 200 END AS INTEGER) AS age_upper_limit,
       CASE target_group
         WHEN 'ALL' THEN 'Overall adults (18+)'
         WHEN 'Age<18' THEN 'Overall adolescents and children (0-17 years old)'
         WHEN 'HCW' THEN 'Healthcare workers'
         WHEN 'LTCF' THEN 'Residents in long term care facilities'
         WHEN 'Age0_4' THEN '0-4 years old'
         WHEN 'Age5_9' THEN '5-9 years old'
         WHEN 'Age10_14' THEN '10-14 years old'
         WHEN 'Age15_17' THEN '15-17 years old'
         WHEN 'Age18_24' THEN '18-24 years old'
         WHEN 'Age25_49' THEN '25-49 years old'
         WHEN 'Age50_59' THEN '50-59 years old'
         WHEN 'Age60_69' THEN '60-69 years old'
         WHEN 'Age70_79' THEN '70-79 years old'
         WHEN 'Age80+' THEN '80 years and over'
         ELSE target_group END AS target_description,
       count(*) AS n_customers
FROM b GROUP BY ALL
""",
    "f7_row_hash": """
SELECT o_orderkey,
       concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS row_key,
       sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR))) AS row_hash
FROM orders
""",
    "w1_running_total": """
SELECT o_orderkey, o_custkey,
       CAST(CASE WHEN o_orderstatus <> 'P' THEN
         sum(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END)
           OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       END AS DECIMAL(18,2)) AS running_price
FROM orders
""",
    "j9_prev_week": """
WITH w AS (
  SELECT c.c_nationkey, CAST(date_trunc('week', CAST(o.o_orderdate AS DATE)) AS DATE) AS week_start_date,
         count(*) AS n_orders_7
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY ALL
)
SELECT w.c_nationkey, w.week_start_date, w.n_orders_7,
       w.n_orders_7 + coalesce(p.n_orders_7, 0) AS n_orders_14
FROM w LEFT JOIN w p
  ON w.c_nationkey IS NOT DISTINCT FROM p.c_nationkey
 AND w.week_start_date = p.week_start_date + INTERVAL 7 DAY
""",
    "j4_week_interval": """
WITH d AS (
  SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS date, count(*) AS n_orders FROM orders GROUP BY ALL
),
w AS (
  SELECT l_linestatus AS status, CAST(date_trunc('week', CAST(l_shipdate AS DATE)) AS DATE) AS week_start_date,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS week_qty
  FROM lineitem GROUP BY ALL
)
SELECT d.status, d.date, d.n_orders, w.week_start_date, w.week_qty
FROM d JOIN w ON d.status = w.status AND d.date BETWEEN w.week_start_date AND w.week_start_date + INTERVAL 6 DAY
""",
    "j2_fuzzy": f"""
WITH {_SEGMENT_LOOKUP.strip()},
names AS (SELECT {_PERTURBED.strip()} AS name FROM customer),
{_FUZZY_BEST.strip()}
SELECT name, match_name, CAST(match_score AS INTEGER) AS match_score, code FROM best
""",
    "j3_fallback": f"""
WITH {_SEGMENT_LOOKUP.strip()},
c AS (
  SELECT c_custkey, {_PERTURBED.strip()} AS country_name,
         CASE WHEN c_acctbal >= 0 THEN concat('T', c_nationkey) END AS territory_code,
         concat('X', substring(c_mktsegment, 1, 1)) AS country_code
  FROM customer
),
names AS (SELECT country_name AS name FROM c),
{_FUZZY_BEST.strip()}
SELECT c.c_custkey, c.country_name,
       coalesce(ex.lk_code, best.code, substring(c.territory_code, 1, 2), c.country_code) AS country_code
FROM c
LEFT JOIN seg ex ON {_NORM.format(x="c.country_name")} = lower(ex.lk_name)
LEFT JOIN best ON c.country_name = best.name
""",
    "j6_dim_keys": """
WITH dn AS (SELECT n_name AS nation_name, CAST(row_number() OVER (ORDER BY n_name) AS INTEGER) AS k FROM nation),
c AS (
  SELECT c_custkey,
         CASE WHEN c_acctbal >= 0 THEN concat('NATION_', c_nationkey) ELSE 'NATION_X' END AS nation_name
  FROM customer
)
SELECT c.c_custkey, CAST(coalesce(dn.k, -1) AS INTEGER) AS dim_nation_key, CAST(-1 AS INTEGER) AS dim_region_key
FROM c LEFT JOIN dn ON c.nation_name = dn.nation_name
""",
    "h5_surrogate": """
WITH m AS (
  SELECT DISTINCT concat_ws('-', c.c_mktsegment, n.n_name) AS member
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)
SELECT CAST(row_number() OVER (ORDER BY member) AS INTEGER) AS member_key, member FROM m
UNION ALL
SELECT CAST(-1 AS INTEGER) AS member_key, '-unknown-' AS member
""",
    "h4_upsert": """
WITH t0 AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment, DATE '2024-01-01' AS cd, DATE '2024-01-01' AS ud
  FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY c_name, c_acctbal, c_mktsegment) AS rn FROM customer)
  WHERE rn = 1
),
s1 AS (SELECT o_custkey AS c_custkey, max(o_totalprice) AS c_acctbal FROM orders GROUP BY 1),
t1 AS (
  SELECT coalesce(t0.c_custkey, s1.c_custkey) AS c_custkey, t0.c_name,
         CASE WHEN s1.c_custkey IS NOT NULL THEN s1.c_acctbal ELSE t0.c_acctbal END AS c_acctbal,
         t0.c_mktsegment,
         coalesce(t0.cd, DATE '2024-01-02') AS cd,
         CASE WHEN s1.c_custkey IS NOT NULL THEN DATE '2024-01-02' ELSE t0.ud END AS ud
  FROM t0 FULL OUTER JOIN s1 ON t0.c_custkey = s1.c_custkey
),
s2 AS (
  SELECT s_suppkey + 1000000000 AS c_custkey, s_name AS c_name, s_acctbal AS c_acctbal FROM supplier
),
t2 AS (
  SELECT coalesce(t1.c_custkey, s2.c_custkey) AS c_custkey,
         CASE WHEN s2.c_custkey IS NOT NULL THEN s2.c_name ELSE t1.c_name END AS c_name,
         CASE WHEN s2.c_custkey IS NOT NULL THEN s2.c_acctbal ELSE t1.c_acctbal END AS c_acctbal,
         t1.c_mktsegment,
         coalesce(t1.cd, DATE '2024-01-03') AS created_day,
         CASE WHEN s2.c_custkey IS NOT NULL THEN DATE '2024-01-03' ELSE t1.ud END AS updated_day
  FROM t1 FULL OUTER JOIN s2 ON t1.c_custkey = s2.c_custkey
)
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, created_day, updated_day FROM t2
""",
    "s11_manifest": """
SELECT p.page_id, p.url
FROM pages p
WHERE p.url NOT IN (SELECT p2.url FROM pages p2 WHERE p2.page_id IN (SELECT doc_id FROM labels) AND p2.url IS NOT NULL)
""",
    "s12_slug": """
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS endpoint FROM pages),
b AS (SELECT page_id, endpoint,
             lower(replace(split_part(regexp_replace(endpoint, '^/+|/+$', '', 'g'), '/', 1), '_', '-')) AS base
      FROM p)
SELECT page_id, endpoint,
       CASE WHEN endpoint = 'json/data.json' THEN 'colour-key.json'
            WHEN contains(base, '.') THEN base
            ELSE concat(base, '.json') END AS slug
FROM b
""",
    "j10_combine": """
WITH n AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY 1),
o AS (SELECT o_custkey AS c_custkey, count(*) AS n_open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT c.c_custkey, c.c_name, n.n_orders, o.n_open
FROM customer c JOIN n ON c.c_custkey = n.c_custkey LEFT JOIN o ON c.c_custkey = o.c_custkey
""",
    "n1_trend": f"""
WITH {_ORDERS_STAR.strip()},
w AS (
  SELECT n_name, r_name, CAST(date_trunc('week', order_date) AS DATE) AS week_start_date,
         count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value
  FROM star GROUP BY ALL
)
SELECT w.*, CAST(sum(n_orders) OVER (PARTITION BY r_name, week_start_date) AS BIGINT) AS region_orders FROM w
""",
    "n2_segment_priority": f"""
WITH {_ORDERS_STAR.strip()}
SELECT c_mktsegment, o_orderpriority, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_value,
       count(DISTINCT c_custkey) AS n_customers
FROM star GROUP BY ALL
""",
    "n3_status_week": f"""
WITH {_ORDERS_STAR.strip()}
SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start_date, o_orderstatus,
       count(DISTINCT n_nationkey) AS n_nations
FROM star GROUP BY ALL
""",
    "n4_two_facts": """
WITH p AS (SELECT CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS week_start_date, count(*) AS n_orders
           FROM orders GROUP BY 1),
s AS (SELECT CAST(date_trunc('week', CAST(l_shipdate AS DATE)) AS DATE) AS week_start_date,
             CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS qty_shipped
      FROM lineitem GROUP BY 1)
SELECT coalesce(p.week_start_date, s.week_start_date) AS week_start_date, p.n_orders, s.qty_shipped
FROM p FULL OUTER JOIN s ON p.week_start_date = s.week_start_date
""",
}

_ND_BASE = """
no AS (
  SELECT n.n_nationkey AS k, n.n_name, r.r_name, o.o_orderstatus AS st, CAST(o.o_orderdate AS DATE) AS d
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
pop AS (SELECT c_nationkey AS k, count(*) * 1000 AS population FROM customer GROUP BY 1),
wk AS (
  SELECT k, n_name, r_name, strftime(d, '%G-%V') AS year_week,
         CASE st WHEN 'F' THEN 'cases' WHEN 'O' THEN 'deaths' ELSE 'tests' END AS indicator, count(*) AS weekly_count
  FROM no GROUP BY ALL
),
wk2 AS (
  SELECT wk.*, pop.population,
         sum(weekly_count) OVER (PARTITION BY n_name, indicator ORDER BY year_week ROWS UNBOUNDED PRECEDING) AS cumulative_count,
         CAST(weekly_count AS DOUBLE) * 1000.0 / pop.population AS rate
  FROM wk JOIN pop USING (k)
),
weekly AS (
  SELECT year_week,
         CAST(date_trunc('week', make_date(CAST(split_part(year_week, '-', 1) AS INTEGER), 1, 4))
              + (CAST(split_part(year_week, '-', 2) AS INTEGER) - 1) * INTERVAL 7 DAY AS DATE) AS week_start_date,
         concat('T', lpad(CAST(k AS VARCHAR), 2, '0')) AS territory_code,
         concat('C', k) AS country_code, r_name AS continent, CAST(population AS BIGINT) AS population,
         'orders' AS source_name,
         CAST(max(weekly_count) FILTER (WHERE indicator = 'cases') AS BIGINT) AS cases,
         CAST(max(cumulative_count) FILTER (WHERE indicator = 'cases') AS BIGINT) AS cases_cumulative,
         max(rate) FILTER (WHERE indicator = 'cases') AS cases_notification_rate,
         CAST(max(weekly_count) FILTER (WHERE indicator = 'deaths') AS BIGINT) AS deaths,
         CAST(max(cumulative_count) FILTER (WHERE indicator = 'deaths') AS BIGINT) AS deaths_cumulative,
         max(rate) FILTER (WHERE indicator = 'deaths') AS deaths_notification_rate
  FROM wk2 GROUP BY year_week, k, r_name, population
)"""

ORACLE_SQL.update(
    {
        "d2_cases_weekly": f"""
WITH {_ND_BASE.strip()}
SELECT year_week, week_start_date, CAST(week_start_date + INTERVAL 6 DAY AS DATE) AS week_end_date,
       territory_code, country_code, continent, population, source_name,
       cases, cases_cumulative, cases_notification_rate, deaths, deaths_cumulative, deaths_notification_rate
FROM weekly
""",
        "d2_cases_daily": f"""
WITH {_ND_BASE.strip()},
dd AS (
  SELECT k, r_name, d, count(*) FILTER (WHERE st = 'F') AS nf, count(*) FILTER (WHERE st = 'O') AS nd
  FROM no GROUP BY ALL
),
daily AS (
  SELECT dd.k, dd.r_name, dd.d, pop.population,
         CASE WHEN nf > 0 THEN nf END AS cases, nd AS deaths
  FROM dd JOIN pop USING (k)
),
cum AS (
  SELECT *,
         CASE WHEN cases IS NOT NULL THEN sum(cases) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING) END AS cases_cumulative,
         sum(deaths) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING) AS deaths_cumulative
  FROM daily
)
SELECT c.d AS date, concat('T', lpad(CAST(c.k AS VARCHAR), 2, '0')) AS territory_code, concat('C', c.k) AS country_code,
       c.r_name AS continent, CAST(c.population AS BIGINT) AS population,
       'Ministries of Health or National Public Health Institutes' AS source_name,
       CAST(c.cases AS BIGINT) AS cases, CAST(c.cases_cumulative AS BIGINT) AS cases_cumulative,
       CAST(c.deaths AS BIGINT) AS deaths, CAST(c.deaths_cumulative AS BIGINT) AS deaths_cumulative,
       w.week_start_date, CAST(w.week_start_date + INTERVAL 6 DAY AS DATE) AS week_end_date,
       w.cases_notification_rate, w.deaths_notification_rate
FROM cum c JOIN weekly w
  ON w.territory_code = concat('T', lpad(CAST(c.k AS VARCHAR), 2, '0'))
 AND w.week_start_date = CAST(date_trunc('week', c.d) AS DATE)
""",
        "d2_countries": """
SELECT concat('C', n_nationkey) AS country_code, n_name AS country_name,
       concat('T', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS territory_code, r_name AS continent
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey IN (SELECT DISTINCT c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
""",
    }
)

_TARGET_DESCRIPTION = """CASE {g}
         WHEN 'ALL' THEN 'Overall adults (18+)'
         WHEN 'Age<18' THEN 'Overall adolescents and children (0-17 years old)'
         WHEN 'HCW' THEN 'Healthcare workers'
         WHEN 'LTCF' THEN 'Residents in long term care facilities'
         WHEN 'Age0_4' THEN '0-4 years old'
         WHEN 'Age5_9' THEN '5-9 years old'
         WHEN 'Age10_14' THEN '10-14 years old'
         WHEN 'Age15_17' THEN '15-17 years old'
         WHEN 'Age18_24' THEN '18-24 years old'
         WHEN 'Age25_49' THEN '25-49 years old'
         WHEN 'Age50_59' THEN '50-59 years old'
         WHEN 'Age60_69' THEN '60-69 years old'
         WHEN 'Age70_79' THEN '70-79 years old'
         WHEN 'Age80+' THEN '80 years and over'
         ELSE {g} END"""

_VT_BASE = """
vt AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS pos,
         strftime(CAST(l.l_shipdate AS DATE), '%G-W%V') AS year_week,
         CAST(date_trunc('week', CAST(l.l_shipdate AS DATE)) AS DATE) AS week_start_date,
         concat('C', s.s_nationkey) AS country_code,
         CASE WHEN l.l_linenumber <= 2 THEN concat('C', s.s_nationkey)
              ELSE concat('C', s.s_nationkey, '-R', l.l_linenumber % 3) END AS region_code,
         CASE p.p_size % 5 WHEN 0 THEN 'ALL'
              WHEN 1 THEN concat('Age', (p.p_size // 10) * 10, '_', (p.p_size // 10) * 10 + 9)
              WHEN 2 THEN 'Age<18' WHEN 3 THEN 'Age80+' ELSE '1_Age60+' END AS target_group,
         p.p_brand AS vaccine_code,
         CAST(l.l_quantity AS BIGINT) AS first_dose,
         CASE WHEN l.l_tax > 0.05 THEN 'yes' END AS first_dose_refused,
         coalesce(CASE WHEN l.l_returnflag <> 'R' THEN CAST(l.l_quantity AS BIGINT) - 1 END, 0) AS second_dose,
         CAST(l.l_linenumber AS BIGINT) AS additional_dose_1,
         CAST(CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS unknown_dose,
         coalesce(CAST(trunc(TRY_CAST(CASE WHEN l.l_discount = 0 THEN 'n/a'
                                           ELSE CAST(CAST(l.l_quantity AS BIGINT) * 10 AS VARCHAR) END AS DOUBLE)) AS BIGINT), 0) AS doses_received,
         coalesce(CAST(trunc(TRY_CAST(concat(l.l_linenumber, '.0') AS DOUBLE)) AS BIGINT), 0) AS doses_exported,
         CAST(s.s_nationkey + 1000 AS BIGINT) AS population,
         coalesce(CAST(trunc(TRY_CAST(CASE WHEN l.l_discount > 0.08 THEN 'bad' ELSE '900' END AS DOUBLE)) AS BIGINT), 0) AS denominator
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
)"""

_AGE_BODY = "CASE WHEN starts_with({g}, 'Age') THEN substring({g}, 4) WHEN starts_with({g}, '1_Age') THEN substring({g}, 6) END"


def _age_lower(g: str) -> str:
    b = _AGE_BODY.format(g=g)
    return (
        f"CAST(CASE WHEN {b} LIKE '%\\_%' ESCAPE '\\' THEN TRY_CAST(split_part({b}, '_', 1) AS INTEGER) "
        f"WHEN {b} LIKE '%<%' THEN 0 WHEN {b} LIKE '%+%' THEN TRY_CAST(replace({b}, '+', '') AS INTEGER) ELSE 0 END AS INTEGER)"
    )


def _age_upper(g: str) -> str:
    b = _AGE_BODY.format(g=g)
    return (
        f"CAST(CASE WHEN {b} LIKE '%\\_%' ESCAPE '\\' THEN TRY_CAST(split_part({b}, '_', 2) AS INTEGER) "
        f"WHEN {b} LIKE '%<%' THEN TRY_CAST(replace({b}, '<', '') AS INTEGER) WHEN {b} LIKE '%+%' THEN 200 ELSE 200 END AS INTEGER)"
    )


ORACLE_SQL.update(
    {
        "d3_vaccine_country": f"""
WITH {_VT_BASE.strip()}
SELECT country_code, target_group, vaccine_code, first_dose, first_dose_refused, second_dose,
       additional_dose_1, unknown_dose, doses_received, doses_exported, population, denominator,
       {_TARGET_DESCRIPTION.format(g="target_group")} AS target_description,
       week_start_date, CAST(week_start_date + INTERVAL 6 DAY AS DATE) AS week_end_date
FROM vt WHERE region_code = country_code
""",
        "d3_target_groups": f"""
WITH {_VT_BASE.strip()}
SELECT DISTINCT target_group, {_age_lower("target_group")} AS age_lower_limit, {_age_upper("target_group")} AS age_upper_limit,
       {_TARGET_DESCRIPTION.format(g="target_group")} AS target_description
FROM vt
""",
        "d3_regions": f"""
WITH {_VT_BASE.strip()}
SELECT DISTINCT region_code FROM vt WHERE region_code <> country_code
""",
    }
)

_MI_BASE = """
no AS (
  SELECT n.n_nationkey AS k, n.n_name, r.r_name, o.o_orderstatus AS st,
         CAST(date_trunc('week', CAST(o.o_orderdate AS DATE)) AS DATE) AS ws
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
wk AS (SELECT k, n_name, r_name, ws, count(*) AS n, count(*) FILTER (WHERE st = 'F') AS nf FROM no GROUP BY ALL),
m AS (
  SELECT k, substring(r_name, 1, 2) AS country_code, concat('N', k) AS region_code, ws AS week_start_date,
         CAST(ws + INTERVAL 6 DAY AS DATE) AS week_end_date, CAST(weekofyear(ws) AS INTEGER) AS week,
         lower(coalesce(CASE WHEN n >= 8 THEN 'Dark Red' WHEN n >= 5 THEN 'Red' WHEN n >= 3 THEN 'Orange'
                             WHEN n >= 2 THEN 'Green' END,
                        CASE WHEN nf >= 1 THEN 'Purple' END)) AS colour_name,
         CASE WHEN k % 2 = 0 THEN CAST(n AS DOUBLE) * 10 END AS national_notification_rate,
         CASE WHEN k % 2 <> 0 THEN CAST(n AS DOUBLE) * 10 END AS regional_notification_rate,
         CASE WHEN n > 5 THEN CAST(nf AS DOUBLE) END AS national_vaccination_rate,
         CASE WHEN n <= 5 THEN CAST(nf AS DOUBLE) END AS regional_vaccination_rate,
         CAST(NULL AS DOUBLE) AS national_testing_rate,
         CAST(n AS DOUBLE) * 2 AS regional_testing_rate,
         CASE WHEN nf > 1 THEN CAST(nf AS DOUBLE) * 0.5 END AS regional_positivity_rate,
         CAST(nf AS DOUBLE) * 0.5 AS positivity_rate_combined,
         CAST(n AS DOUBLE) * 4 AS testing_rate_combined,
         n AS national_cases_7,
         CAST(k + 1000 AS BIGINT) AS national_population,
         CAST(k AS BIGINT) * 100000 + (ws - DATE '1970-01-01') AS pos
  FROM wk
)"""

ORACLE_SQL.update(
    {
        "d1_movement_region": f"""
WITH {_MI_BASE.strip()}
SELECT country_code, colour_name, week, week_start_date, week_end_date, region_code,
       regional_notification_rate AS notification_rate, regional_vaccination_rate AS vaccination_rate,
       regional_testing_rate AS testing_rate, regional_positivity_rate AS positivity_rate,
       positivity_rate_combined, testing_rate_combined
FROM m
""",
        "d1_movement_country": f"""
WITH {_MI_BASE.strip()},
j AS (
  SELECT m.*, m.national_cases_7 + coalesce(p.national_cases_7, 0) AS national_cases_14
  FROM m LEFT JOIN m p ON p.country_code = m.country_code AND p.region_code = m.region_code
   AND p.week_start_date + INTERVAL 7 DAY = m.week_start_date
),
f AS (SELECT *, row_number() OVER (PARTITION BY country_code, week_start_date ORDER BY pos) AS rn FROM j)
SELECT country_code, colour_name, week, week_start_date, week_end_date,
       national_notification_rate AS notification_rate, national_vaccination_rate AS vaccination_rate,
       national_cases_7 AS new_cases_last_7days, national_cases_14 AS new_cases_last_14days,
       national_population AS population, national_testing_rate AS testing_rate
FROM f WHERE rn = 1
""",
        "d1_status": f"""
WITH {_MI_BASE.strip()}
SELECT DISTINCT colour_name,
       CASE colour_name
         WHEN 'green' THEN 'Weighted rate is less than 40'
         WHEN 'orange' THEN 'Weighted rate is less than 100 but 40 or more'
         WHEN 'red' THEN 'Weighted rate is less than 300 but 100 or more'
         WHEN 'dark red' THEN 'Weighted rate is 300 or more'
         WHEN 'dark grey' THEN 'Testing rate is 600 or less'
         WHEN 'grey' THEN 'Insufficient data is available'
         WHEN 'grey - no data' THEN 'no data'
         ELSE colour_name END AS colour_description
FROM m
""",
    }
)

ORACLE_SQL.update(
    {
        "n1_cases_star": f"""
WITH {_ND_BASE.strip()},
pc AS (
  SELECT continent, country_code, week_start_date,
         CAST(sum(coalesce(cases, 0)) AS BIGINT) AS cases, CAST(sum(coalesce(deaths, 0)) AS BIGINT) AS deaths
  FROM weekly GROUP BY ALL
)
SELECT continent, week_start_date, country_code, cases, deaths,
       CAST(sum(cases) OVER (PARTITION BY continent, week_start_date) AS BIGINT) AS continent_cases,
       CAST(sum(deaths) OVER (PARTITION BY continent, week_start_date) AS BIGINT) AS continent_deaths
FROM pc
""",
        "n2_doses_star": f"""
WITH {_VT_BASE.strip()}
SELECT target_group, {_age_lower("target_group")} AS age_lower_limit, {_age_upper("target_group")} AS age_upper_limit,
       vaccine_code,
       CAST(sum(first_dose) AS BIGINT) AS first_dose, CAST(sum(second_dose) AS BIGINT) AS second_dose,
       CAST(sum(additional_dose_1) AS BIGINT) AS additional_doses, CAST(sum(unknown_dose) AS BIGINT) AS unknown_dose
FROM (SELECT * FROM vt WHERE region_code = country_code
      QUALIFY row_number() OVER (PARTITION BY week_start_date, country_code, vaccine_code, target_group ORDER BY pos) = 1)
GROUP BY ALL
""",
        "n3_status_star": f"""
WITH {_MI_BASE.strip()}
SELECT week_start_date, coalesce(colour_name, '-unknown-') AS colour_name, count(DISTINCT region_code) AS n_regions
FROM m GROUP BY ALL
""",
        "n4_testing_star": f"""
WITH {_MI_BASE.strip()},
j AS (
  SELECT m.*, row_number() OVER (PARTITION BY country_code, week_start_date ORDER BY pos) AS rn FROM m
),
nat AS (
  SELECT country_code, week_start_date, coalesce(national_testing_rate, 0.0) AS national_testing_rate,
         CAST(NULL AS DOUBLE) AS national_positivity_rate
  FROM j WHERE rn = 1
),
reg AS (
  SELECT country_code, week_start_date,
         avg(coalesce(regional_testing_rate, 0.0)) AS regional_testing_rate,
         avg(coalesce(regional_positivity_rate, 0.0)) AS regional_positivity_rate,
         count(*) AS n_regions
  FROM m GROUP BY ALL
)
SELECT coalesce(nat.country_code, reg.country_code) AS country_code,
       coalesce(nat.week_start_date, reg.week_start_date) AS week_start_date,
       nat.national_testing_rate, nat.national_positivity_rate,
       reg.regional_testing_rate, reg.regional_positivity_rate, reg.n_regions
FROM nat FULL OUTER JOIN reg ON nat.country_code = reg.country_code AND nat.week_start_date = reg.week_start_date
""",
    }
)

ORACLE_SQL["t1_incremental_upsert"] = """
SELECT o_custkey, count(*) AS n_orders,
       min(CAST(o_orderdate AS DATE)) AS first_order_date, max(CAST(o_orderdate AS DATE)) AS last_order_date,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS open_orders
FROM orders GROUP BY o_custkey
"""

ORACLE_SQL["j4_interval_join"] = """
WITH m AS (
  SELECT s.s_nationkey AS nationkey, CAST(date_trunc('month', CAST(l.l_shipdate AS DATE)) AS DATE) AS month_start,
         CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS month_qty
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY ALL
),
p AS (
  SELECT o.o_orderkey, c.c_nationkey AS nationkey, CAST(o.o_orderdate AS DATE) AS order_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)
SELECT p.o_orderkey, p.nationkey, p.order_date, m.month_start, CAST(last_day(m.month_start) AS DATE) AS month_end, m.month_qty
FROM p JOIN m ON p.nationkey = m.nationkey AND p.order_date BETWEEN m.month_start AND last_day(m.month_start)
"""

# the segment-blocking path must return exactly what the length-window path returns
ORACLE_SQL["j2_fuzzy_segments"] = ORACLE_SQL["j2_fuzzy"]

# every pair of the names and the lookup is scored in all forms; the library meets candidates only
_RATIO = "(CASE WHEN {n} = 0 THEN 100 ELSE (200 * ({n} - {d}) + {n}) // (2 * {n}) END)"
ORACLE_SQL["j2_all_forms"] = f"""
WITH lk AS (
  SELECT lower(p_name || ' ' || p_type) AS b, min(p_partkey) AS pos FROM part GROUP BY b),
names AS (
  SELECT DISTINCT CASE p_partkey % 3
    WHEN 0 THEN p_type || ' ' || replace(p_brand, '#', ' ') || ' ' || p_name
    WHEN 1 THEN 'a ' || p_name || ' of the old ' || p_type
    ELSE substring(p_name, 2, 100) || 's' || p_type || ' and others' END AS name FROM part),
pairs AS (
  SELECT name, lower(name) AS a, b, pos, list_distinct(string_split(lower(name), ' ')) AS ta, list_distinct(string_split(b, ' ')) AS tb,
    least(length(lower(name)), length(b)) AS m, greatest(length(lower(name)), length(b)) AS n
  FROM names, lk),
forms AS (
  SELECT *, {_RATIO.format(n="n", d="levenshtein(a, b)")} AS plain,
    (95 * {_RATIO.format(n="n", d="levenshtein(array_to_string(list_sort(string_split(a, ' ')), ' '), array_to_string(list_sort(string_split(b, ' ')), ' '))")} + 50) // 100 AS sorted,
    length(array_to_string(list_intersect(ta, tb), ' ')) AS common, least(length(array_to_string(ta, ' ')), length(array_to_string(tb, ' '))) AS shorter,
    CASE WHEN m >= 4 AND 2 * n >= 3 * m THEN list_min(list_transform(range(1, n - m + 2), lambda i:
      levenshtein(CASE WHEN length(a) <= length(b) THEN a ELSE b END, substring(CASE WHEN length(a) <= length(b) THEN b ELSE a END, i, m)))) END AS off
  FROM pairs),
scored AS (
  SELECT name, b, pos, greatest(plain, sorted, (95 * ((200 * common + shorter) // (2 * shorter)) + 50) // 100,
    CASE WHEN off IS NULL THEN 0 ELSE ((CASE WHEN n > 8 * m THEN 60 ELSE 90 END) * {_RATIO.format(n="m", d="off")} + 50) // 100 END) AS score
  FROM forms)
SELECT name, b AS match_name, score::INTEGER AS match_score, pos::VARCHAR AS code FROM scored
QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, pos) = 1 AND score >= 75
"""

ORACLE_SQL.update(
    {
        "a2_distinct": "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders",
        "f5_previous_week": """
WITH w AS (SELECT CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS week_start_date, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT w.week_start_date, CAST(w.week_start_date - INTERVAL 7 DAY AS DATE) AS previous_start_date, w.n_orders, coalesce(p.n_orders, 0) AS n_previous
FROM w LEFT JOIN w p ON p.week_start_date = w.week_start_date - INTERVAL 7 DAY
""",
        "s4_lookup_csv": """
SELECT c_name AS "Name", CASE WHEN c_mktsegment = 'BUILDING' THEN 'NA' ELSE substr(c_mktsegment, 1, 2) END AS "Code" FROM customer
""",
        "s7_round_trip": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
        "h9_snapshots": """
SELECT seen, o_orderkey, o_custkey FROM orders, (VALUES ('during', true), ('first', true), ('after', false)) s(seen, open_orders)
WHERE (o_orderstatus = 'O') = open_orders
""",
        # the loaded warehouse answers as the assembled star does
        "n2_loaded_star": ORACLE_SQL["n2_doses_star"],
        "n3_loaded_star": ORACLE_SQL["n3_status_star"],
    }
)
