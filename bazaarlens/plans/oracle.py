"""The registered queries as ANSI SQL for DuckDB, written from their definitions."""

from __future__ import annotations

from bazaarlens.plans.marketplace import TABLE_NAMES
from bazaarlens.plans.registry import (
    BUYER_CATEGORY,
    BUYER_WINDOW,
    CATEGORY_RATE,
    CATEGORY_WINDOW,
    LOOKUP_ORDER_ID,
    LOW_CATEGORY_RATE,
    PREVIEW_ROWS,
    REJECTED_UNITS,
)

_UNITS = "CAST(2 * l_quantity * l_quantity - 2 AS BIGINT)"

_PLACED_LINES = """
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""

_PRICING = f"""
pricing AS (
  SELECT r_name AS region, l_partkey AS item_id, l_partkey * 1000 + l_suppkey AS model_id,
    CASE WHEN l_discount <= 0.05 THEN {_UNITS} ELSE 0 END AS units,
    CASE WHEN l_returnflag = 'A' THEN 'OWN < REF'
         WHEN l_returnflag = 'N' THEN 'OWN = REF'
         WHEN l_linestatus = 'F' THEN 'OWN > REF' END AS status
  {_PLACED_LINES}
)"""

_OFFERS = """
offers AS (
  SELECT l_partkey AS item_id, l_partkey * 1000 + l_suppkey AS model_id,
    CASE WHEN l_returnflag = 'A' THEN 'OWN < REF'
         WHEN l_returnflag = 'N' THEN 'OWN = REF'
         WHEN l_linestatus = 'F' THEN 'OWN > REF' END AS status
  FROM lineitem
)"""

_ORDER_LINES = """
order_lines AS (SELECT l_orderkey AS order_id, l_suppkey AS item_id FROM lineitem)"""

_PLATFORM = f"""
platform AS (
  SELECT r_name AS region, CAST(sum({_UNITS}) AS BIGINT) AS platform_order
  {_PLACED_LINES} GROUP BY r_name
)"""

_PLATFORM_BY_NATION = f"""
platform AS (
  SELECT r_name AS region, CAST(sum({_UNITS}) AS BIGINT) AS platform_order
  {_PLACED_LINES} GROUP BY r_name, n_name
)"""

_ORDER_ITEM = """
order_item AS (
  SELECT o_custkey AS buyer_id, o_orderdate AS create_datetime, p_type AS cluster
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
)"""

_FIRST_PURCHASE = """
first_purchase AS (
  SELECT o_custkey AS buyer_id, min(o_orderdate) AS first_purchase_time
  FROM orders GROUP BY o_custkey
)"""

_ORDER_ITEMS = """
order_items AS (
  SELECT l_orderkey AS order_id, l_suppkey AS item_id, o_orderdate AS create_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_ITEM_CATEGORY = """
item_category AS (
  SELECT s_suppkey AS item_id, n_name AS cluster
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

_DAILY = f"""
daily AS (
  SELECT CAST(first_purchase_time AS DATE) AS create_date,
    count(*) AS num_of_first_purchase_buyers
  FROM first_purchase f LEFT JOIN order_item o ON f.buyer_id = o.buyer_id
  WHERE CAST(first_purchase_time AS DATE)
      BETWEEN DATE '{BUYER_WINDOW[0]}' AND DATE '{BUYER_WINDOW[1]}'
    AND CAST(create_datetime AS DATE)
      BETWEEN DATE '{BUYER_WINDOW[0]}' AND DATE '{BUYER_WINDOW[1]}'
    AND cluster = '{BUYER_CATEGORY}'
  GROUP BY CAST(first_purchase_time AS DATE)
)"""

_CATEGORISED = f"""
categorised AS (
  SELECT o.order_id, o.item_id, CAST(o.create_timestamp AS DATE) AS create_date, c.cluster
  FROM order_items o LEFT JOIN item_category c ON o.item_id = c.item_id
  WHERE CAST(o.create_timestamp AS DATE)
    BETWEEN DATE '{CATEGORY_WINDOW[0]}' AND DATE '{CATEGORY_WINDOW[1]}'
)"""

_RATES = """
item_counts AS (
  SELECT cluster, item_id, count(DISTINCT order_id) AS total_item_per_cluster
  FROM categorised GROUP BY cluster, item_id
),
cluster_counts AS (
  SELECT cluster, count(DISTINCT order_id) AS total_order_per_cluster
  FROM categorised GROUP BY cluster
),
rates AS (
  SELECT i.cluster, i.item_id, i.total_item_per_cluster, c.total_order_per_cluster,
    CAST(i.total_item_per_cluster AS DOUBLE) / nullif(c.total_order_per_cluster, 0)
      AS contribution_rate
  FROM item_counts i LEFT JOIN cluster_counts c ON i.cluster = c.cluster
)"""

# Status counts, each joined to the count of all models.
_NET = """
models AS (SELECT region, count(model_id) AS n FROM pricing GROUP BY region),
statuses AS (SELECT region, status, count(model_id) AS n FROM pricing GROUP BY region, status),
net AS (
  SELECT m.region,
    format('{:,.6f}', CAST(win.n - lose.n AS DOUBLE) / nullif(m.n, 0)) AS net_competitiveness
  FROM models m
  LEFT JOIN (SELECT * FROM statuses WHERE status = 'OWN > REF') lose ON m.region = lose.region
  LEFT JOIN (SELECT * FROM statuses WHERE status = 'OWN < REF') win ON m.region = win.region
)"""

_COVERAGE = """
format('{:,.6f}', CAST(t.sum_units AS DOUBLE) / nullif(p.platform_order, 0))
  AS order_coverage_by_region"""

_SUMS = """
sums AS (
  SELECT region, item_id, model_id, CAST(sum(units) AS BIGINT) AS sum_units
  FROM pricing GROUP BY region, item_id, model_id
)"""

# One row per model and lookup row of its region: share, threshold and rank.
_RANKED = """
shares AS (
  SELECT s.*, p.platform_order,
    format('{:,.10f}', CAST(sum_units AS DOUBLE) / nullif(platform_order, 0))
      AS contribute_ratio,
    format('{:,.0f}', CAST(sum_units AS DOUBLE) * CAST(0.3 AS DOUBLE)) AS order_threshold
  FROM sums s LEFT JOIN platform p ON s.region = p.region
),
ranked AS (
  SELECT *, CAST(row_number() OVER (
      PARTITION BY region, item_id, model_id
      ORDER BY contribute_ratio DIRECTION, platform_order DIRECTION) AS INTEGER)
    AS contribution_rank
  FROM shares
)"""

# The threshold as the number it shows, and as its text parses: not with a comma.
_AS_NUMBER = "contribution_rank <= TRY_CAST(replace(order_threshold, ',', '') AS BIGINT)"
_AS_TEXT = "contribution_rank <= TRY_CAST(order_threshold AS BIGINT)"

_PRIORITIES = """
priorities AS (
  SELECT *, min(new_cpt_status) OVER (PARTITION BY item_id, model_id) AS priority
  FROM (
    SELECT item_id, model_id, status,
      CASE status WHEN 'OWN < REF' THEN 1 WHEN 'OWN = REF' THEN 2 WHEN 'OWN > REF' THEN 3
        ELSE 4 END AS new_cpt_status
    FROM offers)
)"""


def _contribution(condition: str) -> str:
    return f"""
WITH {_ORDER_ITEMS}, {_ITEM_CATEGORY}, {_CATEGORISED}, {_RATES}
SELECT item_id, cluster FROM (
  SELECT *, rank() OVER (PARTITION BY cluster ORDER BY contribution_rate DESC)
    AS contribution_rank FROM rates)
WHERE contribution_rate {condition}
ORDER BY cluster, contribution_rank DESC"""


def _coverage(platform: str) -> str:
    return f"""
WITH {_PRICING}, {platform},
totals AS (SELECT region, sum(units) AS sum_units FROM pricing GROUP BY region)
SELECT t.region, {_COVERAGE}
FROM totals t LEFT JOIN platform p ON t.region = p.region"""


def _ranks(platform: str, direction: str = "DESC") -> str:
    return f"WITH {_PRICING}, {platform}, {_SUMS}, {_RANKED.replace('DIRECTION', direction)}"


def _item_count(condition: str) -> str:
    return f"""
{_ranks(_PLATFORM)}
SELECT region, count(DISTINCT item_id) AS number_of_item_tops_30
FROM ranked WHERE {condition} GROUP BY region"""


def _ranked(platform: str, direction: str) -> str:
    return f"""
{_ranks(platform, direction)}
SELECT * FROM ranked WHERE {_AS_NUMBER}"""


def _flag(platform: str) -> str:
    return f"""
{_ranks(platform)},
top AS (SELECT region, item_id, model_id FROM ranked WHERE {_AS_NUMBER})
SELECT r.region, r.item_id, r.model_id, r.units, r.status,
  CASE WHEN t.region IS NULL THEN 0 ELSE 1 END AS is_top_30_model
FROM pricing r LEFT JOIN top t
  ON r.region = t.region AND r.item_id = t.item_id AND r.model_id = t.model_id"""


ORACLE_SQL: dict[str, str] = {
    "duplicate_keys": """
SELECT o_custkey, count(*) AS count_duplicated FROM orders
GROUP BY o_custkey HAVING count(*) > 1 ORDER BY o_custkey""",
    "first_purchase_daily": f"""
WITH {_FIRST_PURCHASE}, {_ORDER_ITEM}, {_DAILY}
SELECT * FROM daily ORDER BY create_date""",
    "first_purchase_daily_filled": f"""
WITH {_FIRST_PURCHASE}, {_ORDER_ITEM}, {_DAILY},
spine AS (
  SELECT CAST(day AS DATE) AS create_date
  FROM generate_series(DATE '{BUYER_WINDOW[0]}', DATE '{BUYER_WINDOW[1]}', INTERVAL 1 DAY)
    AS s(day)
)
SELECT s.create_date,
  coalesce(d.num_of_first_purchase_buyers, 0) AS num_of_first_purchase_buyers
FROM spine s LEFT JOIN daily d ON s.create_date = d.create_date ORDER BY s.create_date""",
    "categorised_orders": f"""
WITH {_ORDER_ITEMS}, {_ITEM_CATEGORY}, {_CATEGORISED} SELECT * FROM categorised""",
    "category_contribution": _contribution(f"> {CATEGORY_RATE}"),
    "category_contribution_inclusive": _contribution(f">= {CATEGORY_RATE}"),
    "category_contribution_low_rate": _contribution(f"> {LOW_CATEGORY_RATE}"),
    "category_rates": f"""
WITH {_ORDER_ITEMS}, {_ITEM_CATEGORY}, {_CATEGORISED}, {_RATES}
SELECT *, CAST(rank() OVER (PARTITION BY cluster ORDER BY contribution_rate DESC) AS INTEGER)
  AS contribution_rank FROM rates""",
    "order_coverage": _coverage(_PLATFORM),
    "order_coverage_repeated_region": _coverage(_PLATFORM_BY_NATION),
    "item_count_by_region": f"""
WITH {_PRICING}
SELECT region, count(item_id) AS number_of_item_by_region FROM pricing GROUP BY region""",
    "status_count_by_region": f"""
WITH {_PRICING}
SELECT region, status, count(model_id) AS number_of_models FROM pricing
GROUP BY region, status""",
    "net_competitiveness": f"""
WITH {_PRICING}, {_NET} SELECT * FROM net""",
    "regional_scorecard": f"""
WITH {_PRICING}, {_PLATFORM}, {_NET},
totals AS (SELECT region, sum(units) AS sum_units FROM pricing GROUP BY region),
items AS (
  SELECT region, count(item_id) AS number_of_item_by_region FROM pricing GROUP BY region)
SELECT t.region, {_COVERAGE}, n.net_competitiveness, i.number_of_item_by_region
FROM totals t LEFT JOIN platform p ON t.region = p.region
LEFT JOIN net n ON t.region = n.region LEFT JOIN items i ON t.region = i.region""",
    "rejected_prices": f"""
WITH {_PRICING}
SELECT region, count(*) AS row_count, CAST(sum(units) AS BIGINT) AS units,
  CAST(NULL AS VARCHAR) AS rejected_columns
FROM pricing WHERE units <= {REJECTED_UNITS} GROUP BY region
UNION ALL
SELECT NULL, count(*), NULL, 'units' FROM pricing WHERE units > {REJECTED_UNITS} HAVING count(*) > 0""",
    "status_priorities": f"WITH {_OFFERS}, {_PRIORITIES} SELECT * FROM priorities",
    "priority_status": f"""
WITH {_OFFERS}, {_PRIORITIES}
SELECT item_id, model_id, status FROM priorities WHERE new_cpt_status = priority""",
    "top30_item_count": _item_count(_AS_NUMBER),
    "top30_item_count_strict": _item_count(_AS_NUMBER),
    "top30_item_count_text": _item_count(_AS_TEXT),
    "top30_ranked_models": _ranked(_PLATFORM, "DESC"),
    "top30_ranked_models_repeated_region": _ranked(_PLATFORM_BY_NATION, "DESC"),
    "top30_ranked_models_ascending": _ranked(_PLATFORM_BY_NATION, "ASC"),
    "top30_model_flag": _flag(_PLATFORM),
    "top30_model_flag_repeated_region": _flag(_PLATFORM_BY_NATION),
    "published_flags": f"""
SELECT region, is_top_30_model, count(*) AS row_count, CAST(sum(units) AS BIGINT) AS units
FROM ({_flag(_PLATFORM)}) GROUP BY region, is_top_30_model""",
    "stored_flags": f"""
SELECT region, is_top_30_model, count(*) AS row_count, CAST(sum(units) AS BIGINT) AS units,
  CAST(max(model_units) AS BIGINT) AS largest_model_units
FROM (
  SELECT *, sum(units) OVER (PARTITION BY region, item_id, model_id) AS model_units
  FROM ({_flag(_PLATFORM)}))
GROUP BY region, is_top_30_model""",
    "distinct_orders": f"""
WITH {_ORDER_LINES} SELECT count(DISTINCT order_id) AS distinct_orders FROM order_lines""",
    "distinct_order_items": f"""
WITH {_ORDER_LINES}
SELECT count(DISTINCT (order_id, item_id))
  FILTER (WHERE order_id IS NOT NULL AND item_id IS NOT NULL) AS distinct_order_items
FROM order_lines""",
    "distinct_items": f"""
WITH {_ORDER_LINES} SELECT count(DISTINCT item_id) AS distinct_items FROM order_lines""",
    "distinct_items_by_region": f"""
WITH {_PRICING}
SELECT region, count(DISTINCT item_id) AS distinct_items FROM pricing GROUP BY region""",
    "distinct_item_statuses": f"""
WITH {_OFFERS}
SELECT count(DISTINCT (item_id, status))
  FILTER (WHERE item_id IS NOT NULL AND status IS NOT NULL) AS distinct_item_statuses
FROM offers""",
    "order_item_multiplicity": f"""
WITH {_ORDER_LINES}
SELECT order_id, item_id, count(*) AS row_count FROM order_lines
GROUP BY order_id, item_id ORDER BY item_id""",
    "order_lookup": f"""
WITH {_ORDER_ITEMS} SELECT * FROM order_items WHERE order_id = {LOOKUP_ORDER_ID}""",
    "table_preview": f"""
SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT {PREVIEW_ROWS}""",
    "list_tables": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
        for name in TABLE_NAMES
    ),
}

# Written as CSV and read back, it is the same table.
ORACLE_SQL["scorecard_from_csv"] = ORACLE_SQL["regional_scorecard"]
