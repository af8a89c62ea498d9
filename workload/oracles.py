"""SQL counterparts of the registered queries, for an independent engine."""

from __future__ import annotations

import math

from supplycast.functions.geo import EARTH_RADIUS_KM
from supplycast.functions.stats import normal_quantile
from supplycast.operators.cluster import FEATURES
from supplycast.operators.kpi import KPI_COLUMNS
from workload.queries import CENTRES, DAYS_VALID, MONTHS_VALID, SHORT_VALID

ORACLES: dict[str, str] = {}


def q4(x: str) -> str:
    return f"floor(({x}) * 10000 + 0.4863) / 10000"


def iso(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def pearson(x: str, y: str, over: str = "") -> str:
    return (
        f"covar_pop({x}, {y}) {over} / "
        f"nullif(stddev_pop({x}) {over} * stddev_pop({y}) {over}, 0)"
    )


def query(name: str, ctes: list[str], body: str) -> None:
    """Register ``WITH ctes body``; a recursive keyword is harmless where unused."""
    head = "WITH RECURSIVE " + ",\n".join(ctes) + "\n" if ctes else ""
    ORACLES[name] = head + body


# -- shared inputs --------------------------------------------------------------------------

ORDERS = """
ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE o_orderstatus END AS status,
    CAST(o_orderdate AS DATE) AS dt_purchase,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER) AS dt_approved,
    CAST(o_orderdate AS DATE) + 10 AS dt_limit,
    CAST(o_orderdate AS DATE) + 60 AS dt_estimated,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score
  FROM orders)"""

ITEMS = """
itm AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    l_suppkey AS seller_id, l_extendedprice AS price,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS money,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DOUBLE)
      AS freight_value,
    CAST(l_shipdate AS DATE) AS dt_shipped,
    CAST(l_shipdate AS DATE) + CAST(3 + (l_orderkey + l_partkey) % 20 AS INTEGER) AS dt_delivered,
    CASE WHEN l_suppkey % 10 <> 9 THEN CAST(1 + l_suppkey % 3 AS VARCHAR) END AS cluster
  FROM lineitem)"""

PRODUCTS = """
prod AS (
  SELECT p_partkey AS product_id, CASE WHEN p_size % 17 = 0 THEN NULL ELSE p_type END AS category
  FROM part)"""

ITEM_ORDERS = """
io AS (SELECT itm.*, ord.* EXCLUDE (order_id) FROM itm JOIN ord ON itm.order_id = ord.order_id)"""

LOGISTICS = """
feat AS (
  SELECT *, datediff('day', dt_purchase, dt_estimated) AS est_delivery_days,
    datediff('day', dt_approved, dt_delivered) AS days_to_deliver,
    datediff('day', dt_purchase, dt_approved) AS days_approved,
    datediff('day', dt_approved, dt_shipped) AS days_shipping,
    dt_limit < dt_shipped AS delayed_shipping,
    dt_estimated < dt_delivered AS late_vs_estimate_date,
    est_delivery_days < days_to_deliver AS late_delivery
  FROM io)"""


def haversine(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return (
        f"{2 * EARTH_RADIUS_KM} * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lng2} - {lng1}) / 2), 2))))"
    )


def lat(nation: str) -> str:
    return f"(-60.0::DOUBLE + 5.0::DOUBLE * {nation})"


def lng(nation: str) -> str:
    return f"(-170.0::DOUBLE + 13.0::DOUBLE * {nation})"


PLACES = f"""
placed AS (
  SELECT feat.*, s_nationkey AS seller_zip, c_nationkey AS customer_zip,
    r_name AS customer_region,
    {haversine(lat("s_nationkey"), lng("s_nationkey"), lat("c_nationkey"), lng("c_nationkey"))}
      AS distance
  FROM feat
  LEFT JOIN supplier ON seller_id = s_suppkey
  LEFT JOIN customer ON customer_id = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""

PLACED = [ORDERS, ITEMS, ITEM_ORDERS, LOGISTICS, PLACES]

SHELVES = """
goods AS MATERIALIZED (
  SELECT placed.*, coalesce(category, 'nao_informada') AS shelf
  FROM placed LEFT JOIN prod USING (product_id)),
ord_reach AS (
  SELECT seller_id, shelf, count(order_id) AS orders
  FROM (SELECT DISTINCT seller_id, shelf, order_id FROM goods) GROUP BY ALL),
prod_reach AS (
  SELECT seller_id, shelf, count(product_id) AS products
  FROM (SELECT DISTINCT seller_id, shelf, product_id FROM goods) GROUP BY ALL),
shelf_kpi AS (
  SELECT seller_id, shelf, CAST(sum(money) AS DECIMAL(18,2)) AS earned,
    CAST(earned AS DOUBLE) / count(price) AS ticket, arg_min(price, price) AS cheapest,
    arg_max(price, price) AS dearest, avg(distance) AS way, avg(review_score) AS score,
    avg(days_shipping) AS wait,
    CASE WHEN count(delayed_shipping) > 0 THEN count_if(delayed_shipping) END AS late
  FROM goods GROUP BY ALL),
shelves AS MATERIALIZED (
  SELECT * FROM shelf_kpi JOIN ord_reach USING (seller_id, shelf)
  JOIN prod_reach USING (seller_id, shelf))"""

#: KPI -> how the rows of a seller's shelves make it
FROM_SHELVES = {
    "avg_distance": "avg(way)",
    "avg_price": "avg(ticket)",
    "avg_score": "avg(score)",
    "avg_shipping": "avg(wait)",
    "n_categories": "count(*)",
    "n_orders": "CAST(sum(orders) AS BIGINT)",
    "n_products": "CAST(sum(products) AS BIGINT)",
    "pct_delayed": "CAST(sum(late) AS DOUBLE) / CAST(sum(orders) AS DOUBLE)",
    "price_range": "max(dearest) - min(cheapest)",
    "revenue": "CAST(sum(earned) AS DOUBLE)",
}
_SELLERS = ", ".join(f"{rule} AS {name}" for name, rule in FROM_SHELVES.items())
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in KPI_COLUMNS)
KPIS = f"kpi AS (SELECT * FROM (SELECT seller_id, {_SELLERS} FROM shelves GROUP BY 1) WHERE {_COMPLETE})"
KPI = [*PLACED, PRODUCTS, SHELVES, KPIS]


def facts(keys: str, grain: str = "day", source: str = "io", more: str = "") -> str:
    return f"""
  SELECT CAST(date_trunc('{grain}', dt_purchase) AS DATE) AS ds, {keys},
    CAST(count(order_item_id) AS DOUBLE) AS orders,
    CAST(sum(money) AS DOUBLE) / count(order_id) AS avg_price,
    CAST(sum(money) AS DOUBLE) / count(price) AS mean_price,
    CAST(sum(money) AS DOUBLE) AS revenue {more}
  FROM {source} GROUP BY ALL"""


LABELLED = "lab AS (SELECT * FROM io WHERE cluster IS NOT NULL)"
BASE = [ORDERS, ITEMS, ITEM_ORDERS, LABELLED]
DAILY = f"daily AS ({facts('cluster', source='lab')})"
DENSE = """
dense AS (
  SELECT s.cluster, s.ds, datediff('day', s.lo, s.ds) + 1 AS t, orders, avg_price, revenue
  FROM (
    SELECT cluster, lo, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS ds
    FROM (SELECT DISTINCT cluster FROM daily), (SELECT min(ds) AS lo, max(ds) AS hi FROM daily)
  ) s LEFT JOIN daily USING (cluster, ds))"""
DENSE_DAILY = [*BASE, DAILY, DENSE]

MONTHLY = f"""
monthly AS (
  SELECT cluster, ds, datediff('month', min(ds) OVER (), ds) + 1 AS t, orders AS value
  FROM ({facts('cluster', 'month', 'lab')}))"""
MONTH = [*BASE, MONTHLY]

SPLIT = f"""
parts AS (
  SELECT *, CASE WHEN t > max(t) OVER (PARTITION BY cluster) - {MONTHS_VALID} THEN 'valid'
    ELSE 'train' END AS split
  FROM monthly)"""


def month_spine(start: str | None = None) -> str:
    low = f"DATE '{start}'" if start else "min(ds)"
    return f"""
seller_month AS ({facts('seller_id', 'month', 'io')}),
grid AS (
  SELECT seller_id, lo, unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::DATE AS ds
  FROM (SELECT DISTINCT seller_id FROM seller_month),
       (SELECT {low} AS lo, max(ds) AS hi FROM seller_month)),
full_month AS (
  SELECT seller_id, ds, datediff('month', lo, ds) + 1 AS t, orders, revenue
  FROM grid LEFT JOIN seller_month USING (seller_id, ds))"""


def filled(source: str, name: str, key: str, value: str, keep: str) -> str:
    """Linear interpolation with constant ends, as a CTE with column ``filled``."""
    before = f"PARTITION BY {key} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    after = f"PARTITION BY {key} ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    known = f"CASE WHEN {value} IS NOT NULL THEN t END"
    return f"""
{name}_near AS (
  SELECT *, last_value({value} IGNORE NULLS) OVER ({before}) AS pv,
    last_value({known} IGNORE NULLS) OVER ({before}) AS pt,
    first_value({value} IGNORE NULLS) OVER ({after}) AS nv,
    first_value({known} IGNORE NULLS) OVER ({after}) AS nt
  FROM {source}),
{name} AS (
  SELECT {key}, t, {keep}, {value} IS NULL AS is_imputed,
    CASE WHEN {value} IS NOT NULL THEN {value} WHEN pt IS NULL THEN nv WHEN nt IS NULL THEN pv
      ELSE pv + (nv - pv) * (t - pt) / (nt - pt) END AS filled
  FROM {name}_near)"""


#: the daily series under the name and columns of the monthly one
FILLED_DAILY = [
    *DENSE_DAILY,
    filled("dense", "whole", "cluster", "orders", "ds"),
    "monthly AS MATERIALIZED (SELECT cluster, ds, t, filled AS value FROM whole)",
]


# -- sources and sinks ----------------------------------------------------------------------

query(
    "csv_items",
    [*PLACED, PRODUCTS],
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id,
  CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id, price,
  {iso("dt_purchase")} AS dt_purchase, {iso("dt_approved")} AS dt_approved,
  CAST(days_approved AS DOUBLE) AS days_approved, CAST(days_shipping AS DOUBLE) AS days_shipping,
  delayed_shipping, review_score, {q4("distance")} AS distance, category, cluster
FROM placed LEFT JOIN prod USING (product_id)""",
)
query(
    "csv_daily_series",
    DENSE_DAILY,
    f"SELECT {iso('ds')} AS dates, orders, avg_price, revenue, cluster FROM dense",
)
query(
    "csv_monthly_series",
    BASE,
    f"""SELECT {iso("ds")} AS dates, orders, avg_price, revenue, cluster
FROM ({facts("cluster", "month", "lab")})""",
)
query(
    "series_sink",
    [*BASE, DAILY, f"by_month AS ({facts('cluster', 'month', 'lab')})"],
    f"""SELECT grain, cluster, count(*) AS n, sum(orders) AS orders,
  {iso("min(ds)")} AS first_day, {iso("max(ds)")} AS last_day
FROM (SELECT 'daily' AS grain, * FROM daily UNION ALL SELECT 'monthly', * FROM by_month)
GROUP BY 1, 2""",
)

# -- projections and filters ----------------------------------------------------------------

query(
    "item_projection",
    [*BASE, PRODUCTS],
    f"""SELECT order_id, order_item_id, seller_id, coalesce(category, 'nao_informada') AS category,
  cluster, price, {iso("dt_purchase")} AS order_date,
  {iso("CAST(date_trunc('month', dt_purchase) AS DATE)")} AS month,
  CAST(year(dt_purchase) AS INTEGER) AS year, CAST(month(dt_purchase) AS INTEGER) AS month_number,
  CAST(dayofyear(dt_purchase) AS INTEGER) AS day_of_year, 'cluster ' || cluster AS label
FROM lab LEFT JOIN prod USING (product_id)
WHERE dt_purchase BETWEEN DATE '1997-01-01' AND DATE '1998-08-29'""",
)
query(
    "excluded_items",
    [ORDERS, ITEMS, ITEM_ORDERS],
    """SELECT seller_id, count(*) AS n
FROM (SELECT *, count(*) OVER (PARTITION BY seller_id, dt_purchase) AS k FROM io)
WHERE k < 5 AND price > 0 GROUP BY 1""",
)
query(
    "delivered_scope",
    [ORDERS],
    f"""SELECT order_id, customer_id, status, {iso("dt_purchase")} AS dt_purchase FROM ord
WHERE status = 'delivered' AND dt_purchase >= DATE '1997-01-01'""",
)
query(
    "zscore_series",
    DENSE_DAILY,
    f"""SELECT cluster, {iso("ds")} AS ds,
  {q4("(orders - avg(orders) OVER w) / stddev_samp(orders) OVER w")} AS s_orders,
  {q4("(revenue - avg(revenue) OVER w) / stddev_samp(revenue) OVER w")} AS s_revenue
FROM dense WINDOW w AS (PARTITION BY cluster)""",
)
query(
    "completeness",
    [ORDERS, ITEMS, ITEM_ORDERS, PRODUCTS],
    """SELECT count(*) AS n_before, count(category) AS n_after,
  count(*) - count(category) AS n_removed FROM io LEFT JOIN prod USING (product_id)""",
)

# -- features -------------------------------------------------------------------------------

query(
    "order_features",
    [ORDERS, ITEMS, ITEM_ORDERS, LOGISTICS],
    """SELECT order_id, order_item_id, product_id, seller_id, price, freight_value,
  CAST(est_delivery_days AS INTEGER) AS est_delivery_days,
  CAST(days_to_deliver AS INTEGER) AS days_to_deliver,
  CAST(days_approved AS INTEGER) AS days_approved,
  CAST(days_shipping AS INTEGER) AS days_shipping,
  delayed_shipping, late_delivery, late_vs_estimate_date FROM feat""",
)
query(
    "delivery_distance",
    PLACED,
    f"""SELECT seller_zip, customer_zip, count(*) AS n, {q4("max(distance)")} AS distance
FROM placed GROUP BY 1, 2""",
)
GEO = f"""
geo AS (
  SELECT c_nationkey AS zip, avg({lat("c_nationkey")} + CAST(c_custkey % 7 AS DOUBLE) / 100) AS lat,
    avg({lng("c_nationkey")} - CAST(c_custkey % 7 AS DOUBLE) / 100) AS lng
  FROM customer GROUP BY 1)"""
query("postal_points", [GEO], f"SELECT zip, {q4('lat')} AS lat, {q4('lng')} AS lng FROM geo")
query(
    "assembled_items",
    [ORDERS, ITEMS, ITEM_ORDERS, PRODUCTS, GEO],
    f"""SELECT order_id, order_item_id, product_id, seller_id, customer_id, category, price,
  {iso("dt_shipped")} AS dt_shipped,
  CASE WHEN order_id % 10 = 0 THEN 3.0 ELSE CAST(review_score AS DOUBLE) END AS review_score,
  CAST(CASE WHEN order_id % 10 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_reviews,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * (1 + order_id % 3) AS DOUBLE) AS paid,
  1 + order_id % 3 AS n_payments, s_nationkey AS seller_zip, c_nationkey AS customer_zip,
  {q4(haversine("sg.lat", "sg.lng", "cg.lat", "cg.lng"))} AS distance
FROM io JOIN orders ON order_id = o_orderkey
LEFT JOIN prod USING (product_id)
LEFT JOIN supplier ON seller_id = s_suppkey
LEFT JOIN customer ON customer_id = c_custkey
LEFT JOIN geo sg ON s_nationkey = sg.zip
LEFT JOIN geo cg ON c_nationkey = cg.zip""",
)

# -- joins ----------------------------------------------------------------------------------

query(
    "items_with_category",
    [ITEMS, PRODUCTS],
    """SELECT product_id, order_id, seller_id, price,
  coalesce(category, 'nao_informada') AS category FROM itm LEFT JOIN prod USING (product_id)""",
)
query(
    "items_with_cluster",
    [ITEMS, PRODUCTS],
    """SELECT product_id, seller_id, order_id, price, cluster, category
FROM itm LEFT JOIN prod USING (product_id)""",
)
query(
    "spine_join",
    DENSE_DAILY,
    f"""SELECT cluster, {iso("ds")} AS ds, t, orders, avg_price, revenue, false AS is_padding
FROM dense""",
)
query(
    "merged_metrics",
    [*BASE, DAILY],
    f"SELECT cluster, {iso('ds')} AS ds, orders, avg_price, revenue FROM daily",
)


def trailing(order: int) -> str:
    frame = f"(PARTITION BY cluster ORDER BY t ROWS BETWEEN {order} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(value) OVER {frame} = {order} THEN avg(value) OVER {frame} END"


query(
    "forecast_vs_actual",
    MONTH,
    f"""SELECT cluster, t, {iso("ds")} AS ds, {q4("f")} AS forecast, value AS actual
FROM (SELECT *, {trailing(3)} AS f FROM monthly) WHERE f IS NOT NULL""",
)

# -- aggregations ---------------------------------------------------------------------------

query(
    "seller_category_kpis",
    [*PLACED, PRODUCTS, SHELVES],
    f"""SELECT seller_id, shelf AS category, orders, products, CAST(earned AS DOUBLE) AS revenue,
  {q4("ticket")} AS mean_price, cheapest, dearest, dearest - cheapest AS price_span, {q4("wait")} AS avg_shipping,
  {q4("score")} AS avg_score, {q4("way")} AS avg_distance, late FROM shelves""",
)
query(
    "seller_kpis",
    KPI,
    f"""SELECT seller_id, n_orders, n_products, n_categories, {q4("avg_price")} AS avg_price,
  revenue, {q4("price_range")} AS price_range, {q4("avg_shipping")} AS avg_shipping,
  {q4("avg_score")} AS avg_score, {q4("avg_distance")} AS avg_distance,
  {q4("pct_delayed")} AS pct_delayed FROM kpi""",
)
query(
    "daily_facts",
    BASE,
    f"""SELECT * REPLACE ({iso("ds")} AS ds)
FROM ({facts("cluster", source="lab", more=", count(DISTINCT order_id) AS n_orders")})""",
)
CATEGORISED = """
cat AS (SELECT lab.*, coalesce(category, 'nao_informada') AS category
  FROM lab LEFT JOIN prod USING (product_id))"""
for _name, _grain in (("daily", "day"), ("monthly", "month")):
    query(
        f"{_name}_facts_by_category",
        [*BASE, PRODUCTS, CATEGORISED],
        f"SELECT * REPLACE ({iso('ds')} AS ds) FROM ({facts('cluster, category', _grain, 'cat')})",
    )
query(
    "monthly_rollup",
    [*BASE, DAILY],
    f"""SELECT cluster, {iso("CAST(date_trunc('month', ds) AS DATE)")} AS ds,
  sum(orders) AS orders, {q4("sum(avg_price)")} AS avg_price_sum,
  {q4("avg(avg_price)")} AS avg_price_mean, {q4("sum(revenue) / sum(orders)")} AS price_ratio,
  {q4("sum(revenue)")} AS revenue FROM daily GROUP BY 1, 2""",
)
query(
    "weekly_apply",
    [*BASE, DAILY],
    f"""SELECT cluster, {iso("CAST(date_trunc('week', ds) AS DATE)")} AS ds,
  sum(orders) AS orders, {q4("avg(avg_price)")} AS avg_price, {q4("sum(revenue)")} AS revenue,
  {iso("max(daily.ds)")} AS last_ds FROM daily GROUP BY cluster, date_trunc('week', daily.ds)""".replace(
        "date_trunc('week', ds)", "date_trunc('week', daily.ds)"
    ),
)
query(
    "monthly_apply",
    [*BASE, DAILY],
    f"""SELECT cluster, {iso("CAST(date_trunc('month', daily.ds) AS DATE)")} AS ds,
  {q4("avg(orders)")} AS orders, {q4("avg(avg_price)")} AS avg_price,
  {q4("avg(revenue)")} AS revenue, {iso("max(daily.ds)")} AS last_ds
FROM daily GROUP BY cluster, date_trunc('month', daily.ds)""",
)
query(
    "orders_by_date",
    [*BASE, DAILY],
    f"SELECT {iso('daily.ds')} AS ds, sum(orders) AS n_orders FROM daily GROUP BY daily.ds",
)


def correlations(columns: list[str], source: str, key: str | None = None) -> str:
    group = f" GROUP BY {key}" if key else ""
    lead = f"{key}, " if key else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{x}' AS x, '{y}' AS y, {q4(pearson(x, y))} AS r FROM {source}{group}"
        for i, x in enumerate(columns)
        for y in columns[i:]
    )


query("kpi_correlation", KPI, correlations(KPI_COLUMNS, "kpi"))
query(
    "series_correlation",
    [*BASE, DAILY],
    correlations(["orders", "avg_price", "revenue"], "daily", "cluster"),
)
query(
    "category_frequency",
    [ORDERS, ITEMS, ITEM_ORDERS, PRODUCTS],
    """SELECT coalesce(category, 'nao_informada') AS category, count(*) AS n,
  count(*) / sum(count(*)) OVER () AS share
FROM io LEFT JOIN prod USING (product_id) GROUP BY 1""",
)
query(
    "status_by_score",
    [ORDERS],
    """SELECT status, review_score, count(*) AS n,
  count(*) / sum(count(*)) OVER (PARTITION BY status) AS row_share FROM ord GROUP BY 1, 2""",
)


def boxes(key: str | None, source: str, columns: list[str], where: str = "true") -> str:
    lead = f"{key}, " if key else ""
    using = f"{lead}metric"
    long = " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM {source} WHERE {where}"
        for c in columns
    )
    return f"""
long AS ({long}),
quart AS (
  SELECT {using}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS q3 FROM long GROUP BY {using}),
box AS (
  SELECT {using}, q1, median, q3, count(*) AS n,
    min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))
      AS whisker_low,
    max(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))
      AS whisker_high,
    count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))
      AS n_outliers
  FROM long JOIN quart USING ({using}) GROUP BY {using}, q1, median, q3)"""


_BOX = ", ".join(f"{q4(c)} AS {c}" for c in ("q1", "median", "q3", "whisker_low", "whisker_high"))
query(
    "kpi_boxstats",
    [
        *KPI,
        """lk AS (SELECT *, CASE WHEN seller_id % 10 <> 9 THEN CAST(1 + seller_id % 3 AS VARCHAR) END
  AS cluster FROM kpi)""",
        boxes(
            "cluster", "lk", ["n_orders", *FEATURES], "cluster IS NOT NULL AND avg_shipping >= 0"
        ),
    ],
    f"SELECT cluster, metric, n, n_outliers, {_BOX} FROM box",
)

# -- audits ---------------------------------------------------------------------------------

_ENTITIES = {
    "order_id": "o_orderkey) FROM orders",
    "customer_id": "c_custkey) FROM customer",
    "customer_zip": "c_nationkey) FROM customer",
    "seller_id": "s_suppkey) FROM supplier",
    "seller_zip": "s_nationkey) FROM supplier",
    "product_id": "p_partkey) FROM part",
    "category": "category) FROM prod",
    "zip": "n_nationkey) FROM nation",
    "region": "r_name) FROM nation JOIN region ON n_regionkey = r_regionkey",
}
query(
    "granularity",
    [PRODUCTS],
    " UNION ALL ".join(
        f"SELECT '{name}' AS entity, count(DISTINCT {source}" for name, source in _ENTITIES.items()
    ).replace(") FROM", ") AS n_distinct FROM"),
)
query(
    "time_extent",
    [ORDERS],
    f"""SELECT {iso("min(dt_purchase)")} AS first_day, {iso("max(dt_purchase)")} AS last_day,
  CAST(datediff('day', min(dt_purchase), max(dt_purchase)) + 1 AS INTEGER) AS n_days FROM ord""",
)
_PROFILED = {
    "customers": ("customer", ["c_custkey AS customer_id", "c_nationkey AS customer_zip"]),
    "sellers": ("supplier", ["s_suppkey AS seller_id", "s_nationkey AS seller_zip"]),
    "products": ("prod", ["product_id", "category"]),
    "orders": (
        "ord JOIN orders ON order_id = o_orderkey",
        ["order_id", "customer_id", "status", "dt_purchase", "dt_approved", "dt_limit",
         "dt_estimated", "review_score", "o_totalprice AS order_value"],
    ),
    "items": (
        "itm",
        ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
         "dt_shipped", "dt_delivered"],
    ),
    "reviews": (
        "ord, unnest(CASE WHEN order_id % 10 = 0 THEN [review_score, 6 - review_score] "
        "ELSE [review_score] END) AS u(score)",
        ["order_id", "score"],
    ),
    "payments": (
        "orders, unnest(range(1, 2 + o_orderkey % 3)) AS u(payment_sequence)",
        ["o_orderkey AS order_id", "payment_sequence", "o_totalprice AS payment_value"],
    ),
    "geolocation": (
        "customer",
        ["c_nationkey AS zip", "c_nationkey + c_custkey AS lat", "c_nationkey - c_custkey AS lng"],
    ),
}


def _profile(name: str, source: str, columns: list[str]) -> str:
    pairs = [c.split(" AS ") for c in columns]
    whole = " AND ".join(f"{pair[0]} IS NOT NULL" for pair in pairs)
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n, count(*) FILTER (WHERE {whole}) AS "
        f"n_complete, '{pair[-1]}' AS column_name, count(*) - count({pair[0]}) AS n_missing "
        f"FROM {source}"
        for pair in pairs
    )


query(
    "missing_profile",
    [ORDERS, ITEMS, PRODUCTS],
    "SELECT *, n_missing / n AS missing_share, n_complete / n AS complete_share FROM ("
    + " UNION ALL ".join(_profile(n, *parts) for n, parts in _PROFILED.items())
    + ")",
)
query(
    "status_share",
    [ORDERS],
    """SELECT status, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
FROM ord GROUP BY 1""",
)
query(
    "volume_spikes",
    [ORDERS],
    f"""SELECT {iso("dt_purchase")} AS dt_purchase, n, {q4("ratio")} AS ratio FROM (
  SELECT dt_purchase, count(*) AS n, count(*) / (sum(count(*)) OVER () / count(*) OVER ()) AS ratio
  FROM ord GROUP BY 1) WHERE ratio >= 1.5""",
)
query(
    "region_month_revenue",
    PLACED,
    f"""SELECT {iso("CAST(date_trunc('month', dt_purchase) AS DATE)")} AS month, customer_region,
  CAST(sum(money) AS DOUBLE) AS revenue, count(*) AS n_items FROM placed GROUP BY 1, 2""",
)
query(
    "state_month_revenue",
    [ORDERS, ITEMS, ITEM_ORDERS],
    f"""SELECT {iso("CAST(date_trunc('month', dt_purchase) AS DATE)")} AS month,
  c_nationkey AS customer_zip, CAST(sum(money) AS DOUBLE) AS revenue, count(*) AS n_items
FROM io LEFT JOIN customer ON customer_id = c_custkey GROUP BY 1, 2""",
)
VIOLATIONS = """
viol AS (
  SELECT *, 'approved_after_posting' AS violation FROM io WHERE dt_approved > dt_shipped
  UNION ALL
  SELECT *, 'approved_after_delivery' FROM io WHERE dt_approved > dt_delivered
  UNION ALL
  SELECT *, 'delivered_without_approval' FROM io
  WHERE dt_delivered IS NOT NULL AND dt_approved IS NULL)"""
query(
    "process_violations",
    [ORDERS, ITEMS, ITEM_ORDERS, VIOLATIONS],
    "SELECT order_id, product_id, seller_id, price, violation FROM viol",
)
query(
    "violation_counts",
    [ORDERS, ITEMS, ITEM_ORDERS, VIOLATIONS],
    "SELECT violation, count(*) AS n FROM viol GROUP BY 1",
)
query(
    "late_by_review",
    [ORDERS, ITEMS, ITEM_ORDERS, LOGISTICS],
    """SELECT late_delivery, review_score, count(*) AS n,
  count(*) / sum(count(*)) OVER (PARTITION BY late_delivery) AS row_share
FROM feat GROUP BY 1, 2""",
)
query(
    "places_by_region",
    [],
    """SELECT r_name AS region, count(*) AS n, 'customer' AS side
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1
UNION ALL SELECT r_name, count(*), 'seller'
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
query(
    "distance_delay_trend",
    PLACED,
    f"""SELECT late_delivery, count(*) AS n,
  {q4("regr_slope(days_to_deliver, distance)")} AS slope,
  {q4("regr_intercept(days_to_deliver, distance)")} AS intercept,
  {q4("corr(days_to_deliver, distance)")} AS r FROM placed GROUP BY 1""",
)
query(
    "distance_delay_spread",
    PLACED,
    f"""SELECT late_delivery, CAST(floor(distance / 2000.0) AS BIGINT) AS distance_bin,
  count(*) AS n, {q4("avg(days_to_deliver)")} AS mean_days,
  {q4("stddev_samp(days_to_deliver)")} AS sd_days FROM placed GROUP BY 1, 2""",
)
query(
    "price_freight_outliers",
    [ITEMS, boxes(None, "itm", ["price", "freight_value"])],
    f"SELECT metric, n, n_outliers, {_BOX}, {q4('n_outliers / n')} AS share FROM box",
)

# -- windows and series preparation ---------------------------------------------------------

query("daily_spine", DENSE_DAILY, f"SELECT cluster, {iso('ds')} AS ds FROM dense")
query(
    "padded_spine",
    [*BASE, DAILY],
    f"""SELECT cluster, {iso("s.ds")} AS ds,
  CAST(datediff('day', DATE '1994-08-29', s.ds) + 1 AS INTEGER) AS t, orders,
  s.ds < first_seen AS is_padding
FROM (SELECT cluster, first_seen,
        unnest(generate_series(DATE '1994-08-29', hi, INTERVAL 1 DAY))::DATE AS ds
      FROM (SELECT DISTINCT cluster FROM daily),
           (SELECT min(ds) AS first_seen, max(ds) AS hi FROM daily)) s
LEFT JOIN daily USING (cluster, ds)""",
)
query(
    "monthly_spine",
    [ORDERS, ITEMS, ITEM_ORDERS, month_spine()],
    f"SELECT seller_id, {iso('ds')} AS ds, CAST(t AS INTEGER) AS t, orders FROM full_month",
)
query(
    "time_slices",
    DENSE_DAILY,
    f"""SELECT cluster, {iso("dense.ds")} AS ds, CAST(t AS INTEGER) AS t, orders FROM dense
WHERE dense.ds BETWEEN DATE '1997-03-01' AND DATE '1997-12-31'""",
)
query(
    "train_valid_split",
    [*MONTH, SPLIT],
    f"SELECT cluster, {iso('ds')} AS ds, t, value, split FROM parts",
)
query(
    "train_valid_overlap",
    MONTH,
    f"""SELECT cluster, {iso("monthly.ds")} AS ds, t, value, 'train' AS split FROM monthly
WHERE monthly.ds >= DATE '1996-08-01' AND monthly.ds <= DATE '2001-05-01'
UNION ALL SELECT cluster, {iso("monthly.ds")}, t, value, 'valid' FROM monthly
WHERE monthly.ds >= DATE '2001-05-01'""",
)
query(
    "seasonal_diff",
    DENSE_DAILY,
    f"""SELECT cluster, {iso("ds")} AS ds,
  orders - lag(orders, 7) OVER (PARTITION BY cluster ORDER BY t) AS diff FROM dense""",
)


def centred(value: str, order: int) -> str:
    """Weighted centred mean from explicit lags: half weight at the ends of an even order."""
    half = order // 2

    def at(k: int) -> str:
        return f"lag({value}, {k}) OVER w" if k >= 0 else f"lead({value}, {-k}) OVER w"

    if order % 2:
        return "(" + " + ".join(at(k) for k in range(-half, half + 1)) + f") / {order}"
    inner = " + ".join(at(k) for k in range(-half + 1, half))
    return f"({inner} + 0.5::DOUBLE * ({at(-half)}) + 0.5::DOUBLE * ({at(half)})) / {order}"


query(
    "moving_average",
    [*DENSE_DAILY, "z AS (SELECT *, coalesce(orders, 0.0::DOUBLE) AS value FROM dense)"],
    f"""SELECT cluster, {iso("ds")} AS ds, {q4(centred("value", 30))} AS ma_30,
  {q4(centred("value", 7))} AS ma_7, {q4(centred("value", 2))} AS ma_2
FROM z WINDOW w AS (PARTITION BY cluster ORDER BY t)""",
)
query(
    "interpolate",
    [
        ORDERS, ITEMS, ITEM_ORDERS, month_spine("1994-08-01"),
        filled("full_month", "lin", "seller_id", "revenue", "ds"),
    ],
    f"""SELECT seller_id, {iso("ds")} AS ds, CAST(t AS INTEGER) AS t, {q4("filled")} AS filled,
  is_imputed FROM lin""",
)


def median_pass(source: str, name: str) -> str:
    """One outlier pass over ``source(cluster, ds, t, base, fixed, is_outlier)``."""
    return f"""
{name}_rest AS (
  SELECT *, fixed - median(fixed) OVER (
    PARTITION BY cluster ORDER BY t ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS rest
  FROM {source}),
{name}_quart AS (
  SELECT cluster, quantile_cont(rest, 0.25) AS lo, quantile_cont(rest, 0.75) AS hi
  FROM {name}_rest GROUP BY cluster),
{name}_mark AS (
  SELECT cluster, ds, t, base, was OR far AS is_outlier,
    CASE WHEN NOT (was OR far) THEN fixed END AS kept
  FROM (SELECT r.*, r.is_outlier AS was,
      (rest < lo - 3 * (hi - lo) OR rest > hi + 3 * (hi - lo)) AND hi - lo > 1e-14 AS far
    FROM {name}_rest r JOIN {name}_quart USING (cluster))),
{filled(f"{name}_mark", f"{name}_fill", "cluster", "kept", "ds, base, is_outlier").lstrip()},
{name} AS (SELECT cluster, ds, t, base, filled AS fixed, is_outlier FROM {name}_fill)"""


query(
    "outlier_median",
    [
        *DENSE_DAILY,
        filled("dense", "lin", "cluster", "orders", "ds"),
        "start AS (SELECT cluster, ds, t, filled AS base, filled AS fixed, false AS is_outlier "
        "FROM lin)",
        median_pass("start", "one"),
        median_pass("one", "two"),
    ],
    f"""SELECT cluster, {iso("ds")} AS ds, CAST(t AS INTEGER) AS t, {q4("base")} AS filled,
  {q4("fixed")} AS fixed, is_outlier FROM two""",
)
def _line(source: str, name: str, lines: list[tuple[str, str, str, str | None]]) -> str:
    """Regressions over the nearest points, ``(value, half, fit, error)`` each, added to ``source``."""
    over = (
        "PARTITION BY {k} ORDER BY t "
        "ROWS BETWEEN (pos - {lo}) PRECEDING AND ({lo} + {w} - 1 - pos) FOLLOWING"
    )
    columns = []
    for value, half, fit, error in lines:
        width = f"least(2 * {half} + 1, n)"
        low = f"least(greatest(pos - {half}, 0), n - {width})"
        window = over.format(k=SERIES, lo=low, w=width)
        mean = f"avg({value}) OVER ({window})"
        covariance, variance = (f"{f} OVER ({window})" for f in (f"covar_pop({value}, pos)", "var_pop(pos)"))
        dot = f"coalesce({covariance} / nullif({variance}, 0), 0)"
        away = f"(pos - ({low} + ({width} - 1) / 2))"
        columns.append(f"{mean} + {dot} * {away} AS {fit}")
        if error:
            own = f"1 / {width} + {away} * {away} / ({width} * greatest(({width} * {width} - 1) / 12, 1e-12))"
            columns.append(f"abs({value} - {fit}) / (1 - least(greatest({own}, 0), 0.999)) AS {error}")
    return f"{name} AS (SELECT *, {', '.join(columns)} FROM {source})"


SERIES = "cluster, metric"


def smooth_pass(source: str, name: str) -> list[str]:
    """One outlier pass over ``source(cluster, metric, ds, t, base, fixed, is_outlier)``."""
    halves = [f"greatest(floor({s / 2!r}::DOUBLE * n + 5e-1), 2)::BIGINT" for s in (0.05, 0.2, 0.5)]
    return [
        f"""{name}_at AS (SELECT *, row_number() OVER (PARTITION BY {SERIES} ORDER BY t) - 1 AS pos,
  count(*) OVER (PARTITION BY {SERIES}) AS n FROM {source})""",
        _line(f"{name}_at", f"{name}_fit", [("fixed", h, f"f{k}", f"e{k}") for k, h in enumerate(halves)]),
        _line(f"{name}_fit", f"{name}_err", [(f"e{k}", halves[1], f"r{k}", None) for k in range(3)]),
        f"""{name}_best AS (SELECT *, CASE WHEN r0 = least(r0, r1, r2) THEN 5e-2
  WHEN r1 = least(r0, r1, r2) THEN 2e-1 ELSE 5e-1 END AS best FROM {name}_err)""",
        _line(f"{name}_best", f"{name}_span", [("best", halves[1], "wanted", None)]),
        f"""{name}_mix AS (
  SELECT *, CASE WHEN s <= 2e-1 THEN f0 + (f1 - f0) * (s - 5e-2) / 15e-2
    ELSE f1 + (f2 - f1) * (s - 2e-1) / 3e-1 END AS mixed
  FROM (SELECT *, least(greatest(wanted, 5e-2), 5e-1) AS s FROM {name}_span))""",
        _line(f"{name}_mix", f"{name}_end", [("mixed", halves[0], "smooth", None)]),
        f"""{name}_quart AS (
  SELECT {SERIES}, quantile_cont(fixed - smooth, 0.25) AS lo, quantile_cont(fixed - smooth, 0.75) AS hi
  FROM {name}_end GROUP BY {SERIES}),
{name}_mark AS (
  SELECT {SERIES}, ds, t, base, was OR far AS is_outlier, CASE WHEN NOT (was OR far) THEN fixed END AS kept
  FROM (SELECT e.*, is_outlier AS was, hi - lo > 1e-14
      AND (fixed - smooth < lo - 3 * (hi - lo) OR fixed - smooth > hi + 3 * (hi - lo)) AS far
    FROM {name}_end e JOIN {name}_quart USING ({SERIES})))""",
        filled(f"{name}_mark", f"{name}_fill", SERIES, "kept", "ds, base, is_outlier"),
        f"{name} AS (SELECT {SERIES}, ds, t, base, filled AS fixed, is_outlier FROM {name}_fill)",
    ]


_LONG = """long AS (
  SELECT cluster, ds, t, metric, CAST(raw AS DOUBLE) AS raw FROM (
    SELECT cluster, ds, t, CAST(orders AS DOUBLE) AS orders, CAST(avg_price AS DOUBLE) AS avg_price,
      CAST(revenue AS DOUBLE) AS revenue FROM dense)
  UNPIVOT INCLUDE NULLS (raw FOR metric IN (orders, avg_price, revenue)))"""
REPAIRED = [
    *DENSE_DAILY,
    _LONG,
    filled("long", "lin", SERIES, "raw", "ds, raw"),
    f"start AS (SELECT {SERIES}, ds, t, filled AS base, filled AS fixed, false AS is_outlier FROM lin)",
    *smooth_pass("start", "one"),
    *smooth_pass("one", "two"),
]
query(
    "outlier_supersmooth",
    REPAIRED,
    f"""SELECT cluster, {iso("ds")} AS ds, CAST(t AS INTEGER) AS t, {q4("base")} AS filled,
  {q4("fixed")} AS fixed, is_outlier FROM two WHERE metric = 'orders'""",
)
query(
    "series_repair",
    REPAIRED,
    f"""SELECT {SERIES}, {iso("two.ds")} AS ds, CAST(t AS INTEGER) AS t, {q4("raw")} AS raw,
  {q4("fixed")} AS fixed, is_imputed, is_outlier FROM two JOIN lin USING ({SERIES}, t)""",
)
query(
    "time_index",
    DENSE_DAILY,
    f"""SELECT cluster, {iso("ds")} AS ds, CAST(t AS INTEGER) AS t,
  CAST((t - 1) % 365 + 1 AS INTEGER) AS phase, {q4("1995 + (t - 1) / 365.0::DOUBLE")} AS decimal_time
FROM dense""",
)
_FREQ = 241 / 8
query(
    "fourier_regressors",
    DENSE_DAILY,
    f"SELECT cluster, {iso('ds')} AS ds, "
    + ", ".join(
        f"{q4(f'{f}({2 * math.pi * k / _FREQ!r}::DOUBLE * t)')} AS {f[0]}{k}"
        for k in (1, 2)
        for f in ("sin", "cos")
    )
    + " FROM dense",
)
query(
    "unpivoted_series",
    DENSE_DAILY,
    " UNION ALL ".join(
        f"SELECT cluster, {iso('ds')} AS ds, '{m}' AS metric, {m} AS value FROM dense"
        for m in ("orders", "avg_price", "revenue")
    ),
)

# -- decomposition and regression -----------------------------------------------------------

query(
    "linear_trend",
    MONTH,
    f"""SELECT cluster, count(*) AS n, {q4("regr_slope(value, t)")} AS slope,
  {q4("regr_intercept(value, t)")} AS intercept, {q4("regr_r2(value, t)")} AS r2,
  {q4("regr_syy(value, t) * (1 - regr_r2(value, t)) / (count(*) - 2)")} AS sigma2
FROM monthly GROUP BY cluster""",
)

# Nested projections: regress the next power on the ones before, then the value on the rest.
QUADRATIC = """
lin AS (
  SELECT cluster, regr_slope(value, t) AS b, regr_intercept(value, t) AS a,
    regr_slope(t * t, t) AS pb, regr_intercept(t * t, t) AS pa FROM monthly GROUP BY cluster),
res AS (
  SELECT m.*, a + b * t AS line, value - a - b * t AS ry, t * t - pa - pb * t AS rq
  FROM monthly m JOIN lin USING (cluster)),
curve AS (SELECT cluster, sum(ry * rq) / sum(rq * rq) AS c FROM res GROUP BY cluster)"""
query(
    "quadratic_trend",
    [*MONTH, QUADRATIC],
    f"""SELECT cluster, {iso("ds")} AS ds, {q4("line + c * rq")} AS fitted,
  {q4("value - line - c * rq")} AS residual FROM res JOIN curve USING (cluster)""",
)


def polynomial_sse(degree: int, name: str, value: str) -> list[str]:
    """Gram-Schmidt on the centred powers of t, then the residual sum of squares."""
    ctes = [
        f"{name}_0 AS (SELECT cluster, (t - avg(t) OVER c) / 40 AS x, {value} AS y, "
        f"{value} - avg({value}) OVER c AS r FROM monthly WINDOW c AS (PARTITION BY cluster))"
    ]
    basis: list[str] = []
    for d in range(1, degree + 1):
        power = f"x ** {d}"
        shifted = f"{power} - avg({power}) OVER c"
        ctes.append(
            f"{name}_{d}a AS (SELECT *, {shifted} AS g FROM {name}_{d - 1} "
            "WINDOW c AS (PARTITION BY cluster))"
        )
        # project the new power on every earlier basis vector, twice for stability
        expr = "g"
        for b in basis:
            expr += f" - {b} * (sum(g * {b}) OVER c / sum({b} * {b}) OVER c)"
        ctes.append(
            f"{name}_{d}b AS (SELECT * EXCLUDE (g), {expr} AS p{d} FROM {name}_{d}a "
            "WINDOW c AS (PARTITION BY cluster))"
        )
        basis.append(f"p{d}")
        ctes.append(
            f"{name}_{d} AS (SELECT * REPLACE (r - p{d} * (sum(r * p{d}) OVER c / "
            f"sum(p{d} * p{d}) OVER c) AS r) FROM {name}_{d}b WINDOW c AS (PARTITION BY cluster))"
        )
    return ctes


_forms = {f"degree_{d}": (d, "value") for d in range(1, 5)} | {"exponential": (1, "ln(value)")}
_ctes, _selects = [], []
for _form, (_degree, _value) in _forms.items():
    _ctes += polynomial_sse(_degree, _form, _value)
    _k = _degree + 2
    _aic = f"count(*) * ln(sum(r * r) / count(*)) + 2 * {_k}"
    _selects.append(
        f"SELECT cluster, count(*) AS n, {q4('sum(r * r)')} AS sse, "
        f"{q4('1 - sum(r * r) / (var_pop(y) * count(*))')} AS r2, {q4(_aic)} AS aic, "
        f"{q4(f'{_aic} + 2.0 * {_k} * ({_k} + 1) / (count(*) - {_k} - 1)')} AS aicc, "
        f"'{_form}' AS form FROM {_form}_{_degree} GROUP BY cluster"
    )
query("polynomial_criteria", [*MONTH, *_ctes], " UNION ALL ".join(_selects))


def projected(vector: str, basis: list[str]) -> str:
    """``vector`` without its parts along the orthogonal ``basis``, per cluster."""
    return vector + "".join(
        f" - {b} * (sum({vector} * {b}) OVER c / sum({b} * {b}) OVER c)" for b in basis
    )


def _fourier_ctes(k: int, freq: int) -> list[str]:
    """Joint least squares by residuals: slope, then level, then the Fourier part."""
    over = "WINDOW c AS (PARTITION BY cluster)"
    raw = [f"{f}({2 * math.pi * i / freq!r}::DOUBLE * t)" for i in range(1, k + 1) for f in ("sin", "cos")]
    ctes, last, basis = [], "monthly", []
    for i, term in enumerate(raw):
        ctes.append(f"four_{i}r AS (SELECT *, {term} AS u FROM {last})")
        expr = projected("u", basis)
        ctes.append(f"four_{i} AS (SELECT * EXCLUDE (u), {expr} AS g{i} FROM four_{i}r {over})")
        last = f"four_{i}"
        basis.append(f"g{i}")
    ctes += [
        f"four_one AS (SELECT *, {projected('k1', basis)} AS g FROM "
        f"(SELECT *, 1.0::DOUBLE AS k1 FROM {last}) {over})",
        f"four_t AS (SELECT *, {projected('t', [*basis, 'g'])} AS gt FROM four_one {over})",
        f"four_slope AS (SELECT *, sum(value * gt) OVER c / sum(gt * gt) OVER c AS b1 "
        f"FROM four_t {over})",
        "four_level AS (SELECT *, sum((value - b1 * t) * g) OVER c / sum(g * g) OVER c "
        f"+ b1 * t AS trend FROM four_slope {over})",
        "four_rest AS (SELECT *, value - trend AS v FROM four_level)",
        f"four AS (SELECT *, {projected('v', basis)} AS remainder FROM four_rest {over})",
    ]
    return ctes


query(
    "fourier_decompose",
    [*MONTH, *_fourier_ctes(3, 12)],
    f"""SELECT cluster, CAST(t AS INTEGER) AS t, {iso("ds")} AS ds, value AS data,
  {q4("trend")} AS trend, {q4("v - remainder")} AS season, {q4("remainder")} AS remainder
FROM four""",
)

query(
    "fourier_decompose_daily",
    [*FILLED_DAILY, *_fourier_ctes(7, 365)],
    ORACLES["fourier_decompose"][ORACLES["fourier_decompose"].rindex("SELECT cluster, CAST(t") :],
)

for _kind, _minus in (("additive", "{} - {}"), ("multiplicative", "{} / {}")):
    _raw = _minus.format("value", "trend")
    query(
        f"classical_{_kind}",
        [
            *MONTH,
            f"tr AS (SELECT *, {centred('value', 12)} AS trend FROM monthly "
            "WINDOW w AS (PARTITION BY cluster ORDER BY t))",
            f"fig AS (SELECT cluster, (t - 1) % 12 AS ph, avg({_raw}) AS f FROM tr GROUP BY 1, 2)",
            "mid AS (SELECT cluster, avg(f) AS m FROM fig GROUP BY 1)",
            f"dec AS (SELECT tr.*, {_minus.format('f', 'm')} AS seasonal FROM tr "
            "JOIN fig ON tr.cluster = fig.cluster AND (t - 1) % 12 = ph "
            "JOIN mid ON mid.cluster = tr.cluster)",
        ],
        f"SELECT cluster, {iso('ds')} AS ds, value, {q4('trend')} AS trend, "
        f"{q4('seasonal')} AS seasonal, "
        f"{q4(_minus.format(f'({_raw})', 'seasonal'))} AS remainder FROM dec",
    )

RESIDUALS = """
lin AS (SELECT cluster, count(*) AS n, regr_slope(value, t) AS b, regr_intercept(value, t) AS a
  FROM monthly GROUP BY cluster),
res AS (SELECT m.cluster, ds, t, n, value - a - b * t AS r FROM monthly m JOIN lin USING (cluster))"""
query(
    "dominant_period",
    [
        *MONTH,
        RESIDUALS,
        """spec AS (
  SELECT cluster, n, k, (pow(sum(r * cos(2 * pi() * k * t / n)), 2)
    + pow(sum(r * sin(2 * pi() * k * t / n)), 2)) / n AS power
  FROM (SELECT *, unnest(range(1, n // 2 + 1)) AS k FROM res) GROUP BY 1, 2, 3)""",
    ],
    f"""SELECT cluster, CAST(any_value(n) AS INTEGER) AS n, {q4("max(power)")} AS power,
  {q4("any_value(n) / arg_max(k, power)")} AS period FROM spec GROUP BY cluster""",
)

# -- diagnostics ----------------------------------------------------------------------------

def lags(most: int) -> str:
    return f"""
cen AS (SELECT cluster, t, n, r - avg(r) OVER (PARTITION BY cluster) AS e FROM res),
rho AS (
  SELECT a.cluster, a.n, a.t - b.t AS lag,
    sum(a.e * b.e) / any_value(d.s) AS acf
  FROM cen a JOIN cen b ON a.cluster = b.cluster AND a.t - b.t BETWEEN 1 AND {most}
  JOIN (SELECT cluster, sum(e * e) AS s FROM cen GROUP BY 1) d ON d.cluster = a.cluster
  GROUP BY 1, 2, 3)"""


query(
    "acf",
    [*MONTH, RESIDUALS, lags(24)],
    f"""SELECT cluster, CAST(lag AS INTEGER) AS lag, {q4("acf")} AS acf,
  {q4("1.96 / sqrt(n)")} AS bound FROM rho""",
)


def portmanteau(most: int, lag: int, fit_df: int, residuals: str = RESIDUALS) -> list[str]:
    """Statistic over ``lag`` lags at most; with even degrees its tail is a finite Poisson sum."""
    return [
        residuals,
        lags(most),
        f"""lb AS (
  SELECT cluster, n, max(lag) AS lag, n * (n + 2) * sum(acf * acf / (n - lag)) AS q
  FROM rho WHERE lag <= least({lag}, n // 5) GROUP BY 1, 2)""",
        f"""tail AS (
  SELECT *, lag - {fit_df} AS df, list_sum(list_transform(
    range(0, df // 2), lambda k: exp(k * ln(q / 2) - q / 2 - lgamma(k + 1)))) AS p FROM lb)""",
    ]


_PORTMANTEAU = f"""SELECT cluster, CAST(n AS INTEGER) AS n, CAST(lag AS INTEGER) AS lag, {q4("q")} AS q,
  CAST(df AS INTEGER) AS df, {q4("greatest(0.0, least(1.0, p))")} AS p_value FROM tail"""
query("ljung_box", [*MONTH, *portmanteau(24, 10, 2)], _PORTMANTEAU)
query("ljung_box_daily", [*FILLED_DAILY, *portmanteau(730, 730, 1)], _PORTMANTEAU)
query(
    "residual_histogram",
    [*MONTH, RESIDUALS],
    """SELECT cluster, CAST(least(floor((r - lo) / (hi - lo) * 10), 9) + 1 AS BIGINT) AS bin,
  count(*) AS n
FROM res JOIN (SELECT cluster, min(r) AS lo, max(r) AS hi FROM res GROUP BY 1) USING (cluster)
GROUP BY 1, 2""",
)
query(
    "residual_moments",
    [
        *MONTH,
        RESIDUALS,
        "mom AS (SELECT *, r - avg(r) OVER (PARTITION BY cluster) AS e FROM res)",
    ],
    f"""SELECT cluster, count(*) AS n, {q4("avg(r)")} AS mean, {q4("stddev_samp(r)")} AS sd,
  {q4("avg(e ** 3) / pow(avg(e ** 2), 1.5)")} AS skewness,
  {q4("avg(e ** 4) / pow(avg(e ** 2), 2) - 3")} AS excess_kurtosis FROM mom GROUP BY 1""",
)
query(
    "kpss",
    [
        *MONTH,
        """cen AS (SELECT cluster, t, count(*) OVER c AS n, value - avg(value) OVER c AS e
  FROM monthly WINDOW c AS (PARTITION BY cluster))""",
        "cums AS (SELECT *, sum(e) OVER (PARTITION BY cluster ORDER BY t) AS s FROM cen)",
        """top AS (SELECT cluster, n, CAST(floor(4 * pow(n / 100, 0.25)) AS INTEGER) AS lags,
  sum(s * s) / (n * n) AS eta, sum(e * e) / n AS g0 FROM cums GROUP BY cluster, n)""",
        """cov AS (SELECT a.cluster, sum((1 - (a.t - b.t) / (lags + 1)) * a.e * b.e) / any_value(a.n)
    AS g
  FROM cen a JOIN top USING (cluster)
  JOIN cen b ON a.cluster = b.cluster AND a.t - b.t BETWEEN 1 AND lags GROUP BY a.cluster)""",
        "st AS (SELECT *, eta / (g0 + 2 * g) AS stat FROM top JOIN cov USING (cluster))",
    ],
    f"""SELECT cluster, CAST(n AS INTEGER) AS n, lags, {q4("stat")} AS statistic,
  0.347::DOUBLE AS cv_10, 0.463::DOUBLE AS cv_05, 0.574::DOUBLE AS cv_025, 0.739::DOUBLE AS cv_01,
  stat < 0.463 AS stationary_05 FROM st""",
)

query(
    "seasonal_strength",
    [
        *MONTH,
        f"tr AS (SELECT *, value - ({centred('value', 12)}) AS d FROM monthly "
        "WINDOW w AS (PARTITION BY cluster ORDER BY t))",
        "fig AS (SELECT *, d - avg(d) OVER (PARTITION BY cluster, t % 12) AS r FROM tr "
        "WHERE d IS NOT NULL)",
    ],
    f"""SELECT cluster, {q4("greatest(0, 1 - var_pop(r) / var_pop(d))")} AS strength
FROM fig GROUP BY 1""",
)


def kpss_of(source: str, name: str) -> str:
    """Level-stationarity statistic of ``source(cluster, t, value)``."""
    return f"""
{name}_e AS (SELECT cluster, t, count(*) OVER c AS n, value - avg(value) OVER c AS e
  FROM {source} WINDOW c AS (PARTITION BY cluster)),
{name}_s AS (SELECT *, sum(e) OVER (PARTITION BY cluster ORDER BY t) AS s FROM {name}_e),
{name}_top AS (SELECT cluster, n, CAST(floor(4 * pow(n / 100, 0.25)) AS INTEGER) AS lags,
  sum(s * s) / (n * n) AS eta, sum(e * e) / n AS g0 FROM {name}_s GROUP BY cluster, n),
{name}_cov AS (
  SELECT a.cluster, sum((1 - (a.t - b.t) / (lags + 1)) * a.e * b.e) / any_value(a.n) AS g
  FROM {name}_e a JOIN {name}_top USING (cluster)
  JOIN {name}_e b ON a.cluster = b.cluster AND a.t - b.t BETWEEN 1 AND lags GROUP BY a.cluster),
{name} AS (SELECT cluster, eta / (g0 + 2 * g) > 0.463 AS reject
  FROM {name}_top JOIN {name}_cov USING (cluster))"""


_DIFF = (
    "{} AS (SELECT * FROM (SELECT cluster, t, value - lag(value) OVER "
    "(PARTITION BY cluster ORDER BY t) AS value FROM {}) WHERE value IS NOT NULL)"
)
query(
    "difference_order",
    [
        *MONTH,
        "tot AS (SELECT cluster, t, sum(value) OVER (PARTITION BY cluster ORDER BY t) AS value "
        "FROM monthly)",
        _DIFF.format("dif", "tot"),
        kpss_of("tot", "k0"),
        kpss_of("dif", "k1"),
    ],
    """SELECT cluster, CAST(CASE WHEN NOT k0.reject THEN 0 WHEN NOT k1.reject THEN 1 ELSE 2 END
  AS INTEGER) AS d FROM k0 JOIN k1 USING (cluster)""",
)

# -- forecasting ----------------------------------------------------------------------------

query(
    "holt_fixed",
    [
        *MONTH,
        "obs AS MATERIALIZED (SELECT * FROM monthly)",
        """h AS (
  SELECT a.cluster, a.t, a.value AS l, b.value - a.value AS b, 0.0::DOUBLE AS sse
  FROM obs a JOIN obs b ON a.cluster = b.cluster AND b.t = 2 WHERE a.t = 1
  UNION ALL
  SELECT h.cluster, o.t, 0.5 * o.value + 0.5 * (l + 0.9 * b),
    0.1 * (0.5 * o.value + 0.5 * (l + 0.9 * b) - l) + 0.9 * 0.9 * b,
    sse + pow(o.value - l - 0.9 * b, 2)
  FROM h JOIN obs o ON o.cluster = h.cluster AND o.t = h.t + 1)""",
    ],
    f"""SELECT cluster, CAST(t AS INTEGER) AS n, {q4("l")} AS level, {q4("b")} AS trend,
  {q4("sse")} AS sse FROM h WHERE t = (SELECT max(t) FROM obs)""",
)
SELLER_HOLT = [
    ORDERS, ITEMS, ITEM_ORDERS, month_spine(),
    filled("full_month", "lin", "seller_id", "orders", "ds"),
    "obs AS MATERIALIZED (SELECT seller_id, t, filled AS y FROM lin)",
    """h AS (
  SELECT a.seller_id, a.t, a.y, a.y AS l, b.y - a.y AS b, 0.0::DOUBLE AS sse
  FROM obs a JOIN obs b ON a.seller_id = b.seller_id AND b.t = 2 WHERE a.t = 1
  UNION ALL
  SELECT h.seller_id, o.t, o.y, 0.5 * o.y + 0.5 * (l + 0.9 * b),
    0.1 * (0.5 * o.y + 0.5 * (l + 0.9 * b) - l) + 0.9 * 0.9 * b, sse + pow(o.y - l - 0.9 * b, 2)
  FROM h JOIN obs o ON o.seller_id = h.seller_id AND o.t = h.t + 1)""",
    # damping sum and forecast weight per step; an error moves the trend by 0.5 * 0.1
    """step AS (SELECT k AS h, 0.9 * (1 - pow(0.9, k)) / 0.1 AS damp,
    pow(0.5 + 0.05 * 0.9 * (1 - pow(0.9, k)) / 0.1, 2) AS c2 FROM range(1, 5) s(k))""",
    "wide AS (SELECT h, damp, coalesce(sum(c2) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0) AS w FROM step)",
    """path AS (
  SELECT seller_id, y AS last_actual, wide.h, t + wide.h AS t, l + b * damp AS mean,
    sqrt(sse / (t - 1) * (1 + w)) AS sd
  FROM h CROSS JOIN wide WHERE t = (SELECT max(t) FROM obs))""",
]
query(
    "holt_fixed_forecast",
    SELLER_HOLT,
    "SELECT seller_id, CAST(h AS INTEGER) AS h, CAST(t AS INTEGER) AS t, "
    + q4("mean")
    + " AS mean, "
    + ", ".join(
        f"{q4(f'mean {sign} {normal_quantile(level)!r}::DOUBLE * sd')} AS {side}_{round(level * 100)}"
        for level in (0.8, 0.95)
        for sign, side in (("-", "lo"), ("+", "hi"))
    )
    + " FROM path",
)
DAYS_HOLT = [
    *FILLED_DAILY,
    f"""parts AS (
  SELECT *, CASE WHEN t > max(t) OVER (PARTITION BY cluster) - {DAYS_VALID} THEN 'valid'
    ELSE 'train' END AS split
  FROM monthly)""",
    "obs AS MATERIALIZED (SELECT cluster, t, value AS y FROM parts WHERE split = 'train')",
    *[c.replace("seller_id", "cluster").replace("range(1, 5)", f"range(1, {DAYS_VALID + 1})")
      for c in SELLER_HOLT[6:]],
]


def _bounds(source: str, key: str) -> str:
    return ORACLES["holt_fixed_forecast"].rpartition("\n")[2].replace("seller_id", key)


query("holt_daily", DAYS_HOLT, _bounds("path", "cluster"))
query(
    "growth_verdict_fixed",
    SELLER_HOLT,
    f"""SELECT seller_id, {q4("avg(mean)")} AS mean_forecast,
  {q4("max(mean) FILTER (WHERE h = 4) - max(mean) FILTER (WHERE h = 1)")} AS path_change,
  {q4("any_value(last_actual)")} AS last_actual,
  CASE WHEN avg(mean) > any_value(last_actual) THEN 'up'
    WHEN avg(mean) < any_value(last_actual) THEN 'down' ELSE 'flat' END AS verdict
FROM path GROUP BY 1""",
)
# exact likelihood of a first-order autoregression of the changes: the best coefficient is the one
# root inside the unit interval of a cubic in three sums, found by halving
CHANGES = [
    *SELLER_HOLT[:6],
    """chg AS MATERIALIZED (
  SELECT seller_id, t, y, y - lag(y) OVER s AS w, lag(y) OVER s - lag(y, 2) OVER s AS v
  FROM obs WINDOW s AS (PARTITION BY seller_id ORDER BY t))""",
    """sums AS MATERIALIZED (
  SELECT seller_id, CAST(count(w) AS DOUBLE) AS n, sum(w * w) AS a, sum(w * v) AS b,
    sum(w * w) - arg_min(w, t) * arg_min(w, t) - arg_max(w, t) * arg_max(w, t) AS c,
    arg_min(w, t) AS w1, arg_max(w, t) AS wn, arg_max(y, t) AS yn, max(t) AS last_t
  FROM chg WHERE w IS NOT NULL GROUP BY 1)""",
    """halves AS (
  SELECT seller_id, 0 AS step, -0.999::DOUBLE AS lo, 0.999::DOUBLE AS hi FROM sums
  UNION ALL
  SELECT seller_id, step + 1, CASE WHEN right_of THEN lo ELSE m END, CASE WHEN right_of THEN m ELSE hi END
  FROM (SELECT seller_id, step, lo, hi, (lo + hi) / 2 AS m,
      n * (m * c - b) * (1 - m * m) + m * (a - 2 * m * b + m * m * c) > 0 AS right_of
    FROM halves JOIN sums USING (seller_id) WHERE step < 60))""",
    """best AS MATERIALIZED (
  SELECT sums.*, (lo + hi) / 2 AS phi, a - 2 * phi * b + phi * phi * c AS sse,
    sse * pow(1 - phi * phi, -1 / n) AS scaled, sse / (n - 1) AS sigma2,
    n * (ln(2 * pi() * scaled / n) + 1) AS dev
  FROM halves JOIN sums USING (seller_id) WHERE step = 60)""",
]
query(
    "arima_fixed",
    [
        *CHANGES,
        """slope AS (
  SELECT seller_id, pow(1 - any_value(phi) * any_value(phi), -1 / any_value(n)) * sum(pow(CASE
      WHEN v IS NULL THEN w * sqrt(1 - phi * phi) * (phi / (n * (1 - phi * phi)) - phi / (1 - phi * phi))
      ELSE (w - phi * v) * phi / (n * (1 - phi * phi)) - v END, 2)) AS info
  FROM chg JOIN best USING (seller_id) WHERE w IS NOT NULL GROUP BY 1)""",
    ],
    f"""SELECT seller_id, 'ARIMA(1,1,0)' AS model, {q4("phi")} AS phi,
  {q4("sqrt(scaled / n / info)")} AS std_error, {q4("sigma2")} AS sigma2, {q4("-dev / 2")} AS loglik,
  {q4("dev + 4")} AS aic, {q4("dev + 4 + 12 / (n - 3)")} AS aicc, {q4("dev + 2 * ln(n)")} AS bic
FROM best JOIN slope USING (seller_id)""",
)
query(
    "arima_fixed_forecast",
    [
        *CHANGES,
        """path AS (
  SELECT seller_id, h, last_t + h AS t, yn + wn * phi * (1 - pow(phi, h)) / (1 - phi) AS mean,
    sqrt(sigma2 * list_sum(list_transform(range(1, h + 1), lambda j: pow((1 - pow(phi, j)) / (1 - phi), 2))))
      AS sd
  FROM (SELECT *, unnest(range(1, 5)) AS h FROM best))""",
    ],
    _bounds("path", "seller_id"),
)
_ARIMA_RESIDUALS = """res AS (
  SELECT seller_id, t, CAST(n AS BIGINT) AS n,
    CASE WHEN v IS NULL THEN w * sqrt(1 - phi * phi) ELSE w - phi * v END AS r
  FROM chg JOIN best USING (seller_id) WHERE w IS NOT NULL)"""
query(
    "ljung_box_arima",
    [
        *CHANGES,
        _ARIMA_RESIDUALS,
        *[c.replace("cluster", "seller_id") for c in portmanteau(16, 10, 1)[1:3]],
        """tail AS (
  SELECT *, lag - 1 AS df, 1 - list_sum(list_transform(range(0, 300), lambda k:
    exp((df / 2.0 + k) * ln(q / 2) - q / 2 - lgamma(df / 2.0 + k + 1)))) AS p FROM lb)""",
    ],
    _PORTMANTEAU.replace("cluster", "seller_id"),
)


SPECTRUM = [
    *SELLER_HOLT[:6],
    """line AS (SELECT seller_id, regr_slope(y, t) AS g, avg(y) AS my, avg(t) AS mt FROM obs GROUP BY 1)""",
    """pk AS (
  SELECT seller_id, list(y - my - g * (t - mt) ORDER BY t) AS x, CAST(count(*) AS INTEGER) AS n
  FROM obs JOIN line USING (seller_id) GROUP BY 1)""",
    """ac AS MATERIALIZED (
  SELECT seller_id, n, list_sum(list_transform(x, lambda u: u * u)) AS s,
    least(n - 1, CAST(floor(10 * log10(n)) AS INTEGER)) AS most,
    list_transform(range(1, most + 1), lambda k:
      list_sum(list_transform(range(1, n - k + 1), lambda i: x[i] * x[i + k])) / s) AS r
  FROM pk)""",
    """lev AS (
  SELECT seller_id, 0 AS k, CAST([] AS DOUBLE[]) AS a, 1.0::DOUBLE AS v FROM ac
  UNION ALL
  SELECT seller_id, k + 1, list_append(list_transform(range(1, k + 1), lambda j:
    a[j] - q * a[k + 1 - j]), q), v * (1 - q * q)
  FROM (SELECT lev.*, (r[k + 1] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j:
      a[j] * r[k + 1 - j])), 0)) / v AS q
    FROM lev JOIN ac USING (seller_id) WHERE k < most))""",
    """pick AS (
  SELECT seller_id, any_value(n) AS n, any_value(s) AS s,
    arg_min({'k': k, 'a': a, 'v': v}, {'aic': n * ln(greatest(v, 1e-12)) + 2 * k, 'k': k}) AS b
  FROM lev JOIN ac USING (seller_id) GROUP BY 1)""",
    """dens AS (
  SELECT seller_id, n, b.k AS k, i, s * b.v / (n - b.k - 1)
    / (pow(1 - coalesce(list_sum(list_transform(range(1, b.k + 1), lambda j: b.a[j] * cos(pi() * i / 499 * j))), 0), 2)
     + pow(coalesce(list_sum(list_transform(range(1, b.k + 1), lambda j: b.a[j] * sin(pi() * i / 499 * j))), 0), 2)) AS d
  FROM (SELECT *, unnest(range(0, 500)) AS i FROM pick))""",
    """rise AS (
  SELECT *, count_if(up) OVER (PARTITION BY seller_id ORDER BY i) > 0 AS risen
  FROM (SELECT *, d > lag(d) OVER (PARTITION BY seller_id ORDER BY i) AS up FROM dens))""",
    """tops AS (
  SELECT seller_id, any_value(n) AS n, any_value(k) AS k, max(d) AS high,
    arg_max(i, {'d': d, 'i': -i}) AS top, arg_max(i, {'d': d, 'i': -i}) FILTER (WHERE risen) AS later
  FROM rise GROUP BY 1)""",
]
query(
    "ar_spectrum",
    SPECTRUM,
    f"""SELECT seller_id, n, k AS ar_order, {q4("high")} AS density,
  CASE WHEN high <= 10 THEN 1 WHEN top > 0 THEN CAST(floor(998 / top + 0.5) AS INTEGER)
    WHEN later < 499 THEN CAST(floor(998 / later + 0.5) AS INTEGER) ELSE 1 END AS period FROM tops""",
)


def damped_search(key: str, points: int = 9, rounds: int = 4) -> list[str]:
    """``fit(key, n, alpha, beta, l0, b0)`` and the run ``path(key, t, y, f, level, trend, sse)``.

    ``obs(key, t, y)`` holds the series.  Each round tries a grid of weights around the best ones so far;
    a start solves the normal equations of the errors, which are linear in it.
    """
    ctes, half = [
        f"len AS (SELECT {key}, CAST(count(*) AS DOUBLE) AS n FROM obs GROUP BY 1)",
        f"""top0 AS (SELECT {key}, 0.5::DOUBLE AS alpha, 0.5::DOUBLE AS share, NULL::DOUBLE AS sse,
    0.0::DOUBLE AS l0, 0.0::DOUBLE AS b0 FROM len)""",
    ], 0.4999
    sums = [(i, j) for i in range(3) for j in range(i, 3)]
    for r in range(1, rounds + 1):
        near = (
            f"least(greatest({{}} + {half!r}::DOUBLE * ({{}} * {2 / (points - 1)!r}::DOUBLE - 1), "
            "1e-4), 0.9999::DOUBLE)"
        )
        ctes += [
            f"""try{r} AS (
  SELECT {key}, k, {near.format("alpha", f"(k // {points})")} AS alpha,
    {near.format("share", f"(k % {points})")} AS share FROM top{r - 1}, range({points**2}) g(k))""",
            f"""run{r} AS (
  SELECT {key}, k, alpha, share, 0::BIGINT AS t, 0e0 AS l0, 0e0 AS b0, 1e0 AS l1, 0e0 AS b1,
    0e0 AS l2, 1e0 AS b2, {", ".join(f"0e0 AS s{i}{j}" for i, j in sums)} FROM try{r}
  UNION ALL
  SELECT {key}, k, alpha, share, t + 1, f0 + alpha * e, 9e-1 * b0 + alpha * share * e,
    f1 - alpha * f1, 9e-1 * b1 - alpha * share * f1, f2 - alpha * f2, 9e-1 * b2 - alpha * share * f2,
    {", ".join(f"s{i}{j} + {'e' if not i else f'f{i}'} * {'e' if not j else f'f{j}'}" for i, j in sums)}
  FROM (
    SELECT h.*, l0 + 9e-1 * b0 AS f0, y - (l0 + 9e-1 * b0) AS e, l1 + 9e-1 * b1 AS f1,
      l2 + 9e-1 * b2 AS f2
    FROM run{r} h JOIN obs o ON o.{key} = h.{key} AND o.t = h.t + 1))""",
            f"""solved{r} AS (
  SELECT *, greatest(s00 - 2 * (l * s01 + b * s02) + l * l * s11 + 2 * l * b * s12 + b * b * s22, 0)
    AS sse
  FROM (
    SELECT h.*, n, CASE WHEN ok THEN (s01 * s22 - s02 * s12) / det ELSE y END AS l,
      CASE WHEN ok THEN (s02 * s11 - s01 * s12) / det ELSE 0 END AS b
    FROM (
      SELECT *, s11 * s22 - s12 * s12 AS det,
        s11 * s22 - s12 * s12 > 1e-12 * greatest(s11 * s22, 1e-300) AS ok FROM run{r}) h
    JOIN len ON len.{key} = h.{key} AND h.t = n
    JOIN obs ON obs.{key} = h.{key} AND obs.t = 1))""",
            f"""top{r} AS (
  SELECT {key}, alpha, share, sse, l0, b0 FROM (
    SELECT {key}, alpha, share, sse, l0, b0, -1 AS k FROM top{r - 1} WHERE sse IS NOT NULL
    UNION ALL SELECT {key}, alpha, share, sse, l, b, k FROM solved{r})
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY sse, k) = 1)""",
        ]
        half *= 2.2 / (points - 1)
    return [
        *ctes,
        f"""fit AS (SELECT {key}, n, alpha, alpha * share AS beta, l0, b0
  FROM top{rounds} JOIN len USING ({key}))""",
        f"""path AS (
  SELECT {key}, n, alpha, beta, 0::BIGINT AS t, NULL::DOUBLE AS y, NULL::DOUBLE AS f, l0 AS level,
    b0 AS trend, 0e0 AS sse FROM fit
  UNION ALL
  SELECT {key}, n, alpha, beta, t + 1, y, f, f + alpha * (y - f), 9e-1 * trend + beta * (y - f),
    sse + (y - f) * (y - f)
  FROM (SELECT h.* EXCLUDE (y, f), o.y, level + 9e-1 * trend AS f
    FROM path h JOIN obs o ON o.{key} = h.{key} AND o.t = h.t + 1))""",
        f"""done AS (
  SELECT *, sse / greatest(n - 4, 1) AS sigma2, n * ln(greatest(sse, 1e-300) / n) AS lik
  FROM path WHERE t = n)""",
    ]


def damped_path(key: str, horizon: int) -> list[str]:
    """``ahead(key, h, t, mean, sd)`` of the fitted trend."""
    return [
        f"""ahead AS (
  SELECT {key}, n, h, n + h AS t, level + trend * 9 * (1 - pow(9e-1, h)) AS mean,
    sqrt(sigma2 * (1 + list_sum(list_transform(range(0, h),
      lambda j: CASE WHEN j = 0 THEN 0 ELSE pow(alpha + beta * 9 * (1 - pow(9e-1, j)), 2) END))))
      AS sd
  FROM done, range(1, {horizon + 1}) g(h))""",
    ]


def held_out(source: str, n: int) -> str:
    return f"""parts AS (SELECT *, CASE WHEN t > max(t) OVER (PARTITION BY cluster) - {n} THEN 'valid'
  ELSE 'train' END AS split FROM {source})"""


_TRAIN = "obs AS MATERIALIZED (SELECT cluster, t, value AS y FROM parts WHERE split = 'train')"
FITTED = [*MONTH, SPLIT, _TRAIN, *damped_search("cluster")]
SELLER_FITTED = [*SELLER_HOLT[:6], *damped_search("seller_id")]


def summary(key: str, last: str) -> str:
    rounded = ", ".join(f"{q4(c)} AS {c}" for c in ("level", "trend", "sse", "sigma2"))
    return f"""SELECT {key}, 'holt_damped' AS model, CAST(n AS INTEGER) AS n, {q4("alpha")} AS alpha,
  {q4("beta")} AS beta, 9e-1 AS phi, {rounded}, {q4("lik + 10")} AS aic,
  {q4("lik + 10 + 60 / (n - 6)")} AS aicc, {q4("lik + 5 * ln(n)")} AS bic,
  {iso("ds")} AS last_ds, CAST(n AS INTEGER) AS last_t FROM done JOIN {last} USING ({key}, t)"""


query("model_summary", FITTED, summary("cluster", "parts"))
query("holt_fit", SELLER_FITTED, summary("seller_id", "lin"))


def fitted_bounds(kind: str = "") -> str:
    limits = ", ".join(
        f"{q4(f'mean {sign} {normal_quantile(level)!r}::DOUBLE * sd')} AS {side}_{round(level * 100)}"
        for level in (0.8, 0.95)
        for sign, side in (("-", "lo"), ("+", "hi"))
    )
    return f"""SELECT cluster, 'holt_damped' AS model, CAST(h AS INTEGER) AS h, CAST(t AS INTEGER) AS t,
  {q4("mean")} AS mean, {limits} FROM ahead"""


query("holt_forecast", [*FITTED, *damped_path("cluster", MONTHS_VALID)], fitted_bounds())
SHORT_FIT = [*MONTH, held_out("monthly", SHORT_VALID), _TRAIN, *damped_search("cluster")]
query("holt_forecast_short", [*SHORT_FIT, *damped_path("cluster", SHORT_VALID)], fitted_bounds())
DAYS_FIT = [*FILLED_DAILY, held_out("monthly", DAYS_VALID), _TRAIN, *damped_search("cluster")]
query("holt_daily_fit", [*DAYS_FIT, *damped_path("cluster", DAYS_VALID)], fitted_bounds())
query(
    "overlay",
    [*FITTED, *damped_path("cluster", MONTHS_VALID)],
    f"""SELECT cluster, CAST(t AS INTEGER) AS t, split AS kind, value, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi
FROM parts UNION ALL
SELECT cluster, CAST(t AS INTEGER), 'fitted', {q4("f")}, NULL, NULL FROM path WHERE t > 0 UNION ALL
SELECT cluster, CAST(t AS INTEGER), 'forecast', {q4("mean")},
  {q4(f"mean - {normal_quantile(0.95)!r}::DOUBLE * sd")}, {q4(f"mean + {normal_quantile(0.95)!r}::DOUBLE * sd")}
FROM ahead""",
)
query(
    "growth_verdict",
    [
        *MONTH,
        "obs AS MATERIALIZED (SELECT cluster, t, value AS y FROM monthly)",
        *damped_search("cluster"),
        *damped_path("cluster", 4),
    ],
    f"""SELECT cluster, {q4("avg(mean)")} AS mean_forecast,
  {q4("max(mean) FILTER (WHERE h = 4) - max(mean) FILTER (WHERE h = 1)")} AS path_change,
  {q4("any_value(y)")} AS last_actual,
  CASE WHEN avg(mean) > any_value(y) THEN 'up' WHEN avg(mean) < any_value(y) THEN 'down' ELSE 'flat' END
    AS verdict
FROM ahead JOIN obs USING (cluster) WHERE obs.t = n GROUP BY 1""",
)
_HOLT_RESIDUALS = "res AS (SELECT cluster, t, CAST(n AS BIGINT) AS n, y - f AS r FROM path WHERE t > 0)"
query(
    "ljung_box_holt",
    [*FITTED, *portmanteau(24, 10, 4, _HOLT_RESIDUALS)],
    _PORTMANTEAU,
)
query(
    "simple_smoothing",
    [
        *MONTH,
        "obs AS MATERIALIZED (SELECT * FROM monthly)",
        """h AS (
  SELECT cluster, t, value AS l FROM obs WHERE t = 1
  UNION ALL
  SELECT h.cluster, o.t, 0.3 * o.value + 0.7 * l
  FROM h JOIN obs o ON o.cluster = h.cluster AND o.t = h.t + 1)""",
    ],
    f"""SELECT cluster, CAST(t AS INTEGER) AS n, {q4("l")} AS forecast
FROM h WHERE t = (SELECT max(t) FROM obs)""",
)
query(
    "boxcox_lambda",
    [
        *MONTH,
        """blk AS (
  SELECT cluster, avg(value) AS m, stddev_samp(value) AS s
  FROM (SELECT *, (max(t) OVER (PARTITION BY cluster) - t) // 12 AS b FROM monthly)
  GROUP BY cluster, b HAVING count(*) = 12)""",
        """cv AS (
  SELECT cluster, lam, stddev_samp(s / pow(m, 1 - lam)) / avg(s / pow(m, 1 - lam)) AS cv
  FROM (SELECT *, unnest(list_transform(range(0, 301), lambda i: -1.0::DOUBLE + i * 0.01::DOUBLE))
    AS lam FROM blk) GROUP BY 1, 2)""",
    ],
    f"SELECT cluster, {q4('arg_min(lam, cv)')} AS lambda FROM cv GROUP BY 1",
)
query(
    "boxcox_transform",
    MONTH,
    f"""SELECT cluster, {iso("ds")} AS ds, CAST(t AS INTEGER) AS t, value,
  {q4("(pow(value, 0.3) - 1) / 0.3")} AS z, {q4("value")} AS back FROM monthly""",
)
query(
    "moving_average_forecast",
    MONTH,
    f"SELECT cluster, {iso('ds')} AS ds, value, {q4(trailing(6))} AS forecast FROM monthly",
)

# -- evaluation -----------------------------------------------------------------------------

def errors(season: int) -> str:
    """Scores of the forecasts ``f`` in ``sc``; ``parts`` holds the series."""
    return f"""
err AS (SELECT *, value - f AS e, avg(value - f) OVER g AS me,
    lag(value) OVER go AS pv, lag(value - f) OVER go AS pe
  FROM sc WHERE f IS NOT NULL
  WINDOW g AS (PARTITION BY cluster, model, split),
    go AS (PARTITION BY cluster, model, split ORDER BY t)),
scale AS (
  SELECT cluster, avg(abs(d)) AS s FROM (
    SELECT cluster, value - lag(value, {season}) OVER (PARTITION BY cluster ORDER BY t) AS d
    FROM parts WHERE split = 'train') GROUP BY 1),
scores AS (
  SELECT cluster, model, split, count(*) AS n, avg(e) AS me, sqrt(avg(e * e)) AS rmse,
    avg(abs(e)) AS mae, avg(100 * e / value) AS mpe, avg(abs(100 * e / value)) AS mape,
    sum((e - err.me) * (pe - err.me)) / sum((e - err.me) * (e - err.me)) AS acf1,
    sqrt(sum(pow(e / pv, 2)) / sum(pow((value - pv) / pv, 2))) AS theils_u,
    avg(abs(e)) / any_value(s) AS mase
  FROM err JOIN scale USING (cluster) GROUP BY 1, 2, 3)"""


SCORED = f"""
sc AS (
  {" UNION ALL ".join(
    f"SELECT *, '{name}' AS model, {trailing(order)} AS f FROM parts"
    for name, order in (("mean_3", 3), ("mean_6", 6), ("last_value", 1))
  )})"""
_SCORES = ("me", "rmse", "mae", "mpe", "mape", "acf1", "theils_u", "mase")
query(
    "accuracy",
    [*MONTH, SPLIT, SCORED, errors(12)],
    "SELECT cluster, model, split, n, "
    + ", ".join(f"{q4(c)} AS {c}" for c in _SCORES)
    + " FROM scores",
)
query(
    "accuracy_daily",
    [
        *DAYS_HOLT,
        """sc AS (
  SELECT parts.*, 'holt_fixed' AS model, mean AS f
  FROM parts JOIN path USING (cluster, t) WHERE split = 'valid')""",
        errors(7),
    ],
    ORACLES["accuracy"].rpartition("\n")[2],
)
query(
    "best_model",
    [*MONTH, SPLIT, SCORED, errors(12)],
    f"""SELECT cluster, first(model ORDER BY rmse, model) AS best_model,
  {q4("min(rmse)")} AS best_rmse, count(*) AS n_models
FROM scores WHERE split = 'valid' GROUP BY 1""",
)

# -- clustering -----------------------------------------------------------------------------

SCALED = "sca AS (SELECT *, {} FROM kpi)".format(
    ", ".join(
        f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0.0) AS z_{c}"
        for c in FEATURES
    )
)
_DISTANCES = ", ".join(
    "(" + " + ".join(f"pow(z_{c} - ({v}), 2)" for c, v in zip(FEATURES, centre)) + f") AS d{i + 1}"
    for i, centre in enumerate(CENTRES)
)
ASSIGNED = f"""
asg AS (SELECT *, CASE WHEN d1 <= d2 AND d1 <= d3 THEN '1' WHEN d2 <= d3 THEN '2' ELSE '3' END
    AS cluster
  FROM (SELECT *, {_DISTANCES} FROM sca))"""
BOTH = """
two AS (SELECT *, CAST(1 + seller_id % 3 AS VARCHAR) AS other FROM asg WHERE seller_id % 10 <> 9)"""
query(
    "seller_features_scaled",
    [*KPI, SCALED],
    "SELECT seller_id, " + ", ".join(f"{q4(f'z_{c}')} AS z_{c}" for c in FEATURES) + " FROM sca",
)
query("cluster_assign", [*KPI, SCALED, ASSIGNED], "SELECT seller_id, cluster FROM asg")
query(
    "cluster_profile",
    [*KPI, SCALED, ASSIGNED],
    "SELECT cluster, count(*) AS n, "
    + ", ".join(f"{q4(f'avg({c})')} AS mean_{c}" for c in ("n_orders", *FEATURES))
    + ", count(*) / sum(count(*)) OVER () AS share FROM asg GROUP BY 1",
)
query(
    "cluster_crosstab",
    [*KPI, SCALED, ASSIGNED, BOTH],
    """SELECT cluster, other, count(*) AS n,
  count(*) / sum(count(*)) OVER (PARTITION BY cluster) AS row_share FROM two GROUP BY 1, 2""",
)
query(
    "cluster_agreement",
    [*KPI, SCALED, ASSIGNED, BOTH],
    f"""SELECT CAST(any_value(n) AS BIGINT) AS n,
  {q4("(any_value(ab) - any_value(a) * any_value(b) / (any_value(n) * (any_value(n) - 1) / 2)) / ((any_value(a) + any_value(b)) / 2 - any_value(a) * any_value(b) / (any_value(n) * (any_value(n) - 1) / 2))")}
  AS adjusted_rand
FROM (SELECT sum(k * (k - 1) / 2) AS ab FROM (SELECT count(*) AS k FROM two GROUP BY cluster, other)),
  (SELECT sum(k * (k - 1) / 2) AS a, sum(k) AS n FROM (SELECT count(*) AS k FROM two GROUP BY cluster)),
  (SELECT sum(k * (k - 1) / 2) AS b FROM (SELECT count(*) AS k FROM two GROUP BY other))""",
)
