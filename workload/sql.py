"""Common table expressions shared by the comparison SQL."""

from __future__ import annotations

from workload.comparable import sql_select

PANEL = """panel AS (
  SELECT l_returnflag || l_linestatus AS entity, CAST(l_shipdate AS DATE) AS day,
         max(l_extendedprice) AS price_max, min(l_extendedprice) AS price_min,
         avg(l_extendedprice) AS price_mean, avg(l_quantity) AS qty_mean,
         sum(l_quantity) AS qty_sum, max(l_quantity) AS qty_max,
         avg(l_discount) * 100 AS disc_mean, avg(l_tax) * 100 AS tax_mean,
         avg(l_linenumber) AS line_mean
  FROM lineitem GROUP BY 1, 2)"""

NATION_PANEL = PANEL.replace("l_returnflag || l_linestatus AS entity", "n_name AS entity").replace(
    "FROM lineitem",
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON s_nationkey = n_nationkey",
)

WINDOWED = """windowed AS (
  SELECT *, year(day) AS year, month(day) AS month, dayofyear(day) AS day_of_year,
         lag(price_mean, 1) OVER w AS price_mean_lag1,
         lag(disc_mean, 1) OVER w AS disc_mean_lag1,
         lag(tax_mean, 1) OVER w AS tax_mean_lag1,
         lag(qty_mean, 1) OVER w AS qty_mean_lag1,
         lag(qty_max, 1) OVER w AS qty_max_lag1,
         lag(line_mean, 1) OVER w AS line_mean_lag1,
         lag(price_mean, 2) OVER w AS price_mean_lag2,
         avg(price_mean) OVER w3 AS price_avg_3d,
         avg(price_mean) OVER w7 AS price_avg_7d,
         avg(disc_mean) OVER w3 AS disc_avg_3d,
         avg(tax_mean) OVER w3 AS tax_avg_3d,
         sum(qty_mean) OVER w7 AS qty_sum_7d,
         tax_mean - lag(tax_mean, 1) OVER w AS tax_change,
         lead(price_mean, 1) OVER w AS price_tomorrow,
         CASE WHEN lead(qty_mean, 1) OVER w >= 27 THEN 1
              WHEN lead(qty_mean, 1) OVER w < 27 THEN 0 END AS high_qty_tomorrow
  FROM panel
  WINDOW w AS (PARTITION BY entity ORDER BY day),
         w3 AS (PARTITION BY entity ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         w7 AS (PARTITION BY entity ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""

FEATURES = """features AS (
  SELECT * FROM windowed
  WHERE price_mean_lag2 IS NOT NULL AND price_tomorrow IS NOT NULL)"""

REQUESTS = """requests AS (
  SELECT o_orderkey AS request_id,
         CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'AF' WHEN '2' THEN 'AO'
              WHEN '3' THEN 'NF' WHEN '4' THEN 'RO' ELSE 'ZZ' END AS entity,
         CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey % 9 AS DOUBLE) / 10 AS threshold
  FROM orders)"""

MEASURES = (
    "price_max:d price_min:d price_mean:d qty_mean:d qty_sum:d qty_max:d "
    "disc_mean:d tax_mean:d line_mean:d"
)
CALENDAR = "year:i month:i day_of_year:i"
LAGS = (
    "price_mean_lag1:d disc_mean_lag1:d tax_mean_lag1:d qty_mean_lag1:d qty_max_lag1:d "
    "line_mean_lag1:d price_mean_lag2:d"
)
ROLLINGS = "price_avg_3d:d price_avg_7d:d disc_avg_3d:d tax_avg_3d:d qty_sum_7d:d"
TARGETS = "price_tomorrow:d high_qty_tomorrow:i"
SCORING = f"entity:s day:t {MEASURES} {CALENDAR} {LAGS} {ROLLINGS} tax_change:d"
TRAINING = f"{SCORING} {TARGETS}"


def on_panel(columns: str, source: str, *ctes: str) -> str:
    return f"WITH {', '.join([PANEL, *ctes])} " + sql_select(columns, source)


def on_windowed(columns: str, source: str = "windowed", *ctes: str) -> str:
    return on_panel(columns, source, WINDOWED, *ctes)


def on_features(columns: str, source: str = "features", *ctes: str) -> str:
    return on_panel(columns, source, WINDOWED, FEATURES, *ctes)
