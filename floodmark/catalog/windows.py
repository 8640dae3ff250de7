"""Windowed traffic aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import REQ, requests
from floodmark.operators import traffic


def _rate_sql(seconds: int) -> str:
    return f"""WITH {REQ},
r AS (SELECT row_id, src, count(*) OVER (PARTITION BY src ORDER BY ts_us RANGE BETWEEN {seconds * 1000000} PRECEDING AND CURRENT ROW) AS recent_requests FROM req)
SELECT row_id, src, recent_requests, round(recent_requests / {seconds}.0, 6) AS rate FROM r"""


@query("trailing_rate", _rate_sql(60).replace("/ 60.0", "/ 60.0::DOUBLE"))
def trailing_rate(spark, sf_dir):
    return rounded(traffic.trailing_rate(requests(spark, sf_dir)).select("row_id", "src", "recent_requests", "rate"))


@query("trailing_rate_day", _rate_sql(86400).replace("/ 86400.0", "/ 86400.0::DOUBLE"))
def trailing_rate_day(spark, sf_dir):
    rated = traffic.trailing_rate(requests(spark, sf_dir), seconds=86400)
    return rounded(rated.select("row_id", "src", "recent_requests", "rate"))


def window_sql(size: int, slide: int, source: str = REQ, having: str = "") -> str:
    us, step = size * 1_000_000, slide * 1_000_000
    return f"""WITH {source},
s AS (SELECT *, (ts_us // {step} - unnest(range(0, {-(-size // slide)}))) * {step} AS window_start_us FROM req),
w AS (SELECT * FROM s WHERE window_start_us + {us} > ts_us)
SELECT src, window_start_us, count(*) AS request_count, round(count(*) / {size}.0::DOUBLE, 6) AS request_rate,
  count(DISTINCT path) AS unique_paths, round(count(*) FILTER (status // 100 = 2) / count(*)::DOUBLE, 6) AS share_2xx,
  round(count(*) FILTER (status // 100 = 4) / count(*)::DOUBLE, 6) AS share_4xx,
  round(count(*) FILTER (status // 100 = 5) / count(*)::DOUBLE, 6) AS share_5xx, round(avg(payload), 6) AS mean_payload
FROM w GROUP BY src, window_start_us {having}"""


@query("traffic_window_tumbling", window_sql(10, 10))
def traffic_window_tumbling(spark, sf_dir):
    return rounded(traffic.traffic_window(requests(spark, sf_dir), 10))


@query("traffic_window_sliding", window_sql(60, 10))
def traffic_window_sliding(spark, sf_dir):
    return rounded(traffic.traffic_window(requests(spark, sf_dir), 60, 10))


@query("traffic_window_uneven", window_sql(60, 25))
def traffic_window_uneven(spark, sf_dir):
    """The slide does not divide the size: panes of their greatest common divisor."""
    return rounded(traffic.traffic_window(requests(spark, sf_dir), 60, 25))


@query("traffic_window_day", window_sql(86400, 21600))
def traffic_window_day(spark, sf_dir):
    return rounded(traffic.traffic_window(requests(spark, sf_dir), 86400, 21600))


@query("temporal_profile", """WITH c AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) AS INTEGER) AS day_of_week, count(*) AS n FROM events GROUP BY 1, 2)
SELECT hour, day_of_week, n, round(avg(n) OVER (PARTITION BY hour), 6) AS usual_n,
  round(coalesce((n - avg(n) OVER (PARTITION BY hour)) / nullif(stddev_pop(n) OVER (PARTITION BY hour), 0), 0), 6) + 0.0 AS deviation FROM c""")
def temporal_profile(spark, sf_dir):
    return rounded(traffic.temporal_profile(requests(spark, sf_dir)))
