"""HTTP features and label and score expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from floodmark.catalog.registry import query, rounded
from floodmark.catalog.standins import DIRTY, JUDGED, REQ, dirty_flows, judged_flows, requests, table
from floodmark.functions import http, scores

_WORDS = "|".join(w.replace(".", "\\.") for w in http.SUSPICIOUS_KEYWORDS)
_SPECIAL = r"""[!@#$%^&*()+=\[\]{};:''",<>?/\\|`~]"""


def entropy_sql(text: str) -> str:
    """Entropy through a correlated sum over the distinct characters."""
    return (
        f"coalesce((SELECT -sum(c / t * log2(c / t)) FROM (SELECT count(*)::DOUBLE AS c, (sum(count(*)) OVER ())::DOUBLE AS t "
        f"FROM (SELECT unnest(string_split({text}, '')) AS ch) GROUP BY ch)), 0.0)"
    )


_QUERY = "CASE WHEN contains(split_part(url, '#', 1), '?') THEN substr(split_part(url, '#', 1), instr(split_part(url, '#', 1), '?') + 1) ELSE '' END"
_NAMES = f"len(list_distinct(list_transform(list_filter(string_split({_QUERY}, '&'), lambda x: x LIKE '%=_%'), lambda x: url_decode(split_part(x, '=', 1)))))"


def pages_sql(columns: str) -> str:
    return f"SELECT page_id, {columns} FROM pages"


@query("url_length", pages_sql("CAST(length(url) AS INTEGER) AS url_length"))
def url_length(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", http.url_length("url").alias("url_length"))


@query("num_parameters", pages_sql(f"CAST({_NAMES} AS INTEGER) AS num_parameters"))
def num_parameters(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", http.num_parameters("url").alias("num_parameters"))


@query("num_special_chars", pages_sql(f"CAST(len(regexp_extract_all(url, '{_SPECIAL}')) AS INTEGER) AS num_special_chars"))
def num_special_chars(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", http.num_special_chars("url").alias("num_special_chars"))


_ENTROPY = """WITH chars AS (SELECT page_id, unnest(string_split({text}, '')) AS ch FROM pages),
c AS (SELECT page_id, ch, count(*)::DOUBLE AS n FROM chars GROUP BY ALL),
t AS (SELECT page_id, sum(n) AS total FROM c GROUP BY 1),
e AS (SELECT page_id, round(-sum(n / total * log2(n / total)), 6) + 0.0 AS url_entropy FROM c JOIN t USING (page_id) GROUP BY 1)"""


@query("shannon_entropy", _ENTROPY.format(text="url") + " SELECT page_id, url_entropy FROM e")
def shannon_entropy(spark, sf_dir):
    return rounded(table(spark, sf_dir, "pages").select("page_id", http.shannon_entropy("url").alias("url_entropy")))


@query("html_entropy", _ENTROPY.format(text="html") + " SELECT page_id, url_entropy AS html_entropy FROM e")
def html_entropy(spark, sf_dir):
    return rounded(table(spark, sf_dir, "pages").select("page_id", http.shannon_entropy("html").alias("html_entropy")))


@query("has_suspicious_keywords", pages_sql(f"CAST(regexp_matches(lower(url), '{_WORDS}') AS INTEGER) AS has_suspicious_keywords"))
def has_suspicious_keywords(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", http.has_suspicious_keywords("url").alias("has_suspicious_keywords"))


@query("method_flags", f"""WITH {REQ} SELECT row_id, CAST(method = 'GET' AS INTEGER) AS method_get, CAST(method = 'POST' AS INTEGER) AS method_post FROM req""")
def method_flags(spark, sf_dir):
    return requests(spark, sf_dir).select("row_id", http.method_get("method").alias("method_get"), http.method_post("method").alias("method_post"))


@query("text_length_features", f"""WITH {REQ} SELECT row_id, CAST(coalesce(length(user_agent), 3) AS INTEGER) AS user_agent_length,
  CAST(coalesce(length(user_agent), 0) AS INTEGER) AS user_agent_length_fixed, CAST(length(path) AS INTEGER) AS content_length FROM req""")
def text_length_features(spark, sf_dir):
    return requests(spark, sf_dir).select(
        "row_id",
        http.user_agent_length("user_agent").alias("user_agent_length"),
        http.user_agent_length("user_agent", fix_null=True).alias("user_agent_length_fixed"),
        http.content_length("path").alias("content_length"),
    )


@query("presence_flags", f"""WITH {REQ} SELECT row_id, CAST(user_agent IS NOT NULL AND user_agent <> '' AS INTEGER) AS has_cookie,
  CAST(method = 'POST' AS INTEGER) AS has_content_type FROM req""")
def presence_flags(spark, sf_dir):
    return requests(spark, sf_dir).select(
        "row_id",
        http.presence("user_agent").alias("has_cookie"),
        http.presence(F.when(F.col("method") == "POST", "text/html").otherwise("")).alias("has_content_type"),
    )


@query("http_features", _ENTROPY.format(text="url") + f"""
SELECT page_id, CAST(length(url) AS INTEGER) AS url_length, CAST({_NAMES} AS INTEGER) AS num_parameters,
  CAST(len(regexp_extract_all(url, '{_SPECIAL}')) AS INTEGER) AS num_special_chars, url_entropy,
  CAST(regexp_matches(lower(url), '{_WORDS}') AS INTEGER) AS has_suspicious_keywords,
  CAST(page_id % 2 = 0 AS INTEGER) AS method_get, CAST(page_id % 2 = 1 AS INTEGER) AS method_post,
  3 AS user_agent_length, CAST(length(html) AS INTEGER) AS content_length, 0 AS has_cookie, 0 AS has_content_type
FROM pages JOIN e USING (page_id)""")
def http_features(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.when(F.col("page_id") % 2 == 0, "GET").otherwise("POST").alias("method"),
        F.lit(None).cast("string").alias("user_agent"),
        F.col("html").alias("content"),
        F.lit("").alias("cookie"),
    )
    return rounded(http.http_features(pages, keep=["page_id"]))


@query("path_features", f"""WITH {REQ},
chars AS (SELECT row_id, unnest(string_split(path, '')) AS ch FROM req),
c AS (SELECT row_id, ch, count(*)::DOUBLE AS n FROM chars GROUP BY ALL),
e AS (SELECT row_id, round(-sum(n / length(path) * log2(n / length(path))), 6) AS path_entropy FROM c JOIN req USING (row_id) GROUP BY 1)
SELECT row_id, CAST(length(path) AS INTEGER) AS path_length, CAST(len(string_split(rtrim(path, '/'), '/')) AS INTEGER) AS path_depth,
  1 AS query_params_count, path_entropy FROM req JOIN e USING (row_id)""")
def path_features(spark, sf_dir):
    return rounded(requests(spark, sf_dir).select("row_id", *http.path_features("path", "query")))


@query("time_features", """SELECT event_id AS row_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) AS INTEGER) AS day_of_week,
  CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS is_weekend FROM events""")
def time_features(spark, sf_dir):
    return requests(spark, sf_dir).select("row_id", *http.time_features("ts"))


@query("user_agent_features", f"""WITH {REQ}, a AS (SELECT row_id, lower(user_agent) AS u FROM req),
b AS (SELECT row_id, u, CASE WHEN regexp_matches(u, 'edge?/') THEN 'edge' WHEN regexp_matches(u, 'chrome/|chromium/') THEN 'chrome'
  WHEN regexp_matches(u, 'firefox/') THEN 'firefox' WHEN regexp_matches(u, 'safari/') THEN 'safari' ELSE 'other' END AS browser FROM a)
SELECT row_id, CAST(coalesce(contains(u, 'bot'), false) AS INTEGER) AS is_bot, browser,
  {', '.join(f"CAST(browser = '{f}' AS INTEGER) AS browser_{f}" for f, _ in http.BROWSER_PATTERNS)} FROM b""")
def user_agent_features(spark, sf_dir):
    return requests(spark, sf_dir).select("row_id", *http.user_agent_features("user_agent"))


@query("status_class", f"""WITH {REQ} SELECT row_id, {', '.join(f'CAST(status // 100 = {h} AS INTEGER) AS status_{h}xx' for h in (2, 4, 5))} FROM req""")
def status_class(spark, sf_dir):
    return requests(spark, sf_dir).select("row_id", *http.status_class("status"))


@query("one_hot", f"""WITH {REQ} SELECT row_id, {', '.join(f"CAST(event_type = '{v}' AS INTEGER) AS type_{v}" for v in ('view', 'click', 'other'))} FROM req""")
def one_hot(spark, sf_dir):
    return requests(spark, sf_dir).select("row_id", *http.one_hot("event_type", ["view", "click", "other"], "type"))


@query("binary_label", f"""WITH {DIRTY} SELECT row_id, CASE WHEN "Label" IS NOT DISTINCT FROM 'Benign' THEN 1 ELSE -1 END AS y,
  CASE "Label" WHEN 'Attack' THEN -1 WHEN 'Benign' THEN 1 END AS y_strict FROM dirty""")
def binary_label(spark, sf_dir):
    renamed = F.when(F.col("Label") == "Benign", "Normal").when(F.col("Label") == "Attack", "Anomalous").otherwise(F.col("Label"))
    return dirty_flows(spark, sf_dir).select(
        "row_id", scores.binary_label("Label").alias("y"), scores.binary_label(renamed, "strict").alias("y_strict")
    )


@query("minmax_score", f"""WITH {JUDGED}, m AS (SELECT min(score_b) AS a, max(score_b) AS b FROM judged)
SELECT row_id, round((score_b - a) / (b - a), 6) + 0.0 AS score_01, round(1.0 - (score_b - a) / (b - a), 6) + 0.0 AS inverted FROM judged, m""")
def minmax_score(spark, sf_dir):
    df = judged_flows(spark, sf_dir).select("row_id", "score_b")
    scaled = scores.minmax_score(scores.minmax_score(df, "score_b"), "score_b", "inverted", invert=True)
    return rounded(scaled.drop("score_b"))


@query("sigmoid_score", f"""WITH {JUDGED} SELECT row_id, round(1.0 / (1.0 + exp(score_b - 0.5)), 6) AS score FROM judged""")
def sigmoid_score(spark, sf_dir):
    return rounded(judged_flows(spark, sf_dir).select("row_id", scores.sigmoid_score(F.col("score_b") - 0.5).alias("score")))
