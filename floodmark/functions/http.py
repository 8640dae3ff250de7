"""HTTP request features as column expressions (no Python UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Substrings that mark a suspicious URL.
SUSPICIOUS_KEYWORDS = [
    "select", "union", "insert", "delete", "drop", "update",
    "script", "alert", "onerror", "onload", "../", "..",
    "exec", "execute", "cmd", "system",
]
# Characters counted as special (hyphen, underscore and dot are not among them).
SPECIAL_CHARACTERS = "!@#$%^&*()+=[]{};:'\",<>?/\\|`~"
# The feature columns, in order.
HTTP_FEATURES = [
    "url_length", "num_parameters", "num_special_chars", "url_entropy", "has_suspicious_keywords",
    "method_get", "method_post", "user_agent_length", "content_length", "has_cookie", "has_content_type",
]
# Browser family patterns over a lower-cased user agent; the first match wins.
BROWSER_PATTERNS = [
    ("edge", "edge?/"),
    ("chrome", "chrome/|chromium/"),
    ("firefox", "firefox/"),
    ("safari", "safari/"),
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def url_length(url: Column | str) -> Column:
    return F.coalesce(F.length(_col(url)), F.lit(0))


def query_string(url: Column | str) -> Column:
    """Text after the first ``?`` and before ``#``; empty when there is none."""
    before_fragment = F.substring_index(_col(url), "#", 1)
    at = F.instr(before_fragment, "?")
    return F.when(at > 0, before_fragment.substr(at + 1, F.length(before_fragment))).otherwise(F.lit(""))


def num_parameters(url: Column | str) -> Column:
    """Distinct decoded query names that carry a non-blank value."""
    pairs = F.filter(F.split(query_string(url), "&"), lambda p: p.like("%=_%"))
    names = F.transform(pairs, lambda p: F.substring_index(p, "=", 1))
    decoded = F.transform(names, lambda n: F.coalesce(F.try_url_decode(n), n))
    return F.coalesce(F.size(F.array_distinct(decoded)), F.lit(0))


def num_special_chars(url: Column | str) -> Column:
    pattern = "[" + "".join(re.escape(c) if c in "\\[]^-&" else c for c in SPECIAL_CHARACTERS) + "]"
    return F.coalesce(F.regexp_count(_col(url), F.lit(pattern)), F.lit(0))


def shannon_entropy(text: Column | str) -> Column:
    """Entropy in bits of the character distribution; empty or null text gives 0."""
    text = _col(text)
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    size = F.length(text).cast("double")
    # fold over the sorted characters: s = -sum(run * log2(run)), closing a run when the character changes
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("run"), F.lit(0.0).alias("s"))

    def closed(acc: Column) -> Column:
        return F.when(acc["run"] > 0, acc["s"] + acc["run"] * F.log2(acc["run"])).otherwise(acc["s"])

    def step(acc: Column, c: Column) -> Column:
        same = acc["c"] == c
        return F.struct(
            c.alias("c"),
            F.when(same, acc["run"] + 1.0).otherwise(1.0).alias("run"),
            F.when(same, acc["s"]).otherwise(closed(acc)).alias("s"),
        )

    folded = F.aggregate(chars, start, step, closed)
    return F.when(size > 0, F.log2(size) - folded / size).otherwise(0.0)


def has_suspicious_keywords(url: Column | str) -> Column:
    pattern = "|".join(re.escape(k) for k in SUSPICIOUS_KEYWORDS)
    return flag(F.lower(_col(url)).rlike(pattern))


def method_get(method: Column | str) -> Column:
    return flag(_col(method) == "GET")


def method_post(method: Column | str) -> Column:
    return flag(_col(method) == "POST")


def user_agent_length(user_agent: Column | str, fix_null: bool = False) -> Column:
    """Characters of the user agent. A missing cell counts 3 (the text ``nan``) unless ``fix_null``."""
    return F.coalesce(F.length(_col(user_agent)), F.lit(0 if fix_null else 3))


def content_length(content: Column | str) -> Column:
    return F.coalesce(F.length(_col(content)), F.lit(0))


def presence(value: Column | str) -> Column:
    return flag(_col(value) != "")


def http_features(df: DataFrame, url="url", method="method", user_agent="user_agent", content="content",
                  cookie="cookie", content_type="content_type", keep: list[str] = ()) -> DataFrame:
    """The eleven request features in fixed order, after the ``keep`` columns.

    A column the table lacks counts as absent for every row (length 0, flag 0).
    """
    def has(name):
        return name in df.columns

    values = [
        url_length(url),
        num_parameters(url),
        num_special_chars(url),
        shannon_entropy(url),
        has_suspicious_keywords(url),
        method_get(method),
        method_post(method),
        user_agent_length(user_agent) if has(user_agent) else F.lit(0),
        content_length(content) if has(content) else F.lit(0),
        presence(cookie) if has(cookie) else F.lit(0),
        presence(content_type) if has(content_type) else F.lit(0),
    ]
    return df.select(*keep, *[v.alias(n) for v, n in zip(values, HTTP_FEATURES)])


def path_features(path: Column | str, query: Column | str) -> list[Column]:
    """Length, depth (parts between slashes, trailing empty parts dropped), query names, entropy."""
    path, query = _col(path), _col(query)
    trimmed = F.regexp_replace(path, "/+$", "")
    depth = F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, "/"))).otherwise(0)
    return [
        url_length(path).alias("path_length"),
        F.coalesce(depth, F.lit(0)).alias("path_depth"),
        num_parameters(F.concat(F.lit("?"), query)).alias("query_params_count"),
        shannon_entropy(path).alias("path_entropy"),
    ]


def time_features(ts: Column | str) -> list[Column]:
    """Hour, weekday with Sunday = 0, weekend flag."""
    ts = _col(ts)
    weekday = F.dayofweek(ts) - 1
    return [
        F.hour(ts).alias("hour"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).cast("int").alias("is_weekend"),
    ]


def is_bot(user_agent: Column | str) -> Column:
    return flag(F.lower(_col(user_agent)).contains("bot"))


def browser_family(user_agent: Column | str) -> Column:
    text = F.lower(_col(user_agent))
    chain = F
    for family, pattern in BROWSER_PATTERNS:
        chain = chain.when(text.rlike(pattern), family)
    return chain.otherwise("other")


def user_agent_features(user_agent: Column | str) -> list[Column]:
    family = browser_family(user_agent)
    return [
        is_bot(user_agent).alias("is_bot"),
        family.alias("browser"),
        *[flag(family == f).alias(f"browser_{f}") for f, _ in BROWSER_PATTERNS],
    ]


def status_class(status: Column | str) -> list[Column]:
    hundred = F.floor(_col(status) / 100)
    return [flag(hundred == h).alias(f"status_{h}xx") for h in (2, 4, 5)]


def one_hot(column: Column | str, values: list, prefix: str) -> list[Column]:
    """One 0/1 column per value of a fixed vocabulary."""
    column = _col(column)
    return [flag(column == v).alias(f"{prefix}_{v}") for v in values]
