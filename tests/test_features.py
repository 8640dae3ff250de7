import math
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from floodmark.functions import http, scores

URLS = [
    None, "", "/a?x=1&x=2&y=", "/a?b", "/p?q=%41&A=1#f?z=1", "/../etc", "/SELECT", "a-b_c.d", "/x?%61=1&a=2", "/x?a=1&&b=2?c=3",
    "http://h/p?k=v#frag", "/p#f?k=v", "/%zz?%zz=1", "/path?a=b=c&d==", "!@#$%^&*()+=[]{};:'\",<>?/\\|`~-_.", "/üñí?ö=1", "/onError.JS",
]


@pytest.fixture(scope="module")
def urls(spark):
    return spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "row_id long, url string")


def test_url_features_follow_the_rules(urls):
    out = urls.select(
        "url", http.url_length("url").alias("n"), http.num_parameters("url").alias("p"), http.num_special_chars("url").alias("s"),
        http.shannon_entropy("url").alias("e"), http.has_suspicious_keywords("url").alias("k"),
    ).collect()
    for r in out:
        u = r.url or ""
        assert r.n == len(u)
        assert r.s == sum(c in http.SPECIAL_CHARACTERS for c in u)
        shares = [u.count(c) / len(u) for c in set(u)]
        assert math.isclose(r.e, -sum(p * math.log2(p) for p in shares), abs_tol=1e-9)
        assert r.k == int(any(w in u.lower() for w in http.SUSPICIOUS_KEYWORDS))
        assert r.p == len(parse_qs(urlparse(u).query)), u


def test_missing_cells_and_missing_columns(spark):
    df = spark.createDataFrame([(1, "/a", "GET", None, None, "", None), (2, None, "get", "ua", "body", "c=1", "text/html")],
                               "row_id long, url string, method string, user_agent string, content string, cookie string, content_type string")
    first, second = http.http_features(df, keep=["row_id"]).orderBy("row_id").collect()
    assert list(first.asDict())[1:] == http.HTTP_FEATURES
    assert (first.user_agent_length, first.content_length, first.has_cookie, first.has_content_type, first.method_get) == (3, 0, 0, 0, 1)
    assert (second.url_length, second.method_get, second.user_agent_length, second.content_length, second.has_cookie) == (0, 0, 2, 4, 1)
    bare = http.http_features(df.select("row_id", "url", "method")).first()
    assert bare.user_agent_length == 0 and bare.has_cookie == 0
    assert df.select(http.user_agent_length("user_agent", fix_null=True).alias("n")).first().n == 0


def test_path_depth_drops_trailing_parts(spark):
    df = spark.createDataFrame([("/api/users", "page=1"), ("/", ""), ("", ""), ("/a//", "a=1&b=2"), (None, None)], "path string, query string")
    got = [tuple(r)[:3] for r in df.select(*http.path_features("path", "query")).collect()]
    assert got == [(10, 3, 1), (1, 0, 0), (0, 0, 0), (4, 2, 2), (0, 0, 0)]


def test_time_features_count_from_sunday(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 12:34:56' AS ts UNION ALL SELECT timestamp_ntz'2024-01-07 03:00:00'")
    assert [tuple(r) for r in df.select(*http.time_features("ts")).orderBy("day_of_week").collect()] == [(3, 0, 1), (12, 1, 0)]


def test_labels_keep_missing_as_attack(spark):
    labels = ["Benign", "Label", None, "Attack", "Suspicious", "Normal", "Anomalous", "other"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    got = df.select(scores.binary_label("label").alias("a"), scores.binary_label("label", "strict").alias("b")).collect()
    assert [r.a for r in got] == [1, -1, -1, -1, -1, -1, -1, -1]
    assert [r.b for r in got] == [None, None, None, None, None, 1, -1, None]


def test_constant_score_scales_to_zero(spark):
    df = spark.range(3).withColumn("s", F.lit(4.0))
    assert {r.score_01 for r in scores.minmax_score(df, "s").collect()} == {0.0}
