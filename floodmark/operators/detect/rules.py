"""Rule detectors and proxy labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.functions.http import is_bot
from floodmark.functions.scores import ANOMALY, NORMAL

# Countries of the rule baseline.
WATCHED_COUNTRIES = ["CN", "RU", "KP"]
# The feature pattern table (rate per second, path entropy in bits, payload bytes).
PATTERN_RATE, PATTERN_ENTROPY, PATTERN_PAYLOAD = 1000.0, 4.0, 1024 * 1024
SCRIPTED_AGENTS = "curl|wget|python|scrapy|httpclient|bot"


def _holds(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def rules_basic(rate: str = "rate", status: str = "status") -> dict[str, Column]:
    """More than 50 requests per second, or a 5xx status."""
    return {"rate_over_50": F.col(rate) > 50, "status_5xx": F.floor(F.col(status) / 100) == 5}


def rules_traffic(rate: str = "rate", share_5xx: str = "share_5xx", country: str = "country", user_agent: str = "user_agent") -> dict[str, Column]:
    """Rate over 100/s, more than 10 % of 5xx, watched country, bot user agent."""
    return {
        "rate_over_100": F.col(rate) > 100,
        "share_5xx_over_10pct": F.col(share_5xx) > 0.10,
        "watched_country": F.col(country).isin(WATCHED_COUNTRIES),
        "bot_agent": is_bot(user_agent) == 1,
    }


def rules_patterns(rate: str = "rate", path_entropy: str = "path_entropy", payload: str = "payload", user_agent: str = "user_agent") -> dict[str, Column]:
    """Flood rate, random path, large payload, missing or scripted user agent."""
    agent = F.lower(F.col(user_agent))
    return {
        "flood_rate": F.col(rate) >= PATTERN_RATE,
        "random_path": F.col(path_entropy) > PATTERN_ENTROPY,
        "large_payload": F.col(payload) > PATTERN_PAYLOAD,
        "scripted_agent": F.col(user_agent).isNull() | (agent == "") | agent.rlike(SCRIPTED_AGENTS),
    }


def rule_baseline(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``reasons`` (names of the rules that hold) and ``y_pred``."""
    named = F.array(*[F.when(_holds(rule), name) for name, rule in rules.items()])
    out = df.withColumn("reasons", F.array_compact(named))
    return out.withColumn("y_pred", F.when(F.size("reasons") > 0, ANOMALY).otherwise(NORMAL))


def proxy_labels(
    df: DataFrame, status: str = "status", blacklisted: str = "blacklisted", rate: str = "rate", user_agent: str = "user_agent"
) -> DataFrame:
    """1 for an error status, a listed source, more than 100 requests per second, or a bot agent."""
    suspicious = (
        _holds(F.col(status) >= 400)
        | _holds(F.col(blacklisted) == 1)
        | _holds(F.col(rate) > 100)
        | (is_bot(user_agent) == 1)
    )
    return df.withColumn("proxy_label", suspicious.cast("int"))
