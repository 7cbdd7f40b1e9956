"""Values read out of JSON payload columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_PAYLOAD = "public_metrics map<string,double>, score double, num_comments double"


def engagement_score(source_type: Column, raw_payload: Column) -> Column:
    """Weighted reactions for twitter and reddit rows, null for other sources."""
    payload = F.from_json(raw_payload, _PAYLOAD)
    metrics = payload["public_metrics"]

    def metric(name: str) -> Column:
        return F.coalesce(metrics[name], F.lit(0.0))

    twitter = F.when(
        F.size(metrics) > 0,
        metric("retweet_count") * 2 + metric("like_count") + metric("reply_count") + metric("quote_count"),
    )
    reddit = F.coalesce(payload["score"], F.lit(0.0)) + F.coalesce(payload["num_comments"], F.lit(0.0)) * 1.5
    return F.when(source_type == "twitter", twitter).when(source_type == "reddit", reddit)
