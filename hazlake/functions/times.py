"""ISO and RFC 2822 times, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_iso(value: Column) -> Column:
    """Timestamp of any ISO form, with or without fraction or zone (none means UTC); else null."""
    # The date test keeps a bare clock time from being read as today's.
    return F.when(value.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(value))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text in UTC, with microseconds only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(whole, fraction, F.lit("+00:00"))


def parse_feed_date(value: Column) -> Column:
    """RFC 2822 (offset or zone name) first, then ISO; null when neither fits."""
    bare = F.regexp_replace(F.trim(value), r"^[A-Za-z]+,\s*", "")
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")),
        parse_iso(value),
    )


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "month": F.month(ts),
        "hour": F.hour(ts),
        "day_of_year": F.dayofyear(ts),
    }
