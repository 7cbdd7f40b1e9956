"""Revisits against the rules applied one by one."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from hazlake.llm import revisits
from hazlake.llm.checks import QUERIES, SQL
from tests.compare import differences

SCHEMA = "record_id long, url string, at timestamp, status int, headers map<string,string>, payload string"


@pytest.mark.parametrize(
    "url, place",
    [
        ("HTTP://User:pw@WWW.Example.org:80/a/b/?b=2&a=1&UTM_Source=x#f", "example.org/a/b/?a=1&b=2"),
        ("https://example.org", "example.org/"), ("https://example.org:8080/A", "example.org:8080/A/"), ("https://e.org?gclid=1", "e.org/"),
        ("ftp://example.org/a", None), ("", None), (None, None), ("https:///a", None),
    ],
)
def test_canonical(spark, url, place):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(revisits.canonical(F.col("u"))).first()[0] == place


def captures(seed=2):
    rng = random.Random(seed)
    rows = []
    for k in range(400):
        status = rng.choice([200, 304, 304, 404])
        headers = {}
        if rng.random() < 0.7:
            headers[rng.choice(["ETag", "etag"])] = rng.choice(['"a"', '"b"', 'W/"a"'])
        if rng.random() < 0.4:
            headers["Last-Modified"] = rng.choice(["Mon", "Tue"])
        headers |= {"Content-Length": str(k), "Date": str(k), "Connection": "close"}
        at = datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=rng.randint(0, 200)) if rng.random() < 0.95 else None
        url = rng.choice(["https://a.org/1", "http://www.A.org:80/1/#x", "https://a.org/2", None, "bad"])
        rows.append((k, url, at, status, headers if rng.random() < 0.95 else None, f"p{k}" if status == 200 else None))
    return rows


def place_of(url):
    return {"https://a.org/1": "a.org/1/", "http://www.A.org:80/1/#x": "a.org/1/", "https://a.org/2": "a.org/2/"}.get(url)


def brute(rows):
    out = []
    for k, url, at, status, headers, payload in rows:
        if status != 304:
            continue
        own = {n.lower(): v for n, v in (headers or {}).items()}
        place = place_of(url) if at is not None else None
        full = [r for r in rows if r[3] == 200 and place and r[2] and place_of(r[1]) == place and r[2] < at]
        if not place or not full:
            out.append((k, place, None, "no_earlier" if place else "no_place", own, payload))
            continue
        source = max(full, key=lambda r: (r[2], r[0]))
        stored = {n.lower(): v for n, v in (source[4] or {}).items()}
        tag, old = own.get("etag"), stored.get("etag")
        if tag is not None:
            weak = tag.startswith("W/") or (old or "").startswith("W/")
            good = old is not None and (tag.removeprefix("W/") == old.removeprefix("W/") if weak else tag == old)
            outcome = "resolved" if good else "changed"
        elif "last-modified" in own:
            outcome = "resolved" if own["last-modified"] == stored.get("last-modified") else "changed"
        else:
            outcome = "unconfirmed" if {"etag", "last-modified"} & stored.keys() else "resolved"
        if outcome == "resolved":
            own = stored | {n: v for n, v in own.items() if n not in ("content-length", "connection")}
            payload = source[5]
        out.append((k, place, source[0], outcome, own, payload))
    return sorted(out, key=lambda r: r[0])


@pytest.mark.parametrize("seconds", [revisits.SLICE_SECONDS, 3600, 10**9])
def test_equals_the_rules(spark, seconds):
    rows = captures()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "2 AS outcome").repartition(3)
    got = sorted(map(tuple, revisits.resolve(df, seconds).collect()), key=lambda r: r[0])
    assert got == brute(rows) and len({r[3] for r in got}) == 5


def test_repeated_rows_and_names(spark):
    day = datetime.datetime(2024, 1, 1)
    later = day + datetime.timedelta(days=3)
    rows = [(1, "https://a.org", day, 200, {"ETag": "1", "X": "old"}, "p")] * 2 + [(2, "https://a.org", later, 304, {"X": "a", "x": "new", "ETAG": "1"}, None)] * 2
    got = revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(2, "a.org/", 1, "resolved", {"etag": "1", "x": "new"}, "p")] * 2
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["op9_not_modified"](spark, folder), SQL["op9_not_modified"], folder) is None
