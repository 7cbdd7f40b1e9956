"""Edge rows of every rule, with results worked out by hand."""

import hashlib

import pytest
from pyspark.sql import functions as F

from hazlake.functions import media, text
from hazlake.functions.classify import hazard_severity, hazard_type, keyword_hits
from hazlake.functions.payload import engagement_score
from hazlake.functions.times import iso_utc, parse_feed_date
from hazlake.operators import dedupe, ml_export, normalize, reports
from hazlake.schemas import LAKE, LAKE_COLUMNS
from hazlake.sources.articles import article_text, lead_image
from hazlake.sources.bronze import malformed, parse_lines
from hazlake.taxonomy import Taxonomy


def values(spark, expression, rows, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.select(expression.alias("v"), "i").orderBy("i").select("v").collect()]


def lines(spark, *rows):
    return parse_lines(spark.createDataFrame([(r,) for r in rows], "line string"))


def silver(spark, *rows):
    return normalize.normalize(lines(spark, *rows)).collect()


def test_malformed_lines(spark):
    bad = ["{bad", "{'a':1}", '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}}', "5", "[1]"]
    good = ['{"a":1}', '{"a":null,"b":{"c":[1,2]}}', "{}"]
    found = malformed(spark.createDataFrame([(r,) for r in bad + good], "line string"))
    assert sorted(r["line"] for r in found.collect()) == sorted(bad)


def test_shape_goes_by_key_presence(spark):
    rows = [
        '{"temperature_c":null,"location_name":"A"}', '{"source_url":null,"local_path":"x"}',
        '{"source_type":"rss"}', '{"foo":1}', '{"temperature_c":1}',
    ]
    parsed = lines(spark, *rows)
    pairs = parsed.select("shape", normalize.bronze_shape()).collect()
    assert [tuple(p) for p in pairs] == [
        ("weather", "weather"), ("media", "media"), ("text", "text"), ("unknown", "text"), ("unknown", "text"),
    ]


@pytest.mark.parametrize(
    "body,hazard,severity",
    [
        ("Flood and landslide", "FLOOD", "INFO"),
        ("isosceles flood", "FLOOD", "CRITICAL"),
        ("a blaze, orange ALERT", "FIRE", "WARNING"),
        ("x" * 500 + "flood", "FLOOD", "INFO"),
        ("x" * 495 + "flood", "FLOOD", "INFO"),
        ("nothing here, sos", None, None),
    ],
)
def test_text_labels(spark, body, hazard, severity):
    row = silver(spark, f'{{"source_type":"RSS","record_id":"1","collected_at":"2024-01-01T00:00:00","text":"{body}"}}')[0]
    assert (row["hazard_type"], row["hazard_severity"], row["source_type"]) == (hazard, severity, "rss")


def test_label_options(spark):
    no_words = F.array().cast("array<string>")
    whole = Taxonomy(scan_chars=None, word_boundary=True)
    rows = [("x " * 400 + "flood sos",), ("floods",), ("isosceles flood",)]
    assert values(spark, hazard_type(no_words, F.col("t"), whole), rows, "t string") == ["FLOOD", None, "FLOOD"]
    assert values(spark, hazard_severity(no_words, F.col("t"), whole), rows, "t string") == ["CRITICAL", "INFO", "INFO"]
    marked = hazard_severity(no_words, F.col("t"), condition=F.col("c"))
    assert values(spark, marked, [("sos", "[WARNING] x"), ("", "CRITICAL WARNING"), ("sos", "mist")], "t string, c string") == [
        "WARNING", "CRITICAL", "CRITICAL",
    ]


@pytest.mark.parametrize(
    "rain,condition,hazard,severity",
    [
        (35.0, "rain", "CLOUDBURST", "CRITICAL"), (15.0, "rain", "CLOUDBURST", "WARNING"), (14.9, "rain", None, "INFO"),
        (0, "thunderstorm with heavy rain", "CLOUDBURST", "INFO"), (0, "[CRITICAL RAINFALL] mist", None, "CRITICAL"),
    ],
)
def test_weather_labels(spark, rain, condition, hazard, severity):
    row = silver(
        spark,
        f'{{"temperature_c":1,"location_name":"A","collected_at":"2024-01-01T00:00:00","rainfall_mm":{rain},"condition":"{condition}"}}',
    )[0]
    assert (row["hazard_type"], row["hazard_severity"]) == (hazard, severity)
    assert (row["record_id"], row["source_name"], row["text"]) == ("weather_A_2024-01-01T00:00:00", "openweathermap", None)


def test_defaults_and_drops(spark):
    rows = silver(
        spark, '{"source_type":null,"collected_at":"2024-01-01"}', '{"source_type":"x"}', '{"foo":1}',
        '{"source_url":"","local_path":null,"collected_at":"2024-01-01","media_type":"image"}',
    )
    text_row, media_row = sorted(rows, key=lambda r: r["source_type"])
    assert (text_row["record_id"], text_row["language"], text_row["keywords_hit"], text_row["media_urls"]) == ("", "en", [], [])
    assert (media_row["record_id"], media_row["media_urls"], media_row["hazard_type"]) == ("", [], None)
    assert text_row.__fields__ == LAKE_COLUMNS and len(LAKE_COLUMNS) == 27


def test_engagement(spark):
    rows = [
        ("twitter", '{"public_metrics":{"retweet_count":2,"like_count":3,"reply_count":1,"quote_count":1}}'),
        ("twitter", "{}"), ("twitter", '{"public_metrics":{}}'), ("twitter", '{"public_metrics":{"like_count":null}}'),
        ("reddit", '{"score":4,"num_comments":2}'), ("reddit", "{}"), ("rss", '{"score":4}'),
    ]
    assert values(spark, engagement_score(F.col("s"), F.col("p")), rows, "s string, p string") == [
        9.0, None, None, 0.0, 7.0, 0.0, None,
    ]


def test_keyword_hits_keep_list_order(spark):
    rows = [("KERALA FLOOD after Assam Flood india",), (None,)]
    assert values(spark, keyword_hits(F.col("t")), rows, "t string") == [["flood India", "Kerala flood", "Assam flood"], []]


def test_clean_text(spark):
    rows = [("See https://a.b/c <b>now</b>  é",), ("हिन्दी",), ("",), (None,), ("a WWW.x.y b",), ("a\n\tb",)]
    assert values(spark, text.clean_text(F.col("t")), rows, "t string") == ["See now", None, None, None, "a b", "a b"]
    assert values(spark, text.clean_text(F.col("t"), keep_unicode=True), rows[:2], "t string") == ["See now é", "हिन्दी"]


def test_label_confidence(spark):
    rows = [("a b c d e f g h", ["Kerala flood"]), ("", ["x"]), ("a", []), ("a", ["b c"]), (None, ["x"]), ("a b c", ["x"])]
    got = values(spark, text.label_confidence(F.col("t"), F.col("k")), rows, "t string, k array<string>")
    assert got == [0.25, 0.0, 0.0, 1.0, 0.0, 0.3333]


@pytest.mark.parametrize("n,days", [(1, (1, 0, 0)), (2, (1, 0, 1)), (5, (4, 0, 1)), (6, (4, 1, 1)), (10, (8, 1, 1)), (12, (9, 1, 2))])
def test_split_days(spark, n, days):
    df = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, n + 1)], "date_partition string")
    rows = ml_export.temporal_split(df).collect()
    got = tuple(sum(r["split"] == s for r in rows) for s in ("train", "val", "test"))
    assert got == days
    by = {s: [r["date_partition"] for r in rows if r["split"] == s] for s in ("train", "val", "test")}
    assert max(by["train"]) < min(by["val"] or by["test"] or ["9"])


def test_engagement_scaling(spark):
    rows = [("a", 4.0), ("a", -2.0), ("a", None), ("b", -1.0), ("c", None), ("b", 0.0)]
    df = spark.createDataFrame(rows, "source_type string, engagement_score double")
    got = sorted((tuple(r) for r in ml_export.scale_engagement(df).collect()), key=repr)
    assert got == sorted([("a", 1.0), ("a", -0.5), ("a", None), ("b", -1.0), ("c", None), ("b", 0.0)], key=repr)


def test_media_links(spark):
    rows = [
        ("https://www.NDTV.com/a.jpg",), ("https://xndtv.com/a.jpg",), ("https://ndtv.com/uploads/a.jpg",),
        ("https://u:p@img.ndtv.com:8080/a b.PNG?x",), ("ndtv.com/a.jpg",), ("https://ndtv.com/Banner.jpg",),
    ]
    assert values(spark, media.is_relevant_url(F.col("u")), rows, "u string") == [True, False, False, True, False, False]
    kinds = [
        ("https://h/a.JPG?x=1.mp4", ""), ("https://h/v.webm#t", ""), ("https://h/a", "image/png"), ("https://h/a", ""),
        ("https://h/.jpg", ""), ("https://h/a.jpg/", ""), ("https://h/a.mov;v=1", ""), ("https://h/x.txt", "video/mp4"),
    ]
    assert values(spark, media.media_type(F.col("u"), F.col("c")), kinds, "u string, c string") == [
        "image", "video", "image", None, None, "image", "video", "video",
    ]
    names = values(spark, media.local_name(F.col("u"), F.col("k")), [("a", "image"), ("https://h/b.MP4", "video")], "u string, k string")
    assert names == ["images/0cc175b9c0f1b6a831c399e269772661.jpg", "videos/" + hashlib.md5(b"https://h/b.MP4").hexdigest() + ".mp4"]


def test_size_gate(spark):
    rows = [
        ("image", 10, 300, 200), ("image", 10, 299, 500), ("image", 10, None, None), ("image", 10, -1, -1),
        ("video", 10, 1, 1), ("video", 10 * 1024 * 1024 + 1, None, None), ("image", 10 * 1024 * 1024, 300, 200),
    ]
    gate = media.passes_size_gate(F.col("k"), F.col("n"), F.col("w"), F.col("h"))
    assert values(spark, gate, rows, "k string, n long, w int, h int") == [True, False, True, True, True, False, True]


def test_feed_dates(spark):
    rows = [
        ("Mon, 01 Jan 2024 10:00:00 +0530",), ("1 Jan 2024 10:00:00 GMT",), ("2024-01-01T10:00:00.5+00:00",),
        ("2024-01-01 10:00:00",), ("yesterday",), ("10:00:00",), (None,),
    ]
    assert values(spark, iso_utc(parse_feed_date(F.col("t"))), rows, "t string") == [
        "2024-01-01T04:30:00+00:00", "2024-01-01T10:00:00+00:00", "2024-01-01T10:00:00.500000+00:00",
        "2024-01-01T10:00:00+00:00", None, None, None,
    ]


def test_article_pages(spark):
    page = (
        '<html><head><meta content="https://i/x.jpg?a=1&amp;b" property="og:image"><script>var t="<p>no</p>";</script></head>'
        "<body><div><p class='x'>One <b>two</b>&nbsp;</p>skip<p>Three &amp;lt; &#8217;&#x41;<br>four<p>Five</div>tail</body></html>"
    )
    twitter = '<meta property="og:image" content="/rel.png"><meta name="twitter:image" content="http://t/y.png"><pre>no</pre>'
    rows = [(page,), (twitter,), ("<p></p>",), (None,)]
    assert values(spark, article_text(F.col("h")), rows, "h string") == ["One two Three &lt; ’A four Five", "", "", ""]
    assert values(spark, article_text(F.col("h"), 7), rows[:1], "h string") == ["One two"]
    odd = "<p>&#0000039;&#x01F600;&eacute;&#55357;&#150;&amp;eacute;&#38;lt;&nosuch;&#99999999999;&NotEqualTilde;&Eacute;</p>"
    assert values(spark, article_text(F.col("h")), [(odd,)], "h string") == ["'😀é\ufffd–&eacute;&lt;&nosuch;\ufffd≂̸É"]
    assert values(spark, lead_image(F.col("h")), rows, "h string") == ["https://i/x.jpg?a=1&b", "http://t/y.png", None, None]


def test_first_arrival_does_not_depend_on_row_order(spark):
    rows = [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), ("m", 5, "x")]
    pick = lambda rs: sorted(
        tuple(r) for r in dedupe.first_arrival(spark.createDataFrame(rs, "k string, t int, v string"), ["k"], [F.col("t")]).collect()
    )
    assert pick(rows) == pick(rows[::-1]) and [r[:2] for r in pick(rows)] == [("k", 1), ("m", 5)]


def test_empty_lake_reports(spark):
    empty = spark.createDataFrame([], LAKE)
    assert reports.totals(empty).first().asDict()["total"] == 0
    for report in (reports.lake_stats, reports.hazard_summary, reports.class_distribution, reports.source_coverage):
        assert report(empty).count() == 0
    assert [r["hazard_type"] for r in reports.low_sample_classes(empty, expected=["FIRE"]).collect()] == ["FIRE"]
    assert ml_export.ml_dataset(empty).count() == 0
