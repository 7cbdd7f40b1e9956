"""Landed payloads built from the given tables, and what the parsers make of them."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazlake.functions.times import iso_utc, parse_feed_date
from hazlake.operators.dedupe import first_arrival
from hazlake.plans.checks import base as b
from hazlake.session import shared_dir
from hazlake.sources import payloads
from hazlake.sources.articles import article_text, lead_image

def _id() -> Column:
    return F.col("doc_id")


def _at() -> Column:
    return F.lit("2024-02-01T00:00:00+00:00")


_WITH_NULLS = {"ignoreNullFields": "false"}


def _str(col: Column) -> Column:
    return col.cast("string")


def _day_ts() -> Column:
    return F.timestamp_seconds(1_704_067_200 + (_id() % 30) * 86_400 + _id() * 7919 % 86_400)


_SQL_TS = "(TIMESTAMP '2024-01-01' + (doc_id % 30) * INTERVAL 1 DAY + (doc_id * 7919 % 86400) * INTERVAL 1 SECOND)"


def tweet_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page per document: the tweet, a reply without media, and the page's media list."""
    key = F.concat(F.lit("m"), _str(_id()))
    other = F.concat(F.lit("n"), _str(_id()))
    created = F.date_format(_day_ts(), "yyyy-MM-dd'T'HH:mm:ss'.000Z'")

    def tweet(tweet_id: Column, text: Column, attachments: Column, place: Column) -> Column:
        return F.struct(
            tweet_id.alias("id"), text.alias("text"), created.alias("created_at"), F.lit("7").alias("author_id"),
            attachments.alias("attachments"), F.struct(place.alias("place_id")).alias("geo"),
            F.struct((_id() % 5).alias("retweet_count"), (_id() % 3).alias("like_count")).alias("public_metrics"),
        )

    keys = F.struct(F.array(key, other, F.lit("absent")).alias("media_keys"))
    no_keys = F.struct(F.lit(None).cast("array<string>").alias("media_keys"))
    data = F.array(
        tweet(_str(_id()), F.col("text"), keys, F.when(_id() % 7 != 0, F.concat(F.lit("place"), _str(_id() % 10)))),
        tweet(F.concat(F.lit("r"), _str(_id())), F.lit("Reply of the day"), no_keys, F.lit(None).cast("string")),
    )

    def media(media_key: Column, url: Column, preview: Column) -> Column:
        return F.struct(media_key.alias("media_key"), url.alias("url"), preview.alias("preview_image_url"))

    none = F.lit(None).cast("string")
    listed = F.array(
        media(key, F.when(_id() % 2 == 0, F.concat(F.lit("https://img/"), key)), F.concat(F.lit("https://pre/"), key)),
        media(other, none, F.when(_id() % 3 == 0, F.concat(F.lit("https://pre/"), other))),
    )
    page = F.to_json(F.struct(data.alias("data"), F.struct(listed.alias("media")).alias("includes")), _WITH_NULLS)
    return b.load(spark, folder, "documents").select(page.alias("payload"))


def flat_text_records(records: DataFrame) -> DataFrame:
    return records.select(
        "source_type", "source_name", "record_id", "published_at", "url", "text", "language",
        F.array_join("keywords_hit", "|").alias("keywords_hit"), F.col("location.name").alias("location_name"),
        F.array_join("media_urls", "|").alias("media_urls"),
    )


def _sql_hits(text: str) -> str:
    return "array_to_string(" + b.SQL_HITS.replace("lower(text)", f"lower({text})") + ", '|')"


TWEETS_SQL = f"""
SELECT 'twitter' AS source_type, 'twitter' AS source_name, CAST(doc_id AS VARCHAR) AS record_id,
  strftime({_SQL_TS}, '%Y-%m-%dT%H:%M:%S+00:00') AS published_at, concat('https://twitter.com/i/web/status/', doc_id) AS url, text,
  'en' AS language, {_sql_hits('text')} AS keywords_hit,
  CASE WHEN doc_id % 7 <> 0 THEN concat('place', doc_id % 10) END AS location_name,
  concat(CASE WHEN doc_id % 2 = 0 THEN 'https://img/m' ELSE 'https://pre/m' END, doc_id,
         CASE WHEN doc_id % 3 = 0 THEN concat('|https://pre/n', doc_id) ELSE '' END) AS media_urls
FROM documents
UNION ALL SELECT 'twitter', 'twitter', concat('r', doc_id), strftime({_SQL_TS}, '%Y-%m-%dT%H:%M:%S+00:00'),
  concat('https://twitter.com/i/web/status/r', doc_id), 'Reply of the day', 'en', 'of the', NULL, '' FROM documents"""


@b.check(TWEETS_SQL)
def parse_tweet(spark: SparkSession, folder: str) -> DataFrame:
    return flat_text_records(payloads.parse_tweets(tweet_pages(spark, folder), _at(), keywords=b.KEYWORDS))


def _dup(docs: DataFrame) -> DataFrame:
    """Every third payload lands twice, as a second poll would bring it."""
    return docs.unionAll(docs.filter(_id() % 3 == 0))


def posts(spark: SparkSession, folder: str) -> DataFrame:
    post = F.struct(
        _str(_id()).alias("id"), F.concat(F.lit("Post "), _str(_id())).alias("title"), F.col("text").alias("selftext"),
        (_id() % 50 - 5).alias("score"), (_id() % 9).alias("num_comments"), F.col("source").alias("subreddit"),
        F.when(_id() % 4 != 0, F.lit("ann")).alias("author"),
        (F.lit(1_704_067_200) + (_id() % 30) * 86_400 + _id() * 7919 % 86_400 + F.when(_id() % 2 == 0, 0.5).otherwise(0.0)).alias("created_utc"),
        F.concat(F.lit("/r/x/"), _str(_id())).alias("permalink"),
        F.concat(F.lit("https://i.redd.it/"), _str(_id())).alias("url"), (_id() % 3 == 0).alias("is_self"),
    )
    return _dup(b.load(spark, folder, "documents")).select(F.to_json(post, _WITH_NULLS).alias("payload"))


@b.check(f"""
WITH p AS (SELECT *, concat('Post ', doc_id, ' ', text) AS body FROM documents),
q AS (SELECT *, {_sql_hits('body')} AS hits FROM p)
SELECT 'reddit' AS source_type, concat('reddit/r/', source) AS source_name, CAST(doc_id AS VARCHAR) AS record_id,
  concat(strftime({_SQL_TS}, '%Y-%m-%dT%H:%M:%S'), CASE WHEN doc_id % 2 = 0 THEN '.500000' ELSE '' END, '+00:00') AS published_at,
  concat('https://reddit.com/r/x/', doc_id) AS url, body AS text, 'en' AS language, hits AS keywords_hit,
  CAST(NULL AS VARCHAR) AS location_name, CASE WHEN doc_id % 3 <> 0 THEN concat('https://i.redd.it/', doc_id) ELSE '' END AS media_urls
FROM q WHERE hits <> ''""")
def parse_reddit(spark: SparkSession, folder: str) -> DataFrame:
    """Posts parsed, and the repeats of a second poll dropped."""
    records = payloads.parse_reddit(posts(spark, folder), _at(), keywords=b.KEYWORDS)
    return flat_text_records(first_arrival(records, ["record_id"], [F.col("published_at")]))


@b.check(f"""
WITH a AS (SELECT *, concat_ws(' ', CASE WHEN doc_id % 4 <> 0 THEN concat('Title ', doc_id) END, NULL, text) AS body FROM documents WHERE doc_id % 9 <> 0)
SELECT 'news_api' AS source_type, CASE WHEN doc_id % 6 <> 0 THEN source ELSE 'newsapi' END AS source_name,
  md5(concat('https://news.example.org/', doc_id)) AS record_id,
  strftime({_SQL_TS}, '%Y-%m-%dT%H:%M:%SZ') AS published_at, concat('https://news.example.org/', doc_id) AS url, body AS text, 'en' AS language,
  {_sql_hits('body')} AS keywords_hit, 'India' AS location_name,
  CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('https://img.example.org/', doc_id, '.jpg') END AS media_urls
FROM a""")
def parse_news(spark: SparkSession, folder: str) -> DataFrame:
    url = F.concat(F.lit("https://news.example.org/"), _str(_id()))
    article = F.struct(
        F.struct(F.when(_id() % 6 != 0, F.col("source")).alias("name")).alias("source"),
        F.when(_id() % 4 != 0, F.concat(F.lit("Title "), _str(_id()))).alias("title"), F.lit("").alias("description"),
        F.col("text").alias("content"), F.when(_id() % 9 != 0, url).otherwise("").alias("url"),
        F.when(_id() % 5 != 0, F.concat(F.lit("https://img.example.org/"), _str(_id()), F.lit(".jpg"))).alias("urlToImage"),
        F.date_format(_day_ts(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
    )
    landed = b.load(spark, folder, "documents").select(F.to_json(article, _WITH_NULLS).alias("payload"))
    return flat_text_records(payloads.parse_news(landed, _at(), keywords=b.KEYWORDS))


# -- article pages ------------------------------------------------------------------

_SPACES_SQL = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), chr(133), chr(160))"


# The references that occur in the given pages; &amp; is decoded last.
_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&copy;": "©",
    "&reg;": "®", "&middot;": "·", "&bull;": "•", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”", "&euro;": "€", "&deg;": "°",
    "&amp;": "&",
}


def _sql_entities(text: str) -> str:
    for name, char in _ENTITIES.items():
        quoted = char.replace("'", "''")
        text = f"replace({text}, '{name}', '{quoted}')"
    return text


def _sql_article(html: str) -> str:
    """Body text: paragraphs from their start tag to their end, tags out, strings trimmed and joined."""
    skipped = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    parts = rf"string_split_regex(regexp_replace({html}, '{skipped}', ' ', 'g'), '(?i)<p(?:\s[^>]*)?>')[2:]"
    inner = r"regexp_replace(p, '(?is)</(?:p|article|section|div|main|td|body|html)\s*>.*$', '')"
    marked = _sql_entities(f"regexp_replace({inner}, '(?s)<[^>]*>', chr(1), 'g')")
    strings = f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: trim(s, {_SPACES_SQL})), lambda s: s <> '')"
    return f"array_to_string(list_transform({parts}, lambda p: array_to_string({strings}, ' ')), ' ')"


def _pages_with_image(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("page_id")
    head = (
        F.when(n % 4 == 0, F.concat(F.lit('<meta property="og:image" content="https://img.example.org/'), _str(n), F.lit('.jpg?a=1&amp;b=2">')))
        .when(n % 4 == 1, F.concat(F.lit('<meta content="/rel.jpg" property="og:image"><meta name="twitter:image" content="http://tw.example.org/'), _str(n), F.lit('.png">')))
        .when(n % 4 == 2, F.lit('<!-- <meta property="og:image" content="https://no"> -->'))
        .otherwise("")
    )
    return b.load(spark, folder, "pages").select("page_id", "url", F.concat(head, "html").alias("html"))


@b.check(f"""
WITH t AS (SELECT page_id, {_sql_article('html')} AS body FROM pages)
SELECT page_id, body, substring(body, 1, 3000) AS stored_body,
  CASE page_id % 4 WHEN 0 THEN concat('https://img.example.org/', page_id, '.jpg?a=1&b=2') WHEN 1 THEN concat('http://tw.example.org/', page_id, '.png') END AS image
FROM t""")
def page_text_image(spark: SparkSession, folder: str) -> DataFrame:
    """Whole body text, its leading part, and the lead image."""
    return _pages_with_image(spark, folder).select(
        "page_id", article_text(F.col("html"), None).alias("body"), article_text(F.col("html"), 3000).alias("stored_body"),
        lead_image(F.col("html")).alias("image"),
    )


def feed_items(spark: SparkSession, folder: str) -> DataFrame:
    """One feed item per document, some linking to a landed page."""
    docs = b.load(spark, folder, "documents")
    pages = b.load(spark, folder, "pages").select("page_id", F.col("url").alias("link"))
    joined = docs.join(pages, _id() == F.col("page_id"), "left")
    safe = F.replace(F.replace(F.regexp_replace("text", r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " "), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    link = F.replace(F.coalesce("link", F.lit("")), F.lit("&"), F.lit("&amp;"))
    xml = F.concat(
        F.lit("<item><title>Item "), _str(_id()), F.lit("</title><description>"), safe, F.lit("</description><link>"), link,
        F.lit("</link><pubDate>"), F.date_format(_day_ts(), "d MMM yyyy HH:mm:ss"), F.lit(" +0530</pubDate><category>x</category><category>y</category></item>"),
    )
    return joined.select(F.col("source").alias("feed"), xml.alias("xml"))


@b.check(f"""
WITH i AS (
  SELECT d.doc_id, d.source, concat('Item ', d.doc_id) AS title, trim(regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', ' ', 'g'), concat(' ', chr(9), chr(10), chr(13))) AS summary,
    coalesce(p.url, '') AS link, CASE WHEN p.url IS NULL THEN '' ELSE {_sql_article('p.html')} END AS body
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id
), q AS (SELECT *, concat(title, ' ', summary) AS quick FROM i),
h AS (SELECT *, {_sql_hits('quick')} AS hits FROM q)
SELECT 'rss' AS source_type, min(source) AS source_name, md5(CASE WHEN link <> '' THEN link ELSE quick END) AS record_id, 'en' AS language,
  min(strftime({_SQL_TS} - INTERVAL 19800 SECOND, '%Y-%m-%dT%H:%M:%S+00:00')) AS published_at, min(link) AS url, count(*)::BIGINT AS copies,
  min(trim(concat(quick, ' ', body))) AS text, min(hits) AS keywords_hit
FROM h WHERE hits <> '' GROUP BY CASE WHEN link <> '' THEN link ELSE quick END""")
def parse_rss(spark: SparkSession, folder: str) -> DataFrame:
    """Feed items with the bodies of landed pages; items with the same link are one record."""
    entries = payloads.parse_feed_items(feed_items(spark, folder))
    records = payloads.parse_rss(entries, _at(), b.load(spark, folder, "pages"), b.KEYWORDS)
    return records.groupBy("source_type", "record_id", "language").agg(
        F.min("source_name").alias("source_name"), F.min("published_at").alias("published_at"), F.min("url").alias("url"),
        F.count("*").alias("copies"), F.min("text").alias("text"), F.min(F.array_join("keywords_hit", "|")).alias("keywords_hit"),
    )


def _two_dialects(spark: SparkSession, folder: str) -> DataFrame:
    """One feed per fifty documents and dialect, its entries half of them; dates, links, bodies and tags in the ways feeds write them."""
    safe = F.replace(F.replace(F.regexp_replace("text", r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " "), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    title, n = F.concat(F.lit("Item "), _str(_id())), _str(_id())
    iso = F.date_format(_day_ts(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rss = F.concat(
        F.lit("<item><title>"), title, F.lit("</title><description>"), safe,
        F.lit("</description><link>https://r.example.org/"), n, F.lit("</link>"),
        F.when(_id() % 4 == 0, F.concat(F.lit("<pubDate>"), F.date_format(_day_ts(), "E, d MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate>")))
        .otherwise(F.concat(F.lit("<dc:date>"), iso, F.lit("</dc:date>"))),
        F.lit("<category>x</category><category>y</category></item>"),
    )
    body = F.when(_id() % 3 == 0, F.concat(F.lit('<content type="html">'), safe, F.lit("</content>"))).otherwise(F.concat(F.lit("<summary>"), safe, F.lit("</summary><content>other</content>")))
    atom = F.concat(
        F.lit('<entry><title type="text">'), title, F.lit('</title><link rel="self" href="https://self.example.org/"/>'),
        F.lit('<link href="https://a.example.org/'), n, F.lit('?a=1&amp;b=2"/>'), body,
        F.when(_id() % 5 == 0, F.concat(F.lit("<updated>"), iso, F.lit("</updated>")))
        .otherwise(F.concat(F.lit("<published>"), iso, F.lit("</published><updated>2030-01-01T00:00:00Z</updated>"))),
        F.lit('<category term="x" label="X"/><category term="y"/></entry>'),
    )
    entries = b.load(spark, folder, "documents").select(F.expr("doc_id div 50").alias("feed"), (_id() % 2 == 0).alias("rss"), F.when(_id() % 2 == 0, rss).otherwise(atom).alias("xml"))
    feeds = entries.groupBy("feed", "rss").agg(F.array_join(F.collect_list("xml"), "").alias("xml"))
    head = '<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>All</title>', '<feed xmlns="http://www.w3.org/2005/Atom"><title>All</title>'
    return feeds.select(
        F.when(F.col("rss"), F.concat(F.lit(head[0]), "xml", F.lit("</channel></rss>"))).otherwise(F.concat(F.lit(head[1]), "xml", F.lit("</feed>"))).alias("xml")
    )


@b.check(f"""
WITH i AS (
  SELECT doc_id, concat('Item ', doc_id) AS title, trim(regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', ' ', 'g'), concat(' ', chr(9), chr(10), chr(13))) AS summary,
    CASE WHEN doc_id % 2 = 0 THEN concat('https://r.example.org/', doc_id) ELSE concat('https://a.example.org/', doc_id, '?a=1&b=2') END AS link
  FROM documents
), q AS (SELECT *, concat(title, ' ', summary) AS quick FROM i), h AS (SELECT *, {_sql_hits('quick')} AS hits FROM q)
SELECT md5(link) AS record_id, link AS url, strftime({_SQL_TS}, '%Y-%m-%dT%H:%M:%S+00:00') AS published_at, trim(quick) AS text, hits AS keywords_hit, 'x|y' AS tags
FROM h WHERE hits <> ''""")
def parse_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """RSS and Atom files of one folder."""
    home = f"{shared_dir(spark)}/feeds"
    _two_dialects(spark, folder).write.option("maxRecordsPerFile", 1).text(home)
    records = payloads.parse_rss(payloads.read_feed(spark, home), _at(), keywords=b.KEYWORDS)
    tags = F.from_json("raw_payload", "tags array<string>")["tags"]
    return records.select(
        "record_id", "url", "published_at", "text", F.array_join("keywords_hit", "|").alias("keywords_hit"), F.array_join(tags, "|").alias("tags"),
    )


@b.check("""
SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL
  ELSE concat(strftime(CASE event_id % 5 WHEN 0 THEN ts - INTERVAL 19800 SECOND WHEN 3 THEN ts + INTERVAL 3600 SECOND ELSE ts END, '%Y-%m-%dT%H:%M:%S'),
    CASE WHEN event_id % 5 = 2 AND epoch_us(ts) % 1000000 <> 0 THEN strftime(ts, '.%f') ELSE '' END, '+00:00') END AS published_at
FROM events""")
def date_parse(spark: SparkSession, folder: str) -> DataFrame:
    """RFC 2822 with an offset, with a zone name, ISO with a fraction, ISO with an offset, and noise."""
    n, ts = F.col("event_id"), F.col("ts")
    mail = F.date_format(ts, "d MMM yyyy HH:mm:ss")
    day = F.date_format(ts, "E")
    raw = (
        F.when(n % 5 == 0, F.concat(day, F.lit(", "), mail, F.lit(" +0530")))
        .when(n % 5 == 1, F.concat(day, F.lit(", "), mail, F.lit(" GMT")))
        .when(n % 5 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(n % 5 == 3, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-01:00")))
        .otherwise(F.concat(F.lit("about "), _str(n)))
    )
    return b.load(spark, folder, "events").select("event_id", iso_utc(parse_feed_date(raw)).alias("published_at"))


@b.check(f"""
SELECT event_id, concat('loc_', user_id % 10) AS location_name, value / 10 AS temperature_c, round(value % 100)::DOUBLE AS humidity_pct,
  value / 7 AS wind_speed_ms, CASE WHEN event_type <> 'view' THEN value / 10 ELSE 0 END AS rainfall_mm, 1000::DOUBLE AS pressure_hpa,
  concat(CASE WHEN event_type = 'view' THEN '' WHEN value / 10 >= 35 THEN '[CRITICAL RAINFALL] ' WHEN value / 10 >= 15 THEN '[WARNING RAINFALL] ' ELSE '' END, event_type) AS condition
FROM events""")
def parse_weather(spark: SparkSession, folder: str) -> DataFrame:
    value, kind = F.col("value"), F.col("event_type")
    body = F.struct(
        F.struct((value / 10).alias("temp"), F.round(value % 100).cast("bigint").alias("humidity"), F.lit(1000).alias("pressure")).alias("main"),
        F.struct((value / 7).alias("speed"), F.lit(90).alias("deg")).alias("wind"),
        F.when(kind != "view", F.struct((value / 10).alias("1h"))).alias("rain"),
        F.array(F.struct(kind.alias("description"))).alias("weather"), F.col("event_id").alias("id"),
    )
    landed = b.load(spark, folder, "events").select(
        F.concat(F.lit("loc_"), _str(F.col("user_id") % 10)).alias("location_name"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"),
        F.to_json(body).alias("payload"),
    )
    return payloads.parse_weather(landed, _at()).select(
        F.get_json_object("raw_payload", "$.id").cast("bigint").alias("event_id"), "location_name", "temperature_c",
        "humidity_pct", "wind_speed_ms", "rainfall_mm", "pressure_hpa", "condition",
    )
