"""Media links: relevance, type, stored name, size gates."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazlake.functions.media import image_size, is_relevant_url, local_name, media_type, passes_size_gate, size_kb
from hazlake.operators import media
from hazlake.plans.checks import base as b

DOMAINS = ["example.com", "ththth.example.net", "spam-farm.example.org"]
_SKIP_SQL = r"(?i)logo|icon|avatar|banner|pixel|tracker|badge|button|sprite|widget|gravatar|favicon|ads|advert|analytics|1x1|blank\.|spacer"
_HOST = r"regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1), ':[0-9]*$', ''), '^www\.', '')"
_ALLOWED = " OR ".join(f"{_HOST} = '{d}' OR ends_with({_HOST}, '.{d}')" for d in DOMAINS)

# Links of every sort a page may carry, five per page.
_LINKS = """
links AS (
  SELECT page_id, k, CASE k WHEN 0 THEN url WHEN 1 THEN concat(string_split(url, '?')[1], '/Photo.JPG?x=1') WHEN 2 THEN concat(string_split(url, '#')[1], '/clip.mp4#t')
    WHEN 3 THEN concat('https://WWW.Example.com/uploads/', page_id, '.png') ELSE concat('https://img.example.com:8080/a b/', page_id, '.webp;v=2') END AS url
  FROM pages, (SELECT unnest([0, 1, 2, 3, 4]) AS k)
)"""


def _links(spark: SparkSession, folder: str) -> DataFrame:
    page = F.col("page_id").cast("string")
    url = F.col("url")
    forms = F.array(
        url,
        F.concat(F.split(url, r"\?")[0], F.lit("/Photo.JPG?x=1")),
        F.concat(F.split(url, "#")[0], F.lit("/clip.mp4#t")),
        F.concat(F.lit("https://WWW.Example.com/uploads/"), page, F.lit(".png")),
        F.concat(F.lit("https://img.example.com:8080/a b/"), page, F.lit(".webp;v=2")),
    )
    return b.load(spark, folder, "pages").select("page_id", F.posexplode(forms).alias("k", "url"))


@b.check("WITH" + _LINKS + rf"""
SELECT page_id, k::BIGINT AS k, (NOT regexp_matches(url, '{_SKIP_SQL}') AND ({_ALLOWED}))::INT AS relevant FROM links""")
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _links(spark, folder).select(
        "page_id", F.col("k").cast("bigint").alias("k"), is_relevant_url(F.col("url"), DOMAINS).cast("int").alias("relevant")
    )


# The suffix of a page link is whatever follows the last dot of its last segment.
_EXT = r"lower(regexp_extract(regexp_extract(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#;]*)', 1), '([^/]*)/*$', 1), '^.+(\.[^.]+)$', 1))"
_TYPE = f"CASE WHEN {_EXT} IN ('.jpg', '.jpeg', '.png', '.webp', '.gif', '.tiff') OR contains(ctype, 'image') THEN 'image' WHEN {_EXT} IN ('.mp4', '.avi', '.mov', '.mkv', '.webm') OR contains(ctype, 'video') THEN 'video' END"
_TYPED = "WITH" + _LINKS + f""", c AS (SELECT *, CASE WHEN page_id % 3 = 0 THEN 'image/png' WHEN page_id % 3 = 1 THEN 'video/mp4' ELSE '' END AS ctype FROM links),
typed AS (SELECT *, {_EXT} AS ext, {_TYPE} AS media_type FROM c)"""


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("page_id") % 3 == 0, "image/png").when(F.col("page_id") % 3 == 1, "video/mp4").otherwise("")
    return _links(spark, folder).withColumn("media_type", media_type(F.col("url"), kind))


@b.check(_TYPED + " SELECT page_id, k::BIGINT AS k, media_type FROM typed")
def media_type_of(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(spark, folder).select("page_id", F.col("k").cast("bigint").alias("k"), "media_type")


@b.check(_TYPED + """
SELECT page_id, k::BIGINT AS k, concat(CASE media_type WHEN 'image' THEN 'images/' ELSE 'videos/' END, md5(url),
  CASE WHEN ext <> '' THEN ext WHEN media_type = 'image' THEN '.jpg' ELSE '.mp4' END) AS local_path
FROM typed WHERE media_type IS NOT NULL""")
def local_names(spark: SparkSession, folder: str) -> DataFrame:
    typed = _typed(spark, folder).filter(F.col("media_type").isNotNull())
    return typed.select(
        "page_id", F.col("k").cast("bigint").alias("k"), local_name(F.col("url"), F.col("media_type")).alias("local_path")
    )


@b.check(f"""
WITH r AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS record_id, {b.SQL_HITS} AS hits FROM documents),
u AS (SELECT record_id, unnest([concat('https://a.example.com/', doc_id % 97, '.jpg'), CASE WHEN doc_id % 2 = 0 THEN '' ELSE concat('https://b.example.com/', doc_id) END]) AS url FROM r WHERE len(hits) > 0)
SELECT url, min(record_id) AS source_record_id FROM u WHERE url <> '' GROUP BY url""")
def harvest_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Links of relevant documents, many of which share a picture."""
    n = F.col("doc_id")
    urls = F.array(
        F.concat(F.lit("https://a.example.com/"), (n % 97).cast("string"), F.lit(".jpg")),
        F.when(n % 2 == 0, "").otherwise(F.concat(F.lit("https://b.example.com/"), n.cast("string"))),
    )
    return media.harvest_urls(b.doc_records(spark, folder).withColumn("media_urls", urls))


@b.check("""
WITH f AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'image' ELSE 'video' END AS media_type, length(html)::BIGINT * 4000 AS length,
  CASE WHEN page_id % 7 <> 0 THEN 200 + page_id % 300 END AS width, CASE WHEN page_id % 7 <> 0 THEN 100 + page_id % 250 END AS height FROM pages)
SELECT page_id, round(length / 1024 + 1e-9, 2) AS file_size_kb FROM f
WHERE length <= 10485760 AND NOT (media_type = 'image' AND width IS NOT NULL AND (width < 300 OR height < 200))""")
def media_size_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as landed files, with sizes derived from them."""
    n = F.col("page_id")
    files = b.load(spark, folder, "pages").select(
        "page_id", F.when(n % 2 == 0, "image").otherwise("video").alias("media_type"),
        (F.length("html").cast("bigint") * 4000).alias("length"), F.when(n % 7 != 0, 200 + n % 300).alias("width"),
        F.when(n % 7 != 0, 100 + n % 250).alias("height"),
    )
    gate = passes_size_gate(F.col("media_type"), F.col("length"), F.col("width"), F.col("height"))
    return files.filter(gate).select("page_id", size_kb(F.col("length")).alias("file_size_kb"))


@b.check("""
WITH s AS (SELECT page_id, page_id % 5 AS kind, 1 + page_id * 37 % 900 AS w, 1 + length(html) % 700 AS h FROM pages)
SELECT page_id, CASE WHEN kind < 4 THEN w END::BIGINT AS width, CASE WHEN kind < 4 THEN h END::BIGINT AS height FROM s""")
def image_header_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes read from image headers in front of page contents, of four kinds, and from contents that are no image."""
    n = F.col("page_id")
    sized = b.load(spark, folder, "pages").select(
        "page_id", "html", (1 + n * 37 % 900).cast("long").alias("w"), (1 + F.length("html") % 700).cast("long").alias("h")
    )
    # Some 65,000 bytes of pages as comment segments before a JPEG's frame.
    comment = F.substring(F.encode("html", "UTF-8"), 1, 65_000)
    length = F.lpad(F.hex(F.octet_length(comment) + 2), 4, "0")

    def big(col: str, digits: int) -> Column:
        return F.lpad(F.hex(col), digits, "0")

    def little(col: str, digits: int, less: int = 0) -> Column:
        text = F.lpad(F.hex(F.col(col) - less), digits, "0")
        return F.concat(*[F.substring(text, i + 1, 2) for i in reversed(range(0, digits, 2))])

    header = (
        F.when(n % 5 == 0, F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), big("w", 8), big("h", 8)))
        .when(n % 5 == 1, F.concat(F.lit("474946383961"), little("w", 4), little("h", 4)))
        .when(n % 5 == 2, F.concat(F.lit("FFD8FFE000044A46FFFE"), length, F.hex(comment), F.lit("FFC2001108"), big("h", 4), big("w", 4)))
        .when(n % 5 == 3, F.concat(F.lit("524946460000000057454250565038580A00000000000000"), little("w", 6, 1), little("h", 6, 1)))
        .otherwise("")
    )
    contents = sized.select("page_id", F.concat(F.unhex(header), F.encode("html", "UTF-8")).alias("content"))
    size = contents.select("page_id", image_size(F.col("content")).alias("size"))
    return size.select("page_id", F.col("size.width").cast("long").alias("width"), F.col("size.height").cast("long").alias("height"))
