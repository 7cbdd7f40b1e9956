"""Ranked search, bounding box, time range."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.functions.text import latin_fold
from hazlake.operators import ranges, search
from hazlake.operators.dedupe import numbered
from hazlake.plans.checks import base as b
from hazlake.session import stage

_ACCENTED, _PLAIN = latin_fold()
_LAKE = b.sql_lake()


def _sql_tokens(text: str) -> str:
    bare = rf"regexp_replace(coalesce({text}, ''), '[\x{{0300}}-\x{{036f}}]', '', 'g')"
    folded = f"lower(translate({bare}, '{_ACCENTED}', '{_PLAIN}'))"
    return rf"list_filter(string_split_regex({folded}, '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


# Tokens are kept as a list and as a blank-padded string, in which a phrase is a substring.
_TOKENS = _LAKE + f""", split AS (
  SELECT lake_id, date_partition, {_sql_tokens('text')} AS a, {_sql_tokens("array_to_string(keywords_hit, ' ')")} AS k,
    {_sql_tokens('hazard_type')} AS h, {_sql_tokens('location_name')} AS l FROM lake
), toks AS (
  SELECT lake_id, date_partition, list_concat(a, k, h, l) AS t, len(a) + len(k) + len(h) + len(l) AS len, a, k, h, l FROM split
)"""


def _freq(word: str) -> str:
    return f"len(list_filter(t, lambda x: x = '{word}'))"


def _pairs(column: str, one: str, two: str) -> str:
    return f"len(list_filter(generate_series(1, len({column}) - 1), lambda i: {column}[i] = '{one}' AND {column}[i + 1] = '{two}'))"


def _phrase(one: str, two: str) -> str:
    return " + ".join(_pairs(c, one, two) for c in ("a", "k", "h", "l"))


def _sql_bm25(freqs: dict[str, str], keep: str, scored: list[str], limit: int | None = None) -> str:
    counted = ", ".join(f"{expr} AS {name}" for name, expr in freqs.items())
    hits = ", ".join(f"count(*) FILTER ({name} > 0) AS n_{name}" for name in freqs)

    def part(f: str) -> str:
        raw = f"ln((n - n_{f} + 0.5) / (n_{f} + 0.5))"
        idf = f"CASE WHEN n_{f} + 0.0 < n - n_{f} THEN {raw} ELSE 1e-6 END"
        return f"({idf}) * {f} * 2.2 / ({f} + 1.2 * (0.25 + 0.75 * len / avg_len))"
    score = " + ".join(part(f) for f in scored)
    return _TOKENS + f""", f AS (SELECT lake_id, len, {counted} FROM toks),
s AS (SELECT count(*)::DOUBLE AS n, avg(len) AS avg_len, {hits} FROM f),
r AS (SELECT lake_id, -({score}) AS score FROM f, s WHERE {keep})
SELECT lake_id, round(score, 6) AS score FROM r ORDER BY round(r.score, 9), lake_id {f'LIMIT {limit}' if limit else ''}"""


@b.check(_sql_bm25({"w0": _freq("the"), "w1": _freq("thing")}, "w0 > 0 AND w1 > 0", ["w0", "w1"], 50))
def search_bm25(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best records holding both words, found by scan."""
    return search.search(b.doc_lake(spark, folder), "The thing", 50).select("lake_id", F.round("score", 6).alias("score"))


_UNITS = {
    "w0": _freq("with"), "p0": _phrase("of", "the"), "x0": "len(list_filter(t, lambda x: starts_with(x, 'thi')))",
    "o0": _phrase("is", "on"), "o1": _freq("ouen"), "z0": _freq("sos"),
}
_KEEP = "w0 > 0 AND p0 > 0 AND x0 > 0 AND (o0 > 0 OR o1 > 0) AND z0 = 0"


@b.check(_sql_bm25(_UNITS, _KEEP, ["w0", "p0", "x0", "o0", "o1"]))
def search_match(spark: SparkSession, folder: str) -> DataFrame:
    """Word, phrase, prefix, either-or and exclusion together; all matches, ranked."""
    match = search.Match("with", ("of the",), ("thi",), ("is on", "ouen"), ("sos",))
    return search.search(b.doc_lake(spark, folder), match, None).select("lake_id", F.round("score", 6).alias("score"))


@b.check(_sql_bm25(_UNITS, _KEEP, ["w0", "p0", "x0", "o0", "o1"]))
def search_index_match(spark: SparkSession, folder: str) -> DataFrame:
    """The same match through postings with their places."""
    lake = stage(b.doc_lake(spark, folder), "lake")
    match = search.Match("with", ("of the",), ("thi",), ("is on", "ouen"), ("sos",))
    hits = search.search_postings(stage(search.postings(lake), "postings"), search.corpus_stats(lake), match, None)
    return hits.select("lake_id", F.round("score", 6).alias("score"))


@b.check(_sql_bm25(
    {"w0": "len(list_filter(l, lambda x: x = 'loc'))", "w1": "len(list_filter(l, lambda x: x = '3'))"},
    "w0 > 0 AND w1 > 0", ["w0", "w1"]))
def search_column(spark: SparkSession, folder: str) -> DataFrame:
    match = search.Match("loc 3", columns=("location_name",))
    return search.search(b.doc_lake(spark, folder), match, None).select("lake_id", F.round("score", 6).alias("score"))


@b.check(_TOKENS + """, p AS (SELECT lake_id, len, unnest(t) AS token FROM toks)
SELECT lake_id, token, count(*)::BIGINT AS freq, any_value(len)::BIGINT AS len FROM p GROUP BY lake_id, token""")
def search_postings(spark: SparkSession, folder: str) -> DataFrame:
    """The text index: one row per record and token."""
    return search.postings(b.doc_lake(spark, folder)).select(
        "lake_id", "token", F.col("freq").cast("bigint").alias("freq"), F.col("len").cast("bigint").alias("len")
    )


@b.check(_TOKENS + " SELECT count(*)::BIGINT AS docs, sum(len)::BIGINT AS tokens FROM toks")
def search_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return search.corpus_stats(b.doc_lake(spark, folder))


SEARCH_INDEX_SQL = _sql_bm25(
    {"w0": _freq("of"), "w1": _freq("thing"), "w2": _freq("with")}, "w0 > 0 AND w1 > 0 AND w2 > 0", ["w0", "w1", "w2"], 20,
)


@b.check(SEARCH_INDEX_SQL)
def search_index(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best records holding all words, found through the index."""
    lake = stage(numbered(b.doc_lake(spark, folder), "doc"), "lake")
    posts = stage(search.postings(lake, ("doc",)), "postings")
    hits = search.search_postings(posts, search.corpus_stats(lake), "of thing with", 20, lake)
    return search.fetch(hits, lake).select("lake_id", F.round("score", 6).alias("score"))


@b.check(_LAKE + """
SELECT lake_id, source_type, hazard_type, collected_at FROM lake
WHERE date_partition BETWEEN '2024-01-03' AND '2024-01-25' AND source_type = 'reddit' AND hazard_type = 'B' ORDER BY collected_at""")
def time_range(spark: SparkSession, folder: str) -> DataFrame:
    found = ranges.time_range(b.doc_lake(spark, folder), "2024-01-03", "2024-01-25", "reddit", "B")
    return found.select("lake_id", "source_type", "hazard_type", "collected_at")


@b.check(_LAKE + """
SELECT lake_id, location_name, lat, lon FROM lake WHERE lat >= 12.5 AND lat <= 30.25 AND lon >= 70 AND lon <= 90.75""")
def bbox(spark: SparkSession, folder: str) -> DataFrame:
    return ranges.bbox(b.doc_lake(spark, folder), 12.5, 30.25, 70, 90.75).select("lake_id", "location_name", "lat", "lon")


@b.check(_LAKE + """
SELECT lake_id, lat, lon, floor(lat)::INT AS lat_cell, floor(lon)::INT AS lon_cell FROM lake
WHERE lat IS NOT NULL AND lon IS NOT NULL AND lake_id NOT IN (SELECT lake_id FROM lake WHERE source_type = 'twitter')""")
def missing_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Positions not yet in a cell table that holds the tweets only."""
    lake = b.doc_lake(spark, folder)
    return ranges.missing_cells(lake, ranges.grid_cells(lake.filter("source_type = 'twitter'")))


@b.check(_LAKE + """
SELECT floor(lat)::INT AS lat_cell, floor(lon)::INT AS lon_cell, count(*)::BIGINT AS records FROM lake
WHERE lat BETWEEN 12.5 AND 30.25 AND lon BETWEEN 70 AND 90.75 GROUP BY ALL""")
def bbox_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same box on the cell table, where the cell columns prune first."""
    cells = ranges.grid_cells(b.doc_lake(spark, folder))
    return ranges.bbox(cells, 12.5, 30.25, 70, 90.75).groupBy("lat_cell", "lon_cell").agg(F.count("*").alias("records"))
