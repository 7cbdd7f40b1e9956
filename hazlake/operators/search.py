"""Ranked text search (BM25) over four columns, by scan or by a postings table.

Tokens are letter and digit runs, lowercased, without accents, not stemmed. All
plain words must occur, in any of the columns. Scores follow the usual BM25
with k1 = 1.2 and b = 0.75; lower is better, as in an ascending rank.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hazlake.functions.once import once
from hazlake.functions.text import query_tokens, token_line, tokens

# BM25 parameters and the floor for non-positive idf.
K1 = 1.2
B = 0.75
IDF_FLOOR = 1e-6

# What names a record in postings, if no shorter key is given.
RECORD = ("lake_id", "date_partition")
NUMBER = ("insert", "doc")

INDEXED = ["text", "keywords_hit", "hazard_type", "location_name"]
TOKEN_BUCKETS = 256
PLACE_STEP = 1 << 32
# A token's number in its record takes the lower half of its code.
CODE = 1 << 32


@dataclass(frozen=True)
class Match:
    """What a record must contain.

    ``words`` all occur, as do all ``phrases`` (adjacent words) and ``prefixes``;
    with ``any_of`` at least one of its entries; none of ``none_of``. ``columns``
    limits everything to those columns. Each entry may hold several words and is
    then read as a phrase.
    """

    words: str = ""
    phrases: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()
    columns: tuple[str, ...] = tuple(INDEXED)


def _as_text(df: DataFrame, name: str) -> Column:
    return F.array_join(name, " ") if df.schema[name].dataType.typeName() == "array" else F.col(name)


def all_tokens(df: DataFrame) -> Column:
    """Tokens of the indexed columns of a record, in one array."""
    return F.concat(*[tokens(_as_text(df, name)) for name in INDEXED])


def _length(line: Column) -> Column:
    """Tokens in a token line: one fewer than its pairs of blanks."""
    blanks = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return (blanks / 2).cast("int") - 1


def _occurrences(line: Column, words: list[str], prefix: bool = False) -> Column:
    """How often ``words`` stand next to each other in a token line; the last may be a prefix."""
    needle = " " + "  ".join(words) + ("" if prefix else " ")
    if any(needle.endswith(needle[:k]) for k in range(2, len(needle))):
        # An occurrence may overlap the next one ("the the"); a look-ahead counts both.
        return F.regexp_count(line, F.lit(f"(?={needle})"))
    cut = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(needle), F.lit("")))
    return (cut / len(needle.encode())).cast("int")


def _units(match: Match) -> list[tuple[str, list[str], bool]]:
    """(role, words, prefix) of every scored or excluded unit."""
    units = [("all", [w], False) for w in query_tokens(match.words)]
    for role, entries, prefix in (
        ("all", match.phrases, False), ("all", match.prefixes, True),
        ("any", match.any_of, False), ("none", match.none_of, False),
    ):
        for entry in entries:
            words = _words_in_order(entry)
            if words:
                units.append((role, words, prefix))
    return units


def _words_in_order(entry: str) -> list[str]:
    # query_tokens drops repeats; a phrase keeps them.
    return [w for part in entry.split() for w in query_tokens(part)]


def _bm25(freq: Column, length: Column, idf: Column, avg_len: Column) -> Column:
    return idf * freq * (K1 + 1) / (freq + K1 * (1 - B + B * length / avg_len))


def _idf(n_docs: Column, n_hits: Column) -> Column:
    raw = F.ln((n_docs - n_hits + 0.5) / (n_hits + 0.5))
    return F.when(raw > 0, raw).otherwise(IDF_FLOOR)


def _best(scored: DataFrame, limit: int | None) -> DataFrame:
    ranked = scored.orderBy("score", "lake_id")
    return ranked if limit is None else ranked.limit(limit)


def _matching(counted: DataFrame, units: list[tuple[str, list[str], bool]]) -> DataFrame:
    """Rows whose counts ``_f`` meet every unit's role."""
    def role(name: str) -> list[Column]:
        return [F.col("_f")[i] for i, (r, _, _) in enumerate(units) if r == name]

    kept = counted
    for freq in role("all"):
        kept = kept.filter(freq > 0)
    if role("any"):
        kept = kept.filter(reduce(lambda a, b: a | b, [freq > 0 for freq in role("any")]))
    for freq in role("none"):
        kept = kept.filter(freq == 0)
    return kept


def search(lake: DataFrame, match: Match | str, limit: int | None = 50) -> DataFrame:
    """Best ``limit`` records for the match (all with ``None``), with ``score``; scans the table, needs no index.

    No row is exploded: each record's tokens are written as one line, in which
    words, phrases and prefixes are counted as substrings. The corpus totals are one small aggregate, read back as a scalar subquery, and
    the result is a top-k, not a global sort.
    """
    match = Match(words=match) if isinstance(match, str) else match
    units = _units(match)
    if not any(role != "none" for role, _, _ in units):
        return lake.limit(0).withColumn("score", F.lit(None).cast("double"))

    lines = {f"_line_{c}": token_line(_as_text(lake, c)) for c in INDEXED}
    counts = [
        reduce(lambda a, b: a + b, [_occurrences(F.col(f"_line_{c}"), words, prefix) for c in match.columns])
        for _, words, prefix in units
    ]
    length = reduce(lambda a, b: a + b, [_length(F.col(line)) for line in lines])
    counted = once(once(lake, lines), {"_f": F.array(*counts), "_len": length}).drop(*lines)

    totals = counted.agg(
        F.struct(
            F.count("*").cast("double").alias("n"),
            F.avg("_len").alias("avg_len"),
            *[F.count_if(F.col("_f")[i] > 0).cast("double").alias(f"h{i}") for i in range(len(units))],
        ).alias("t")
    ).scalar()

    kept = _matching(counted, units)
    scored = [i for i, (r, _, _) in enumerate(units) if r != "none"]
    # One column holds the subquery: every further mention of it would be a subquery of its own.
    kept, totals = kept.withColumn("_totals", totals), F.col("_totals")
    parts = [
        _bm25(F.col("_f")[i].cast("double"), F.col("_len"), _idf(totals["n"], totals[f"h{i}"]), totals["avg_len"])
        for i in scored
    ]
    score = -reduce(lambda a, b: a + b, parts)
    return _best(kept.withColumn("score", score).drop("_f", "_len", "_totals"), limit)


# -- postings table ---------------------------------------------------------


def _bucket_of(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(TOKEN_BUCKETS)).cast("int")


def postings(lake: DataFrame, key: tuple[str, ...] = RECORD) -> DataFrame:
    """(bucket, token, lake_id, date_partition, freq, places, len): one row per token of a record.

    Another ``key``, such as a number, stands in place of the id and the date; it is written once per token. ``places`` are the token's positions, counted within each column, plus ``PLACE_STEP`` per column.
    Equal tokens are brought together inside the record before anything is exploded, so
    building the table needs no shuffle.
    """
    cut = once(lake.select(*key, *INDEXED), {f"_t{k}": tokens(_as_text(lake, name)) for k, name in enumerate(INDEXED)})
    columns = [f"_t{k}" for k in range(len(INDEXED))]
    ends = {f"_e{k}": reduce(lambda a, b: a + b, [F.size(c) for c in columns[: k + 1]]) for k in range(len(INDEXED))}
    joined = once(cut.select(*key, *columns), {"toks": F.concat(*columns), **ends}).drop(*columns)
    joined = joined.withColumnRenamed(f"_e{len(INDEXED) - 1}", "len").filter("len > 0")

    def number(i: Column) -> Column:
        """The number of the token whose code stands at ``i``."""
        return F.get("codes", i).bitwiseAND(F.lit(CODE - 1)).cast("int")

    def starts() -> Column:
        """Where the left neighbour is another token."""
        return F.filter(
            F.sequence(F.lit(0), F.col("len") - 1),
            lambda i: (i == 0) | (F.get("toks", number(i)) != F.get("toks", number(i - 1))),
        )

    def place(code: Column) -> Column:
        at = code.bitwiseAND(F.lit(CODE - 1))
        spot = F.when(at < F.col("_e0"), at)
        for k in range(1, len(INDEXED) - 1):
            spot = spot.when(at < F.col(f"_e{k}"), at + (F.lit(k * PLACE_STEP) - F.col(f"_e{k - 1}")))
        return spot.otherwise(at + (F.lit((len(INDEXED) - 1) * PLACE_STEP) - F.col(f"_e{len(INDEXED) - 2}")))

    # A code is a token's hash before its number in the record: codes sort faster than words. Where a run starts and
    # the hash is that of the run before, two words share it; then the words themselves are sorted.
    by_hash = F.transform("toks", lambda t, i: F.shiftleft(F.hash(t).cast("bigint"), 32).bitwiseOR(i.cast("bigint")))
    by_word = F.sort_array(F.transform("toks", lambda t, i: F.struct(t.alias("t"), i.alias("i"))))
    runs = once(once(joined, {"codes": F.sort_array(by_hash)}), {"starts": starts()})
    shared = F.exists(
        "starts", lambda s: (s > 0) & (F.shiftright(F.get("codes", s), 32) == F.shiftright(F.get("codes", s - 1), 32))
    )
    runs = once(runs, {"shared": shared, "codes": F.when(shared, F.transform(by_word, lambda x: x["i"].cast("bigint"))).otherwise(F.col("codes"))})
    runs = once(runs, {"starts": F.when(F.col("shared"), starts()).otherwise(F.col("starts")), "places": F.transform("codes", place)})
    exploded = runs.select(*key, "len", "toks", "codes", "places", "starts", F.posexplode("starts").alias("k", "s"))
    size = F.coalesce(F.get("starts", F.col("k") + 1), F.col("len")) - F.col("s")
    found = exploded.select(*key, "len", F.get("toks", number(F.col("s"))).alias("token"), F.slice("places", F.col("s") + 1, size).alias("places"))
    return found.select(_bucket_of(F.col("token")).alias("bucket"), "token", *key, F.size("places").alias("freq"), "places", "len")


def in_buckets(posts: DataFrame) -> DataFrame:
    """Postings as the index keeps them: by bucket and token, without what can be told from the rest."""
    return posts.drop("freq").hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "token")


def corpus_stats(lake: DataFrame) -> DataFrame:
    """One row: records and tokens indexed. Appended per batch and summed when read."""
    length = reduce(lambda a, b: a + b, [_length(token_line(_as_text(lake, c))) for c in INDEXED])
    return lake.agg(F.count("*").alias("docs"), F.coalesce(F.sum(length), F.lit(0)).cast("bigint").alias("tokens"))


def postings_stats(posts: DataFrame, docs: int) -> DataFrame:
    """The row of ``corpus_stats`` for so many records, from all their postings: every token has one place."""
    tokens = F.coalesce(F.sum(F.size("places")), F.lit(0)).cast("bigint")
    return posts.agg(F.lit(docs).cast("bigint").alias("docs"), tokens.alias("tokens"))


def _wanted_postings(posts: DataFrame, words: list[str], prefixes: list[str]) -> DataFrame:
    """Postings of the words and of all tokens with a prefix.

    Words name the buckets to read. A prefix may be in any bucket; within one, files are in
    order of token, so its range skips row groups.
    """
    tests = [F.col("token").isin(words)] if words else []
    tests += [F.col("token").between(p, p + "\U0010ffff") for p in prefixes]
    hits = posts.filter(reduce(lambda a, b: a | b, tests))
    if "bucket" in posts.columns and not prefixes:
        # The bucket of a word is computed by Spark on literals, then folded into the partition filter.
        hits = hits.filter(reduce(lambda a, b: a | b, [F.col("bucket") == _bucket_of(F.lit(w)) for w in words]))
    return hits


def _unit_counts(hits: DataFrame, units: list[tuple[str, list[str], bool]], columns: tuple[str, ...], key: tuple[str, ...]) -> DataFrame:
    """(the key, len, _f): how often each unit occurs in a record, from places of its words."""
    found = hits.groupBy(*key).agg(
        F.max("len").alias("len"), F.collect_list(F.struct("token", "places")).alias("_found"),
    )
    allowed = [k for k, name in enumerate(INDEXED) if name in columns]
    parts = list(dict.fromkeys((w, prefix and i == len(words) - 1) for _, words, prefix in units for i, w in enumerate(words)))

    def places(word: str, prefix: bool) -> Column:
        of = F.filter("_found", lambda x: x["token"].startswith(word) if prefix else x["token"] == word)
        return F.filter(F.flatten(F.transform(of, lambda x: x["places"])), lambda p: F.shiftright(p, 32).isin(allowed))

    # Places stand in columns of their own, so that looking one up does not gather them again.
    found = once(found, {f"_p{k}": places(*part) for k, part in enumerate(parts)})

    def followed(at: Column, name: str, step: int) -> Column:
        return F.filter(at, lambda p: F.array_contains(F.col(name), p + step))

    def count(words: list[str], prefix: bool) -> Column:
        names = [f"_p{parts.index((w, prefix and i == len(words) - 1))}" for i, w in enumerate(words)]
        at = F.col(names[0])
        for step, name in enumerate(names[1:], 1):
            at = followed(at, name, step)
        return F.size(at)

    counted = once(found, {"_f": F.array(*[count(words, prefix) for _, words, prefix in units])})
    return counted.select(*key, "len", "_f")


def search_postings(
    posts: DataFrame, stats: DataFrame, match: Match | str, limit: int | None = 50, records: DataFrame | None = None
) -> DataFrame:
    """(lake_id, date_partition, score) of the best records for the match, as ``search`` ranks them.

    Postings by number need ``records``, the id and date of each number (``insert``, ``doc``); those of
    matching records are looked up before the ranking, which settles ties by id. Only postings of the query's tokens are read; the query is the caller's own short string, so everything
    up to the top-k works on matching postings.
    """
    match = Match(words=match) if isinstance(match, str) else match
    units = _units(match)
    if not any(role != "none" for role, _, _ in units):
        return (posts if records is None else records).limit(0).select(*RECORD, F.lit(None).cast("double").alias("score"))
    words = list(dict.fromkeys(w for _, ws, prefix in units for w in (ws[:-1] if prefix else ws)))
    prefixes = list(dict.fromkeys(ws[-1] for _, ws, prefix in units if prefix))
    key = RECORD if records is None else tuple(c for c in NUMBER if c in posts.columns)
    counted = _unit_counts(_wanted_postings(posts, words, prefixes), units, match.columns, key)

    corpus = stats.agg(
        F.struct(F.sum("docs").cast("double").alias("n"), F.try_divide(F.sum("tokens"), F.sum("docs")).alias("avg_len")).alias("t")
    ).scalar()
    found = counted.agg(
        F.struct(*[F.count_if(F.col("_f")[i] > 0).cast("double").alias(f"h{i}") for i in range(len(units))]).alias("t")
    ).scalar()
    kept = _matching(counted, units).withColumns({"_corpus": corpus, "_found": found})
    n, avg_len = F.col("_corpus.n"), F.col("_corpus.avg_len")
    parts = [
        _bm25(F.col("_f")[i].cast("double"), F.col("len"), _idf(n, F.col(f"_found.h{i}")), avg_len)
        for i, (role, _, _) in enumerate(units) if role != "none"
    ]
    score = -reduce(lambda a, b: a + b, parts)
    scored = kept.select(*key, score.alias("score"))
    if records is not None:
        scored = records.select(*key, *RECORD).join(scored, list(key))
    return _best(scored.select(*RECORD, "score"), limit)


def fetch(hits: DataFrame, lake: DataFrame) -> DataFrame:
    """Records of the hits, best first.

    No hint: Spark knows how short a limited hit list is, and an unlimited one
    must not be broadcast unseen. The hits' dates narrow the folders read.
    """
    short = hits.select("lake_id", "date_partition", "score")
    if "date" in lake.columns:
        short = short.withColumn("date", F.col("date_partition"))
        return lake.join(short, ["lake_id", "date_partition", "date"]).orderBy("score", "lake_id")
    return lake.join(short, ["lake_id", "date_partition"]).orderBy("score", "lake_id")
