"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every rule is a ratio of two measures with bounds. Measures are column expressions
over the words and lines of the whole text; each costly one is computed once per
row. Nothing is shuffled, so a row's cost depends on its own text alone.

The rule on stop words speaks only where a listed language can be meant: not for a text of which half of the words hold
a letter of another script than Latin, and not where a language is given that has no list.

Defined cases: a null or empty text has no words and fails the base rule; a ratio whose
denominator is 0 is undefined and breaks no bound; repeated rows are judged one by one;
columns of the input are kept, and a clash with a result's name is settled by the caller.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from hazlake.functions.once import once

# The separators of words, and the characters counted as symbols.
SEPARATORS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

# Frequent function words by language.
STOP_WORDS_OF = {
    "en": "the of and to in is that it for was on are as with be by at from this an or",
    "de": "der die das und ist in zu den von mit ein eine nicht auf des im auch sich für",
    "fr": "le la les de des et un une est que qui dans pour pas sur au avec en du",
    "es": "el los las y es por con para no se lo del al",
}
#: All of them: a text may change its language, or be given a wrong one.
STOP_WORDS = " ".join(STOP_WORDS_OF.values()).split()
#: A word of another script: it holds a letter that is not Latin.
FOREIGN = r"[^\P{L}\p{IsLatin}]"

BASE_WORDS = 20
BASE_REPEAT_PERCENT = 30
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``numerator / denominator`` must lie within the bounds that are given, where the measure ``given`` (boolean), if any, holds."""

    name: str
    numerator: str
    denominator: str
    least: float | None = None
    most: float | None = None
    given: str | None = None

    def broken(self) -> Column:
        ratio = F.col(self.numerator) / F.nullif(F.col(self.denominator), F.lit(0))
        tests = [ratio < self.least] if self.least is not None else []
        tests += [ratio > self.most] if self.most is not None else []
        out = tests[0]
        for test in tests[1:]:
            out = out | test
        if self.given:
            out = out & F.col(self.given)
        return F.coalesce(out, F.lit(False))


RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=15.0),
    Rule("symbols", "n_symbols", "n_words", most=0.3),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02, given="stop_words_listed"),
    Rule("letters", "n_letter_words", "n_words", least=0.6),
    Rule("stutter", "n_stutters", "n_words", most=0.3),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("bullets", "n_bullet_lines", "n_lines", most=0.9),
    Rule("ellipses", "n_ellipsis_lines", "n_lines", most=0.3),
)


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def _repeated_starts(sorted_windows: Column) -> Column:
    """Ascending positions of the windows that occur twice or more; windows sorted by hash."""
    before = F.concat(F.array(F.lit(None)), F.slice(sorted_windows, 1, F.size(sorted_windows) - 1))
    after = F.slice(sorted_windows, 2, F.size(sorted_windows))
    beside = F.arrays_zip(sorted_windows.alias("w"), before.alias("b"), after.alias("a"))
    repeats = F.filter(beside, lambda x: (x["w"]["h"] == x["b"]["h"]) | (x["w"]["h"] == x["a"]["h"]))
    return F.array_sort(F.transform(repeats, lambda x: x["w"]["i"]))


def listed(language: Column, languages=tuple(STOP_WORDS_OF)) -> Column:
    """Whether a language tag (``en``, ``en-GB``, ``EN_us``) has a list of stop words; an unknown one may have."""
    primary = F.lower(F.regexp_extract(language, r"^\s*([A-Za-z]*)", 1))
    return F.coalesce(primary.isin(*languages, "", "und"), F.lit(True))


def measured(df: DataFrame, text: str = "text", stop_words=STOP_WORDS, language: str | None = None) -> DataFrame:
    """Add the measures that rules name, all long but the boolean ``stop_words_listed``; ``language`` names a column of language tags.

    ``n_repeat_words`` counts the words inside runs of eight words that occur twice or
    more in the text. Runs are compared by 64-bit hashes within one text, and only a
    text that has a repeated hash goes on to the positions.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    df = once(df, {"_words": words_of(F.col(text)), "_lines": lines})
    # Everything that needs words or lines comes first, so that later steps carry only hashes.
    of_words = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOL)),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(list(dict.fromkeys(stop_words))))),
        # One search of the text spares most texts a search of every word.
        "n_foreign_words": F.when(body.rlike(FOREIGN), F.size(F.filter("_words", lambda w: w.rlike(FOREIGN)))).otherwise(0),
        "n_letter_words": F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))),
        "n_stutters": F.size(F.filter(F.zip_with("_words", F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))), lambda a, b: a == b), lambda x: x)),
        "n_bullet_lines": F.size(F.filter("_lines", lambda line: line.rlike(r"^\s*[-*•‣●]\s"))),
        "n_ellipsis_lines": F.size(F.filter("_lines", lambda line: line.rlike(r"(\.\.\.|…)\s*$"))),
    }
    hashes = F.when(F.size("_words") > WINDOW, F.transform("_words", lambda w: F.xxhash64(w)))
    df = once(df, {name: column.cast("long") for name, column in of_words.items()} | {"_hashes": hashes}).drop("_words", "_lines")
    same_script = 2 * F.col("n_foreign_words") < F.greatest("n_words", F.lit(1))
    df = df.withColumn("stop_words_listed", same_script & listed(F.col(language)) if language else same_script)
    runs = F.transform(F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)))
    df = once(df, {"_runs": F.when(F.col("_hashes").isNotNull(), runs)}).drop("_hashes")
    by_hash = F.array_sort(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size("_runs") > F.size(F.array_distinct("_runs"))
    df = once(df, {"_sorted": F.when(repeated, by_hash)}).drop("_runs")
    df = once(df, {"_starts": _repeated_starts(F.col("_sorted"))}).drop("_sorted")
    # A run covers up to the next one, and no more than its own words.
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.least(F.lit(WINDOW), s + WINDOW - acc["end"])).alias("n"), (s + WINDOW).alias("end")),
        lambda acc: acc["n"],
    )
    return once(df, {"n_repeat_words": F.coalesce(covered, F.lit(0).cast("long"))}).drop("_starts")


def judged(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, language: str | None = None) -> DataFrame:
    """Add the measures, ``base_failed``, ``broken`` (names of the rules a text breaks) and ``kept``."""
    df = measured(df, text, language=language)
    base = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))
    names = F.array(*[F.when(rule.broken(), rule.name) for rule in rules])
    df = df.withColumns({"base_failed": base, "broken": F.array_compact(names)})
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def kept_documents(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, language: str | None = None) -> DataFrame:
    """The rows whose text passes, with the columns they came with."""
    tag = F.col(language) if language else F.lit(None).cast("string")
    row = df.select(F.struct(*df.columns).alias("_row"), F.col(text).alias("_text"), tag.alias("_tag"))
    return judged(row, "_text", rules, "_tag").filter("kept").select("_row.*")
