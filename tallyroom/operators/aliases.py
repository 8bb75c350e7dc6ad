"""Names found by patterns: abbreviated, misspelt or wordier names than the dimension holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col

#: Shortest words that may hold a slip of one letter, and shortest abbreviation.
SLIP_LETTERS, SHORT_LETTERS = 5, 3
_NO = 99


def plain_words(name: Column) -> Column:
    """Lower-case words of letters and digits; dotted initials are one word (U.S. is us)."""
    spaced = F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{M}\p{N}]+", " "))
    joined = F.regexp_replace(spaced, r"(?<=(^| )\p{L}) (?=\p{L}( |$))", "")
    return F.filter(F.split(joined, " "), lambda w: w != "")


def word_cost(word: Column, pattern: Column) -> Column:
    """0 for the pattern's word itself, 1 for its beginning or a slip of one letter, else 99."""
    short = (F.length(word) >= SHORT_LETTERS) & F.startswith(pattern, word)
    slip = ((F.least(F.length(word), F.length(pattern)) >= SLIP_LETTERS)
            & (F.levenshtein(word, pattern) <= 1))
    return F.when(word == pattern, 0).when(short | slip, 1).otherwise(_NO)


def _keys(word: Column) -> Column:
    """What two words share if one may stand for the other: the first letters, or the word
    with at most one letter left out (words one slip apart have such a form in common)."""
    without = F.transform(F.sequence(F.lit(1), F.length(word)),
                          lambda i: F.concat(F.lit("-"), F.substring(word, F.lit(1), i - 1),
                                             F.substring(word, i + 1, F.length(word))))
    slips = F.when(F.length(word) >= SLIP_LETTERS, F.array_append(without, F.concat(F.lit("-"), word)))
    return F.array_distinct(F.concat(
        F.array(F.concat(F.lit("="), word), F.concat(F.lit("^"), F.substring(word, 1, SHORT_LETTERS))),
        F.coalesce(slips, F.array().cast("array<string>"))))


def place_by_pattern(counts: DataFrame, patterns: DataFrame, on: str, key: str,
                     pattern: str = "pattern") -> DataFrame:
    """The counts with ``key``: of the pattern that fits the name, or null.

    A pattern is a list of words. It fits a name that holds all of them, in any order, among any
    others; a word of the name may be short for the pattern's or hold a slip. The pattern
    of most words wins, then the one with the fewest words that differ. Where the best patterns of
    a name have different keys it is not placed. Null names and names without words are not placed,
    patterns or keys that are null or have no words never fit.

    Every pattern is indexed under its rarest word, every distinct name looked up with its words, and
    what meets there is verified: names and patterns are never multiplied out.
    """
    rules = (patterns.select(col(key).alias("__key"), F.array_distinct(plain_words(col(pattern))).alias("__rule"))
             .where(F.col("__key").isNotNull() & (F.size("__rule") > 0)).distinct())
    words = rules.select("__key", "__rule", F.explode("__rule").alias("__word"))
    used = words.groupBy("__word").agg(F.count(F.lit(1)).alias("__n"))
    rarest = (words.join(used, "__word").groupBy("__key", "__rule")
              .agg(F.min(F.struct("__n", -F.length("__word"), "__word"))["__word"].alias("__word")))
    index = rarest.select("__key", "__rule", F.explode(_keys(F.col("__word"))).alias("__at"))
    names = (counts.select(col(on).alias("__name")).where(F.col("__name").isNotNull()).distinct()
             .withColumn("__words", F.array_distinct(plain_words(F.col("__name")))))
    looked = names.select("__name", "__words", F.explode("__words").alias("__word")).select(
        "__name", "__words", F.explode(_keys(F.col("__word"))).alias("__at"))
    met = looked.join(index, "__at").select("__name", "__words", "__key", "__rule").distinct()
    costs = F.transform("__rule", lambda p: F.array_min(
        F.transform("__words", lambda w: word_cost(w, p))))
    cost = F.aggregate(costs, F.lit(0), lambda total, c: total + c)
    fits = met.withColumn("__cost", cost).where(F.col("__cost") < _NO)
    ranked = fits.groupBy("__name", F.struct(-F.size("__rule"), "__cost").alias("__rank")).agg(
        F.min("__key").alias("__least"), F.max("__key").alias("__most"))
    best = ranked.groupBy("__name").agg(F.min_by(F.struct("__least", "__most"), "__rank").alias("__best"))
    placed = best.select("__name", F.when(F.col("__best.__least") == F.col("__best.__most"),
                                          F.col("__best.__least")).alias(key))
    return counts.join(placed, col(on) == F.col("__name"), "left").drop("__name")
