"""Mix sources to target weights: repetition rates per source, whole documents repeated.

``target_rates`` shares all words over the sources by weight, limited to ``max_repeats``
times a source's own size; ``mix`` gives every document floor(rate) copies and one more by
a hash-seeded draw whose probability is the fraction of the rate.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; empty sources have target and rate 0; rows of one id draw each by its text, so only rows
equal in both draw alike; a null id draws like the text "null"; an empty table gives no rows. Input columns of other names are
never looked at, so clashing names cannot matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, unused

#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = "mix-1"


def n_words(column: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(WORD)).cast("bigint")


def target_rates(sized: DataFrame, weights: Sequence[int] = WEIGHTS,
                 max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source of ``sized`` (source, size): source_size, target, rate.

    The limit binds for the sources with the least (limit / weight) first, so the
    sources that stop at their limit are a prefix in that order, and what remains for
    the others is one division. All steps after the first aggregate see one row per
    source; every map task sends one row per source into it, so a source with a third
    of all rows is no more work than another.
    """
    sources = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*[F.lit(int(w)) for w in weights])
    by_limit = Window.orderBy("__ratio", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    shares = (
        sources
        .withColumn("__weight", F.element_at(weight, (place % len(weights) + 1).cast("int")))
        .withColumn("__limit", F.col("source_size") * max_repeats)
        .withColumn("__ratio", F.col("__limit") / F.col("__weight"))
        .withColumn("__left", F.sum("source_size").over(whole)
                    - F.coalesce(F.sum("__limit").over(before), F.lit(0)))
        .withColumn("__level", F.col("__left") / F.sum("__weight").over(onward))
        # The first source whose limit is not below the level ends the prefix; its level
        # holds for it and all after it.
        .withColumn("__free", F.col("__level") <= F.col("__ratio"))
        .withColumn("__level", F.min(F.when(F.col("__free"), F.struct("__ratio", "__level")))
                    .over(whole)["__level"]))
    target = F.least(F.col("__limit").cast("double"), F.col("__level") * F.col("__weight"))
    return (shares.withColumn("target", F.coalesce(target, F.col("__limit").cast("double")))
            .withColumn("rate", F.when(F.col("source_size") > 0,
                                       F.col("target") / F.col("source_size"))
                        .otherwise(F.lit(0.0)))
            .select("source", "source_size", "target", "rate"))


def draw(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id, the text and the seed: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"),
                                                  F.lit("null")), F.lit(":"),
                    F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def copies(rate: Column, id_col: str, text_col: str, seed: str = SEED) -> Column:
    """How often a document is emitted: floor(rate), and one more with its fraction."""
    more = (draw(id_col, text_col, seed) < rate - F.floor(rate)).cast("int")
    return (F.floor(rate) + more).cast("int")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", seed: str = SEED) -> DataFrame:
    """Per document: id, size, source, source_size, target, rate, copies.

    The join with the sources is left to the planner: adaptive execution broadcasts
    them while they are small, else splits a hot source's partition.
    """
    sized = docs.select(F.col(f"`{id_col}`").alias("id"),
                        F.col(f"`{source_col}`").alias("source"),
                        n_words(f"`{text_col}`").alias("size"),
                        draw(id_col, text_col, seed).alias("__draw"))
    rates = target_rates(sized).withColumnRenamed("source", "__source")
    rate = F.col("rate")
    more = (F.col("__draw") < rate - F.floor(rate)).cast("int")
    return (sized.join(rates, F.col("source").eqNullSafe(F.col("__source")))
            .withColumn("copies", (F.floor(rate) + more).cast("int")).drop("__source", "__draw"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, all columns, each as often as it is taken."""
    sized = docs.select(F.col(f"`{source_col}`").alias("source"),
                        n_words(f"`{text_col}`").alias("size"))
    source, rate, times, copy = unused(docs, "__source", "__rate", "__times", "__copy")
    rates = target_rates(sized).select(F.col("source").alias(source), F.col("rate").alias(rate))
    joined = docs.join(rates, F.col(f"`{source_col}`").eqNullSafe(F.col(source)))
    return (joined.withColumn(times, copies(F.col(rate), id_col, text_col, seed))
            .where(F.col(times) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
