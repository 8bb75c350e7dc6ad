"""Token counts from an exact length histogram.

Documents are aggregated by encoded length: one row per length, whatever the number of
documents. Suffix sums over the lengths then answer, for every context limit L, how many
documents are longer, how many tokens the corpus holds and how many remain when each text is
cut to L tokens (sum of min(length, L)); cumulative counts answer every quantile exactly.

The sums run in two levels, so no task sees all lengths once there are many: lengths are grouped
in ranges of ``RANGE``, a short table of range totals is summed first, and within a
range the window is local. The number of ranges is the longest text over ``RANGE``.

Defined results: a null text has length 0 and counts as a document; ids are not looked at, so
repeated rows count each; an empty table has an empty histogram and answers of 0 (quantiles
null). Columns of other names are never read, so clashing names cannot matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import written

RANGE = 4096


def length_counts(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(length, n_docs): documents per encoded length. Map tasks count before the shuffle.

    The histogram is written, so that texts are encoded once however often it is read.
    """
    return written(bpe.encode(docs, vocabulary, id_col, text_col)
                   .groupBy(F.col("n_tokens").alias("length"))
                   .agg(F.count(F.lit(1)).alias("n_docs")), "lengths", compact=True)


def suffix_sums(counts: DataFrame) -> DataFrame:
    """One row per length: n_docs, docs_up_to, docs_longer, tokens, tokens_longer,
    truncated_tokens (the corpus cut to this length) and share (quantile of the length)."""
    place = F.floor(F.col("length") / RANGE)
    ranged = counts.withColumn("__range", place).withColumn(
        "__tokens", F.col("length") * F.col("n_docs"))
    totals = ranged.groupBy(F.col("__range").alias("__of")).agg(
        F.sum("n_docs").alias("__docs"), F.sum("__tokens").alias("__sum"))
    over = Window.orderBy(F.col("__of").desc())
    above = over.rowsBetween(Window.unboundedPreceding, -1)
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    totals = totals.select(
        "__of", F.coalesce(F.sum("__docs").over(above), zero).alias("__docs_above"),
        F.coalesce(F.sum("__sum").over(above), zero).alias("__tokens_above"),
        F.sum("__docs").over(whole).alias("__all_docs"), F.sum("__sum").over(whole).alias("tokens"))
    longer = (Window.partitionBy("__range").orderBy(F.col("length").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    return (
        ranged.join(totals, F.col("__range") == F.col("__of"))
        .withColumn("docs_longer", F.col("__docs_above")
                    + F.coalesce(F.sum("n_docs").over(longer), zero))
        .withColumn("tokens_longer", F.col("__tokens_above")
                    + F.coalesce(F.sum("__tokens").over(longer), zero))
        .withColumn("docs_up_to", F.col("__all_docs") - F.col("docs_longer"))
        .withColumn("truncated_tokens", F.col("tokens") - F.col("tokens_longer")
                    + F.col("length") * F.col("docs_longer"))
        .withColumn("share", F.col("docs_up_to") / F.col("__all_docs"))
        .select("length", "n_docs", "docs_up_to", "docs_longer", "tokens", "tokens_longer",
                "truncated_tokens", "share"))


def answer_limits(counts: DataFrame, limits: Sequence[int]) -> DataFrame:
    """One row per context limit: docs_longer, tokens, truncated_tokens.

    Between two lengths the truncated total is linear, so the suffix counts of any
    limit follow from the histogram alone: one aggregate, no join.
    """
    spark = counts.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in sorted(set(limits))], "limit bigint")
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    cut = F.least(F.col("length"), F.col("limit")) * F.col("n_docs")
    rows = counts.withColumn("limit", F.explode(F.array(*[F.lit(int(x)).cast("bigint")
                                                           for x in sorted(set(limits))])))
    sums = rows.groupBy("limit").agg(
        total(F.when(F.col("length") > F.col("limit"), F.col("n_docs"))).alias("docs_longer"),
        total(F.col("length") * F.col("n_docs")).alias("tokens"),
        total(cut).alias("truncated_tokens"))
    return wanted.join(sums, "limit", "left").na.fill(0)


def quantiles(counts: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the least length that at least this share of the documents has at most."""
    sums = suffix_sums(counts)
    picks = [F.min(F.when(F.col("share") >= float(q), F.col("length"))).alias(str(i))
             for i, q in enumerate(shares)]
    row = F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(str(i)).alias("length"))
                    for i, q in enumerate(shares)])
    return sums.agg(*picks).select(F.inline(row))
