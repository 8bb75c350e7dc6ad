"""Category counts, shares, option lists and histograms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col


def category_counts(df: DataFrame, key: str, key_name: str = "k",
                    count_name: str = "n") -> DataFrame:
    """Rows per known key, most frequent first.

    Counts are combined in the map tasks, so a dominant key costs one row per task.
    """
    return _counts(df, key).toDF(key_name, count_name).orderBy(
        col(count_name).desc(), col(key_name).asc())


def _counts(df: DataFrame, key: str) -> DataFrame:
    k = col(key)
    return df.where(k.isNotNull()).groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


def shares(df: DataFrame, key: str) -> DataFrame:
    """``k``, ``n`` and ``share`` of all known rows, most frequent first.

    The total is a scalar subquery over the same counts, whose shuffle is reused.
    A window over all rows would move every group to one task.
    """
    counts = _counts(df, key)
    total = counts.agg(F.sum("n")).scalar()
    return (counts.withColumn("share", F.col("n") / total)
            .orderBy(F.col("n").desc(), F.col("k").asc()))


def options(df: DataFrame, column: str, everything: str = "All") -> DataFrame:
    """Choices for a filter: ``everything`` at ``pos`` 0, then the known values
    in ascending order at ``pos`` 1. Order by (pos, label) is the list order, and
    tells a real value spelt like ``everything`` from the first entry.
    """
    first = df.sparkSession.range(1).select(F.lit(0).alias("pos"), F.lit(everything).alias("label"))
    c = col(column)
    values = (df.where(c.isNotNull()).select(c.cast("string").alias("label")).distinct()
              .select(F.lit(1).alias("pos"), "label"))
    return first.union(values).orderBy("pos", "label")


# Round steps within one power of ten and the two above it.
_STEPS = (1, 2, 5, 10, 20, 50, 100, 200, 500)


@dataclass(frozen=True)
class Bins:
    """SQL texts of the binning of one column: of its value ``v``, its range ``lo``, ``hi`` and a
    width ``w``."""

    whole: bool
    nbins: int

    def value(self, column: str) -> Column:
        """The binned value, null for null, NaN and infinite ones. Whole numbers are binned in exact
        64-bit arithmetic, all others in doubles."""
        c = col(column)
        if self.whole:
            return c.cast("bigint")
        return F.when(F.abs(c) < F.lit(float("inf")), c).cast("double")

    def width(self, lo: str, hi: str) -> str:
        widths = (_whole_widths if self.whole else _float_widths)(self.nbins, lo, hi)
        # As decimals: two 64-bit bins can be further apart than 64 bits.
        fits = (f"w -> cast({self.bin(hi, 'w')} as decimal(20, 0)) - "
                f"cast({self.bin(lo, 'w')} as decimal(20, 0)) < {self.nbins}")
        return f"get(filter({widths}, {fits}), 0)"

    def bin(self, v: str, w: str) -> str:
        return (_whole_bin if self.whole else _float_bin)(v, w)

    def start(self, b: str, w: str) -> str:
        return (_whole_start if self.whole else _float_start)(b, w)


def bins_of(df: DataFrame, column: str, nbins: int) -> Bins:
    if nbins < 2:
        raise ValueError("nbins must be at least 2")
    return Bins(isinstance(df.schema[column].dataType, T.IntegralType), nbins)


def histogram(df: DataFrame, column: str, nbins: int = 25, fill_empty: bool = False,
              weight: str | None = None) -> DataFrame:
    """Counts per equal-width bin: ``bin``, ``bin_start``, ``n``, in bin order.

    ``weight`` names a whole-number column that says how many rows a row stands for.

    The width is the smallest of 1, 2 or 5 times a power of ten that needs at most
    ``nbins`` bins aligned at zero, so edges are round numbers. Whole-number
    columns never take a width under 1. Null, NaN and infinite values are in no bin.

    The range is a scalar subquery: one pruned scan for min and max, one for the
    counts; neither shuffles more than a row or ``nbins`` rows per task.
    """
    b = bins_of(df, column, nbins)
    values = (df.where(col(column).isNotNull())
              .select(b.value(column).alias("v"),
                      (F.lit(1) if weight is None else col(weight)).cast("bigint").alias("__n"))
              .where(F.col("v").isNotNull()))
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = span.select(F.expr(b.width("lo", "hi"))).scalar().alias("w")
    count = F.count(F.lit(1)) if weight is None else F.sum("__n")
    counts = (values.select("v", "__n", width).select(F.expr(b.bin("v", "w")).alias("bin"), "__n")
              .groupBy("bin").agg(count.alias("n")))
    if fill_empty:
        # At most nbins rows on either side of this join.
        bins = f"explode(sequence({b.bin('lo', 'w')}, {b.bin('hi', 'w')}))"
        spine = span.where("lo is not null").select("lo", "hi", width).select(
            F.expr(bins).alias("bin"))
        counts = spine.join(counts, "bin", "left").select(
            "bin", F.expr("coalesce(n, 0L)").alias("n"))
    # One row per bin: sorted in one task, without the sampling job of a
    # range-partitioned sort.
    return (counts.select("bin", "n", width)
            .select("bin", F.expr(b.start("bin", "w")).alias("bin_start"), "n")
            .repartition(1).sortWithinPartitions("bin"))


# The formulas are SQL text: as nested Column calls they take longer to build than
# a small table takes to scan.

def _exponent(nbins: int, lo: str, hi: str) -> str:
    """Power of ten at or below range/nbins: no smaller width is enough, and one of
    the steps above it is. A single value counts as a range that needs width 1."""
    span = f"(cast({hi} as double) - cast({lo} as double))"
    return f"if({span} > 0, cast(floor(log10({span} / {nbins})) as int), 0)"


def _ten_to(e: str) -> str:
    """10^e read from text, which is exact where ``pow`` need not be."""
    return f"cast(concat('1e', {e}) as double)"


def _whole_widths(nbins: int, lo: str, hi: str) -> str:
    unit = f"cast({_ten_to(f'greatest({_exponent(nbins, lo, hi)}, 0)')} as decimal(20, 0))"
    steps = f"transform(array{_STEPS}, s -> cast({unit} * s as decimal(38, 0)))"
    fitting = f"filter({steps}, x -> x <= {2**63 - 1}BD)"
    return f"transform({fitting}, x -> cast(x as bigint))"


def _whole_bin(v: str, w: str) -> str:
    # Floor division that never leaves 64 bits.
    return f"(({v} div {w}) - if({v} % {w} < 0, 1L, 0L))"


def _whole_start(b: str, w: str) -> str:
    # The first bin may start below the least bigint.
    return f"coalesce(try_multiply({b}, {w}), {-2**63 + 1}L - 1L)"


def _float_widths(nbins: int, lo: str, hi: str) -> str:
    """Widths as num/den with whole num and den: 0.05 has no exact double, 5/100 has."""
    e = _exponent(nbins, lo, hi)
    unit = _ten_to(f"abs({e})")
    return (f"transform(array{_STEPS}, s -> named_struct("
            f"'num', if({e} >= 0, {unit} * s, cast(s as double)), "
            f"'den', if({e} >= 0, 1D, {unit})))")


def _float_start(b: str, w: str) -> str:
    """Start of a bin, the double nearest to its decimal value."""
    return f"(cast({b} as double) * {w}.num / {w}.den)"


def _float_bin(v: str, w: str) -> str:
    """The bin whose edges enclose the value: 0.29 starts bin 29 of width 0.01,
    though 0.29 * 100 is just under 29."""
    guess = f"floor({v} * {w}.den / {w}.num)"
    return (f"(case when {_float_start(f'({guess} + 1)', w)} <= {v} then {guess} + 1 "
            f"when {_float_start(guess, w)} > {v} then {guess} - 1 else {guess} end)")
