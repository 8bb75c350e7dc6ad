"""Top groups by mean, and reproducible fixed-size samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, nan_as_null

# Leading zero digits tried for the sample cut; 16 to the twelfth is beyond any
# row count. The cut is looked for among this part of the rows.
_MAX_ZEROS = 12
_LOOKED_AT = 1 / 16


def top_groups(df: DataFrame, key: str, value: str, n: int = 15,
               mean_name: str = "mean") -> DataFrame:
    """The ``n`` groups with the highest mean; groups without a known value last."""
    k = col(key)
    means = (df.where(k.isNotNull()).groupBy(k)
             .agg(F.avg(nan_as_null(df, value)).alias(mean_name)))
    return means.orderBy(col(mean_name).desc_nulls_last(), k.asc()).limit(n)


def sample_digest(keys: Sequence[str], seed: int) -> Column:
    """The text whose order is the order of the sample."""
    text = [F.coalesce(col(k).cast("string"), F.lit("")) for k in keys]
    joined = text[0] if len(text) == 1 else F.concat_ws("\x1f", *text)
    return F.md5(F.concat(F.lit(f"{seed}:"), joined).cast("binary"))


def sample_cut(digest: str, n: int) -> str:
    """SQL text of an aggregate: a digest that at least ``n`` of the rows seen sort before, 'g',
    which all do, if there are fewer. A digest with z leading zeros sorts before z zeros and a 'g'."""
    return "least(" + ", ".join(
        f"if(count_if({digest} < '{'0' * z}g') >= {n:d}, '{'0' * z}g', 'g')"
        for z in range(1, _MAX_ZEROS + 1)) + ")"


def sample_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                n: int = 1500, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows without replacement, the same on every run.

    The sample is the first ``n`` rows in order of md5(seed:key), a random order
    that partitioning does not change. ``n`` is what one screen can show.

    Keeping ``n`` rows in every one of many thousand tasks and merging them in one
    would be the bottleneck. So a first look at a part of the keys counts how many
    digests start with one, two, three.. zeros. The longest run of zeros that is
    seen ``n`` times becomes the cut. What a part holds the whole holds, so at least
    ``n`` rows pass the cut for certain, a few hundred times ``n`` as a rule, and
    the result is exact for any data. Without such a run every row passes.
    """
    digest = sample_digest(keys, seed)
    some = (df.select(*[col(k) for k in keys]).sample(_LOOKED_AT, seed)
            .select(digest.alias("digest")))
    cut = some.agg(F.expr(sample_cut("digest", n))).scalar()

    wanted = list(dict.fromkeys([*keys, *columns]))
    order = [F.col("__digest"), *[col(c).asc_nulls_last() for c in wanted]]
    return (df.where(digest < cut)
            .select(*[col(c) for c in wanted], digest.alias("__digest"))
            .orderBy(*order).limit(n)
            .select(*[col(c) for c in columns]))
