"""Many groupings of one frame in a single aggregate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col

VIEW = "view"
#: The view that holds one row on all rows together.
WHOLE = "whole"


def grouped_together(df: DataFrame, keys: Mapping[str, list[str]],
                     aggregates: Mapping[str, Column]) -> DataFrame:
    """One row per view and group: ``view``, every key column, the aggregates.

    ``keys`` names the key columns of each view; columns that a view does not group by are
    null in its rows. ``WHOLE`` is there besides, unless its name is taken. All views come from one pass: Spark
    expands each row into one per view (GROUPING SETS) and combines them in the task that read
    it, so only groups are shuffled. Rows whose keys are all null belong to a group of
    their own; ``view_of`` leaves it out.
    """
    views = {**({} if WHOLE in keys else {WHOLE: []}), **keys}
    names = list(dict.fromkeys(k for ks in views.values() for k in ks))
    top = len(names) - 1
    # Spark numbers a grouping set by the keys that it does not hold, the first key being
    # the highest bit.
    number = {view: sum(1 << (top - i) for i, n in enumerate(names) if n not in ks)
              for view, ks in views.items()}
    if len(set(number.values())) < len(views):
        raise ValueError("two views group by the same columns")
    which = F.grouping_id()
    view = F.element_at(F.create_map(*[F.lit(x) for v, n in number.items() for x in (n, v)]),
                        which.cast("int"))
    return (df.groupingSets([[col(k) for k in ks] for ks in views.values()],
                            *[col(n) for n in names])
            .agg(view.alias(VIEW), *[c.alias(name) for name, c in aggregates.items()])
            .select(VIEW, *[col(n) for n in names], *aggregates))


def view_of(groups: DataFrame, view: str, keys: list[str]) -> DataFrame:
    """The rows of one view whose keys are all known."""
    rows = groups.where(F.col(VIEW) == view)
    for k in keys:
        rows = rows.where(col(k).isNotNull())
    return rows
