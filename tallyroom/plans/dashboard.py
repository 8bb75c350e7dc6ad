"""Every dashboard view as a DataFrame over one kept table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.columns import col, nans_to_nulls
from ..functions.labels import currency
from ..operators.distributions import category_counts, histogram, options, shares
from ..operators.filters import filter_rows, page
from ..operators.region import place, unplaced
from ..operators.summary import bounds, metric_labels, summarise, top_row
from ..operators.topk import sample_rows, top_groups

HISTOGRAM_BINS = 25
SAMPLE_ROWS = 1500
TOP_GROUPS = 15


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in the views."""

    key: str = "full_name"
    label: str = "short_name"
    rating: str = "overall"
    potential: str = "potential"
    value: str = "value_eur"
    age: str = "age"
    region: str = "nationality"
    category: str = "preferred_foot"
    group: str = "club_name"

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys([self.key, self.label, self.rating, self.potential, self.value,
                                   self.age, self.region, self.category, self.group]))


class Dashboard:
    """Views over one table, kept between calls until ``close``.

    Spark holds the table on the executors, in memory and then on their disks, and
    rebuilds lost parts from the source. Only the columns in use are kept. Give
    ``keep=None`` where the table is larger than the cluster's storage: each view
    then scans the two or three columns it needs.
    """

    def __init__(self, table: DataFrame, roles: Roles = Roles(),
                 countries: DataFrame | None = None,
                 keep: StorageLevel | None = StorageLevel.MEMORY_AND_DISK):
        self.table, self.roles, self.countries = table, roles, countries
        rows = nans_to_nulls(table.select(*[col(c) for c in roles.columns]))
        # What is kept has the columns of the views; whole rows come from the table.
        self.rows = rows.persist(keep) if keep is not None else rows
        self._kept = keep is not None

    def close(self) -> None:
        if self._kept:
            self.rows.unpersist()

    def inputs(self) -> dict[str, DataFrame]:
        """What the filter controls offer: regions and rating bounds."""
        return {"region_options": options(self.rows, self.roles.region),
                "rating_bounds": bounds(self.rows, self.roles.rating)}

    def filtered(self, rating: tuple[Any, Any] | None = None,
                 region: str | None = None) -> DataFrame:
        """The filtered rows with the columns of the views, from the kept frame if there is one."""
        if self._kept:
            return filter_rows(self.rows, {self.roles.rating: rating}, {self.roles.region: region})
        return self.explored(rating, region).select(*[col(c) for c in self.roles.columns])

    def explored(self, rating: tuple[Any, Any] | None = None,
                 region: str | None = None) -> DataFrame:
        """The filtered rows with every column of the table. The filter stands on the columns as
        stored, so it reaches the scan; a closed range holds no NaN."""
        return nans_to_nulls(filter_rows(self.table, {self.roles.rating: rating},
                                         {self.roles.region: region}))

    def views(self, rating: tuple[Any, Any] | None = None, region: str | None = None,
              seed: int = 42) -> dict[str, DataFrame]:
        """All views of the filtered rows; each is lazy and small once run."""
        r, rows = self.roles, self.filtered(rating, region)
        counts = category_counts(rows, r.region, r.region, "count")
        explored = self.explored(rating, region)
        top = top_row(explored, r.value, [r.key])
        views = {
            "summary": summarise(rows, r.rating),
            "labels": metric_labels(rows, r.rating, r.value),
            "top_entity": top.select("*", currency(col(r.value)).alias("value_label")),
            "age_histogram": histogram(rows, r.age, HISTOGRAM_BINS),
            "rating_histogram": histogram(rows, r.rating, HISTOGRAM_BINS),
            "category_shares": shares(rows, r.category),
            "rating_value_sample": sample_rows(
                rows, [r.key], [r.rating, r.value, r.label], SAMPLE_ROWS, seed),
            "age_potential_sample": sample_rows(
                rows, [r.key], [r.age, r.potential, r.label], SAMPLE_ROWS, seed + 1),
            "region_counts": counts,
            "top_groups": top_groups(rows, r.group, r.rating, TOP_GROUPS),
            "rows": explored,
        }
        if self.countries is not None:
            views["region_counts"] = place(counts, self.countries, r.region)
            views["unplaced_regions"] = unplaced(counts, self.countries, r.region)
        return views

    def rows_page(self, size: int, after: tuple | None = None,
                  filters: Mapping[str, Any] | None = None) -> DataFrame:
        """One page of the filtered rows in key order, see ``page``."""
        return page(self.explored(**(filters or {})), [self.roles.key], size, after)


def long_form(views: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Several views in one frame: ``view``, ``key``, ``number``."""
    parts = [df.select(F.lit(name).alias("view"), col(key).cast("string").alias("key"),
                       col(number).cast("double").alias("number"))
             for name, (df, key, number) in views.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
