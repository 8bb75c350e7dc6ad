"""The dashboard from one aggregate, and a stored cube that answers any filter.

``dashboard_facts`` reads the filtered rows twice, however many views there are: once for the ranges of the
histograms and the cuts of the samples, once for one aggregate over all groupings. ``views``
of the stored facts are then small.

``build_cube`` keeps partial aggregates per region and rating, by each of the dimensions of the views.
They merge, so ``cube_views`` answers every range of ratings and every region from the
cube alone. The cube's size follows the number of different values, not that of rows.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, known, nan_as_null, nans_to_nulls
from ..operators.distributions import bins_of, histogram
from ..operators.filters import filter_rows
from ..operators.fused import VIEW, WHOLE, grouped_together, view_of
from ..operators.topk import sample_cut, sample_digest
from .dashboard import HISTOGRAM_BINS, SAMPLE_ROWS, TOP_GROUPS, Roles

# The rows whose digests are looked at for the cut of a sample: one in so many, by hash.
_LOOKED_AT = 16

# The bounds of a cube's top rows: about a cell each for the few thousand that filters have.
_BUCKETS = 4096

_SAMPLES = ("rating_value_sample", "age_potential_sample")


def _negative(df: DataFrame, roles: Roles) -> Column:
    """Ascending from the largest known value."""
    return F.when(known(df, roles.value), -col(roles.value).cast("double"))


def _top(df: DataFrame, roles: Roles) -> Column:
    """The least of these is the row with the largest value, smallest key on ties."""
    k, v = col(roles.key), col(roles.value)
    return F.when(known(df, roles.value), F.struct(
        _negative(df, roles).alias("negative"), k.isNull().alias("unknown"), k.alias("key"),
        col(roles.label).alias("label"), v.alias("value")))


def dashboard_facts(table: DataFrame, roles: Roles = Roles(), rating: tuple[Any, Any] | None = None,
                    region: str | None = None, seed: int = 42) -> DataFrame:
    """One row per view and group, for all views of the filtered rows. Store it; then see ``views``."""
    kept = filter_rows(table, {roles.rating: rating}, {roles.region: region})
    rows = nans_to_nulls(kept.select(*[col(c) for c in roles.columns]))
    age, rate = bins_of(rows, roles.age, HISTOGRAM_BINS), bins_of(rows, roles.rating, HISTOGRAM_BINS)
    digests = {s: sample_digest([roles.key], seed + i) for i, s in enumerate(_SAMPLES)}
    looked = F.pmod(F.xxhash64(col(roles.key)), F.lit(_LOOKED_AT)) == 0
    ranges = rows.select(
        age.value(roles.age).alias("age"), rate.value(roles.rating).alias("rating"),
        *[F.when(looked, d).alias(s) for s, d in digests.items()]).agg(
        F.min("age").alias("age_lo"), F.max("age").alias("age_hi"),
        F.min("rating").alias("rating_lo"), F.max("rating").alias("rating_hi"),
        *[F.expr(sample_cut(s, SAMPLE_ROWS)).alias(s) for s in _SAMPLES])
    # One subquery for all of them, so one scan.
    limits = ranges.select(F.struct(
        F.expr(age.width("age_lo", "age_hi")).alias("age_width"),
        F.expr(rate.width("rating_lo", "rating_hi")).alias("rating_width"), *_SAMPLES)).scalar()
    base = rows.withColumns({"__limits": limits, "__age": age.value(roles.age),
                             "__rating": rate.value(roles.rating),
                             "__score": nan_as_null(rows, roles.rating).cast("double")})
    shown = {"rating_value_sample": (roles.rating, roles.value),
             "age_potential_sample": (roles.age, roles.potential)}
    sampled = {s: F.when(digests[s] < F.col(f"__limits.{s}"), F.struct(
        digests[s].alias("digest"), col(roles.key).alias("key"), col(x).alias("x"),
        col(y).alias("y"), col(roles.label).alias("label"))) for s, (x, y) in shown.items()}
    keyed = base.select(
        F.expr(f"if(__age is null, null, {age.bin('__age', '__limits.age_width')})").alias("age_bin"),
        F.expr(f"if(__rating is null, null, {rate.bin('__rating', '__limits.rating_width')})")
        .alias("rating_bin"),
        F.col("__limits.age_width").alias("age_width"),
        F.col("__limits.rating_width").alias("rating_width"),
        col(roles.category).alias("category"), col(roles.region).alias("region"),
        col(roles.group).alias("group"), *[c.alias(s) for s, c in sampled.items()],
        F.col("__score").alias("score"), _top(rows, roles).alias("top"))
    groups = grouped_together(
        keyed, {"age_histogram": ["age_bin"], "rating_histogram": ["rating_bin"],
                "category_shares": ["category"], "region_counts": ["region"],
                "top_groups": ["group"], **{s: [s] for s in _SAMPLES}},
        {"n": F.count(F.lit(1)), "mean": F.avg("score"), "lo": F.min("score"), "hi": F.max("score"),
         "top": F.min("top"), "age_width": F.any_value("age_width"),
         "rating_width": F.any_value("rating_width")})
    start = {"age_bin": age.start("age_bin", "age_width"),
             "rating_bin": rate.start("rating_bin", "rating_width")}
    return groups.withColumns({k.replace("_bin", "_start"): F.expr(s) for k, s in start.items()})


def views(facts: DataFrame, roles: Roles = Roles()) -> dict[str, DataFrame]:
    """The views of stored facts, with the columns that ``Dashboard.views`` gives them."""
    whole = facts.where(F.col(VIEW) == WHOLE)
    counts = view_of(facts, "category_shares", ["category"])
    total = counts.agg(F.sum("n")).scalar()
    out = {
        # One row also where there are no rows, which make no group.
        "summary": whole.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n"),
                             *[F.max(c).alias(c) for c in ("mean", "lo", "hi")]),
        "top_entity": whole.where("top is not null").select(
            F.col("top.key").alias(roles.key), F.col("top.label").alias(roles.label),
            F.col("top.value").alias(roles.value)),
        "category_shares": counts.select(
            F.col("category").alias("k"), "n", (F.col("n") / total).alias("share"))
        .orderBy(F.desc("n"), "k"),
        "region_counts": view_of(facts, "region_counts", ["region"]).select(
            F.col("region").alias(roles.region), F.col("n").alias("count"))
        .orderBy(F.desc("count"), col(roles.region)),
        "top_groups": view_of(facts, "top_groups", ["group"])
        .orderBy(F.desc_nulls_last("mean"), "group").limit(TOP_GROUPS)
        .select(F.col("group").alias(roles.group), "mean"),
    }
    for name in ("age", "rating"):
        out[f"{name}_histogram"] = (
            view_of(facts, f"{name}_histogram", [f"{name}_bin"])
            .select(F.col(f"{name}_bin").alias("bin"), F.col(f"{name}_start").alias("bin_start"), "n")
            .orderBy("bin"))
    for name, (x, y) in {"rating_value_sample": (roles.rating, roles.value),
                         "age_potential_sample": (roles.age, roles.potential)}.items():
        s = f"{name}."
        # Equal rows are one group; a group never gives more rows than the sample has.
        times = F.sequence(F.lit(1), F.least(F.col("n"), F.lit(SAMPLE_ROWS)).cast("int"))
        order = [F.col(s + "digest"), *[F.asc_nulls_last(s + c) for c in ("key", "x", "y", "label")]]
        out[name] = (view_of(facts, name, [name]).orderBy(*order).limit(SAMPLE_ROWS)
                     .withColumn("__time", F.explode(times)).orderBy(*order).limit(SAMPLE_ROWS)
                     # A column that plays two parts is there once.
                     .select(*[F.col(s + part).alias(c) for c, part in
                               {roles.label: "label", y: "y", x: "x"}.items()]))
    return out


#: The dimensions of the cube beside region and rating.
_DIMENSIONS = ("age", "category", "group")


def build_cube(table: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Partial aggregates by (region, rating) and, each for itself, age, category and group.

    ``top`` is held by the cells of (region, rating), which every filter is made of; it is null in the
    rows of the dimensions. All rows are counted in hash maps, one grouping at a time so that entries are
    short. The least of structs needs rows sorted in the tasks that read them, which spills, so it is
    taken of the few rows that can be a cell's top. Each scan reads the three to five columns it
    needs; only groups are shuffled.
    """
    df = nans_to_nulls(table.select(*[col(c) for c in roles.columns]))
    cells = ["region", "rating"]
    rows = df.select(col(roles.region).alias("region"), col(roles.rating).alias("rating"),
                     *[col(getattr(roles, d)).alias(d) for d in _DIMENSIONS],
                     _negative(df, roles).alias("negative"), _top(df, roles).alias("top"))
    n = F.count(F.lit(1)).alias("n")
    counts = rows.groupBy(*cells).agg(n)
    tops = (rows.where(F.col("negative") <= _weakest_top(rows, cells))
            .groupBy(*cells).agg(F.min("top").alias("top")))
    whole = (counts.unionByName(tops, allowMissingColumns=True).groupBy(*cells)
             .agg(F.sum("n").alias("n"), F.min("top").alias("top")))
    cube = whole.withColumn(VIEW, F.lit(WHOLE))
    for d in _DIMENSIONS:
        groups = rows.groupBy(*cells, d).agg(n).withColumn(VIEW, F.lit(d))
        cube = cube.unionByName(groups, allowMissingColumns=True)
    return cube.select(VIEW, *cells, *_DIMENSIONS, "n", "top")


def _weakest_top(rows: DataFrame, cells: list[str]) -> Column:
    """What ``negative`` is at most in the top row of the cell of a row.

    Cells are spread over a fixed number of buckets; a bucket's bound is that of its weakest cell. So it
    is one small array however many cells there are, and exact where a bucket holds one cell.
    """
    bucket = F.pmod(F.xxhash64(*cells), F.lit(_BUCKETS)).cast("int")
    bounds = (rows.groupBy(*cells).agg(F.min("negative").alias("best"))
              .groupBy(bucket.alias("bucket")).agg(F.max("best").alias("bound")))
    spread = (rows.sparkSession.range(_BUCKETS).select(F.col("id").cast("int").alias("bucket"))
              .join(bounds, "bucket", "left")
              .agg(F.array_sort(F.collect_list(F.struct("bucket", "bound"))).alias("bounds")))
    return F.get(spread.select(F.col("bounds.bound")).scalar(), bucket)


def cube_views(cube: DataFrame, roles: Roles = Roles(), rating: tuple[Any, Any] | None = None,
               region: str | None = None) -> dict[str, DataFrame]:
    """Summary, largest value, histograms, shares, regions and top groups of the filtered rows,
    from a stored cube alone. Samples and whole rows need the table."""
    kept = filter_rows(cube, {"rating": rating}, {"region": region})
    cells = kept.where(F.col(VIEW) == WHOLE)
    n, score = F.col("n"), F.col("rating").cast("double")
    known_n = F.sum(F.when(score.isNotNull(), n))
    mean = F.sum(score * n) / F.nullif(known_n, F.lit(0))
    counts = (view_of(kept, "category", ["category"]).groupBy(F.col("category").alias("k"))
              .agg(F.sum("n").alias("n")))
    top = cells.agg(F.min("top").alias("top")).where("top is not null")
    return {
        "summary": cells.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n"), mean.alias("mean"),
                             F.min(score).alias("lo"), F.max(score).alias("hi")),
        "top_entity": top.select(F.col("top.key").alias(roles.key), F.col("top.label").alias(roles.label),
                                 F.col("top.value").alias(roles.value)),
        "age_histogram": histogram(view_of(kept, "age", ["age"]), "age", HISTOGRAM_BINS, weight="n"),
        "rating_histogram": histogram(cells, "rating", HISTOGRAM_BINS, weight="n"),
        "category_shares": counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())
        .orderBy(F.desc("n"), "k"),
        "region_counts": cells.where("region is not null")
        .groupBy(F.col("region").alias(roles.region)).agg(F.sum("n").alias("count"))
        .orderBy(F.desc("count"), col(roles.region)),
        "top_groups": view_of(kept, "group", ["group"]).groupBy(F.col("group").alias(roles.group))
        .agg(mean.alias("mean")).orderBy(F.desc_nulls_last("mean"), col(roles.group)).limit(TOP_GROUPS),
    }
