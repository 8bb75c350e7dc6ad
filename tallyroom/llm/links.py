"""Connected components of links, as joins and aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _local_stars(links: DataFrame) -> DataFrame:
    """The links of every task as stars: each node it met with the least node it reaches
    there. Paths inside a task are gone, and so are links that close a circle."""
    def run(batches):
        import pyarrow as pa

        root: dict[int, int] = {}

        def find(node: int) -> int:
            top = node
            while (up := root.setdefault(top, top)) != top:
                top = up
            while root[node] != top:
                root[node], node = top, root[node]
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        stars = [(node, find(node)) for node in list(root)]
        stars = [(a, b) for a, b in stars if a != b]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in stars], pa.int64()), pa.array([b for _, b in stars], pa.int64())],
            names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable over links (a, b), for every linked node.

    Each task first joins the links it holds. Then, round by round, a node takes the
    least label among its own and its neighbours', and the label of that label, so
    the number of rounds follows the logarithm of the longest path. Labels are combined in map
    tasks before they are sent, so a node with very many links gets one row per task.
    Every round is written to the shared folder: a lost executor repeats tasks of one
    round, not the rounds before it.
    """
    stars = written(_local_stars(links.where("a != b")), "stars", compact=True)
    both = written(stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "both-ways", compact=True)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("component"))
    while True:
        near = (both.join(labels, F.col("b") == F.col("node"))
                .groupBy("a").agg(F.min("component").alias("least")))
        stepped = (labels.join(near, F.col("node") == F.col("a"))
                   .select("node", F.col("component").alias("before"),
                           F.least("component", "least").alias("component")))
        jump = stepped.select(F.col("node").alias("component"), F.col("component").alias("next"))
        following = written(
            stepped.join(jump, "component")
            .select("node", F.least("component", "next").alias("component"),
                    (F.least("component", "next") < F.col("before")).alias("moved")),
            "labels", compact=True)
        labels = following.select("node", "component")
        if following.where("moved").isEmpty():
            return labels


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: only the components that links join are looked at."""
    of = labels.select("node", "component")
    for end in ("a", "b"):
        links = (links.join(of.select(F.col("node").alias(end), F.col("component").alias("to")),
                            end, "left")
                 .withColumn(end, F.coalesce("to", end)).drop("to"))
    joined = components(links).select(F.col("node").alias("component"),
                                      F.col("component").alias("least"))
    # A node that had no link until now is a component of its own.
    alone = joined.join(of.select(F.col("node").alias("component")), "component", "left_anti")
    return written(
        of.join(joined, "component", "left")
        .select("node", F.coalesce("least", "component").alias("component"))
        .unionByName(alone.select(F.col("component").alias("node"),
                                  F.col("least").alias("component"))), "labels", compact=True)
