"""Plans that must hold at a thousand times the data, for the whole catalogue.

A key, source or group may hold a third of all rows. So whatever is shuffled by a
key or sent to one task must have been reduced in the task that read it.
"""

import random
import re

import pytest

from tallyroom.catalog import QUERIES, rows, views
from tallyroom.operators.dedupe import keep_best
from tallyroom.operators.distributions import category_counts, histogram, shares
from tallyroom.operators.quality import key_violations
from tallyroom.operators.topk import sample_rows, top_groups

# Queries of the other modules return what they read back; their flows are the
# operators of these.
LAZY = sorted(name for name, query in QUERIES.items()
              if query.__module__ in (rows.__name__, views.__name__))
REDUCED = ("Aggregate(", "WindowGroupLimit", "LocalLimit", "TakeOrdered")


def tree(df, capsys):
    capsys.readouterr()
    df.explain()
    lines = capsys.readouterr().out.splitlines()
    # Depth and text of each operator; subquery expressions hang off with a colon.
    return [(len(re.match(r"[\s:+\-*()\d]*", line).group()), line) for line in lines if line.strip()]


def inputs_of_exchanges(nodes, kind):
    for i, (_, line) in enumerate(nodes):
        if f"Exchange {kind}" in line:
            below = next(text for _, text in nodes[i + 1:]
                         if "Subquery" not in text and "Project" not in text
                         and "AdaptiveSparkPlan" not in text)
            yield line, below


@pytest.mark.parametrize("name", LAZY)
def test_only_reduced_rows_are_shuffled_by_key_or_to_one_task(spark, sf_dir, capsys, name):
    nodes = tree(QUERIES[name](spark, sf_dir), capsys)
    for kind in ("hashpartitioning", "SinglePartition"):
        for exchange, below in inputs_of_exchanges(nodes, kind):
            assert any(r in below for r in REDUCED), (exchange, below)


@pytest.mark.parametrize("name", LAZY)
def test_no_product_join_no_python_no_global_window(spark, sf_dir, capsys, name):
    text = "\n".join(line for _, line in tree(QUERIES[name](spark, sf_dir), capsys))
    for word in ("CartesianProduct", "NestedLoop", "Python", "MapInArrow"):
        assert word not in text
    assert not re.search(r"windowspecdefinition\([^,]*(ASC|DESC)", text)


@pytest.mark.parametrize("name", LAZY)
def test_scans_read_no_column_that_is_not_used(spark, sf_dir, capsys, name):
    if name in ("filtered_rows", "filtered_rows_large"):
        pytest.skip("returns every column")
    for _, line in tree(QUERIES[name](spark, sf_dir), capsys):
        read = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        if read and "lineitem" in line:
            assert len(read.group(1).split(",")) < 11


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows under one key, in another order than the others."""
    rng = random.Random(11)
    rows = [("hot" if rng.random() < .5 else f"k{rng.randrange(3000)}", rng.randrange(100), i)
            for i in range(30_000)]
    return rows, spark.createDataFrame(rows, "k string, v int, id int").repartition(7)


def test_operators_on_a_hot_key(spark, skewed):
    rows, df = skewed
    groups = {}
    for k, v, i in rows:
        groups.setdefault(k, []).append((v, i))
    best = {(k, *min(g, key=lambda r: (-r[0], r[1]))) for k, g in groups.items()}
    assert {tuple(r) for r in keep_best(df, ["k"], ["v"]).collect()} == best
    counts = sorted(((k, len(g)) for k, g in groups.items()), key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in category_counts(df, "k").collect()] == counts
    assert [(r["k"], r["n"]) for r in shares(df, "k").collect()] == counts
    repeated = {(k, n) for k, n in counts if n > 1}
    assert {tuple(r) for r in key_violations(df, ["k"]).collect()} == repeated
    means = sorted(((k, sum(v for v, _ in g) / len(g)) for k, g in groups.items()),
                   key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in top_groups(df, "k", "v", 20).collect()] == means[:20]
    assert sum(r["n"] for r in histogram(df, "v").collect()) == len(rows)
    assert sample_rows(df, ["k"], ["id"], 1500).count() == 1500
