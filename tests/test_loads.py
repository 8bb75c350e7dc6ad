"""Quarantine, one parse of the source, and clustered files."""

import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from tallyroom.contracts import PLAYERS, Column, Table
from tallyroom.errors import MissingColumnsError
from tallyroom.operators.layout import bucket_edges, bucket_of, clustered, interleaved
from tallyroom.plans.quarantine import quarantine, with_reasons
from tallyroom.plans.stages import build_audited_stages
from tallyroom.sources.delimited import read_with_records

ITEMS = Table("items", "", (Column("id", "bigint"), Column("line", "int"), Column("name", "string", 5),
                            Column("price", "double")), ("id", "line"))


def test_every_row_is_good_or_rejected_with_all_reasons(spark, tmp_path):
    rows = [("1", "1", "a", "1.5", "x"), ("1", "2", "a", None, "x"), ("2", "1", "toolong", "free", "x"),
            (None, "1", "a", "1", "x"), (None, "1", "a", "1", "x"), ("3", "one", "a", "1", "x"),
            ("4", "1", "a", "1", "x"), ("4", "1", "b", "2", "x"), ("4", "1", "b", "2", "x")]
    df = spark.createDataFrame(rows, "id string, line string, name string, price string, other string")
    found = quarantine(df, ITEMS, str(tmp_path / "q"))
    assert (found.n_read, found.n_good, found.n_rejected) == (9, 2, 7)
    assert found.good.schema == ITEMS.schema
    assert rows_of(found.good) == [(1, 1, "a", 1.5), (1, 2, "a", None)]
    assert rows_of(found.rejected.select("id", "line", F.concat_ws("|", "reasons"))) == sorted([
        (2, 1, "name is longer than 5|price is no double: free"), (None, 1, "id is null"),
        (None, 1, "id is null"), (3, None, "line is no int: one|line is null"),
        *[(4, 1, "key is repeated")] * 3], key=str)
    with pytest.raises(MissingColumnsError):
        with_reasons(df.drop("price"), ITEMS)


def test_quarantine_of_no_and_of_hot_rows(spark, tmp_path):
    df = spark.createDataFrame([], ITEMS.schema)
    none = quarantine(df, ITEMS, str(tmp_path / "none"))
    assert (none.n_read, none.good.count(), none.rejected.count()) == (0, 0, 0)
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") + 100)
        .cast("bigint").alias("id"), F.lit(1).alias("line"), F.lit("n").alias("name"), F.lit(1.0).alias("price"))
    found = quarantine(hot.repartition(6), ITEMS, str(tmp_path / "hot"))
    assert (found.n_good, found.n_rejected) == (10_000, 20_000)


def test_keys_are_shuffled_once_when_few_are_repeated(spark, tmp_path, capsys):
    spark.range(1000).select((F.col("id") % 995).alias("id"), F.lit(1).alias("line"), F.lit("n").alias("name"),
                             F.lit(1.0).alias("price")).write.parquet(str(tmp_path / "t"))
    df = with_reasons(spark.read.parquet(str(tmp_path / "t")), ITEMS)
    df.collect()
    final = plan_of(df, capsys).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and len(re.findall(r"^\(\d+\) Exchange$", final, re.M)) <= 1


def test_the_source_is_parsed_once(spark, tmp_path, capsys):
    from test_plans import CSV

    (tmp_path / "in.csv").write_text(CSV + "8,Gi,Gi G,25,Spain,65\n")
    counts = build_audited_stages(read_with_records(spark, str(tmp_path / "in.csv")), PLAYERS,
                                  str(tmp_path / "out"))
    assert counts == {"cleaned": 3, "master_player_table": 3, "player_metadata": 3, "club_metadata": 2,
                      "malformed": 1}
    # What the later steps read is the stored parse, not the file.
    parsed = spark.read.parquet(str(tmp_path / "out/audit/parsed"))
    assert parsed.count() == 8
    (tmp_path / "in.csv").unlink()
    assert spark.read.parquet(str(tmp_path / "out/audit/load")).count() == 1
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        (tmp_path / "in.csv").write_text(CSV)
        build_audited_stages(read_with_records(spark, str(tmp_path / "in.csv")), PLAYERS,
                             str(tmp_path / "out"))


def test_bits_are_interleaved(spark):
    got = spark.createDataFrame([(0b1011, 0b0110)], "a int, b int").select(
        interleaved([F.col("a"), F.col("b")], 4).alias("z")).first().z
    assert got == 0b10011110
    with pytest.raises(ValueError):
        interleaved([F.col("a")] * 8, 8)


def files_to_read(path, low, high, flag):
    """Files whose least and largest values do not rule the filter out."""
    n = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        where = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        n += any(s["l_quantity"].max >= low and s["l_quantity"].min <= high
                 and s["l_returnflag"].min <= flag <= s["l_returnflag"].max
                 for s in ({c: g.column(i).statistics for c, i in where.items()} for g in groups))
    return n


def test_clustered_files_are_skipped_by_filters_on_either_column(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    clustered(rows, ["l_returnflag", "l_quantity"], 16).write.parquet(str(tmp_path / "z"))
    rows.repartition(16).write.parquet(str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "z")).exceptAll(rows).count() == 0
    assert files_to_read(tmp_path / "plain", 10, 20, "R") == 16
    assert files_to_read(tmp_path / "z", 10, 20, "R") <= 6
    assert files_to_read(tmp_path / "z", 10, 20, "A") + files_to_read(tmp_path / "z", 45, 50, "N") <= 9


def test_a_common_box_is_cut_and_unknown_values_have_a_place(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 > 0, F.lit("same")).alias("region"),
                                  F.lit(float("nan")).alias("rating"))
    sizes = [r.n for r in clustered(df, ["region", "rating"], 6).groupBy(F.spark_partition_id())
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 6 and max(sizes) < 3000
    edges = bucket_edges(df, ["region", "rating"])
    assert edges["region"] == ["same"]
    assert {r[0] for r in df.select(bucket_of(df, "region", edges["region"])).collect()} == {0}
    assert clustered(df.where("false"), ["region", "rating"], 4).count() == 0


def test_changed_stages_are_not_published(spark, tmp_path):
    from tallyroom.errors import ContractError
    from tallyroom.operators.quality import fingerprint
    from tallyroom.plans.publish import publish
    from tallyroom.plans.stages import build_stages, folder_of, manifest
    from tallyroom.sources.delimited import read_delimited
    from test_plans import CSV

    (tmp_path / "in.csv").write_text(CSV)
    root = str(tmp_path / "out")
    build_stages(spark, read_delimited(spark, str(tmp_path / "in.csv")), PLAYERS, root)
    known = manifest(spark, root)
    assert {n: proven for n, (_, proven) in known.items()} == {
        "master_player_table": True, "player_metadata": True, "club_metadata": True}
    master = PLAYERS.tables[0]
    folder = folder_of(root, master)
    rows = spark.read.parquet(folder)
    assert fingerprint(rows.repartition(5)) == known[master.name][0]
    (some,) = glob.glob(f"{folder}/*.parquet")[:1]

    class Nothing:
        def stage(self, *_):
            raise AssertionError("staged")

    # A file that is there twice, rows and all.
    with open(some, "rb") as file, open(f"{folder}/again.parquet", "wb") as copy:
        copy.write(file.read())
    with pytest.raises(ContractError, match="not those that were written"):
        publish(spark, PLAYERS, root, Nothing())


def test_pages_by_number(spark, tmp_path):
    from tallyroom.operators.paging import RANGE, store_pages

    rows = [(i % 7 if i % 11 else None, f"k{i % 50}", i % 3) for i in range(500)] + [(3, "same", 1)] * 60
    df = spark.createDataFrame(rows, "a int, k string, b int").repartition(5)
    pages = store_pages(df, ["a", "k"], str(tmp_path / "pages"), 9)
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    for size in (1, 37, 560, 1000):
        for number in {0, 1, 560 // size // 2, 559 // size, 560 // size + 1}:
            got = [tuple(r) for r in pages.page(number, size).collect()]
            assert got == want[number * size:(number + 1) * size]
    assert pages.rows.columns == ["a", "k", "b", RANGE]
    none = store_pages(df.where("false"), ["a"], str(tmp_path / "none"), 4)
    assert none.page(0, 10).count() == 0 and none.directory.count() == 0


def test_a_page_reads_its_range_only(spark, tmp_path, capsys):
    from tallyroom.operators.paging import store_pages

    pages = store_pages(spark.range(10_000), ["id"], str(tmp_path / "pages"), 10)
    plan = plan_of(pages.page(70, 50), capsys)
    assert "TakeOrderedAndProject" in plan or "GlobalLimit" in plan
    assert re.search(r"PartitionFilters: .*__range.* = \d+\)|PartitionFilters: .*__range.* IN \(", plan)
