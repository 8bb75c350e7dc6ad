import os
import warnings
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_of, rows_of
from tallyroom.contracts import Column
from tallyroom.errors import ContractError
from tallyroom.sources.archive import (archive_lines, archive_members, dealt, extract_archives,
                                       placed)
from tallyroom.sources.delimited import read_delimited
from tallyroom.sources.jdbc import range_options, read_table
from tallyroom.sources.parquet import empty_frame, read_parquet

COLUMNS = [Column("Full Name", "string"), Column("Age", "int")]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_quotes_are_escaped_by_doubling(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Full Name,Age\n"Al ""Ace"" B, jr",20\n')
    assert rows_of(read_delimited(spark, path, COLUMNS)) == [('Al "Ace" B, jr', 20)]


def test_columns_are_matched_by_name_and_extras_ignored(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Age,Club,Full Name\n20,X,Al\n")
    assert rows_of(read_delimited(spark, path, COLUMNS)) == [("Al", 20)]


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "Full Name,Age\nAl,20\n")
    write(tmp_path / "in" / "b.csv", "Age,Full Name\n20,Al\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path / "in"), COLUMNS).collect()


def test_empty_field_is_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Full Name,Age\n,20\nAl,\n")
    assert rows_of(read_delimited(spark, path, COLUMNS)) == [("Al", None), (None, 20)]


def test_line_break_in_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Full Name,Age\n"x\ny",20\n')
    assert rows_of(read_delimited(spark, path, COLUMNS, multi_line=True)) == [("x\ny", 20)]
    assert read_delimited(spark, path, COLUMNS).count() == 2


def test_types_can_be_inferred(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b,c,d\n2147483648,1.5,2020-01-01,true\n")
    assert read_delimited(spark, path, infer=True).dtypes == [
        ("a", "bigint"), ("b", "double"), ("c", "date"), ("d", "boolean")]


def test_unused_columns_are_not_parsed(spark, tmp_path, capsys):
    path = write(tmp_path / "a.csv", "Age,Club,Full Name\n20,X,Al\n")
    plan = plan_of(read_delimited(spark, path, COLUMNS), capsys)
    assert "ReadSchema: struct<Age:string,Full Name:string>" in plan


def test_missing_folder(spark, tmp_path):
    path = str(tmp_path / "none")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(AnalysisException):
        read_parquet(spark, path)
    with pytest.warns(UserWarning, match="skipped"):
        assert read_parquet(spark, path, on_missing="skip") is None
    empty = read_parquet(spark, path, schema, on_missing="empty")
    assert empty.schema == schema and empty.count() == 0
    with pytest.raises(ValueError):
        read_parquet(spark, path, on_missing="empty")
    with pytest.raises(ValueError):
        read_parquet(spark, path, on_missing="whatever")


def test_other_read_errors_are_not_swallowed(spark, tmp_path):
    (tmp_path / "x").mkdir()
    with warnings.catch_warnings(), pytest.raises(AnalysisException):
        warnings.simplefilter("error")
        read_parquet(spark, str(tmp_path / "x"), on_missing="skip")


def test_empty_frame_keeps_the_schema(spark):
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert empty_frame(spark, schema).schema == schema


def make_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return str(path)


def test_lines_of_all_members(spark, tmp_path):
    make_zip(tmp_path / "z" / "one.zip", {"a.csv": "h\n1\n2\n", "sub/b.csv": "h\r\n3"})
    make_zip(tmp_path / "z" / "two.zip", {"a.csv": "h\n4\n"})
    make_zip(tmp_path / "z" / "empty.zip", {})
    lines = archive_lines(spark, str(tmp_path / "z"))
    got = sorted((os.path.basename(r["archive"]), r["member"], r["line_no"], r["line"])
                 for r in lines.collect())
    assert got == [("one.zip", "a.csv", 1, "h"), ("one.zip", "a.csv", 2, "1"),
                   ("one.zip", "a.csv", 3, "2"), ("one.zip", "sub/b.csv", 1, "h"),
                   ("one.zip", "sub/b.csv", 2, "3"), ("two.zip", "a.csv", 1, "h"),
                   ("two.zip", "a.csv", 2, "4")]


def test_large_member_is_streamed_in_order(spark, tmp_path):
    text = "".join(f"line {i:07d} é\n" for i in range(200_000))
    path = make_zip(tmp_path / "big.zip", {"big.txt": text})
    lines = archive_lines(spark, path)
    assert lines.count() == 200_000
    assert lines.where("line <> concat('line ', lpad(line_no - 1, 7, '0'), ' é')").count() == 0


@pytest.mark.parametrize("name", ["../x", "a/../../x", "/etc/x", "..\\x", "C:/x"])
def test_names_that_leave_the_folder_are_listed_not_written(spark, tmp_path, name):
    path = make_zip(tmp_path / "in" / "a.zip", {name: "bad", "good.csv": "ok"})
    safe = {r["member"]: r["safe"] for r in archive_members(spark, path).collect()}
    assert safe.pop("good.csv") is True and list(safe.values()) == [False]
    extract_archives(spark, path, str(tmp_path / "out"))
    assert (tmp_path / "out" / "good.csv").read_text() == "ok"
    assert not (tmp_path / "x").exists()
    assert archive_lines(spark, path).count() == 1


def test_extract_writes_members_and_lists_them(spark, tmp_path):
    path = make_zip(tmp_path / "a.zip", {"a.csv": "Full Name,Age\nAl,20\n", "sub/b.txt": "b"})
    files = extract_archives(spark, path, str(tmp_path / "out"))
    assert sorted((r["member"], r["bytes"]) for r in files.collect()) == [
        ("a.csv", 20), ("sub/b.txt", 1)]
    assert (tmp_path / "out" / "sub" / "b.txt").read_text() == "b"
    left = [f for _, _, names in os.walk(tmp_path / "out") for f in names if f.startswith(".a")]
    assert left == []
    assert rows_of(read_delimited(spark, str(tmp_path / "out" / "a.csv"), COLUMNS)) == [("Al", 20)]


def test_two_members_for_one_target_are_an_error(spark, tmp_path):
    for name in ("one", "two"):
        make_zip(tmp_path / "z" / f"{name}.zip", {"a.csv": name})
    with pytest.raises(ContractError, match="a.csv"):
        extract_archives(spark, str(tmp_path / "z"), str(tmp_path / "out"))
    extract_archives(spark, str(tmp_path / "z"), str(tmp_path / "out"), folder_per_archive=True)
    assert (tmp_path / "out" / "two" / "a.csv").read_text() == "two"


def test_members_get_tasks_of_their_own(spark, tmp_path):
    path = make_zip(tmp_path / "a.zip", {f"{i}.txt": str(i) for i in range(20)})
    assert archive_lines(spark, path, parallelism=6).rdd.getNumPartitions() == 6


def test_jdbc_ranges_are_all_or_none():
    assert range_options(None, None, None, None) == {}
    assert range_options("id", 0, 100, 4) == {"partitionColumn": "id", "lowerBound": "0",
                                              "upperBound": "100", "numPartitions": "4"}
    with pytest.raises(ValueError, match="upperBound, numPartitions"):
        range_options("id", 0, None, None)


def test_jdbc_split_is_by_ranges_or_predicates(spark):
    with pytest.raises(ValueError, match="not both"):
        read_table(spark, "jdbc:x", "t", {}, "id", 0, 9, 2, predicates=["id > 0"])


@pytest.mark.parametrize("members", [5, 6, 40])
def test_members_are_dealt_one_by_one(spark, members):
    rows = [(f"z{i % 3}", f"m{i}", i) for i in range(members)]
    listed = spark.createDataFrame(rows, "archive string, member string, bytes bigint").repartition(3)
    per_task = [r["count"] for r in dealt(listed, 6).groupBy(
        F.spark_partition_id().alias("task")).count().collect()]
    assert sum(per_task) == members and len(per_task) == min(members, 6)
    assert max(per_task) - min(per_task) <= 1


def test_members_of_skewed_sizes_are_packed_by_bytes(spark):
    """10,000 members: no task holds twice the mean, or it holds one member."""
    rows = [(f"z{i % 7}", f"m{i}", 5000 + (10**9 // (i + 1) if i % 3 == 0 else 0)) for i in range(10_000)]
    listed = spark.createDataFrame(rows, "archive string, member string, bytes bigint").repartition(5)
    packed = dealt(listed, 16)
    tasks = packed.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()
    mean = sum(r[2] for r in rows) / 16
    assert sum(t["n"] for t in tasks) == 10_000 and packed.distinct().count() == 10_000
    assert max(t["n"] for t in tasks) > 1 and any(t["n"] == 1 for t in tasks)
    assert all(t["bytes"] < 2 * mean or t["n"] == 1 for t in tasks)
    assert dealt(listed.limit(0), 4).count() == 0
    empty = listed.withColumn("bytes", F.lit(0).cast("bigint"))
    counts = [r["count"] for r in dealt(empty, 16).groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == 16 and max(counts) <= 626


def test_paths_without_a_scheme_are_on_the_default_filesystem(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert placed(spark, "/out") == "/out" and placed(spark, "out") == "out"
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://names:8020/")
    try:
        assert placed(spark, "/out/x") == "hdfs://names:8020/out/x"
        assert placed(spark, "file:/out") == "file:/out"
        assert placed(spark, "s3a://bucket/out") == "s3a://bucket/out"
        with pytest.raises(ContractError):
            placed(spark, "out")
    finally:
        conf.set("fs.defaultFS", before)
