import os
import subprocess
import sys
import zipfile

import pyspark
import pytest

from conftest import ROOT
from test_plans import CSV
from tallyroom.contracts import PLAYERS
from tallyroom.jobs import dashboard, extract, load, transform
from tallyroom.session import (MAX_TASKS, get_session, input_bytes, scratch_dir, size_tasks,
                               sized_tasks)
from tallyroom.sinks.versions import VersionedSink


def test_the_jobs_run_from_archive_to_views(spark, tmp_path, capsys):
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as archive:
        archive.writestr("players.csv", CSV)
    raw, stages, tables, views = (str(tmp_path / n) for n in ("raw", "stages", "tables", "views"))
    extract.main(["--input", str(tmp_path / "in.zip"), "--output", raw])
    transform.main(["--input", raw + "/players.csv", "--output", stages])
    load.main(["--input", stages, "--tables-root", tables])
    dashboard.main(["--input", stages + "/stage2/master_player_table", "--output", views,
                    "--rating", "60", "70"])
    out = capsys.readouterr().out
    assert "1 members written" in out and "master_player_table: 3 rows" in out
    assert "published club_metadata" in out
    assert spark.table("master_player_table").count() == 3
    assert spark.read.parquet(views + "/summary").first()["n"] == 3
    assert spark.read.parquet(views + "/region_options").count() == 3
    for name in ("master_player_table", "player_metadata", "club_metadata"):
        spark.sql(f"DROP TABLE {name}")


def test_load_to_a_database_hands_over_its_options(spark, tmp_path, monkeypatch):
    seen = {}

    class Sink:
        def __init__(self, url, properties, run_statements, **options):
            seen.update(url=url, properties=properties, run=run_statements, options=options)

    monkeypatch.setattr(load, "JdbcSink", Sink)
    monkeypatch.setattr(load, "publish", lambda *a: ["t"])
    monkeypatch.setenv("JDBC_USER", "u")
    monkeypatch.setenv("JDBC_PASSWORD", "p")
    arguments = ["--input", str(tmp_path), "--jdbc-url", "jdbc:x", "--connections", "3"]
    load.main(arguments)
    assert seen == {"url": "jdbc:x", "properties": {"user": "u", "password": "p"}, "run": None,
                    "options": {"num_partitions": 3}}
    load.main([*arguments, "--client", "json", "--jdbc-driver", "d"])
    assert callable(seen["run"]) and seen["properties"]["driver"] == "d"


def test_load_in_place(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text(CSV)
    stages = str(tmp_path / "stages")
    transform.main(["--input", str(tmp_path / "in.csv"), "--output", stages])
    load.main(["--input", stages, "--in-place"])
    assert spark.table("player_metadata").count() == 3
    for name in ("master_player_table", "player_metadata", "club_metadata"):
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("job", [extract, transform, load, dashboard])
def test_missing_arguments_stop_the_job(job, capsys):
    with pytest.raises(SystemExit) as stop:
        job.main([])
    assert stop.value.code == 2 and "--input" in capsys.readouterr().err


def test_the_running_session_is_reused(spark):
    assert get_session("other") is spark


def test_shuffles_are_sized_from_the_input(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("x" * 1000)
    (tmp_path / "d" / "b.csv").write_text("x" * 500)
    assert input_bytes(spark, str(tmp_path / "d")) == 1500
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    try:
        assert size_tasks(spark, 100 << 40) == MAX_TASKS == int(spark.conf.get(start))
        assert int(spark.conf.get(split)) == (100 << 40) // MAX_TASKS
        assert size_tasks(spark, 64 << 30) == 1024
        assert int(spark.conf.get(split)) == 128 << 20
        assert size_tasks(spark, 1) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset(start)
        spark.conf.set(split, before)


def test_a_reused_session_has_its_settings_back(spark):
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split), spark.conf.get(start, None)
    with pytest.raises(ZeroDivisionError), sized_tasks(spark, 100 << 40) as tasks:
        assert tasks == MAX_TASKS == int(spark.conf.get(start))
        raise ZeroDivisionError
    assert (spark.conf.get(split), spark.conf.get(start, None)) == before


def test_scratch_folders_go_with_the_driver(tmp_path):
    script = ("from pyspark.sql import SparkSession\nfrom tallyroom.session import scratch_dir\n"
              "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config("
              f"'spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
              "p = scratch_dir(s, 'x')\ns.range(3).write.parquet(p)\nassert s.read.parquet(p).count() == 3")
    subprocess.run([sys.executable, "-c", script], check=True, cwd=ROOT, capture_output=True)
    assert list((tmp_path / "tallyroom").iterdir()) == []


def test_scratch_folders_are_under_the_shared_folder_and_new(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b
    if base:
        assert a.startswith(base.rstrip("/") + "/")


def test_a_job_runs_as_a_program_and_from_a_zip(tmp_path):
    """As on a cluster: the package comes from the shipped zip, not from a folder."""
    (tmp_path / "in.csv").write_text(CSV)
    shipped = tmp_path / "tallyroom.zip"
    with zipfile.ZipFile(shipped, "w") as package:
        for folder, _, names in os.walk(os.path.join(ROOT, "tallyroom")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    package.write(path, os.path.relpath(path, ROOT))
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    done = subprocess.run(
        [submit, "--master", "local[2]", "--conf", "spark.ui.enabled=false",
         "--py-files", str(shipped), os.path.join(ROOT, "tallyroom", "jobs", "transform.py"),
         "--input", str(tmp_path / "in.csv"), "--output", str(tmp_path / "out")],
        cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "club_metadata: 2 rows" in done.stdout
    assert (tmp_path / "out" / "stage2" / "master_player_table" / "_SUCCESS").exists()


def test_extract_fails_on_unsafe_members_unless_told_to_skip_them(spark, tmp_path, capsys):
    from tallyroom.errors import ContractError
    from tallyroom.sources.archive import read_manifest

    with zipfile.ZipFile(tmp_path / "in.zip", "w") as archive:
        archive.writestr("a.csv", "h\n1\n")
        archive.writestr("../b.csv", "h\n2\n")
    arguments = ["--input", str(tmp_path / "in.zip"), "--output", str(tmp_path / "out")]
    with pytest.raises(ContractError, match="1 members"):
        extract.main(arguments)
    assert "unsafe name: ../b.csv" in capsys.readouterr().out
    said = {r["member"]: (r["status"], r["target"] is None)
            for r in read_manifest(spark, str(tmp_path / "out")).collect()}
    assert said == {"a.csv": ("written", False), "../b.csv": ("unsafe", True)}
    extract.main([*arguments, "--skip-unsafe"])
    assert (tmp_path / "out" / "a.csv").exists() and not (tmp_path / "b.csv").exists()


def test_load_as_views_over_versions(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text(CSV)
    stages, journal = str(tmp_path / "stages"), str(tmp_path / "journal")
    transform.main(["--input", str(tmp_path / "in.csv"), "--output", stages])
    for _ in range(2):
        load.main(["--input", stages, "--tables-root", str(tmp_path / "tables"), "--journal", journal])
    assert spark.catalog.getTable("player_metadata").tableType == "VIEW"
    assert spark.table("player_metadata").count() == 3
    with pytest.raises(SystemExit):
        load.main(["--input", stages, "--jdbc-url", "jdbc:x", "--journal", journal])
    sink = VersionedSink(spark, journal)
    for t in PLAYERS.tables:
        sink.remove(t)
    assert not spark.catalog.tableExists("player_metadata")
