import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from tallyroom.contracts import PLAYERS
from tallyroom.errors import ContractError
from tallyroom.plans.dashboard import Dashboard, Roles
from tallyroom.plans.publish import publish
from tallyroom.plans.stages import build_stages, cleaned_rows, folder_of, load_audit
from tallyroom.sinks.parquet import write_parquet
from tallyroom.sinks.tables import TableSink
from tallyroom.sources.delimited import read_delimited
from tallyroom.sources.parquet import read_parquet

CSV = '''id,Known As,Full Name,Age,Nationality,Overall,Potential,Club Name,Value(in Euro),\
Wage(in Euro),Positions Played,Preferred Foot
1,Al,"Al ""Ace"" B",20,Spain,70,80,Reds,1000,10,"GK,CB",Left
2,Bo,Bo C,30,France,60,60,Reds,2000,,ST,Right
3,Bo2,Bo C,31,France,,65,Blues,500,5,ST,Right
4,Cy,Cy D,25,,65,70,Blues,3000,5,ST,Right
5,Di,Di E,25,Spain,65,70,,3000,5,ST,Right
6,Ed,Ed F,25,Spain,65,70,Blues,,5,ST,Right
7,,Fi G,25,Spain,65,70,Blues,1,5,ST,Right
'''


@pytest.fixture
def source(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    return read_delimited(spark, str(tmp_path / "in.csv"))


def test_stages(spark, source, tmp_path):
    root = str(tmp_path / "out")
    assert build_stages(spark, source, PLAYERS, root) == {
        "cleaned": 3, "master_player_table": 3, "player_metadata": 3, "club_metadata": 2}
    master = read_parquet(spark, root + "/stage2/master_player_table")
    assert master.schema == PLAYERS.tables[0].schema
    assert rows_of(master.select("full_name", "short_name", "overall", "wage_eur")) == [
        ('Al "Ace" B', "Al", 70, 10.0), ("Bo C", "Bo", 60, None), ("Cy D", "Cy", 65, 5.0)]
    positions = read_parquet(spark, root + "/stage3/player_metadata")
    assert rows_of(positions.select("player_positions"))[0] == ("GK,CB",)
    assert rows_of(read_parquet(spark, root + "/stage3/club_metadata")) == [("Blues",), ("Reds",)]
    assert read_parquet(spark, root + "/stage1/cleaned_players").count() == 3


def test_one_shuffle_up_to_the_first_stage(spark, source, capsys):
    assert plan_of(cleaned_rows(source, PLAYERS), capsys).count("Exchange\n") == 1


def test_master_files_are_sorted_for_the_dashboard_filters(spark, source, tmp_path):
    root = str(tmp_path / "out")
    build_stages(spark, source, PLAYERS, root)
    master = read_parquet(spark, folder_of(root, PLAYERS.tables[0])).withColumn(
        "file", F.input_file_name())
    by_file = {}
    for row in master.collect():
        by_file.setdefault(row["file"], []).append((row["nationality"] or "", row["overall"] or 0))
    assert all(rows == sorted(rows) for rows in by_file.values())


def test_stages_that_may_be_served_are_not_overwritten(spark, source, tmp_path):
    root = str(tmp_path / "out")
    build_stages(spark, source, PLAYERS, root)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        build_stages(spark, source.where("id = 1"), PLAYERS, root)
    assert read_parquet(spark, folder_of(root, PLAYERS.tables[0])).count() == 3
    assert build_stages(spark, source.where("id = 1"), PLAYERS, root, replace=True)["cleaned"] == 1


def test_audit_accounts_for_every_row(spark, source):
    assert rows_of(load_audit(source, PLAYERS)) == [(7, 3, 1, 3)]
    assert rows_of(load_audit(source.where("id = 99"), PLAYERS)) == [(0, 0, 0, 0)]


def test_an_empty_source_gives_empty_tables(spark, source, tmp_path):
    rows = build_stages(spark, source.where("id = 99"), PLAYERS, str(tmp_path / "out"))
    assert set(rows.values()) == {0}


@pytest.mark.parametrize("copied", [True, False])
def test_publish(spark, source, tmp_path, copied):
    root = str(tmp_path / "out")
    build_stages(spark, source, PLAYERS, root)
    sink = TableSink(spark, str(tmp_path / "tables") if copied else None)
    assert publish(spark, PLAYERS, root, sink) == [t.name for t in PLAYERS.tables]
    assert spark.table("master_player_table").count() == 3
    assert (tmp_path / "tables").exists() == copied
    for table in PLAYERS.tables:
        spark.sql(f"DROP TABLE {table.name}")


class Recorder:
    def __init__(self):
        self.staged, self.commits = [], 0

    def stage(self, df, table, folder):
        self.staged.append(table.name)

    def commit(self):
        self.commits += 1


def test_one_bad_table_stops_the_whole_load(spark, source, tmp_path):
    root = str(tmp_path / "out")
    build_stages(spark, source, PLAYERS, root)
    clubs = PLAYERS.tables[2]
    write_parquet(spark.createDataFrame([("Reds",), ("Reds",)], "club_name string"),
                  folder_of(root, clubs))
    sink = Recorder()
    with pytest.raises(ContractError, match="club_metadata: unique key"):
        publish(spark, PLAYERS, root, sink)
    assert (sink.staged, sink.commits) == ([], 0)


def test_missing_stage_fails_or_is_skipped(spark, source, tmp_path):
    root = str(tmp_path / "out")
    master = PLAYERS.tables[0]
    write_parquet(cleaned_rows(source, PLAYERS).select(*master.names), folder_of(root, master))
    sink = Recorder()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publish(spark, PLAYERS, root, sink)
    assert sink.staged == []
    with pytest.warns(UserWarning, match="skipped"):
        assert publish(spark, PLAYERS, root, sink, "skip") == ["master_player_table"]


@pytest.fixture
def board(spark, players):
    rows = players(
        {"full_name": "a", "nationality": "Spain", "overall": 60, "value_eur": 5.0},
        {"full_name": "b", "nationality": "Spain", "overall": 80, "value_eur": 9.0,
         "preferred_foot": "Right", "club_name": "D"},
        {"full_name": "c", "nationality": None, "overall": 70, "value_eur": 7.0},
        {"full_name": "d", "nationality": "Atlantis", "overall": None, "value_eur": 99.0})
    countries = spark.createDataFrame([("Spain", "ESP")], "nationality string, code string")
    board = Dashboard(rows, Roles(), countries)
    yield board
    board.close()


def test_inputs(board):
    inputs = board.inputs()
    assert [tuple(r) for r in inputs["region_options"].collect()] == [
        (0, "All"), (1, "Atlantis"), (1, "Spain")]
    assert rows_of(inputs["rating_bounds"]) == [(60, 80)]


def test_views(board):
    views = board.views(rating=(60, 80))
    assert rows_of(views["summary"]) == [(3, 70.0, 60, 80)]
    assert rows_of(views["labels"]) == [("3", "70.0", "€9")]
    assert views["top_entity"].first()["full_name"] == "b"
    assert views["top_entity"].first()["value_label"] == "€9"
    assert rows_of(views["category_shares"].select("k", "n")) == [("Left", 2), ("Right", 1)]
    assert rows_of(views["region_counts"]) == [("Spain", 2, "ESP")]
    assert rows_of(views["unplaced_regions"]) == []
    assert [tuple(r) for r in views["top_groups"].collect()] == [("D", 80.0), ("C", 65.0)]
    assert rows_of(views["rating_value_sample"]) == [(60, 5.0, "s"), (70, 7.0, "s"), (80, 9.0, "s")]
    assert views["age_potential_sample"].columns == ["age", "potential", "short_name"]
    assert sum(r["n"] for r in views["rating_histogram"].collect()) == 3
    assert rows_of(views["age_histogram"]) == [(20, 20, 3)]
    assert views["rows"].count() == 3


def test_full_range_is_not_the_same_as_no_filter(board):
    assert board.views()["summary"].first()["n"] == 4
    assert rows_of(board.views()["unplaced_regions"]) == [("Atlantis", 1)]


def test_region_filter_and_empty_result(board):
    assert board.views(region="Spain")["summary"].first()["n"] == 2
    for name, view in board.views(rating=(1, 2)).items():
        assert view.count() == (1 if name in ("summary", "labels") else 0), name


def test_pages(board):
    page = board.rows_page(2)
    assert [r["full_name"] for r in page.collect()] == ["a", "b"]
    page = board.rows_page(2, after=("b",), filters={"rating": (60, 80)})
    assert [r["full_name"] for r in page.collect()] == ["c"]


def test_the_table_is_kept_and_released(spark, players):
    rows = players({"full_name": "kept"})
    board = Dashboard(rows)
    assert board.rows.is_cached
    board.close()
    assert not board.rows.is_cached
    assert not Dashboard(rows, keep=None).rows.is_cached


def test_filters_reach_the_scan_of_a_table_that_is_not_kept(spark, players, tmp_path, capsys):
    rows = players({"full_name": "a", "overall": 60}, {"full_name": "b", "overall": 80}).withColumn(
        "overall", F.col("overall").cast("double"))
    write_parquet(rows, str(tmp_path / "t"))
    board = Dashboard(read_parquet(spark, str(tmp_path / "t")), keep=None)
    plan = plan_of(board.views(rating=(70, 90))["summary"], capsys)
    assert "GreaterThanOrEqual(overall,70.0)" in plan
    assert board.views(rating=(70, 90))["summary"].first()["n"] == 1


def test_rows_pages_and_the_top_row_hold_every_column(board):
    views = board.views()
    assert views["rows"].columns == board.table.columns == board.rows_page(2).columns
    assert views["top_entity"].columns == [*board.table.columns, "value_label"]


def test_audit_counts_malformed_rows_by_file_and_keeps_them(spark, tmp_path, capsys):
    from tallyroom.jobs import transform

    head, *body = CSV.splitlines()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([head, *body]) + "\n")
    short, long = "8,Gi,Gi G,25,Spain,65", "9,Hy,Hy G,25,Spain,65,70,Blues,9,5,ST,Right,lost"
    again = "10,Bo,Bo C,30,France,61,60,Reds,2000,,ST,Right"
    (tmp_path / "in" / "b.csv").write_text("\n".join([head, short, long, again]) + "\n")
    out = str(tmp_path / "out")
    transform.main(["--input", str(tmp_path / "in"), "--output", out])
    assert "malformed: 2 rows" in capsys.readouterr().out
    names = F.substring_index("source", "/", -1)
    audit = spark.read.parquet(out + "/audit/load").withColumn("source", names)
    # Bo C's best row stands in b.csv.
    assert rows_of(audit) == [("a.csv", 7, 0, 3, 2, 2), ("b.csv", 3, 2, 1, 0, 2)]
    lost = spark.read.parquet(out + "/audit/malformed").withColumn("source", names)
    assert rows_of(lost) == [("b.csv", short), ("b.csv", long)]
