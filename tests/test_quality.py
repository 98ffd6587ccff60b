"""Quality rules in one pass, the split by severity, and the journal of runs."""

import sys

import pytest
from pyspark.sql import functions as F

from shelfwise import __main__ as cli
from shelfwise.operators import quality as Q
from shelfwise.plans import jobs
from shelfwise.sinks import runlog as R

ROWS = [(1, "a", 5, 0.5), (1, "b", 7, None), (2, None, 5, 2.0), (None, "", None, 0.1), (None, "", None, 0.1)]
SCHEMA = "id long, name string, n int, x double"
RULES = [
    Q.Rule("id", unique=("id",)), Q.Rule("pair", unique=("name", "n")), Q.Rule("name", "trim(name) <> ''", "warning"), Q.Rule("x", "x BETWEEN 0 AND 1"),
    Q.Rule("few", "n > 5", "info").where("id = 1"),
    Q.all_of("both", [Q.Rule("a", "x <= 1"), Q.Rule("b", "n = 5").where("n IS NOT NULL")], "info"),
    Q.any_of("either", [Q.Rule("a", "x <= 1"), Q.Rule("b", "n = 5")], "info"),
]
EXPECTED = {"id": (3, 1), "pair": (2, 0), "name": (5, 3), "x": (5, 2), "few": (2, 1), "both": (5, 2), "either": (5, 1)}


def test_report_in_one_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"file:{tmp_path}/t")
    report = Q.quality_report(spark.read.parquet(f"file:{tmp_path}/t"), RULES)
    assert {r["rule"]: (r["checked"], r["broken"]) for r in report.collect()} == EXPECTED
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    empty = Q.quality_report(spark.createDataFrame([], SCHEMA), RULES).collect()
    assert len(empty) == len(RULES) and all(r["checked"] == r["broken"] == 0 for r in empty)
    assert Q.quality_report(spark.createDataFrame(ROWS, SCHEMA), []).count() == 0


def test_split_counts_what_it_writes(spark, tmp_path):
    path = f"file:{tmp_path}/checked"
    counts = Q.write_checked(spark.createDataFrame(ROWS, SCHEMA), RULES, path)
    assert counts == {"rows": 5, **{r.name: EXPECTED[r.name][1] for r in RULES if not r.unique}}
    stored = spark.read.parquet(path)
    assert stored.count() == 5
    assert {(r["id"], r["x"]) for r in stored.filter("quality = 'refused'").collect()} == {(1, None), (2, 2.0)}
    assert stored.filter("quality = 'kept' AND array_contains(broken, 'x')").count() == 0
    assert Q.flagged(spark.createDataFrame(ROWS, SCHEMA), []).filter(F.size("broken") > 0).count() == 0


def test_rules_from_rows():
    row = {"table": "t", "rule": "r", "condition": "n > 1", "severity": "", "guard": None, "unique": ""}
    assert Q.read_rules([row, {**row, "rule": "u", "condition": "", "unique": "a b"}]) == {"t": [Q.Rule("r", "n > 1"), Q.Rule("u", unique=("a", "b"))]}
    with pytest.raises(ValueError, match="two rules"):
        Q.read_rules([row, row])
    with pytest.raises(ValueError, match="severity"):
        Q.read_rules([{**row, "severity": "fatal"}])


def test_journal_of_runs(spark, tmp_path):
    folder = f"file:{tmp_path}/journal"
    assert R.runs(R.entries(spark, folder)).count() == 0 and R.unknown_entries(spark, folder) == 0
    with R.RunJournal(spark, folder, "music-build", "one", out="x") as journal:
        journal.step("tracks", 10)
        journal.step("files", 5)
        journal.quota_hit("features", 14_800)
    with pytest.raises(KeyError):
        with R.RunJournal(spark, folder, "music-build", "two"):
            raise KeyError("gone")
    R.RunJournal(spark, folder, "watch", "three").write("RUN_STARTED")
    twice = R.RunJournal(spark, folder, "music-build", "one")
    twice.seq = 1
    twice.step("tracks", 10)  # an entry written again counts once
    spark.createDataFrame([(99, "four", 0, "x", "NEW", None, None, {}, None)], R.ENTRY).write.mode("append").parquet(folder)
    rows = {r["run_id"]: r for r in R.runs(R.entries(spark, folder)).collect()}
    assert {k: (r["status"], r["steps"], r["rows"], r["quota_hits"]) for k, r in rows.items()} == {
        "one": ("DONE", 2, 15, 1), "two": ("FAILED", 0, None, 0), "three": ("RUNNING", 0, None, 0)}
    assert rows["two"]["error"].startswith("KeyError") and rows["one"]["started"] <= rows["one"]["ended"] and rows["three"]["ended"] is None
    assert R.unknown_entries(spark, folder) == 1
    assert {r["job"]: r["run_id"] for r in R.latest_runs(R.entries(spark, folder)).collect()} == {"music-build": "two", "watch": "three"}
    with pytest.raises(ValueError, match="no type"):
        journal.write("PARTY")


def test_commands_write_the_journal(spark, tmp_path, monkeypatch, capsys):
    places = spark.createDataFrame([("a", "x", 1.0, 2.0), ("a", "", 95.0, 2.0), ("b", "y", None, None)], "id string, name string, lat double, lon double")
    places.write.parquet(f"file:{tmp_path}/t/places")
    spark.createDataFrame([("l", "saved")], "id string, type string").write.parquet(f"file:{tmp_path}/t/lists")
    spark.createDataFrame([("l", "a"), ("l", "a")], "list_id string, place_id string").write.parquet(f"file:{tmp_path}/t/list_places")
    monkeypatch.setattr(cli, "drop_scratch", lambda spark: None)
    monkeypatch.setattr(sys, "argv", ["shelfwise", "quality", "--tables", f"file:{tmp_path}/t", "--rules", "places", "--journal", f"file:{tmp_path}/j"])
    cli.main()
    found = {(r["step"], r["rows"]) for r in R.entries(spark, f"file:{tmp_path}/j").filter("type = 'RULE_BROKEN'").collect()}
    assert found == {("places.id", 1), ("places.name", 1), ("places.point", 1), ("places.resolved", 1), ("list_places.link", 1)}
    monkeypatch.setattr(sys, "argv", ["shelfwise", "runs", "--journal", f"file:{tmp_path}/j"])
    cli.main()
    assert "DONE" in capsys.readouterr().out
    assert jobs.check_tables(spark, f"file:{tmp_path}/t", {}).count() == 0
