"""Analysis, coherence and split jobs from a library CSV and JSON caches."""

import json
import random
import sys

import pytest

from shelfwise import __main__ as cli
from shelfwise.plans import jobs
from shelfwise.sources.files import read_csv_strings


@pytest.fixture()
def inputs(tmp_path):
    rng = random.Random(1)
    rows = ["playlist,artist,track,album"]
    tags, primary, secondary = {}, {"_requests_used": 9}, {}
    for i in range(30):
        tags[f"artist {i}"] = {"artist": f"Artist {i}", "error": None, "tags": [{"name": n, "count": 100 - j} for j, n in enumerate(rng.sample(["rock", "jazz", "soul", "dub", "seen live", "80s"], 4))]}
    for n in range(400):
        artist, track = f"Artist {rng.randrange(30)}", f"Track {n}"
        rows.append(f"List {n % 3},{artist},{track},Album")
        key = f"{artist.lower()}||{track.lower()}"
        if n % 2:
            primary[key] = {"found": n % 4 == 1, "bpm": 100.5, "energy": rng.random(), "valence": 0.5, "duration_ms": 61000, "camelot": "8A", "mood": None}
        if n % 3:
            secondary[key] = {"found": True, "energy": rng.random(), "valence": 0.2, "tempo": 0.0}
    (tmp_path / "lib.csv").write_text("\n".join(rows))
    for name, content in (("tags", tags), ("primary", primary), ("secondary", secondary)):
        (tmp_path / f"{name}.json").write_text(json.dumps(content))
    return tmp_path


def test_library_jobs(spark, inputs):
    library = read_csv_strings(spark, str(inputs / "lib.csv"))
    tags, primary, secondary, countries = (jobs.load_cache(spark, n, str(inputs / f"{n}.json")) for n in ("tags", "primary", "secondary", "countries"))
    out = str(inputs / "out")
    covered = jobs.build_analysis(library, tags, primary, secondary, countries, out).first()
    assert covered["n_rows"] == 400 and covered["n_genres"] == 400
    analysed = {r["track"]: r for r in spark.read.parquet(f"{out}/analysis").collect()}
    found = {n for n in range(400) if n % 4 == 1 or n % 3}
    assert covered["n_features"] == len(found)
    assert (analysed["Track 1"]["tempo"], analysed["Track 1"]["camelot"], analysed["Track 1"]["duration"]) == (100, "8A", "1:01")
    assert (analysed["Track 2"]["tempo"], analysed["Track 2"]["camelot"], analysed["Track 2"]["duration"]) == (None, "", "")
    assert analysed["Track 0"]["mood"] == "" and analysed["Track 2"]["mood"] in ("melancholic", "aggressive")
    states = {r["stream"]: r["pct"] for r in jobs.harvest_coverage(library, tags, primary, countries).collect()}
    assert states == {"tags": 100, "features": 50, "country": 0}
    rows, names = jobs.tagged_library(library, tags, primary, secondary), jobs.playlist_names(library)
    plan = jobs.report_split(rows, names, out).collect()
    assert sum(r["tracks"] for r in plan) == 400 and {r["name"] for r in plan} == {"List 0", "List 1", "List 2"}
    assert jobs.report_coherence(rows, names, out).count() == 3


def test_command_line(spark, inputs, monkeypatch, capsys):
    monkeypatch.setattr(sys, "argv", ["shelfwise", "progress", "--library", str(inputs / "lib.csv"), "--tags", str(inputs / "tags.json")])
    cli.main()
    assert "stream" in capsys.readouterr().out


def test_pending_work_of_each_harvest(spark, tmp_path):
    """Library order, limits, misses again, caches with a key written twice, excluded folders."""
    library = spark.createDataFrame(
        [(i, "p", a, t) for i, (a, t) in enumerate([("A, B", "x"), ("A", "y"), ("C", "z"), ("A", "y")])],
        "ordinal bigint, playlist string, artist string, track string")
    artists = jobs.pending_keys(library, spark.createDataFrame([("b",)], "norm string"), "tags")
    assert [r["norm"] for r in artists.orderBy("ordinal", "pos").collect()] == ["a", "c"]
    path = str(tmp_path / "primary")
    columns = f"track_key string, {jobs.CACHES['primary'][1]}"
    for found in (False, True):
        rest = [None] * (len(jobs.CACHES["primary"][1].split(",")) - 1)
        spark.createDataFrame([("a||y", found, *rest), ("c||z", False, *rest)], columns).coalesce(1).write.mode("append").parquet(path)
    cache = jobs.load_cache(spark, "primary", path)
    assert cache.count() == 2
    assert [r["track_key"] for r in jobs.pending_keys(library, cache, "primary").collect()] == ["a, b||x"]
    again = {r["track_key"] for r in jobs.pending_keys(library, cache.withColumn("found", cache["track_key"] == "a||y"), "primary", retry=True).collect()}
    assert again == {"a, b||x", "c||z"}
    assert [r["sent_track"] for r in jobs.pending_batches(library, cache).collect()] == ["x"]
    scan = spark.createDataFrame([("/m/1.mp3", "", "t", 0), ("/m/radio/2.mp3", "", "t", 1), ("/m/3.mp3", "", "t", 2), ("/m/4.mp3", "a", "t", 3)],
                                 "path string, artist string, title string, ordinal bigint")
    done = spark.createDataFrame([("/m/3.mp3",)], "path string")
    assert {r["path"] for r in jobs.pending_files(scan, done).collect()} == {"/m/1.mp3"}
    assert {r["path"] for r in jobs.pending_files(scan, done, ("/m/1",)).collect()} == {"/m/radio/2.mp3"}


def test_rows_of_several_csv_files_keep_their_order(spark, tmp_path):
    for name, rows in (("b.csv", 3), ("a.csv", 400), ("c.csv", 50)):
        (tmp_path / name).write_text("v\n" + "".join(f"{name[0]}{i}\n" for i in range(rows)))
    read = read_csv_strings(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [r["v"] for r in read] == [f"{n}{i}" for n, k in (("a", 400), ("b", 3), ("c", 50)) for i in range(k)]
