"""File sources and sinks, and the music build from files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import jobs
from shelfwise.sinks import state
from shelfwise.sinks import tables as sinks
from shelfwise.sources import files


def test_history_report(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    play = lambda ts, ms, artist, album, track: {"ts": ts, "ms_played": ms, "master_metadata_album_artist_name": artist,
                                                  "master_metadata_album_album_name": album, "master_metadata_track_name": track}
    (tmp_path / "in" / "Streaming_History_Audio_1.json").write_text(json.dumps([
        play("2024-01-02T00:00:00Z", 30000, "A", "L", "x"), play("2024-01-01T00:00:00Z", 90000, "A", "L", "y"), play("2024-01-01T00:00:00Z", 29999, "A", "L", "z"),
    ]))
    (tmp_path / "in" / "deep" / "Streaming_History_Audio_2.json").write_text(json.dumps([
        play("2024-03-01T00:00:00Z", 60000, "A", None, "x"), play("2024-03-01T00:00:00Z", 60000, None, "L", "x"),
    ]))
    (tmp_path / "in" / "other.json").write_text("[1]")
    span = jobs.report_history(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert tuple(span.select("plays", F.col("first_ts").cast("string"), F.col("last_ts").cast("string")).first()) == (
        3, "2024-01-01 00:00:00", "2024-03-01 00:00:00"
    )
    albums = spark.read.option("header", True).csv(str(tmp_path / "out" / "albums_ranked")).collect()
    assert [(r["plays"], r["distinct_tracks"], r["first_played"]) for r in albums] == [("2", "2", "2024-01-01T00:00:00Z")]


SCAN = (
    "﻿path,filename,extension,size_bytes,mtime,artist,title,album,bitrate_kbps,tags_read\n"
    '/mnt/m/a.mp3,a.mp3,.mp3,10,1,Ann,"One, ""two""\nthree",L,320,yes\n'
    "/mnt/m/b.mp3,b.mp3,.mp3,99,1,ANN,One two three (Live),L,bad,yes\n"
    "/mnt/m/c.mp3,c.mp3,.mp3,10,1,,,,128,no\n"
    "/mnt/m/d.mp3,d.mp3,.mp3,10,1,Bob,New,,192.9,yes\n"
    "/mnt/m/e.mp3,e.mp3,.mp3,10,1,Bob,NEW!,,,yes\n"
    "/mnt/m/f.mp3,f.mp3,.mp3,10,1,Bob,12,,,yes\n"
)


def test_duplicate_report(spark, tmp_path):
    (tmp_path / "scan.csv").write_text(SCAN, encoding="utf-8")
    stats = jobs.report_duplicates(spark, str(tmp_path / "scan.csv"), str(tmp_path / "out")).first()
    assert tuple(stats) == (6, 2, 2, 4)
    lines = {r["value"] for r in spark.read.text(str(tmp_path / "out" / "quarantine_paths")).collect()}
    assert lines == {"M:\\b.mp3", "M:\\e.mp3"}


def test_music_build(spark, tmp_path):
    (tmp_path / "scan.csv").write_text(SCAN, encoding="utf-8")
    (tmp_path / "lib.csv").write_text(
        "playlist,artist,track,album\nP1,Ann,One two three,L\nP1,Ann,one  two three feat. X,L\nP2,Zed,Solo,\nP2,Ann,One Two Three,\nP2,,,\n"
    )
    (tmp_path / "prof.csv").write_text("playlist,theme,main_genres,main_artists,energy,valence\nP1,old,g,a,0.5,\nP1,new,g,a,0.6,\n")
    read = lambda n: files.read_csv_strings(spark, str(tmp_path / n))
    analysis = read("lib.csv").select(
        "artist", "track", "ordinal", F.lit("rock").alias("genres"), F.lit("").alias("country"), F.lit("").alias("mood"),
        F.lit("").alias("camelot"), F.lit("3:10").alias("duration"), F.lit("0.5").alias("energy"), F.lit("x").alias("valence"),
        *[F.lit(None).cast("string").alias(c) for c in ("danceability", "tempo", "acousticness", "instrumentalness")],
    )
    out = str(tmp_path / "db")
    total = jobs.build_music(spark, out, read("lib.csv"), read("scan.csv"), read("prof.csv"), analysis).first().asDict()
    # Tracks: Ann/One two three, Zed/Solo, Bob/New, Bob/12.
    assert total == {"tracks": 4, "on_library": 2, "on_local": 3, "on_both": 1, "library_only": 1, "local_only": 2, "playlists": 2,
                     "files": 6, "files_unattached": 1, "enriched": 2}
    tracks = {r["id"]: r for r in spark.read.parquet(f"{out}/tracks").collect()}
    assert tracks["P6-TRK-000001"]["title"] == "One two three" and tracks["P6-TRK-000003"]["origin"] == "local"
    assert {r["theme"] for r in spark.read.parquet(f"{out}/playlists").collect()} == {"new", None}
    assert spark.read.parquet(f"{out}/playlist_tracks").count() == 3
    rows = {r["path"]: r for r in spark.read.parquet(f"{out}/files").collect()}
    assert (rows["/mnt/m/d.mp3"]["bitrate_kbps"], rows["/mnt/m/b.mp3"]["bitrate_kbps"], rows["/mnt/m/a.mp3"]["id"]) == (192, None, "P6-FIL-000001")
    again = jobs.build_music(spark, out, scan=read("scan.csv")).first().asDict()
    assert (again["tracks"], again["on_library"], again["playlists"]) == (3, 0, 0)


def test_inventory_of_a_tree(spark, tmp_path):
    for name in ("x/01 - Ann - Song.MP3", "x/_a_trier/Bob - Old.mp3", "y/cover.jpg", "y/Solo.flac", "y/.gitkeep"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    tags = spark.createDataFrame([(str(tmp_path / "y" / "Solo.flac"), "", "Tagged", "1999")], "path string, artist string, title string, year string")
    found = files.read_inventory(spark, [str(tmp_path / "x"), str(tmp_path / "y"), str(tmp_path / "none")], tags)
    got = {r["filename"]: (r["extension"], r["size_bytes"], r["artist"], r["title"], r["year"], r["tags_read"]) for r in found.collect()}
    assert got == {"01 - Ann - Song.MP3": (".mp3", 5, "Ann", "Song", "", "no"), "Solo.flac": (".flac", 5, "", "Tagged", "1999", "yes")}
    kinds = {os.path.basename(r["path"]): r["kind"] for r in files.classify_files(spark, str(tmp_path)).collect()}
    assert kinds["cover.jpg"] == "other"


def test_json_cache(spark, tmp_path):
    cache = tmp_path / "cache.json"
    cache.write_text(json.dumps({"a||b": {"found": True, "bpm": 99.5}, "_requests_used": 7, "_areas": {"x": "FR"}}))
    rows = files.import_json_cache(spark, str(cache), "found boolean, bpm double", "track_key").collect()
    assert [tuple(r) for r in rows] == [("a||b", True, 99.5)]
    assert files.cache_counter(spark, str(cache), "_requests_used").first()[0] == 7
    assert files.read_table_or_empty(spark, str(tmp_path / "no"), "a int").count() == 0
    with pytest.raises(FileNotFoundError):
        jobs.music_totals(spark, str(tmp_path / "no"))


def test_publish_reads_and_replaces_one_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish(spark.range(3).toDF("n"), path)
    sinks.publish(spark.read.parquet(path).selectExpr("n + 10 AS n"), path)
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [10, 11, 12]
    assert os.listdir(tmp_path) == ["t"]


def test_tabs_are_contiguous_and_rewritable(spark, tmp_path):
    path = str(tmp_path / "tabs")
    rows = spark.range(25).select(F.col("id").alias("n"))
    for _ in range(2):
        sinks.write_tabs(rows, path, ["n"], cap=10)
    sizes = {r["tab"]: (r["lo"], r["c"]) for r in spark.read.parquet(path).groupBy("tab").agg(F.min("n").alias("lo"), F.count("*").alias("c")).collect()}
    assert sizes == {1: (0, 10), 2: (10, 10), 3: (20, 5)}


REGISTRY = "key string, id string"


def test_state_survives_a_stop_at_every_step(spark, tmp_path):
    """Between any two steps of a publish the registry is the old version or the new one."""
    path = str(tmp_path / "state")

    def frame(*keys):
        return spark.createDataFrame([(k, f"P-{i}") for i, k in enumerate(keys)], REGISTRY)

    def keys(name="places"):
        return {r["key"] for r in state.read_state(spark, path, name, REGISTRY).collect()}

    assert keys() == set()
    state.publish_state({"places": frame("a"), "lists": frame("l")}, path)
    assert keys() == {"a"} and keys("lists") == {"l"}
    version = state.write_version({"places": frame("a", "b"), "lists": frame("l", "m")}, path)
    assert keys() == {"a"} and keys("lists") == {"l"}
    state.write_version({"places": frame("z")}, path)
    state.point_to(spark, path, version)
    assert keys() == {"a", "b"} and keys("lists") == {"l", "m"}
    state.publish_state({"places": state.read_state(spark, path, "places", REGISTRY).union(frame("c")), "lists": frame("l")}, path)
    assert keys() == {"a", "b", "c"}
    (tmp_path / "state" / f".{state.POINTER}.crc").unlink(missing_ok=True)
    (tmp_path / "state" / state.POINTER).write_text("version-lost")
    with pytest.raises(RuntimeError):
        keys()
    (tmp_path / "state" / state.POINTER).unlink()
    with pytest.raises(RuntimeError):
        keys()


def test_a_stopped_swap_is_put_right(spark, tmp_path):
    path = tmp_path / "table"
    sinks.publish(spark.range(3).toDF("n"), str(path))
    path.rename(tmp_path / "table.old-1")
    sinks.recover(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 3
