"""The deduplicated library and the advice, over tables of their own."""

import random

from pyspark.sql import functions as F

from shelfwise.operators import catalog, indexing
from shelfwise.plans import queries


def test_library_dedup_moves_no_key_texts(spark):
    rng = random.Random(3)
    artists, tracks = ["Ann", "ANN ", "ann, Bob", "", None, "Zoé"], ["One (Live)", "one", "Two", "", None, "Zwei - Remastered"]
    rows = [(rng.choice(["p", "q", None]), rng.choice(artists), rng.choice(tracks), f"album {i}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "playlist string, artist string, track string, album string, ordinal long")
    keyed = [(r["playlist"], r["na"], r["nt"], r["ordinal"]) for r in catalog.keyed_library(df).collect()]
    first = {}
    for playlist, na, nt, ordinal in keyed:
        first[playlist, na, nt] = min(ordinal, first.get((playlist, na, nt), ordinal))
    found = catalog.library_dedup(df)
    assert sorted(r["ordinal"] for r in found.collect()) == sorted(first.values())
    assert found.columns == df.columns
    again = catalog.library_dedup(catalog.keyed_library(df))
    assert sorted(r["ordinal"] for r in again.collect()) == sorted(first.values())
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "nt#" not in text and "min_by" not in text


def test_recommend_reads_its_tables_once(spark, tmp_path):
    """All steps read the written rows, so the tables behind them are joined and sent once."""
    rng = random.Random(5)
    spark.range(4).select(F.col("id").alias("s_suppkey"), F.lit(1.0).alias("s_acctbal"), F.lit("n").alias("s_name")).write.parquet(f"{tmp_path}/supplier.parquet")
    parts = [(i, f"{rng.choice(['red', 'blue', 'green'])} {rng.choice(['tin', 'lace', 'milk'])}", f"Brand#{i % 3}", rng.choice(["STEEL", "BRASS"]), 6 + i % 40, 900.0 + i) for i in range(60)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    lines = [(i, i % 3, rng.randrange(60), rng.randrange(4)) for i in range(400)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = queries.QUERIES["recommend"].run(spark, str(tmp_path))
    assert not [f for f in found.inputFiles() if "lineitem" in f or "supplier" in f]


def test_track_status_numbers_rows_without_texts(spark, monkeypatch):
    """Tracks and files are numbered by row numbers alone; repeated and keyless rows, and paths, count as before."""
    written = []
    write = indexing.materialize
    monkeypatch.setattr(indexing, "materialize", lambda df, name="cut": written.append(set(df.columns)) or write(df, name))
    lib = [("A", "Bo", "One", "x", 1), ("A", "BO", "one", "y", 2), ("B", "Bo", "One", "x", 3), ("B", None, "Two", "z", 4), ("A", "", "", "z", 5)] * 2
    scan = [("/1", "bo", "ONE", "x", "128", 1), ("/2", "bo", "Two", "x", "320", 2), ("/2", "bo", "Three", "x", "64", 3), ("/3", "", "", "x", "1", 4), ("/4", "bo", "two", "x", "", 5), ("/5", "", "", "x", "1", None)] * 2
    library = spark.createDataFrame(lib, "playlist string, artist string, track string, album string, ordinal long")
    files = catalog.keyed_scan(spark.createDataFrame(scan, "path string, artist string, title string, album string, bitrate_kbps string, ordinal long"))
    tracks = catalog.canonical_tracks(library, files, marks=True)
    links = catalog.playlist_tracks(library, catalog.playlists_table(library), tracks)
    listed = catalog.files_table(catalog.match_files(files, tracks))
    status = {tuple(r) for r in catalog.track_status(tracks, links, listed).collect()}
    assert status == {("P6-TRK-000001", "Bo", "One", "x", 2, 1, 128, 1, 1), ("P6-TRK-000002", None, "Two", "z", 1, 0, None, 1, 0),
                      ("P6-TRK-000003", "bo", "Two", "x", 0, 2, 320, 0, 1), ("P6-TRK-000004", "bo", "Three", "x", 0, 0, None, 0, 0)}
    assert sorted(r["path"] for r in listed.collect()) == ["/1", "/2", "/3", "/4", "/5"]
    plain = catalog.canonical_tracks(library, files)
    assert plain.columns == ["na", "nt", "artist", "title", "album", "origin", "source_rank", "ordinal", "id"] and plain.count() == 4
    assert catalog.playlist_tracks(catalog.keyed_library(library), catalog.playlists_table(library), plain).count() == 3 == links.count()
    assert not any(columns & {"title", "nt", "path", "artist"} for columns in written)
