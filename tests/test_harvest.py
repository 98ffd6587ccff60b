"""Payload parsing, matching, bookkeeping and the incremental run."""

import json

from pyspark.sql import functions as F

from shelfwise.operators import enrich, harvest, matching
from shelfwise.sources import files, harvest as bodies
from shelfwise.streaming import harvest as streams


def page(*names, nxt=None, key="track"):
    items = [None if n is None else {key: {"id": n, "name": n, "artists": [{"name": "A"}, {"name": ""}], "album": {"name": "L"}}} for n in names]
    return json.dumps({"items": items, "next": nxt, "total": len(items)})


def test_pages_keep_usable_items_and_refuse_unknown_formats(spark):
    raw = spark.createDataFrame([
        ("u", 0, page("x", None, "", nxt="n")), ("u", 3, page("e", key="episode")), ("v", 0, page("")), ("w", 0, "{}"),
        ("z", 0, '{"items": [{"other": 1}]}'),
    ], "unit string, page_offset bigint, body string")
    rows, facts, refused = bodies.parse_pages(raw)
    assert [(r["track"], r["artist"], r["pos"]) for r in rows.orderBy("page_offset").collect()] == [("x", "A", 0), ("e", "A", 0)]
    assert sorted((r["unit"], r["n_items"]) for r in facts.collect()) == [("u", 1), ("u", 3), ("w", 0)]
    assert sorted(r["unit"] for r in refused.collect()) == ["v", "z"]
    units = spark.createDataFrame([("u", None), ("v", None), ("w", None), ("z", 0), ("new", None)], "unit string, total bigint")
    done = {r["unit"]: (r["offset"], r["done"]) for r in harvest.unit_progress(units, facts).collect()}
    assert done == {"u": (4, True), "v": (0, False), "w": (0, True), "z": (0, True), "new": (0, False)}


def test_progress_stops_at_a_gap(spark):
    """A missing page, a refused one in the middle, a last page not yet seen, and a page landed twice."""
    facts = spark.createDataFrame([
        ("gap", 0, 1, "n"), ("gap", 5, 1, None), ("middle", 0, 2, "n"), ("middle", 4, 2, None),
        ("open", 0, 3, "n"), ("twice", 0, 2, "n"), ("twice", 0, 2, "n"), ("twice", 2, 1, None), ("late", 2, 1, None),
    ], "unit string, page_offset bigint, n_items int, next string")
    units = facts.select("unit").distinct()
    done = {r["unit"]: (r["offset"], r["done"]) for r in harvest.unit_progress(units, facts).collect()}
    assert done == {"gap": (1, False), "middle": (2, False), "open": (3, False), "twice": (3, True), "late": (0, False)}


def test_completed_prefix_and_liked(spark):
    units = spark.createDataFrame([("a", 1, True), ("b", 2, False), ("c", 3, True)], "unit string, ordinal int, done boolean")
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "unit string, track string")
    liked = spark.createDataFrame([("liked", "l", True)], "unit string, track string, done boolean")
    assert [r["track"] for r in harvest.completed_prefix(units, rows, liked).collect()] == ["x"]
    complete = units.withColumn("done", F.lit(True))
    assert sorted(r["track"] for r in harvest.completed_prefix(complete, rows, liked).collect()) == ["l", "x", "y", "z"]


def test_batches_stop_before_the_budget(spark):
    pending = spark.range(1, 124).select(F.col("id").alias("ordinal"), F.lit("A, B").alias("artist"), F.repeat(F.lit("t"), 300).alias("track"))
    sent = harvest.plan_batches(pending, ["ordinal"], size=10, budget=107, used=4).collect()
    assert len(sent) == 100 and {r["batch"] for r in sent} == set(range(10))
    assert {(len(r["sent_track"]), r["sent_artist"]) for r in sent} == {(200, "A")}
    assert len(harvest.plan_batches(pending, ["ordinal"], size=10, budget=123).collect()) == 123


def test_error_streaks(spark):
    pattern = "ok bad bad bad bad bad bad ok bad ok bad bad bad bad bad".split()
    df = spark.createDataFrame([(i, p == "bad") for i, p in enumerate(pattern)], "n int, failed boolean")
    got = sorted(tuple(r) for r in harvest.error_streaks(df, ["n"]).collect())
    assert got == [(2, 7, 6, 6), (11, 15, 5, 15)]


def test_fingerprint_choice(spark):
    def rec(title, score, groups=()):
        return {"score": score, "recordings": [{"id": title, "title": title, "artists": [{"name": "A"}, {"name": "B"}], "releasegroups": list(groups)}]}

    album, ep = {"title": "LP", "type": "Album"}, {"title": "E", "type": "EP"}
    answers = {
        "first": {"status": "ok", "results": [rec("x", 0.9, [ep, album]), rec("y", 0.9)]},
        "low": {"status": "ok", "results": [rec("x", 0.7994, [ep])]},
        "edge": {"status": "ok", "results": [rec("x", 0.7996)]},
        "none": {"status": "ok", "results": [{"score": 1.0}]},
        "err": {"status": "error"},
    }
    raw = spark.createDataFrame([(k, json.dumps(v)) for k, v in answers.items()], "path string, body string")
    got = {r["path"]: r for r in matching.best_recording(bodies.parse_fingerprints(raw)).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"first": "ok", "low": "low_score", "edge": "ok", "none": "nomatch", "err": "error"}
    assert (got["first"]["title"], got["first"]["album"], got["first"]["artist"]) == ("x", "LP", "A, B")
    assert got["low"]["album"] == "E" and got["edge"]["album"] == ""


def test_candidates_prefer_variant_then_exact_title(spark):
    library = spark.createDataFrame([("Ann, Bob", "Song (Live)")], "artist string, track string")
    key = "ann, bob||song (live)"
    candidates = spark.createDataFrame([
        (key, 0, 0, 1, "Song", ["Zed"]), (key, 0, 1, 2, "Song", ["BOB"]), (key, 0, 2, 3, "SONG (live)", ["ann"]), (key, 1, 0, 4, "Song (Live)", ["ann"]),
    ], "track_key string, variant_pos int, cand_pos int, catalog_id int, title string, artists array<string>")
    assert [tuple(r) for r in matching.match_candidates(library, candidates).collect()] == [(key, 3, 0, True)]


def test_countries_climb_areas(spark):
    raw = spark.createDataFrame([
        ("a", "A", '{"artists":[{"score":90,"country":"","area":{"id":"x","name":"Town"}}]}'),
        ("b", "B", '{"artists":[{"score":84,"country":"FR"}]}'), ("c", "C", '{"artists":[{"score":85,"country":"FR"}]}'), ("d", "D", "{}"),
    ], "norm string, artist string, body string")
    areas = spark.createDataFrame([
        ('{"id":"x","relations":[{"type":"part of","direction":"forward","area":{"id":"q"}},{"type":"part of","direction":"backward","area":{"id":"y"}}]}',),
        ('{"id":"y","relations":[{"type":"part of","direction":"backward","area":{"id":"z"}}]}',), ('{"id":"z","iso-3166-1-codes":["PT"]}',),
    ], "body string")
    found = bodies.parse_countries(raw)
    codes = matching.resolve_codes(bodies.parse_areas(areas))
    got = {r["norm"]: (r["country"], r["area"], r["score"]) for r in bodies.with_area_country(found, codes).collect()}
    assert got == {"a": ("PT", "Town", 90), "b": ("", "", 84), "c": ("FR", "", 85), "d": ("", "", 0)}


def test_hierarchy_with_cycles_and_dead_ends(spark):
    nodes = [("r", "XX", None), ("a", None, "b"), ("b", None, "a"), ("c", None, "gone"), ("s", "", "s"), ("own", "YY", "r")]
    nodes += [(f"n{i}", None, f"n{i - 1}" if i else "r") for i in range(40)]
    got = dict(map(tuple, matching.resolve_codes(spark.createDataFrame(nodes, "id string, code string, parent string")).collect()))
    assert {got[f"n{i}"] for i in range(40)} == {"XX"} and (got["own"], got["a"], got["c"], got["s"]) == ("YY", "", "", "")


def test_bulk_results_and_tags(spark):
    bulk = spark.createDataFrame([(0, json.dumps({"requests_used": 2, "results": [{"found": True, "result": {"bpm": 120.5, "energy": 0.5}}, {"found": False}]}))], "batch bigint, body string")
    requests = spark.createDataFrame([(0, 0, "k1"), (0, 1, "k2")], "batch bigint, pos int, track_key string")
    entries = bodies.bulk_entries(matching.zip_batches(requests, bodies.parse_bulk(bulk)))
    assert {(r["track_key"], r["found"], r["bpm"]) for r in entries.collect()} == {("k1", True, 120.5), ("k2", False, None)}
    assert [r["track_key"] for r in enrich.retry_misses(entries).collect()] == ["k1"]
    tags = spark.createDataFrame([("a", "A", json.dumps({"toptags": {"tag": [{"name": "ROCK", "count": 3}] + [{"name": f"T{i}"} for i in range(20)]}}))], "norm string, artist string, body string")
    entry = bodies.parse_tags(tags).first()
    assert len(entry["tags"]) == 12 and entry["tags"][0]["name"] == "rock" and entry["tags"][1]["count"] == 0


def test_stream_resumes_without_loss_or_repeats(spark, tmp_path):
    landing, cache, resume = (str(tmp_path / n) for n in ("landing", "cache", "resume"))

    def land(*pages):
        spark.createDataFrame(list(pages), streams.LANDING_SCHEMA).coalesce(1).write.mode("append").parquet(landing)

    def run():
        streams.ingest_pages(spark, landing, cache, resume, files_per_batch=1).awaitTermination()
        return sorted((r["unit"], r["page_offset"], r["track"]) for r in streams.cached_rows(spark, cache).collect())

    land(("u", 0, page("x", "y", nxt="n")))
    land(("v", 0, page("q")))
    first = [("u", 0, "x"), ("u", 0, "y"), ("v", 0, "q")]
    assert run() == first
    assert run() == first
    land(("u", 2, page("z")), ("u", 0, page("x", "y", nxt="n")), ("bad", 0, page("")))
    assert run() == first[:2] + [("u", 2, "z"), first[2]]
    pages = streams.cached_pages(spark, cache)
    progress = harvest.unit_progress(pages.select("unit").distinct(), pages)
    assert {r["unit"]: r["offset"] for r in progress.collect()} == {"u": 3, "v": 1}
    assert spark.read.parquet(f"{cache}/refused").count() == 1


def test_watch_rebuilds_once_per_landing(spark, tmp_path):
    landing, calls = str(tmp_path / "caches"), []
    schema = "key string"

    def run():
        streams.watch(spark, landing, schema, lambda: calls.append(1), str(tmp_path / "resume")).awaitTermination()

    spark.createDataFrame([("a",)], schema).write.parquet(landing)
    run()
    run()
    assert len(calls) == 1
    spark.createDataFrame([("b",)], schema).write.mode("append").parquet(landing)
    run()
    assert len(calls) == 2


def test_run_log(spark, tmp_path):
    log = tmp_path / "run.log"
    log.write_text("noise\n[10:00:00] Analyse: 5 lignes | genres 1 | features 2 | x\n[11:30:00] Analyse: 5 lignes | genres 4 | features 3 | x\nend\n")
    assert tuple(files.read_run_log(spark, str(log)).first()) == ("11:30:00", 4, 3)
