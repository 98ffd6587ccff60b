"""Build jobs: sources in, published tables and reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import track_key
from shelfwise.operators import catalog, coherence, duplicates, enrich, harvest, history, matching, places, quality, splitting
from shelfwise.operators.indexing import first_wins, last_wins
from shelfwise.session import materialize, tune
from shelfwise.sinks.runlog import RunJournal
from shelfwise.sinks.registry import grow, read_counters, read_registries
from shelfwise.sinks.tables import publish, publish_all, write_paths, write_report
from shelfwise.sources import files as file_sources
from shelfwise.sources import maps as map_sources

MUSIC_TABLES = ["tracks", "playlists", "playlist_tracks", "files", "enrichment", "platform_refs"]
PLACE_TABLES = ["places", "lists", "list_places", "platform_refs"]
_NO_REFS = "track_id string, platform string, external_id string"


def build_music(
    spark: SparkSession, out: str, library: DataFrame | None = None, scan: DataFrame | None = None,
    profiles: DataFrame | None = None, analysis: DataFrame | None = None,
) -> DataFrame:
    """Rebuild the canonical music tables from the sources there are; returns the totals.

    ``library``: playlist, artist, track, album, ordinal. ``scan``: the file inventory with
    an ordinal. ``profiles`` and ``analysis`` are optional.
    """
    tune(spark)
    if library is None and scan is None:
        raise ValueError("neither a library nor a file scan was given")
    if library is None:
        library = spark.createDataFrame([], "playlist string, artist string, track string, album string").withColumn(
            "ordinal", F.lit(None).cast(scan.schema["ordinal"].dataType)
        )
    if scan is not None:
        scan = materialize(catalog.keyed_files(scan), "scan")
    tracks = catalog.canonical_tracks(library, scan)
    playlists = catalog.playlists_table(library, profiles)
    links = catalog.playlist_tracks(library, playlists, tracks)
    matched = catalog.match_files(scan if scan is not None else _no_files(library), tracks)
    files = catalog.files_table(matched)
    enrichment = (
        catalog.enrichment_table(analysis, tracks) if analysis is not None
        else spark.createDataFrame([], "track_id string")
    )
    refs = spark.createDataFrame([], _NO_REFS)
    publish_all({
        "tracks": tracks.drop("source_rank", "ordinal"), "playlists": playlists, "playlist_tracks": links,
        "files": files, "enrichment": enrichment, "platform_refs": refs,
    }, out)
    return music_totals(spark, out)


def _no_files(library: DataFrame) -> DataFrame:
    return library.limit(0).select("artist", F.col("track").alias("title"), "album", "ordinal").withColumn(
        "path", F.lit("")
    )


def music_totals(spark: SparkSession, out: str) -> DataFrame:
    """Totals of the built tables, without rebuilding."""
    t = file_sources.open_tables(spark, out, MUSIC_TABLES)
    status = catalog.track_status(t["tracks"], t["playlist_tracks"], t["files"])
    return catalog.music_summary(status, t["playlists"], t["files"], t["enrichment"])


def build_places(spark: SparkSession, source: str, out: str, state: str, backfill: bool = False) -> DataFrame:
    """Rebuild the place tables from map and list exports; returns counts and totals.

    The registry in ``state`` outlives rebuilds, so ids do not change. The entries a rebuild adds are in
    force, all of them, before any table with new ids is published; a rebuild stopped in between repeats them.
    """
    tune(spark)
    kinds = {r["kind"] for r in file_sources.classify_files(spark, source).select("kind").distinct().collect()}
    if not kinds & {"my_maps", "saved"}:
        raise FileNotFoundError(f"no map or list export below {source}")
    registries = read_registries(spark, state, ["places", "lists"])
    counters = read_counters(spark, state, registries)
    maps = materialize(map_sources.read_maps(spark, source, strict=True), "maps")
    saved = map_sources.read_saved_lists(spark, source)
    built = places.build_places(
        places.map_occurrences(maps).unionByName(places.saved_occurrences(saved)),
        places.map_lists(maps).unionByName(places.saved_lists(map_sources.saved_files(spark, source))),
        registries["places"], registries["lists"], counters["places"], counters["lists"], backfill,
    )
    grow(state, {"places": built.new_place_keys, "lists": built.new_list_keys}, counters)
    publish_all({
        "places": built.places, "lists": built.lists, "list_places": built.list_places, "platform_refs": built.refs,
    }, out)
    skipped = maps.filter("pos IS NOT NULL AND NOT coalesce(geometry = 'Point', false)").agg(F.count("*").alias("n"))
    totals = places_totals(spark, out).select(F.struct(*_TOTALS).alias("_totals")).scalar()
    counted = places.place_counters(built).select("*", skipped.scalar().alias("skipped_tracks"), totals.alias("_totals"))
    return counted.select("*", "_totals.*").drop("_totals")


_TOTALS = ("places", "resolved", "unresolved", "in_several_lists", "lists", "map_lists", "saved_lists", "links", "refs")


def places_totals(spark: SparkSession, out: str) -> DataFrame:
    """Totals of the built tables, without rebuilding."""
    t = file_sources.open_tables(spark, out, PLACE_TABLES)
    return places.places_summary(t["places"], t["lists"], t["list_places"], t["platform_refs"])


def inventory(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    """What a folder of exports holds: maps, lists, unread maps and other files."""
    tune(spark)
    listed = file_sources.classify_files(spark, source)
    return {
        "maps": places.inventory_maps(map_sources.read_maps(spark, source)),
        "lists": places.inventory_lists(map_sources.read_saved_lists(spark, source)),
        "unreadable": map_sources.unreadable_maps(spark, source),
        "other": listed.filter("kind = 'other'").orderBy("path"),
    }


def report_history(spark: SparkSession, source: str, out: str) -> DataFrame:
    """Write the album and artist rankings; returns the analysed span."""
    tune(spark)
    plays = file_sources.read_history(spark, source)
    order = [F.desc("hours_played")]
    write_report(history.album_ranking(plays), f"{out}/albums_ranked", order)
    write_report(history.artist_ranking(plays), f"{out}/artists_ranked", order)
    return history.history_span(plays)


def report_duplicates(spark: SparkSession, scan_csv: str, out: str) -> DataFrame:
    """Write the duplicate report and the quarantine list; returns the figures."""
    tune(spark)
    scan = catalog.keyed_files(file_sources.read_csv_strings(spark, scan_csv))
    ranked = materialize(duplicates.rank_duplicates(scan), "ranked")
    write_report(ranked, f"{out}/local_duplicates_report", ["group_id", "rank"])
    write_paths(duplicates.quarantine_paths(ranked), f"{out}/quarantine_paths")
    return duplicates.duplicate_stats(scan)


def tagged_library(
    library: DataFrame, tags: DataFrame, primary: DataFrame, secondary: DataFrame | None = None
) -> DataFrame:
    """Library rows with profile tags and features: the input of coherence and splitting."""
    keyed = library.withColumn("track_key", track_key(F.col("artist"), F.col("track")))
    joined = enrich.with_features(keyed, primary, secondary).join(enrich.track_tags(library, tags), "artist", "left")
    return joined.select(
        "playlist", "ordinal", "artist", "track", "album",
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.col("features.energy").alias("energy"), F.col("features.valence").alias("valence"),
    )


def report_coherence(rows: DataFrame, names: DataFrame, out: str) -> DataFrame:
    """Write outliers with a better playlist; returns the summary per playlist."""
    rows = materialize(rows, "tagged")
    outliers = coherence.all_outliers(rows, names)
    listed = outliers.join(rows.select("playlist", "ordinal", "artist", "track"), ["playlist", "ordinal"])
    write_report(listed.select("playlist", "artist", "track", "kind", "value", "z", "recommended"), f"{out}/coherence")
    facts = coherence.playlist_facts(rows)
    kept = coherence.profiled_rows(rows, facts)
    return coherence.coherence_summary(kept, coherence.profile_tags(coherence.tag_frequency(kept)), names)


def report_split(rows: DataFrame, names: DataFrame, out: str) -> DataFrame:
    """Write the split detail and the plan, each playlist's larger themes first; returns the plan."""
    detail = materialize(splitting.split_detail(materialize(rows, "tagged"), names), "detail")
    plan = splitting.split_plan(detail)
    write_report(detail.select("name", "sub_playlist", "artist", "track", "album", "energy"), f"{out}/monoliths_detail")
    write_report(splitting.plan_order(plan), f"{out}/monoliths_plan", ["name", "playlist", "place"])
    return plan


def playlist_names(library: DataFrame) -> DataFrame:
    """Playlists with their name and listing position: ``playlist, name, pos``."""
    return library.groupBy("playlist").agg(F.min("ordinal").alias("pos")).withColumn("name", F.col("playlist"))


def build_analysis(
    library: DataFrame, tags: DataFrame, primary: DataFrame, secondary: DataFrame, countries: DataFrame, out: str
) -> DataFrame:
    """Rewrite the analysis table as a whole; returns its coverage."""
    publish(enrich.analysis_table(library, tags, primary, secondary, countries), f"{out}/analysis")
    return enrich.build_coverage(library.sparkSession.read.parquet(f"{out}/analysis"))


def report_retag(results: DataFrame, scan: DataFrame, out: str) -> DataFrame:
    """Write the retag plan of a fingerprint cache; returns the counts per outcome."""
    plan = materialize(matching.retag_plan(results, scan), "retag")
    write_report(plan, f"{out}/retag_plan")
    return matching.retag_counts(plan)


def report_playlists(rows: DataFrame, liked: DataFrame, out: str) -> DataFrame:
    """Write playlist rows and tracks found in several playlists; returns the counts.

    ``rows``: playlist, name, track_id, artist, track, ordinal; ``liked``: track_id.
    """
    write_report(rows.drop("ordinal"), f"{out}/playlists_tracks")
    duplicate = materialize(harvest.duplicate_names(rows), "duplicates")
    write_report(duplicate, f"{out}/duplicate_tracks", ["track_id"])
    return duplicate.agg(F.count("*").alias("duplicates")).select(
        "*", harvest.orphan_ids(liked, rows).agg(F.count("*").alias("n")).scalar().alias("orphans")
    )


# Entry types of the harvest caches, each a JSON map from its key.
CACHES = {
    "tags": ("norm", "artist string, tags array<struct<name:string,count:bigint>>, error string"),
    "primary": (
        "track_key",
        "found boolean, bpm double, energy double, valence double, danceability double, acousticness double, "
        "instrumentalness double, duration_ms bigint, camelot string, mood string",
    ),
    "secondary": (
        "track_key",
        "found boolean, energy double, valence double, danceability double, tempo double, acousticness double, "
        "instrumentalness double",
    ),
    "countries": ("norm", "artist string, country string, area string, score bigint"),
    "fingerprints": (
        "path", "status string, score double, artist string, title string, album string, mbid string, detail string",
    ),
}


def load_cache(spark: SparkSession, name: str, path: str | None) -> DataFrame:
    """One harvest cache as a keyed table: a JSON map, or Parquet; empty while absent."""
    key, schema = CACHES[name]
    columns = f"{key} string, {schema}"
    if not path or not file_sources.path_exists(spark, path):
        return spark.createDataFrame([], columns)
    if path.endswith(".json"):
        return file_sources.import_json_cache(spark, path, schema, key)
    # Parquet caches are appended to: a key written twice counts once, the later row.
    stored = spark.read.schema(columns).parquet(path).withColumn("_row", F.monotonically_increasing_id())
    return last_wins(stored, [key], "_row").drop("_row")


def pending_keys(library: DataFrame, cache: DataFrame, name: str, limit: int = 0, retry: bool = False) -> DataFrame:
    """What the harvest ``name`` still has to ask for, in library order; with ``retry`` misses again.

    Artists for tags and countries, tracks for features.
    """
    if name in ("tags", "countries"):
        return enrich.pending_work(enrich.unique_artists(library), cache, "norm", limit)
    tracks = first_wins(
        library.select(track_key(F.col("artist"), F.col("track")).alias("track_key"), "artist", "track", "ordinal"), ["track_key"])
    return enrich.pending_work(tracks, enrich.retry_misses(cache) if retry else cache, "track_key", limit)


def pending_batches(library: DataFrame, cache: DataFrame, used: int = 0, retry: bool = False) -> DataFrame:
    """The next batches of tracks within the request budget, after ``used`` requests."""
    return harvest.plan_batches(pending_keys(library, cache, "primary", retry=retry), ["ordinal"], used=used)


def pending_files(scan: DataFrame, cache: DataFrame, excluded: tuple[str, ...] = (), limit: int = 0) -> DataFrame:
    """Files with unusable tags that have no fingerprint yet, outside the excluded folders."""
    targets = duplicates.weak_tag_targets(scan, excluded or duplicates.EXCLUDED_PARTS)
    return enrich.pending_work(targets, cache, "path", limit)


def harvest_coverage(
    library: DataFrame, tags: DataFrame, primary: DataFrame, countries: DataFrame
) -> DataFrame:
    """State of the three harvests against what the library needs."""
    artists = enrich.artist_names(library)
    tracks = library.select(track_key(F.col("artist"), F.col("track")).alias("track_key"))
    return (
        harvest.coverage(artists, tags, "norm", "tags", "size(tags) > 0")
        .unionByName(harvest.coverage(tracks, primary, "track_key", "features", "found"))
        .unionByName(harvest.coverage(artists, countries, "norm", "country", "country <> ''"))
    )


def check_tables(spark: SparkSession, folder: str, rules: dict[str, list[quality.Rule]], journal: RunJournal | None = None) -> DataFrame:
    """(table, rule, severity, checked, broken) of the published tables that ``rules`` names; broken rules go to ``journal``."""
    tune(spark)
    out = None
    for name, own in rules.items():
        report = materialize(quality.quality_report(spark.read.parquet(f"{folder}/{name}"), own), "quality")
        if journal:
            journal.rules(name, report)
        report = report.select(F.lit(name).alias("table"), "*")
        out = report if out is None else out.unionByName(report)
    return out if out is not None else spark.createDataFrame([], "table string, " + quality.REPORT)
