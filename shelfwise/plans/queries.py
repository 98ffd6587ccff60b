"""Registered queries: one per operator, over whole tables, with a SQL check where it exists."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import geo, numbers, paths, text
from shelfwise.operators import catalog, coherence, duplicates, enrich, history, identity, matching, nearby, places, quality, schedule, splitting
from shelfwise.operators import harvest as bookkeeping
from shelfwise.plans import oracle as o
from shelfwise.plans import views as v
from shelfwise.session import materialize, scratch_path, tune
from shelfwise.sinks import registry
from shelfwise.sinks.state import publish_state, read_state
from shelfwise.sinks.tables import write_report
from shelfwise.sources import files as file_sources
from shelfwise.sources import harvest as bodies
from shelfwise.sources import maps as map_sources
from shelfwise.streaming import harvest as streams
from shelfwise.streaming import journal, watching


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}
PROFILE_SIZE = 4  # the parts have few tags, so a shorter profile leaves some misfits


def register(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        QUERIES[fn.__name__] = Query(run, sql)
        return run

    return add


def _flat(df: DataFrame) -> DataFrame:
    """The ordinal as plain columns."""
    return df.select(*[c for c in df.columns if c != "ordinal"], *v.flat_ordinal())


def _text_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: v.text_time(F.col(c)) for c in columns})


def _r4(x: Column) -> Column:
    return numbers.round_even(x, 4)


def _sql_r4(x: str) -> str:
    return o.round_even(x, 4)


_ORD = "o1, o2, o3, o4"

# --- listening history -----------------------------------------------------------------

_ALBUMS = """SELECT artist, album, count(*) plays, CAST(sum(ms_played) AS BIGINT) / 3600000.0 hours_played, count(DISTINCT track) distinct_tracks,
    min(ts) first_played, max(ts) last_played FROM plays WHERE album IS NOT NULL GROUP BY 1, 2"""


@register(o.sql(_ALBUMS, "plays"))
def album_ranking(spark, folder):
    return _text_times(history.album_ranking(v.history(spark, folder)), "first_played", "last_played")


@register(o.sql(_ALBUMS + " ORDER BY hours_played DESC, artist, album LIMIT 30", "plays"))
def album_top30(spark, folder):
    return _text_times(history.top_by_hours(history.album_ranking(v.history(spark, folder))), "first_played", "last_played")


@register(o.sql("""SELECT artist, count(*) plays, CAST(sum(ms_played) AS BIGINT) / 3600000.0 hours_played, count(DISTINCT album) distinct_albums
    FROM plays GROUP BY 1""", "plays"))
def artist_ranking(spark, folder):
    return history.artist_ranking(v.history(spark, folder))


@register(o.sql("SELECT count(*) plays, min(ts) first_ts, max(ts) last_ts FROM plays", "plays"))
def history_span(spark, folder):
    return _text_times(history.history_span(v.history(spark, folder)), "first_ts", "last_ts")


# --- text keys -------------------------------------------------------------------------


@register(f"SELECT doc_id, {o.norm_key('text')} norm_key FROM documents")
def norm_key_docs(spark, folder):
    return v.table(spark, folder, "documents").select("doc_id", text.norm_key(F.col("text")).alias("norm_key"))


@register("SELECT doc_id, regexp_replace(lower(replace(replace(replace(replace(nfkd, '…', '...'), '™', 'tm'), '½', '12'), 'ﬁ', 'fi')), '[^a-z0-9]+', '', 'g') AS norm_place "
          "FROM (SELECT doc_id, strip_accents(text) || '…™½ﬁ' AS nfkd FROM documents)")
def norm_expanding_docs(spark, folder):
    """The documents with characters at their end that become several letters."""
    expanding = F.concat("text", F.lit("…™½ﬁ"))
    return v.table(spark, folder, "documents").select("doc_id", text.norm_place(expanding).alias("norm_place"))


@register(f"SELECT conv_id, turn, {o.norm_place('text')} norm_place FROM conversations")
def norm_place_turns(spark, folder):
    return v.table(spark, folder, "conversations").select("conv_id", "turn", text.norm_place(F.col("text")).alias("norm_place"))


@register(f"SELECT doc_id, {o.norm_ws('text')} norm_ws FROM documents")
def norm_ws_docs(spark, folder):
    return v.table(spark, folder, "documents").select("doc_id", text.norm_ws(F.col("text")).alias("norm_ws"))


@register(o.sql("""SELECT strength, count(*) n_files FROM (SELECT CASE (na <> '')::INT + (nt <> '')::INT WHEN 2 THEN 'both' WHEN 1 THEN 'one' ELSE 'none' END strength
    FROM kfiles) GROUP BY 1""", "kfiles"))
def key_strength_counts(spark, folder):
    keyed = catalog.keyed_files(v.local_files(spark, folder))
    return keyed.groupBy(text.key_strength(F.col("na"), F.col("nt")).alias("strength")).agg(F.count("*").alias("n_files"))


# --- duplicates ------------------------------------------------------------------------


@register(o.sql("SELECT group_id, na, nt, n_files FROM dgroups", "dgroups"))
def dup_groups(spark, folder):
    return duplicates.duplicate_groups(v.local_files(spark, folder))


@register(o.sql("""SELECT group_id, artist, title, rank, CASE WHEN rank = 1 THEN 'keep' ELSE 'candidate_removal' END action, path, bitrate_kbps, size_bytes,
    extension FROM ranked""", "ranked"))
def dup_ranked(spark, folder):
    return duplicates.rank_duplicates(v.local_files(spark, folder))


@register(o.sql("""SELECT group_id, rank, upper(path[6]) || ':\\' || replace(path[8:], '/', '\\') win_path FROM ranked WHERE rank > 1""", "ranked"))
def quarantine_paths(spark, folder):
    return duplicates.quarantine_paths(duplicates.rank_duplicates(v.local_files(spark, folder)))


@register(o.sql("""SELECT (SELECT count(*) FROM kfiles) n_loaded, (SELECT count(*) FROM kfiles) - (SELECT count(*) FROM strong) n_skipped,
    (SELECT count(*) FROM dgroups) n_groups, (SELECT CAST(coalesce(sum(n_files), 0) AS BIGINT) FROM dgroups) n_files""", "kfiles", "strong", "dgroups"))
def dup_stats(spark, folder):
    return duplicates.duplicate_stats(v.local_files(spark, folder))


@register(o.sql("""SELECT path, artist, title FROM files WHERE (trim(artist) = '' OR trim(title) = '' OR regexp_full_match(trim(title), '[0-9]+'))
    AND NOT contains(path, '_a_trier') AND NOT contains(path, '/radio/') AND NOT contains(path, '/downloads/')""", "files"))
def weak_tag_targets(spark, folder):
    return duplicates.weak_tag_targets(v.local_files(spark, folder)).select("path", "artist", "title")


# --- canonical tables ------------------------------------------------------------------


class _Built(NamedTuple):
    library: DataFrame
    tracks: DataFrame
    playlists: DataFrame
    links: DataFrame
    matched: DataFrame


def _build(spark: SparkSession, folder: str) -> _Built:
    # The match keys of the scan are read by several tables, so it is keyed once.
    library = v.library(spark, folder)
    scan = catalog.keyed_scan(v.local_files(spark, folder))
    tracks = catalog.canonical_tracks(library, scan, marks=True)
    playlists = catalog.playlists_table(library, v.profiles(spark, folder))
    return _Built(
        library, tracks, playlists, catalog.playlist_tracks(library, playlists, tracks), catalog.match_files(scan, tracks)
    )


@register(o.sql(f"SELECT id, artist, title, album, na, nt, origin, source_rank, {_ORD} FROM tracks", "tracks"))
def canonical_tracks(spark, folder):
    return _flat(catalog.canonical_tracks(v.library(spark, folder), v.local_files(spark, folder)))


@register(o.sql("SELECT id, playlist AS name, 'spotify' AS source, theme, energy FROM playlists", "playlists"))
def playlists_table(spark, folder):
    built = catalog.playlists_table(v.library(spark, folder), v.profiles(spark, folder))
    return built.select("id", "name", "source", "theme", "energy")


@register(o.sql("SELECT playlist_id, track_id FROM links", "links"))
def playlist_tracks(spark, folder):
    return _build(spark, folder).links


@register(o.sql(f"""SELECT playlist, playlist_id, track_id, artist, track, album, {_ORD} FROM keyed
    QUALIFY row_number() OVER (PARTITION BY playlist, na, nt ORDER BY {_ORD}) = 1""", "keyed"))
def library_dedup(spark, folder):
    return _flat(catalog.library_dedup(v.library(spark, folder)))


@register(o.sql("SELECT path, track_id, match_class FROM matched", "matched"))
def local_match(spark, folder):
    return _build(spark, folder).matched.select("path", "track_id", "match_class")


@register(o.sql("""SELECT count(*) n_files, count(*) FILTER (match_class = 'matched_library') matched_library, count(*) FILTER (match_class = 'matched_local') matched_local,
    count(*) FILTER (match_class = 'created') created, count(*) FILTER (match_class = 'orphan') orphan, count(*) FILTER (match_class LIKE 'matched%') matched FROM matched""", "matched"))
def match_counts(spark, folder):
    return catalog.match_counts(_build(spark, folder).matched)


@register(o.sql(f"""SELECT 'P6-FIL-' || lpad(CAST(row_number() OVER (ORDER BY {_ORD}) AS VARCHAR), 6, '0') id, track_id, path, artist, title, album,
    TRY_CAST(size_bytes AS BIGINT) size_bytes, TRY_CAST(trunc(TRY_CAST(bitrate_kbps AS DOUBLE)) AS BIGINT) bitrate_kbps FROM matched""", "matched"))
def files_table(spark, folder):
    built = catalog.files_table(_build(spark, folder).matched)
    return built.select("id", "track_id", "path", "artist", "title", "album", "size_bytes", "bitrate_kbps")


@register(o.sql("""SELECT id, artist, title, album, n_playlists, n_files, best_bitrate, (n_playlists > 0)::INT on_library, (n_files > 0)::INT on_local FROM status""", "status"))
def track_status(spark, folder):
    b = _build(spark, folder)
    return catalog.track_status(b.tracks, b.links, catalog.files_table(b.matched))


_ENRICHED = f"""SELECT t.id track_id, nullif(genres, '') genres, nullif(country, '') country, nullif(mood, '') mood, nullif(camelot, '') camelot, nullif(duration, '') duration,
    energy, valence, danceability, CAST(tempo AS DOUBLE) tempo, acousticness, instrumentalness
    FROM (SELECT *, {o.norm_key('artist')} na, {o.norm_key('track')} nt FROM analysis) a JOIN tracks t USING (na, nt)
    QUALIFY row_number() OVER (PARTITION BY na, nt ORDER BY a.o1, a.o2, a.o3, a.o4) = 1"""


@register(o.sql(_ENRICHED, "analysis", "tracks"))
def enrichment_table(spark, folder):
    tracks = catalog.canonical_tracks(v.library(spark, folder), v.local_files(spark, folder))
    return catalog.enrichment_table(_analysis(spark, folder), tracks)


@register(o.sql(f"""SELECT count(*) tracks, count(*) FILTER (n_playlists > 0) on_library, count(*) FILTER (n_files > 0) on_local,
    count(*) FILTER (n_playlists > 0 AND n_files > 0) on_both, count(*) FILTER (n_playlists > 0 AND n_files = 0) library_only,
    count(*) FILTER (n_playlists = 0 AND n_files > 0) local_only, (SELECT count(*) FROM playlists) playlists, (SELECT count(*) FROM matched) files,
    (SELECT count(*) FROM matched WHERE track_id IS NULL) files_unattached, (SELECT count(*) FROM ({_ENRICHED})) enriched FROM status""",
    "status", "playlists", "matched", "analysis", "tracks"))
def music_summary(spark, folder):
    b = _build(spark, folder)
    scan = catalog.files_table(b.matched)
    enriched = catalog.enrichment_table(_analysis(spark, folder), b.tracks)
    return catalog.music_summary(catalog.track_status(b.tracks, b.links, scan), b.playlists, scan, enriched)


@register(o.sql(f"""SELECT count(*) n_files, count(*) FILTER (match_class = 'matched_library') matched_library, count(*) FILTER (match_class = 'matched_local') matched_local,
    count(*) FILTER (match_class = 'created') created, count(*) FILTER (match_class = 'orphan') orphan, count(*) FILTER (match_class LIKE 'matched%') matched,
    (SELECT count(*) FROM playlists) playlists, (SELECT count(*) FROM tracks WHERE origin = 'spotify') library_tracks,
    (SELECT count(*) FROM keyed WHERE na <> '' OR nt <> '') links_attempted, (SELECT count(*) FROM links) links_kept,
    (SELECT count(*) FROM ({_ENRICHED})) enriched FROM matched""", "matched", "playlists", "tracks", "keyed", "links", "analysis"))
def import_counters(spark, folder):
    b = _build(spark, folder)
    enriched = catalog.enrichment_table(_analysis(spark, folder), b.tracks)
    return catalog.import_counters(b.library, b.tracks, b.playlists, b.links, enriched, b.matched)


# --- enrichment ------------------------------------------------------------------------


def _analysis(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.analysis_table(
        v.library(spark, folder), v.artist_tags(spark, folder), v.primary_features(spark, folder),
        v.secondary_features(spark, folder), v.countries(spark, folder),
    )


_ANALYSIS_COLUMNS = """playlist, artist, track, album, genres, country, mood, energy, valence, danceability, tempo, acousticness, instrumentalness,
    camelot, duration"""


@register(o.sql(f"SELECT {_ANALYSIS_COLUMNS}, found, {_ORD} FROM analysis", "analysis"))
def analysis_table(spark, folder):
    return _flat(_analysis(spark, folder))


@register(o.sql("SELECT count(*) n_rows, count(*) FILTER (genres <> '') n_genres, count(*) FILTER (found) n_features FROM analysis", "analysis"))
def build_coverage(spark, folder):
    return enrich.build_coverage(_analysis(spark, folder))


@register(o.sql("SELECT artist, genres FROM genres", "genres"))
def track_genres(spark, folder):
    return enrich.track_genres(v.library(spark, folder), v.artist_tags(spark, folder))


@register(o.sql(f"""SELECT artist, string_agg(name, ', ' ORDER BY name) tags FROM (SELECT DISTINCT artist, t.name FROM names JOIN cachetags t USING (norm)
    WHERE rank <= 8 AND {o.usable_tag('t.name')}) GROUP BY 1""", "names", "cachetags"))
def track_tags(spark, folder):
    tagged = enrich.track_tags(v.library(spark, folder), v.artist_tags(spark, folder))
    return tagged.select("artist", F.array_join("tags", ", ").alias("tags"))


@register(o.sql(f"""SELECT norm, name artist, {_ORD} FROM names JOIN library USING (artist)
    QUALIFY row_number() OVER (PARTITION BY norm ORDER BY {_ORD}, pos) = 1""", "names", "library"))
def unique_artists(spark, folder):
    return _flat(enrich.unique_artists(v.library(spark, folder))).drop("pos")


@register(o.sql(f"""SELECT norm, name artist FROM (SELECT norm, name, {_ORD} FROM names JOIN library USING (artist)
    QUALIFY row_number() OVER (PARTITION BY norm ORDER BY {_ORD}, pos) = 1) WHERE norm NOT IN (SELECT 'brand#' || (n_nationkey + 1) FROM nation)""", "names", "library"))
def pending_work(spark, folder):
    artists = enrich.unique_artists(v.library(spark, folder))
    return enrich.pending_work(artists, v.countries(spark, folder), "norm").select("norm", "artist")


@register(o.sql(f"""SELECT norm, artist FROM (SELECT norm, name artist, {_ORD}, pos FROM names JOIN library USING (artist)
    QUALIFY row_number() OVER (PARTITION BY norm ORDER BY {_ORD}, pos) = 1) WHERE norm NOT IN (SELECT 'brand#' || (n_nationkey + 1) FROM nation) ORDER BY {_ORD}, pos LIMIT 25""", "names", "library"))
def pending_first(spark, folder):
    """The 25 artists that a harvest asks for first."""
    artists = enrich.unique_artists(v.library(spark, folder))
    return enrich.pending_work(artists, v.countries(spark, folder), "norm", 25, ["ordinal", "pos"]).select("norm", "artist")


@register(o.sql(f"""SELECT {o.norm_ws('artist')} || '||' || {o.norm_ws('track')} track_key FROM tparts WHERE NOT p_size > 20""", "tparts"))
def retry_misses(spark, folder):
    requested = v.titled_parts(spark, folder).select(text.track_key(F.col("artist"), F.col("track")).alias("track_key"))
    return enrich.pending_work(requested, enrich.retry_misses(v.primary_features(spark, folder)), "track_key")


# --- playlists in general --------------------------------------------------------------


@register(f"SELECT {o.playlist_name('s_suppkey')} AS name, {o.catchall(o.playlist_name('s_suppkey'))} catchall, {o.excluded(o.playlist_name('s_suppkey'))} excluded FROM supplier")
def playlist_classes(spark, folder):
    name = F.col("name")
    return v.playlist_names(spark, folder).select(
        "name", coherence.is_catchall(name).alias("catchall"), splitting.is_excluded(name).alias("excluded")
    )


def _memberships(spark: SparkSession, folder: str) -> DataFrame:
    return v.library(spark, folder).select(
        "track_id", F.col("playlist_id").alias("playlist"), F.col("playlist").alias("name"), "artist", "track", "ordinal"
    )


_MULTI = "SELECT track_id, count(DISTINCT playlist_id) n_playlists FROM library GROUP BY 1 HAVING count(DISTINCT playlist_id) > 1"


@register(o.sql(f"SELECT l.playlist_id, track_id, n_playlists, artist, track, {_ORD} FROM library l JOIN ({_MULTI}) USING (track_id)", "library"))
def multi_playlist(spark, folder):
    rows = bookkeeping.multi_playlist_rows(_memberships(spark, folder))
    return _flat(rows.select(F.col("playlist").alias("playlist_id"), "track_id", "n_playlists", "artist", "track", "ordinal"))


@register(o.sql(f"""SELECT track_id, count(*) n_names, string_agg(playlist, ', ' ORDER BY r) AS "names" FROM (
    SELECT track_id, playlist, row_number() OVER (PARTITION BY track_id ORDER BY {_ORD}) r FROM (
      SELECT * FROM library QUALIFY row_number() OVER (PARTITION BY track_id, playlist ORDER BY {_ORD}) = 1)
    JOIN ({_MULTI}) USING (track_id)) GROUP BY 1""", "library"))
def dup_names(spark, folder):
    return bookkeeping.duplicate_names(_memberships(spark, folder))


@register("SELECT o_orderkey track_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orphans(spark, folder):
    liked = v.table(spark, folder, "orders").select(F.col("o_orderkey").alias("track_id"))
    rows = v.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("track_id"))
    return bookkeeping.orphan_ids(liked, rows)


# --- coherence -------------------------------------------------------------------------


@register(o.sql("SELECT playlist, tag, df FROM tagdf", "tagdf"))
def tag_df(spark, folder):
    return coherence.tag_frequency(v.tagged_rows(spark, folder))


@register(o.sql(f"SELECT playlist, n_rows, n_tagged, {_sql_r4('e_mean')} e_mean FROM facts", "facts"))
def playlist_facts(spark, folder):
    return coherence.playlist_facts(v.tagged_rows(spark, folder)).withColumn("e_mean", _r4(F.col("e_mean")))


@register(o.sql("SELECT playlist, tag, df, CAST(rank AS INTEGER) rank FROM profile", "profile"))
def playlist_profile(spark, folder):
    return coherence.profile_tags(coherence.tag_frequency(v.tagged_rows(spark, folder)), PROFILE_SIZE)


def _profiled(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = v.tagged_rows(spark, folder)
    return rows, coherence.profile_tags(coherence.tag_frequency(rows), PROFILE_SIZE)


@register(o.sql(f"SELECT playlist, artist, track, array_to_string(tags[1:4], ', ') tags, array_to_string(profile[1:5], ', ') profile, {_ORD} FROM misfits", "misfits"))
def misfits(spark, folder):
    found = coherence.misfits(*_profiled(spark, folder))
    preview = lambda c, k: F.array_join(F.slice(F.array_sort(c), 1, k), ", ").alias(c)
    return _flat(found.select("playlist", "artist", "track", preview("tags", 4), preview("profile", 5), "ordinal"))


_ALIGNED = f"""SELECT playlist, n_rows, n_tagged, coalesce(m, 0) n_misfits,
    CASE WHEN n_tagged > 0 THEN 100.0::DOUBLE * (n_tagged - coalesce(m, 0)) / n_tagged END aligned_pct
    FROM facts LEFT JOIN (SELECT playlist, count(*) m FROM misfits GROUP BY 1) USING (playlist)"""


@register(o.sql(_ALIGNED, "facts", "misfits"))
def aligned_pct(spark, folder):
    return coherence.aligned(*_profiled(spark, folder))


_SUMMARY = f"""SELECT playlist, name, a.n_rows, aligned_pct, CASE WHEN catchall THEN 'fourre-tout' ELSE array_to_string(profile[1:6], ', ') END profile
    FROM ({_ALIGNED}) a JOIN facts USING (playlist) LEFT JOIN parrays USING (playlist)"""


@register(o.sql(_SUMMARY, "facts", "misfits", "parrays"))
def coherence_summary(spark, folder):
    return coherence.coherence_summary(*_profiled(spark, folder), v.playlist_names(spark, folder))


@register(o.sql(f"SELECT * FROM ({_SUMMARY}) ORDER BY coalesce(aligned_pct, 100), name LIMIT 15", "facts", "misfits", "parrays"))
def least_coherent(spark, folder):
    return coherence.least_coherent(coherence.coherence_summary(*_profiled(spark, folder), v.playlist_names(spark, folder)))


_USER_STATS = """SELECT user_id, 'value' feature, count(*) n, avg(value) mean, stddev_pop(value) std FROM events GROUP BY 1
    HAVING count(*) >= 15 AND stddev_pop(value) >= 0.05"""


@register(f"SELECT user_id, feature, n, {_sql_r4('mean')} mean, {_sql_r4('std')} std FROM ({_USER_STATS})")
def feature_stats(spark, folder):
    stats = coherence.feature_stats(v.table(spark, folder, "events"), "user_id", ("value",))
    return stats.withColumns({c: _r4(F.col(c)) for c in ("mean", "std")})


@register(f"""SELECT user_id, event_id, feature, value, {_sql_r4('mean')} mean, {_sql_r4('(value - mean) / std')} z FROM events JOIN ({_USER_STATS}) USING (user_id)
    WHERE abs((value - mean) / std) > 2.2""")
def z_outliers(spark, folder):
    found = coherence.z_outliers(v.table(spark, folder, "events"), "user_id", ("event_id",), ("value",))
    return found.drop("std").withColumns({c: _r4(F.col(c)) for c in ("mean", "z")})


@register(o.sql(f"""SELECT x.playlist, {_ORD}, kind, {_sql_r4('value')} AS value, {_sql_r4('z')} z, coalesce(CAST(tgt AS VARCHAR), '') recommended, {_sql_r4('score')} score
    FROM outliers x LEFT JOIN advice a ON a.playlist = x.playlist AND a.tags = x.tags AND a.e IS NOT DISTINCT FROM x.e""", "outliers", "advice"))
def outliers_all(spark, folder):
    found = coherence.all_outliers(v.tagged_rows(spark, folder), v.playlist_names(spark, folder), PROFILE_SIZE)
    return _flat(found.withColumns({c: _r4(F.col(c)) for c in ("value", "z", "score")}))


@register(o.sql(f"""SELECT x.playlist, {_ORD}, coalesce(CAST(tgt AS VARCHAR), '') recommended, {_sql_r4('score')} score FROM outliers x
    LEFT JOIN advice a ON a.playlist = x.playlist AND a.tags = x.tags AND a.e IS NOT DISTINCT FROM x.e WHERE kind = 'genre'""", "outliers", "advice"))
def recommend(spark, folder):
    # Read by five steps; written, so that the tables behind it are joined and sent once.
    rows = materialize(v.tagged_rows(spark, folder).select("playlist", "ordinal", "tags", "energy"), "rows")
    frequency = materialize(coherence.tag_frequency(rows), "frequency")
    profile = coherence.profile_tags(frequency, PROFILE_SIZE)
    facts = materialize(coherence.with_catchall(coherence.playlist_facts(rows), v.playlist_names(spark, folder)), "facts")
    mixed = facts.filter("catchall").select("playlist")
    items = coherence.misfits(rows, profile).join(mixed, "playlist", "left_anti").select("playlist", "ordinal", "tags", "energy")
    advised = coherence.recommend(items, frequency, facts)
    return _flat(advised.drop("tags", "energy").withColumn("score", _r4(F.col("score"))))


# --- splitting -------------------------------------------------------------------------


@register(o.sql(f"""SELECT playlist, name, n playlist_rows, theme, theme_rows, volume, sub_playlist, position, artist, track, album, {o.round_even('energy')} energy, {_ORD}
    FROM detail""", "detail"))
def split_detail(spark, folder):
    return _flat(splitting.split_detail(v.tagged_rows(spark, folder), v.playlist_names(spark, folder)))


@register(o.sql("""SELECT playlist, name, n playlist_rows, theme, volume, sub_playlist, CAST(sum(c) AS BIGINT) tracks, CAST(sum(c) * 4 AS BIGINT) AS "minutes",
    string_agg(artist, ', ' ORDER BY r) FILTER (r <= 3) top_artists FROM (SELECT *, row_number() OVER (PARTITION BY sub_playlist, playlist ORDER BY c DESC, f) r FROM (
      SELECT playlist, name, n, theme, volume, sub_playlist, artist, count(*) c, min(position) f FROM detail GROUP BY ALL)) GROUP BY ALL""", "detail"))
def split_plan(spark, folder):
    return splitting.split_plan(splitting.split_detail(v.tagged_rows(spark, folder), v.playlist_names(spark, folder)))


@register(o.sql("""SELECT playlist, theme, volume, theme_rows, CAST(row_number() OVER (PARTITION BY playlist ORDER BY theme_rows DESC, theme, volume) AS INTEGER) place FROM (
    SELECT playlist, theme, volume, CAST(sum(count(*)) OVER (PARTITION BY playlist, theme) AS BIGINT) theme_rows FROM detail GROUP BY playlist, theme, volume)""", "detail"))
def split_order(spark, folder):
    """The places of the sub-playlists in the plan: larger themes of a playlist first."""
    plan = splitting.split_plan(splitting.split_detail(v.tagged_rows(spark, folder), v.playlist_names(spark, folder)))
    return splitting.plan_order(plan).select("playlist", "theme", "volume", "theme_rows", "place")


# --- matching --------------------------------------------------------------------------


@register("""WITH RECURSIVE n AS (
    SELECT 'R' || r_regionkey id, r_name[1:2] code, NULL parent FROM region
    UNION ALL SELECT 'N' || n_nationkey, CASE WHEN n_nationkey = 7 THEN 'N7' END, CASE n_nationkey WHEN 24 THEN 'N23' WHEN 23 THEN 'N24' ELSE 'R' || n_regionkey END FROM nation
    UNION ALL SELECT 'C' || c_custkey, NULL, 'N' || c_nationkey FROM customer
    UNION ALL SELECT 'O' || o_orderkey, NULL, 'C' || o_custkey FROM orders),
  w AS (SELECT id, code, parent, 0 d FROM n UNION ALL SELECT w.id, n.code, n.parent, d + 1 FROM w JOIN n ON n.id = w.parent WHERE w.code IS NULL AND d < 8)
  SELECT id, coalesce(max(code), '') code FROM w GROUP BY id""")
def hierarchy_code(spark, folder):
    return matching.resolve_codes(v.area_nodes(spark, folder))


_VARIANTS = f"""WITH va AS (SELECT DISTINCT artist, track, {o.norm_ws('artist')} || '||' || {o.norm_ws('track')} track_key, i - 1 variant_pos, {o.norm_ws('x')} title_key,
      {o.norm_ws('track')} full_title
    FROM (SELECT DISTINCT artist, track FROM library), unnest(list_filter([track, CASE WHEN contains(track, ' - ') THEN split_part(track, ' - ', 1) END,
      CASE WHEN contains(track, '(') THEN trim(split_part(track, '(', 1)) END], lambda y: y IS NOT NULL)) WITH ORDINALITY u(x, i)),
  wanted AS (SELECT va.*, {o.norm_ws('a')} AS name FROM va, unnest(string_split(artist, ', ')) t(a)),
  entries AS (SELECT catalog_id, {o.norm_ws('title')} title_key, {o.norm_ws('a')} AS name FROM (
      SELECT p_partkey * 2 catalog_id, p_name || ' ' || p_partkey title, [upper(p_brand), 'Guest'] artists FROM tparts
      UNION ALL SELECT p_partkey * 2 + 1, upper(track), [upper(p_brand), 'Guest'] FROM tparts WHERE p_size > 25), unnest(artists) t(a))
  SELECT track_key, catalog_id, CAST(variant_pos AS INTEGER) variant_pos, title_key = full_title exact FROM wanted JOIN entries USING (title_key, name)
  QUALIFY row_number() OVER (PARTITION BY track_key ORDER BY variant_pos, title_key = full_title DESC, catalog_id) = 1"""


@register("SELECT * FROM (" + o.sql("SELECT * FROM (" + _VARIANTS + ")", "library") + ")")
def variant_match(spark, folder):
    return matching.match_variants(v.library(spark, folder), v.catalog_entries(spark, folder))


def _identified(spark: SparkSession, folder: str) -> DataFrame:
    return matching.best_recording(bodies.parse_fingerprints(v.fingerprint_bodies(spark, folder)))


@register(o.sql("SELECT path, status, score, artist, title, album, mbid FROM identified", "identified"))
def best_recording(spark, folder):
    return _identified(spark, folder)


def _plan(spark: SparkSession, folder: str) -> DataFrame:
    scanned = v.table(spark, folder, "orders").join(v.table(spark, folder, "customer"), F.col("c_custkey") == F.col("o_custkey")).select(
        F.concat(F.lit("/x/"), F.col("o_orderkey"), F.lit(".mp3")).alias("path"), F.col("c_name").alias("artist"),
        F.col("o_orderpriority").alias("title"), F.col("o_orderkey").alias("ordinal"),
    )
    return matching.retag_plan(_identified(spark, folder), scanned)


@register(o.sql("SELECT * FROM plan", "plan"))
def retag_plan(spark, folder):
    return _plan(spark, folder)


@register(o.sql("""SELECT count(*) FILTER (status = 'ok') identified, count(*) FILTER (status IN ('nomatch', 'low_score')) unreliable,
    count(*) FILTER (status NOT IN ('ok', 'nomatch', 'low_score')) failed FROM plan""", "plan"))
def retag_counts(spark, folder):
    return matching.retag_counts(_plan(spark, folder))


@register("SELECT '/x/' || o_orderkey || '.mp3' path, 'missing' status FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_files(spark, folder):
    path = lambda key: F.concat(F.lit("/x/"), F.col(key), F.lit(".mp3")).alias("path")
    listing = v.table(spark, folder, "lineitem").select("l_orderkey").distinct().select(path("l_orderkey"))
    return matching.missing_files(v.table(spark, folder, "orders").select(path("o_orderkey")), listing)


@register("""WITH RECURSIVE c AS (SELECT lower(c_name) norm, c_name artist, c_custkey % 41 + 60 score, CASE WHEN c_custkey % 2 = 0 THEN 'N' || c_nationkey ELSE '' END country,
      c_mktsegment area, c_nationkey FROM customer),
    n AS (SELECT n_nationkey, CASE WHEN n_nationkey = 7 THEN 'N7' WHEN n_nationkey IN (23, 24) THEN '' ELSE r_name[1:2] END code FROM nation JOIN region ON r_regionkey = n_regionkey)
    SELECT norm, artist, score, CASE WHEN score < 85 THEN '' ELSE area END area, CASE WHEN score < 85 THEN '' WHEN country <> '' THEN country ELSE code END country
    FROM c JOIN n ON n_nationkey = c_nationkey""")
def country_harvest(spark, folder):
    """Artist searches with a confidence gate; missing countries come from climbing areas."""
    nation = F.concat(F.lit("N"), F.col("c_nationkey"))
    hit = F.struct(
        (F.col("c_custkey") % 41 + 60).alias("score"), F.when(F.col("c_custkey") % 2 == 0, nation).otherwise("").alias("country"),
        F.struct(nation.alias("id"), F.col("c_mktsegment").alias("name")).alias("area"),
    )
    raw = v.table(spark, folder, "customer").select(
        F.lower("c_name").alias("norm"), F.col("c_name").alias("artist"), F.to_json(F.struct(F.array(hit).alias("artists"))).alias("body")
    )
    return bodies.with_area_country(bodies.parse_countries(raw), matching.resolve_codes(v.area_nodes(spark, folder)))


@register("SELECT o_orderkey // 50 batch, o_orderkey % 50 pos, o_custkey requested, o_totalprice result FROM orders")
def batch_zip(spark, folder):
    orders = v.table(spark, folder, "orders").withColumns({"batch": F.expr("o_orderkey div 50"), "pos": F.expr("o_orderkey % 50")})
    answers = orders.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("pos", "o_totalprice")))["o_totalprice"].alias("results"))
    return matching.zip_batches(orders.select("batch", "pos", F.col("o_custkey").alias("requested")), answers)


# --- harvest ---------------------------------------------------------------------------

_ITEM = "SELECT unit, page_offset, CAST(pos AS INTEGER) pos, role artist, track, 'talk' album, role first_artist FROM pagerows WHERE track <> ''"


@register(o.sql(_ITEM, "pagerows"))
def page_rows(spark, folder):
    return bodies.parse_pages(v.raw_pages(spark, folder))[0].drop("track_id")


@register(o.sql("SELECT unit, page_offset FROM pagerows GROUP BY 1, 2 HAVING count(*) FILTER (track <> '') = 0", "pagerows"))
def refused_pages(spark, folder):
    return bodies.parse_pages(v.raw_pages(spark, folder))[2].select("unit", "page_offset")


@register(o.sql('SELECT unit, "offset", done FROM progress', "progress"))
def unit_progress(spark, folder):
    return bookkeeping.unit_progress(v.listed_units(spark, folder), bodies.parse_pages(v.raw_pages(spark, folder))[1])


@register(o.sql(f"""SELECT p.* FROM ({_ITEM}) p JOIN progress g ON g.unit = p.unit
    WHERE g.ordinal < (SELECT coalesce(min(ordinal), 9223372036854775807) FROM progress WHERE NOT done)""", "pagerows", "progress"))
def prefix_rows(spark, folder):
    rows, facts, _ = bodies.parse_pages(v.raw_pages(spark, folder))
    listing = v.listed_units(spark, folder)
    units = bookkeeping.unit_progress(listing, facts).join(listing.select("unit", "ordinal"), "unit")
    return bookkeeping.completed_prefix(units, rows).drop("track_id")


@register(o.sql("""SELECT (SELECT CAST(sum("offset") AS BIGINT) FROM progress) fetched, (SELECT CAST(sum(n_items) AS BIGINT) FROM pagefacts) expected""", "progress", "pagefacts"))
def export_progress(spark, folder):
    facts = bodies.parse_pages(v.raw_pages(spark, folder))[1]
    progress = bookkeeping.unit_progress(v.listed_units(spark, folder), facts)
    return bookkeeping.export_progress(facts.withColumn("total", F.col("n_items")), progress)


@register(o.sql("SELECT playlist, artist, track, album FROM library UNION ALL SELECT 'Liked Songs', artist, track, album FROM tparts", "library", "tparts"))
def snapshot_rows(spark, folder):
    columns = ["playlist", "artist", "track", "album"]
    return bookkeeping.snapshot_rows(v.library(spark, folder).select(*columns), v.titled_parts(spark, folder).select(*columns[1:]))


def _units(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as listed playlists, with a JSON listing body per nation."""
    orders = v.table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    total = F.when(F.col("c_acctbal") < 0, F.lit(0)).otherwise(F.col("n"))
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_acctbal") > 5000, F.col("c_name")).alias("name"),
        F.struct(F.col("c_mktsegment").alias("id")).alias("owner"), F.struct(total.alias("total")).alias("tracks"),
    )
    listed = v.table(spark, folder, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    # 50 playlists to a page, as the listing delivers them.
    paged = listed.groupBy(F.expr("c_custkey div 50").alias("page_offset")).agg(F.sort_array(F.collect_list(F.struct("c_custkey", item.alias("i"))))["i"].alias("items"))
    return bodies.parse_playlists(paged.select("page_offset", F.to_json(F.struct("items")).alias("body")))


@register("""SELECT CAST(c_custkey AS VARCHAR) id, CASE WHEN c_acctbal > 5000 THEN c_name ELSE CAST(c_custkey AS VARCHAR) END AS name,
    CASE WHEN c_acctbal < 0 THEN 0 ELSE n END total FROM customer LEFT JOIN (SELECT o_custkey, count(*) n FROM orders GROUP BY 1) ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' AND NOT c_acctbal < 0""")
def units_to_fetch(spark, folder):
    owned = bookkeeping.owned_units(_units(spark, folder), "BUILDING")
    return bookkeeping.units_to_fetch(owned).select("id", "name", "total")


@register(o.sql(f"""SELECT {_ORD}, (i - 1) // 14000 + 1 tab, (i - 1) % 14000 + 1 tab_row FROM (SELECT *, row_number() OVER (ORDER BY {_ORD}) i FROM library)""", "library"))
def tab_chunks(spark, folder):
    return _flat(bookkeeping.with_tabs(v.library(spark, folder).select("ordinal"), ["ordinal"]))


@register(o.sql(f"""SELECT {_ORD}, (i - 1) // 50 batch, (i - 1) % 50 pos, track[1:200] sent_track, split_part(artist, ', ', 1) sent_artist FROM (
    SELECT *, row_number() OVER (ORDER BY {_ORD}) i, count(*) OVER () n FROM library) WHERE least(((i - 1) // 50 + 1) * 50, n) <= 14800""", "library"))
def budget_batches(spark, folder):
    planned = bookkeeping.plan_batches(v.library(spark, folder).select("ordinal", "artist", "track"), ["ordinal"])
    return _flat(planned.drop("artist", "track"))


@register(o.sql(f"""SELECT 'tags' stream, count(DISTINCT norm) done, (SELECT count(DISTINCT norm) FROM names) total, count(DISTINCT norm) matched,
      100 * count(DISTINCT norm) // (SELECT count(DISTINCT norm) FROM names) pct, 100 match_pct FROM cachetags
    UNION ALL SELECT 'features', count(*), (SELECT count(DISTINCT (artist, track)) FROM library), count(*) FILTER (p_size > 20),
      100 * count(*) // (SELECT count(DISTINCT (artist, track)) FROM library), 100 * count(*) FILTER (p_size > 20) // count(*) FROM part
    UNION ALL SELECT 'country', count(*), (SELECT count(DISTINCT norm) FROM names), count(*), 100 * count(*) // (SELECT count(DISTINCT norm) FROM names), 100 FROM nation""",
    "cachetags", "names", "library"))
def coverage(spark, folder):
    library = v.library(spark, folder)
    artists = enrich.artist_names(library)
    tracks = library.select(text.track_key(F.col("artist"), F.col("track")).alias("track_key"))
    return (
        bookkeeping.coverage(artists, v.artist_tags(spark, folder), "norm", "tags", "size(tags) > 0")
        .unionByName(bookkeeping.coverage(tracks, v.primary_features(spark, folder), "track_key", "features", "found"))
        .unionByName(bookkeeping.coverage(artists, v.countries(spark, folder), "norm", "country", "country <> ''"))
    )


_GAINS = "SELECT stream, run, pct, pct - lag(pct) OVER (PARTITION BY stream ORDER BY run) gain FROM snaps QUALIFY gain >= 1"


@register(o.sql(_GAINS, "snaps"))
def gains(spark, folder):
    return bookkeeping.gains(v.snapshots(spark, folder))


@register("""WITH e AS (SELECT row_number() OVER (ORDER BY event_id) i, event_type IN ('error', 'click', 'view') failed FROM events),
    g AS (SELECT i, i - row_number() OVER (ORDER BY i) run FROM e WHERE failed)
    SELECT min(i) first_idx, max(i) last_idx, count(*) AS length, min(i) + 4 stop_idx FROM g GROUP BY run HAVING count(*) >= 5""")
def error_streaks(spark, folder):
    attempts = v.table(spark, folder, "events").select("event_id", F.col("event_type").isin("error", "click", "view").alias("failed"))
    return bookkeeping.error_streaks(attempts, ["event_id"])


@register("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P')")
def pending_after_errors(spark, folder):
    status = F.when(F.col("o_orderstatus") == "P", "transient").otherwise("ok")
    attempts = v.table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), status.alias("status"))
    return bookkeeping.pending_after_errors(v.table(spark, folder, "customer").select("c_custkey"), attempts, "c_custkey")


@register("""SELECT strftime(max(d), '%Y-%m-%d') AS "time", arg_max(g, d) genres, arg_max(f, d) features FROM (
    SELECT CAST(ts AS DATE) d, count(DISTINCT user_id) g, count(*) f FROM events GROUP BY 1)""")
def latest_run(spark, folder):
    daily = v.table(spark, folder, "events").groupBy(F.to_date("ts").alias("ordinal")).agg(
        F.countDistinct("user_id").alias("g"), F.count("*").alias("f")
    )
    line = F.format_string("[%s] Analyse: %d lignes | genres %d | features %d | caches", F.col("ordinal").cast("string"), "f", "g", "f")
    return file_sources.latest_run(daily.select("ordinal", line.alias("value")))


# --- streams ---------------------------------------------------------------------------


@register(o.sql(_ITEM, "pagerows"))
def stream_pages(spark, folder):
    """The pages landed as files, consumed by the incremental run, then read from its cache."""
    landing, cache = scratch_path(spark, "landing"), scratch_path(spark, "cache")
    v.raw_pages(spark, folder).write.option("maxRecordsPerFile", 50_000).parquet(landing)
    streams.ingest_pages(spark, landing, cache, scratch_path(spark, "resume"), files_per_batch=2).awaitTermination()
    return streams.cached_rows(spark, cache).drop("track_id")


@register(o.sql(_GAINS, "snaps"))
def stream_gains(spark, folder):
    """The coverage snapshots as a stream, followed with one number of state per stream."""
    landing, out = scratch_path(spark, "snapshots"), scratch_path(spark, "gains")
    v.snapshots(spark, folder).write.parquet(landing)
    stream = spark.readStream.schema("stream string, run bigint, pct bigint").parquet(landing)
    streams.follow_gains(stream).writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "resume")).trigger(
        availableNow=True
    ).start(out).awaitTermination()
    return spark.read.schema("stream string, run bigint, pct bigint, gain bigint").parquet(out)


# --- paths -----------------------------------------------------------------------------


def _scan_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as files of a folder tree, some of them in quarantine or of another kind."""
    size = F.col("p_size")
    ext = F.when(size % 4 == 0, ".MP3").when(size % 4 == 1, ".flac").when(size % 4 == 2, ".m4a").otherwise(".txt")
    number = F.when(size % 3 == 0, F.concat(F.lpad(size.cast("string"), 2, "0"), F.lit(". - "))).otherwise("")
    artist = F.when(size % 5 == 0, "").otherwise(F.concat("p_brand", F.lit(" - ")))
    folder_part = F.when(size == 13, "_a_trier").otherwise(F.lower("p_type"))
    return v.table(spark, folder, "part").select(
        F.concat(F.lit("/music/"), folder_part, F.lit("/"), number, artist, "p_name", F.lit(" "), "p_partkey", ext).alias("path"),
        F.col("p_partkey").alias("key"), folder_part.alias("root"),
        F.when(size > 40, F.col("p_brand")).otherwise("").alias("tag_artist"),
    )


def _inventory(spark: SparkSession, folder: str) -> DataFrame:
    listed = _scan_paths(spark, folder)
    tags = listed.select("path", F.col("tag_artist").alias("artist"), F.when(F.col("tag_artist") != "", "tagged").otherwise("").alias("title"))
    return file_sources.with_tags(file_sources.describe_files(listed), tags)


_SCAN = """SELECT p_partkey AS key, p_size, folder root, '/music/' || folder || '/' || stem || ext path, stem || ext filename, lower(ext) extension, stem,
    CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END guess_artist, p_name || ' ' || p_partkey base, p_brand FROM (
    SELECT *, CASE WHEN p_size = 13 THEN '_a_trier' ELSE lower(p_type) END folder, CASE p_size % 4 WHEN 0 THEN '.MP3' WHEN 1 THEN '.flac' WHEN 2 THEN '.m4a' ELSE '.txt' END ext,
      CASE WHEN p_size % 3 = 0 THEN lpad(CAST(p_size AS VARCHAR), 2, '0') || '. - ' ELSE '' END || CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand || ' - ' END || p_name || ' ' || p_partkey stem
    FROM part)"""
_FILES = f"""SELECT *, CASE WHEN p_size > 40 THEN p_brand ELSE guess_artist END artist, CASE WHEN p_size > 40 THEN 'tagged' WHEN guess_artist = '' THEN stem ELSE base END title,
    CASE WHEN p_size > 40 THEN 'yes' ELSE 'no' END tags_read FROM ({_SCAN}) WHERE extension <> '.txt' AND root <> '_a_trier'"""


@register(f"SELECT path, filename, extension, artist, title, tags_read FROM ({_FILES})")
def file_guess(spark, folder):
    return _inventory(spark, folder).select("path", "filename", "extension", "artist", "title", "tags_read")


@register(f"SELECT root, count(*) n_files, count(*) FILTER (tags_read = 'yes') n_tagged, count(*) FILTER (tags_read = 'no') n_guessed FROM ({_FILES}) GROUP BY 1")
def scan_counts(spark, folder):
    return file_sources.scan_counts(_inventory(spark, folder), F.col("root"))


@register(o.sql("SELECT path, upper(path[6]) || ':\\' || replace(path[8:], '/', '\\') win_path FROM files", "files"))
def win_path(spark, folder):
    return v.local_files(spark, folder).select("path", paths.win_path(F.col("path")).alias("win_path"))


@register(r"""SELECT page_id, path, CASE WHEN page_id % 4 < 2 THEN 'my_maps' WHEN page_id % 4 = 2 THEN 'saved' ELSE 'other' END kind FROM (
    SELECT page_id, regexp_replace(url, '^[a-z]+://', '/') || '/f' || page_id || CASE page_id % 4 WHEN 0 THEN '.kml' WHEN 1 THEN '.KMZ' WHEN 2 THEN '.csv' ELSE '.html' END path FROM pages)""")
def vault_classes(spark, folder):
    n = F.col("page_id")
    suffix = F.when(n % 4 == 0, ".kml").when(n % 4 == 1, ".KMZ").when(n % 4 == 2, ".csv").otherwise(".html")
    path = F.concat(F.regexp_replace("url", "^[a-z]+://", "/"), F.lit("/f"), n, suffix)
    return v.table(spark, folder, "pages").select("page_id", path.alias("path"), paths.file_kind(path).alias("kind"))


# --- places ----------------------------------------------------------------------------


@register(o.sql("SELECT pos, url, lat, lon, cid FROM saved", "saved"))
def url_coords(spark, folder):
    return v.saved_rows(spark, folder).select("pos", "url", "lat", "lon", "cid")


@register(o.sql(f"SELECT pos, lat, lon, {o.geohash('lat', 'lon')} geohash FROM maps", "maps"))
def geohash7(spark, folder):
    return v.map_rows(spark, folder).select("pos", "lat", "lon", geo.geohash(F.col("lat"), F.col("lon")).alias("geohash"))


def _empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "key string, id string")


def _places(spark: SparkSession, folder: str) -> places.Places:
    maps, saved = v.map_rows(spark, folder), v.saved_rows(spark, folder)
    occurrences = places.map_occurrences(maps).unionByName(places.saved_occurrences(saved))
    lists = places.map_lists(maps).unionByName(places.saved_lists(saved))
    registry = _empty_registry(spark)
    return places.build_places(occurrences, lists, registry, registry)


@register(o.sql("SELECT src AS source, path, part, row, id FROM occids", "occids"))
def place_ids(spark, folder):
    seen = _places(spark, folder).occurrences
    return seen.select("ordinal.source", "ordinal.path", "ordinal.part", "ordinal.row", "id")


@register(o.sql("SELECT key, id, is_new FROM keyids", "keyids"))
def place_registry(spark, folder):
    return _places(spark, folder).new_place_keys


@register(o.sql("SELECT id, name, norm_name, lat, lon, geohash, description, url, status, origin, source_file FROM places", "places"))
def places_table(spark, folder):
    return _places(spark, folder).places.drop("extra")


@register(o.sql("SELECT id, name, map_name, type, source_file FROM plists", "plists"))
def place_lists(spark, folder):
    return _places(spark, folder).lists


@register(o.sql("SELECT list_id, place_id, note, tags FROM lplaces", "lplaces"))
def list_places(spark, folder):
    return _places(spark, folder).list_places


@register(o.sql("SELECT place_id, platform, external_id FROM prefs", "prefs"))
def place_refs(spark, folder):
    return _places(spark, folder).refs


_STATUS = """SELECT id, name, origin, (SELECT count(*) FROM lplaces l WHERE l.place_id = p.id) n_lists, (lat IS NOT NULL)::INT resolved FROM places p"""


@register(o.sql(_STATUS, "places", "lplaces"))
def place_status(spark, folder):
    built = _places(spark, folder)
    return places.place_status(built.places, built.list_places)


@register(o.sql(f"""SELECT count(*) places, count(*) FILTER (resolved = 1) resolved, count(*) FILTER (resolved = 0) unresolved, count(*) FILTER (n_lists > 1) in_several_lists,
    (SELECT count(*) FROM plists) lists, (SELECT count(*) FROM plists WHERE type = 'my_maps') map_lists, (SELECT count(*) FROM plists WHERE type = 'saved') saved_lists,
    (SELECT count(*) FROM lplaces) links, (SELECT count(*) FROM prefs) refs FROM ({_STATUS})""", "places", "lplaces", "plists", "prefs"))
def places_summary(spark, folder):
    built = _places(spark, folder)
    return places.places_summary(built.places, built.lists, built.list_places, built.refs)


@register(o.sql("""SELECT (SELECT count(*) FROM occids) occurrences, (SELECT count(*) FROM occids) - (SELECT count(*) FROM places) merged,
    (SELECT count(*) FROM keyids WHERE is_new) new_places, (SELECT count(*) FROM plists) new_lists""", "occids", "places", "keyids", "plists"))
def place_counters(spark, folder):
    return places.place_counters(_places(spark, folder))


@register(o.sql("""SELECT k1, k2, a.id id1, b.id id2 FROM (SELECT DISTINCT k1, k2 FROM occ WHERE k2 IS NOT NULL) JOIN keyids a ON a.key = k1 JOIN keyids b ON b.key = k2
    WHERE a.id <> b.id""", "occ", "keyids"))
def registry_conflicts(spark, folder):
    built = _places(spark, folder)
    return identity.registry_conflicts(built.occurrences, built.new_place_keys)


@register(o.sql("""SELECT key, id, CAST(1 + min(src) AS INTEGER) run, 0 third_run_new FROM (SELECT k1 key, src FROM occ UNION ALL SELECT k2, src FROM occ WHERE k2 IS NOT NULL)
    JOIN keyids USING (key) GROUP BY key, id""", "occ", "keyids"))
def registry_second_run(spark, folder):
    """The registry after runs over the maps, over maps and saved lists, and over both again: which run added a key,
    and how many ids the third run made."""
    state, kinds = scratch_path(spark, "registry"), ["places"]
    maps = places.map_occurrences(v.map_rows(spark, folder))
    both = maps.unionByName(places.saved_occurrences(v.saved_rows(spark, folder)))
    keys = places.place_keys(F.col("name"), F.col("lat"), F.col("lon"), F.col("reference"), F.col("list_scope"))
    runs = []
    for run, occurrences in enumerate((maps, both, both), 1):
        before = registry.read_registries(spark, state, kinds)
        counters = registry.read_counters(spark, state, before)
        keyed = materialize(occurrences.select("ordinal", keys.alias("keys")), "occurrences")
        _, added = identity.resolve_ids(keyed, before["places"], places.PLACE_KIND, places.PLACE_WIDTH, counters["places"])
        registry.grow(state, {"places": added}, counters)
        runs.append(added.select("key", F.lit(run).alias("run")))
    stored = registry.read_registries(spark, state, kinds)["places"]
    third = runs[2].agg(F.count("*").cast("int").alias("n")).scalar()
    return stored.join(runs[0].unionByName(runs[1]), "key").select("key", "id", "run", third.alias("third_run_new"))


_LAYERS = """SELECT map, path, layer_pos, CASE WHEN layer = '' THEN '(sans calque)' ELSE layer END || ':' || count(*) t, count(*) FILTER (geometry = 'Point') p,
    count(*) FILTER (geometry <> 'Point') k, count(*) FILTER (name = '') u FROM maps GROUP BY map, path, layer_pos, layer"""


@register(o.sql(f"""SELECT map, path, CAST(sum(p) AS BIGINT) points, CAST(sum(k) AS BIGINT) tracks, CAST(sum(u) AS BIGINT) unnamed, string_agg(t, ', ' ORDER BY layer_pos) layers
    FROM ({_LAYERS}) GROUP BY 1, 2
    UNION ALL SELECT NULL, NULL, CAST(sum(p) AS BIGINT), CAST(sum(k) AS BIGINT), CAST(sum(u) AS BIGINT), NULL FROM ({_LAYERS})""", "maps"))
def inventory_maps(spark, folder):
    return places.inventory_maps(v.map_rows(spark, folder))


@register(o.sql("""SELECT list, count(*) n_rows, count(*) FILTER (lat IS NOT NULL) with_coords, count(*) FILTER (lat IS NULL AND cid IS NOT NULL) reference_only,
    count(*) FILTER (lat IS NULL AND cid IS NULL) name_only FROM saved GROUP BY ROLLUP (list)""", "saved"))
def inventory_lists(spark, folder):
    return places.inventory_lists(v.saved_rows(spark, folder))


_METRES = """2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"""
_POINTS = "(SELECT pos AS place, lat, lon FROM maps WHERE lat IS NOT NULL AND lon IS NOT NULL)"
_POSITIONS = "(SELECT pos, lat, lon FROM saved WHERE lat IS NOT NULL AND lon IS NOT NULL)"


def _map_points(spark: SparkSession, folder: str) -> DataFrame:
    return v.map_rows(spark, folder).select(F.col("pos").alias("place"), "lat", "lon")


@register(o.sql(f"SELECT pos, place, CAST(round({_METRES}) AS BIGINT) metres FROM {_POSITIONS} a, {_POINTS} b WHERE {_METRES} <= 100000", "maps", "saved"))
def places_near(spark, folder):
    """All placemarks at most 100 km from each saved position."""
    found = nearby.places_near(v.saved_rows(spark, folder), _map_points(spark, folder), 100_000, "pos", "place")
    return found.withColumn("metres", F.round("metres").cast("bigint"))


@register(o.sql(f"""SELECT pos, CAST(rank AS INTEGER) AS rank, place, CAST(round(m) AS BIGINT) metres FROM (
    SELECT pos, place, m, row_number() OVER (PARTITION BY pos ORDER BY m, place) AS rank FROM (SELECT pos, place, {_METRES} m FROM {_POSITIONS} a, {_POINTS} b))
    WHERE rank <= 3""", "maps", "saved"))
def places_nearest(spark, folder):
    """The three placemarks nearest to each saved position."""
    found = nearby.places_nearest(v.saved_rows(spark, folder), _map_points(spark, folder), 3, "pos", "place")
    return found.withColumn("metres", F.round("metres").cast("bigint"))


# --- events of places ------------------------------------------------------------------

_STATUS_LIST = "['INBOX', 'DRAFT', 'VALIDATED', 'BROKEN']"
_PLACE_EVENTS = f"""
    e AS (SELECT 'P' || user_id place_id, event_id, event_id * 7919 % 10007 seq, (['CAPTURE', 'RENAME', 'STATUS', 'VISIT', 'VISIT', 'DELETE', 'RESTORE'])[event_id % 7 + 1] AS type,
            CASE event_id % 7 WHEN 1 THEN 'name ' || (props->>'$.k') WHEN 2 THEN ({_STATUS_LIST})[CAST(props->>'$.k' AS INT) % 4 + 1] END AS value, ts FROM events),
    landed AS (SELECT * FROM e
        UNION ALL SELECT place_id, event_id + 1000000000000, seq, 'UNVISIT', CAST(event_id AS VARCHAR), ts FROM e WHERE type = 'VISIT' AND event_id % 3 = 0
        UNION ALL SELECT place_id, event_id, seq + CASE WHEN event_id % 20 = 1 THEN -1 ELSE 1 END, type, value, ts FROM e WHERE event_id % 10 = 1)"""
_REPLAY = f"""WITH {_PLACE_EVENTS},
    once AS (SELECT * FROM landed WHERE value IS DISTINCT FROM 'BROKEN' QUALIFY row_number() OVER (PARTITION BY place_id, event_id ORDER BY seq) = 1),
    v AS (SELECT place_id, count(*) visits, min(ts) first_visit, max(ts) last_visit FROM once a WHERE type = 'VISIT'
        AND NOT EXISTS (SELECT 1 FROM once b WHERE b.type = 'UNVISIT' AND b.place_id = a.place_id AND b.value = CAST(a.event_id AS VARCHAR)) GROUP BY 1),
    s AS (SELECT place_id, arg_max(value, (seq, event_id)) FILTER (type = 'RENAME') AS name, coalesce(arg_max(value, (seq, event_id)) FILTER (type = 'STATUS'), 'INBOX') status,
        bool_or(type = 'CAPTURE') captured, coalesce(arg_max(type, (seq, event_id)) FILTER (type IN ('DELETE', 'RESTORE')) = 'DELETE', false) deleted, count(*) events FROM once GROUP BY 1)
    SELECT s.*, coalesce(visits, 0) visits, strftime(first_visit, '%Y-%m-%dT%H:%M:%S.%f') first_visit, strftime(last_visit, '%Y-%m-%dT%H:%M:%S.%f') last_visit
    FROM s LEFT JOIN v USING (place_id)"""


@register(_REPLAY)
def event_replay(spark, folder):
    """The state of all places from all events at once."""
    return _text_times(journal.replay(v.place_events(spark, folder)), "first_visit", "last_visit")


def _landed_events(spark: SparkSession, folder: str, landing: str, turn: int) -> None:
    """Half of the events as files, dealt so that places' events come late and out of order."""
    events = v.place_events(spark, folder)
    half = F.pmod(F.xxhash64("event_id", "seq"), F.lit(2)) == turn
    events.filter(half).repartition(3, "seq").write.mode("append").parquet(landing)


@register(_REPLAY)
def stream_event_replay(spark, folder):
    """The same states from a stream that stops after half of the files and goes on from its checkpoint."""
    landing, out, checkpoint = (scratch_path(spark, name) for name in ("events", "states", "resume"))
    for turn in range(2):
        _landed_events(spark, folder, landing, turn)
        journal.replay_stream(spark, landing, out, checkpoint, files_per_batch=2).awaitTermination()
    return _text_times(journal.current_states(spark, out), "first_visit", "last_visit")


@register(f"WITH {_PLACE_EVENTS} SELECT place_id, event_id, seq, type, value FROM landed WHERE value = 'BROKEN'")
def refused_events(spark, folder):
    return journal.refused(v.place_events(spark, folder)).select("place_id", "event_id", "seq", "type", "value")


@register(o.sql(f"""SELECT c_custkey, 'P' || c_custkey AS id, coalesce(visits, 0) visits, coalesce(visits, 0) > 0 visited, last_visit, coalesce(deleted, false) deleted
    FROM customer LEFT JOIN ({_REPLAY}) ON place_id = 'P' || c_custkey"""))
def visit_status(spark, folder):
    """All customers as places, with what the events say of them."""
    places_ = v.table(spark, folder, "customer").select("c_custkey", F.concat(F.lit("P"), "c_custkey").alias("id"))
    return _text_times(journal.with_visits(places_, journal.replay(v.place_events(spark, folder))), "last_visit")


# --- broadcast schedule ----------------------------------------------------------------

_STATION = "(['click', 'error', 'purchase', 'signup', 'view'])[{k} % 5 + 1]"
_ERA = "(['80s', '90s', '00s'])[{k} % 3 + 1]"
_SLOT_DAYS = f"""slotdays AS (SELECT DISTINCT station, slot_id, priority, start_min, length, day FROM (
    SELECT {_STATION.format(k='p_partkey')} station, p_partkey slot_id, CASE WHEN p_partkey % 499 = 0 THEN 9 ELSE p_size % 7 END priority, (p_partkey * 37 + p_size * 11) % 1440 start_min,
      CASE WHEN p_partkey % 499 = 0 THEN 1440 ELSE 1 + p_size % 15 END AS length, unnest([p_partkey % 7 + 1, (p_partkey * 3 + p_size) % 7 + 1]) AS day FROM part))"""
_ON_AIR = "(wd - day + 7) % 7 * 1440 + clock - start_min BETWEEN 0 AND length - 1"


@register(f"""WITH {_SLOT_DAYS}, plays AS (SELECT event_id play_id, event_type station, isodow(ts) wd, hour(ts) * 60 + minute(ts) AS clock FROM events),
    held AS (SELECT play_id, arg_min(slot_id, (priority, slot_id)) slot_id FROM plays JOIN slotdays s ON s.station = plays.station AND {_ON_AIR} GROUP BY 1)
    SELECT play_id, plays.station, slot_id FROM plays LEFT JOIN held USING (play_id)""")
def slot_of_play(spark, folder):
    """The slot on air at every play."""
    return schedule.slot_of_play(v.station_plays(spark, folder), v.slots(spark, folder)).select("play_id", "station", "slot_id")


@register(f"""WITH {_SLOT_DAYS}, clocks AS (SELECT wd, clock FROM range(1, 8) a(wd), range(0, 1440) b(clock)),
    air AS (SELECT station, wd, clock, arg_min(slot_id, (priority, slot_id)) slot_id FROM clocks JOIN slotdays ON {_ON_AIR} GROUP BY 1, 2, 3)
    SELECT station, slot_id, count(*) AS minutes FROM air GROUP BY 1, 2""")
def slot_minutes(spark, folder):
    """Minutes a week that each slot is on air, after stronger slots took theirs."""
    grid = schedule.weekly_grid(v.slots(spark, folder))
    return grid.groupBy("station", "slot_id").agg(F.sum(F.col("end_min") - F.col("start_min")).alias("minutes"))


@register(f"""WITH requests AS (SELECT s_suppkey request_id, {_STATION.format(k='s_suppkey')} station, make_timestamp((1704067200 + s_suppkey * 26171 % 2592000) * 1000000) AS "at",
      s_suppkey % 3 + 1 low, s_suppkey % 3 + 1 + s_suppkey % 2 high, CASE WHEN s_suppkey % 4 > 0 THEN {_ERA.format(k='(s_suppkey // 5)')} END era,
      CASE WHEN s_suppkey % 3 = 0 THEN 'US' END culture FROM supplier),
    files AS (SELECT p_partkey AS file, {_STATION.format(k='p_partkey')} station, p_size % 5 + 1 energy, {_ERA.format(k='p_partkey')} era,
      CASE WHEN p_partkey // 5 % 2 = 0 THEN 'US' ELSE 'FR' END culture, round(p_retailprice / 100) weight FROM part WHERE p_size % 11 <> 0 AND round(p_retailprice / 100) > 0),
    drawn AS (SELECT request_id, f.file, -ln((('0x' || substr(md5('draw|' || request_id || '|' || f.file), 1, 12))::BIGINT + 1) / 281474976710656.0) / weight AS key
      FROM requests r JOIN files f ON f.station = r.station AND energy BETWEEN low AND high AND coalesce(r.era, f.era) = f.era AND coalesce(r.culture, f.culture) = f.culture
      WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = r.station AND e.event_id * 7 % 2000 = f.file AND e.ts >= r."at" - INTERVAL 7 DAY AND e.ts < r."at"))
    SELECT request_id, CAST(rank AS INTEGER) AS rank, file FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY key, file) AS rank FROM drawn) WHERE rank <= 5""")
def slot_candidates(spark, folder):
    """Five files for each request, drawn by weight among those not played for a week."""
    return schedule.slot_candidates(v.slot_requests(spark, folder), v.station_files(spark, folder), v.station_plays(spark, folder), 5, "draw")


@register("""WITH plays AS (SELECT event_type station, ts, event_id play_id, CAST(props->>'$.k' AS INT) % 5 + 1 energy FROM events),
    o AS (SELECT *, lag(energy) OVER w AS e, lag(play_id) OVER w AS before FROM plays WINDOW w AS (PARTITION BY station ORDER BY ts, play_id))
    SELECT station, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') ts, play_id, before FROM o WHERE energy = 5 AND e = 1""")
def energy_breaks(spark, folder):
    """Plays of the highest energy right after the lowest."""
    return _text_times(schedule.energy_breaks(v.station_plays(spark, folder)), "ts")


# --- data quality ----------------------------------------------------------------------

_RULES = {
    "documents": [
        quality.Rule("id", unique=("doc_id",)), quality.Rule("text", "length(trim(text)) > 0"), quality.Rule("copies", severity="info", unique=("text",)),
        quality.Rule("length", "n_chars = char_length(text)", "warning"),
        quality.any_of("known", [quality.Rule("lang", "lang IN ('en', 'fr')"), quality.Rule("long", "n_chars > 2000")], "info"),
    ],
    "orders": [
        quality.Rule("id", unique=("o_orderkey",)), quality.Rule("status", "o_orderstatus IN ('F', 'O')", "warning"),
        quality.Rule("price", "o_totalprice > 1000").where("o_orderstatus = 'F'"),
    ],
    "lineitem": [
        quality.Rule("line", "true", "error", "true", ("l_orderkey", "l_linenumber")),
        quality.all_of("amount", [quality.Rule("quantity", "l_quantity BETWEEN 2 AND 49"), quality.Rule("tax", "l_tax > 0").where("l_returnflag = 'R'")], "warning"),
        quality.Rule("discount", "l_discount BETWEEN 0 AND 0.08"),
    ],
    "customer": [quality.Rule("id", unique=("c_custkey",)), quality.Rule("balance", "c_acctbal >= 0", "warning"), quality.Rule("nation", unique=("c_nationkey",), severity="info")],
    "events": [quality.Rule("id", unique=("event_id",)), quality.Rule("value", "value > 0.5", "warning", "event_type <> 'error'")],
}


def _sql_rule(table: str, rule: quality.Rule) -> str:
    """A rule counted on its own, as a check of the one pass."""
    present = " AND ".join([f"({rule.guard})", *(f"{c} IS NOT NULL" for c in rule.unique)])
    broken = f"count(*) FILTER (WHERE {present}) - count(DISTINCT ({', '.join(rule.unique)})) FILTER (WHERE {present})" if rule.unique else (
        f"count(*) FILTER (WHERE ({rule.guard}) AND NOT coalesce({rule.condition.replace('char_length', 'length')}, false))")
    return f"""SELECT '{table}' AS "table", '{rule.name}' AS rule, '{rule.severity}' AS severity, count(*) FILTER (WHERE {present}) checked, {broken} broken FROM {table}"""


@register(" UNION ALL ".join(_sql_rule(t, r) for t, rules in _RULES.items() for r in rules))
def quality_report(spark, folder):
    """All rules over five whole tables, one scan of each."""
    parts = [quality.quality_report(v.table(spark, folder, t), rules).select(F.lit(t).alias("table"), "*") for t, rules in _RULES.items()]
    return reduce(DataFrame.unionByName, parts)


@register("""SELECT quality, rule, count(*) n FROM (SELECT CASE WHEN len(broken) > 0 THEN 'refused' ELSE 'kept' END quality, unnest(broken || ['rows']) AS rule FROM (
    SELECT list_filter([CASE WHEN NOT coalesce(l_discount BETWEEN 0 AND 0.08, false) THEN 'discount' END], lambda x: x IS NOT NULL) broken FROM lineitem)) GROUP BY 1, 2""")
def quality_split(spark, folder):
    """Line items written in one pass as kept and refused; the counts are those of the table read back."""
    path = scratch_path(spark, "checked")
    quality.write_checked(v.table(spark, folder, "lineitem"), [r for r in _RULES["lineitem"] if r.severity == "error"], path)
    stored = spark.read.parquet(path).select("quality", F.explode(F.concat("broken", F.array(F.lit("rows")))).alias("rule"))
    return stored.groupBy("quality", "rule").agg(F.count("*").alias("n"))


# --- sources and sinks, written and read again -----------------------------------------


@register(o.sql("SELECT ts, ms_played, artist, album, track FROM history", "history"))
def history_roundtrip(spark, folder):
    """All events as JSON arrays of at most 5,000 plays a file, read as a listening history."""
    path = scratch_path(spark, "history")
    play = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), "ms_played", F.col("artist").alias("master_metadata_album_artist_name"),
        F.col("album").alias("master_metadata_album_album_name"), F.col("track").alias("master_metadata_track_name"))
    plays = materialize(v.history(spark, folder).withColumn("file", F.expr("monotonically_increasing_id() div 5000")), "plays")
    plays.groupBy("file").agg(F.to_json(F.collect_list(play)).alias("value")).write.partitionBy("file").text(path)
    return _text_times(file_sources.read_history(spark, path, "part-*"), "ts")


@register("SELECT CAST(doc_id AS VARCHAR) AS key, text, lang, source, n_chars FROM documents")
def json_cache_roundtrip(spark, folder):
    """All documents as entries of JSON maps over several lines, whole texts with quotes and brackets included."""
    path = scratch_path(spark, "maps")
    docs = v.table(spark, folder, "documents").withColumn("file", F.expr("doc_id div 500"))
    entry = F.to_json(F.create_map(F.col("doc_id").cast("string"), F.struct("text", "lang", "source", "n_chars")))
    inner = F.array_join(F.collect_list(F.expr("substring(entry, 2, length(entry) - 2)")), ",\n  ")
    maps = docs.select("file", entry.alias("entry")).groupBy("file").agg(F.concat(F.lit('{"_used": 3,\n  '), inner, F.lit("\n}")).alias("value"))
    maps.write.partitionBy("file").text(path)
    return file_sources.import_json_cache(spark, path, "text string, lang string, source string, n_chars bigint", "key")


@register("SELECT CAST(doc_id AS VARCHAR) doc_id, text, lang, source, CAST(n_chars AS VARCHAR) n_chars FROM documents")
def report_roundtrip(spark, folder):
    """All documents as a CSV report with header, quotes and line breaks included, read as text columns."""
    path = scratch_path(spark, "report")
    write_report(v.table(spark, folder, "documents"), path)
    return file_sources.read_csv_strings(spark, path).drop("ordinal")


@register(o.sql("SELECT title, coalesce(note, '') note, url, tags, coalesce(comment, '') AS comment, lat, lon, cid FROM saved", "saved"))
def saved_list_roundtrip(spark, folder):
    """All saved rows as CSV files, half of them with headers of another language and order."""
    path = scratch_path(spark, "saved")
    rows = v.saved_urls(spark, folder)
    headers = {0: ("title Title, note Note, url URL, tags Tags, comment Comment"), 1: ("url URL, title Titre, comment Commentaire, note Note, tags Tags")}
    for turn, names in headers.items():
        half = rows.filter(F.col("pos") % 2 == turn).selectExpr(*[" AS ".join(f"`{x}`" for x in n.split()) for n in names.split(", ")])
        write_report(half, f"{path}/{turn}")
    read = map_sources.read_saved_lists(spark, path)
    return read.select("title", "note", "url", "tags", "comment", "lat", "lon", "cid")


@register("SELECT 'k' || c_custkey AS key, 'P' || c_custkey AS id, 2 AS version FROM customer")
def state_roundtrip(spark, folder):
    """A registry published twice: readers get the second version whole."""
    state = scratch_path(spark, "state")
    rows = v.table(spark, folder, "customer").select(F.concat(F.lit("k"), "c_custkey").alias("key"), F.concat(F.lit("P"), "c_custkey").alias("id"), "c_custkey")
    for version, part in ((1, rows.filter(F.col("c_custkey") % 2 == 0)), (2, rows)):
        publish_state({"registry": part.select("key", "id", F.lit(version).alias("version"))}, state)
    return read_state(spark, state, "registry", "key string, id string, version int")


@register("""SELECT 'n' || n_nationkey AS id, CASE WHEN n_nationkey % 3 > 0 THEN upper(n_name[1:2]) END code, CASE WHEN n_nationkey % 4 > 0 THEN 'r' || n_regionkey END parent FROM nation
    UNION ALL SELECT 'c' || c_custkey, CASE WHEN c_custkey % 3 > 0 THEN upper(c_name[1:2]) END, CASE WHEN c_custkey % 4 > 0 THEN 'n' || c_nationkey END FROM customer""")
def area_rows(spark, folder):
    """Nations and customers as area bodies: the first code, and the first area that it is part of."""

    def landed(name: str, mark: str, key: str, text_: str, up: str, up_mark: str) -> DataFrame:
        relation = lambda kind, way, area: F.struct(F.lit(kind).alias("type"), F.lit(way).alias("direction"), F.struct(area.alias("id")).alias("area"))
        part_of = F.when(F.col(key) % 4 > 0, F.array(
            relation("capital", "backward", F.lit("x")), relation("part of", "forward", F.lit("y")), relation("part of", "backward", F.concat(F.lit(up_mark), up)),
            relation("part of", "backward", F.lit("z"))))
        codes = F.when(F.col(key) % 3 > 0, F.array(F.upper(F.substring(text_, 1, 2)), F.lit("ZZ")))
        body = F.struct(F.concat(F.lit(mark), key).alias("id"), codes.alias("iso-3166-1-codes"), part_of.alias("relations"))
        return v.table(spark, folder, name).select(F.to_json(body).alias("body"))

    raw = landed("nation", "n", "n_nationkey", "n_name", "n_regionkey", "r").unionByName(landed("customer", "c", "c_custkey", "c_name", "c_nationkey", "n"))
    return bodies.parse_areas(raw)


@register(f"""SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN CAST({o.lat_text('c_custkey // 3')} AS DOUBLE) END lat,
    CASE WHEN c_custkey % 5 > 0 THEN CAST({o.lon_text('c_custkey // 3')} AS DOUBLE) END lon FROM customer""".replace("c_custkey // 3", "(c_custkey // 3)"))
def point_texts(spark, folder):
    """Coordinates of all customers from texts of maps, with a height, blanks, or a half that cannot be read."""
    k = F.expr("c_custkey div 3")
    lat = F.when(F.col("c_custkey") % 5 == 0, "north").otherwise(v._lat_text(k))
    point = F.concat(F.lit(" "), v._lon_text(k), F.lit(", "), lat, F.when(F.col("c_custkey") % 2 == 0, ",12.5").otherwise(""), F.lit(" "))
    lat, lon = geo.point_coords(point)
    return v.table(spark, folder, "customer").select("c_custkey", lat.alias("lat"), lon.alias("lon"))


@register("""SELECT CAST(p_partkey AS VARCHAR) track_key, p_size % 5 > 0 AS found, CASE WHEN p_size % 5 > 0 THEN p_name END matched_title, CASE WHEN p_size % 5 > 0 THEN p_size / 50.0::DOUBLE END energy,
    CASE WHEN p_size % 5 > 0 AND p_size % 7 > 0 THEN (p_partkey % 100) / 100.0::DOUBLE END valence, NULL danceability, CASE WHEN p_size % 5 > 0 THEN 60.0::DOUBLE + p_size END tempo, NULL acousticness,
    NULL instrumentalness, NULL liveness, NULL loudness, NULL speechiness, CASE WHEN p_size % 5 > 0 THEN p_size % 12 END AS key, CASE WHEN p_size % 5 > 0 THEN p_size % 2 END AS mode FROM part""")
def feature_entries(spark, folder):
    """Parts as feature responses, some of them not found and some without a value, as cache entries."""
    size, k = F.col("p_size"), F.col("p_partkey")
    body = F.struct((size / 50.0).alias("energy"), F.when(size % 7 > 0, (k % 100) / 100.0).alias("valence"), (F.lit(60.0) + size).alias("tempo"),
                    (size % 12).alias("key"), (size % 2).alias("mode"))
    status = F.when(size % 5 > 0, 200).otherwise(404)
    raw = v.table(spark, folder, "part").select(
        k.cast("string").alias("track_key"), F.col("p_name").alias("matched_title"), status.alias("http_status"),
        F.when(status == 200, F.to_json(body)).otherwise("not found").alias("body"))
    return bodies.parse_features(raw)


@register("""WITH a AS (SELECT event_id % 2 part, CAST(user_id AS VARCHAR) AS key, 1 + event_id % 3 r FROM events), w AS (SELECT DISTINCT key, key[-1:] = '7' AS never FROM a),
    runs AS (SELECT unnest([0, 1]) last)
  SELECT CAST(last + 1 AS INTEGER) run, (SELECT count(DISTINCT key) FROM a WHERE part <= last) done, (SELECT count(*) + count(*) FILTER (never) FROM w) total,
    (SELECT CAST(sum(r) AS BIGINT) FROM a WHERE part <= last) used, CASE WHEN (SELECT count(*) FILTER (never) FROM w) = 0 AND
      (SELECT count(DISTINCT key) FROM a WHERE part <= last) = (SELECT count(*) FROM w) THEN 'complete' ELSE 'landed' END reason FROM runs""")
def harvest_watch(spark, folder):
    """Events as answers that land in two halves: how far each run of the stream came, the second one continuing the first."""
    landing, out, resume = (scratch_path(spark, name) for name in ("answers", "harvest", "resume"))
    events = v.table(spark, folder, "events")
    user = F.col("user_id").cast("string")
    keys = materialize(events.select(user.alias("key")).distinct(), "keys")
    requested = keys.unionByName(keys.filter(F.col("key").endswith("7")).select(F.concat(F.lit("never "), "key").alias("key")))
    reports = []
    for run in (0, 1):
        answers = events.filter(F.col("event_id") % 2 == run).select(user.alias("key"), (1 + F.col("event_id") % 3).cast("bigint").alias("requests"))
        answers.write.mode("append").parquet(landing)
        reports.append((run + 1, *watching.follow_harvest(spark, landing, requested, out, resume, files_per_batch=4)))
    return spark.createDataFrame(reports, "run int, done bigint, total bigint, used bigint, reason string")
