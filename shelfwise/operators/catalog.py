"""The canonical tables: tracks, playlists, links, files, enrichment, and their status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numbers import safe_double, safe_long
from shelfwise.functions.text import blank_to_null, with_norm_key
from shelfwise.operators.indexing import bounded_broadcast, first_wins, last_wins, top_k, with_sequential_id
from shelfwise.session import materialize

KEY = ["na", "nt"]
# The names of the two origins, in order of precedence.
LIBRARY_ORIGIN, LOCAL_ORIGIN = "spotify", "local"

FILE_TEXT = ("filename", "extension", "artist", "title", "album", "album_artist", "year",
             "track_number", "tags_read")
FILE_LONG = ("size_bytes", "mtime", "bitrate_kbps", "sample_rate")
FEATURES = ("energy", "valence", "danceability", "tempo", "acousticness", "instrumentalness")
ENRICHED_TEXT = ("genres", "country", "mood", "camelot", "duration")


def _has_key() -> Column:
    return (F.col("na") != "") | (F.col("nt") != "")


def keyed_library(library: DataFrame) -> DataFrame:
    """The library with its match keys; already keyed input is taken as it is.

    Keys are computed once per distinct (artist, track); a written table on the right lets AQE
    split the rows of a frequent pair.
    """
    if set(KEY) <= set(library.columns):
        return library
    return with_pairs(library, norm_pairs(library))


def norm_pairs(library: DataFrame) -> DataFrame:
    """The distinct (artist, track) with their match keys, written."""
    return materialize(with_norm_key(library.select("artist", "track").distinct(), na="artist", nt="track"), "pairs")


def with_pairs(library: DataFrame, pairs: DataFrame) -> DataFrame:
    """The library with what ``pairs`` says of each (artist, track)."""
    pairs = pairs.withColumnsRenamed({"artist": "_artist", "track": "_track"})
    same = F.col("artist").eqNullSafe(F.col("_artist")) & F.col("track").eqNullSafe(F.col("_track"))
    return library.join(pairs, same).drop("_artist", "_track")


def first_pairs(library: DataFrame) -> DataFrame:
    """The first row of each (artist, track) with its match keys."""
    if set(KEY) <= set(library.columns):
        return library
    return with_norm_key(first_wins(library.select("artist", "track", "album", "ordinal"), ["artist", "track"]), na="artist", nt="track")


def key_marks() -> dict[str, Column]:
    """A 128-bit hash of the match key, to join and group on; null without a key."""
    return {
        "_h1": F.when(_has_key(), F.xxhash64(*KEY)),
        "_h2": F.when(_has_key(), F.xxhash64(F.lit(1), *KEY[::-1])),
    }


MARKS = ["_h1", "_h2"]


def marked(df: DataFrame) -> DataFrame:
    """Keyed rows with the hashes of their key; rows that carry them are taken as they are."""
    return df if set(MARKS) <= set(df.columns) else df.withColumns(key_marks())


def keyed_scan(files: DataFrame) -> DataFrame:
    """The file scan, written once with its match keys, their hashes and a number ``_row`` for each row."""
    if "_row" in files.columns:
        return files
    return materialize(marked(keyed_files(files)).withColumn("_row", F.monotonically_increasing_id()), "scan")


def keyed_files(files: DataFrame) -> DataFrame:
    """The file scan with its match keys; already keyed input is taken as it is."""
    return files if set(KEY) <= set(files.columns) else with_norm_key(files, na="artist", nt="title")


def canonical_tracks(library: DataFrame, files: DataFrame | None = None, marks: bool = False) -> DataFrame:
    """One row per (na, nt): first row wins, the library before the local files.

    Columns: id, artist, title, album, na, nt, origin, source_rank, ordinal; with ``marks`` the hashes of the key too.
    Winners are found and numbered by row numbers alone; texts are joined to them only when they are read.
    """

    def part(df: DataFrame, title: str, origin: str, rank: int) -> DataFrame:
        return marked(df).filter(_has_key()).select(
            *KEY, "artist", F.col(title).alias("title"), blank_to_null(F.col("album")).alias("album"),
            F.lit(origin).alias("origin"), F.lit(rank).alias("source_rank"), "ordinal", *MARKS, *[c for c in df.columns if c == "_row"],
        )

    rows = part(first_pairs(library), "track", LIBRARY_ORIGIN, 0).withColumn("_order", F.struct("source_rank", "ordinal"))
    rows = first_wins(rows, MARKS, "_order").drop("_order").withColumn("_row", -1 - F.monotonically_increasing_id())
    rows = materialize(rows, "library-rows")
    if files is not None:
        rows = rows.unionByName(part(keyed_scan(files), "title", LOCAL_ORIGIN, 1))
    won = rows.groupBy(*MARKS).agg(F.min(F.struct("source_rank", "ordinal", "_row")).alias("_won")).select("_won.*")
    numbered = with_sequential_id(won, ["source_rank", "ordinal"], "TRK", 6).select("_row", "id")
    tracks = rows.join(numbered, "_row").drop("_row")
    return tracks if marks else tracks.drop(*MARKS)


def playlists_table(library: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """One row per playlist name, numbered by first appearance, with its optional profile."""
    names = library.groupBy("playlist").agg(F.min("ordinal").alias("ordinal"))
    numbered = with_sequential_id(names, ["ordinal"], "PLS", 4).select(
        "id", F.col("playlist").alias("name"), F.lit(LIBRARY_ORIGIN).alias("source")
    )
    extra = ("theme", "main_genres", "main_artists", "energy", "valence")
    if profiles is None:
        return numbered.select("*", *[F.lit(None).cast("string").alias(c) for c in extra])
    latest = last_wins(profiles.select("playlist", *extra, "ordinal"), ["playlist"]).drop("ordinal")
    return numbered.join(latest.withColumnRenamed("playlist", "name"), "name", "left").select(
        "id", "name", "source", *extra
    )


def playlist_tracks(library: DataFrame, playlists: DataFrame, tracks: DataFrame) -> DataFrame:
    """Distinct (playlist_id, track_id) links.

    The track of each distinct (artist, track) is looked up first, so library rows move by a 128-bit hash of
    the two and become links where they meet it.
    """
    known = marked(tracks).select(*MARKS, F.col("id").alias("track_id"))
    if set(KEY) <= set(library.columns):
        named = marked(library).filter(_has_key()).select("playlist", *MARKS).distinct().join(known, MARKS).select("playlist", "track_id")
    else:
        given = [F.col("artist").isNull(), "artist", F.col("track").isNull(), "track"]
        pair = {"_p1": F.xxhash64(*given), "_p2": F.xxhash64(F.lit(1), *given[::-1])}
        found = marked(norm_pairs(library)).filter(_has_key()).join(known, MARKS).withColumns(pair).select(*pair, "track_id")
        found = materialize(found, "pair-tracks")
        named = library.withColumns(pair).select("playlist", *pair).join(found, [*pair]).select("playlist", "track_id").distinct()
    names = playlists.select(F.col("name").alias("playlist"), F.col("id").alias("playlist_id"))
    return named.join(bounded_broadcast(names, names.count()), "playlist").select("playlist_id", "track_id")


def enrichment_table(analysis: DataFrame, tracks: DataFrame) -> DataFrame:
    """First analysis row of each known track, numbers read with a guard."""
    keyed = with_norm_key(analysis, na="artist", nt="track").filter(_has_key())
    rows = keyed.select(
        *KEY, "ordinal",
        *[blank_to_null(F.col(c).cast("string")).alias(c) for c in ENRICHED_TEXT],
        *[safe_double(F.col(c).cast("string")).alias(c) for c in FEATURES],
    )
    return (
        first_wins(rows, KEY)
        .join(tracks.select(*KEY, F.col("id").alias("track_id")), KEY)
        .select("track_id", *ENRICHED_TEXT, *FEATURES)
    )


def match_files(files: DataFrame, tracks: DataFrame) -> DataFrame:
    """Attach every file to its track; adds ``track_id`` and ``match_class``.

    ``matched_library`` and ``matched_local`` found a track of that origin, ``created`` is
    the file that brought a new track, ``orphan`` has no usable key and joins nothing.
    """
    keyed = keyed_files(files)
    known = marked(tracks).select(
        "_h1", "_h2", F.col("id").alias("track_id"), "origin", F.col("ordinal").alias("_first")
    )
    # A file without a key has null marks, so orphans neither match nor pile up on one key.
    joinable = marked(keyed).drop(*KEY)
    created = (F.col("origin") == LOCAL_ORIGIN) & (F.col("ordinal") == F.col("_first"))
    match_class = (
        F.when(F.col("track_id").isNull(), "orphan")
        .when(F.col("origin") == LIBRARY_ORIGIN, "matched_library")
        .when(created, "created")
        .otherwise("matched_local")
    )
    return (
        joinable.join(known, ["_h1", "_h2"], "left")
        .withColumn("match_class", match_class)
        .drop("_first", "origin", "_h1", "_h2")
    )


def match_counts(matched: DataFrame) -> DataFrame:
    """One row: files per match class, and the combined "matched" figure."""
    count = {c: F.count_if(F.col("match_class") == c) for c in
             ("matched_library", "matched_local", "created", "orphan")}
    return matched.agg(
        F.count("*").alias("n_files"),
        *[expr.alias(name) for name, expr in count.items()],
        (count["matched_library"] + count["matched_local"]).alias("matched"),
    )


def files_table(matched: DataFrame) -> DataFrame:
    """One row per path (first wins), numbered densely, with typed columns.

    Paths are numbered by row numbers (``_row``) alone; the other columns are joined to them only when they are read.
    """
    if "_row" not in matched.columns:
        matched = materialize(matched.withColumn("_row", F.monotonically_increasing_id()), "matched")
    present = set(matched.columns)
    rows = matched.select(
        "_row", "path", "track_id",
        *[(F.col(c) if c in present else F.lit("")).cast("string").alias(c) for c in FILE_TEXT],
        *[safe_long((F.col(c) if c in present else F.lit(None)).cast("string")).alias(c) for c in FILE_LONG],
        safe_double((F.col("duration_sec") if "duration_sec" in present else F.lit(None)).cast("string"))
        .alias("duration_sec"),
    )
    first = F.min(F.struct(F.col("ordinal").isNull().alias("late"), "ordinal", "_row")).alias("_first")
    firsts = matched.groupBy("path").agg(first).select("_first.ordinal", "_first._row")
    numbered = with_sequential_id(firsts, ["ordinal"], "FIL", 6).select("_row", "id")
    return rows.join(numbered, "_row").select("id", *[c for c in rows.columns if c != "_row"])


def track_status(tracks: DataFrame, links: DataFrame, files: DataFrame) -> DataFrame:
    """Where each track exists: playlist and file counts, best bit rate, presence flags."""
    per_link = links.groupBy("track_id").agg(F.count("*").alias("n_playlists"))
    per_file = files.filter("track_id IS NOT NULL").groupBy("track_id").agg(
        F.count("*").alias("n_files"), F.max("bitrate_kbps").alias("best_bitrate")
    )
    joined = (
        tracks.select(F.col("id").alias("track_id"), "artist", "title", "album")
        .join(per_link, "track_id", "left")
        .join(per_file, "track_id", "left")
    )
    n_playlists = F.coalesce("n_playlists", F.lit(0))
    n_files = F.coalesce("n_files", F.lit(0))
    return joined.select(
        F.col("track_id").alias("id"), "artist", "title", "album",
        n_playlists.alias("n_playlists"), n_files.alias("n_files"), "best_bitrate",
        (n_playlists > 0).cast("int").alias("on_library"),
        (n_files > 0).cast("int").alias("on_local"),
    )


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def music_summary(
    status: DataFrame, playlists: DataFrame, files: DataFrame, enrichment: DataFrame
) -> DataFrame:
    """One row of totals over the built tables."""
    lib, loc = F.col("on_library") == 1, F.col("on_local") == 1
    tracks = status.agg(
        F.count("*").alias("tracks"),
        F.count_if(lib).alias("on_library"),
        F.count_if(loc).alias("on_local"),
        F.count_if(lib & loc).alias("on_both"),
        F.count_if(lib & ~loc).alias("library_only"),
        F.count_if(~lib & loc).alias("local_only"),
    )
    attached = files.agg(
        F.count("*").alias("files"), F.count_if(F.col("track_id").isNull()).alias("files_unattached")
    )
    return tracks.select(
        "*",
        _count(playlists, "n").scalar().alias("playlists"),
        attached.select("files").scalar().alias("files"),
        attached.select("files_unattached").scalar().alias("files_unattached"),
        _count(enrichment, "n").scalar().alias("enriched"),
    )


def import_counters(
    library: DataFrame, tracks: DataFrame, playlists: DataFrame, links: DataFrame,
    enrichment: DataFrame, matched: DataFrame,
) -> DataFrame:
    """Figures of one import; links are reported both as attempted and as kept."""
    attempts = keyed_library(library).filter(_has_key())
    return match_counts(matched).select(
        "*",
        _count(playlists, "n").scalar().alias("playlists"),
        _count(tracks.filter(F.col("origin") == LIBRARY_ORIGIN), "n").scalar().alias("library_tracks"),
        _count(attempts, "n").scalar().alias("links_attempted"),
        _count(links, "n").scalar().alias("links_kept"),
        _count(enrichment, "n").scalar().alias("enriched"),
    )


def library_dedup(library: DataFrame) -> DataFrame:
    """The library reduced to one row per (playlist, artist key, title key)."""
    first = [F.asc_nulls_last("ordinal")]
    if set(KEY) <= set(library.columns):
        return top_k(library, ["playlist", *KEY], first, 1, "_first").drop("_first", *KEY)
    # Rows carry the number of their key, not its texts.
    pairs = norm_pairs(library)
    numbers = materialize(pairs.select(*KEY).distinct().withColumn("_key", F.monotonically_increasing_id()), "keys")
    numbers = numbers.withColumnsRenamed({"na": "_na", "nt": "_nt"})
    same = F.col("na").eqNullSafe(F.col("_na")) & F.col("nt").eqNullSafe(F.col("_nt"))
    numbered = with_pairs(library, materialize(pairs.join(numbers, same).select("artist", "track", "_key"), "pairs"))
    return top_k(numbered, ["playlist", "_key"], first, 1, "_first").drop("_first", "_key")
