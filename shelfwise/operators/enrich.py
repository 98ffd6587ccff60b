"""Enrichment joins: tags, features by source priority, countries, and the analysis table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numbers import minutes_seconds, mood, round_even
from shelfwise.functions.text import norm_ws, strip, track_key
from shelfwise.operators.indexing import first_wins
from shelfwise.session import materialize

# Frequent tags that are not genres, and the shape of unusable tags.
TAG_BLACKLIST = (
    "seen live", "favorites", "favourites", "female vocalists", "male vocalists",
    "under 2000 listeners", "spotify", "french", "france", "british", "american",
    "usa", "uk", "german", "ninja tune", "all", "beautiful", "awesome", "love",
)
JUNK_TAG = r"[0-9_]|.{26,}"
STORED_TAGS, PROFILE_TAGS, GENRES = 12, 8, 3
ROUNDED = ("energy", "valence", "danceability", "acousticness", "instrumentalness")


def artist_names(library: DataFrame) -> DataFrame:
    """Distinct artist strings split into names: ``artist, pos, name, norm``.

    Lookups run on distinct strings, so a frequent artist costs the same as a rare one.
    """
    split = library.select("artist").distinct().select(
        "artist", F.posexplode(F.split("artist", ", ")).alias("pos", "name")
    )
    named = split.withColumn("name", strip(F.col("name"))).filter("name <> ''")
    return named.withColumn("norm", norm_ws(F.col("name")))


def unique_artists(library: DataFrame) -> DataFrame:
    """One row per normalised name with its first spelling: ``norm, artist, ordinal, pos``."""
    seen = library.groupBy("artist").agg(F.min("ordinal").alias("ordinal"))
    named = artist_names(library).join(seen, "artist")
    rows = named.select("norm", F.col("name").alias("artist"), "ordinal", "pos")
    return (
        first_wins(rows.withColumn("_order", F.struct("ordinal", "pos")), ["norm"], "_order")
        .drop("_order")
    )


def pending_work(
    requested: DataFrame, cache: DataFrame, key: str, limit: int = 0, order: str | list[str] = "ordinal"
) -> DataFrame:
    """Requested rows whose key is not cached, optionally only the first ``limit``."""
    todo = requested.join(cache.select(key).distinct(), key, "left_anti")
    return todo.orderBy(order).limit(limit) if limit else todo


def retry_misses(cache: DataFrame) -> DataFrame:
    """The cache without its misses, so that they are requested again."""
    return cache.filter(F.coalesce(F.col("found"), F.lit(False)))


def clip_tags(tags: Column, stored: int = STORED_TAGS) -> Column:
    """The stored prefix of a tag response: lower-case names, missing counts as 0."""
    return F.transform(
        F.slice(tags, 1, stored),
        lambda t: F.struct(
            F.lower(t["name"]).alias("name"), F.coalesce(t["count"], F.lit(0)).alias("count")
        ),
    )


def track_genres(
    library: DataFrame, tags: DataFrame, k: int = GENRES, blacklist: tuple[str, ...] = TAG_BLACKLIST
) -> DataFrame:
    """Per artist string, its ``k`` heaviest tags: ``artist, genres``.

    A tag's weight is its greatest count over the artists of the string; equal weights keep
    the order of artists, then of their tags. A string's tags are bounded by its own names.
    """
    rows = (
        artist_names(library)
        .join(tags.select("norm", "tags"), "norm")
        .select("artist", F.col("pos").alias("apos"), F.posexplode("tags").alias("tpos", "tag"))
        .filter(~F.col("tag.name").isin(*blacklist))
    )
    weights = rows.groupBy("artist", F.col("tag.name").alias("tag")).agg(
        F.max("tag.count").alias("weight"), F.min(F.struct("apos", "tpos")).alias("first")
    )
    ordered = F.sort_array(
        F.collect_list(F.struct((-F.col("weight")).alias("w"), "first", "tag"))
    )
    return weights.groupBy("artist").agg(
        F.array_join(F.slice(ordered, 1, k)["tag"], ", ").alias("genres")
    )


def track_tags(
    library: DataFrame, tags: DataFrame, per_artist: int = PROFILE_TAGS,
    blacklist: tuple[str, ...] = TAG_BLACKLIST,
) -> DataFrame:
    """Per artist string, the set of usable profile tags: ``artist, tags`` (sorted array)."""
    rows = (
        artist_names(library)
        .join(tags.select("norm", "tags"), "norm")
        .select("artist", F.explode(F.slice("tags", 1, per_artist)["name"]).alias("tag"))
        .filter(~F.col("tag").isin(*blacklist) & ~F.col("tag").rlike(JUNK_TAG))
    )
    return rows.groupBy("artist").agg(F.sort_array(F.collect_set("tag")).alias("tags"))


def with_features(rows: DataFrame, primary: DataFrame, secondary: DataFrame | None = None) -> DataFrame:
    """Add ``features``, the whole record of the first source that found the track.

    ``rows`` has ``track_key``. The primary source names the tempo ``bpm`` and adds key,
    duration and mood; the struct is null when neither source found the track.
    """
    null = F.lit(None)
    first = F.struct(
        *ROUNDED, F.col("bpm").alias("tempo"), "camelot", F.col("duration_ms").cast("bigint").alias("duration_ms"),
        "mood",
    )
    found = primary.filter("found").select("track_key", first.alias("_p"))
    out = rows.join(found, "track_key", "left")
    if secondary is None:
        return out.withColumn("features", F.col("_p")).drop("_p")
    second = F.struct(
        *ROUNDED, "tempo", null.cast("string").alias("camelot"), null.cast("bigint").alias("duration_ms"),
        null.cast("string").alias("mood"),
    )
    found = secondary.filter("found").select("track_key", second.alias("_s"))
    return (
        out.join(found, "track_key", "left")
        .withColumn("features", F.coalesce("_p", "_s"))
        .drop("_p", "_s")
    )


def analysis_table(
    library: DataFrame, tags: DataFrame, primary: DataFrame, secondary: DataFrame,
    countries: DataFrame,
) -> DataFrame:
    """One analysed row per library row: genres, country of the first artist, features."""
    pairs = library.select("artist", "track").distinct().withColumns({
        "track_key": track_key(F.col("artist"), F.col("track")),
        "_first": norm_ws(F.get(F.split("artist", ", "), F.lit(0))),
    })
    joined = (
        with_features(pairs, primary, secondary)
        .join(track_genres(library, tags), "artist", "left")
        .join(countries.select(F.col("norm").alias("_first"), "country"), "_first", "left")
    )
    f = F.col("features")
    own_mood = F.nullif(f["mood"], F.lit(""))
    found = materialize(joined.select(
        F.col("artist").alias("_artist"), F.col("track").alias("_track"),
        F.coalesce("genres", F.lit("")).alias("genres"),
        F.coalesce("country", F.lit("")).alias("country"),
        F.when(f.isNotNull(), F.coalesce(own_mood, mood(f["energy"], f["valence"])))
        .otherwise("").alias("mood"),
        *[round_even(f[c]).alias(c) for c in ROUNDED],
        F.when(f["tempo"] != 0, round_even(f["tempo"], 0)).cast("bigint").alias("tempo"),
        F.coalesce(f["camelot"], F.lit("")).alias("camelot"),
        F.coalesce(minutes_seconds(f["duration_ms"]), F.lit("")).alias("duration"),
        f.isNotNull().alias("found"),
    ), "analysed")
    # All lookups are done per distinct pair; the library's rows are moved once, to meet theirs.
    same = F.col("artist").eqNullSafe(F.col("_artist")) & F.col("track").eqNullSafe(F.col("_track"))
    return library.select("ordinal", "playlist", "artist", "track", "album").join(found, same).drop("_artist", "_track")


def build_coverage(analysis: DataFrame) -> DataFrame:
    """Rows built, rows with genres, rows with features."""
    return analysis.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("genres") != "").alias("n_genres"),
        F.count_if("found").alias("n_features"),
    )
