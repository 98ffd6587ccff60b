"""Listening history: rankings of albums and artists by hours played."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numbers import hours

MIN_MS_PLAYED = 30_000


def real_plays(history: DataFrame, min_ms: int = MIN_MS_PLAYED) -> DataFrame:
    """Plays long enough to count and with a known artist."""
    return history.filter((F.col("ms_played") >= min_ms) & F.col("artist").isNotNull())


def album_ranking(history: DataFrame, min_ms: int = MIN_MS_PLAYED) -> DataFrame:
    """Plays, hours, distinct tracks, first and last play per (artist, album)."""
    plays = real_plays(history, min_ms).filter(F.col("album").isNotNull())
    # Reduce to one row per track first: the distinct count is then a plain sum, and one
    # heavily played album is spread over its tracks in the first shuffle.
    by_track = plays.groupBy("artist", "album", "track").agg(
        F.count("*").alias("plays"),
        F.sum("ms_played").alias("ms"),
        F.min("ts").alias("first_played"),
        F.max("ts").alias("last_played"),
    )
    return by_track.groupBy("artist", "album").agg(
        F.sum("plays").alias("plays"),
        hours(F.sum("ms")).alias("hours_played"),
        F.count("track").alias("distinct_tracks"),
        F.min("first_played").alias("first_played"),
        F.max("last_played").alias("last_played"),
    )


def artist_ranking(history: DataFrame, min_ms: int = MIN_MS_PLAYED) -> DataFrame:
    """Plays, hours and distinct albums per artist."""
    by_album = (
        real_plays(history, min_ms)
        .groupBy("artist", "album")
        .agg(F.count("*").alias("plays"), F.sum("ms_played").alias("ms"))
    )
    return by_album.groupBy("artist").agg(
        F.sum("plays").alias("plays"),
        hours(F.sum("ms")).alias("hours_played"),
        F.count("album").alias("distinct_albums"),
    )


def top_by_hours(ranking: DataFrame, n: int = 30) -> DataFrame:
    names = [c for c in ("artist", "album") if c in ranking.columns]
    return ranking.orderBy(F.desc("hours_played"), *names).limit(n)


def history_span(history: DataFrame, min_ms: int = MIN_MS_PLAYED) -> DataFrame:
    """Number of analysed plays with the first and last time stamp."""
    return real_plays(history, min_ms).agg(
        F.count("*").alias("plays"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
