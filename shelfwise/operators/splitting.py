"""Splitting oversized playlists into themed volumes of a fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.numbers import round_even
from shelfwise.operators.coherence import tag_frequency
from shelfwise.operators.indexing import MAX_GROUP_ROWS, grouped_rank, top_k
from shelfwise.session import materialize

MIN_PLAYLIST, VOLUME, MIN_GROUP, MINUTES_PER_TRACK = 120, 37, 12, 4
MAX_SHARE, MIN_SHARE, CANDIDATES = 0.6, 0.08, 8
REST = "divers"
# Fixed value: dated archives and collection pools that are never split (found anywhere).
EXCLUDED = r"\b(19|20)\d\d\b|^(Backup|My Playlist|Mes titres Shazam|My Shazam|\.)"


def is_excluded(name: Column) -> Column:
    return name.rlike(EXCLUDED)


def large_playlists(rows: DataFrame, names: DataFrame, min_rows: int = MIN_PLAYLIST) -> DataFrame:
    """Playlists to split: ``playlist, name, n``."""
    sizes = rows.groupBy("playlist").agg(F.count("*").alias("n")).filter(F.col("n") >= min_rows)
    return sizes.join(names.select("playlist", "name"), "playlist").filter(~is_excluded(F.col("name")))


def candidate_tags(
    rows: DataFrame, large: DataFrame, min_group: int = MIN_GROUP, max_share: float = MAX_SHARE,
    min_share: float = MIN_SHARE, k: int = CANDIDATES,
) -> DataFrame:
    """Up to ``k`` discriminating tags per playlist: neither near-universal nor rare."""
    n, df = F.col("n"), F.col("df")
    frequency = tag_frequency(rows).join(large.select("playlist", "n"), "playlist")
    fit = frequency.filter((df <= max_share * n) & (df >= F.greatest(F.lit(float(min_group)), min_share * n)))
    return top_k(fit, ["playlist"], [F.desc("df"), F.asc("tag")], k)


def assign_groups(
    rows: DataFrame, large: DataFrame, candidates: DataFrame, min_group: int = MIN_GROUP
) -> DataFrame:
    """Rows of the playlists to split with their ``theme`` and its ``theme_rows``.

    A row takes its first candidate tag; groups that stay too small join the rest.
    """
    ordered = candidates.groupBy("playlist").agg(
        F.sort_array(F.collect_list(F.struct("rank", "tag")))["tag"].alias("_cands")
    )
    chosen = F.get(F.filter("_cands", lambda c: F.array_contains(F.col("tags"), c)), F.lit(0))
    first = (
        rows.join(large, "playlist").join(ordered, "playlist", "left")
        .withColumn("_dest", F.coalesce(chosen, F.lit(REST))).drop("_cands")
    )
    sizes = first.groupBy("playlist", "_dest").agg(F.count("*").alias("_size"))
    theme = F.when(F.col("_size") < min_group, REST).otherwise(F.col("_dest"))
    folded = sizes.withColumn("theme", theme)
    totals = folded.groupBy("playlist", "theme").agg(F.sum("_size").alias("theme_rows"))
    routed = folded.join(totals, ["playlist", "theme"]).select("playlist", "_dest", "theme", "theme_rows")
    return first.join(routed, ["playlist", "_dest"]).drop("_dest")


def split_detail(
    rows: DataFrame, names: DataFrame, volume: int = VOLUME, min_rows: int = MIN_PLAYLIST,
    min_group: int = MIN_GROUP, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Every row of a large playlist with its sub-playlist: rising energy, unknown last.

    A theme is ranked once and cut into volumes; only themes longer than one volume carry
    a volume number in their name.
    """
    large = large_playlists(rows, names, min_rows)
    themed = materialize(
        assign_groups(rows, large, candidate_tags(rows, large, min_group), min_group), "themed"
    )
    sizes = themed.groupBy("playlist", "theme").count()
    ranked = grouped_rank(
        themed, ["playlist", "theme"], [F.asc_nulls_last("energy"), F.asc("ordinal")], "_pos",
        max_group_rows, sizes,
    )
    number = F.floor((F.col("_pos") - 1) / volume) + 1
    title = F.concat(
        F.col("name"), F.lit(" — "), F.col("theme"),
        F.when(F.col("theme_rows") > volume, F.format_string(" (Vol. %d)", F.col("volume"))).otherwise(""),
    )
    return ranked.withColumn("volume", number).select(
        "playlist", "name", F.col("n").alias("playlist_rows"), "theme", "theme_rows", "volume",
        title.alias("sub_playlist"), F.col("_pos").alias("position"), "ordinal", "artist", "track", "album",
        round_even(F.col("energy")).alias("energy"),
    )


def split_plan(detail: DataFrame, minutes: int = MINUTES_PER_TRACK, top: int = 3) -> DataFrame:
    """One row per sub-playlist: size, estimated minutes and its most frequent artists.

    Artists are counted per volume, so the list per row is bounded by the volume size.
    """
    volume = ["playlist", "name", "playlist_rows", "theme", "volume", "sub_playlist"]
    artists = detail.groupBy(*volume, "artist").agg(
        F.count("*").alias("c"), F.min("position").alias("first")
    )
    leading = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("c"), "first", "artist"))), 1, top)
    return artists.groupBy(*volume).agg(
        F.sum("c").alias("tracks"),
        (F.sum("c") * minutes).alias("minutes"),
        F.array_join(leading["artist"], ", ").alias("top_artists"),
    )


def plan_order(plan: DataFrame) -> DataFrame:
    """The plan with ``theme_rows`` and ``place``: a playlist's larger themes first, then by theme and volume."""
    whole = Window.partitionBy("playlist", "theme")
    sized = plan.withColumn("theme_rows", F.sum("tracks").over(whole))
    order = Window.partitionBy("playlist").orderBy(F.desc("theme_rows"), "theme", "volume")
    return sized.withColumn("place", F.row_number().over(order))
