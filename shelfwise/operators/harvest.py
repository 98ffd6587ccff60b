"""Harvest bookkeeping: progress, completed prefixes, batches under a budget, error streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.indexing import global_index

BATCH, BUDGET, TAB_ROWS, ERROR_STREAK = 50, 14_800, 14_000, 5
TITLE_CHARS = 200
LIKED = "Liked Songs"  # fixed value: name of the pseudo-playlist of liked tracks


def owned_units(playlists: DataFrame, user_id: str) -> DataFrame:
    """Playlists of the user; an unnamed one is named by its id."""
    name = F.coalesce(F.nullif("name", F.lit("")), F.col("id"))
    return playlists.filter((F.col("id") != "") & (F.col("owner") == user_id)).withColumn("name", name)


def units_to_fetch(units: DataFrame) -> DataFrame:
    """Units not known to be empty; an unknown total is fetched."""
    return units.filter(F.col("total").isNull() | (F.col("total") > 0))


def unit_progress(units: DataFrame, pages: DataFrame) -> DataFrame:
    """Per listed unit the next offset to ask for, and whether it is done: ``unit, offset, done``.

    ``units`` has ``unit`` and may have ``total``; ``pages`` (read ones only) has ``unit, page_offset,
    n_items, next``, an offset counting items. Pages count as far as each begins where the one before
    ended, so a refused or missing page leaves its unit open from there. A unit is done when
    its last counted page has no next one, or when it is known to be empty.
    """
    before = Window.partitionBy("unit").orderBy("page_offset")
    held = before.rowsBetween(Window.unboundedPreceding, -1)
    joined = F.col("page_offset") == F.coalesce(F.sum("n_items").over(held), F.lit(0))
    counted = pages.dropDuplicates(["unit", "page_offset"]).withColumn("_joined", joined).withColumn(
        "_joined", F.min("_joined").over(before)).filter("_joined")
    read = counted.groupBy("unit").agg(F.sum("n_items").alias("offset"), F.bool_or(F.col("next").isNull()).alias("done"))
    empty = F.col("total") == 0 if "total" in units.columns else F.lit(False)
    return units.join(read, "unit", "left").select(
        "unit", F.coalesce("offset", F.lit(0)).cast("bigint").alias("offset"),
        (F.coalesce("done", F.lit(False)) | F.coalesce(empty, F.lit(False))).alias("done"),
    )


def completed_prefix(units: DataFrame, rows: DataFrame, liked: DataFrame | None = None) -> DataFrame:
    """Rows of the units listed before the first unfinished one.

    ``units`` is the whole listing, with ``unit, ordinal, done``; ``rows`` has ``unit``. Liked rows follow only
    when no unit is unfinished and the liked unit itself is done (``liked`` has ``done``).
    """
    gap = units.filter(~F.coalesce("done", F.lit(False))).agg(F.min("ordinal").alias("gap"))
    complete = units.withColumn("_gap", gap.scalar()).filter(
        F.col("_gap").isNull() | (F.col("ordinal") < F.col("_gap"))
    )
    prefix = rows.join(complete.select("unit"), "unit", "left_semi")
    if liked is None:
        return prefix
    after_all = liked.withColumn("_gap", gap.scalar()).filter(F.col("_gap").isNull() & F.col("done"))
    return prefix.unionByName(after_all.select(*prefix.columns))


def snapshot_rows(rows: DataFrame, liked: DataFrame, playlist: str = "playlist") -> DataFrame:
    """Everything fetched so far, partial units included, then the liked tracks."""
    return rows.unionByName(liked.withColumn(playlist, F.lit(LIKED)).select(*rows.columns))


def plan_batches(
    pending: DataFrame, order: list[str], size: int = BATCH, budget: int = BUDGET, used: int = 0
) -> DataFrame:
    """Rows to send, with ``batch`` (from 0) and ``pos``, until a batch would pass the budget.

    The requests used before a batch follow from its number, so no running sum is needed.
    A request sends the first artist and the start of the title.
    """
    # Only rows that the budget may reach are sorted and numbered: a bounded number, in one task.
    sendable = pending.orderBy(*order).limit(max(0, budget - used))
    numbered = sendable.withColumn("_n", F.row_number().over(Window.orderBy(*order)) - 1)
    total = pending.agg(F.count("*").alias("n")).scalar()
    last = F.least((F.floor(F.col("_n") / size) + 1) * size, total)
    return numbered.filter(last + used <= budget).select(
        *pending.columns,
        F.floor(F.col("_n") / size).alias("batch"), (F.col("_n") % size).alias("pos"),
        F.substring("track", 1, TITLE_CHARS).alias("sent_track"),
        F.nullif(F.get(F.split("artist", ", "), F.lit(0)), F.lit("")).alias("sent_artist"),
    )


def with_tabs(rows: DataFrame, order: list[str], cap: int = TAB_ROWS) -> DataFrame:
    """Number of the capped tab each row belongs to, and its row inside the tab."""
    numbered = global_index(rows, order, "_n", start=0)
    return numbered.select(
        *rows.columns, (F.floor(F.col("_n") / cap) + 1).alias("tab"), (F.col("_n") % cap + 1).alias("tab_row")
    )


def coverage(requested: DataFrame, cache: DataFrame, key: str, stream: str, matched: str) -> DataFrame:
    """One row: cached and requested keys, floored percentage, and share of matches.

    ``matched`` is a boolean expression over the cache.
    """
    total = requested.select(F.col(key)).distinct().agg(F.count("*").alias("n")).scalar()
    done = F.count("*")
    return cache.agg(done.alias("done"), F.count_if(F.expr(matched)).alias("matched")).select(
        F.lit(stream).alias("stream"), "done", total.alias("total"), "matched",
        F.floor(F.try_divide(100 * F.col("done"), total)).alias("pct"),
        F.floor(100 * F.col("matched") / F.greatest("done", F.lit(1))).alias("match_pct"),
    )


def export_progress(units: DataFrame, progress: DataFrame) -> DataFrame:
    """Rows fetched and rows expected over all units; an unknown total counts as 0."""
    expected = units.agg(F.sum(F.coalesce("total", F.lit(0))).alias("n")).scalar()
    return progress.agg(F.coalesce(F.sum("offset"), F.lit(0)).alias("fetched")).select(
        "fetched", F.coalesce(expected, F.lit(0)).alias("expected")
    )


def gains(snapshots: DataFrame) -> DataFrame:
    """Runs that gained at least a point over the run before: ``stream, run, pct, gain``.

    One row per stream and run; the percentages of a cache only grow, so the value shown
    last is the value of the previous run.
    """
    before = F.lag("pct").over(Window.partitionBy("stream").orderBy("run"))
    return snapshots.withColumn("gain", F.col("pct") - before).filter("gain >= 1").select(
        "stream", "run", "pct", "gain"
    )


def pending_after_errors(requested: DataFrame, attempts: DataFrame, key: str) -> DataFrame:
    """Requested rows without a settled attempt; transient failures stay pending."""
    settled = attempts.filter("status <> 'transient'").select(key).distinct()
    return requested.join(settled, key, "left_anti")


def error_streaks(attempts: DataFrame, order: list[str], streak: int = ERROR_STREAK) -> DataFrame:
    """Unbroken runs of at least ``streak`` failures: ``first_idx, last_idx, length, stop_idx``.

    Numbering all attempts and the failures among them gives each run a constant
    difference, so runs become groups and no ordered scan is needed. ``stop_idx`` is where
    a harvest would have stopped.
    """
    numbered = global_index(attempts, order, "_idx")
    failed = global_index(numbered.filter("failed").select("_idx"), ["_idx"], "_nth")
    runs = failed.groupBy((F.col("_idx") - F.col("_nth")).alias("_run")).agg(
        F.min("_idx").alias("first_idx"), F.max("_idx").alias("last_idx"), F.count("*").alias("length")
    )
    return runs.filter(F.col("length") >= streak).select(
        "first_idx", "last_idx", "length", (F.col("first_idx") + streak - 1).alias("stop_idx")
    )


def track_playlists(rows: DataFrame) -> DataFrame:
    """Tracks found in more than one playlist: ``track_id, n_playlists``."""
    pairs = rows.select("track_id", "playlist").distinct()
    return pairs.groupBy("track_id").agg(F.count("*").alias("n_playlists")).filter("n_playlists > 1")


def multi_playlist_rows(rows: DataFrame) -> DataFrame:
    """All rows of tracks found in more than one playlist."""
    return rows.join(track_playlists(rows), "track_id")


def duplicate_names(rows: DataFrame) -> DataFrame:
    """Per track in several playlists, the distinct playlist names in first-seen order."""
    first = (
        rows.join(track_playlists(rows).select("track_id"), "track_id", "left_semi")
        .groupBy("track_id", "name").agg(F.min("ordinal").alias("ordinal"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("ordinal", "name")))
    return first.groupBy("track_id").agg(
        F.count("*").alias("n_names"), F.array_join(ordered["name"], ", ").alias("names")
    )


def orphan_ids(liked: DataFrame, rows: DataFrame) -> DataFrame:
    """Liked track ids that are in no playlist."""
    return liked.select("track_id").distinct().join(
        rows.select("track_id").distinct(), "track_id", "left_anti"
    )
