"""Duplicate files: groups by match key, quality ranks, quarantine lists, weak-tag targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numbers import number_or_zero
from shelfwise.functions.paths import contains_any, win_path
from shelfwise.functions.text import is_strong_dedup_key, is_weak_tag
from shelfwise.operators.catalog import keyed_files
from shelfwise.operators.indexing import MAX_GROUP_ROWS, global_index, grouped_rank
from shelfwise.session import materialize

KEY = ["na", "nt"]
# Path parts whose files are not fingerprint targets.
EXCLUDED_PARTS = ("_a_trier", "/radio/", "/downloads/")


def dedup_candidates(files: DataFrame) -> DataFrame:
    """Files whose key is strong enough to compare, with ``na`` and ``nt`` added."""
    return keyed_files(files).filter(is_strong_dedup_key(F.col("na"), F.col("nt")))


def duplicate_groups(files: DataFrame) -> DataFrame:
    """``group_id, na, nt, n_files`` for every key held by two files or more.

    Ids follow the order of the keys.
    """
    sizes = dedup_candidates(files).groupBy(*KEY).agg(F.count("*").alias("n_files"))
    return global_index(sizes.filter("n_files > 1"), KEY, "group_id")


def rank_duplicates(files: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Files of duplicate groups, best quality first; the first is kept.

    Quality is bit rate, then size (unreadable numbers count as 0), then input order, which must be
    unique. Files are counted and ranked on a 128-bit hash of their key; texts are fetched last, for
    members of groups only.
    """
    mark = [F.xxhash64(*KEY).alias("_h1"), F.xxhash64(F.lit(1), *KEY[::-1]).alias("_h2")]
    narrow = materialize(dedup_candidates(files).select(*mark, "ordinal"), "candidates")  # keys of all files are computed once
    shared = narrow.groupBy("_h1", "_h2").agg(F.count("*").alias("n")).filter("n > 1")
    known = narrow.join(shared, ["_h1", "_h2"]).select("ordinal")
    members = materialize(keyed_files(files.join(known, "ordinal")), "members")
    groups = duplicate_groups(members)
    order = [
        F.desc(number_or_zero(F.col("bitrate_kbps"))),
        F.desc(number_or_zero(F.col("size_bytes"))),
        F.asc("ordinal"),
    ]
    sizes = groups.select("group_id", F.col("n_files").alias("count"))
    ranked = grouped_rank(members.join(groups, KEY), ["group_id"], order, "rank", max_group_rows, sizes)
    action = F.when(F.col("rank") == 1, "keep").otherwise("candidate_removal")
    return ranked.withColumn("action", action).select(
        "group_id", "artist", "title", "rank", "action", "path",
        "bitrate_kbps", "size_bytes", "extension",
    )


def quarantine_paths(ranked: DataFrame) -> DataFrame:
    """Converted paths of the files proposed for removal."""
    return ranked.filter("action = 'candidate_removal'").select(
        "group_id", "rank", win_path(F.col("path")).alias("win_path")
    )


def duplicate_stats(files: DataFrame) -> DataFrame:
    """Files loaded, files skipped for a weak key, duplicate groups and files in them."""
    keyed = keyed_files(files).withColumn(
        "strong", is_strong_dedup_key(F.col("na"), F.col("nt"))
    )
    # Weak files need no key: blanking it keeps them from forming one large group.
    key = [F.when(F.col("strong"), F.col(c)).alias(c) for c in KEY]
    sizes = keyed.select("strong", *key).groupBy("strong", *KEY).agg(F.count("*").alias("n"))
    repeated = F.col("strong") & (F.col("n") > 1)
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_loaded"),
        F.coalesce(F.sum(F.when(~F.col("strong"), F.col("n"))), F.lit(0)).alias("n_skipped"),
        F.count_if(repeated).alias("n_groups"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("n_files"),
    )


def weak_tag_targets(files: DataFrame, excluded: tuple[str, ...] = EXCLUDED_PARTS) -> DataFrame:
    """Files whose raw tags are unusable, outside the excluded folders."""
    weak = is_weak_tag(F.col("artist"), F.col("title"))
    return files.filter(weak & ~contains_any(F.col("path"), list(excluded)))
