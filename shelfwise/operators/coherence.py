"""Playlist profiles, tracks that do not fit, feature outliers and better playlists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.indexing import top_k
from shelfwise.session import materialize

PROFILE_SIZE, MIN_ROWS, MIN_FEATURED = 12, 8, 15
Z_THRESHOLD, MIN_STD = 2.2, 0.05
MIN_SCORE, ENERGY_PENALTY = 0.3, 0.5
# Fixed value: names of playlists that are mixed on purpose (anchored at the start).
CATCHALL = r"^(20\d\d|Best-of|Discover|Backup|My Playlist|Mes titres Shazam|My Shazam|\.)"


def is_catchall(name: Column) -> Column:
    return name.rlike(CATCHALL)


def tag_frequency(rows: DataFrame) -> DataFrame:
    """Rows carrying each tag, per playlist: ``playlist, tag, df``.

    ``rows`` carries a ``tags`` array; counts are summed before the shuffle.
    """
    return rows.select("playlist", F.explode("tags").alias("tag")).groupBy("playlist", "tag").agg(
        F.count("*").alias("df")
    )


def playlist_facts(rows: DataFrame, min_featured: int = MIN_FEATURED) -> DataFrame:
    """Per playlist: rows, tagged rows and mean energy (null when too few are known)."""
    return rows.groupBy("playlist").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.size("tags") > 0).alias("n_tagged"),
        F.when(F.count("energy") >= min_featured, F.avg("energy")).alias("e_mean"),
    )


def profiled_rows(rows: DataFrame, facts: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rows of playlists large enough to be profiled."""
    return rows.join(facts.filter(F.col("n_rows") >= min_rows).select("playlist"), "playlist", "left_semi")


def profile_tags(frequency: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """The ``size`` most frequent tags per playlist, ties by name: ``playlist, tag, df, rank``."""
    return top_k(frequency, ["playlist"], [F.desc("df"), F.asc("tag")], size)


def profile_arrays(profile: DataFrame) -> DataFrame:
    """Profiles as one sorted array per playlist (at most the profile size)."""
    return profile.groupBy("playlist").agg(F.sort_array(F.collect_list("tag")).alias("profile"))


def misfits(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """Tagged rows that share no tag with their playlist's profile."""
    tagged = rows.filter(F.size("tags") > 0).join(profile_arrays(profile), "playlist")
    return tagged.filter(~F.arrays_overlap("tags", "profile"))


def aligned(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """Per playlist: tagged rows, misfits and the aligned percentage (null if none tagged)."""
    flagged = rows.join(profile_arrays(profile), "playlist", "left").select(
        "playlist",
        (F.size("tags") > 0).alias("tagged"),
        ((F.size("tags") > 0) & ~F.coalesce(F.arrays_overlap("tags", "profile"), F.lit(False))).alias("misfit"),
    )
    counted = flagged.groupBy("playlist").agg(
        F.count("*").alias("n_rows"), F.count_if("tagged").alias("n_tagged"), F.count_if("misfit").alias("n_misfits")
    )
    share = F.try_divide(F.lit(100.0) * (F.col("n_tagged") - F.col("n_misfits")), F.col("n_tagged"))
    return counted.withColumn("aligned_pct", share)


def coherence_summary(rows: DataFrame, profile: DataFrame, names: DataFrame, preview: int = 6) -> DataFrame:
    """One row per playlist: size, aligned percentage and a short profile (or its mark)."""
    tags = F.array_join(F.slice(F.coalesce("profile", F.array().cast("array<string>")), 1, preview), ", ")
    joined = (
        aligned(rows, profile).join(names.select("playlist", "name"), "playlist")
        .join(profile_arrays(profile), "playlist", "left")
    )
    catchall = is_catchall(F.col("name"))
    return joined.select(
        "playlist", "name", "n_rows", "aligned_pct", F.when(catchall, "fourre-tout").otherwise(tags).alias("profile")
    )


def least_coherent(summary: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` least aligned playlists; an unknown percentage counts as 100."""
    return summary.orderBy(F.coalesce("aligned_pct", F.lit(100.0)), "name").limit(n)


def feature_stats(
    rows: DataFrame, group: str = "playlist", features: tuple[str, ...] = ("energy", "valence"),
    min_featured: int = MIN_FEATURED, min_std: float = MIN_STD,
) -> DataFrame:
    """Mean and population deviation per group and feature, where both are meaningful."""
    stats = _unpivot(rows.select(group, *features), [group], features).groupBy(group, "feature").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )
    return stats.filter((F.col("n") >= min_featured) & (F.col("std") >= min_std))


def _unpivot(rows: DataFrame, ids: list[str], features: tuple[str, ...]) -> DataFrame:
    values = [F.col(f).cast("double").alias(f) for f in features]
    return (
        rows.select(*ids, *values).unpivot(ids, list(features), "feature", "value").filter("value IS NOT NULL")
    )


def z_outliers(
    rows: DataFrame, group: str = "playlist", ids: tuple[str, ...] = ("ordinal",),
    features: tuple[str, ...] = ("energy", "valence"), threshold: float = Z_THRESHOLD,
    min_featured: int = MIN_FEATURED, min_std: float = MIN_STD,
) -> DataFrame:
    """Rows whose feature is more than ``threshold`` deviations off their group's mean.

    Statistics are aggregated and joined back, so no group is held in one task; one row of them for each group, so rows move once.
    """
    stats = feature_stats(rows, group, features, min_featured, min_std)
    stats = stats.groupBy(group).agg(F.collect_list(F.struct("feature", "mean", "std")).alias("_stats"))
    values = rows.select(group, *ids, F.struct(*[F.col(f).cast("double").alias(f) for f in features]).alias("_values"))
    joined = values.join(materialize(stats, "stats"), group).select(group, *ids, "_values", F.explode("_stats").alias("_s"))
    value = F.coalesce(*[F.when(F.col("_s.feature") == f, F.col("_values")[f]) for f in features])
    z = (F.col("value") - F.col("mean")) / F.col("_s.std")
    return (
        joined.withColumns({"feature": F.col("_s.feature"), "value": value, "mean": F.col("_s.mean")}).withColumn("z", z).filter(F.abs("z") > threshold)
        .select(group, *ids, "feature", "value", "mean", "z")
    )


def _tagset(tags: Column) -> Column:
    return F.array_join(F.array_sort(tags), "\u0001")


def recommend(
    items: DataFrame, frequency: DataFrame, facts: DataFrame, min_score: float = MIN_SCORE,
    penalty: float = ENERGY_PENALTY,
) -> DataFrame:
    """Add ``recommended`` and ``score`` to items (``playlist, tags, energy, …``).

    ``frequency`` is the full tag table, ``facts`` has ``playlist, n_tagged, e_mean,
    catchall, pos``. A playlist scores the tag shares it has in common with the item, less
    up to the penalty for its energy distance; own and mixed playlists are left out, and
    the first playlist wins ties.

    Scores are computed per distinct tag set, then per (tag set, energy). The two best
    playlists of a pair suffice, since an item rules out only its own. Three exact bounds
    keep the candidates few. A set of k tags reaches the floor only with a playlist that
    gives one of them a k-th of it, so only such pairs are made, and their scores completed.
    The penalty only lowers a score, so a raw score under the floor is out. And means lie
    close together, so the penalties of two playlists differ by a bounded factor: a raw
    score further below the set's second best than that factor cannot be among the two.
    Only pairs within all bounds are stored.
    """
    keyed = items.withColumn("_text", _tagset(F.col("tags")))
    # Sets go by numbers until their advice is known.
    sets = materialize(keyed.select("_text", "tags").dropDuplicates(["_text"]).withColumn("_set", F.monotonically_increasing_id()), "sets")
    eligible = facts.filter(~F.col("catchall")).select(
        F.col("playlist").alias("_to"), F.greatest("n_tagged", F.lit(1)).alias("_n"), "e_mean", "pos"
    )
    wanted = materialize(keyed.select("_text", "energy").distinct().join(sets.select("_text", "_set"), "_text").select("_set", "energy"), "wanted")
    near = materialize(
        _near_pairs(sets.select("_set", "tags"), frequency, eligible, _penalty_bounds(wanted, eligible, penalty), min_score), "scores"
    )
    distance = F.abs(F.col("energy") - F.col("e_mean"))
    score = F.col("_raw") * F.coalesce(F.lit(1.0) - F.lit(penalty) * distance, F.lit(1.0))
    scored = wanted.join(near, "_set").withColumn("_score", score).filter(F.col("_score") >= min_score)
    two = top_k(scored, ["_set", "energy"], [F.desc("_score"), F.asc("pos")], 2, "_k")
    best = two.groupBy("_set", "energy").agg(
        F.sort_array(F.collect_list(F.struct("_k", "_to", "_score"))).alias("_two")
    ).join(sets.select("_set", "_text"), "_set").select(F.col("_text").alias("_text2"), F.col("energy").alias("_en2"), "_two")
    joined = keyed.join(
        materialize(best, "best"), (F.col("_text") == F.col("_text2")) & F.col("energy").eqNullSafe(F.col("_en2")), "left"
    )
    choice = F.get(F.filter("_two", lambda c: c["_to"] != F.col("playlist")), F.lit(0))
    return joined.withColumn("_best", choice).select(
        *items.columns, F.coalesce(F.col("_best._to").cast("string"), F.lit("")).alias("recommended"),
        F.col("_best._score").alias("score"),
    )


def _near_pairs(
    sets: DataFrame, frequency: DataFrame, eligible: DataFrame, bounds: DataFrame, min_score: float
) -> DataFrame:
    """Raw scores of the (tag set, playlist) pairs that can be among the two best of an energy."""
    weights = frequency.select(F.col("playlist").alias("_to"), "tag", "df").join(eligible.select("_to", "_n"), "_to")
    tags = sets.dropDuplicates(["_set"]).select("_set", F.size("tags").alias("_tags"), F.explode("tags").alias("tag"))
    slack = 1 - 1e-9  # sums of doubles round
    leading = (
        tags.join(weights, "tag").filter(F.col("df") * F.col("_tags") >= F.lit(min_score * slack) * F.col("_n"))
        .select("_set", "_to").distinct()
    )
    raw = (
        leading.join(tags, "_set").join(weights.select("_to", "tag", "df"), ["_to", "tag"])
        .groupBy("_set", "_to").agg(F.sum("df").alias("_df"))
        .join(eligible, "_to")
        .withColumn("_raw", F.col("_df") / F.col("_n"))
        .filter(F.col("_raw") >= min_score)
    )
    of_set = Window.partitionBy("_set")
    ranked = raw.withColumn("_k", F.row_number().over(of_set.orderBy(F.desc("_raw"), F.asc("_to"))))
    second = F.max(F.when(F.col("_k") == 2, F.col("_raw"))).over(of_set)
    keep = F.when(F.col("e_mean").isNull(), bounds.select("keep_flat").scalar()).otherwise(bounds.select("keep").scalar())
    return (
        ranked.withColumns({"_second": second, "_least": keep})
        .filter(F.col("_second").isNull() | (F.col("_raw") >= F.col("_least") * F.col("_second")))
        .select("_set", "_to", "_raw", "e_mean", "pos")
    )


def _penalty_bounds(wanted: DataFrame, eligible: DataFrame, penalty: float) -> DataFrame:
    """Least ratio of two playlists' energy factors for one item, as one row.

    With means in [lo, hi] the distances of an item to two means differ by hi - lo at most,
    and the nearer is at most ``far``. ``keep_flat`` bounds a playlist without a mean, whose
    factor is 1. A factor that could reach zero gives no bound.
    """
    means = eligible.agg(F.min("e_mean").alias("lo"), F.max("e_mean").alias("hi"))
    span = wanted.agg(F.min("energy").alias("e_lo"), F.max("energy").alias("e_hi"))
    one = means.select(
        "lo", "hi", span.select("e_lo").scalar().alias("e_lo"), span.select("e_hi").scalar().alias("e_hi")
    )
    width = F.coalesce(F.col("hi") - F.col("lo"), F.lit(0.0))
    far = F.coalesce(F.greatest(F.col("e_hi") - F.col("hi"), F.col("lo") - F.col("e_lo"), F.lit(0.0)), F.lit(0.0))
    nearest = F.lit(1.0) - penalty * far
    least = nearest - penalty * width
    usable = least > 0
    slack = 1 - 1e-9
    return one.select(
        F.when(usable, least / nearest * slack).otherwise(0.0).alias("keep"),
        F.when(usable, least * slack).otherwise(0.0).alias("keep_flat"),
    )


def with_catchall(facts: DataFrame, names: DataFrame) -> DataFrame:
    """Facts with the playlist's name, listing position and catch-all mark."""
    listed = names.select("playlist", "name", "pos")
    return facts.join(listed, "playlist").withColumn("catchall", is_catchall(F.col("name")))


def all_outliers(
    rows: DataFrame, names: DataFrame, profile_size: int = PROFILE_SIZE, min_rows: int = MIN_ROWS,
    min_featured: int = MIN_FEATURED, threshold: float = Z_THRESHOLD, min_score: float = MIN_SCORE,
) -> DataFrame:
    """Genre misfits (mixed playlists left out) and feature outliers, each with a better
    playlist: ``playlist, ordinal, kind, value, z, recommended, score``."""
    facts = materialize(
        with_catchall(playlist_facts(rows, min_featured), names).filter(F.col("n_rows") >= min_rows), "facts"
    )
    used = rows.select("playlist", "ordinal", "tags", "energy", "valence")
    kept = materialize(profiled_rows(used, facts, min_rows), "profiled")  # read by four steps
    frequency = materialize(tag_frequency(kept), "frequency")
    off_genre = (
        misfits(kept, profile_tags(frequency, profile_size))
        .join(facts.filter("catchall").select("playlist"), "playlist", "left_anti")
        .select(
            "playlist", "ordinal", "tags", "energy", F.lit("genre").alias("kind"),
            F.lit(None).cast("double").alias("value"), F.lit(None).cast("double").alias("z"),
        )
    )
    # Feature detection reads rows whose energy is known.
    featured = kept.filter("energy IS NOT NULL")
    off_feature = z_outliers(
        featured.withColumn("known_energy", F.col("energy")), ids=("ordinal", "tags", "known_energy"),
        threshold=threshold, min_featured=min_featured,
    )
    off_feature = off_feature.select(
        "playlist", "ordinal", "tags", F.col("known_energy").alias("energy"), F.col("feature").alias("kind"), "value", "z"
    )
    found = off_genre.unionByName(off_feature)
    return recommend(found, frequency, facts, min_score).drop("tags", "energy")
