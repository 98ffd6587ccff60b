"""Matching: title variants against a catalogue, best recordings, code hierarchies, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numbers import round_even
from shelfwise.functions.text import norm_ws, strip, track_key
from shelfwise.operators.indexing import first_wins, last_wins
from shelfwise.operators.pointers import follow
from shelfwise.session import materialize

MIN_RECORDING_SCORE = 0.80


def title_variants(title: Column) -> Column:
    """The title, then cut before " - ", then before "(": distinct, in that order."""
    return F.array_distinct(F.array_compact(F.array(
        title,
        F.when(F.contains(title, F.lit(" - ")), F.substring_index(title, " - ", 1)),
        F.when(F.contains(title, F.lit("(")), strip(F.substring_index(title, "(", 1))),
    )))


def _names(artist: Column) -> Column:
    names = F.filter(F.split(artist, ", "), lambda a: strip(a) != "")
    return F.array_distinct(F.transform(names, norm_ws))


def _variants(library: DataFrame) -> DataFrame:
    tracks = library.select("artist", "track").distinct()
    return tracks.select(
        "*",
        track_key(F.col("artist"), F.col("track")).alias("track_key"),
        _names(F.col("artist")).alias("names"),
        norm_ws(F.col("track")).alias("full_title"),
        F.posexplode(title_variants(F.col("track"))).alias("variant_pos", "variant"),
    )


def pick_candidate(candidates: DataFrame) -> DataFrame:
    """Best candidate per track: earliest variant, then exact title, then position."""
    ordered = candidates.withColumn(
        "_order", F.struct("variant_pos", (~F.col("exact")).cast("int"), "cand_pos", "catalog_id")
    )
    picked = first_wins(ordered, ["track_key"], "_order")
    return picked.select("track_key", "catalog_id", "variant_pos", "exact")


def match_variants(library: DataFrame, catalog: DataFrame) -> DataFrame:
    """Match tracks with a catalogue (``catalog_id, title, artists, cand_pos``) by title
    variant and at least one common artist.

    The join key is (variant title, artist) and the catalogue is first reduced to its
    leading entry per key. Nothing is lost: all entries under one key are equally exact, so
    only the first can win. A title shared by very many entries thus never multiplies.
    """
    wanted = _variants(library).select(
        "track_key", "full_title", "variant_pos", norm_ws(F.col("variant")).alias("title_key"),
        F.explode("names").alias("name"),
    )
    entries = catalog.select(
        "catalog_id", "cand_pos", norm_ws(F.col("title")).alias("title_key"),
        F.explode(F.array_distinct(F.transform("artists", norm_ws))).alias("name"),
    )
    leading = first_wins(
        entries.withColumn("_order", F.struct("cand_pos", "catalog_id")), ["title_key", "name"], "_order"
    ).drop("_order")
    hits = wanted.join(leading, ["title_key", "name"])
    return pick_candidate(hits.withColumn("exact", F.col("title_key") == F.col("full_title")))


def match_candidates(library: DataFrame, candidates: DataFrame) -> DataFrame:
    """As ``match_variants`` for harvested search results, one row per candidate:
    ``track_key, variant_pos, cand_pos, catalog_id, title, artists``."""
    tracks = library.select("artist", "track").distinct().select(
        track_key(F.col("artist"), F.col("track")).alias("track_key"),
        _names(F.col("artist")).alias("names"),
        norm_ws(F.col("track")).alias("full_title"),
    ).dropDuplicates(["track_key"])
    names = F.transform("artists", norm_ws)
    hits = candidates.join(tracks, "track_key").filter(F.arrays_overlap(F.col("names"), names))
    exact = norm_ws(F.coalesce(F.col("title"), F.lit(""))) == F.col("full_title")
    return pick_candidate(hits.withColumn("exact", exact))


def best_recording(responses: DataFrame, min_score: float = MIN_RECORDING_SCORE) -> DataFrame:
    """Best recording of each fingerprint response (``path, response``), row by row.

    The highest score wins, the first one on ties; recordings need a title and artists. The
    album is the first titled release group of type "Album", else the first group's title.
    """
    r = F.col("response")
    usable = lambda rec: (F.coalesce(rec["title"], F.lit("")) != "") & (F.size(rec["artists"]) > 0)
    candidates = F.flatten(F.transform(
        F.coalesce(r["results"], F.array().cast(_result_type(responses))),
        lambda res, i: F.transform(
            F.filter(F.coalesce(res["recordings"], F.array().cast(_recording_type(responses))), usable),
            lambda rec, j: F.struct(
                F.coalesce(res["score"], F.lit(0.0)).alias("score"), (-i).alias("i"), (-j).alias("j"),
                rec.alias("rec"),
            ),
        ),
    ))
    best = responses.withColumn("_best", F.array_max(candidates))
    rec = F.col("_best.rec")
    groups = rec["releasegroups"]
    albums = F.filter(
        groups, lambda g: (g["type"] == "Album") & (F.coalesce(g["title"], F.lit("")) != "")
    )
    score = round_even(F.col("_best.score"), 3)
    status = (
        F.when(F.coalesce(r["status"], F.lit("")) != "ok", "error")
        .when(F.col("_best").isNull(), "nomatch")
        .when(score < min_score, "low_score")
        .otherwise("ok")
    )
    answered = status.isin("ok", "low_score")
    tagged = lambda value: F.when(answered, value)
    return best.select(
        "path", status.alias("status"), tagged(score).alias("score"),
        tagged(F.array_join(rec["artists"]["name"], ", ")).alias("artist"),
        tagged(rec["title"]).alias("title"),
        tagged(F.coalesce(F.get(albums, F.lit(0))["title"], F.get(groups, F.lit(0))["title"], F.lit("")))
        .alias("album"),
        tagged(F.coalesce(rec["id"], F.lit(""))).alias("mbid"),
    )


def _result_type(responses: DataFrame):
    return responses.schema["response"].dataType["results"].dataType


def _recording_type(responses: DataFrame):
    return _result_type(responses).elementType["recordings"].dataType


def missing_files(targets: DataFrame, listing: DataFrame) -> DataFrame:
    """Targets that left the disk since the scan, as cache rows with status "missing"."""
    return targets.select("path").join(listing.select("path"), "path", "left_anti").withColumn(
        "status", F.lit("missing")
    )


def retag_plan(results: DataFrame, files: DataFrame) -> DataFrame:
    """Old and new tags side by side for every cached path (last scanned row per path)."""
    scanned = last_wins(files.select("path", "artist", "title", "ordinal"), ["path"]).select(
        "path", F.col("artist").alias("old_artist"), F.col("title").alias("old_title")
    )
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return results.join(scanned, "path", "left").select(
        "path", blank("old_artist").alias("old_artist"), blank("old_title").alias("old_title"),
        blank("artist").alias("new_artist"), blank("title").alias("new_title"),
        blank("album").alias("new_album"), "score", blank("mbid").alias("mbid"), "status",
    )


def retag_counts(plan: DataFrame) -> DataFrame:
    """Identified, without a reliable match, and failed or missing."""
    ok = F.col("status") == "ok"
    unsure = F.col("status").isin("nomatch", "low_score")
    return plan.agg(
        F.count_if(ok).alias("identified"), F.count_if(unsure).alias("unreliable"),
        F.count_if(~ok & ~unsure).alias("failed"),
    )


def resolve_codes(nodes: DataFrame) -> DataFrame:
    """Nearest code on the way up a hierarchy: ``id, code, parent`` to ``id, code``.

    The nodes are written once, narrow; beyond that only open nodes that others go through are
    (``pointers.follow``). Cycles and dead ends give "".
    """
    given = F.nullif("code", F.lit(""))
    table = materialize(nodes.select("id", given.alias("code"), F.when(given.isNull(), F.col("parent")).alias("parent")), "codes")
    codes = table.filter("code IS NOT NULL").select(F.col("id").alias("root"), "code")
    found = follow(table).join(codes, "root", "left").select("id", "code")
    return found.unionByName(table.filter("parent IS NULL").select("id", "code")).select(
        "id", F.coalesce("code", F.lit("")).alias("code")
    )


def zip_batches(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """The i-th result of a batch belongs to its i-th request: ``batch, pos`` (from 0)."""
    results = responses.select("batch", F.posexplode("results").alias("pos", "result"))
    return requests.join(results, ["batch", "pos"])
