"""Places: occurrences from maps and saved lists, consolidation, status and inventories."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.geo import geohash, join_note, place_keys
from shelfwise.functions.text import norm_place
from shelfwise.operators.identity import resolve_ids, resolve_single_ids
from shelfwise.operators.indexing import first_wins
from shelfwise.session import materialize

# Kinds of ids with their widths, labels of unnamed things, default status.
PLACE_KIND, PLACE_WIDTH, LIST_KIND, LIST_WIDTH = "PLC", 6, "PLL", 4
NO_NAME, NO_LAYER, VALIDATED = "(sans nom)", "(sans calque)", "VALIDATED"


class Places(NamedTuple):
    """Built tables, the registry entries to append per kind, and merge counts."""

    places: DataFrame
    lists: DataFrame
    list_places: DataFrame
    refs: DataFrame
    new_place_keys: DataFrame
    new_list_keys: DataFrame
    occurrences: DataFrame


def map_occurrences(maps: DataFrame) -> DataFrame:
    """Point placemarks of maps as place occurrences (tracks are left out)."""
    return maps.filter("geometry = 'Point'").select(
        F.struct(F.lit(0).alias("source"), "path", F.col("layer_pos").cast("int").alias("part"),
                 F.col("pos").cast("bigint").alias("row")).alias("ordinal"),
        "name", "lat", "lon", F.lit(None).cast("string").alias("reference"),
        F.nullif("description", F.lit("")).alias("description"), F.lit(None).cast("string").alias("url"),
        F.lit("my_maps").alias("origin"), "source_file",
        F.when(F.size("extended") > 0, F.to_json("extended")).alias("extra"),
        F.concat(F.lit("my_maps:"), "map", F.lit("/"), "layer").alias("list_scope"),
        F.concat(F.lit("my_maps:"), "map", F.lit("/"), _layer_name()).alias("list_key"),
        F.nullif("description", F.lit("")).alias("note"), F.lit(None).cast("string").alias("tags"),
    )


def saved_occurrences(saved: DataFrame) -> DataFrame:
    """Rows of saved lists as place occurrences."""
    return saved.select(
        F.struct(F.lit(1).alias("source"), "path", F.lit(0).alias("part"),
                 F.col("pos").cast("bigint").alias("row")).alias("ordinal"),
        F.col("title").alias("name"), "lat", "lon", F.col("cid").alias("reference"),
        F.lit(None).cast("string").alias("description"), F.nullif("url", F.lit("")).alias("url"),
        F.lit("saved").alias("origin"), "source_file", F.lit(None).cast("string").alias("extra"),
        F.concat(F.lit("saved:"), "list").alias("list_scope"),
        F.concat(F.lit("saved:/"), "list").alias("list_key"),
        join_note(F.col("note"), F.col("comment")).alias("note"), F.nullif("tags", F.lit("")).alias("tags"),
    )


def _layer_name():
    return F.coalesce(F.nullif("layer", F.lit("")), F.lit(NO_LAYER))


def map_lists(maps: DataFrame) -> DataFrame:
    """One row per layer in reading order, empty ones included: the lists of the maps."""
    return maps.groupBy("path", "layer_pos", "map", "layer", "source_file").agg(F.count("*").alias("_n")).select(
        F.struct(F.lit(0).alias("source"), "path", F.col("layer_pos").cast("int").alias("part"),
                 F.lit(0).cast("bigint").alias("row")).alias("ordinal"),
        _layer_name().alias("name"), F.col("map").alias("map_name"), F.lit("my_maps").alias("type"), "source_file",
        F.concat(F.lit("my_maps:"), "map", F.lit("/"), _layer_name()).alias("list_key"),
    )


def saved_lists(saved: DataFrame) -> DataFrame:
    return saved.groupBy("path", "list", "source_file").agg(F.count("*").alias("_n")).select(
        F.struct(F.lit(1).alias("source"), "path", F.lit(0).alias("part"),
                 F.lit(0).cast("bigint").alias("row")).alias("ordinal"),
        F.col("list").alias("name"), F.lit(None).cast("string").alias("map_name"), F.lit("saved").alias("type"),
        "source_file", F.concat(F.lit("saved:/"), "list").alias("list_key"),
    )


def build_places(
    occurrences: DataFrame, lists: DataFrame, place_registry: DataFrame, list_registry: DataFrame,
    place_counter: int = 0, list_counter: int = 0, backfill: bool = False,
) -> Places:
    """Consolidate occurrences and lists into tables with registry ids.

    The first occurrence of a place supplies its attributes; its coordinates stay unknown
    if that one had none, unless ``backfill`` takes the first known pair.
    """
    keyed = occurrences.withColumn(
        "keys", place_keys(F.col("name"), F.col("lat"), F.col("lon"), F.col("reference"), F.col("list_scope"))
    )
    keyed = materialize(keyed, "occurrences")
    seen, new_places = resolve_ids(keyed, place_registry, PLACE_KIND, PLACE_WIDTH, place_counter)
    seen = materialize(seen, "places")  # read by four tables
    listed, new_lists = resolve_single_ids(
        lists, "list_key", list_registry, LIST_KIND, LIST_WIDTH, list_counter
    )

    attributes = ["name", "lat", "lon", "description", "url", "origin", "source_file", "extra"]
    first = first_wins(seen.select("id", "ordinal", *attributes), ["id"])
    if backfill:
        located = first_wins(
            seen.filter("lat IS NOT NULL").select("id", "ordinal", F.col("lat").alias("_lat"), F.col("lon").alias("_lon")),
            ["id"],
        ).drop("ordinal")
        first = first.join(located, "id", "left").withColumns(
            {"lat": F.coalesce("lat", "_lat"), "lon": F.coalesce("lon", "_lon")}
        )
    places = first.select(
        "id", F.coalesce(F.nullif("name", F.lit("")), F.lit(NO_NAME)).alias("name"),
        norm_place(F.col("name")).alias("norm_name"), "lat", "lon",
        geohash(F.col("lat"), F.col("lon")).alias("geohash"), "description", "url",
        F.lit(VALIDATED).alias("status"), "origin", "source_file", "extra",
    )
    list_rows = first_wins(listed.select("id", "ordinal", "name", "map_name", "type", "source_file"), ["id"])
    list_ids = listed.select("list_key", F.col("id").alias("list_id")).distinct()
    # Reduce to one row per (list, place) before list ids are attached.
    links = first_wins(
        seen.select("list_key", F.col("id").alias("place_id"), "ordinal", "note", "tags"),
        ["list_key", "place_id"],
    )
    list_places = first_wins(
        links.join(list_ids, "list_key").select("list_id", "place_id", "ordinal", "note", "tags"),
        ["list_id", "place_id"],
    ).drop("ordinal")
    refs = first_wins(
        seen.filter("reference IS NOT NULL").select(
            F.col("id").alias("place_id"), F.lit("google").alias("platform"),
            F.col("reference").alias("external_id"), "ordinal",
        ),
        ["place_id", "platform"],
    ).drop("ordinal")
    return Places(places, list_rows.drop("ordinal"), list_places, refs, new_places, new_lists, seen)


def place_counters(built: Places) -> DataFrame:
    """Occurrences, merges (occurrences beyond the first per place) and ids made."""
    return built.occurrences.groupBy("id").agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("occurrences"), F.sum(F.col("n") - 1).alias("merged")
    ).select(
        "*",
        built.new_place_keys.agg(F.count_if("is_new").alias("n")).scalar().alias("new_places"),
        built.new_list_keys.agg(F.count_if("is_new").alias("n")).scalar().alias("new_lists"),
    )


def place_status(places: DataFrame, list_places: DataFrame) -> DataFrame:
    """Number of lists per place and whether its coordinates are known."""
    per_place = list_places.groupBy(F.col("place_id").alias("id")).agg(F.count("*").alias("n_lists"))
    return places.join(per_place, "id", "left").select(
        "id", "name", "origin", F.coalesce("n_lists", F.lit(0)).alias("n_lists"),
        F.col("lat").isNotNull().cast("int").alias("resolved"),
    )


def places_summary(places: DataFrame, lists: DataFrame, list_places: DataFrame, refs: DataFrame) -> DataFrame:
    """One row of totals over the built tables."""
    status = place_status(places, list_places).agg(
        F.count("*").alias("places"),
        F.count_if(F.col("resolved") == 1).alias("resolved"),
        F.count_if(F.col("resolved") == 0).alias("unresolved"),
        F.count_if(F.col("n_lists") > 1).alias("in_several_lists"),
    )
    kinds = lists.agg(
        F.count("*").alias("lists"), F.count_if(F.col("type") == "my_maps").alias("map_lists"),
        F.count_if(F.col("type") == "saved").alias("saved_lists"),
    )
    return status.select(
        "*",
        *[kinds.select(c).scalar().alias(c) for c in ("lists", "map_lists", "saved_lists")],
        list_places.agg(F.count("*").alias("n")).scalar().alias("links"),
        refs.agg(F.count("*").alias("n")).scalar().alias("refs"),
    )


def inventory_maps(maps: DataFrame) -> DataFrame:
    """Per map, and in total (``map`` null): points, tracks, unnamed; layers with sizes."""
    is_point = F.coalesce(F.col("geometry") == "Point", F.lit(False))
    placemark = F.col("pos").isNotNull()
    layers = (
        maps.groupBy("map", "path", "layer_pos", "layer")
        .agg(
            F.count_if(placemark).alias("n"), F.count_if(placemark & is_point).alias("points"),
            F.count_if(placemark & ~is_point).alias("tracks"),
            F.count_if(placemark & (F.coalesce("name", F.lit("")) == "")).alias("unnamed"),
        )
    )
    text = F.concat(_layer_name(), F.lit(":"), F.col("n"))
    per_map = layers.groupBy("map", "path").agg(
        *[F.sum(c).alias(c) for c in ("points", "tracks", "unnamed")],
        F.array_join(F.sort_array(F.collect_list(F.struct("layer_pos", text.alias("t"))))["t"], ", ").alias("layers"),
    )
    total = layers.agg(
        F.lit(None).cast("string").alias("map"), F.lit(None).cast("string").alias("path"),
        *[F.sum(c).alias(c) for c in ("points", "tracks", "unnamed")], F.lit(None).cast("string").alias("layers"),
    )
    return per_map.unionByName(total)


def inventory_lists(saved: DataFrame) -> DataFrame:
    """Per list, and in total (``list`` null): rows with coordinates, a reference, or only a name."""
    located = F.col("lat").isNotNull()
    referenced = ~located & F.col("cid").isNotNull()
    return saved.rollup("list").agg(
        F.count("*").alias("n_rows"), F.count_if(located).alias("with_coords"),
        F.count_if(referenced).alias("reference_only"), F.count_if(~located & ~referenced).alias("name_only"),
    )
