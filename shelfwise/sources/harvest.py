"""Harvested API bodies as rows: tables of raw payloads in, parsed columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.enrich import clip_tags

_TRACK = "struct<id:string,name:string,artists:array<struct<name:string>>,album:struct<name:string>>"
PAGE_SCHEMA = (
    f"items array<struct<track:{_TRACK},item:{_TRACK},episode:{_TRACK}>>, next string, total bigint"
)
PLAYLISTS_SCHEMA = (
    "items array<struct<id:string,name:string,owner:struct<id:string>,tracks:struct<total:bigint>>>, next string"
)
TAGS_SCHEMA = "toptags struct<tag:array<struct<name:string,count:bigint>>>, error string"
COUNTRY_SCHEMA = (
    "artists array<struct<score:bigint,country:string,area:struct<id:string,name:string>>>"
)
AREA_SCHEMA = (
    "id string, `iso-3166-1-codes` array<string>, "
    "relations array<struct<type:string,direction:string,area:struct<id:string>>>"
)
FEATURES_SCHEMA = (
    "energy double, valence double, danceability double, tempo double, acousticness double, "
    "instrumentalness double, liveness double, loudness double, speechiness double, key int, mode int"
)
BULK_RESULT = (
    "struct<found:boolean,result:struct<track_name:string,artist_name:string,isrc:string,mbid:string,"
    "release_date:string,duration_ms:bigint,bpm:double,key:string,camelot:string,open_key:string,mode:string,"
    "time_signature:string,energy:double,valence:double,danceability:double,acousticness:double,"
    "instrumentalness:double,speechiness:double,liveness:double,loudness_db:double,mood:string,genre:string,"
    "is_remix:boolean,feature_source:string>>"
)
BULK_SCHEMA = f"requests_used bigint, results array<{BULK_RESULT}>"
FINGERPRINT_SCHEMA = (
    "status string, results array<struct<score:double,recordings:array<struct<id:string,title:string,"
    "artists:array<struct<name:string>>,releasegroups:array<struct<title:string,type:string>>>>>>"
)
MIN_COUNTRY_SCORE = 85


def _parsed(raw: DataFrame, schema: str) -> DataFrame:
    return raw.withColumn("_b", F.from_json("body", schema))


def _blank(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def _usable(track: Column) -> Column:
    return _blank(track["name"]) != ""


def parse_pages(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages of playlist or liked items (``unit, page_offset, body``).

    Returns track rows, page facts, and refused pages. A page is refused when its body has
    items but none could be read as a track: it must not count as consumed.
    """
    items = F.coalesce(F.col("_b.items"), F.array().cast(_items_type()))
    pages = _parsed(raw, PAGE_SCHEMA).withColumn("_items", items).withColumn(
        "_tracks", F.transform("_items", lambda i: F.coalesce(i["track"], i["item"], i["episode"]))
    )
    usable = F.size(F.filter("_tracks", lambda t: t.isNotNull() & _usable(t)))
    refused = F.col("_b").isNull() | (F.exists("_items", lambda i: i.isNotNull()) & (usable == 0))
    pages = pages.withColumn("_refused", refused)
    good = pages.filter("NOT _refused")
    exploded = good.select("unit", "page_offset", F.posexplode("_tracks").alias("pos", "t")).filter(
        F.col("t").isNotNull() & _usable(F.col("t"))
    )
    names = F.filter(F.coalesce("t.artists.name", F.array().cast("array<string>")), lambda a: _blank(a) != "")
    rows = exploded.select(
        "unit", "page_offset", "pos", F.col("t.id").alias("track_id"), F.array_join(names, ", ").alias("artist"),
        F.col("t.name").alias("track"), _blank(F.col("t.album.name")).alias("album"),
        _blank(F.get(F.col("t.artists"), F.lit(0))["name"]).alias("first_artist"),
    )
    facts = good.select(
        "unit", "page_offset", F.size("_items").alias("n_items"), F.col("_b.next").alias("next"),
        F.col("_b.total").alias("total"),
    )
    return rows, facts, pages.filter("_refused").select(*raw.columns)


def _items_type() -> str:
    return f"array<struct<track:{_TRACK},item:{_TRACK},episode:{_TRACK}>>"


def parse_playlists(raw: DataFrame) -> DataFrame:
    """Listing pages (``page_offset, body``) to ``id, name, owner, total, page_offset, pos``."""
    listed = _parsed(raw, PLAYLISTS_SCHEMA).select("page_offset", F.posexplode("_b.items").alias("pos", "p"))
    return listed.filter(_blank(F.col("p.id")) != "").select(
        F.col("p.id").alias("id"), F.coalesce(F.nullif(F.col("p.name"), F.lit("")), F.col("p.id")).alias("name"),
        F.col("p.owner.id").alias("owner"), F.col("p.tracks.total").alias("total"), "page_offset", "pos",
    )


def parse_tags(raw: DataFrame) -> DataFrame:
    """Tag responses (``norm, artist, body``) to stored entries; unreadable ones are empty."""
    tags = F.coalesce(F.col("_b.toptags.tag"), F.array().cast("array<struct<name:string,count:bigint>>"))
    return _parsed(raw, TAGS_SCHEMA).select("norm", "artist", clip_tags(tags).alias("tags"), F.col("_b.error").alias("error"))


def parse_countries(raw: DataFrame, min_score: int = MIN_COUNTRY_SCORE) -> DataFrame:
    """Artist searches (``norm, artist, body``): country and area of a confident first hit.

    ``area_id`` is set where the country is still to be found by climbing the areas.
    """
    hit = F.get("_b.artists", F.lit(0))
    score = F.coalesce(hit["score"], F.lit(0))
    sure = score >= min_score
    country = F.when(sure, _blank(hit["country"])).otherwise("")
    return _parsed(raw, COUNTRY_SCHEMA).select(
        "norm", "artist", country.alias("country"), F.when(sure, _blank(hit["area"]["name"])).otherwise("").alias("area"),
        score.alias("score"), F.when(sure & (country == ""), hit["area"]["id"]).alias("area_id"),
    )


def parse_areas(raw: DataFrame) -> DataFrame:
    """Area bodies to ``id, code, parent``: first ISO code, first backward "part of"."""
    parents = F.filter("_b.relations", lambda r: (r["type"] == "part of") & (r["direction"] == "backward"))
    return _parsed(raw, AREA_SCHEMA).select(
        F.col("_b.id").alias("id"), F.get(F.col("_b.iso-3166-1-codes"), F.lit(0)).alias("code"),
        F.get(parents, F.lit(0))["area"]["id"].alias("parent"),
    )


def with_area_country(countries: DataFrame, codes: DataFrame) -> DataFrame:
    """Fill the missing countries from resolved areas (``id, code``)."""
    found = codes.select(F.col("id").alias("area_id"), "code")
    return countries.join(found, "area_id", "left").select(
        "norm", "artist", F.coalesce(F.nullif("country", F.lit("")), F.col("code"), F.lit("")).alias("country"),
        "area", "score",
    )


def parse_features(raw: DataFrame) -> DataFrame:
    """Feature responses (``track_key, matched_title, http_status, body``) to cache entries."""
    ok = F.col("http_status") == 200
    return _parsed(raw, FEATURES_SCHEMA).select(
        "track_key", ok.alias("found"), F.when(ok, F.col("matched_title")).alias("matched_title"),
        F.when(ok, F.col("_b")).alias("_f"),
    ).select("track_key", "found", "matched_title", "_f.*")


def parse_bulk(raw: DataFrame) -> DataFrame:
    """Bulk responses (``batch, body``) to ``batch, requests_used, results``."""
    return _parsed(raw, BULK_SCHEMA).select("batch", F.col("_b.requests_used").alias("requests_used"), F.col("_b.results").alias("results"))


def bulk_entries(zipped: DataFrame) -> DataFrame:
    """Cache entries of zipped bulk results (``track_key, result``)."""
    return zipped.select("track_key", F.coalesce("result.found", F.lit(False)).alias("found"), "result.result.*")


def parse_fingerprints(raw: DataFrame) -> DataFrame:
    """Fingerprint responses (``path, body``) to ``path, response``."""
    return raw.select("path", F.from_json("body", FINGERPRINT_SCHEMA).alias("response"))
