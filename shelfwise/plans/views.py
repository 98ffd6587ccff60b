"""The star-schema tables seen as a library: each view gives one operator its input.

Every view has two forms that must agree: a DataFrame, and a SQL text used only to check
results. Views cover the whole of the tables they read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.geo import url_coords, url_reference
from shelfwise.functions.text import track_key
from shelfwise.operators.enrich import STORED_TAGS, TAG_BLACKLIST
from shelfwise.operators.indexing import top_k


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def history(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as plays: user as artist, type as album, property as track."""
    return table(spark, folder, "events").select(
        "ts", F.round(F.col("value") * 1000).cast("bigint").alias("ms_played"),
        F.concat(F.lit("user "), F.col("user_id")).alias("artist"), F.col("event_type").alias("album"),
        F.get_json_object("props", "$.k").alias("track"),
    )


def playlist_name(key: Column) -> Column:
    kind = key % 10
    prefix = (
        F.when(kind == 0, "Backup ").when(kind == 1, "2019 mix ").when(kind == 2, "Summer 2021 ").otherwise("List ")
    )
    return F.concat(prefix, key.cast("string"))


def _color() -> Column:
    return F.substring_index("p_name", " ", 1)


def _ordinal(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.struct(
        a.cast("bigint").alias("o1"), b.cast("int").alias("o2"), c.cast("bigint").alias("o3"), d.cast("bigint").alias("o4")
    ).alias("ordinal")


def titled_parts(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` with the artist, title and album its rows stand for."""
    suffix = F.when(F.col("p_size") % 3 == 0, " (Live)").when(F.col("p_size") % 3 == 1, " - Remastered").otherwise("")
    return table(spark, folder, "part").withColumns({
        "artist": F.concat("p_brand", F.lit(", "), F.initcap(_color())),
        "track": F.concat("p_name", F.lit(" "), F.col("p_partkey"), suffix),
        "album": F.col("p_type"),
    })


def library(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as playlist rows: supplier is the playlist, part is the track."""
    parts = titled_parts(spark, folder).select("p_partkey", "artist", "track", "album")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        playlist_name(F.col("l_suppkey")).alias("playlist"), F.col("l_suppkey").alias("playlist_id"),
        F.col("p_partkey").alias("track_id"), "artist", "track", "album",
        _ordinal(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")),
    )


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as the optional profile of each playlist."""
    return table(spark, folder, "supplier").select(
        playlist_name(F.col("s_suppkey")).alias("playlist"), F.col("s_name").alias("theme"),
        F.lit(None).cast("string").alias("main_genres"), F.lit(None).cast("string").alias("main_artists"),
        (F.col("s_acctbal") / 10000.0).alias("energy"), F.lit(None).cast("double").alias("valence"),
        F.col("s_suppkey").alias("ordinal"),
    )


def playlist_names(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(key.alias("playlist"), playlist_name(key).alias("name"), key.alias("pos"))


def _bitrate(n: Column) -> Column:
    kind = n % 5
    return (
        F.when(kind == 0, "abc").when(kind == 1, "320").when(kind == 2, "192.7").when(kind == 3, "").otherwise("128")
    )


def local_files(spark: SparkSession, folder: str) -> DataFrame:
    """A file scan: one file per part, then one per document; text columns as in a CSV.

    Documents labelled as bad quality lost their tags.
    """
    parts = titled_parts(spark, folder).select(
        _ordinal(F.lit(0), F.lit(0), F.col("p_partkey"), F.lit(0)),
        F.concat(F.lit("/mnt/m/"), "p_type", F.lit("/"), F.col("p_partkey"), F.lit(".mp3")).alias("path"),
        F.lit(".mp3").alias("extension"), F.upper("artist").alias("artist"),
        F.concat("p_name", F.lit(" "), F.col("p_partkey"), F.lit(" [Remix] feat. Someone")).alias("title"),
        F.col("p_type").alias("album"), (F.col("p_size") * 1000).cast("string").alias("size_bytes"),
        _bitrate(F.col("p_size")).alias("bitrate_kbps"),
    )
    labels = table(spark, folder, "labels").select("doc_id", "quality").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    lost = F.coalesce(F.col("quality") == 0, F.lit(False))
    docs = table(spark, folder, "documents").join(labels, "doc_id", "left").select(
        _ordinal(F.lit(1), F.lit(0), F.col("doc_id"), F.lit(0)),
        F.concat(F.lit("/mnt/d/"), "source", F.lit("/"), F.col("doc_id"), F.lit(".flac")).alias("path"),
        F.lit(".flac").alias("extension"), F.when(lost, "").otherwise(F.col("lang")).alias("artist"),
        F.when(lost, "").otherwise(F.col("text")).alias("title"), F.col("source").alias("album"),
        F.col("n_chars").cast("string").alias("size_bytes"), _bitrate(F.col("doc_id")).alias("bitrate_kbps"),
    )
    return parts.unionByName(docs)


def _tag(word: Column) -> Column:
    """Part words as tags; two of them become a non-genre and an unusable tag."""
    return F.when(word == "old", "seen live").when(word == "new", "80s").otherwise(word)


def _words() -> Column:
    return F.array(_color(), F.substring_index("p_name", " ", -1), F.lower("p_type"))


def artist_tags(spark: SparkSession, folder: str) -> DataFrame:
    """A tag cache: per brand and colour, how often each word goes with it."""
    parts = table(spark, folder, "part")
    pairs = parts.select(
        F.explode(F.array(F.lower("p_brand"), _color())).alias("norm"), F.transform(_words(), _tag).alias("words")
    ).select("norm", F.explode("words").alias("name"))
    counted = pairs.groupBy("norm", "name").agg(F.count("*").alias("count"))
    kept = top_k(counted, ["norm"], [F.desc("count"), F.asc("name")], STORED_TAGS)
    entry = F.struct("rank", "name", "count")
    return kept.groupBy("norm").agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda t: F.struct(t["name"].alias("name"), t["count"].alias("count")))
        .alias("tags")
    )


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.concat(F.lit("brand#"), F.col("n_nationkey") + 1).alias("norm"),
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("country"),
    )


def _feature_columns() -> list[Column]:
    key, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    return [
        track_key(F.col("artist"), F.col("track")).alias("track_key"),
        (size / 50.0).alias("energy"), ((price - 900.0) / 100.0).alias("valence"), (size / 100.0).alias("danceability"),
        (price / 1000.0).alias("acousticness"), ((key % 97) / 97.0).alias("instrumentalness"),
    ]


def primary_features(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return titled_parts(spark, folder).select(
        *_feature_columns(), (size > 20).alias("found"), (60 + key % 120 + 0.25).alias("bpm"),
        F.concat(size % 12 + 1, F.lit("A")).alias("camelot"), ((key * 1370) % 600000).alias("duration_ms"),
        F.when(size % 2 == 0, "dark").alias("mood"),
    )


def secondary_features(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return titled_parts(spark, folder).select(*_feature_columns(), (size > 8).alias("found"), (key % 150).cast("double").alias("tempo"))


def tagged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Library rows with the tags and features of their part."""
    size = F.col("p_size").cast("bigint")
    words = F.filter(F.transform(_words(), _tag), lambda t: ~t.isin(*TAG_BLACKLIST) & ~t.rlike("[0-9_]|.{26,}"))
    parts = titled_parts(spark, folder).select(
        "p_partkey", "artist", "track", "album", F.array_sort(F.array_distinct(words)).alias("tags"),
        F.when(size > 5, size * size * size * size / 6250000.0).alias("energy"),
        F.when(size % 7 != 0, (F.col("p_retailprice") - 900.0) / 100.0).alias("valence"),
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("playlist"), "artist", "track", "album", "tags", "energy", "valence",
        _ordinal(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")),
    )


def flat_ordinal() -> list[Column]:
    return [F.col("ordinal")[c].alias(c) for c in ("o1", "o2", "o3", "o4")]


# --- places ----------------------------------------------------------------------------


def _degrees(k: Column, step: int, turn: int, salt: int) -> Column:
    sign = F.when(k % 2 == 1, "-").otherwise("")
    return F.concat(
        sign, ((k * step) % turn).cast("string"), F.lit("."), F.lpad(((k * salt) % 10000).cast("string"), 4, "0")
    )


def _lat_text(k: Column) -> Column:
    return _degrees(k, 37, 80, 7919)


def _lon_text(k: Column) -> Column:
    return _degrees(k, 53, 170, 6271)


def _place_name(k: Column) -> Column:
    return F.concat(F.lit("Café No. "), k.cast("string"))


def map_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as placemarks: nation is the map, market segment the layer."""
    k = F.expr("c_custkey div 3")
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        F.concat(F.lit("/maps/"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit(".kml")).alias("path"),
        F.concat(F.lit("Map "), F.col("c_nationkey")).alias("map"),
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit(".kml")).alias("source_file"),
        F.ascii(segment).alias("layer_pos"), F.when(segment == "BUILDING", "").otherwise(segment).alias("layer"),
        F.col("c_custkey").alias("pos"), F.when(F.col("c_custkey") % 13 == 5, "").otherwise(_place_name(k)).alias("name"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.concat(F.lit("note "), F.col("c_custkey"))).alias("description"),
        F.when(F.col("c_custkey") % 11 == 0, "LineString").otherwise("Point").alias("geometry"),
        _lat_text(k).cast("double").alias("lat"), _lon_text(k).cast("double").alias("lon"),
        F.lit(None).cast("map<string,string>").alias("extended"),
    )


def saved_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as rows of saved lists, with the four URL shapes."""
    k, n = F.expr("o_custkey div 3"), F.col("o_orderkey")
    reference = F.concat(F.lit("data=!1s0x"), k, F.lit(":0x"), k * 7 + 1)
    base = "https://maps.example.org/"
    url = (
        F.when(n % 4 == 0, F.concat(F.lit(base + "place/x/"), reference))
        .when(n % 4 == 1, F.concat(F.lit(base + "search/"), _lat_text(k), F.lit(",+"), _lon_text(k)))
        .when(n % 4 == 2, F.concat(F.lit(base + "place/x/@"), _lat_text(k), F.lit(","), _lon_text(k), F.lit(",17z/"), reference))
        .otherwise(F.lit(base + "s/short"))
    )
    return table(spark, folder, "orders").select(
        F.concat(F.lit("/lists/"), "o_orderpriority", F.lit(".csv")).alias("path"),
        F.concat("o_orderpriority", F.lit(".csv")).alias("source_file"), F.col("o_orderpriority").alias("list"),
        n.alias("pos"), _place_name(k).alias("title"), F.when(n % 3 == 0, F.concat(F.lit("n"), n)).otherwise("").alias("note"),
        url.alias("url"), F.col("o_orderstatus").alias("tags"), F.when(n % 5 == 0, "seen").otherwise("").alias("comment"),
    )


def saved_rows(spark: SparkSession, folder: str) -> DataFrame:
    lat, lon = url_coords(F.col("url"))
    return saved_urls(spark, folder).withColumns({"lat": lat, "lon": lon, "cid": url_reference(F.col("url"))})


# --- harvest ---------------------------------------------------------------------------


def raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as landed pages: every line of the text is one item, offsets count items.

    The items of system turns carry no name, so those pages cannot be read.
    """
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = table(spark, folder, "conversations").withColumn(
        "page_offset", F.coalesce(F.sum(F.size(F.split("text", "\n"))).over(before), F.lit(0)).cast("bigint"))
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    item = lambda line: F.struct(F.struct(
        F.when(F.col("role") == "system", "").otherwise(line).alias("name"), F.array(F.struct(F.col("role").alias("name")), F.struct(F.lit("").alias("name"))).alias("artists"),
        F.struct(F.lit("talk").alias("name")).alias("album"),
    ).alias("track"))
    unfinished = (F.col("turn") < F.col("last")) | ((F.col("role") == "user") & (F.col("conv_id") % 9 == 8))
    body = F.to_json(F.struct(
        F.transform(F.split("text", "\n"), item).alias("items"), F.when(unfinished, "more").alias("next"),
    ))
    return turns.join(last, "conv_id").select(
        F.col("conv_id").cast("string").alias("unit"), "page_offset", body.alias("body")
    )


def listed_units(spark: SparkSession, folder: str) -> DataFrame:
    """The listing of units: the conversations, and some without any page, every other one known to be empty."""
    ids = table(spark, folder, "conversations").select("conv_id").distinct()
    seen = ids.select(F.col("conv_id").cast("string").alias("unit"), (2 * F.col("conv_id")).alias("ordinal"), F.lit(None).cast("bigint").alias("total"))
    bare = ids.filter("conv_id % 10 = 7").select(
        F.concat(F.lit("x"), "conv_id").alias("unit"), (2 * F.col("conv_id") + 1).alias("ordinal"),
        F.when(F.col("conv_id") % 20 == 7, F.lit(0)).cast("bigint").alias("total"))
    return seen.unionByName(bare)


def fingerprint_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as fingerprinted files; their lines are the results, in line order."""
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    result = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey",
        F.struct(
            (1.0 - 3.0 * F.col("l_discount")).alias("score"),
            F.array(F.struct(
                F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_size") > 4, F.col("p_name")).otherwise("").alias("title"),
                F.array(F.struct(F.col("p_brand").alias("name")), F.struct(_color().alias("name"))).alias("artists"),
                F.array(
                    F.struct(F.concat(F.lit("EP "), "p_type").alias("title"), F.lit("EP").alias("type")),
                    F.struct(F.col("p_type").alias("title"), F.when(F.col("p_size") % 2 == 0, "Album").otherwise("Single").alias("type")),
                ).alias("releasegroups"),
            )).alias("recordings"),
        ).alias("result"),
    )
    per_order = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(result))["result"].alias("results"))
    status = F.when(F.col("o_orderstatus") == "F", "error").otherwise("ok")
    return table(spark, folder, "orders").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.concat(F.lit("/x/"), F.col("o_orderkey"), F.lit(".mp3")).alias("path"),
        F.to_json(F.struct(status.alias("status"), "results")).alias("body"),
    )


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Coverage of each event type by day: its cumulated share, in whole points."""
    daily = table(spark, folder, "events").groupBy(
        F.col("event_type").alias("stream"), F.dayofmonth("ts").cast("bigint").alias("run")
    ).agg(F.count("*").alias("n"))
    by_stream = Window.partitionBy("stream")  # one row per day, after the aggregate
    cumulated = F.sum("n").over(by_stream.orderBy("run"))
    return daily.select("stream", "run", F.floor(100 * cumulated / F.sum("n").over(by_stream)).cast("bigint").alias("pct"))


def area_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Regions, nations, customers and orders as a hierarchy; two nations form a cycle."""
    text = lambda prefix, col: F.concat(F.lit(prefix), F.col(col))
    none = F.lit(None).cast("string")
    nation = F.col("n_nationkey")
    up = F.when(nation == 24, "N23").when(nation == 23, "N24").otherwise(text("R", "n_regionkey"))
    return (
        table(spark, folder, "region").select(text("R", "r_regionkey").alias("id"), F.substring("r_name", 1, 2).alias("code"), none.alias("parent"))
        .unionByName(table(spark, folder, "nation").select(text("N", "n_nationkey").alias("id"), F.when(nation == 7, "N7").alias("code"), up.alias("parent")))
        .unionByName(table(spark, folder, "customer").select(text("C", "c_custkey").alias("id"), none.alias("code"), text("N", "c_nationkey").alias("parent")))
        .unionByName(table(spark, folder, "orders").select(text("O", "o_orderkey").alias("id"), none.alias("code"), text("C", "o_custkey").alias("parent")))
    )


def catalog_entries(spark: SparkSession, folder: str) -> DataFrame:
    """A search catalogue: every part under its plain title, larger ones also in full."""
    parts = titled_parts(spark, folder)
    artists = F.array(F.upper("p_brand"), F.lit("Guest"))
    plain = parts.select(
        (F.col("p_partkey") * 2).alias("catalog_id"), F.concat("p_name", F.lit(" "), F.col("p_partkey")).alias("title"), artists.alias("artists")
    )
    full = parts.filter("p_size > 25").select((F.col("p_partkey") * 2 + 1).alias("catalog_id"), F.upper("track").alias("title"), artists.alias("artists"))
    return plain.unionByName(full).withColumn("cand_pos", F.col("catalog_id"))


# --- events of places, broadcast schedule ----------------------------------------------


def place_events(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as typed events of places: the user is the place; some visits are taken back, some rows repeat, some are refused."""
    n, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")
    kinds = F.array(*map(F.lit, ("CAPTURE", "RENAME", "STATUS", "VISIT", "VISIT", "DELETE", "RESTORE")))
    statuses = F.array(*map(F.lit, ("INBOX", "DRAFT", "VALIDATED", "BROKEN")))
    kind = F.get(kinds, (n % 7).cast("int"))
    value = F.when(kind == "RENAME", F.concat(F.lit("name "), k)).when(kind == "STATUS", F.get(statuses, k % 4))
    events = table(spark, folder, "events").select(
        F.concat(F.lit("P"), "user_id").alias("place_id"), "event_id", (n * 7919 % 10007).alias("seq"), kind.alias("type"), value.alias("value"), "ts")
    visits = events.filter((F.col("type") == "VISIT") & (n % 3 == 0))
    back = visits.select("place_id", (n + 1_000_000_000_000).alias("event_id"), "seq", F.lit("UNVISIT").alias("type"), n.cast("string").alias("value"), "ts")
    repeated = events.filter(n % 10 == 1).withColumn("seq", F.col("seq") + F.when(n % 20 == 1, -1).otherwise(1))
    return events.unionByName(back).unionByName(repeated)


def _station(k: Column) -> Column:
    return F.get(F.array(*map(F.lit, ("click", "error", "purchase", "signup", "view"))), (k % 5).cast("int"))


def slots(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as the slots of five stations, on one or two days each; a few run all day below the others."""
    k, size = F.col("p_partkey"), F.col("p_size")
    start = (k * 37 + size * 11) % 1440
    all_day = k % 499 == 0
    return table(spark, folder, "part").select(
        _station(k).alias("station"), k.alias("slot_id"), F.array(k % 7 + 1, (k * 3 + size) % 7 + 1).alias("days"), start.alias("start_min"),
        F.when(all_day, start).otherwise((start + 1 + size % 15) % 1440).alias("end_min"), F.when(all_day, 9).otherwise(size % 7).alias("priority"))


def station_files(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as files that stations can play."""
    k, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, folder, "part").select(
        k.alias("file"), _station(k).alias("station"), (size % 5 + 1).alias("energy"), F.get(F.array(F.lit("80s"), F.lit("90s"), F.lit("00s")), (k % 3).cast("int")).alias("era"),
        F.when(F.expr("p_partkey div 5 % 2 = 0"), "US").otherwise("FR").alias("culture"), F.when(size % 11 == 0, 0.0).otherwise(F.round(F.col("p_retailprice") / 100)).alias("weight"))


def station_plays(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as plays of stations."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("station"), F.col("event_id").alias("play_id"), "ts", (F.col("event_id") * 7 % 2000).alias("file"),
        (F.get_json_object("props", "$.k").cast("int") % 5 + 1).alias("energy"))


def slot_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as requests for files, spread over the month of the plays."""
    k = F.col("s_suppkey")
    low = (k % 3 + 1).cast("int")
    return table(spark, folder, "supplier").select(
        k.alias("request_id"), _station(k).alias("station"), F.timestamp_seconds(F.lit(1704067200) + k * 26171 % 2592000).alias("at"), low.alias("energy_min"),
        (low + k % 2).cast("int").alias("energy_max"), F.when(k % 4 > 0, F.get(F.array(F.lit("80s"), F.lit("90s"), F.lit("00s")), (F.expr("s_suppkey div 5") % 3).cast("int"))).alias("era"),
        F.when(k % 3 == 0, "US").alias("culture"))
