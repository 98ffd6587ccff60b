"""File sources: listening history, CSV tables, file listings, run logs, caches, built tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.paths import (
    AUDIO_EXTENSIONS, QUARANTINE, extension, file_kind, filename, guess_artist_title, in_folder, stem,
)
from shelfwise.operators.indexing import global_index
from shelfwise.session import materialize
from shelfwise.sources.jsonmap import read_json_maps

HISTORY_SCHEMA = T.StructType([
    T.StructField("ts", T.StringType()),
    T.StructField("ms_played", T.LongType()),
    T.StructField("master_metadata_track_name", T.StringType()),
    T.StructField("master_metadata_album_artist_name", T.StringType()),
    T.StructField("master_metadata_album_album_name", T.StringType()),
])

TAG_FIELDS = ("artist", "title", "album", "album_artist", "year", "track_number",
              "duration_sec", "bitrate_kbps", "sample_rate")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_history(spark: SparkSession, folder: str, glob: str = "Streaming_History_Audio_*.json") -> DataFrame:
    """Listening history from JSON arrays in a folder tree, all files as one table."""
    raw = (
        spark.read.schema(HISTORY_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).json(folder)
    )
    return raw.select(
        F.col("ts").try_cast("timestamp").alias("ts"), "ms_played", F.col("master_metadata_album_artist_name").alias("artist"),
        F.col("master_metadata_album_album_name").alias("album"),
        F.col("master_metadata_track_name").alias("track"),
    )


def _csv(spark: SparkSession) -> "DataFrameReader":  # noqa: F821
    return spark.read.option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header (byte order mark allowed), every column text, in file order.

    A quoted line break makes a file unsplittable, so it is read once into a columnar
    table; ``ordinal`` keeps the order of the rows.
    """
    raw = _csv(spark).option("header", True).option("inferSchema", False).csv(path)
    named = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    if len(raw.inputFiles()) <= 1:
        return materialize(named.withColumn("ordinal", F.monotonically_increasing_id()), "csv")
    # Splits are packed by size, so rows of several files are numbered by (path, place in the file).
    cells = [F.col(f"`{old}`").alias(new) for old, new in zip(raw.columns, named.columns)]
    placed = raw.select(*cells, F.col("_metadata.file_path").alias("_path"), F.monotonically_increasing_id().alias("_row"))
    return global_index(materialize(placed, "csv"), ["_path", "_row"], "ordinal", start=0).drop("_path", "_row")


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A stored table, or an empty one of that schema while it does not exist yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def open_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """The built tables, without rebuilding; a missing one is an error."""
    missing = [n for n in names if not path_exists(spark, f"{folder}/{n}")]
    if missing:
        raise FileNotFoundError(f"{folder}: not built yet: {', '.join(missing)}")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def import_json_cache(spark: SparkSession, path: str, value_schema: str, key: str) -> DataFrame:
    """A JSON map of entries as a keyed table; keys starting with "_" are housekeeping."""
    entries = read_json_maps(spark, path).filter(~F.col("key").startswith("_"))
    return entries.select(F.col("key").alias(key), F.from_json("body", value_schema).alias("_e")).select(key, "_e.*")


def cache_counter(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One housekeeping number of a JSON map (0 while absent)."""
    entries = read_json_maps(spark, path).filter(F.col("key") == name)
    return entries.agg(F.coalesce(F.max(F.col("body").try_cast("bigint")), F.lit(0)).alias(name))


def local_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _listing(spark: SparkSession, folders: list[str]) -> DataFrame:
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
        .select(local_path(F.col("path")).alias("path"), F.col("length"), F.col("modificationTime"))
    )


def classify_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below ``folder`` with its kind; only names and sizes are read.

    Names starting with "_" or "." are hidden from the listing.
    """
    found = _listing(spark, [folder]).filter(filename(F.col("path")) != ".gitkeep")
    return found.select("path", "length", file_kind(F.col("path")).alias("kind"))


def describe_files(paths: DataFrame, extensions: tuple[str, ...] = AUDIO_EXTENSIONS, skip: str = QUARANTINE) -> DataFrame:
    """Audio files among ``paths`` (outside the quarantine folder) with name parts and the
    artist and title guessed from the name."""
    path = F.col("path")
    return (
        paths.filter(extension(path).isin(*extensions) & ~in_folder(path, skip))
        .withColumns({"filename": filename(path), "extension": extension(path), "guess": guess_artist_title(stem(path))})
    )


def with_tags(described: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """Tags where artist or title is present, else both guessed from the name."""
    if tags is None:
        blank = {f: F.lit("") for f in TAG_FIELDS}
        joined = described.withColumns({f"_{k}": v for k, v in blank.items()})
    else:
        named = tags.select("path", *[F.col(f).cast("string").alias(f"_{f}") for f in TAG_FIELDS if f in tags.columns])
        joined = described.join(named, "path", "left")
        joined = joined.withColumns({f"_{f}": F.lit("") for f in TAG_FIELDS if f not in tags.columns})
    tagged = (F.coalesce("_artist", F.lit("")) != "") | (F.coalesce("_title", F.lit("")) != "")
    value = lambda f, other: F.when(tagged, F.coalesce(f"_{f}", F.lit(""))).otherwise(other)
    fields = [
        value(f, F.col("guess")[f] if f in ("artist", "title") else F.lit("")).alias(f) for f in TAG_FIELDS
    ]
    kept = [c for c in described.columns if c != "guess"]
    return joined.select(*kept, *fields, F.when(tagged, "yes").otherwise("no").alias("tags_read"))


def read_inventory(spark: SparkSession, roots: list[str], tags: DataFrame | None = None) -> DataFrame:
    """Inventory of the audio files below several roots; a missing root is skipped."""
    present = [r for r in roots if path_exists(spark, r)]
    if not present:
        raise FileNotFoundError(f"no root found among {roots}")
    listed = _listing(spark, present).select(
        "path", F.col("length").alias("size_bytes"), F.unix_timestamp("modificationTime").alias("mtime")
    )
    return with_tags(describe_files(listed), tags)


def scan_counts(inventory: DataFrame, root: Column) -> DataFrame:
    """Files, files with tags and guessed files per root."""
    return inventory.groupBy(root.alias("root")).agg(
        F.count("*").alias("n_files"), F.count_if(F.col("tags_read") == "yes").alias("n_tagged"),
        F.count_if(F.col("tags_read") == "no").alias("n_guessed"),
    )


def latest_run(lines: DataFrame, marker: str = "Analyse") -> DataFrame:
    """Time, genre and feature counts from the last log line naming the run.

    ``lines`` has ``ordinal, value``; the last line is a partial aggregate, not a sort.
    """
    last = lines.filter(F.col("value").contains(marker)).agg(F.max_by("value", "ordinal").alias("value"))
    number = lambda word: F.regexp_extract("value", rf"{word} (\d+)", 1).try_cast("bigint")
    return last.select(
        F.regexp_extract("value", r"^\[*([^\]]*)\] ", 1).alias("time"),
        number("genres").alias("genres"), number("features").alias("features"),
    )


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).withColumn("ordinal", F.monotonically_increasing_id())
    return latest_run(lines)
