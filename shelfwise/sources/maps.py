"""Map exports (KML, KMZ) and saved lists (CSV) as tables."""

from __future__ import annotations

import codecs
import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.geo import GEOMETRIES, point_coords, url_coords, url_reference
from shelfwise.functions.paths import extension, filename, stem
from shelfwise.session import materialize
from shelfwise.sources.files import classify_files, local_path

# The declared shape: inference would turn a single child into a struct.
_PLACEMARK = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("ExtendedData", T.StructType([
        T.StructField("Data", T.ArrayType(T.StructType([
            T.StructField("_name", T.StringType()), T.StructField("value", T.StringType()),
        ]))),
    ])),
    T.StructField("Point", T.StructType([T.StructField("coordinates", T.StringType())])),
    *[T.StructField(g, T.StringType()) for g in GEOMETRIES[1:]],
]))
_FOLDER = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("Placemark", _PLACEMARK)]))
_LAYERS = [T.StructField("name", T.StringType()), T.StructField("Placemark", _PLACEMARK), T.StructField("Folder", _FOLDER)]
KML_SCHEMA = T.StructType([
    T.StructField("Document", T.StructType(_LAYERS)), *_LAYERS, T.StructField("_corrupt_record", T.StringType()),
])

# Accepted header names of a saved list, per column.
LIST_HEADERS = {
    "title": ("title", "titre"),
    "note": ("note",),
    "url": ("url",),
    "tags": ("tags",),
    "comment": ("comment", "commentaire"),
}


_DECLARED = re.compile(rb"""^\s*<\?xml[^>]*\bencoding\s*=\s*["']([A-Za-z0-9._-]+)["']""")


def decode_xml(data: bytes) -> str:
    """The text of an XML file by its byte order mark or declaration, without the declaration."""
    if data[:2] in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
        text = data.decode("utf-16")
    else:
        declared = _DECLARED.match(data.removeprefix(codecs.BOM_UTF8))
        text = data.decode("utf-8-sig" if data.startswith(codecs.BOM_UTF8) or not declared else declared[1].decode())
    return re.sub(r"^\s*<\?xml[^>]*\?>", "", text)


def _unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for content in batch["content"]:
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    name = next(n for n in archive.namelist() if n.lower().endswith(".kml"))
                    texts.append(decode_xml(archive.read(name)))
            except (zipfile.BadZipFile, StopIteration, UnicodeDecodeError, LookupError):
                texts.append(None)
        yield pd.DataFrame({"path": batch["path"], "body": texts})


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per map file: ``path, kml`` (the parsed root), null ``kml`` if unreadable."""
    parsed = (
        spark.read.format("xml").schema(KML_SCHEMA).option("rowTag", "kml").option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.[kK][mM][lL]").load(folder)
        .select(F.col("_metadata.file_path").alias("path"), F.struct(*KML_SCHEMA.names).alias("kml"))
    )
    # A file per task: archives are small and independent.
    archives = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[kK][mM][zZ]").load(folder)
        .select("path", "content").mapInPandas(_unzip, "path string, body string")
        .select("path", F.from_xml("body", KML_SCHEMA.simpleString(), {"mode": "PERMISSIVE"}).alias("kml"))
    )
    return parsed.unionByName(archives).withColumn("path", F.url_decode(local_path(F.col("path"))))


def _text(x: Column) -> Column:
    return F.coalesce(F.regexp_replace(x, r"^\s+|\s+$", ""), F.lit(""))


def unreadable_maps(spark: SparkSession, folder: str) -> DataFrame:
    """Map files that could not be parsed, for the quarantine report."""
    listed = classify_files(spark, folder).filter("kind = 'my_maps'").select("path")
    # Written out first: a raw file scan may not be asked for its corrupt records alone.
    readable = materialize(_documents(spark, folder), "documents").filter("kml IS NOT NULL AND kml._corrupt_record IS NULL")
    return listed.join(readable.select("path"), "path", "left_anti")


def read_maps(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    """One row per placemark: ``path, source_file, map, layer_pos, layer, pos, name,
    description, geometry, lat, lon, extended``.

    Placemarks outside any layer come first, in a layer named "". A layer without
    placemarks keeps one row with a null ``pos``. Only direct children are read. Unreadable
    maps have no rows; with ``strict`` they are an error, as in a build.
    """
    if strict:
        lost = [r["path"] for r in unreadable_maps(spark, folder).orderBy("path").collect()]
        if lost:
            raise ValueError(f"{len(lost)} unreadable maps: {', '.join(lost)}")
    docs = _documents(spark, folder).filter("kml IS NOT NULL AND kml._corrupt_record IS NULL")
    root = F.coalesce(
        F.col("kml.Document"),
        F.struct(F.col("kml.name").alias("name"), F.col("kml.Placemark").alias("Placemark"), F.col("kml.Folder").alias("Folder")),
    )
    docs = docs.withColumn("doc", root).withColumn(
        "map", F.coalesce(F.nullif(_text(F.col("doc.name")), F.lit("")), stem(F.col("path")))
    )
    base = ["path", "map"]
    loose = docs.filter(F.size("doc.Placemark") > 0).select(
        *base, F.lit(0).alias("layer_pos"), F.lit("").alias("layer"), F.posexplode("doc.Placemark").alias("pos", "pm")
    )
    layers = docs.select(*base, F.posexplode("doc.Folder").alias("_pos", "folder"))
    layered = layers.select(
        *base, (F.col("_pos") + 1).alias("layer_pos"), _text(F.col("folder.name")).alias("layer"),
        F.posexplode_outer("folder.Placemark").alias("pos", "pm"),
    )
    pm = F.col("pm")
    geometry = F.coalesce(*[F.when(pm[g].isNotNull(), F.lit(g)) for g in GEOMETRIES])
    lat, lon = point_coords(pm["Point"]["coordinates"])
    data = F.coalesce(pm["ExtendedData"]["Data"], F.array().cast(_data_type()))
    extended = F.map_from_entries(F.transform(
        data, lambda d: F.struct(F.coalesce(d["_name"], F.lit("")).alias("key"), _text(d["value"]).alias("value"))
    ))
    return loose.unionByName(layered).select(
        *base, filename(F.col("path")).alias("source_file"), "layer_pos", "layer", "pos",
        _text(pm["name"]).alias("name"), _text(pm["description"]).alias("description"),
        geometry.alias("geometry"), F.when(geometry == "Point", lat).alias("lat"),
        F.when(geometry == "Point", lon).alias("lon"), extended.alias("extended"),
    )


def _data_type() -> T.DataType:
    return _PLACEMARK.elementType["ExtendedData"].dataType["Data"].dataType


def list_header(columns: Column) -> Column:
    """Position of each wanted column in a header row; of two matches the last wins."""
    clean = F.transform(columns, lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "﻿", ""))))

    def position(names: tuple[str, ...]) -> Column:
        return F.array_max(F.transform(clean, lambda c, i: F.when(c.isin(*names), i)))

    return F.struct(*[position(names).alias(field) for field, names in LIST_HEADERS.items()])


def list_width(spark: SparkSession, folder: str) -> int:
    """Columns of the widest header among the saved lists, at least one; a single number to the driver."""
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]").text(folder)
        .filter("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("pos"), "value")
    )
    first = lines.groupBy("path").agg(F.min_by("value", "pos").alias("header"))
    return (first.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1)


def read_saved_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of saved lists: ``path, source_file, list, pos, title, note, url, tags, comment,
    lat, lon, cid``.

    Headers vary by language. All files are read once by position, as wide as the widest header;
    each file's first row is its header and is joined back to name the columns. Rows without title
    and URL are empty.
    """
    columns = [f"c{i}" for i in range(list_width(spark, folder))]
    raw = (
        spark.read.schema(", ".join(f"{c} string" for c in columns)).option("header", False)
        .option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
        .option("maxColumns", max(20480, len(columns) + 1))
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]").csv(folder)
        .select(
            F.url_decode(local_path(F.col("_metadata.file_path"))).alias("path"),
            F.monotonically_increasing_id().alias("pos"), F.array(*columns).alias("cells"),
        )
    )
    rows = materialize(raw, "lists")
    headers = rows.groupBy("path").agg(
        F.min("pos").alias("_header_pos"), list_header(F.min_by("cells", "pos")).alias("_h")
    )
    body = rows.join(headers, "path").filter(F.col("pos") > F.col("_header_pos"))
    cell = lambda f: _text(F.get("cells", F.col(f"_h.{f}")))
    named = body.select("path", "pos", *[cell(f).alias(f) for f in LIST_HEADERS])
    lat, lon = url_coords(F.col("url"))
    return named.filter("title <> '' OR url <> ''").select(
        "path", filename(F.col("path")).alias("source_file"), stem(F.col("path")).alias("list"), "pos",
        *LIST_HEADERS, lat.alias("lat"), lon.alias("lon"), url_reference(F.col("url")).alias("cid"),
    )


def saved_files(spark: SparkSession, folder: str) -> DataFrame:
    """The saved-list files themselves, lists without rows included."""
    return classify_files(spark, folder).filter(extension(F.col("path")) == ".csv").select(
        "path", stem(F.col("path")).alias("list"), filename(F.col("path")).alias("source_file")
    )
