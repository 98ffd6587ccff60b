"""Large JSON maps as rows, one entry each, without one task that holds a file.

Files are cut at quotation marks by the text source, so any byte range of a file is a task's input on
any file system. What a piece is (inside a string or not, how deep, in which entry) are running sums
over the pieces before it: sums inside a piece of the input, and an offset for each piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.operators.indexing import last_wins
from shelfwise.session import materialize

_UNIT = ["path", "part"]


def read_json_maps(spark: SparkSession, path: str) -> DataFrame:
    """The entries of the JSON map at ``path``, or of every map below it: ``path, key, body``.

    ``body`` is the JSON text of a value, or the text itself of a string. The last of equal keys of a
    file counts. An entry that cannot be parsed has no row; a file that ends inside a string or with
    brackets open is an error.
    """
    raw = spark.read.option("lineSep", '"').option("recursiveFileLookup", True).text(path)
    place = F.monotonically_increasing_id()
    pieces = materialize(
        raw.select(F.col("_metadata.file_path").alias("path"), F.shiftright(place, 33).alias("part"), place.alias("row"), F.col("value").alias("piece")),
        "pieces",
    )
    # A quotation mark after an odd number of backslashes does not end its string.
    ends = F.length(F.regexp_extract("piece", r"(\\*)$", 1)) % 2 == 0
    quoted = _before(pieces.withColumn("_n", ends.cast("int")), "_marks")
    inside = quoted.withColumn("inside", F.col("_marks") % 2 == 1)
    change = F.when(F.col("inside"), 0).otherwise(_count("piece", "{[") - _count("piece", "}]"))
    deep = materialize(_before(inside.withColumn("_n", change), "_depth").withColumn("depth", F.col("_depth") + F.col("_n")), "depths")
    _check(deep)
    # A string after the map's first bracket or after a comma between entries is a key.
    opens = ~F.col("inside") & (F.col("depth") == 1) & F.rtrim(F.regexp_replace("piece", r"\s+$", "")).rlike("[{,]$")
    entries = _before(deep.select(*_UNIT, "row", "piece", opens.cast("int").alias("_n")), "entry").filter("entry > 0")
    ordered = F.sort_array(F.collect_list(F.struct("row", "piece")))
    texts = entries.groupBy("path", "entry").agg(F.concat(F.lit('"'), F.array_join(ordered["piece"], '"')).alias("text"))
    # What follows the value: the comma before the next key, or the bracket that ends the map.
    pair = F.concat(F.lit("{"), F.regexp_replace("text", r"[,}]\s*$", ""), F.lit("}"))
    parsed = texts.select("path", "entry", F.explode(F.from_json(pair, "map<string,string>")).alias("key", "body"))
    return last_wins(parsed, ["path", "key"], "entry").drop("entry")


def _count(column: str, characters: str) -> Column:
    return F.length(column) - F.length(F.translate(column, characters, ""))


def _before(rows: DataFrame, name: str) -> DataFrame:
    """Add the sum of ``_n`` over all rows of the file before each row."""
    sums = rows.groupBy(*_UNIT).agg(F.sum("_n").alias("_sum"))
    units = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*_UNIT, F.coalesce(F.sum("_sum").over(units), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy(*_UNIT).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    return local.join(offsets, _UNIT).withColumn(name, F.col("_local") + F.col("_offset")).drop("_local", "_offset")


def _check(deep: DataFrame) -> None:
    last = F.struct("part", "row")
    broken = deep.groupBy("path").agg(
        F.max_by("depth", last).alias("depth"), F.max_by("inside", last).alias("inside")
    ).filter("depth <> 0 OR inside")
    found = broken.agg(F.count("*").alias("n"), F.min("path").alias("path")).first()
    if found["n"]:
        raise ValueError(f"{found['n']} files are no whole JSON maps, {found['path']} first")
