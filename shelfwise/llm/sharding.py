"""Sharding of groups of equal texts by vector bin packing on bytes, tokens and rows.

Every group of equal texts is an item with three sizes. Items are placed one after the other, the
largest first, each into the shard where the dot product of its sizes with the shard's residual
capacity is highest among the shards that its bytes do not overfill. The order needs one place, so
the number of items is bounded:

* a group that holds more than 1/``SINGLE`` of any total is an item of its own; there are at most
  three times ``SINGLE`` of those;
* a group that holds more than half of a shard is dealt by a hash of its rows to ``PARTS`` items, as
  no single shard could take it without upsetting the balance;
* all other groups go by hash of their text to ``BUNDLES`` items, with their exact sums.

Slots are ranks inside a shard, made from counts per task. Only items and per-task counts are ever
gathered; texts and rows are not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.ranks import with_ranks
from shelfwise.session import materialize

SINGLE = 2048
PARTS = 256
BUNDLES = 8192
WORD = r"[^\x20\x09-\x0D]+"
SIZES = ("size", "tokens", "rows")


def place_items(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (a row of bytes, tokens, rows)."""
    total = sizes.sum(axis=0).astype(float)
    total[total == 0] = 1
    share = sizes / total
    residual = np.full((shards, sizes.shape[1]), 1 / shards)
    out = np.zeros(len(sizes), np.int64)
    for i in np.lexsort((np.arange(len(sizes)), -share.sum(axis=1), -share.max(axis=1))):
        score = residual @ share[i]
        fits = residual[:, 0] >= share[i, 0]
        # Without a shard that has the bytes left, the one with most bytes left takes the item.
        out[i] = np.argmax(np.where(fits, score, -np.inf)) if fits.any() else np.argmax(residual[:, 0])
        residual[out[i]] -= share[i]
    return out


def _number(shards: int):
    """Number the rows of each shard within the task."""

    def run(batches):
        task, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            shard = batch["shard"].to_numpy()
            local = np.zeros(len(shard), np.int64)
            for s in np.unique(shard):
                own = np.flatnonzero(shard == s)
                local[own] = seen[s] + np.arange(len(own))
                seen[s] += len(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * len(shard), pa.int32()), pa.array(local)], [*batch.schema.names, "task", "local"])

    return run


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8) -> DataFrame:
    """One row per row of ``docs``: (doc_id, size, text_crc32, tokens, law, shard, slot, grown_shard).

    size is the text's UTF-8 bytes plus one (a null text has none, like an empty one), tokens its
    words. law is ``bytes``: the sizes of the shards are nearly equal, and tokens and rows too as far
    as the texts allow. Equal texts share a shard unless their group holds more than half of one.
    slot counts from 0 in each shard without gaps; grown_shard is null. Null and repeated ids
    are rows like any other. An empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("tokens"),
        F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16).alias("key"),
    )
    rows = materialize(rows, "sized")
    groups = materialize(rows.groupBy("key").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "groups")
    total = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SIZES]).first()
    share = F.greatest(*[F.col(c) / F.lit(max(1, total[c])) for c in SIZES])

    # The few groups that are items themselves: at most three times SINGLE.
    single = F.broadcast(groups.filter(share > 1 / SINGLE).select("key", (share > 0.5 / shards).alias("split")))
    item = (
        F.when(F.col("split"), F.concat(F.lit("part:"), F.hex("key"), F.lit(":"), F.pmod(F.xxhash64("id", "key"), F.lit(PARTS)).cast("string")))
        .when(F.col("split").isNotNull(), F.concat(F.lit("group:"), F.hex("key")))
        .otherwise(F.concat(F.lit("bundle:"), F.pmod(F.xxhash64("key"), F.lit(BUNDLES)).cast("string")))
    )
    rows = rows.join(single, "key", "left").withColumn("item", item)
    items = rows.groupBy("item").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).orderBy("item").toPandas()
    items["shard"] = place_items(items[list(SIZES)].to_numpy(np.int64), shards)
    placed = spark.createDataFrame(items[["item", "shard"]], "item string, shard long")

    sharded = rows.join(F.broadcast(placed), "item").select("id", "size", "text_crc32", "tokens", "shard")
    schema = T.StructType([*sharded.schema.fields, T.StructField("task", T.IntegerType()), T.StructField("local", T.LongType())])
    ranked = with_ranks(materialize(sharded.mapInArrow(_number(shards), schema), "sharded"), "shard", "slot")
    return ranked.select(
        F.col("id").alias(id_col), "size", "text_crc32", "tokens", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
