"""Identity over alias keys with a persistent registry, in parallel and order-exact.

Occurrences arrive in a fixed order, each with one or two keys by priority. The first key
already known gives the id; with none known a new id is made; missing keys become aliases;
a key that already has an id keeps it (no transitive merge).

Whatever happened at an occurrence, its leading key ends up with the occurrence's id: it
was known and decided, or it was added with the id that was decided. So only the keys need
resolving, and every occurrence reads the id of its leading key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.indexing import MAX_BROADCAST_ROWS, global_index
from shelfwise.operators.pointers import follow
from shelfwise.session import materialize


def _first_seen(occurrences: DataFrame) -> DataFrame:
    """``k1, k2, ordinal`` of the first occurrence of each pair of keys."""
    return occurrences.groupBy(
        F.get("keys", F.lit(0)).alias("k1"), F.get("keys", F.lit(1)).alias("k2")
    ).agg(F.min("ordinal").alias("ordinal"))


def resolve_ids(
    occurrences: DataFrame, registry: DataFrame, kind: str, width: int, counter: int = 0, prefix: str = "P6"
) -> tuple[DataFrame, DataFrame]:
    """Ids for ``occurrences`` (``ordinal, keys, …``) given ``registry`` (``key, id``).

    Returns the occurrences with ``id`` and the registry entries to append (``key, id,
    is_new``, where ``is_new`` marks the entry that allocated its id). Parents of keys were
    seen earlier, so the parent links form a forest whose roots ``pointers.follow`` finds.

    Up to a million keys (counted), the registry is filtered by them where it lies, so a run
    over few keys moves and joins only the entries it touches, and writes only new ones.
    """
    pairs = materialize(_first_seen(occurrences), "pairs")
    keyed = pairs.select("k1", "k2", "ordinal", F.explode(F.array_compact(F.array("k1", "k2"))).alias("key"))
    seen = keyed.groupBy("key").agg(F.min("ordinal").alias("first"))
    known = _touched(registry, seen, 2 * pairs.count()).select("key", F.col("id").alias("_known"))
    first = materialize(seen.join(known, "key", "left"), "keys")

    # Parent of an unregistered key: the first key of its first occurrence that was known
    # by then. Without one, the leading key of that occurrence is the root of its keys.
    fresh = first.filter("_known IS NULL").select("key", "first")
    at_first = fresh.join(
        keyed.select("key", F.col("ordinal").alias("first"), "k1", "k2"), ["key", "first"]
    )
    lead = first.select(
        F.col("key").alias("k1"), F.col("first").alias("_first1"), F.col("_known").alias("_known1")
    )
    other = first.select(
        F.col("key").alias("k2"), F.col("first").alias("_first2"), F.col("_known").alias("_known2")
    )
    lead_known = F.col("_known1").isNotNull() | (F.col("_first1") < F.col("first"))
    other_known = F.col("k2").isNotNull() & (
        F.col("_known2").isNotNull() | (F.col("_first2") < F.col("first"))
    )
    parent = F.when(lead_known, F.col("k1")).when(other_known, F.col("k2")).otherwise(F.col("k1"))
    links = at_first.join(lead, "k1").join(other, "k2", "left").select("key", "first", parent.alias("parent"))
    links = materialize(
        links.select(F.col("key").alias("id"), F.when(F.col("parent") != F.col("key"), F.col("parent")).alias("parent"), "first"),
        "links",
    )
    numbered = global_index(links.filter("parent IS NULL").select("id", "first"), ["first"], "_n", start=counter + 1)
    made = numbered.select(F.col("id").alias("key"), F.format_string(f"{prefix}-{kind}-%0{width}d", F.col("_n")).alias("id"))
    registered = first.filter("_known IS NOT NULL").select("key", F.col("_known").alias("id"))
    root_ids = made.unionByName(registered).select(F.col("key").alias("root"), F.col("id").alias("_id"))
    aliases = follow(links).join(root_ids, "root").select(F.col("id").alias("key"), F.col("_id").alias("id"))
    added = materialize(
        made.withColumn("is_new", F.lit(True)).unionByName(aliases.withColumn("is_new", F.lit(False))), "ids"
    )
    lead_ids = added.select("key", "id").unionByName(registered).withColumnRenamed("key", "_lead")
    with_ids = (
        occurrences.withColumn("_lead", F.get("keys", F.lit(0))).join(lead_ids, "_lead").drop("_lead")
    )
    return with_ids, added


def _touched(registry: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """The registry entries of ``keys``, found without moving the others; all entries for more keys than may be sent."""
    if n_keys > MAX_BROADCAST_ROWS:
        return registry
    return registry.join(F.broadcast(keys.select("key")), "key", "left_semi")


def resolve_single_ids(
    occurrences: DataFrame, key: str, registry: DataFrame, kind: str, width: int, counter: int = 0, prefix: str = "P6"
) -> tuple[DataFrame, DataFrame]:
    """As ``resolve_ids`` for occurrences with one key each: no aliases, so no rounds."""
    first = occurrences.groupBy(F.col(key).alias("key")).agg(F.min("ordinal").alias("first"))
    fresh = first.join(registry.select("key"), "key", "left_anti")
    new_id = F.format_string(f"{prefix}-{kind}-%0{width}d", F.col("_n"))
    added = global_index(fresh, ["first"], "_n", start=counter + 1).select(
        "key", new_id.alias("id"), F.lit(True).alias("is_new")
    )
    ids = added.select(F.col("key").alias(key), "id").unionByName(registry.select(F.col("key").alias(key), "id"))
    return occurrences.join(ids, key), added


def registry_conflicts(occurrences: DataFrame, registry: DataFrame) -> DataFrame:
    """Pairs of keys seen together that hold different ids (reported, never merged)."""
    pairs = _first_seen(occurrences).filter("k2 IS NOT NULL")
    ids = registry.select("key", "id")
    return (
        pairs.join(ids.select(F.col("key").alias("k1"), F.col("id").alias("id1")), "k1")
        .join(ids.select(F.col("key").alias("k2"), F.col("id").alias("id2")), "k2")
        .filter("id1 <> id2").select("k1", "k2", "id1", "id2")
    )
