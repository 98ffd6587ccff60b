"""Dropping rows without moving the texts of the rows that stay."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.bloom import build, passes
from shelfwise.llm.memory import fresh, released
from shelfwise.session import materialize


def _filter(keys: DataFrame) -> Callable[[Column], Column]:
    """Whether a 64-bit hash may be among the one column of ``keys``."""
    filled = build(keys, keys.count())

    def one(key: pa.Array) -> pa.Array:
        return pa.array(passes(filled, key.to_numpy(zero_copy_only=False).view("uint64")))

    @F.arrow_udf(T.BooleanType())
    def may(keys_: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from released(lambda columns: map(one, columns))(keys_)

    return may


def one_row_each(docs: DataFrame, rows: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """One of the rows of ``docs`` for each group, and all rows whose group is not listed.

    ``rows`` has (id, key, stays) of all rows of the groups listed; ``key`` is the same key over
    ``docs``, and id and key together tell the rows of a group apart. Of rows that repeat both, one
    stays where stays says so. A null is an id. Only rows that may be listed go into the join.
    """
    own_key, own_id, listed_key, keeps = fresh(docs.columns, "_key", "_id", "_listed", "_stays")
    listed = rows.groupBy(F.col("id").alias(own_id), F.col("key").alias(listed_key)).agg(
        F.bool_or("stays").alias(keeps), F.count(F.lit(1)).alias("rows"))
    listed = materialize(listed.filter(~F.col(keeps) | (F.col("rows") > 1)).select(own_id, listed_key, keeps), "listed")
    keyed = docs.withColumn(own_key, key)
    may = _filter(listed.select(F.xxhash64(own_id, listed_key).alias("key")))(F.xxhash64(id_col, own_key))
    asked = keyed.filter(may)
    found = asked.join(listed, (asked[own_key] == listed[listed_key]) & asked[id_col].eqNullSafe(listed[own_id]), "left")
    out = keyed.filter(~may).unionByName(found.filter(F.col(keeps).isNull()).select(*keyed.columns))
    if not listed.filter(F.col(keeps)).isEmpty():
        out = out.unionByName(found.filter(F.col(keeps)).select(*keyed.columns).dropDuplicates([id_col, own_key]))
    return out.select(*docs.columns)


def without_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not among the one column of ``dropped``; a null is an id.

    A Bloom filter of the dropped ids lets most rows through where they are; only rows that may be
    dropped go into the join.
    """
    dropped = materialize(dropped.select(F.col(dropped.columns[0]).alias("_dropped")).distinct(), "dropped")
    may = _filter(dropped.select(F.xxhash64("_dropped").alias("key")))(F.xxhash64(id_col))
    asked = docs.filter(may)
    return docs.filter(~may).unionByName(asked.join(dropped, asked[id_col].eqNullSafe(dropped["_dropped"]), "left_anti"))
