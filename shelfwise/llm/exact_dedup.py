"""Exact duplicates by distributed most-significant-digit radix partitioning.

Texts are split into groups by their successive bytes. Each level takes the next digit, a run of
bytes eight times as long as the one before, and splits every open group by it with one grouped
count and one join. A group that has one row, or whose texts end in the digit, is settled; only
the rest of the bytes of open groups goes on to the next level. Groups are told apart by the bytes
themselves, so no digest decides equality.

Counts are pre-aggregated before their shuffle, so a large group of copies is one row per task
there. The join of the rows with the counts can be split by AQE, as it needs no rows together.
Each level is written to the shared scratch folder, so a lost executor costs one level at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.dropping import one_row_each
from shelfwise.llm.memory import released
from shelfwise.session import materialize

FIRST_DIGIT = 64
GROWTH = 8


@F.arrow_udf(T.StringType())
def ascii_lower(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A-Z to a-z; every other character stays."""
    yield from released(lambda columns: map(pc.ascii_lower, columns))(texts)


ascii_lower = ascii_lower.asNondeterministic()  # or a filter on it would make Spark run it twice, in workers of its own


def _split(rows: DataFrame, width: int, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """One level: the rows with their group's decision, and the groups of two rows or more."""
    rows = rows.withColumns({
        "digit": F.substring("rest", 1, width),
        "ended": F.octet_length("rest") <= width,
    })
    keys = [*keys, "digit", "ended"]
    groups = materialize(
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("lead")).filter("n > 1")
        .withColumn("next_path", F.monotonically_increasing_id()),
        "radix-groups",
    )
    split = rows.join(groups.hint("shuffle_hash"), keys, "left")
    open_ = F.col("n").isNotNull() & ~F.col("ended")
    return split.select(
        "id", "text_sha256",
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("lead")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.when(open_, F.col("next_path")).alias("path"),
        F.when(open_, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
    ), groups


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when their bytes are after lower-casing A-Z (or after ``normalise``); of equal
    texts the row with the largest id stays. A null text counts as empty, and so equals an empty
    one. A row without an id yields to any row with one; in a group without ids every row stays.
    Rows that repeat an id are one document: they count each in group_size and stay or go together.
    An empty table gives no rows. Other columns of ``docs`` are not looked at, whatever their names.
    """
    text = normalise if normalise is not None else ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), text.cast("binary").alias("rest"))
    rows = rows.select("id", F.sha2("rest", 256).alias("text_sha256"), "rest")
    keys: list[str] = []
    width, settled = FIRST_DIGIT, []
    while True:
        split, groups = _split(rows, width, keys)
        if groups.filter(~F.col("ended")).isEmpty():
            settled.append(split)
            break
        split = materialize(split, "radix-level")
        settled.append(split.filter(F.col("path").isNull()))
        rows = split.filter(F.col("path").isNotNull()).select("id", "text_sha256", "path", "rest")
        keys, width = ["path"], width * GROWTH
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, all its columns unchanged: one with the group's largest id.

    Of rows that repeat id and text any one stays; in a group without ids one does. Where an id has
    several texts, each is a row of its own group. Rows are found again by id and SHA-256.
    """
    groups = exact_groups(docs, id_col, text_col).filter("group_size > 1")
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return one_row_each(
        docs, groups.select(F.col(id_col).alias("id"), F.col("text_sha256").alias("key"), F.col("kept").alias("stays")),
        F.sha2(text.cast("binary"), 256), id_col)
