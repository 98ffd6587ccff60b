"""First-wins and last-wins rows, dense global numbering and ranks inside large groups.

Nothing here sends a whole table, or a whole group, through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize

# Rows of one group that a single task may sort. Larger groups are ranked by range.
MAX_GROUP_ROWS = 1_000_000
# Rows of a lookup that is sent to every task, checked by counting it first.
MAX_BROADCAST_ROWS = 1_000_000

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition above, row in partition below


def _one_per_key(df: DataFrame, key: Sequence[str], order: str, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*key, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def first_wins(df: DataFrame, key: Sequence[str], order: str = "ordinal") -> DataFrame:
    """One row per key, the one with the least ``order`` (reduced before the shuffle)."""
    return _one_per_key(df, list(key), order, F.min_by)


def last_wins(df: DataFrame, key: Sequence[str], order: str = "ordinal") -> DataFrame:
    """One row per key, the one with the greatest ``order``."""
    return _one_per_key(df, list(key), order, F.max_by)


def global_index(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "idx",
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Number all rows ``start, start+1, …`` in ``order``, which must be unique.

    Rows are range partitioned and sorted, and written once with their place inside the
    partition; the size of each partition then gives every partition its offset. The
    offsets table has one row per partition, whatever the data size. The written copy is
    needed because range bounds are sampled: they may differ from one run to the next.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    # The session's number of shuffle partitions is what sizes a partition.
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    fixed = materialize(placed, "index")
    part = F.shiftright("_place", _LOCAL_BITS)
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    sizes = fixed.groupBy(part.alias("_part")).count()
    offsets = sizes.select(
        "_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_offset")
    )
    return (
        fixed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (local + F.col("_offset") + F.lit(start)).alias(name))
    )


def with_sequential_id(
    df: DataFrame, order: Sequence[str], kind: str, width: int, name: str = "id",
    start: int = 1, prefix: str = "P6",
) -> DataFrame:
    """Ids ``P6-<kind>-<zero-padded n>`` in ``order``; a number may outgrow its padding."""
    numbered = global_index(df, order, "_n", start)
    text = F.format_string(f"{prefix}-{kind}-%0{width}d", F.col("_n"))
    return numbered.withColumn(name, text).drop("_n")


def grouped_rank(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rank",
    max_group_rows: int = MAX_GROUP_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each group ``1, 2, …`` in ``order`` (unique inside a group).

    Groups up to ``max_group_rows`` use a window. A larger group would be one task's sort,
    so such groups are spread by range over (group, order), numbered across the partitions
    and shifted to start at one. Group sizes (``group columns, count``) are counted first,
    with partial sums, unless the caller has them. Group columns must not be null.
    """
    group = list(group)
    if sizes is None:
        sizes = df.groupBy(*group).count()
    large = materialize(sizes.filter(F.col("count") > max_group_rows).select(*group), "large")
    n_large = large.count()  # at most rows / max_group_rows
    window = Window.partitionBy(*group).orderBy(*order)
    if n_large == 0:
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))
    large = bounded_broadcast(large, n_large)
    small_ranked = df.join(large, group, "left_anti").withColumn(
        name, F.row_number().over(window).cast("bigint")
    )
    spread = global_index(df.join(large, group, "left_semi"), [*group, *order], "_idx")
    starts = spread.groupBy(*group).agg(F.min("_idx").alias("_start"))
    spread_ranked = (
        spread.join(bounded_broadcast(starts, n_large), group)
        .withColumn(name, F.col("_idx") - F.col("_start") + 1)
        .select(*df.columns, name)
    )
    return small_ranked.select(*df.columns, name).unionByName(spread_ranked)


def top_k(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """The first ``k`` rows per group; the limit is applied before the shuffle as well."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def bounded_broadcast(df: DataFrame, rows: int, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only for a counted size within ``limit``; else a shuffle join."""
    return F.broadcast(df) if rows <= limit else df
