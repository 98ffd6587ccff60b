"""Gapless ranks inside groups without bringing a group together.

Tasks number the rows of each group on their own while they make them; what a task's numbers start
from is a sum over one small row per task and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_ranks(rows: DataFrame, group: str, rank: str = "rank") -> DataFrame:
    """``rows`` with ``rank`` from 0 in each ``group``.

    ``rows`` must be a written table with the columns ``task`` and ``local`` (from 0 within the task
    and group); both are dropped. A null group is a group.
    """
    counts = rows.groupBy("task", group).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("task").alias("_task"), F.col(group).alias("_group"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    same = (F.col("task") == F.col("_task")) & F.col(group).eqNullSafe(F.col("_group"))
    return rows.join(starts, same).withColumn(rank, F.col("local") + F.col("_start")).drop("task", "local", "_task", "_group", "_start")
