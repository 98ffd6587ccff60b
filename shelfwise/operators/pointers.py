"""Where chains of pointers end, by doubling over the rows that other rows go through."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize


def follow(links: DataFrame) -> DataFrame:
    """Ends of chains: ``id, parent`` to ``id, root`` for every row that has a parent.

    ``links`` is a stored table with unique ids; a row without a parent is a root, and a parent
    without a row ends its chain as well. On a cycle, or leading into one, ``root`` is null.

    A row that no other row names needs the end of its parent only, so just the named rows with a
    parent are doubled. A round moves the open ones and writes nothing else: rows that reached their
    end stay in the table of the round that settled them. A chain of n steps needs log2(n) rounds.
    """
    chained = links.filter("parent IS NOT NULL").select("id", "parent")
    named = chained.select(F.col("parent").alias("id")).distinct()
    inner = chained.join(named, "id", "left_semi").withColumn("done", F.lit(False))
    rounds: list[DataFrame] = []
    current, n_open, n_settled = inner, 1, 1
    # A row at a finite distance has rows at every smaller one before it, so a round that
    # settles nothing leaves only cycles.
    while n_open and n_settled:
        settled = [r.filter("done") for r in rounds]
        target = reduce(DataFrame.unionByName, settled, current.filter("NOT done")).select(
            F.col("id").alias("parent"), F.col("parent").alias("_up"), F.col("done").alias("_done")
        )
        moved = current.filter("NOT done").join(target, "parent", "left").select(
            "id", F.coalesce("_up", "parent").alias("parent"), F.coalesce("_done", F.lit(True)).alias("done")
        )
        current = materialize(moved, "pointers")
        rounds.append(current)
        n_open, n_settled = current.agg(F.count_if(~F.col("done")), F.count_if("done")).first()
    ends = [r.filter("done").select(F.col("id").alias("parent"), F.col("parent").alias("root")) for r in rounds]
    if n_open:
        ends.append(current.filter("NOT done").select(F.col("id").alias("parent"), F.lit(None).cast(links.schema["id"].dataType).alias("root")))
    through = reduce(DataFrame.unionByName, ends).withColumn("_inner", F.lit(True))
    return chained.join(through, "parent", "left").select(
        "id", F.when(F.col("_inner"), F.col("root")).otherwise(F.col("parent")).alias("root")
    )
