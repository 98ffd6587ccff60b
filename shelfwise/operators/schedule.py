"""A weekly broadcast grid: the slot of a play, candidates for a slot, and breaks of the energy curve.

A slot has ``station``, ``slot_id``, ``days`` (1 is Monday), ``start_min`` and ``end_min`` of the day, and a
``priority``, the smaller the stronger. A slot whose end is not after its start runs over midnight, and a whole day if both are equal.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.digests import pairs_from
from shelfwise.session import materialize

DAY_MIN = 1440
#: Energies are the levels 1 to 5.
LEVELS = 5
#: Largest tables that are sent to all tasks; beyond it both sides are shuffled.
SENT_ROWS = 100_000
COOLDOWN_S = 7 * 86_400
#: Requests and files of a kind that meet in one place, about, and the most tasks they are dealt to.
TILE_REQUESTS, TILE_FILES, MOST_TASKS = 2_000, 16_000, 20_000


def segments(slots: DataFrame) -> DataFrame:
    """(station, day, start_min, end_min, slot_id, priority): slots by day, split at midnight.

    Days outside 1 to 7 and minutes outside the day have no segment; a null day or minute has none either.
    """
    start, end = F.col("start_min"), F.col("end_min")
    inside = start.between(0, DAY_MIN - 1) & end.between(0, DAY_MIN)
    once = slots.filter(inside).withColumn("day", F.explode(F.array_distinct("days"))).filter(F.col("day").between(1, 7))

    def part(day: Column, low: Column, high: Column) -> Column:
        return F.struct(day.cast("int").alias("day"), low.cast("int").alias("start_min"), high.cast("int").alias("end_min"))

    tomorrow = F.col("day") % 7 + 1
    parts = F.when(start < end, F.array(part(F.col("day"), start, end))).otherwise(
        F.array(part(F.col("day"), start, F.lit(DAY_MIN)), part(tomorrow, F.lit(0), end)))
    out = once.select("station", "slot_id", "priority", F.explode(parts).alias("s"))
    return out.select("station", "s.*", "slot_id", "priority").filter(F.col("start_min") < F.col("end_min"))


def weekly_grid(slots: DataFrame) -> DataFrame:
    """The segments without overlap: each stretch belongs to the strongest slot, ties to the smaller id.

    A station's day has 1,440 stretches at most, however many slots there are.
    """
    parts = materialize(segments(slots), "segments")
    edges = parts.select("station", "day", F.explode(F.array("start_min", "end_min")).alias("start_min")).distinct()
    following = F.lead("start_min").over(Window.partitionBy("station", "day").orderBy("start_min"))
    stretches = edges.withColumn("end_min", following).filter("end_min is not null")
    slot = parts.select("station", "day", F.col("start_min").alias("low"), F.col("end_min").alias("high"), "slot_id", "priority")
    held = stretches.join(slot, ["station", "day"]).filter((F.col("low") <= F.col("start_min")) & (F.col("start_min") < F.col("high")))
    best = held.groupBy("station", "day", "start_min", "end_min").agg(F.min(F.struct(F.col("priority").isNull(), "priority", "slot_id")).alias("best"))
    return best.select("station", "day", "start_min", "end_min", F.col("best.slot_id").alias("slot_id"))


def _by_hour(grid: DataFrame) -> DataFrame:
    """A row for each hour that a stretch touches."""
    hours = F.sequence(F.expr("start_min div 60").cast("int"), F.expr("(end_min - 1) div 60").cast("int"))
    return grid.withColumn("hour", F.explode(hours))


def small(df: DataFrame) -> DataFrame:
    """A written table, to be sent to all tasks if it is proven to be small."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def slot_of_play(plays: DataFrame, slots: DataFrame, time_col: str = "ts") -> DataFrame:
    """``plays`` with the ``slot_id`` that is on air at their station and time; null where none is.

    Grid hours join plays on equality, so a play meets only the stretches of its hour. The grid is written first: a
    small one goes to all tasks and plays stay where they are, a large one is on the right, where a busy hour can be split.
    A play without station or time has no slot. ``slot_id`` replaces a column of that name.
    """
    grid = small(materialize(_by_hour(weekly_grid(slots)).select(
        F.col("station").alias("_station"), F.col("day").alias("_day"), F.col("hour").alias("_hour"),
        F.col("start_min").alias("_start"), F.col("end_min").alias("_end"), "slot_id"), "grid"))
    ts = F.col(time_col)
    minute = F.hour(ts) * 60 + F.minute(ts)
    here = (
        (F.col("station") == F.col("_station")) & (F.weekday(ts) + 1 == F.col("_day")) & (F.hour(ts) == F.col("_hour"))
        & (F.col("_start") <= minute) & (minute < F.col("_end"))
    )
    return plays.drop("slot_id").join(grid, here, "left").drop("_station", "_day", "_hour", "_start", "_end")


def _digits(seed: str, group: Column, item: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("|", F.lit(seed), group.cast("string"), item.cast("string")).cast("binary")), 1, 12)


def draw_key(seed: str, group: Column, item: Column, weight: Column) -> Column:
    """-ln(u) / weight with u from a hash of seed, group and item: the smallest keys are a weighted draw without replacement."""
    return _key(F.conv(_digits(seed, group, item), 16, 10).cast("bigint"), weight)


def _key(number: Column, weight: Column) -> Column:
    return -F.log((number + 1) / F.lit(float(1 << 48))) / weight


def cooling(requests: DataFrame, history: DataFrame, cooldown_s: int = COOLDOWN_S) -> DataFrame:
    """(request_id, file) of what a request's station played in the ``cooldown_s`` seconds before it.

    ``history`` is station, file, ts. Plays become one row for each file and day, or each cooldown if that is shorter; a
    request meets only those its time reaches back to. The ends are exact: of the first day the last play counts, of the last day the first.
    Requests that carry a ``file`` ask for that file only, so what is made does not grow with what the station played.
    """
    file = ["file"] if "file" in requests.columns else []
    width = min(86_400, cooldown_s)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    day = F.floor(at / (width * 1_000_000))
    played = history.groupBy("station", "file", day.alias("bin")).agg(F.min(at).alias("first"), F.max(at).alias("last"))
    asked = requests.select("request_id", "station", *file, F.unix_micros(F.col("at").cast("timestamp")).alias("at"))
    since = F.col("at") - cooldown_s * 1_000_000
    low, high = F.floor(since / (width * 1_000_000)), F.floor(F.col("at") / (width * 1_000_000))
    asked = asked.withColumn("since", since).withColumn("bin", F.explode(F.sequence(low, high)))
    recent = asked.join(materialize(played, "played"), ["station", *file, "bin"])
    return recent.filter((F.col("last") >= F.col("since")) & (F.col("first") < F.col("at"))).select("request_id", "file").distinct()


def _tiles(requests: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides by (kind, part, piece): each request meets each file of its kind in one tile, and no tile is larger than others by much.

    ``requests`` and ``files`` have ``kind``; requests have ``n_files``, how many files there are of it, and ``nth``, their number.
    """
    many = materialize(requests.groupBy("kind").agg(
        F.ceil(F.count(F.lit(1)) / TILE_REQUESTS).cast("int").alias("parts"), F.ceil(F.max("n_files") / TILE_FILES).cast("int").alias("pieces")), "tiles")
    n = max(int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")), many.agg(F.sum(F.col("parts") * F.col("pieces"))).first()[0] or 0)
    n, tile = min(n, MOST_TASKS), ["kind", "part", "piece"]
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = files.join(many, "kind").withColumn("piece", F.pmod(F.xxhash64("file"), F.col("pieces")).cast("int")).withColumn("part", each("parts"))
    spread = F.pmod(F.xxhash64("request_id", "nth"), F.col("parts")).cast("int")
    right = requests.join(many, "kind").withColumn("part", spread).withColumn("piece", each("pieces"))
    return left.drop("parts", "pieces").repartition(n, *tile), right.drop("parts", "pieces", "nth").repartition(n, *tile)


def _drawn(asked: DataFrame, files: DataFrame, seed: str, expected: int) -> DataFrame:
    """(request_id, file, key, whole) of the pairs with the smallest keys: ``expected`` for each request, about, or all if they are few.

    A key is exponential with the weight as its rate, so about ``limit`` times the sum of weights lie below a ``limit``. Keys up to the
    limit are complete. Those that cannot be are told by the digest alone, before a logarithm is taken. Digests are made for a whole tile
    at a time in numpy; only the pairs that are left become rows.
    """
    own = Window.partitionBy("request_id")
    n, total = F.sum("n_files").over(own), F.sum("total").over(own)
    whole = (n <= 4 * expected) | F.isnan(total) | (total == float("inf"))
    asked = asked.withColumn("whole", whole).withColumn("limit", F.when(~whole, F.lit(float(expected)) / total))
    least = F.exp(-F.col("limit") * F.col("most")) * float(1 << 48) * (1 - 1e-9) - 2
    asked = asked.withColumn("least", F.when(F.col("limit").isNull(), 0).otherwise(F.greatest(least, F.lit(0.0)).cast("bigint")))
    left, right = _tiles(asked.withColumn("group", F.col("request_id").cast("string")), files.withColumn("item", F.col("file").cast("string")))
    kinds = {c: df.schema[c].dataType.simpleString() for df, cs in ((asked, ("request_id", "whole", "limit")), (files, ("file", "weight"))) for c in cs}
    schema = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items()) + ", number bigint"
    tile = ["kind", "part", "piece"]
    pairs = right.groupBy(*tile).cogroup(left.groupBy(*tile)).applyInArrow(_numbered(seed), schema)
    drawn = pairs.withColumn("key", _key(F.col("number"), F.col("weight")))
    return drawn.filter(F.col("whole") | (F.col("key") <= F.col("limit"))).select("request_id", "file", "key", "whole")


def _numbered(seed: str) -> Callable:
    """The pairs of a tile whose number, that of ``_digits``, is at least their request's ``least``."""
    begin = seed.encode()

    def run(requests: pa.Table, files: pa.Table) -> pa.Table:
        heads = [begin if g is None else begin + b"|" + g.encode() for g in requests["group"].to_pylist()]
        tails = [b"" if i is None else b"|" + i.encode() for i in files["item"].to_pylist()]
        found = list(pairs_from(heads, tails, requests["least"].to_numpy()))
        at, of, number = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        out = {c: requests[c].take(pa.array(at)) for c in ("request_id", "whole", "limit")} | {c: files[c].take(pa.array(of)) for c in ("file", "weight")}
        return pa.table(out | {"number": pa.array(number)})

    return run


def slot_candidates(requests: DataFrame, files: DataFrame, history: DataFrame, k: int, seed: str, cooldown_s: int = COOLDOWN_S) -> DataFrame:
    """(request_id, rank, file): up to ``k`` files drawn for each request by weight, without replacement.

    A request has request_id, station, at, energy_min, energy_max, era and culture; null era or culture takes any. A file has file,
    station, energy, era, culture and weight; one without a positive weight is never drawn. Files the station
    played within the cooldown are left out. The draw is fixed by ``seed``: the same tables give the same files, and a file's chance grows with
    its weight. Requests without a fitting file have no row; repeated files of a station count once, with the largest weight.

    Each fitting pair is drawn, as its key depends on both, but only pairs below a limit that leaves some more than ``k`` are
    stored and looked up in the history. A request that gets fewer than ``k`` is asked again with a limit eight times as wide.
    """
    low, high = F.greatest("energy_min", F.lit(1)).cast("int"), F.least("energy_max", F.lit(LEVELS)).cast("int")
    asked = requests.filter(low <= high).select(
        "request_id", "station", F.explode(F.sequence(low, high)).alias("energy"), F.col("era").alias("_era"), F.col("culture").alias("_culture"))
    traits = F.max(F.struct("weight", "energy", "era", "culture")).alias("f")
    usable = files.filter((F.col("weight") > 0) & ~F.isnan(F.col("weight").cast("double"))).groupBy("station", "file").agg(traits)
    usable = materialize(usable.select("station", "file", "f.*").withColumn("energy", F.col("energy").cast("int")), "files")
    # Files of one kind fit the same requests.
    weight = F.col("weight").cast("double")
    kinds = usable.groupBy("station", "energy", "era", "culture").agg(F.count(F.lit(1)).alias("n_files"), F.sum(weight).alias("total"), F.max(weight).alias("most"))
    kinds = materialize(kinds.withColumn("kind", F.monotonically_increasing_id()), "kinds")
    named = kinds.select("kind", F.col("station").alias("_s"), F.col("energy").alias("_e"), F.col("era").alias("_r"), F.col("culture").alias("_c"))
    same = (F.col("station") == F.col("_s")) & (F.col("energy") == F.col("_e")) & F.col("era").eqNullSafe(F.col("_r")) & F.col("culture").eqNullSafe(F.col("_c"))
    usable = usable.join(named, same).select("kind", "file", "weight")
    fits = (F.col("_era").isNull() | (F.col("_era") == F.col("era"))) & (F.col("_culture").isNull() | (F.col("_culture") == F.col("culture")))
    asked = materialize(asked.join(kinds, ["station", "energy"]).filter(fits).select(
        "request_id", "kind", "n_files", "total", "most", F.monotonically_increasing_id().alias("nth")), "requests")
    times = requests.select(F.col("request_id").alias("_id"), "station", "at")
    order = Window.partitionBy("request_id").orderBy("key", "file")
    out, expected = None, 4 * k + 20
    while True:
        drawn = materialize(_drawn(asked, usable, seed, expected), "drawn")
        looked_up = drawn.select("request_id", "file").distinct()
        looked_up = looked_up.join(times, F.col("request_id") == F.col("_id")).select("request_id", "station", "at", "file")
        free = drawn.join(materialize(cooling(looked_up, history, cooldown_s), "cooling"), ["request_id", "file"], "left_anti")
        ranked = materialize(free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "ranked")
        done = ranked.filter(F.col("whole") | (F.col("rank") == k)).select(F.col("request_id").alias("_id")).distinct()
        same_id = F.col("request_id").eqNullSafe(F.col("_id"))
        full = ranked.join(done, same_id, "left_semi").select("request_id", "rank", "file")
        out = full if out is None else out.unionByName(full)
        # Requests whose pairs were all looked at leave, with fewer files or none.
        own = Window.partitionBy("request_id")
        wider = asked.withColumn("_n", F.sum("n_files").over(own)).withColumn("_w", F.sum("total").over(own))
        wider = wider.filter((F.col("_n") > 4 * expected) & ~F.isnan("_w") & (F.col("_w") < float("inf"))).drop("_n", "_w")
        asked = materialize(wider.join(done, same_id, "left_anti"), "requests")
        if asked.isEmpty():
            return out
        expected *= 8


def energy_breaks(plays: DataFrame, low: int = 1, high: int = 5) -> DataFrame:
    """Plays of energy ``high`` that follow one of ``low`` at the same station: (station, ts, play_id, before).

    ``before`` is the id of the play before. Plays are ordered by (ts, play_id); those without station, time or energy are passed over. Orders run inside a
    station's days, and each day gets the last play of the days before it, so a station that plays without end is no single task.
    """
    usable = plays.select("station", "ts", "play_id", "energy").dropna().withColumn("day", F.to_date("ts"))
    this = F.struct("ts", "play_id", "energy")
    usable = usable.withColumn("this", this)
    ends = usable.groupBy("station", "day").agg(F.max("this").alias("last"))
    ends = materialize(ends.select("station", "day", F.lag("last").over(Window.partitionBy("station").orderBy("day")).alias("earlier")), "days")
    inside = F.lag("this").over(Window.partitionBy("station", "day").orderBy("ts", "play_id"))
    ordered = usable.withColumn("prior", inside).join(ends, ["station", "day"])
    prior = F.coalesce("prior", "earlier")
    return ordered.filter((F.col("energy") == high) & (prior["energy"] == low)).select("station", "ts", "play_id", prior["play_id"].alias("before"))
