"""The weekly grid, the draw with its cooldown and the energy breaks, against plain loops."""

import datetime as dt
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.functions import digests
from shelfwise.operators import schedule as S

MONDAY = dt.datetime(2026, 3, 2)
SLOT = "station string, slot_id long, days array<int>, start_min int, end_min int, priority int"
PLAY = "station string, play_id long, ts timestamp, energy int"


def on_air(slots, station, ts):
    """The strongest slot at a time, by looking at each."""
    week = (ts.isoweekday() - 1) * 1440 + ts.hour * 60 + ts.minute
    held = []
    for place, slot, days, start, end, priority in slots:
        if place != station or place is None or start is None or end is None or not (0 <= start < 1440 and 0 <= end <= 1440):
            continue
        length = (end - start) if end > start else end - start + 1440
        for day in days or []:
            if day is not None and 1 <= day <= 7 and (week - (day - 1) * 1440 - start) % 10080 < length:
                held.append((priority is None, priority or 0, slot))
    return min(held)[2] if held else None


def grid_slots(seed):
    rng = random.Random(seed)
    slots = [(rng.choice("ab"), i, rng.sample(range(1, 8), 2), rng.randrange(1440), rng.randrange(1441), rng.choice([1, 2, 3, None])) for i in range(25)]
    return slots + [("a", 90, [7], 1380, 120, 0), ("a", 91, [3], 600, 600, 9), ("b", 92, [0, 8, None, 2, 2], 0, 1440, 5), ("a", 93, None, 5, 9, 0), ("a", 94, [1], None, 9, 0),
                    ("a", 95, [1], -5, 9, 0), ("a", 96, [1], 5, 1500, 0), (None, 97, [1], 0, 10, 0)]


@pytest.mark.parametrize("sent", [0, 100_000])
def test_slot_of_every_ten_minutes(spark, monkeypatch, sent):
    monkeypatch.setattr(S, "SENT_ROWS", sent)
    slots = grid_slots(sent)
    plays = [(s, i, MONDAY + dt.timedelta(minutes=10 * i + (i % 3)), 1) for s in ("a", "b", "c") for i in range(1008)] + [(None, 1, MONDAY, 1), ("a", 2, None, 1)]
    df = spark.createDataFrame(plays, PLAY).withColumns({c: F.lit("x") for c in ("slot_id", "day", "hour", "start_min")})
    found = S.slot_of_play(df, spark.createDataFrame(slots, SLOT)).collect()
    assert len(found) == len(plays)
    for r in found:
        assert r["slot_id"] == (on_air(slots, r["station"], r["ts"]) if r["station"] and r["ts"] else None), r


def test_grid_is_disjoint_and_whole(spark):
    rows = S.weekly_grid(spark.createDataFrame(grid_slots(5), SLOT)).collect()
    minutes = Counter((r["station"], r["day"], m) for r in rows for m in range(r["start_min"], r["end_min"]))
    assert max(minutes.values()) == 1
    assert S.weekly_grid(spark.createDataFrame([], SLOT)).count() == 0
    plan = S.slot_of_play(spark.createDataFrame([("a", 1, MONDAY, 1)], PLAY), spark.createDataFrame(grid_slots(5), SLOT))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


REQUEST = "request_id long, station string, at timestamp, energy_min int, energy_max int, era string, culture string"
FILE = "file long, station string, energy int, era string, culture string, weight double"
HISTORY = "station string, file long, ts timestamp"


def frames(spark, requests, files, history):
    return spark.createDataFrame(requests, REQUEST), spark.createDataFrame(files, FILE), spark.createDataFrame(history, HISTORY)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.sampled_from([3600, 86_400, 7 * 86_400, 100_000]))
def test_cooldown_property(spark, seed, cooldown):
    """No file is drawn that its station played within the cooldown, and every other fitting one is."""
    rng = random.Random(seed)
    when = lambda: MONDAY + dt.timedelta(seconds=rng.randrange(0, 20 * 86_400, 1800))
    requests = [(i, rng.choice("ab"), when(), rng.randint(0, 3), rng.randint(1, 6), rng.choice([None, "80s"]), rng.choice([None, "FR"])) for i in range(12)]
    files = [(i, rng.choice("ab"), rng.randint(1, 5), rng.choice(["80s", "90s", None]), rng.choice(["FR", "US"]), rng.choice([1.0, 2.0, 0.0, None, -1.0])) for i in range(40)]
    history = [(rng.choice("ab"), rng.randrange(40), when()) for _ in range(150)]
    history += [(r[1], i, r[2] - dt.timedelta(seconds=d)) for i, r in enumerate(requests) for d in (0, cooldown)]  # the ends of the window
    got = {}
    for r in S.slot_candidates(*frames(spark, requests, files, history), 100, "s", cooldown).collect():
        got.setdefault(r["request_id"], set()).add(r["file"])
    for request, station, at, low, high, era, culture in requests:
        fitting = {f for f, place, energy, e, c, w in files if place == station and low <= energy <= high and era in (None, e) and culture in (None, c) and w and w > 0}
        played = {f for place, f, ts in history if place == station and at - dt.timedelta(seconds=cooldown) <= ts < at}
        assert got.get(request, set()) == fitting - played


def test_draw_follows_weights_and_seed(spark):
    requests = [(i, "a", MONDAY, 1, 5, None, None) for i in range(3000)]
    files = [(1, "a", 1, "x", "y", 1.0), (2, "a", 2, "x", "y", 3.0), (3, "a", 2, "x", "y", 0.0), (2, "a", 9, "x", "y", 0.5)]
    tables = frames(spark, requests, files, [])
    first = S.slot_candidates(*tables, 2, "one").collect()
    ranks = Counter((r["rank"], r["file"]) for r in first)
    assert ranks[1, 1] + ranks[1, 2] == 3000 and ranks[2, 1] == ranks[1, 2]
    assert abs(ranks[1, 2] / 3000 - 0.75) < 0.03
    assert sorted(map(tuple, first)) == sorted(map(tuple, S.slot_candidates(*tables, 2, "one").collect()))
    assert sorted(map(tuple, first)) != sorted(map(tuple, S.slot_candidates(*tables, 2, "two").collect()))


def test_few_pairs_are_stored(spark, monkeypatch):
    """Draws equal to plain loops while only some more than k pairs of a request are stored, most files played or not."""
    monkeypatch.setattr(S, "TILE_REQUESTS", 3)
    monkeypatch.setattr(S, "TILE_FILES", 50)
    rng, k = random.Random(8), 2
    stations = {"a": 900, "b": 700, "c": 5}  # of b nearly all files were played, c has few
    files = [(i, s, rng.randint(1, 2), rng.choice(["80s", None]), "FR", rng.choice([1.0, 2.0, 7.0])) for s, n in stations.items() for i in range(n)]
    requests = [(i, "abc"[i % 3], MONDAY, 1, 2, rng.choice([None, "80s"]), None) for i in range(60)] + [(3, "a", MONDAY, 1, 1, None, None), (None, "a", MONDAY, 1, 2, None, None)]
    history = [("b", i, MONDAY - dt.timedelta(hours=1)) for i in range(697)] + [("a", i, MONDAY - dt.timedelta(days=i % 9)) for i in range(0, 900, 3)]
    stored, write = Counter(), S.materialize

    def counted(df, name):
        out = write(df, name)
        stored[name] = max(stored[name], out.count())
        return out

    monkeypatch.setattr(S, "materialize", counted)
    got = {}
    for r in S.slot_candidates(*frames(spark, requests, files, history), k, "s").collect():
        got.setdefault(r["request_id"], []).append((r["rank"], r["file"]))

    def key(request, file, weight):
        text = "|".join(str(x) for x in ("s", request, file) if x is not None)
        return -math.log((int(hashlib.md5(text.encode()).hexdigest()[:12], 16) + 1) / 2**48) / weight, file

    for request in {r[0] for r in requests}:
        own = [r for r in requests if r[0] == request]
        # The rule holds for the id: what any of its rows keeps away is kept away, a null id knows no history.
        away = {f for r in own for place, f, ts in history if r[0] is not None and place == r[1] and MONDAY - dt.timedelta(days=7) <= ts < MONDAY}
        keys = sorted(key(request, f[0], f[5]) for r in own for f in files if f[1] == r[1] and r[3] <= f[2] <= r[4] and r[5] in (None, f[3]) and f[0] not in away)
        assert sorted(got.get(request, [])) == [(i + 1, f) for i, (_, f) in enumerate(keys[:k])], request
    assert stored["drawn"] < 12_000 and stored["cooling"] < 12_000, stored  # all that was played is some 18,000


def test_energy_breaks(spark):
    rng = random.Random(4)
    plays = [(rng.choice("ab"), i, MONDAY + dt.timedelta(hours=rng.randrange(0, 400, 5)), rng.randint(1, 5)) for i in range(300)]
    plays += [("a", 900, None, 5), (None, 901, MONDAY, 5), ("a", 902, MONDAY, None), ("c", 903, MONDAY, 1), ("c", 904, MONDAY + dt.timedelta(days=90), 5)]
    expected = []
    for station in "abc":
        own = sorted((p for p in plays if p[0] == station and None not in p), key=lambda p: (p[2], p[1]))
        expected += [(station, b[2], b[1], a[1]) for a, b in zip(own, own[1:]) if a[3] == 1 and b[3] == 5]
    assert sorted(map(tuple, S.energy_breaks(spark.createDataFrame(plays, PLAY)).collect())) == sorted(expected)
    assert expected and ("c", MONDAY + dt.timedelta(days=90), 904, 903) in expected


def test_digests_of_pairs_are_made_without_rows(spark, monkeypatch):
    """Numbers of any lengths and bytes are those of MD5, also in small chunks; pairs that cannot be drawn never become rows."""
    rng = random.Random(5)
    heads = [b"s|" + str(rng.randrange(10**rng.randrange(1, 12))).encode() for _ in range(40)] + [b"", b"s", "s|é|∞".encode(), b"x" * 54, b"y" * 90]
    tails = [b"|" + str(rng.randrange(10**rng.randrange(1, 9))).encode() for _ in range(70)] + [b"", b"z" * 55, b"z" * 200]
    every = {(h, t): int(hashlib.md5(heads[h] + tails[t]).hexdigest()[:12], 16) for h in range(len(heads)) for t in range(len(tails))}
    for chunk in (1, 7, digests.CHUNK):
        monkeypatch.setattr(digests, "CHUNK", chunk)
        for least in (np.zeros(len(heads), np.int64), np.array([rng.randrange(1 << 48) for _ in heads])):
            found = {(int(h), int(t)): int(n) for hs, ts, ns in digests.pairs_from(heads, tails, least) for h, t, n in zip(hs, ts, ns)}
            assert found == {pair: n for pair, n in every.items() if n >= least[pair[0]]}
    requests = spark.createDataFrame([(i, 0, 400, 4000.0, 20.0, i) for i in range(6)], "request_id long, kind long, n_files long, total double, most double, nth long")
    files = spark.createDataFrame([(0, i, 10.0) for i in range(400)], "kind long, file long, weight double")
    drawn = S._drawn(requests, files, "s", 10)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" in plan and "Join" not in plan.split("CoGroups")[0]
    limit = 10 / 4000.0
    keys = {(r, f): -math.log((int(hashlib.md5(f"s|{r}|{f}".encode()).hexdigest()[:12], 16) + 1) / 2**48) / 10 for r in range(6) for f in range(400)}
    assert {(r["request_id"], r["file"]) for r in drawn.collect()} == {pair for pair, key in keys.items() if key <= limit}
