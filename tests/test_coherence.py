"""Profiles, outliers, recommendations and splits against direct computation."""

import collections
import random
import statistics

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import coherence, splitting

TAGS = [f"t{chr(97 + i)}" for i in range(14)]


@pytest.fixture(scope="module", params=[1, 2])
def data(request, spark):
    rng = random.Random(request.param)
    names = {p: ("2020 mix" if p == 3 else f"List {p}") for p in range(12)}
    rows = []
    for n in range(1500):
        p = rng.choice([0, 0, 0, *range(12)])
        mine = [TAGS[(p + k) % 14] for k in range(4)]
        tags = sorted(set(rng.sample(mine, rng.randint(0, 3)) + (rng.sample(TAGS, 1) if rng.random() < 0.2 else [])))
        energy = None if rng.random() < 0.3 else round(rng.random() ** 3, 3)
        rows.append((p, n, f"artist {rng.randrange(40)}", f"track {n}", "", tags, energy, None if rng.random() < 0.1 else rng.random()))
    df = spark.createDataFrame(rows, "playlist int, ordinal int, artist string, track string, album string, tags array<string>, energy double, valence double")
    listed = spark.createDataFrame([(p, n, p) for p, n in names.items()], "playlist int, name string, pos int")
    return rows, df, names, listed


def profile_of(rows, playlist, size):
    df = collections.Counter(t for r in rows if r[0] == playlist for t in r[5])
    return df, [t for t, _ in sorted(df.items(), key=lambda kv: (-kv[1], kv[0]))[:size]]


def test_outliers_and_recommendations(spark, data):
    rows, df, names, listed = data
    size = 4
    facts = {}
    for p in names:
        mine = [r for r in rows if r[0] == p]
        known = [r[6] for r in mine if r[6] is not None]
        facts[p] = (*profile_of(rows, p, size), max(sum(bool(r[5]) for r in mine), 1), statistics.fmean(known) if len(known) >= 15 else None)

    def best(tags, current, energy):
        top, top_score = "", 0.0
        for p in names:
            if p == current or names[p].startswith("20"):
                continue
            frequency, _, n, mean = facts[p]
            score = sum(frequency[t] for t in tags) / n
            if energy is not None and mean is not None:
                score *= 1 - 0.5 * abs(energy - mean)
            if score > top_score + 1e-12:
                top, top_score = str(p), score
        return top if top_score >= 0.3 else ""

    want = set()
    for p in names:
        mine = [r for r in rows if r[0] == p]
        if not names[p].startswith("20"):
            want |= {(p, r[1], "genre", best(r[5], p, r[6])) for r in mine if r[5] and not set(r[5]) & set(facts[p][1])}
        featured = [r for r in mine if r[6] is not None]
        for kind, i in (("energy", 6), ("valence", 7)):
            known = [r[i] for r in featured if r[i] is not None]
            if len(known) < 15:
                continue
            mean, std = statistics.fmean(known), statistics.pstdev(known)
            want |= {
                (p, r[1], kind, best(r[5], p, r[6])) for r in featured
                if r[i] is not None and std >= 0.05 and abs((r[i] - mean) / std) > 2.2
            }
    got = {(r["playlist"], r["ordinal"], r["kind"], r["recommended"]) for r in coherence.all_outliers(df, listed, size).collect()}
    assert got == want and {k[2] for k in want} >= {"genre", "energy"} and any(k[3] for k in want)


def test_summary_counts_aligned_rows(spark, data):
    rows, df, names, listed = data
    profile = coherence.profile_tags(coherence.tag_frequency(df), 4)
    got = {r["playlist"]: r for r in coherence.coherence_summary(df, profile, listed).collect()}
    for p in names:
        tagged = [r for r in rows if r[0] == p and r[5]]
        top = profile_of(rows, p, 4)[1]
        aligned = sum(bool(set(r[5]) & set(top)) for r in tagged)
        assert got[p]["aligned_pct"] == pytest.approx(100 * aligned / len(tagged))
    assert got[3]["profile"] == "fourre-tout"


@pytest.mark.parametrize("limit", [20, 1_000_000])
def test_split(spark, data, limit):
    rows, df, names, listed = data
    detail = splitting.split_detail(df, listed, max_group_rows=limit).collect()
    mine = [r for r in rows if r[0] == 0]
    assert len(mine) >= 120
    n = len(mine)
    frequency = collections.Counter(t for r in mine for t in r[5])
    candidates = [t for t, c in sorted(frequency.items(), key=lambda kv: (-kv[1], kv[0])) if c <= 0.6 * n and c >= max(12, 0.08 * n)][:8]
    groups = collections.defaultdict(list)
    for r in mine:
        groups[next((c for c in candidates if c in r[5]), "divers")].append(r)
    for tag in [t for t, g in groups.items() if t != "divers" and len(g) < 12]:
        groups["divers"] += groups.pop(tag)
    want = {}
    for tag, members in groups.items():
        members.sort(key=lambda r: (r[6] is None, r[6] or 0.0, r[1]))
        for i, r in enumerate(members):
            want[r[1]] = f"List 0 — {tag}" + (f" (Vol. {i // 37 + 1})" if len(members) > 37 else "")
    got = {r["ordinal"]: r["sub_playlist"] for r in detail if r["playlist"] == 0}
    assert got == want
    plan = splitting.split_plan(splitting.split_detail(df, listed)).filter("playlist = 0").collect()
    assert sum(r["tracks"] for r in plan) == n and all(r["tracks"] <= 37 and r["minutes"] == 4 * r["tracks"] for r in plan)


def test_outliers_store_only_what_they_read(spark, data, monkeypatch):
    """Texts of tracks are not written, and tag sets go by numbers."""
    rows, df, names, listed = data
    stored, write = {}, coherence.materialize

    def kept(frame, name):
        stored[name] = dict(frame.dtypes)
        return write(frame, name)

    monkeypatch.setattr(coherence, "materialize", kept)
    assert coherence.all_outliers(df, listed, 4, 8, 15, 1.5).count()
    assert set(stored["profiled"]) == {"playlist", "ordinal", "tags", "energy", "valence"}
    assert stored["scores"]["_set"] == "bigint"


def test_z_outliers_move_rows_once(spark, data):
    rows, df, names, listed = data
    found = coherence.z_outliers(df, threshold=1.2, min_featured=5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = found._jdf.queryExecution().optimizedPlan().toString()
        got = {(r["playlist"], r["ordinal"], r["feature"]): (r["value"], r["z"]) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = {}
    for p in names:
        for f, c in (("energy", 6), ("valence", 7)):
            values = [r[c] for r in rows if r[0] == p and r[c] is not None]
            if len(values) >= 5 and statistics.pstdev(values) >= 0.05:
                mean, std = statistics.fmean(values), statistics.pstdev(values)
                expected |= {(p, r[1], f): (r[c], (r[c] - mean) / std) for r in rows if r[0] == p and r[c] is not None and abs((r[c] - mean) / std) > 1.2}
    assert got.keys() == expected.keys() and expected
    assert all(got[k] == pytest.approx(expected[k]) for k in got)
    assert "Expand" not in text.split("Relation")[0]  # rows are joined before they become one for each feature
