"""Column expressions against their rules."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import geo, numbers, paths, text
from shelfwise.operators.matching import title_variants


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_folds_agree_with_unicode_rules(spark):
    rng = random.Random(3)
    pool = [c for c in map(chr, range(0x20, 0x3100))] + [chr(c) for c in range(0x1D400, 0x1D7FF)] + list("ßﬁŉİΣς½™№Å")
    rows = ["".join(rng.choice(pool) for _ in range(12)) for _ in range(3000)]
    assert values(spark, rows, text.fold_ascii) == [
        unicodedata.normalize("NFKD", r).encode("ascii", "ignore").decode() for r in rows
    ]
    assert values(spark, rows, text.norm_ws) == [" ".join(r.casefold().split()) for r in rows]


@pytest.mark.parametrize("raw, key", [
    ("Éléphant (Live) [2004]", "elephant"),
    ("Song feat. Someone", "song"),
    ("Song FEAT Someone\nsecond line", "songsecondline"),
    ("Feature film", "featurefilm"),
    ("Ft. Worth", ""),
    ("Straße", "strae"),
    ("ﬁn", "fin"),
    ("東京", ""),
    ("(Live)", ""),
    ("a (b [c) d] e", "ade"),
    ("fe東at x", ""),
    (None, ""),
])
def test_norm_key(spark, raw, key):
    assert values(spark, [raw], text.norm_key) == [key]


def test_norm_place_keeps_featuring_and_brackets(spark):
    assert values(spark, ["Café (feat. X)"], text.norm_place) == ["cafefeatx"]


def test_weak_keys_differ_before_and_after_normalising(spark):
    rows = [("a", "(Live)"), ("a", "12"), ("", "x"), ("a", "b"), (None, "b")]
    df = spark.createDataFrame(rows, "a string, t string")
    out = df.select(
        text.is_weak_tag(F.col("a"), F.col("t")).alias("raw"),
        text.is_strong_dedup_key(text.norm_key(F.col("a")), text.norm_key(F.col("t"))).alias("strong"),
    ).collect()
    assert [(r["raw"], r["strong"]) for r in out] == [(False, False), (True, False), (True, False), (False, True), (True, False)]


def bisect(lat, lon, precision):
    low, high, out = [-180.0, -90.0], [180.0, 90.0], ""
    value, n = 0, 0
    while len(out) < precision:
        axis, x = n % 2, (lon, lat)[n % 2]
        middle = (low[axis] + high[axis]) / 2
        value = value * 2 + (x >= middle)
        if x >= middle:
            low[axis] = middle
        else:
            high[axis] = middle
        n += 1
        if n % 5 == 0:
            out, value = out + geo.BASE32[value], 0
    return out


@pytest.mark.parametrize("precision", [1, 2, 7, 8, 12])
def test_geohash_is_the_bisection(spark, precision):
    rng = random.Random(precision)
    points = [(rng.uniform(-95, 95), rng.uniform(-190, 190)) for _ in range(2000)]
    points += [(180 * rng.randrange(2**17 + 1) / 2**17 - 90, 360 * rng.randrange(2**18 + 1) / 2**18 - 180) for _ in range(2000)]
    points += [(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0), (57.64911, 10.40744), (-1e-17, 1e-17)]
    df = spark.createDataFrame(points, "lat double, lon double").select("*", geo.geohash(F.col("lat"), F.col("lon"), precision).alias("g"))
    assert all(r["g"] == bisect(r["lat"], r["lon"], precision) for r in df.collect())


def test_geohash_of_a_missing_coordinate(spark):
    df = spark.createDataFrame([(None, 1.0)], "lat double, lon double")
    assert df.select(geo.geohash(F.col("lat"), F.col("lon")).alias("g")).first()["g"] is None


@pytest.mark.parametrize("url, expected", [
    ("https://m.example/search/48.876944,+2.382222", (48.876944, 2.382222, None)),
    ("https://m.example/@-38.7190,-9.1321,17z/!1s0xAb:0x1f", (-38.719, -9.1321, "0xAb:0x1f")),
    ("https://m.example/search/1.5,2.5/@9.9,9.9", (1.5, 2.5, None)),
    ("https://m.example/@38,9", (None, None, None)),
    ("", (None, None, None)),
])
def test_urls(spark, url, expected):
    df = spark.createDataFrame([(url,)], "u string")
    lat, lon = geo.url_coords(F.col("u"))
    assert tuple(df.select(lat.alias("a"), lon.alias("b"), geo.url_reference(F.col("u")).alias("c")).first()) == expected


@pytest.mark.parametrize("name, expected", [
    ("01 - Titre", ("", "01 - Titre")), ("Artist - Title", ("Artist", "Title")), ("01. - A - B - C", ("A", "B - C")),
    ("Brand#11 - 5 mix", ("Brand#11", "5 mix")), ("", ("", "")), ("a -  - b", ("a", "b")),
])
def test_guesses(spark, name, expected):
    assert tuple(values(spark, [name], paths.guess_artist_title)[0]) == expected


def test_paths(spark):
    rows = ["/mnt/m/a b/c.MP3", "D:\\x", "/mnt/data/x", "/a/.hidden", "/a/b.tar.gz"]
    assert values(spark, rows, paths.win_path)[:3] == ["M:\\a b\\c.MP3", "D:\\x", "/mnt/data/x"]
    assert values(spark, rows, paths.extension) == [".mp3", "", "", "", ".gz"]
    assert values(spark, rows, paths.stem)[3:] == [".hidden", "b.tar"]


def test_numbers(spark):
    rows = ["320.9", "", "abc", "NaN", " 12 ", None]
    assert values(spark, rows, numbers.safe_long) == [320, None, None, None, 12, None]
    assert values(spark, [0.125, 2.675, -0.5, None], numbers.round_even, "double") == [0.12, 2.68, -0.5, None]
    assert values(spark, [0, 59_999, 61_000, 600_000, None], numbers.minutes_seconds, "bigint") == ["", "0:59", "1:01", "10:00", ""]
    moods = spark.createDataFrame([(0.5, 0.4), (0.5, 0.39), (0.49, 0.4), (0.1, 0.1), (None, 0.1)], "e double, v double")
    assert [r[0] for r in moods.select(numbers.mood(F.col("e"), F.col("v"))).collect()] == [
        "energetic", "aggressive", "chill", "melancholic", ""
    ]


def test_title_variants(spark):
    assert values(spark, ["A - B (C)", "Plain", "X (Y"], title_variants) == [["A - B (C)", "A", "A - B"], ["Plain"], ["X (Y", "X"]]
