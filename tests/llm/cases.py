"""Rows that every operator must take: nulls, empty, blank and very long texts, repeats, clashing names."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Columns that operators use inside; they must not be mistaken for the operators' own.
CLASHING = ["id", "rest", "n", "sid", "tid", "row", "kept", "task", "local", "shard", "entities", "rank", "spans", "key", "digit", "_key", "_id", "_listed", "_stays", "_attempts", "_tid"]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    stems = ["than", "ed", "ing", "Re", "tion", "é", "ß", "straße", "漢字", "don't", "1st"]
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) + rng.choice(["", "", ",", "."]) for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
    return " ".join(words)


def hard_texts() -> list[str | None]:
    base, passage = prose(1, 120), prose(2, 50)
    texts: list[str | None] = [None, "", " \t\n", "one", "One", "two words", "\x0b\x0c\r", "no break space", "!!! 123 ...", "🙂", "a" * 5000]
    texts += [base, base.upper(), base.lower(), base + " ", base]
    texts += [edited(base, i, e) for i, e in enumerate((1, 2, 3, 4, 8, 20))]
    texts += [prose(10 + i, 40) + " " + passage + " " + prose(20 + i, 40) for i in range(4)]
    texts += ["again and again " * 60, "again and again " * 61, prose(3, 9000), prose(3, 9000) + " tail", passage]
    texts += [edited(prose(4, 200), i, 2) for i in range(12)]
    return texts


def hard_rows() -> list[tuple]:
    rows = [(i, t, ["en", "fr", None][i % 3], f"src{i % 3}" if i % 4 else None, None if t is None else len(t)) for i, t in enumerate(hard_texts())]
    rows += [rows[11], rows[11], (None, rows[11][1], None, None, None), (None, "only here, without an id, " * 10, "en", "s", 1), (77, None, None, None, None)]
    return rows


def hard_docs(spark, clashing: bool = False):
    docs = spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)
    if clashing:
        from pyspark.sql import functions as F

        docs = docs.withColumns({name: F.lit("x") for name in CLASHING})
    return docs


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
