"""Whitening, secrets and collocations against numpy, Python's regular expressions and plain counting."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from cases import CLASHING, empty_docs, hard_docs, hard_rows
from pyspark.sql import functions as F

from shelfwise.llm import collocations as C
from shelfwise.llm import secrets as S
from shelfwise.llm import whitening as W

# ---- whitening

RNG = np.random.default_rng(7)


@pytest.mark.parametrize("a", [
    RNG.normal(size=(9, 9)), np.diag(10.0 ** -np.arange(12)) @ RNG.normal(size=(12, 12)), np.eye(6), np.zeros((4, 4)),
    np.ones((5, 5)), RNG.normal(size=(1, 1)), np.diag([3.0, 3, 3, 1, 1, 0]), RNG.normal(size=(8, 3)) @ RNG.normal(size=(3, 8)),
    np.linalg.qr(RNG.normal(size=(7, 7)))[0] @ np.diag([5, 5, 5, 5, 1, 1, 1e-9]) @ np.linalg.qr(RNG.normal(size=(7, 7)))[0], RNG.normal(size=(64, 64)),
], ids=lambda a: str(a.shape))
def test_singular_values_and_directions(a):
    d, e, right = W.bidiagonal(a)
    b = np.diag(d) + np.diag(e, 1)
    values, expected = W.squared_values(d, e), np.linalg.svd(a, compute_uv=False)
    assert np.allclose(np.sqrt(values), expected, rtol=1e-10, atol=1e-13 * max(1, expected[0]))
    k = int((values > values[0] * 1e-28).sum()) if values[0] else 0
    z = W.directions(d, e, values, k)
    assert np.abs(z.T @ z - np.eye(k)).max(initial=0) < 1e-12
    assert np.abs(b.T @ b @ z - z * values[:k]).max(initial=0) <= 1e-12 * max(values[0], 1e-300)


def test_graded_bidiagonal_keeps_relative_accuracy():
    d, e = 10.0 ** -np.arange(0, 40, 4), 10.0 ** -np.arange(1, 37, 4)
    product = math.prod(float(x) for x in d)  # the determinant, which a plain method loses
    assert math.isclose(math.prod(math.sqrt(v) for v in W.squared_values(d, e)), product, rel_tol=1e-12)


VECTORS = "vec_id long, embedding array<float>"


def frame(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    return df.withColumns({name: F.lit("x") for name in [*CLASHING, "v", "r", "part", "size", "at", "high"]}) if clashing else df


def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(3)
    data = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + rng.normal(size=12) * 5).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(5, rows[5][1]), (None, rows[6][1])]
    out = W.whiten(frame(spark, rows + [(900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [float("nan")] * 12), (904, [float("inf")] * 12),
                                        (905, [1.0, 2.0]), (906, [3e38] * 12)], clashing=True)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"]) for r in out) == sorted((r[0] is None, r[0]) for r in rows)
    x = np.floor(np.array([v for _, v in rows], np.float32).astype(np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:8]
    expected = y @ vectors[:, order] / np.sqrt(values[order])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    by_id = {r["vec_id"]: r for r in out}
    got = np.array([by_id[i]["whitened"] for i, _ in rows])
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got - expected * signs).max() < 1e-9
    assert [int(by_id[i]["deviation"]) for i, _ in rows] == deviation.tolist()
    assert np.allclose(out[0]["explained"], values[order] / values.sum(), rtol=1e-10)
    assert all(r["n"] == n and r["identity_error"] < 1e-10 for r in out)


def test_whitening_edges(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert W.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(4)])).count() == 0  # no variance
    two = W.whiten(frame(spark, [(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 0.0])])).collect()
    assert [len(r["whitened"]) for r in two] == [1, 1] and {round(abs(r["whitened"][0]), 9) for r in two} == {1.0}
    equal = W.whiten(frame(spark, [(i, [float(s * (j == i // 2)) for j in range(5)]) for i, s in enumerate([1, -1] * 5)])).collect()
    assert all(len(r["whitened"]) == 5 and r["identity_error"] < 1e-12 for r in equal)  # one cluster of five
    huge = W.whiten(frame(spark, [(i, [1e15 * i, float(i % 2)]) for i in range(3)]))
    x = [[int(np.float64(np.float32(1e15 * i)) * 1024) + 100_000, 1024 * (i % 2) + 100_000] for i in range(3)]
    sums = [sum(column) for column in zip(*x)]
    exact = sorted(sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x)
    assert sorted(int(r["deviation"]) for r in huge.collect()) == exact
    assert {r["deviation"] for r in W.by_component(huge).collect()} == {None if d >= 2**63 else d for d in exact}


def test_many_triangles_and_blocks(spark, monkeypatch):
    data = np.random.default_rng(5).normal(size=(500, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>").repartition(40)
    plain = {r["vec_id"]: np.abs(r["whitened"]) for r in W.whiten(df).collect()}
    monkeypatch.setattr(W, "FAN_IN", 4)
    for r in W.whiten(df).collect():
        assert np.allclose(np.abs(r["whitened"]), plain[r["vec_id"]], atol=1e-9)


# ---- secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


KEYS = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(300)]
CODES = ["AKIA" + hashlib.sha256(f"k{i}".encode()).hexdigest().upper()[:16].translate(str.maketrans("012", "XYZ")) for i in range(200)]
SECRETS = [
    f"pässword: no PASSWORD = '{KEYS[0]}' é secret:{KEYS[1][:8]}, token:short", f"🙂api_key={KEYS[2]}token={KEYS[3]}", "AKIA", "AKIA" * 5, "AKIAé" + CODES[0],
    "A" + CODES[1] + "b", "api-key: 12345678901", "token=secret=abcdefgh", "password\n=\nabcdefghijkl", "PASSWD\"   :   \"" + KEYS[4], KEYS[5] + KEYS[6], KEYS[7][:31], "ſecret=abcdefghijk",
    "toKen=abcdefghijk", " ".join(KEYS[8:12]), "x" * 3000 + KEYS[12], KEYS[13] + "\n" + KEYS[14], "token=" + "a" * 70_000,
]


def secret_docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_patterns_against_python(spark):
    texts = SECRETS + [r[1] for r in hard_rows()]
    found = S.with_counts(S.find_secrets(secret_docs(spark, texts), automata={}))
    for r in found.collect():
        spans = base_spans(texts[r["doc_id"]])
        line = ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r["spans"] == line and r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in S.KINDS] == [sum(k == i for _, k, _ in spans) for i in range(3)]


def test_scores_are_those_of_the_automaton():
    words = [w.encode() for w in ("banana", "bandana", "cabana", "AKIA12", "x-y=z", "a", "b" * 40)]
    automaton = S.infer(words[:4])
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = automaton.scores(data, ends - [len(w) for w in words], ends)
    for word, score in zip(words, got):
        state, total = 0, 0.0
        for c in word:
            symbol = S.TOKEN.index(c)
            total += automaton.shares[state, symbol]
            state = automaton.follow[state, symbol]
        assert math.isclose(score, total + automaton.shares[state, S.END])
    assert np.allclose(np.exp(automaton.shares).sum(axis=1), 1)


def test_inferred_automaton_generalises():
    """States of the random part are one; the fixed beginning keeps its own states; other formats are less likely."""
    automaton = S.infer([c.encode() for c in CODES[:100]])
    assert 5 <= len(automaton.shares) < 60
    tree = S._Tree([c.encode() for c in CODES[:100]])
    assert len(tree.total) > 1000

    def score(text):
        return float(automaton.scores(np.frombuffer(text.encode(), np.uint8), np.array([0]), np.array([len(text)]))[0]) / len(text)

    assert min(score(c) for c in CODES[100:]) > max(score(w) for w in ("internationalisation", "2024-01-02T03:04:05".replace(":", "."), KEYS[0][:20]))


def test_candidates_beside_the_patterns(spark):
    """Unlabelled values of a learned format are added; prose is left alone; base spans stay."""
    rng = np.random.default_rng(2)
    stems = ["inter", "nation", "al", "tele", "com", "muni", "ca", "tion", "re", "pub", "lish", "ed", "organ", "isa", "recom", "mend"]
    prose = [" ".join("".join(rng.choice(stems, 4)) for _ in range(12)) for _ in range(60)]
    prose += [f"call {a}-{b}-{a}{b} or pay {a}{b}{b}{a} by 20{a % 100:02d}-{b % 12:02d}-{a % 28:02d}" for a, b in rng.integers(1000, 9999, (150, 2))]
    labelled = [f"config {c} and token = {k}" for c, k in zip(CODES[:150], KEYS[:150])]
    bare = [f"seen éé {k[:30]} there" for k in KEYS[200:210]]
    texts = prose + labelled + bare
    out = {r["doc_id"]: r["spans"] for r in S.find_secrets(secret_docs(spark, texts)).collect()}
    first = len(prose) + len(labelled)
    assert all(not out[i] for i in range(len(prose)))
    for i, text in enumerate(texts):
        assert [(s["start"], s["end"]) for s in out[i] if s["score"] is None] == [(s, e) for s, _, e in base_spans(text)]
    hits = [i for i in range(first, len(texts)) if [(s["start"], s["end"]) for s in out[i]] == [(8, 38)]]
    assert len(hits) >= 0.9 * len(bare) and all(out[i][0]["kind"].startswith("like_") for i in hits)


def test_secret_rows(spark):
    docs = hard_docs(spark, clashing=True)
    out = S.find_secrets(docs)
    assert out.columns == ["doc_id", "spans"] and out.count() == len(hard_rows())
    assert S.find_secrets(empty_docs(spark)).count() == 0
    assert S.with_counts(S.find_secrets(empty_docs(spark))).columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def test_sample_is_bounded_and_distinct(spark):
    texts = [f"token={k}" for k in KEYS] * 3
    found = S.samples(secret_docs(spark, texts).select("text"), most=40)
    assert len(found["assign"]) == 40 == len(set(found["assign"])) and found["access"] == []
    assert found == S.samples(secret_docs(spark, texts).repartition(7).select("text"), most=40)


# ---- collocations


def brute_collocations(rows, least=30, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    out = []
    for p, a in candidates.items():
        lang, words = p[0], p[1:]
        if any(100 * b >= 80 * a and q[0] == lang and len(q) > len(p) and any(q[i:i + len(words)] == words for i in range(1, len(q))) for q, b in candidates.items()):
            continue
        cuts = [(2_000_000 * a // (f[lang, *words[:k]] + f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[lang, *words[:k]], f[lang, *words[k:]], n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(lang, i, *x[1:]) for i, x in enumerate(own, 1)]
    return sorted(ranked)


def phrase_rows():
    rng = np.random.default_rng(11)
    words = ["New", "york", "city", "of", "the", "à", "la", "carte", "x y", "漢字", "A", "b"]
    rows = [(" ".join(rng.choice(words, 40)) + rng.choice([".", "!", "\n", "\t", " "]) + "new york city of the", ["en", "fr", None][i % 3]) for i in range(120)]
    rows += [("a a a a a a " * 20, "en"), (None, "en"), ("", None), (" \t ,;", "xx"), ("rare words only here", "yy"), ("in a, row; of:pieces!no?phrase", "")] + [("hot hot pair", "")] * 40
    return rows + [rows[0]] * 3


def collocation_rows(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("changes", [{}, {"SHARD": 50, "PENDING": 10, "FAN_IN": 2, "RANGE": 20}, {"LONGEST": 4, "RANGE": 1}], ids=["plain", "many shards", "many ranges"])
def test_collocations_against_counting(spark, monkeypatch, changes):
    for name, value in changes.items():
        monkeypatch.setattr(C, name, value)
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5).withColumns({n: F.lit("x") for n in [*CLASHING, "phrase", "a", "l", "r", "score", "range"]})
    assert collocation_rows(C.collocations(docs)) == brute_collocations(rows)
    assert collocation_rows(C.collocations(docs, least=60, top=5)) == brute_collocations(rows, 60, 5)


def test_collocation_edges(spark):
    assert C.collocations(empty_docs(spark)).count() == 0
    assert C.collocations(hard_docs(spark).limit(3)).count() == 0
    rows = [(r[1], r[2]) for r in hard_rows()]
    assert collocation_rows(C.collocations(hard_docs(spark, clashing=True), least=5)) == brute_collocations(rows, 5)


def test_transducers():
    phrases = {("en", "a"): 3, ("en", "a", "b"): 2, ("en", "a", "b", "c"): 2, ("en", "b"): 4, ("en", "b", "b"): 2, ("en", "b", "b", "c"): 2, ("fr", "z", "z"): 1}
    builder = C.Builder()
    for labels in sorted(phrases):
        builder.add(labels, phrases[labels])
    machine = builder.machine()
    assert dict(machine.paths()) == phrases
    assert len(machine.arcs) < 9  # the states after "a b" and "b b" are one, as are all ends
    again = C.Machine.read(*(machine.row()[c] for c in ("first", "label", "weight", "target")))
    assert dict(again.paths()) == phrases
    both = C.united([machine, again, again])
    assert dict(both.paths()) == {k: 3 * v for k, v in phrases.items()}
    assert dict(C.united([machine, again], least=5).paths()) == {("en", "a"): 6, ("en", "b"): 8}
    asked = C.Builder()
    for labels in [("en", "a", "b"), ("en", "a", "x"), ("fr", "z"), ("fr", "z", "z")]:
        asked.add(labels, 1)
    assert dict(C.composed(asked.machine(), both)) == {("en", "a", "b"): 6, ("fr", "z", "z"): 3}
    assert list(C.united([C.Builder().machine()]).paths()) == []


def test_exact_scores_beyond_64_bits(spark):
    """The score's product and the share test are exact for counts near the end of long."""
    df = spark.createDataFrame([(2**62 + 1, 2**62 + 3, 2**62 + 9)], "a long, l long, r long")
    got = df.select(C.score().alias("s")).first()["s"]
    assert got == 2_000_000 * (2**62 + 1) // (2**63 + 12)
