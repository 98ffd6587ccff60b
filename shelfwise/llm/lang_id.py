"""Language identification of mixed text: script ranges, per-word scores, Viterbi over words.

Learning counts byte bigrams and hashed byte trigrams of lower-cased words per language, and how
often each language writes in each script. The model has a fixed number of cells per language, so
it is small whatever the corpus. For a word, the ranges of its characters give its script, which
narrows the candidate languages; each candidate scores the sum of its log shares. Labels of the
words of a text are the best path under a penalty for every change of language, which leaves spans.

A text keeps one label throughout, without search, when no stretch of it favours another language by
more than the penalty, and its beginning and end together do not either: then no path with a change can be
better. The other texts of a block go through Viterbi side by side, very long ones on their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.memory import release, released
from shelfwise.llm.words import Block, blocks

#: The model is fitted on about so many labelled documents, chosen by a hash of id and text.
FIT_DOCUMENTS = 20_000
PENALTY = 8.0
#: Scores count bigrams and trigrams of the same letters, so each counts for less.
WEIGHT = 0.5
SMOOTHING = 0.5
CELLS = 1 << 16
NOT_HERE = -30.0
LONG = 400
UNDETERMINED = "und"

# Unicode ranges by script.
SCRIPTS = [
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xC0, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF),
    ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF),
    ("arabic", 0x750, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF),
    ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F), ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7A3),
    ("han", 0x20000, 0x2FFFF),
]
NAMES = ["none", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


def _script_table() -> np.ndarray:
    """The script of each (first byte, second byte) of a UTF-8 character; a range is whole for such a pair or decided by its first letter."""
    table = np.zeros((256, 256), np.uint8)
    for name, low, high in reversed(SCRIPTS):
        script = NAMES.index(name)
        if high < 0x80:
            table[low:high + 1, :] = script
            continue
        for point in range(low & ~63, high + 1, 64):
            code = chr(max(point, low)).encode("utf-8", "surrogatepass")
            if len(code) == 2:
                table[code[0], 0x80:0xC0] = script
            else:
                table[code[0], code[1]] = script
    return table.ravel()


_SCRIPT = _script_table()
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ASCII_LETTER = _LETTER & (np.arange(256) < 128)


@dataclass
class Words:
    """The features of a block's words: cells of the byte grams, where each word's begin, and more."""

    grams: np.ndarray
    trigrams: np.ndarray
    first: np.ndarray
    weight: np.ndarray
    script: np.ndarray


def features(block: Block) -> Words:
    data = np.append(block.data, np.uint8(32)).astype(np.uint32)
    size = block.end - block.start + 1  # with the byte after it, read as a blank
    first = np.cumsum(size) - size
    at = np.repeat(block.start - first, size) + np.arange(size.sum())
    here = data[at]
    here[first + size - 1] = 32
    one, two = np.roll(here, 1), np.roll(here, 2)
    one[first] = two[first] = 32
    inner = first[size > 1] + 1
    two[inner] = 32
    grams = one << 8 | here
    trigrams = ((two << 16 | grams) * np.uint32(2654435761)) >> np.uint32(16)
    ascii_ = block.data
    script = _SCRIPT[ascii_.astype(np.uint16) << 8 | np.append(ascii_[1:], np.uint8(0))]
    weight = np.add.reduceat(_LETTER[here.astype(np.uint8)].astype(np.int64), first) if len(first) else first
    found = np.maximum.reduceat(np.append(script, np.uint8(0))[at], first) if len(first) else script[:0]
    return Words(grams, trigrams, first, weight, found)


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


@dataclass
class Model:
    """Log shares by cell and language (grams, then trigrams), and the candidates of each script."""

    languages: list[str]
    grams: np.ndarray
    trigrams: np.ndarray
    candidates: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        if not len(words.first):
            return np.zeros((0, len(self.languages)))
        every = self.grams[words.grams]
        every += self.trigrams[words.trigrams]
        scores = np.add.reduceat(every, words.first, axis=0).astype(np.float64) * WEIGHT
        scores[~self.candidates[words.script]] += NOT_HERE
        scores[words.weight == 0] = 0
        return scores


def viterbi(scores: np.ndarray, edges: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; rows ``edges[i]`` to ``edges[i + 1]`` are text i."""
    size = np.diff(edges)
    labels = np.zeros(len(scores), np.int64)
    order = np.argsort(-size, kind="stable")
    start, left = edges[:-1][order], size[order]
    if not len(left) or not left[0]:
        return labels
    best = np.zeros((len(order), scores.shape[1]))
    before = np.zeros((left[0], len(order)), np.int32)  # the best label up to the word before
    stays = np.zeros((left[0], len(order), scores.shape[1]), bool)
    for t in range(left[0]):
        n = int(np.searchsorted(-left, -t, "left"))  # texts with more than t words
        if t:
            top = best[:n].argmax(axis=1)
            change = best[np.arange(n), top] - penalty
            stay = best[:n] >= change[:, None]
            before[t, :n], stays[t, :n] = top, stay
            best[:n] = np.where(stay, best[:n], change[:, None])
        best[:n] += scores[start[:n] + t]
    label = best.argmax(axis=1)
    for t in range(left[0] - 1, -1, -1):
        n = int(np.searchsorted(-left, -t, "left"))
        labels[start[:n] + t] = label[:n]
        if t:
            label[:n] = np.where(stays[t, np.arange(n), label[:n]], label[:n], before[t, :n])
    return labels


def viterbi_alone(scores: np.ndarray, penalty: float) -> np.ndarray:
    """As ``viterbi`` for one long text: lists are quicker than arrays of a few cells."""
    rows = scores.tolist()
    best, changes = rows[0], []
    for row in rows[1:]:
        top = max(best)
        change = top - penalty
        changes.append((best.index(top), [b < change for b in best]))
        best = [(b if b >= change else change) + s for b, s in zip(best, row)]
    label = best.index(max(best))
    labels = [label]
    for top, changed in reversed(changes):
        if changed[label]:
            label = top
        labels.append(label)
    return np.array(labels[::-1])


def label_words(scores: np.ndarray, edges: np.ndarray, penalty: float) -> np.ndarray:
    """As ``viterbi``, which only sees the texts that one label may not suit."""
    size = np.diff(edges)
    owner = np.repeat(np.arange(len(size)), size)
    filled = np.flatnonzero(size)
    if not len(filled):
        return np.zeros(0, np.int64)
    total = np.zeros((len(size), scores.shape[1]))
    total[filled] = np.add.reduceat(scores, edges[filled], axis=0)
    single = total.argmax(axis=1)
    labels = single[owner]
    gain = scores - scores[np.arange(len(scores)), labels][:, None]
    sums = np.cumsum(gain, axis=0)
    drop = 2 * (np.abs(sums).max() + 1)
    before = np.concatenate([np.zeros((1, sums.shape[1])), sums[:-1]]) - owner[:, None] * drop
    stretch = sums - owner[:, None] * drop - np.minimum.accumulate(before, axis=0)
    most = np.maximum.reduceat(stretch.max(axis=1), edges[filled])
    from_start = sums - np.concatenate([np.zeros((1, sums.shape[1])), sums])[edges[:-1]][owner]
    start = np.maximum.reduceat(from_start, edges[filled], axis=0).max(axis=1)
    least = np.minimum(0, np.minimum.reduceat(from_start, edges[filled], axis=0))
    end = (from_start[edges[1:][filled] - 1] - least).max(axis=1)
    open_ = filled[(most > penalty) | (start + end > penalty)]
    for i in open_[size[open_] > LONG]:
        labels[edges[i]:edges[i + 1]] = viterbi_alone(scores[edges[i]:edges[i + 1]], penalty)
    open_ = open_[size[open_] <= LONG]
    for part in np.array_split(open_, max(1, -(-int(size[open_].sum()) // 50_000))) if len(open_) else ():
        rows = np.concatenate([np.arange(edges[i], edges[i + 1]) for i in part])
        labels[rows] = viterbi(scores[rows], np.concatenate([[0], np.cumsum(size[part])]), penalty)
    return labels


def _count(batches):
    """(kind, cell, lang, n): bigrams 0, trigrams 1, scripts 2, documents 3."""
    for batch in batches:
        langs, own = np.unique(np.asarray(batch["lang"].to_pylist(), object).astype(str), return_inverse=True)
        # Sparse: (cell and language as one number, n), so that many languages need no large tables.
        counts: list[list] = [[], [], [], [np.unique(own, return_counts=True)]]
        for block in blocks(lowered(batch["text"])):
            words = features(block)
            by_word = own[block.row:block.row + len(block)][block.owner()]
            letters = words.weight > 0
            by_gram = np.repeat(by_word, np.diff(np.append(words.first, len(words.grams))))
            counts[2].append(np.unique(words.script[letters] * np.int64(len(langs)) + by_word[letters], return_counts=True))
            for k, cells in enumerate((words.grams, words.trigrams)):
                counts[k].append(np.unique(cells.astype(np.int64) * len(langs) + by_gram, return_counts=True))
        for kind, parts in enumerate(counts):
            if parts:
                codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                n = np.bincount(where, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(codes), kind, np.int32)), pa.array((codes // len(langs)).astype(np.int32)),
                    pa.array(langs[codes % len(langs)].astype(str)), pa.array(n)], ["kind", "cell", "lang", "n"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", documents: int = FIT_DOCUMENTS) -> Model | None:
    """Learn from rows with a text and a language; None without any.

    At most about ``documents`` rows are read, chosen by a hash of their id and text; what comes back to the
    driver are counts per cell and language of that sample, half a megabyte a language at most.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        "text is not null and lang is not null")
    n = rows.select("lang").count()
    if not n:
        return None
    if n > documents:
        rows = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < int(1_000_000 * documents / n))
    counts = rows.select("text", "lang").mapInArrow(released(_count), "kind int, cell int, lang string, n long").groupBy("kind", "cell", "lang")
    found = counts.agg(F.sum("n").alias("n")).toPandas()
    if found.empty:
        return None
    languages = sorted(found["lang"].unique())
    column = found["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy()
    tables = []
    for kind, size in ((0, CELLS), (1, CELLS), (2, len(NAMES))):
        table = np.zeros((size, len(languages)))
        own = (found["kind"] == kind).to_numpy()
        table[found["cell"].to_numpy()[own], column[own]] = found["n"].to_numpy()[own]
        tables.append(table)
    shares = [np.log((t + SMOOTHING) / (t.sum(axis=0) + SMOOTHING * CELLS)).astype(np.float32) for t in tables[:2]]
    scripts = tables[2] / np.maximum(1, tables[2].sum(axis=0))
    candidates = scripts >= 0.01
    candidates[~candidates.any(axis=1)] = True
    return Model(languages, *shares, candidates)


def _identify(model: Model, penalty: float) -> Callable:
    languages = np.array(model.languages, object)

    def run(batches):
        for batch in batches:
            names, shares, spans = [], [], []
            for block in blocks(lowered(batch["text"])):
                words = features(block)
                scores = model.word_scores(words)
                labels = label_words(scores, block.first, penalty)
                letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[block.data])])[block.offsets]
                for i in range(len(block)):
                    low, high = block.first[i], block.first[i + 1]
                    own, weight = labels[low:high], words.weight[low:high]
                    if not weight.sum() or letters[i] == letters[i + 1] and not any(map(str.isalpha, block.text(i).decode())):
                        names.append(UNDETERMINED)
                        shares.append(0.0)
                        spans.append([])
                        continue
                    by_label = np.bincount(own, weight, len(languages))
                    best = int(by_label.argmax())
                    total = scores[low:high].sum(axis=0)
                    sure = 1 / np.exp(np.minimum(total - total[best], 50)).sum()
                    names.append(languages[best])
                    shares.append(float(by_label[best] / by_label.sum()) * (1.0 if total[best] < total.max() else float(sure)))
                    head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                    spans.append([{"lang": languages[own[a]], "first_word": int(a), "end_word": int(b)}
                                  for a, b in zip(head, np.append(head[1:], len(own)))])
            yield pa.RecordBatch.from_arrays([
                batch["id"], pa.array(names, pa.string()), pa.array(shares, pa.float64()),
                pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("end_word", pa.int32())]))),
            ], ["id", "lang_pred", "score", "spans"])

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept from learning; a missing id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, lang_pred, score, spans).

    spans are runs of words in one language; lang_pred is the language with most letters, of equals
    the first by name. score is its share of the letters, times how much likelier it is than the
    others for the whole text. A text that is null or has no letter is ``und`` with score 0 and no
    spans, and so is every text where nothing could be learned (``model`` None). Only the text is
    looked at, whole; null and repeated ids are rows like any other, and an empty table gives none.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = T.StructType([T.StructField("lang", T.StringType()), T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType())])
    if model is None:
        out = rows.select("id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast(T.ArrayType(span)).alias("spans"))
    else:
        out = rows.mapInArrow(released(_identify(model, penalty)), T.StructType([
            T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))]))
    return out.withColumnRenamed("id", id_col)


def predicted(text: Column, model: Model | None, penalty: float = PENALTY) -> Column:
    """(lang_pred, score) of each text, as ``identify`` has them; only the text goes to Python and only these come back."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if model is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score")).cast(kind)
    run = _identify(model, penalty)

    @F.arrow_udf(kind)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for column in texts:
                batch = pa.RecordBatch.from_arrays([column, column], ["id", "text"])
                (found,) = run([batch])
                yield pa.StructArray.from_arrays([found["lang_pred"], found["score"]], ["lang_pred", "score"])
        finally:
            release()

    return predict.asNondeterministic()(text)  # or a filter on it would make Spark run it twice
