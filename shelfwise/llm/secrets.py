"""Secrets by fixed patterns and by probabilistic automata learned from what the patterns find.

The matches of three patterns are the labelled credentials. For each kind, a bounded sample of
distinct values becomes a prefix tree; states whose ways to go on do not differ by more than
Hoeffding's bound are merged, in breadth-first order, into a probabilistic automaton. Two more are
learned from samples of other tokens, words and what holds digits. Every run of token characters in every text is a
candidate: one that an automaton of credentials makes much likelier than those of other tokens, and as likely per
character as its own labelled values, is a further span. Spans of the patterns stay as they are. A format that many
tokens without a label have too counts as no secret: the automata of other tokens know it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.words import BLOCK_BYTES, mix, span_hashes, text_buffers
from shelfwise.session import materialize

# The patterns of the three kinds and the least length of what they must hold.
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = b"0123456789abcdef"
TOKEN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
LEAST = {"assign": 8, "access": 16, "hex": 32}

KINDS = list(LEAST)
#: What other tokens are told apart by: without and with a digit.
OTHER = ["words", "codes"]
#: Distinct values of each kind, and of either sort of other tokens, that the automata are learned from.
FIT_VALUES = 1_000
#: Confidence of the merge test; natural log of how much likelier a credential must be; standard errors below the labelled values' mean.
ALPHA, MARGIN, ERRORS = 0.05, 12.0, 3.0
#: A learned value counts with so many characters at most; every candidate is scored in full.
LEARNED = 128
CANDIDATE = 8

_ASSIGN, _ACCESS = re.compile(ASSIGN, re.IGNORECASE), re.compile(ACCESS)
_SYMBOL = np.full(256, -1, np.int16)
_SYMBOL[list(TOKEN)] = np.arange(len(TOKEN))
_IS_HEX = np.zeros(256, bool)
_IS_HEX[list(HEX)] = True
_IS_TOKEN = _SYMBOL >= 0
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
#: Upper case, lower case, digits, and each sign on its own.
_CLASS = np.array([0] * 26 + [1] * 26 + [2] * 10 + list(range(3, 9)))
END = len(TOKEN)


def _runs(mask: np.ndarray, edges: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``least`` or more in ``mask`` that do not go over ``edges``."""
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    heads, tails = edges[edges < len(mask)], edges[edges > 0] - 1
    begins[heads], ends[tails] = mask[heads], mask[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = end - start >= least
    return start[long], end[long]


@dataclass
class Scan:
    """Some texts side by side: the spans of the patterns (text, kind, start, end, start of the value) and all candidates."""

    row: int
    data: np.ndarray
    edges: np.ndarray
    base: list[tuple[int, int, int, int, int]]
    start: np.ndarray
    end: np.ndarray

    def owner(self) -> np.ndarray:
        return np.searchsorted(self.edges, self.start, "right") - 1

    def free(self) -> np.ndarray:
        """Whether a candidate meets no span of the patterns."""
        size = len(self.data) + 1
        taken = np.zeros(size, np.int32)
        for _, _, start, end, _ in self.base:
            taken[start] += 1
            taken[end] -= 1
        covered = np.append(0, np.cumsum(np.cumsum(taken)[:-1] > 0))
        return covered[self.end] == covered[self.start]


def scans(column: pa.Array) -> Iterator[Scan]:
    """The column's texts in blocks, with what the patterns find in each."""
    data, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        part, edges = data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        base = []
        raw = part.tobytes()
        signs = np.flatnonzero((part == 0x3A) | (part == 0x3D))
        for i in np.unique(np.searchsorted(edges, signs, "right") - 1).tolist():  # texts with a sign
            for m in _ASSIGN.finditer(raw, int(edges[i]), int(edges[i + 1])):
                if m.end(2) - m.start(2) >= LEAST["assign"]:
                    base.append((i, 0, m.start(), m.end(), m.start(2)))
        at = raw.find(b"AKIA")
        while at >= 0:
            i = int(np.searchsorted(edges, at, "right")) - 1
            m = _ACCESS.match(raw, at, int(edges[i + 1]))
            if m and m.end() - at >= LEAST["access"]:
                base.append((i, 1, at, m.end(), at))
            at = raw.find(b"AKIA", m.end() if m else at + 1)
        start, end = _runs(_IS_HEX[part], edges[1:-1], LEAST["hex"])
        for s, e, i in zip(start.tolist(), end.tolist(), (np.searchsorted(edges, start, "right") - 1).tolist()):
            base.append((i, 2, s, e, s))
        yield Scan(row, part, edges, base, *_runs(_IS_TOKEN[part], edges[1:-1], CANDIDATE))
        row = stop


@dataclass
class Automaton:
    """Log shares by state and symbol (the last is the end), and where each symbol leads."""

    shares: np.ndarray
    follow: np.ndarray
    mean: float = 0.0
    spread: float = np.inf

    def least(self, size: np.ndarray) -> np.ndarray:
        """The log likelihood per character below which a run of ``size`` is unlike the learned values."""
        return self.mean - ERRORS * self.spread / np.sqrt(size)

    def scores(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The log likelihood of each run ``data[start:end]``; all runs advance side by side."""
        order = np.argsort(start - end, kind="stable")  # longest first
        start, size = start[order], (end - start)[order]
        state, total = np.zeros(len(start), np.int32), np.zeros(len(start))
        width = END + 1
        shares, follow = self.shares.ravel(), self.follow.ravel()
        active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")  # runs longer than each position
        for i, n in enumerate(active.tolist()):
            cell = state[:n] * width + _SYMBOL[data[start[:n] + i]]
            total[:n] += shares[cell]
            state[:n] = follow[cell]
        total += shares[state * width + END]
        out = np.empty(len(total))
        out[order] = total
        return out


class _Tree:
    """A prefix tree that becomes an automaton as its states are merged."""

    def __init__(self, values: list[bytes]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.count: list[dict[int, int]] = [{}]
        self.total = [0]
        for value in values:
            at = 0
            for symbol in (*_SYMBOL[list(value)].tolist(), END):
                self.total[at] += 1
                self.count[at][symbol] = self.count[at].get(symbol, 0) + 1
                if symbol == END:
                    break
                if symbol not in self.next[at]:
                    self.next[at][symbol] = len(self.total)
                    self.next.append({})
                    self.count.append({})
                    self.total.append(0)
                at = self.next[at][symbol]

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """No share of a symbol or of the end differs beyond Hoeffding's bound, here and in all common successors."""
        bound = np.sqrt(0.5 * np.log(2 / alpha))
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.total[a], self.total[b]
            if not n or not m:
                continue
            most = bound * (n ** -0.5 + m ** -0.5)
            if most < 1:
                here, there = self.count[a], self.count[b]
                if any(abs(here.get(s, 0) / n - there.get(s, 0) / m) > most for s in here.keys() | there.keys()):
                    return False
            stack += [(t, self.next[b][s]) for s, t in self.next[a].items() if s in self.next[b]]
        return True

    def fold(self, into: int, state: int) -> None:
        """Add ``state`` and all below it to ``into``; ``state`` is still the root of a tree."""
        stack = [(into, state)]
        while stack:
            into, state = stack.pop()
            self.total[into] += self.total[state]
            for symbol, n in self.count[state].items():
                self.count[into][symbol] = self.count[into].get(symbol, 0) + n
            for symbol, below in self.next[state].items():
                if symbol in self.next[into]:
                    stack.append((self.next[into][symbol], below))
                else:
                    self.next[into][symbol] = below


def infer(values: list[bytes], alpha: float = ALPHA) -> Automaton:
    """The probabilistic automaton of ``values`` by merging compatible states of their prefix tree.

    Shares are smoothed towards those of the symbol's class in the whole sample, so any run has a likelihood; an unseen
    symbol leads where the state's most frequent symbol of that class leads, else where its most frequent symbol does.
    """
    values = sorted(v[:LEARNED] for v in values)
    tree = _Tree(values)
    red, held = [0], {0}
    blue = [(0, s) for s in sorted(tree.next[0])]
    while blue:
        parent, symbol = blue.pop(0)
        state = tree.next[parent].get(symbol)
        if state is None or state in held:
            continue
        for known in red:
            if tree.compatible(known, state, alpha):
                tree.next[parent][symbol] = known
                tree.fold(known, state)
                break
        else:
            red.append(state)
            held.add(state)
        # Folding may have given any settled state new successors.
        blue = [(r, s) for r in red for s in sorted(tree.next[r]) if tree.next[r][s] not in held]
    at = {state: i for i, state in enumerate(red)}
    overall = np.full(END + 1, 0.5)
    for counts in (tree.count[s] for s in red):
        for symbol, n in counts.items():
            overall[symbol] += n
    by_class = np.bincount(_CLASS, overall[:END])
    spread = np.append((by_class / np.bincount(_CLASS))[_CLASS], overall[END])
    spread /= spread.sum()
    shares, follow = np.zeros((len(red), END + 1)), np.zeros((len(red), END + 1), np.int32)
    for state, i in at.items():
        counts = np.zeros(END + 1)
        counts[list(tree.count[state])] = list(tree.count[state].values())
        shares[i] = np.log((counts + 2 * spread) / (counts.sum() + 2))
        if tree.next[state]:
            for c in range(_CLASS.max() + 1):
                near = [s for s in tree.next[state] if _CLASS[s] == c] or list(tree.next[state])
                follow[i, :END][_CLASS == c] = at[tree.next[state][max(near, key=lambda s: (counts[s], -s))]]
            for symbol, target in tree.next[state].items():
                follow[i, symbol] = at[target]
    automaton = Automaton(shares, follow)
    if values:
        sizes = np.array([len(v) for v in values])
        ends = np.cumsum(sizes)
        likely = automaton.scores(np.frombuffer(b"".join(values), np.uint8), ends - sizes, ends) / (sizes + 1)
        automaton.mean = float(likely.mean())
        automaton.spread = float(np.sqrt((((likely - automaton.mean) ** 2) * (sizes + 1)).mean()))
    return automaton


def _lowest(found: dict[bytes, int], most: int) -> dict[bytes, int]:
    return dict(sorted(found.items(), key=lambda x: (x[1], x[0]))[:most]) if len(found) > most else found


def samples(texts: DataFrame, most: int = FIT_VALUES) -> dict[str, list[bytes]]:
    """Up to ``most`` distinct values of each kind and of either sort of other tokens: those with the lowest hashes over all texts."""

    def run(batches):
        lowest: list[dict[bytes, int]] = [{} for _ in range(len(KINDS) + len(OTHER))]
        limits = [1 << 64] * len(lowest)
        for batch in batches:
            for scan in scans(batch.column(0)):
                spans = [np.array([(v, e) for _, kind, _, e, v in scan.base if kind == k], np.int64).reshape(-1, 2) for k in range(len(KINDS))]
                other = np.stack([scan.start, scan.end], axis=1)[scan.free()]
                digits = np.append(0, np.cumsum(_IS_DIGIT[scan.data]))
                coded = digits[other[:, 1]] > digits[other[:, 0]]
                for k, ends in enumerate([*spans, other[~coded], other[coded]]):
                    ends[:, 1] = np.minimum(ends[:, 1], ends[:, 0] + LEARNED)
                    hashes = mix(span_hashes(scan.data, ends[:, 0], ends[:, 1])) if len(ends) else np.zeros(0, np.uint64)
                    for i in np.flatnonzero(hashes < np.uint64(min(limits[k], (1 << 64) - 1))).tolist():
                        lowest[k][scan.data[ends[i, 0]:ends[i, 1]].tobytes()] = int(hashes[i])
                    if len(lowest[k]) > 2 * most:
                        lowest[k] = _lowest(lowest[k], most)
                        limits[k] = max(lowest[k].values())
        rows = [(k, v, h - (1 << 63)) for k, found in enumerate(lowest) for v, h in _lowest(found, most).items()]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())],
            ["kind", "value", "mark"])

    found = materialize(texts.mapInArrow(run, "kind int, value binary, mark long").distinct(), "credentials")
    out = {}
    for k, kind in enumerate([*KINDS, *OTHER]):
        rows = found.filter(F.col("kind") == k).orderBy("mark", "value").limit(most)
        out[kind] = [bytes(r["value"]) for r in rows.select("value").collect()]
    return out


def learned(texts: DataFrame, most: int = FIT_VALUES) -> dict[str, Automaton]:
    """An automaton for each kind that occurs and for other tokens; nothing if no kind does."""
    found = {kind: values for kind, values in samples(texts, most).items() if values or kind in OTHER}
    return {kind: infer(values) for kind, values in found.items()} if len(found) > len(OTHER) else {}


def likely(scan: Scan, automata: dict[str, Automaton]) -> list[tuple[int, int, int, int, float]]:
    """(text, kind, start, end, score) of the candidates that an automaton of credentials explains."""
    free = scan.free()
    start, end = scan.start[free], scan.end[free]
    if not automata or not len(start):
        return []
    owner, size = scan.owner()[free], end - start + 1
    rest = np.maximum(*(automata[name].scores(scan.data, start, end) for name in OTHER))
    best, kind = np.full(len(start), -np.inf), np.full(len(start), -1)
    for k, name in enumerate(KINDS):
        if name in automata:
            own = automata[name].scores(scan.data, start, end)
            better = (own - rest > best) & (own / size >= automata[name].least(size))
            best[better], kind[better] = (own - rest)[better], k
    return [(int(owner[i]), int(kind[i]), int(start[i]), int(end[i]), float(best[i])) for i in np.flatnonzero(best >= MARGIN)]


SPANS = "array<struct<kind: string, start: long, end: long, score: double>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def find_secrets(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", automata: dict[str, Automaton] | None = None) -> DataFrame:
    """(id, spans) of every row: the spans of the patterns, and those the automata add, ordered by start and kind.

    Spans count code points, the end is not part of them. A span of a pattern is its whole match and has no
    score. A span that is added is a whole run of token characters that meets no span of the patterns; its kind is
    ``like_`` and the likeliest kind, its score the log of how much likelier. Without ``automata`` they are learned from
    ``docs``.

    A null text is empty; empty texts and texts without secrets have empty lists. Rows stay as they are, repeated
    or without an id; other columns are not read. Without labelled credentials nothing is added.
    """
    if automata is None:
        automata = learned(docs.select(F.col(text_col).cast("string").alias("text")))

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(batch.num_rows)]
            for scan in scans(batch.column(1)):
                spans = [(i, s, k, e, KINDS[k], None) for i, k, s, e, _ in scan.base]
                spans += [(i, s, k, e, f"like_{KINDS[k]}", score) for i, k, s, e, score in likely(scan, automata)]
                points: dict[int, np.ndarray] = {}  # code points before each byte of a text
                for i, s, _, e, kind, score in sorted(spans, key=lambda x: x[:3]):
                    first = scan.edges[i]
                    if i not in points:
                        points = {i: np.append(0, np.cumsum((scan.data[first:scan.edges[i + 1]] & 0xC0) != 0x80))}
                    out[scan.row + i].append({"kind": kind, "start": int(points[i][s - first]), "end": int(points[i][e - first]), "score": score})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _SPAN_TYPE)], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}").withColumnRenamed("id", id_col)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_counts(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_<kind> for each pattern, base_sha256, spans as text) of what ``find_secrets`` returns."""
    base = F.filter("spans", lambda s: s["score"].isNull())

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(id_col, *map(count, KINDS), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
