"""Byte-level BPE encoding and decoding with forced-boundary splitting.

The vocabulary says which pairs of bytes occur side by side inside some token. Between two bytes
of any other pair every encoding has a token boundary, as no merge can ever join them. Texts are
cut there in two places:

* in the whole text, found by table lookup on all bytes at once, where the second byte is ASCII
  white space and the first one ends a character that is not white space. No pre-token goes on
  over such a place and none looks beyond it, so both sides can be encoded on their own;
* inside each pre-token of a fragment that is not known yet, before its merges are looked for. This
  holds for the merges in Python only: with the compiled encoder, the main path, texts are cut at
  white space alone, and pairs inside pre-tokens are left to that encoder.

Fragments are encoded apart from each other and their ids concatenated. As they repeat, each worker keeps
the encodings of short ones in a table of bounded size. New fragments of a block are encoded in one
call: put one after the other they stay apart, as certain cuts lie between them, and this is
checked on the lengths of the tokens that come back.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.memory import released
from shelfwise.llm.words import BLOCK_BYTES, text_buffers

# Fixed value: the published pre-token pattern of this kind of byte-level vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encodings that a worker keeps, and the longest fragment it keeps; memory and speed only.
KNOWN_FRAGMENTS = 100_000
KNOWN_BYTES = 40
_WHITE = frozenset(b" \t\n\x0b\x0c\r")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """A vocabulary read from a tokenizer file; ids are little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        vocab = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        self.token: dict[int, bytes] = {i: token for token, i in vocab.items()} | {i: t.encode() for t, i in added.items()}
        self.single = [vocab[bytes([b])] for b in range(256)]
        self.merge = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            one, two = (bytes(alphabet[c] for c in part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merge[vocab[one], vocab[two]] = (rank, vocab[one + two])
        self.inside = np.zeros((256, 256), bool)
        for token in vocab:
            pairs = np.frombuffer(token, np.uint8)
            self.inside[pairs[:-1], pairs[1:]] = True
        self.cuts = self._text_cuts().ravel()
        self.pattern = regex.compile(PRE_TOKEN)
        self.added = added
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.known: dict[bytes, bytes] = {}
        self.lengths = np.array([len(self.token.get(i, b"")) for i in range(max(self.token) + 1)])
        # The compiled encoder merges by id; it serves where ids follow the order of the merges.
        by_rank = [new for _, new in sorted(self.merge.values())]
        self.compiled = None
        if by_rank == sorted(by_rank) and (not by_rank or max(self.single) < by_rank[0]):
            self.compiled = tiktoken.Encoding("fragments", pat_str=PRE_TOKEN, mergeable_ranks=dict(vocab), special_tokens={})

    def _text_cuts(self) -> np.ndarray:
        """Pairs that are a certain cut wherever the first byte ends a character that is not white space."""
        cuts = ~self.inside
        white = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
        cuts[:, ~white] = False
        cuts[white | np.isin(np.arange(256), range(0x1C, 0x20))] = False
        return cuts

    def merges(self, piece: bytes) -> list[int]:
        """Merge the pair of least rank, the leftmost of equals, until no pair can be merged."""
        ids: list = [self.single[b] for b in piece]
        right, left = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(*self.merge[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in self.merge]
        heapq.heapify(heap)
        while heap:
            _, new, i, one, two = heapq.heappop(heap)
            j = right[i]
            if ids[i] != one or j >= len(ids) or ids[j] != two:
                continue
            ids[i], ids[j] = new, None
            right[i] = k = right[j]
            if k < len(ids):
                left[k] = i
                if (new, ids[k]) in self.merge:
                    heapq.heappush(heap, (*self.merge[new, ids[k]], i, new, ids[k]))
            if left[i] >= 0 and (ids[left[i]], new) in self.merge:
                heapq.heappush(heap, (*self.merge[ids[left[i]], new], left[i], ids[left[i]], new))
        return [i for i in ids if i is not None]

    def encode_fragment(self, fragment: bytes) -> bytes:
        ids: list[int] = []
        for token in self.pattern.findall(fragment.decode("utf-8")):
            piece = token.encode()
            start = 0
            for cut in range(1, len(piece)):
                if not self.inside[piece[cut - 1], piece[cut]]:
                    ids += self.merges(piece[start:cut])
                    start = cut
            ids += self.merges(piece[start:])
        return np.array(ids, "<u4").tobytes()

    def encode_apart(self, fragments: list[bytes]) -> list[bytes]:
        """Encode fragments that each begin with white space and end without."""
        if self.compiled is None or not fragments:
            return [self.encode_fragment(f) for f in fragments]
        ids = np.array(self.compiled.encode_ordinary(b"".join(fragments).decode("utf-8")), "<u4")
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum([len(f) for f in fragments])
        at = np.searchsorted(ends, wanted)
        if not np.array_equal(ends[at], wanted):
            return [self.encode_fragment(f) for f in fragments]
        raw, stops = ids.tobytes(), (4 * (at + 1)).tolist()
        return [raw[i:j] for i, j in zip([0, *stops], stops)]

    def _one(self, fragment: bytes) -> bytes:
        if self.compiled is None:
            return self.encode_fragment(fragment)
        return np.array(self.compiled.encode_ordinary(fragment.decode("utf-8")), "<u4").tobytes()

    def _edges(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Where fragments begin, with the end of the data, and which of them begin each text."""
        pairs = data[:-1].astype(np.uint16) << 8 | data[1:]
        at = np.flatnonzero(self.cuts[pairs]) + 1
        last, before = data[at - 1], data[at - 2]  # at - 2 is -1 only after an ASCII byte, which needs no look
        at = at[(last < 0x80) | ((before >= 0xC3) & (before <= 0xDF))]
        begins = np.zeros(len(data) + 1, bool)
        begins[at] = begins[offsets] = True
        edges = np.flatnonzero(begins)
        return edges.tolist(), np.searchsorted(edges, offsets)

    def _encode_block(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of each text of a block, none with an added token in it."""
        raw = data.tobytes()
        edges, first = self._edges(data, offsets)
        fragments = [raw[i:j] for i, j in zip(edges, edges[1:])]
        known = self.known
        if len(known) > KNOWN_FRAGMENTS:
            known.clear()
        new = list(set(fragments).difference(known))
        regular = [f for f in new if f[0] in _WHITE and f[-1] < 0x80 and f[-1] not in _WHITE]
        known.update(zip(regular, self.encode_apart(regular)))
        for f in new:
            if f not in known:
                known[f] = self._one(f)
        ids = list(map(known.__getitem__, fragments))
        for f in new:
            if len(f) > KNOWN_BYTES:
                del known[f]
        return [b"".join(ids[i:j]) for i, j in zip(first.tolist(), first.tolist()[1:])]

    def _with_added(self, text: str) -> bytes:
        out, start = [], 0
        parts = [(m.start(), m.end(), self.added[m[0]]) for m in self.special.finditer(text)]
        for begin, end, token in [*parts, (len(text), len(text), None)]:
            plain = text[start:begin].encode()
            if plain:
                out += self._encode_block(np.frombuffer(plain, np.uint8), np.array([0, len(plain)]))
            if token is not None:
                out.append(np.array([token], "<u4").tobytes())
            start = end
        return b"".join(out)

    def encode_column(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text; null is empty."""
        data, offsets = text_buffers(column)
        row, rows = 0, len(offsets) - 1
        while row < rows:
            stop = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
            stop = min(max(stop, row + 1), rows)
            part, edges = data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
            raw = part.tobytes()
            if self.special is not None and any(t.encode() in raw for t in self.added):
                for i, j in zip(edges, edges[1:]):
                    yield self._with_added(raw[i:j].decode("utf-8"))
            elif len(part):
                yield from self._encode_block(part, edges)
            else:
                yield from (b"" for _ in range(stop - row))
            row = stop

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        token = self.token
        return b"".join([token.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")


@lru_cache(2)
def vocabulary(path: str) -> Bpe:
    """One vocabulary per worker and file; ``path`` must be readable on every executor."""
    return Bpe(path)


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a few blocks of text each."""
    _, offsets = text_buffers(batch[column])
    row = 0
    while row < batch.num_rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + 4 * BLOCK_BYTES, "right")) - 1)
        stop = min(stop, batch.num_rows)
        yield batch.slice(row, stop - row)
        row = stop


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in place of the text, other columns unchanged.

    The ids are those of the tokenizers library without added special tokens, truncation or padding;
    an added token that is spelt out in a text is that token. Null and empty texts have no ids. An
    ``ids_col`` that is there already is replaced. Rows are independent, so repeats and null ids are
    as they come. An empty table gives no rows.
    """
    fields = [f for f in docs.schema.fields if f.name not in (text_col, ids_col)]
    schema = T.StructType([*fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    names = [f.name for f in fields]

    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            for part in _parts(batch, text_col):
                ids = [np.frombuffer(x, "<i4") for x in bpe.encode_column(part[text_col])]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
                yield pa.RecordBatch.from_arrays([*(part[n] for n in names), column], [*names, ids_col])

    return docs.select(*[F.col(f"`{n}`") for n in [*names, text_col]]).mapInArrow(released(run), schema)


def decoded(ids: Column | str, path: str) -> Column:
    """The text of an array of ids, special tokens included; null for null."""

    @F.arrow_udf(T.StringType())
    def run(lists: pa.Array) -> pa.Array:
        bpe = vocabulary(path)
        return pa.array([bpe.decode(x.values.to_numpy()) if x.is_valid else None for x in lists], pa.string())

    return run(ids)


def ids_text(ids: Column | str) -> Column:
    """Decimal ids joined by commas; empty for no ids, null for null."""

    @F.arrow_udf(T.StringType())
    def run(lists: pa.Array) -> pa.Array:
        return pa.array([",".join(map(str, x.values.to_pylist())) if x.is_valid else None for x in lists], pa.string())

    return run(ids)
