"""Exact Jaccard self-join of word-shingle sets through signature trees.

Texts with equal shingle sets form one class first, so copies never meet each other. Two sets
that reach the threshold share a token among the first few of both in any fixed order of tokens
(the order here is by hash, with the tokens that many share last, by how many, so that blocks stay
small in large tables). The tokens split the classes into blocks; blocks with the same members are kept
once. Inside a block a signature tree is built: leaves are token bitmaps with set sizes, inner nodes hold the OR of the bitmaps below and the range
of sizes. A traversal of the tree against itself drops pairs of nodes whose size ranges or whose
largest possible overlap rule out every link below them. What is left is verified on the whole sets.

Verified links of each class with its block's first class come before the trees, and the trees
skip pairs that are already in one component and take in only classes that have one of like size to be compared with. Blocks with the same first class share a tree. So a large group of near copies costs about one
verified pair per member, and no link between components is left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bloom import build, passes
from shelfwise.llm.components import components
from shelfwise.llm.dropping import one_row_each
from shelfwise.llm.memory import released
from shelfwise.llm.words import blocks, mix, run_hashes, span_hashes, word_hashes
from shelfwise.session import materialize

#: Tokens that so many of some ``RUN_TEXTS`` texts share go after the others in the order of tokens; speed only.
SHARED = 4
RUN_TEXTS = 10_000
#: A run of long texts ends earlier.
RUN_TOKENS = 1 << 23
#: So many of them, the most frequent, go last by their number: bounds what each task is sent; speed only.
FREQUENT_TOKENS = 1 << 17
#: Prefix tokens for each task that gathers blocks.
ENTRIES_PER_TASK = 2_000_000
#: Larger blocks are dealt to several tasks, each with a pair of parts.
TILE = 512
LEAF = 8
FANOUT = 4


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes; shorter texts are one shingle, empty ones none."""
    for block in blocks(column, lower=True):
        hashes = word_hashes(block)
        runs = run_hashes(hashes, words)
        for first, stop in zip(block.first[:-1], block.first[1:]):
            if stop - first >= words:
                yield np.unique(runs[first:stop - words + 1])
            else:
                yield span_hashes(hashes, np.array([first]), np.array([stop])) if stop > first else runs[:0]


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(n: np.ndarray | int, percent: int):
    """Tokens that a set of n shares at least with any set it links to."""
    return (percent * n + 99) // 100


def prefix_size(n: int, percent: int) -> int:
    return int(n - least_overlap(n, percent) + 1)


def signature(tokens: np.ndarray) -> bytes:
    """A bitmap of two to four bits per token, 1024 bits at least; halving it by OR gives a narrower one."""
    width = max(1024, 1 << (2 * len(tokens)).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


def _count(bits: np.ndarray) -> int:
    return int(np.bitwise_count(bits).sum())


class Node:
    """A leaf with one set, or an inner node over its children."""

    __slots__ = ("bits", "least", "low", "high", "group", "children", "row", "side")

    def __init__(self, bits, least, low, high, group, side, children=(), row=-1):
        self.bits, self.least, self.low, self.high = bits, least, low, high
        self.group, self.side, self.children, self.row = group, side, children, row


def _parent(children: list[Node]) -> Node:
    size = min(len(c.bits) for c in children)
    bits = np.bitwise_or.reduce([_fold(c.bits, size) for c in children])
    groups, sides = {c.group for c in children}, {c.side for c in children}
    least = min(_count(_fold(c.bits, size)) if c.row >= 0 else (c.least if len(c.bits) == size else 0) for c in children)
    return Node(bits, least, min(c.low for c in children), max(c.high for c in children),
                groups.pop() if len(groups) == 1 else None, sides.pop() if len(sides) == 1 else None, children)


def build_tree(sizes, signatures, groups, sides) -> Node:
    """A signature tree; sets of one group and of like size lie side by side."""
    order = np.lexsort((sizes, groups, sides))
    level = []
    for row in order:
        bits = np.frombuffer(signatures[row], np.uint8).view(np.uint64)
        level.append(Node(bits, _count(bits), int(sizes[row]), int(sizes[row]), int(groups[row]), int(sides[row]), row=int(row)))
    width = LEAF
    while len(level) > 1:
        level = [_parent(level[i:i + width]) for i in range(0, len(level), width)]
        width = FANOUT
    return level[0]


def may_link(x: Node, y: Node, percent: int) -> bool:
    """Whether any set below x can reach the threshold with any set below y."""
    if 100 * x.high < percent * y.low or 100 * y.high < percent * x.low:
        return False
    size = min(len(x.bits), len(y.bits))
    one, two = _fold(x.bits, size), _fold(y.bits, size)
    common = _count(one & two)
    # A set's bits outside the other node's bitmap are that many tokens it cannot share.
    least_x = x.least if len(x.bits) == size else (_count(one) if x.row >= 0 else 0)
    least_y = y.least if len(y.bits) == size else (_count(two) if y.row >= 0 else 0)
    most = min(x.high - max(0, least_x - common), y.high - max(0, least_y - common))
    return (100 + percent) * most >= percent * (x.low + y.low)


def dual_traversal(root: Node, percent: int, both_sides: bool) -> list[tuple[int, int]]:
    """Pairs of rows of different groups (and sides, if so asked) that the bounds do not rule out."""
    found, stack = [], [(root, root)]
    while stack:
        x, y = stack.pop()
        if x.group is not None and x.group == y.group:
            continue
        if both_sides and x.side is not None and x.side == y.side:
            continue
        if x is y:
            if x.row < 0:
                kids = x.children
                stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
            continue
        if not may_link(x, y, percent):
            continue
        if x.row >= 0 and y.row >= 0:
            found.append((x.row, y.row))
        elif x.row < 0 and (y.row >= 0 or x.high - x.low >= y.high - y.low):
            stack += [(kid, y) for kid in x.children]
        else:
            stack += [(x, kid) for kid in y.children]
    return found


def _members(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch["text"], words))
            yield pa.RecordBatch.from_arrays([
                batch["id"],
                batch["mark"],
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
            ], ["id", "mark", "n", "sid"])

    return run


def _shared(words: int) -> Callable:
    """Tokens that ``SHARED`` texts or more of a run hold, with their number."""
    edges = (np.arange(1, 8, dtype=np.uint64) << np.uint64(61)).tolist()

    def counted(seen):
        cuts = [[0, *np.searchsorted(s, np.array(edges, np.uint64)).tolist(), len(s)] for s in seen]
        for i in range(len(edges) + 1):  # a part of the hashes at a time, to hold few copies
            tokens, counts = np.unique(np.concatenate([s[c[i]:c[i + 1]] for s, c in zip(seen, cuts)]), return_counts=True)
            shared = counts >= SHARED
            yield pa.RecordBatch.from_arrays([pa.array(tokens[shared].view(np.int64)), pa.array(counts[shared].astype(np.int64))], ["token", "n"])

    def run(batches):
        seen: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            for s in shingle_sets(batch["text"], words):
                if len(s) and (sid := set_id(s)) not in seen:
                    seen[sid] = s
                    held += len(s)
                if len(seen) >= RUN_TEXTS or held >= RUN_TOKENS:
                    yield from counted(list(seen.values()))
                    seen, held = {}, 0
        if seen:
            yield from counted(list(seen.values()))

    return run


class Order(NamedTuple):
    """Rare tokens by hash, then those that pass the filter ``shared``, then ``last`` (sorted) by ``place``."""

    shared: np.ndarray
    last: np.ndarray
    place: np.ndarray

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """Sorted tokens in this order; any fixed order finds the same links."""
        level = passes(self.shared, tokens).astype(np.int32)
        if len(self.last):
            at = np.minimum(np.searchsorted(self.last, tokens), len(self.last) - 1)
            listed = self.last[at] == tokens
            level[listed] = self.place[at[listed]] + 2
        return tokens[np.argsort(level, kind="stable")] if level.any() else tokens


def _order(counted: DataFrame) -> Order:
    """The order of tokens by the table (token, n)."""
    most = counted.orderBy(F.desc("n"), "token").limit(FREQUENT_TOKENS).select("token").toPandas()["token"]
    most = most.to_numpy(np.int64).view(np.uint64)[::-1]
    by_hash = np.argsort(most)
    return Order(build(counted.select("token"), counted.count()), most[by_hash], by_hash.astype(np.int32))


def _entries(words: int, percent: int, order: Order) -> Callable:
    """(token, sid) for the prefix of each distinct set of the task."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            tokens, owners, lengths = [], [], []
            for s in shingle_sets(batch["text"], words):
                if not len(s) or (sid := set_id(s)) in seen:
                    continue
                seen.add(sid)
                prefix = order.of(s)[:prefix_size(len(s), percent)].copy()
                tokens.append(prefix)
                owners.append(sid)
                lengths.append(len(prefix))
            if tokens:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(tokens).view(np.int64)),
                    pa.array(np.repeat(np.array(owners, np.int64), lengths)),
                ], ["token", "sid"])

    return run


def _blocks(batches):
    """The members of each token with two sets or more; sets of members that repeat are kept once."""
    parts = [(b["token"].to_numpy(), b["sid"].to_numpy()) for b in batches]
    if not parts:
        return
    token, sid = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((sid, token))
    token, sid = token[order], sid[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
    token, sid = token[fresh], sid[fresh]
    if not len(token):
        return
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    size = np.diff(np.append(first, len(token)))
    mark = np.add.reduceat(mix(sid.view(np.uint64)), first)
    chosen = np.flatnonzero(size > 1)
    _, at = np.unique(np.stack([mark[chosen], size[chosen].astype(np.uint64)], 1), axis=0, return_index=True)
    chosen = chosen[at]
    size = size[chosen]
    rows = np.repeat(first[chosen] - np.cumsum(size) + size, size) + np.arange(size.sum())
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(mark[chosen].view(np.int64), size)), pa.array(sid[rows])], ["block", "sid"])


def packed(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each token, enough to tell the tokens of two texts apart."""
    return (tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def unpacked(tokens: pa.Buffer) -> np.ndarray:
    out = np.zeros((len(tokens) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(tokens, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _sets(words: int, filled: np.ndarray, whole: bool) -> Callable:
    """Sizes and bitmaps, or whole sets, of the rows that may be a class's first row; of repeated rows one a task."""
    names = ["sid", "mark", "n", "tokens" if whole else "bits"]
    pack = packed if whole else signature

    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                sets = list(shingle_sets(part["text"], words))
                sids = np.array([set_id(s) if len(s) else 0 for s in sets], np.int64)
                may = passes(filled, sids.view(np.uint64) ^ mix(part["mark"].to_numpy().view(np.uint64)))
                kept = {}
                for sid, mark, s, m in zip(sids.tolist(), part["mark"].to_pylist(), sets, may):
                    if m and len(s) and (sid, mark) not in seen:
                        kept[sid, mark] = s
                seen.update(kept)
                columns = [pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)]
                columns += [pa.array([len(s) for s in kept.values()], pa.int64()), pa.array([pack(s) for s in kept.values()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _keys(batches):
    for batch in batches:
        keys = batch["sid"].to_numpy() ^ mix(batch["mark"].to_numpy().view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])


def _bounded(percent: int) -> Callable:
    """Pairs (a, b) whose sizes and bitmaps leave a link possible."""

    def run(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch[c].to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))):
                one, two = (np.frombuffer(v, np.uint8).view(np.uint64) for v in (x, y))
                keep.append(may_link(Node(one, _count(one), n, n, 0, 0, row=0), Node(two, _count(two), m, m, 1, 0, row=1), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(percent: int) -> Callable:
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["tokens_a"], batch["tokens_b"]):
                one, two = (unpacked(v.as_buffer()) for v in (x, y))
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _traverse(percent: int) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        sids, side = group["sid"].to_numpy(), group["side"].to_numpy()
        roots, groups = np.unique(group["root"].to_numpy(), return_inverse=True)
        pairs = []
        if len(roots) > 1:
            tree = build_tree(group["n"].to_numpy(), group["bits"].to_pylist(), groups, side)
            pairs = dual_traversal(tree, percent, group["tile_a"][0].as_py() != group["tile_b"][0].as_py())
        a, b = (sids[[p[i] for p in pairs]] if pairs else sids[:0] for i in (0, 1))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


class _Sets(NamedTuple):
    """``rows`` may hold rows of no class and several of one; ``chosen`` has the one row of each class."""

    chosen: DataFrame
    rows: DataFrame


def _with_chosen(pairs: DataFrame, sets: _Sets) -> DataFrame:
    """The size and the row of both ends; b is looked up first, as a may be the hub of many pairs."""
    for end in ("b", "a"):
        pairs = pairs.join(sets.chosen.select(F.col("sid").alias(end), F.col("n").alias(f"n_{end}"), F.col("row").alias(f"row_{end}")), end)
    return pairs


def _with_column(pairs: DataFrame, sets: _Sets, column: str) -> DataFrame:
    """The column of the rows of both ends."""
    for end in ("b", "a"):
        pairs = pairs.join(sets.rows.select(F.col("row").alias(f"row_{end}"), F.col(column).alias(f"{column}_{end}")), f"row_{end}")
    return pairs


def _bounded_pairs(pairs: DataFrame, signs: _Sets, percent: int) -> DataFrame:
    """The pairs that sizes and bitmaps do not rule out."""
    near = _with_chosen(pairs, signs).filter(f"100 * n_a >= {percent} * n_b and 100 * n_b >= {percent} * n_a")
    return _with_column(near, signs, "bits").mapInArrow(released(_bounded(percent)), "a long, b long")


class _Texts:
    """Sets are made again from the texts when asked for, for the classes that need them only."""

    def __init__(self, source: DataFrame, first_of: DataFrame, words: int):
        self.rows, self.first_of, self.words = source.select("mark", "text"), first_of, words

    def of(self, sids: DataFrame, whole: bool) -> _Sets:
        """The whole sets, or the bitmaps, of the classes in the column ``sid``."""
        firsts = materialize(self.first_of.join(sids, "sid", "left_semi"), "keys")
        filled = build(firsts.mapInArrow(released(_keys), "key long"), firsts.count())
        schema = f"sid long, mark long, n long, {'tokens' if whole else 'bits'} binary"
        rows = materialize(
            self.rows.mapInArrow(released(_sets(self.words, filled, whole)), schema).withColumn("row", F.monotonically_increasing_id()), "sets")
        # The filter lets other rows through, and copies of the first row lie in several tasks.
        chosen = rows.select("sid", "mark", "n", "row").join(firsts, ["sid", "mark"]).groupBy("sid").agg(
            F.min(F.struct("row", "n")).alias("one"))
        return _Sets(materialize(chosen.select("sid", "one.row", "one.n"), "chosen"), rows)

    def links(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs that do link, by their whole sets."""
        ends = materialize(pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct(), "ends")
        sets = self.of(ends, whole=True)
        found = _with_column(_with_chosen(pairs, sets), sets, "tokens")
        return materialize(found.mapInArrow(released(_verified(percent)), "a long, b long"), "links")


def _still_open(members_of: DataFrame, first: DataFrame, sizes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, sid, root) of the classes that may still link inside a block with another class than its first, ``a``.

    Sizes that can link lie in the same step of a scale or in neighbouring ones, so a class whose steps
    hold one component only in all its blocks has nothing to be compared with.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100.0001 / max(percent, 1)))
    placed = materialize(
        members_of.join(first.filter("held > 2"), "block").filter("sid <> a").join(sizes, "sid")
        .join(roots.withColumnRenamed("node", "sid"), "sid", "left")
        .select("block", "a", "sid", F.coalesce("root", "sid").alias("root"), step.alias("step")), "placed")
    ends = F.min("root").alias("least"), F.max("root").alias("most")
    steps = placed.groupBy("block", "step").agg(*ends)
    reached = steps.withColumn("step", F.explode(F.array(*[F.col("step") + i for i in (-1, 0, 1)]))).groupBy("block", "step").agg(
        F.min("least").alias("least"), F.max("most").alias("most"))
    open_steps = materialize(reached.filter("least <> most").select("block", "step"), "steps")
    return materialize(placed.join(open_steps, ["block", "step"]).select("a", "sid", "root").distinct(), "open")


def _linked(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """One row per row of ``docs``: (id, mark, n, component_id, lead_mark, size).

    The mark is a hash of id and text that every row has. Of the row that leads a component, the one
    with the smallest id and then mark, every row has id and mark; size counts the component's rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("mark"), F.col(text_col).alias("text"))
    texts = source.select("text")
    members = materialize(source.mapInArrow(released(_members(words)), f"id {docs.schema[id_col].dataType.simpleString()}, mark long, n long, sid long"), "members")
    total = members.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()

    counted = texts.mapInArrow(released(_shared(words)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    order = _order(materialize(counted, "shared"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total["tokens"] * (100 - percent) / 100 // ENTRIES_PER_TASK))
    members_of = materialize(
        texts.mapInArrow(released(_entries(words, percent, order)), "token long, sid long")
        .repartition(tasks, "token").mapInArrow(released(_blocks), "block long, sid long").distinct(),
        "blocks",
    )
    wanted = members_of.select("sid").distinct()
    first_of = materialize(
        members.filter("sid is not null").groupBy("sid").agg(F.min("mark").alias("mark")).join(wanted, "sid", "left_semi"), "first-rows")
    sets = _Texts(source, first_of, words)
    signs = sets.of(first_of.select("sid"), whole=False)

    # Each class with the first one of its block. The blocks of one first class make up a larger block.
    first = materialize(members_of.groupBy("block").agg(F.min("sid").alias("a"), F.count(F.lit(1)).alias("held")), "firsts")
    stars = materialize(members_of.join(first, "block").filter("sid <> a").select("a", F.col("sid").alias("b")).distinct(), "stars")
    links = sets.links(materialize(_bounded_pairs(stars, signs, percent), "near"), percent)
    roots = components(links)

    # Then the trees of the larger blocks, over the classes that have one of another component and like size in a block.
    placed = _still_open(members_of, first, signs.chosen.select("sid", "n"), roots, percent)
    tiles = materialize(placed.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles")), "mixed")
    tiled = (
        placed.join(tiles, "a")
        .withColumn("side", F.pmod(F.xxhash64("sid"), F.col("tiles")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .select("a", "sid", "root", "side", F.least("side", "other").alias("tile_a"), F.greatest("side", "other").alias("tile_b"))
    )
    pairs = materialize(
        tiled.join(signs.chosen, "sid").join(signs.rows.select("row", "bits"), "row")
        .groupBy("a", "tile_a", "tile_b").applyInArrow(_traverse(percent), "a long, b long")
        .distinct().join(stars, ["a", "b"], "left_anti"), "near",
    )
    more = sets.links(pairs, percent)
    if not more.isEmpty():
        roots = components(links.unionByName(more))

    full = members.filter("sid is not null").join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "root", F.coalesce("root", "sid"))
    lead = F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("lead")
    least = full.groupBy("root").agg(lead, F.count(F.lit(1)).alias("size"))
    least = materialize(least.select("root", F.col("lead.id").alias("component_id"), F.col("lead.mark").alias("lead_mark"), "size"), "least")
    out = full.join(least, "root").select("id", "mark", "n", "component_id", "lead_mark", "size")
    alone = members.filter("sid is null").select(
        "id", "mark", "n", F.col("id").alias("component_id"), F.col("mark").alias("lead_mark"), F.lit(1).cast("long").alias("size"))
    return out.unionByName(alone)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    Words are lower-cased in A-Z only. Two texts link when 100 * |intersection| >= percent * |union|
    of their shingle sets. component_id is the smallest id reachable by links. A text of fewer
    words than a shingle is one shingle; a null, empty or blank text has none, links with nothing
    and is its own component. Rows that repeat a text share its component, also when they repeat an
    id. A row without an id has its group's smallest id, or null if no member has one. An empty table
    gives no rows; other columns are not looked at. Shingles and sets are told apart by 64-bit hashes.
    """
    return _linked(docs, id_col, text_col, words, percent).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, all its columns unchanged: one with the component's smallest id.

    Of rows that repeat id and text any one stays; in a component without ids one row does. Texts
    without words are components of their own, and stay. Rows are found again by id and a 64-bit hash.
    """
    rows = _linked(docs, id_col, text_col, words, percent).filter("size > 1")
    stays = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("mark") == F.col("lead_mark"))
    return one_row_each(docs, rows.select("id", F.col("mark").alias("key"), stays.alias("stays")), F.xxhash64(id_col, text_col), id_col)
