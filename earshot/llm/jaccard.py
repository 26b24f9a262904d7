"""Jaccard join of shingle sets by signature trees.

Equal sets are one class. Classes that share a key meet in a cell: in a first round their smallest shingle
hashes, so that families of near copies are connected cheaply, then parts of their sets: of one part more than
linked sets of their size can differ in, one at least is equal in both, which misses no pair. In a cell the sets are the leaves of a tree whose nodes hold the OR of their sets' bitmaps and
their range of sizes. Two trees (or one with itself) are walked together; a pair of nodes is left out
where the largest possible overlap is too small, or where all below is one component already. What is
left at the leaves is counted exactly. Cells are cut into blocks of bounded size, pairs of which meet.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import settle, slabs
from earshot.llm.components import components
from earshot.session import scratch_path
from earshot.sources.history import remove

#: Least power of two of a bitmap's bits, nodes below a node, pairs of nodes looked at together, shingles in a block of a cell.
BITS, FAN, PAIRS, BLOCK = 9, 8, 1024, 1 << 19
#: Cells of the filter in front of the texts.
SIEVE = 1 << 22
SEED = 42
#: Words whose hashes a task remembers, names of sets that it remembers, texts that it looks at together.
WORDS, NAMES, TEXTS = 1 << 18, 1 << 18, 256
#: Odd multiplier of the hashes and of the second smallest-hash key (a fixed value).
MIX = 0x9E3779B97F4A7C15


class _Words(dict):
    """64-bit hashes of words; forgets all when there are many, so that its size is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


_WORDS = _Words()


def _chained(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive words, from the hashes of the words."""
    count = len(words) - width + 1
    hashes = np.full(count, width, np.uint64)
    for i in range(width):
        hashes = (hashes ^ words[i : i + count]) * np.uint64(MIX)
        hashes ^= hashes >> np.uint64(29)
    return hashes


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; with fewer words, of the whole sequence."""
    found, tail = [], np.zeros(0, np.uint64)
    for slab in slabs(text.lower()):
        own = slab.split()
        words = np.concatenate([tail, np.fromiter(map(_WORDS.__getitem__, own), np.uint64, len(own))])
        if len(words) >= width:
            found.append(np.unique(_chained(words, width)))
        tail = words[max(0, len(words) - width + 1) :]
    if found:
        return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
    return _chained(tail, len(tail)) if len(tail) else tail


def width_of(size: int) -> int:
    """Bits of the bitmap of a set: about a third of them are then set, or up to a half in a large one."""
    return 1 << max(BITS, int(2 * size - 1).bit_length()) if size else 1 << BITS


def bitmap(hashes: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, np.uint8)
    bits[(hashes >> np.uint64(24)) % np.uint64(width)] = 1
    return np.packbits(bits).view(np.uint64)


def evened(bitmaps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps folded to the shortest of them."""
    least = min(map(len, bitmaps))
    return np.stack([np.bitwise_or.reduce(b.reshape(-1, least), axis=0) for b in bitmaps])


def linked(overlap: np.ndarray | int, total: np.ndarray | int, percent: int) -> np.ndarray | bool:
    """100 * overlap >= percent * union, where ``total`` is the sum of both sizes."""
    return (100 + percent) * overlap >= percent * total


class Tree:
    """Leaves in a given order, and levels of nodes over FAN of the level below, up to ``height`` levels."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, rest: np.ndarray, labels: np.ndarray, height: int):
        slack = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        #: Of each level: OR of the bitmaps, smallest and largest size, most shingles that share a bit, most
        #: that can be shared if the key of the cell is the first shared one.
        self.levels = [(bits, sizes, sizes, slack, rest)]
        for _ in range(height - 1):
            bits, low, high, slack, rest = self.levels[-1]
            cuts = np.arange(0, len(bits), FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cuts, axis=0),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.maximum.reduceat(slack, cuts),
                    np.maximum.reduceat(rest, cuts),
                )
            )
        self.relabel(labels)

    def relabel(self, labels: np.ndarray) -> None:
        """The one label below each node, -1 where there are several."""
        self.labels = [labels]
        for _ in self.levels[1:]:
            labels = self.labels[-1]
            cuts = np.arange(0, len(labels), FAN)
            same = np.minimum.reduceat(labels, cuts) == np.maximum.reduceat(labels, cuts)
            self.labels.append(np.where(same, labels[cuts], -1))


def height(n: int) -> int:
    levels = 1
    while n > FAN:
        n, levels = -(-n // FAN), levels + 1
    return levels


def walk(left: Tree, right: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves that may be linked and differ in their label; of one tree with itself, i < j."""
    same = left is right
    top = len(left.levels) - 1
    i, j = (x.ravel() for x in np.indices((len(left.levels[top][0]), len(right.levels[top][0]))))
    stack = [(top, *((i[i <= j], j[i <= j]) if same else (i, j)))]
    steps = np.indices((FAN, FAN)).reshape(2, -1)
    while stack:
        level, i, j = stack.pop()
        if len(i) > PAIRS:
            stack.append((level, i[PAIRS:], j[PAIRS:]))
            i, j = i[:PAIRS], j[:PAIRS]
        if same and not level:
            i, j = i[i < j], j[i < j]
        (bits, low, high, slack, rest), (bits2, low2, high2, slack2, rest2) = left.levels[level], right.levels[level]
        labels, labels2 = left.labels[level], right.labels[level]
        shared = np.bitwise_count(bits[i] & bits2[j]).sum(axis=1, dtype=np.int64) + np.minimum(slack[i], slack2[j])
        most = np.minimum(shared, np.minimum(rest[i], rest2[j]))
        fits = linked(most, low[i] + low2[j], percent) & (100 * high[i] >= percent * low2[j]) & (100 * high2[j] >= percent * low[i])
        fits &= (labels[i] != labels2[j]) | (labels[i] < 0)
        i, j = i[fits], j[fits]
        if not len(i):
            continue
        if not level:
            yield i, j
            continue
        a, b = (i[:, None] * FAN + steps[0]).ravel(), (j[:, None] * FAN + steps[1]).ravel()
        there = (a < len(left.levels[level - 1][0])) & (b < len(right.levels[level - 1][0]))
        if same:
            there &= a <= b
        stack.append((level - 1, a[there], b[there]))


def _trees(bits: np.ndarray, sizes: np.ndarray, rest: np.ndarray, labels: np.ndarray, sides: np.ndarray) -> Iterator[tuple[Tree, Tree, np.ndarray, np.ndarray]]:
    """The one tree of a block, or the trees of both blocks, with the rows of their leaves."""
    order = np.lexsort((sizes, labels))
    rows = [order[sides[order] == s] for s in np.unique(sides)]
    levels = height(max(map(len, rows)))
    trees = [Tree(bits[r], sizes[r], rest[r], labels[r], levels) for r in rows]
    yield trees[0], trees[-1], rows[0], rows[-1]


def candidates(bits: np.ndarray, sizes: np.ndarray, rest: np.ndarray, labels: np.ndarray, sides: np.ndarray, percent: int) -> np.ndarray:
    """Which sets may be linked to one of another label."""
    flagged = np.zeros(len(sizes), bool)
    for left, right, rows, rows2 in _trees(bits, sizes, rest, labels, sides):
        for i, j in walk(left, right, percent):
            flagged[rows[i]] = flagged[rows2[j]] = True
    return flagged


def links(sets: list[np.ndarray], rest: np.ndarray, labels: np.ndarray, sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Verified links that connect all sets of a cell that links connect, labels taken as given."""
    sizes, known, found = np.array([len(s) for s in sets]), labels.copy(), []
    width = width_of(int(sizes.max()))
    bits = np.stack([bitmap(s, width) for s in sets])
    members: dict[int, frozenset] = {}
    for left, right, rows, rows2 in _trees(bits, sizes, rest, labels, sides):
        for i, j in walk(left, right, percent):
            a, b = rows[i], rows2[j]
            apart = known[a] != known[b]
            before = len(found)
            for u, v in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
                if known[u] == known[v]:
                    continue
                x, y = (members.get(k) or members.setdefault(k, frozenset(sets[k].tolist())) for k in (u, v))
                if linked(len(x & y), len(x) + len(y), percent):
                    known[known == known[v]] = known[u]
                    found.append((u, v))
            if len(found) > before:
                left.relabel(known[rows])
                right.relabel(known[rows2])
    return found


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes], tuple]]:
    """node, root (as numbers from 0), block, size, rest and payload of the rows of each cell; rows come sorted by key, x, y."""
    held, now = [], None
    for batch in batches:
        numbers = [batch.column(c).to_numpy() for c in ("node", "root", "block", "size", "rest")]
        marks = np.stack([batch.column(c).to_numpy() for c in ("key", "x", "y")], axis=1)
        cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            if start == stop:
                continue
            cell = tuple(marks[start].tolist())
            if cell != now and held:
                yield _cell(held, now)
                held = []
            now = cell
            held.append(([x[start:stop] for x in numbers], batch.column("payload").slice(start, stop - start).to_pylist()))
    if held:
        yield _cell(held, now)


def _cell(held: list, cell: tuple) -> tuple:
    node, root, block, size, rest = (np.concatenate(x) for x in zip(*(numbers for numbers, _ in held), strict=True))
    return node, np.unique(root, return_inverse=True)[1], block, size, rest, [v for _, values in held for v in values], cell


def _sieve(keys: DataFrame) -> np.ndarray:
    """A one-hash filter of SIEVE bits, whatever the number of keys: its cells, at most, reach the driver."""
    cells = keys.select(F.pmod(F.xxhash64("node"), F.lit(SIEVE)).cast("int").alias("cell")).distinct()
    bits = np.zeros(SIEVE, bool)
    bits[cells.toArrow()["cell"].to_numpy()] = True
    return np.packbits(bits, bitorder="little")


def _some_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, payload) with the texts of the wanted nodes and, as the filter lets some pass, of a few others."""
    shared = texts.sparkSession.sparkContext.broadcast(_sieve(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            node, cell, text = batch.columns
            cell = cell.to_numpy()
            kept = np.flatnonzero(bits[cell >> 3] >> (cell & 7) & 1)
            for start in range(0, len(kept), TEXTS):
                some = pa.array(kept[start : start + TEXTS])
                yield pa.RecordBatch.from_arrays([node.take(some), text.take(some)], ["node", "payload"])

    cell = F.pmod(F.xxhash64("node"), F.lit(SIEVE)).cast("int").alias("cell")
    return texts.select("node", cell, F.col("text").cast("binary")).mapInArrow(run, "node long, payload binary")


def _bitmaps(texts: DataFrame, width: int) -> DataFrame:
    """(node, payload) with the bitmaps of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), TEXTS):
                node, values = batch.slice(start, TEXTS).columns
                sets = (shingles(t, width) for t in values.to_pylist())
                bits = pa.array([bitmap(s, width_of(len(s))).tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([node, bits], ["node", "payload"])

    return texts.mapInArrow(run, "node long, payload binary")


def _work(cells: DataFrame, run: Callable, schema: str) -> DataFrame:
    return cells.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(run, schema)


def _verify(cells: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (u, v) of the cells (key, x, y, node, root, size, rest, block), from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, labels, block, _, rest, payload, _ in _cells(batches):
            found = links([shingles(t, width) for t in payload], rest, labels, block, percent)
            if found:
                u, v = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], ["u", "v"])

    full = cells.join(_some_texts(texts, cells.select("node")), "node")
    return _work(full, run, "u long, v long")


def _distinct(cells: DataFrame) -> DataFrame:
    """Cells of equal members (``m1``, ``m2``) are one: close sets share most of their parts."""
    return cells.dropDuplicates(["m1", "m2"]).drop("m1", "m2")


def _marks() -> list[Column]:
    return [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"m{i}") for i in (1, 2)]


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Add ``x``, ``y`` and ``block`` to the members (key, node, root, size, rest, home) of cells with more than one root and one at home at least.

    A cell is cut into blocks of about ``block`` shingles; a member comes once for each pair of blocks that
    its own is in.
    """
    cells = members.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.max("home").alias("any"), F.sum("size").alias("weight"), *_marks())
    cells = _distinct(cells.filter("least <> most and any")).select("key", F.ceil(F.col("weight") / block).alias("n_blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("n_blocks")).alias("block")
    dealt = members.join(cells, "key").select("key", "node", "root", "size", "rest", own, F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("other"))
    return dealt.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node", "root", "size", "rest", "block")


def _first_round(classes: DataFrame, block: int) -> DataFrame:
    """Cells of the smallest hashes, cut into blocks that each hold the cell's first class besides."""
    keyed = classes.select(F.explode(F.array("k1", "k2")).alias("key"), "node", "size")
    cells = keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n"), F.sum("size").alias("weight"), *_marks())
    cells = _distinct(cells.filter("n > 1"))
    own = F.pmod(F.xxhash64("node"), F.col("n_blocks"))
    dealt = keyed.join(cells.select("key", "pivot", F.ceil(F.col("weight") / block).alias("n_blocks")), "key").withColumn(
        "x", F.explode(F.when(F.col("node") == F.col("pivot"), F.expr("sequence(0L, n_blocks - 1)")).otherwise(F.array(own)))
    )
    zero = F.lit(0).cast("long")
    return dealt.select("key", "x", zero.alias("y"), "node", F.col("node").alias("root"), "size", F.col("size").alias("rest"), zero.alias("block"))


def _named(texts: DataFrame, width: int) -> DataFrame:
    """(doc_id, node, c1, c2, k1, k2, size) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), TEXTS):
                ids, nodes, values = batch.slice(start, TEXTS).columns
                sets = [shingles((t or "").encode(), width) for t in values.to_pylist()]
                names = np.array([np.frombuffer(blake2b(s, digest_size=16).digest(), np.int64) for s in sets])
                mins = np.array([[s[0], (s * np.uint64(MIX)).min()] if len(s) else [0, 0] for s in sets], np.uint64).view(np.int64)
                columns = [ids, nodes, *(pa.array(x.copy()) for x in (*names.T, *mins.T)), pa.array([len(s) for s in sets], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, fields)

    fields = ["doc_id", "node", "c1", "c2", "k1", "k2", "size"]
    return texts.select("doc_id", "node", "text").mapInArrow(run, ", ".join(f"{f} long" for f in fields))


def rung_of(size: int, percent: int) -> int:
    """Rung of a size: sizes of linked sets are at most one rung apart."""
    return math.floor(math.log(size) / _step(percent))


def _step(percent: int) -> float:
    # A little wider than the ratio, so that rounding can't part two sizes further.
    return math.log(100 / percent) * 1.000001 if percent < 100 else 1e-6


@lru_cache(256)
def _bounds(rung: int, percent: int) -> np.ndarray:
    """First hashes of the parts of sets up to a rung: one part more than linked ones can differ in."""
    most = math.floor(math.exp((rung + 1) * _step(percent))) + 1
    # Linked sets of a and b shingles differ in (100 - percent) / (100 + percent) * (a + b) at most.
    n = 2 * most * (100 - percent) // (100 + percent) + 1
    return np.array([(i << 64) // n for i in range(n)], np.uint64)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    for shift in (np.uint64(29), np.uint64(32)):
        hashes = hashes * np.uint64(MIX)
        hashes ^= hashes >> shift
    return hashes


def part_keys(hashes: np.ndarray, rung: int, percent: int) -> np.ndarray:
    """A key for each part of a set (sorted hashes), the empty ones too, in a rung."""
    bounds = _bounds(rung, percent)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(hashes), dtype=np.uint64)])
    ends = np.append(np.searchsorted(hashes, bounds), len(hashes))
    places = _mixed(np.arange(len(bounds), dtype=np.uint64) + np.uint64(rung << 32))
    return _mixed((sums[ends[1:]] - sums[ends[:-1]]) ^ places)


def _parts(texts: DataFrame, percent: int, width: int) -> DataFrame:
    """(key, c1, home): parts of sets, by rung of size, that several classes share; c1 is half of a class's name.

    Linked sets meet in the rung of the larger, so each comes with the parts of its rung (``home``) and of
    that above. A task passes on a set once as far as it remembers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for start in range(0, len(batch), TEXTS):
                keys, names, homes = [], [], []
                for value in batch.column(0).slice(start, TEXTS).to_pylist():
                    hashes = shingles((value or "").encode(), width)
                    name = int(np.frombuffer(blake2b(hashes, digest_size=16).digest(), np.int64)[0])
                    if not len(hashes) or name in seen:
                        continue
                    if len(seen) >= NAMES:
                        seen.clear()
                    seen.add(name)
                    rung = rung_of(len(hashes), percent)
                    for up in (0, 1):
                        keys.append(part_keys(hashes, rung + up, percent))
                        names.append(name)
                        homes.append(up == 0)
                if keys:
                    lengths = [len(k) for k in keys]
                    columns = [np.concatenate(keys).view(np.int64), np.repeat(np.array(names, np.int64), lengths), np.repeat(homes, lengths)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "c1", "home"])

    found = texts.select("text").mapInArrow(run, "key long, c1 long, home boolean").repartition("key")
    of_key = Window.partitionBy("key")
    ends = found.select("*", F.min("c1").over(of_key).alias("least"), F.max("c1").over(of_key).alias("most"), F.max("home").over(of_key).alias("any"))
    return ends.filter("least <> most and any").select("key", "c1", "home").dropDuplicates()


def jaccard_groups(
    docs: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Texts are lower-cased over A-Z and split at ASCII white space; a set has the distinct shingles of
    ``width`` words, with fewer words the whole sequence. Two sets are linked when 100 times their
    intersection is ``percent`` times their union at least; the component is the smallest doc_id reachable.
    Null, empty and blank texts have no shingles and are linked with nothing, not even each other: their
    component is their own id. Repeated rows stay, each with the same result; a null id stays and names no
    component that has another. Texts may be of any length. Other columns are not read. An empty table gives
    an empty result.

    Shingles are compared by 64-bit hashes, classes named by 128 bits. Equal sets take part once, so copies
    cost nothing; no pairs of a cell are listed, only links that connect what wasn't connected. A cell costs
    what its blocks of ``block`` shingles leave to compare: families that the first round connects cost no
    more; sets of a hot cell that are close but not linked are compared block by block, by many tasks.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("node"), F.col(text_col).cast("string").alias("text"))
    path = scratch_path(docs.sparkSession, "texts")
    narrow.write.parquet(path)
    texts = docs.sparkSession.read.schema("doc_id long, node long, text string").parquet(path)
    named = settle(_named(texts, width), "named")
    members = named.select("doc_id", "c1", "c2", "size")
    classes = named.filter("size > 0").groupBy("c1", "c2").agg(*(F.min(c).alias(c) for c in ("node", "size", "k1", "k2", "doc_id")))
    classes = settle(classes, "classes")

    near = settle(_verify(settle(_first_round(classes, block), "cells"), texts, percent, width), "near")
    roots = components(near)
    rooted = settle(classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    entries = settle(_parts(texts, percent, width), "parts").join(rooted.select("c1", "node", "root", "size"), "c1").drop("c1")
    cells = settle(_blocks(entries.withColumn("rest", F.col("size")), block), "cells")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, labels, side, sizes, rest, payload, cell in _cells(batches):
            bits = evened([np.frombuffer(p, np.uint64) for p in payload])
            kept = np.flatnonzero(candidates(bits, sizes, rest, labels, side, percent))
            if len(kept):
                yield pa.RecordBatch.from_arrays([pa.array(node[kept]), *(pa.array(np.full(len(kept), c, np.int64)) for c in cell)], ["node", "key", "x", "y"])

    signed = cells.join(_bitmaps(_some_texts(texts, cells.select("node")), width), "node")
    left = settle(_work(signed, sift, "node long, key long, x long, y long"), "left")
    worth = settle(left.join(cells, ["node", "key", "x", "y"]), "worth")
    far = settle(_verify(worth, texts, percent, width), "far")
    reached = components(near.unionByName(far))
    grouped = classes.join(reached, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    chosen = settle(grouped.join(names, "root").select("c1", "c2", "component_id"), "names")
    remove(docs.sparkSession, path)
    joined = members.join(chosen, ["c1", "c2"], "left")
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))
