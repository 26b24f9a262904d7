"""The trie of conversations' beginnings, as perfect-hash node tables over flat arrays.

Every turn has a digest, every beginning of a conversation the digest of its turns. Equal beginnings are
one node. A node belongs to its smallest conversation; the nodes of one conversation that belong to it
are the lower end of its path. Sums over subtrees are linear in the nodes, so paths are dealt to shards
as they come, a node of many paths standing in many shards with its value in one: each shard numbers its
digests by a minimal perfect hash, scatters the values into flat arrays and adds them up through the
parents' slots, deepest first; the shards' sums of a node are then added. Paths are cut into bands of
depth, with what lies below a band carried to its lowest node, so a very long conversation is spread too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import settle

#: Depths of one band, rows of one shard, conversation ids of one run, and the shares of shared beginnings.
BAND, SHARD, RUN = 256, 1 << 17, 1 << 14
GROUP, SHARES = 5, 9
ROOT = b"\0" * 16
EMPTY = hashlib.sha256(b"").hexdigest()
#: Cells of a level of the perfect hash for each key left, and the odd multipliers that mix its two halves (fixed values).
ROOM = 2.0
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)


class PerfectHash:
    """Slots 0 .. n-1 for n distinct 16-byte keys, each verified against the key kept at its slot.

    Keys that are alone in their cell of a level get the rank of the cell; the others go on to the next.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, left, done = [], np.arange(len(keys)), 0
        while len(left):
            size = int(ROOM * len(left)) + 1
            cells = self._cells(keys[left], len(self.levels), size)
            alone = np.bincount(cells, minlength=size) == 1
            self.levels.append((size, alone, done + np.cumsum(alone) - 1))
            done += int(alone.sum())
            left = left[~alone[cells]]
        self.kept = np.zeros((done, 2), np.uint64)
        self.kept[self._slots(keys)] = keys

    @staticmethod
    def _cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = keys[:, 0] * np.uint64(MIX[0]) ^ (keys[:, 1] + np.uint64(level)) * np.uint64(MIX[1])
            x = (x ^ (x >> np.uint64(31))) * np.uint64(MIX[2])
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        found, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (size, alone, rank) in enumerate(self.levels):
            cells = self._cells(keys[left], level, size)
            hit = alone[cells]
            found[left[hit]] = rank[cells[hit]]
            left = left[~hit]
        return found

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that were not given."""
        found = self._slots(keys)
        if len(self.kept):
            found[(self.kept[found] != keys).any(axis=1)] = -1
        return found


def _keys(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _hash(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _ordered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, mark, size, pos, part) by rows that range partitioning puts in order, and (conv, part, first, n).

    Turns of one conversation may lie in many partitions; equal ones are told apart by their row.
    """
    ordered = (
        turns.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(F.col("conv"), F.col("turn").asc_nulls_first(), F.col("mark"), F.col("row"))
        .sortWithinPartitions(F.col("conv"), F.col("turn").asc_nulls_first(), F.col("mark"), F.col("row"))
        .select("conv", "mark", "size", F.monotonically_increasing_id().alias("pos"))
        .withColumn("part", F.shiftright("pos", 33))
    )
    ordered = settle(ordered, "turns")
    spans = ordered.groupBy("conv", "part").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    return ordered, settle(spans, "spans")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv, d, mark, size, last), d from 1, and conversations (conv, length)."""
    ordered, spans = _ordered(turns)
    lengths = spans.groupBy("conv").agg(F.sum("n").alias("n"))
    share = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARES
    convs = (
        lengths.select("conv", "n", share.alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
        .join(lengths.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left")
        .withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
        .select("conv", "base", "h", "shared", (F.col("shared") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length"))
    )
    convs = settle(convs, "conversations")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = spans.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(convs, "conv")
    numbered = ordered.join(placed.drop("n", "base"), ["conv", "part"]).withColumn("i", F.col("pos") - F.col("first") + F.col("before") + 1)
    own = numbered.filter("i > h").withColumn("d", F.col("shared") + F.col("i") - F.col("h")).select("conv", "d", "mark", "size", F.col("d") == F.col("length"))
    firsts = numbered.filter((F.col("i") < SHARES) & (F.col("conv") % GROUP == 0)).select(F.col("conv").alias("base"), F.col("i").alias("d"), "mark", "size")
    lent = firsts.join(convs, "base").filter("d <= shared").select("conv", "d", "mark", "size", F.col("d") == F.col("length"))
    return settle(own.unionByName(lent.toDF(*own.columns)).toDF("conv", "d", "mark", "size", "last"), "rebuilt"), convs


def _chains(rows: DataFrame, band: int) -> DataFrame:
    """``rows`` (conv, d, mark, ...) with ``here``, the digest of the marks of its block up to it, and ``above``, up to the one before."""
    schema = rows.schema.simpleString()[7:-1] + ",here:binary,above:binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, b""
        for batch in batches:
            here, above = [], []
            for conv, d, mark in zip(*(batch.column(c).to_pylist() for c in ("conv", "d", "mark")), strict=True):
                block = (conv, (d - 1) // band)
                if block != now:
                    now, digest = block, b""
                above.append(digest)
                digest = hashlib.sha256(digest + mark).digest()[:16]
                here.append(digest)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(here, pa.binary()), pa.array(above, pa.binary())], [*batch.schema.names, "here", "above"])

    block = F.expr(f"(d - 1) div {band}")
    return rows.repartition(F.col("conv"), block).sortWithinPartitions("conv", "d").mapInArrow(run, schema)


def _prefixes(rows: DataFrame, longest: int, band: int) -> DataFrame:
    """``rows`` (conv, d, mark, ...) with ``digest`` and ``parent``: the digests of the first d and d - 1 marks.

    Blocks of ``band`` marks are chained by themselves; whole blocks are marks of a sequence of their own,
    whose digests stand before those of the next block. The number of levels is the logarithm of ``longest``.
    """
    local = _chains(rows, band)
    if longest <= band:
        parent = F.when(F.col("d") == 1, F.lit(ROOT)).otherwise(F.col("above"))
        return local.withColumn("digest", F.col("here")).withColumn("parent", parent).drop("here", "above", "mark")
    local = settle(local, "chains")
    blocks = local.filter(F.col("d") % band == 0).select("conv", F.expr(f"d div {band}").alias("d"), F.col("here").alias("mark"))
    blocks = settle(_prefixes(blocks, longest // band, band).select("conv", F.col("d").alias("k"), "digest"), "blocks")
    before = blocks.select("conv", "k", F.col("digest").alias("before"))
    upto = blocks.select("conv", F.col("k").alias("k2"), F.col("digest").alias("upto"))
    joined = (
        local.withColumn("k", F.expr(f"(d - 1) div {band}"))
        .withColumn("k2", F.when(F.col("d") % band == 0, F.col("k") + 1))
        .join(before, ["conv", "k"], "left")
        .join(upto, ["conv", "k2"], "left")
    )
    behind = lambda part: F.when(F.col("k") == 0, part).otherwise(_hash(F.col("before"), part))
    parent = F.when(F.col("d") == 1, F.lit(ROOT)).when(F.col("above") == b"", F.col("before")).otherwise(behind(F.col("above")))
    return (
        joined.withColumn("digest", F.coalesce("upto", behind(F.col("here"))))
        .withColumn("parent", parent)
        .drop("here", "above", "mark", "k", "k2", "before", "upto")
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """(d, digest, ends_sha256) of (d, digest, conv): runs of sorted ids are joined by many tasks, then hashed in order."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, done = None, [], []
        for batch in batches:
            for d, digest, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (d, digest) != now or len(held) >= RUN:
                    if held:
                        done.append((*now, held[0], ",".join(map(str, held))))
                    now, held = (d, digest), []
                held.append(conv)
            yield _batch(done, run_schema)
            done = []
        if held:
            yield _batch([(*now, held[0], ",".join(map(str, held)))], run_schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for d, digest, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (d, digest) != now:
                    if now:
                        done.append((*now, state.hexdigest()))
                    now, state = (d, digest), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(done, end_schema)
            done = []
        if now:
            yield _batch([(*now, state.hexdigest())], end_schema)

    node = [("d", pa.int64()), ("digest", pa.binary())]
    run_schema, end_schema = pa.schema([*node, ("first", pa.int64()), ("ids", pa.string())]), pa.schema([*node, ("ends_sha256", pa.string())])
    ordered = ends.repartitionByRange("d", "digest", "conv").sortWithinPartitions("d", "digest", "conv")
    joined = ordered.mapInArrow(runs, "d long, digest binary, first long, ids string")
    dealt = joined.repartition("d", "digest").sortWithinPartitions("d", "digest", "first").select("d", "digest", "ids")
    return dealt.mapInArrow(hashed, "d long, digest binary, ends_sha256 string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def shard_sums(table: pa.Table, band: int = BAND) -> pa.Table:
    """Sums of a shard's nodes over what lies below them in it: (d, digest, children, leaves, saved).

    ``table`` has rows (d, digest, parent, own, leaf, saved, leaves_below, saved_below); paths that share a
    node repeat it. Links that leave a band end it; the child at the top of a band counts for its parent
    by a row of its own.
    """
    d, own = table["d"].to_numpy(), table["own"].to_numpy()
    digests, parents = _keys(table["digest"]), _keys(table["parent"])
    nodes, first = np.unique(digests, axis=0, return_index=True)
    slots = PerfectHash(nodes)
    at, up = slots(digests), slots(parents)
    up[d % band == 0] = -1
    n = len(nodes)
    depth, parent = np.zeros(n, np.int64), np.full(n, -1)
    depth[at], parent[at] = d, up
    children, leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(leaves, at, own * table["leaf"].to_numpy() + table["leaves_below"].to_numpy())
    np.add.at(saved, at, own * table["saved"].to_numpy() + table["saved_below"].to_numpy())
    np.add.at(children, up[own & (up >= 0)], 1)
    order = np.argsort(-(depth % band), kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order] % band)) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    tops = np.flatnonzero(own & (d % band == 0) & (d > 0))
    none = np.zeros(len(tops), np.int64)
    names = np.empty(n, object)
    names[at[first]] = [table["digest"][i].as_py() for i in first.tolist()]
    return pa.table(
        {
            "d": np.concatenate([depth, d[tops] - 1]),
            "digest": pa.array([*names, *(table["parent"][i].as_py() for i in tops.tolist())], pa.binary()),
            "children": np.concatenate([children, none + 1]),
            "leaves": np.concatenate([leaves, none]),
            "saved": np.concatenate([saved, none]),
        }
    )


def prefix_trie(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    band: int = BAND,
    shard_rows: int = SHARD,
) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations: a node of their trie.

    A conversation c begins with the first h turns of conversation c - c % 5 (all of them if there are
    fewer, none if there is no such conversation) and goes on with its own turns behind its first h; h is
    the unsigned crc32 of c in decimal, modulo 9. Turns are in the order of ``turn``, null first, equal ones
    by a digest of role and text. A null role or text is empty; rows of a null id take no part; repeated
    rows are turns of their own. Other columns are not read. An empty table gives no rows, not even a root.

    Columns: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members),
    n_children, n_leaves (nodes without children in the subtree), saved_tokens (over the subtree, members
    but one times UTF-8 bytes of the last text), ends_sha256 (hex digest of the comma-joined ids of the
    members that end there). Digests have 128 bits. A conversation of any length is cut into bands of
    ``band`` turns, a shard has about ``shard_rows`` rows, and only counts of rows reach the driver.
    """
    if band < 2:
        raise ValueError("a band has two turns at least")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        _hash(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("mark"),
        F.octet_length(text).cast("long").alias("size"),
    ).filter("conv is not null")
    rebuilt, convs = _rebuilt(turns)
    longest = convs.agg(F.max("length")).first()[0] or 0
    paths = _prefixes(rebuilt, longest, band).select("conv", "d", "size", "last", "digest", "parent")
    top = convs.select("conv", F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("size"), (F.col("length") == 0).alias("last"), F.lit(ROOT).alias("digest"), F.lit(ROOT).alias("parent"))
    paths = settle(paths.unionByName(top), "paths")
    nodes = settle(
        paths.groupBy("d", "digest").agg(
            F.min("conv").alias("conv"),
            F.count("*").alias("n_convs"),
            F.sum(F.col("last").cast("long")).alias("n_ends"),
            F.min(F.when(F.col("last"), F.col("conv"))).alias("first_end"),
            F.min("parent").alias("parent"),
            F.max("size").alias("size"),
        ),
        "nodes",
    )
    # A node's smallest conversation is also that of the nodes below it on its path: those with an end of their own own nodes.
    owners = nodes.filter("first_end = conv").select("conv")
    owned = nodes.select(
        "conv", "d", "digest", F.lit(True).alias("own"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved")
    )
    walked = paths.join(owners, "conv", "left_semi").join(owned, ["conv", "d", "digest"], "left")
    walked = walked.select("conv", "d", "digest", "parent", F.coalesce("own", F.lit(False)).alias("own"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("leaf", "saved")))
    zero = F.lit(0).cast("long")
    if longest < band:
        walked = walked.withColumn("leaves_below", zero).withColumn("saved_below", zero)
    else:
        walked = settle(walked, "walked")
        level = F.expr(f"d div {band}")
        below = Window.partitionBy("conv").orderBy("level").rowsBetween(1, Window.unboundedFollowing)
        bands = walked.groupBy("conv", level.alias("level")).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        carried = bands.select("conv", (F.col("level") * band + band - 1).alias("d"), F.sum("leaf").over(below).alias("leaves_below"), F.sum("saved").over(below).alias("saved_below"))
        walked = walked.join(carried, ["conv", "d"], "left").fillna(0, ["leaves_below", "saved_below"])
    n_shards = max(1, -(-paths.count() // shard_rows))
    shard = F.pmod(F.xxhash64("conv", F.expr(f"d div {band}")), F.lit(n_shards)).alias("shard")
    columns = ("d", "digest", "parent", "own", "leaf", "saved", "leaves_below", "saved_below")
    sums = (
        walked.select(shard, *columns)
        .groupBy("shard")
        .applyInArrow(lambda t: shard_sums(t, band), "d long, digest binary, children long, leaves long, saved long")
        .groupBy("d", "digest")
        .agg(F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    ends = _end_digests(paths.filter("last").select("d", "digest", "conv"))
    above = nodes.select((F.col("d") + 1).alias("d"), F.col("digest").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        nodes.join(sums, ["d", "digest"])
        .join(ends, ["d", "digest"], "left")
        .join(above, ["d", "parent"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            F.col("d").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )
