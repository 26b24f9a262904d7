import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from conftest import rows
from earshot.llm.prefix_trie import PerfectHash, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(turns):
    """Every beginning in a dictionary."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - int(np.fmod(c, 5)), [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in convs if rebuilt[c] == node))
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        children = [n for n in below if len(n) == len(node) + 1]
        parent = min(members[node[:-1]]) if node else None
        yield min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()


def check(spark, turns, **sizes):
    found = prefix_trie(spark.createDataFrame(turns, SCHEMA), **sizes)
    order = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(found) == sorted(plain(turns), key=order)


def conversations(seed, n, most, kinds):
    draw = random.Random(seed)
    for c in range(n):
        for t in range(draw.randrange(most)):
            yield c, t, draw.choice(["user", "assistant"]) if t > 2 else "user", f"é {draw.randrange(kinds) if t > 3 else 0}" * (t % 3)


@pytest.mark.parametrize(("band", "shard_rows"), [(256, 1 << 17), (2, 40), (3, 7)])
def test_equals_brute_force(spark, band, shard_rows):
    check(spark, [*conversations(band, 40, 14, 2)], band=band, shard_rows=shard_rows)


def test_odd_turns(spark):
    turns = [
        (0, 1, "user", "a"), (0, None, "user", "first"), (0, 2, None, "b"), (0, 3, "user", None), (3, 5, "x", "ac"), (3, 6, "xa", "c"),
        (3, 6, "xa", "c"), (None, 1, "user", "gone"), (-3, 0, "user", "a"), (-3, 1, "user", "b"), (7, 0, "", ""), (12, 0, "only", "one"),
    ]
    check(spark, turns, band=2, shard_rows=5)


def test_copies_and_one_long_conversation(spark):
    """A conversation with a third of all turns, and a third of all conversations alike."""
    turns = [(5, t, "user", f"t{t % 7}") for t in range(90)]
    turns += [(c, t, "user", f"same {t}") for c in range(100, 130) for t in range(3)]
    turns += [*conversations(4, 30, 6, 3)]
    check(spark, [(c + 1000 if c < 5 else c, *r) for c, *r in turns], band=4, shard_rows=25)


def test_empty_table_and_clashing_columns(spark):
    turns = [*conversations(9, 20, 8, 2)]
    assert rows(prefix_trie(spark.createDataFrame([], SCHEMA))) == []
    wide = spark.createDataFrame([(*t, "x", 1, "y") for t in turns], SCHEMA + ", conv string, d long, mark string")
    assert rows(prefix_trie(wide)) == rows(prefix_trie(spark.createDataFrame(turns, SCHEMA)))


def test_perfect_hash_has_no_gaps_and_knows_strangers():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2)).astype(np.uint64)
    slots = PerfectHash(keys)
    assert sorted(slots(keys).tolist()) == list(range(5000))
    assert (slots(keys + np.uint64(1)) == -1).all()
    assert PerfectHash(keys[:0])(keys).tolist() == [-1] * 5000
