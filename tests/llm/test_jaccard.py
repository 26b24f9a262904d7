import random
import re

import numpy as np
import pytest
from llm_helpers import odd_docs, texts
from pyspark.sql import functions as F

from conftest import rows
from earshot.llm import jaccard
from earshot.llm.jaccard import Tree, bitmap, evened, height, jaccard_groups, linked, links, part_keys, rung_of, shingles, walk, width_of


def word_sets(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain(docs, percent=90):
    """Every pair of rows."""
    sets = [word_sets(t) for _, t in docs]
    parent = list(range(len(docs)))

    def of(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[of(i)] = of(j)
    for i, (doc_id, _) in enumerate(docs):
        ids = [d for k, (d, _) in enumerate(docs) if of(k) == of(i) and d is not None] if sets[i] else [doc_id]
        yield doc_id, len(sets[i]), min(ids, default=None)


def same(found, docs, percent=90):
    order = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(found) == sorted(plain(docs, percent), key=order)


def family(draw, n, words, edits):
    """Copies of one text, each with some words replaced."""
    base = [f"w{draw.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(words)] = f"e{draw.randrange(40)}"
        yield " ".join(copy)


def corpus(seed):
    draw = random.Random(seed)
    values = [t for _ in range(12) for t in family(draw, draw.randrange(2, 9), draw.randrange(3, 130), 4)]
    values += [" ".join(f"u{draw.randrange(3000)}" for _ in range(draw.randrange(90))) + " all rights reserved by nobody at all" for _ in range(40)]
    draw.shuffle(values)
    return values


@pytest.mark.parametrize(("seed", "block"), [(1, 1 << 19), (2, 400)])
def test_equals_all_pairs(spark, seed, block):
    docs = list(enumerate(corpus(seed)))
    same(jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string"), block=block), docs)


def test_a_family_with_a_third_of_all_rows(spark, monkeypatch):
    """Near copies that share one hot cell, cut into many blocks, among chains and strangers."""
    monkeypatch.setattr(jaccard, "FAN", 3)
    draw = random.Random(5)
    values = [*family(draw, 120, 60, 2), *family(draw, 60, 58, 6), *corpus(6)[:60]]
    chain = [f"c{i}" for i in range(40)]
    values += [" ".join(chain[: 40 - k]) for k in range(12)] + [values[0]] * 30
    docs = list(enumerate(values, 100))
    same(jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string"), block=1500), docs)


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark)
    same(jaccard_groups(docs), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rows(jaccard_groups(docs.limit(0))) == []
    assert rows(jaccard_groups(texts(spark, ["", None, "  "]))) == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]


def test_other_similarity_and_long_texts(spark):
    draw = random.Random(8)
    docs = list(enumerate([*family(draw, 20, 50, 5), *family(draw, 3, 4000, 300)]))
    same(jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string"), percent=70), docs, 70)


@pytest.mark.parametrize("size", [1, 7, 40, 90])
def test_walk_leaves_out_no_link(size):
    draw = random.Random(size)
    sets = [shingles(t.encode(), 3) for t in family(draw, size, 70, 9)]
    sizes, labels = np.array([len(s) for s in sets]), np.arange(size)
    tree = Tree(evened([bitmap(s, width_of(len(s))) for s in sets]), sizes, sizes, labels, height(size))
    met = {(int(a), int(b)) for i, j in walk(tree, tree, 90) for a, b in zip(i, j)}
    true = {(i, j) for j in range(size) for i in range(j) if linked(len(set(sets[i].tolist()) & set(sets[j].tolist())), len(sets[i]) + len(sets[j]), 90)}
    assert true <= met
    found = links(sets, sizes, labels, np.zeros(size, int), 90)
    assert len(found) < size and {tuple(sorted(x)) for x in found} <= true


@pytest.mark.parametrize("percent", [70, 90, 100])
def test_linked_sets_share_a_part_in_the_rung_of_the_larger(percent):
    draw = np.random.default_rng(percent)
    for size in [*range(1, 60), 333, 5000]:
        base = draw.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
        for extra in range(3 + size // 3):
            kept = draw.permutation(base)[: size - extra // 2]
            other = np.unique(np.append(kept, draw.integers(0, 1 << 63, extra - extra // 2, dtype=np.uint64)))
            a, b = np.unique(base), other
            if len(b) and linked(len(np.intersect1d(a, b)), len(a) + len(b), percent):
                rung = max(rung_of(len(a), percent), rung_of(len(b), percent))
                assert rung - min(rung_of(len(a), percent), rung_of(len(b), percent)) <= 1
                assert len(np.intersect1d(part_keys(a, rung, percent), part_keys(b, rung, percent)))


def test_unrelated_texts_that_share_shingles_meet_in_no_cell(spark):
    """Long texts of common phrases share shingles of any prefix, but no whole part."""
    draw = random.Random(4)
    phrases = [" ".join(f"p{i}x{k}" for k in range(6)) for i in range(200)]
    values = [" ".join(draw.choice(phrases) for _ in range(60)) for _ in range(120)]
    cells = jaccard._parts(spark.createDataFrame([(v,) for v in values], "text string"), 90, 3)
    assert cells.count() < len(values)


def test_cells_of_equal_members_are_one(spark):
    draw = random.Random(7)
    docs = spark.createDataFrame([(v,) for v in family(draw, 2, 3000, 2)], "text string")
    parts = jaccard._parts(docs, 90, 3)
    nodes = parts.select("key", F.col("c1").alias("node"), F.col("c1").alias("root"), F.lit(2998).alias("size"), F.lit(1).alias("rest"), "home")
    assert nodes.select("key").distinct().count() > 100
    assert jaccard._blocks(nodes, 1 << 19).count() == 2
