import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import topk
from earshot.llm.queries import ORACLE, QUERIES
from earshot.llm.topk import exact_top_k, search_block


def brute(vectors, queries, k):
    out = set()
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randint(-4, 4) / 4 for _ in range(3)], None) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.25], 1) for i in range(300, 340)]  # one common vector
    odd = [(350, None, 1), (400, [1.0, None, 0.0], 1), (450, [float("nan"), 1.0, 1.0], 1), (500, [float("inf"), 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 1)]
    twice, other = [rows[0], rows[7]], [(550, [1.0, 2.0], 1), (551, [1.0, 1.0], 1), (600, [], 1), (601, [], 1)]
    vectors = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows + other}
    found = exact_top_k(frame(spark, rows + odd + twice + other), F.col("vec_id") % 50 == 0)
    queries = [i for i in vectors if i % 50 == 0]
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()} == brute(vectors, queries, 5)


@pytest.mark.parametrize("steep", [0.0, 0.85, 2.0])
def test_pruning_keeps_every_candidate(monkeypatch, steep):
    """By coordinates, by length, and mixed, over buckets of different lengths."""
    monkeypatch.setattr(topk, "STEEP", steep)
    rng = np.random.default_rng(4)
    centre = rng.integers(-200, 200, 8)
    vectors = (centre + rng.integers(-30, 30, (400, 8))) * rng.integers(1, 4, (400, 1))
    vectors = vectors[np.argsort(-np.linalg.norm(vectors, axis=1))]
    ids = np.arange(400)
    products = vectors @ vectors.T
    np.fill_diagonal(products, -(2**60))
    least = np.sort(products, axis=1)[:, -5].astype(float)
    found = {q: list(zip(i.tolist(), s.tolist(), strict=True)) for q, i, s in search_block(ids, vectors, least, ids, vectors, 5)}
    for q in range(400):
        order = np.lexsort((ids, -products[q]))[:5]
        assert found[q] == list(zip(order.tolist(), products[q][order].tolist(), strict=True))


def test_few_candidates_and_empty_tables(spark):
    two = frame(spark, [(0, [1.0, 2.0], 0), (1, [3.0, 1.0], 0)])
    assert [tuple(r) for r in exact_top_k(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 5 * 65536)]
    assert exact_top_k(two, F.lit(None).cast("boolean")).count() == 0
    assert exact_top_k(two.limit(0), F.lit(True)).count() == 0


def test_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
        want = db.execute(ORACLE["op5_exact_top_k"]).fetchall()
    found = QUERIES["op5_exact_top_k"](spark, sf).select("query_id", "rank", "vec_id", "score").collect()
    assert {tuple(r) for r in found} == set(want)


def test_other_vectors_of_an_id_are_candidates(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [0.5, 3.0], 0), (1, [0.5, 3.0], 0), (2, [0.75, 0.0], 0)]
    found = exact_top_k(frame(spark, rows), F.col("vec_id") == 0)
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(1, 1, 65536), (2, 2, 49152), (3, 1, 32768)]
