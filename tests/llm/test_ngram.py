import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark import cloudpickle

from earshot.llm import ngram

from llm_helpers import ODD_TEXTS, odd_docs, texts


class Plain:
    """The model over dictionaries."""

    def __init__(self, tokens):
        self.words, self.pairs = Counter(), Counter()
        for text in tokens:
            self.words.update(text)
            self.pairs.update(zip([None, *text], text, strict=False))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.after = Counter(w for _, w in self.pairs)
        self.followers = defaultdict(list)
        for (v, _), c in self.pairs.items():
            self.followers[v].append(c)
        tally = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]
        self.high, self.low = ngram.discounts(tally(self.pairs.values())), ngram.discounts(tally(self.after.values()))

    def word(self, w):
        spare = sum(self.low[min(c, 3)] for c in self.after.values()) / len(self.pairs)
        c = self.after[w]
        return max(c - self.low[min(c, 3)], 0) / len(self.pairs) + spare / (self.v + 1)

    def chance(self, v, w):
        counts = self.followers.get(v)
        if not counts:
            return self.word(w)
        c = self.pairs[v, w]
        return (max(c - self.high[min(c, 3)], 0) + sum(self.high[min(x, 3)] for x in counts) * self.word(w)) / sum(counts)


def split(text):
    return [*text.encode().lower().split(), b"\n"]


def trains(i):
    return zlib.crc32(str(i).encode()) % 7 != 2


@pytest.mark.parametrize(("piece", "words"), [(1 << 22, 1 << 21), (50, 8)])
def test_scores_equal_the_plain_model(spark, monkeypatch, piece, words):
    """Whole tables, and tables cut into many pieces."""
    monkeypatch.setattr(ngram, "PIECE", piece)
    monkeypatch.setattr(ngram, "WORDS", words)
    monkeypatch.setattr(ngram, "CHUNK", 200)
    cloudpickle.register_pickle_by_value(ngram)
    rng = random.Random(8)
    weights = [1 / (i + 1) for i in range(120)]
    values = [" ".join(rng.choices([f"w{i}" for i in range(120)], weights, k=rng.randint(0, 30))) for _ in range(90)]
    try:
        found = ngram.language_model_scores(texts(spark, values)).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(ngram)
    plain = Plain([split(v) for i, v in enumerate(values) if trains(i)])
    for row in found:
        tokens = split(values[row["doc_id"]])
        assert row["held_out"] != trains(row["doc_id"])
        assert row["n_tokens"] == len(tokens) and row["train_tokens"] == plain.n
        assert row["n_known"] == sum(plain.words[t] > 0 for t in tokens)
        base = sum(math.log10((plain.words[t] + 1) / (plain.n + plain.v + 1)) for t in tokens)
        score = sum(math.log10(plain.chance(v, w)) for v, w in zip([None, *tokens], tokens, strict=False))
        assert row["base_score"] == pytest.approx(base, rel=1e-9) and row["score"] == pytest.approx(score, rel=1e-9)
    for context in (None, b"w0", b"w90", b"unseen"):
        total = sum(plain.chance(context, w) for w in plain.words) + plain.chance(context, b"unseen")
        assert total == pytest.approx(1)


def test_discounts():
    assert ngram.discounts([0, 1, 1, 1]).tolist() == [0, 0.5, 0.5, 0.5]
    d = ngram.discounts([100, 40, 20, 12])
    assert d[0] == 0 and np.all(np.diff(d) > 0)


def test_odd_rows(spark):
    found = ngram.language_model_scores(odd_docs(spark)).collect()
    assert len(found) == len(ODD_TEXTS) + 4
    assert {r["n_tokens"] for r in found if r["doc_id"] in (0, 1, 2)} == {1}
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in found)
    assert ngram.language_model_scores(odd_docs(spark).limit(0)).count() == 0
    held = texts(spark, ["a b"], next(i for i in range(100) if not trains(i)))
    assert [(r["train_tokens"], r["n_known"], r["score"]) for r in ngram.language_model_scores(held).collect()] == [(0, 0, 0.0)]
