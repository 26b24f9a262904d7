import random

import numpy as np
import pytest

from earshot.llm.token_counts import RULES, VOCABULARY, attribute, encoder, token_counts

from llm_helpers import ODD_TEXTS, odd_docs, texts


def brute(sizes, ends, rule):
    """Allocate byte by byte."""
    counts, at = [0] * len(ends), 0
    for size in sizes:
        owners = [next(i for i, e in enumerate(ends) if b < e) for b in range(at, at + size)]
        owner = {"first": owners[0], "last": owners[-1], "most": max(sorted(set(owners)), key=owners.count)}[rule]
        counts[owner] += 1
        at += size
    return counts


@pytest.mark.parametrize("rule", RULES)
def test_attribution_equals_byte_counting(rule):
    rng = random.Random(1)
    for _ in range(100):
        sizes = [rng.randint(1, 6) for _ in range(rng.randint(1, 12))]
        cuts = sorted({sum(sizes), *(rng.randint(0, sum(sizes)) for _ in range(4))})
        found, _ = attribute(np.array(sizes), np.array(cuts), rule)
        assert found.tolist() == brute(sizes, cuts, rule)


def test_lines_add_up_to_whole_texts(spark):
    encoding, sizes = encoder(open(VOCABULARY, "rb").read())
    values = ["First line.\n\n\n second, é😀\nthird", "no end", "\n", "", "a\n" * 3000]
    found = token_counts(texts(spark, values)).collect()
    for i, text in enumerate(values):
        own = sorted((r for r in found if r["doc_id"] == i), key=lambda r: r["section"])
        assert "".join(text[r["start"] : r["end"]] for r in own) == text
        assert [r["section"] for r in own] == list(range(len(own)))
        tokens = encoding.encode_ordinary(text)
        ends = np.cumsum([len(text[r["start"] : r["end"]].encode()) for r in own]).tolist()
        if tokens and len(text) < 100:
            assert [r["n_tokens"] for r in own] == brute(sizes[tokens].tolist(), ends, "most")
        assert sum(r["n_tokens"] for r in own) == len(tokens)


def test_fields_share_one_encoding(spark):
    docs = spark.createDataFrame([(1, "ab", "cd"), (2, None, "x"), (None, "", None)], "doc_id long, a string, b string")
    found = sorted(map(tuple, token_counts(docs, ("a", "b"), split_lines=False).collect()), key=str)
    assert [(r[0], r[1], r[3], r[4]) for r in found] == [(1, "a", 0, 3), (1, "b", 3, 5), (2, "a", 0, 1), (2, "b", 1, 2), (None, "a", 0, 1), (None, "b", 1, 1)]


def test_odd_rows(spark):
    found = token_counts(odd_docs(spark)).collect()
    assert len(found) == len(ODD_TEXTS) + 4 + 1  # one text has two lines
    assert token_counts(odd_docs(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        token_counts(odd_docs(spark), rule="half")
