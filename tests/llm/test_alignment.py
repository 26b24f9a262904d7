import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm_helpers import odd_docs, texts
from pathlib import Path
from tokenizers import Tokenizer

from conftest import rows
from earshot.llm import alignment
from earshot.llm.alignment import BYTE_BPE, PIECES, Fragment, Tokenizers, align, compose, fragments, links, slabs, spell


@pytest.fixture(scope="module")
def vocab():
    return Tokenizers(Path(BYTE_BPE).read_bytes(), Path(PIECES).read_bytes())


def plain(vocab, values):
    """Token by token, with the library that the first file belongs to."""
    a_of = Tokenizer.from_file(BYTE_BPE)
    a_of.encode_special_tokens = True
    aligned, counts = [], Counter()
    for text in values:
        line = b" " + (text or "").encode()
        a = a_of.encode(line.decode(), add_special_tokens=False).ids
        b = vocab.sp.encode(text or "")
        spans = []
        for side, ids in ((vocab.a, a), (vocab.b, b)):
            ends = np.cumsum([len(side.spelled[i]) for i in ids]).tolist()
            spans.append(list(zip(ids, [0, *ends], ends)))
        fits = all(b"".join(side.spelled[i] for i in ids) == line for side, ids in ((vocab.a, a), (vocab.b, b)))
        if not text or not fits:
            spans = [[], []]
        pairs = [(i, j) for i, s, e in spans[0] for j, s2, e2 in spans[1] if max(s, s2) < min(e, e2)]
        counts.update(pairs)
        aligned.append((spans, pairs))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    for (a, b), pairs in aligned:
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        of = lambda spans, lo, hi: ",".join(str(i) for i, _, e in spans if lo < e <= hi)
        text = ";".join(f"{of(a, lo, hi)}|{of(b, lo, hi)}" for lo, hi in zip([0, *common], common))
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        yield len(a), len(b), len(common), len(pairs), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs), digest


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "", None, " ", "<|endoftext|> and <s> are plain", "mark ▁ inside",
    "don't  stop\n\n\tnow 12345 é😀中文", "x\x00y", "aaaa" * 30, "<0x41> [UNK]", "The quick brown fox" * 3, "the capital of the world " * 9,
]


@pytest.mark.parametrize("chunk", [16, 50, 1 << 16])
def test_equals_brute_force(spark, vocab, chunk):
    found = rows(align(texts(spark, TEXTS), chunk=chunk, fan=2))
    assert found == sorted(((i, *x) for i, x in enumerate(plain(vocab, TEXTS))), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_very_long_texts_cross_many_tasks(spark, vocab):
    words = "wind over water é中 anstattion 77 thehorse ".split()
    long = " ".join(words[i * i % 7 % len(words)] * (1 + i % 3) for i in range(900))
    values = [long, "x" * 3000, long + " ▁", "short one", long]
    found = rows(align(texts(spark, values), chunk=256, fan=4))
    whole = rows(align(texts(spark, values), chunk=1 << 20))
    assert found == whole and [r[1] > 0 for r in sorted(found)] == [True, True, False, True, True]


def test_slabs_are_encoded_as_in_the_whole_text(vocab):
    text = "one two, three  four it's five 6 seven é eight\nnine ten's 中文 eleven " * 20
    whole = vocab.encode([text])[0]
    parts = [vocab.encode([part[1:].decode()])[0] for _, part in slabs(b" " + text.encode(), 20)]
    assert len(parts) > 20 and vocab.separable
    assert all(np.array_equal(np.concatenate([p[i] for p in parts]), whole[i]) for i in (0, 1))


@given(st.lists(st.integers(1, 6), min_size=1, max_size=40), st.lists(st.integers(1, 6), min_size=1, max_size=40), st.integers(1, 12), st.randoms())
def test_composition_is_associative_and_loses_nothing(sizes_a, sizes_b, chunk, random):
    short = sizes_a if sum(sizes_a) < sum(sizes_b) else sizes_b
    if sum(sizes_a) != sum(sizes_b):
        short.append(abs(sum(sizes_a) - sum(sizes_b)))
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    a, b = np.arange(len(sizes_a), dtype=np.uint32), np.arange(len(sizes_b), dtype=np.uint32)
    parts, closed = [], {}
    for _, fragment, groups in fragments(a, b, ends_a, ends_b, 0, int(ends_a[-1]), chunk, True):
        parts.append(fragment)
        if groups:
            closed[groups[0]] = groups[1]
    while len(parts) > 1:
        at = random.randrange(len(parts) - 1)
        parts[at : at + 2], seam = [(both := compose(parts[at], parts[at + 1]))[0]], both[1]
        if seam:
            closed[seam[0]] = seam[1]
    assert parts[0].split and not len(parts[0].suffix[0]) and not len(parts[0].suffix[1])
    closed[0] = parts[0].prefix
    in_order = [closed[k] for k in sorted(closed)]
    assert np.array_equal(np.concatenate([g[0] for g in in_order]), a)
    assert np.array_equal(np.concatenate([g[1] for g in in_order]), b)
    empty = Fragment((a[:0], b[:0]), (a[:0], b[:0]), False, 0, True)
    assert compose(empty, parts[0])[0].prefix[0].tolist() == parts[0].prefix[0].tolist()


def test_odd_rows_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH", 64)
    docs = odd_docs(spark)
    found = rows(align(docs, chunk=512))
    assert len(found) == docs.count() and align(docs, chunk=512).columns[0] == "doc_id"
    assert [r[1:] for r in found if r[0] == 1] == [(0, 0, 0, 0, 0, 0, "")]
    assert rows(align(docs.limit(0))) == []


def test_links_and_groups_equal_plain_walks():
    vocab = Tokenizers(Path(BYTE_BPE).read_bytes(), Path(PIECES).read_bytes())
    encoded = [x for x in vocab.encode(["a", "née 😀 the\nend", "x" * 90, "one two  three ", " \t", "unbelievable, it's 3.14"]) if x[2]]
    a, b = (np.concatenate([x[i] for x in encoded]) for i in (0, 1))
    owners = [[t for t, token in enumerate(ids.tolist()) for _ in range(side.sizes[token])] for ids, side in ((a, vocab.a), (b, vocab.b))]
    pairs, ends, ends_a, ends_b = links(vocab, a, b)
    want = sorted(set(zip(*owners, strict=True)))
    assert pairs.tolist() == [int(b[j]) * len(vocab.a.sizes) + int(a[i]) for i, j in want]
    assert ends.tolist() == sorted({*ends_a.tolist(), *ends_b.tolist()})
    groups, common = spell(vocab, a, b, ends_a, ends_b)
    closed, text, start = sorted({*ends_a.tolist()} & {*ends_b.tolist()}), b"", 0
    for end in closed:
        inside = [[str(int(i)) for i, e in zip(ids, of, strict=True) if start < e <= end] for ids, of in ((a, ends_a), (b, ends_b))]
        text, start = text + "|".join(map(",".join, inside)).encode() + b";", end
    assert b"".join(groups) == text and common.tolist() == closed
    # The digits of an id stand ready with the sign behind them.
    assert vocab.a.last[12] == b"12|" and vocab.b.last[12] == b"12;" and vocab.b.inside[12] == b"12,"
    none = a[:0]
    assert [len(x) for x in links(vocab, none, none)] == [0] * 4 and spell(vocab, none, none, ends_a[:0], ends_b[:0])[0] == []
