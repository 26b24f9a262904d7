import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from earshot.llm import pieces as P

from llm_helpers import ODD_TEXTS, odd_docs, texts


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


@pytest.fixture(scope="module")
def values():
    rng = random.Random(1)
    odd = ["", " ", "  a  b\n c é\t😀 ", "\n\n\n", "x" * 5000, "ab " * 3 + "   ", "a" * 70 + " b" * 10, "é" * 63, "é" * 62]
    return odd + ["".join(rng.choice("aben thro   \n.,é😀梦1") for _ in range(rng.randint(0, 90))) for _ in range(300)]


def test_units_are_the_text_in_parts(monkeypatch, values):
    whole = [list(P.units(v)) for v in values]
    assert all("".join(u) == (P.MARK + v.replace(" ", P.MARK) if v else "") for u, v in zip(whole, values, strict=True))
    monkeypatch.setattr(P, "SLAB", 3)
    assert [list(P.units(v)) for v in values] == whole


def test_merging_in_place_equals_the_library(library, values):
    model = P.load()
    for value in values:
        assert [i for u in P.units(value) for i in P.merge_unit(model, u)] == library.encode(value)


def test_encoding_equals_the_library_and_decodes(spark, library, values):
    found = P.encode(texts(spark, values), decoded=True).collect()
    assert sorted(map(str, found)) == sorted(map(str, P.decode(P.encode(texts(spark, values))).collect()))
    for row in found:
        assert row["ids"] == library.encode(values[row["doc_id"]])
        assert row["decoded"] == values[row["doc_id"]] and row["n_pieces"] == len(row["ids"])


def test_dictionary_in_many_pieces(spark, library, values, monkeypatch):
    model, folder = P.load(), None
    folder = P.scratch_path(spark, "pieces-test")
    P._dictionary(texts(spark, values), model, folder, 3)
    dictionary = P.Dictionary(folder, 3, model)
    words = sorted({u for v in values for u in P.units(v)})
    assert [ids.tolist() for ids in dictionary.encode(words)] == [P.merge_unit(model, w) for w in words]


def test_each_task_has_one_piece_of_the_dictionary_in_order(spark, values, monkeypatch):
    dealt, encode_words = [], P.encode_words
    monkeypatch.setattr(P, "encode_words", lambda words, model: dealt.append(words) or encode_words(words, model))
    P._dictionary(texts(spark, values), P.load(), P.scratch_path(spark, "pieces-test"), 3)
    rows = dealt[0].select(F.spark_partition_id().alias("task"), "piece_no", "word").collect()
    assert len({r["piece_no"] for r in rows}) == len({r["task"] for r in rows}) == len({(r["task"], r["piece_no"]) for r in rows}) == 8
    assert [tuple(r) for r in rows] == sorted(map(tuple, rows)) and len({r["word"] for r in rows}) == len(rows)


def cheapest(model, unit):
    best = [(0.0, 0, [])]
    for end in range(1, len(unit) + 1):
        ways = []
        for start in range(max(0, end - model.longest), end):
            piece = unit[start:end]
            if piece in model.ids:
                ways.append((best[start][0] - model.scores[piece], start, best[start][2] + [model.ids[piece]]))
            elif end - start == 1:
                ways.append((best[start][0] - (min(model.scores.values()) - 10), start, best[start][2] + P.spell(model, piece)))
        best.append(min(ways))
    return best[-1][2]


def test_the_cheapest_path_equals_brute_force(spark, values):
    model = P.load()
    words = sorted({u for v in values[10:50] for u in P.units(v) if len(u) <= P.LONGEST})
    rows = spark.createDataFrame([(0, w) for w in words], "piece_no long, word string")
    found = P.encode_words(rows, model, P.UNIGRAM).collect()
    assert len(found) == len(words)
    assert all(r["ids"] == cheapest(model, r["word"]) for r in found)


def test_odd_rows(spark):
    found = P.decode(P.encode(odd_docs(spark))).collect()
    assert len(found) == len(ODD_TEXTS) + 4
    assert sorted(r["decoded"] for r in found if r["doc_id"] == 0) == [""]
    assert P.encode(odd_docs(spark).limit(0)).count() == 0


def test_arrays_of_lines_are_cut_as_units_are(monkeypatch, values):
    model = P.load()
    cutter, odd = P.Cutter(model), [None, *values, "▁a▁▁ b", "a ▁", "\x00 a"]
    want = [[p.replace(P.MARK, " ") for u in P.units(v or "") for p in model.parts(u)] for v in odd]
    for block in (P.BLOCK, 300):
        monkeypatch.setattr(P, "BLOCK", block)
        monkeypatch.setattr(P, "SLAB", 100)
        found = []
        for some, rows in P.blocks(pa.array(odd, pa.string()).slice(0), True):
            cut = [cutter(b) for b in some]
            own = [p for parts, _ in cut for p in parts.to_pylist()]
            n_parts = cut[0][1].tolist() if len(cut) == 1 else [len(own)]
            assert len(n_parts) == rows and sum(n_parts) == len(own)
            found += [own[sum(n_parts[:i]) : sum(n_parts[: i + 1])] for i in range(rows)]
        assert found == want


def test_parts_that_are_not_filed_are_encoded_on_the_spot(tmp_path, library, values):
    model = P.load()
    parts = sorted({p for v in values[10:] for u in P.units(v) for p in model.parts(u)})
    filed = pa.array([p.replace(P.MARK, " ") for p in parts[::2]])
    hashes = P._hashes(filed)
    order = np.argsort(hashes)
    ids = [P.merge_unit(model, parts[::2][i]) for i in order]
    wrong = next(i for i, found in enumerate(ids) if len(found) == 1)
    ids[wrong] = [ids[wrong][0] + 1]  # as if another part had the same hash
    for name, array in (("hash-0", hashes[order]), ("stop-0", np.cumsum([len(i) for i in ids], dtype=np.int64)), ("ids-0", np.concatenate(ids).astype(np.int32))):
        P.put(str(tmp_path), name, array)
    found = P.Dictionary(str(tmp_path), 0, model).encode(parts)
    assert [f.tolist() for f in found] == [P.merge_unit(model, p) for p in parts]


def test_the_fold_alone_equals_the_library(spark, library, values):
    model = P.load()
    bare = P.library(P.bare(P.MODEL))
    words = sorted({u for v in values for u in P.units(v) if len(u) <= P.LONGEST})
    rows = spark.createDataFrame([(0, w) for w in words], "piece_no long, word string")
    found = {r["word"]: r["ids"] for r in P.encode_words(rows, model).collect()}
    assert found == {w: bare.encode(w) for w in words}
