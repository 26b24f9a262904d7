from collections import Counter

import numpy as np
import pyarrow as pa

from earshot.llm import common
from earshot.llm.common import portions, tidy
from earshot.llm.toxicity import (
    AIMED,
    DENIED,
    HELD,
    PLAIN,
    Grammar,
    Lexicon,
    Model,
    _scored,
    clause_scores,
    count_words,
    drop_toxic,
    learn_lexicon,
    measure,
    toxicity_scores,
)

from llm_helpers import ODD_TEXTS, odd_docs

SF = "/root/testdata/sf0.1"


def score(text, learnt=None):
    return sum(clause_scores(text, Lexicon(learnt or {}), Grammar()))


def test_context_changes_the_weight_of_a_clause():
    plain = score("such an idiot")
    assert plain == 3.0
    assert score("you idiot") == 1.5 * plain
    assert score("he is not an idiot") < plain < score("he is an idiot")
    assert score("the paper quoted him: idiot") == 0.5 * plain
    assert score("i will kill you") == 2 * score("the kill")
    assert score("not here. an idiot") == plain  # negation ends with its clause
    assert score("nothing of the kind") == 0


def test_composition_multiplies_its_parts():
    grammar, symbols = Grammar(), "YNOITWNTSOI"
    states, product = (0, 0, 0, 0), 1.0
    parts = list(grammar.parts)
    own = [0] * len(parts)
    for symbol in symbols:
        states, factor = grammar.step(states, symbol)
        want = 1.0
        for i, part in enumerate(parts):
            own[i], f = part.step(own[i], symbol)
            want *= f
        assert states == tuple(own) and factor == want
        product *= factor
    assert product > 0 and AIMED != DENIED


def test_learnt_words_and_stems(spark):
    toxic = [f"{a} gruntling{b} {c} vexor" for a, b, c in zip("abcdefgh", ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op"], "ijklmnop", strict=True)]
    toxic = [t.replace("vexor", f"{w} vexor") for t, w in zip(toxic, "qrstuvwx", strict=True)]
    rows = [(t, 1) for t in toxic] + [("common words of a clean text", 0)] * 40 + [("copied rarity", 1)] * 9
    learnt = learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert "vexor" in learnt and "gruntling*" in learnt
    assert "rarity" not in learnt  # nine copies are one context


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity_scores(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["toxic"] is not None]
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.97
    assert np.mean([r["predicted"] for r in held if r["toxic"]]) > 0.9
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 - r["predicted"] for r in rows)


def test_odd_rows_and_no_labels(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (4, 7)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        found = toxicity_scores(odd_docs(spark), known).collect()
        assert len(found) == len(ODD_TEXTS) + 4
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    docs = odd_docs(spark)
    assert drop_toxic(docs, labels).columns == docs.columns
    assert toxicity_scores(docs.limit(0), labels).count() == 0


def word(n):
    return "".join("abcdefghij"[int(d)] for d in str(n))


def test_words_are_counted_in_bounded_parts():
    rows = [(" ".join(word(n * 37 + i) for i in range(300)), n % 2) for n in range(3000)] + [(None, 1), ("", 0)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([t for t, _ in rows]), "label": pa.array([y for _, y in rows], pa.int32())})
    parts = list(count_words(iter([batch.slice(0, 1000), batch.slice(1000)])))
    assert len(parts) > 2 and max(p.num_rows for p in parts) < HELD + 2 * 300
    toxic, other, pairs = Counter(), Counter(), set()
    for part in parts:
        for r in part.to_pylist():
            toxic[r["word"]] += r["toxic"]
            other[r["word"]] += r["other"]
            pairs |= {(r["word"], r["before"])} if r["before"] is not None else set()
    want = [Counter(w for t, y in rows if y == label for w in set((t or "").split())) for label in (0, 1)]
    assert +other == want[0] and +toxic == want[1]
    assert len(pairs) == len({p for t, y in rows if y and t for p in zip(t.split(), ["", *t.split()[:-1]], strict=True)})


def test_texts_are_measured_in_portions():
    assert list(portions(pa.array(["ab", None, "cde", "f" * 9, "", "g"]), 5)) == [(0, 3), (3, 4), (4, 6)]
    assert list(portions(pa.array([], pa.string()))) == []
    texts = ["you idiot. " + "word " * 2000, None, "fine"] * 400
    row = pa.StructArray.from_arrays([pa.array(texts), pa.array(range(1200))], ["text", "n"])
    for batch, own in ((pa.RecordBatch.from_arrays([row], ["row"]), 0), (pa.RecordBatch.from_arrays([row, pa.array(texts)], ["row", "text"]), None)):
        parts = list(measure(iter([batch]), {}, own))
        assert len(parts) > 3 and max(p.nbytes for p in parts) < 2 << 20
        found = [r for p in parts for r in p.to_pylist()]
        assert [(r["row"]["text"], r["row"]["n"]) for r in found] == list(zip(texts, range(1200), strict=True))
        assert [r["tox"]["total"] for r in found] == [score(t or "") for t in texts]


def test_texts_come_back_only_where_they_are_kept(spark):
    docs = odd_docs(spark)
    model = Model({}, PLAIN)
    assert _scored(docs, model, "text", "doc_id").schema["row"].dataType.names == ["doc_id"]
    whole = _scored(docs, model, "text")
    assert whole.schema["row"].dataType == docs.schema
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "struct(" in plan and " AS text#" not in plan  # no second copy beside the row's
    assert whole.select("row.*").exceptAll(docs).count() == docs.exceptAll(whole.select("row.*")).count() == 0


def test_workers_give_freed_memory_back(monkeypatch):
    seen = []
    pool = type("Pool", (), {"release_unused": lambda self: seen.append("released")})
    monkeypatch.setattr(common.pa, "default_memory_pool", pool)
    assert list(tidy(lambda batches: (b + 1 for b in batches if not seen.append(b)))(iter([1, 2]))) == [2, 3]
    assert seen == [1, 2, "released"]
