import random
import re

import pytest

from earshot.llm import decontam
from earshot.llm.decontam import NAME, NUM, UNIT, Templates, contamination, decontaminate, template

from llm_helpers import odd_docs, texts

ITEM = "Yesterday Tom bought 2 apples and 4 pears at the market for Ann in 6 seconds flat."


def items(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "item_id long, text string")


def found(spark, docs, benchmark, **limits):
    rows = contamination(texts(spark, docs), items(spark, benchmark), **limits).collect()
    return {(r["doc_id"], r["item_id"]): r["share"] for r in rows}


def test_templates():
    assert [template(t, False) for t in ("7", "seven", "km", "%", "Tom", "TOM", "I", "tom")] == ["<num>", "<num>", "<unit>", "<unit>", "<name>", "tom", "i", "tom"]
    assert template("Tom", True) == "tom"
    read = Templates().read
    assert (read("He met Tom. Tom left")[2][:3] == read("He met Bill. Bill left")[2][:3]).all()


def test_reparameterised_items_need_consistent_slots(spark):
    docs = [
        ITEM,
        "Yesterday Bill bought 7 apples and 9 pears at the market for Sue in 30 hours flat.",
        "Yesterday Bill bought 7 apples and 7 pears at the market for Bill in 7 hours flat.",
        "Words before it. " + ITEM + " And words behind it.",
        ITEM.upper().replace(".", "!"),
        "Yesterday somebody bought apples, but not a single window of this text is that of the item.",
    ]
    assert found(spark, docs, [ITEM, "Go now", None, ""]).keys() == {(0, 0), (1, 0), (3, 0)}


def test_equals_plain_search_of_word_windows(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    sentence = lambda n: " ".join(word() for _ in range(n))
    benchmark = [sentence(rng.randint(8, 40)) for _ in range(30)]
    docs = [sentence(50) for _ in range(60)]
    want = set()
    for i in range(0, 60, 3):
        item = rng.randrange(30)
        words = benchmark[item].split()
        part = words if i % 2 else words[: max(8, len(words) // 3)]
        docs[i] = f"{docs[i]} {' '.join(part)} {sentence(5)}"
        total = max(1, len(words) - 7)
        if max(0, len(part) - 7) / total >= 0.5:
            want.add((i, item))
    assert found(spark, docs, benchmark).keys() == want


def test_short_items_are_searched_whole(spark):
    assert found(spark, ["they go now away", "go away now"], ["go now"]) == {(0, 0): 1.0}


def test_decontaminate_keeps_clean_rows(spark):
    docs = odd_docs(spark)
    benchmark = items(spark, ["one two three four five six seven", None]).unionByName(spark.createDataFrame([(None, "one")], "item_id long, text string"))
    clean = decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    held = [r for r in docs.collect() if re.search(r"\bone\b", r["text"] or "")]
    assert len(held) > 2
    assert clean.count() == docs.count() - len(held)
    assert set(map(str, clean.collect())) <= set(map(str, docs.collect()))
    assert decontaminate(docs, benchmark.limit(0)).count() == docs.count()
    assert decontaminate(docs.limit(0), benchmark).count() == 0
    doubled = docs.unionByName(docs)
    assert decontaminate(doubled, benchmark).count() == 2 * clean.count()


def test_names_that_open_sentences_and_runs_are_slots(spark):
    benchmark = [
        "Tom has 5 apples. Tom gives 2 to Mary. Tom then buys 7 more. How many apples does Tom have now?",
        "Natalia sold 48 clips in April. Natalia sold half as many clips in May. How many clips were sold?",
        "In the summer twenty five people met Mary Jane Smith in New York for 3 days and left.",
    ]
    docs = [
        "Ann has 6 apples. Ann gives 3 to Paul. Ann then buys 9 more. How many apples does Ann have now?",
        "Peter sold 12 clips in June. Peter sold half as many clips in July. How many clips were sold?",
        "In the summer 7 people met Tom in Paris for thirty two days and left.",
        "Ann has 6 apples. Paul gives 6 to Ann. Mary then buys 6 more. How many apples does Paul have now?",
        "Words of their own. So many apples are here that nobody counts them, and clips are sold elsewhere.",
    ]
    assert found(spark, docs, benchmark) == {(0, 0): 1.0, (1, 1): 1.0, (2, 2): 1.0}


def test_one_edit_does_not_void_an_item(spark):
    words = [f"word{'abcdefghijklmnopqrst'[i]}" for i in range(20)]
    docs = [" ".join(words[:9] + middle + words[10:]) for middle in (["other"], [], [words[9], "more"])]
    docs += [" ".join(words[:10]), " ".join(words[:8] + ["other"] * 4 + words[12:])]
    assert found(spark, docs, [" ".join(words)]) == {(0, 0): 1.0, (1, 0): 1.0, (2, 0): 1.0}


def test_all_texts_of_an_id_are_searched(spark):
    words = ["these are the words of one question in the suite", "another suite asks for other things in its own way"]
    benchmark = spark.createDataFrame([(0, words[0]), (0, words[1]), (0, words[1])], "item_id long, text string")
    rows = contamination(texts(spark, [f"so {w} again" for w in words] + ["none of it"]), benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["share"]) for r in rows) == [(0, 0, 1.0), (1, 0, 1.0)]


TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,:/]\d+)*|[.!?\n]|[%$€£°]")


@pytest.mark.parametrize("together", [7, 60, 1 << 16])
def test_scan_equals_token_by_token(monkeypatch, together):
    monkeypatch.setattr(decontam, "TOGETHER", together)
    rng = random.Random(3)
    parts = ["Tom", "O'Brien", "don't", "TOM", "I", "Élan", "日本", "ǅa", "²x", "ΣΑΣ", "İl", "1.2", "3,4:5/6", "7.", "km", "Seven", "$", "°", " ", "  ", "\n", ".", "!", "'", ".-", "_", "x" * 70]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", " ", ""]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    fixed = {int(h): n for h, n in ((decontam.NUM_HASH, NUM), (decontam.NAME_HASH, NAME), (decontam.UNIT_HASH, UNIT))}
    names: dict[int, str] = {}
    for text, (tokens, kept, hashes, named, words) in zip(texts, Templates().read_all(texts), strict=True):
        found = TOKEN.findall(text)
        assert [tokens[i] for i in range(len(tokens))] == [t.lower() for t in found]
        assert kept.tolist() == [i for i, t in enumerate(found) if t not in ".!?\n"]
        for i, h, n, w in zip(kept.tolist(), hashes.tolist(), named.tolist(), words.tolist(), strict=True):
            opening = i == 0 or found[i - 1] in ".!?\n"
            for got, want in ((h, template(found[i], opening)), (n, template(found[i], False))):
                assert fixed.get(got) == want if want in fixed.values() else names.setdefault(got, want).casefold() == want.casefold()
            assert fixed.get(w) is None


def test_every_copy_is_found(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    kinds = [word, lambda: word().title(), lambda: str(rng.randint(0, 99)), lambda: "km"]
    benchmark = [
        "3 5 8 13 21 34 55 89 144 233",
        "Sort these numbers: 9 4 7 1 8 3 6 2 5 12 44 31 27 18",
        "London bridge fell in 1831",
        "What year did Rome fall?",
        "The capital of France is Paris.",
    ]
    for n in [*range(1, 41), *range(1, 41)]:
        weights = rng.choice([(6, 1, 1, 1), (1, 1, 1, 1), (0, 1, 0, 0), (0, 0, 1, 0), (1, 0, 4, 0)])
        benchmark.append(" ".join(rng.choices(kinds, weights)[0]() + rng.choice(["", "", "", ".", ","]) for _ in range(n)))
    frames = ["{}", "we saw here that {} and more of it", "Words before it. {}", "so he said: {}\nThe end."]
    docs = [f.format(text) for text in benchmark for f in frames]
    hits = found(spark, docs, benchmark)
    assert [(d, docs[d]) for d in range(len(docs)) if (d, d // len(frames)) not in hits] == []


def test_other_texts_of_a_short_shape_are_left(spark):
    benchmark = ["who is Tom", "it has 12 legs", "the year 1831", "42"]
    docs = ["we ask who is Mary", "so it has 8 legs", "in the year 1900", "there are 41 of them"]
    assert found(spark, docs, benchmark) == {}


def test_tables_of_numbers_meet_by_their_values(spark):
    rng = random.Random(2)
    item = " ".join(str(rng.randint(0, 999)) for _ in range(60))
    table = " ".join(str(rng.randint(0, 999)) for _ in range(3000))
    assert found(spark, [table, f"{table} {item} {table}", f"Numbers: {item}"], [item]).keys() == {(1, 0), (2, 0)}


def test_items_with_null_ids_are_searched(spark):
    benchmark = spark.createDataFrame([(None, "these are the words of one question"), (None, "and these of yet another"), (None, None)], "item_id long, text string")
    docs = texts(spark, ["so these are the words of one question", "and these of yet another", "none of it"])
    assert sorted((r["doc_id"], r["item_id"]) for r in contamination(docs, benchmark).collect()) == [(0, None), (1, None)]
    assert decontaminate(docs, benchmark).count() == 1


def test_very_long_texts(spark):
    docs = ["word " * 400_000 + ITEM + " word" * 400_000, "word" * 300_000]
    assert found(spark, docs, [ITEM]).keys() == {(0, 0)}
