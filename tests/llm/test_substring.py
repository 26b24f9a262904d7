import random

from earshot.llm.queries import QUERIES
from earshot.llm.substring import substring_dedup, units

from llm_helpers import ODD_TEXTS, odd_docs, texts


def brute(values, min_words=5):
    """The spans to remove, by the place that comes first."""
    first, out = {}, {}
    for i, text in enumerate(values):
        for a, _, digest in units(text or "", min_words):
            first.setdefault(digest, (i, a))
    for i, text in enumerate(values):
        gone = {(a, b, first[d][0]) for a, b, d in units(text or "", min_words) if first[d] != (i, a)}
        out[i] = sorted(g for g in gone if not any(o[:2] != g[:2] and o[0] <= g[0] and g[1] <= o[1] for o in gone))
    return out


def test_units():
    text = "One two three four five. Six seven eight nine ten!\nshort line\nONE  two three four five."
    spans = [text[a:b] for a, b, _ in units(text, 5)]
    assert spans == [text.split("\n")[0], "One two three four five.", " Six seven eight nine ten!", "ONE  two three four five."]
    digests = [d for _, _, d in units(text, 5)]
    assert digests[1] == digests[3] and len(set(digests)) == 3


def test_equals_brute_force(spark):
    rng = random.Random(2)
    pool = [" ".join(rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(rng.randint(2, 9))) + "." for _ in range(60)]
    values = ["\n".join(" ".join(rng.choice(pool) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 5))) for _ in range(80)]
    want = brute(values)
    for row in substring_dedup(texts(spark, values)).collect():
        got = sorted((r["start"], r["end"], r["kept_in"]) for r in row["removed"])
        assert got == want[row["doc_id"]]
        assert row["n_removed"] == len(got)
        kept = values[row["doc_id"]]
        for a, b, _ in reversed(got):
            kept = kept[:a] + kept[b:]
        assert row["text"].replace("\n", "") == kept.replace("\n", "")


def test_a_repeated_passage_goes_but_once(spark):
    passage = " ".join(f"word{i}" for i in range(60)) + "."
    values = [f"First own words of this text.\n{passage}", f"Other words come before it here. {passage}", passage, "Clean text of its own, left alone."]
    found = {r["doc_id"]: r["text"] for r in substring_dedup(texts(spark, values)).collect()}
    assert found == {0: values[0], 1: "Other words come before it here.", 2: "", 3: values[3]}


def test_odd_rows(spark):
    found = substring_dedup(odd_docs(spark)).collect()
    assert len(found) == len(ODD_TEXTS) + 4
    assert [r["text"] for r in found if r["doc_id"] == 0] == [None]
    line = ODD_TEXTS[4]
    assert {(r["doc_id"], r["text"]) for r in found if r["doc_id"] in (4,) or (r["doc_id"] is None and r["n_removed"])} == {(4, line), (None, "")}
    assert substring_dedup(odd_docs(spark).limit(0)).count() == 0


def test_the_query_removes_short_lines_and_text_without_blanks(spark, folder):
    page = "今天天气很好我们去公园。明天下雨我们都在家里看书。"
    values = ["All rights reserved.\nown", "Other.\nall rights  reserved.", "a\nb\nc", "a\nb\nc", page, page, f"新的一页写在这里没有重复的。{page[:12]}", "\n \n\n"]
    texts(spark, values).write.parquet(f"{folder}/documents.parquet")
    found = {r["doc_id"]: r["text"] for r in QUERIES["op1_substring_dedup"](spark, folder).collect()}
    want = {1: "Other.\n", 3: "", 5: "", 6: values[6][:-12]}
    assert found == {i: want.get(i, v) for i, v in enumerate(values)}
