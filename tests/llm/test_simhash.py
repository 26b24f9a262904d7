import random

import pytest
import xxhash

from earshot.llm.simhash import fingerprint, hamming_links, keep_one_of_each, simhash_groups

from llm_helpers import ODD_TEXTS, odd_docs, texts


def plain_print(text, shingle=3):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    found = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def components(prints):
    """Smallest index reachable, over all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(i) for i in range(len(prints))]


def test_fingerprints_equal_the_plain_form():
    rng = random.Random(1)
    for _ in range(200):
        text = " ".join(rng.choice(["the", "OF", "é", "Ü", "x\x0by", "a\tb"]) for _ in range(rng.randint(0, 40)))
        assert fingerprint(text.encode()) == plain_print(text)


def test_long_texts_are_read_across_slabs():
    text = "ab cd " * 300_000 + "ef"
    assert fingerprint(text.encode()) == plain_print(text)


@pytest.mark.parametrize("cell_size", [1, 4, 256])
def test_links_connect_exactly_what_all_pairs_connect(spark, cell_size):
    """Crowds of close fingerprints and strangers; a small cell size sends crowds the other way."""
    rng = random.Random(cell_size)
    prints = {0}
    for _ in range(8):
        centre = rng.getrandbits(64)
        for _ in range(40):
            near = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                near ^= 1 << bit
            prints.add(near)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = hamming_links(spark.createDataFrame([(p,) for p in signed], "fp long"), cell_size).collect()
    place = {p: i for i, p in enumerate(signed)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in links:
        assert (u % (1 << 64) ^ v % (1 << 64)).bit_count() <= 3 or cell_size < 256
        x, y = sorted((find(place[u]), find(place[v])))
        root[y] = x
    assert [find(i) for i in range(len(prints))] == components(prints)


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randint(1, 60))) for _ in range(12)]
    values = base + [b + " tail" for b in base] + base[:4] + ["", " ", None]
    found = {r["doc_id"]: r for r in simhash_groups(texts(spark, values)).collect()}
    prints = [plain_print(v or "") for v in values]
    assert [int(found[i]["fingerprint"], 16) for i in range(len(values))] == prints
    assert [found[i]["component_id"] for i in range(len(values))] == components(prints)


def test_odd_rows(spark):
    found = simhash_groups(odd_docs(spark)).collect()
    assert len(found) == len(ODD_TEXTS) + 4
    blank = [r for r in found if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in blank} == {0} and len(blank) == 4
    assert simhash_groups(odd_docs(spark).limit(0)).count() == 0


def test_one_of_each_stays(spark):
    docs = odd_docs(spark)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    groups = simhash_groups(docs).select("fingerprint").distinct().count()  # only copies are linked here
    assert set(map(str, kept.collect())) <= set(map(str, docs.collect()))
    assert kept.count() == groups
    assert keep_one_of_each(docs.unionByName(docs)).count() == groups
    assert keep_one_of_each(docs.limit(0)).count() == 0
