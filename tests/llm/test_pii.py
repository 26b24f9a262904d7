import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from earshot.llm import pii
from earshot.llm.pii import DISCLOSURE, MIN_LETTERS, MIN_SUPPORT, REACH, find_pii, pii_digest, sanitise

from llm_helpers import odd_docs, texts

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base(text):
    found = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text):
            value, digits = match.group(), re.sub("[^0-9]", "", match.group())
            if kind == "ip" and any(int(p) > 255 for p in value.split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, match.start(), match.end(), value))
    return found


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(3)
    values = ["".join(rng.choice("a.@-_1 +5(9)é4😀%") for _ in range(rng.randint(0, 60))) for _ in range(800)]
    values += ["".join(rng.choice("0123456789- .") for _ in range(rng.randint(10, 40))) for _ in range(800)]
    values += ["4111 1111 1111 1111", "x@y.z_d@e.f.g", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.0255", "0004.1.1.1", "+1 (650) 253-0000 x", "9" * 4000, "1." * 2000, "a@b" + ".c" * 4000, ""]
    for row in pii_digest(find_pii(texts(spark, values))).collect():
        want = base(values[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(told(want).encode()).hexdigest()
        assert row["spans"].startswith(told(want))
        kinds = Counter(k for k, *_ in want)
        assert [row[f"n_{k}"] for k in PLAIN] == [kinds[k] for k in PLAIN]


def brute_terms(values):
    """Disclosing terms by counting sets of documents; texts of one line with short sides."""
    words = lambda t: [w for w in re.split(r"[^a-z]+", t.lower()) if len(w) >= MIN_LETTERS]
    holds, near, has = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, text in enumerate(values):
        for word in words(text):
            has[word].add(i)
        for kind, start, end, value in base(text):
            entity = kind, value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value)
            holds[entity].add(i)
            for word in words(text[:start])[-REACH:] + words(text[end:])[:REACH]:
                near[entity, word].add(i)
    n = len(values)
    return {
        word
        for (entity, word), docs in near.items()
        if len(docs) >= MIN_SUPPORT
        and len(holds[entity]) < n
        and math.log(n * len(docs) / (len(holds[entity]) * len(has[word]))) >= DISCLOSURE * math.log(n / len(holds[entity])) - 1e-12
    }


def test_terms_equal_brute_force(spark):
    rng = random.Random(9)
    common = ["river", "stone", "cloud", "green", "table", "light"]
    values = []
    for i in range(60):
        line = [rng.choice(common) for _ in range(8)]
        if i % 3 == 0:
            person = i % 4
            line[4:4] = [f"Codename{'abcd'[person]}", f"user{person}@mail.example.org", rng.choice(common)]
        if i % 7 == 0:
            line.append("codenamea")
        values.append(" ".join(line))
    want = brute_terms(values)
    assert want and not want & set(common)
    for row in pii_digest(find_pii(texts(spark, values))).collect():
        text = values[row["doc_id"]]
        got = [text[int(a) : int(b)].lower() for k, a, b in (s.split(":") for s in row["spans"].split(",") if s) if k == "term"]
        assert got == [w.lower() for w in re.findall("[A-Za-z]+", re.sub(PLAIN["email"], lambda m: "0" * len(m.group()), text)) if w.lower() in want]


def test_sanitise_keeps_rows_and_columns(spark):
    docs = odd_docs(spark)
    clean = sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert sorted(map(str, clean.collect())) == sorted(map(str, docs.collect()))  # nothing to remove
    assert sanitise(docs.limit(0)).count() == 0 and find_pii(docs.limit(0)).count() == 0
    values = ["Mail joe@x.org, or 10.0.0.1 now", "call +1 650 253 0000 or (4111 1111 1111 1111)", "joe@x.org.1.2.3.4"]
    found = {r["doc_id"]: r["text"] for r in sanitise(texts(spark, values)).collect()}
    assert found == {0: "Mail [EMAIL], or [IP] now", 1: "call [PHONE] or ([CARD])", 2: "[EMAIL]"}


def test_no_python_on_the_main_path(spark):
    plan = find_pii(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Pandas" not in plan and "Python" not in plan


def test_terms_far_from_a_value_disclose_it(spark):
    filler = " ".join(["river stone cloud green table light"] * 12)
    letter = "Dear Lee, {} Written for joe@x.org, ann@y.org, Zacharias of the mill"
    values = [letter.format(filler), letter.format(filler).replace("ann@y.org, ", ""), *[f"{filler} Dear Written for of the mill {i}"for i in range(30)]]
    rows = {r["doc_id"]: r for r in find_pii(texts(spark, values)).collect()}
    for i in (0, 1):
        assert [values[i][s["start"] : s["end"]] for s in rows[i]["terms"]] == ["Lee", "Zacharias"]
    assert not any(rows[i]["terms"] for i in range(2, 32))


def test_common_candidates_are_counted_not_listed(spark, monkeypatch):
    """Words that stand near a value twice, and in all other texts, are written by no table once for each text."""
    filler = "river stone cloud green table light"
    values = [f"{filler} Zacharias joe@x.org"] * 2 + [f"{filler} {i}" for i in range(300)]
    plain, sizes = pii.settle, {}

    def counted(df, name, *rest):
        found = plain(df, name, *rest)
        sizes[name] = found.count()
        return found

    monkeypatch.setattr(pii, "settle", counted)
    docs = texts(spark, values).unionByName(texts(spark, values[:1]))  # a row repeated counts once
    for r in find_pii(docs).collect():
        assert [values[r["doc_id"]][s["start"] : s["end"]] for s in r["terms"]] == (["Zacharias"] if r["doc_id"] < 2 else [])
    assert max(n for name, n in sizes.items() if name != "base") < 100, sizes
