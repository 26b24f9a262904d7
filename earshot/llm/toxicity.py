"""Toxicity by a weighted finite-state grammar over clauses, with a lexicon learnt from labels."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from earshot.llm.common import fold, portions, settle, sift, tidy

# Seed words of the grammar's classes in English, German, French and Spanish.
INSULTS = """
idiot idiots moron morons stupid dumb loser losers pathetic worthless scum trash clown jerk fool
imbecile disgusting filthy vermin idioten dumm dummkopf trottel abschaum versager widerlich
crétin imbécile débile minable ordure raclure dégoûtant estúpido estúpida imbécil basura escoria
asqueroso payaso perdedor
""".split()
VIOLENCE = """
kill hurt destroy punish beat stab shoot töten umbringen verprügeln vernichten tuer frapper
détruire matar golpear destruir
""".split()
INTENT = "will shall gonna going werde werden vais va voy vamos".split()
TARGETS = """
you your yours u they them he she him her we people all everyone du dich dir ihr euch sie alle tu te
toi vous ils elles eux tous tú vosotros ustedes ellos ellas todos
""".split()
NEGATION = "not no never isn't aren't don't nicht kein keine nie ne pas jamais aucun ninguno nunca".split()
REPORTING = """
said says claimed claims called wrote reported quoted alleged sagte sagt behauptet schrieb nannte
dit disait écrit prétend dijo dice escribió afirma llamó
""".split()

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]")
STOPS = frozenset(".!?;\n")
#: Shortest and longest learnt stem.
STEM = (3, 10)
#: Support a learnt word or stem needs in toxic texts, and its least log ratio; forms of a stem.
MIN_SUPPORT, MIN_WEIGHT, MIN_FORMS = 5, 3.0, 5
#: Different texts of each label, at most, from which the last step's weights are fitted.
FIT_ROWS = 20_000
#: Words and pairs of words that a task counts before it passes them on.
HELD = 1 << 17
#: Score from which a text counts as toxic.
THRESHOLD = 0.3
#: Weight of a seed insult or threat that the labels say nothing about.
SEED_WEIGHT = 3.0

INSULT, THREAT, WILL, TARGET, NOT, SAID, OTHER = "ITWYNSO"


@dataclass(frozen=True)
class Transducer:
    """Reads class symbols and multiplies weights: arcs map (state, symbol) to (state, factor).

    Where no arc fits, the symbol ``*`` is tried; failing that the state stays, with factor one.
    """

    arcs: dict[tuple[int, str], tuple[int, float]]

    def step(self, state: int, symbol: str) -> tuple[int, float]:
        return self.arcs.get((state, symbol)) or self.arcs.get((state, "*")) or (state, 1.0)


def _within(trigger: str, events: str, factor: float, reach: int) -> Transducer:
    """Scales ``events`` by ``factor`` up to ``reach`` symbols after ``trigger``."""
    arcs: dict[tuple[int, str], tuple[int, float]] = {(0, trigger): (1, 1.0)}
    for state in range(1, reach + 1):
        following = state + 1 if state < reach else 0
        arcs[state, "*"] = (following, 1.0)
        arcs[state, trigger] = (1, 1.0)
        for event in events:
            arcs[state, event] = (following, factor)
    return Transducer(arcs)


def _behind(part: Transducer, verb: str, object_: str) -> Transducer:
    """``part`` starting anew at ``verb``, which takes the ``object_`` directly behind it for its own."""
    states = {s for s, _ in part.arcs} | {s for s, _ in part.arcs.values()}
    own = max(states) + 1
    arcs = part.arcs | {(s, verb): (own, 1.0) for s in [*states, own]}
    return Transducer(arcs | {(own, object_): (0, 1.0), (own, "*"): (0, 1.0)})


#: The parts of the grammar. An insult or threat counts more with a target or an intent shortly
#: before it (whom a reporting verb is about is no target), less when it is negated, and less for the rest
#: of a clause after a reporting verb.
AIMED = _behind(_within(TARGET, INSULT + THREAT, 1.5, 4), SAID, TARGET)
MEANT = _within(WILL, THREAT, 2.0, 3)
DENIED = _within(NOT, INSULT + THREAT, 0.3, 3)
REPORTED = Transducer({(0, SAID): (1, 1.0), (1, INSULT): (1, 0.5), (1, THREAT): (1, 0.5)})


@dataclass
class Grammar:
    """The composition of the parts: one automaton over their joint states, built as needed."""

    parts: tuple[Transducer, ...] = (AIMED, MEANT, DENIED, REPORTED)
    arcs: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], float]] = field(default_factory=dict)

    def step(self, state: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], float]:
        known = self.arcs.get((state, symbol))
        if known is None:
            moves = [part.step(s, symbol) for part, s in zip(self.parts, state, strict=True)]
            known = tuple(s for s, _ in moves), math.prod(f for _, f in moves)
            self.arcs[state, symbol] = known
        return known

    def score(self, clause: Iterable[tuple[str, float]]) -> float:
        """Sum over a clause's insults and threats of their weights, scaled by the context."""
        state, total = (0,) * len(self.parts), 0.0
        for symbol, weight in clause:
            state, factor = self.step(state, symbol)
            total += weight * factor
        return total


class Lexicon:
    """The first transducer: words to class symbols and weights, by whole word or by stem."""

    def __init__(self, learnt: dict[str, float]):
        self.words = {
            w: (symbol, 0.0)
            for symbol, members in ((WILL, INTENT), (TARGET, TARGETS), (NOT, NEGATION), (SAID, REPORTING))
            for w in members
        }
        for symbol, members in ((THREAT, VIOLENCE), (INSULT, INSULTS)):
            self.words |= {w: (symbol, learnt.get(w, SEED_WEIGHT)) for w in members}
        self.words |= {w: (INSULT, x) for w, x in learnt.items() if not w.endswith("*") and w not in self.words}
        self.stems = {w[:-1]: (INSULT, x) for w, x in learnt.items() if w.endswith("*")}
        self.sizes = sorted({len(stem) for stem in self.stems})
        self.loud = {w for w, (symbol, x) in self.words.items() if x}

    def read(self, word: str) -> tuple[str, float]:
        known = self.words.get(word)
        if known is None:
            for size in self.sizes:
                if found := self.stems.get(word[:size]):
                    return found
        return known or (OTHER, 0.0)

    def triggers(self, words: set[str]) -> set[str]:
        """The words of a text that carry a weight."""
        found = words & self.loud
        for size in self.sizes:
            stems = self.stems.keys() & {w[:size] for w in words}
            if stems:
                found |= {w for w in words if w[:size] in stems and self.read(w)[1]}
        return found


def clause_scores(text: str, lexicon: Lexicon, grammar: Grammar) -> list[float]:
    """Scores of the clauses of a whole text that hold an insult or a threat.

    Clauses end at ``. ! ? ;`` and line feeds. Clauses without a trigger can't score.
    """
    lowered = text.lower()
    triggers = lexicon.triggers(set(TOKEN.findall(lowered)))
    if not triggers:
        return []
    scores, clause, hot = [], [], False
    for token in [*TOKEN.findall(lowered), "\n"]:
        if token not in STOPS:
            clause.append(token)
            hot = hot or token in triggers
            continue
        if hot:
            scores.append(grammar.score(map(lexicon.read, clause)))
        clause, hot = [], False
    return scores


def _labelled(docs: DataFrame, labels: DataFrame, column: str, parts: int, held: int) -> DataFrame:
    """(text, label) of the training rows; of contradicting labels the largest counts."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", parts) != held))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    training = docs.filter(F.col("doc_id").isNotNull() & (fold("doc_id", parts) != held))
    return sift(training, known, "doc_id", 1 << 20).join(known, "doc_id").select("text", "label")


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of (text, label) by label, and the pairs of words in toxic texts, about HELD rows at a time."""

    def counted() -> pa.RecordBatch:
        other, toxic = texts
        return pa.RecordBatch.from_pydict(
            {
                "word": pa.array([*(w for w, _ in pairs), *toxic, *other], pa.string()),
                "before": pa.array([*(b for _, b in pairs), *[None] * (len(toxic) + len(other))], pa.int64()),
                "toxic": pa.array([*[0] * len(pairs), *toxic.values(), *[0] * len(other)], pa.int64()),
                "other": pa.array([*[0] * (len(pairs) + len(toxic)), *other.values()], pa.int64()),
            }
        )

    pairs: set[tuple[str, int]] = set()
    texts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            words = [w for w in TOKEN.findall((text.as_py() or "").lower()) if w not in STOPS]
            texts[label].update(set(words))
            if label:
                before = ["", *words]  # a text may have no words
                pairs.update((w, xxhash.xxh32_intdigest(b)) for w, b in zip(words, before, strict=False))
            if len(pairs) + sum(map(len, texts)) >= HELD:
                yield counted()
                pairs, texts = set(), (Counter(), Counter())
    yield counted()


def learn_lexicon(training: DataFrame, support: int = MIN_SUPPORT, least: float = MIN_WEIGHT) -> dict[str, float]:
    """Words and stems (with a final ``*``) that mark toxic texts, with their log ratios.

    A word's support is the number of toxic texts with it or, if less, of different words it follows
    in them, so that copies of one text count once; it is set against the number of other texts
    with the word. Stems of STEM letters add up their forms, of which they need MIN_FORMS and none
    may give half of the support. Of nested stems the shortest is taken, then lengthened as long as
    nine tenths of its support remain; a word under it that is known well enough keeps its own
    weight, be it zero. All labelled training rows are
    counted; only what passes the thresholds reaches the driver.
    """
    seen = training.select("text", "label").mapInArrow(tidy(count_words), "word string, before long, toxic long, other long")
    n_toxic, n_other = training.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    if not n_toxic or not n_other:
        return {}
    counts = (
        seen.groupBy("word", "before")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .groupBy("word")
        .agg(F.least(F.count("before"), F.sum("toxic")).alias("toxic"), F.sum("other").alias("other"))
    )
    counts = settle(counts, "words")
    ratio = F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("other") + 0.5) / F.lit(n_other + 1.0))
    strong = (F.col("toxic") >= support) & (ratio >= least)
    learnt = {r["word"]: r["w"] for r in counts.filter(strong).select("word", ratio.alias("w")).collect()}
    cuts = F.sequence(F.lit(STEM[0]), F.least(F.lit(STEM[1]), F.length("word")))
    cut = counts.filter(F.length("word") >= STEM[0]).select(
        F.explode(F.transform(cuts, lambda n: F.substr(F.col("word"), F.lit(1), n))).alias("stem"), "word", "toxic", "other"
    )
    stems = (
        cut.groupBy("stem")
        .agg(
            F.sum("toxic").alias("toxic"),
            F.sum("other").alias("other"),
            F.count_if(F.col("toxic") > 0).alias("forms"),
            F.max("toxic").alias("most"),
        )
        .filter(strong & (F.col("forms") >= MIN_FORMS) & (2 * F.col("most") < F.col("toxic")))
        .select("stem", "toxic", ratio.alias("w"))
    )
    kept: dict[str, float] = {}
    found = {r["stem"]: (r["toxic"], r["w"]) for r in stems.collect()}
    short: set[str] = set()
    for stem in sorted(found, key=lambda x: (len(x), x)):
        if any(stem[:n] in short for n in range(STEM[0], len(stem))):
            continue
        short.add(stem)
        longer = [x for x in found if x.startswith(stem) and found[x][0] >= 0.9 * found[stem][0]]
        best = max(longer, key=lambda x: (len(x), x))
        kept[best] = found[best][1]
    if kept:
        own = cut.filter(F.col("stem").isin(*kept) & (F.col("toxic") + F.col("other") >= support))
        known = own.select("word", F.greatest(ratio, F.lit(0.0)).alias("w")).collect()
        learnt = {r["word"]: r["w"] for r in known} | learnt
    return learnt | {f"{stem}*": w for stem, w in kept.items()}


def _sample(training: DataFrame) -> DataFrame:
    """The rows of FIT_ROWS different texts of each label, those with the smallest hash of the text.

    Only hashes are sorted; the texts stay spread over tasks, and of copies one is taken.
    """
    hashed = training.withColumn("hash", F.xxhash64("text"))
    kinds = []
    for label in (0, 1):
        own = hashed.filter(F.col("label") == label)
        last = own.select("hash").distinct().orderBy("hash").limit(FIT_ROWS).agg(F.max("hash")).first()[0]
        kinds.append(own.filter(F.col("hash") <= F.lit(last)).dropDuplicates(["hash"]) if last is not None else own)
    return kinds[0].unionByName(kinds[1]).drop("hash")


SHAPE = "total double, most double, clauses int, words int"


def _inputs(total: np.ndarray, most: np.ndarray, clauses: np.ndarray, words: np.ndarray) -> np.ndarray:
    logs = (np.log1p(x) for x in (total, most, clauses, words))
    return np.stack([np.ones(len(total)), total > 0, *logs], axis=1)


def _columns() -> list[Column]:
    """The inputs of the last step as columns."""
    logs = (F.log1p(F.col(f"tox.{c}")) for c in ("total", "most", "clauses", "words"))
    return [F.lit(1.0), (F.col("tox.total") > 0).cast("double"), *logs]


def _fit(x: np.ndarray, y: np.ndarray, decay: float = 0.1) -> np.ndarray:
    """Logistic weights by Newton steps."""
    weights = np.zeros(x.shape[1])
    penalty = decay * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (chance - y) + penalty @ weights
        weights = weights - np.linalg.solve((x * (chance * (1 - chance))[:, None]).T @ x + penalty, slope)
    return weights


#: Weights of the last step where labels give none: a text with a scoring clause is above 0.3.
PLAIN = np.array([-3.0, 1.0, 1.0, 0.5, 0.0, 0.0])


@dataclass(frozen=True)
class Model:
    """The learnt part: log ratios of words and stems, and the last step's weights."""

    lexicon: dict[str, float]
    weights: np.ndarray


def measure(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float], own: int | None = None) -> Iterator[pa.RecordBatch]:
    """(row, tox) of batches of rows, whose text is their field ``own`` or else the second column; a portion at a time."""
    words, grammar = Lexicon(lexicon), Grammar()
    for batch in batches:
        column = batch.column(1) if own is None else batch.column(0).field(own)
        for start, end in portions(column):
            texts = [t or "" for t in column.slice(start, end - start).to_pylist()]
            scores = [clause_scores(t, words, grammar) for t in texts]
            found = pa.StructArray.from_arrays(
                [
                    pa.array(map(sum, scores), pa.float64()),
                    pa.array([max(s, default=0.0) for s in scores], pa.float64()),
                    pa.array(map(len, scores), pa.int32()),
                    pa.array([t.count(" ") for t in texts], pa.int32()),
                ],
                ["total", "most", "clauses", "words"],
            )
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), found], ["row", "tox"])


def _measure(df: DataFrame, text_col: str, lexicon: dict[str, float], *kept: str) -> DataFrame:
    """Columns of ``df`` (without ``kept`` all) as ``row`` and, as ``tox``, what the grammar finds in its text.

    A text goes to the workers once and comes back only if it is kept.
    """
    row = F.struct(*(kept or "*")).alias("row")
    fields = df.select(row).schema["row"].dataType
    own = [i for i, f in enumerate(fields) if f.name == text_col and isinstance(f.dataType, StringType)]
    packed = df.select(row) if own else df.select(row, F.col(text_col).cast("string").alias("text"))
    shape = StructType().add("row", fields).add("tox", StructType.fromDDL(SHAPE))
    return packed.mapInArrow(tidy(lambda batches: measure(batches, lexicon, *own)), shape)


def learn(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of ``toxicity_scores`` from the labelled rows that aren't held out."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    training = settle(_labelled(narrow, labels, "toxic", parts, held), "labelled")
    lexicon = learn_lexicon(training)
    fitted = _measure(_sample(training), "text", lexicon, "label").select("row.label", "tox.*").toPandas()
    weights = PLAIN
    if fitted["label"].nunique() == 2:
        known = _inputs(*(fitted[c].to_numpy(np.float64) for c in ("total", "most", "clauses", "words")))
        weights = _fit(known, fitted["label"].to_numpy(np.float64))
    return Model(lexicon, weights)


def _scored(docs: DataFrame, model: Model, text_col: str, *kept: str) -> DataFrame:
    """(row, tox, score) for each row of ``docs``, the row with all or the ``kept`` columns; nothing is shuffled."""
    z = sum((part * float(w) for part, w in zip(_columns(), model.weights, strict=True)), F.lit(0.0))
    return _measure(docs, text_col, model.lexicon, *kept).withColumn("score", 1 / (1 + F.exp(-z)))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score, predicted, clauses, most of every row; score: the chance of label 1.

    The lexicon is learnt from the labelled rows whose crc32(doc_id) modulo ``parts`` isn't
    ``held``, added to the seed words. Every clause with a lexical trigger passes the composed
    grammar; ``clauses`` counts them and ``most`` is the highest score. A logistic step, fitted on at
    most FIT_ROWS different training texts of each label (those with the smallest hash), turns a
    text's clause scores and length into a chance. Id, label, language and source are no inputs.

    A null text is empty; repeated rows are each scored alike; null or other labels are no labels, of
    contradicting labels of an id the largest counts; a null doc_id matches no label. Without
    labels of both kinds the seed words and fixed weights are used. Other columns are not read.
    """
    model = learn(docs, labels, parts, held, id_col, text_col)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _scored(narrow, model, "text", "doc_id").select(
        "row.doc_id",
        (fold("row.doc_id", parts) == held).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "tox.clauses",
        "tox.most",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score below THRESHOLD, as they are; the model is that of ``toxicity_scores``."""
    model = learn(docs, labels, id_col=id_col, text_col=text_col)
    return _scored(docs, model, text_col).filter(F.col("score") < THRESHOLD).select("row.*")
