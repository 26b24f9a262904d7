"""Interpolated modified Kneser-Ney bigram model, counted in Spark and mapped by its workers.

Words are 64-bit hashes; a word's number is its rank among the sorted hashes of all training words.
A bigram is one key, context number above word number. All tables are sorted arrays in files of the
shared folder, cut into pieces of bounded size however frequent a word is: pieces of words by hash
range, pieces of bigrams by ranges of their keys that hold about PIECE tokens, so that the followers
of a frequent word spread over several pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import fold, settle, slabs
from earshot.llm.shared_arrays import get, put
from earshot.session import scratch_path

#: Hash of the end of a text, which no word has as words hold no line feed.
END = xxhash.xxh64_intdigest(b"\n")
#: Training tokens of a piece of the bigram table; tokens that a task handles at a time.
PIECE, CHUNK = 1 << 22, 1 << 21
#: Training words of a piece of the word table, on average.
WORDS = 1 << 21
MOST_WORDS = 2**32 - 2


def hashes(text: bytes) -> np.ndarray:
    """Hashes of a text's words, A-Z in lower case, and of its end."""
    parts = []
    for slab in slabs(text.lower()):
        words = slab.split()
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    return np.concatenate([*parts, np.array([END], np.uint64)])


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Ids of some texts, their tokens' hashes one after the other, and where each text ends."""
    ids, parts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            ids.append(doc_id)
            parts.append(hashes(text.as_py() or b""))
            size += len(parts[-1])
            if size >= CHUNK:
                yield ids, np.concatenate(parts), np.cumsum([len(p) for p in parts])
                ids, parts, size = [], [], 0
    if ids:
        yield ids, np.concatenate(parts), np.cumsum([len(p) for p in parts])


def folded(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def dealt(keys: np.ndarray, counts: np.ndarray, pieces: np.ndarray) -> pa.RecordBatch:
    """Sorted keys and counts as one packed row per piece; ``pieces`` doesn't fall."""
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(pieces)), bool), pieces[1:] != pieces[:-1]]))
    ends = [*starts[1:].tolist(), len(keys)][: len(starts)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(pieces[starts].astype(np.int64)),
            pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
        ],
        ["piece", "keys", "counts"],
    )


PACKED = "piece long, keys binary, counts binary"


def unpacked(group: pd.DataFrame, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """All packed rows of a group, folded."""
    keys = np.concatenate([np.frombuffer(k, dtype) for k in group["keys"]])
    counts = np.concatenate([np.frombuffer(c, np.uint32) for c in group["counts"]]).astype(np.int64)
    return folded(keys, counts)


def discounts(found: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and 3 or more, from how many have 1 to 4.

    Where a number is missing, as in tiny tables, one half of each count up to one.
    """
    n1, n2, n3, n4 = found
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    rough = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(rough, [0.0, 0.05, 0.05, 0.05], [0.0, 0.95, 1.95, 2.95])


@dataclass(frozen=True)
class Words:
    """The word table: hash pieces with cumulative counts; what it holds in total."""

    folder: str
    bits: int
    bases: tuple[int, ...]
    total: int
    texts: int

    @property
    def size(self) -> int:
        return self.bases[-1]

    def pieces(self, values: np.ndarray) -> np.ndarray:
        return values >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(values), np.uint64)


class Mapped:
    """A worker's view of the word table; pieces are mapped when first used."""

    def __init__(self, words: Words):
        self.words, self.files = words, {}

    def file(self, name: str, dtype: type) -> np.ndarray:
        if name not in self.files:
            self.files[name] = get(self.words.folder, name, dtype)
        return self.files[name]

    def numbers(self, values: np.ndarray) -> np.ndarray:
        """Numbers of word hashes, -1 for words not seen in training."""
        distinct, back = np.unique(values, return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        pieces = self.words.pieces(distinct)
        for piece in np.unique(pieces).tolist():
            a, b = np.searchsorted(pieces, [piece, piece + 1])
            known = self.file(f"hash-{piece}", np.uint64)
            if len(known):
                at = np.minimum(np.searchsorted(known, distinct[a:b]), len(known) - 1)
                out[a:b] = np.where(known[at] == distinct[a:b], at + self.words.bases[piece], -1)
        return out[back]

    def dense(self, name: str, dtype: type, numbers: np.ndarray) -> np.ndarray:
        """Values of a table with one value per word, at known word numbers."""
        distinct, back = np.unique(numbers, return_inverse=True)
        out = np.zeros(len(distinct), np.int64)
        edges = np.searchsorted(distinct, self.words.bases)
        for piece in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[piece], edges[piece + 1]
            out[a:b] = self.file(f"{name}-{piece}", dtype)[distinct[a:b] - self.words.bases[piece]]
        return out[back]

    def spans(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a context's tokens begin in the order of all, and how many it has.

        The beginning of a text is the context after all words.
        """
        words, begin = self.words, contexts == self.words.size
        known = np.where(begin, 0, contexts)
        count = self.dense("count", np.int64, known) if words.size else np.zeros(len(known), np.int64)
        stop = self.dense("stop", np.int64, known) if words.size else count
        return np.where(begin, words.total, stop - count), np.where(begin, words.texts, count)


def piece_of(start: np.ndarray, count: np.ndarray, following: np.ndarray, size: int) -> np.ndarray:
    """Piece of a bigram; rises with its key. A frequent context's followers are spread by number."""
    inside = np.floor(count * (following / max(1, size + 1))).astype(np.int64)
    return (start + inside) // PIECE


def _grouped(packed: DataFrame, merge: Callable[[tuple, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    return packed.groupBy("piece").applyInPandas(merge, schema)


def _count_words(texts: DataFrame, folder: str, n_texts: int, n_words: int) -> Words:
    """Count all training words into pieces by the upper bits of their hash."""
    bits = max(0, int(np.ceil(np.log2(max(1, n_words) / WORDS))))
    table = Words(folder, bits, (0,), 0, n_texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values, _ in chunks(batches):
            keys, counts = folded(values, np.ones(len(values), np.int64))
            yield dealt(keys, counts, table.pieces(keys))

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = unpacked(group, np.uint64)
        put(folder, f"hash-{key[0]}", keys)
        put(folder, f"count-{key[0]}", counts)
        return pd.DataFrame({"piece": [key[0]], "words": [len(keys)], "tokens": [counts.sum()]})

    made = _grouped(texts.mapInArrow(count, PACKED), merge, "piece long, words long, tokens long")
    sizes = {r["piece"]: r for r in settle(made, "word-pieces").collect()}  # one row per piece
    bases, stops, total = [0], [0], 0
    for piece in range(1 << bits):
        found = sizes.get(piece)
        bases.append(bases[-1] + (found["words"] if found else 0))
        total += found["tokens"] if found else 0
        stops.append(total)
        if not found:
            put(folder, f"hash-{piece}", np.zeros(0, np.uint64))
            put(folder, f"count-{piece}", np.zeros(0, np.int64))
    if bases[-1] > MOST_WORDS:
        raise ValueError("more distinct words than 32-bit numbers")
    pieces = texts.sparkSession.range(1 << bits, numPartitions=min(1 << bits, 4096))

    def add_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for piece in frame["id"].tolist():
                put(folder, f"stop-{piece}", np.cumsum(get(folder, f"count-{piece}", np.int64)) + stops[piece])
            yield frame

    pieces.mapInPandas(add_up, "id long").count()
    return Words(folder, bits, tuple(bases), total, n_texts)


@dataclass(frozen=True)
class Model:
    words: Words
    #: Discounts of bigram counts and of the numbers of contexts of words.
    high: np.ndarray
    low: np.ndarray
    bigrams: int
    #: Share that the word level leaves to a uniform choice.
    spare: float


def keys_of(mapped: Mapped, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and words of consecutive tokens; the first token of a text follows its beginning."""
    contexts = np.concatenate([[mapped.words.size], numbers[:-1]])
    contexts[ends[:-1]] = mapped.words.size
    return contexts, numbers


def _count_bigrams(texts: DataFrame, words: Words) -> Model:
    """Count bigrams piece by piece, then what each word has as context and as follower."""
    folder, size = words.folder, words.size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = Mapped(words)
        for _, values, ends in chunks(batches):
            contexts, following = keys_of(mapped, mapped.numbers(values), ends)
            joint = contexts.astype(np.uint64) << np.uint64(32) | following.astype(np.uint64)
            keys, counts = folded(joint, np.ones(len(joint), np.int64))
            contexts = (keys >> np.uint64(32)).astype(np.int64)
            following = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            yield dealt(keys, counts, piece_of(*mapped.spans(contexts), following, size))

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = unpacked(group, np.uint64)
        put(folder, f"bigram-{key[0]}", keys)
        put(folder, f"times-{key[0]}", counts.astype(np.uint32))
        contexts, following = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
        rows = []
        # As context: how many followers were seen once, twice, more often. As follower: after how many words.
        for kind, numbers in (("one", contexts[counts == 1]), ("two", contexts[counts == 2]), ("more", contexts[counts > 2]), ("after", following)):
            of, n = folded(numbers, np.ones(len(numbers), np.int64))
            part = dealt(of, n, np.searchsorted(words.bases, of.astype(np.int64), side="right") - 1).to_pandas()
            rows.append(part.assign(kind=kind))
        tally = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
        rows.append(pd.DataFrame({"piece": [-1], "keys": [b""], "counts": [np.append(tally, len(keys)).astype(np.int64).tobytes()], "kind": ["tally"]}))
        return pd.concat(rows, ignore_index=True)

    def spread(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        piece = key[0]
        low, high = (words.bases[piece], words.bases[piece + 1]) if piece < len(words.bases) - 1 else (size, size + 1)
        tally = np.zeros(5, np.int64)
        for kind in ("one", "two", "more", "after"):
            numbers, n = unpacked(group[group["kind"] == kind], np.uint64) if (group["kind"] == kind).any() else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            out = np.zeros(high - low, np.int64)
            out[numbers.astype(np.int64) - low] = n
            put(folder, f"{kind}-{piece}", out.astype(np.uint32))
            if kind == "after":
                tally = np.bincount(np.minimum(n, 5), minlength=6)[1:6]
                more = int((n > 2).sum())
        return pd.DataFrame([[piece, *(int(t) for t in tally[:4]), more]], columns=["piece", "n1", "n2", "n3", "n4", "more"])

    counted = settle(_grouped(texts.mapInArrow(count, PACKED), merge, f"{PACKED}, kind string"), "bigram-pieces")
    tallies = [np.frombuffer(r["counts"], np.int64) for r in counted.filter("piece = -1").collect()]  # one per piece
    seen = np.sum(tallies, axis=0) if tallies else np.zeros(5, np.int64)
    after = (
        _grouped(counted.filter("piece >= 0"), spread, "piece long, n1 long, n2 long, n3 long, n4 long, more long")
        .agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n1", "n2", "n3", "n4", "more")))
        .first()
    )
    low = discounts(list(after[:4]))
    spare = float(low[1] * after[0] + low[2] * after[1] + low[3] * after[4]) / max(1, int(seen[4]))
    return Model(words, discounts(list(seen[:4])), low, int(seen[4]), spare if seen[4] else 1.0)


def probabilities(model: Model, mapped: Mapped, values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of the tokens' words and the model's chance of each token."""
    words = model.words
    contexts, following = keys_of(mapped, mapped.numbers(values), ends)
    seen = following >= 0
    counts, after = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    counts[seen] = mapped.dense("count", np.int64, following[seen])
    after[seen] = mapped.dense("after", np.uint32, following[seen])
    chance = model.spare / (words.size + 1) + np.maximum(after - model.low[np.minimum(after, 3)], 0) / max(1, model.bigrams)

    start, total = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    usable = (contexts >= 0) & (words.texts > 0)
    start[usable], total[usable] = mapped.spans(contexts[usable])
    usable &= total > 0
    spare = sum(
        model.high[i] * mapped_context(mapped, kind, contexts[usable]) for i, kind in ((1, "one"), (2, "two"), (3, "more"))
    )
    times = np.zeros(len(values), np.int64)
    pairs = np.flatnonzero(usable & seen)
    joint = contexts[pairs].astype(np.uint64) << np.uint64(32) | following[pairs].astype(np.uint64)
    order = np.argsort(joint)
    pairs, joint = pairs[order], joint[order]
    pieces = piece_of(start[pairs], total[pairs], following[pairs], words.size)
    for piece in np.unique(pieces).tolist():
        a, b = np.searchsorted(pieces, [piece, piece + 1])
        known = mapped.file(f"bigram-{piece}", np.uint64)
        if len(known):
            at = np.minimum(np.searchsorted(known, joint[a:b]), len(known) - 1)
            times[pairs[a:b]] = np.where(known[at] == joint[a:b], mapped.file(f"times-{piece}", np.uint32)[at], 0)
    rest = np.maximum(times[usable] - model.high[np.minimum(times[usable], 3)], 0)
    chance[usable] = (rest + spare * chance[usable]) / total[usable]
    return counts, chance


def mapped_context(mapped: Mapped, kind: str, contexts: np.ndarray) -> np.ndarray:
    """A context table's values; the beginning of a text has a piece of its own."""
    size = mapped.words.size
    begin = contexts == size
    out = np.zeros(len(contexts), np.int64)
    out[~begin] = mapped.dense(kind, np.uint32, contexts[~begin])
    if begin.any():
        out[begin] = mapped.file(f"{kind}-{len(mapped.words.bases) - 1}", np.uint32)[0]
    return out


def language_model_scores(
    docs: DataFrame, parts: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row.

    The rows whose crc32(doc_id) modulo ``parts`` isn't ``held`` train an interpolated modified
    Kneser-Ney bigram model, whose word level is interpolated with a uniform choice among the V
    training words and one unknown. Tokens are the words between ASCII white space, A-Z in lower
    case, and one end per text. ``score`` is the sum of the tokens' log10 chances, ``base_score`` that
    of add-one word chances log10((c + 1) / (N + V + 1)); ``n_known`` counts tokens seen in training,
    ``perplexity`` is 10 ** (-score / n_tokens).

    A null text is empty and has its end alone; repeated rows train and are scored once each; a null
    doc_id has the crc32 of the empty text. Without training rows V and N are 0 and every chance is
    one. Other columns are not read. The model's files stay in the shared folder for the result's
    tasks; they grow with the corpus, each one stays bounded.
    """
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    training = narrow.filter(fold("doc_id", parts) != held)
    folder = scratch_path(docs.sparkSession, "ngram")
    n_texts, n_bytes = training.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    words = _count_words(training, folder, n_texts, n_bytes // 24)
    model = _count_bigrams(training, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = Mapped(words)
        for ids, values, ends in chunks(batches):
            counts, chance = probabilities(model, mapped, values, ends)
            starts = np.concatenate([[0], ends[:-1]])
            base = np.log10((counts + 1) / (words.total + words.size + 1))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "n_tokens": ends - starts,
                    "n_known": np.add.reduceat((counts > 0).astype(np.int64), starts),
                    "base_score": np.add.reduceat(base, starts),
                    "score": np.add.reduceat(np.log10(chance), starts),
                }
            )

    scored = narrow.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id",
        (fold("doc_id", parts) == held).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(words.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
