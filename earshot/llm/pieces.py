"""SentencePiece encoding by a relational lattice of each distinct word, and decoding.

A *unit* is a run of word marks (blanks) and what follows up to the next one; a *part* of it ends where
no piece holds the next two characters side by side, say at a full stop. No piece reaches across
parts, so a text's pieces are those of its parts one after the other. Each distinct part of the
corpus is encoded once, in Spark: its bounded-length substrings are joined to the piece table, the
edges grouped by unit, and a higher-order aggregate folds them into pieces. The results, as sorted
hash arrays in the shared folder, are what the documents look their parts up in.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import tidy
from earshot.llm.shared_arrays import get, put
from earshot.session import scratch_path

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
#: Longest part, in characters, that passes the lattice; its boundaries are the bits of a long.
LONGEST = 62
#: Characters of text cut into units at a time, parts a task gathers, parts of a dictionary piece, whose edges one task sorts.
SLAB, GATHER, PIECE = 1 << 20, 1 << 19, 1 << 15
#: Bytes of lines that a task cuts into parts and encodes at a time.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Model:
    """What a model file says: pieces with scores, byte pieces, the unknown piece, the kind of fold."""

    kind: int
    ids: dict[str, int]
    scores: dict[str, float]
    spelled: tuple[bytes, ...]
    octets: tuple[int, ...]
    unknown: int
    prefix: bool
    #: Pairs of characters that stand side by side in some piece.
    neighbours: frozenset[str]

    @property
    def longest(self) -> int:
        return max(map(len, self.ids))

    def parts(self, unit: str) -> list[str]:
        """A unit cut wherever no piece can hold the characters on both sides."""
        cuts = [i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in self.neighbours]
        return [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)], strict=True)]


def load(path: str = MODEL) -> Model:
    """Read a model file; raises where its normalisation or pieces break the cut into units."""
    from sentencepiece import sentencepiece_model_pb2 as messages

    proto = messages.ModelProto()
    proto.ParseFromString(Path(path).read_bytes())
    rules, trainer = proto.normalizer_spec, proto.trainer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only models that leave the text as it is are supported")
    if trainer.model_type not in (UNIGRAM, BPE) or trainer.treat_whitespace_as_suffix:
        raise ValueError("only unigram and BPE models with leading word marks are supported")
    usable = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
    if any(p.type == USER_DEFINED for p in proto.pieces) or any(MARK in p.lstrip(MARK) for p in usable):
        raise ValueError("pieces that reach across words are not supported")
    octets = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == BYTE}
    order = tuple(octets[f"<0x{b:02X}>"] for b in range(256)) if octets else ()
    spelled = [p.piece.replace(MARK, " ").encode() if p.type == NORMAL else b"" for p in proto.pieces]
    for octet, piece in enumerate(order):
        spelled[piece] = bytes([octet])
    unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
    if not order:
        spelled[unknown] = " ⁇ ".encode()
    scores = {p: proto.pieces[i].score for p, i in usable.items()}
    pairs = frozenset(p[i : i + 2] for p in usable for i in range(len(p) - 1))
    if len(proto.pieces) >= NO_ID:
        raise ValueError("ids must fit 20 bits")
    return Model(trainer.model_type, usable, scores, tuple(spelled), order, unknown, rules.add_dummy_prefix, pairs)


def slabs(line: str, mark: str = MARK) -> Iterator[str]:
    """A line cut into slabs of about SLAB characters that end before a word mark."""
    start = 0
    while start < len(line):
        end = start + SLAB
        while 0 < end < len(line) and not (line[end] == mark and line[end - 1] != mark):
            end = line.find(mark, end + 1)
        end = len(line) if end < 0 else min(end, len(line))
        yield line[start:end]
        start = end


def units(text: str, prefix: bool = True) -> Iterator[str]:
    """The units of a whole text."""
    if text:
        for slab in slabs((MARK if prefix else "") + text.replace(" ", MARK)):
            yield from UNIT.findall(slab)


def lines(texts: pa.Array, prefix: bool) -> pa.Array:
    """Each text as the model reads it, word marks as blanks; a null or empty text is the empty line."""
    filled = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), MARK, " ")
    return pc.if_else(pc.equal(filled, ""), "", pc.binary_join_element_wise("", filled, " ")) if prefix else filled


def blocks(texts: pa.Array, prefix: bool) -> Iterator[tuple[Iterable[pa.Array], int]]:
    """Lines of about BLOCK bytes in one array, with their number; a longer one by itself, in an array for each slab."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    stops, start = np.cumsum(size), 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(stops, stops[start] - size[start] + BLOCK, "right")))
        some = lines(texts.slice(start, end - start), prefix)
        yield [some] if size[start] <= BLOCK else (pa.array([slab], pa.string()) for slab in slabs(some[0].as_py(), " ")), end - start
        start = end


class Cutter:
    """Cuts whole arrays of lines into parts, wherever no piece holds the characters on both sides."""

    def __init__(self, model: Model):
        letters = {c: i for i, c in enumerate(sorted({c for pair in model.neighbours for c in pair}), 1)}
        self.width = len(letters) + 1
        self.kinds = np.zeros(0x110000, np.int32)  # 0: in no pair
        for letter, kind in letters.items():
            self.kinds[ord(letter.replace(MARK, " "))] = kind
        pairs = np.array([letters[a] * self.width + letters[b] for a, b in model.neighbours], np.int64)
        self.pairs = np.unique(pairs)
        self.table = np.zeros(self.width**2, bool) if self.width <= 1 << 12 else None
        if self.table is not None:
            self.table[pairs] = True

    def held(self, codes: np.ndarray) -> np.ndarray:
        return np.isin(codes, self.pairs) if self.table is None else self.table[codes]

    def __call__(self, block: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The parts of all lines in a row, and the number of each line's parts."""
        bounds = np.frombuffer(block.buffers()[1], np.int32)[block.offset : block.offset + len(block) + 1] if len(block) else np.zeros(1, np.int32)
        if bounds[-1] == bounds[0]:
            return pa.array([], pa.string()), np.zeros(len(block), np.int64)
        raw = np.frombuffer(block.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        starts, letters = None, raw
        if raw.max() >= 0x80:
            starts = np.flatnonzero((raw & 0xC0) != 0x80)
            letters = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        kinds = self.kinds[letters]
        cut = np.ones(len(letters), bool)
        cut[1:] = ~self.held(kinds[:-1].astype(np.int64) * self.width + kinds[1:])
        begins = bounds[:-1][bounds[1:] > bounds[:-1]]
        cut[begins if starts is None else np.searchsorted(starts, begins)] = True
        first = np.flatnonzero(cut)
        stops = np.append(first if starts is None else starts[first], len(raw)).astype(np.int32)
        parts = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(stops), pa.py_buffer(raw)])
        return parts, np.diff(np.searchsorted(stops[:-1], bounds))


def spell(model: Model, symbol: str) -> list[int]:
    """Ids of a symbol: its piece, else the pieces of its bytes, else the unknown piece."""
    known = model.ids.get(symbol)
    if known is not None:
        return [known]
    return [model.octets[b] for b in symbol.encode()] if model.octets else [model.unknown]


def merge_unit(model: Model, unit: str) -> list[int]:
    """Pieces of one unit by merging pairs in the order of their scores, for units of any length."""
    ends = list(range(1, len(unit) + 1))
    before, after = list(range(-1, len(unit) - 1)), [*range(1, len(unit)), -1]
    alive = [True] * len(unit)
    queue: list[tuple[float, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right >= 0:
            score = model.scores.get(unit[left : ends[right]])
            if score is not None:
                heapq.heappush(queue, (-score, left, ends[left], ends[right]))

    for i in range(len(unit)):
        offer(i)
    while queue:
        _, left, middle, end = heapq.heappop(queue)
        right = after[left] if alive[left] else -1
        if right < 0 or ends[left] != middle or ends[right] != end:
            continue
        alive[right], ends[left], after[left] = False, end, after[right]
        if after[left] >= 0:
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [i for at in range(len(unit)) if alive[at] for i in spell(model, unit[at : ends[at]])]


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, score, code) of the size of the model file; a code is the rank of the score, then the id."""
    ranks = {score: rank for rank, score in enumerate(sorted(set(model.scores.values()), reverse=True))}
    rows = pd.DataFrame(
        {
            "piece": list(model.ids),
            "score": list(model.scores.values()),
            "code": [ranks[model.scores[p]] << 32 | i for p, i in model.ids.items()],
        }
    )
    return spark.createDataFrame(rows, "piece string, score double, code long")


#: A character without a piece, in the id's bits of an edge, and its rank.
NO_ID, NO_RANK = (1 << 20) - 1, (1 << 30) - 1


def lattice(words: DataFrame, model: Model) -> DataFrame:
    """(piece_no, word, start, end, piece, score, code): the pieces in distinct words, one row per edge.

    Substrings of up to the longest piece's length are joined to the piece table, which is of the model's
    size and so is broadcast. A character without a piece stays, with nulls.
    """
    stop = F.least(F.length("word"), F.col("start") + model.longest)
    return (
        words.select("piece_no", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
        .select("piece_no", "word", "start", F.explode(F.sequence(F.col("start") + 1, stop)).alias("end"))
        .withColumn("piece", F.substr("word", F.col("start") + 1, F.col("end") - F.col("start")))
        .join(F.broadcast(piece_table(words.sparkSession, model)), "piece", "left")
        .filter(F.col("code").isNotNull() | (F.col("end") - F.col("start") == 1))
    )


def _spelled(letter: Column, model: Model) -> Column:
    """Ids of the bytes of a character, or the unknown piece."""
    if not model.octets:
        return F.array(F.lit(model.unknown))
    octets = F.array(*map(F.lit, model.octets))
    letters = F.hex(F.encode(letter, "UTF-8"))
    return F.transform(
        F.sequence(F.lit(0), F.shiftright(F.length(letters), 1) - 1),
        lambda i: F.get(octets, F.conv(F.substr(letters, 2 * i + 1, F.lit(2)), 16, 10).cast("int")),
    )


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))


def _field(edge: Column, shift: int, bits: int) -> Column:
    return F.shiftright(edge, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def merged(edges: DataFrame, model: Model) -> DataFrame:
    """(piece_no, word, ids) by merging in the order of the scores, from the left among equal ones.

    An edge is packed into a long: rank, start, end, id; sorted, they are in the order of merging. The
    state is the set of boundaries between parts as the bits of a long, and beside each edge stand the bits
    of its ends and those from one end to the other. Each edge in turn that joins two parts takes away the
    boundary inside it. One pass misses an edge that becomes possible only after one of a worse rank;
    ``_dictionary`` checks for it.
    """
    code = F.coalesce("code", F.lit(NO_RANK << 32 | NO_ID))
    packed = code + F.shiftleft(F.col("start").cast("long"), 26) + F.shiftleft(F.col("end").cast("long"), 20)
    ends = _bit(F.col("start")) + _bit(F.col("end"))
    span = 2 * _bit(F.col("end")) - _bit(F.col("start"))
    # Three longs, computed before the rows are grouped: a row waits for its group in memory.
    narrow = edges.select("piece_no", "word", packed.alias("edge"), ends.alias("ends"), span.alias("span"))
    edge = F.struct("edge", "ends", "span")

    def turn(bounds: Column, x: Column) -> Column:
        joined = (bounds.bitwiseAND(x["ends"]) == x["ends"]) & (F.bit_count(bounds.bitwiseAND(x["span"])) == 3)
        return F.when(joined, bounds.bitwiseAND(F.bitwise_not(x["span"])).bitwiseOR(x["ends"])).otherwise(bounds)

    def read(bounds: Column) -> Column:
        # The edges between neighbouring boundaries: both ends, and nothing else, from start to end.
        parts = F.filter("edges", lambda x: bounds.bitwiseAND(x["span"]) == x["ends"])
        return F.sort_array(F.transform(parts, lambda x: x["edge"].bitwiseAND(F.lit((1 << 32) - 1))))

    def spelled(x: Column) -> Column:
        letter = F.substr(F.col("word"), _field(x, 26, 6) + 1, F.lit(1))
        return F.when(_field(x, 0, 20) == NO_ID, _spelled(letter, model)).otherwise(F.array(_field(x, 0, 20)))

    every = F.call_function("shiftleft", F.lit(2).cast("long"), F.length("word")) - 1
    grouped = narrow.groupBy("piece_no", "word").agg(
        F.collect_list(edge).alias("edges"),
        F.bool_or(F.col("edge").bitwiseAND(F.lit(NO_ID)) == NO_ID).alias("gaps"),
    )
    joins = F.filter("edges", lambda x: x["span"] != x["ends"])
    ordered = F.aggregate(F.sort_array(joins), every, turn, read)
    ids = F.transform(ordered, lambda x: x.bitwiseAND(F.lit(NO_ID)).cast("int"))
    ids = F.when(F.col("gaps"), F.flatten(F.transform(ordered, spelled))).otherwise(ids)
    return grouped.select("piece_no", "word", ids.alias("ids"))


def viterbi(edges: DataFrame, model: Model) -> DataFrame:
    """(piece_no, word, ids) of the path of least cost: the best way to each place, from those before it.

    Of equal paths the one whose last pieces are longer is kept.
    """
    known = F.col("code").isNotNull()
    edge = F.struct(
        (-F.coalesce("score", F.lit(min(model.scores.values()) - 10))).alias("cost"),
        "start",
        "end",
        F.when(known, F.array(_field(F.col("code"), 0, 20))).otherwise(_spelled(F.col("piece"), model)).alias("ids"),
    )
    grouped = edges.groupBy("piece_no", "word").agg(F.collect_list(edge).alias("edges"))
    size = F.length("word")

    def place(best: Column, end: Column) -> Column:
        ways = F.transform(
            F.filter("edges", lambda x: x["end"] == end),
            lambda x: F.struct(
                (F.get(best, x["start"])["cost"] + x["cost"]).alias("cost"),
                x["start"].alias("start"),
                F.concat(F.get(best, x["start"])["ids"], x["ids"]).alias("ids"),
            ),
        )
        return F.array_append(best, F.array_min(ways))

    origin = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(0).alias("start"), F.array().cast("array<int>").alias("ids")))
    path = F.aggregate(F.sequence(F.lit(1), size), origin, place, lambda best: F.get(best, size)["ids"])
    return grouped.select("piece_no", "word", path.alias("ids"))


def encode_words(words: DataFrame, model: Model, kind: int | None = None) -> DataFrame:
    """(piece_no, word, ids) of distinct words of up to LONGEST characters.

    The fold follows the kind of model: the path of least cost for a unigram model, merges in the order of
    the scores for BPE, whose pieces the cheapest path doesn't give.
    """
    fold = viterbi if (kind or model.kind) == UNIGRAM else merged
    return fold(lattice(words, model), model)


def _dictionary(docs: DataFrame, model: Model, folder: str, bits: int, model_path: str = MODEL) -> None:
    """Encode the distinct parts of all texts and file them under the upper bits of their hash.

    Each part's pieces are checked against the model's own library before they are filed; one that differs
    is filed as the queue of ``merge_unit`` gives it.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held = Cutter(model), []
        for batch in batches:
            for block in (b for some, _ in blocks(batch.column(0), model.prefix) for b in some):
                held.append(cutter(block)[0].unique())
                if sum(map(len, held)) > GATHER:
                    held = [pa.concat_arrays(held).unique()]
                    if len(held[0]) > GATHER // 2:
                        yield rows(held[0])
                        held = []
        if held:
            yield rows(pa.concat_arrays(held).unique())

    def rows(parts: pa.Array) -> pa.RecordBatch:
        parts = parts.filter(pc.less_equal(pc.utf8_length(parts), LONGEST))
        numbers = _hashes(parts) >> np.uint64(64 - bits) if bits else np.zeros(len(parts), np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), pc.replace_substring(parts, " ", MARK)], ["piece_no", "word"])

    def write(table: pa.Table) -> pa.Table:
        name, words = table["piece_no"][0].as_py(), _whole(table["word"])
        hashes = _hashes(pc.replace_substring(words, MARK, " "))
        order = np.argsort(hashes)
        every, found = words.take(pa.array(order)).to_pylist(), _whole(table["ids"]).take(pa.array(order))
        ids, n_ids = found.flatten().to_numpy(), pc.list_value_length(found).to_numpy()
        exact = library(proto).encode(every, num_threads=1)
        n_exact = np.fromiter(map(len, exact), np.int64, len(exact))
        if not np.array_equal(n_ids, n_exact) or not np.array_equal(ids, np.fromiter(chain.from_iterable(exact), np.int32, n_exact.sum())):
            own = [f if f == e else merge_unit(model, word) for word, f, e in zip(every, found.to_pylist(), exact, strict=True)]
            ids, n_ids = np.array([*chain.from_iterable(own)], np.int32), np.array([*map(len, own)])
        put(folder, f"hash-{name}", hashes[order])
        put(folder, f"stop-{name}", np.cumsum(n_ids, dtype=np.int64))
        put(folder, f"ids-{name}", ids.astype(np.int32))
        return pa.table({"piece_no": pa.array([name], pa.int32()), "words": pa.array([len(every)], pa.int64())})

    proto = bare(model_path)
    words = docs.select("text").mapInArrow(tidy(distinct), "piece_no int, word string")
    # A task for each piece, as several in one would wait in its memory together; in the order of their
    # groups, since the edges of words in order are sorted as they come.
    words = words.repartitionById(1 << bits, "piece_no").dropDuplicates(["piece_no", "word"])
    encoded = encode_words(words.sortWithinPartitions("piece_no", "word"), model).groupBy("piece_no").applyInArrow(write, "piece_no int, words long")
    encoded.agg(F.sum("words")).first()


def bare(path: str) -> bytes:
    """The model file's content, for an encoder that takes a part as it stands, without a mark before it."""
    from sentencepiece import sentencepiece_model_pb2 as messages

    proto = messages.ModelProto()
    proto.ParseFromString(Path(path).read_bytes())
    proto.normalizer_spec.add_dummy_prefix = False
    return proto.SerializeToString()


@functools.lru_cache(maxsize=2)
def library(proto: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=proto)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def _hashes(parts: pa.Array) -> np.ndarray:
    """Hashes of parts whose marks are blanks."""
    found = [np.zeros(0, np.uint64)]
    for at in range(0, len(parts), PIECE):
        values = parts.slice(at, PIECE).cast(pa.binary()).to_pylist()
        found.append(np.fromiter(map(xxhash.xxh64_intdigest, values), np.uint64, len(values)))
    return np.concatenate(found)


class Dictionary:
    """A worker's view of the encoded parts."""

    def __init__(self, folder: str, bits: int, model: Model):
        self.folder, self.bits, self.model, self.files = folder, bits, model, {}
        self.cutter = Cutter(model)
        self.sizes = np.array([len(s) for s in model.spelled], np.int64)

    def file(self, name: str, dtype: type) -> np.ndarray:
        if name not in self.files:
            self.files[name] = get(self.folder, name, dtype)
        return self.files[name]

    def encode(self, distinct: list[str]) -> list[np.ndarray]:
        """Ids of units or of runs of them."""
        ids, n_ids = self.encode_lines(pc.replace_substring(pa.array(distinct, pa.string()), MARK, " "))
        return np.split(ids, np.cumsum(n_ids)[:-1]) if distinct else []

    def encode_lines(self, block: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all lines in a row, and the number of each line's."""
        parts, n_parts = self.cutter(block)
        coded = parts.dictionary_encode()
        ids, n_ids = self.look_up(coded.dictionary)
        order = coded.indices.to_numpy()
        stops = np.append(0, np.cumsum(n_ids[order]))[np.append(0, np.cumsum(n_parts))]
        return _gathered(ids, (np.cumsum(n_ids) - n_ids)[order], n_ids[order]), np.diff(stops)

    def look_up(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts in a row, and the number of each part's.

        One that isn't filed, or under another's hash, is encoded on the spot.
        """
        hashes = _hashes(parts)
        pieces = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(parts), np.int64)
        found, order = [np.zeros(0, np.int32)], np.argsort(hashes)  # by piece too, which is the hash's upper bits
        n_ids = np.zeros(len(parts), np.int64)  # in this order
        bounds = [*np.flatnonzero(np.diff(pieces[order], prepend=-1)).tolist(), len(parts)]
        for low, high in zip(bounds, bounds[1:]):
            name = pieces[order[low]]
            known, stops, ids = (self.file(f"{n}-{name}", t) for n, t in (("hash", np.uint64), ("stop", np.int64), ("ids", np.int32)))
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes[order[low:high]]), len(known) - 1)
                starts = np.where(at > 0, stops[at - 1], 0)
                n_ids[low:high] = np.where(known[at] == hashes[order[low:high]], stops[at] - starts, 0)
                found.append(_gathered(ids, starts, n_ids[low:high]))
        ids, parts = np.concatenate(found), parts.take(pa.array(order))
        # Ids stand for their part where they spell it out; else it is encoded by itself.
        size = pc.binary_length(parts).to_numpy(zero_copy_only=False)
        other = np.diff(np.append(0, np.cumsum(self.sizes[ids]))[np.append(0, np.cumsum(n_ids))]) != size
        ids, n_ids = self.mended(parts, ids, n_ids, np.flatnonzero(other))
        if spelling(self.model, ids) != b"".join(parts.cast(pa.binary()).to_pylist()):  # two parts of one hash
            own = np.split(ids, np.cumsum(n_ids)[:-1])
            other = [i for i, part in enumerate(parts.to_pylist()) if spelling(self.model, own[i]) != part.encode()]
            ids, n_ids = self.mended(parts, ids, n_ids, np.array(other, np.int64))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return _gathered(ids, (np.cumsum(n_ids) - n_ids)[back], n_ids[back]), n_ids[back]

    def mended(self, parts: pa.Array, ids: np.ndarray, n_ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, those at some places replaced by what the queue gives."""
        if not len(places):
            return ids, n_ids
        exact = [merge_unit(self.model, part.replace(" ", MARK)) for part in parts.take(pa.array(places)).to_pylist()]
        starts, n_ids = np.cumsum(n_ids) - n_ids, n_ids.copy()
        n_ids[places] = [len(e) for e in exact]
        starts[places] = len(ids) + np.cumsum(n_ids[places]) - n_ids[places]
        return _gathered(np.concatenate([ids, *(np.array(e, np.int32) for e in exact)]), starts, n_ids), n_ids


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of values one after the other."""
    places = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return values[places]


def spelling(model: Model, ids: np.ndarray) -> bytes:
    return b"".join(map(model.spelled.__getitem__, ids.tolist()))


def encode(
    docs: DataFrame, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """doc_id, ids, n_pieces of every row of ``docs``: the pieces of its whole text.

    With ``decoded`` also the text that the ids stand for, as ``decode`` gives it, in the same pass.

    The ids are those the model gives the text. A null or empty text has none. Repeated rows are kept,
    null ids too; other columns are not read. Parts longer than LONGEST characters don't pass the
    lattice but are merged where they stand, by a queue, with the same result.
    """
    model = load(model_path)
    if model.kind != BPE:
        raise ValueError("long units of unigram models are not supported; use encode_words")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_bytes = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(0, int(np.ceil(np.log2(max(1, n_bytes // 128) / PIECE))))
    folder = scratch_path(docs.sparkSession, "pieces")
    _dictionary(narrow, model, folder, bits, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = Dictionary(folder, bits, model)
        for batch in batches:
            at = 0
            for some, rows in blocks(batch.column(1), model.prefix):
                found = _encoded(batch.column(0).slice(at, rows), some, dictionary)
                at += rows
                if decoded:
                    texts = pa.array([read_back(model, ids) for ids in found.column(1)], pa.string())
                    found = pa.RecordBatch.from_arrays([*found.columns, texts], [*found.schema.names, "decoded"])
                yield found

    return narrow.mapInArrow(tidy(run), "doc_id long, ids array<int>, n_pieces int" + ", decoded string" * decoded)


def _encoded(doc_ids: pa.Array, some: Iterable[pa.Array], dictionary: Dictionary) -> pa.RecordBatch:
    ids, n_ids = zip(*map(dictionary.encode_lines, some))
    # The arrays are slabs of one line, or there is but one array.
    n_pieces = n_ids[0] if len(n_ids) == 1 else np.array([sum(n.sum() for n in n_ids)])
    stops = pa.array(np.append(0, np.cumsum(n_pieces)).astype(np.int32))
    found = pa.ListArray.from_arrays(stops, pa.array(np.concatenate(ids), pa.int32()))
    return pa.RecordBatch.from_arrays([doc_ids, found, pa.array(n_pieces.astype(np.int32))], ["doc_id", "ids", "n_pieces"])


def read_back(model: Model, ids: pa.ListScalar) -> str:
    """The text of a row's ids without the blank that the model puts first."""
    spelled = spelling(model, ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else b""
    return spelled.decode("utf-8", "replace")[1 if model.prefix and spelled[:1] == b" " else 0 :]


def decode(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """``encoded`` with the text that its ids stand for; null ids decode to the empty text.

    Ids are spelled out and read as UTF-8, and the blank that the model puts before a text goes. A
    literal word mark U+2581 comes back as a blank, which is what the model takes it for.
    """
    model = load(model_path)
    shape = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in encoded.schema)}, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [read_back(model, ids) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, shape)
