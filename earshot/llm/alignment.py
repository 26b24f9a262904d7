"""Alignment of two tokenizers' tokens by an associative fragment monoid.

A text's *line* is a space and the text; both tokenizers' tokens cover its bytes. Where tokens of both
end at the same byte, a *group* closes. A byte range of a line gives a *fragment*: an open prefix up to
its first common end, closed groups, and an open suffix behind its last one. Fragments compose
associatively, so those of a very long text are folded by a tree over Spark tasks; groups are filed as
soon as they are closed, and only the open ends travel up the tree.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import settle
from earshot.llm.shared_arrays import get, put
from earshot.llm.token_counts import PATTERN
from earshot.session import scratch_path

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bytes of a line that make one fragment; longer texts go through the tree.
CHUNK = 1 << 16
#: Fragments that one node of the tree composes.
FAN = 16
#: Tokens that a task looks at together, pairs in one file of counts, pairs a task counts before it passes them on.
BATCH, FILE, COUNTED = 1 << 17, 1 << 20, 1 << 18
#: Texts that a task encodes, rows that it unpacks at a time.
TEXTS, ROWS = 256, 256
#: Where both tokenizers end a token whatever stands around: before the one space between two words.
SEAM = re.compile(rb"(?<=[A-Za-z0-9]) (?=[A-Za-z])")


@dataclass(frozen=True)
class Side:
    """Bytes of each token id, their number, and the digits of the id with the sign inside and at the end of a group."""

    spelled: list[bytes]
    sizes: np.ndarray
    inside: np.ndarray
    last: np.ndarray


def _side(spelled: list[bytes], sign: bytes) -> Side:
    signed = (np.array([b"%d%b" % (i, c) for i in range(len(spelled))], object) for c in (b",", sign))
    return Side(spelled, np.array([len(s) for s in spelled], np.int64), *signed)


class Tokenizers:
    """Byte-level BPE (A) of a ``tokenizers`` file and the pieces (B) of a SentencePiece model."""

    def __init__(self, byte_bpe: bytes, model: bytes):
        body = json.loads(byte_bpe)["model"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        octet = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
        ids = {bytes(map(octet.__getitem__, t)): i for t, i in body["vocab"].items() if all(c in octet for c in t)}
        joined = [bytes(map(octet.__getitem__, "".join(m if isinstance(m, list) else m.split(" ")))) for m in body["merges"]]
        ranks = {t: i for t, i in ids.items() if len(t) == 1} | {t: ids[t] for t in joined}
        if [ranks[t] for t in joined] != sorted(ranks[t] for t in joined):
            raise ValueError("the ids don't follow the order of the merges")
        spelled = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            spelled[i] = token
        self.a = _side(spelled, b"|")
        self.bpe = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.b = _side([bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)], b";")
        #: What ids are kept as.
        self.dtype = np.uint16 if max(len(self.a.spelled), len(self.b.spelled)) <= 1 << 16 else np.uint32
        #: Whether no piece reaches across a space and texts are left as they are, so that slabs can be encoded alone.
        self.separable = not any(MARK in p.lstrip(MARK) for p in names) and sp.normalize(" a  b ") == f"{MARK * 2}a{MARK * 2}b{MARK}"

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """Ids of both and whether each side's bytes are those of the line."""
        found = []
        for text, b in zip(texts, self.sp.encode(texts, num_threads=1), strict=True):
            line = b" " + text.encode()
            a = self.bpe.encode_ordinary(" " + text)
            fits = all(b"".join(map(side.spelled.__getitem__, ids)) == line for side, ids in ((self.a, a), (self.b, b)))
            found.append((np.array(a, self.dtype), np.array(b, self.dtype), fits))
        return found


@functools.lru_cache(maxsize=2)
def _load(byte_bpe: bytes, model: bytes) -> Tokenizers:
    return Tokenizers(byte_bpe, model)


Open = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Fragment:
    """The open ends of a byte range: ids of A and B; without a common end (``split``) all is prefix.

    ``mark`` is the byte at which the suffix begins; ``ok`` says whether the bytes were those of the text.
    """

    prefix: Open
    suffix: Open
    split: bool
    mark: int
    ok: bool


def _plus(x: Open, y: Open) -> Open:
    return np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, tuple[int, Open] | None]:
    """The fragment of two neighbouring ranges, and the group that closes where they meet, with its first byte.

    Associative; the fragment of an empty range (no tokens, not split) is neutral.
    """
    ok, mark = left.ok and right.ok, right.mark if right.split else left.mark
    if not left.split:
        return Fragment(_plus(left.prefix, right.prefix), right.suffix, right.split, mark, ok), None
    seam = _plus(left.suffix, right.prefix)
    if not right.split:
        return Fragment(left.prefix, seam, True, mark, ok), None
    return Fragment(left.prefix, right.suffix, True, mark, ok), (left.mark, seam)


def fragments(
    a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, at: int, stop: int, chunk: int, ok: bool
) -> Iterator[tuple[int, Fragment, tuple[int, Open] | None]]:
    """First byte, fragment and closed groups (with their first byte) of each ``chunk``-aligned range in (at, stop].

    A token belongs to the range of its last byte.
    """
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    none = (a[:0], b[:0])
    for low in [at, *range(at - at % chunk + chunk, stop, chunk)]:
        high = min(low - low % chunk + chunk, stop)
        cut = lambda lo, hi: (
            a[np.searchsorted(ends_a, lo, "right") : np.searchsorted(ends_a, hi, "right")],
            b[np.searchsorted(ends_b, lo, "right") : np.searchsorted(ends_b, hi, "right")],
        )
        inside = common[np.searchsorted(common, low, "right") : np.searchsorted(common, high, "right")]
        if not len(inside):
            yield low, Fragment(cut(low, high), none, False, 0, ok), None
            continue
        first, last = int(inside[0]), int(inside[-1])
        closed = (first, cut(first, last)) if last > first else None
        yield low, Fragment(cut(low, first), cut(last, high), True, last, ok), closed


def links(vocab: Tokenizers, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of whole groups in a row: the pair b * |A| + a of every link, the last byte of each, ends of A and of B.

    Ranges of A and of B each cover the bytes without gaps, so the links are the bytes at which a token ends.
    """
    ends_a, ends_b = np.cumsum(vocab.a.sizes[a]), np.cumsum(vocab.b.sizes[b])
    marks = np.zeros(ends_a[-1] + 1 if len(a) else 1, np.uint8)
    marks[ends_a] = 1
    marks[ends_b] += 2
    ends = np.flatnonzero(marks)
    of_a, of_b = marks[ends] & 1, marks[ends] >> 1
    ia, ib = (np.cumsum(of, dtype=np.int64) - of for of in (of_a, of_b))  # tokens that end before
    return b[ib].astype(np.int64) * len(vocab.a.sizes) + a[ia], ends, ends_a, ends_b


def spell(vocab: Tokenizers, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The tokens of all groups in the order of their text, each with the sign behind it; the last bytes of groups."""
    marks = np.zeros(ends_a[-1] + 1 if len(a) else 1, np.uint8)
    marks[ends_a] = 1
    last_b = marks[ends_b] == 1
    marks[ends_b] += 2
    last_a = marks[ends_a] == 3
    group_a, group_b = (np.cumsum(last) - last for last in (last_a, last_b))
    before_b = np.append(0, np.flatnonzero(last_b) + 1)[group_a]  # tokens of B in earlier groups
    upto_a = np.append(np.flatnonzero(last_a) + 1, len(a))[group_b]
    parts = np.empty(len(a) + len(b), object)
    parts[np.arange(len(a)) + before_b] = np.where(last_a, vocab.a.last[a], vocab.a.inside[a])
    parts[np.arange(len(b)) + upto_a] = np.where(last_b, vocab.b.last[b], vocab.b.inside[b])
    return parts.tolist(), ends_b[last_b]


class Counts:
    """The corpus-wide counts of id pairs, as sorted hash arrays mapped from the shared folder."""

    def __init__(self, folder: str, files: int):
        self.folder, self.files = folder, files
        self.parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        """Twice the count of each pair, plus one where it is the highest of its B id."""
        found = np.zeros(len(pairs), np.int64)
        file = pairs % self.files
        for f in np.unique(file).tolist():
            if f not in self.parts:
                self.parts[f] = get(self.folder, f"pairs-{f}", np.int64), get(self.folder, f"counts-{f}", np.int64)
            keys, values = self.parts[f]
            mine = np.flatnonzero(file == f)
            spot = np.searchsorted(keys, pairs[mine])
            if (spot >= len(keys)).any() or (keys[spot] != pairs[mine]).any():
                raise ValueError("a pair was not counted")
            found[mine] = values[spot]
        return found


TOKENS = "doc_id long, a binary, b binary"
PARTS = "key long, at long, sealed boolean, a binary, b binary, a2 binary, b2 binary, split boolean, mark long, ok boolean"
KINDS = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
PART_SCHEMA = pa.schema([(n, KINDS[t]) for n, t in map(str.split, PARTS.split(", "))])
SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _part(key: int, at: int, fragment: Fragment) -> dict:
    (a, b), (a2, b2) = fragment.prefix, fragment.suffix
    return {"key": key, "at": at, "sealed": False, "a": a.tobytes(), "b": b.tobytes(), "a2": a2.tobytes(), "b2": b2.tobytes(), "split": fragment.split, "mark": fragment.mark, "ok": fragment.ok}


def _sealed(key: int, at: int, group: Open) -> dict:
    return {"key": key, "at": at, "sealed": True, "a": group[0].tobytes(), "b": group[1].tobytes()}


def _fragment(row: dict, dtype: type) -> Fragment:
    a, b, a2, b2 = (np.frombuffer(row[c], dtype) for c in ("a", "b", "a2", "b2"))
    return Fragment((a, b), (a2, b2), row["split"], row["mark"], row["ok"])


def slabs(line: bytes, size: int) -> Iterator[tuple[int, bytes]]:
    """First byte and bytes of parts of about ``size`` bytes, cut only where both tokenizers end a token."""
    start = 0
    while start < len(line):
        seam = SEAM.search(line, start + size)
        end = seam.start() if seam else len(line)
        yield start, line[start:end]
        start = end


def _tree(parts: DataFrame, longest: int, chunk: int, fan: int, dtype: type) -> tuple[list[DataFrame], DataFrame]:
    """Closed groups of each level of the tree, and the one fragment of each text."""

    def fold(table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns(["block"]).to_pylist(), key=lambda r: r["at"])
        whole, closed = _fragment(rows[0], dtype), []
        for row in rows[1:]:
            whole, seam = compose(whole, _fragment(row, dtype))
            if seam:
                closed.append(_sealed(row["key"], *seam))
        return pa.Table.from_pylist([_part(rows[0]["key"], rows[0]["at"], whole), *closed], PART_SCHEMA)

    done, reach = [parts.filter("sealed")], chunk
    while True:
        reach *= fan
        blocks = parts.filter("not sealed").withColumn("block", F.floor(F.col("at") / reach))
        parts = settle(blocks.groupBy("key", "block").applyInArrow(fold, PARTS), "fragments")
        done.append(parts.filter("sealed"))
        if reach >= longest:
            return done, parts.filter("not sealed")


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_bpe: str = BYTE_BPE,
    pieces: str = PIECES,
    chunk: int = CHUNK,
    fan: int = FAN,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``.

    A encodes a space and the text, B the text; special tokens' strings are plain text. Byte offsets where
    tokens of both end cut them into groups; every A and B token whose bytes overlap are a link. A pair of
    ids counts as many as its links in all documents; ``n_best`` are the links whose pair has the highest
    count of its B id, ``count_sum`` adds up the counts of all links. ``groups_sha256`` is the lower-case
    hex digest of ``a,a|b;a|b,b``. Null or empty texts, and such whose tokens' bytes aren't those of the
    line (a U+2581 in the text), have no tokens: zeros and ''. Repeated rows and ids each give a row and
    count each; a null id stays null. Other columns are not read. An empty table gives an empty result.

    Texts of up to ``chunk`` bytes are encoded and aligned in one pass. Longer ones are cut into slabs where
    both tokenizers end a token, which are encoded by different tasks; their fragments, one for each
    ``chunk`` bytes, are composed by a tree, ``fan`` at a node. What has to be in memory at once is a slab,
    or the longest run of a text without a single space between words, and one group. The counts of pairs
    (at most |A| x |B|) lie in sorted arrays in the shared folder that the tasks map.
    """
    spark = docs.sparkSession
    files = [Path(byte_bpe).read_bytes(), Path(pieces).read_bytes()]
    separable, dtype, width = (known := _load(*files)).separable, known.dtype, len(known.a.sizes)
    shared = [spark.sparkContext.broadcast(f) for f in files]

    def vocab() -> Tokenizers:
        return _load(*(s.value for s in shared))

    def encode_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = vocab()
        for batch in batches:
            for start in range(0, len(batch), TEXTS):
                ids, texts = (c.to_pylist() for c in batch.slice(start, TEXTS).columns)
                found = tokenizers.encode([t or "" for t in texts])
                fits = [ok and bool(t) for t, (_, _, ok) in zip(texts, found, strict=True)]
                a, b = ([x[i].tobytes() if ok else b"" for x, ok in zip(found, fits, strict=True)] for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["doc_id", "a", "b"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                doc_id, key, text = (c[row].as_py() for c in batch.columns)
                line = b" " + text.encode()
                for at, part in slabs(line, 4 * chunk) if separable else [(0, line)]:
                    yield pa.RecordBatch.from_pylist([{"doc_id": doc_id, "key": key, "at": at, "text": part[1:].decode()}], slab_schema)

    slab_schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int64()), ("text", pa.string())])

    def encode_slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = vocab()
        for batch in batches:
            for key, at, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b, ok = tokenizers.encode([text])[0]
                ends_a, ends_b = at + np.cumsum(tokenizers.a.sizes[a]), at + np.cumsum(tokenizers.b.sizes[b])
                stop, rows = at + 1 + len(text.encode()), []
                for low, fragment, closed in fragments(a, b, ends_a, ends_b, at, stop, chunk, ok):
                    rows.append(_part(key, low, fragment))
                    if closed:
                        rows.append(_sealed(key, *closed))
                yield pa.RecordBatch.from_pylist(rows, PART_SCHEMA)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") >= chunk, F.lit(False))
    short = settle(narrow.filter(~is_long).mapInArrow(encode_short, TOKENS), "tokens")
    # The key is fixed by being written; the slabs of one text are then dealt to many tasks.
    numbered = narrow.filter(is_long).withColumn("key", F.monotonically_increasing_id()).select("doc_id", "key", "text")
    cut_up = settle(numbered.mapInArrow(cut, "doc_id long, key long, at long, text string"), "slabs")
    longest = cut_up.agg(F.max(F.col("at") + F.octet_length("text") + 1)).first()[0]
    groups, roots = None, None
    if longest:
        dealt = cut_up.select("key", "at", "text").repartition("key", "at")
        closed, roots = _tree(settle(dealt.mapInArrow(encode_slabs, PARTS), "fragments"), longest, chunk, fan, dtype)
        # The line's first byte and, where its bytes fit, its last are common ends: the root's prefix is a whole group.
        firsts = roots.filter("ok").select("key", F.lit(0).cast("long").alias("at"), "a", "b")
        groups = firsts
        for level in closed:
            groups = groups.unionByName(level.select("key", "at", "a", "b"))
        groups = settle(groups.join(roots.filter("ok").select("key"), "key", "left_semi"), "groups")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, held, n_held = vocab(), [], 0
        for a, b, _ in _batched(batches, dtype):
            pairs, n = np.unique(links(tokenizers, np.concatenate(a), np.concatenate(b))[0], return_counts=True)
            held.append((pairs, n))
            n_held += len(pairs)
            if n_held > COUNTED:
                held = [_added(held)]
                n_held = len(held[0][0])
                if n_held > COUNTED // 2:
                    yield _counted(*held[0])
                    held, n_held = [], 0
        if held:
            yield _counted(*_added(held))

    tokens = short.select("a", "b")
    tokens = tokens if groups is None else tokens.unionByName(groups.select("a", "b"))
    pairs = settle(tokens.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    best = pairs.groupBy(F.expr(f"pair div {width}").alias("id")).agg(F.max("n").alias("most"))
    n_files = max(1, -(-pairs.count() // FILE))
    folder = scratch_path(spark, "pair-counts")

    def file(table: pa.Table) -> pa.Table:
        keys, values = (table[c].to_numpy() for c in ("pair", "value"))
        order = np.argsort(keys)
        name = table["file"][0].as_py()
        put(folder, f"pairs-{name}", keys[order].astype(np.int64))
        put(folder, f"counts-{name}", values[order].astype(np.int64))
        return pa.table({"file": pa.array([name], pa.int64())})

    valued = pairs.withColumn("id", F.expr(f"pair div {width}")).join(best, "id").select(
        F.expr(f"pair % {n_files}").alias("file"), "pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("value")
    )
    valued.groupBy("file").applyInArrow(file, "file long").agg(F.count("*")).first()

    def measure(batches: Iterator[pa.RecordBatch], lead: int) -> Iterator[tuple[list[list], np.ndarray, list[bytes], np.ndarray]]:
        """Leading columns, sums and the spelled groups with the number of their tokens, of some rows at a time."""
        tokenizers, counts = vocab(), Counts(folder, n_files)
        for a, b, rest in _batched(batches, dtype, lead):
            sizes_a, sizes_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
            ids_a, ids_b = np.concatenate(a), np.concatenate(b)
            found, ends, ends_a, ends_b = links(tokenizers, ids_a, ids_b)
            stops = np.append(0, ends_a)[np.cumsum(sizes_a)]
            row = np.searchsorted(stops, ends)
            unique, back = np.unique(found, return_inverse=True)
            values = counts(unique)[back]
            parts, common = spell(tokenizers, ids_a, ids_b, ends_a, ends_b)
            add = lambda rows: np.bincount(rows, minlength=len(a)).astype(np.int64)
            total = np.zeros(len(a), np.int64)
            np.add.at(total, row, values >> 1)
            sums = np.stack([sizes_a, sizes_b, add(np.searchsorted(stops, common)), add(row), add(row[values % 2 == 1]), total])
            yield rest, sums, parts, sizes_a + sizes_b

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), sums, parts, sizes in measure(batches, 1):
            at, digests = 0, []
            for size in sizes.tolist():
                digests.append(hashlib.sha256(b"".join(parts[at : at + size])[:-1]).hexdigest() if size else "")
                at += size
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, sums), pa.array(digests)], ["doc_id", *SUMS, "groups_sha256"])

    def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (keys, ats), sums, parts, sizes in measure(batches, 2):
            stops = np.cumsum(sizes).tolist()
            texts = [b"".join(parts[s - n : s]) for s, n in zip(stops, sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ats, pa.int64()), *map(pa.array, sums), pa.array(texts, pa.binary())], ["key", "at", *SUMS, "groups"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hash the groups of each text in order, one part at a time; the sign behind the last group is left out."""
        now, state, rest = None, None, b""
        for batch in batches:
            for key, groups_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if now is not None:
                        yield _digested(now, state, rest)
                    now, state, rest = key, hashlib.sha256(), b""
                state.update(rest)
                state.update(groups_[:-1])
                rest = groups_[-1:]
        if now is not None:
            yield _digested(now, state, rest)

    sums = ", ".join(f"{s} long" for s in SUMS)
    done = short.mapInArrow(whole, f"doc_id long, {sums}, groups_sha256 string")
    if groups is None:
        return done
    measured = settle(groups.select("key", "at", "a", "b").mapInArrow(by_part, f"key long, at long, {sums}, groups binary"), "measured")
    totals = measured.groupBy("key").agg(*(F.sum(s).alias(s) for s in SUMS))
    ordered = measured.select("key", "at", "groups").repartition("key").sortWithinPartitions("key", "at").select("key", "groups")
    hashed = ordered.mapInArrow(digest, "key long, groups_sha256 string")
    ids = cut_up.filter("at = 0").select("doc_id", "key")
    joined = ids.join(totals, "key", "left").join(hashed, "key", "left")
    return done.unionByName(joined.select("doc_id", *(F.coalesce(s, F.lit(0)).alias(s) for s in SUMS), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))


def _digested(key: int, state, rest: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([state.hexdigest()])], ["key", "groups_sha256"])


def _batched(batches: Iterator[pa.RecordBatch], dtype: type, lead: int = 0) -> Iterator[tuple[list, list, list[list]]]:
    """Ids of A and B of some rows, BATCH tokens or one row at a time, and the leading columns."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            *rest, a, b = (c.to_pylist() for c in batch.slice(at, ROWS).columns)
            a, b = ([np.frombuffer(x, dtype) for x in side] for side in (a, b))
            start, size = 0, 0
            for i in range(len(a)):
                size += len(a[i]) + len(b[i])
                if size >= BATCH or i == len(a) - 1:
                    yield a[start : i + 1], b[start : i + 1], [r[start : i + 1] for r in rest[:lead]]
                    start, size = i + 1, 0


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, back = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
    n = np.zeros(len(pairs), np.int64)
    np.add.at(n, back, np.concatenate([n for _, n in held]))
    return pairs, n


def _counted(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])
