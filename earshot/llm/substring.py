"""Repeated lines and sentences, removed everywhere but at their earliest place."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ends of sentences.
STOP = re.compile(r"[.!?](?=\s)|[。！？｡]+[」』”’）]*")
#: Letters and digits from which a sentence of few words says something about copying.
ENOUGH = 8
#: Words from which any sentence does.
SENTENCE = 5
NO_ID = 2**63 - 1


def _digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words))


def units(text: str, min_words: int | None) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of the lines of a text and of the sentences in lines that have several.

    A line ends before its line feed. A sentence ends after a run of ``.!?`` before white space, or
    after ideographic stops and the quotes that close behind them. Units of fewer than ``min_words``
    words are left out. With None, all lines but blank ones are units, and the sentences of SENTENCE
    words or ENOUGH letters and digits, so that scripts without blanks have sentences too.
    """
    least = 1 if min_words is None else min_words
    start = 0
    for line in text.split("\n"):
        words = line.lower().split()
        if len(words) >= least:
            yield start, start + len(line), _digest(words)
            ends = [stop.end() for stop in STOP.finditer(line)]
            if ends and ends[-1] < len(line):
                ends.append(len(line))
            at = 0
            for end in ends if len(ends) > 1 else ():
                words = line[at:end].lower().split()
                if len(words) >= (min_words or SENTENCE) or (min_words is None and sum(map(str.isalnum, "".join(words))) >= ENOUGH):
                    yield start + at, start + end, _digest(words)
                at = end
        start += len(line) + 1


def _cut(text: str, spans: list[tuple[int, int, int | None]]) -> tuple[str, list[tuple[int, int, int | None]]]:
    """The text without the spans; spans inside others are dropped, a removed line takes its end."""
    outer: list[tuple[int, int, int | None]] = []
    for a, b, keeper in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not outer or b > outer[-1][1]:
            outer.append((a, b, keeper))
    kept, at = [], 0
    for a, b, _ in outer:
        kept.append(text[at:a])
        whole = (a == 0 or text[a - 1] == "\n") and (b == len(text) or text[b] == "\n")
        at = b + 1 if whole and b < len(text) else b
    kept.append(text[at:])
    return "".join(kept), outer


def substring_dedup(
    docs: DataFrame, min_words: int | None = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text without repeated units, n_removed, removed (start, end, kept_in) of each row.

    Units are lines, and sentences of lines with several (see ``units``; with ``min_words`` None, lines
    of any length), compared by a 128-bit digest of their lower-cased words over all documents. The place with the smallest doc_id, then the smallest
    offset, keeps a unit; it goes everywhere else. ``removed`` has the offsets in the original text
    in code points, end exclusive, and the doc_id that keeps the unit (its own, if it repeats
    within the text). A repeated sentence inside a repeated line is not listed again.

    Rows that share a doc_id are copies of one document and get the same decisions. A null doc_id
    ranks after all others; such rows keep their units against each other. A null text stays null
    with nothing removed; an empty text stays empty. Other columns are not read. Empty table: empty
    result.

    Digests are reduced per document, then summed up before and after one shuffle; only digests
    found in more than one document meet the documents' rows again, so a line that a third of all
    documents share costs one row a document. Digests are computed again for the second meeting: that
    costs less than to store them.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                ids, found = [], []
                for row in batch.slice(at, 64).to_pylist():
                    own = {digest for _, _, digest in units(row["text"] or "", min_words)}
                    found.extend(own)
                    ids.extend([NO_ID if row["doc_id"] is None else row["doc_id"]] * len(own))
                halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])), pa.array(ids, pa.int64())],
                    ["high", "low", "doc"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                yield _cut_rows(batch.slice(at, 64).to_pylist(), min_words)

    held = narrow.mapInArrow(digests, "high long, low long, doc long")
    keepers = (
        held.groupBy("high", "low")
        .agg(F.min("doc").alias("keeper"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    gone = (
        held.join(keepers, ["high", "low"])
        .filter("doc > keeper")
        .distinct()
        .groupBy("doc")
        .agg(F.collect_list(F.struct("high", "low", "keeper")).alias("gone"))
    )
    joined = narrow.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID))).join(gone, "doc", "left")
    return joined.select("doc_id", "text", "gone").mapInArrow(
        cut,
        "doc_id long, text string, n_removed int, removed array<struct<start:int,end:int,kept_in:long>>",
    )


def _cut_rows(rows: list[dict], min_words: int | None) -> pa.RecordBatch:
    out: dict[str, list] = {"doc_id": [], "text": [], "n_removed": [], "removed": []}
    for row in rows:
        text, spans = row["text"], []
        elsewhere = {
            np.array([g["high"], g["low"]]).tobytes(): g["keeper"] for g in row["gone"] or ()
        }
        seen: set[bytes] = set()
        for a, b, digest in units(text or "", min_words):
            if digest in elsewhere:
                spans.append((a, b, elsewhere[digest]))
            elif digest in seen:
                spans.append((a, b, row["doc_id"]))
            seen.add(digest)
        if spans:
            text, spans = _cut(text, spans)
        out["doc_id"].append(row["doc_id"])
        out["text"].append(text)
        out["n_removed"].append(len(spans))
        out["removed"].append([{"start": a, "end": b, "kept_in": k} for a, b, k in spans])
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kept_in", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(out["doc_id"], pa.int64()),
            pa.array(out["text"], pa.string()),
            pa.array(out["n_removed"], pa.int32()),
            pa.array(out["removed"], pa.list_(span)),
        ],
        list(out),
    )
