"""Token counts of the sections of a text, from one encoding of the whole text."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts are split before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("most", "first", "last")
#: Rows of one result batch of a task.
ROWS = 50_000


@functools.lru_cache(maxsize=2)
def encoder(ranks: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a rank file and the number of bytes of each token."""
    pieces = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    sizes = np.zeros(max(pieces.values()) + 1, np.int64)
    for piece, rank in pieces.items():
        sizes[rank] = len(piece)
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=pieces, special_tokens={}), sizes


def line_ends(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the lines in code points and in UTF-8 bytes; a line feed ends its own line.

    A text has at least one line; nothing after a final line feed is no further line.
    """
    lines = re.findall(r"[^\n]*\n|[^\n]+$", text) or [""]
    chars = np.cumsum([len(line) for line in lines])
    return chars, chars if text.isascii() else np.cumsum([len(line.encode()) for line in lines])


def attribute(sizes: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many crossed a boundary.

    ``sizes``: bytes of the consecutive tokens; ``ends``: ends of the consecutive sections in
    bytes. Token intervals are joined to section intervals by binary search on their ends. A token
    inside a section belongs to it. One that crosses goes whole to the section of its ``first``
    byte, of its ``last`` byte, or to that with ``most`` of its bytes, the earliest of equals.
    """
    stops = np.cumsum(sizes)
    starts = stops - sizes
    first = np.searchsorted(ends, starts, side="right")
    last = np.searchsorted(ends, stops - 1, side="right")
    owner = last if rule == "last" else first
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        for t in crossing:
            inner = np.arange(first[t], last[t] + 1)
            begins = np.concatenate([[starts[t]], ends[inner[:-1]]])
            shares = np.minimum(ends[inner], stops[t]) - np.maximum(begins, starts[t])
            owner[t] = inner[np.argmax(shares)]
    return np.bincount(owner, minlength=len(ends)), len(crossing)


def _encode(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    return np.array(encoding.encode_ordinary(text), np.int64)


def token_counts(
    docs: DataFrame,
    fields: tuple[str, ...] = ("text",),
    split_lines: bool = True,
    rule: str = "most",
    id_col: str = "doc_id",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """doc_id, field, section, start, end, n_tokens: one row per section of each document.

    The ``fields`` of a row, each but the last followed by a line feed, are one text, encoded once.
    Its sections are the fields or, with ``split_lines``, their lines; a line feed belongs to the
    section it ends. ``start`` and ``end`` (exclusive) are code points of that text, ``section``
    counts from 0 within the row. The counts of a row add up to the tokens of its whole text; a
    token that crosses sections is allocated by ``rule`` (see ``attribute``).

    A null field is empty; an empty field is one section without characters (its own line feed
    apart). Repeated rows and null ids are kept, each row by itself. Other columns are not read.
    ``vocabulary`` is a rank file; its bytes, of a size fixed by the file, reach the executors as a
    broadcast variable. Texts are encoded one at a time, nothing is shuffled.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ranks = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    names = np.array(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = encoder(ranks.value)
        columns: list[list[np.ndarray]] = [[], [], [], [], [], []]
        held = 0
        for batch in batches:
            for at in range(len(batch)):
                doc_id, *parts = (column[at].as_py() for column in batch.columns)
                texts = [(part or "") + ("\n" if i < len(fields) - 1 else "") for i, part in enumerate(parts)]
                chars, octets, owner = _sections(texts, split_lines)
                tokens = _encode(encoding, "".join(texts))
                counts, _ = attribute(sizes[tokens], octets, rule)
                begins = np.concatenate([[0], chars[:-1]])
                ids = np.ma.masked_all(len(chars), np.int64) if doc_id is None else np.full(len(chars), doc_id)
                for column, values in zip(
                    columns, (ids, owner, np.arange(len(chars)), begins, chars, counts), strict=True
                ):
                    column.append(values)
                held += len(chars)
                if held >= ROWS:
                    yield _batch(columns, names)
                    columns, held = [[], [], [], [], [], []], 0
        if held:
            yield _batch(columns, names)

    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields))
    )
    return narrow.mapInArrow(run, "doc_id long, field string, section int, start int, end int, n_tokens int")


def _sections(texts: list[str], split_lines: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends in code points and bytes of the sections of all fields, and each one's field."""
    chars, octets, owner, at_char, at_byte = [], [], [], 0, 0
    for i, text in enumerate(texts):
        if split_lines:
            c, b = line_ends(text)
        else:
            c, b = np.array([len(text)]), np.array([len(text.encode())])
        chars.append(c + at_char)
        octets.append(b + at_byte)
        owner.append(np.full(len(c), i))
        at_char, at_byte = chars[-1][-1], octets[-1][-1]
    return np.concatenate(chars), np.concatenate(octets), np.concatenate(owner)


def _batch(columns: list[list[np.ndarray]], names: np.ndarray) -> pa.RecordBatch:
    ids = np.ma.concatenate(columns[0])
    field, *rest = (np.concatenate(c) for c in columns[1:])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.ma.getdata(ids), pa.int64(), mask=np.ma.getmaskarray(ids)),
            pa.array(names[field]),
            *(pa.array(c.astype(np.int32)) for c in rest),
        ],
        ["doc_id", "field", "section", "start", "end", "n_tokens"],
    )
