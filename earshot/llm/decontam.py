"""Benchmark decontamination by template windows with consistent slots."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import settle

# Unit words and the lower-case words of number expressions.
UNITS = frozenset("""
mm cm m km in inch inches ft feet foot yd yard yards mile miles mg g kg lb lbs pound pounds oz ounce ounces
ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week
weeks month months year years usd eur gbp dollar dollars euro euros cent cents percent degree degrees
""".split())
NUMBERS = frozenset("""
one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen
nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
""".split())
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"

STOPS, SIGNS, QUOTES, POINT, JOINTS = ".!?\n", "%$€£°", "'’", ".", ",:/"

#: Tokens of a window; the share of an item's windows that marks a document; the least share of its
#: slot values that must be consistent.
WINDOW, COVER, CONSISTENT = 8, 0.5, 0.8
#: Bits of the filter that goes to every worker: 1 MB, whatever the benchmark's size.
FILTER_BITS = 1 << 23
#: Characters that are read together: short texts are joined up to it, longer ones cut at blanks.
TOGETHER = 1 << 16


def template(token: str, opening: bool) -> str:
    """The template of one token, as ``read_all`` gives it for whole texts.

    Digits and number words are ``<num>``; unit words and signs are ``<unit>``; a word with a capital
    and small letters after it that doesn't begin a sentence is ``<name>``. Other words stand for
    themselves in lower case, as does any word that begins a sentence or is in capitals
    throughout, since its capital tells nothing.
    """
    low = token.lower()
    if token[0].isdigit() or low in NUMBERS:
        return NUM
    if token in SIGNS or low in UNITS:
        return UNIT
    return NAME if token.istitle() and len(token) > 1 and not opening else low


NUM_HASH, NAME_HASH, UNIT_HASH = (np.uint64(xxhash.xxh64_intdigest(t)) for t in (NUM, NAME, UNIT))
PLACEHOLDERS = frozenset(map(int, (NUM_HASH, NAME_HASH, UNIT_HASH)))
#: Kinds of characters; quotes between letters and points or joints between digits become part of the token.
OTHER, LETTER, DIGIT, QUOTED, POINTED, JOINED, STOP, SIGN = range(8)
MULTIPLIER = 0x9E3779B97F4A7C15


@cache
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its kind, its lower case, its case (1 upper, 2 lower), whether it counts as a digit."""
    every = "".join(map(chr, range(0x110000)))
    kind = np.zeros(len(every), np.uint8)
    for pattern, code in ((r"[^\W\d_]+", LETTER), (r"\d+", DIGIT)):
        for found in re.finditer(pattern, every):
            kind[found.start() : found.end()] = code
    for signs, code in ((QUOTES, QUOTED), (JOINTS, JOINED), (STOPS, STOP), (POINT, POINTED), (SIGNS, SIGN)):
        kind[list(map(ord, signs))] = code
    lower, case, digit = np.arange(len(every), dtype=np.uint64), np.zeros(len(every), np.uint8), kind == DIGIT
    for number, char in enumerate(every[:0x20000]):  # no letter beyond has two cases
        if char.isalnum():
            small = char.lower()
            lower[number] = ord(small) if len(small) == 1 else number
            case[number] = 1 if char.istitle() else 2 if char.islower() else 0
            digit[number] |= char.isdigit()
    return kind, lower, case, digit


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of MULTIPLIER and of its inverse modulo 2**64."""
    out = []
    for factor in (MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64)):
        powers = np.full(size, factor, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


def _cut(text: str) -> tuple[np.ndarray, ...]:
    """Code points and kinds of characters, starts, ends and word hashes (in lower case) of all tokens.

    A token is a word with quotes between its letters, a number with points and joints between its
    digits, or one sign or end of a sentence.
    """
    kinds, lower, _, _ = _characters()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    kind = np.zeros(n + 2, np.uint8)
    kind[1:-1] = kinds[points]
    for code, within, alone in ((QUOTED, LETTER, OTHER), (POINTED, DIGIT, STOP), (JOINED, DIGIT, OTHER)):
        at = np.flatnonzero(kind == code)
        kind[at] = np.where((kind[at - 1] == within) & (kind[at + 1] == within), within, alone)
    change, inner = kind[1:] != kind[:-1], kind[1:-1]
    single, some = inner >= STOP, inner != OTHER
    starts, ends = np.flatnonzero(some & (change[:-1] | single)), np.flatnonzero(some & (change[1:] | single)) + 1
    powers, inverse = _powers(max(TOGETHER, 1 << n.bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((lower[points] + np.uint64(1)) * powers[:n], out=sums[1:])
    words = (sums[ends] - sums[starts]) * inverse[starts]
    words = (words ^ (words >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return points, inner, starts, ends, words ^ (words >> np.uint64(29))


@cache
def _fixed_words() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of number and unit words in order, and the placeholder of each."""
    found = sorted((int(_cut(w)[4][0]), NUM_HASH if w in NUMBERS else UNIT_HASH) for w in NUMBERS | UNITS)
    return tuple(np.array(column, np.uint64) for column in zip(*found, strict=True))


def _scan(text: str) -> tuple[np.ndarray, ...]:
    """Of all tokens: starts, ends, whether they end sentences, template hashes at a beginning and inside, word hashes."""
    points, kind, starts, ends, words = _cut(text)
    if not len(starts):
        return starts, ends, np.zeros(0, bool), words, words, words
    _, _, cases, digits = _characters()
    case, token = cases[points], kind[starts]
    cased = np.zeros(len(points), bool)
    cased[1:] = case[:-1] > 0
    cased[starts] = False
    odd, capital = np.zeros((2, len(points) + 1), np.int32)
    np.cumsum(((case == 1) & cased) | ((case == 2) & ~cased), out=odd[1:])
    np.cumsum(case == 1, out=capital[1:])
    name = (token == LETTER) & (ends - starts > 1) & (odd[ends] == odd[starts]) & (capital[ends] > capital[starts])
    known, meaning = _fixed_words()
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    opening = np.where((token == LETTER) & (known[at] == words), meaning[at], words)
    opening = np.where(digits[points[starts]], NUM_HASH, np.where(token == SIGN, UNIT_HASH, opening))
    inside = np.where(name & (opening == words), NAME_HASH, opening)
    return starts, ends, token == STOP, opening, inside, words


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """A text cut at blanks, where no token crosses, with the offsets of the parts."""
    begin = 0
    while len(text) - begin > TOGETHER:
        end = text.rfind(" ", begin, begin + TOGETHER) + 1 or text.find(" ", begin + TOGETHER) + 1 or len(text)
        yield begin, text[begin:end]
        begin = end
    yield begin, text[begin:]


class Tokens:
    """The tokens of a text in lower case, cut when asked for."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, place: int) -> str:
        return self.text[self.starts[place] : self.ends[place]].lower()


class Templates:
    """Reads texts as tokens and template hashes."""

    def read(self, text: str) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All tokens of a text, the places of those that don't end sentences, and three hashes of these.

        First the template, then that with words that begin sentences as inside one, then the word itself.
        """
        return next(self.read_all([text]))

    def read_all(self, texts: Iterable[str]) -> Iterator[tuple[Tokens, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``read`` of each text; short ones are scanned together."""
        group, size = [], 0
        for text in texts:
            if group and size + len(text) >= TOGETHER:
                yield from self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text) + 1
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[tuple]:
        """Texts one after the other, each followed by a line end, which no token holds."""
        joined = "".join(f"{t}\n" for t in texts)
        parts = [(begin, _scan(part)) for begin, part in _pieces(joined)]
        columns = [np.concatenate(c) for c in zip(*((b + s, b + e, *rest) for b, (s, e, *rest) in parts), strict=True)]
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        tokens = np.searchsorted(columns[0], bounds)
        for text, begin, a, b in zip(texts, bounds[:-1].tolist(), tokens[:-1].tolist(), (tokens[1:] - 1).tolist(), strict=True):
            starts, ends, stop, opening, inside, words = (c[a:b] for c in columns)
            begins = np.concatenate([[True], stop[:-1]])
            kept = np.flatnonzero(~stop)
            yield Tokens(text, starts - begin, ends - begin), kept, np.where(begins, opening, inside)[kept], inside[kept], words[kept]


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * np.uint64(MULTIPLIER)
    out += right
    out ^= out >> np.uint64(29)
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` template hashes, put together from runs of 1, 2, 4, ..."""
    total, done, block, size = None, 0, hashes, 1
    while True:
        if width & size:
            n = max(0, len(hashes) - done - size + 1)
            total = block[:n] if total is None else _joined(total[:n], block[done : done + n])
            done += size
        if done == width:
            return total
        block = _joined(block[:-size], block[size:])
        size *= 2


class Reading:
    """A text as template hashes of tokens, or of runs of tokens that share one slot.

    ``starts`` are the places of the runs among the text's tokens, with the number of tokens at the end.
    """

    def __init__(self, found: Tokens, kept: np.ndarray, hashes: np.ndarray, words: np.ndarray, starts: np.ndarray):
        self.found, self.kept, self.words, self.starts = found, kept, words, starts
        self.hashes = hashes[starts[:-1]]

    def windows(self, at: np.ndarray, width: int) -> np.ndarray:
        """Hashes of the windows at some places.

        A window of one placeholder throughout, as in a table of numbers, tells nothing as a template: it
        stands for its words.
        """
        out = window_hashes(self.hashes, width)[at]
        alike = self.hashes[1:] == self.hashes[:-1]
        if np.count_nonzero(alike) >= width - 1:
            slot = (self.hashes == NUM_HASH) | (self.hashes == NAME_HASH) | (self.hashes == UNIT_HASH)
            runs = np.concatenate([[0], np.cumsum(alike)])
            plain = np.flatnonzero(slot[at] & (runs[at + width - 1] - runs[at] == width - 1))
            if len(plain):
                words = np.add.reduceat(self.words, self.starts[:-1])
                out[plain] = ~window_hashes(words, width)[at[plain]]
        return out

    def slots(self, at: int, width: int) -> list[str]:
        """What the placeholders of a window stand for, in order."""
        starts = self.starts[at : at + width + 1].tolist()
        return [
            " ".join(self.found[place] for place in self.kept[a:b].tolist())
            for a, b, h in zip(starts[:-1], starts[1:], self.hashes[at : at + width].tolist(), strict=True)
            if h in PLACEHOLDERS
        ]

    def touched(self, places: np.ndarray, width: int) -> np.ndarray:
        """The windows that hold a marked place."""
        sums = np.concatenate([[0], np.cumsum(places)])[self.starts]
        return np.flatnonzero(sums[width:] > sums[:-width])


def readings(
    found: Tokens, kept: np.ndarray, hashes: np.ndarray, named: np.ndarray, words: np.ndarray
) -> tuple[list[tuple[Reading, np.ndarray | None]], np.ndarray]:
    """The readings of a text, each with the places where it differs from those before, and slot numbers.

    First token by token; then with each run of names and each run of numbers in a sentence as one
    slot; then with words with a capital that begin a sentence as names too. Slot numbers tell for
    each token its run of the last reading, so that windows of all readings share alignments.
    """
    out = [(Reading(found, kept, hashes, words, np.arange(len(kept) + 1)), None)]
    close = np.diff(kept) == 1
    before, starts = np.zeros(max(0, len(kept) - 1), bool), out[0][0].starts
    for last in ((hashes, named) if (hashes != named).any() else (hashes,)):
        joined = close & (last[1:] == last[:-1]) & ((last[1:] == NAME_HASH) | (last[1:] == NUM_HASH))
        starts = np.concatenate([[0], np.flatnonzero(~joined) + 1, [len(kept)]]) if len(kept) else out[0][0].starts
        new = joined & ~before
        marked = np.concatenate([new, [False]]) | np.concatenate([[False], new]) if len(kept) else np.zeros(0, bool)
        if last is named:
            marked = marked | (hashes != named)
        if marked.any():
            out.append((Reading(found, kept, last, words, starts), marked))
        before = joined
    number = np.zeros(len(kept), np.int64)
    number[starts[1:-1]] = 1
    return out, np.cumsum(number)


def windows(read: tuple, size: int, whole: int) -> Iterator[tuple[Reading, np.ndarray, np.ndarray, np.ndarray]]:
    """(reading, its windows of ``size``, their hashes, their slot numbers) of a text.

    Runs are read as one in windows of ``whole`` only: less would be a slot and hardly a word.
    """
    all_readings, number = read
    for reading, marked in all_readings:
        if len(reading.hashes) < size or (marked is not None and size < whole):
            continue
        at = np.arange(len(reading.hashes) - size + 1) if marked is None else reading.touched(marked, size)
        if len(at):
            yield reading, at, reading.windows(at, size), number[reading.starts[at]]


def _amid(tokens: tuple, width: int) -> Iterator[tuple[Reading, np.ndarray, np.ndarray, np.ndarray]]:
    """The first window of an item whose first word reads otherwise inside a sentence, read so."""
    found, kept, hashes, named, words = tokens
    if hashes[0] != named[0]:
        reading = Reading(found, kept, np.concatenate([named[:1], hashes[1:]]), words, np.arange(len(kept) + 1))
        at = np.zeros(1, np.int64)
        yield reading, at, reading.windows(at, width), at


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(hash, width, item_id, part, slot, ranks, totals, told, item_slots) of every window of every item with words.

    ``slot`` is the slot number of a window's first token. ``totals`` has the number of windows of each
    reading of the item, ``ranks`` the number, if any, of each reading's window that begins there.
    ``part`` tells different texts of one id apart. ``told`` says whether the window is enough to know an
    item with other values by: a short one needs two different names or numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            rows = []
            texts = (text.as_py() or "" for text in batch.column(2))
            for item, part, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), templates.read_all(texts), strict=True):
                read = readings(*tokens)
                width = min(size, len(read[0][0][0].hashes))
                if not width:
                    continue
                used = [r for r, marked in read[0] if marked is None or (width == size and len(r.hashes) >= size)]
                begins = [r.starts[: len(r.hashes) - width + 1] for r in used]
                totals = [len(b) for b in begins]
                begins = [dict(zip(b.tolist(), range(len(b)), strict=True)) for b in begins]
                for reading, at, runs, number in (*windows(read, width, size), *_amid(tokens, width)):
                    for i, h, slot in zip(at.tolist(), runs.view(np.int64).tolist(), number.tolist(), strict=True):
                        place = int(reading.starts[i])
                        ranks = [b.get(place) for b in begins]
                        values = reading.slots(i, width)
                        told = width == size or len({v for v in values if v not in UNITS and v not in SIGNS}) > 1
                        rows.append((h, width, item, part, slot, ranks, totals, told, values))
            yield _table(rows, ["hash", "width", "item_id", "part", "slot", "ranks", "totals", "told", "item_slots"])

    narrow = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.distinct().select("item_id", F.xxhash64("text").alias("part"), "text").mapInArrow(
        run,
        "hash long, width int, item_id long, part long, slot int, ranks array<int>, totals array<int>, told boolean, item_slots array<string>",
    )


TYPES = {
    **dict.fromkeys(("hash", "item_id", "part", "doc_id", "text_hash"), pa.int64()),
    **dict.fromkeys(("width", "slot", "at"), pa.int32()),
    "told": pa.bool_(),
    **dict.fromkeys(("ranks", "totals"), pa.list_(pa.int32())),
    **dict.fromkeys(("item_slots", "doc_slots"), pa.list_(pa.string())),
}


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, TYPES[n]) for c, n in zip(columns, names, strict=True)], names)


def _sieve(items: DataFrame, bits: int) -> bytes:
    """A one-hash Bloom filter of the items' windows; at most ``bits`` / 8 set bytes are gathered."""
    cell = F.pmod(F.col("hash"), F.lit(bits))
    octets = items.groupBy(F.shiftright(cell, 3).cast("int").alias("octet")).agg(
        F.bit_or(F.expr(f"shiftleft(1, int(pmod(hash, {bits}) % 8))")).alias("set")
    )
    found, out = octets.toPandas(), np.zeros(bits // 8, np.uint8)
    out[found["octet"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64)
    return out.tobytes()


def _passing(docs: DataFrame, sieve: bytes, widths: list[int], size: int) -> DataFrame:
    """(doc_id, text_hash, hash, at, doc_slots) of the documents' windows that pass the filter; ``at`` is a slot number."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, templates = np.frombuffer(shared.value, np.uint8), Templates()
        cells = np.uint64(8 * len(bitmap) - 1)
        for batch in batches:
            ids, prints = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, tokens in enumerate(templates.read_all(text.as_py() for text in batch.column(2))):
                read = readings(*tokens)
                rows = {}  # windows of one run that read the same are one row
                for reading, places, runs, number, width in (w + (width,) for width in widths for w in windows(read, width, size)):
                    cell = runs & cells
                    passed = np.flatnonzero(bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1)
                    for i, at, h in zip(places[passed].tolist(), number[passed].tolist(), runs[passed].view(np.int64).tolist(), strict=True):
                        rows[ids[row], prints[row], h, at, tuple(reading.slots(i, width))] = None
                if rows:
                    yield _table(list(rows), ["doc_id", "text_hash", "hash", "at", "doc_slots"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, hash long, at int, doc_slots array<string>")


def _matched(places: str, reading: Column, size: int) -> Column:
    """How many of a reading's windows match, with those that one other, missing or added token breaks.

    Such a token takes ``size`` windows at most, and what follows moves by one slot at most.
    """
    ranked = F.transform(places, lambda p: F.struct(p["ranks"][reading].alias("rank"), p["offset"].alias("offset")))

    def step(state: Column, x: Column) -> Column:
        gap = x["rank"] - state["rank"]
        bridged = (gap <= size + 1) & (F.abs(x["offset"] - state["offset"]) <= 1)
        n = state["n"] + F.when((gap == 0) | bridged, gap).otherwise(1)
        return F.struct(x["rank"].alias("rank"), x["offset"].alias("offset"), F.coalesce(n, state["n"] + 1).alias("n"))

    none = F.lit(None).cast("int")
    start = F.struct(none.alias("rank"), F.lit(None).cast("int").alias("offset"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort(F.filter(ranked, lambda p: p["rank"].isNotNull())), start, step, lambda s: s["n"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    cover: float = COVER,
    consistent: float = CONSISTENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text_hash, item_id, matched, total, share: the documents that hold an item.

    Both sides become templates (see ``Templates``) and are cut into windows of ``size`` tokens, which
    are joined by a 64-bit hash. Matches of a document and an item are checked per alignment: the
    values that placeholders stand for must map one to one, in ``consistent`` of the pairs at least, so
    that re-parameterised questions match and texts of merely equal shape don't; where they don't, windows
    whose placeholders stand for the very same texts still count. A window of one kind of placeholder
    throughout stands for its words. Texts are read token by
    token, with runs of names or numbers as one slot, and with words that begin sentences as names (see
    ``readings``). A document holds an item if ``cover`` of the item's windows, of any one reading,
    begin where windows match in consistent alignments, or in a gap between such places that one token
    makes (see ``_matched``). An item shorter than a window is one window of all its tokens, searched as
    such; with fewer than two different names or numbers only copies of it count. The first word of an item is
    read as at the beginning of a sentence and as inside one.

    A document's windows first pass a filter of FILTER_BITS bits, which alone goes to all workers;
    what passes is joined to the items. Rows equal in id and text count once. All
    texts of items that share an id are searched, as are those of items with a null id, which count as one id;
    the text with the largest share tells the result. Null texts and null document ids are legal; items
    without words match nothing. Very long texts are scanned in parts of TOGETHER characters. Other columns are not read. Empty tables give an empty result.
    """
    items = settle(benchmark_windows(benchmark, size), "items")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # ``size`` at most
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    passing = settle(_passing(narrow, _sieve(items, FILTER_BITS), widths, size), "windows")
    pair = F.transform(F.arrays_zip("item_slots", "doc_slots"), lambda p: F.struct(p["item_slots"], p["doc_slots"]))
    equal = F.col("item_slots") == F.col("doc_slots")
    aligned = (
        passing.join(items, "hash")
        .filter(equal | (F.col("told") & (F.size("item_slots") == F.size("doc_slots"))))
        .withColumn("pairs", F.array_distinct(pair))
        .groupBy("doc_id", "text_hash", "item_id", "part", "totals", (F.col("at") - F.col("slot")).alias("offset"))
        .agg(
            F.collect_set("ranks").alias("ranks"),
            F.collect_set(F.when(equal, F.col("ranks"))).alias("copied"),
            F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        )
    )
    distinct = lambda side: F.size(F.array_distinct(F.transform("pairs", lambda p: p[side])))
    fits = F.least(distinct("item_slots"), distinct("doc_slots")) >= consistent * F.size("pairs")
    reading = F.sequence(F.lit(0), F.size("totals") - 1)
    count = F.transform(reading, lambda r: _matched("places", r, size))
    best = F.array_max(F.zip_with(count, "totals", lambda m, t: F.struct((m / t).alias("share"), m.alias("matched"), t.alias("total"))))
    return (
        aligned.withColumn("ranks", F.when(fits, F.col("ranks")).otherwise(F.col("copied")))
        .groupBy("doc_id", "text_hash", "item_id", "part", "totals")
        .agg(F.flatten(F.collect_list(F.transform("ranks", lambda r: F.struct(r.alias("ranks"), F.col("offset"))))).alias("places"))
        .withColumn("best", best)
        .filter(F.col("best.share") >= cover)
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max("best").alias("best"))
        .select("doc_id", "text_hash", "item_id", "best.matched", "best.total", "best.share")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: float) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows and columns otherwise as they are."""
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **limits)
    least = F.lit(-(2**63))
    gone = found.select(F.coalesce("doc_id", least).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    gone = settle(gone, "contaminated")
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), least).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_hash"),
        F.struct("*").alias("_doc"),
    )
    return keyed.join(gone, ["_id", "_hash"], "left_anti").select("_doc.*")
