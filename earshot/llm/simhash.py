"""Near-duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import settle, slabs
from earshot.llm.components import components

HALF = 32
#: Fingerprints in one cell up to which its pairs are compared one by one.
CELL = 256


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the shingles' XXH64, as an unsigned number; 0 without words."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for slab in slabs(text.lower()):
        words = tail + slab.split()
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        count = max(0, len(words) - shingle + 1)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, count)
        for start in range(0, count, 1 << 14):
            part = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += count
        tail = words[len(words) - min(len(words), shingle - 1) :] if shingle > 1 else []
    if not total:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), seed)
    bits = (2 * ones > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, fp): ``fp`` has the fingerprint's 64 bits as a signed long, ``row`` is a hash of the text.

    A null text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            found = np.fromiter(
                (fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "row", "fp"]
            )

    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row(text).alias("row"), text.alias("text"))
    return narrow.mapInArrow(run, "doc_id long, row long, fp long")


def _row(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _segment(fp: Column, which: int) -> Column:
    """The lower (0) or upper (1) half as a non-negative long."""
    return fp.bitwiseAND(F.lit((1 << HALF) - 1)) if which == 0 else F.shiftrightunsigned(fp, HALF)


def _flips(bits: int) -> list[int]:
    """All masks over a half with exactly ``bits`` bits set."""
    return [sum(1 << i for i in chosen) for chosen in combinations(range(HALF), bits)]


def _array(values: list[int]) -> Column:
    return F.expr("array(" + ",".join(f"{v}L" for v in values) + ")")


def hamming_links(prints: DataFrame, cell_size: int = CELL) -> DataFrame:
    """Links (u, v) that connect exactly the distinct fingerprints ``fp`` at 3 or fewer bits.

    Two halves share at most three differing bits, so one half differs in one bit or none.
    Every fingerprint is filed under both halves (residents) and looks into the cells of the
    halves one bit away (visitors, only from a cleared bit to a set one, so each pair meets
    once). A pair in a cell is verified on all 64 bits.

    A cell with more than ``cell_size`` residents is not paired off. There, points of the other
    half stand between its fingerprints: two residents are linked exactly if some point is within
    one bit of one and two of the other, a resident and a visitor if some point is within one bit
    of both. At each point all are linked to its smallest near resident. A fingerprint then costs
    a fixed number of rows, and a point holds at most 33 + 496 + 32 * 33 fingerprints.
    """
    homes, visits = [], []
    for which in (0, 1):
        own = _segment(F.col("fp"), which)
        homes.append(prints.select(F.lit(which).alias("seg"), own.alias("cell"), "fp"))
        cells = F.filter(F.transform(_array(_flips(1)), lambda m: own.bitwiseOR(m)), lambda c: c != own)
        visits.append(prints.select(F.lit(which).alias("seg"), F.explode(cells).alias("cell"), "fp"))
    homes, visits = homes[0].unionByName(homes[1]), visits[0].unionByName(visits[1])
    crowds = settle(homes.groupBy("seg", "cell").agg(F.count("*").alias("n")).filter(F.col("n") > cell_size), "cells")
    calm = homes.join(crowds, ["seg", "cell"], "left_anti").withColumnRenamed("fp", "v")
    guests = visits.withColumn("own", F.lit(False)).unionByName(homes.withColumn("own", F.lit(True)))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= 3
    paired = (
        guests.join(calm, ["seg", "cell"])
        .filter(near & (~F.col("own") | (F.col("fp") < F.col("v"))))
        .select(F.col("fp").alias("u"), "v")
    )

    other = F.when(F.col("seg") == 0, _segment(F.col("fp"), 1)).otherwise(_segment(F.col("fp"), 0))
    one, two = [0, *_flips(1)], _flips(2)
    points = lambda df, masks, inner: df.select(
        "seg",
        "cell",
        F.explode(F.transform(_array(masks), lambda m: other.bitwiseXOR(m))).alias("point"),
        F.when(F.lit(inner), F.col("fp")).alias("near"),
        "fp",
    )
    inside = homes.join(crowds.drop("n"), ["seg", "cell"], "left_semi")
    outside = visits.join(crowds.drop("n"), ["seg", "cell"], "left_semi")
    met = points(inside, one, True).unionByName(points(inside, two, False)).unionByName(points(outside, one, False))
    starred = (
        met.groupBy("seg", "cell", "point")
        .agg(F.min("near").alias("u"), F.collect_set("fp").alias("all"))
        .filter(F.col("u").isNotNull() & (F.size("all") > 1))
        .select("u", F.explode("all").alias("v"))
        .filter("u <> v")
    )
    return paired.unionByName(starred.distinct())


def _grouped(docs: DataFrame, shingle: int, cell_size: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, fp, root) of every row; ``root`` is the smallest fingerprint of its component."""
    prints = settle(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = settle(prints.select("fp").distinct(), "distinct")
    roots = components(hamming_links(distinct, cell_size)).withColumnRenamed("node", "fp")
    return prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_groups(
    docs: DataFrame, shingle: int = 3, cell_size: int = CELL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Texts whose fingerprints differ in 3 bits or fewer are linked; the component is the smallest
    doc_id reachable over links. Only distinct fingerprints are compared, so a group of exact
    copies costs one node however large it is. Texts are lower-cased over A-Z and split at ASCII
    white space; with fewer words than a shingle the whole sequence is one; null, empty and blank
    texts have fingerprint zero and are linked like any other. Repeated rows stay, each with the
    same result; a null doc_id stays and never names a component unless it has no other member.
    Other columns are not read. An empty table gives an empty result.
    """
    rooted = _grouped(docs, shingle, cell_size, id_col, text_col)
    names = settle(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "names")
    return rooted.join(names, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``simhash_groups``: that with the smallest doc_id.

    Of rows that share the id, one with the smallest hash of the text stays; null ids come last. Columns
    stay as they are.
    """
    rooted = _grouped(docs, shingle, CELL, id_col, text_col)
    last = F.lit(2**63 - 1)
    # Two steps of plain minima, which sum up before the shuffle, in place of one over pairs.
    numbered = settle(rooted.select(F.coalesce("doc_id", last).alias("_id"), "row", "root"), "members")
    least = numbered.groupBy("root").agg(F.min("_id").alias("_id"))
    kept = settle(numbered.join(least, ["root", "_id"]).groupBy("root", "_id").agg(F.min("row").alias("_row")), "kept")
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), last).alias("_id"),
        _row(F.col(text_col).cast("string")).alias("_row"),
        F.struct("*").alias("_doc"),
    )
    chosen = keyed.join(kept.select("_id", "_row"), ["_id", "_row"], "left_semi")
    n_rows = numbered.join(kept, (F.col("row") == F.col("_row")) & (numbered["_id"] == kept["_id"]), "left_semi").count()
    if n_rows > kept.count():  # whole rows repeat
        chosen = chosen.dropDuplicates(["_id", "_row"])
    return chosen.select("_doc.*")
