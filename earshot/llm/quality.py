"""Text quality by positive-unlabelled learning with the non-negative risk."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import fold, settle

#: Byte classes whose shares are features: capital, small, digit, blank, line feed, stop, other
#: marks, symbols, control, beyond ASCII.
CLASSES = np.full(256, 9, np.uint8)
CLASSES[:32] = CLASSES[127] = 8
for _number, _members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r", b".,", b"!?;:'\"()-")):
    CLASSES[list(_members)] = _number
CLASSES[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = 7

FEATURES = 10 + 10
QUANTILES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98, 0.99, 0.995)
INPUTS = FEATURES * len(QUANTILES) + 1
#: Gradient steps for the first fit and for the risk, their size, and the weight decay.
FIRST, STEPS, RATE, DECAY = 15, 30, 0.03, 1e-2


def features(text: str) -> list[float]:
    """Shares of byte classes and of kinds of words, repetition and size of a whole text."""
    octets = np.frombuffer(text.encode(), np.uint8)
    shares = np.bincount(CLASSES[octets], minlength=10) / max(1, len(octets))
    words = text.split()
    n = max(1, len(words))
    lines = text.split("\n")
    counts = Counter(words)
    return [
        *shares,
        np.log1p(len(words)),
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        sum(map(str.isalpha, words)) / n,
        sum(map(len, words)) / n,
        float(np.log1p(max(map(len, words), default=0))),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        len(set(zip(words, words[1:], strict=False))) / n,
        len(set(lines)) / len(lines),
    ]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, f: array of FEATURES floats) per row; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([features(t.as_py() or "") for t in batch.column(1)], np.float64)
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * FEATURES, pa.int32()), pa.array(found.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "f"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, f array<double>")


def inputs(values: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Which quantile steps each feature exceeds, and a constant one."""
    above = (values[:, :, None] > steps[None, :, :]).reshape(len(values), -1)
    return np.hstack([above, np.ones((len(values), 1), bool)]).astype(np.float64)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def loss_sums(x: np.ndarray, trusted: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums over rows, as (loss, gradient): positives as 1, positives as 0, unlabelled as 0."""
    z = x @ weights
    chance = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    out = []
    for rows, label in ((trusted, 1), (trusted, 0), (~trusted, 0)):
        loss = np.logaddexp(0, -z[rows]) if label else np.logaddexp(0, z[rows])
        out.append(np.concatenate([[loss.sum()], (chance[rows] - label) @ x[rows]]))
    return np.concatenate(out)


def _sums(rows: DataFrame, steps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 * (INPUTS + 1))
        for batch in batches:
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
            total += loss_sums(inputs(_matrix(batch, "f"), steps), trusted, weights)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(total)), pa.int32()), "s": total})

    summed = rows.select("f", "trusted").mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
    total = np.zeros(3 * (INPUTS + 1))
    for row in summed.collect():  # one number per weight and kind of loss
        total[row["i"]] = row["s"]
    return total.reshape(3, -1)


def _descend(
    rows: DataFrame, steps: np.ndarray, weights: np.ndarray, n_trusted: int, n_open: int, prior: float | None, times: int
) -> np.ndarray:
    """Adam over the whole table; each step is one Spark job that returns sums.

    Without ``prior`` the plain risk of trusted against unlabelled rows, else the non-negative
    unbiased risk: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)). Where the second part is
    negative, its gradient is followed upwards instead.
    """
    speed, square = np.zeros(INPUTS), np.zeros(INPUTS)
    for t in range(1, times + 1):
        plus, minus, loose = _sums(rows, steps, weights)
        plus, minus, loose = plus / n_trusted, minus / n_trusted, loose / n_open
        if prior is None:
            slope = plus[1:] + loose[1:]
        else:
            rest = loose - prior * minus
            slope = prior * plus[1:] + rest[1:] if rest[0] >= 0 else -rest[1:]
        slope = slope + DECAY * weights * (np.arange(INPUTS) < INPUTS - 1)
        speed, square = 0.8 * speed + 0.2 * slope, 0.95 * square + 0.05 * slope**2
        scale = np.sqrt(square / (1 - 0.95**t)) + 1e-6
        weights = weights - RATE / (1 + t / 20) * speed / (1 - 0.8**t) / scale
    return weights


def class_prior(rows: DataFrame, steps: np.ndarray, weights: np.ndarray) -> float:
    """Share of positives among the unlabelled: the least ratio U(A) / P(A) over sets A = {score >= t}.

    Every such ratio is an upper bound; A ranges over sets that hold nine tenths of the trusted rows, where
    ratios are least prone to an overfitted score.
    """
    scored = _scored(rows, steps, weights, "trusted").withColumn("cell", F.floor(F.col("score") * 1000).cast("int"))
    cells = np.zeros((2, 1001))
    for row in scored.groupBy("cell", "trusted").count().collect():  # 2,002 rows at most
        cells[int(row["trusted"]), row["cell"]] = row["count"]
    above = cells[:, ::-1].cumsum(axis=1)
    loose, trusted = above[0] / above[0, -1], above[1] / above[1, -1]
    wide = trusted >= 0.9
    return float(np.clip((loose[wide] / trusted[wide]).min(), 0.01, 0.99))


def _scored(rows: DataFrame, steps: np.ndarray, weights: np.ndarray, *keep: str) -> DataFrame:
    kinds = {"doc_id": "long", "trusted": "boolean"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = inputs(_matrix(batch, "f"), steps) @ weights
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(score)], [*keep, "score"])

    return rows.select(*keep, "f").mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in keep) + ", score double")


def quality_scores(
    docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; score is the chance of quality 1.

    Rows whose crc32(doc_id) modulo ``parts`` is ``held`` are held out. Of the others, those with a
    label of 1 are trusted positives and all the rest are unlabelled; labels of 0 are never used.
    The model adds up weights of feature quantiles. Quantiles, every gradient step and the class
    prior cover all training rows; only sums reach the driver. Id, label, language and source are
    no inputs.

    A null text is empty and is scored; repeated rows are each scored alike, repeated or null
    labels don't matter, a null doc_id matches no label. Without a trusted or without an unlabelled
    training row every score is 0.5. Other columns are not read.
    """
    table = settle(feature_table(docs, id_col, text_col), "features").withColumn(
        "held_out", fold("doc_id", parts) == held
    )
    trusted = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    marked = table.filter("NOT held_out").join(trusted.withColumn("trusted", F.lit(True)), "doc_id", "left")
    rows = settle(marked.select("f", F.coalesce("trusted", F.lit(False)).alias("trusted")), "training")
    n_trusted, n_open = rows.agg(F.count_if("trusted"), F.count_if(~F.col("trusted"))).first()
    weights, steps = np.zeros(INPUTS), np.zeros((FEATURES, len(QUANTILES)))
    if n_trusted and n_open:
        steps = np.array(
            rows.agg(
                *(F.percentile_approx(F.col("f")[i], list(QUANTILES), 2000).alias(f"q{i}") for i in range(FEATURES))
            ).first()
        )
        weights = _descend(rows, steps, weights, n_trusted, n_open, None, FIRST)
        prior = class_prior(rows, steps, weights)
        weights = _descend(rows, steps, weights, n_trusted, n_open, prior, STEPS)
    scored = _scored(table, steps, weights, "doc_id")
    return scored.select(
        "doc_id",
        (fold("doc_id", parts) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
