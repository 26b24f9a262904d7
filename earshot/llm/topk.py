"""Exact inner-product top-k by norm buckets with local cosine thresholds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.llm.common import settle

#: Vectors of a bucket and queries of a block; they bound the memory of a task.
BUCKET, BLOCK = 4096, 1024
#: Local cosine threshold from which coordinates are pruned, and how many coordinates.
STEEP, FOCUS = 0.85, 4
#: Relative room for rounding in every pruning bound; products themselves are exact.
ROOM = 1e-9


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, computed in double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _packed(df: DataFrame, rows: int, name: str) -> DataFrame:
    """Rows (vec_id, vector) of a partition, longest first, as blocks of packed arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1)
            size = np.diff(values.offsets.to_numpy())
            flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(size)])
            for dim in np.unique(size):
                chosen = np.flatnonzero(size == dim)
                for at in range(0, len(chosen), rows):
                    part = chosen[at : at + rows]
                    vectors = np.stack([flat[starts[i] : starts[i] + dim] for i in part])
                    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
                    order = np.lexsort((ids[part], -norms))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "dim": pa.array([dim], pa.int32()),
                            "longest": [float(norms.max())],
                            "ids": [ids[part][order].tobytes()],
                            "vectors": [vectors[order].tobytes()],
                            "size": pa.array([len(part)], pa.int32()),
                        }
                    )

    packed = df.mapInArrow(run, "dim int, longest double, ids binary, vectors binary, size int")
    return settle(packed, name)


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products: by floating point where 53 bits hold every sum."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    most = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if most < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def _best(query: int, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores without the query's own id, ties to the smaller id."""
    keep = ids != query
    ids, scores = ids[keep], scores[keep]
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    least: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query the k best of one bucket (vectors longest first) that reach ``least``.

    ``least`` is a score that k candidates of the query are known to reach (minus infinity: none).
    The local threshold least / (|q| * longest) is a bound for the cosine. Above one, the bucket
    holds nothing for the query. From STEEP on, candidates must lie near the query in its FOCUS
    largest coordinates; below, only vectors too short are cut off. What is left is multiplied out.
    """
    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        needed = np.where(least > 0, least / lengths, -np.inf) * (1 - ROOM)
        local = needed / norms[0] if norms[0] > 0 else np.where(needed > 0, np.inf, -np.inf)
    alive = local <= 1
    steep = alive & (local >= STEEP)
    if steep.any():
        units = vectors / np.maximum(norms, 1e-300)[:, None]
    for q in np.flatnonzero(steep):
        t, unit = local[q], queries[q] / lengths[q]
        fits = norms >= needed[q]
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            reach = np.sqrt(max(0.0, (1 - t * t) * (1 - min(1.0, unit[f] ** 2)))) + 1e-7
            fits &= np.abs(units[:, f] - unit[f] * t) <= reach + abs(unit[f]) * (1 - t)
        scores = _products(queries[q : q + 1], vectors[fits])[0]
        enough = scores >= least[q]
        yield (int(query_ids[q]), *_best(query_ids[q], ids[fits][enough], scores[enough], k))
    flat = np.flatnonzero(alive & ~steep)
    if len(flat):
        reach = np.searchsorted(-norms, -needed[flat], side="right")
        for at in range(0, len(flat), 256):
            part, ends = flat[at : at + 256], reach[at : at + 256]
            scores = _products(queries[part], vectors[: ends.max()])
            for row, q, end in zip(scores, part, ends, strict=True):
                enough = row[:end] >= least[q]
                yield (int(query_ids[q]), *_best(query_ids[q], ids[:end][enough], row[:end][enough], k))


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Search each pair of a query block and a bucket of the same number of components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                query_ids = np.frombuffer(row["q_ids"], np.int64)
                found = list(
                    search_block(
                        query_ids,
                        np.frombuffer(row["q_vectors"], np.int64).reshape(len(query_ids), row["dim"]),
                        np.frombuffer(row["q_least"], np.float64),
                        ids,
                        np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["dim"]),
                        k,
                    )
                )
                if found:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "query_id": np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]),
                            "vec_id": np.concatenate([i for _, i, _ in found]),
                            "score": np.concatenate([s for _, _, s in found]),
                        }
                    )

    columns = ["dim", "q_ids", "q_vectors", "q_least", "ids", "vectors"]
    return pairs.select(*columns).mapInArrow(run, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _query_blocks(queries: DataFrame) -> DataFrame:
    """Queries (query_id, vector, least) as packed blocks; ``least``: the score to reach, if known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            least = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
            least = np.where(np.isnan(least), -np.inf, least)
            rows = [np.array(v, np.int64) for v in batch.column(1).to_pylist()]
            size = np.array([len(v) for v in rows])
            for dim in np.unique(size):
                chosen = np.flatnonzero(size == dim)
                for at in range(0, len(chosen), BLOCK):
                    part = chosen[at : at + BLOCK]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "dim": pa.array([dim], pa.int32()),
                            "q_ids": [ids[part].tobytes()],
                            "q_vectors": [np.stack([rows[i] for i in part]).tobytes()],
                            "q_least": [least[part].tobytes()],
                        }
                    )

    return queries.select("query_id", "vector", "least").mapInArrow(
        run, "dim int, q_ids binary, q_vectors binary, q_least binary"
    )


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k highest integer inner products.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition over its columns. Every
    usable vector is a candidate but the query's own, ties go to the smaller vec_id, and queries
    with fewer candidates return fewer rows. Vectors that are null, hold null or non-finite
    components, or have a null vec_id take no part. Rows equal in vec_id and quantised vector count
    as one; other rows that repeat a vec_id are candidates each, and queries of one id share a result. Only vectors with as many components as the query are its
    candidates. Sums must stay below 2**63. Other columns are not read.

    Vectors are sorted by length into buckets of BUCKET rows. Each query first meets the bucket of
    the longest vectors, which gives a score it must reach; with it every block of BLOCK queries
    passes through all buckets. The work is queries times vectors by its nature, cut by the
    pruning; a task holds one block and one bucket at a time.
    """
    narrow = vectors.withColumn("_q", F.coalesce(is_query, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", "_q"
    )
    whole = (
        narrow.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select("vec_id", quantise(F.col("embedding"), scale).alias("vector"), "_q")
        .groupBy("vec_id", "vector")
        .agg(F.max("_q").alias("_q"))
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    whole = settle(whole.withColumn("square", square), "vectors")
    spread = lambda df, n: df.repartitionByRange(n, F.desc("square"), F.col("vec_id"))
    count, asked = whole.agg(F.count("*"), F.count_if("_q")).first()
    ordered = spread(whole, max(1, -(-count // BUCKET))).select("vec_id", "vector")
    buckets = _packed(ordered, BUCKET, "buckets")
    queries = whole.filter("_q").select(F.col("vec_id").alias("query_id"), "vector")
    queries = queries.repartition(max(1, -(-asked // BLOCK)), "query_id")
    blind = _query_blocks(queries.withColumn("least", F.lit(None).cast("double")))
    longest = buckets.groupBy("dim").agg(F.max("longest").alias("longest"))
    heads = buckets.join(longest, ["dim", "longest"]).drop("size")
    first = settle(_ranked(_searched(blind.join(heads, "dim"), k), k), "first")
    least = first.filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))

    aimed = settle(_query_blocks(queries.join(least, "query_id", "left")), "aimed")
    groups = max(1, min(buckets.count(), 4 * vectors.sparkSession.sparkContext.defaultParallelism))
    near = buckets.drop("size").withColumn("turn", F.pmod(F.xxhash64("ids"), F.lit(groups)))
    far = aimed.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    found = _searched(far.join(near, ["dim", "turn"]), k)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
