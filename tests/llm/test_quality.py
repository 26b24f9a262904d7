import numpy as np
from pyspark.sql import functions as F

from earshot.llm import quality as Q

from llm_helpers import ODD_TEXTS, odd_docs

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = Q.quality_scores(docs, labels)
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_labels_of_zero_and_held_out_labels_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.filter("doc_id < 200")
    plain = Q.quality_scores(some, labels).select("doc_id", "score")
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 1
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).filter(held | (F.col("quality") == 1))
    changed = dict(Q.quality_scores(some, other).select("doc_id", "score").collect())
    assert all(abs(changed[i] - s) < 1e-6 for i, s in plain.collect())


def test_gradients_are_those_of_the_losses():
    rng = np.random.default_rng(0)
    x, trusted, weights = rng.random((50, 6)), rng.random(50) < 0.4, rng.normal(size=6)
    sums = Q.loss_sums(x, trusted, weights).reshape(3, -1)
    for i in range(6):
        step = np.zeros(6)
        step[i] = 1e-6
        up = Q.loss_sums(x, trusted, weights + step).reshape(3, -1)[:, 0]
        down = Q.loss_sums(x, trusted, weights - step).reshape(3, -1)[:, 0]
        assert np.allclose((up - down) / 2e-6, sums[:, 1 + i], atol=1e-5)


def test_odd_rows_and_no_labels(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    found = Q.quality_scores(odd_docs(spark), labels).collect()
    assert len(found) == len(ODD_TEXTS) + 4
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    none = Q.quality_scores(odd_docs(spark), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert Q.quality_scores(odd_docs(spark).limit(0), labels).count() == 0
