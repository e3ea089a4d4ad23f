import numpy as np
from pyspark.sql import functions as F

from gaugeline.llm import quality as op
from helpers import DOCS, ODD_TEXTS, frame

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    found = op.quality(docs, op.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert len(found) > 80
    assert sum(r["quality"] == r["predicted"] for r in found) >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)


def test_only_training_labels_are_learnt(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (op.sample_measures(docs, t, "doc_id", "text", "quality") for t in (labels, turned))
    assert a == b


def test_positives_and_unlabelled_alone_are_enough():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(2, 1, (600, 5)), rng.normal(-2, 1, (600, 5))
    sample = [(1, m.tolist()) for m in good[:200]] + [(None, m.tolist()) for m in np.concatenate([good[200:], bad[:400]])]
    model = op.fit(sample, {1: 200, None: 800})
    assert 0.3 < model["prior"] < 0.7
    assert (op.score(model, good) >= 0.5).mean() > 0.95
    assert (op.score(model, bad[400:]) < 0.5).mean() > 0.95


def test_odd_rows(spark):
    docs = frame(spark, ODD_TEXTS, wide=True)
    labels = spark.createDataFrame([(4, 1), (5, None), (None, 1), (14, 0), (14, 1), (99, 1)], "doc_id long, quality int").withColumn("text", F.lit(1))
    for given in (labels, labels.limit(0)):
        rows = op.quality(docs, op.train(docs, given)).collect()
        assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows} == {0.5}
    empty = spark.createDataFrame([], DOCS)
    assert op.quality(empty, op.train(empty, labels)).count() == 0
