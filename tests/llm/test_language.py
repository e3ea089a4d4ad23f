import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import language as op
from helpers import DOCS, ODD_TEXTS, frame

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = op.identify(docs, op.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 250
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_only_training_rows_are_learnt(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "xx").otherwise(F.col("lang")))
    assert op.train(wrong) == op.train(docs)
    assert op.train(wrong.withColumn("source", F.lit(None))) == op.train(docs)


def test_kernel_counts_shared_ngrams():
    a, b = "abcab", "bcabd"
    presence, _, _ = op.window_presence([a, b])
    grams = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    shared = len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b)))
    marks = presence[1:].astype(np.float32) / np.sqrt(presence[1].sum())
    assert abs(float(op.kernel(presence[:1], marks)[0, 0]) - shared) < 1e-6


def test_long_texts_are_read_whole():
    rng = random.Random(0)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    texts = [(lang, " ".join(word(letters) for _ in range(60))) for lang, letters in (("p", "abcd"), ("q", "wxyz")) for _ in range(40)]
    model = op.fit(sorted((lang, np.packbits(op.window_presence([t])[0], axis=1)[0].tobytes()) for lang, t in texts))
    predict = op.predictor(model)
    start, end = " ".join(word("abcd") for _ in range(3_000)), " ".join(word("wxyz") for _ in range(200_000))
    assert predict([start, start + " " + end, start[:5000]])[0] == ["p", "q", "p"]


@pytest.mark.parametrize("langs", [None, "en"], ids=["no labels", "one language"])
def test_odd_rows(spark, langs):
    docs = frame(spark, ODD_TEXTS, wide=True).withColumn("lang", F.lit(langs).cast("string"))
    model = op.train(docs)
    letters = lambda t: any(c.isalpha() for c in t or "")
    got = sorted((repr(r["doc_id"]), r["lang_pred"]) for r in op.identify(docs, model).collect())
    assert got == sorted((repr(i), langs if langs and letters(t) else "und") for i, t in ODD_TEXTS)
    kept = op.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(letters(t) for _, t in ODD_TEXTS)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert op.train(docs) is None
    assert op.identify(docs, None).count() == op.keep_identified(docs, None).count() == 0
