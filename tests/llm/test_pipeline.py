"""The pipeline against a plain version of its stages."""

import re

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeline.llm import decontaminate, language
from gaugeline.llm.common import tokenizer_file
from helpers import DOCS
from test_near_dedup import brute as near_brute

FOLDER = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, scores = language.predictor(language.train(docs))([t for _, t in rows])
    rows = [r for r, n, s in zip(rows, names, scores) if n != "und" and s >= language.LEAST_SCORE]
    best = {}
    for i, t in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[bare] = min(best.get(bare, (1, 0)), (-len(t), i))
    staying = {i for _, i in best.values()}
    rows = [r for r in rows if r[0] in staying]
    kept = {i for i, _, _, k in near_brute(rows, 5, 80) if k}
    rows = [r for r in rows if r[0] in kept]
    items = [(r[0], decontaminate.words(r[1])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]

    def leaked(text):
        words = decontaminate.words(text)
        runs = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        shared = lambda w: {p for k in range(len(w) - 4) if tuple(w[k : k + 5]) in runs for p in range(k, k + 5)}
        return any(w and len(shared(w)) >= decontaminate.COVERAGE * len(w) for _, w in items)

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    want = {i: library.encode(t) for i, t in rows if not leaked(t)}
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in found} == want and len(found) == len(want)
    assert all(r["round_trip"] for r in found)
    assert 0 < len(want) < docs.count()


def test_stages_keep_the_columns_and_survive_odd_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "Some words in here", None, None, None), (None, "Other text at hand", "en", "s", 1)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, DOCS).withColumn("digest", F.lit("x"))
        for name, stage in corpus_pipeline.STAGES:
            before = docs
            docs = stage(spark, docs, FOLDER)
            assert name == "encode" or docs.schema.simpleString() == before.schema.simpleString()
        assert sorted(repr(r["doc_id"]) for r in docs.collect()) == (["3", "None"] if given else [])
