"""Language by string kernels.

A text is cut into windows of ``WINDOW`` code points, all of them. A window stands
for the set of its n-grams of one to ``MAX_N`` code points (lower case), hashed to
``BUCKETS``; the kernel of two windows is the number of n-grams both have, over the
root of the product of their numbers (blended spectrum, presence). Landmark windows
of the labelled sample give the Nyström features, and ridge regression on them,
one language against the rest, the weights. Scoring a batch is two matrix products:
presence by landmarks, and kernel by weights. A document's language has the highest
mean over its windows, each weighted by its code points; the score is the softmax of
these means at a temperature fitted on labelled windows that were not trained on.

The model is fitted on a bounded sample: of each language the ``SAMPLE_DOCS``
documents with the smallest hash of their id, ``SAMPLE_WINDOWS`` windows spread over
each, ``LANDMARKS`` landmarks in all. Each document is then classified whole.

Defined cases: a null text or one without a letter is ``und`` with score 0; with no
labelled row everything is ``und``; with one language each text with a letter is
that language; equal scores give the first language by name; repeated rows give a
row each; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import bounded_sample, crc_third, slices

WINDOW = 2048
MAX_N = 3
BUCKETS = 4096
LANDMARKS = 128
SAMPLE_DOCS = 240
SAMPLE_WINDOWS = 3
RIDGE = 1e-3
UNKNOWN = "und"
#: Below this score the pipeline takes a text for none of the languages.
LEAST_SCORE = 0.4
#: Code points that are turned into n-grams at once.
_CHUNK = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def window_presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence matrix (windows by buckets), the text of each window, its code points."""
    codes, owner, sizes = [], [], []
    for i, text in enumerate(texts):
        code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        for start in range(0, len(code), WINDOW):
            part = code[start : start + WINDOW + MAX_N - 1]  # n-grams that start in the window
            codes.append(part)
            owner.append(i)
            sizes.append(min(WINDOW, len(code) - start))
    presence = np.zeros((len(codes), BUCKETS), np.bool_)
    if codes:
        lengths = np.array([len(c) for c in codes])
        all_codes = np.concatenate(codes)
        window = np.repeat(np.arange(len(codes), dtype=np.int64), lengths)
        hashed = np.zeros(len(all_codes), np.uint32)
        for n in range(1, MAX_N + 1):
            here = len(all_codes) - n + 1
            if here <= 0:
                break
            hashed = (hashed[:here] + all_codes[n - 1 :]) * _MIX[n - 1]
            hashed ^= hashed >> np.uint32(15)
            inside = window[:here] == window[n - 1 :]
            bucket = (hashed * _MIX[3]) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            presence.reshape(-1)[(window[:here] * BUCKETS + bucket)[inside]] = True
    return presence, np.array(owner, np.int64), np.array(sizes, np.float64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    landmarks: bytes  # presence bits
    weights: bytes  # landmarks by languages, float32
    temperature: float

    def unpacked(self) -> tuple[np.ndarray, np.ndarray]:
        bits = np.frombuffer(self.landmarks, np.uint8).reshape(-1, BUCKETS // 8)
        marks = np.unpackbits(bits, axis=1).astype(np.float32)
        marks /= np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))
        return marks, np.frombuffer(self.weights, np.float32).reshape(len(marks), -1)


def kernel(presence: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Normalised kernel of windows and landmarks (``marks`` are scaled already)."""
    dense = presence.astype(np.float32)
    return (dense @ marks.T) / np.sqrt(np.maximum(dense.sum(1, keepdims=True), 1))


def classify(texts: list[str], marks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean outputs per text and language; nan rows for empty texts."""
    totals, shares = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
    start = 0
    while start < len(texts):
        end, chars = start, 0
        while end < len(texts) and (end == start or chars + len(texts[end]) <= _CHUNK):
            chars += len(texts[end])
            end += 1
        # A very long text is classified in pieces of whole windows.
        step = _CHUNK // WINDOW * WINDOW
        for at in range(0, max(chars, 1) if end == start + 1 else 1, step):
            part = [texts[start][at : at + step]] if end == start + 1 else texts[start:end]
            presence, owner, sizes = window_presence(part)
            out = kernel(presence, marks) @ weights
            np.add.at(totals, owner + start, out * sizes[:, None])
            np.add.at(shares, owner + start, sizes)
        start = end
    with np.errstate(invalid="ignore"):
        return totals / shares[:, None]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def sample_windows(docs: DataFrame, labels: Column, id_col: str, text_col: str) -> list:
    """(language, packed presence) of the bounded sample; the texts stay on the executors."""
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), labels.alias("label"), crc_third(id_col).alias("third")
    ).filter((F.col("third") != 1) & F.col("label").isNotNull())
    ids = sorted({r[0] for r in bounded_sample(narrow, SAMPLE_DOCS, "label")})

    def cut(batches):
        for part in slices(batches):
            rows = []
            for text, label in zip(*(c.to_pylist() for c in part.columns), strict=True):
                count = max(1, -(-len(text) // WINDOW))
                spread = sorted({round(k * (count - 1) / max(1, SAMPLE_WINDOWS - 1)) for k in range(SAMPLE_WINDOWS)})
                presence, _, _ = window_presence([text[s * WINDOW : (s + 1) * WINDOW] for s in spread])
                rows += [(label, p.tobytes()) for p in np.packbits(presence, axis=1)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["label", "bits"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), labels.alias("label"))
    texts = texts.filter(F.col("doc_id").isin(ids) & F.col("label").isNotNull()).select("text", "label")
    return sorted(tuple(r) for r in texts.mapInArrow(cut, "label string, bits binary").collect())


def fit(sample: list) -> Model | None:
    if not sample:
        return None
    languages = tuple(sorted({label for label, _ in sample}))
    rng = np.random.default_rng(0)
    order = rng.permutation(len(sample))
    target = np.array([languages.index(sample[i][0]) for i in order])
    bits = np.frombuffer(b"".join(sample[i][1] for i in order), np.uint8).reshape(len(order), -1)
    each = max(1, LANDMARKS // len(languages))
    chosen = np.concatenate([np.flatnonzero(target == c)[:each] for c in range(len(languages))])
    held = np.arange(len(order)) % 4 == 3
    presence = np.unpackbits(bits, axis=1).astype(bool)
    draft = Model(languages, bits[chosen].tobytes(), np.zeros((len(chosen), len(languages)), np.float32).tobytes(), 1.0)
    marks, _ = draft.unpacked()
    among = marks @ marks.T
    values, vectors = np.linalg.eigh(among.astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = kernel(presence, marks).astype(np.float64) @ root
    signs = np.where(target[:, None] == np.arange(len(languages)), 1.0, -1.0)

    def ridge(rows: np.ndarray) -> np.ndarray:
        x = features[rows]
        gram = x.T @ x + RIDGE * len(x) * np.eye(x.shape[1])
        return np.linalg.solve(gram, x.T @ signs[rows])

    temperature = 1.0
    if held.any() and not held.all():
        out = features[held] @ ridge(~held)
        grid = [0.5, 1, 2, 3, 4, 6, 8, 12]
        loss = [-np.log(_softmax(t * out)[np.arange(held.sum()), target[held]] + 1e-9).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
    weights = (root @ ridge(np.ones(len(order), bool))).astype(np.float32)
    return Model(languages, draft.landmarks, weights.tobytes(), temperature)


def predictor(model: Model | None):
    """Function of texts (nulls allowed): languages and scores."""
    marks, weights = model.unpacked() if model else (None, None)

    def predict(texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        real = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
        if real:
            chances = _softmax(model.temperature * classify([texts[i] for i in real], marks, weights))
            for i, c in zip(real, chances, strict=True):
                best = int(c.argmax())
                names[i], scores[i] = model.languages[best], float(c[best])
        return names, scores

    return predict


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    return fit(sample_windows(docs, F.col(lang_col), id_col, text_col))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    def run(batches):
        predict = predictor(model)
        for part in slices(batches):
            names, scores = predict(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (crc_third(id_col) == 1).alias("held_out"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None, least: float = LEAST_SCORE, text_col: str = "text") -> DataFrame:
    """The documents, all columns, whose language is known with at least this score.
    Without a model nothing is told apart and every text with a letter stays."""
    def run(batches):
        predict = predictor(model)
        for part in slices(batches):
            texts = part.column(text_col).to_pylist()
            if model is None:
                stays = [bool(t and _LETTER.search(t)) for t in texts]
            else:
                names, scores = predict(texts)
                stays = [n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)]
            yield part.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
