"""Text quality by positive-unlabelled learning.

Trusted positives and unlabelled web text, no negatives, train a small network on
measures of the whole text: the non-negative unbiased risk is minimised, that is the
positive part weighed by the class prior, plus the larger of zero and the unlabelled
part less the positives' share of it; a batch whose difference is below zero takes a
step back from it instead. The prior is estimated from the labelled rows (the share
of positives) where both labels occur there, otherwise from how much
denser held-back positives are among positive than among unlabelled text. A logistic curve fitted on labelled rows
turns the output into a score.

Everything that is learnt comes from rows whose crc32(id as text) modulo 3 is not 1,
of which a bounded sample is used: the ``SAMPLE`` rows of each label value (positive,
negative, none) with the smallest hash of their id. Every document is then measured
and scored whole.

Defined cases: a null text is empty and is scored as any other; without positives in
the sample every score is 0.5; repeated label rows count once per row, and a document
labelled both ways is in both samples; a null label is none; repeated documents give
a row each; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import bounded_sample, crc_third, id_and_text, slices, written

SAMPLE = 2_500
HIDDEN = 12
STEPS = 1_500
BATCH = 256
RATE = 0.01
#: The prior stays this far from 0 and 1.
MARGIN = 0.02

_NO_LETTER = bytes(i for i in range(128) if not chr(i).isalpha())
_LOWER_OR_HIGH = bytes(i for i in range(256) if i >= 128 or chr(i).islower())
_NOT_DIGIT = bytes(i for i in range(256) if not (48 <= i < 58))
_PLAIN = b".,;:'\"()-"
_NOT_SYMBOL = bytes(i for i in range(256) if i >= 128 or chr(i).isalnum() or chr(i).isspace() or i in _PLAIN)
_MARKED = re.compile(r"[^\w\s]{2,}(?=\s|$)")
_LEAST_LINE = 20


def _shares(data: bytes) -> tuple[float, float, float]:
    """Shares of upper case among letters, of digits and of symbols among bytes."""
    size = max(1, len(data))
    letters = len(data.translate(None, _NO_LETTER))
    upper = len(data.translate(None, _NO_LETTER + _LOWER_OR_HIGH))
    return (
        upper / max(1, letters),
        len(data.translate(None, _NOT_DIGIT)) / size,
        len(data.translate(None, _NOT_SYMBOL)) / size,
    )


def measures(text: str) -> list[float]:
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    data = text.encode("utf-8", "surrogatepass")
    upper, digits, symbols = _shares(data)
    per_line = [_shares(line.encode("utf-8", "surrogatepass")) for line in lines if len(line) >= _LEAST_LINE]
    most = np.max(per_line, axis=0) if per_line else (upper, digits, symbols)
    weight = max(1, len(words))
    common = Counter(words).most_common(1)
    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        upper,
        digits,
        symbols,
        *most,
        len(_MARKED.findall(text)) / weight,
        sum(1 for w in words if not w[-1].isalnum() and not w[0].isalnum()) / weight,
        len(set(words)) / weight,
        (common[0][1] if common else 0) / weight,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(map(len, words)) / weight / 10,
        max(map(len, words), default=0) / 50,
        len(data.translate(None, _NO_LETTER)) / max(1, len(data)),
    ]


class _Net:
    """One hidden layer, trained by Adam."""

    def __init__(self, inputs: int, rng):
        self.p = [
            rng.normal(0, 1 / np.sqrt(inputs), (inputs, HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1),
        ]
        self.m = [np.zeros_like(x) for x in self.p]
        self.v = [np.zeros_like(x) for x in self.p]
        self.t = 0

    def output(self, x: np.ndarray) -> np.ndarray:
        w, b, u, c = self.p
        return np.tanh(x @ w + b) @ u + c

    def gradient(self, x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Of the sum of slope times output."""
        w, b, u, _ = self.p
        h = np.tanh(x @ w + b)
        back = slope[:, None] * u * (1 - h * h)
        return [x.T @ back, back.sum(0), h.T @ slope, np.array([slope.sum()])]

    def step(self, gradient: list[np.ndarray]) -> None:
        self.t += 1
        for i, g in enumerate(gradient):
            g = g + 1e-4 * self.p[i]
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            rate = RATE * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
            self.p[i] = self.p[i] - rate * self.m[i] / (np.sqrt(self.v[i]) + 1e-8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train_net(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 0) -> _Net:
    """Minimises the non-negative unbiased risk with the sigmoid loss."""
    rng = np.random.default_rng(seed)
    net = _Net(positive.shape[1], rng)
    for _ in range(STEPS):
        x = positive[rng.integers(0, len(positive), BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        sx, su = _sigmoid(net.output(x)), _sigmoid(net.output(u))
        # Loss 1 - s for a positive, s for a negative.
        negative_part = su.mean() - prior * sx.mean()
        dx, du = sx * (1 - sx) / len(x), su * (1 - su) / len(u)
        if negative_part >= 0:
            gx = net.gradient(x, -prior * dx - prior * dx)
            gu = net.gradient(u, du)
        else:
            gx = net.gradient(x, prior * dx)
            gu = net.gradient(u, -du)
        net.step([a + b for a, b in zip(gx, gu, strict=True)])
    return net


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled rows. A plain classifier of labelled against
    as many unlabelled rows gives the ratio of their densities, which is one over the
    share where only positives are; the median on positives held back is taken."""
    half = len(positive) // 2 or 1
    rng = np.random.default_rng(1)
    net = _Net(positive.shape[1], rng)
    for _ in range(STEPS // 3):
        x = positive[:half][rng.integers(0, half, BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        both = np.concatenate([x, u])
        slope = (_sigmoid(net.output(both)) - np.repeat([1.0, 0.0], BATCH)) / len(both)
        net.step(net.gradient(both, slope))
    held = positive[half:] if len(positive) > 1 else positive
    ratio = np.exp(np.clip(np.median(net.output(held)), -8, 8))
    return float(np.clip(1 / ratio, MARGIN, 1 - MARGIN))


def _curve(outputs: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Logistic curve (slope, shift) by Newton steps, slightly ridged."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * outputs + b)
        w = weights * p * (1 - p) + 1e-6
        off = weights * (p - labels)
        g = np.array([(off * outputs).sum() + 0.1 * (a - 1), off.sum() + 0.1 * b])
        h = np.array([[(w * outputs**2).sum() + 0.1, (w * outputs).sum()], [(w * outputs).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit(sample: list[tuple[int | None, list[float]]], counts: dict) -> dict | None:
    """Model of a sample of (label or null, measures) and the number of rows of each
    label; plain numbers only."""
    of = lambda value: np.array([m for label, m in sample if label == value])
    positive, negative, unlabelled = of(1), of(0), of(None)
    if not len(positive):
        return None
    if not len(unlabelled):
        unlabelled = np.concatenate([positive, negative]) if len(negative) else positive
    mean, spread = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    scale = lambda rows: np.clip((rows - mean) / spread, -8, 8)
    if len(negative):
        prior = float(np.clip(counts[1] / (counts[0] + counts[1]), MARGIN, 1 - MARGIN))
    else:
        prior = estimated_prior(scale(positive), scale(unlabelled))
    net = train_net(scale(positive), scale(unlabelled), prior)
    slope, shift = 4.0, 0.0
    if len(negative):
        outputs = net.output(scale(np.concatenate([positive, negative])))
        labels = np.concatenate([np.ones(len(positive)), np.zeros(len(negative))])
        weights = np.where(labels == 1, prior / len(positive), (1 - prior) / len(negative)) * len(labels)
        slope, shift = _curve(outputs, labels, weights)
    return {"mean": mean, "spread": spread, "net": net.p, "slope": slope, "shift": shift, "prior": prior}


def score(model: dict | None, rows: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(rows), 0.5)
    w, b, u, c = model["net"]
    x = np.clip((rows - model["mean"]) / model["spread"], -8, 8)
    return _sigmoid(model["slope"] * (np.tanh(x @ w + b) @ u + c) + model["shift"])


def sample_measures(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str):
    """(label, measures) of the bounded sample, and the number of rows of each label in
    the whole tables; texts stay on the executors."""
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = marked.filter((crc_third("doc_id") != 1) & F.col("label").isin(0, 1))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id")).filter(crc_third("doc_id") != 1)
    rows = written(rows.join(known, "doc_id", "left"), "labelled-ids")
    counts = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    picked = bounded_sample(rows, SAMPLE, "label")
    ids = sorted({r[0] for r in picked})

    def measure(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([measures(t) for t in part.column("text").to_pylist()], pa.list_(pa.float64()))],
                names=["doc_id", "measures"],
            )

    chosen = id_and_text(docs, id_col, text_col).filter(F.col("doc_id").isin(ids))
    values = {r[0]: list(r[1]) for r in chosen.mapInArrow(measure, "doc_id long, measures array<double>").collect()}
    sample = ((label, values[doc]) for doc, label in picked)
    return sorted(sample, key=lambda x: (x[0] is None, x[0] or 0, x[1])), counts


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict | None:
    return fit(*sample_measures(docs, labels, id_col, text_col, label_col))


def quality(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def run(batches):
        for part in slices(batches):
            scores = score(model, np.array([measures(t) for t in part.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    rows = id_and_text(docs, id_col, text_col).withColumn("held_out", crc_third("doc_id") == 1)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )
