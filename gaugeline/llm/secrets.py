"""Secrets in text: patterns and a character convolutional network.

The kinds ``assign``, ``access`` and ``hex`` stand by their pattern. The network adds
``learned``: other tokens of 16 or more characters with a letter and a digit, outside
those spans and not plain (below), that it takes for secrets. It reads the whole token, filled up to
``TOKEN`` characters, with ``BEFORE`` characters before and ``AFTER`` behind; one
convolution over one-hot characters, the maximum over each of the three parts, one output.

It is trained on labelled findings, from a bounded sample of documents (``SAMPLE_DOCS``
with the smallest hash of their id) and of four groups, each of at most ``FINDINGS``:
the pattern findings, which are secrets; long tokens known not to be secrets
(``is_plain``: words, numbers, identifiers and paths made of them, UUIDs, times; at most
``PER_DOC`` of a document); and, as patterns label one or two kinds only, secrets and
harmless tokens of many kinds that ``made_findings`` puts between the words of these
documents. What the patterns leave open, the very tokens to be judged, has no label and
takes no part. Of an ``assign`` finding the value is the token, and the keyword, which no
other token has before it, is left out of what stands before. Of a token longer than
``WINDOW`` training, and only training, takes so many characters from a place drawn by
its hash. A quarter of the findings is kept back, a logistic curve on it calibrates the
output, and the threshold is the largest at which ``RECALL`` of its secrets are found,
but never above even odds: kinds that no finding stands for score lower than those that
were trained. Every document is then searched whole.

Defined cases: null text is empty; without findings of both labels, as in an empty
table, nothing is added; spans of equal start are in the order of the kinds; each row gives
one row; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm import made_findings
from gaugeline.llm.common import bounded_sample, id_and_text, slices

SAMPLE_DOCS = 8_000
FINDINGS = 3_000
PER_DOC = 4
RECALL = 0.98
BEFORE, TOKEN, AFTER = 24, 48, 16
WIDTH, FILTERS = 5, 32
#: Characters of a finding that training reads at most, and places convolved at once.
WINDOW, CHUNK = 512, 1 << 16
STEPS, BATCH, RATE = 500, 128, 0.01

KINDS = ("assign", "access", "hex", "learned")
_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_BETWEEN = re.compile("[+/_=-]+")
_UUID = re.compile("[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Words in camel case, with a short number if there are three letters before it;
#: capitals; digits; a version; day and hour of a time.
_PLAIN = re.compile("(?:[A-Z]?+[a-z]++)++(?:(?<=[A-Za-z]{3})[0-9]{1,4})?|[A-Z]+|[0-9]+|[vV][0-9]{1,4}|[0-9]{2}T[0-9]{2,6}Z?")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
_SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n=:\"'+/_-.,;@#$%&*()"
_OTHER = len(_SYMBOLS)
_PAD = _OTHER + 1
_ALPHABET = _PAD + 1
_CODES = np.full(128, _OTHER, np.uint8)
for _i, _c in enumerate(_SYMBOLS):
    _CODES[ord(_c)] = _i


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), not in order."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return spans + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


def other_tokens(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Long tokens outside the base spans."""
    found = [m.span() for m in _TOKEN.finditer(text)]
    if not base:
        return found
    taken = sorted((s, e) for s, _, e in base)
    return [t for t in found if not any(s < t[1] and t[0] < e for s, e in taken)]


def has_both(token: str) -> bool:
    return bool(_DIGIT.search(token) and _LETTER.search(token))


def is_candidate(token: str) -> bool:
    """Whether the network has to judge a long token."""
    return has_both(token) and not is_plain(token)


def is_plain(token: str) -> bool:
    """Whether a long token is known to be no secret: all its parts are plain."""
    return bool(_UUID.fullmatch(token)) or all(_PLAIN.fullmatch(p) for p in _BETWEEN.split(token) if p)


def base_codes(text: str, base: list[tuple[int, int, int]]) -> list[bytes]:
    """The base findings encoded. Of an assignment the value, without keyword and quotes
    around it; a finding at the start of such a value has its surroundings."""
    value = {}
    for start, kind, _ in base:
        if kind == 0:
            first = _ASSIGN.match(text, start).start(2)
            value[first] = min(start, value.get(first, start))

    def code(start: int, kind: int, end: int) -> bytes:
        first = _ASSIGN.match(text, start).start(2) if kind == 0 else start
        quoted = first in value and text[first - 1] in "\"'" and text[end : end + 1] == text[first - 1]
        return encoded(text, first, end, value.get(first, first), end + quoted)

    return [code(*span) for span in base]


def encoded(text: str, start: int, end: int, before: int | None = None, after: int | None = None) -> bytes:
    """The characters around and in a finding as numbers, in three parts. What is
    around ends at ``before`` and starts at ``after``, else where the finding does."""
    before, after = start if before is None else before, end if after is None else after

    def part(piece: str, size: int, right: bool) -> np.ndarray:
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        known = np.where(codes < 128, _CODES[np.minimum(codes, 127)], _OTHER).astype(np.uint8)
        gap = np.full(size - len(known), _PAD, np.uint8)
        return np.concatenate([gap, known] if right else [known, gap])

    return np.concatenate(
        [
            part(text[max(0, before - BEFORE) : before], BEFORE, True),
            part(text[start:end], max(TOKEN, end - start), False),
            part(text[after : after + AFTER], AFTER, False),
        ]
    ).tobytes()


def windowed(code: bytes) -> bytes:
    """An encoded finding, for training, with at most ``WINDOW`` characters of its token."""
    size = len(code) - BEFORE - AFTER
    if size <= WINDOW:
        return code
    at = BEFORE + int.from_bytes(hashlib.sha256(code).digest()[:8]) % (size - WINDOW + 1)
    return code[:BEFORE] + code[at : at + WINDOW] + code[-AFTER:]


class Network:
    """One-hot characters, one convolution, maximum over each part, one output."""

    def __init__(self, rng):
        self.filters = rng.normal(0, 0.1, (WIDTH, _ALPHABET, FILTERS))
        self.bias = np.zeros(FILTERS)
        self.out = rng.normal(0, 0.1, 3 * FILTERS)
        self.shift = np.zeros(1)

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.out, self.shift]

    def _convolved(self, wide: np.ndarray) -> np.ndarray:
        size = len(wide) - WIDTH + 1
        return self.bias + sum(self.filters[k][wide[k : k + size]] for k in range(WIDTH))

    def _maxima(self, wide: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Of each part, however long, the maximum; in chunks of bounded size."""
        flat, size = cuts.ravel(), len(wide) - WIDTH + 1
        values = np.full((len(flat), FILTERS), -np.inf)
        for at in range(0, size, CHUNK):
            maps = self._convolved(wide[at : at + CHUNK + WIDTH - 1])
            first = np.searchsorted(flat, at, "right") - 1
            last = np.searchsorted(flat, at + len(maps))
            here = np.maximum.reduceat(maps, np.maximum(flat[first:last] - at, 0), 0)
            values[first:last] = np.maximum(values[first:last], here)
        return values.reshape(len(cuts), 4, FILTERS)[:, :3].reshape(len(cuts), -1)

    def output(self, x) -> np.ndarray:
        return np.maximum(self._maxima(*_in_row(x)), 0) @ self.out + self.shift

    def gradient(self, x, y: np.ndarray) -> list[np.ndarray]:
        wide, cuts = _in_row(x)
        maps = self._convolved(wide)
        best = [np.array([a + maps[a:b].argmax(0) for a, b in zip(cuts[:, p], cuts[:, p + 1], strict=True)]) for p in range(3)]
        pooled = np.maximum(np.concatenate([np.take_along_axis(maps, p, 0) for p in best], 1), 0)
        slope = (_sigmoid(pooled @ self.out + self.shift) - y) / len(y)
        back = slope[:, None] * self.out * (pooled > 0)
        filters, bias = np.zeros_like(self.filters), np.zeros_like(self.bias)
        which = np.arange(FILTERS)
        for part, place in enumerate(best):
            here = back[:, part * FILTERS : (part + 1) * FILTERS]
            bias += here.sum(0)
            for k in range(WIDTH):
                np.add.at(filters[k], (wide[place + k], which), here)
        return [filters, bias, slope @ pooled, np.array([slope.sum()])]


def _in_row(x) -> tuple[np.ndarray, np.ndarray]:
    """Encoded findings of any length one after the other, ``_PAD`` around each, and
    where in the convolution the three parts of each start and the last one ends."""
    gap = np.full(WIDTH // 2, _PAD, np.uint8)
    wide = np.concatenate([piece for row in x for piece in (gap, row, gap)])
    sizes = np.array([len(row) for row in x])
    starts = np.cumsum(sizes + 2 * len(gap)) - sizes - 2 * len(gap)
    return wide, np.stack([starts, starts + BEFORE, starts + sizes - AFTER, starts + sizes], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _arrays(rows: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(row, np.uint8) for row in rows]


def train_network(x: list[np.ndarray], y: np.ndarray, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    net = Network(rng)
    places = [np.flatnonzero(y == v) for v in (0, 1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    for t in range(1, STEPS + 1):
        pick = np.concatenate([rng.choice(p, BATCH // 2) for p in places])
        for parameter, (m, v), g in zip(net.parameters(), moments, net.gradient([x[i] for i in pick], y[pick]), strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            parameter -= RATE * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * m / (np.sqrt(v) + 1e-8)
    return net


def calibrated(outputs: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Slope and shift of the logistic curve, and the threshold on its values: the
    largest that finds ``RECALL`` of the secrets, however low, and at most even odds."""
    a, b = 1.0, 0.0
    for _ in range(100):
        p = _sigmoid(a * outputs + b)
        w = p * (1 - p) + 1e-6
        g = np.array([((p - y) * outputs).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b])
        h = np.array([[(w * outputs**2).sum() + 0.1, (w * outputs).sum()], [(w * outputs).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    chances = np.sort(_sigmoid(a * outputs + b)[y == 1])[::-1]
    need = int(np.ceil(RECALL * len(chances)))
    return float(a), float(b), min(0.5, float(chances[need - 1]))


def fit(findings: list[tuple[int, bytes]]) -> dict | None:
    """Model of labelled findings; plain numbers only."""
    y = np.array([label for label, _ in findings])
    if min((y == 0).sum(), (y == 1).sum()) < 8:
        return None
    x = _arrays([code for _, code in findings])
    order = np.random.default_rng(0).permutation(len(y))
    held = order[: max(8, len(y) // 4)]
    rest = order[len(held) :]
    if len(set(y[held])) < 2 or len(set(y[rest])) < 2:
        return None
    net = train_network([x[i] for i in rest], y[rest])
    slope, shift, threshold = calibrated(net.output([x[i] for i in held]), y[held])
    return {"net": net.parameters(), "slope": slope, "shift": shift, "threshold": threshold}


def chances(model: dict, codes: list[bytes]) -> np.ndarray:
    net = Network(np.random.default_rng(0))
    net.filters, net.bias, net.out, net.shift = model["net"]
    out = [net.output(_arrays(codes[i : i + 512])) for i in range(0, len(codes), 512)] or [np.empty(0)]
    return _sigmoid(model["slope"] * np.concatenate(out) + model["shift"])


def made_codes(text: str, kinds: tuple[str, ...] = made_findings.KINDS) -> list[tuple[int, str, bytes]]:
    """(label, kind, encoded) of the findings made for a text, each cut and encoded as
    the search cuts and encodes a candidate."""
    found = []
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    for label, kind, around, start, end in made_findings.made(text, seed, kinds):
        for s, e in other_tokens(around, base_spans(around)):
            if s < end and start < e and has_both(around[s:e]):
                found.append((label, kind, windowed(encoded(around, s, e))))
                break
    return found


def labelled_findings(
    docs: DataFrame, kinds: tuple[int, ...] = (0, 1, 2), made: tuple[str, ...] = made_findings.KINDS
) -> list[tuple[int, bytes]]:
    """Of ``doc_id, text``: the findings of the bounded sample, encoded where they are;
    as secrets only those of ``kinds``, of made ones those of ``made``, so that others
    can be held out."""
    ids = [r[0] for r in bounded_sample(docs.select("doc_id"), SAMPLE_DOCS)]

    def find(batches):
        for part in slices(batches):
            rows = []
            for doc, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                base = base_spans(text)
                rows += [(1, windowed(code), doc) for code, span in zip(base_codes(text, base), base, strict=True) if span[1] in kinds]
                rest = [t for t in other_tokens(text, base) if is_plain(text[t[0] : t[1]])]
                rest.sort(key=lambda t: (not has_both(text[t[0] : t[1]]), t))
                rows += [(0, windowed(encoded(text, s, e)), doc) for s, e in rest[:PER_DOC]]
                rows += [(2 + label, code, doc) for label, _, code in made_codes(text, made)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["group", "code", "doc"])

    found = docs.filter(F.col("doc_id").isin(ids)).mapInArrow(find, "group long, code binary, doc long")
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.xxhash64("doc"), "doc", "code"))
    few = found.withColumn("place", place).filter(F.col("place") <= FINDINGS).orderBy("group", "place")
    return [(r[0] % 2, bytes(r[1])) for r in few.select("group", "code").collect()]


def recall_held_out(docs: DataFrame, out: tuple[int, ...] = (1, 2), made: tuple[str, ...] = ()) -> tuple[int, int] | None:
    """Of ``doc_id, text``: how many findings of the kinds ``out`` and ``made`` a network
    finds that was trained without them, and how many there are. None where it can't be
    trained."""
    others = tuple(k for k in made_findings.KINDS if k not in made)
    model = fit(labelled_findings(docs, tuple(k for k in range(3) if k not in out), others))
    held = [code for label, code in labelled_findings(docs, out, tuple(k for k in made if k in made_findings.SECRETS)) if label == 1]
    return model and (int((chances(model, held) >= model["threshold"]).sum()), len(held))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans,
    n_learned, and n_confirmed, the base spans that the network takes for secrets
    as well. ``model`` as ``fit`` gives it; without one it is trained on ``docs``."""
    rows = id_and_text(docs, id_col, text_col)
    model = model or fit(labelled_findings(rows))

    def search(batches):
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            spans = [base_spans(t) for t in texts]
            confirmed = [0] * len(texts)
            if model:
                places, codes = [], []
                for i, text in enumerate(texts):
                    places += [(i, *span) for span in spans[i]]
                    codes += base_codes(text, spans[i])
                    tokens = [(start, end) for start, end in other_tokens(text, spans[i]) if is_candidate(text[start:end])]
                    places += [(i, start, 3, end) for start, end in tokens]
                    codes += [encoded(text, start, end) for start, end in tokens]
                for (i, start, kind, end), chance in zip(places, chances(model, codes), strict=True):
                    if chance >= model["threshold"]:
                        if kind == 3:
                            spans[i].append((start, kind, end))
                        else:
                            confirmed[i] += 1
            counts, digests, joined = [], [], []
            for found in spans:
                found.sort()
                words = [f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found]
                base = ",".join(w for w, s in zip(words, found, strict=True) if s[1] < 3)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                joined.append(",".join(words))
                counts.append([sum(s[1] == k for s in found) for k in range(4)])
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns[:3], pa.array(digests, pa.string()), pa.array(joined, pa.string()), columns[3], pa.array(confirmed, pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learned", "n_confirmed"],
            )

    return rows.mapInArrow(
        search, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long, n_confirmed long"
    )
