"""SentencePiece encoding and decoding.

All pieces form an Aho-Corasick automaton. One pass over the characters keeps, for
each position, the best way to have cut the text up to there: at each position the
output links name every piece that ends there, and each is tried behind the best way
to its start (Viterbi). With ``merges`` (models of the byte-pair kind, as the one
installed) a piece may only follow another if merging their characters by rank would
leave the two as they are; each position then has exactly one way, and it is what
merging gives. Without (unigram models) the sum of scores alone decides.

Pieces never join a character to a following space mark, nor anything to a character
outside all pieces, so a text is cut there and every distinct part is encoded once per
Python worker, as long as its cache holds it; parts are encoded many at a time, position by position, with numpy. Characters
outside all pieces become byte pieces.

As the library does by default, a text gets one space mark in front, and spaces become
space marks. A space mark in the text itself is therefore decoded as a space; any
other text comes back as it was.

Defined cases: null text is empty and has no piece; each input row gives one row,
repeated ids included; an empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import deque
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import id_and_text, slices, worker_store

MARK = "▁"
#: Parts kept in a worker before three quarters of its cache are dropped.
CACHED = 400_000
#: A longer part is encoded on its own, one character after the other.
LONG = 96
#: Cells of the tables that are filled at once.
CELLS = 1 << 21
_START, _BYTES = 60_000, 60_001  # in place of a piece: nothing before, a character as bytes
_VERDICTS = 1 << 20


class Model:
    """Pieces and their automaton, as plain arrays."""

    def __init__(self, pieces: dict[int, str], scores: dict[int, float], byte_ids: list[int], merges: bool = True):
        self.merges = merges
        #: Equal for equal models.
        self.name = xxhash.xxh3_128_hexdigest(repr((merges, byte_ids, sorted(pieces.items()), sorted(scores.items()))))
        self.byte_ids = byte_ids
        self.text = pieces
        self.rank = {text: -scores[i] for i, text in pieces.items()}
        self.id_of = {text: i for i, text in pieces.items()}
        usable = {i: t for i, t in pieces.items() if not merges or len(t) == 1 or self.merged(t) == [t]}
        size = max(pieces) + 1
        self.length = np.ones(max(size, _BYTES + 1), np.int32)
        self.score = np.zeros(max(size, _BYTES + 1))
        for i, text in usable.items():
            self.length[i], self.score[i] = len(text), scores[i]
        self.score[_BYTES] = min(scores.values()) - 10
        self._automaton(usable)
        letters = set("".join(pieces.values()))
        breaks = "" if "\n" in letters else "\n"
        self.parts = re.compile(f"{MARK}*[^{MARK}{breaks}]+|{MARK}+" + (f"|{breaks}" if breaks else ""))

    def _automaton(self, usable: dict[int, str]) -> None:
        letters = sorted(set("".join(usable.values())))
        self.letter = np.zeros(0x110000, np.int32)
        for n, c in enumerate(letters, 1):
            self.letter[ord(c)] = n
        self.width = len(letters) + 1
        children: list[dict[int, int]] = [{}]
        own = [-1]
        for i, text in usable.items():
            node = 0
            for c in text:
                n = int(self.letter[ord(c)])
                if n not in children[node]:
                    children[node][n] = len(children)
                    children.append({})
                    own.append(-1)
                node = children[node][n]
            own[node] = i
        fail, link = [0] * len(children), [0] * len(children)
        queue = deque(children[0].values())
        while queue:
            node = queue.popleft()
            for n, child in children[node].items():
                back = fail[node]
                while back and n not in children[back]:
                    back = fail[back]
                fail[child] = children[back].get(n, 0) if node else 0
                queue.append(child)
            link[node] = fail[node] if own[fail[node]] >= 0 else link[fail[node]]
        self.own, self.fail, self.link = (np.array(x, np.int32) for x in (own, fail, link))
        # Edges in an open hash table: node and letter to node.
        self.edge_bits = max(10, (8 * len(children)).bit_length())
        self.edge_key = np.full(1 << self.edge_bits, -1, np.int64)
        self.edge_to = np.zeros(1 << self.edge_bits, np.int32)
        for node, edges in enumerate(children):
            for n, child in edges.items():
                key = node * self.width + n
                slot = int(_slots(np.array([key]), self.edge_bits)[0])
                while self.edge_key[slot] >= 0:
                    slot = (slot + 1) & ((1 << self.edge_bits) - 1)
                self.edge_key[slot], self.edge_to[slot] = key, child

    def merged(self, text: str) -> list[str]:
        """Neighbours merged by rank, the best first, of equal ones the leftmost."""
        parts = list(text)
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, first: int, second: int) -> bool:
        a, b = self.text[first], self.text[second]
        return a + b not in self.rank and self._kept_apart(a, b)

    def _kept_apart(self, a: str, b: str) -> bool:
        """Whether merging the characters of both never merges across their border."""
        parts, border = [*a, *b], len(a)
        get = self.rank.get
        ranks = [get(x + y) for x, y in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return True
            if at == border - 1:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < border:
                border -= 1
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1])


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Encoder:
    """Encodes parts; one for each Python worker."""

    def __init__(self, model: Model):
        self.model = model
        self.cache: dict[str, bytes] = {}
        self.verdict_key = np.full(_VERDICTS, -1, np.int64)
        self.verdict = np.zeros(_VERDICTS, np.bool_)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.cache) > CACHED:
            # The first to be met are the most frequent ones.
            self.cache = dict(islice(self.cache.items(), CACHED // 4))
        known = self.cache.get
        cut = [self.model.parts.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        ids = [list(map(known, parts)) for parts in cut]
        gaps = [i for i, found in enumerate(ids) if None in found]
        new = self._parts(list({p for i in gaps for p, n in zip(cut[i], ids[i], strict=True) if n is None}))
        # Long parts are rarely met again and are not kept.
        self.cache.update((p, n) for p, n in new.items() if len(p) <= LONG)
        for i in gaps:
            ids[i] = [n or new[p] for p, n in zip(cut[i], ids[i], strict=True)]
        return [np.frombuffer(b"".join(found), np.int32) for found in ids]

    def _parts(self, parts: list[str]) -> dict[str, bytes]:
        found = {p: self._one(p) for p in parts if len(p) > LONG}
        rest = sorted((p for p in parts if len(p) <= LONG), key=len, reverse=True)
        start = 0
        while start < len(rest):
            rows = max(1, CELLS // (len(rest[start]) + 1))
            some = rest[start : start + rows]
            found.update(zip(some, self._many(some), strict=True))
            start += rows
        return found

    def _step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The automaton's next states."""
        m = self.model
        result = np.zeros(len(node), np.int32)
        open_at = np.flatnonzero(letter > 0)
        state = node[open_at].astype(np.int64)
        mask = (1 << m.edge_bits) - 1
        while len(open_at):
            key = state * m.width + letter[open_at]
            slot = _slots(key, m.edge_bits)
            seen = m.edge_key[slot]
            while True:  # past other keys in the same place
                other = np.flatnonzero((seen != key) & (seen >= 0))
                if not len(other):
                    break
                slot[other] = (slot[other] + 1) & mask
                seen[other] = m.edge_key[slot[other]]
            hit = seen == key
            result[open_at[hit]] = m.edge_to[slot[hit]]
            again = ~hit & (state > 0)
            open_at, state = open_at[again], m.fail[state[again]].astype(np.int64)
        return result

    def _allowed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        if not self.model.merges:
            return np.ones(len(first), np.bool_)
        free = first >= _START
        code = first.astype(np.int64) << 16 | second
        slot = _slots(code, _VERDICTS.bit_length() - 1)
        new = np.flatnonzero(~free & (self.verdict_key[slot] != code))
        result = self.verdict[slot] | free
        if len(new):
            codes, back = np.unique(code[new], return_inverse=True)
            verdicts = np.array([self.model.may_follow(c >> 16, c & 0xFFFF) for c in codes.tolist()], np.bool_)
            result[new] = verdicts[back]
            slots = _slots(codes, _VERDICTS.bit_length() - 1)
            self.verdict_key[slots], self.verdict[slots] = codes, verdicts
            # Two codes of one place: the last stays, with its own verdict.
            self.verdict[slots] = verdicts
        return result

    def _many(self, parts: list[str]) -> list[bytes]:
        """Parts in order of length, the longest first."""
        m = self.model
        size, most = len(parts), len(parts[0])
        lengths = np.array([len(p) for p in parts])
        codes = np.frombuffer("".join(p.ljust(most) for p in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = m.letter[codes.reshape(size, most)]
        best = np.full((size, most + 1), -np.inf)
        last = np.full((size, most + 1), -1, np.int32)
        best[:, 0], last[:, 0] = 0, _START
        node = np.zeros(size, np.int32)
        for p in range(most):
            alive = int(np.searchsorted(-lengths, -p))  # longer than p
            letter = letters[:alive, p]
            node = self._step(node[:alive], letter)
            unknown = np.flatnonzero(letter == 0)
            best[unknown, p + 1] = best[unknown, p] + m.score[_BYTES]
            last[unknown, p + 1] = _BYTES
            out = np.where(m.own[node] >= 0, node, m.link[node])
            rows = np.flatnonzero(out)
            out = out[rows]
            while len(rows):
                piece = m.own[out]
                start = p + 1 - m.length[piece]
                before = last[rows, start]
                score = best[rows, start] + m.score[piece]
                better = np.flatnonzero((score > best[rows, p + 1]) & (before >= 0))
                better = better[self._allowed(before[better], piece[better])]
                best[rows[better], p + 1] = score[better]
                last[rows[better], p + 1] = piece[better]
                out = m.link[out]
                rows, out = rows[out > 0], out[out > 0]
        ids = np.zeros((size, most), np.int32)
        count = np.zeros(size, np.int64)
        at = lengths.copy()
        rows = np.arange(size)
        while len(rows):
            piece = last[rows, at[rows]]
            count[rows] += 1
            ids[rows, most - count[rows]] = piece
            at[rows] -= m.length[piece]
            rows = rows[at[rows] > 0]
        plain = ~(ids == _BYTES).any(1)
        whole = memoryview(ids.tobytes())
        ends = np.arange(1, size + 1) * most
        return [
            bytes(whole[4 * (end - n) : 4 * end]) if fine else self._with_bytes(part, ids[i, most - n :])
            for i, (part, end, n, fine) in enumerate(zip(parts, ends.tolist(), count.tolist(), plain.tolist(), strict=True))
        ]

    def _with_bytes(self, part: str, ids: np.ndarray) -> bytes:
        result, at = [], 0
        for i in ids.tolist():
            if i == _BYTES:
                result += [self.model.byte_ids[b] for b in part[at].encode("utf-8", "surrogatepass")]
                at += 1
            else:
                result.append(i)
                at += len(self.model.text[i])
        return np.array(result, np.int32).tobytes()

    def _one(self, part: str) -> bytes:
        """The same pass over one long part, without tables of its length in width."""
        m = self.model
        edges = self._edges()
        best, last = [0.0], [_START]
        node = 0
        verdicts: dict[tuple[int, int], bool] = {}
        for p, c in enumerate(part):
            letter = int(m.letter[ord(c)])
            top, chosen = -np.inf, -1
            if letter:
                while True:
                    following = edges.get(node * m.width + letter)
                    if following is not None or not node:
                        node = following or 0
                        break
                    node = self._fail[node]
                out = node if self._own[node] >= 0 else self._link[node]
                while out:
                    piece = self._own[out]
                    start = p + 1 - len(m.text[piece])
                    score = best[start] + self._score[piece]
                    if score > top and last[start] >= 0:
                        pair = (last[start], piece)
                        allowed = not m.merges or pair[0] >= _START or verdicts.get(pair)
                        if allowed is None:
                            allowed = verdicts[pair] = m.may_follow(*pair)
                        if allowed:
                            top, chosen = score, piece
                    out = self._link[out]
            else:
                node, top, chosen = 0, best[p] + float(m.score[_BYTES]), _BYTES
            best.append(top)
            last.append(chosen)
        ids, at = [], len(part)
        while at:
            ids.append(last[at])
            at -= 1 if last[at] == _BYTES else len(m.text[last[at]])
        return self._with_bytes(part, np.array(ids[::-1], np.int32))

    def _edges(self) -> dict[int, int]:
        if not hasattr(self, "_edge_dict"):
            m = self.model
            used = np.flatnonzero(m.edge_key >= 0)
            self._edge_dict = dict(zip(m.edge_key[used].tolist(), m.edge_to[used].tolist(), strict=True))
            self._own, self._fail, self._link = m.own.tolist(), m.fail.tolist(), m.link.tolist()
            self._score = m.score.tolist()
        return self._edge_dict


def load(path: str, merges: bool = True) -> Model:
    """The model of a SentencePiece file. Only its pieces and scores are read."""
    import sentencepiece

    source = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(source.get_piece_size())
    plain = [i for i in every if not (source.is_control(i) or source.is_unknown(i) or source.is_unused(i) or source.is_byte(i))]
    by_byte = {int(source.id_to_piece(i)[3:5], 16): i for i in every if source.is_byte(i)}
    unknown = source.unk_id()
    return Model(
        {i: source.id_to_piece(i) for i in plain},
        {i: source.get_score(i) for i in plain},
        [by_byte.get(b, unknown) for b in range(256)],
        merges,
    )


def piece_bytes(model: Model) -> list[bytes]:
    """What each id stands for; nothing for ids that are no pieces."""
    table = [b""] * (max([*model.text, *model.byte_ids]) + 1)
    for i, text in model.text.items():
        table[i] = text.replace(MARK, " ").encode("utf-8", "surrogatepass")
    for b, i in enumerate(model.byte_ids):
        table[i] = bytes([b])
    return table


def decoded(ids, table: list[bytes]) -> str:
    data = b"".join(map(table.__getitem__, ids))
    return data.removeprefix(b" ").decode("utf-8", "replace")


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pieces, ids, and round_trip: whether the ids decode
    to the text."""

    def run(batches):
        store = worker_store()
        if store.get("pieces") != model.name:
            store.update({"pieces": model.name, "encoder": Encoder(model)})
        encoder, table = store["encoder"], piece_bytes(model)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            ids = encoder.encode(texts)
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            back = [decoded(i.tolist(), table) == t for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(np.diff(ends), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())), pa.array(back, pa.bool_()),
                ],
                names=["doc_id", "n_pieces", "ids", "round_trip"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def decode(rows: DataFrame, model: Model, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the text of their ids in a new last column; null ids give null."""
    table = piece_bytes(model)
    chosen = rows.select("*", F.col(ids_col).alias("_ids"))
    schema = pa.field(text_col, pa.string())

    def run(batches):
        for part in slices(batches):
            texts = [None if i is None else decoded(i, table) for i in part.column(part.num_columns - 1).to_pylist()]
            columns = [*part.columns[:-1], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*list(part.schema)[:-1], schema]))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return chosen.mapInArrow(run, f"{fields}, `{text_col}` string")
