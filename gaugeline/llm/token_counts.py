"""Token counts of byte-level BPE by a map-side two-tier lookup.

A text is cut where white space follows something else. Byte-level BPE
(``ByteLevel`` with its own pattern and no prefix space) never joins characters
over such a place, so the counts of the pieces add up to the count of the text.
The first tier is a compact table of frequent pieces and their token counts: one
text of all pieces and one byte per count, sent to the tasks and unpacked once per
Python worker.
Pieces that are not in it go to the second tier, a cache per worker
that the tokenizer fills and that is emptied at ``CACHE_PIECES``. Nothing is
shuffled but the piece counts of the bounded sample that fills the first tier.

The first tier is a cache and nothing else: any table gives the same counts. It is
filled from ``SAMPLE_DOCS`` documents, those with the smallest hash of their id,
and from at most ``SAMPLE_CHARS`` code points of each, and holds at most
``FREQUENT`` pieces of at most ``PIECE_CHARS`` code points.

The tokenizer's special strings inside a text are one token each, as by its
default; texts are cut at them first. Characters that Python takes for white space
and the tokenizer does not (U+001C to U+001F) would be cut wrongly, so a text with
one of them goes to the tokenizer whole.

Defined cases: null text is empty and has no token; each input row gives one row,
repeated ids included; an empty table gives an empty result. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import bounded_sample, id_and_text, slices, worker_store

FREQUENT = 60_000
PIECE_CHARS = 48
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 8_192
CACHE_PIECES = 200_000
#: A piece longer than this is never kept in a worker's cache.
CACHED_CHARS = 256

_PIECES = re.compile(r"\s*\S+|\s+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def pieces(text: str) -> list[str]:
    return _PIECES.findall(text)


class _Counter:
    """The two tiers of one worker."""

    def __init__(self, path: str, names: str, counts: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.frequent = dict(zip(names.split("\x1c"), counts, strict=True)) if counts else {}
        self.known = dict(self.frequent)  # first tier, then what the cache adds

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        counts, open_at, open_pieces = [], [], []
        if len(self.known) > len(self.frequent) + CACHE_PIECES:
            self.known = dict(self.frequent)
        known = self.known.get
        for text in texts:
            if _ODD_SPACE.search(text):
                counts.append(self._encode([text])[0])
                continue
            total, parts = 0, (text,)
            if self.special:
                parts = self.special.split(text)
                total = len(parts) - 1
            for part in parts:
                found = pieces(part)
                lengths = list(map(known, found))
                if None in lengths:
                    missing = [p for p, n in zip(found, lengths, strict=True) if n is None]
                    open_pieces += missing
                    open_at += [len(counts)] * len(missing)
                    total += sum(n for n in lengths if n is not None)
                else:
                    total += sum(lengths)
            counts.append(total)
        if open_pieces:
            unique = list(dict.fromkeys(open_pieces))
            new = dict(zip(unique, self._encode(unique), strict=True))
            for at, piece in zip(open_at, open_pieces, strict=True):
                counts[at] += new[piece]
            self.known.update((p, n) for p, n in new.items() if len(p) <= CACHED_CHARS)
        return counts


def frequent_pieces(docs: DataFrame, path: str) -> tuple[str, bytes]:
    """The first tier from a bounded sample: the pieces as one text, their counts as bytes."""
    from tokenizers import Tokenizer

    def cut(batches):
        for batch in batches:
            found = [p for t in batch.column(0).to_pylist() for p in pieces(t) if len(p) <= PIECE_CHARS and not _ODD_SPACE.search(p)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["piece"])

    ids = [r[0] for r in bounded_sample(docs.select("doc_id"), SAMPLE_DOCS)]
    sample = docs.filter(F.col("doc_id").isin(ids)).select(F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    top = (
        sample.mapInArrow(cut, "piece string").groupBy("piece").count()
        .orderBy(F.desc("count"), "piece").limit(FREQUENT).select("piece").toArrow().column(0).to_pylist()
    )
    tokenizer = Tokenizer.from_file(path)
    lengths = [len(e) for e in tokenizer.encode_batch_fast(top, add_special_tokens=False)]
    both = [(p, n) for p, n in zip(top, lengths, strict=True) if n < 256]
    return "\x1c".join(p for p, _ in both), bytes(n for _, n in both)


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. ``path`` is the
    tokenizer's file, which every executor must have at the same place."""
    rows = id_and_text(docs, id_col, text_col)
    names, counts = frequent_pieces(rows, path)

    def count(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        store = worker_store()
        if store.get("counts") != (path, names, counts):
            store.update({"counts": (path, names, counts), "counter": _Counter(path, names, counts)})
        counter = store["counter"]
        for part in slices(batches):
            n = counter.count(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    counted = rows.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
