"""Rows that an operator must survive."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\n\r\x0b\f "), (4, "one"), (5, "one two"), (6, "Same words here"), (7, "Same words here"),
    (8, "same  words\there"), (9, "é中🙂 \x00 ﬁ"), (10, "x" * 30_000), (11, "word " * 6_000), (12, "12 " * 4_000),
    (13, "a.b@c.d " * 300), (None, "no id at all"), (14, "twice"), (14, "twice"), (15, "0" * 5_000 + "." * 2_000 + "@" * 500),
]

#: Names that operators use inside.
CLASHING = "id key digest label score seed start windows region text_hash component size _n _label _key packed third spans".split()


def frame(spark, rows, wide: bool = False):
    """``documents`` of (doc_id, text) rows, with clashing columns if ``wide``."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    return docs.withColumns({c: F.lit(c) for c in CLASHING}) if wide else docs


def real_texts(count: int = 150):
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"])
    return [(r["doc_id"], r["text"]) for r in table.slice(0, count).to_pylist()]
