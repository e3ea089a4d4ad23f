"""Personal data in text, with DataFrame functions only.

Regular expressions propose spans, checks on the found text confirm them (Luhn for
cards, modulo 97 for bank account numbers, number ranges for addresses), and words
shortly before a span, whole ones, raise its score. The kinds ``email``, ``ip``, ``card`` and
``phone`` stand by their pattern and check alone. ``iban`` and ``ssn`` are added by
the method: a span counts when its score reaches ``ACCEPT``.

Positions are code points. The matches of a pattern come from ``regexp_extract_all``
and the lengths between them from ``split`` by the same pattern; running totals of
both give the starts. The patterns never give back what they took (possessive
quantifiers), so that very long runs need neither stack nor quadratic time; they
match exactly what the plain forms in the SQL match. An ``iban`` ends at the length of
its country; neither end of an ``ssn`` may touch a letter, digit, hyphen or underscore.

Defined cases: null text is empty; a text without spans gives zero counts, an empty
``spans`` and the digest of empty text; each input row gives one row, repeated ids
included. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import id_and_text

ACCEPT = 70
CONTEXT_CHARS = 40
_BLOCK = 256

#: Characters of an account number by country, as registered under ISO 13616.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """An account number ends where its country's length does; one of a country without
    a registered length where the groups end."""
    known = [
        f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]{{4}}){{{(size - 4) // 4}}}"
        + (f"\\x20?[A-Z0-9]{{{size % 4}}}" if size % 4 else "")
        for size, codes in _IBAN_LENGTHS.items()
    ]
    taken = "|".join(_IBAN_LENGTHS.values()).replace(" ", "|")
    other = f"(?!{taken})[A-Z]{{2}}[0-9]{{2}}(?:\\x20?[A-Z0-9]{{4}}){{2,7}}(?:\\x20?[A-Z0-9]{{1,3}})?"
    return f"(?:^|[^A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*known, other])})"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: int
    words: str
    bonus: int
    base: bool = True


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        90, "e?-?mails?|contact|write", 10,
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        70, "ips?|servers?|hosts?|address(?:es)?", 25,
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 75, "cards?|credit|visa|payments?", 20),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 70, "(?:tele)?phones?|tel|call|mobile", 25),
    Kind(
        "iban",
        _iban_pattern(),
        80, "ibans?|bank|accounts?", 15, base=False,
    ),
    Kind(
        "ssn",
        r"(?<![A-Za-z0-9_-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_-])",
        45, "ssns?|social security", 50, base=False,
    ),
)


def running_totals(numbers: Column) -> Column:
    """Inclusive running totals of an array, by blocks: the work per element stays
    bounded however many matches a text has."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    count = F.size(numbers)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((count - 1) / _BLOCK), F.lit(0)).cast("int")),
        lambda b: F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    sums = F.transform(blocks, total)
    return F.flatten(
        F.transform(
            F.arrays_zip(blocks.alias("block"), _before(sums).alias("before")),
            lambda b: F.transform(
                b["block"], lambda x, i: b["before"] + total(F.slice(b["block"], F.lit(1), i + 1))
            ),
        )
    )


def _before(sums: Column) -> Column:
    return F.transform(
        sums, lambda x, i: F.aggregate(F.slice(sums, F.lit(1), i), F.lit(0), lambda s, y: s + y)
    )


def luhn(digits: Column) -> Column:
    """Whether a text of digits has a sound Luhn check digit."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    doubled = F.transform(
        each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(account: Column) -> Column:
    """Remainder of an account number, country and check digits moved to the end
    and letters read as 10 to 35."""
    turned = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))
    return F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        F.lit(0),
        lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97).otherwise(
            (r * 100 + F.ascii(c) - 55) % 97
        ),
    )


def _confirmed(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        account = F.regexp_replace(found, "[^A-Z0-9]", "")
        return F.length(account).between(15, 34) & (mod97(account) == 1)
    return F.lit(True)


def _spans(kind: Kind, order: int) -> Column:
    """Confirmed spans of one kind: struct(start, order, end, score)."""
    text, found, starts = F.col("text"), F.col(f"{kind.name}_found"), F.col(f"{kind.name}_starts")

    def span(pair: Column) -> Column:
        # A pattern that takes the character before the span leaves it out here.
        lead = (
            F.when(pair["found"].rlike("^[A-Z0-9]"), 0).otherwise(1) if not kind.base else F.lit(0)
        )
        start = pair["start"] + lead
        context = F.substring(
            text, F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT_CHARS))
        )
        score = F.when(context.rlike(f"(?i)(?<![A-Za-z0-9_])(?:{kind.words})(?![A-Za-z0-9_])"), kind.score + kind.bonus).otherwise(kind.score)
        return F.struct(
            start.alias("start"),
            F.lit(order).alias("order"),
            (pair["start"] + F.length(pair["found"])).alias("end"),
            score.alias("score"),
        )

    # Zipped outside the lambdas, where nothing is computed again for each element.
    pairs = F.filter(
        F.arrays_zip(found.alias("found"), starts.alias("start")), lambda p: _confirmed(kind.name, p["found"])
    )
    return F.filter(F.transform(pairs, span), lambda s: s["score"] >= ACCEPT)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["order"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def _gaps(kind: Kind) -> Column:
    """The code points before each match, with those of the match before it: the
    running total is where the match starts."""
    found = F.col(f"{kind.name}_found")
    pieces = F.slice(F.split("text", kind.pattern, -1), F.lit(1), F.size(found))
    shifted = F.concat(F.array(F.lit("")), F.slice(found, F.lit(1), F.size(found) - 1))
    lengths = F.zip_with(pieces, shifted, lambda p, m: F.length(p) + F.length(m))
    return F.when(F.size(found) == 0, F.array().cast("array<int>")).otherwise(lengths)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id and spans, an array of (start, order, end, score) by
    start and then kind; ``order`` counts ``KINDS``."""
    rows = id_and_text(docs, id_col, text_col)
    for kind in KINDS:
        rows = rows.withColumn(f"{kind.name}_found", F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0)))
    rows = rows.withColumns({f"{k.name}_gaps": _gaps(k) for k in KINDS})
    rows = rows.withColumns({f"{k.name}_starts": running_totals(F.col(f"{k.name}_gaps")) for k in KINDS})
    rows = rows.withColumns({f"{k.name}_spans": _spans(k, i) for i, k in enumerate(KINDS)})
    return rows.select(
        "doc_id", F.array_sort(F.concat(*[F.col(f"{k.name}_spans") for k in KINDS])).alias("spans")
    )


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a count per base kind, base_sha256, spans and their scores as text."""
    found = pii_spans(docs, id_col, text_col)
    base = [i for i, k in enumerate(KINDS) if k.base]
    of = lambda i: F.size(F.filter("spans", lambda s: s["order"] == i)).cast("long")
    return found.select(
        "doc_id",
        *[of(i).alias(f"n_{KINDS[i].name}") for i in base],
        F.sha2(_joined(F.filter("spans", lambda s: s["order"] <= base[-1])).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
