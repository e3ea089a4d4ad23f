"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from gaugeline.llm.pii import _IBAN_LENGTHS

EXACT_DEDUP_SQL = r"""
WITH marked AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY bare ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY bare) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY bare ORDER BY chars DESC, doc_id) AS kept,
       sha256(bare) AS text_sha256
FROM marked
"""


def _iban_sql() -> str:
    """The patterns of the countries with a registered length first; numbers of these with
    another length match the last one and are refused when confirmed."""
    known = [
        f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]{{4}}){{{(size - 4) // 4}}}"
        + (f"\\x20?[A-Z0-9]{{{size % 4}}}" if size % 4 else "")
        for size, codes in _IBAN_LENGTHS.items()
    ]
    other = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
    return f"(?:^|[^A-Za-z0-9])(?:{'|'.join([*known, other])})"


_IBAN_LENGTH = " ".join(
    f"WHEN bare[:2] IN ({', '.join(repr(c) for c in codes.split())}) THEN length(bare) = {size}" for size, codes in _IBAN_LENGTHS.items()
)
_PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 90, "e?-?mails?|contact|write", 10, 0),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", 70, "ips?|servers?|hosts?|address(?:es)?", 25, 0),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", 75, "cards?|credit|visa|payments?", 20, 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 70, "(?:tele)?phones?|tel|call|mobile", 25, 0),
    ("iban", _iban_sql(), 80, "ibans?|bank|accounts?", 15, 1),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 45, "ssns?|social security", 50, 0),
)

_CONFIRMED = """CASE kind
    WHEN 'ip' THEN list_max(list_transform(string_split(found, '.'), lambda p: CAST(p AS HUGEINT))) <= 255
    WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(
        range(length(digits)), lambda i: CASE WHEN i % 2 = 0 THEN CAST(digits[length(digits) - i] AS INT)
        ELSE (2 * CAST(digits[length(digits) - i] AS INT)) // 10 + (2 * CAST(digits[length(digits) - i] AS INT)) % 10 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
    WHEN 'ssn' THEN NOT regexp_matches(substr(text, CAST(greatest(pos, 1) AS BIGINT), CAST(least(pos, 1) AS BIGINT)) || ' ' || substr(text, CAST(pos + length(found) + 1 AS BIGINT), 1), '[A-Za-z0-9_-]')
    WHEN 'iban' THEN length(bare) BETWEEN 15 AND 34 AND (CASE """ + _IBAN_LENGTH + """ ELSE TRUE END) AND list_reduce(list_prepend(0, list_transform(
        string_split(bare[5:] || bare[:4], ''), lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS INT))),
        lambda r, c: (CASE WHEN c < 10 THEN r * 10 ELSE r * 100 END + c) % 97) = 1
    ELSE TRUE END"""


def pii_sql() -> str:
    parts = "\n  UNION ALL\n".join(
        f"""  SELECT doc_id, text, '{name}' AS kind, {order} AS ord, {score} AS score, {bonus} AS bonus, '{words}' AS words,
         {lead} AS may_lead, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS gaps
  FROM whole"""
        for order, (name, pattern, score, words, bonus, lead) in enumerate(_PII)
    )
    return f"""
WITH whole AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS (
{parts}),
each AS (
  SELECT doc_id, text, kind, ord, score, bonus, words, may_lead, hits[i] AS found,
         list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0) AS pos
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM hits WHERE len(hits) > 0)),
checked AS (
  SELECT *, regexp_replace(found, '[^0-9]', '', 'g') AS digits, regexp_replace(found, '[^A-Z0-9]', '', 'g') AS bare FROM each),
placed AS (
  SELECT doc_id, text, kind, ord, score, bonus, words, pos + length(found) AS till,
         CAST(pos + CASE WHEN may_lead = 1 AND NOT regexp_matches(found, '^[A-Z0-9]') THEN 1 ELSE 0 END AS BIGINT) AS pos
  FROM checked WHERE {_CONFIRMED}),
scored AS (
  SELECT doc_id, kind, ord, pos, CAST(till AS BIGINT) AS till,
         score + CASE WHEN regexp_matches(substr(text, greatest(pos - 40, 0) + 1, least(pos, 40)), '(?i)\\b(?:' || words || ')\\b') THEN bonus ELSE 0 END AS score
  FROM placed),
spans AS (
  SELECT doc_id,
         count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || pos || ':' || till, ',' ORDER BY pos, ord) FILTER (ord < 4) AS base,
         string_agg(kind || ':' || pos || ':' || till, ',' ORDER BY pos, ord) AS spans,
         string_agg(CAST(score AS VARCHAR), ',' ORDER BY pos, ord) AS scores
  FROM scored WHERE score >= 70 GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id
"""


#: crc32 of a number as text, bit by bit; a null is the empty text.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    list_filter(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: c <> ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _levels(first: str, count: int, tag: str) -> str:
    """Groups of 16 nodes (g, p, h, n) level by level; n is the number of nodes of the tree."""
    parts, source = [], first
    for k in range(count):
        parts.append(f"""
{tag}r{k} AS (SELECT g, p // 16 AS p, list(h ORDER BY p) AS hs, any_value(n) AS n FROM {source} GROUP BY g, p // 16),
{tag}l{k} AS (SELECT g, p, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, (n + 15) // 16 AS n FROM {tag}r{k})""")
        source = f"{tag}l{k}"
    return ",".join(parts)


def _folds(first: str, count: int, tag: str) -> str:
    parts, source = [], first
    for k in range(count):
        parts.append(f"""
{tag}f{k} AS (
  SELECT f.* REPLACE (f.p // 16 AS p,
      CASE WHEN n > 1 THEN sha256(array_to_string(hs[:f.p % 16] || [f.h] || hs[f.p % 16 + 2:], '')) ELSE f.h END AS h,
      f.proof || CASE WHEN n > 1 THEN array_to_string(hs[:f.p % 16] || hs[f.p % 16 + 2:], '') ELSE '' END AS proof)
  FROM {source} f JOIN {tag}r{k} r ON f.g IS NOT DISTINCT FROM r.g AND f.p // 16 = r.p)""")
        source = f"{tag}f{k}"
    return ",".join(parts)


def merkle_sql(depth: int = 6, top: int = 4) -> str:
    """Enough levels for 16 ** depth rows of a source and 16 ** top sources."""
    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH leaves AS (
  SELECT doc_id, source, sha256({head} || {field("text")}) AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN sha256({head} || {field(low)}) END AS shown
  FROM documents),
base AS (
  SELECT *, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
nodes AS (SELECT g, p, leaf AS h, n FROM base),{_levels("nodes", depth, "s")},
tops AS (
  SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p, h, count(*) OVER () AS n, g AS source
  FROM sl{depth - 1}),{_levels("tops", top, "t")},
fold0 AS (SELECT doc_id, leaf, source, g, p, coalesce(shown, leaf) AS h, '' AS proof FROM base),{_folds("fold0", depth, "s")},
fold1 AS (
  SELECT f.doc_id, f.leaf, t.h AS subroot, t.g, t.p, f.h, f.proof
  FROM sf{depth - 1} f JOIN tops t ON f.source IS NOT DISTINCT FROM t.source),{_folds("fold1", top, "t")}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM tf{top - 1} f, tl{top - 1} r
"""


RUNS_SQL = rf"""
WITH texts AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words, {_CRC} AS h
  FROM documents),
sized AS (SELECT *, len(words) AS n, h // 10 AS g FROM texts),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
edited AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN words ELSE
      list_transform(range(n), lambda i: words[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) END AS words
  FROM placed),
each AS (SELECT doc_id, i, words[i + 1] AS word FROM (SELECT *, unnest(range(n)) AS i FROM edited)),
grams AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER four AS gram, count(*) OVER four AS n FROM each
  WINDOW four AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS period FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i
  WHERE a.n = 4 AND b.n = 4),
islands AS (
  SELECT doc_id, period, i, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT doc_id, min(i) AS start, period + count(*) + 3 AS length, period FROM islands GROUP BY doc_id, period, island),
runs AS (
  SELECT doc_id, start, length, min(period) AS period FROM stretches
  WHERE length >= greatest(12, 2 * period) GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         max(struct_pack(l := length, s := -start, p := -period)) AS best
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.s AS start, best.l AS length, -best.p AS period,
       CAST(1000 * best.l // -best.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
