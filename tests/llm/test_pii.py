import hashlib
import re

import pytest

from gaugeline.llm import pii
from helpers import ODD_TEXTS, frame, real_texts

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
HARD = [
    (100, "a@b.c.@d.e x@y a@b@c.d .@-.- +1 (988) 555-2485 1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0004"),
    (101, "4041894974608795 4041-8949 7460-8795 4041894974608796 +49 30 1234567890123456 +(1)"),
    (102, "é🙂 a@b.de 中 1.1.1.1 DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 XX00ABCD1234567"),
    (103, "ssn 123-45-6789 and 123-45-6789 far " + "z" * 60 + " 123-45-6789"),
    (104, "1." * 20_000 + "a@" * 5_000 + "+1-" * 5_000),
    (105, "1 " * 30_000 + "q" * 9_000 + "a." * 5_000),
    (106, "a@b" + ".c" * 20_000),
]


def base(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))] if kind == "card" else []
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fine:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


@pytest.mark.parametrize("rows", [ODD_TEXTS, HARD, real_texts(), []], ids=["odd", "hard", "real", "empty"])
def test_base_spans(spark, rows):
    got = sorted((tuple(r) for r in pii.pii_report(frame(spark, rows, wide=True)).collect()), key=repr)
    want = []
    for i, t in rows:
        spans = base(t)
        counts = [sum(s.startswith(k) for s in spans) for k, _ in PATTERNS]
        want.append((i, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert [g[:6] for g in got] == sorted(want, key=repr)


def test_added_kinds(spark):
    spans = {r["doc_id"]: r["spans"] for r in pii.pii_report(frame(spark, HARD)).collect()}
    text = dict(HARD)[102]
    found = [s.split(":") for s in spans[102].split(",") if s.startswith("iban")]
    assert [text[int(a) : int(b)] for _, a, b in found] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    assert spans[103].count("ssn") == 2  # the last has no word about it nearby


def test_account_numbers_end_at_the_length_of_their_country(spark):
    rows = [
        (1, "ES9121000418450200051332 EUR 25"), (2, "ES91 2100 0418 4502 0005 1332 25 May"), (3, "AT611904300234573201 BIC BKAUATWW"),
        (4, "NO9386011117947 12 and ES9121000418450200051332 DE89 3704 0044 0532 0130 00 EUR"), (5, "ES9121000418450200051333 EUR"),
    ]
    want = {
        1: ["ES9121000418450200051332"], 2: ["ES91 2100 0418 4502 0005 1332"], 3: ["AT611904300234573201"],
        4: ["NO9386011117947", "ES9121000418450200051332", "DE89 3704 0044 0532 0130 00"], 5: [],
    }
    for r in pii.pii_report(frame(spark, rows)).collect():
        found = [s.split(":") for s in r["spans"].split(",") if s.startswith("iban")]
        assert [dict(rows)[r["doc_id"]][int(a) : int(b)] for _, a, b in found] == want[r["doc_id"]]


EDGES = [
    (1, "ssn X123-45-6789"), (2, "ssn 123-45-67890"), (3, "ssn -123-45-6789"), (4, "ssn 123-45-6789-1"), (5, "ssn: 123-45-6789."),
    (6, "classname 123-45-6789"), (7, "Social Security 123-45-6789,123-45-6780"), (8, "ssn_ 123-45-6789"), (9, "SSNs (123-45-6789)"),
    (10, "ssn _123-45-6789"), (11, "ssn \u00e9123-45-6789"),
]


def test_both_ends_of_a_number_and_whole_words(spark):
    found = {r["doc_id"]: r["spans"] for r in pii.pii_report(frame(spark, EDGES)).collect()}
    assert [i for i, s in sorted(found.items()) if s] == [5, 7, 9, 11]
    assert found[5] == "ssn:5:16" and found[7] == "ssn:16:27,ssn:28:39" and found[9] == "ssn:6:17"


def test_sql_has_the_same_rules(spark):
    import duckdb

    from gaugeline.llm.sql import pii_sql

    rows = [r for r in [*EDGES, *HARD[:4]] if len(r[1]) < 3000]
    rows += [
        (20, "ES9121000418450200051332 EUR 25"), (21, "bank ES91 2100 0418 4502 0005 1332 25 May"), (22, "AT611904300234573201 BIC BKAUATWW"),
        (23, "NO9386011117947 12 and ES9121000418450200051332 DE89 3704 0044 0532 0130 00 EUR"), (24, "ES9121000418450200051333 EUR"),
        (25, "telephone +1 (988) 555-2485, emails a@b.de, subway card 4041894974608795"),
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cursor = con.execute(pii_sql())
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(dict(zip(names, r, strict=True)).items()) for r in cursor.fetchall())
    got = sorted(tuple((n, r[n]) for n in names) for r in pii.pii_report(frame(spark, rows)).collect())
    assert got == want


def test_no_python_in_the_plan(spark):
    plan = pii.pii_report(frame(spark, HARD))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
