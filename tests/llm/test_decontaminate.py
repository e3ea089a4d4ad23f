import random

import pytest

from gaugeline.llm import decontaminate as op
from helpers import ODD_TEXTS, frame

ITEM = "The quick brown fox jumps over the lazy dog while seven wizards quietly brew tea"
OTHER = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_tiles(item, text, size):
    """Greedy string tiling by trying everything."""
    marked_i, marked_t, tiles = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while (
                    i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k]
                    and i + k not in marked_i and j + k not in marked_t
                ):
                    k += 1
                if k >= size and (-k, i, j) < (-best[0], best[1], best[2]):
                    best = (k, i, j)
        if not best[0]:
            return len(marked_i), tiles
        marked_i.update(range(best[1], best[1] + best[0]))
        marked_t.update(range(best[2], best[2] + best[0]))
        tiles += 1


def test_tiling_by_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        item = [rng.choice("abc") for _ in range(rng.randint(1, 14))]
        text = [rng.choice("abc") for _ in range(rng.randint(1, 25))]
        found = op.Items([(7, " ".join(item))], 3).leaks(" ".join(text))
        want = brute_tiles(item, text, 3)
        assert (found[0][2:] if found else (0, 0)) == want


def test_reordered_and_clean_texts(spark):
    words = ITEM.split()
    moved = " ".join(words[8:] + ["between"] + words[:8])
    docs = [
        (1, f"before {ITEM.upper()}, after"), (2, moved), (3, "seven wizards quietly brew beer"), (4, " ".join(words[:6])),
        (5, OTHER), (6, f"{OTHER} {ITEM}"),
    ]
    items = bench(spark, [(10, ITEM), (11, OTHER), (12, None), (13, "too short"), (14, ""), (None, OTHER)])
    found = op.contaminated(frame(spark, docs, wide=True), items).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0) for r in found) == [(1, 10), (2, 10), (5, 0), (5, 11), (6, 0), (6, 10), (6, 11)]
    assert {r["tiles"] for r in found if r["doc_id"] == 2} == {2}
    kept = op.drop_contaminated(frame(spark, docs, wide=True), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4]
    assert kept.columns == frame(spark, docs, wide=True).columns


def test_blocks_change_nothing(spark, monkeypatch):
    items = bench(spark, [(i % 2 or None, f"{ITEM} {i} {OTHER}") for i in range(6)] + [(7, "quite another item of seven words")] * 3 + [(8, "on its own")])
    docs = frame(
        spark,
        [(1, ITEM), (2, "nothing at all"), (2, f"see {OTHER}"), (3, "it is quite another item of seven words"), (4, None), (5, "a\nOn its own.\n"), (3, ITEM)],
        wide=True,
    )
    whole = sorted(map(repr, op.contaminated(docs, items).collect()))
    kept = sorted(map(repr, op.drop_contaminated(docs, items).collect()))
    assert len(whole) == 16 and len(kept) == 3
    monkeypatch.setattr(op, "BLOCK_CHARS", 60)
    count, parts = op.blocks(items, 5, "item_id", "text")
    parts = list(parts)
    assert count == len(parts) > 3 and sum(len(p.items) for p in parts) == 10
    assert sorted(map(repr, op.contaminated(docs, items).collect())) == whole
    assert sorted(map(repr, op.drop_contaminated(docs, items).collect())) == kept


def brute(docs, items, size, coverage):
    """Rows of the whole search: every item tiled on every document by trying everything."""
    rows = []
    for doc, text in docs:
        have = op.words(text or "")
        lines = [op.words(part) for part in [text or "", *(text or "").splitlines()]]
        for item, passage in items:
            want = op.words(passage or "")
            if len(want) >= size:
                matched, tiles = brute_tiles(want, have, size)
                if tiles and matched >= coverage * len(want):
                    rows.append((doc, item, len(want), matched, tiles))
            elif want:
                anywhere = len(want) >= op.SHORT and any(have[i : i + len(want)] == want for i in range(len(have)))
                if anywhere or want in lines:
                    rows.append((doc, item, len(want), len(want), 1))
    return sorted(rows)


def test_whole_search_by_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    text = lambda most: " ".join(rng.choice(["ab", "cd", "ef", "Gh", "ij,"]) for _ in range(rng.randint(0, most)))
    items = [(i, text(16)) for i in range(40)] + [(40, None), (41, "")]
    docs = [(i, rng.choice([" ", "\n"]).join([text(14), rng.choice(items)[1] or "", text(6)])) for i in range(60)] + [(60, None)]
    want = brute(docs, items, 5, 0.5)
    assert len(want) > 50
    for chars in (op.BLOCK_CHARS, 300):
        monkeypatch.setattr(op, "BLOCK_CHARS", chars)
        found = op.contaminated(frame(spark, docs), bench(spark, items)).collect()
        assert sorted(tuple(r)[:5] for r in found) == want
        kept = op.drop_contaminated(frame(spark, docs), bench(spark, items)).collect()
        assert {r["doc_id"] for r in kept} == {d for d, _ in docs} - {r[0] for r in want}


def test_very_long_text_is_dropped_whole(spark):
    docs = [(1, "word " * 60_000 + ITEM), (2, "word " * 60_000)]
    assert [r["doc_id"] for r in op.drop_contaminated(frame(spark, docs), bench(spark, [(1, ITEM)])).collect()] == [2]


@pytest.mark.parametrize("docs", [ODD_TEXTS, []], ids=["odd", "empty"])
@pytest.mark.parametrize("items", [[(1, ITEM)], []], ids=["items", "none"])
def test_odd_rows(spark, docs, items):
    table = frame(spark, docs, wide=True)
    assert op.contaminated(table, bench(spark, items)).count() == 0
    assert op.drop_contaminated(table, bench(spark, items)).count() == len(docs)


def test_unspaced_scripts_and_short_items(spark):
    chinese = "今天天气很好，我们一起去公园散步，看见许多孩子在草地上放风筝，真是快乐的一天。"
    thai = "วันนี้อากาศดีมากเราไปเดินเล่นที่สวนสาธารณะด้วยกัน"
    items = bench(spark, [(1, chinese), (2, thai), (3, "Ada Lovelace"), (4, "the lazy brown fox"), (5, "东京")])
    docs = [
        (10, f"前面的话。{chinese}后面的话。"), (11, thai), (12, "ada lovelace"), (13, "Who?\nAda Lovelace.\nYes"),
        (14, "see Ada Lovelace there"), (15, "It is the lazy brown fox again"), (16, "the lazy old brown fox"), (17, "东京"), (18, "我住在东京市"), (19, "完全不同的句子"),
    ]
    found = op.contaminated(frame(spark, docs), items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(10, 1), (11, 2), (12, 3), (13, 3), (15, 4), (17, 5)]
    assert sorted(r["doc_id"] for r in op.drop_contaminated(frame(spark, docs), items).collect()) == [14, 16, 18, 19]
