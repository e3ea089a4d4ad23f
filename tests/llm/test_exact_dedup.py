import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeline.llm import exact_dedup as op
from gaugeline.llm.cuckoo import CuckooIndex
from helpers import ODD_TEXTS, frame, real_texts


def brute(rows):
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(bare(t), []).append((-len(t or ""), i is None, i or 0, i))
    return sorted(
        (
            (i, min(groups[bare(t)])[3], len(groups[bare(t)]), i == min(groups[bare(t)])[3], hashlib.sha256(bare(t).encode()).hexdigest())
            for i, t in rows
        ),
        key=repr,
    )


@pytest.mark.parametrize("rows", [ODD_TEXTS, real_texts(), []], ids=["odd", "real", "empty"])
def test_against_brute_force(spark, rows):
    found = op.exact_dedup(frame(spark, rows, wide=True)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows)


def test_deleted_digests_are_new_again(spark):
    old = op.digests(frame(spark, [(5, "a b"), (6, "ab"), (7, "c")]))
    index = op.build(old)
    gone = op.digests(frame(spark, [(6, "ab")]))
    new = op.digests(frame(spark, [(9, "a  b"), (8, "c")]))
    after = {r["keep_id"]: r["copies"] for r in op.change(index, new, gone).collect()}
    assert after == {9: 1, 7: 2}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 400)), max_size=900))
def test_cuckoo_index_is_a_set(steps):
    index, live = CuckooIndex(buckets=2), set()
    for add, number in steps:
        # Few fingerprints and buckets, so that different digests meet in both.
        digest = hashlib.sha256(bytes([number % 256, number // 256])).digest()
        digest = digest[:1] + bytes(7) + digest[8:9] + bytes(1) + digest[10:]
        if add and digest not in live:
            index.insert(digest, number)
            live.add(digest)
        elif not add:
            assert index.delete(digest) == (digest in live)
            live.discard(digest)
        assert (index.find(digest) >= 0) == (digest in live)
    assert {k for k, _ in index.items()} == live and index.live == len(live)
    assert all(index.values[index.find(k)] == v for k, v in index.items())
