import random

import brute
import numpy as np
import pytest
from brute import prose

from hybridflow.llm import minhash
from hybridflow.llm.minhash import drop_near_duplicates, near_duplicates


def families(seed, n=8, each=9):
    """Families of texts that differ in some words, so that similarities lie around the threshold."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        base = prose(rng, 120).split()
        for _ in range(each):
            words = list(base)
            for _ in range(rng.randint(0, 7)):
                words[rng.randrange(len(words))] = prose(rng, 1)
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [1000, 3])
def test_components_as_brute_force(docs_of, block):
    rows = families(1)
    sets = {i: brute.shingles(t, 4) for i, t in rows}
    want = brute.groups(sets, brute.near_pairs(sets, 80))
    got = {r["doc_id"]: r for r in near_duplicates(docs_of(rows), size=4, block=block).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_links_that_miss_the_first_member_are_found(docs_of, monkeypatch):
    """One bucket for all: every pair must still be looked at, whatever the first member is like."""
    monkeypatch.setattr(minhash, "least_agreement", lambda n, percent: 0)
    rows = families(2, n=3, each=6)
    sets = {i: brute.shingles(t, 4) for i, t in rows}
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs_of(rows), size=4, bands=1, rows=1).collect()}
    want = brute.groups(sets, brute.near_pairs(sets, 80))
    assert all(want[got[i]] == want[i] for i in got)  # never joined without a link


def test_signatures_tell_long_texts_apart():
    """Minima of large sets are small numbers; what is kept of them must differ all the same."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 5000).astype(np.uint64)
    family = minhash.hash_family(128, 3)

    def signature(items):
        return minhash.sh.mix(minhash.minima(np.sort(items), family)).astype(np.uint8)

    def agreement(share):
        other = np.concatenate([base[: int(share * 5000)], rng.integers(0, 2**63, 5000 - int(share * 5000)).astype(np.uint64)])
        both = int(share * 5000) / (10_000 - int(share * 5000))
        return (signature(base) == signature(other)).mean(), both

    for share in (0.0, 0.5, 0.9):
        found, similarity = agreement(share)
        assert abs(found - similarity) < 0.2
    assert agreement(0.3)[0] * 128 < minhash.least_agreement(128, 80)


def test_odd_rows(docs_of, odd_rows):
    got = near_duplicates(docs_of(odd_rows), size=4).collect()
    assert len(got) == len(odd_rows)
    by = {(r["doc_id"], r["n_shingles"]): r for r in got}
    assert by[(1, 0)]["component_id"] == 1 and by[(3, 0)]["kept"]
    assert all(r["component_id"] == 5 for r in got if r["doc_id"] in (5, 6, 7))
    assert [r["component_id"] for r in got if r["doc_id"] is None and r["n_shingles"]] == [5]
    assert all(r["component_id"] == 8 for r in got if r["doc_id"] in (8, 9))
    assert near_duplicates(docs_of([]), size=4).count() == 0


def test_filter_keeps_one_of_each_group(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    out = drop_near_duplicates(docs, size=5)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    ids = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert ids == [1, 2, 3, 4, 5, 8, 10, 10, 11]


def test_repeated_rows_leave_one(docs_of):
    text = "a b c d e f g h"
    assert drop_near_duplicates(docs_of([(1, text), (1, text), (2, text)])).count() == 1
    assert drop_near_duplicates(docs_of([(None, text), (None, text)])).count() == 1
    assert drop_near_duplicates(docs_of([])).count() == 0
