import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from hybridflow.llm import mixing
from hybridflow.llm.mixing import mix_sources


def many(n=600):
    return [(i, " ".join(["w"] * (i % 17)), ["a", "b", "c", "d", None][(i * i) % 5]) for i in range(n)]


def test_targets_are_met_to_the_word(docs_of):
    rows = mix_sources(docs_of(many())).collect()
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        size[r["source"]] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    assert all(target[s] <= 2 * size[s] for s in target)


def test_reruns_and_ranges_agree(docs_of):
    a = {r["doc_id"]: r["taken"] for r in mix_sources(docs_of(many(), 2)).collect()}
    b = {r["doc_id"]: r["taken"] for r in mix_sources(docs_of(many(), 5), rows_per_range=7).collect()}
    assert a == b


def test_a_source_takes_whole_epochs_before_a_part(docs_of):
    for r in mix_sources(docs_of(many())).collect():
        if r["source_size"] and r["target"] >= r["source_size"]:
            assert r["taken"] >= r["size"]


def plain_mix(rows, seed=17):
    """Words taken, by taking epochs and then documents one after the other."""
    size = Counter()
    for _, text, source in rows:
        size[source] += len((text or "").split())
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    want, left, target = 1.5 * sum(size.values()), set(order), {}
    while left:
        level = (want - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if 2 * size[s] < level * weight[s]}
        target |= {s: 2 * size[s] for s in full} if full else {s: level * weight[s] for s in left}
        left = left - full if full else set()

    def key(i, text):
        letters = len(re.findall(r"[^\W\d_]", text or ""))
        u = (int(hashlib.md5(f"{'' if i is None else i}:{seed}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        return -math.log(u) / (0.25 + 0.75 * letters / max(len(text or ""), 1))

    out = Counter()
    for s in order:
        whole = math.floor(target[s] / size[s]) if size[s] else 0
        rest = math.floor(target[s] - whole * size[s])
        for _, i, text in sorted(((key(i, t), i, t) for i, t, x in rows if x == s), key=lambda r: r[0]):
            n = len((text or "").split())
            part = max(0, min(n, rest))
            rest -= part
            out[(i, s, n, whole * n + part)] += 1
    return out


def test_as_plain_sampling(docs_of):
    rows = many(300)
    got = Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in mix_sources(docs_of(rows), rows_per_range=13).collect())
    assert got == plain_mix(rows)


@pytest.mark.parametrize("at_a_time", [10_000, 7])
def test_a_third_of_the_rows_repeated(docs_of, monkeypatch, at_a_time):
    """Rows alike in id and text are placed as one, and each is taken on its own."""
    monkeypatch.setattr(mixing, "COPIES", at_a_time)
    rows = many(200) + [(5, "w w w w w", "a")] * 60 + [(None, "x y", "b")] * 40
    frame = mix_sources(docs_of(rows), rows_per_range=10)
    got = Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in frame.collect())
    assert got == plain_mix(rows) and sum(got.values()) == 300


def test_odd_rows_and_empty_table(docs_of, odd_rows):
    rows = mix_sources(docs_of([(i, t, None if k % 2 else "s") for k, (i, t) in enumerate(odd_rows)])).collect()
    assert len(rows) == len(odd_rows)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mix_sources(docs_of([])).count() == 0
    assert [r["taken"] for r in mix_sources(docs_of([(1, None), (2, " ")])).collect()] == [0, 0]
