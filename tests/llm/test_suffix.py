import random
import time

import brute
import numpy as np
import pytest

from hybridflow.llm import suffix_dedup
from hybridflow.llm.suffix_dedup import agreements, intervals, remove_repeats


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(50):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s))
            parts += [s[a : a + rng.randint(0, 150)], word()]
        rows.append((i, "".join(parts)))
    return [*rows, (50, rows[3][1]), (51, "ab " * 200), (52, "x" * 500), (53, rows[3][1] + "!")]


@pytest.mark.parametrize("task_rows", [100_000, 2])
def test_as_brute_force(docs_of, task_rows):
    rows = planted(1)
    got = {r["doc_id"]: r for r in remove_repeats(docs_of(rows), length=40, seed=10, task_rows=task_rows).collect()}
    for (i, _), (size, removed, spans, kept) in zip(rows, brute.repeated_bytes([t for _, t in rows], 40), strict=True):
        r = got[i]
        assert (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) == (size, removed, spans, kept), i


def checked(docs_of, rows, **options):
    """Rows as brute force gives them, in any order."""
    got = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"] or []), len(r["spans"] or []), bytes(r["kept"]))
        for r in remove_repeats(docs_of(rows), **options).collect()
    )
    plain = brute.repeated_bytes([t for _, t in rows], options["length"])
    want = sorted((i is None, i or 0, size, removed, spans, kept) for (i, _), (size, removed, spans, kept) in zip(rows, plain, strict=True))
    assert got == want


def test_a_third_of_the_rows_repeated_and_null_ids(docs_of):
    rows = planted(4)
    checked(docs_of, rows + [rows[5]] * 20 + [(None, rows[7][1])] * 15 + [(None, None)] * 4 + [(9, "short")] * 3, length=40, seed=10)


def test_many_equal_rows_make_few_contexts(spark, docs_of, monkeypatch):
    """Work grows with the number of equal rows, not with its square."""
    cuts, sizes = suffix_dedup.Cuts, []
    cut = cuts.cut
    monkeypatch.setattr(cuts, "cut", lambda self, df: sizes.append(cut(self, df)) or sizes[-1])
    kept = []
    monkeypatch.setattr(cuts, "drop", lambda self, *tables: kept.extend(tables))
    text = planted(5)[3][1] * 4
    checked(docs_of, [(1, text)] * 2000 + [(2, text)] * 1000, length=40, seed=10)
    assert max(df.count() for df in sizes) <= 4 * len(text)


@pytest.mark.parametrize("text", ["x" * 3000, "ab" * 1500, "abc" * 700 + "x" + "abc" * 700, "x" * 60 + "y" + "x" * 60, ("y" * 90 + "z") * 20])
def test_runs_and_periods(docs_of, text):
    checked(docs_of, [(1, text), (2, "q" + text[:150] + "r"), (3, "other text of no use")], length=40, seed=10)


def test_blocks_portions_and_batches(docs_of, monkeypatch):
    for name, value in (("BLOCK", 97), ("PORTION", 5), ("BATCH", 3), ("HOT_ROWS", 4), ("HOT_KEYS", 50)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = planted(6)
    checked(docs_of, rows[:25] + rows[50:] + [(60, "x" * 700), (61, rows[3][1]), (62, rows[3][1] + " z")], length=40, seed=10)


def test_a_run_of_megabytes_takes_linear_work():
    data = np.full(9 << 20, 120, np.uint8)
    at = np.array([0, len(data)])
    begun, rows = time.perf_counter(), 0
    for place, code in suffix_dedup.text_anchors(data, at, 200, 50):
        first, last, step = suffix_dedup.runs(place, code, np.zeros(len(place), int), 200)
        rows += len(first)
    assert rows <= 4 and time.perf_counter() - begun < 60


def test_intervals_of_a_suffix_array():
    text = "banana$"
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = [next(k for k in range(9) if text[a : a + k + 1] != text[b : b + k + 1]) for a, b in zip(order[:-1], order[1:], strict=True)]
    found = {(d, text[order[a] : order[a] + d], b - a + 1) for d, a, b in intervals(common)}
    assert found == {(3, "ana", 2), (1, "a", 3), (2, "na", 2), (0, "", 7)}


def test_agreements_as_all_pairs():
    rng = random.Random(2)
    for _ in range(200):
        made = {(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 5))), bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6)))) for _ in range(rng.randint(1, 9))}
        rows = sorted(made, key=lambda r: r[1])
        count = [rng.choice([1, 1, 2]) for _ in rows]

        def same(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        want = []
        for i, (left, right) in enumerate(rows):
            pairs = [(same(left, x), same(right, y)) for j, (x, y) in enumerate(rows) if j != i or count[i] > 1]
            pairs = [p for p in pairs if sum(p) >= 6]
            want.append((max((p[0] for p in pairs), default=0), max((p[1] for p in pairs), default=0)))
        assert agreements([r[0] for r in rows], [r[1] for r in rows], count, 6) == want


def test_odd_rows_and_empty_table(docs_of, odd_rows):
    got = remove_repeats(docs_of(odd_rows), length=30, seed=8).collect()
    assert len(got) == len(odd_rows)
    want = {r[0]: r for r in zip([i for i, _ in odd_rows], brute.repeated_bytes([t for _, t in odd_rows if len(t or "") < 10_000], 30), strict=False)}
    assert all(bytes(r["kept"]) == want[r["doc_id"]][1][3] for r in got if r["doc_id"] in (1, 2, 3, 4, 5, 6, 7))
    assert remove_repeats(docs_of([])).count() == 0
