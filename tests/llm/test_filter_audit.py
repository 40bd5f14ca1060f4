import random
import re
from collections import defaultdict
from itertools import permutations

import brute
from pyspark.sql import types as T

from hybridflow.llm import filter_audit
from hybridflow.llm.filter_audit import Diagram, audit, failure_masks, orders, part_steps, swaps

LABELS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "quality", "toxic", "mask")])


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], LABELS)


def plain_masks(rows):
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = []
    for i, t, part in rows:
        text = t or ""
        words = brute.WORD.findall(text)
        fails = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            bool(re.search("[#$%&*|]", text)),
            i is not None and smallest[text] < i,
        ]
        out.append((part or "", sum(f << k for k, f in enumerate(fails)), i))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    masks = plain_masks(rows)
    out = set()
    for part in {m[0] for m in masks}:
        own = [(m, i) for p, m, i in masks if p == part]
        steps, shapley = [], defaultdict(int)
        for order in permutations(range(5)):
            left = own
            for step, bit in enumerate(order, 1):
                gone = [(m, i) for m, i in left if m >> bit & 1]
                left = [(m, i) for m, i in left if not m >> bit & 1]
                fails = sum(m >> bit & 1 for m, _ in own)
                alone = sum(m == 1 << bit for m, _ in own)
                shapley[bit] += len(gone)
                named = [i for _, i in gone if i is not None]
                lost = [sum(i in s for i in named) for s in (good, toxic)]
                name = "".join("ABCDE"[b] for b in order)
                steps.append((bit, (part, name, step, len(left), len(gone), fails - len(gone), alone, *lost)))
        out |= {(*s, shapley[bit]) for bit, s in steps}
    return out


def random_docs(seed, n=120):
    rng = random.Random(seed)
    texts = []
    for _ in range(n // 2):
        words = [rng.choice(["aa", "Bb", "cc$", "dd", "EE", f"w{rng.randint(0, 400)}"]) for _ in range(rng.choice([3, 150, 260]))]
        texts.append(" ".join(words))
    return [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(n)]


def test_as_brute_force(spark, docs_of):
    rows = random_docs(1)
    told = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 120, 2)] + [(4, 1, 1), (999, 1, 1)]
    got = audit(failure_masks(docs_of(rows), labels_of(spark, told)))
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, told)


def test_odd_rows(spark, docs_of, odd_rows):
    rows = [(i, t, "s" if k % 2 else None) for k, (i, t) in enumerate(odd_rows)]
    told = [(6, 1, 0), (10, 0, 1)]
    got = audit(failure_masks(docs_of(rows), labels_of(spark, [*told, (6, None, None)])))
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, told)


def test_null_ids_are_no_copies_of_others(spark, docs_of):
    rows = [(None, "same", "p"), (None, "same", "p"), (3, "same", "p"), (5, "same", "q"), (5, "same", "p"), (3, "same", "p")]
    masks = failure_masks(docs_of(rows), labels_of(spark, [(3, 1, 0), (None, 1, 1)])).collect()
    found = {(r["part"], r["mask"]): (r["n"], r["good"], r["toxic"]) for r in masks}
    assert found == {("p", 1): (4, 2, 0), ("p", 17): (1, 0, 0), ("q", 17): (1, 0, 0)}


def test_a_third_of_the_rows_is_one_text(spark, docs_of):
    rows = random_docs(3, 90) + [(1000 + i, "copy", "a") for i in range(40)] + [(2000, "copy", "b")] * 5
    got = audit(failure_masks(docs_of(rows), labels_of(spark, [])))
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, [])


def test_empty_tables(spark, docs_of):
    assert audit(failure_masks(docs_of([]), labels_of(spark, []))).count() == 0


def test_swaps_reach_every_order_once():
    for width in range(1, 6):
        order = list(range(width))
        seen = [tuple(order)]
        for level in swaps(width):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(permutations(range(width)))
    assert sorted(set(part_steps("", {0: (1, 0, 0)})["filter_order"])) == orders()


def test_a_swapped_diagram_is_the_one_built_in_that_order():
    rng = random.Random(5)
    weights = {m: (rng.randint(0, 3), 0, 1) for m in range(32) if rng.random() < 0.6}

    def leaves(diagram, node, level, mask, out):
        if level == 5:
            out[mask] = diagram._weights[node]
            return out
        passing, failing = diagram._nodes[node]
        leaves(diagram, passing, level + 1, mask, out)
        return leaves(diagram, failing, level + 1, mask | 1 << diagram.order[level], out)

    diagram = Diagram(5, weights)
    for level in swaps(5):
        diagram.swap(level)
        found = leaves(diagram, diagram.root, 0, 0, {})
        assert all(found[m] == weights.get(m, (0, 0, 0)) for m in range(32))
        assert diagram._weights[diagram.root][0] == sum(w[0] for w in weights.values())


def test_equal_subtrees_are_one_node():
    assert len(Diagram(5, {})._nodes) == 6
    assert filter_audit.LETTERS == "ABCDE"
