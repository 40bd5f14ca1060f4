import random
import re
import time

from brute import prose

from hybridflow.llm.decontaminate import contamination, dealt_blocks, drop_contaminated, tile

ITEMS = "item_id long, text string, row string"


def brute_coverage(doc, item, least):
    """Tiles by looking for the longest unmarked match everywhere, again and again."""
    used_doc, used_item, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while (
                    i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and i + k not in used_doc and j + k not in used_item
                ):
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return total
        used_doc.update(range(i, i + k))
        used_item.update(range(j, j + k))
        total += k


def test_tiles_cover_what_brute_force_covers():
    rng = random.Random(3)
    for _ in range(150):
        item = [rng.randint(0, 3) for _ in range(rng.randint(3, 30))]
        doc = [rng.randint(0, 3) for _ in range(10)]
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, len(item))
            doc += item[a : a + rng.randint(0, 12)]
        tiles = tile(doc, item, 3)
        assert all(doc[a : a + n] == item[b : b + n] and n >= 3 for a, b, n in tiles)
        marked = [x for _, b, n in tiles for x in range(b, b + n)]
        assert len(marked) == len(set(marked))
        assert len({x for a, _, n in tiles for x in range(a, a + n)}) == len(marked)
        assert sum(n for *_, n in tiles) == brute_coverage(doc, item, 3)


def test_repeated_tokens_are_tiled_at_once():
    begun = time.perf_counter()
    assert tile([7] * 20_000, [7] * 2_000) == [(0, 0, 2_000)]
    pattern = [1, 2] * 10_000
    assert sum(n for *_, n in tile(pattern, [1, 2, 3] * 700, 2)) == 1_400
    assert time.perf_counter() - begun < 5


def test_gaps_are_not_matched():
    assert tile([1, 2, 3, 1, 2], [1, 2, 3, 1, 2], 2, [True, True, False, True, True]) == [(0, 0, 2), (3, 3, 2)]
    assert tile([], [1], 1) == [] == tile([1], [], 1)


def plain_matches(rows, items, least=5, threshold=0.8):
    """Coverage of every pair, by brute force on token lists."""
    def words(text):
        return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())

    out = {}
    for i, text in rows:
        for j, passage in items:
            tokens = words(passage)
            if tokens:
                share = brute_coverage(words(text), tokens, min(least, len(tokens))) / len(tokens)
                if share >= threshold:
                    out.setdefault(i, set()).add((j, round(share, 9)))
    return out


def test_items_with_a_common_opening_as_brute_force(spark, docs_of):
    """Every item begins alike; some are the same passage under two ids, one has no id."""
    rng = random.Random(8)
    opening = "which of the following sentences about the story is true and which is not"
    items = [(i, f"{opening} {prose(rng, 9)}") for i in range(20)]
    items += [(50, items[3][1]), (None, items[4][1]), (51, "one two three"), (52, opening), (53, "a a a a a a a a b a a a a a a a")]
    rows = [(i, f"{prose(rng, 5)} {opening} {prose(rng, 6)}") for i in range(6)]
    rows += [(10 + k, f"{prose(rng, 4)} {items[k][1]} {prose(rng, 4)}") for k in range(0, 25, 2)]
    rows += [(40, " ".join(reversed([items[6][1][:40], items[6][1][40:]]))), (41, "x one two three y"), (42, "a " * 30), (43, "b" + " a" * 8)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    found = contamination(docs_of(rows), bench).select("row.doc_id", "matches").collect()
    got = {r["doc_id"]: {(m["item_id"], round(m["coverage"], 9)) for m in r["matches"]} for r in found if r["matches"]}
    assert got == plain_matches(rows, items)


def test_items_without_an_id_reject(spark, docs_of):
    bench = spark.createDataFrame([(None, "this very passage is in the benchmark", "x")], ITEMS)
    rows = [(1, "so this very passage is in the benchmark too"), (2, "this passage is not")]
    assert [r["doc_id"] for r in drop_contaminated(docs_of(rows), bench).collect()] == [2]


def test_repeated_items_and_blocks_too_large(spark, docs_of):
    text = "a passage of some length that is in the benchmark many times"
    bench = spark.createDataFrame([(i % 3, text, "x") for i in range(300)] + [(9, f"other {i} passage of the same block {i}", "x") for i in range(40)], ITEMS)
    dealt, blocks = dealt_blocks(bench, 200)
    assert dealt.count() == 43 and len(blocks) > 8
    found = contamination(docs_of([(1, f"x {text} y"), (2, "nothing")]), bench, block_bytes=700).select("row.doc_id", "matches").collect()
    assert {r["doc_id"]: [m["item_id"] for m in r["matches"]] for r in found} == {1: [0, 1, 2], 2: []}


def planted(rng):
    items = [(i, prose(rng, rng.randint(20, 60))) for i in range(12)]
    rows, dirty = [], set()
    for i in range(60):
        text = prose(rng, 80)
        if i % 3 == 0:
            words = items[i % 12][1].split()
            cut = len(words) // 2
            parts = [words] if i % 2 else [words[cut:], words[:cut]]  # whole, or its halves swapped
            text = " ".join([text, *[" ".join(p).upper() + ", " + prose(rng, 9) for p in parts], text[:50]])
            dirty.add(i)
        elif i % 3 == 1:
            text += " " + " ".join(items[i % 12][1].split()[:8])  # a short quotation
        rows.append((i, text))
    return items, rows, dirty


def test_finds_whole_and_reordered_passages_only(spark, docs_of):
    items, rows, dirty = planted(random.Random(4))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    found = contamination(docs_of(rows), bench).select("row.doc_id", "matches").collect()
    assert {r["doc_id"] for r in found if r["matches"]} == dirty
    assert all(m["item_id"] == r["doc_id"] % 12 for r in found for m in r["matches"])


def test_blocks_of_the_benchmark_change_nothing(spark, docs_of):
    items, rows, _ = planted(random.Random(5))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    one = contamination(docs_of(rows), bench).select("row.doc_id", "matches").orderBy("doc_id").collect()
    some = contamination(docs_of(rows), bench, block_bytes=700).select("row.doc_id", "matches").orderBy("doc_id").collect()
    assert one == some


def test_odd_rows_and_tables(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    none = spark.createDataFrame([], ITEMS)
    assert drop_contaminated(docs, none).count() == len(odd_rows)
    odd = spark.createDataFrame([(None, "two words", "x"), (1, None, "x"), (2, "", "x"), (3, "two words", "x"), (3, "no such", "x")], ITEMS)
    out = drop_contaminated(docs, odd)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    # The passage "two words" stands under two ids, one of them null; each alone would do.
    assert sorted(r["text"] for r in out.where("doc_id = 10").collect()) == ["other text here"]
    assert drop_contaminated(docs_of([]), odd).count() == 0
