import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hybridflow.llm import sharding
from hybridflow.llm.sharding import assign, write_shards


def many(n=500):
    return [(i, f"text {i % 37} {'x' * (i % 11)}", ["a", "a", "a", "b", None][(i * i) % 5]) for i in range(n)]


def places(rows):
    return sorted((r["doc_id"] is None, r["doc_id"], r["source"] or "", r["text_crc32"], r["shard"], r["slot"]) for r in rows)


def check_law(rows, n_shards):
    """Counts at most one apart, slots without gaps, each shard's sources as the whole's."""
    slots = defaultdict(list)
    sources = Counter(r["source"] for r in rows)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(n_shards)]
    assert max(counts) - min(counts) <= 1
    for source, n in sources.items():
        per = Counter(r["shard"] for r in rows if r["source"] == source)
        assert all(abs(per[k] - n / n_shards) <= 2 + len(sources) / 2 for k in range(n_shards))


@pytest.mark.parametrize("per_range", [3, 50, 10_000])
def test_every_shard_matches_the_mixture(docs_of, per_range):
    rows = assign(docs_of(many()), 7, rows_per_range=per_range).collect()
    assert len(rows) == 500
    check_law(rows, 7)


def test_ranges_and_partitions_do_not_matter(docs_of):
    a = assign(docs_of(many(), 2)).collect()
    b = assign(docs_of(many(), 5), rows_per_range=9).collect()
    assert places(a) == places(b)
    assert places(a) != places(assign(docs_of(many()), seed=1).collect())


def test_sizes_and_checksums(docs_of, odd_rows):
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in assign(docs_of(odd_rows)).collect())
    assert got == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_rows)


def test_a_third_of_the_rows_repeated(docs_of, monkeypatch):
    """Copies of one row spread over all shards, and over the tasks that tell them apart."""
    monkeypatch.setattr(sharding, "BLOCK", 40)
    rows = many(300) + [(7, "the same", "a")] * 150
    got = assign(docs_of(rows), 5, rows_per_range=20).collect()
    assert len(got) == 450
    check_law(got, 5)
    copies = Counter(r["shard"] for r in got if r["text_crc32"] == zlib.crc32(b"the same"))
    assert sum(copies.values()) == 150 and all(15 <= copies[k] <= 45 for k in range(5))


def test_sources_of_one_row_lie_anywhere(docs_of):
    got = assign(docs_of([(i, "t", f"s{i}") for i in range(400)]), 4, rows_per_range=10).collect()
    assert Counter(r["shard"] for r in got) == Counter({0: 100, 1: 100, 2: 100, 3: 100})


def test_fewer_rows_than_shards_and_none(docs_of):
    got = assign(docs_of([(1, "a"), (2, None), (None, "")])).collect()
    assert sorted(r["slot"] for r in got) == [0, 0, 0] and len({r["shard"] for r in got}) == 3
    assert assign(docs_of([])).count() == 0


def test_written_shards_hold_all_rows_in_order(spark, docs_of, odd_rows, tmp_path):
    docs = docs_of(odd_rows + many(60))
    write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert set(back.columns) == {*docs.columns, "shard", "slot"}
    plain = docs.columns
    assert back.select(plain).exceptAll(docs).count() == 0 and docs.exceptAll(back.select(plain)).count() == 0
    for file in back.select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at")).collect():
        assert f"shard={file['shard']}" in file["file"]
    check_law(back.collect(), 4)


def test_no_python_in_the_plan(docs_of):
    plan = assign(docs_of(many(50)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
