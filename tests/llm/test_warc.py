import hashlib
import io
import zlib
from base64 import b32encode

import pytest

from hybridflow.llm import warc
from hybridflow.llm.common import Cuts

PAGES = "page_id long, url string, html string, digest string, sha1 string, s string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES).repartition(3)


ROWS = [
    (3, "http://a/3", "<p>same</p>"), (1, "http://a/1", "<p>same</p>"), (2, None, "<p>é 漢\r\n\r\nWARC/1.1\r\n</p>"),
    (4, "http://a/\r\nX: y", None), (5, "u", ""), (None, "u", "<p>same</p>"), (None, None, "only one"), (6, "u", "x" * 3_000_000), (7, "u", "y"), (7, "u", "y"),
]


def brute(rows, least=0):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        equal = [i for i, _, h in rows if (h or "").encode() == payload and i is not None]
        revisit = equal and page_id != min(equal) and len(payload) >= least
        digest = b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", min(equal) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = warc.round_trip(spark, pages_of(spark, ROWS), least).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS, least)


def test_payloads_come_back_whole(spark):
    cuts = Cuts(spark, "warc-test")
    files = cuts.cut(warc.write_archives(warc.plan_records(pages_of(spark, ROWS), cuts), f"{cuts.root}/a", file_bytes=100))
    assert files.count() == len(ROWS)  # a file per record at this bound
    index = cuts.cut(warc.build_index(files, files.count()))
    assert index.where("offset is null or length is null or digest is null").count() == 0
    found = warc.read_records(index.where("record_id = '<urn:page:2>'"), 1000).collect()
    assert [bytes(r["payload"]).decode() for r in found] == [ROWS[2][2]]
    assert found[0]["url"] is None


def test_members_of_an_archive_at_any_block_size():
    parts = [b"a" * 1000, b"", b"bc"]
    packed = [zlib.compress(p, wbits=31) for p in parts]
    for size in (1, 7, 64, 10_000):
        found = list(warc.members(io.BytesIO(b"".join(packed)), size))
        assert [d for *_, d in found] == parts
        assert [n for _, n, _ in found] == [len(p) for p in packed]
    with pytest.raises(EOFError):
        list(warc.members(io.BytesIO(packed[0][:-9])))


def test_ranges_join_neighbours_only():
    rows = [("f", 0, 10), ("f", 10, 5), ("f", 40, 5), ("g", 0, 3), ("g", 3, 200)]
    assert list(warc.ranges(iter(rows), 10, 100)) == [
        ("f", 0, 15, [(0, 10), (10, 5)]),
        ("f", 40, 5, [(40, 5)]),
        ("g", 0, 3, [(0, 3)]),
        ("g", 3, 200, [(3, 200)]),
    ]


def test_a_damaged_payload_is_an_error(spark, tmp_path):
    data = warc.record(1, "u", b"payload", "A" * 32, None, 7)
    path = tmp_path / "x.warc.gz"
    path.write_bytes(zlib.compress(data, wbits=31))
    files = spark.createDataFrame([(str(path),)], "file string")
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(warc.build_index(files, 1), 100).collect()


def test_empty_table(spark):
    assert warc.round_trip(spark, pages_of(spark, [])).count() == 0
