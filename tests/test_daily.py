"""Daily files: names, window bounds, order, archives."""

import zipfile
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hybridflow.sources import archives, daily
from hybridflow.sources.text import numbered_lines

END = date(2024, 3, 10)


@pytest.fixture
def days(tmp_path):
    """Unpacked and zipped files for twelve days before the end and the end itself."""
    (tmp_path / "daily").mkdir()
    (tmp_path / "zipped").mkdir()
    for back in range(13):
        day = END - timedelta(days=back)
        name = f"{day:%Y%m%d}.export.CSV"
        text = "".join(f"{day}\tline {i}\n" for i in range(back + 1))
        (tmp_path / "daily" / name).write_text(text)
        with zipfile.ZipFile(tmp_path / "zipped" / f"{name}.zip", "w") as z:
            z.writestr(name, text)
    (tmp_path / "daily" / "notes.export.CSV").write_text("no day\n")
    return tmp_path


def per_day(lines):
    return {r[0]: r[1] for r in lines.groupBy("file_date").count().collect()}


EXPECTED = {END - timedelta(days=b): b + 1 for b in range(1, 5)}


def test_window_days():
    assert daily.window_days(END, 90) == (END - timedelta(days=89), END - timedelta(days=1))


def test_names(spark):
    names = ["20240301.export.CSV", "x/20240301.export.CSV.zip", "a.export.CSV", "20241350.export.CSV", "20240301.csv"]
    rows = spark.createDataFrame([(n,) for n in names], "n STRING").select(daily.day_of_file(F.col("n")))
    assert [r[0] for r in rows.collect()] == [date(2024, 3, 1), date(2024, 3, 1), None, None, None]
    key = spark.range(1).select(daily.file_key(F.lit(date(2024, 3, 1)))).first()[0]
    assert key == "20240301.export.CSV.zip"


def test_daily_lines(spark, days):
    lines = daily.daily_lines(spark, str(days / "daily"), END, 5)
    assert per_day(lines) == EXPECTED


def files_read(df):
    """Number of files the scan of a frame that has run has opened."""
    found, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.metrics().contains("numFiles"):
            found.append(node.metrics().apply("numFiles").value())
        children = node.children().iterator()
        while children.hasNext():
            nodes.append(children.next())
    return found


def test_only_files_of_the_window_are_read(spark, days):
    lines = daily.daily_lines(spark, str(days / "daily"), END, 5)
    lines.collect()
    assert files_read(lines) == [4]
    zipped = daily.archives(spark, str(days / "zipped"), END, 5)
    assert len(zipped.collect()) == 4
    assert files_read(zipped) == [4]


def test_unzip(spark, days):
    lines = daily.unzip_lines(daily.archives(spark, str(days / "zipped"), END, 5))
    assert per_day(lines) == EXPECTED
    first = lines.where(F.col("file_date") == F.lit(END - timedelta(days=3))).orderBy("line_no").collect()
    assert [r["value"] for r in first] == [f"{END - timedelta(days=3)}\tline {i}" for i in range(4)]
    assert first[0]["file_name"] == "20240307.export.CSV"


def test_unzip_in_chunks(spark, days, monkeypatch):
    monkeypatch.setattr(archives, "LINES_PER_CHUNK", 2)
    lines = daily.unzip_lines(daily.archives(spark, str(days / "zipped"), END, 5))
    assert per_day(lines) == EXPECTED
    assert lines.groupBy("file_date", "line_no").count().where("count > 1").count() == 0


@pytest.fixture
def large(tmp_path):
    """One archive of many members, packed, stored, empty and in a folder."""
    texts = {f"part/{i}.txt": "".join(f"{i} line {j} \u00e9\r{j}\n" for j in range(i * 50)) for i in range(12)}
    texts["no end"] = "first\nlast without end"
    with zipfile.ZipFile(tmp_path / "large.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("part")
        for k, (name, text) in enumerate(texts.items()):
            z.writestr(name, text, zipfile.ZIP_STORED if k % 3 == 0 else zipfile.ZIP_DEFLATED)
    return tmp_path, texts


def lines_in(texts):
    return sorted((n, i, line) for n, t in texts.items() for i, line in enumerate(t.removesuffix("\n").split("\n")) if t)


def test_members_of_one_archive_are_separate_tasks(spark, large):
    folder, texts = large
    listed = archives.list_archives(spark, str(folder))
    members = archives.list_members(listed)
    assert {(r["member"], r["size"]) for r in members.collect()} == {(n, len(t.encode())) for n, t in texts.items()}
    size = listed.first()["length"]
    lines = archives.read_members(members, size, task_bytes=size // 5)
    assert sorted(map(tuple, lines.select("member", "line_no", "value").collect())) == lines_in(texts)
    assert lines.select(F.spark_partition_id()).distinct().count() > 2


def test_bytes_are_read_in_small_portions(spark, large, monkeypatch):
    monkeypatch.setattr(archives, "READ_BYTES", 7)
    folder, texts = large
    lines = archives.read_members(archives.list_members(archives.list_archives(spark, str(folder))), 1)
    assert sorted(map(tuple, lines.select("member", "line_no", "value").collect())) == lines_in(texts)


def test_a_damaged_member_is_an_error(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("m", "one\ntwo\n")
    data = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "a.zip").write_bytes(data.replace(b"two", b"too", 1))
    with pytest.raises(Exception, match="damaged"):
        archives.read_members(archives.list_members(archives.list_archives(spark, str(tmp_path))), 1).collect()


def test_written_archives_are_zip_files(spark, tmp_path):
    path = str(tmp_path / "new" / "a.zip")
    size = archives.write_zip(path, iter([("x", iter(["1", "\u00e9"])), ("y", iter([]))]))
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and z.read("x").decode() == "1\n\u00e9\n" and z.read("y") == b""
    assert size == (tmp_path / "new" / "a.zip").stat().st_size


def test_no_archives_no_lines(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert daily.unzip_lines(daily.archives(spark, str(tmp_path / "none"), END, 5)).count() == 0


@pytest.mark.parametrize("split", ["128m", "64"])
def test_line_numbers_over_all_files(spark, days, split):
    """Files are cut into splits of a few bytes, and read by several tasks in any order."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, split)
    try:
        got = numbered_lines(spark, str(days / "daily")).orderBy("line_no").collect()
    finally:
        spark.conf.set(name, before)
    texts = [(p.name, line) for p in sorted((days / "daily").iterdir()) for line in p.read_text().splitlines()]
    assert [(r["file_name"], r["value"]) for r in got] == texts
    assert [r["line_no"] for r in got] == list(range(1, len(texts) + 1))


def test_master_text_is_in_order(spark, days, tmp_path):
    lines = daily.daily_lines(spark, str(days / "daily"), END, 5)
    out = tmp_path / "master"
    daily.write_master(lines, ["file_name", "block_start", "line_no"], str(out), parts=3)
    files = sorted(out.glob("part-*"))
    text = "".join(f.read_text() for f in files)
    sources = sorted(p for p in (days / "daily").iterdir() if "20240306" <= p.name < "20240310")
    assert len(files) > 1
    assert text == "".join(p.read_text() for p in sources)


def test_table_by_day(spark, days, tmp_path):
    lines = daily.daily_lines(spark, str(days / "daily"), END, 5)
    out = str(tmp_path / "table")
    daily.write_by_day(lines, out)
    assert per_day(spark.read.parquet(out)) == EXPECTED
