"""Repeated byte strings across whole texts, by an enhanced suffix array over anchored suffixes.

A string of ``length`` bytes that starts at two places has the same lowest-ranked ``seed``-byte piece
at both, so it is enough to sort suffixes at such pieces, the anchors (about one place in 75):

1. Anchors are found where texts are read (sliding minimum of piece fingerprints) and counted; those
   whose piece occurs once anywhere are done. Anchors of one piece that follow each other at equal
   distance, as in a run of one byte, are one row with their number.
2. The others get a fingerprint of their context, the ``length - seed`` bytes before and ``length`` bytes
   from the anchor on. Equal contexts become one class with a count; copies cost nothing further, and equal
   contexts that follow each other in a text stay one row.
3. Each class is shown by the bytes of one place. Classes of one anchor piece are sorted by what follows: a suffix array with the common prefixes of
   neighbours. A scan with a stack walks its intervals of common prefixes, from the longest to the
   shortest; in each, members fall into groups by what precedes them, and a group of two or more is a
   repeat that no further interval prolongs to the right. Its members learn how far they agree to
   either side with another of the group, all members, not only neighbours.
4. What two places have in common around an anchor is removed if it has ``length`` bytes or more.

A piece with more than ``task_rows`` distinct contexts is not sorted in one task: its strings of
``length`` bytes around the anchor are counted as fingerprints, with the same result. Texts travel
to the list of their own anchors and spans only. What meets by a piece or a context that holds more
than its share of all rows is joined by broadcast: of such keys there are at most ``HOT_KEYS``.

Defined results: a null text is empty; texts shorter than ``length`` keep everything. Matches never
cross rows. Rows that repeat id and text are separate documents, and remove each other; they are
looked at once, with their number. A text of any length is gone through in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hybridflow.llm import shingles as sh
from hybridflow.llm.common import Cuts, keyed_text, ready

LENGTH = 200
SEED = 50
TASK_ROWS = 100_000
#: A key with more than one in so many of all rows, and more than HOT_ROWS, is joined by broadcast.
HOT_KEYS = 10_000
HOT_ROWS = 50_000
#: Bytes of a text gone through at a time; places looked at and contexts passed on at a time.
BLOCK = 4 << 20
PORTION = 1_000_000
BATCH = 4_096
U = np.uint64


def _sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``w`` values from each place on; the last w-1 are left out."""
    n = len(x)
    blocks = -(-n // w)
    fill = np.iinfo(np.uint64).max if pick is np.minimum else U(0)
    padded = np.full(blocks * w, fill, dtype=U)
    padded[:n] = x
    grid = padded.reshape(blocks, w)
    ahead = pick.accumulate(grid, axis=1).ravel()
    behind = pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of anchors in texts laid end to end, and the fingerprints of their pieces."""
    n, w = len(data), length - seed + 1
    if n < length:
        return np.empty(0, np.int64), np.empty(0, U)
    starts = np.arange(n - seed + 1)
    codes = sh.range_codes(data, starts, starts + seed) | U(1)
    least = _sliding(codes, w, np.minimum)  # of the string of ``length`` bytes from each place on
    inside = np.zeros(len(least), dtype=bool)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        inside[a : max(b - length + 1, a)] = True
    least = np.where(inside, least, U(0))
    pad = np.zeros(w - 1, dtype=U)
    most = _sliding(np.concatenate([pad, least, pad]), w, np.maximum)[: len(codes)]
    at = np.flatnonzero(most == codes)
    return at, codes[at]


def text_anchors(part: np.ndarray, at: np.ndarray, length: int, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """:func:`anchors` in bounded memory: a text of more than BLOCK bytes in blocks that see what is around them."""
    n = len(part)
    if n <= BLOCK or len(at) > 2:
        yield anchors(part, at, length, seed)
        return
    for start in range(0, n, BLOCK):
        a, b = max(0, start - length), min(n, start + BLOCK + length)
        place, code = anchors(part[a:b], np.array([0, b - a]), length, seed)
        own = (place + a >= start) & (place + a < start + BLOCK)
        yield place[own] + a, code[own]


def runs(place: np.ndarray, code: np.ndarray, text: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of one code that follow each other at an equal distance of at most ``most``: first, last, distance."""
    n = len(place)
    if not n:
        return np.empty(0, int), np.empty(0, int), np.empty(0, int)
    gap = np.diff(place)
    linked = (code[1:] == code[:-1]) & (text[1:] == text[:-1]) & (gap <= most)
    begins = np.ones(n, dtype=bool)
    begins[1:] = ~linked
    begins[2:] |= linked[1:] & linked[:-1] & (gap[1:] != gap[:-1])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], n) - 1
    step = np.where(last > first, np.append(gap, 1)[first], 1)
    return first, last, step


def _anchor_rows(length: int, seed: int):
    """(doc_id, tag, text, copies) to a row per run of anchors: (h, doc_id, tag, pos, last, step, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = sh.text_buffers(batch.column(2))
            copies = batch.column(3).to_numpy()
            for begin, _, part, at in sh.chunks(data, offsets):
                for place, code in text_anchors(part, at, length, seed):
                    text = np.searchsorted(at, place, side="right") - 1
                    first, last, step = runs(place, code, text, length)
                    which = pa.array(begin + text[first])
                    own = at[text[first]]
                    n = ((place[last] - place[first]) // step + 1) * copies[begin + text[first]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(code[first].view(np.int64)), batch.column(0).take(which), batch.column(1).take(which),
                         pa.array((place[first] - own).astype(np.int32)), pa.array((place[last] - own).astype(np.int32)),
                         pa.array(step.astype(np.int32)), pa.array(n)],
                        ["h", "doc_id", "tag", "pos", "last", "step", "n"],
                    )

    return run


ANCHORS = "h long, doc_id long, tag long, pos int, last int, step int, n long"


def _fields(rows: pa.ListArray, i: int, *names: str) -> list[np.ndarray]:
    """Fields of the structs in a row's list, as arrays."""
    held = rows[i].values
    return [held.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in names]


def _portions(pos: np.ndarray, last: np.ndarray, step: np.ndarray, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of anchors as places, their pieces and the number of their run, a bounded number at a time."""
    size = (last - pos) // step + 1
    cuts = -(-size // PORTION)  # a run longer than a portion is cut
    which = np.repeat(np.arange(len(pos)), cuts)
    part = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = pos[which] + part * PORTION * step[which]
    size = np.minimum(PORTION, size[which] - part * PORTION)
    total = np.cumsum(size)
    at = 0
    while at < len(which):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PORTION, side="right")))
        n, own = size[at:end], which[at:end]
        along = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        run = np.repeat(own, n)
        yield np.repeat(begin[at:end], n) + along * step[run], h[run], run
        at = end


def _contexts(length: int, seed: int):
    """(doc_id, tag, text, copies, anchors) to a row per run of places that have the same context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = length - seed
        for batch in batches:
            data, offsets = sh.text_buffers(batch.column(2))
            for i in range(batch.num_rows):
                own = data[int(offsets[i]) : int(offsets[i + 1])]
                size = len(own)
                copies = batch.column(3)[i].as_py()
                ids = [batch.column(k).take(pa.array(np.full(BATCH, i))) for k in (0, 1)]
                for pos, h, which in _portions(*_fields(batch.column(4), i, "pos", "last", "step", "h")):
                    start, end = np.maximum(pos - before, 0), np.minimum(pos + length, size)
                    code = sh.range_codes(own, start, end) ^ sh.mix((pos - start).astype(U) + U(1))
                    first, last, step = runs(pos, code, which, length)
                    for k in range(0, len(first), BATCH):
                        f, t, d = first[k : k + BATCH], last[k : k + BATCH], step[k : k + BATCH]
                        m, at = len(f), pos[f]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h[f], pa.int64()), pa.array(code[f].view(np.int64)),
                             ids[0].slice(0, m), ids[1].slice(0, m),
                             pa.array(at.astype(np.int32)), pa.array(pos[t].astype(np.int32)), pa.array(((pos[t] - at) // d + 1) * copies),
                             pa.array((at - start[f]).astype(np.int32)), pa.array((end[f] - at).astype(np.int32))],
                            ["h", "c", "doc_id", "tag", "pos", "last", "n", "nl", "nr"],
                        )

    return run


CONTEXT = "h long, c long, doc_id long, tag long, pos int, last int, n long, nl int, nr int"


def _bytes_of(length: int, seed: int):
    """(text, places) to a row per place with the bytes before it, reversed, and those from it on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = length - seed
        for batch in batches:
            data, offsets = sh.text_buffers(batch.column(0))
            for i in range(batch.num_rows):
                raw = data[int(offsets[i]) : int(offsets[i + 1])].tobytes()
                h, c, n, m, place = _fields(batch.column(1), i, "h", "c", "n", "m", "p")
                for k in range(0, len(place), BATCH):
                    part = slice(k, k + BATCH)
                    at = place[part].tolist()
                    columns = [pa.array(x[part]) for x in (h, c, n)]
                    columns.append(pa.array([raw[x - before if x > before else 0 : x][::-1] for x in at], pa.binary()))
                    columns.append(pa.array([raw[x : x + length] for x in at], pa.binary()))
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(m[part])], ["h", "c", "n", "left", "right", "m"])

    return run


BYTES = "h long, c long, n long, left binary, right binary, m long"


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Intervals (common prefix, first, last) of a suffix array, children before parents.

    ``lcp[i]`` is the common prefix of suffixes i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            depth, first = stack.pop()
            yield depth, first, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def agreements(left: list[bytes], right: list[bytes], count: list[int], length: int) -> list[tuple[int, int]]:
    """How far each class (sorted by ``right``) agrees with another place to either side: (before, after).

    ``left`` is reversed, so that agreement to the left is a common prefix too. (0, 0): nowhere in a
    string of ``length`` bytes.
    """
    n = len(right)
    out = [(len(left[i]), len(right[i])) if count[i] > 1 and len(left[i]) + len(right[i]) >= length else (0, 0) for i in range(n)]
    lcp = [common(right[i], right[i + 1]) for i in range(n - 1)]
    for depth, first, last in intervals(lcp):
        need = max(length - depth, 0)
        members = range(first, last + 1)
        groups: dict[bytes, list[int]] = {}
        for i in members:
            if len(left[i]) >= need:
                groups.setdefault(left[i][:need], []).append(i)
        for group in groups.values():
            if len(group) < 2:
                continue
            group.sort(key=left.__getitem__)
            near = [common(left[a], left[b]) for a, b in zip(group[:-1], group[1:], strict=True)]
            for k, i in enumerate(group):
                before = max(near[max(k - 1, 0) : k + 1])
                out[i] = (max(out[i][0], before), max(out[i][1], depth))
    return out


AGREED = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("before", pa.int32()), ("after", pa.int32())])


def _sorted_groups(length: int):
    """Rows (h, c, n, left, right) sorted by h and right to the agreements of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def settle():
            found = agreements([r[3] for r in held], [r[4] for r in held], [r[2] for r in held], length)
            out.extend((r[0], r[1], a, b) for r, (a, b) in zip(held, found, strict=True) if a + b)
            held.clear()

        def batch_of():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, AGREED, strict=True)], schema=AGREED)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][0] != row[0]:
                    settle()
                held.append(row)
            if len(out) > 10_000:
                yield batch_of()
        settle()
        if out:
            yield batch_of()

    return run


def _windows(length: int):
    """Rows (h, c, n, left, right) to a row per string of ``length`` bytes that holds the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, c, n, left, right in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                data = np.frombuffer(left[::-1] + right, dtype=np.uint8)
                before = np.arange(max(0, length - len(right)), len(left) + 1)
                start = len(left) - before
                if not len(before):
                    continue
                code = sh.range_codes(data, start, start + length)
                m = len(before)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * m), pa.array([c] * m), pa.array([n] * m), pa.array(before.astype(np.int32)), pa.array(code.view(np.int64))],
                    ["h", "c", "n", "before", "code"],
                )

    return run


def one_of_each(texts: DataFrame, cuts: Cuts) -> DataFrame:
    """``texts`` with rows that repeat id and text put together, and their number as ``copies``."""
    repeated = cuts.cut(texts.groupBy("doc_id", "tag").agg(F.count("*").alias("k")).where("k > 1"))
    if repeated.isEmpty():
        return texts.withColumn("copies", F.lit(1).cast("long"))
    repeated = repeated.select(F.col("doc_id").alias("d"), F.col("tag").alias("t"))
    single = texts.join(repeated, _key(texts), "left_anti").withColumn("copies", F.lit(1).cast("long"))
    # Copies meet where they are read, so what moves is a text per task that has it.
    several = texts.join(repeated, _key(texts), "left_semi").groupBy("doc_id", "tag")
    return single.unionByName(several.agg(F.first("text").alias("text"), F.count("*").alias("copies")))


def meet(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` joined with ``keys``, which has a row per key and counts that key's ``rows_of_key`` in ``rows``.

    Keys with more than their share are broadcast, there can be only HOT_KEYS of them; so their rows stay where they are.
    """
    total = keys.agg(F.coalesce(F.sum("rows_of_key"), F.lit(0))).first()[0]
    is_hot = F.col("rows_of_key") > max(HOT_ROWS, total // HOT_KEYS)
    hot = keys.where(is_hot)
    if hot.isEmpty():
        return rows.join(keys.drop("rows_of_key"), on)
    apart = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(keys.where(~is_hot).drop("rows_of_key"), on)
    return apart.unionByName(rows.join(F.broadcast(hot.drop("rows_of_key")), on))


def repeated_spans(texts: DataFrame, cuts: Cuts, length: int, seed: int, task_rows: int) -> DataFrame:
    """``doc_id, tag, start, end`` of repeated bytes (overlapping ones not joined)."""
    texts = one_of_each(texts, cuts)
    found = cuts.cut(texts.mapInArrow(_anchor_rows(length, seed), ANCHORS))
    often = cuts.cut(found.groupBy("h").agg(F.sum("n").alias("n"), F.count("*").alias("rows_of_key")).where("n > 1").drop("n"))
    places = meet(found, often, ["h"]).groupBy("doc_id", "tag")
    places = cuts.cut(places.agg(F.collect_list(F.struct("pos", "last", "step", "h")).alias("anchors")))
    cuts.drop(found, often)
    with_text = texts.join(places.withColumnsRenamed({"doc_id": "d", "tag": "t"}), _key(texts))
    context = cuts.cut(with_text.select("doc_id", "tag", "text", "copies", "anchors").mapInArrow(_contexts(length, seed), CONTEXT))
    cuts.drop(places)

    # Each class is shown by one of its places, whose bytes are read from its text again; the others move as numbers.
    own = F.xxhash64("doc_id", "tag", "pos")
    shown = [F.min_by(column, own).alias(name) for column, name in (("doc_id", "d"), ("tag", "t"), ("pos", "p"))]
    counted = context.groupBy("h", "c")
    classes = cuts.cut(
        counted.agg(F.sum("n").alias("n"), F.count("*").alias("rows_of_class"), F.min("nl").alias("nl"), F.min("nr").alias("nr"), *shown)
    )
    per = cuts.cut(classes.groupBy("h").agg(F.count("*").alias("m")).withColumn("rows_of_key", F.col("m")))
    by_piece = cuts.cut(meet(classes, per, ["h"]))
    cuts.drop(classes, per)
    alone = by_piece.where(f"m = 1 and n > 1 and nl + nr >= {length}").select("h", "c", F.col("nl").alias("before"), F.col("nr").alias("after"), "rows_of_class")
    several = by_piece.where("m > 1")
    wanted = several.groupBy("d", "t").agg(F.collect_list(F.struct("p", "h", "c", "n", "m")).alias("places"))
    bytes_ = cuts.cut(texts.join(wanted, _key(texts)).select("text", "places").mapInArrow(_bytes_of(length, seed), BYTES))
    few = bytes_.where(F.col("m") <= task_rows).select("h", "c", "n", "left", "right")
    n_tasks = 1 + bytes_.where(F.col("m") <= task_rows).count() // task_rows
    width = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_tasks)
    by_tree = few.repartition(width, "h").sortWithinPartitions("h", "right")
    agreed = by_tree.mapInArrow(_sorted_groups(length), "h long, c long, before int, after int")
    many = bytes_.where(F.col("m") > task_rows).select("h", "c", "n", "left", "right")
    if not many.isEmpty():
        strings = cuts.cut(many.mapInArrow(_windows(length), "h long, c long, n long, before int, code long"))
        again = strings.groupBy(F.col("h").alias("k"), F.col("before").alias("b"), F.col("code").alias("x"))
        again = again.agg(F.sum("n").alias("times")).where("times > 1")
        hit = strings.join(again, (F.col("h") == F.col("k")) & (F.col("before") == F.col("b")) & (F.col("code") == F.col("x")))
        reach = hit.groupBy("h", "c").agg(F.max("before").alias("before"), (length - F.min("before")).alias("after"))
        agreed = agreed.union(reach.select("h", "c", "before", F.col("after").cast("int")))
    counts = several.select("h", "c", "rows_of_class")
    agreed = alone.unionByName(agreed.join(counts, ["h", "c"])).withColumnRenamed("rows_of_class", "rows_of_key")
    agreed = cuts.cut(agreed)
    cuts.drop(by_piece, bytes_)
    at = context.select("h", "c", "doc_id", "tag", "pos", "last")
    spans = meet(at, agreed, ["h", "c"])
    spans = spans.select("doc_id", "tag", (F.col("pos") - F.col("before")).alias("start"), (F.col("last") + F.col("after")).alias("end"))
    spans = cuts.cut(spans)
    cuts.drop(context, agreed)
    return spans


def _key(texts: DataFrame):
    return texts["doc_id"].eqNullSafe(F.col("d")) & (texts["tag"] == F.col("t"))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to what is kept, with the spans joined."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        data, offsets = sh.text_buffers(batch.column(1))
        raw = data.tobytes()
        sizes, joined, kept = [], [], []
        for i in range(batch.num_rows):
            a, b = int(offsets[i]), int(offsets[i + 1])
            merged: list[dict] = []
            for s in sorted(batch.column(2)[i].as_py() or [], key=lambda s: s["start"]):
                if merged and s["start"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                else:
                    merged.append(dict(s))
            parts, at = [], a
            for s in merged:
                parts.append(raw[at : a + s["start"]])
                at = a + s["end"]
            parts.append(raw[at:b])
            sizes.append(b - a)
            joined.append(merged)
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(joined, kind), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, task_rows: int = TASK_ROWS) -> DataFrame:
    """Per row: ``doc_id, n_bytes, spans`` (removed, joined) and ``kept`` (bytes that stay)."""
    spark = ready(docs.sparkSession)
    cuts = Cuts(spark, "suffix")
    texts = keyed_text(docs)
    spans = repeated_spans(texts, cuts, length, seed, task_rows)
    each = spans.distinct().groupBy(F.col("doc_id").alias("d"), F.col("tag").alias("t"))
    each = each.agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))).alias("spans"))
    out = texts.join(each, _key(texts), "left").select("doc_id", "text", "spans")
    return out.mapInArrow(_cut_out, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
