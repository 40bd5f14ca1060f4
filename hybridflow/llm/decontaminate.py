"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters, digits and non-ASCII characters, A-Z as a-z, each a 64-bit fingerprint.
Seeds are runs of ``min_match`` tokens that a document shares with a benchmark item; they are found
by array lookups where the documents are read, against a block of the benchmark. An item is looked at
closer if the document has one of its rarest seeds: of those, any document that covers enough of the
item must have one, so an opening that all items share leads nowhere by itself. Items whose seeds could
cover enough are tiled: the longest match of unmarked tokens on both sides is marked again and again,
found by running Karp-Rabin fingerprints whose length is halved in on, until none of ``min_match`` tokens
is left. The share of the item's tokens under tiles is its coverage, so a passage counts in whatever order
its parts stand.

The benchmark is dealt into blocks of at most about ``block_bytes`` of text, whatever its size, counted
before they are fetched (a longer text is a block alone). A block goes to the tasks as a broadcast of that
bound and meets all documents; it is released before the next one is fetched.

Defined results: a null or empty text covers nothing. An item of fewer than ``min_match`` tokens is
matched as a whole; one without tokens never. Items that repeat an id are separate passages under
that id; items that repeat id and text are one. An item without an id matches like others, under a null
id. Rows of ``docs`` stay separate even if they repeat. Repeated tokens, in documents, items or both, cost
no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hybridflow.llm import shingles as sh
from hybridflow.llm.common import Cuts, ready

MIN_MATCH = 5
THRESHOLD = 0.8
BLOCK_BYTES = 16 << 20


def tokens_of(texts: list[str]) -> list[np.ndarray]:
    """Token fingerprints of each text."""
    column = pa.array(texts, pa.string())
    data, offsets = sh.text_buffers(column)
    out: list[np.ndarray] = []
    for _, _, part, at in sh.chunks(data, offsets):
        w = sh.words(part, at, letters=True)
        out += [w.code[a:b] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    return out


class _Side:
    """Tokens of one side, those that are free, and running Karp-Rabin fingerprints of free runs."""

    def __init__(self, tokens: np.ndarray, free: np.ndarray):
        n = len(tokens)
        self.tokens, self.free = tokens, free.copy()
        self.sums = np.zeros(n + 1, dtype=sh.U)
        np.cumsum(sh.mix(tokens + sh.U(1)) * sh.powers(n, sh.BASE_INVERSE, "down"), out=self.sums[1:])
        self.shift = sh.powers(n + 1, sh.BASE, "up")
        self._count()

    def _count(self) -> None:
        self.taken = np.concatenate([[0], np.cumsum(~self.free)])

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places from which ``size`` tokens are free, and the fingerprints of these."""
        at = np.flatnonzero(self.taken[size:] == self.taken[: len(self.taken) - size])
        return at, (self.sums[at + size] - self.sums[at]) * self.shift[at]

    def mark(self, places: list[int], size: int) -> None:
        for at in places:
            self.free[at : at + size] = False
        self._count()


def _marked(doc: _Side, item: _Side, size: int) -> list[tuple[int, int, int]]:
    """Non-overlapping matches of ``size`` tokens, the longest there are: earliest place in doc, then in item."""
    here, code = doc.runs(size)
    there, other = item.runs(size)
    kept = np.isin(code, other)
    here, code = here[kept], code[kept]
    order = np.argsort(other, kind="stable")
    other, there = other[order], there[order]
    first, last = np.searchsorted(other, code, "left").tolist(), np.searchsorted(other, code, "right").tolist()
    free = item.free.tobytes()
    left, at_item = bytearray(free), there.tolist()
    nexts: dict[int, int] = {}
    tiles, end = [], 0
    for at, a, b in zip(here.tolist(), first, last, strict=True):
        if at < end:
            continue
        k = nexts.get(a, a)
        # Marks of this round are as long as the run, so they lie across one of its ends.
        while k < b and not (left[at_item[k]] and left[at_item[k] + size - 1]):
            k += 1
        nexts[a] = k
        if k < b and np.array_equal(doc.tokens[at : at + size], item.tokens[at_item[k] : at_item[k] + size]):
            left[at_item[k] : at_item[k] + size] = bytes(size)
            tiles.append((at, at_item[k], size))
            end = at + size
    return tiles


def tile(doc, item, min_match: int = MIN_MATCH, free=None) -> list[tuple[int, int, int]]:
    """Non-overlapping tiles (place in doc, place in item, size), longest first, earliest on ties.

    ``free`` tells which tokens of ``doc`` may be matched; all if it is not given. A match of some length
    holds one of any smaller length, so the longest is found by halving.
    """
    tokens = [np.asarray(x).astype(sh.U) for x in (doc, item)]
    if not len(tokens[0]) or not len(tokens[1]):
        return []
    one = _Side(tokens[0], np.ones(len(tokens[0]), bool) if free is None else np.asarray(free, bool))
    two = _Side(tokens[1], np.ones(len(tokens[1]), bool))

    def shared(size: int) -> bool:
        return bool(np.isin(one.runs(size)[1], two.runs(size)[1]).any())

    tiles: list[tuple[int, int, int]] = []
    most = min(len(tokens[0]), len(tokens[1]))
    while most >= min_match and shared(min_match):
        low, high = min_match, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        found = _marked(one, two, low)
        one.mark([t[0] for t in found], low)
        two.mark([t[1] for t in found], low)
        tiles += found
        most = low - 1
    return tiles


class Items:
    """A block of the benchmark, ready to be looked up by seed.

    ``keys`` lead from a seed to the items it is a key of, ``n_keys`` items from each.
    """

    def __init__(self, ids: list[int | None], texts: list[str], min_match: int, threshold: float):
        same: dict[bytes, int] = {}
        self.ids: list[list[int | None]] = []
        self.tokens: list[np.ndarray] = []
        for item_id, tokens in zip(ids, tokens_of(texts), strict=True):
            if not len(tokens):
                continue
            k = same.setdefault(tokens.tobytes(), len(self.tokens))
            if k == len(self.tokens):
                self.tokens.append(tokens)
                self.ids.append([])
            self.ids[k].append(item_id)
        self.threshold = threshold
        self.sizes = [min(min_match, len(t)) for t in self.tokens]
        self.codes = [self._codes(t, size) for t, size in zip(self.tokens, self.sizes, strict=True)]
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in set(self.sizes):
            self.by_size[size] = self._keyed([k for k, s in enumerate(self.sizes) if s == size], size)

    @staticmethod
    def _codes(tokens: np.ndarray, size: int) -> np.ndarray:
        w = sh.Words(np.arange(len(tokens)), np.arange(len(tokens)), tokens, np.array([0, len(tokens)]))
        codes, whole = sh.shingle_codes(w, size)
        return codes[whole]

    def _keyed(self, members: list[int], size: int):
        """All seeds of this size, sorted; and the key seeds, sorted, each with an item."""
        own = [np.unique(self.codes[k]) for k in members]
        seeds, times = np.unique(np.concatenate(own), return_counts=True)
        keys, items = [], []
        for k in members:
            codes, n = self.codes[k], len(self.tokens[k])
            often = times[np.searchsorted(seeds, codes)]
            # Of each token, the most common seed over it; a document that covers enough of the item
            # covers one of any ``wanted`` tokens, with one of the seeds over them.
            spread = np.concatenate([np.zeros(size - 1, int), often, np.zeros(size - 1, int)])
            worst = np.lib.stride_tricks.sliding_window_view(spread, size).max(axis=1)
            wanted = min(n, int(np.floor((1 - self.threshold) * n + 1e-9)) + 1)
            rare = np.zeros(n + size - 1, bool)
            rare[np.argsort(worst, kind="stable")[:wanted]] = True
            over = np.lib.stride_tricks.sliding_window_view(rare, size).any(axis=1)[: len(codes)]
            key = np.unique(codes[over])
            keys.append(key)
            items.append(np.full(len(key), k))
        key, item = np.concatenate(keys), np.concatenate(items)
        order = np.argsort(key, kind="stable")
        return seeds, key[order], item[order], size

    def candidates(self, size: int, codes: np.ndarray) -> np.ndarray:
        """Items with a key among the distinct ``codes``."""
        _, keys, items, _ = self.by_size[size]
        first, last = np.searchsorted(keys, codes, "left"), np.searchsorted(keys, codes, "right")
        parts = [items[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True) if b > a]
        return np.unique(np.concatenate(parts)) if parts else np.empty(0, int)


def _pieces(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Token places that seeds at ``places`` (ascending) cover, a gap between pieces, and which of them are no gap."""
    starts = np.flatnonzero(np.diff(places, prepend=-size - 1) > size)
    ends = np.append(starts[1:], len(places)) - 1
    at, free = [], []
    for a, b in zip(places[starts].tolist(), (places[ends] + size).tolist(), strict=True):
        at += [np.arange(a, b), np.array([a])]
        free += [np.ones(b - a, bool), np.zeros(1, bool)]
    return np.concatenate(at), np.concatenate(free)


def covers(w: sh.Words, items: Items, min_match: int, threshold: float) -> dict[int, list[tuple[int | None, float]]]:
    """For each text with enough of an item: (item id, coverage) by item."""
    out: dict[int, list[tuple[int | None, float]]] = {}
    for size, (seeds, _, _, _) in items.by_size.items():
        codes, whole = sh.shingle_codes(w, size)
        near = np.searchsorted(seeds, codes)
        near[near == len(seeds)] = 0
        hits = np.flatnonzero(whole & (seeds[near] == codes))
        texts = np.searchsorted(w.bounds, hits, side="right") - 1
        edges = np.flatnonzero(np.diff(texts, prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            here = hits[a:b]
            own = codes[here]
            for k in items.candidates(size, np.unique(own)).tolist():
                item, n = items.codes[k], len(items.tokens[k])
                shared = np.isin(item, own)
                covered = np.concatenate([shared, np.zeros(size - 1, bool)])
                for shift in range(1, size):
                    covered[shift : shift + len(shared)] |= shared
                if covered.sum() < threshold * n:  # tiles lie within what seeds cover
                    continue
                at, free = _pieces(here[np.isin(own, item)], size)  # any match lies within one piece
                share = sum(s for _, _, s in tile(w.code[at], items.tokens[k], min(min_match, n), free)) / n
                if share >= threshold:
                    out.setdefault(int(texts[a]), []).extend((i, share) for i in items.ids[k])
    return out


def _judge(block, min_match: int, threshold: float, schema: pa.Schema):
    """Batches of rows whose last column is the text to the same rows with the matches added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*block.value, min_match, threshold)
        kind = schema.field("matches").type
        for batch in batches:
            data, offsets = sh.text_buffers(batch.column(batch.num_columns - 1))
            found: list = [[] for _ in range(batch.num_rows)]
            for first, _, part, at in sh.chunks(data, offsets):
                for text, some in covers(sh.words(part, at, letters=True), items, min_match, threshold).items():
                    found[first + text] = [{"item_id": i, "coverage": c} for i, c in sorted(some, key=lambda m: (m[0] is None, m[0] or 0, m[1]))]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], schema=schema)

    return run


MATCHES = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("coverage", T.DoubleType())]))


def dealt_blocks(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, list[int]]:
    """The benchmark's items, each once, with the number of their ``block``, and the blocks there are.

    Blocks are counted, and dealt anew in more of them while one is too large and holds several items.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null and text <> ''").distinct()
    size = F.octet_length("text")
    total, count = items.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    n = 1 + total // block_bytes
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("text", "item_id"), F.lit(n)))
        large = dealt.groupBy("block").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("items"))
        if n == 1 or n >= count or large.where(f"bytes > {2 * block_bytes} and items > 1").isEmpty():
            return dealt, list(range(n))
        n *= 2


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` (as struct ``row``) with ``matches``: items covered enough, and how much of each."""
    spark = ready(docs.sparkSession)
    cuts = Cuts(spark, "tiling")
    dealt, blocks = dealt_blocks(benchmark, block_bytes)
    dealt = cuts.cut(dealt) if len(blocks) > 1 else dealt
    rows = docs.select(F.struct("*").alias("row"))
    out = None
    for k in blocks:
        held = dealt.where(F.col("block") == k).select("item_id", "text").collect()
        block = spark.sparkContext.broadcast(([r[0] for r in held], [r[1] for r in held]))
        source = rows if out is None else out.select("row", F.col("matches").alias("before"))
        schema = T.StructType([*source.schema.fields, T.StructField("matches", MATCHES)])
        text = F.col("row").getField("text").cast("string").alias("text")
        judge = _judge(block, min_match, threshold, _arrow(schema))
        judged = source.select("*", text).mapInArrow(judge, schema)
        if out is not None:
            judged = judged.select("row", F.array_sort(F.concat("before", "matches")).alias("matches"))
        if k == blocks[-1]:
            return judged
        before, out = out, cuts.cut(judged)
        block.destroy()
        if before is not None:
            cuts.drop(before)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold enough of a benchmark item; all columns stay."""
    clean = contamination(docs, benchmark, **options).where(F.size("matches") == 0)
    return clean.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
