"""Near-duplicate documents by MinHash: universal hash minima, banding, verification, components.

1. Every text becomes its set of word shingles, as 64-bit fingerprints of whole shingles. A
   fingerprint of the set itself brings documents with equal sets into one class; from here on a
   class is one row, however many copies it has.
2. ``bands * rows`` universal hashes ``(a * x + b) mod 2**64`` give minima; each band's minima are one
   bucket key. At similarity 0.8 a pair meets in no bucket with probability below 1e-6.
3. Each member of a bucket is held against the bucket's first member, by the full sets, and confirmed
   links are united. Buckets that still hold several components are searched once more, block
   against block: signatures first (a pair that agrees in far too few minima is let go: below 1e-8
   at 0.8), then the full sets; members of one component need no second look. So no link between
   different texts is lost, and no bucket's pairs are written out.
4. Components come from alternating large-star and small-star.

Buckets are never gathered whole: the first member is a minimum, and blocks hold ``block`` members.

Defined results: null and blank texts have no shingles and link with nothing. Rows that repeat
doc_id are one node; their texts' links all count. Null ids link, but name no component: the
smallest id that is not null does, or null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hybridflow.llm import shingles as sh
from hybridflow.llm.common import Cuts, keyed_text, ready, text_tag
from hybridflow.llm.components import components

BANDS = 35
ROWS = 5
#: Members of a bucket that one task compares, and bytes of their sets.
BLOCK = 1000
BLOCK_BYTES = 8 << 20
#: A pair at the threshold agrees in fewer of the minima than this share below it with p < 1e-9.
SLACK = 6.0
#: Components without any id are named from here on.
NAMELESS = 1 << 62
SPACES = " \t\n\x0b\f\r"

U, U8 = np.uint64, np.uint8


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    a = draw.integers(0, 1 << 63, n, dtype=np.uint64) * U(2) + U(1)
    return a[:, None], draw.integers(0, 1 << 63, n, dtype=np.uint64)[:, None]


def minima(items: np.ndarray, family) -> np.ndarray:
    """The smallest value of every hash over the set."""
    a, b = family
    out = np.full(len(a), np.iinfo(np.uint64).max, dtype=U)
    for at in range(0, len(items), 256):
        np.minimum(out, (a * items[at : at + 256] + b).min(axis=1), out=out)
    return out


def set_code(items: np.ndarray) -> tuple[int, int]:
    """128 bits naming a set."""
    first = sh.mix(items).sum(dtype=U) + U(len(items))
    second = np.bitwise_xor.reduce(sh.mix(items + U(sh.BASE))) if len(items) else U(0)
    return _signed(sh.mix(np.array([first, second], dtype=U)))


def _signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def set_rows(size: int, n_bands: int, n_rows: int, seed: int):
    """Batches of (doc_id, tag, text) to (doc_id, tag, n, s1, s2, keys, minima)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(n_bands * n_rows, seed)
        place = sh.PLACES[:n_rows]
        band = sh.mix(np.arange(n_bands, dtype=U) + U(1))
        for batch in batches:
            data, offsets = sh.text_buffers(batch.column(2))
            ns, s1, s2, keys, sigs = [], [], [], [], []
            for _, _, part, at in sh.chunks(data, offsets):
                for items in sh.shingle_sets(sh.words(part, at), size):
                    ns.append(len(items))
                    x, y = set_code(items)
                    s1.append(x)
                    s2.append(y)
                    if len(items):
                        m = minima(items, family)
                        keys.append(_signed(sh.mix((m.reshape(n_bands, n_rows) * place).sum(axis=1, dtype=U) + band)))
                        sigs.append(sh.mix(m).astype(np.uint8).tobytes())  # a minimum's own bits lean to 0, its mixed ones don't
                    else:
                        keys.append([])
                        sigs.append(b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ns, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                ["doc_id", "tag", "n", "s1", "s2", "keys", "sig"],
            )

    return run


SETS = "doc_id long, tag long, n long, s1 long, s2 long, keys array<long>, sig binary"


def overlap_enough(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct fingerprints."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets_of(size: int):
    """Batches of (doc_id, text) to (s1, s2, items): the whole set as sorted 64-bit fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = sh.text_buffers(batch.column(0))
            s1, s2, sets = [], [], []
            for _, _, part, at in sh.chunks(data, offsets):
                for items in sh.shingle_sets(sh.words(part, at), size):
                    x, y = set_code(items)
                    s1.append(x)
                    s2.append(y)
                    sets.append(items.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sets, pa.binary())], ["s1", "s2", "items"]
            )

    return run


def _confirmed(percent: int):
    """Batches of (a, b, x, y), two nodes and their sets, to the linked (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column(2), batch.column(3)
            keep = [
                overlap_enough(np.frombuffer(xs[i].as_py(), U), np.frombuffer(ys[i].as_py(), U), percent)
                for i in range(batch.num_rows)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def least_agreement(n: int, percent: int) -> int:
    p = percent / 100
    return int(np.floor(n * p - SLACK * np.sqrt(n * p * (1 - p))))


def _across(percent: int):
    """A bucket's members, or two blocks of them, to links that join components not joined before.

    A pair is looked at in the first bucket it shares only; pairs of one component are passed over,
    also of one that grew together here, so that at most one link per member comes out.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = len(rows)
        sig = np.frombuffer(b"".join(rows["sig"]), U8).reshape(n, -1)
        keys = np.stack(rows["keys"].to_numpy())
        band = int(np.argmax(keys[0] == key[0]))
        node, block = rows["node"].to_numpy(), rows["own"].to_numpy()
        comp = rows["comp"].to_numpy().copy()
        least = least_agreement(sig.shape[1], percent)
        sets = [np.frombuffer(x, U) for x in rows["items"]]
        sizes = np.array([len(x) for x in sets])
        within = key[1] == key[2]
        out = []
        for x in range(n - 1):
            other = np.arange(x + 1, n)
            far = (comp[other] != comp[x]) & (100 * np.minimum(sizes[other], sizes[x]) >= percent * np.maximum(sizes[other], sizes[x]))
            if not within:
                far &= block[other] != block[x]
            other = other[far]
            other = other[(sig[other] == sig[x]).sum(axis=1) >= least]
            other = other[~(keys[other, :band] == keys[x, :band]).any(axis=1)]
            for y in other:
                if comp[y] != comp[x] and overlap_enough(sets[x], sets[y], percent):
                    out.append((max(node[x], node[y]), min(node[x], node[y])))
                    comp[comp == comp[y]] = comp[x]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def grouped(docs: DataFrame, size: int, percent: int, bands: int, rows: int, seed: int, block: int) -> DataFrame:
    """Per row of ``docs``: ``doc_id, tag, n, c``, where ``c`` names the component (null without shingles).

    ``c`` is the smallest id of the component, or at least NAMELESS if it has none.
    """
    spark = ready(docs.sparkSession)
    cuts = Cuts(spark, "minhash")
    doc = keyed_text(docs)
    marked = cuts.cut(doc.mapInArrow(set_rows(size, bands, rows, seed), SETS))

    nameless = F.lit(NAMELESS) + F.shiftrightunsigned("s1", 3)
    classes = cuts.cut(
        marked.where("n > 0")
        .groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sig").alias("sig"))
        .select("s1", "s2", "rep", F.coalesce("rep", nameless).alias("node"), "n", "keys", "sig")
    )
    links = [_same_id_links(marked, classes)]

    # Members of buckets that hold more than one class, each with the bucket's first member.
    spread = classes.select(F.explode("keys").alias("key"), "node", "n")
    first = spread.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("members")).where("members > 1")
    members = cuts.cut(spread.join(first.withColumnRenamed("key", "k"), F.col("key") == F.col("k")).drop("k"))

    pairs = members.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    reloaded = classes.join(members.select(F.col("node").alias("m")).distinct(), F.col("node") == F.col("m"), "left_semi")
    wanted = reloaded.select(F.col("rep").alias("r"), "s1", "s2", "node", "keys", "sig")
    texts = doc.join(wanted.select("r").distinct(), F.col("doc_id").eqNullSafe(F.col("r")), "left_semi")
    sets = texts.select("text").mapInArrow(_sets_of(size), "x1 long, x2 long, items binary")
    sets = cuts.cut(
        sets.join(wanted, (F.col("x1") == F.col("s1")) & (F.col("x2") == F.col("s2")))
        .groupBy("node", "s1", "s2").agg(*[F.first(c).alias(c) for c in ("items", "keys", "sig")]).drop("s1", "s2")
    )

    def confirmed(some: DataFrame) -> DataFrame:
        xs = sets.select(F.col("node").alias("p"), F.col("items").alias("x"))
        ys = sets.select(F.col("node").alias("q"), F.col("items").alias("y"))
        both = some.join(xs, F.col("a") == F.col("p")).join(ys, F.col("b") == F.col("q")).select("a", "b", "x", "y")
        return both.mapInArrow(_confirmed(percent), "a long, b long")

    links.append(cuts.cut(confirmed(pairs)))
    found = cuts.cut(components(links[0].union(links[1]), cuts))

    # Buckets whose members are not of one component yet.
    comp = F.coalesce("component", "node")
    placed = members.join(found.withColumnRenamed("node", "f"), F.col("node") == F.col("f"), "left")
    placed = placed.select("key", "node", comp.alias("comp"), "n", "members")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum("n").alias("total"))
    mixed = mixed.where("lo <> hi").select(F.col("key").alias("k"), "total")
    open_ = cuts.cut(placed.join(mixed, F.col("key") == F.col("k")).drop("k"))
    if not open_.isEmpty():
        blocks = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("total") * 8 / BLOCK_BYTES)).cast("int")
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        facts = sets.withColumnRenamed("node", "f")
        each = open_.join(facts, F.col("node") == F.col("f")).drop("f").withColumn("blocks", blocks).withColumn("own", own)
        each = each.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        i, j = F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j")
        each = each.select("key", i, j, "own", "node", "comp", "sig", "keys", "items")
        more = cuts.cut(each.groupBy("key", "i", "j").applyInPandas(_across(percent), "a long, b long"))
        known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = cuts.cut(components(known.union(more), cuts))

    named = classes.join(found.withColumnRenamed("node", "f"), F.col("node") == F.col("f"), "left")
    named = named.select(F.col("s1").alias("c1"), F.col("s2").alias("c2"), comp.alias("c"))
    out = marked.join(named, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")), "left")
    return out.select("doc_id", "tag", "n", "c")


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    seed: int = 11,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents with ``100 * intersection >= percent * union`` of their shingle sets are linked.
    """
    out = grouped(docs, size, percent, bands, rows, seed, block)
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("c") < NAMELESS, F.col("c"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    seed: int = 11,
    block: int = BLOCK,
) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id. All columns stay.

    Of rows that repeat id and text one stays; different texts under that id are one document and
    all stay, and so do documents without shingles.
    """
    cuts = Cuts(ready(docs.sparkSession), "minhash-kept")
    rows_ = cuts.cut(grouped(docs, size, percent, bands, rows, seed, block))
    place = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("d"), F.col("tag").alias("t"))
    firsts = rows_.where("c is not null").groupBy(F.col("c").alias("k")).agg(F.min(place).alias("first"))
    chosen = (F.col("doc_id") == F.col("first.d")) | (F.col("first.late") & (F.col("tag") == F.col("first.t")))
    firsts = rows_.join(firsts, F.col("c") == F.col("k")).where(chosen)
    firsts = firsts.select(F.col("doc_id").alias("d"), F.col("tag").alias("t")).distinct()
    bare = rows_.where("c is null").select(F.col("doc_id").alias("d"), F.col("tag").alias("t")).distinct()
    left = docs.select(F.struct("*").alias("row"), text_tag(docs["text"]).alias("tag"), docs["doc_id"].cast("long").alias("id"))
    kept = firsts.union(bare)
    out = left.join(kept, left["id"].eqNullSafe(kept["d"]) & (left["tag"] == kept["t"]), "left_semi")
    twice = rows_.where("c is not null").groupBy("doc_id", "tag").count().where("count > 1")
    if not twice.isEmpty():
        nth = F.row_number().over(Window.partitionBy("id", "tag").orderBy(F.lit(0)))
        bare_row = F.col("row").getField("text").isNull() | (F.trim(F.translate(F.col("row").getField("text"), SPACES, " " * len(SPACES))) == "")
        out = out.withColumn("nth", nth).where((F.col("nth") == 1) | bare_row)
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _same_id_links(marked: DataFrame, classes: DataFrame) -> DataFrame:
    """An id that stands on rows of several classes joins those classes."""
    node = classes.select(F.col("s1").alias("c1"), F.col("s2").alias("c2"), "node")
    rows = marked.where("n > 0 and doc_id is not null").select("doc_id", "s1", "s2").distinct()
    several = rows.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select(F.col("doc_id").alias("d"))
    rows = rows.join(several, F.col("doc_id") == F.col("d"), "left_semi")
    linked = rows.join(node, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")))
    return linked.where("node <> doc_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
