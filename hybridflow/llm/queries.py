"""One query per operator over the given tables, and SQL for the same rows where there is any."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.llm import (
    decontaminate,
    embedding_dedup,
    filter_audit,
    hard_negatives,
    html_text,
    line_dedup,
    minhash,
    mixing,
    pii,
    sharding,
    suffix_dedup,
    toxicity,
    warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to a WARC archive and read back through the archives' index."""
    return warc.round_trip(spark, table(spark, folder, "pages"), min_revisit_bytes=0)


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words each document gives to a mix of 150% of all words, sources weighing 5, 2, 1."""
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of one label whose cosine is 0.98 or more, their links and components."""
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"), cosine=0.98)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from the labelled rows that are not held out."""
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document under a 200-byte string that also starts elsewhere, taken out."""
    out = suffix_dedup.remove_repeats(table(spark, folder, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles overlap by 80%."""
    return minhash.near_duplicates(table(spark, folder, "documents"), size=4, percent=80)


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that repeated three-line windows remove from each document, and what stays."""
    out = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """E-mail addresses, IP addresses, card and phone numbers of every document."""
    found = pii.personal_data(table(spark, folder, "documents").select("doc_id", "text"))

    def joined(spans: str):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page, by a node classifier trained on made-up pages."""
    text = html_text.extract(table(spark, folder, "pages"), html_text.fit(spark))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that each document covers by 80% or more."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    best = F.array_sort(F.transform("matches", lambda m: F.struct((-m["coverage"]).alias("order"), m["item_id"].alias("item"))))
    top = F.get(best, F.lit(0))
    return found.select(
        "row.doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.array_join(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string"))), ",").alias("item_ids"),
        top["item"].alias("best_item"),
        F.coalesce(-top["order"], F.lit(0.0)).alias("coverage"),
    )


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in 16 shards that all match the mixture of sources."""
    placed = sharding.assign(table(spark, folder, "documents"))
    law, grown = F.lit(sharding.LAW).alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove from each source, in all 120 orders."""
    masks = filter_audit.failure_masks(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return filter_audit.audit(masks)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives for every hundredth vector and each of its positives."""
    rows = table(spark, folder, "embeddings")
    return hard_negatives.hard_negatives(rows.withColumn("label", hard_negatives.relabelled(rows["label"], rows["vec_id"])))


OP1_SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, n, hex, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS INTEGER), 1)), '') AS digest
  FROM hashed
), first AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM coded
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM first
"""

OP2_SQL = """
WITH base AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':17'), 1, 12) AS BIGINT) + 0.5::DOUBLE)
        / 281474976710656::DOUBLE)
      / coalesce(0.25::DOUBLE + 0.75::DOUBLE * length(regexp_replace(text, '[^\\p{L}]+', '', 'g'))
                 / greatest(length(text), 1), 0.25::DOUBLE) AS key
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1 AS place
  FROM base GROUP BY source
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
    source_size * 2.0::DOUBLE AS cap
  FROM totals
), levels AS (
  SELECT *, row_number() OVER w AS rank,
    ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
      / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW w AS (ORDER BY cap / weight, place)
), chosen AS (
  SELECT arg_min(level, rank) AS level FROM levels WHERE level <= cap / weight
), plan AS (
  SELECT source, source_size, least(cap, coalesce(chosen.level * weight, cap)) AS target FROM levels, chosen
), ordered AS (
  SELECT b.doc_id, b.size, p.source_size, p.target,
    CASE WHEN p.source_size > 0 THEN CAST(floor(p.target / p.source_size) AS BIGINT) ELSE 0 END AS whole,
    coalesce(CAST(sum(b.size) OVER (PARTITION BY b.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS prefix
  FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(0, least(size,
    CAST(floor(target - whole * source_size) AS BIGINT) - prefix)) AS BIGINT) AS taken
FROM ordered
"""

#: The search is exact where a shard is no larger than its beam, as here; elsewhere it may miss a few.
OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.y FROM reach r JOIN links l ON l.x = r.b
), least_of AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least_of ON a = vec_id LEFT JOIN counts ON x = vec_id
"""

OP6_SQL = """
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : least(i + 3, len(w))], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM tokens WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), overlap AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM overlap JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.y FROM reach r JOIN links l ON l.x = r.b
), least_of AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN least_of ON a = doc_id
"""

OP7_SQL = """
WITH texts AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), windows AS (
  SELECT doc_id, i AS line,
    lines[i + 1] || chr(10) || lines[i + 2] || chr(10) || lines[i + 3] AS content
  FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS i FROM texts WHERE len(lines) >= 3)
), filled AS (
  SELECT * FROM windows WHERE regexp_matches(content, '[^ \\t\\n\\r\\f\\x0b]')
), later AS (
  SELECT doc_id, line FROM filled
  QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, line) > 1
), covered AS (
  SELECT DISTINCT doc_id, line + unnest([0, 1, 2]) AS line FROM later
), kept AS (
  SELECT doc_id, string_agg(content, chr(10) ORDER BY i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(lines) AS content, unnest(range(0, len(lines))) AS i FROM texts) l
  WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.doc_id = l.doc_id AND c.line = l.i)
  GROUP BY doc_id
)
SELECT t.doc_id, CAST(coalesce(len(t.lines), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(t.lines), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  CASE WHEN t.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS kept_md5
FROM texts t LEFT JOIN kept k USING (doc_id)
"""


def _crc_step(c: int) -> int:
    for _ in range(8):
        c = 0xEDB88320 ^ c >> 1 if c & 1 else c >> 1
    return c


# The checksum's step over a byte is linear, so it is the sum of the steps of the byte's bits.
_CRC_FOLD = functools.reduce(
    lambda a, b: f"xor({a}, {b})", [f"((xor(c, b) >> {k}) & 1) * {_crc_step(1 << k)}" for k in range(8)], "(c >> 8)"
)
_U48 = "(CAST('0x' || substr(md5({}), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE"

OP11_SQL = f"""
WITH coded AS (
  SELECT doc_id, source, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes FROM documents
), base AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS s, CAST(len(bytes) + 1 AS BIGINT) AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(bytes, lambda h: CAST('0x' || h AS BIGINT))),
        lambda c, b: {_CRC_FOLD})) AS text_crc32
  FROM coded
), keyed AS (
  SELECT *, {_U48.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_crc32 || ':' || copy || ':29'")} AS key,
    {_U48.format("'source:' || s || ':29'")} AS start
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, s, size, text_crc32) - 1 AS copy FROM base)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY key, doc_id NULLS FIRST, size, text_crc32, copy) - 1 AS rank,
    count(*) OVER (PARTITION BY s) AS source_n
  FROM keyed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (CAST(rank AS DOUBLE) + start) / source_n, s, rank) - 1 AS place, count(*) OVER () AS total
  FROM ranked
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(place * 16 // total AS INTEGER) AS shard,
  CAST(place - ((place * 16 // total) * total + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

OP12_SQL = """
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), masks AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM base
), told AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM masks LEFT JOIN told USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), placed AS (
  SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before FROM placed
), counted AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

OP13_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, a.label = r.label AND a.vec_id = r.vec_id AS itself,
    CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM rows a, rows r WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same AND NOT itself
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

QUERIES = {
    "op1_warc": op1_warc,
    "op2_mix_sources": op2_mix_sources,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_personal_data": op8_personal_data,
    "op9_html_text": op9_html_text,
    "op10_decontaminate": op10_decontaminate,
    "op11_sharding": op11_sharding,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL = {
    "op1_warc": OP1_SQL,
    "op2_mix_sources": OP2_SQL,
    "op3_embedding_dedup": OP3_SQL,
    "op6_minhash_near_dedup": OP6_SQL,
    "op7_line_dedup": OP7_SQL,
    "op11_sharding": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
