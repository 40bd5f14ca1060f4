"""Online logistic regression over the embedding table.

A vector counts as positive if its label is 5 or more. In order of ``vec_id`` the first
half of the table is history, the second half is the stream in five micro-batches.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.functions.sampling import sample_rows
from hybridflow.functions.vectors import parse_labeled_vector, vector_add
from hybridflow.functions.words import split_blank
from hybridflow.operators.learn import error_rates, gradient, gradient_sums, score, stepped
from hybridflow.operators.sparse import train
from hybridflow.session import new_path
from hybridflow.sources.queue import BatchQueue, split_at
from hybridflow.sources.tables import table
from hybridflow.sources.text import history_ready, read_clean_lines
from hybridflow.streaming.training import HybridTrainer, Settings

N = 64
BATCHES = 5
HISTORY_READY_AT = 2
SETTINGS = Settings(n_features=N, rate=8.0, threshold=0.6943)
FIXED = [(j % 7 - 3) / 10.0 for j in range(N)]


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id",
        (F.col("label") >= 5).cast("double").alias("label"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def parts(rows: DataFrame, n: int) -> list[DataFrame]:
    """The whole table as ``n`` runs of ``vec_id`` of equal width, each a range filter."""
    width = (rows.agg(F.max("vec_id")).first()[0] or 0) + 1
    return split_at(rows, "vec_id", [-(-i * width // n) for i in range(1, n)])


def _exploded(df, column, alias, *keep):
    spread = df.select(*keep, F.posexplode(column).alias("j0", "x"))
    rounded = (F.round("x", 6) + F.lit(0.0)).alias(alias)
    return spread.select(*keep, (F.col("j0") + 1).cast("bigint").alias("j"), rounded)


def parse_labeled_vectors(spark, folder):
    path = new_path(spark, "vectors")
    rows = vectors(spark, folder)
    numbers = F.concat(F.array("label"), F.col("features"))
    line = F.concat_ws(",", F.transform(numbers, lambda v: v.cast("string")))
    rows.select(line).write.text(path)
    parsed = read_clean_lines(spark, path).select(parse_labeled_vector(F.col("value"), N).alias("r"))
    return _exploded(parsed.select("r.*"), "features", "x", "label").groupBy("label", "j").agg(
        F.count(F.lit(1)).alias("n"), (F.round(F.sum("x"), 4) + F.lit(0.0)).alias("x")
    )


def added_vectors(spark, folder):
    summed = vectors(spark, folder).select(
        "vec_id", vector_add(F.col("features"), F.reverse("features")).alias("v")
    )
    return _exploded(summed, "v", "x", "vec_id")


def bernoulli_sample(spark, folder):
    return sample_rows(vectors(spark, folder).select("vec_id", "label"), 0.3, seed=7, row_id="vec_id")


def lr_predict(spark, folder):
    return score(vectors(spark, folder), FIXED).select("vec_id", F.round("p", 6).alias("p"))


def lr_error_rate(spark, folder):
    """Both metrics from one scan, a row each."""
    metrics = ["log_loss", "misclassified"]
    rates = error_rates(vectors(spark, folder), FIXED, metrics)
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("rate")) for m in metrics])).alias("r")
    return rates.select(each, "n").select("r.metric", F.round("r.rate", 6).alias("error_rate"), "n")


def lr_gradient(spark, folder):
    sums = gradient_sums(vectors(spark, folder), FIXED)
    mean = F.transform(vector_to_array(F.col("g")), lambda v: v / F.col("n"))
    return _exploded(sums.select(mean.alias("g")), "g", "g")


def lr_sgd_steps(spark, folder):
    """Five steps, each on a fifth of the table."""
    weights, steps = [0.0] * N, []
    for i, batch in enumerate(parts(vectors(spark, folder), BATCHES)):
        weights = stepped(weights, gradient(batch, weights), SETTINGS.rate)
        steps.append((i, weights))
    frame = spark.createDataFrame(steps, "step BIGINT, weights ARRAY<DOUBLE>")
    return _exploded(frame, "weights", "w", "step")


def _halves(spark, folder):
    rows = vectors(spark, folder)
    history, _ = parts(rows, 2)
    return history, parts(rows, 2 * BATCHES)[BATCHES:]


def _trained(spark, folder) -> HybridTrainer:
    history, batches = _halves(spark, folder)
    trainer = HybridTrainer(spark, new_path(spark, "training"), lambda: history, SETTINGS)
    trainer.start_from()
    for batch_id, batch in enumerate(batches):
        trainer(batch, batch_id)
    return trainer


def _trace(trainer):
    return trainer.trace().select(
        "batch_id", F.round("error_rate", 6).alias("error_rate"), "action", "pushed"
    )


def lr_hybrid_retrain(spark, folder):
    return _trace(_trained(spark, folder))


def lr_hybrid_retrain_stream(spark, folder):
    history, batches = _halves(spark, folder)
    trainer = HybridTrainer(spark, new_path(spark, "training"), lambda: history, SETTINGS)
    trainer.start_from()
    BatchQueue(spark).run(batches, lambda s: s.writeStream.foreachBatch(trainer))
    return _trace(trainer)


def lr_buffer_gate(spark, folder):
    """History is being written while the stream runs and is complete before batch 2."""
    history, batches = _halves(spark, folder)
    path = new_path(spark, "history")
    trainer = HybridTrainer(
        spark,
        new_path(spark, "training"),
        lambda: spark.read.schema(history.schema).parquet(path),
        SETTINGS,
        ready=lambda: history_ready(spark, path),
    )
    trainer.start_from()
    for batch_id, batch in enumerate(batches):
        if batch_id == HISTORY_READY_AT:
            history.write.parquet(path)
        trainer(batch, batch_id)
    return _trace(trainer)


def model_push_history(spark, folder):
    pushed = _trained(spark, folder).models.history()
    return _exploded(pushed, "weights", "w", "model_key", "version")


def model_pull_latest(spark, folder):
    latest = _trained(spark, folder).models.latest()
    latest = latest.withColumn("error_rate", F.round("error_rate", 6))
    return _exploded(latest, "weights", "w", "model_key", "version", "error_rate")


SPARSE_STEPS, SPARSE_RATE = 2, 4.0


def lr_sparse_steps(spark, folder):
    """A model of a million features: hashed words of the labelled documents, to tell good from bad.

    A document's words stay an array, a feature as often as its words occur: they are added up where rows are packed.
    """
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    known = labels.where("label IS NOT NULL").select("doc_id")
    words = F.flatten(F.transform(F.split("text", "\n"), split_blank))
    features = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 5), 16, 10).cast("int"))
    hashed = table(spark, folder, "documents").join(known, "doc_id", "left_semi").select("doc_id", features.alias("j"))
    rows = hashed.where(F.size("j") > 0).groupBy("doc_id").agg(F.flatten(F.collect_list("j")).alias("j"))
    share = F.array_repeat(F.lit(1.0) / F.size("j"), F.size("j"))
    rows = rows.join(labels, "doc_id").select("label", F.col("j").alias("indices"), share.alias("values"))
    weights, _ = train(rows, SPARSE_STEPS, SPARSE_RATE)
    return weights.select("j", (F.round("w", 9) + F.lit(0.0)).alias("w"))


QUERIES = {
    "lr_sparse_steps": lr_sparse_steps,
    "parse_labeled_vectors": parse_labeled_vectors,
    "vector_add": added_vectors,
    "bernoulli_sample": bernoulli_sample,
    "lr_predict": lr_predict,
    "lr_error_rate": lr_error_rate,
    "lr_gradient": lr_gradient,
    "lr_sgd_steps": lr_sgd_steps,
    "lr_hybrid_retrain": lr_hybrid_retrain,
    "lr_hybrid_retrain_stream": lr_hybrid_retrain_stream,
    "lr_buffer_gate": lr_buffer_gate,
    "model_push_history": model_push_history,
    "model_pull_latest": model_pull_latest,
}

_VECTORS = """
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CASE WHEN label >= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y
    FROM embeddings"""
_FIXED = "[" + ", ".join(f"{w}::DOUBLE" for w in FIXED) + "]"
_P = "1.0 / (1.0 + exp(-list_dot_product(x, {w})))"
_LOSS = "avg(-(y * ln(p) + (1.0 - y) * ln(1.0 - p)))"


def _step_sql(name: str, rows: str, weights: str) -> str:
    """CTEs for one step from the weight list of ``weights``: ``name_p``, ``name_g`` and ``name``.

    Without rows the weights stay.
    """
    return f"""
    {name}_p AS MATERIALIZED (
        SELECT x, y, {_P.format(w='w')} AS p FROM ({rows}), {weights}),
    {name}_g AS MATERIALIZED (
        SELECT list(g ORDER BY j) AS g FROM (
            SELECT j, avg((p - y) * x[j]) AS g FROM {name}_p, (SELECT unnest(range(1, {N + 1})) AS j)
            GROUP BY j)),
    {name} AS MATERIALIZED (
        SELECT CASE WHEN g IS NULL THEN w
                    ELSE (SELECT list(w[j] - {SETTINGS.rate}::DOUBLE * g[j] ORDER BY j)
                          FROM (SELECT unnest(range(1, {N + 1})) AS j)) END AS w
        FROM {weights}, {name}_g)"""


def _parts_sql(n: int) -> str:
    return f"""
    v AS MATERIALIZED (
        SELECT *, vec_id * {n} // ((SELECT max(vec_id) FROM embeddings) + 1) AS part FROM ({_VECTORS})),
    zero AS (SELECT list(0.0::DOUBLE) AS w FROM range({N}))"""


def _steps_sql() -> str:
    ctes, weights, outs = [_parts_sql(BATCHES)], "zero", []
    for i in range(BATCHES):
        ctes.append(_step_sql(f"s{i}", f"SELECT x, y FROM v WHERE part = {i}", weights))
        weights = f"s{i}"
        outs.append(f"SELECT {i}::BIGINT AS step, unnest(range(1, {N + 1})) AS j, unnest(w) AS w FROM s{i}")
    return f"""WITH {", ".join(ctes)}
    SELECT step, j, round(w, 6) + 0.0 AS w FROM ({" UNION ALL ".join(outs)})"""


def _training_sql(select: str, ready_at: int = 0) -> str:
    """The training run with every micro-batch written out."""
    ctes = [
        _parts_sql(2 * BATCHES),
        "m0 AS (SELECT w, 0::BIGINT AS version, NULL::DOUBLE AS error FROM zero)",
        "held0 AS (SELECT []::INTEGER[] AS held)",
    ]
    for b in range(BATCHES):
        now = f"SELECT x, y FROM v WHERE part = {BATCHES + b}"
        past = f"""SELECT x, y FROM v WHERE part < {BATCHES}
                   OR list_contains((SELECT held FROM held{b}), part - {BATCHES})"""
        when_high = "retrain" if b >= ready_at else "buffer"
        ctes.append(_step_sql(f"one{b}", now, f"m{b}"))
        ctes.append(_step_sql(f"two{b}", past, f"one{b}"))
        ctes.append(f"""
        did{b} AS MATERIALIZED (
            SELECT error, CASE WHEN error > {SETTINGS.threshold} THEN '{when_high}' ELSE 'step' END AS action
            FROM (SELECT {_LOSS} AS error FROM one{b}_p)),
        held{b + 1} AS MATERIALIZED (
            SELECT CASE action WHEN 'retrain' THEN [] WHEN 'buffer' THEN list_append(held, {b})
                   ELSE held END AS held
            FROM held{b}, did{b}),
        m{b + 1} AS MATERIALIZED (
            SELECT CASE WHEN len(held) > 0 THEN m{b}.w WHEN action = 'retrain' THEN two{b}.w
                        ELSE one{b}.w END AS w,
                   CASE WHEN len(held) > 0 THEN m{b}.version ELSE {b + 1} END AS version,
                   CASE WHEN len(held) > 0 THEN m{b}.error ELSE did{b}.error END AS error
            FROM m{b}, one{b}, two{b}, did{b}, held{b + 1})""")
    trace = " UNION ALL ".join(
        f"""SELECT {b}::BIGINT AS batch_id, round(error, 6) AS error_rate, action, len(held) = 0 AS pushed
            FROM did{b}, held{b + 1}"""
        for b in range(BATCHES)
    )
    versions = " UNION ".join(f"SELECT w, version, error FROM m{b}" for b in range(BATCHES + 1))
    ctes += [f"trace AS ({trace})", f"versions AS ({versions})"]
    return f"WITH {', '.join(ctes)} {select}"


_WEIGHT_ROWS = f"""
    SELECT model_key, version, j, round(w, 6) + 0.0 AS w {{more}} FROM (
        SELECT '{SETTINGS.model_key}' AS model_key, version, round(error, 6) AS error_rate,
               unnest(range(1, {N + 1})) AS j, unnest(w) AS w
        FROM versions) {{where}}"""
_TRACE = "SELECT batch_id, error_rate, action, pushed FROM trace"

_SPARSE = f"""
    WITH words AS (
      SELECT doc_id, CAST('0x' || substr(md5(word), 1, 5) AS BIGINT) AS j
      FROM (SELECT doc_id, unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                                       ELSE string_split(rtrim(line, ' '), ' ') END) AS word
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))
    ), x AS (
      SELECT doc_id, j, CAST(quality AS DOUBLE) AS y, count(*) / CAST(sum(count(*)) OVER (PARTITION BY doc_id) AS DOUBLE) AS x
      FROM words JOIN labels USING (doc_id) GROUP BY doc_id, j, quality
    ), n AS (SELECT count(DISTINCT doc_id) AS n FROM x
    ), w1 AS (SELECT j, -{SPARSE_RATE} * sum((0.5 - y) * x) / any_value(n) AS w FROM x, n GROUP BY j
    ), p AS (SELECT doc_id, 1 / (1 + exp(-sum(w * x))) AS p FROM x JOIN w1 USING (j) GROUP BY doc_id
    ), g AS (SELECT j, sum((p - y) * x) / any_value(n) AS g FROM n, x JOIN p USING (doc_id) GROUP BY j)
    SELECT j, round(w - {SPARSE_RATE} * g, 9) + 0.0::DOUBLE AS w FROM w1 JOIN g USING (j)"""

SQL = {
    "lr_sparse_steps": _SPARSE,
    "parse_labeled_vectors": f"""
        SELECT label, j, count(*) AS n, round(sum(x), 4) + 0.0 AS x FROM (
            SELECT y AS label, unnest(range(1, {N + 1})) AS j, round(unnest(x), 6) AS x FROM ({_VECTORS}))
        GROUP BY label, j""",
    "vector_add": f"""
        SELECT vec_id, j, round(x[j] + x[{N + 1} - j], 6) + 0.0 AS x
        FROM ({_VECTORS}), (SELECT unnest(range(1, {N + 1})) AS j)""",
    "bernoulli_sample": f"""
        SELECT vec_id, y AS label FROM ({_VECTORS})
        WHERE CAST('0x' || md5('7:' || vec_id)[:8] AS BIGINT) / 4294967296.0 < 0.3""",
    "lr_predict": f"SELECT vec_id, round({_P.format(w=_FIXED)}, 6) AS p FROM ({_VECTORS})",
    "lr_error_rate": f"""
        SELECT metric, round(error_rate, 6) AS error_rate, n FROM (
            SELECT 'log_loss' AS metric, {_LOSS} AS error_rate, count(*) AS n
            FROM (SELECT y, {_P.format(w=_FIXED)} AS p FROM ({_VECTORS}))
            UNION ALL
            SELECT 'misclassified', avg(CASE WHEN (p >= 0.5) = (y >= 0.5) THEN 0.0 ELSE 1.0 END), count(*)
            FROM (SELECT y, {_P.format(w=_FIXED)} AS p FROM ({_VECTORS})))""",
    "lr_gradient": f"""
        SELECT j, round(avg((p - y) * x[j]), 6) + 0.0 AS g
        FROM (SELECT x, y, {_P.format(w=_FIXED)} AS p FROM ({_VECTORS})),
             (SELECT unnest(range(1, {N + 1})) AS j)
        GROUP BY j""",
    "lr_sgd_steps": _steps_sql(),
    "lr_hybrid_retrain": _training_sql(_TRACE),
    "lr_hybrid_retrain_stream": _training_sql(_TRACE),
    "lr_buffer_gate": _training_sql(_TRACE, HISTORY_READY_AT),
    "model_push_history": _training_sql(_WEIGHT_ROWS.format(more="", where="")),
    "model_pull_latest": _training_sql(
        _WEIGHT_ROWS.format(
            more=", error_rate", where="WHERE version = (SELECT max(version) FROM versions)"
        )
    ),
}
