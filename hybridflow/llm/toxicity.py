"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier.

1. Features of a text are its distinct words (runs of letters, digits and non-ASCII characters) and
   word beginnings, as 64-bit fingerprints, computed where the text is read.
2. Voters: lexicons of insults by language, and lexicons of words and of word beginnings that the
   labelled rows show, dealt into several; patterns ask for several different insults, and for many
   of them in few words. A voter fires or not.
3. The label model gives every voter's accuracy in either class and, along a tree of the strongest
   dependences (Chow-Liu, given the class), its correlation with one other voter. It is fitted by
   expectation-maximisation on how often each pattern of votes occurs.
4. A logistic regression over the features is trained on the model's posterior labels; it scores
   every whole text.

Learning uses at most ``sample_rows`` labelled rows, those of smallest fingerprint of their id, and
never rows held out. What reaches the driver is bounded by that sample and ``max_features``.

Defined results: null and empty texts have no features and get the score of a text without any. A
null id is not held out. Without labelled rows the lexicons alone decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hybridflow.llm import shingles as sh
from hybridflow.llm.common import ready, text_tag

SAMPLE_ROWS = 12_000
MAX_FEATURES = 4096
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
U = np.uint64

# Common insults by language.
LEXICONS = {
    "en": "idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb imbecile fool jerk bastard creep",
    "de": "idiot trottel dummkopf arschloch abschaum versager vollidiot penner widerling mistkerl",
    "fr": "imbécile crétin connard salaud abruti ordure minable débile pauvre-type pourriture",
    "es": "imbécil estúpido cabrón basura inútil payaso asqueroso patético tarado miserable",
}

LEARNED_GROUPS = 3
FEW_WORDS = 60


def held_out(doc_id: Column) -> Column:
    """Rows that must teach nothing: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features(w: sh.Words, data: np.ndarray) -> list[np.ndarray]:
    """Fingerprints of whole words, then of beginnings of each length (0 for shorter words)."""
    out = [w.code]
    for k in PREFIXES:
        long = w.end - w.start > k
        code = np.zeros(len(w.code), dtype=U)
        code[long] = sh.range_codes(data, w.start[long], w.start[long] + k) ^ U(k)
        out.append(code)
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def lexicon_codes() -> list[np.ndarray]:
    out = []
    for words in LEXICONS.values():
        data, offsets = sh.text_buffers(pa.array([words.replace("-", " ")]))
        out.append(np.unique(sh.words(data, offsets, letters=True).code))
    return out


class Vocabulary:
    """Sorted features, with a small table that settles most lookups of others."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.unique(codes)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.codes >> U(48)).astype(np.int64)] = True

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``codes`` that hold a feature, and which."""
        at = np.flatnonzero(self.maybe[(codes >> U(48)).astype(np.int64)])
        if not len(self.codes) or not len(at):
            return at[:0], at[:0]
        k = np.searchsorted(self.codes, codes[at])
        k[k == len(self.codes)] = 0
        same = self.codes[k] == codes[at]
        return at[same], k[same]

    def of_texts(self, w: sh.Words, data: np.ndarray) -> list[np.ndarray]:
        """Distinct features of each text."""
        n = len(w.bounds) - 1
        keys = []
        for codes in features(w, data):
            at, k = self.find(codes)
            text = np.searchsorted(w.bounds, at, side="right") - 1
            keys.append(text.astype(np.int64) * (len(self.codes) + 1) + k)
        pair = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
        text, k = np.divmod(pair, len(self.codes) + 1)
        ends = np.searchsorted(text, np.arange(n + 1))
        return [k[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) to how many toxic and other texts of a chunk have each feature."""
    for batch in batches:
        toxic = np.array(batch.column(0).to_pylist(), dtype=np.int64)
        data, offsets = sh.text_buffers(batch.column(1))
        for first, _, part, at in sh.chunks(data, offsets):
            low = lowered(part)
            w = sh.words(part, at, letters=True)
            n = np.diff(w.bounds)
            text = np.repeat(np.arange(len(n)), n)
            codes, votes = [], []
            for some in features(w, low):
                order = np.lexsort((text, some))
                c, t = some[order], text[order]
                new = np.ones(len(c), dtype=bool)
                new[1:] = (c[1:] != c[:-1]) | (t[1:] != t[:-1])
                new &= c != 0
                codes.append(c[new])
                votes.append(toxic[first + t[new]])
            code, which = np.unique(np.concatenate(codes), return_inverse=True)
            vote = np.concatenate(votes)
            bad = np.bincount(which, weights=vote, minlength=len(code)).astype(np.int64)
            every = np.bincount(which, minlength=len(code)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code.view(np.int64)), pa.array(bad), pa.array(every - bad)], ["code", "bad", "good"]
            )


def _shown(codes: np.ndarray):
    """(toxic, text) to the text's number of words and which of ``codes`` it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(codes)
        for batch in batches:
            data, offsets = sh.text_buffers(batch.column(0))
            n_words, found = [], []
            for _, _, part, at in sh.chunks(data, offsets):
                w = sh.words(part, at, letters=True)
                n_words += np.diff(w.bounds).tolist()
                found += [k.tolist() for k in vocabulary.of_texts(w, lowered(part))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(n_words, pa.int32()), pa.array(found, pa.list_(pa.int32()))], ["n_words", "found"]
            )

    return run


@dataclass
class LabelModel:
    """P(class) and P(vote | parent's vote, class) of binary voters along a tree."""

    prior: float
    parent: list[int]
    table: np.ndarray  # voter, parent's vote, class -> P(fires)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, up in enumerate(self.parent):
            above = votes[:, up] if up >= 0 else np.zeros(len(votes), dtype=int)
            p = self.table[j][above]
            log += np.log(np.where(votes[:, [j]] == 1, p, 1 - p))
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        return p[:, 1] / p.sum(axis=1)


def _tree(votes: np.ndarray, weight: np.ndarray) -> list[int]:
    """Parents that maximise mutual information given the class. ``weight``: rows by class."""
    n = votes.shape[1]
    gain = np.zeros((n, n))
    for c in (0, 1):
        w = weight[:, c] + 1e-12
        share = w.sum() / weight.sum()
        for a in (0, 1):
            for b in (0, 1):
                joint = ((votes == a) * w[:, None]).T @ (votes == b) / w.sum() + 1e-9
                pa_, pb = ((votes == a) * w[:, None]).sum(0) / w.sum() + 1e-9, ((votes == b) * w[:, None]).sum(0) / w.sum() + 1e-9
                gain += share * joint * np.log(joint / np.outer(pa_, pb))
    parent, inside = [-1] * n, {0}
    while len(inside) < n:
        _, i, j = max((gain[i, j], i, j) for i in inside for j in range(n) if j not in inside)
        parent[j] = i
        inside.add(j)
    return parent


def fit_label_model(votes: np.ndarray, count: np.ndarray, rounds: int = 30) -> LabelModel:
    """Expectation-maximisation from the number of voters that fire. ``votes``: distinct patterns."""
    fired = votes.sum(axis=1)
    post = np.where(fired >= 2, 0.95, np.where(fired == 1, 0.5, 0.01))
    model = None
    for _ in range(rounds):
        weight = count[:, None] * np.stack([1 - post, post], axis=1)
        parent = _tree(votes, weight)
        table = np.zeros((votes.shape[1], 2, 2))
        for j, up in enumerate(parent):
            for v in (0, 1):
                rows = np.ones(len(votes), bool) if up < 0 else votes[:, up] == v
                table[j, v] = (weight[rows][votes[rows, j] == 1].sum(axis=0) + 0.1) / (weight[rows].sum(axis=0) + 1.0)
        prior = float(np.clip(weight[:, 1].sum() / weight.sum(), 1e-3, 0.5))
        model = LabelModel(prior, parent, table)
        post = model.posterior(votes)
    return model


def fit_linear(rows: list[np.ndarray], n: int, labels: np.ndarray, l2: float = 0.02, rounds: int = 300):
    """Logistic regression on soft labels: weights of ``n`` features, and the bias."""
    which = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)]) if rows else np.empty(0, int)
    feature = np.concatenate(rows) if rows else np.empty(0, int)
    which, feature = which.astype(np.int64), feature.astype(np.int64)
    w, bias = np.zeros(n), -2.0
    m_w, v_w, m_b, v_b = np.zeros(n), np.zeros(n), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = bias + np.bincount(which, weights=w[feature], minlength=len(rows))
        err = (1 / (1 + np.exp(-z)) - labels) / max(len(rows), 1)
        g = np.bincount(feature, weights=err[which], minlength=n) + l2 * w / max(len(rows), 1)
        gb = err.sum()
        m_w, v_w = 0.9 * m_w + 0.1 * g, 0.999 * v_w + 0.001 * g * g
        m_b, v_b = 0.9 * m_b + 0.1 * gb, 0.999 * v_b + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= 0.1 * fix * m_w / (np.sqrt(v_w) + 1e-8)
        bias -= 0.1 * fix * m_b / (np.sqrt(v_b) + 1e-8)
    return w, float(bias)


@dataclass
class Scorer:
    codes: np.ndarray
    weights: np.ndarray
    bias: float
    label_model: LabelModel | None = None


def labelled_ids(labels: DataFrame, rows: int) -> DataFrame:
    """(id, toxic) of at most ``rows`` labelled documents that are not held out."""
    given = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    given = given.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    return given.where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(rows)


def labelled_sample(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(toxic, text) of the labelled documents ``ids``, a row per id; of several texts one picked by its fingerprint."""
    few = F.broadcast(ids)  # at most ``sample_rows`` rows of two numbers
    text = F.col("text").cast("string")
    row = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_tag(text).alias("tag"), text.alias("text"))
    found = row.join(few, F.col("doc_id") == F.col("id")).groupBy("doc_id")
    # Repeated rows are put together where they are read, so what moves is a text per id and task.
    return found.agg(F.first("toxic").alias("toxic"), F.min_by("text", F.struct("tag", "text")).alias("text")).select("toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES) -> Scorer:
    """Learn a scorer from the labelled rows that are not held out."""
    ready(docs.sparkSession)
    ids = labelled_ids(labels, sample_rows)
    share = min(max(ids.agg(F.avg("toxic")).first()[0] or 0.0, 1e-3), 0.5)
    sample = labelled_sample(docs, ids)
    counts = sample.mapInArrow(_counts, "code long, bad long, good long").groupBy("code")
    counts = counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    # More often toxic than chance gives: by four standard deviations, and mostly.
    n = F.col("bad") + F.col("good")
    chance = n * share + 4 * F.sqrt(n * (share * (1 - share)))
    counts = counts.where((F.col("bad") >= 3) & (F.col("bad") > 2 * F.col("good")) & (F.col("bad") > chance))
    best = counts.orderBy(F.desc(F.col("bad") - 2 * F.col("good")), "code").limit(max_features).collect()
    shown = np.array([r["code"] for r in best], dtype=np.int64).view(U)
    lexicons = lexicon_codes()
    vocabulary = Vocabulary(np.concatenate([shown, *lexicons]))
    given = sample.select("text").mapInArrow(_shown(vocabulary.codes), "n_words int, found array<int>").toPandas()
    rows = [np.asarray(r, dtype=np.int64) for r in given["found"]]
    if not rows:
        return Scorer(vocabulary.codes, np.where(np.isin(vocabulary.codes, np.concatenate(lexicons)), 2.0, 0.0), -3.0)
    votes = _votes(vocabulary.codes, shown, lexicons, rows, given["n_words"].to_numpy())
    pattern, which, count = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = fit_label_model(pattern, count.astype(float))
    labels_ = model.posterior(pattern)[which.ravel()]
    weights, bias = fit_linear(rows, len(vocabulary.codes), labels_)
    return Scorer(vocabulary.codes, weights, bias, model)


def _votes(codes, shown, lexicons, rows, n_words) -> np.ndarray:
    """A row of votes per text: lexicons, learned lexicons, then the patterns."""
    groups = [np.isin(codes, some) for some in lexicons]
    learned = np.isin(codes, shown)
    part = sh.mix(codes) % U(LEARNED_GROUPS)
    groups += [learned & (part == U(g)) for g in range(LEARNED_GROUPS)]
    any_lexicon = np.isin(codes, np.concatenate([*lexicons, shown]))
    out = np.zeros((len(rows), len(groups) + 2), dtype=int)
    for i, r in enumerate(rows):
        out[i, : len(groups)] = [bool(g[r].any()) for g in groups]
        hits = int(any_lexicon[r].sum())
        out[i, len(groups)] = hits >= 2
        out[i, len(groups) + 1] = hits * FEW_WORDS >= max(int(n_words[i]), 1)
    return out


def score_of(scorer: Scorer):
    """A vectorised function of the text column: the score from 0 to 1."""
    codes, weights, bias = scorer.codes, scorer.weights, scorer.bias

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        vocabulary = Vocabulary(codes)
        data, offsets = sh.text_buffers(pa.Array.from_pandas(texts, type=pa.string()))
        out: list[float] = []
        for _, _, part, at in sh.chunks(data, offsets):
            found = vocabulary.of_texts(sh.words(part, at, letters=True), lowered(part))
            out += [bias + float(weights[k].sum()) for k in found]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, dtype=float), -30, 30))))

    return score


def score_documents(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    score = score_of(scorer)(docs["text"].cast("string"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), score.alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents scored at the threshold or above; all columns stay."""
    return docs.where(score_of(scorer)(docs["text"].cast("string")) < threshold)
