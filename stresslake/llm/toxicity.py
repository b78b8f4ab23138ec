"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Only confirmed toxic documents are labels; everything else in the training split is
unlabelled text. With the class prior p, losses l+ and l- and the positive (P) and
unlabelled (U) samples, a classifier g minimises (Kiryo et al., 2017)

    p * mean_P l+(g)  +  max(0, mean_U l-(g) - p * mean_P l-(g)).

When the second term goes negative, the step reverses it instead, which keeps the
classifier from memorising the positives. Features are the distinct words of a text
and their first letters (four to six), which covers inflected forms.

The fit is bounded: at most ``MAX_POSITIVE`` toxic and ``MAX_UNLABELLED`` unlabelled
documents, drawn by a hash of the id, and ``MAX_FEATURES`` features. Scoring reads
every whole text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.llm.common import held_out, materialize, read, smallest_hashes
from stresslake.llm.near_copies import shingle_set

MAX_POSITIVE = 2_000
MAX_UNLABELLED = 6_000
MAX_CANDIDATES = 30_000
MAX_FEATURES = 1_500
# A feature stands in this many toxic texts at least, and one more for each 200 of them.
MIN_DOCUMENTS = 3
# Log-likelihood ratio against equal frequency in both samples.
MIN_EVIDENCE = 8.0
# The more features are tried, the more stand out by chance: a share of ln(candidates).
EVIDENCE_PER_LOG = 1.2
STEMS = (4, 5, 6)
CLASSIFIERS = 3
STEPS = 200
LEARNING_RATE = 0.1
SHRINK = 1e-3
THRESHOLD = 0.3
# Values of the sketch that tells near copies in the sample, and the share that must agree.
SKETCH, SAME = 64, 0.8
# Prior if no labels tell it.
DEFAULT_PRIOR = 0.1

_WORD = re.compile(r"[^\W\d_]+")
# The same characters, for Spark.
HAS_WORD = r"[\p{L}\p{Nl}\p{No}]"


def features(text: str | None) -> set[str]:
    """Distinct words of the whole text in lower case, and their stems with a mark."""
    words = set(_WORD.findall(text.lower())) if text else set()
    out = {f"{w}$" for w in words if len(w) > 2}
    for n in STEMS:
        out.update(w[:n] for w in words if len(w) >= n)
    return out


@dataclass(frozen=True)
class ToxicityModel:
    """Weights per feature and a bias for each classifier of the ensemble."""

    vocabulary: dict[str, int]
    weights: np.ndarray  # classifiers x features
    bias: np.ndarray

    def score(self, text: str | None) -> float:
        """Mean probability over the classifiers."""
        at = [self.vocabulary[f] for f in features(text) if f in self.vocabulary]
        margin = self.bias + self.weights[:, at].sum(1)
        return float(_sigmoid(margin).mean())


def nnpu_risk(x_pos: np.ndarray, x_unl: np.ndarray, w: np.ndarray, prior: float):
    """Risk of the positives and of the negatives under sigmoid loss, and their slopes.

    The loss is bounded, l+(g) = sigmoid(-g) and l-(g) = sigmoid(g), so no single
    document can dominate the risk. The risk of the negatives is that of all unlabelled
    rows less that of the positives they hold.
    """
    s_pos, s_unl = _sigmoid(x_pos @ w), _sigmoid(x_unl @ w)
    slope_pos = x_pos.T @ (s_pos * (1 - s_pos) / len(s_pos)).astype(x_pos.dtype)
    slope_unl = x_unl.T @ (s_unl * (1 - s_unl) / len(s_unl)).astype(x_unl.dtype)
    positive = prior * (1 - s_pos).mean()
    negative = s_unl.mean() - prior * s_pos.mean()
    return positive, negative, -prior * slope_pos, slope_unl - prior * slope_pos


def fit_nnpu(x_pos: np.ndarray, x_unl: np.ndarray, prior: float, seed: int, steps: int = STEPS):
    """One linear classifier by full-batch Adam on the nnPU risk.

    A soft threshold on the weights drops features that do not help.
    """
    rng = np.random.default_rng(seed)
    # A bootstrap of the unlabelled sample makes the classifiers differ.
    x_unl = x_unl[rng.integers(0, len(x_unl), len(x_unl))]
    x_pos = np.hstack([x_pos, np.ones((len(x_pos), 1), np.float32)])
    x_unl = np.hstack([x_unl, np.ones((len(x_unl), 1), np.float32)])
    d = x_pos.shape[1]
    w = np.zeros(d, np.float32)
    w[-1] = -1
    shrink = np.full(d, LEARNING_RATE * SHRINK, np.float32)
    shrink[-1] = 0
    m, v = np.zeros(d), np.zeros(d)
    for step in range(1, steps + 1):
        _, negative, d_positive, d_negative = nnpu_risk(x_pos, x_unl, w, prior)
        grad = d_positive + d_negative if negative >= 0 else -d_negative
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w = w - LEARNING_RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        w = (np.sign(w) * np.maximum(np.abs(w) - shrink, 0)).astype(np.float32)
    return w[:-1].astype(float), float(w[-1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


_ORDERS = np.random.default_rng(7).integers(0, 1 << 62, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sketch(text: str) -> list[int]:
    """Least shingle hash under each order; the share that agrees estimates the Jaccard
    similarity of two texts."""
    hashes = shingle_set(text, 3)
    if not len(hashes):
        return [0] * SKETCH
    # High bits of odd multiples: each order is its own shuffle of the hashes.
    return [int((hashes * k).min() >> np.uint64(1)) for k in _ORDERS]


def fold_copies(sketches: np.ndarray) -> np.ndarray:
    """Rows that stay: of rows that agree in ``SAME`` of their sketch with one that stays,
    only that one. Bounded like the sample.

    Rows that agree in so many places agree in a whole band, so only those are compared.
    """
    # More bands than places that may differ.
    bands = int(SKETCH * (1 - SAME)) + 1
    edges = np.linspace(0, SKETCH, bands + 1).astype(int)
    kept: list[int] = []
    held: dict[tuple[int, bytes], list[int]] = {}
    for i, row in enumerate(sketches):
        keys = [(k, row[a:b].tobytes()) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
        near = sorted({j for key in keys for j in held.get(key, ())})
        if near and (sketches[near] == row).mean(1).max() >= SAME:
            continue
        kept.append(i)
        for key in keys:
            held.setdefault(key, []).append(i)
    return np.array(kept, int)


def _lowest(ids: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` distinct ids, chosen by a hash that does not follow their order."""
    hashed = ids.where("id IS NOT NULL").select("id", F.xxhash64("id").alias("h"))
    return smallest_hashes(hashed.distinct(), "h", bound, hashed.count()).select("id")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of a bounded set of ids, one of near copies.

    Copies of one text would make its rare words look typical of the class.
    """

    @F.arrow_udf("array<long>")
    def sketch(texts: pa.Array) -> pa.Array:
        return pa.array([_sketch(t.as_py()) for t in texts], pa.list_(pa.int64()))

    found = docs.join(F.broadcast(ids), docs["doc_id"] == ids["id"], "left_semi")
    found = found.select("text").where("text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    found = materialize(found.dropDuplicates(["h"]).withColumn("s", sketch("text")))
    # One small row per text of a bounded sample.
    rows = found.select("h", "s").orderBy("h").collect()
    if not rows:
        return found.select("text")
    kept = fold_copies(np.array([r["s"] for r in rows], np.int64))
    ids = found.sparkSession.createDataFrame([(rows[i]["h"],) for i in kept], "h long")
    return found.join(F.broadcast(ids), "h", "left_semi").select("text")


def _feature_lists(texts: DataFrame) -> DataFrame:
    @F.arrow_udf("array<string>")
    def extract(column: pa.Array) -> pa.Array:
        return pa.array([sorted(features(t.as_py())) for t in column], pa.list_(pa.string()))

    return texts.select(extract("text").alias("features"))


def _listed(texts: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``at``: numbers of the features that each text has."""

    @F.arrow_udf("array<int>")
    def index(column: pa.Array) -> pa.Array:
        return pa.array([
            sorted(vocabulary[f] for f in features(t.as_py()) if f in vocabulary) for t in column
        ], pa.list_(pa.int32()))

    return texts.select(index("text").alias("at"))


def _matrix(texts: DataFrame, vocabulary: dict[str, int]) -> np.ndarray:
    """Presence of each feature per document; documents and features are both bounded."""
    rows = _listed(texts, vocabulary).collect()
    out = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, r in enumerate(rows):
        out[i, r["at"]] = 1
    return out


def train(
    docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES,
) -> ToxicityModel | None:
    """Fit on rows that are not held out; ``None`` without any confirmed toxic text.

    A document counts as toxic if any of its label rows says so. Other labels only
    give the class prior; their documents are unlabelled text like the rest.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    )
    counts = known.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("long"))).head()
    if not counts[1]:
        return None
    prior = min(0.9, max(0.001, counts[1] / counts[0])) if counts[0] > counts[1] else DEFAULT_PRIOR
    toxic = known.where("toxic = 1").select("id")
    learnable = docs.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"))
    positive_ids = materialize(_lowest(toxic.join(learnable, "id", "left_semi"), max_positive))
    unlabelled_ids = materialize(_lowest(learnable.join(toxic, "id", "left_anti"), max_unlabelled))
    positive = materialize(_texts(docs, positive_ids))
    unlabelled = materialize(_texts(docs, unlabelled_ids))

    n_pos, n_unl = positive.count(), unlabelled.count()
    if not n_pos or not n_unl:
        return None
    least = MIN_DOCUMENTS + n_pos // 200
    candidates = (
        _feature_lists(positive).select(F.explode("features").alias("f")).groupBy("f").count()
        .where(F.col("count") >= least).orderBy(F.desc("count"), "f").limit(MAX_CANDIDATES).collect()
    )
    if not candidates:
        return None
    vocabulary = {r["f"]: i for i, r in enumerate(candidates)}
    in_pos = np.array([r["count"] for r in candidates], float)
    in_unl = np.zeros(len(candidates))
    listed = _listed(unlabelled, vocabulary).select(F.explode("at").alias("f"))
    for r in listed.groupBy("f").count().collect():
        in_unl[r["f"]] = r["count"]
    p, q = (in_pos + 0.5) / (n_pos + 1), (in_unl + 0.5) / (n_unl + 1)
    # U holds toxic texts too, so a mark of toxicity is at most 1 / prior times as
    # frequent in P. Features must be frequent enough to tell that from chance.
    evidence = 2 * (in_pos * np.log(p / q) - n_pos * (p - q))
    least_evidence = max(MIN_EVIDENCE, EVIDENCE_PER_LOG * np.log(len(candidates)))
    order = np.argsort(-evidence, kind="stable")
    chosen = [i for i in order if p[i] > 3 * q[i] and evidence[i] > least_evidence][:max_features]
    if not chosen:
        return None
    names = {candidates[i]["f"]: k for k, i in enumerate(chosen)}
    # Frequent features get larger values, so the fit leans on them first.
    scale = np.sqrt(p[chosen] / p[chosen].max()).astype(np.float32)
    x_pos, x_unl = _matrix(positive, names) * scale, _matrix(unlabelled, names) * scale
    fits = [fit_nnpu(x_pos, x_unl, prior, seed) for seed in range(CLASSIFIERS)]
    weights = np.array([w for w, _ in fits]) * scale
    return ToxicityModel(names, weights, np.array([b for _, b in fits]))


def score_column(model: ToxicityModel | None, text: Column) -> Column:
    """Score of each whole text, 0 to 1; NULL and empty texts get the bias alone.

    Without a model (no confirmed toxic text) every score is 0.
    """
    if model is None:
        return F.lit(0.0)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return score(text)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        score_column(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents whose score stays under the threshold, with the columns of ``docs``.

    NULL texts and texts without a word carry no mark of toxicity and stay.
    """
    model = train(docs.select("doc_id", "text"), labels)
    # Their score is the learned bias alone, which may lie over the threshold.
    wordless = F.col("text").isNull() | ~F.col("text").rlike(HAS_WORD)
    return docs.where(wordless | (score_column(model, F.col("text")) < threshold))
