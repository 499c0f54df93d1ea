"""Toxicity by multiple-instance learning: sentence scores under a noisy-or, from document labels."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.shared import held_out, map_texts, stored

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled documents learned from, about so many of each label."""

    sample: int = 4000
    features: int = 2000
    least_z: float = 3.0
    prefix: int = 5
    steps: int = 300
    rate: float = 0.1
    ridge: float = 1e-4
    threshold: float = 0.3


def features(text: str, prefix: int) -> set[str]:
    """The distinct words, and ``^`` with the first letters of the longer ones."""
    words = set(WORD.findall(text.lower()))
    return words | {"^" + w[:prefix] for w in words if len(w) > prefix}


def sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, label, weight, text of about ``most`` labelled documents of each label.

    Which ones is up to a hash of the id. The weight of a label makes up for its share. A document
    with several labels takes the largest, and one with several rows one of them.
    """
    spark = docs.sparkSession
    known = (
        labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    kept = {k: min(1.0, most / n) for k, n in counts.items()}
    if not kept:
        return spark.createDataFrame([], "doc_id long, label int, weight double, text string")
    pairs = [v for k, share in kept.items() for v in (F.lit(k), F.lit(share))]
    share = F.create_map(*pairs)[F.col("label")]
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    chosen = known.filter(unit < share).select("doc_id", "label", (1 / share).alias("weight"))
    # About 2 * most ids at any size of the corpus.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(
        F.max("label").alias("label"), F.max("weight").alias("weight"),
        F.max("text").alias("text"),
    )


def vocabulary(learned: DataFrame, settings: Settings) -> list[str]:
    """The features that mark positive documents most clearly, by the z-score of their rates."""
    def run(batches):
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                seen[label].update(features(text or "", settings.prefix))
        words = sorted(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([seen[0][w] for w in words], pa.int64()),
             pa.array([seen[1][w] for w in words], pa.int64())],
            names=["word", "n0", "n1"],
        )

    counts = learned.select("text", "label").mapInArrow(run, "word string, n0 long, n1 long")
    sizes = learned.agg(
        F.count(F.when(F.col("label") == 0, 1)), F.count(F.when(F.col("label") == 1, 1))
    ).first()
    all0, all1 = max(sizes[0], 1), max(sizes[1], 1)
    rate = (F.col("n0") + F.col("n1") + 1) / float(all0 + all1 + 2)
    spread = F.sqrt(rate * (1 - rate) * (1 / all0 + 1 / all1))
    z = (F.col("n1") / all1 - F.col("n0") / all0) / spread
    best = (
        counts.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .withColumn("z", z).filter(F.col("z") >= settings.least_z).orderBy(F.desc("z"), "word").limit(settings.features)
    )
    return [r.word for r in best.collect()]


def sentence_ids(text: str, index: dict[str, int], prefix: int) -> list[list[int]]:
    """Feature ids of every sentence that has any."""
    if not index.keys() & features(text, prefix):
        return []
    found = [index.keys() & features(m[0], prefix) for m in SENTENCE.finditer(text)]
    return [sorted(index[f] for f in known) for known in found if known]


def softplus(z):
    return np.logaddexp(0.0, z)


def train(rows: list[tuple[int, float, list[list[int]]]], n: int, settings: Settings):
    """Weights (none negative), bias and leak that maximise the likelihood of the document labels.

    A sentence with features is toxic with probability sigmoid(bias + weights), any other is not. A
    document is toxic unless all its sentences are not and the leak, which stands for what no
    feature shows, is closed: so clean sentences add nothing, however many there are. ``rows`` are
    (label, weight, feature ids by sentence).
    """
    y = np.array([r[0] > 0 for r in rows], float)
    weight = np.array([r[1] for r in rows], float)
    weight = weight / max(weight.sum(), 1e-9)
    sentences = [(d, ids) for d, r in enumerate(rows) for ids in r[2]]
    doc = np.array([d for d, _ in sentences], np.int64)
    one = np.repeat(np.arange(len(sentences)), [len(ids) for _, ids in sentences])
    feature = np.array([i for _, ids in sentences for i in ids], np.int64)
    theta = np.zeros(n + 2)
    theta[n:] = -4.0
    mean, square = np.zeros(n + 2), np.zeros(n + 2)
    for step in range(1, settings.steps + 1):
        w, bias, leak = theta[:n], theta[n], theta[n + 1]
        z = bias + np.bincount(one, w[feature], len(sentences))
        s = np.maximum(np.bincount(doc, softplus(z), len(rows)) + softplus(leak), 1e-9)
        slope = weight * ((1 - y) - y / np.expm1(np.minimum(s, 50.0)))
        dz = slope[doc] / (1 + np.exp(-z))
        grad = np.empty(n + 2)
        grad[:n] = np.bincount(feature, dz[one], n) + settings.ridge * w
        grad[n] = dz.sum()
        grad[n + 1] = slope.sum() / (1 + np.exp(-leak))
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        theta -= settings.rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-9
        )
        theta[:n] = np.maximum(theta[:n], 0.0)
    return theta[:n], float(theta[n]), float(theta[n + 1])


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    leak: float
    prefix: int

    def sentences(self, text: str) -> tuple[list[tuple[int, int, float]], float]:
        """(start, end, log-odds) of the sentences with known features, and the noisy-or."""
        weights, spans = self.weights, []
        total = float(softplus(self.leak))
        if weights.keys() & features(text, self.prefix):
            for m in SENTENCE.finditer(text):
                found = weights.keys() & features(m[0], self.prefix)
                if found:
                    z = self.bias + sum(weights[f] for f in sorted(found))
                    spans.append((m.start(), m.end(), z))
                    total += float(softplus(z))
        return spans, -float(np.expm1(-total))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from ``labels`` (doc_id, label: 0 or 1) and the texts of ``docs``.

    Without labelled documents of both kinds no feature is known and every score is near zero. What
    reaches the driver is bounded by the sample: its sentences as ids of the chosen features.
    """
    learned = stored(sample(docs, labels, settings.sample), "toxic-sample")
    words = vocabulary(learned, settings)
    index = {w: i for i, w in enumerate(words)}

    def start():
        return lambda texts: [(sentence_ids(t or "", index, settings.prefix),) for t in texts]

    fields = [T.StructField("sentences", T.ArrayType(T.ArrayType(T.IntegerType())))]
    rows = map_texts(learned, start, fields).select("label", "weight", "sentences", "doc_id")
    data = [tuple(r)[:3] for r in sorted(rows.collect(), key=lambda r: r.doc_id)]
    if not words:
        return Model({}, -12.0, -12.0, settings.prefix)
    weights, bias, leak = train(data, len(words), settings)
    known = {w: float(x) for w, x in zip(words, weights) if x > 0}
    return Model(known, bias, leak, settings.prefix)


def score(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """Adds score, predicted and offending to the columns of ``docs``.

    ``offending`` are the sentences (start, end in code points, score) that reach the threshold by
    themselves. NULL and empty texts have the score of a text without any known feature. Columns of these names are replaced; repeated rows
    score alike, and an empty table gives no rows.
    """
    sentence = T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ])
    fields = [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("offending", T.ArrayType(sentence)),
    ]

    def start():
        def one(text):
            spans, p = model.sentences(text or "")
            p = round(min(max(p, 0.0), 1.0), 6)
            sure = [(a, b, float(1 / (1 + np.exp(-z)))) for a, b, z in spans]
            return p, int(p >= threshold), [s for s in sure if s[2] >= threshold]

        return lambda texts: [one(t) for t in texts]

    return map_texts(docs, start, fields)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learns from the labels outside the fourth kept back (crc32 of the id) and scores all of ``docs``."""
    known = labels.select("doc_id", F.col("toxic").alias("label"))
    model = fit(docs, known.filter(~held_out(F.col("doc_id"), 4, 2)), settings)
    apart = docs.withColumn("held_out", held_out(F.col("doc_id"), 4, 2))
    return score(apart, model, settings.threshold)
