"""Quality by a regularised quadratic discriminant on transformed document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.quality_rules import BLANKS, SYMBOLS, words
from shelfcast.llm.shared import SPACES, UPPER, held_out, stored

#: Log densities differ by this much at most, so that scores stay inside 0 to 1.
MOST = 30.0


@dataclass(frozen=True)
class Settings:
    """``pool`` draws a class covariance towards that of both, ``ridge`` towards its mean variance."""

    pool: float = 0.2
    ridge: float = 0.05
    threshold: float = 0.5


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x, the transformed statistics: logs of sizes, square roots of shares."""
    text = F.coalesce("text", F.lit(""))
    cut = docs.select(
        "doc_id", text.alias("text"), words(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
    )
    said = F.col("text")
    chars = F.greatest(F.length(said), F.lit(1))
    n_words = F.greatest(F.size("words"), F.lit(1))
    n_lines = F.greatest(F.size("lines"), F.lit(1))
    share = lambda part, whole: F.sqrt(part / whole)
    x = [
        F.log1p(F.size("words")),
        F.log1p(F.length(F.translate(said, SPACES, "")) / n_words),
        F.log1p(F.size("words") / n_lines),
        share(F.size(F.array_distinct("words")), n_words),
        share(F.size("lines") - F.size(F.array_distinct("lines")), n_lines),
        share(F.size(F.filter("words", lambda w: F.length(w) <= 3)), n_words),
        share(_removed(said, UPPER), chars),
        share(_removed(said, "0123456789"), chars),
        share(_removed(said, SYMBOLS), chars),
        share(_removed(said, "!?"), chars),
        share(_removed(said, ".,;:"), chars),
        share(_removed(said, "|"), chars),
        share(F.octet_length(said) - F.length(said), chars),
    ]
    return cut.select("doc_id", F.array(*[v.cast("double") for v in x]).alias("x"))


@dataclass(frozen=True)
class Model:
    """Per class (bad, good): mean, inverse Cholesky factor, and log of prior over density scale."""

    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    offset: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the good class, from the difference of the log densities."""
        gap = np.full(len(x), self.offset)
        if self.means is not None:
            for sign, mean, factor in zip((1, -1), self.means, self.factors):
                gap += sign * 0.5 * ((x - mean) @ factor.T).__pow__(2).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(gap, -MOST, MOST)))


def fit(stats: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from all labelled rows: counts, sums and products per class, added up by Spark.

    ``labels`` are doc_id and label (0 or 1); of several labels the largest holds. With one class
    only, or none, every score is near that class's number, or one half.
    """
    known = (
        labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    rows = stats.join(known, "doc_id")
    first = rows.first()
    if first is None:
        return Model(None, None, 0.0)
    d = len(first["x"])
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    x = [F.col("x")[i] for i in range(d)]
    sums = (
        rows.groupBy((F.col("label") > 0).alias("good"))
        .agg(
            F.count("*").alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p"),
        )
        .collect()
    )
    by = {r["good"]: r for r in sums}
    if len(by) < 2:
        return Model(None, None, MOST if True in by else -MOST)
    means, covs, sizes = [], [], []
    for good in (False, True):
        row = by[good]
        mean, cov = np.array(row["s"]) / row["n"], np.zeros((d, d))
        for (i, j), value in zip(pairs, row["p"]):
            cov[i, j] = cov[j, i] = value / row["n"] - mean[i] * mean[j]
        means.append(mean)
        covs.append(cov)
        sizes.append(row["n"])
    pooled = (sizes[0] * covs[0] + sizes[1] * covs[1]) / sum(sizes)
    factors, scales = [], []
    for cov in covs:
        mixed = (1 - settings.pool) * cov + settings.pool * pooled
        spread = np.maximum(np.diag(pooled), 1e-6)
        mixed = (1 - settings.ridge) * mixed + settings.ridge * np.diag(spread)
        lower = np.linalg.cholesky(mixed)
        factors.append(np.linalg.inv(lower))
        scales.append(np.log(np.diag(lower)).sum())
    offset = float(np.log(sizes[1] / sizes[0]) + scales[0] - scales[1])
    return Model(tuple(means), tuple(factors), offset)


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Learns from the labels outside the third kept back (crc32 of the id). NULL and empty texts have
    the statistics of a text without words. NULL ids are scored, not learned from. Repeated rows
    score alike; other columns are ignored, and an empty table gives no rows.
    """
    stats = stored(statistics(docs), "quality-statistics")
    known = labels.select("doc_id", F.col("quality").alias("label"))
    model = fit(stats, known.filter(~held_out(F.col("doc_id"), 3, 1)), settings)

    def run(batches):
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            n = batch.num_rows
            scores = np.round(model.score(flat.reshape(n, -1)), 6) if n else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= settings.threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    schema = T.StructType([
        stats.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    ])
    apart = stats.withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    return apart.select("doc_id", "held_out", "x").mapInArrow(run, schema)
