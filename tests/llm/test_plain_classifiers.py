"""The learned queries next to plain Python on the same tables: sentences, sets of strings, densities."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import language_id, queries, toxicity

SF = "/root/testdata/sf0.01"


def back(doc_id, parts, part):
    return zlib.crc32(str(doc_id).encode()) % parts == part


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").collect()


def label_of(labels, column, parts, part):
    known = defaultdict(int)
    for r in labels:
        if r[column] is not None and r.doc_id is not None and not back(r.doc_id, parts, part):
            known[r.doc_id] = max(known[r.doc_id], int(r[column] > 0))
    return known


# ---- op5 --------------------------------------------------------------------------------------


def plain_features(text, prefix):
    words = {w for w in re.split(r"[\W\d_]+", text.lower()) if w}
    return words | {"^" + w[:prefix] for w in words if len(w) > prefix}


@pytest.fixture(scope="module")
def toxic_model(spark, labels):
    known = [(d, y) for d, y in label_of(labels, "toxic", 4, 2).items()]
    frame = spark.createDataFrame(known, "doc_id long, label int")
    return toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), frame)


def test_toxic_features_are_those_of_plain_counts(docs, labels, toxic_model):
    """The bound of the sample is above this table, so that all labelled documents are learned from."""
    settings, known = toxicity.Settings(), label_of(labels, "toxic", 4, 2)
    texts = {r.doc_id: r.text or "" for r in docs if r.doc_id in known}
    size = Counter(known[d] for d in texts)
    assert max(size.values()) <= settings.sample and size[1] > 10
    seen = {0: Counter(), 1: Counter()}
    for d, text in texts.items():
        seen[known[d]].update(plain_features(text, settings.prefix))
    z = {}
    for w in seen[0].keys() | seen[1].keys():
        rate = (seen[0][w] + seen[1][w] + 1) / (size[0] + size[1] + 2)
        spread = math.sqrt(rate * (1 - rate) * (1 / size[0] + 1 / size[1]))
        z[w] = (seen[1][w] / size[1] - seen[0][w] / size[0]) / spread
    clear = sorted((w for w in z if z[w] >= settings.least_z), key=lambda w: (-z[w], w))
    assert toxic_model.weights and toxic_model.weights.keys() <= set(clear[: settings.features])


def test_toxic_scores_are_a_noisy_or_over_sentences(spark, docs, toxic_model):
    """One minus the chance that neither the leak nor any sentence with a known feature is toxic."""
    said = {r.doc_id: r.text or "" for r in docs}
    got = queries.op5_toxicity(spark, SF).collect()
    assert len(got) == len(docs)
    weights, odds = toxic_model.weights, lambda z: 1 / (1 + math.exp(-z))
    for r in got:
        clean, guilty, at = 1 - odds(toxic_model.leak), [], 0
        for part in re.split(r"([.!?\n])", said[r.doc_id]):
            known = plain_features(part, toxic_model.prefix) & weights.keys()
            if known:
                p = odds(toxic_model.bias + sum(weights[w] for w in known))
                clean *= 1 - p
                if p >= 0.3:
                    guilty.append((at, at + len(part)))
            at += len(part)
        assert r.score == pytest.approx(1 - clean, abs=2e-6)
        assert r.predicted == int(r.score >= 0.3) and r.held_out == back(r.doc_id, 4, 2)
        assert [(s.start, s.end) for s in r.offending] == guilty
    assert any(r.offending for r in got)


def test_held_out_labels_change_no_score(spark):
    whole = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    apart = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = marks.withColumn("toxic", F.when(apart, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert turned.exceptAll(marks).count() > 0
    one, other = [
        sorted((r.doc_id, r.score) for r in toxicity.toxicity(whole, m).collect()) for m in (marks, turned)
    ]
    assert one == other


# ---- op8 --------------------------------------------------------------------------------------


def plain_grams(text):
    for word in re.split(r"[\W\d_]+", text.lower()):
        if word:
            line = f"\0{word}\0"
            for n in language_id.SIZES:
                yield from (line[i:i + n] for i in range(len(line) - n + 1))


def test_languages_by_exact_sets_of_grams(spark, docs):
    """Each language's n-grams as a set of strings; the filter's count may differ by false hits alone.

    An n-gram of two that spans two words holds one mark only, so words can be cut apart here.
    """
    settings = language_id.Settings()
    counts = defaultdict(Counter)
    for r in docs:
        if r.lang is not None and not back(r.doc_id, 4, 2):
            counts[r.lang].update(plain_grams(r.text or ""))
    assert all(n <= settings.sample for n in Counter(r.lang for r in docs).values())
    rates = {c: {g: n / counts[c].total() for g, n in counts[c].items()} for c in counts}
    best = defaultdict(float)
    for c in rates:
        for g, rate in rates[c].items():
            best[g] = max(best[g], rate)
    sets, loose = {}, {}
    for c, seen in counts.items():
        fit = {g: n for g, n in seen.items()
               if n >= settings.least and rates[c][g] >= settings.share * best[g]}
        # Which of the n-grams as frequent as the last one get in is up to their hash.
        last = min(sorted(fit.values(), reverse=True)[: settings.grams])
        sets[c] = {g for g, n in fit.items() if n > last}
        loose[c] = {g for g, n in fit.items() if n >= last}
    got = queries.op8_language_id(spark, SF).collect()
    said, sure = {r.doc_id: r.text for r in docs}, 0
    assert len(got) == len(docs) and len(sets) > 2
    for r in got:
        text = said[r.doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        grams = Counter(plain_grams(text))
        least = {c: sum(n for g, n in grams.items() if g in sets[c]) for c in sets}
        most = {c: sum(n for g, n in grams.items() if g in loose[c]) for c in sets}
        slack = 2 + 0.02 * grams.total()
        lead = sorted(least, key=lambda c: (-most[c], c))
        if least[lead[0]] > most[lead[1]] + slack:
            sure += 1
            assert r.lang_pred == lead[0]
            low = (least[lead[0]] - slack) / (sum(most.values()) + len(sets) * slack)
            high = (most[lead[0]] + slack) / max(sum(least.values()) - len(sets) * slack, 1)
            assert low - 1e-6 <= r.score <= high + 1e-6
    assert sure > 0.9 * len(docs)


# ---- op9 --------------------------------------------------------------------------------------

SPACE = " \t\x0b\x0c\r"


def plain_statistics(text):
    words = [w for w in re.split(r"[ \t-\r]", text) if w]
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    n, chars, rows = max(len(words), 1), max(len(text), 1), max(len(lines), 1)
    share = lambda chosen: math.sqrt(sum(c in chosen for c in text) / chars)
    return [
        math.log1p(len(words)),
        math.log1p(sum(map(len, words)) / n),
        math.log1p(len(words) / rows),
        math.sqrt(len(set(words)) / n),
        math.sqrt((len(lines) - len(set(lines))) / rows),
        math.sqrt(sum(len(w) <= 3 for w in words) / n),
        share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("0123456789"), share("#*$%&|<>"),
        share("!?"), share(".,;:"), share("|"),
        math.sqrt((len(text.encode()) - len(text)) / chars),
    ]


def test_quality_by_plain_densities(spark, docs, labels):
    """Class means and covariances by numpy, log densities by inverse and determinant, then Bayes."""
    known = label_of(labels, "quality", 3, 1)
    x = {r.doc_id: plain_statistics(r.text or "") for r in docs}
    groups = [np.array([x[d] for d in sorted(x) if known.get(d) == y]) for y in (0, 1)]
    assert min(map(len, groups)) > 20
    sizes = [len(g) for g in groups]
    covs = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(n * c for n, c in zip(sizes, covs)) / sum(sizes)
    density = []
    for g, cov in zip(groups, covs):
        cov = 0.8 * cov + 0.2 * pooled
        cov = 0.95 * cov + 0.05 * np.diag(np.maximum(np.diag(pooled), 1e-6))
        inverse, log_det = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
        centre = g.mean(axis=0)
        density.append(
            lambda v, c=centre, i=inverse, s=log_det, n=len(g):
            math.log(n) - 0.5 * (s + (v - c) @ i @ (v - c))
        )
    got = queries.op9_quality_classifier(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        v = np.array(x[r.doc_id])
        gap = min(max(density[1](v) - density[0](v), -30.0), 30.0)
        assert r.score == pytest.approx(1 / (1 + math.exp(-gap)), abs=1e-5)
        assert r.predicted == int(r.score >= 0.5) and r.held_out == back(r.doc_id, 3, 1)
