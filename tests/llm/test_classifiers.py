"""Held-out accuracy of the learned operators, and rows of unusual kinds."""

import random
import zlib

import numpy as np
import pytest

from shelfcast.llm import language_id, quality_classifier, toxicity

KEPT_BACK = {"toxic": (4, 2), "quality": (3, 1), "lang": (4, 2)}


def back(doc_id, parts, part):
    return zlib.crc32(str(doc_id).encode()) % parts == part


@pytest.fixture(scope="module")
def corpus(spark):
    """Made-up prose in two languages; toxic sentences, shouting and symbols in some."""
    rng = random.Random(11)
    words = {"xa": [f"{a}{b}" for a in ("kel", "mor", "tin", "sa") for b in ("an", "eth", "ir", "o")],
             "yb": [f"{a}{b}" for a in ("zhu", "wei", "qi", "pao") for b in ("gu", "ny", "x", "ba")]}
    docs, labels = [], []
    for i in range(900):
        lang = rng.choice(["xa", "yb"])
        sentences = [" ".join(rng.choices(words[lang], k=8)).capitalize() + "." for _ in range(rng.randrange(2, 12))]
        toxic, bad = i % 5 == 0, i % 7 == 0
        if toxic:
            sentences.insert(rng.randrange(len(sentences)), f"You {rng.choice(['grub', 'grubling', 'swine'])} {words[lang][0]}.")
        text = " ".join(sentences)
        if bad:
            text = " ".join(w + "###" for w in text.split())
        docs.append((i, text, lang if i % 3 else None))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(None, None, None), (5000, "", None), (5001, "12 34 !", "xa"), (5001, "12 34 !", "xa"),
             (5002, "kelan moreth. " * 20_000, None)]
    labels += [(None, 1, 1), (7, None, None), (9999, 1, 0)]
    schema = "doc_id long, quality int, toxic int"
    frame = spark.createDataFrame([(*d, 0.5, "x", 3) for d in docs],
                                  "doc_id long, text string, lang string, score double, x string, predicted int")
    return frame, spark.createDataFrame(labels, schema), dict((d[0], d) for d in docs), labels


def test_toxicity(corpus):
    docs, labels, by_id, known = corpus
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 905
    truth = {d: t for d, _, t in known}
    held = [r for r in rows if r.held_out and r.doc_id in truth and r.doc_id < 900]
    assert len(held) > 150 and all(r.held_out == back(r.doc_id, 4, 2) for r in rows if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    for r in held:
        if r.predicted and truth[r.doc_id] and "###" not in r.text:
            told = [r.text[s.start:s.end] for s in r.offending]
            assert any("grub" in t or "swine" in t for t in told)
    scores = {r.score for r in rows if not r.text}
    assert len(scores) == 1 and max(scores) < 0.1
    long = [r.predicted for r in rows if r.doc_id == 5002]
    assert long == [0]


def test_gradient_of_the_noisy_or():
    """More evidence, higher score; a document is as toxic as the least clean way through it."""
    rows = [(1, 1.0, [[0]]), (0, 1.0, [[1]]), (1, 1.0, [[0, 1], [1]]), (0, 1.0, [])] * 20
    weights, bias, leak = toxicity.train(rows, 2, toxicity.Settings())
    assert weights[0] > 2 and weights[1] < 1 and bias < -2 and leak < -3


def test_language(corpus):
    docs, _, by_id, _ = corpus
    rows = language_id.language_id(docs).collect()
    assert len(rows) == 905
    held = [r for r in rows if r.held_out and r.doc_id is not None and by_id[r.doc_id][2] and r.doc_id < 900]
    assert np.mean([r.lang_pred == r.lang for r in held]) == 1.0
    assert {r.lang_pred for r in rows if not language_id.has_letter(r.text)} == {"und"}
    assert {0 <= r.score <= 1 for r in rows} == {True}


def test_filters_find_what_was_added():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2**63, 4000).astype(np.uint64)
    owner = np.arange(4000) % 70
    filters = language_id.Filters([f"l{i:02d}" for i in range(70)], 1 << 16, 3)
    filters.add(codes, owner)
    filters.seal()
    places = filters.places(codes)
    for part in (0, 1):
        masks = filters.masks[part]
        found = masks[places[0]] & masks[places[1]] & masks[places[2]]
        own = owner // 64 == part
        assert np.all(found[own] >> (owner[own] % 64).astype(np.uint64) & np.uint64(1))
    assert 0 < filters.false_rate.max() < 0.001


def test_quality(corpus):
    docs, labels, _, known = corpus
    rows = quality_classifier.quality(docs, labels).collect()
    assert len(rows) == 905 and all(0 <= r.score <= 1 for r in rows)
    truth = {d: q for d, q, _ in known if d is not None and q is not None and d < 900}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == back(r.doc_id, 3, 1) for r in rows if r.doc_id is not None)
    assert len(held) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_cholesky_scores_match_densities():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(5, 3)), rng.normal(1, 2, size=(5, 3))
    covs = [np.diag([1.0, 2.0, 3.0]), np.array([[2.0, 0.3, 0], [0.3, 1.0, 0.1], [0, 0.1, 1.5]])]
    means = [np.zeros(3), np.ones(3)]
    lowers = [np.linalg.cholesky(c) for c in covs]
    offset = sum(s * np.log(np.diag(lo)).sum() for s, lo in zip((1, -1), lowers))
    model = quality_classifier.Model(tuple(means), tuple(np.linalg.inv(lo) for lo in lowers), offset)
    x = np.vstack([a, b])
    density = [
        -0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m) - 0.5 * np.linalg.slogdet(c)[1]
        for m, c in zip(means, covs)
    ]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(density[0] - density[1])))


def test_nothing_to_learn_from(corpus):
    docs, labels, _, _ = corpus
    none = labels.limit(0)
    few = docs.limit(5)
    assert {r.predicted for r in toxicity.toxicity(few, none).collect()} == {0}
    assert {r.score for r in quality_classifier.quality(few, none).collect()} == {0.5}
    assert {r.lang_pred for r in language_id.language_id(few.filter("lang IS NULL")).collect()} == {"und"}
    for empty in (toxicity.toxicity(docs.limit(0), labels), quality_classifier.quality(docs.limit(0), labels),
                  language_id.language_id(docs.limit(0))):
        assert empty.collect() == []
