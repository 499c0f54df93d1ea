"""Near words against all pairs; op13 on the given tables is compared with SQL in test_llm_queries."""

import random

import pytest

from shelfcast.llm import spelling as S


def near(u, v):
    """Whether one insertion, deletion or replacement leads from one to the other."""
    if len(u) > len(v):
        u, v = v, u
    if u == v or len(v) - len(u) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def plain(words, ratio=10):
    out = {}
    for w, n in words.items():
        mates = [(-words[v], v) for v in words if near(w, v)]
        best = min(mates, default=(0, None))
        form = best[1] if mates and -best[0] >= ratio * n else None
        out[w] = (form, n, len(mates), -best[0] if form else None)
    rooted = {}
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        form, n, mates, form_n = out[w]
        rooted[w] = (form, root, n, mates, form_n)
    return rooted


def vocabulary(seed, n, alphabet, low, high):
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))) for _ in range(n)}
    return {w: rng.choice([1, 2, 3, 40, 500, 7_000]) for w in words}


def frame(spark, words):
    rows = [(w, n, 1, "x") for w, n in words.items()] or []
    return spark.createDataFrame(rows, "word string, n long, part int, best string").repartition(4)


def grouped(spark, words, **limits):
    return {r.word: tuple(r)[1:] for r in S.group_variants(frame(spark, words), **limits).collect()}


@pytest.mark.parametrize("part_chars", [S.PART_CHARS, 60, 1])
def test_against_all_pairs(spark, part_chars):
    words = vocabulary(1, 500, "abé", 1, 9)
    assert grouped(spark, words, part_chars=part_chars) == plain(words)
    pairs = [tuple(sorted(r)) for r in S.near_pairs(frame(spark, words), part_chars).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(u, v) for u in words for v in words if u < v and near(u, v)}


def test_runs_of_one_letter_and_the_empty_word(spark):
    words = {"a" * k: 10 ** (k % 7) for k in range(12)} | {"b": 3, "ab": 2, "ba": 5, "aab": 1, "ÿ": 90}
    assert grouped(spark, words) == plain(words)


def test_long_chain_of_forms(spark):
    words = {"letters" + "x" * k: 10 ** (2 * k) for k in range(9)}
    got = grouped(spark, words)
    assert got == plain(words) and {r[1] for r in got.values()} == {"letters" + "x" * 8}


def test_ties_go_to_the_first_in_code_point_order(spark):
    got = grouped(spark, {"variant": 1, "variantz": 10, "varianté": 10, "varianta": 10})
    assert got["variant"][0] == "varianta" and got["variant"][3] == 3


def test_very_long_words(spark):
    base = "".join(random.Random(4).choices("abcdefgh", k=100_000))
    words = {base: 50, base[:500] + base[501:]: 2, base[:-1]: 3, "x" + base: 4, base[:99_000] + "z" + base[99_001:]: 5}
    got = grouped(spark, words)
    assert {w: r[0] for w, r in got.items()} == {w: None if w == base else base for w in words}
    assert got[base][3] == 4


def test_nulls_and_no_words(spark):
    assert grouped(spark, {}) == {}
    one = frame(spark, {"alone": 3}).unionByName(frame(spark, {"alone": 3}).selectExpr("string(null) AS word", "n", "part", "best"))
    assert [tuple(r) for r in S.group_variants(one).collect()] == [("alone", None, "alone", 3, 0, None)]


def test_runs_of_letters(spark):
    docs = spark.createDataFrame(
        [(1, "Ab-c ÉÀÿ1x", "e"), (None, None, "e"), (2, "", "e"), (3, "q" * 200_000, "e")],
        "doc_id long, text string, run string",
    )
    got = sorted((r.doc_id, r.run) for r in S.runs(docs).collect())
    assert got == [(1, "ab"), (1, "c"), (1, "x"), (1, "ÉÀÿ"), (3, "q" * 200_000)]


def test_equal_right_languages_are_one_state():
    machine = S.Machine()
    begin = machine.accept(sorted(["tapped", "topped", "tipped"]))
    assert len(machine.arcs) == 7  # one way behind the vowels
    assert machine.accept(["tapped", "tipped", "topped"]) == begin
