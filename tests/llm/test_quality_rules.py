"""Rules on words and shared lines; the measures are compared with SQL in test_llm_queries."""

import random

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import quality_rules as Q
from shelfcast.llm.quality_rules import Limits, quality_rules

COLUMNS = "doc_id long, text string, source string, n_words string, kept int"


def body(i, n=60):
    return " ".join(f"w{i}x{k}" for k in range(n))


def verdicts(spark, rows, limits=Limits(min_docs=3, depleted=0.8)):
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], COLUMNS)
    out = quality_rules(docs, limits)
    assert set(docs.columns) <= set(out.columns)
    return out.collect()


def test_shared_lines_go_but_the_first_keeps_them(spark):
    line = "Subscribe to our news letter"
    rows = [(i, f"{body(i)}\n  {line.upper() if i % 2 else line}\nend of {i}", "a") for i in range(6)]
    rows += [(9, f"{body(9)}\n{line}\nend", "b")]
    got = {r.doc_id: r for r in verdicts(spark, rows)}
    assert line in got[0].clean_text and got[0].removed_words == 0
    for i in range(1, 6):
        assert got[i].clean_text == f"{body(i)}\nend of {i}" and got[i].removed_words == 5
    assert got[9].clean_text.endswith(f"{line}\nend") and all(r.kept for r in got.values())


def test_depleted_documents_go(spark):
    shared = "\n".join(body(f"s{k}", 20) for k in range(4))
    rows = [(i, f"{shared}\nown words {i}", "a") for i in range(5)]
    got = {r.doc_id: r.kept for r in verdicts(spark, rows)}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: False}


def kept_texts(spark, rows):
    return {r.doc_id: r.clean_text for r in verdicts(spark, rows) if r.kept}


def test_keeper_is_a_document_that_stays(spark):
    line = "Subscribe to our news letter"
    rows = [(0, f"too short\n{line}", "a"), (1, f"{'x y z ' * 40}\n{line}", "a")]
    rows += [(i, f"{body(i)}\n{line}", "a") for i in range(2, 6)]
    assert kept_texts(spark, rows) == {2: f"{body(2)}\n{line}"} | {i: body(i) for i in range(3, 6)}


def test_copies_of_a_rejected_document_leave_one(spark):
    shared = "\n".join(body(f"s{k}", 20) for k in range(4))
    rows = [(0, f"{shared}\n{'x y z ' * 99}", "a")] + [(i, f"{shared}\nown words {i}", "a") for i in range(1, 5)]
    assert kept_texts(spark, rows) == {1: f"{shared}\nown words 1"}


def test_keeper_is_not_depleted(spark):
    shared, line = "\n".join(body(f"s{k}", 20) for k in range(4)), "a line of five words"
    rows = [(i, f"{shared}\n{line}" if i == 1 else f"{shared}\nown {i}", "a") for i in range(4)]
    rows += [(i, f"{body(i)}\n{line}", "a") for i in range(5, 8)]
    got = kept_texts(spark, rows)
    assert set(got) == {0, 5, 6, 7} and [i for i in got if line in got[i]] == [5]


def test_line_of_depleted_documents_only_brings_one_back(spark):
    shared, passage = "\n".join(body(f"s{k}", 100) for k in range(4)), body("p")
    rows = [(i, f"{shared}\n{passage}" if i == 1 else f"{shared}\nown {i}", "a") for i in range(4)]
    rows += [(i, f"{passage}\nown words {i}", "a") for i in (10, 11)]
    assert kept_texts(spark, rows) == {0: f"{shared}\nown 0", 10: f"{passage}\nown words 10"}


def test_copies_do_not_make_a_line_shared(spark):
    rows = [(i, f"{body(1)}\n{body(2)}", "a") for i in range(9)]
    assert {r.kept for r in verdicts(spark, rows)} == {True}


def test_measures_and_unusual_rows(spark):
    rows = [
        (1, "a b c a b c\nx", "h"), (None, None, None), (2, "", "h"), (2, "", "h"),
        (3, "# $ * a|b\n# $ * a|b\n \n \n", "h"), (4, body(4, 49), None), (5, body(5, 50), None),
        (6, body(6, 50), None), (6, body(6, 50), None), (7, "x y z " * 40_000, "h"),
    ]
    got = verdicts(spark, rows)
    assert len(got) == len(rows)
    chars = lambda i, n: len("".join(f"w{i}x{k}" for k in range(n)))
    assert {
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.kept) for r in got
    } == {
        (1, 7, 7, 0, 0, 6, False), (None, 0, 0, 0, 0, 0, False), (2, 0, 0, 0, 0, 0, False),
        (3, 8, 12, 8, 1, 8, False), (4, 49, chars(4, 49), 0, 0, 0, False),
        (5, 50, chars(5, 50), 0, 0, 0, True), (6, 50, chars(6, 50), 0, 0, 0, True),
        (7, 120_000, 120_000, 0, 0, 120_000, False),
    }


def plain_words(line):
    return line.encode().split()


def plain_verdicts(rows, limits):
    """doc_id: (kept, clean text, removed words) of (doc_id, text, host) rows with different ids."""
    text = {d: t or "" for d, t, _ in rows}
    host = {d: h for d, _, h in rows}
    norm = lambda line: " ".join(w.lower() if w.isascii() else w for w in line.split())
    lines, holders = {}, {}
    for d in text:
        lines[d] = [(host[d], norm(x)) if plain_words(x) else None for x in text[d].split("\n")]
        for line in set(lines[d]) - {None}:
            holders.setdefault(line, set()).add(d)
    shared = {x: ds for x, ds in holders.items() if len({text[d] for d in ds}) >= limits.min_docs}
    size = {d: len(plain_words(text[d])) for d in text}
    most = {d: limits.depleted * n for d, n in size.items()}

    def good(d):
        words = plain_words(text[d])
        triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        again = {p for i, t in enumerate(triples) if triples.count(t) > 1 for p in (i, i + 1, i + 2)}
        return len(words) >= limits.min_words and 100 * len(again) <= limits.max_repeat_percent * len(words)

    def lost(d, goes):
        return sum(len(x[1].split()) for x in lines[d] if x in shared and goes(x))

    passing = {d for d in text if good(d)}
    first = {x: min(ds & passing, default=None) for x, ds in shared.items()}
    stay = {d for d in passing if lost(d, lambda x: first[x] != d) <= most[d]}
    held = {x for x, ds in shared.items() if ds & stay}
    able = {d for d in passing - stay if lost(d, lambda x: x in held) <= most[d]}
    stay |= {min(ds & able) for x, ds in shared.items() if x not in held and ds & able}
    keeper = {x: min(ds & stay, default=None) for x, ds in shared.items()}
    out = {}
    for d in text:
        cut = lambda x: x in shared and keeper[x] not in (None, d)  # noqa: E731, B023
        left = [raw for raw, x in zip(text[d].split("\n"), lines[d]) if not cut(x)]
        out[d] = (d in stay, "\n".join(left), lost(d, cut))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_against_plain(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("ABcdé1", k=rng.randint(1, 6))) for _ in range(12)] + ["", " \t", "1 1", "2021"]
    blank = lambda: rng.choice(["", " ", "\t ", "  "])
    rows = []
    for d in range(80):
        own = [f"{d}w{k} x{rng.random()}" for k in range(rng.randrange(4))]
        picked = [blank() + rng.choice(pool).replace(" ", rng.choice([" ", "  "])) + blank()
                  for _ in range(rng.randrange(1, 14))]
        body = own + picked
        rng.shuffle(body)
        rows.append((d, "\n".join(body), rng.choice("ab")))
    rows += [(100 + k, rows[k][1], rows[k][2]) for k in range(10)]
    limits = Limits(min_words=5, max_repeat_percent=90, min_docs=rng.choice([2, 3, 6]), depleted=rng.choice([0.3, 0.6]))
    got = {r.doc_id: (r.kept, r.clean_text, r.removed_words) for r in verdicts(spark, rows, limits)}
    want = plain_verdicts(rows, limits)
    assert got == want
    kept = [t for k, t, _ in want.values() if k]
    assert 0 < len(kept) < len(rows) and any(n for k, _, n in want.values() if k)


def test_lines_are_equal_whatever_their_indent_and_place(spark):
    foot = "Page 1 of 2021"
    rows = [(i, "\n" * (i % 7) + f"{body(i)}\n{' ' * (i % 2)}{foot}{' ' * (i % 3)}\n{i}", "a") for i in range(38)]
    got = {r.doc_id: r for r in verdicts(spark, rows)}
    assert [i for i, r in got.items() if foot in r.clean_text] == [0]
    assert all(r.removed_words == 4 for i, r in got.items() if i)
    odd = spark.createDataFrame([("  A b \n1 one 1\n2x2",)], "t string").select(Q.line_words(F.col("t")))
    assert odd.first()[0] == [["A", "b"], ["1", "one", "1"], ["2x2"]]


def test_the_limit_is_the_same_in_a_large_host(spark):
    rows = [(i, f"{body(i)}\n{'the same short line' if i < 6 else i}\n{i}", "a") for i in range(2_000)]
    got = {r.doc_id: r.removed_words for r in verdicts(spark, rows, Limits())}
    assert {i for i, n in got.items() if n} == {1, 2, 3, 4, 5}


def test_rolling_pages_take_two_passes(spark, monkeypatch):
    """Each page is one line on from the one before it: the number of steps is that of few pages."""
    limits, steps = Limits(min_words=1, min_docs=2, depleted=0.6), []
    real = Q.stored
    monkeypatch.setattr(Q, "stored", lambda df, name: steps.append(name) or real(df, name))

    def pages(n):
        steps.clear()
        rows = [(i, "\n".join(f"line number {i + k}" for k in range(10)), "a") for i in range(n)]
        got = {r.doc_id: (r.kept, r.clean_text, r.removed_words) for r in verdicts(spark, rows, limits)}
        return rows, got, len(steps)

    rows, got, few = pages(60)
    assert got == plain_verdicts(rows, limits)
    _, got, many = pages(10_000)
    assert few == many
    kept = {line for ok, text, _ in got.values() if ok for line in text.split("\n")}
    # All shared lines; the very last one is in the last page alone, which is depleted.
    assert kept == {f"line number {k}" for k in range(10_008)}


def test_columns_with_names_used_inside(spark):
    rows = [(i, f"{body(i)}\nthe same line", "a", f"v{i}") for i in range(4)]
    names = ("_full", "_removed", "_k1", "k2", "_words", "line", "_sorted", "lines", "__x", "HOST", "removed")
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, v string")
    docs = docs.select("doc_id", "text", "source", *[F.col("v").alias(n) for n in names])
    out = quality_rules(docs, Limits(min_docs=3)).collect()
    assert all([r[n] for n in names] == [f"v{r.doc_id}"] * len(names) for r in out) and len(out) == 4
    assert sum("the same line" in r.clean_text for r in out) == 1


def test_no_rows(spark):
    assert verdicts(spark, []) == []
