"""Windows of benchmark items against a brute-force search."""

import random

from shelfcast.llm import decontamination as D


def brute(text, items, size):
    words = D.WORD.findall(D.lower_ascii(text or ""))
    hit, ids = set(), set()
    for item, said in items:
        own = D.WORD.findall(D.lower_ascii(said or ""))
        n = min(size, len(own))
        windows = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add(item)
    return len(words), len(hit), sorted(ids)


def corpus():
    rng = random.Random(1)
    vocabulary = ["a", "b", "Cé", "d1", "日本"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 6, 9]))) for i in range(12)] + [(3, text(5)), (10, None), (None, "q r s t u")]
    docs = [(i, text(rng.choice([0, 2, 30, 300]))) for i in range(60)] + [(99, None), (100, "x q-R. s T u"), (None, "")]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(*d, "x", "kept") for d in docs], "doc_id long, text string, items string, _1 string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [("" if i is None else str(i), t) for i, t in items]
    want = {d: brute(t, named, 4) for d, t in docs}
    for most in (10_000_000, 150):
        assert (D._passes(D._items(bench), 4, most) > 1) == (most == 150)
        got = D.decontaminate(frame, bench, 4, most).collect()
        assert len(got) == len(docs) and got[0].asDict()["_1"] == "kept"
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want
        assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in got)
    row = next(r for r in got if r.doc_id == 100)
    assert [row.text[s.start:s.end] for s in row.hit_spans] == ["q-R. s T u"]


def test_empty_tables(spark):
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert not any(r.contaminated for r in D.decontaminate(frame, bench.limit(0)).collect())
    assert D.decontaminate(frame.limit(0), bench).collect() == []
