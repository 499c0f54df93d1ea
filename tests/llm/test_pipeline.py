"""The pipeline's stages against plain Python over the smallest tables."""

import hashlib

import corpus_pipeline as P
import public_tokenizers
from test_decontamination import brute
from test_quality_rules import plain_verdicts
from test_simhash import slow_components, slow_fingerprint

from shelfcast.llm import byte_bpe, secret_scan
from shelfcast.llm.quality_rules import Limits

SF = "/root/testdata/sf0.001"


def plain_quality(rows):
    """(doc_id, text) kept by the rules, lines of a host above the limits taken out."""
    done = plain_verdicts([(r.doc_id, r.text, r.source) for r in rows], Limits())
    return {d: text for d, (kept, text, _) in done.items() if kept}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    made = []
    for _, stage in P.STAGES[:-1]:
        before, docs = docs, P.stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == before.columns
        made.append((before.collect(), {r.doc_id: r for r in docs.collect()}))
        assert all(r.n_chars == len(r.text) for r in made[-1][1].values())
    before, after = made[0]
    assert {d: r.text for d, r in after.items()} == plain_quality(before)
    before, after = made[1]
    prints = {r.doc_id: slow_fingerprint(r.text, 3) for r in before}
    root = slow_components(sorted(set(prints.values())), 2)
    first = {}
    for d in sorted(prints):
        first.setdefault(root[prints[d]], d)
    assert set(after) == set(first.values()) and len(after) < len(before)
    before, after = made[2]
    assert set(after) == {r.doc_id for r in before if brute(r.text, bench, 10)[1] == 0}
    before, after = made[3]
    finder = secret_scan.keyword_automaton()
    for r in before:
        assert after[r.doc_id].text == secret_scan.redact(r.text, secret_scan.find(r.text, finder))
    tokens = byte_bpe.read_ranks(P.VOCABULARY)
    codec = byte_bpe.Codec(byte_bpe.model_bytes(tokens), tokens, public_tokenizers.PATTERN)
    last = P.encoded(spark, docs, SF).collect()
    assert {r.doc_id for r in last} == set(after)
    for r in last:
        text = after[r.doc_id].text
        assert r.ids == codec.encode(text)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    whole = P.run(spark, SF)
    assert {(r.doc_id, r.ids_sha256) for r in whole.collect()} == {(r.doc_id, r.ids_sha256) for r in last}


def test_no_documents(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_unusual_rows(spark):
    """NULLs in every column, repeated rows, a long text and columns with names used inside."""
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, None, None, None, None),
            (None, text + " x", None, None, None), (2, "", "en", "a", 0), (3, text * 300, "en", "b", 9)]
    docs = spark.createDataFrame(
        [(*r, 1, "k", 2, 3) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, "
        "n_words int, kept string, fp int, ids int",
    )
    kept = [[(1, 5)] * 2 + [(None, None)], [(1, 5), (2, 0), (3, 9), (None, None)], rows, rows]
    for (_, stage), want in zip(P.STAGES[:-1], kept):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got = [(r.doc_id, r.n_chars) for r in out.collect()]
        if want is not rows:
            assert sorted(map(str, got)) == sorted(map(str, want))
        else:
            assert len(got) == len(rows)
    assert P.encoded(spark, docs, SF).count() == len(rows)
