"""Benchmark passages in documents, by one Aho-Corasick automaton over normalised windows."""

from __future__ import annotations

import re
from bisect import bisect_right

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.shared import map_texts, stored, unused

#: Words are runs of digits, letters and everything outside ASCII, after A-Z became a-z.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
#: Characters of all windows of an automaton, so of its states; more take several passes.
AUTOMATON_CHARS = 8_000_000

HITS = T.ArrayType(
    T.StructType([
        T.StructField("first", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("item", T.StringType()),
    ])
)


def lower_ascii(text: str) -> str:
    """A-Z in lower case; every other character, and so every offset, stays."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def windows(text: str | None, size: int) -> set[str]:
    """All windows of an item as words with a space around each; a short item is one window."""
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return set()
    last = max(1, len(words) - size + 1)
    return {f" {' '.join(words[i:i + size])} " for i in range(last)}


def automaton(items: list[tuple[str, str | None]], size: int) -> ahocorasick.Automaton | None:
    """Finds windows; a find carries the number of words and the items that have the window."""
    owners: dict[str, set[str]] = {}
    for item, text in items:
        for window in windows(text, size):
            owners.setdefault(window, set()).add(item)
    if not owners:
        return None
    found = ahocorasick.Automaton()
    for window, ids in owners.items():
        found.add_word(window, (window.count(" ") - 1, sorted(ids)))
    found.make_automaton()
    return found


def scan(text: str | None, finder: ahocorasick.Automaton | None) -> tuple[int, list[tuple]]:
    """The number of words, and (first, last word, item) of every window found."""
    words = WORD.findall(lower_ascii(text or ""))
    if not words or finder is None:
        return len(words), []
    line = f" {' '.join(words)} "
    hits, ends, at = [], None, 1
    for end, (n, ids) in finder.iter(line):
        if ends is None:
            ends = []
            for word in words:
                at += len(word)
                ends.append(at)
                at += 1
        last = bisect_right(ends, end) - 1
        hits += [(last - n + 1, last, item) for item in ids]
    return len(words), hits


def merged(hits: list[tuple]) -> list[tuple[int, int]]:
    """Word intervals, both ends included, that the hits cover, in order."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted({(h[0], h[1]) for h in hits}):
        if spans and first <= spans[-1][1] + 1:
            spans[-1] = (spans[-1][0], max(last, spans[-1][1]))
        else:
            spans.append((first, last))
    return spans


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word intervals as code point offsets of the original text, end exclusive."""
    if not spans:
        return []
    places = [m.span() for m in WORD.finditer(lower_ascii(text))]
    return [(places[a][0], places[b][1]) for a, b in spans]


def verdict(text: str, n_words: int, hits: list[tuple]) -> tuple:
    """n_words, n_hit, n_items, items, hit_spans, contaminated."""
    spans = merged(hits)
    items = sorted({h[2] for h in hits})
    n_hit = sum(b - a + 1 for a, b in spans)
    return n_words, n_hit, len(items), items, offsets(text, spans), bool(spans)


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    )


def _passes(items: DataFrame, window: int, most_chars: int) -> int:
    """Parts in which the windows stay under ``most_chars``, where those of single items do. A
    character of an item is in at most ``window`` windows."""
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return 1 + 2 * (chars * window // most_chars)


def _scanner(shipped, window: int, finish):
    """Starts a task: one automaton, and a function from texts to ``finish(text, n_words, hits)``."""
    def start():
        finder = automaton(shipped.value, window)
        return lambda texts: [finish(t or "", *scan(t, finder)) for t in texts]

    return start


def _found_in_parts(docs: DataFrame, items: DataFrame, window: int, n: int) -> DataFrame:
    """(t1, t2, hits) of the texts, by two hashes of theirs, in which some part is found.

    One part of the items at a time comes to the driver and becomes an automaton; its hits are
    written out before the next one's turn.
    """
    context = docs.sparkSession.sparkContext
    part, found = F.pmod(F.xxhash64("item", "text"), F.lit(n)), None
    for k in range(n):
        shipped = context.broadcast([tuple(r) for r in items.filter(part == k).collect()])
        scanned = map_texts(
            docs.select("text"), _scanner(shipped, window, lambda text, n_words, hits: (hits,)),
            [T.StructField("hits", HITS)],
        )
        hits = stored(
            scanned.filter("size(hits) > 0").select(*_text_key(), F.explode("hits").alias("hit"))
            .distinct(),
            "benchmark-hits",
        )
        shipped.destroy()
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("t1", "t2").agg(F.collect_set("hit").alias("hits"))


def _text_key() -> list:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most_chars: int = AUTOMATON_CHARS
) -> DataFrame:
    """Marks the words of every document that lie in a window of a benchmark item.

    Adds n_words, n_hit, n_items, items (ids as sorted text), hit_spans (offsets in the original
    text, end exclusive) and contaminated; an input column of such a name is replaced. A NULL text
    has no words. A NULL item id counts as the id ''. Equal items share their windows. Windows of
    an empty or NULL item do not exist. An empty benchmark marks nothing.

    The benchmark's size is measured first. With up to ``most_chars`` in its windows it becomes one
    broadcast automaton and one pass over the documents. More is cut into parts, each one pass
    that keeps the hits of the few texts that have any; these are joined to the documents in the end.
    """
    span = T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
    made = [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", T.ArrayType(span)),
        T.StructField("contaminated", T.BooleanType()),
    ]
    out, items = docs.drop(*[f.name for f in made]), _items(benchmark)
    n = _passes(items, window, most_chars)
    if n == 1:
        shipped = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])
        return map_texts(out, _scanner(shipped, window, verdict), made)
    mark = unused(out.columns)
    hits = _found_in_parts(docs, items, window, n).select(
        F.col("t1").alias(f"{mark}1"), F.col("t2").alias(f"{mark}2"), F.col("hits").alias(f"{mark}hits")
    )
    one, two = _text_key()
    joined = out.select("*", one.alias(f"{mark}1"), two.alias(f"{mark}2")).join(
        hits, [f"{mark}1", f"{mark}2"], "left"
    )

    def start():
        def work(texts, found):
            return [
                verdict(t or "", scan(t, None)[0], [(h["first"], h["last"], h["item"]) for h in hits or []])
                for t, hits in zip(texts, found)
            ]

        return work

    marked = map_texts(joined, start, made, reads=("text", f"{mark}hits"))
    return marked.select(*[F.col(f"`{c}`") for c in out.columns], *[f.name for f in made])
