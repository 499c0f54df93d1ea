"""Spelling variants: words one edit apart, found by composing finite-state machines.

The minimised acceptor of the vocabulary is composed with a one-edit transducer and the acceptor
again. The work is divided by initial states. A pair of words differs first at one place, which lies
in one half of the shorter word; all else is equal. So words that share what is before
and behind a half (with a length) make one part: they are the paths from one initial state, and the
acceptor of a part reads their differing halves only. Each pair is accepted in exactly one part. A
part that is too large is cut again, by halves of its half. In the end a half has one letter, and
the alphabet bounds the part.
"""

from __future__ import annotations

import math
import os.path
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.shared import UPPER, stored

#: Anything but the letters of a word, in lower case (A-Z).
BETWEEN = "[^a-zÀ-ÿ]+"
#: Code points of all words of a part; beyond that it is cut again.
PART_CHARS = 2_000_000


class Machine:
    """Acyclic acceptors with one register: states with the same right language are one state.

    A state is a number, its arcs a tuple of (letter, state). All words of an acceptor have one
    length, so state 0, without arcs, is the only final one.
    """

    def __init__(self) -> None:
        self.arcs: list[tuple[tuple[str, int], ...]] = [()]
        self.known: dict[tuple[tuple[str, int], ...], int] = {(): 0}
        self.shared: dict[tuple[int, int], list[str]] = {}

    def _state(self, arcs: Sequence[tuple[str, int]]) -> int:
        key = tuple(arcs)
        if key not in self.known:
            self.known[key] = len(self.arcs)
            self.arcs.append(key)
        return self.known[key]

    def accept(self, words: Iterable[str]) -> int:
        """The initial state of the minimal acceptor of the words: sorted, of one length."""
        open_arcs: list[list[tuple[str, int]]] = [[]]
        last = ""

        def close(depth: int) -> None:
            while len(open_arcs) > depth + 1:
                state = self._state(open_arcs.pop())
                open_arcs[-1].append((last[len(open_arcs) - 1], state))

        for word in words:
            same = len(os.path.commonprefix((last, word)))
            close(same)
            open_arcs.extend([] for _ in range(len(word) - same))
            last = word
        close(0)
        return self._state(open_arcs[0])

    def _both(self, a: int, b: int) -> Iterator[tuple[str, int, int]]:
        there = dict(self.arcs[b])
        return ((x, to, there[x]) for x, to in self.arcs[a] if x in there)

    def tails(self, a: int, b: int) -> list[str]:
        """What both states accept."""
        key = (a, b) if a < b else (b, a)
        if key not in self.shared:
            found, path, steps = [], [], [self._both(a, b)]
            if key == (0, 0):
                found.append("")
            while steps:
                step = next(steps[-1], None)
                if step is None:
                    steps.pop()
                    if path:
                        path.pop()
                elif step[1] == 0:
                    found.append("".join(path) + step[0])
                else:
                    path.append(step[0])
                    steps.append(self._both(step[1], step[2]))
            self.shared[key] = found
        return self.shared[key]


def one_edit(shorter: Sequence[str], longer: Sequence[str], last: bool) -> Iterator[tuple[str, str, bool]]:
    """Pairs one edit apart, and whether it is an insertion: of two ``shorter`` words, or of one and
    one of the ``longer``, which have a letter more.

    A state of the composition before the edit is the state that both sides have reached by
    the same letters. The transducer then reads another letter on each side, or one on the longer side
    only; afterwards both sides read the same to the end. An insertion is taken at the first
    difference. That is behind the end of the shorter word only if the words end there (``last``).
    """
    machine = Machine()
    begin = machine.accept(sorted(shorter))
    other = machine.accept(sorted(longer)) if longer else None
    path: list[str] = []
    todo: list[tuple[int, str, int, int | None]] = [(0, "", begin, other)]
    while todo:
        depth, letter, here, there = todo.pop()
        if depth:
            del path[depth - 1:]
            path.append(letter)
        arcs = machine.arcs[here]
        for i, (x, to_x) in enumerate(arcs):
            for y, to_y in arcs[i + 1:]:
                for tail in machine.tails(to_x, to_y):
                    start = "".join(path)
                    yield start + x + tail, start + y + tail, False
        onward = {} if there is None else dict(machine.arcs[there])
        for y, to_y in onward.items():
            if here == 0:
                if last:
                    yield "".join(path), "".join(path) + y, True
                continue
            for x, a, b in machine._both(here, to_y):
                if x != y:
                    for tail in machine.tails(a, b):
                        start = "".join(path)
                        yield start + x + tail, start + y + x + tail, True
        for x, to in reversed(arcs):
            todo.append((depth + 1, x, to, onward.get(x)))


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every run of letters of every whole text, A-Z in lower case."""
    text = F.translate("text", UPPER, UPPER.lower())
    return docs.select("doc_id", F.explode(F.split(text, BETWEEN)).alias("run")).filter("run <> ''")


def _halves(words: DataFrame) -> DataFrame:
    """Every word with (size, low, high, more): the half [low, high) of words of ``size`` letters,
    for the word itself and (``more`` = 1) as one with a letter more."""
    cut = F.expr("""explode(flatten(transform(array(0, 1), more -> transform(array(0, 1), half ->
        named_struct('size', length(word) - more,
          'low', IF(half = 0, 0, (length(word) - more) div 2),
          'high', IF(half = 0, (length(word) - more) div 2, length(word) - more),
          'more', more, 'second', half = 1)))))""")
    return words.select("word", "n", cut.alias("cut")).filter(
        "cut.low < cut.high OR (cut.size = 0 AND cut.second)"
    ).select(
        "word", "n", F.expr("int(cut.size)").alias("size"), F.expr("int(cut.low)").alias("low"),
        F.expr("int(cut.high)").alias("high"), "cut.more",
    )


def _again(parts: DataFrame) -> DataFrame:
    """Rows of large parts, for both halves of their half."""
    half = F.expr("(low + high) div 2").cast("int")
    two = F.explode(F.array(
        F.struct(F.col("low").alias("a"), half.alias("b")),
        F.struct(half.alias("a"), F.col("high").alias("b")),
    ))
    return parts.withColumn("two", two).select(
        "word", "n", "size", F.col("two.a").alias("low"), F.col("two.b").alias("high"), "more"
    )


def _keyed(cuts: DataFrame) -> DataFrame:
    """Adds the part: a hash of the half and of all letters outside it. Words of several parts may
    share one by chance, and are told apart where the part is read."""
    return cuts.withColumn("part", F.expr(
        "xxhash64(size, low, high, substring(word, 1, low), substring(word, high + more + 1))"
    ))


def _parts(words: DataFrame, part_chars: int) -> DataFrame:
    """All rows of all parts, those over ``part_chars`` replaced by the parts of their halves.

    The parts to be cut are at most all letters by ``part_chars``, so their list is broadcast. A round
    halves their halves: there are no more rounds than the logarithm of the longest word.
    """
    done, level = [], _keyed(_halves(words))
    while True:
        large = stored(
            level.groupBy("part").agg(
                F.sum(F.length("word")).alias("chars"), F.max(F.expr("high - low")).alias("width")
            ).filter((F.col("chars") > part_chars) & (F.col("width") > 1)).select("part"),
            "large-parts",
        )
        if large.isEmpty():
            break
        done.append(level.join(F.broadcast(large), "part", "left_anti"))
        level = _keyed(_again(level.join(F.broadcast(large), "part", "left_semi")))
    for other in done:
        level = level.unionByName(other)
    return level


def _together(parts: DataFrame) -> DataFrame:
    """The rows of a part side by side; parts in which no two words can meet are left out."""
    w = Window.partitionBy("part")
    return (
        parts.repartition("part").sortWithinPartitions("part")
        .withColumns({"_n": F.count(F.lit(1)).over(w), "_least": F.min("more").over(w)})
        .filter("_n > 1 AND _least = 0")
        .select("part", "word", "n", "size", "low", "high", "more")
    )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple[tuple[str, int], tuple[str, int]]]]:
    """For every part in turn, the pairs of near words with their counts."""

    def of(rows: dict) -> Iterator[tuple[tuple[str, int], tuple[str, int]]]:
        for (size, _, high, _, _), (short, long) in rows.items():
            for u, v, inserted in one_edit(list(short), list(long), high == size):
                yield short[u], (long if inserted else short)[v]

    now, rows = None, {}
    for batch in batches:
        for part, word, n, size, low, high, more in zip(*[c.to_pylist() for c in batch.columns]):
            if part != now:
                if rows:
                    yield of(rows)
                now, rows = part, {}
            key = (size, low, high, word[:low], word[high + more:])
            rows.setdefault(key, ({}, {}))[more][word[low:high + more]] = (word, n)
    if rows:
        yield of(rows)


def near_pairs(words: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(word, near): every pair of different words one edit apart, once. ``words`` has word and n."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("word", "near")])

    def run(batches):
        for pairs in _pairs(batches):
            found = [(u[0], v[0]) for u, v in pairs]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in zip(*found)], names=schema.names
                )

    return _together(_parts(words, part_chars)).mapInArrow(run, schema)


def near_counts(words: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(word, n_near, best_n, best): number of near words, and the one with the largest count (ties:
    the first in code-point order). Each part gives a row per word, not per pair."""
    schema = T.StructType([
        T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()),
        T.StructField("less_n", T.LongType()), T.StructField("best", T.StringType()),
    ])
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for pairs in _pairs(batches):
            seen: dict[str, list] = {}
            for a, b in pairs:
                for (word, _), (near, n) in ((a, b), (b, a)):
                    now = seen.setdefault(word, [0, (1, "")])
                    now[0] += 1
                    now[1] = min(now[1], (-n, near))
            out += [(word, count, *best) for word, (count, best) in seen.items()]
            if len(out) > 4096:
                yield batch()
        if out:
            yield batch()

    found = _together(_parts(words, part_chars)).mapInArrow(run, schema)
    return (
        found.groupBy("word").agg(
            F.sum("n_near").alias("n_near"), F.min(F.struct("less_n", "best")).alias("first")
        )
        .select("word", "n_near", (-F.col("first.less_n")).alias("best_n"), F.col("first.best"))
    )


def _roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of words with a form, by doubling the steps each round. A form's count is many
    times its word's, so the way to the root is short and so are the rounds."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-links")
    for _ in range(rounds):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stored(
            links.join(onward, "root", "left")
            .select("word", F.coalesce("next", "root").alias("root")),
            "spelling-links",
        )
    return links


def group_variants(words: DataFrame, ratio: int = 10, part_chars: int = PART_CHARS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary with ``word`` and ``n`` (over 0).

    The form is the near word of largest n (ties: the first in code-point order) if that is at
    least ``ratio`` (over 1) times the word's own. Following forms from a word leads to its root;
    a word without a form is its own. Words must be different; NULL words are left out, an
    empty word is near every word of one letter, and an empty vocabulary gives no rows. Any column
    beside ``word`` and ``n`` is ignored. Very long words cost time in proportion to their length.
    """
    words = stored(words.filter("word IS NOT NULL").select("word", "n"), "vocabulary")
    formed = stored(
        words.join(near_counts(words, part_chars), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            *[F.when(F.col("best_n") >= ratio * F.col("n"), F.col(c)).alias(name)
              for c, name in (("best", "form"), ("best_n", "form_n"))],
        ),
        "spelling-forms",
    )
    most = formed.agg(F.max("n")).first()[0] or 1
    steps = max(1.0, math.log(max(most, ratio), ratio))
    roots = _roots(formed.filter("form IS NOT NULL"), math.ceil(math.log2(steps + 1)))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
