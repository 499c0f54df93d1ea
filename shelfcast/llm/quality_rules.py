"""Rules on words and lines, with lines that many documents of a host share taken out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shared import SPACES, UPPER, stored, unused

SYMBOLS = "#*$%&|<>"
BLANKS = SPACES.replace("\n", "")
KEY = ["k1", "k2"]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Limits:
    """A line goes when at least ``min_docs`` different texts of its host have it, however large the
    host is. A document is depleted when over ``depleted`` of its words go with such lines.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    min_docs: int = 6
    depleted: float = 0.3


def words(text: Column) -> Column:
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def line_words(text: Column) -> Column:
    """The words of every line, in order; a line without words has none."""
    plain = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.transform(
        F.split(plain, "\n"), lambda line: F.filter(F.split(line, " "), lambda w: w != "")
    )


def line_hash(host: Column, words: Column) -> Column:
    """Of the host and the line's words in lower case (A-Z) with one space between them."""
    return F.xxhash64(host, F.translate(F.array_join(words, " "), UPPER, UPPER.lower()))


def _keys(doc_id: Column, host: Column, text: Column) -> list[Column]:
    """128 bits that stand for a row; rows equal in id, host and text share them. The second
    number is of the text alone."""
    return [F.xxhash64(doc_id, host).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _repeated(n: Column, word: Column) -> Column:
    """How many words lie in a run of three that occurs more than once; ``word`` is the array."""
    window = lambda i: F.xxhash64(
        F.get(word, i), F.get(word, i + 1), F.get(word, i + 2)
    )
    return F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window))


def measured(docs: DataFrame) -> DataFrame:
    """Measures of every row of ``docs`` (doc_id, host, text), its key and its lines with words.

    One pass over the texts. ``lines`` has the hash and the number of words of each line.
    """
    text = F.coalesce("text", F.lit(""))
    first = docs.select(
        *_keys(F.col("doc_id"), F.col("host"), F.col("text")), "doc_id", "host", text.alias("text"),
        line_words(text).alias("said"),
    )
    second = first.select("*", F.flatten("said").alias("words")).select(
        *KEY, "doc_id", "host", "text", "said", F.size("words").alias("n"),
        _repeated(F.size("words"), F.col("words")).alias("windows"),
    )
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    third = second.withColumn(
        "ordered",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered),
    )
    near = lambda e, k: (
        (F.get("ordered", k - 1)["h"] == e["h"]) | (F.get("ordered", k + 1)["h"] == e["h"])
    )
    again = F.transform("ordered", lambda e, k: F.when(near(e, k), e["i"]))
    covered = F.array_distinct(F.flatten(F.transform(
        F.filter(again, lambda i: i.isNotNull()), lambda i: F.array(i, i + 1, i + 2)
    )))
    full = F.filter(
        F.arrays_zip(F.split("text", "\n").alias("raw"), F.col("said")), lambda x: F.size(x["said"]) > 0
    )
    fourth = third.select(
        *KEY, "doc_id", F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        full.alias("full"), "host",
        F.coalesce(F.when(F.col("ordered").isNotNull(), F.size(covered)), F.lit(0)).cast("long")
        .alias("n_repeat_words"),
    )
    raw = F.transform("full", lambda x: x["raw"])
    lines = F.transform("full", lambda x: F.struct(
        line_hash(F.col("host"), x["said"]).alias("line"), F.size(x["said"]).alias("n")
    ))
    return fourth.select(
        *KEY, "doc_id", *MEASURES[:3],
        (F.size(raw) - F.size(F.array_distinct(raw))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", lines.alias("lines"),
    )


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )


def shared_lines(known: DataFrame, limits: Limits) -> DataFrame:
    """Hashes of the lines that at least ``min_docs`` different texts have.

    Equal texts are one document, so copies don't make their lines shared. Both steps of the
    distinct count combine before their shuffle: a line that every document has is spread over its
    texts first, and then one row per task.
    """
    each = known.select("k2", F.explode(F.array_distinct("lines.line")).alias("line"))
    counted = each.groupBy("line").agg(F.countDistinct("k2").alias("n_docs"))
    return counted.filter(F.col("n_docs") >= limits.min_docs).select("line")


def places(known: DataFrame, shared: DataFrame, limits: Limits) -> DataFrame:
    """One row per key and shared line, with the words ``n`` of all its places there.

    ``good`` tells whether the text passes by itself.
    """
    each = known.select(
        *KEY, "doc_id", "n_words", (~base_failed(limits)).alias("good"), F.posexplode("lines").alias("pos", "at")
    ).select(*KEY, "doc_id", "n_words", "good", "pos", "at.line", F.col("at.n").cast("long").alias("n"))
    return (
        each.join(shared, "line").distinct()
        .groupBy(*KEY, "doc_id", "n_words", "good", "line").agg(F.sum("n").alias("n"))
    )


def _keepers(rows: DataFrame) -> DataFrame:
    """The first document of each line among the given places; one narrow row per line."""
    return stored(rows.groupBy("line").agg(F.min("doc_id").alias("keeper")), "line-keepers")


def _goes() -> Column:
    return ~F.col("doc_id").eqNullSafe(F.col("keeper"))


def settled(found: DataFrame, limits: Limits) -> DataFrame:
    """``found`` places with ``stays``: whether the document stays, by two passes over them.

    First, a line is kept by the first good document with it. Those that lose too much even so are
    depleted, the others stay. A line is open if no document that stays has it. Of its documents that
    lose little enough to lines that stay, the first is then brought back with it.
    """
    most = limits.depleted * F.col("n_words")
    lost = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    good = found.filter("good")
    first = (
        good.join(_keepers(good), "line").groupBy(*KEY, "n_words").agg(lost(_goes()).alias("lost"))
        .select(*KEY, (F.col("lost") <= most).alias("stays"))
    )
    once = stored(
        found.join(stored(first, "line-states"), KEY, "left")
        .withColumn("stays", F.coalesce("stays", F.lit(False))),
        "line-places",
    )
    held = stored(once.groupBy("line").agg(F.max("stays").alias("held")), "line-held")
    out = once.filter("good AND NOT stays").join(held, "line")
    able = (
        out.groupBy(*KEY, "n_words").agg(lost(F.col("held")).alias("lost"))
        .filter(F.col("lost") <= most).select(*KEY)
    )
    open_ = stored(out.filter("NOT held").join(stored(able, "line-able"), KEY), "line-open")
    back = open_.join(_keepers(open_), "line").filter(~_goes()).select(*KEY).distinct()
    return stored(
        once.join(stored(back.withColumn("back", F.lit(True)), "line-back"), KEY, "left")
        .select(*found.columns, (F.col("stays") | F.coalesce("back", F.lit(False))).alias("stays")),
        "line-settled",
    )


def line_verdicts(found: DataFrame, limits: Limits) -> DataFrame:
    """Per key with shared lines: whether it stays, the words that go, and the hashes of their lines.

    A line goes where another document that stays is the first to have it.
    """
    done = settled(found, limits)
    cut = F.col("kept_somewhere") & ~(F.col("stays") & ~_goes())
    keepers = _keepers(done.filter("stays")).withColumn("kept_somewhere", F.lit(True))
    cut = F.coalesce(cut, F.lit(False))
    return done.join(keepers, "line", "left").groupBy(*KEY).agg(
        F.max("stays").alias("stays"), F.sum(F.when(cut, F.col("n")).otherwise(0)).alias("removed_words"),
        F.collect_set(F.when(cut, F.col("line"))).alias("removed"),
    )


def verdicts(docs: DataFrame, limits: Limits) -> DataFrame:
    """One narrow row per key of ``docs`` (doc_id, host, text): measures, verdict, removed lines."""
    known = stored(measured(docs), "line-measures")
    shared = stored(shared_lines(known, limits), "shared-lines")
    found = stored(places(known, shared, limits), "line-places")
    once = known.groupBy(*KEY).agg(*[F.max(m).alias(m) for m in MEASURES])
    failed = base_failed(limits)
    return once.join(stored(line_verdicts(found, limits), "line-verdicts"), KEY, "left").select(
        *KEY, *MEASURES, failed.alias("base_failed"),
        F.coalesce("removed_words", F.lit(0)).cast("long").alias("removed_words"), "removed",
        (~failed & F.coalesce("stays", F.lit(True))).alias("kept"),
    )


def _clean(text: Column, host: Column, removed: Column) -> Column:
    """The text without the lines whose hash is among ``removed``."""
    lines = F.arrays_zip(F.split(text, "\n").alias("raw"), line_words(text).alias("said"))
    left = F.filter(
        lines,
        lambda x: (F.size(x["said"]) == 0) | ~F.array_contains(removed, line_hash(host, x["said"])),
    )
    joined = F.array_join(F.transform(left, lambda x: x["raw"]), "\n")
    return F.when(F.coalesce(F.size(removed), F.lit(0)) <= 0, text).otherwise(joined)


def quality_rules(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """Judges every document and gives its text without the lines its host repeats.

    Lines are equal if their words are, in lower case (A-Z); lines without words are never shared. Of
    a shared line all but one document lose it: the first that stays keeps it. A document goes if
    it fails by itself, or if it is depleted and no line would leave the corpus with it but those
    whose documents all fail or lose too much to lines that stay. The passes over shared lines
    are two, whatever the data.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
    clean_text and kept to the columns of ``docs``; an input column of such a name is replaced, all
    others pass through. A NULL text counts as empty (no words: base_failed) and stays NULL
    in clean_text. NULL hosts form one host. NULL ids are ordinary rows; a line whose staying holders
    all have NULL ids is kept by all of them, as rows with one id all keep their line. Rows equal in
    id, host and text get equal verdicts. An empty table gives no rows.
    """
    made = [*MEASURES, "base_failed", "removed_words", "clean_text", "kept"]
    docs = docs.drop(*made)
    judged = stored(
        verdicts(docs.select("doc_id", F.col(host).alias("host"), "text"), limits), "quality-verdicts"
    )
    mark = unused(docs.columns)
    keyed = docs.select("*", *[
        c.alias(f"{mark}{k}") for k, c in zip(KEY, _keys(F.col("doc_id"), F.col(host), F.col("text")))
    ])
    judged = judged.select(*[F.col(c).alias(f"{mark}{c}") for c in judged.columns])
    joined = keyed.join(judged, [f"{mark}{k}" for k in KEY])
    clean = _clean(F.col("text"), F.col(host), F.col(f"{mark}removed"))
    added = [clean if c == "clean_text" else F.col(f"{mark}{c}") for c in made]
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], *[a.alias(c) for a, c in zip(added, made)])
