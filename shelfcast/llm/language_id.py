"""Language by n-gram filters: one bit-sliced Bloom filter answers for all languages at once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.shared import held_out, map_texts, stored

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
SIZES = (2, 3, 4)
MASK_BITS = 64
#: Words whose n-grams are held at a time.
BLOCK = 50_000
#: Odd multipliers of a common 64-bit mixing function.
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the documents learned from, about so many of each language.

    An n-gram enters a language if it is at least ``share`` as frequent there as in the language
    that has it most, up to the ``grams`` most frequent.
    """

    sample: int = 3000
    grams: int = 10_000
    share: float = 0.25
    least: int = 3
    slots: int = 1 << 18
    hashes: int = 3
    languages: int = 1024


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams within words, a mark before and after each word, block by block."""
    words = WORD.findall(text.lower())
    for at in range(0, len(words), BLOCK):
        line = "\0" + "\0".join(words[at:at + BLOCK]) + "\0"
        code = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        for n in SIZES:
            if len(code) < n:
                continue
            mixed = np.full(len(code) - n + 1, n, np.uint64)
            inside = np.ones(len(mixed), bool)
            for k in range(n):
                part = code[k:k + len(mixed)]
                if 0 < k < n - 1:
                    inside &= part != 0
                mixed = (mixed ^ part) * np.uint64(MIX[0])
                mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(MIX[1])
            yield (mixed ^ (mixed >> np.uint64(32)))[inside]


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


class Filters:
    """``masks[slot]`` has bit l if an n-gram of language l falls into the slot."""

    def __init__(self, languages: list[str], slots: int, hashes: int):
        self.languages, self.slots, self.hashes = languages, slots, hashes
        parts = max(1, -(-len(languages) // MASK_BITS))
        self.masks = np.zeros((parts, slots), np.uint64)
        self.false_rate = np.zeros(len(languages))

    def places(self, codes: np.ndarray) -> list[np.ndarray]:
        step = (codes >> np.uint64(33)) | np.uint64(1)
        top = np.uint64(self.slots - 1)
        return [((codes + np.uint64(j) * step) & top).astype(np.int64) for j in range(self.hashes)]

    def add(self, codes: np.ndarray, language: np.ndarray) -> None:
        bit = np.uint64(1) << (language % MASK_BITS).astype(np.uint64)
        for part in range(len(self.masks)):
            own = language // MASK_BITS == part
            for place in self.places(codes[own]):
                np.bitwise_or.at(self.masks[part], place, bit[own])

    def seal(self) -> None:
        """Each language's false-positive rate, from how full its slice is."""
        for l in range(len(self.languages)):
            bit = np.uint64(1) << np.uint64(l % MASK_BITS)
            full = np.count_nonzero(self.masks[l // MASK_BITS] & bit) / self.slots
            self.false_rate[l] = full**self.hashes

    def counts(self, text: str) -> np.ndarray:
        """Per language, the n-grams of the text that are in its filter, less the false ones."""
        hits, n = np.zeros(len(self.languages)), 0
        for codes in grams(text):
            n += len(codes)
            places = self.places(codes)
            for part, masks in enumerate(self.masks):
                found = masks[places[0]]
                for place in places[1:]:
                    found &= masks[place]
                first = part * MASK_BITS
                for l in range(first, min(first + MASK_BITS, len(self.languages))):
                    hits[l] += np.count_nonzero(found & (np.uint64(1) << np.uint64(l - first)))
        return np.maximum(0.0, (hits - n * self.false_rate) / (1 - self.false_rate))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        counts = self.counts(text)
        best = int(np.argmax(counts))
        total = counts.sum()
        share = counts[best] / total if total > 0 else 1 / len(self.languages)
        return self.languages[best], round(float(share), 6)


def sample(docs: DataFrame, most: int) -> tuple[DataFrame, list[str]]:
    """Text and lang of about ``most`` documents of each language, chosen by a hash, and the languages."""
    known = docs.filter(F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003.0
    sizes = stored(sizes, "language-sizes")
    chosen = known.join(sizes, "lang").filter(unit < most / F.col("n")).select("lang", "text")
    return chosen, sorted(r.lang for r in sizes.collect())


def gram_counts(chosen: DataFrame) -> DataFrame:
    """lang, code, n: how often each n-gram occurs; added up per task before the shuffle."""
    def run(batches):
        for batch in batches:
            seen: dict[str, list[np.ndarray]] = {}
            langs, texts = batch.column("lang").to_pylist(), batch.column("text")
            for i, lang in enumerate(langs):
                seen.setdefault(lang, []).extend(grams(texts[i].as_py() or ""))
                if len(seen[lang]) > 3000:
                    yield from emit(lang, seen.pop(lang))
            for lang, codes in seen.items():
                yield from emit(lang, codes)

    def emit(lang, codes):
        if codes:
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(code), pa.string()), pa.array(code.view(np.int64)),
                 pa.array(n.astype(np.int64))],
                names=["lang", "code", "n"],
            )

    counts = chosen.mapInArrow(run, "lang string, code long, n long")
    return counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, settings: Settings = Settings()) -> Filters:
    """Learns from the rows of ``docs`` with a lang. Sample, n-grams and filters have fixed bounds."""
    chosen, languages = sample(docs, settings.sample)
    if len(languages) > settings.languages:
        raise ValueError(f"more than {settings.languages} languages")
    counts = stored(gram_counts(chosen), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = rated.groupBy("code").agg(F.max("rate").alias("best"))
    ranked = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    kept = (
        rated.join(best, "code")
        .filter((F.col("rate") >= settings.share * F.col("best")) & (F.col("n") >= settings.least))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= settings.grams)
        .select("code", "lang")
    )
    rows = kept.collect()
    filters = Filters(languages, settings.slots, settings.hashes)
    if rows:
        index = {lang: i for i, lang in enumerate(languages)}
        codes = np.array([r.code for r in rows], np.int64).view(np.uint64)
        filters.add(codes, np.array([index[r.lang] for r in rows], np.int64))
    filters.seal()
    return filters


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """Adds lang_pred and score to the columns of ``docs``.

    A NULL text and one without a letter are ``und`` with score 0, and so is everything if nothing
    was learned. Ties go to the first language by name. Columns of these names are replaced;
    repeated rows are judged alike, and an empty table gives no rows.
    """
    def start():
        return lambda texts: [filters.predict(t) for t in texts]

    return map_texts(
        docs, start,
        [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())],
    )


def language_id(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learns from the rows outside the fourth kept back (crc32 of the id), predicts all of ``docs``."""
    apart = held_out(F.col("doc_id"), 4, 2)
    filters = fit(docs.filter(~apart), settings)
    return identify(docs.withColumn("held_out", apart), filters)
