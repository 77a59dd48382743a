"""Language ID by bit-sliced n-gram filters.

The model is one Bloom filter for all languages: each slot holds a bitmask
with one bit per language, so the AND of the slots of an n-gram gives all
languages that contain it at once. A document's n-grams are looked up, the
bits are counted per language (popcounts), and each count is corrected for the
false positives that its language's share of set slots makes likely. The
largest corrected count decides.

Fit: from at most SAMPLE_PER_LANGUAGE documents per language (the smallest
hashes of the id; a documented bound), whole texts. An n-gram belongs to a
language if it is among the language's GRAMS most frequent ones and at least
SHARE as frequent there as in the language where it is most frequent. The
model's size is fixed by SLOTS and the number of languages.

N-grams are 3 and 4 characters of the lower-cased text in which every run of
non-letters is one blank. Defined cases: a null text or one without a letter
is ``und`` with score 0; a text whose n-grams are in no filter gets the first
language of the model (by name) with score 0; ties go to the first language;
without any training row every text is ``und``; repeated rows are judged each
for themselves; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import bounded_batches, held_out, rows_of, smallest, with_struct

UND = "und"
ORDERS = (3, 4)
SAMPLE_PER_LANGUAGE = 1500
GRAMS = 12_000
LEAST_COUNT = 4
SHARE = 0.25
SLOTS = 1 << 19
HASHES = 2
#: A pipeline keeps a text if this share of its n-grams speaks for its language ...
LEAST_COVERAGE = 0.10
#: ... or if it has too few n-grams to tell.
FEW_GRAMS = 40

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Code point -> itself if it is a letter, else a blank."""
    if not _letters:
        _letters.append(np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], np.uint32))
    return _letters[0]


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, runs of others as one blank,
    a blank at either end; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    a = letter_table()[codes]
    blank = a == 32
    if blank.all():
        return np.empty(0, np.uint32)
    a = a[~(blank & np.concatenate(([True], blank[:-1])))]
    return np.concatenate((np.array([32], np.uint32), a if a[-1] == 32 else np.append(a, np.uint32(32))))


def grams(text: str | None) -> np.ndarray:
    """64-bit hashes of all n-grams, in order of length and place."""
    a = letters(text).astype(np.uint64)
    out = []
    for n in ORDERS:
        m = len(a) - n + 1
        if m > 0:
            h = np.full(m, n, np.uint64)
            for i in range(n):
                h = (h ^ a[i : i + m]) * _A
                h ^= h >> np.uint64(32)
            out.append(h)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


class Filters(NamedTuple):
    languages: list[str]
    #: slot -> bitmask, in words of 8 languages each
    slots: np.ndarray
    #: chance that an n-gram outside a language looks as if it were inside
    false_positive: np.ndarray

    @staticmethod
    def build(members: dict[str, np.ndarray], slots: int = SLOTS) -> "Filters":
        names = sorted(members)
        table = np.zeros((max(1, -(-len(names) // 8)), slots), np.uint8)
        fp = []
        for k, name in enumerate(names):
            for at in places(members[name], slots):
                table[k // 8, at] |= np.uint8(1 << (k % 8))
            fp.append(((table[k // 8] >> (k % 8)) & 1).mean() ** HASHES)
        return Filters(names, table, np.array(fp))

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Per language: n-grams of ``h`` that its filter holds."""
        out = []
        at = places(h, self.slots.shape[1])
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        for word in self.slots:
            mask = np.bitwise_and.reduce([word[p] for p in at])
            out.append(np.bincount(mask, minlength=256) @ bits)
        return np.concatenate(out)[: len(self.languages)]

    def decide(self, text: str | None) -> tuple[str, float, float, int]:
        """(language, score, share of its n-grams, n-grams) of a whole text."""
        h = grams(text)
        if not len(h) or not self.languages:
            return UND, 0.0, 0.0, len(h)
        right = np.maximum(0.0, (self.counts(h) - len(h) * self.false_positive) / (1 - np.minimum(self.false_positive, 0.999)))
        k, total = int(right.argmax()), float(right.sum())
        return self.languages[k], float(right[k]) / total if total > 0 else 0.0, min(1.0, float(right[k]) / len(h)), len(h)


def places(h: np.ndarray, slots: int) -> list[np.ndarray]:
    return [((h * _B) >> np.uint64(33)).astype(np.int64) % slots, (h >> np.uint64(7)).astype(np.int64) % slots][:HASHES]


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most about ``per_language`` fit rows per language (lang, text)."""
    fit = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col)).alias("_h"))
    ids = smallest(fit, "lang", "_h", per_language).select("_id").distinct()
    # at most per_language ids for each language: small enough to broadcast
    texts = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).join(F.broadcast(ids), "_id", "left_semi").select("lang", "text")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE) -> Filters:
    """Learn the filters. What reaches the driver is at most GRAMS n-grams
    for each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        n = 0

        def flush():
            for lang, got in held.items():
                h, c = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                h = grams(text)
                held.setdefault(lang, []).append(h)
                n += len(h)
                if n > 8_000_000:
                    yield from flush()
                    n = 0
        yield from flush()

    bounded_batches(docs)
    counted = sample(docs, id_col, text_col, lang_col, per_language).mapInArrow(count, "lang string, gram long, n long")
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = summed.withColumn("_r", F.row_number().over(top)).where(F.col("_r") <= GRAMS).select("lang", "gram", "n").toPandas()
    if best.empty:
        return Filters.build({})
    best["p"] = best["n"] / best.groupby("lang")["n"].transform("sum")
    own = best[best["p"] >= SHARE * best.groupby("gram")["p"].transform("max")]
    return Filters.build({lang: g["gram"].to_numpy(np.int64).view(np.uint64) for lang, g in own.groupby("lang")})


FIELDS = ("lang_pred", "score", "coverage", "n_grams")


def with_language(docs: DataFrame, model: Filters, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred, score, coverage and n_grams of each whole text."""
    bounded_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, coverage double, n_grams long")
    def decide(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([shared.value.decide(t) for t in batch], columns=list(FIELDS))

    return with_struct(docs, decide(F.col(text_col)), FIELDS)


def language_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Fit on the rows that are not held out and predict all rows."""
    model = fit(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return with_language(rows, model, "text").drop("text")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without texts that have no letter or look like none of the
    learned languages."""
    model = fit(docs, id_col, text_col, lang_col)
    judged = with_language(rows_of(docs, _text=F.col(f"`{text_col}`")), model, "_text")
    known = (F.col("lang_pred") != UND) & ((F.col("coverage") >= LEAST_COVERAGE) | (F.col("n_grams") < FEW_GRAMS))
    return judged.where(known).select("_row.*")
