"""Benchmark decontamination by spaced-seed hashing.

A mask says which of the tokens of a short span count and which are ignored
('1' and '0'). Under every mask, the counting tokens of each span of the
benchmark items are hashed; the spans of the documents are hashed the same way
and the two joined by hash. Masks ignore different positions, so
a substituted word spoils some seeds and leaves others. A hit lays an item
against a document; every window of WINDOW tokens (or the whole item, if
shorter) around the seed is verified token by token and must agree in all but
a few substitutions. Items of fewer than MIN_TOKENS words allow none: they
are hashed whole, one mask for each of their lengths, and found where all
their words stand one after the other.

Texts are tokenized to words ``\\w+`` of the lower-cased text; Chinese and
Japanese characters, which are written without blanks, are a word each. Words
are compared by 31 bits of their hash, seeds by 64.

Scale and skew. Both tables are hashed in tasks. A Bloom filter of the
benchmark's seeds (at most BLOOM_BITS bits, whatever its size; a fuller
one lets more through and loses nothing) drops nearly all spans of the
documents where they are made. What is left carries the words around it, so that the
join verifies a hit without reading a text again; Spark broadcasts the
benchmark's seeds only if its size check allows it, else joins by hash and splits hot
hashes (AQE skew join). Repeats of a seed with the same words around it count once in a text and in
an item, equal texts once in a task. The best window of a (text, item) is a
minimum that merges map-side. Texts are named by their SHA-256 and never shuffled. The
driver sees a count and the filter.

Defined cases: null and empty texts and items match nothing; equal
items are each reported; equal documents are each reported; rows with a null
id are compared too; empty tables give an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import bounded_batches, rows_of, whole_text, written
from tidepool.llm.near_dedup import mixed, word_hashes

#: '1': the token counts, '0': it is ignored. Every overlap that verifies, of
#: MIN_TOKENS to WINDOW tokens, holds a seed of one of these masks wherever its
#: substitutions stand (the tests try all), so the search loses none.
MASKS = ("11111", "1101011", "10110011")
#: A verified overlap: so many tokens, of which this share agrees.
WINDOW = 13
AGREE = 0.8
MIN_TOKENS = 8
#: Each word of the mask of a whole short item.
WHOLE = "w"
#: Words before and after the first word of a seed that a window can reach.
BEFORE, AFTER = WINDOW - min(map(len, MASKS)), WINDOW
#: Bits of the filter for each seed, and at most.
BITS_PER_SEED, BLOOM_BITS, BLOOM_HASHES = 16, 1 << 27, 3
#: Tokens that are hashed at once in a task.
CHUNK_TOKENS = 200_000
#: Texts of a task that are remembered, so that copies are hashed once.
REMEMBERED = 100_000

# Kana, CJK ideographs and their extensions, hangul is written with blanks.
CJK = "ぁ-ヿ㐀-䶿一-鿿豈-﫿"
WORD = re.compile(f"[{CJK}]|[^\\W{CJK}]+")
OVERLAP = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()),
                        T.StructField("item_start", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("agree", T.LongType())])


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c != "0"]


def need(length: int) -> tuple[int, int]:
    """(window, agreeing tokens needed) for an item of this length."""
    w = min(WINDOW, length)
    return w, w if length < MIN_TOKENS else int(np.ceil(AGREE * w))


def seeds(words: np.ndarray, doc: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of the spans that lie in one text, and the hashes of their counting words."""
    offs, n = offsets(mask), len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(doc[:n] == doc[len(mask) - 1 :])
    h = np.full(len(at), zlib.crc32(mask.encode()), np.uint64)
    for o in offs:
        h = mixed(h ^ words[at + o])
    return at, h


def around(words: np.ndarray, doc: np.ndarray, at: np.ndarray, outside: int) -> np.ndarray:
    """31 bits of the hashes of the words around each place; ``outside`` where the text ends."""
    place = at[:, None] + np.arange(-BEFORE, AFTER)
    inside = (place >= 0) & (place < len(words))
    place = np.where(inside, place, 0)
    inside &= doc[place] == doc[at][:, None]
    low = (words[place] & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(2)
    return np.where(inside, low, np.uint32(outside))


def first_only(text: np.ndarray, h: np.ndarray, near: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows without those whose text, seed and surroundings stood there before."""
    key = mixed(h ^ mixed(text.astype(np.uint64)))
    for k in range(near.shape[1]):
        key = mixed(key ^ near[:, k].astype(np.uint64))
    _, first = np.unique(key, return_index=True)
    return np.sort(first)


def chunks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes of words, number of the text of each, place of each text's
    first word) for chunks of about CHUNK_TOKENS words."""
    held: list[tuple[int, list[str]]] = []
    size = 0
    for k, text in enumerate([*texts, None]):
        ws = tokens(text)
        if ws:
            held.append((k, ws))
            size += len(ws)
        if held and (size >= CHUNK_TOKENS or k == len(texts)):
            doc = np.repeat(np.array([d for d, _ in held]), [len(w) for _, w in held])
            first = np.zeros(len(texts), np.int64)
            first[[d for d, _ in held]] = np.cumsum([0, *[len(w) for _, w in held[:-1]]])
            yield word_hashes(" ".join(w for _, ws in held for w in ws)), doc, first
            held, size = [], 0


def hit_places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mixed(h + np.uint64(k)) & np.uint64(bits - 1)).astype(np.int64) for k in range(BLOOM_HASHES)]


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def item_seeds(benchmark: DataFrame, text_col: str) -> DataFrame:
    """(hash, item, at, n, near): the seeds of each distinct item text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for words, doc, first in chunks(batch.column(1).to_pylist()):
                n = np.bincount(doc, minlength=len(names))
                for mask in [*MASKS, *[WHOLE * k for k in range(1, MIN_TOKENS)]]:
                    at, h = seeds(words, doc, mask)
                    whole = mask not in MASKS
                    keep = n[doc[at]] == len(mask) if whole else n[doc[at]] >= MIN_TOKENS
                    at, h = at[keep], h[keep]
                    near = around(words, doc, at, 1)
                    k = first_only(doc[at], h, near, at)
                    at, h, near = at[k], h[k], near[k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array([names[d] for d in doc[at].tolist()], pa.binary()), pa.array(at - first[doc[at]]), pa.array(n[doc[at]]),
                         pa.array([x.tobytes() for x in near], pa.binary()), pa.array(np.full(len(at), len(mask) if whole else 0, np.int64))],
                        ["hash", "item", "at", "n", "near", "whole"])

    rows = benchmark.select(digest(whole_text(text_col)).alias("item"), whole_text(text_col).alias("text")).dropDuplicates(["item"])
    return rows.mapInArrow(make, "hash long, item binary, at long, n long, near binary, whole long")


def seed_filter(found: DataFrame) -> np.ndarray:
    """The Bloom filter of the seeds, OR-ed in tasks; its size follows their number up to a bound."""
    count = found.count()
    bits = 64
    while bits < min(BLOOM_BITS, BITS_PER_SEED * count):
        bits *= 2

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(hit_places(h, bits)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64))], ["word", "bit"])

    words = found.select("hash").mapInArrow(parts, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(bits // 64, np.uint64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return table


def text_hits(docs: DataFrame, text_col: str, table: np.ndarray, lengths: list[int]) -> DataFrame:
    """(hash, text, at, near) of the documents' spans that the filter lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, bits = shared.value, len(shared.value) * 64
        seen: set[bytes] = set()
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, name in enumerate(names):
                if name in seen:
                    texts[k] = None
                elif len(seen) < REMEMBERED:
                    seen.add(name)
            for words, doc, first in chunks(texts):
                out = []
                for mask in [*MASKS, *[WHOLE * k for k in lengths]]:
                    at, h = seeds(words, doc, mask)
                    may = np.ones(len(at), bool)
                    for place in hit_places(h, bits):
                        may &= (words_of[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0
                    at, h = at[may], h[may]
                    if mask not in MASKS:
                        # no window but the seed itself: its first place in the text is enough
                        _, k = np.unique(mixed(h ^ mixed(doc[at].astype(np.uint64))), return_index=True)
                        at, h = at[np.sort(k)], h[np.sort(k)]
                    out.append((at, h))
                at, h = (np.concatenate(x) for x in zip(*out))
                if not len(at):
                    continue
                near = around(words, doc, at, 0)
                k = first_only(doc[at], h, near, at)
                at, h, near = at[k], h[k], near[k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array([names[d] for d in doc[at].tolist()], pa.binary()), pa.array(at - first[doc[at]]),
                     pa.array([x.tobytes() for x in near], pa.binary())], ["hash", "text", "at", "near"])

    rows = docs.select(digest(whole_text(text_col)).alias("digest"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(make, "hash long, text binary, at long, near binary")


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a hit and an item's seed: the best window around the seed that verifies."""
    for batch in batches:
        text, item = batch.column("text"), batch.column("item")
        at, q, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "item_at", "n"))
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, BEFORE + AFTER) for c in ("near", "item_near"))
        same = np.concatenate([np.zeros((len(a), 1), np.int64), np.cumsum(a == b, axis=1)], axis=1)
        inside = np.concatenate([np.zeros((len(a), 1), np.int64), np.cumsum((a != 0) & (b != 1), axis=1)], axis=1)
        w = np.minimum(WINDOW, n)
        least = np.where(n < MIN_TOKENS, w, np.ceil(AGREE * w)).astype(np.int64)
        best, where = np.full(len(a), -1, np.int64), np.zeros(len(a), np.int64)
        row = np.arange(len(a))
        # windows from left to right: of equal ones the first counts
        for start in range(BEFORE + 1):
            end = np.minimum(start + w, BEFORE + AFTER)
            agree = np.where(inside[row, end] - inside[:, start] == w, same[row, end] - same[:, start], -1)
            better = (agree >= least) & (agree > best)
            best, where = np.where(better, agree, best), np.where(better, start, where)
        ok = np.flatnonzero(best >= 0)
        shift = where[ok] - BEFORE
        yield pa.RecordBatch.from_arrays(
            [text.take(pa.array(ok)), item.take(pa.array(ok)), pa.array(-best[ok]), pa.array(at[ok] + shift), pa.array(q[ok] + shift), pa.array(w[ok])],
            ["text", "item", "less", "start", "item_start", "tokens"])


def matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text: str = "text") -> DataFrame:
    """(text, item, start, item_start, tokens, agree): of each text and item
    text (named by their digests) the best verified window."""
    bounded_batches(docs)
    known = written(item_seeds(benchmark, item_text), "seeds")
    lengths = sorted(r[0] for r in known.where(F.col("whole") > 0).select("whole").distinct().collect())
    hits = text_hits(docs, text_col, seed_filter(known), lengths)
    items = known.select("hash", "item", F.col("at").alias("item_at"), "n", F.col("near").alias("item_near"))
    pairs = hits.join(items, "hash").select("text", "item", "at", "item_at", "n", "near", "item_near")
    found = pairs.mapInArrow(verified, "text binary, item binary, less long, start long, item_start long, tokens long")
    best = found.groupBy("text", "item").agg(F.min(F.struct("less", "start", "item_start", "tokens")).alias("b"))
    return best.select("text", "item", "b.start", "b.item_start", "b.tokens", (-F.col("b.less")).alias("agree"))


def _item_matches(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """``matches`` for the ids of all items of a text."""
    ids = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), digest(whole_text(item_text)).alias("item"))
    found = written(matches(docs, benchmark, text_col, item_text), "matches")
    return found.join(ids, "item").select(F.col("text").alias("_digest"), "item_id", "start", "item_start", "tokens", "agree")


def with_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", out: str = "overlaps") -> DataFrame:
    """``docs`` plus the array of verified overlaps (item_id, start, item_start,
    tokens, agree), the best one per matching item, places counted in words from 0."""
    found = _item_matches(docs, benchmark, text_col, item_col, item_text)
    per = found.groupBy("_digest").agg(F.array_sort(F.collect_list(F.struct(*OVERLAP.names))).alias("_found"))
    rows = rows_of(docs, _digest=digest(whole_text(text_col))).join(per, "_digest", "left")
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c.lower() != out.lower()]
    return rows.select(*kept, F.coalesce("_found", F.array().cast(T.ArrayType(OVERLAP))).alias(out))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per document and item whose passage it repeats."""
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), digest(whole_text(text_col)).alias("_digest"))
    return slim.join(_item_matches(docs, benchmark, text_col, item_col, "text"), "_digest").drop("_digest")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` without the rows that repeat a benchmark passage."""
    gone = written(matches(docs, benchmark, text_col), "matches").select(F.col("text").alias("_digest")).distinct()
    return rows_of(docs, _digest=digest(whole_text(text_col))).join(gone, "_digest", "left_anti").select("_row.*")
