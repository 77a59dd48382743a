"""Periodic runs of words by seeds on diagonals.

A run is a stretch of words with smallest period q, of at least
``max(LEAST, TIMES * q)`` words, that no neighbouring word extends. In such a
run, words at lag q agree over at least ``max(LEAST - q, (TIMES - 1) * q)``
places. Periods are taken in classes; the seeds of a class are k-grams of the
overlap that its smallest period guarantees, and a class ends at period k. A
k-gram of k >= q words recurs inside its run at multiples of q only, so that the next
occurrence of a gram in its document is the lag itself: only neighbouring occurrences are
paired, never all. A pair whose lag is of the class is extended to both sides
on its diagonal; per lag, a table of the furthest place that an extension
covered drops the pairs inside it.

Grams have exact numbers, not hashes: those of length m come from sorting pairs of
shorter ones, and only places whose shorter grams recur in their document are
looked at again. Documents are worked off in chunks of about CHUNK words, with
the document as part of a word's number, so that nothing crosses documents.

Scale: a narrow map, no shuffle; a task holds one batch of rows and one chunk (or the one
text that is longer) of words as numbers.

Defined cases: words ``[^\\x20\\x09-\\x0D]+``; null, empty and blank texts have no
words and no runs, and collapse to the empty string; equal rows are each
reported; null ids stay; columns other than the text's do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import rows_of, whole_text

#: A run has so many words at least, and so many times its period.
LEAST, TIMES = 6, 4
#: Words that are worked off at once.
CHUNK = 400_000
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
FOUND = T.StructType([T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """(smallest period, largest period, seed length) up to the periods that a
    text of so many words can hold."""
    low = 1
    while max(LEAST, TIMES * low) <= longest:
        k = max(LEAST - low, (TIMES - 1) * low)
        high = k if low > 1 else 1
        yield low, high, k
        low = high + 1


def paired(left: np.ndarray, right: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the joined grams ``left`` here and ``right`` ``shift`` words on
    (-1: not whole, or nowhere else in its document), and the pairs of
    neighbouring occurrences."""
    at = np.flatnonzero(left[: max(0, len(left) - shift)] >= 0)
    at = at[right[at + shift] >= 0]
    key = left[at] * (int(right.max(initial=0)) + 1) + right[at + shift]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    again = key[1:] == key[:-1]
    number = np.cumsum(np.concatenate(([0], ~again))) if len(at) else at
    recurs = np.concatenate(([False], again)) | np.concatenate((again, [False])) if len(at) else np.zeros(0, bool)
    out = np.full(len(left), -1, np.int64)
    out[at[recurs]] = number[recurs]
    return out, at[:-1][again], at[1:][again]


def reach(words: np.ndarray, at: int, lag: int, limit: int, step: int) -> int:
    """How far from ``at`` (to the right: step 1, to the left: -1) words at the
    lag agree, at most ``limit`` places; blocks of growing size."""
    done, size = 0, 32
    while done < limit:
        n = min(size, limit - done)
        lo = at + done if step > 0 else at - done - n
        differ = np.flatnonzero(words[lo : lo + n] != words[lo + lag : lo + lag + n])
        if len(differ):
            return done + int(differ[0] if step > 0 else n - 1 - differ[-1])
        done, size = done + n, size * 4
    return done


def runs_of(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in documents laid end to end;
    ``words``: numbers that differ between documents, ``ends``: the ends of the
    documents. Sorted by start, then period."""
    if not len(words):
        return []
    longest = int(np.diff(ends, prepend=0).max())
    recurs, _, _ = paired(words, np.zeros(len(words), np.int64), 0)
    grams, whole = {1: recurs}, []
    for low, high, k in classes(longest):
        m = max(n for n in grams if n <= k)
        # double the length, then one overlapping step to k
        while 2 * m < k:
            grams[2 * m], i, j = paired(grams[m], grams[m], m)
            m *= 2
        if (grams[m] < 0).all():
            break
        grams[k], i, j = paired(grams[m], grams[m], k - m)
        near = (j - i >= low) & (j - i <= high)
        i, lag = i[near], (j - i)[near]
        order = np.lexsort((i, lag))
        i, lag = i[order], lag[order]
        head = np.concatenate(([True], (i[1:] != i[:-1] + 1) | (lag[1:] != lag[:-1]))) if len(i) else np.zeros(0, bool)
        furthest: dict[int, int] = {}
        for at, q in zip(i[head].tolist(), lag[head].tolist()):
            if at < furthest.get(q, 0):
                continue
            d = int(np.searchsorted(ends, at, "right"))
            begin, end = int(ends[d - 1]) if d else 0, int(ends[d])
            right = at + reach(words, at, q, end - q - at, 1)
            left = at - reach(words, at, q, at - begin, -1)
            furthest[q] = right
            if right - left + q >= max(LEAST, TIMES * q):
                whole.append((left, right - left + q, q))
        for n in [n for n in grams if n < m]:
            del grams[n]
    return sorted(whole, key=lambda r: (r[0], r[2]))


def _chunk(texts: list[bytes | None]) -> Iterator[tuple[list, bytes]]:
    """Runs and collapsed text of each text."""
    split = [(t or b"").split() for t in texts]
    ends = np.cumsum([len(w) for w in split], dtype=np.int64)
    flat = np.empty(int(ends[-1]), object)
    flat[:] = [w for ws in split for w in ws]
    number, names = pd.factorize(flat)
    doc = np.repeat(np.arange(len(split)), np.diff(ends, prepend=0))
    runs = runs_of(number.astype(np.int64) + doc * (len(names) + 1), ends)
    where = np.searchsorted(ends, [r[0] for r in runs], "right").tolist()
    by_doc: dict[int, list] = {}
    for d, r in zip(where, runs):
        by_doc.setdefault(d, []).append(r)
    for d, ws in enumerate(split):
        mine = by_doc.get(d)
        if not mine:
            yield [], b" ".join(ws)
            continue
        begin = int(ends[d]) - len(ws)
        edge = np.zeros(len(ws) + 1, np.int64)
        for start, length, q in mine:
            edge[start - begin + q] += 1
            edge[start - begin + length] -= 1
        kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        yield [(s - begin, n, q) for s, n, q in mine], b" ".join([ws[k] for k in kept.tolist()])


def found_in(texts: list[bytes | None]) -> Iterator[tuple[list, bytes]]:
    """``_chunk`` over chunks of about CHUNK words (a blank every two bytes at most)."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or b"") // 6 + 1
        if size >= CHUNK:
            yield from _chunk(held)
            held, size = [], 0
    if held:
        yield from _chunk(held)


@F.arrow_udf(FOUND)
def _found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        runs, texts = [], []
        for mine, text in found_in(batch.cast(pa.binary()).to_pylist()):
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in mine])
            texts.append(text)
        yield pa.StructArray.from_arrays([pa.array(runs, _RUNS), pa.array(texts, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def with_runs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` plus ``runs`` (start, length, period; by start, then period) and
    ``collapsed``: the words that no run holds after its first period, joined by
    one space."""
    kept = [F.col("_row")[c].alias(c) for c in df.columns if c.lower() not in ("runs", "collapsed")]
    found = rows_of(df, _text=whole_text(text_col)).select("_row", _found("_text").alias("_found"))
    return found.select(*kept, "_found.runs", "_found.collapsed")


def planted(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, text), where in one document of ten words repeat from some
    place on; place and period come from the CRC of the id (null: the empty string)."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # a column of its own: inside the lambda the text would be split anew for each word
    rows = rows.withColumn("_h", h).withColumn("_words", F.when(F.col("_h") % 10 == 0, F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")))
    words, g, n = F.col("_words"), F.floor(F.col("_h") / 10), F.greatest(F.size("_words"), F.lit(1))
    rows = rows.withColumn("_a", (g % n).cast("int")).withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int"))
    again = F.transform(words, lambda w, i: F.when(i < F.col("_a"), w).otherwise(F.get(words, F.col("_a") + (i - F.col("_a")) % F.col("_p"))))
    return rows.select("doc_id", F.when(F.size(words) > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def period_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its runs, the longest one, and digests of runs and rest."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(text_col).alias("text"))
    found = with_runs(planted(rows)).drop("text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("_best", best)
    length, period = F.col("_best.length"), -F.col("_best.period")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
