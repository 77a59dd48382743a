"""Toxicity by a counterfactual-regularised classifier.

A logistic regression over the presence of words and word beginnings. Each
labelled text that names an identity group is paired with counterfactuals in
which the term is swapped for the other terms of its group; the loss adds
PENALTY times the squared change of the score (before the logistic function)
between a text and its counterfactuals. A word that only names a group thus
keeps the same small weight as the other names of its group, and neutral
mentions do not raise the score.

Fit: from at most about SAMPLE_PER_CLASS labelled rows of each class that are not
held out (the smallest hashes of the id; a documented bound), whole texts.
Features are counted in Spark; those whose counts in the two classes differ by
a likelihood ratio of at least LEAST_Z standard errors are kept, at most FEATURES of them (the model's
size). Their rows in the sample are what the driver fits on.

Defined cases: null and empty texts score the intercept (as do texts without
any feature); without labelled rows of both classes every score is the share
of toxic rows, or 0.0; a document labelled more than once counts as toxic if
any label says so; rows that share an id are one labelled row with the words
of all; null labels are ignored; repeated rows are scored each for
themselves; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import bounded_batches, held_out, rows_of, smallest, written

SAMPLE_PER_CLASS = 12_000
FEATURES = 4_000
LEAST_ROWS = 3
LEAST_Z = 4.0
#: Lengths of the word beginnings that count besides the whole word.
BEGINNINGS = (4, 5, 6)
PENALTY = 4.0
RIDGE = 5e-5
STEPS = 800
#: Words whose features a worker remembers.
CACHE_ENTRIES = 300_000
WORD = re.compile(r"[^\W\d_]+")

#: Groups of identity terms that can stand for each other.
IDENTITY_GROUPS = tuple(tuple(line.split()) for line in (
    "women men girls boys woman man",
    "gay lesbian straight bisexual transgender queer",
    "muslim christian jewish hindu buddhist atheist catholic",
    "black white asian latino african european arab",
    "immigrants refugees foreigners natives",
    "old young elderly teenagers",
    "blind deaf disabled autistic",
    "frauen männer mädchen jungen",
    "muslime christen juden hindus",
    "femmes hommes filles garçons",
    "musulmans chrétiens juifs hindous",
    "mujeres hombres chicas chicos",
    "musulmanes cristianos judíos hindúes",
))
SWAPS = {term: [x for x in group if x != term] for group in IDENTITY_GROUPS for term in group}


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings ('lov~')."""
    return [word, *[word[:n] + "~" for n in BEGINNINGS if len(word) > n]]


def features(ws: set[str]) -> set[str]:
    return {f for w in ws for f in features_of(w)}


class Model(NamedTuple):
    weights: dict[str, float]
    intercept: float

    def score(self, ws: set[str]) -> float:
        hit = {f for w in ws for f in features_of(w) if f in self.weights}
        return self.total(hit)

    def total(self, hit: set[str]) -> float:
        x = self.intercept + sum(self.weights[f] for f in sorted(hit))
        return float(1 / (1 + np.exp(-np.clip(x, -60, 60))))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_class: int) -> DataFrame:
    """(toxic, words) of at most about ``per_class`` labelled documents of each
    class, one row for each id. The sampled ids are few enough to broadcast,
    so no text is shuffled to find them."""
    one = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("_id")).distinct().join(one, "_id")
    ids = smallest(known.withColumn("_h", F.xxhash64("_id")), "toxic", "_h", per_class).select("_id", "toxic")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, toxic, texts = (batch.column(k) for k in range(3))
            found = pa.array([sorted(words(t)) for t in texts.to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([ids, toxic, found], ["_id", "toxic", "words"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    id_type = texts.schema["_id"].dataType.simpleString()
    found = texts.join(F.broadcast(ids), "_id").select("_id", "toxic", "text").mapInArrow(split, f"_id {id_type}, toxic int, words array<string>")
    return found.groupBy("_id").agg(F.max("toxic").alias("toxic"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("words")))).alias("words")).drop("_id")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn from the labelled rows that are not held out."""
    bounded_batches(docs)
    rows = written(labelled(docs, labels, id_col, text_col, per_class), "toxicity")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        p = bad / (bad + good) if bad + good else 0.0
        return Model({}, float(np.log(p / (1 - p))) if 0 < p < 1 else (60.0 if p else -60.0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *[pa.array([v[k] for v in held.values()], pa.int64()) for k in (0, 1)]], ["f", "good", "bad"])

        for batch in batches:
            for toxic, ws in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                for f in features(set(ws)):
                    held.setdefault(f, [0, 0])[toxic] += 1
            if len(held) > 500_000:
                yield flush()
                held.clear()
        yield flush()

    per = rows.mapInArrow(count, "f string, good long, bad long").groupBy("f").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    # likelihood ratio of the feature's two-by-two table
    x, y = F.col("bad").cast("double"), F.col("good").cast("double")
    row, off = x + y, F.lit(float(bad + good)) - x - y
    cells = ((x, row * bad), (y, row * good), (bad - x, off * bad), (good - y, off * good))
    ratio = sum((F.when(o > 0, o * F.log(o * (bad + good) / e)).otherwise(0.0) for o, e in cells), F.lit(0.0))
    z = F.sqrt(F.greatest(F.lit(0.0), 2 * ratio))
    telling = per.where(F.col("good") + F.col("bad") >= LEAST_ROWS).withColumn("z", z).where(F.col("z") >= LEAST_Z)
    kept = [r["f"] for r in telling.orderBy(F.desc("z"), "f").limit(FEATURES).select("f").collect()]
    names = sorted({*kept, *SWAPS})
    where = {f: k for k, f in enumerate(names)}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Feature numbers of a row and of its counterfactuals, in the sample only."""
        at = lambda ws: sorted({where[f] for w in ws for f in features_of(w) if f in where})
        for batch in batches:
            toxic, x, swapped = [], [], []
            for label, ws in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                ws = set(ws)
                toxic.append(label)
                x.append(at(ws))
                swapped.append([at(ws - {t} | {other}) for t in sorted(ws & SWAPS.keys()) for other in SWAPS[t]])
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(x, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.list_(pa.int32())))], ["toxic", "x", "swapped"])

    sample = rows.mapInArrow(rows_of, "toxic int, x array<int>, swapped array<array<int>>").toPandas()
    return descend(names, sample)


def sparse(lists) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) numbers of a list of column lists."""
    n = np.array([len(x) for x in lists], np.int64)
    cols = np.concatenate([np.asarray(x, np.int64) for x in lists]) if n.sum() else np.empty(0, np.int64)
    return np.repeat(np.arange(len(n)), n), cols


def descend(names: list[str], sample: pd.DataFrame, penalty: float = PENALTY) -> Model:
    """Gradient descent (Adam) on the balanced logistic loss plus the
    counterfactual penalty; all rows at once, so the result is repeatable."""
    y = sample["toxic"].to_numpy(float)
    r, c = sparse(list(sample["x"]))
    pairs = [(x, s) for x, ss in zip(sample["x"], sample["swapped"]) for s in ss]
    r0, c0 = sparse([p[0] for p in pairs])
    r1, c1 = sparse([p[1] for p in pairs])
    k, share = len(names), np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = np.zeros(k), 0.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(r, w[c], len(y)), -60, 60)))
        e = share * (p - y)
        g = np.bincount(c, e[r], k) + RIDGE * w
        if pairs:
            change = (np.bincount(r0, w[c0], len(pairs)) - np.bincount(r1, w[c1], len(pairs))) / len(pairs) * 2 * penalty
            g += np.bincount(c0, change[r0], k) - np.bincount(c1, change[r1], k)
        g = np.append(g, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Model({f: float(x) for f, x in zip(names, w) if abs(x) > 1e-4}, float(b))


def with_toxicity(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus the score (0 to 1) of each whole text."""
    bounded_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        seen: dict[str, tuple[str, ...]] = {}
        for batch in texts:
            got = []
            for text in batch:
                hit: set[str] = set()
                for w in words(text):
                    fs = seen.get(w)
                    if fs is None:
                        if len(seen) >= CACHE_ENTRIES:
                            seen.clear()
                        fs = seen[w] = tuple(f for f in features_of(w) if f in m.weights)
                    if fs:
                        hit.update(fs)
                got.append(m.total(hit))
            yield pd.Series(got, dtype="float64")

    return docs.withColumn(out, score(F.col(text_col)))


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on labelled rows that are not held out and score all rows."""
    model = fit(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return with_toxicity(rows, model, "text").drop("text").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_civil(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    model = fit(docs, labels, id_col, text_col)
    rows = rows_of(docs, _text=F.col(f"`{text_col}`"))
    return with_toxicity(rows, model, "_text", "_score").where(F.col("_score") < threshold).select("_row.*")
