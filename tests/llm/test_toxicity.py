import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from llm_data import EDGE_TEXTS, SMALL, documents, empty, prose
from tidepool.llm import toxicity
from tidepool.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def labelled(spark, n=240):
    texts, labels = [], []
    for k in range(n):
        bad = k % 3 == 0
        texts.append(prose(k, 30) + (" you rotten fool" if bad else "") + " " + prose(k + 10_000, 20))
        labels.append((k, 1, int(bad)))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS)


def test_held_out_rows_are_told_apart(spark):
    docs, labels = labelled(spark)
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert len(rows) == 240
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    out = [r for r in rows if r["held_out"]]
    assert len(out) > 20 and all(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in out)


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = labelled(spark)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0
    wrong = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda x: {r["doc_id"]: r["score"] for r in toxicity.toxicity_report(docs, x).collect()}
    assert score(labels) == score(wrong)


def test_penalty_evens_out_identity_terms():
    # a biased sample: one group is mentioned in toxic texts, its counterparts are not
    names = sorted({"rotten", "women", "men"})
    at = {f: k for k, f in enumerate(names)}
    rows = []
    for k in range(200):
        bad = k % 2
        words = {"women"} if bad else ({"men"} if k % 4 else set())
        if bad and k % 4 == 1:
            words |= {"rotten"}
        swaps = [sorted(at[w] for w in words - {t} | {o}) for t in words & {"women", "men"} for o in {"women", "men"} - {t}]
        rows.append((bad, sorted(at[w] for w in words), swaps))
    sample = pd.DataFrame(rows, columns=["toxic", "x", "swapped"])
    free, held = toxicity.descend(names, sample, penalty=0.0), toxicity.descend(names, sample, penalty=50.0)
    gap = lambda m: abs(m.weights.get("women", 0) - m.weights.get("men", 0))
    assert gap(held) < 0.2 * gap(free)
    assert held.weights["rotten"] > 1


def test_neutral_mentions_stay_clean(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    plain = model.score(toxicity.words("the women went home"))
    assert plain < 0.5 and abs(plain - model.score(toxicity.words("the men went home"))) < 0.05


def test_edge_cases(spark):
    docs, labels = labelled(spark, 60)
    edge = docs.unionAll(documents(spark, EDGE_TEXTS, first=1000)).unionAll(docs.limit(1)).selectExpr("*", "1 AS _id", "2 AS toxic", "3 AS score", "4 AS words")
    labels = labels.unionAll(spark.createDataFrame([(1000, 0, 0), (1001, 0, None), (None, 0, 1), (0, 0, 0), (9999, 0, 1)], LABELS))
    rows = toxicity.toxicity_report(edge, labels).collect()
    assert len(rows) == 60 + len(EDGE_TEXTS) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    null, blank = (next(r["score"] for r in rows if r["doc_id"] == 1000 + k) for k in (0, 1))
    assert null == blank
    kept = toxicity.keep_civil(edge, labels)
    assert kept.columns == edge.columns


def test_without_labels_or_rows(spark):
    docs, labels = labelled(spark, 6)
    none = labels.filter("false")
    assert {r["score"] < 1e-6 for r in toxicity.toxicity_report(docs, none).collect()} == {True}
    assert toxicity.toxicity_report(empty(spark), labels).collect() == []
    assert toxicity.keep_civil(empty(spark), none).collect() == []


def test_one_id_with_many_rows_is_one_labelled_row(spark):
    docs, labels = labelled(spark, 60)
    many = docs.unionAll(docs.filter("doc_id = 1").join(spark.range(0, 400).selectExpr("1 AS k")).drop("k"))
    found = toxicity.labelled(many, labels, "doc_id", "text", 100)
    assert found.count() == toxicity.labelled(docs, labels, "doc_id", "text", 100).count()


def test_query_covers_the_table(spark):
    rows = QUERIES["op3_toxicity"](spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert np.isfinite([r["score"] for r in rows]).all()


def test_sample_of_a_hot_class_is_not_dealt_out_whole(spark):
    """Rows are dropped by the counts before they are shuffled by class."""
    from pyspark.sql import functions as F

    from tidepool.llm.common import smallest

    df = spark.range(0, 200_000).selectExpr("CASE WHEN id % 100 = 0 THEN 1 ELSE 0 END AS toxic", "xxhash64(id) AS _h", "id AS _id")
    got = smallest(df, "toxic", "_h", 500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.index("Exchange hashpartitioning(toxic") < plan.index("BroadcastHashJoin")
    best = {t: {r["_id"] for r in df.where(F.col("toxic") == t).orderBy(F.pmod("_h", F.lit(1 << 52)), "_h").limit(500).collect()} for t in (0, 1)}
    assert {t: {r["_id"] for r in got.where(F.col("toxic") == t).collect()} for t in (0, 1)} == best
