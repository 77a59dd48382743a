import math
import random
import re
from collections import Counter

import numpy as np

from llm_data import EDGE_TEXTS, SMALL, documents, empty, prose
from tidepool.llm import quality
from tidepool.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    ws = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    covered = {k for i in range(len(ws) - 7) if seen[tuple(ws[i : i + 8])] > 1 for k in range(i, i + 8)}
    n, r = len(ws), len(covered)
    return n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def base(r):
    return tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_base_measures_against_brute_force(spark):
    texts = EDGE_TEXTS + ["a b c d e f g h " * 3, "a " * 40 + "\n\nx\nx\n x y\n", "#*$%&|<> " * 9, prose(1, 300), prose(2, 40) + "\n" + prose(2, 40),
                          "a b c d e f g h i a b c d e f g h j", "a\rb\x0bc\x0cd\x1ce f"]
    got = {r["doc_id"]: r for r in quality.quality_report(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert base(got[i]) == brute(t), t
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_distance_against_numpy(spark):
    p, q = [0.5, 0.5, 0.0, 0.0], [0.1, 0.2, 0.3, 0.4]
    m = (np.array(p) + q) / 2
    want = math.sqrt(sum(a * math.log2(a / c) for a, c in zip(p, m) if a) / 2 + sum(b * math.log2(b / c) for b, c in zip(q, m) if b) / 2)
    df = spark.createDataFrame([(p, q), (p, p), ([1.0, 0.0], [0.0, 1.0])], "p array<double>, q array<double>")
    got = [r[0] for r in df.select(quality.js_distance(df["p"], df["q"])).collect()]
    assert np.allclose(got, [want, 0.0, 1.0])


def test_odd_documents_go_and_short_ones_are_not_judged(spark):
    plain = [prose(k, 120) for k in range(60)]
    odd = [prose(91, 120).upper().replace(" ", "!!! "), "0123 " * 5 + " ".join(str(k * 7919) for k in range(100))]
    short = [prose(92, 22)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_report(documents(spark, plain + odd + short)).collect()}
    assert all(got[k] for k in range(60)) and not got[60] and not got[61] and got[62]


def test_nulls_repeats_and_empty_table(spark):
    df = documents(spark, [prose(1, 60)], lang=None)
    rows = quality.quality_report(df.unionAll(df).selectExpr("*", "1 AS _lang", "2 AS kept", "3 AS _words")).collect()
    assert len(rows) == 2 and all(r["kept"] for r in rows)
    assert quality.quality_report(empty(spark)).collect() == []


def test_query_covers_the_table_without_python(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    df = QUERIES["op5_quality"](spark, SMALL)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r["doc_id"]: r for r in df.collect()}
    assert got.keys() == texts.keys() and all(base(got[i]) == brute(t) for i, t in texts.items())


def test_a_language_of_few_rows_does_not_judge_itself(spark):
    plain = documents(spark, [prose(k, 120) for k in range(60)])
    r = random.Random(3)
    junk = " ".join("".join(r.choices("#*$%|<>", k=r.randint(2, 7))) for _ in range(300))
    chinese = " ".join("".join(r.choices("今天天气很好我们一起去公园散步。", k=r.randint(3, 9))) for _ in range(100))
    other = documents(spark, [junk, " ".join(prose(200 + k, 60) for k in range(2)), chinese], lang="xx").selectExpr("doc_id + 1000 AS doc_id", *plain.columns[1:])
    got = {r["doc_id"]: r for r in quality.quality_report(plain.unionByName(other)).collect()}
    assert not got[1000]["base_failed"] and got[1000]["char_distance"] > quality.MAX_CHAR_DISTANCE and not got[1000]["kept"]
    assert got[1001]["kept"] and all(got[k]["kept"] for k in range(60))
    assert got[1002]["kept"] and not got[1002]["base_failed"]


def test_failing_rows_stay_out_of_the_references(spark):
    plain = documents(spark, [prose(k, 120) for k in range(30)])
    junk = documents(spark, ["#*$ " * 4000] * 3).selectExpr("doc_id + 1000 AS doc_id", *plain.columns[1:])
    alone = {r["doc_id"]: r["char_distance"] for r in quality.quality_report(plain).collect()}
    got = {r["doc_id"]: r for r in quality.quality_report(plain.unionByName(junk)).collect()}
    assert all(got[k]["char_distance"] == d and got[k]["kept"] for k, d in alone.items()) and not got[1000]["kept"]
