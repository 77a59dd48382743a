import numpy as np
from pyspark.sql import functions as F

from llm_data import EDGE_TEXTS, documents, empty, prose
from tidepool.llm import language
from tidepool.llm.queries import QUERIES

TABLE = "/root/testdata/sf0.01"


def three(spark, n=60):
    df = None
    for k, lang in enumerate(("en", "de", "fr")):
        part = documents(spark, [prose(1000 * k + i, 80, lang) for i in range(n)], lang, first=1000 * k)
        df = part if df is None else df.unionAll(part)
    return df


def test_held_out_accuracy(spark):
    df = three(spark)
    rows = language.language_report(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 180
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in rows)


def test_languages_of_held_out_rows_are_never_read(spark):
    df = three(spark)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0
    odd = df.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(language.language_report(odd).collect()) == sorted(language.language_report(df).collect())


def test_filters_return_all_languages_of_a_gram():
    a, b = language.grams("the thing"), language.grams("the other")
    f = language.Filters.build({"x": a, "y": b, **{f"z{k}": language.grams(prose(k, 5)) for k in range(12)}})
    counts = dict(zip(f.languages, f.counts(language.grams("the"))))
    assert counts["x"] == counts["y"] == len(language.grams("the")) > 0
    assert len(f.slots) == 2  # 14 languages: two bytes of bits
    assert f.counts(a)[f.languages.index("x")] == len(a)  # a filter never misses


def test_false_positives_are_corrected():
    rng = np.random.default_rng(1)
    h = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64)
    small, large = h(10), h(4000)
    f = language.Filters.build({"small": small, "large": large}, slots=1 << 12)
    outside = h(20_000)
    seen = f.counts(outside) / len(outside)
    assert seen[0] > 0.5 and abs(seen[0] - f.false_positive[0]) < 0.02  # names are sorted: large, small


def test_edge_cases(spark):
    df = three(spark, 20).unionAll(documents(spark, EDGE_TEXTS + ["12 34", "¿!"], None, first=5000))
    df = df.unionAll(df.limit(3)).selectExpr("*", "1 AS score", "'x' AS lang_pred", "2 AS _text", "3 AS _s", "4 AS coverage")
    rows = language.language_report(df).collect()
    assert len(rows) == df.count()
    pred = {r["doc_id"]: r["lang_pred"] for r in rows}
    for k, t in enumerate(EDGE_TEXTS + ["12 34", "¿!"]):
        assert (pred[5000 + k] == "und") == (not any(c.isalpha() for c in t or ""))
    kept = language.keep_known(df)
    assert kept.columns == df.columns and kept.filter("doc_id < 5000").count() == df.filter("doc_id < 5000").count()
    assert kept.filter("text IS NULL OR text = ''").count() == 0


def test_without_training_rows(spark):
    unlabelled = documents(spark, [prose(1, 20)], None)
    assert [r["lang_pred"] for r in language.language_report(unlabelled).collect()] == ["und"]
    assert language.language_report(empty(spark)).collect() == []


def test_sample_is_bounded_with_a_hot_language(spark):
    from tidepool.llm.common import smallest

    df = spark.range(0, 30_000).selectExpr("CASE WHEN id % 10 < 9 THEN 'hot' ELSE 'rare' END AS lang", "xxhash64(id) AS h")
    assert sorted((r["lang"], r["count"]) for r in smallest(df, "lang", "h", 500).groupBy("lang").count().collect()) == [("hot", 500), ("rare", 500)]


def test_query_on_the_given_table(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{TABLE}/documents.parquet").collect()}
    rows = QUERIES["op9_language"](spark, TABLE).collect()
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and len(out) > 100
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in out]) > 0.95
