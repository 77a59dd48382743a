import corpus_pipeline
from llm_data import EDGE_TEXTS, documents, prose
from tidepool.llm import language, near_dedup, pieces, token_counts, toxicity
from test_decontaminate import brute as leaks
from test_near_dedup import brute, shingle_set

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, path):
    """Two languages, toxic texts, copies, benchmark passages and odd rows."""
    item = prose(900, 30)
    df = documents(spark, [prose(k, 60) for k in range(50)])
    df = df.unionAll(documents(spark, [prose(k, 60, "de") for k in range(50)], "de", first=100))
    df = df.unionAll(documents(spark, [prose(300 + k, 50) + " you rotten fool" for k in range(40)], first=200))
    df = df.unionAll(documents(spark, [prose(k, 60) + " again" for k in range(10)], first=300))  # near copies
    df = df.unionAll(documents(spark, [f"{prose(400 + k, 30)} {item}" for k in range(3)], first=400))  # leaks
    df = df.unionAll(documents(spark, EDGE_TEXTS, None, first=500))
    df.write.parquet(f"{path}/documents.parquet")
    toxic = [(k, 1, 0) for k in range(50)] + [(100 + k, 1, 0) for k in range(50)] + [(200 + k, 0, 1) for k in range(40)]
    spark.createDataFrame(toxic, LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_pipeline_against_a_plain_version(spark, scratch):
    path = scratch("pipeline")
    docs = corpus(spark, path)
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = spark.read.parquet(f"{path}/labels.parquet")

    # the same decisions row by row, with the models fitted on each stage's input
    model = language.fit(docs)
    left = {}
    for i, t in texts.items():
        lang, _, coverage, n = model.decide(t)
        if lang != "und" and (coverage >= language.LEAST_COVERAGE or n < language.FEW_GRAMS):
            left[i] = t
    assert all(k in left for k in range(50)) and 501 not in left and 505 not in left
    frame = lambda x: spark.createDataFrame([(i, t, None, None, None) for i, t in x.items()], docs.schema)
    known = docs.join(frame(left).select("doc_id"), "doc_id", "left_semi").select(*columns)
    judge = toxicity.fit(known, labels)
    left = {i: t for i, t in left.items() if judge.score(toxicity.words(t)) < 0.5}
    assert not any(200 <= i < 240 for i in left) and all(k in left for k in range(50))
    left = {i: left[i] for i, (c, _) in brute(left).items() if i == c}
    assert not any(300 <= i < 310 for i in left)
    leaking = {d for d, _ in leaks(left, {1: prose(900, 30)})}
    left = {i: t for i, t in left.items() if i not in leaking}
    assert not any(400 <= i < 403 for i in left)
    encoder = pieces.Encoder(pieces.Vocabulary(token_counts.model_bytes()))
    want = {i: ids.tolist() for i, ids in zip(left, encoder.texts(list(left.values())))}

    stage, seen = docs, []
    for name, function in corpus_pipeline.STAGES:
        stage = function(spark, stage, path)
        seen.append(name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert stage.columns == columns
            stage.write.parquet(f"{path}/{name}")
            stage = spark.read.parquet(f"{path}/{name}")
    rows = corpus_pipeline.run(spark, path).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == want == {r["doc_id"]: r["ids"] for r in stage.collect()}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert len(seen) == 5


def test_pipeline_over_an_empty_table(spark, scratch):
    path = scratch("nothing")
    documents(spark, []).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


def test_near_dedup_stage_links_from_four_fifths(spark):
    # a word replaced in the middle changes five shingles: 49 words make exactly 40 of 50
    texts, stay = {}, set()
    for k, n in enumerate([47, 48, 49, 50, 55, 60, 65, 66, 70] * 3):
        a = prose(2000 + k, n).split()
        b = [*a[: n // 2], f"other{k}", *a[n // 2 + 1 :]]
        texts[2 * k], texts[2 * k + 1] = " ".join(a), " ".join(b)
        x, y = shingle_set(texts[2 * k]), shingle_set(texts[2 * k + 1])
        stay |= {2 * k} if 100 * len(x & y) >= 80 * len(x | y) else {2 * k, 2 * k + 1}
    assert 27 < len(stay) < 54
    docs = documents(spark, list(texts.values()))
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == stay
    # the operator's own limit is another one
    assert {r["doc_id"] for r in near_dedup.keep_one(docs).collect()} == {i for i, (c, _) in brute(texts).items() if i == c} > stay
