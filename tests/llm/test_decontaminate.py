import random

from llm_data import EDGE_TEXTS, SMALL, documents, empty, prose
from tidepool.llm import decontaminate
from tidepool.llm.queries import QUERIES

ITEMS = "item_id long, text string"


def bench(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def brute(texts, items):
    """Every placing of every item against every text."""
    out = set()
    for d, text in texts.items():
        a = decontaminate.tokens(text)
        for i, t in items.items():
            b = decontaminate.tokens(t)
            if not b:
                continue
            w, least = decontaminate.need(len(b))
            if any(sum(x == y for x, y in zip(a[p : p + w], b[q : q + w])) >= least for q in range(len(b) - w + 1) for p in range(len(a) - w + 1)):
                out.add((d, i))
    return out


def changed(text, share, seed):
    r = random.Random(seed)
    ws = text.split()
    for k in range(7, len(ws), max(2, round(1 / share))):
        ws[k] = f"zz{r.randint(0, 999)}"
    return " ".join(ws)


def test_masks_lose_no_overlap():
    from itertools import combinations

    masks = [decontaminate.offsets(m) for m in decontaminate.MASKS]
    for length in range(decontaminate.MIN_TOKENS, decontaminate.WINDOW + 1):
        w, least = decontaminate.need(length)
        for bad in combinations(range(w), w - least):
            assert any(not set(bad) & {p + o for o in m} for m in masks for p in range(w - m[-1]))


def best(texts, items):
    """Every placing, with the best window of each text and item."""
    out = set()
    for d, text in texts.items():
        a = decontaminate.tokens(text)
        for i, t in items.items():
            b = decontaminate.tokens(t)
            if b:
                w, least = decontaminate.need(len(b))
                found = [(-agree, p, q) for q in range(len(b) - w + 1) for p in range(len(a) - w + 1)
                         if (agree := sum(x == y for x, y in zip(a[p : p + w], b[q : q + w]))) >= least]
                if found:
                    agree, p, q = min(found)
                    out.add((d, i, p, q, w, -agree))
    return out


def test_best_windows_of_random_texts_with_substitutions_against_brute_force(spark):
    r = random.Random(4)
    word = lambda n: f"w{r.randint(0, n)}"
    items = {k: " ".join(word(9 if k % 3 else 60) for _ in range(r.randint(1, 30))) for k in range(40)}
    texts = {}
    for k in range(120):
        ws = items[r.randrange(40)].split()
        for _ in range(r.randint(0, 4)):
            ws[r.randrange(len(ws))] = word(99)
        texts[k] = " ".join([*(word(60) for _ in range(r.randint(0, 12))), *ws, *(word(60) for _ in range(r.randint(0, 12))), *ws[: r.randint(0, 9)]])
    got = {(x["doc_id"], x["item_id"], x["start"], x["item_start"], x["tokens"], x["agree"])
           for x in decontaminate.leaks(documents(spark, list(texts.values())), bench(spark, list(items.items()))).collect()}
    assert got == best(texts, items) and len(got) > 200


def test_short_items_and_scripts_without_blanks(spark):
    items = {k: " ".join(f"q{k}x{j}" for j in range(k)) for k in range(1, 8)}
    items[10] = "富士山は日本で一番高い山です。"
    items[11] = "日本の首都は東京"
    texts = [f"so {items[k]} it is" for k in range(1, 8)] + [items[5].replace("q5x2", "zz"), "私は富士山は日本で一番高い山ですと思う", "日本の首都は京都", "日本の首都は東京都"]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(spark, texts), bench(spark, list(items.items()))).collect()}
    assert got == {(k - 1, k) for k in range(1, 8)} | {(8, 10), (10, 11)} == brute(dict(enumerate(texts)), items)


def test_planted_passages_are_found_and_clean_texts_are_not(spark):
    items = [(k, prose(7000 + k, 30)) for k in range(12)]
    texts, want = [], set()
    for k in range(60):
        t = prose(k, 80)
        if k % 4 == 0:
            i = k // 4 % 12
            t = f"{prose(k, 20)} {changed(items[i][1], 0.1, k) if k % 8 else items[i][1].upper()}. {prose(k + 500, 20)}"
            want.add((k, i))
        texts.append(t)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(spark, texts), bench(spark, items)).collect()}
    assert got == want
    left = decontaminate.clean(documents(spark, texts), bench(spark, items)).collect()
    assert {r["doc_id"] for r in left} == set(range(60)) - {d for d, _ in want}


def test_query_equals_brute_force_on_the_given_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontamination"](spark, SMALL).collect()}
    assert got == brute(texts, items)


def test_chunks_and_a_full_filter_change_nothing(spark, monkeypatch):
    items = [(k, prose(k, 25)) for k in range(9)]
    docs = documents(spark, [prose(k, 25) + " " + prose(k + 100, 30) for k in range(9)])
    key = lambda df: {r["doc_id"]: sorted(tuple(o) for o in r["overlaps"]) for r in df.select("doc_id", "overlaps").collect()}
    whole = key(decontaminate.with_overlaps(docs, bench(spark, items)))
    monkeypatch.setattr(decontaminate, "BLOOM_BITS", 64)
    monkeypatch.setattr(decontaminate, "BLOOM_HASHES", 1)
    assert key(decontaminate.with_overlaps(docs, bench(spark, items))) == whole and all(len(v) == 1 for v in whole.values())
    cut = [(d, decontaminate.tokens(t)) for d, t in enumerate(["a b", "", "c d e", "f"])]
    monkeypatch.setattr(decontaminate, "CHUNK_TOKENS", 2)
    assert [(doc.tolist(), first.tolist()) for _, doc, first in decontaminate.chunks([" ".join(w) for _, w in cut])] == [
        ([0, 0], [0, 0, 0, 0]), ([2, 2, 2], [0, 0, 0, 0]), ([3], [0, 0, 0, 0])]


def test_benchmark_is_neither_collected_nor_broadcast_by_hand(spark):
    """The join by hash is Spark's own, so its size check holds."""
    items = bench(spark, [(k, prose(k, 25)) for k in range(5)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    docs = documents(spark, [prose(k, 25) for k in range(9)])
    try:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, "-1")
        df = decontaminate.matches(docs, items)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [hash" in plan and "Broadcast" not in plan and df.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", before[1])


def test_edge_cases(spark):
    items = bench(spark, [(1, prose(1, 30)), (2, None), (3, ""), (4, "too short to be there"), (5, prose(1, 30)), (None, prose(6, 30)), (7, "word " * 20)])
    docs = documents(spark, EDGE_TEXTS + [prose(1, 30), prose(1, 30)]).selectExpr("*", "1 AS _overlaps", "2 AS item_id", "3 AS _row", "4 AS overlaps")
    n = len(EDGE_TEXTS)
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect())
    assert got == sorted([(n, 1), (n, 5), (n + 1, 1), (n + 1, 5), (EDGE_TEXTS.index("word " * 12_000), 7)])
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and left.count() == n - 1
    nothing = bench(spark, [(1, None)]).filter("false")
    assert decontaminate.clean(docs, nothing).count() == n + 2 and decontaminate.leaks(docs, nothing).collect() == []
    assert decontaminate.leaks(empty(spark), items).collect() == []
