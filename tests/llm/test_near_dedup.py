import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from llm_data import EDGE_TEXTS, documents, empty, prose
from tidepool.llm import near_dedup
from tidepool.llm.queries import QUERIES

TABLE = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    import re

    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(texts):
    """(component, set size) per document, by comparing all that share a shingle."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in holders[g]).items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                top[b] = a
        for g in s:
            holders[g].append(i)
    return {i: (root(i), len(sets[i])) for i in sets}


def found(spark, df):
    return {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in near_dedup.dedup_report(df).collect()}


def edited(text, n, seed):
    r = random.Random(seed)
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"q{r.randint(0, 10**6)}"
    return " ".join(w)


def test_groups_chains_and_edges_against_brute_force(spark):
    base = [prose(k, 150) for k in range(6)]
    texts = list(base)
    for k in range(120):  # copies of copies: groups in which many pairs are not linked
        texts.append(edited(texts[random.Random(k).randrange(len(texts))], 2, k))
    texts += base[:2] * 20 + [base[0].upper()] + EDGE_TEXTS + ["one two", "ONE two", "one two three", "a b c d e", "a b c d e f"]
    want = brute(dict(enumerate(texts)))
    assert found(spark, documents(spark, texts)) == want
    assert len({c for c, _ in want.values()}) < 110


def test_small_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 7)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 2000)
    texts = [prose(1, 120)]
    for k in range(80):
        texts.append(edited(texts[k // 3], 2, k))
    assert found(spark, documents(spark, texts)) == brute(dict(enumerate(texts)))


def test_pivots_leave_few_blocks_of_a_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 7)
    base = prose(5, 220)
    texts = [base, *[edited(base, 1, k) for k in range(90)], *[prose(50 + k, 80) for k in range(5)]]
    blocks, compare = [], near_dedup._bucket_links

    def counted(members, open_, sets, percent):
        blocks.append(open_.agg(F.coalesce(F.sum(F.col("all") * F.col("other")), F.lit(0))).first()[0])
        return compare(members, open_, sets, percent)

    monkeypatch.setattr(near_dedup, "_bucket_links", counted)
    want = brute(dict(enumerate(texts)))
    assert found(spark, documents(spark, texts)) == want
    with_pivots, blocks[:] = sum(blocks), []
    monkeypatch.setattr(near_dedup, "PIVOTS", 0)
    assert found(spark, documents(spark, texts)) == want
    assert 5 * with_pivots < sum(blocks)


def test_query_equals_brute_force_on_the_given_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TABLE}/documents.parquet").collect()}
    rows = QUERIES["op7_near_dedup"](spark, TABLE).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in rows} == brute(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    sign = lambda s: near_dedup.packed(near_dedup.minima(np.unique(s)))[None, :]
    for share in (0.0, 0.5, 0.85, 1.0):
        both = int(1000 * share)
        a, b = pool[:1000], np.concatenate((pool[:both], pool[2000 : 3000 - both]))
        want = both / (2000 - both)
        assert abs(float(near_dedup.estimates(sign(a), sign(b))[0, 0]) - want) < 0.15


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in near_dedup.components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


def test_repeated_ids_nulls_and_empty_table(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    # document 5 has two texts: one is document 1's, the other document 9's
    rows = [(1, a), (5, a), (5, b), (9, b), (9, b), (None, a), (None, a), (20, c), (20, c), (21, None), (22, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], documents(spark, []).schema)
    got = sorted((r["doc_id"], r["component_id"]) for r in near_dedup.with_components(df).collect() if r["doc_id"] is not None)
    assert got == [(1, 1), (5, 1), (5, 1), (9, 1), (9, 1), (20, 20), (20, 20), (21, 21), (22, 22)]
    odd = df.selectExpr("*", "1 AS _id", "2 AS _row", "3 AS digest", "4 AS component_id")
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.select("doc_id").collect() if r["doc_id"] is not None) == [
        (False, 1), (False, 5), (False, 20), (False, 21), (False, 22)]
    # unlike texts under one id both stay
    two = documents(spark, [a, b]).selectExpr("1L AS doc_id", "text", "lang", "source", "n_chars")
    assert {r["text"] for r in near_dedup.keep_one(two).collect()} == {a, b}
    assert kept.filter(F.col("doc_id").isNull()).count() == 2
    assert near_dedup.dedup_report(empty(spark)).collect() == [] and near_dedup.keep_one(empty(spark)).collect() == []
