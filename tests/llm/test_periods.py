import hashlib
import random
import re
import zlib

import numpy as np

from llm_data import EDGE_TEXTS, SMALL, documents, empty, prose
from tidepool.llm import periods
from tidepool.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_runs(ws):
    """All runs by every period: stretches where words q apart are identical."""
    number = {w: k for k, w in enumerate(dict.fromkeys(ws))}
    a, out, seen = np.array([number[w] for w in ws]), [], set()
    for q in range(1, len(ws) // 4 + 1):
        same = np.concatenate(([False], a[:-q] == a[q:], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            n = e - s + q
            if n >= max(6, 4 * q) and (s, n) not in seen:
                # a smaller period would have given the same stretch before
                seen.add((s, n))
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, damage=True):
    ws = WORD.findall(text or "")
    n, h = len(ws), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if damage and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = brute_runs(ws)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for k, w in enumerate(ws) if k not in gone)))


FIELDS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def answer(df):
    return {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in df.collect()}


def runs(ws):
    number = {w: k for k, w in enumerate(dict.fromkeys(ws))}
    return periods.runs_of(np.array([number[w] for w in ws], np.int64), np.array([len(ws)]))


def test_random_texts_of_few_words_against_brute_force():
    for seed in range(3000):
        r = random.Random(seed)
        ws = "".join(r.choices("ab", k=r.randint(0, 60))) if seed % 3 else "".join("".join(r.choices("abc", k=r.randint(1, 6))) * r.randint(1, 7) for _ in range(4))
        assert runs(ws) == brute_runs(list(ws)), ws


def test_long_periods_nested_runs_and_borders_of_the_classes():
    for q in (1, 2, 5, 6, 7, 20, 21, 22, 23, 65, 66, 67, 68, 150, 201):
        for extra in (-1, 0, 1, q // 2):
            r = random.Random(q)
            block = [f"w{r.randint(0, 5)}" if q > 9 else f"w{k}" for k in range(q)]
            ws = ["x", *(block * 6)[: max(6, 4 * q) + extra], "y", *"zzzzzzz"]
            assert runs(ws) == brute_runs(ws), (q, extra)


def test_documents_of_a_chunk_do_not_meet(spark):
    ws = ["a b c", "a b c a b c", "a b c a b c a b c", "a a a", "a a a a"]
    got = list(periods.found_in([t.encode() for t in ws]))
    assert all(not r for r, _ in got) and [t.decode() for _, t in got] == ws


def test_chunks_of_any_size_give_the_same(spark, monkeypatch):
    texts = [prose(k, 30 + k) + " " + "la li lu " * (k % 7) for k in range(40)]
    whole = list(periods.found_in([t.encode() for t in texts]))
    monkeypatch.setattr(periods, "CHUNK", 50)
    assert list(periods.found_in([t.encode() for t in texts])) == whole


def test_report_against_brute_force(spark):
    texts = EDGE_TEXTS[:9] + ["word " * 3000, "x" * 70_000, "a\x0bb\x1cc\x85d " * 9] + [prose(k, 50 + 9 * k) + " " + prose(k, 3) * (k % 9) for k in range(60)]
    got = answer(periods.period_report(documents(spark, texts)))
    assert got == {k: brute(k, t) for k, t in enumerate(texts)}


def test_nulls_repeats_clashing_columns_and_empty_table(spark):
    df = documents(spark, ["a b " * 9, None])
    twice = df.unionAll(df).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "1 AS runs", "2 AS _row", "3 AS collapsed", "4 AS _h")
    got = [tuple(r[f] for f in FIELDS) for r in periods.period_report(twice).collect()]
    assert sorted(got, key=str) == sorted([brute(None, "a b " * 9), brute(None, None)] * 2, key=str)
    rows = periods.with_runs(twice).collect()
    assert {r["collapsed"] for r in rows} == {"a b", ""} and {len(r["runs"]) for r in rows} == {0, 1}
    assert periods.period_report(empty(spark)).collect() == []


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert answer(QUERIES["op12_periods"](spark, SMALL)) == {i: brute(i, t) for i, t in texts.items()}
