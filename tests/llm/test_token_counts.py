import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from llm_data import EDGE_TEXTS, documents, empty
from tidepool.llm import pieces, token_counts
from tidepool.llm.common import BATCH_BYTES
from tidepool.llm.queries import QUERIES
from llm_data import SMALL

PARTS = [" ", "  ", "a", "the", " the", "\n", "\t", "▁", "é", "日", "本", "<s>", "</s>", "<0x0A>", "x", "\0", "😀", "ing", "qu", "1", "23", "...", "    "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))


def odd_texts(n, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)] + ["a" * 2000, " " * 100, "the" * 300]


def test_counts_equal_the_library(spark, library):
    texts = EDGE_TEXTS + odd_texts(300)
    got = {r["doc_id"]: r for r in token_counts.token_report(documents(spark, texts), limit=100).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or ""))
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 100)


def test_small_cache_changes_nothing(library):
    model = token_counts.model_bytes()
    for frequent in ([], ["the", "a", "", " x"]):
        lengths = token_counts.Lengths(model, token_counts.frequent_lengths(model, frequent), entries=8)
        for t in odd_texts(2000):
            assert lengths.count(t) == len(library.encode(t))
        assert len(lengths.new) + len(lengths.old) < 60


def test_tier_one_holds_the_frequent_words_and_is_bounded(spark):
    texts = [f"often seen word{k} " + "often " * 3 + "seen" for k in range(500)] + [None, "", "x" * 500]
    df = documents(spark, texts).repartition(4)
    words = token_counts.frequent_words(df)
    assert words[:2] == ["often", "seen"] and len(words) == len(set(words)) and "x" * 500 not in words
    few = token_counts.frequent_words(df, per_batch=2, pairs=6)
    assert set(few) == {"often", "seen"}
    assert len(token_counts.frequent_words(df, pairs=7)) <= 7
    assert token_counts.frequent_words(empty(spark)) == []


def test_repeated_rows_and_empty_table(spark):
    twice = documents(spark, ["a b", "a b"]).unionAll(documents(spark, ["a b"]))
    assert sorted(r["doc_id"] for r in token_counts.token_report(twice).collect()) == [0, 0, 1]
    assert token_counts.token_report(empty(spark)).collect() == []


def test_clashing_columns_are_replaced(spark):
    df = documents(spark, ["one two"]).selectExpr("*", "'x' AS n_tokens", "1 AS ids", "2 AS decoded")
    assert token_counts.with_token_counts(df).first()["n_tokens"] == 2
    row = pieces.with_pieces(df).first()
    assert row["decoded"] == "one two" and row["n_tokens"] == "x"


def test_pieces_equal_the_library_and_read_back(spark, library):
    texts = EDGE_TEXTS + odd_texts(400, seed=9)
    got = {r["doc_id"]: r for r in pieces.piece_report(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["round_trip"] == (library.decode(ids) == (t or ""))
    assert pieces.piece_report(empty(spark)).collect() == []


def test_pieces_with_tiny_chunks_and_cache(library, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 40)
    monkeypatch.setattr(pieces, "INDEX_CHARS", 7)
    vocabulary = pieces.Vocabulary(token_counts.model_bytes())
    encoder = pieces.Encoder(vocabulary, entries=4)
    texts = odd_texts(300, seed=11)
    for t, ids in zip(texts, encoder.texts(texts)):
        assert ids.tolist() == library.encode(t)
        assert pieces.decode(ids.tolist(), vocabulary) == library.decode(ids.tolist())


def test_suffix_array_and_search():
    import numpy as np

    codes = np.array([1, 2, 1, 2, 1, 0, 2, 1, 0], np.uint16)
    keys = pieces.sort_keys(codes, 8)
    order = pieces.suffix_array(keys)
    padded = [tuple(list(codes[i:]) + [0] * 20)[:8] for i in range(len(codes))]
    assert [padded[i] for i in order] == sorted(padded)
    assert pieces.search(keys[:, order], keys[:, :1])[0] == sorted(padded).index(padded[0])


def test_queries_cover_the_table(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op2_token_counts"](spark, SMALL).collect()}
    ids = {r["doc_id"]: r["ids"] for r in QUERIES["op6_pieces"](spark, SMALL).collect()}
    assert counts.keys() == ids.keys() == texts.keys()
    for i, t in texts.items():
        assert ids[i] == library.encode(t) and counts[i] == len(ids[i])


def test_batches_for_the_pieces_are_bounded_in_bytes(spark):
    def batch_bytes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(conf)
    try:
        df = documents(spark, [f"word{i} " * 400 for i in range(4000)]).coalesce(1)
        assert pieces.with_pieces(df).where(F.size("ids") > 0).count() == 4000
        sizes = [r["n"] for r in df.select("text").mapInArrow(batch_bytes, "n long").collect()]
        assert len(sizes) > 2 and max(sizes) < 2 * BATCH_BYTES
    finally:
        spark.conf.set(conf, before)
