"""Small tables for the tests of the training-data operators."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SMALL = "/root/testdata/sf0.001"

SYLLABLES = {"en": "the in ing er on at re tion ed and", "de": "sch ein ich ung keit der ver zu ach pf", "fr": "ou eau les que aux ion ent tre"}


def prose(seed: int, n: int, lang: str = "en") -> str:
    r = random.Random(seed)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(r.choices(parts, k=r.randint(1, 3))) for _ in range(n))


def documents(spark, texts, lang="en", first=0):
    rows = [(first + i, t, lang, "src0", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


EDGE_TEXTS = [None, "", " ", "\n\t", "a", "....", "日本語 テキスト", "\0x", "é" * 50, "word " * 12_000, "x" * 70_000]
