"""Token counts by a two-tier lookup of pre-token lengths, on the map side.

A text is cut into pre-tokens before each run of spaces. In a SentencePiece
BPE vocabulary in which no piece has the space mark after another character
(checked when the table is built), no merge crosses such a cut, so the token
count of a text is the sum over its pre-tokens.

Tier 1 is a compact table pre-token -> length, broadcast once. It holds the
most frequent pre-tokens of a bounded sample of the texts: tasks count the
pre-tokens of their batches and hand on the most frequent PER_BATCH of each; the
first SAMPLE_PAIRS such pairs are read (from as few partitions as yield them),
added up, and encoded by the library. It never grows with the input, and
decides the speed only: whatever it lacks is tier 2, a bounded cache in each
Python worker, for which the library encodes a pre-token once per worker and
cache generation. No pre-tokens are shuffled.

Defined cases: a null text counts as empty, an empty text has 0 tokens and 0
bytes, special strings inside a text are ordinary text (the library's
default), repeated rows are counted each for themselves, columns named like
the results are replaced, an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import whole_text

MARK = "▁"  # SentencePiece's space
MODEL = "piece_bpe_32k.model"
#: Most (pre-token, count) pairs that a batch of the sample hands on, and that are read in all.
PER_BATCH = 8_192
SAMPLE_PAIRS = 16_384
#: Pre-tokens longer than this are encoded each time and never cached.
LONGEST_CACHED = 64
#: Most pre-tokens that a worker keeps; when full, the older half goes.
CACHE_ENTRIES = 400_000

_RUN = re.compile(" +[^ ]*")
_worker: dict[int, "Lengths"] = {}


def model_bytes(model: str = MODEL) -> bytes:
    """The vocabulary file of a public tokenizer (read once, on the driver)."""
    import public_tokenizers

    with open(public_tokenizers.path(model), "rb") as f:
        return f.read()


def pre_tokens(text: str) -> list[str]:
    """The text's pre-tokens, each without its first space: the library puts
    one space mark before whatever it encodes."""
    text = text.replace(MARK, " ")
    words = text.split(" ")
    return [w[1:] for w in _RUN.findall(" " + text)] if "" in words else words


def frequent_words(df: DataFrame, text_col: str = "text", per_batch: int = PER_BATCH, pairs: int = SAMPLE_PAIRS) -> list[str]:
    """The most frequent pre-tokens of a sample, at most ``pairs``, in
    descending order of their counts."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for t in batch["text"]:
                seen.update(w for w in pre_tokens(t) if len(w) <= LONGEST_CACHED) if t else None
            top = seen.most_common(per_batch)
            yield pd.DataFrame({"word": [w for w, _ in top], "n": [n for _, n in top]})

    total: Counter[str] = Counter()
    for r in df.select(whole_text(text_col).alias("text")).mapInPandas(counts, "word string, n long").take(pairs):
        total[r["word"]] += r["n"]
    return [w for w, _ in total.most_common()]


def frequent_lengths(model: bytes, words: list[str]) -> dict[str, int]:
    """Tier 1: the given pre-tokens and their lengths in tokens, and always the
    key '', a lone space mark.

    Raises if a piece of the vocabulary spans two pre-tokens, for then
    lengths would not add up.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    if any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size())):
        raise ValueError("a piece holds a space after another character: pre-token lengths do not add up")
    words = [w for w in words if w]
    return {"": 1} | (dict(zip(words, map(len, sp.encode(words, num_threads=1)))) if words else {})


class Lengths:
    """Pre-token -> number of tokens: the frequent table, then two bounded
    cache generations, then the library."""

    def __init__(self, model: bytes, frequent: dict[str, int], entries: int = CACHE_ENTRIES):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.frequent, self.new, self.old, self.room = frequent, {}, {}, max(1, entries // 2)

    def encode(self, missing: list[str]) -> dict[str, int]:
        got = {w: len(ids) for w, ids in zip(missing, self.sp.encode(missing, num_threads=1))}
        if len(self.new) >= self.room:
            self.old, self.new = self.new, {}
        self.new.update((w, n) for w, n in got.items() if len(w) <= LONGEST_CACHED)
        return got

    def count(self, text: str) -> int:
        """Tokens of one whole text."""
        if not text:
            return 0
        frequent, new, old = self.frequent, self.new, self.old
        total, missing = 0, []
        for w in pre_tokens(text):
            n = frequent.get(w) or new.get(w) or old.get(w)
            if n is None:
                missing.append(w)
            else:
                total += n
        if missing:
            got = self.encode(list(dict.fromkeys(missing)))
            total += sum(map(got.__getitem__, missing))
        return total


def with_token_counts(df: DataFrame, text_col: str = "text", model: str = MODEL, out: str = "n_tokens") -> DataFrame:
    """``df`` plus the number of tokens of each whole text."""
    sc = df.sparkSession.sparkContext
    proto = model_bytes(model)
    shared = sc.broadcast((proto, frequent_lengths(proto, frequent_words(df, text_col))))

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        key = id(shared.value[1])  # held by Lengths, so no other object has it
        lengths = _worker.get(key)
        if lengths is None:
            _worker.clear()
            lengths = _worker[key] = Lengths(*shared.value)
        for batch in texts:
            yield pd.Series([lengths.count(t) for t in batch], dtype="int64")

    return df.withColumn(out, count(whole_text(text_col)))


def token_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, model: str = MODEL) -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens, and whether the tokens exceed ``limit``."""
    counted = with_token_counts(df.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")), "text", model)
    return counted.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
