"""A reproducible shuffle into shards by a Feistel permutation (native).

Rows get gapless global row numbers in the order of (id, text checksum, size)
and a keyed permutation of 0..N-1 sends row number g to position p: shard
p mod S, slot p div S. The law ``rows`` holds: shard sizes differ by at most
one, slots are gapless from 0. Shard and slot of any row number can be
computed without the data, and the row number of any (shard, slot) too.

The permutation is a Feistel network over 2^b numbers, the smallest power of
two that holds N, with cycle walking: a position outside 0..N-1 is permuted
again until it falls inside. Each step leaves fewer than half of the numbers
outside, and a walk of more than WALK steps raises an error instead of
giving a wrong place (below 2^-60 for 10^12 rows).

Row numbers need no single-task window: a range-partitioned sort of slim rows
(no text), written once, then one count per written partition (bounded by the
partition count) with a running sum, joined back.

Defined cases: a null text has size 16 and the checksum of no bytes (0); null
ids sort first; equal rows are told apart by their place in the input and get
places of their own (they are interchangeable); an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import whole_text, written

ROUNDS = 4
WALK = 128
SEED = 20_240_607
#: Bytes that each row counts besides its text.
ROW_BYTES = 16
MASK32 = (1 << 32) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """Round keys: successive 31-bit numbers of a linear congruence."""
    keys, x = [], seed & MASK32
    for _ in range(rounds):
        x = (x * 1_664_525 + 1_013_904_223) & MASK32
        keys.append(x >> 1)
    return keys


def bits_for(n: int) -> int:
    """Bits of the smallest power of two that holds n numbers (2 at least)."""
    return max(2, (max(1, n) - 1).bit_length())


def _mix(x, key: int):
    """Round function on numbers or columns below 2^31: a 31-bit hash."""
    y = (x * 0x2C1B3C6D + key) & 0x7FFFFFFF
    return (y * 0x297A2D39 + (y >> 15)) & 0x7FFFFFFF


def _mix_col(x: Column, key: int) -> Column:
    mask = F.lit(0x7FFFFFFF).cast("long")
    y = (x * F.lit(0x2C1B3C6D).cast("long") + F.lit(key).cast("long")).bitwiseAND(mask)
    return (y * F.lit(0x297A2D39).cast("long") + F.shiftright(y, 15)).bitwiseAND(mask)


def _widths(bits: int, r: int) -> tuple[int, int]:
    """(left, right) bits before round r; the halves change places each round."""
    small, large = bits // 2, bits - bits // 2
    return (small, large) if r % 2 == 0 else (large, small)


def permute_once(x: int, bits: int, keys: list[int]) -> int:
    """One pass of the Feistel network over 0..2^bits-1 (Python numbers)."""
    for r, key in enumerate(keys):
        left, right = _widths(bits, r)
        a, b = x >> right, x & ((1 << right) - 1)
        x = (b << left) | (a ^ (_mix(b, key) >> 3 & ((1 << left) - 1)))
    return x


def invert_once(x: int, bits: int, keys: list[int]) -> int:
    for r in reversed(range(len(keys))):
        left, right = _widths(bits, r)
        b, a = x >> left, x & ((1 << left) - 1)
        x = ((a ^ (_mix(b, keys[r]) >> 3 & ((1 << left) - 1))) << right) | b
    return x


def place_of(g: int, n: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of row number g of n, without the data."""
    bits, keys = bits_for(n), round_keys(seed)
    x = permute_once(g, bits, keys)
    while x >= n:
        x = permute_once(x, bits, keys)
    return x % shards, x // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = SEED) -> int:
    """The row number at (shard, slot): the inverse of ``place_of``."""
    bits, keys = bits_for(n), round_keys(seed)
    x = invert_once(slot * shards + shard, bits, keys)
    while x >= n:
        x = invert_once(x, bits, keys)
    return x


def _permute_col(x: Column, bits: int, keys: list[int]) -> Column:
    for r, key in enumerate(keys):
        left, right = _widths(bits, r)
        a, b = F.shiftright(x, right), x.bitwiseAND(F.lit((1 << right) - 1).cast("long"))
        f = F.shiftright(_mix_col(b, key), 3).bitwiseAND(F.lit((1 << left) - 1).cast("long"))
        x = F.shiftleft(b, left).bitwiseOR(a.bitwiseXOR(f))
    return x


def permuted(g: Column, n: int, seed: int = SEED) -> Column:
    """The position 0..n-1 of row number ``g``, by cycle walking."""
    bits, keys = bits_for(n), round_keys(seed)
    if bits > 56:
        raise ValueError("more than 2^56 rows")
    size = F.lit(n).cast("long")
    step = lambda x: _permute_col(x, bits, keys)
    first = step(g.cast("long"))
    walked = F.aggregate(F.array_repeat(first, WALK), first, lambda x, _: F.when(x < size, x).otherwise(step(x)))
    return F.when(first < size, first).when(walked < size, walked).otherwise(
        F.raise_error(F.lit("a cycle walk did not end: take another seed")).cast("long"))


def numbered(df: DataFrame, order: list[str], out: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with gapless row numbers from 0 in the order of ``order`` (equal
    rows by their place in the input), and the number of rows."""
    slim = df.withColumn("_place", F.monotonically_increasing_id())
    ranged = slim.orderBy(*order, "_place").drop("_place")
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    kept = written(ranged.withColumns({"_part": F.spark_partition_id(), "_in": inside}), "numbered")
    # one row a partition: bounded by the number of partitions, not by the rows
    parts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    running = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("_part", F.coalesce(running, F.lit(0)).alias("_start"))
    n = parts.agg(F.sum("_n")).first()[0] or 0
    return kept.join(starts, "_part").withColumn(out, F.col("_start") + F.col("_in")).drop("_part", "_in", "_start"), n


def shard_plan(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Shard and slot of every row, with its size and text checksum."""
    if shards < 1:
        raise ValueError("shards must be positive")
    text = whole_text(text_col)
    slim = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"))
    rows, n = numbered(slim, ["doc_id", "text_crc32", "size"])
    p = F.col("_p")
    return rows.withColumn("_p", permuted(F.col("row_number"), n, seed)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (p % shards).cast("int").alias("shard"),
        F.floor(p / F.lit(shards)).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number")
