"""Nested data: build bounded arrays, explode them, flatten structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.time import epoch_to_string

#: Rows of one key that one task may gather before they are cut into parts.
ROWS_PER_BLOCK = 4096


def nest_rows(df: DataFrame, *, key: str, part: str, item: str, array: str, size: int) -> DataFrame:
    """Group ``item`` values into arrays of at most ``size``, one for each
    (``key``, ``part``).

    Keys of more than ROWS_PER_BLOCK rows (counted map-side first) are dealt into blocks by
    the hash of the item, so no task gathers an unbounded array; each block's
    sorted items are cut into parts. The part is 0 for a key of up to
    ``size`` rows; else the block and the place in it make its number. The
    hash is of the row itself, so a task that is run again deals out the same;
    only copies of one and the same row share a block however many they are.

    Only these large keys (at most one for ROWS_PER_BLOCK rows, so they are
    broadcast) are shuffled by block. The others are one block each, and are gathered by
    key alone: rows that lie by the key already, and a join of the result on
    it, need no shuffle.
    """
    large = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > ROWS_PER_BLOCK)
    large = F.broadcast(large.select("_key", F.ceil(F.col("_n") / F.lit(ROWS_PER_BLOCK)).alias("_blocks")))
    same = df[key].eqNullSafe(large["_key"])
    gathered = F.array_sort(F.collect_list(item)).alias("_all")
    rest = df.join(large, same, "left_anti").groupBy(key).agg(gathered).select(key, F.lit(0).cast("bigint").alias("_block"), "_all")
    # the semi join first: it goes below the joins that made the rows
    dealt = df.join(large, same, "left_semi").join(large, same, "inner").select(key, item, F.pmod(F.xxhash64(item), F.col("_blocks")).alias("_block"))
    dealt = dealt.repartition(F.col(key), F.col("_block")).groupBy(key, "_block").agg(gathered)
    # cut after the union: without large keys AQE drops the empty side below
    arrays = rest.unionByName(dealt)
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / F.lit(size)).cast("int")), lambda i: F.slice("_all", i * size + 1, size))
    cut = arrays.select(key, "_block", F.posexplode(parts).alias("_place", array))
    return cut.select(key, (F.col("_block") * (1 << 20) + F.col("_place")).cast("bigint").alias(part), array)


def explode_items(
    df: DataFrame,
    *,
    array: str = "players",
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per array element, element fields as columns.

    NULL and empty arrays give no row. With ``fields`` only those element
    fields are read: ``arrays_zip(players.a, players.b)`` keeps the parquet
    read schema pruned to them, where exploding whole elements and then
    picking fields reads every field of the element.
    """
    if fields:
        zipped = F.arrays_zip(*[F.col(f"{array}.{f}").alias(f) for f in fields])
        src: Column = zipped
    else:
        src = F.col(array)
    exploded = df.select(*keep, F.explode(src).alias("_item"))
    return exploded.select(*keep, "_item.*")


def explode_players(
    details: DataFrame,
    *,
    array: str = "players",
    start: str = "start_time",
    fields: Sequence[str] | None = None,
    time_col: str = "td_match",
    ts_col: str | None = None,
) -> DataFrame:
    """Player table from match documents: ``player.*`` plus the start time
    as ``yyyy-MM-dd HH:mm:ss`` text (session time zone). ``ts_col`` adds the
    same instant as a TIMESTAMP so later window filters push down."""
    if fields is not None and start not in fields:
        fields = list(fields) + [start]
    flat = explode_items(details, array=array, fields=fields)
    flat = flat.withColumn(time_col, epoch_to_string(F.col(start)))
    if ts_col:
        flat = flat.withColumn(ts_col, F.timestamp_seconds(F.col(start)))
    return flat


def flatten_structs(
    df: DataFrame, structs: Sequence[str], keep: Sequence[str] = (), prefix: bool = True
) -> DataFrame:
    """Expand struct columns into top-level columns (``league.*``), named
    ``<struct>_<field>`` when ``prefix`` so sibling structs cannot clash."""
    cols = [F.col(k) for k in keep]
    for s in structs:
        st = df.schema[s].dataType
        for f in st.fields:
            name = f"{s}_{f.name}" if prefix else f.name
            cols.append(F.col(s).getField(f.name).alias(name))
    return df.select(*cols)
