"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import scratch_path

# One row in HOLD_OUT_FOLDS is held out of every fit: crc32(id as text) mod 5 = 0.
HOLD_OUT_FOLDS = 5


#: Bytes of rows that go to Python at once. Spark's own limits are 10,000 rows and
#: 64 MB; both sides hold a batch and its results whole.
BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> None:
    """Let no batch of rows for Python exceed about BATCH_BYTES, in the session of ``df``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row stays out of every fit (a null id counts as the text '')."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % HOLD_OUT_FOLDS) == 0


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can see, so a lost
    executor costs its own tasks and never an earlier stage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_of(df: DataFrame, **more: Column) -> DataFrame:
    """Every row of ``df`` as one struct ``_row``, plus the given columns: none
    of its columns can clash with theirs. ``select("_row.*")`` gives it back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in more.items()])


#: Values whose counts are broadcast; with more of them no one holds much of a sample.
FEW_VALUES = 10_000
#: Ranges of the order that the rows of a value near its sample are cut into.
RANGES = 256


def smallest(df: DataFrame, by: str, order: str, k: int) -> DataFrame:
    """At most ``k`` rows of each value of ``by``, those with the smallest
    ``order`` (a 64-bit hash). Rows whose hash cannot be among them are dropped
    first, by the counts of the values, looked at before they are broadcast: about
    2 * k rows of a value are left, however many it has. Those are cut into RANGES of
    the order; counts of the ranges say which are whole in the sample, and only
    rows of one range of one value are ranked in one task."""
    counts = written(df.groupBy(by).agg(F.count(F.lit(1)).alias("_n")), "counts")
    few = counts.limit(FEW_VALUES + 1).count() <= FEW_VALUES
    place = F.pmod(F.col(order), F.lit(1 << 52))
    share = place.cast("double") * F.col("_n") / F.lit(2.0 * k * (1 << 52))
    near = df.join(F.broadcast(counts) if few else counts, by).withColumn("_p", F.floor(share * RANGES)).where(F.col("_p") < RANGES)
    near = written(near.drop("_n"), "near")
    # one row for each value and range
    sums = Window.partitionBy(by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ranges = near.groupBy(by, "_p").agg(F.count(F.lit(1)).alias("_c")).withColumn("_before", F.coalesce(F.sum("_c").over(sums), F.lit(0)))
    rows = near.join(ranges.where(F.col("_before") < k).drop("_c"), [by, "_p"])
    rank = F.row_number().over(Window.partitionBy(by, "_p").orderBy(place, order))
    return rows.withColumn("_r", rank).where(F.col("_r") + F.col("_before") <= k).drop("_r", "_before", "_p")


def free_name(taken: Sequence[str], name: str) -> str:
    """A column name that does not clash (case-insensitively) with ``taken``."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def with_struct(df: DataFrame, udf_col: Column, fields: Sequence[str]) -> DataFrame:
    """``df`` plus the named fields of a struct column, evaluated once."""
    tmp = free_name([*df.columns, *fields], "_s")
    kept = [c for c in df.columns if c.lower() not in {f.lower() for f in fields}]
    out = df.withColumn(tmp, udf_col)
    return out.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{tmp}`.`{f}`").alias(f) for f in fields])


def long_fields(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])
