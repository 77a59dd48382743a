"""JSON documents: fixed schemas, scans, landing.

A fixed schema makes the scan deterministic and skips inference (which
reads the whole directory twice). Under the default PERMISSIVE mode Spark
drops unknown keys, reads missing keys as NULL, nulls only a wrong-typed
field (also inside arrays of structs), keeps a number read as string as its
text, and turns a broken document into one all-NULL row -- which the
payload filter on the key removes.
"""

from __future__ import annotations

import json
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import read_text, write_text


def match_document_schema() -> T.StructType:
    """Fixed schema of the stand-in match documents (see plans/standin.py),
    shipped with the package."""
    text = resources.files("tidepool.sources").joinpath("schemas/match_document.json").read_text()
    return T.StructType.fromJson(json.loads(text))


def schema_from_json(path: str, spark: SparkSession) -> T.StructType:
    """Load a ``StructType`` saved as JSON (``schema.json()``) from the file
    system that the path names."""
    return T.StructType.fromJson(json.loads(read_text(spark, path)))


def schema_to_json(schema: T.StructType, path: str, spark: SparkSession) -> None:
    """Save a schema as JSON next to the data it describes."""
    write_text(spark, path, json.dumps(schema.jsonValue(), indent=1))


def read_json_docs(
    spark: SparkSession, path: str, schema: T.StructType | str, key: str | None = "match_id"
) -> DataFrame:
    """Scan a directory of JSON-lines files under a fixed schema (a
    ``StructType`` or DDL text). With
    ``key``, documents without it (including broken files) are dropped."""
    df = spark.read.schema(schema).json(path)
    if key:
        df = df.filter(F.col(key).isNotNull())
    return df


def parse_json_column(df: DataFrame, column: str, schema: T.DataType, alias: str | None = None) -> DataFrame:
    """The same fixed-schema parse on a text column (``from_json``)."""
    return df.withColumn(alias or column, F.from_json(F.col(column), schema))


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON document per row, in a single ``value`` text column."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def land_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Write rows as JSON-lines documents, many per file, in parallel.

    Where the reference dumps one file per document from the driver, each
    task here writes its partition as one file."""
    writer = to_json_lines(df).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
