"""Documents that a fixed-schema scan drops, kept with their text and file.

:func:`tidepool.sources.json_docs.read_json_docs` keeps the documents that have a
key. The others -- broken JSON, and JSON without the key -- are dropped there
without a trace; here they are found by the same parser under the key's own field of the
schema and kept in a table of their own, so a load can be reconciled:
documents landed = documents loaded + documents in quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Why a document is in quarantine.
BROKEN, KEYLESS = "broken", "no key"


def broken_documents(spark: SparkSession, raw_dir: str, schema: T.StructType, key: str = "match_id") -> DataFrame:
    """(file, text, reason) of the documents under ``raw_dir`` without a key
    under ``schema``. Only the key is parsed; blank lines are no documents."""
    field = next(f for f in schema.fields if f.name.lower() == key.lower())
    bad = "_broken"
    parsed = F.from_json("value", T.StructType([field, T.StructField(bad, T.StringType())]), {"columnNameOfCorruptRecord": bad})
    lines = spark.read.text(raw_dir).select(F.col("_metadata.file_path").alias("file"), "value").where(F.length(F.trim("value")) > 0)
    read = lines.withColumn("_doc", parsed)
    reason = F.when(F.col(f"_doc.{bad}").isNotNull() | F.col("_doc").isNull(), F.lit(BROKEN)).otherwise(F.lit(KEYLESS))
    return read.where(F.col(f"_doc.`{field.name}`").isNull()).select("file", F.col("value").alias("text"), reason.alias("reason"))


def quarantine(spark: SparkSession, raw_dir: str, schema: T.StructType, table_path: str, load: str, key: str = "match_id") -> dict[str, int]:
    """Write a load's dropped documents under ``table_path`` (one folder for each
    load, written anew if the load is repeated); how many there are for each reason,
    counted in the write itself."""
    from pyspark.sql import Observation

    seen = Observation()
    found = broken_documents(spark, raw_dir, schema, key).observe(
        seen, F.count_if(F.col("reason") == BROKEN).alias(BROKEN), F.count_if(F.col("reason") == KEYLESS).alias(KEYLESS))
    found.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/load={load}")
    return {r: int(seen.get[r]) for r in (BROKEN, KEYLESS)}
