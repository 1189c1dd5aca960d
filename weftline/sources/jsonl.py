"""JSON lines in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def read(spark: SparkSession, path: str, schema: T.StructType | str, tolerant: bool = False) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped and a missing file is an empty table.

    Strict reading fails on a malformed line; tolerant reading drops malformed
    lines and lines that hold no object.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = spark.read.text(path).filter(F.trim("value").startswith("{")).filter(F.try_parse_json("value").isNotNull())
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A file that holds one JSON value (an array gives a row for each object); a missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def numbered(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of a JSON-lines file with ``ord``, which grows in input order (Spark numbers the parts of a file in their order)."""
    return read(spark, path, schema).withColumn("ord", F.monotonically_increasing_id())


def load(spark: SparkSession, path: str, schema) -> DataFrame:
    """By suffix: .jsonl as lines, anything else as a document."""
    return read(spark, path, schema) if path.endswith(".jsonl") else read_document(spark, path, schema)


def ordered_head(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first n rows in input order."""
    return df.orderBy(order).limit(n)


def write(df: DataFrame, path: str, single: bool = False) -> None:
    """Overwrites with JSON lines; null fields are kept.  ``single`` is for small exports only."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("ignoreNullFields", False).json(path)
