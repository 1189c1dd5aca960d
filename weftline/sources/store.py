"""Checkpoint files of a stage: JSON-lines tables and JSON documents below one folder of any file system that Spark writes."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import jsonl

#: Rows of a kept file: what one task wrote is read by all cores, as rows behind it are long to work on.
FILE_ROWS = 10_000


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.kept = spark, path.rstrip("/"), 0

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` as a table that is not computed again (a model call must never be)."""
        self.kept += 1
        path = self.at(f"kept/{self.kept:05d}")
        df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write(self, name: str, df: DataFrame) -> None:
        jsonl.write(df, self.at(name))

    def append(self, name: str, df: DataFrame) -> None:
        """Adds to a log of reports or failures."""
        df.write.mode("append").option("ignoreNullFields", False).json(self.at(name))

    def read(self, name: str, schema: T.StructType | str) -> DataFrame:
        return jsonl.read(self.spark, self.at(name), schema, tolerant=True)

    def document(self, name: str, payload: dict) -> None:
        held = self.spark._jvm.org.apache.hadoop.fs.Path(self.at(name))
        out = held.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(held, True)
        out.write(bytearray(json.dumps(payload, ensure_ascii=False, indent=2).encode()))
        out.close()

    def complete(self, names: Iterable[str]) -> bool:
        """Whether all outputs are there and hold something, so that the stage can be passed over."""
        return all(jsonl.exists(self.spark, self.at(n)) and self.spark.read.text(self.at(n)).limit(1).count() for n in names)

    def round(self, name: str, turn: int, tables: dict[str, DataFrame], summary: dict) -> None:
        """The files of one round, and its summary."""
        for kind, df in tables.items():
            self.write(f"{name}.rounds/round_{turn:03d}.{kind}.jsonl", df)
        self.document(f"{name}.rounds/round_{turn:03d}.summary.json", {"round": turn} | summary)


def histogram(df: DataFrame, column: str) -> dict[str, int]:
    """Rows per value of a column of few values (failure types, actions, buckets)."""
    return {r[0]: r[1] for r in df.groupBy(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("unknown"))).count().orderBy("count", ascending=False).collect()}


def export_summary(candidates: int, exported: int) -> dict:
    return {"input_count": candidates, "output_count": exported, "pass_rate": round(exported / max(1, candidates), 4), "format": "instruction/input/output"}
