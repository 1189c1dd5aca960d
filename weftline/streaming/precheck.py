"""The precheck over a stream of candidate files (an addition; stateless)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.validate import Limits, precheck

SCHEMA = "source_task_id string, plan_id string, question string, steps array<string>, answer string"


def candidates(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)


def start(stream: DataFrame, out: str, checkpoint: str, limits: Limits = Limits()) -> StreamingQuery:
    """Writes each candidate with its issues and warnings, exactly once, as Parquet."""
    checked = precheck(stream, limits).select("plan_id", "passed", "issues", "warnings")
    return checked.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
