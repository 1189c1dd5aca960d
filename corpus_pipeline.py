"""The corpus pipeline: five operators, one after another, over documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from weftline.llm.common import drop, table
from weftline.llm.decontam import stage_decontaminate
from weftline.llm.langid import stage_language
from weftline.llm.linededup import stage_lines
from weftline.llm.mixing import stage_mix
from weftline.llm.neardup import stage_near_duplicates
from weftline.session import drop_at_exit, shared_folder

#: Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs.
STAGES = [
    ("language_id", stage_language),
    ("line_dedup", stage_lines),
    ("near_dedup", stage_near_duplicates),
    ("decontamination", stage_decontaminate),
    ("mixing", stage_mix),
]

#: Language identification is a fitted model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result but the last is written and read again.

    A stage's table goes once the next one is written; the last goes at the driver's end.
    Null and wordless texts leave with language identification; an empty table stays empty.
    """
    docs, written = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        drop_at_exit(spark, path)
        stage(spark, docs, sf_dir).write.parquet(path)
        if written:
            drop(spark, written)
        docs, written = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
