"""The stages of a run, each from files to files, and the run from seeds to training records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import text as T
from ..operators import kb as K
from ..operators import planning as P
from ..operators import quota as Q
from ..operators import review as R
from ..sources import jsonl
from ..sources.store import Folder, export_summary
from . import assess, legacy, rounds
from .backend import Backend

SEEDS = "task_id string, question string, answer string, solution_steps string, question_type string"
BANKS = {"concept_bank": K.concept_bank, "scene_bank": K.scene_bank, "template_bank": K.template_bank, "knowledge_bank": K.knowledge_bank}


def read_seeds(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Seed records in file order, the first ``limit`` of them; the place is the id of a record without one."""
    seeds = jsonl.numbered(spark, path, SEEDS)
    return seeds if limit is None else jsonl.ordered_head(seeds, "ord", limit)


def build_knowledge_base(seeds: DataFrame, folder: Folder, name: str) -> DataFrame:
    """Writes records, banks, their link rows, and a manifest with the counts; returns the records."""
    kb = folder.keep(K.records(seeds))
    folder.write("kb_records.jsonl", kb)
    counts = {"kb_records": kb.count()}
    for bank, made in BANKS.items():
        rows = folder.keep(made(kb))
        folder.write(f"{bank}.jsonl", rows)
        counts[bank] = rows.count()
    folder.write("concept_links.jsonl", K.concept_links(kb).drop("at"))
    for bank, key in (("scene", F.lower("scene_template")), ("template", F.lower("surface_template")), ("knowledge", F.col("knowledge_signature"))):
        folder.write(f"{bank}_links.jsonl", K.bank_links(kb, key))
    folder.document("manifest.json", {"dataset_name": name, "counts": counts, "files": {n: folder.at(f"{n}.jsonl") for n in counts}})
    return kb


def distribute(reports: DataFrame, seeds: DataFrame, folder: Folder, config: Config = Config()) -> DataFrame:
    """Step reports -> mastery, quota and target difficulty of each seed, in task order."""
    attempts = reports.select(F.col("source_task_id").alias("task_id"), "step_score_mean", F.col("final_answer_correct").alias("correct"))
    mastered = assess.with_sources(Q.mastery(attempts), seeds)
    given = folder.keep(Q.allocate(mastered.drop("question"), config.multiplier, config.n_min, config.n_max, config.balance))
    out = folder.keep(Q.settle(given, config.n_min, config.n_max).join(seeds.select("task_id", "question"), "task_id"))
    folder.write("mastery.jsonl", out.orderBy("task_id"))
    return out


def plan_summary(plans: DataFrame) -> dict:
    """Counts of plans, of their scenes and of their signatures (empty ones don't count)."""
    some = lambda c: F.countDistinct(F.nullif(F.col(c), F.lit("")))
    r = plans.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source_task_id").alias("seeds"), some("knowledge.diversity.primary_scene.domain").alias("scenes"), some("knowledge.diversity.plan_signature").alias("signatures")).first()
    return {"plan_count": r["n"], "source_count": r["seeds"], "unique_scene_domains": r["scenes"], "unique_plan_signatures": r["signatures"]}


def plan(quotas: DataFrame, kb: DataFrame, folder: Folder) -> DataFrame:
    """Writes the plans of all variants, in seed and variant order, and their summary."""
    rows = P.plan_rows(quotas, kb)
    order = F.struct(F.col("source_task_id").alias("s"), F.regexp_extract("plan_id", r"_(\d+)$", 1).cast("int").alias("v"))
    plans = folder.keep(rows.orderBy(order).withColumn("ord", F.monotonically_increasing_id()))
    folder.write("plan.jsonl", plans)
    folder.document("plan.summary.json", plan_summary(plans))
    return plans


def build_plan_cards(kb_folder: Folder, folder: Folder, most: int = 6) -> DataFrame:
    """Cards of a knowledge base that was built before; without its manifest this is an error."""
    if not kb_folder.complete(["manifest.json"]):
        raise FileNotFoundError(f"no knowledge base at {kb_folder.path}")
    kb = kb_folder.spark.read.json(kb_folder.at("kb_records.jsonl"))
    cards = folder.keep(legacy.plan_cards(kb, most))
    folder.write("synthesis_plan.jsonl", cards)
    counts = {(r["kind"], r["bucket"]): r["n"] for r in legacy.card_summary(cards).collect()}
    of = lambda kind: {b: n for (k, b), n in counts.items() if k == kind}
    folder.document("summary.json", {"plan_count": sum(of("difficulty").values()), "mode_count": len(legacy.MODES) if counts else 0, "step_bucket_counts": of("step_bucket"), "difficulty_counts": of("difficulty")})
    return cards


def export(items: DataFrame, folder: Folder, instruction: str = "Solve the problem step by step.") -> DataFrame:
    """Writes instruction records of the items that are fit for training, and the summary."""
    given = items.withColumn("solution", F.lit("")) if "solution" not in items.columns else items
    has_passed = "passed" in items.columns
    records = R.training_records(given, has_passed).select(F.lit(instruction).alias("instruction"), "input", "output")
    records = folder.keep(records)
    folder.write("training.jsonl", records)
    folder.document("training.summary.json", export_summary(items.count(), records.count()))
    return records


def run(seeds: DataFrame, backend: Backend, folder: Folder, config: Config = Config(), name: str = "run") -> DataFrame:
    """Seeds to training records; a run that wrote its records is not made again unless forced."""
    if not config.stage_force and folder.complete(["training.jsonl", "training.summary.json"]):
        return folder.spark.read.json(folder.at("training.jsonl"))
    seeds = folder.keep(seeds.withColumn("task_id", F.coalesce("task_id", F.col("ord").cast("string"))))
    kb = build_knowledge_base(seeds, folder, name)
    split = T.solution_and_answer(F.col("solution_steps"), F.col("answer"))
    asked = folder.keep(seeds.withColumn("answer", split["answer"]))
    answers = assess.answer(asked, backend, folder, config.n_answers)
    reports = assess.score(answers, backend, folder, config.score_max_retries)
    quotas = distribute(reports, asked, folder, config)
    plans = plan(quotas, kb, folder)
    options = {"votes": config.qc_blind_votes, "tiebreak": config.qc_tiebreak_votes, "max_rounds": config.qc_max_rounds}
    if not config.run_validation:
        items, _ = rounds.generate(plans, quotas, backend, folder, config.gen_max_retries, config.gen_max_tokens)
        return items
    items, _ = rounds.validate_with_backtracking(plans, quotas, backend, folder, config.qc_backtracks, **options)
    if config.run_refinement:
        items, _ = rounds.refine(items, backend, folder, config.refine_max_rounds)
    return export(items, folder)
