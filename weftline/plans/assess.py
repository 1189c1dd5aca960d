"""Answers of a solver model to seed questions, and the scoring of their steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonx
from ..functions import numeric as N
from ..functions import text as T
from ..operators import review as R
from ..sources.store import Folder
from . import prompts
from .backend import Backend, infer

ANSWER = "task_id string, source_task_id string, attempt_index int, question string, reference_answer string, steps array<string>, final_answer string, extracted_answer string, is_correct boolean"
REPORT = (
    "task_id string, source_task_id string, attempt_index int, question string, reference_answer string, candidate_answer struct<steps:array<string>,final_answer:string>, step_count int, "
    "steps array<struct<step_id:int,text:string,scores:struct<correctness:double,logical:double,standardization:double,completeness:double,efficiency:double>,short_reason:string>>, "
    "step_score_mean double, step_score_sum double, final_answer_correct boolean, overall_reason string"
)


def answer(seeds: DataFrame, backend: Backend, folder: Folder, attempts: int = 4, temperature: float = 0.3, top_p: float = 0.95, max_tokens: int = 1024, resume: bool = True) -> DataFrame:
    """(ord, task_id, question, answer) -> one answer per seed and attempt; those of an earlier run are not asked for again."""
    asked = seeds.select("ord", F.col("task_id").cast("string").alias("source_task_id"), T.ws(F.col("question")).alias("question"), T.ws(F.col("answer")).alias("reference_answer"), F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))).alias("attempt_index"))
    asked = folder.keep(asked.withColumn("task_id", F.concat_ws("_", "source_task_id", F.col("attempt_index").cast("string"))))
    earlier = folder.keep(folder.read("answers.jsonl", ANSWER).dropDuplicates(["task_id"])) if resume else None
    pending = asked if earlier is None else asked.join(earlier.select("task_id"), "task_id", "left_anti")
    raw = folder.keep(infer(pending, prompts.answer(F.col("question")), backend, temperature, top_p, max_tokens))
    read = raw.withColumn("p", jsonx.parse_victim("raw"))
    extracted = F.coalesce(F.nullif(T.ws(F.col("p.final_answer")), F.lit("")), T.final_answer(F.col("raw")))
    read = read.withColumn("extracted_answer", extracted).withColumn("is_correct", N.is_correct(F.col("extracted_answer"), F.col("reference_answer")))
    fresh = read.select("task_id", "source_task_id", "attempt_index", "question", "reference_answer", "p.steps", T.ws(F.col("p.final_answer")).alias("final_answer"), "extracted_answer", "is_correct")
    order = asked.select(F.col("task_id").alias("_t"), "ord", F.col("attempt_index").alias("_a"))
    every = fresh if earlier is None else fresh.unionByName(earlier.join(asked.select("task_id"), "task_id", "left_semi"))
    out = folder.keep(every.join(order, F.col("task_id") == F.col("_t")).orderBy("ord", "_a").select(fresh.columns))
    folder.append("answers_raw.jsonl", read.select("task_id", "source_task_id", "attempt_index", "question", "reference_answer", F.col("p").alias("parsed_output"), "raw", "extracted_answer", "is_correct"))
    folder.write("answers.jsonl", out)
    return out


def scored_inputs(answers: DataFrame) -> DataFrame:
    """Adds what scoring looks at: q, ref, texts and final, and their common signature."""
    steps = T.clean_steps(F.col("steps"))
    final = F.coalesce(F.nullif(T.ws(F.col("final_answer")), F.lit("")), F.col("extracted_answer"), F.lit(""))
    out = answers.withColumns({"q": T.ws(F.col("question")), "ref": T.ws(F.col("reference_answer")), "texts": steps, "final": final})
    return out.withColumn("signature", F.to_json(F.struct("q", "ref", "texts", "final")))


def token_budget(steps: Column, cap: int = 2048, least: int = 1200, base: int = 256, each: int = 96) -> Column:
    return F.least(F.lit(cap), F.greatest(F.lit(least), F.lit(base) + F.lit(each) * F.size(steps)))


def _report(scored: DataFrame) -> DataFrame:
    """(q, ref, texts, final, s, reason) -> the report's own columns; s is struct(scores, texts, means, ...)."""
    short = F.when(F.col("reason").startswith("heuristic_fallback"), F.lit("heuristic_fallback")).otherwise(F.lit(""))
    return scored.select(
        "signature", F.size("s.scores").alias("step_count"), R.step_records(F.col("s.texts"), F.col("s.scores"), short).alias("steps"), "s.step_score_mean", "s.step_score_sum", F.col("s.final_answer_correct").alias("final_answer_correct"),
        F.col("reason").alias("overall_reason"),
    )


def score(answers: DataFrame, backend: Backend, folder: Folder, max_retries: int = 3, deduplicate: bool = True, resume: bool = True, fallback: bool = True) -> DataFrame:
    """Reports of all answers.

    Equal answers (question, reference, steps, final answer) are scored once and share the
    report.  Without steps there is no call.  What no try could score gets the
    heuristic report, or is an error if ``fallback`` is off.  Reports of an earlier run stay.
    """
    inputs = scored_inputs(answers)
    inputs = folder.keep(inputs if deduplicate else inputs.withColumn("signature", F.concat_ws("::record:", "signature", "task_id")))
    one = inputs.groupBy("signature").agg(*(F.min_by(c, "task_id").alias(c) for c in ("q", "ref", "texts", "final")))
    earlier = folder.keep(folder.read("reports.jsonl", REPORT).dropDuplicates(["task_id"]).join(inputs.select("task_id"), "task_id", "left_semi")) if resume else None
    known = None
    if earlier is not None:
        known = folder.keep(earlier.join(inputs.select("task_id", "signature"), "task_id").dropDuplicates(["signature"]).select("signature", "step_count", "steps", "step_score_mean", "step_score_sum", "final_answer_correct", "overall_reason"))
        one = one.join(known.select("signature"), "signature", "left_anti")
    one = folder.keep(one)
    bare = one.filter(F.size("texts") == 0).withColumns({"s": R.fallback_report(F.col("texts"), F.col("ref"), F.col("final")), "reason": F.lit("heuristic_fallback_no_steps")})
    found = [_report(bare)] if known is None else [known, _report(bare)]
    pending, turn = folder.keep(one.filter(F.size("texts") > 0).withColumn("error", F.lit(""))), 0
    while (max_retries < 0 or turn <= max_retries) and pending.limit(1).count():
        raw = folder.keep(infer(pending, prompts.score(F.col("q"), F.col("ref"), F.col("texts"), F.col("final"), turn), backend, 0.0, 1.0, token_budget(F.col("texts"))))
        tried = folder.keep(raw.withColumn("p", jsonx.parse_step_scores(F.col("raw"), F.size("texts"))).withColumn("error", F.coalesce(F.nullif("request_error", F.lit("")), "p.error")))
        whole = F.struct("p.scores", "texts", "p.step_score_mean", "p.step_score_sum", "p.final_answer_correct")
        found.append(_report(tried.filter("error = ''").withColumns({"s": whole, "reason": F.lit("")})))
        pending = folder.keep(tried.filter("error <> ''").select(one.columns + ["error"]))
        folder.append("score_failures.jsonl", pending.select("signature", F.lit(turn).alias("round"), F.lit("retry_pending").alias("event"), "error"))
        turn += 1
    if left := pending.count():
        if not fallback:
            examples = [r["error"] for r in pending.limit(3).collect()]
            raise RuntimeError(f"step scoring retries exhausted for {left} unique responses: {examples}")
        reason = F.concat(F.lit("heuristic_fallback_after_retries: "), "error")
        found.append(_report(pending.withColumns({"s": R.fallback_report(F.col("texts"), F.col("ref"), F.col("final")), "reason": reason})))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    out = inputs.join(every, "signature").select(
        "task_id", "source_task_id", "attempt_index", F.col("q").alias("question"), F.col("ref").alias("reference_answer"), F.struct(F.col("texts").alias("steps"), F.col("final").alias("final_answer")).alias("candidate_answer"), "step_count",
        every["steps"].alias("steps"), "step_score_mean", "step_score_sum", "final_answer_correct", "overall_reason",
    )
    out = folder.keep(out)
    folder.write("reports.jsonl", out)
    return out


def with_sources(mastery: DataFrame, seeds: DataFrame) -> DataFrame:
    """Adds question and category of a source to its mastery, in source order; a source without a type is 'unknown'."""
    side = seeds.select(F.col("task_id").alias("_task"), "ord", "question", F.coalesce(F.nullif(F.trim("question_type"), F.lit("")), F.lit("unknown")).alias("category")).dropDuplicates(["_task"])
    joined = mastery.join(side, F.col("task_id") == F.col("_task"), "left").withColumn("category", F.coalesce("category", F.lit("unknown")))
    return joined.orderBy("task_id").select(*mastery.columns, "ord", "question", "category")
