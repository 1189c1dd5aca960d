"""Generate, validate and refine rounds around an inference backend.

Each round's model calls are kept before they are used again, rows that are done
leave the queue, and what a round knows of an item (its counters, its active plan) is
columns of the queue.  With a folder, a round's tables and summary are written to it
and a run takes up what an earlier one left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import jsonx
from ..functions import numeric as N
from ..functions import text as T
from ..operators import planning as P
from ..operators import validate as V
from ..sources.store import Folder, histogram
from . import prompts
from .backend import Backend, infer

ITEM = ["source_task_id", "plan_id", "difficulty", "question", "steps", "answer"]
PLANNED_LAST = 10**12


def with_seeds(rows: DataFrame, mastery: DataFrame) -> DataFrame:
    """Adds difficulty and seed_question of the row's source task; without one the difficulty is Equal."""
    side = mastery.select(F.col("task_id").cast("string").alias("_task"), F.coalesce(F.nullif("target_difficulty", F.lit("")), F.lit("Equal")).alias("_label"), T.ws(F.col("question")).alias("_question")).dropDuplicates(["_task"])
    joined = rows.join(side, rows["source_task_id"].cast("string") == F.col("_task"), "left")
    return joined.select(*rows.columns, F.coalesce("_label", F.lit("Equal")).alias("difficulty"), F.coalesce("_question", F.lit("")).alias("seed_question"))


def by_plan(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows in plan order, those of unknown plans last."""
    order = plans.select(F.col("plan_id").alias("_plan"), F.col("ord").alias("_ord")).dropDuplicates(["_plan"])
    return rows.join(order, rows["plan_id"] == F.col("_plan"), "left").orderBy(F.coalesce("_ord", F.lit(PLANNED_LAST)), "plan_id").select(*rows.columns)


def known_successes(folder: Folder, plans: DataFrame) -> DataFrame:
    """Earlier successes of plans that are still asked for, one per plan."""
    schema = "source_task_id string, plan_id string, difficulty string, question string, steps array<string>, answer string, attempts int"
    return folder.read("generated.jsonl", schema).join(plans.select("plan_id"), "plan_id", "left_semi").dropDuplicates(["plan_id"]).select(*ITEM, "attempts")


def resumable_failures(failures: DataFrame, completed: DataFrame, max_retries: int, retry_completed: bool = False) -> DataFrame:
    """Earlier failures with tries left and, unless asked for, without those that were completed; adds retry_round.

    The next plan is the stored one, else the failed plan after its replan.
    """
    left = failures.filter("plan_id <> ''")
    left = left if retry_completed else left.join(completed.select("plan_id"), "plan_id", "left_anti")
    left = left.withColumn("retry_round", F.greatest(F.lit(1), F.coalesce("attempts", F.lit(0))))
    left = left if max_retries < 0 else left.filter(F.col("retry_round") <= max_retries)
    next_plan = F.coalesce("next_plan", P.replan(F.col("plan"), F.col("plan_id"), F.coalesce("failure_type", F.lit("unknown")), F.col("retry_round")))
    return left.withColumn("next_plan", next_plan).filter("next_plan IS NOT NULL")


def generation_settings(label: Column, maps: dict[str, float] = C.TEMPERATURES) -> Column:
    """Sampling value of a difficulty."""
    return N.choice(label, maps, 0.5)


def generate(plans: DataFrame, mastery: DataFrame, backend: Backend, folder: Folder, max_retries: int = 5, max_tokens: int = 1200, resume: bool = True) -> tuple[DataFrame, DataFrame]:
    """(ord, source_task_id, plan_id, knowledge) -> (items, failures).

    Every round asks for the failed plans only, with what was wrong; failures left by
    an earlier run come first and go on counting.  ``max_retries`` below 0 never gives up.
    """
    plans = folder.keep(with_seeds(plans.withColumn("source_task_id", F.col("source_task_id").cast("string")), mastery))
    kind = plans.schema["knowledge"].dataType.simpleString()
    failed_schema = f"source_task_id string, plan_id string, difficulty string, round int, attempts int, failure_type string, error string, candidate_question string, raw string, plan {kind}, next_plan {kind}"
    done = folder.keep(known_successes(folder, plans)) if resume else None
    old = folder.keep(folder.read("failed.jsonl", failed_schema)) if resume else None
    queue = plans.withColumns({"retry_reason": F.lit(""), "priority": F.lit(1)})
    turn = 0
    if resume:
        again = folder.keep(resumable_failures(old, done, max_retries).select("plan_id", "next_plan", "error", "retry_round").dropDuplicates(["plan_id"]))
        queue = queue.join(done.select("plan_id"), "plan_id", "left_anti").join(old.select("plan_id"), "plan_id", "left_anti")
        taken = plans.join(again, "plan_id").withColumns({"knowledge": F.col("next_plan"), "retry_reason": F.col("error"), "priority": F.lit(0)})
        queue = taken.select(queue.columns).unionByName(queue)
        turn = again.agg(F.max("retry_round")).first()[0] or 0
    pending, failures = folder.keep(queue), None
    while (max_retries < 0 or turn <= max_retries) and pending.limit(1).count():
        ask = prompts.generate(F.col("seed_question"), F.col("difficulty"), F.col("knowledge"), turn, F.col("retry_reason"))
        label = generation_settings(F.col("difficulty"))
        raw = folder.keep(infer(pending, ask, backend, label, label, max_tokens))
        parsed = raw.withColumn("p", jsonx.parse_generated("raw"))
        fault = (
            F.when(F.col("request_error") != "", F.col("request_error")).when(F.col("p.error") != "", F.col("p.error"))
            .otherwise(V.alignment_error(F.col("p.question"), F.col("p.steps"), F.col("p.answer"), P.plan_tokens(F.col("knowledge")), F.col("difficulty")))
        )
        tried = folder.keep(parsed.select(*plans.columns, "raw", F.lit(turn).alias("round"), F.lit(turn + 1).alias("attempts"), "p.question", "p.steps", "p.answer", fault.alias("error")))
        good = tried.filter("error = ''").select(*ITEM, "attempts")
        done = good if done is None else done.unionByName(good)
        last = max_retries >= 0 and turn >= max_retries
        kept = F.lit(None).cast(kind) if last else P.replan(F.col("knowledge"), F.col("plan_id"), F.col("failure_type"), F.lit(turn + 1))
        bad = tried.filter("error <> ''").withColumn("failure_type", N.failure_class(F.col("error")))
        failures = folder.keep(bad.select("source_task_id", "plan_id", "difficulty", "round", "attempts", "failure_type", "error", F.coalesce("question", F.lit("")).alias("candidate_question"), "raw", F.col("knowledge").alias("plan"), kept.alias("next_plan")))
        done = folder.keep(done)
        summary = {"attempted": pending.count(), "success": good.count(), "failed": failures.count(), "failure_types": histogram(failures, "failure_type")}
        folder.round("generated", turn, {"plan": pending.select("plan_id", "knowledge"), "success": good, "raw": tried.select("plan_id", "round", "attempts", "raw"), "failed": failures}, summary)
        folder.write("generated.jsonl", by_plan(done, plans))
        folder.write("failed.jsonl", by_plan(failures, plans))
        total = plans.count()
        folder.document("generated.summary.json", {"planned": total, "generated": (n := done.count()), "failed_latest_checkpoint": summary["failed"], "remaining": max(0, total - n), "round": turn, "checkpoint_reason": "round_complete"})
        if last:
            break
        pending = folder.keep(plans.drop("knowledge").join(failures.select("plan_id", F.col("next_plan").alias("knowledge"), F.col("error").alias("retry_reason")), "plan_id").withColumn("priority", F.lit(1)))
        turn += 1
    if done is None:
        done = plans.sparkSession.createDataFrame([], f"{', '.join(f'{c} string' for c in ITEM if c != 'steps')}, steps array<string>, attempts int").select(*ITEM, "attempts")
    if failures is None:
        failures = plans.sparkSession.createDataFrame([], failed_schema)
    return done, failures


def _votes(asked: DataFrame, backend: Backend, folder: Folder, turn: int, votes: range, max_tokens: int) -> DataFrame:
    """(plan_id, question) -> (plan_id, vote, v, fault) of the numbered votes."""
    each = asked.select("plan_id", "question", F.explode(F.array(*map(F.lit, votes))).alias("vote"))
    raw = folder.keep(infer(each, prompts.solve(F.col("question"), F.col("vote"), turn), backend, 0.1 + F.col("vote") * 0.05, 0.9, max_tokens))
    read = raw.withColumn("v", jsonx.parse_vote("raw"))
    return folder.keep(read.select("plan_id", "vote", "v", F.coalesce(F.nullif("request_error", F.lit("")), "v.error").alias("fault")))


def _with_votes(checked: DataFrame, votes: DataFrame) -> DataFrame:
    """Adds votes (the readable ones, in order) and vote_fault (whether one could not be read)."""
    listed = votes.groupBy("plan_id").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("fault") == "", F.struct("vote", "v")))), lambda s: s["v"]).alias("votes"), F.count_if(F.col("fault") != "").alias("faults")
    )
    none = F.array().cast(listed.schema["votes"].dataType)
    return checked.join(listed, "plan_id", "left").withColumns({"votes": F.coalesce("votes", none), "vote_fault": F.coalesce("faults", F.lit(0)) > 0}).drop("faults")


def validate(
    candidates: DataFrame, backend: Backend, folder: Folder, plans: DataFrame | None = None, mastery: DataFrame | None = None, votes: int = 2, tiebreak: int = 1, max_rounds: int = 3, replan_after: int = 3,
    retry_replan_after: int = 3, max_tokens: int = 900, limits: V.Limits = V.Limits(),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(source_task_id, plan_id, difficulty, question, steps, answer) -> (accepted, failed, reports).

    Per round: precheck; at least two blind votes, more where they disagree; the
    backend's audit; the decision; repairs of what failed.  Where no vote, or no audit,
    could be read, the round says nothing and the item is asked again as it is.  A repair
    of the solution keeps the question.  A repeated repair, ``replan_after`` failures or
    ``retry_replan_after`` unreadable rounds lead to a new plan and question (below 0:
    never).  ``max_rounds`` below 0 never gives up.
    """
    votes = max(2, votes)
    if plans is None:
        knowledge = F.lit(None).cast(P.knowledge_type(candidates.sparkSession))
        state = candidates.select(*ITEM, knowledge.alias("knowledge"))
    else:
        side = plans.select(F.col("plan_id").alias("_plan"), "knowledge").dropDuplicates(["_plan"])
        state = candidates.select(*ITEM).join(side, F.col("plan_id") == F.col("_plan"), "left").select(*ITEM, "knowledge")
    state = state.withColumns({"source_task_id": F.col("source_task_id").cast("string"), "difficulty": F.coalesce(F.nullif("difficulty", F.lit("")), F.lit("Equal"))})
    if mastery is None:
        state = state.withColumn("seed_question", F.lit(""))
    else:
        state = with_seeds(state.withColumnRenamed("difficulty", "_own"), mastery).withColumn("difficulty", F.col("_own")).drop("_own")
    counters = ["quality_failures", "retry_failures", "replan_count", "repeated_count"]
    state = state.withColumns({c: F.lit(0) for c in counters}).withColumn("active_plan", F.lit(None).cast(state.schema["knowledge"].dataType))
    columns = [*ITEM, "knowledge", "seed_question", *counters, "active_plan"]
    pending, accepted, reports, turn = folder.keep(state.select(columns)), None, None, 0
    failed = None
    while (max_rounds < 0 or turn <= max_rounds) and pending.limit(1).count():
        checked = folder.keep(V.precheck(pending, limits).drop("passed"))
        asked = checked.filter("question <> ''")
        said = _votes(asked, backend, folder, turn, range(votes), max_tokens)
        if tiebreak > 0:
            open_ = _with_votes(asked, said).filter(V.needs_tiebreak(F.col("votes")))
            said = said.unionByName(_votes(open_, backend, folder, turn, range(votes, votes + tiebreak), max_tokens))
        joined = folder.keep(_with_votes(checked, said).withColumn("blind", V.vote_summary(F.col("votes"), True)))
        ask = prompts.audit(F.col("question"), F.col("steps"), F.col("answer"), F.col("difficulty"), F.col("blind.consensus_answer"), F.col("seed_question"))
        audited = folder.keep(infer(joined.filter("question <> ''"), ask, backend, 0.1, 0.9, max_tokens)).withColumn("audit", jsonx.parse_audit("raw"))
        audits = folder.keep(audited.select("plan_id", F.when((F.col("request_error") == "") & (F.col("audit.error") == ""), F.col("audit")).alias("audit"), F.lit(True).alias("was_audited")))
        decided = V.decide(joined.join(audits, "plan_id", "left").withColumn("target_difficulty", F.col("difficulty")), limits)
        # A round in which nothing could be read says nothing about the item.
        deaf = F.when(F.col("was_audited") & F.col("audit").isNull(), "audit_request_error").when(F.col("vote_fault") & (F.size("votes") == 0), "blind_request_error")
        report = decided.withColumn("deaf", deaf).withColumns(
            {
                "round": F.lit(turn), "passed": F.col("passed") & F.col("deaf").isNull(), "repair_action": F.when(F.col("deaf").isNotNull(), "retry_validation").otherwise(F.col("repair_action")),
                "error_type": F.when(F.col("deaf").isNotNull(), "request_error").otherwise(F.col("error_type")), "reasons": F.when(F.col("deaf").isNotNull(), F.array("deaf")).otherwise(F.col("reasons")),
            }
        )
        report = folder.keep(report.select(*columns, "round", "passed", "repair_action", "error_type", "reasons", F.col("all_warnings").alias("warnings"), "issues", "arithmetic_errors", "votes", F.col("blind").alias("blind_summary"), "audit"))
        good, bad = report.filter("passed").select(*ITEM, "round"), report.filter("NOT passed")
        accepted = folder.keep(good if accepted is None else accepted.unionByName(good))
        reports = report if reports is None else reports.unionByName(report)
        last = max_rounds >= 0 and turn >= max_rounds
        following, repairs = (None, None) if last else _repaired(bad, backend, folder, columns, replan_after, retry_replan_after, max_tokens)
        side = None if last else following.select(F.col("plan_id").alias("_plan"), F.col("active_plan").alias("next_plan"), F.struct(*ITEM).alias("next_candidate")).dropDuplicates(["_plan"])
        failed = bad.select(*ITEM, "round", "active_plan", "repair_action", "error_type", "reasons")
        plan_kind, item_kind = bad.schema["active_plan"].dataType, bad.select(F.struct(*ITEM).alias("x")).schema["x"].dataType
        failed = failed.withColumns({"next_plan": F.lit(None).cast(plan_kind), "next_candidate": F.lit(None).cast(item_kind)}) if last else failed.join(side, F.col("plan_id") == F.col("_plan"), "left").drop("_plan")
        failed = folder.keep(failed)
        summary = {"input": pending.count(), "passed": good.count(), "failed": failed.count(), "next_round": 0 if last else following.count(), "error_types": histogram(failed, "error_type"), "reasons": top_values(report, "reasons"), "warnings": top_values(report, "warnings")}
        tables = {"reports": report, "failed": failed} | ({} if last else {"repairs": repairs})
        folder.round("validation", turn, tables, summary | ({} if last else {"actions": histogram(repairs, "action")}))
        folder.write("validated.jsonl", accepted if plans is None or "ord" not in plans.columns else by_plan(accepted, plans))
        folder.write("validation_failed.jsonl", failed)
        folder.append("validation_reports.jsonl", report)
        if last:
            break
        pending, turn = following, turn + 1
    if reports is None:
        raise ValueError("no candidates to validate")
    return accepted, failed, reports


def top_values(rows: DataFrame, column: str, k: int = 8) -> dict[str, int]:
    """The most frequent values of a list column."""
    found = rows.select(F.explode(column).alias("value")).groupBy("value").count().orderBy(F.col("count").desc(), "value").limit(k)
    return {r["value"]: r["count"] for r in found.collect()}


def _repaired(bad: DataFrame, backend: Backend, folder: Folder, columns: list[str], replan_after: int, retry_replan_after: int, max_tokens: int) -> tuple[DataFrame, DataFrame]:
    """(the failed items as the next round takes them, what was done to them)."""
    quality, retries = F.col("quality_failures") + 1, F.col("retry_failures") + 1
    unread = F.col("repair_action") == "retry_validation"
    stubborn = (quality >= max(1, replan_after)) if replan_after >= 0 else F.lit(False)
    lost = (unread & (retries >= max(1, retry_replan_after))) if retry_replan_after >= 0 else F.lit(False)
    action = F.when((F.col("repeated_count") >= 1) | stubborn | lost, "regenerate_question").otherwise(F.col("repair_action"))
    reason = F.when(lost, "validation_response_failure").when(stubborn, "stubborn_validation").otherwise("validation_regeneration")
    bad = bad.withColumns({"waits": unread & ~lost, "action": action, "forced": stubborn | lost, "replan_reason": F.when(action == "regenerate_question", reason).otherwise("")})
    plan = F.coalesce("active_plan", "knowledge")
    new_plan = F.when(F.col("action") == "regenerate_question", P.replan(plan, F.col("plan_id"), F.col("replan_reason"), F.col("replan_count") + 1))
    told = folder.keep(bad.filter("NOT waits").withColumn("repair_plan", new_plan))
    ask = prompts.repair(
        F.col("action"), F.col("question"), F.col("steps"), F.col("answer"), F.col("difficulty"), F.col("reasons"), F.col("blind_summary.consensus_answer"), F.col("audit.short_reason"),
        prompts.block(F.coalesce("repair_plan", plan)), F.col("seed_question"),
    )
    raw = folder.keep(infer(told, ask, backend, F.when(F.col("action") == "repair_solution", 0.2).otherwise(0.5), 0.9, max_tokens))
    out = raw.withColumn("g", jsonx.parse_generated("raw")).withColumn("fault", F.coalesce(F.nullif("request_error", F.lit("")), "g.error"))
    out = folder.keep(out.withColumn("read", F.col("fault") == ""))
    replans = F.col("read") & (F.col("action") == "regenerate_question")
    question = F.when(F.col("read") & (F.col("action") != "repair_solution"), F.col("g.question")).otherwise(F.col("question"))
    answer = F.when(F.col("read"), F.col("g.answer")).otherwise(F.col("answer"))
    mark = lambda q, a: F.concat(F.lower(T.ws(q)), F.lit("::"), T.normalize_answer(a))
    again = mark(question, answer) == mark(F.col("question"), F.col("answer"))
    fresh = out.select(
        "source_task_id", "plan_id", "difficulty", question.alias("question"), F.when(F.col("read"), F.col("g.steps")).otherwise(F.col("steps")).alias("steps"), answer.alias("answer"), "knowledge", "seed_question",
        F.when(replans, 0).otherwise(quality).alias("quality_failures"), F.when(~F.col("read") & (F.col("repair_action") == "retry_validation"), retries).otherwise(0).alias("retry_failures"),
        (F.col("replan_count") + replans.cast("int")).alias("replan_count"), F.when(~F.col("read"), F.col("repeated_count")).when(again, F.col("repeated_count") + 1).otherwise(0).alias("repeated_count"),
        F.when(replans, F.col("repair_plan")).otherwise(F.col("active_plan")).alias("active_plan"),
    )
    waiting = bad.filter("waits").withColumn("retry_failures", retries).select(columns)
    repairs = out.select("source_task_id", "plan_id", "round", "action", "replan_reason", "forced", "fault", F.struct(*ITEM).alias("before"), F.when(F.col("read"), F.col("g")).alias("after"))
    return folder.keep(fresh.select(columns).unionByName(waiting)), folder.keep(repairs)


def failures_to_retry(failures: DataFrame, plans: DataFrame) -> DataFrame:
    """Failed validations as generation failures that a resumed generation takes up; those of no known plan go."""
    named = F.coalesce(F.nullif(F.trim("error_type"), F.lit("")), F.nullif(F.trim("repair_action"), F.lit("")), F.lit("failed"))
    # Of all plans only those that failed are sorted, as a plan is a long row.
    side = plans.join(failures.select("plan_id").distinct(), "plan_id", "left_semi").select(F.col("plan_id").alias("_plan"), F.col("knowledge").alias("_known")).dropDuplicates(["_plan"])
    x = failures.filter("plan_id <> ''").join(side, F.col("plan_id") == F.col("_plan"), "left").withColumns({"failure_type": F.concat(F.lit("validation_"), named), "attempts": (F.coalesce("round", F.lit(0)) + 1).cast("int")})
    chosen = F.coalesce("next_plan", "active_plan", P.replan(F.col("_known"), F.col("plan_id"), F.col("failure_type"), F.col("attempts")))
    return x.select(
        "source_task_id", "plan_id", "difficulty", F.coalesce("round", F.lit(0)).alias("round"), "attempts", "failure_type", F.lit("validation failed; retrying generation").alias("error"), F.col("question").alias("candidate_question"),
        F.lit("").alias("raw"), F.coalesce("_known", "active_plan").alias("plan"), chosen.alias("next_plan"),
    ).filter("next_plan IS NOT NULL")


def validate_with_backtracking(plans: DataFrame, mastery: DataFrame, backend: Backend, folder: Folder, backtracks: int = 3, **options) -> tuple[DataFrame, DataFrame]:
    """(accepted, failed) after generating, validating all, and generating anew what failed, ``backtracks`` times (below 0: until all pass)."""
    items, _ = generate(plans, mastery, backend, folder)
    turn = 0
    while True:
        accepted, failed, _ = validate(items, backend, folder, plans, mastery, **options)
        if (backtracks >= 0 and turn >= backtracks) or not failed.limit(1).count():
            return accepted, failed
        again = folder.keep(failures_to_retry(failed, plans))
        if not again.limit(1).count():
            return accepted, failed
        folder.write("failed.jsonl", again)
        folder.write("generated.jsonl", items.join(again.select("plan_id"), "plan_id", "left_anti"))
        items, _ = generate(plans, mastery, backend, folder)
        turn += 1


def refine(items: DataFrame, backend: Backend, folder: Folder, max_rounds: int = 3, max_tokens: int = 900, resume: bool = True) -> tuple[DataFrame, DataFrame]:
    """(question, steps, answer, ...) -> (items with rewritten steps and all other columns, failures with their issue).

    Items are known by plan_id, else by source, place and the question's beginning; items
    that an earlier run refined are taken from the folder.
    """
    named = F.coalesce(F.nullif("plan_id", F.lit("")), F.concat_ws(":", F.coalesce(F.col("source_task_id").cast("string"), F.lit("")), F.monotonically_increasing_id().cast("string"), F.substring("question", 1, 80)))
    kept = folder.keep(items.withColumns({"_key": named, "_issue": F.lit("")}))
    done = folder.keep(folder.read("refined.jsonl", kept.drop("_issue").schema).join(kept.select("_key"), "_key", "left_semi").dropDuplicates(["_key"])) if resume else None
    pending, turn, failed = (kept if done is None else folder.keep(kept.join(done.select("_key"), "_key", "left_anti"))), 0, None
    while (max_rounds < 0 or turn <= max_rounds) and pending.limit(1).count():
        raw = folder.keep(infer(pending, prompts.refine(F.col("question"), F.col("steps"), F.col("answer"), turn, F.col("_issue")), backend, 0.2, 0.9, max_tokens))
        read = raw.withColumn("r", jsonx.parse_refined("raw"))
        issue = F.when(F.col("request_error") != "", F.col("request_error")).when(F.col("r.error") != "", F.col("r.error")).otherwise(V.step_quality_issue(F.col("r.steps")))
        tried = folder.keep(read.withColumns({"_issue": issue, "_new": T.clean_steps(F.col("r.steps"))}).drop("raw", "request_error", "r"))
        good = tried.filter("_issue = ''").withColumn("steps", F.col("_new")).select(*items.columns, "_key")
        done = folder.keep(good if done is None else done.select(good.columns).unionByName(good))
        failed = folder.keep(tried.filter("_issue <> ''").drop("_new"))
        folder.write("refined.jsonl", done)
        folder.write("refine_failed.jsonl", failed)
        pending, turn = failed, turn + 1
    none = kept.limit(0)
    return (none if done is None else done).select(*items.columns), (none if failed is None else failed).select(*items.columns, F.col("_issue").alias("issue"))
