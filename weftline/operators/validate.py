"""Checks without a model: precheck, vote summaries, the decision, plan alignment, step quality."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import arithmetic
from ..functions import numeric as N
from ..functions import text as T


@dataclass(frozen=True)
class Limits:
    question_chars: int = 700
    solution_chars: int = 900
    steps: int = 10
    calculate_steps: int = 1
    severe_question_chars: int = 1200
    severe_solution_chars: int = 1800
    severe_steps: int = 16
    style_hard_fail: bool = False
    block_unfriendly: bool = True
    warn_overused: bool = True
    difficulty_tolerance: int = 1
    exact_difficulty: bool = False


def arithmetic_errors(steps: Column) -> Column:
    """Equations of the steps that do not hold (the one check that no built-in function can do)."""

    def run(steps: pd.Series) -> pd.Series:
        return steps.map(lambda s: arithmetic.errors(list(s) if s is not None else []))

    return F.pandas_udf(run, "array<struct<step_index:int,expression:string,claimed:double,calculated:double>>")(steps)


def precheck(candidates: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(question, steps, answer, ...) -> adds passed, issues, warnings, arithmetic_errors and the normalised fields."""
    d = candidates.withColumns({"question": T.ws(F.col("question")), "steps": T.clean_steps(F.col("steps")), "answer": T.normalize_answer(F.col("answer"))})
    d = d.withColumn("arithmetic_errors", arithmetic_errors(F.col("steps"))).withColumn("_text", T.ws(F.array_join("steps", " ")))
    q, n, chars = F.col("question"), F.size("steps"), F.char_length("_text")
    calculate = F.size(F.filter("steps", lambda s: s.rlike(C.CALCULATE_STEP)))
    keys = F.transform("steps", lambda s: F.regexp_replace(F.lower(s), r"\s+", ""))
    over = lambda value, limit: (value > limit) if limit > 0 else F.lit(False)
    style = [
        (over(F.char_length(q), limits.question_chars), "question_too_long_for_training"),
        (over(chars, limits.solution_chars), "solution_too_long_for_training"),
        (over(n, limits.steps), "too_many_steps_for_training"),
        ((calculate > limits.calculate_steps) & (calculate / F.greatest(n, F.lit(1)) >= 0.4) if limits.calculate_steps >= 0 else F.lit(False), "template_calculate_steps"),
        (q.rlike(C.UNFRIENDLY_SCENE) if limits.block_unfriendly else F.lit(False), "training_unfriendly_scene"),
    ]
    missing = [(q == "", "missing_question"), (n == 0, "missing_steps"), (F.col("answer") == "", "invalid_answer")]
    several = [(F.regexp_count(q, F.lit(r"\?")) > 1, "multiple_subquestions"), (q.rlike(C.SECOND_QUESTION), "multiple_subquestions")]
    severe = [(over(F.char_length(q), limits.severe_question_chars), "severely_long_question"), (over(chars, limits.severe_solution_chars), "severely_long_solution"), (over(n, limits.severe_steps), "severely_many_steps")]
    wrong = [(F.size(keys) != F.size(F.array_distinct(keys)), "duplicate_steps"), (F.size("arithmetic_errors") > 0, "arithmetic_error")]
    last = T.normalize_answer(F.try_element_at(T.find_all(F.translate(F.element_at("steps", -1), ",", ""), C.NUMERIC), F.lit(-1)))
    mismatch = (n > 0) & (F.col("answer") != "") & (last != "") & ~N.answers_equal(last, F.col("answer"))
    overused = F.col("answer").isin(C.OVERUSED_ANSWERS) if limits.warn_overused else F.lit(False)
    hard = limits.style_hard_fail
    d = d.withColumn("issues", N.issues(*missing, *several, *(style if hard else []), *severe, *wrong))
    d = d.withColumn("warnings", N.issues(*([] if hard else style), (overused, "overused_final_answer"), (F.when(n > 0, mismatch).otherwise(False), "last_step_answer_mismatch")))
    return d.withColumn("passed", F.size("issues") == 0).drop("_text")


def vote_summary(votes: Column, with_steps: bool = False) -> Column:
    """Summary of array<struct<solvable, unique_answer, answer, confidence[, steps]>>, in vote order.

    Equality of answers is tolerant and not transitive, so answers join the first
    group whose head they equal; groups are folded over the votes of one item.  Each
    answer is read once.  The steps are those of the consensus' first most confident vote.
    """
    none = F.array().cast("array<string>")
    yes = lambda v, name: F.coalesce(v[name], F.lit(False))

    def read(v):
        answer = F.coalesce(v["answer"], F.lit(""))
        steps = F.coalesce(v["steps"], none) if with_steps else none
        return F.struct(
            answer.alias("answer"), T.ws(answer).alias("text"), N.numeric_value(answer).alias("value"), F.coalesce(v["confidence"], F.lit(0e0)).alias("confidence"), steps.alias("steps"),
            (yes(v, "solvable") & yes(v, "unique_answer") & (answer != "")).alias("usable"),
        )

    group = lambda head, n, best: F.struct(head.alias("head"), n.alias("n"), best.alias("best"))

    def join(groups, v):
        same = F.transform(groups, lambda g: N.same_value(g["head"]["value"], v["value"], g["head"]["text"], v["text"]))
        grown = lambda g: group(g["head"], g["n"] + 1, F.when(v["confidence"] > g["best"]["confidence"], v).otherwise(g["best"]))
        return T.let(F.array_position(same, True), lambda at: F.when(at > 0, F.transform(groups, lambda g, i: F.when(i + 1 == at, grown(g)).otherwise(g))).otherwise(F.concat(groups, F.array(group(v, F.lit(1), v)))))

    item = "struct<answer:string,text:string,value:double,confidence:double,steps:array<string>,usable:boolean>"
    empty = F.array().cast(f"array<struct<head:{item},n:int,best:{item}>>")
    largest = lambda groups: F.try_element_at(F.filter(groups, lambda g: (g["n"] >= 2) & (g["n"] == F.array_max(F.transform(groups, lambda o: o["n"])))), F.lit(1))

    def told(items, top):
        return F.struct(
            F.size(items).alias("vote_count"), F.size(F.filter(votes, lambda v: yes(v, "solvable"))).alias("solvable_votes"), F.size(F.filter(votes, lambda v: yes(v, "unique_answer"))).alias("unique_answer_votes"),
            top.isNotNull().alias("consensus"), F.coalesce(top["n"], F.lit(0)).alias("consensus_count"), F.coalesce(top["head"]["answer"], F.lit("")).alias("consensus_answer"),
            F.coalesce(top["best"]["steps"], none).alias("representative_steps"), F.transform(items, lambda v: v["answer"]).alias("answers"),
            F.round(F.aggregate(items, F.lit(0e0), lambda a, v: a + v["confidence"]) / F.greatest(F.size(items), F.lit(1)), 4).alias("average_confidence"),
        )

    def summary(items):
        groups = F.aggregate(F.filter(items, lambda v: v["usable"]), empty, join)
        return T.let(T.let(groups, largest), lambda top: told(items, top))

    return T.let(F.transform(votes, read), summary)


def needs_tiebreak(votes: Column) -> Column:
    return (F.size(votes) < 2) | ~vote_summary(votes)["consensus"]


def decide(items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(answer, issues, warnings, blind, audit, target_difficulty, ...) -> adds passed, repair_action, error_type, reasons, all_warnings.

    ``audit`` is a struct or null; ``blind`` a vote summary.
    """
    audit, blind, target = F.col("audit"), F.col("blind"), F.col("target_difficulty")
    there = audit.isNotNull()
    bad = lambda f: there & ~F.coalesce(audit[f], F.lit(False))
    middle = N.rank_of(target, C.LABELS, 2)
    gap = F.abs(N.choice(audit["estimated_difficulty"], {n: i for i, n in enumerate(C.LABELS)}, -1) - middle)
    known = audit["estimated_difficulty"].isin(C.LABELS)
    gap = F.when(known, gap).otherwise(0)
    far = F.lit(True) if limits.exact_difficulty else gap > limits.difficulty_tolerance
    unmatched, other = bad("difficulty_match"), there & known & (audit["estimated_difficulty"] != target)
    style = T.strings(C.STYLE_ISSUES)
    hard = F.filter("issues", lambda i: ~F.array_contains(style, i))
    found = N.issues(
        (~blind["consensus"], "no_blind_consensus"),
        (blind["consensus"] & ~N.answers_equal(blind["consensus_answer"], T.normalize_answer(F.col("answer"))), "answer_mismatch"),
        (blind["solvable_votes"] < 2, "unsolvable"),
        (blind["unique_answer_votes"] < 2, "non_unique_answer"),
        (~there, "missing_audit"),
        (bad("question_valid"), "invalid_question"),
        (bad("solvable"), "unsolvable"),
        (bad("unique_answer"), "non_unique_answer"),
        (bad("answer_correct"), "incorrect_answer"),
        (bad("steps_correct"), "invalid_steps"),
        ((unmatched | other) & far, "difficulty_mismatch"),
    )
    soft = N.issues((unmatched & ~far, "soft_difficulty_mismatch"), (other & ~far, "estimated_adjacent_difficulty"))
    d = items.withColumn("reasons", F.array_distinct(F.concat(hard, found))).withColumn("all_warnings", F.array_distinct(F.concat("warnings", F.filter("issues", lambda i: F.array_contains(style, i)), soft)))
    has = lambda *names: F.arrays_overlap("reasons", T.strings(names))
    basic = has("unsolvable", "non_unique_answer", "invalid_question", "no_blind_consensus")
    asked = F.coalesce(audit["repair_action"], F.lit("regenerate_question"))
    d = d.withColumn("passed", F.size("reasons") == 0)
    action = F.when(F.col("passed"), "pass").when(basic, F.when(asked == "repair_solution", "repair_question").otherwise(asked)).when(has("difficulty_mismatch"), "repair_question").otherwise("repair_solution")
    audit_error = F.nullif(F.coalesce(audit["error_type"], F.lit("")), F.lit("none"))
    error = (
        F.when(F.col("passed"), "none")
        .when(basic, F.coalesce(audit["error_type"], F.lit("unsolvable")))
        .when(has("difficulty_mismatch"), "difficulty_mismatch")
        .when(has("arithmetic_error"), "arithmetic_error")
        .when(has("missing_question", "missing_steps", "invalid_answer", "multiple_subquestions", "duplicate_steps"), "invalid_format")
        .otherwise(F.coalesce(F.nullif(audit_error, F.lit("")), F.lit("answer_mismatch")))
    )
    return d.withColumn("repair_action", action).withColumn("error_type", error)


def alignment_error(question: Column, steps: Column, answer: Column, plan_tokens: Column, label: Column) -> Column:
    """'' if a generated item shows its plan and has a fitting number of steps, else what is wrong."""
    n = F.size(steps)
    return (
        F.when((F.coalesce(question, F.lit("")) == "") | (n == 0) | (T.normalize_answer(answer) == ""), C.NOT_GENERATED)
        .when((F.size(plan_tokens) > 0) & ~F.arrays_overlap(T.keyword_set(question), plan_tokens), C.NOT_ALIGNED)
        .when((label == "Hard") & (n < 2), C.TOO_FEW_STEPS)
        .when((label == "Easy") & (n > 5), C.TOO_MANY_STEPS)
        .otherwise("")
    )


def step_quality_issue(steps: Column) -> Column:
    """The first rule that refined steps break, or ''."""
    s = T.clean_steps(steps)
    n = F.size(s)
    number = lambda x: F.regexp_extract(x, r"(?i)^\s*Step\s+(\d+)\s*:", 1)
    unlabelled = F.array_position(F.transform(s, lambda x, i: number(x) == (i + 1).cast("string")), False)
    mechanical = F.size(F.filter(s, lambda x: x.rlike(C.MECHANICAL_START)))
    connective = F.size(F.filter(s, lambda x: T.strip_label(x).rlike(C.CONNECTIVE)))
    packed = F.exists(s, lambda x: F.regexp_count(x, F.lit(";")) >= 2)
    return (
        F.when(n == 0, C.STEPS_MISSING)
        .when(unlabelled > 0, F.format_string(C.STEP_UNLABELLED, unlabelled.cast("string"), unlabelled.cast("string")))
        .when(mechanical / n >= 0.5, C.STEPS_MECHANICAL)
        .when((n >= 2) & (connective / n < 0.5), C.STEPS_UNCONNECTED)
        .when(packed, C.STEPS_PACKED)
        .otherwise("")
    )
