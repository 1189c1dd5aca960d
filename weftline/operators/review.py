"""Heuristic reviews: noise flags, evaluation scores, quality votes, fallback step scores, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T

DIMENSIONS = ["correctness", "logical", "standardization", "completeness", "efficiency"]
EVALUATED = ["correctness", "difficulty_match", "brevity", "non_redundancy", "answer_quality"]
INSPECTED = ["difficulty_match", "correctness", "answer_uniqueness", "step_validity", "brevity"]

# Issues that no majority can outvote.
CRITICAL = ["difficulty_mismatch", "incorrect_answer", "unsolvable", "non_unique_answer", "invalid_steps", "answer_without_solution"]


def leaks(answer: Column, question: Column, source_answer: Column, source_question: Column) -> Column:
    return ((T.ws(source_answer) != "") & (T.ws(answer) == T.ws(source_answer))) | ((T.ws(source_question) != "") & (T.ws(question) == T.ws(source_question)))


def noise(items: DataFrame) -> DataFrame:
    """(question, solution, answer, bucket, step_count, source_question, source_answer, source_scene, target_bucket, low, high) -> adds issues, is_clean, overlap_ratio, repetition_penalty."""
    q, s = T.ws(F.col("question")), T.ws(F.col("solution"))
    tokens = lambda x: F.array_distinct(T.find_all(F.lower(x), "[a-z0-9]+"))
    same, scene = T.jaccard(tokens(q), tokens(T.ws(F.col("source_question")))), T.jaccard(tokens(q), tokens(T.ws(F.col("source_scene"))))
    rules = N.issues(
        (F.char_length(q) < 20, "question_too_short"),
        (F.char_length(q) > 220, "question_too_long"),
        (F.char_length(s) > 1000, "solution_too_long"),
        (leaks(F.col("answer"), q, F.col("source_answer"), F.col("source_question")), "answer_or_question_leaks_source"),
        ((T.repetition(q) > 0.35) | (T.repetition(s) > 0.4), "repetitive_text"),
        (same > 0.72, "near_duplicate_question"),
        (scene > 0.8, "scene_copied_too_closely"),
        ((F.col("bucket") != "") & (F.col("target_bucket") != "") & (F.col("bucket") != F.col("target_bucket")), "difficulty_drift"),
        (~F.col("step_count").between(F.col("low"), F.col("high")), "step_count_out_of_range"),
    )
    return items.withColumns({"issues": rules, "overlap_ratio": F.round(same, 3), "repetition_penalty": F.round(F.greatest(T.repetition(q), T.repetition(s)), 3)}).withColumn("is_clean", F.size("issues") == 0)


def heuristic_scores(items: DataFrame) -> DataFrame:
    """(question, solution, answer, step_count, source_answer, low, high) -> five scores, overall, issues, passed."""
    a, s = T.ws(F.col("answer")), T.ws(F.col("solution"))
    n, low, high = F.col("step_count"), F.col("low"), F.col("high")
    correctness = F.when(a == "", 1).when(a.rlike(r"^[-+]?\d+(?:\.\d+)?$"), 5).when(T.ws(F.col("source_answer")) == a, 5).when(F.size(F.split(a, " ")) <= 6, 4).otherwise(3)
    match = F.when(n.between(low, high), 5).when(n.between(low - 1, high + 1), 4).otherwise(2)
    brevity = F.when((F.char_length(a) <= 30) & (F.char_length(s) <= 800), 5).when((F.char_length(a) <= 60) & (F.char_length(s) <= 1200), 4).otherwise(2)
    parts = F.filter(F.transform(F.split(F.concat_ws("\n", F.coalesce("question", F.lit("")), F.coalesce("solution", F.lit(""))), r"[.?!]\s*"), T.ws), lambda p: p != "")
    ratio = F.size(F.array_distinct(parts)) / F.greatest(F.size(parts), F.lit(1))
    fresh = F.when(F.size(parts) == 0, 1).when(ratio >= 0.95, 5).when(ratio >= 0.85, 4).when(ratio >= 0.7, 3).otherwise(2)
    length = F.char_length(a)
    quality = F.when(length.between(1, 80), 5).when((length < 0.6) | (length > 112), 2).otherwise(3)
    d = items.withColumns({"correctness": correctness, "difficulty_match": match, "brevity": brevity, "non_redundancy": fresh, "answer_quality": quality})
    names = ["correctness", "difficulty_match", "brevity", "non_redundancy", "answer_quality"]
    overall = sum((F.col(c) for c in names[1:]), F.col(names[0])) / 5
    low_ones = N.issues(*((F.col(c) <= 2, i) for c, i in zip(names, ("possible_incorrect_answer", "difficulty_mismatch", "too_verbose", "redundant_text"))))
    return d.withColumn("issues", low_ones).withColumn("overall_score", F.round(overall, 3)).withColumn("passed", (overall >= 4) & (F.size("issues") == 0))


def top_reasons(exploded: DataFrame, by: list[str], column: str, k: int) -> DataFrame:
    """The k most frequent values per group, ties by text."""
    counted = exploded.groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("n").desc(), column))
    return counted.withColumn("rank", rank).filter(F.col("rank") <= k)


def aggregate_votes(votes: DataFrame, scores: list[str]) -> DataFrame:
    """(item, verdict, issue array, score columns) -> verdict by majority, critical issues and mean score."""
    base = votes.groupBy("item").agg(F.count_if(F.col("verdict") == "pass").alias("pass_count"), F.count(F.lit(1)).alias("vote_count"), *(F.round(F.avg(s), 3).alias(s) for s in scores))
    top = top_reasons(votes.select("item", F.explode("issues").alias("issue")), ["item"], "issue", 5)
    listed = top.groupBy("item").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "issue"))), lambda s: s["issue"]).alias("issues"))
    d = base.join(listed, "item", "left").withColumn("issues", F.coalesce("issues", F.array().cast("array<string>")))
    overall = sum((F.col(s) for s in scores[1:]), F.col(scores[0])) / len(scores)
    critical = F.array_intersect("issues", T.strings(CRITICAL))
    passed = (F.col("pass_count") >= F.floor(F.col("vote_count") / 2) + 1) & (F.size(critical) == 0) & (overall >= 3.8)
    return d.withColumn("critical_issues", critical).withColumn("overall_score", F.round(overall, 3)).withColumn("verdict", F.when(passed, "pass").otherwise("fail"))


def fallback_step_scores(steps: Column, reference: Column) -> Column:
    """Heuristic scores of steps: array of struct(step_id, score, efficiency), both on 0 to 1."""
    clamp = lambda x: (F.least(F.lit(5), F.greatest(F.lit(1), x)) - 1) / 4

    def one(s, i):
        def scored(v):
            words = F.size(F.split(v["text"], " "))
            points = F.when(words >= 3, 4).otherwise(3) + v["text"].rlike("[0-9]").cast("int") + ((v["ref"] != "") & F.contains(T.number_token(s), v["ref"])).cast("int")
            effort = 6 - F.greatest(F.lit(1), F.floor(words / 6).cast("int"))
            return F.struct((i + 1).cast("int").alias("step_id"), clamp(points).alias("score"), clamp(effort).alias("efficiency"))

        return T.let(F.struct(T.ws(s).alias("text"), T.number_token(reference).alias("ref")), scored)

    return F.transform(steps, one)


def step_records(steps: Column, scores: Column, reason: Column) -> Column:
    """Scored steps: array of struct(step_id, text, scores, short_reason); a step without scores has zeros."""
    zeros = F.array(*(F.lit(0e0) for _ in DIMENSIONS))
    five = lambda i: F.coalesce(F.try_element_at(scores, i + 1), zeros)
    named = lambda v: F.struct(*(F.coalesce(F.get(v, k), F.lit(0e0)).alias(d) for k, d in enumerate(DIMENSIONS)))
    return F.transform(steps, lambda s, i: F.struct((i + 1).cast("int").alias("step_id"), s.alias("text"), T.let(five(i), named).alias("scores"), reason.alias("short_reason")))


def fallback_report(steps: Column, reference: Column, final: Column) -> Column:
    """struct(scores, texts, step_score_mean, step_score_sum, final_answer_correct) without a model; an answer without steps is one step of fixed scores."""
    correct = N.is_correct(final, reference)
    # The scores of an answer without steps.
    bare = F.array(F.array(F.when(correct, 1e0).otherwise(0.4), F.lit(0.6), F.lit(0.8), F.lit(0.4), F.lit(0.8)))
    scores = F.when(F.size(steps) > 0, F.transform(fallback_step_scores(steps, reference), lambda v: F.array(v["score"], v["score"], v["score"], v["score"], v["efficiency"]))).otherwise(bare)
    texts = F.when(F.size(steps) > 0, steps).otherwise(F.array(T.ws(final)))

    def told(s):
        total = F.aggregate(s, F.lit(0e0), lambda acc, v: acc + F.aggregate(v, F.lit(0e0), lambda a, x: a + x) / 5)
        return F.struct(s.alias("scores"), texts.alias("texts"), F.round(total / F.size(s), 4).alias("step_score_mean"), F.round(total, 4).alias("step_score_sum"), correct.alias("final_answer_correct"))

    return T.let(scores, told)


def evaluation_verdict(verdict: Column, scores: Column) -> Column:
    """struct(overall, passed) of a model's five scores (correctness and difficulty_match among the fields)."""
    total = sum((scores[d] for d in EVALUATED[1:]), scores[EVALUATED[0]]) / len(EVALUATED)
    said = F.lower(F.trim(F.coalesce(verdict, F.lit("fail"))))
    said = F.when(said != "", said).when(total >= 4, "pass").otherwise("fail")
    return F.struct(said.alias("verdict"), F.round(total, 3).alias("overall_score"), ((said == "pass") & (total >= 4) & (scores["correctness"] >= 4) & (scores["difficulty_match"] >= 3)).alias("passed"))


def training_records(candidates: DataFrame, has_passed: bool) -> DataFrame:
    """(question, steps, solution, answer[, passed]) -> question and output of the rows fit for training.

    A ``passed`` column that is there and false or null drops the row.
    """
    q, a = T.ws(F.col("question")), T.export_answer(F.col("answer"))
    kept = candidates.filter(F.coalesce("passed", F.lit(False))) if has_passed else candidates
    steps = T.clean_steps(F.col("steps"))
    return kept.filter((q != "") & (a != "")).withColumn("input", q).withColumn("output", T.solution_text(steps, F.col("solution"), a))
