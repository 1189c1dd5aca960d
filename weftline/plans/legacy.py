"""The older tools: plan cards, generation plans, one-pass generation, noise repair, model evaluation, quality loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import jsonx
from ..functions import numeric as N
from ..functions import text as T
from ..operators import planning as P
from ..operators import review as R
from ..sources.store import Folder
from . import prompts
from .backend import Backend, infer

MODES = ["same_structure", "scene_swap", "entity_swap", "surface_swap"]
HINTS = {
    "same_structure": "Keep the arithmetic as it is; change words and a few entities only.",
    "scene_swap": "Move the problem to another scene; keep the chain of computations.",
    "entity_swap": "Change people, things, units and quantities; keep the logic.",
    "surface_swap": "Keep meaning and steps; write it anew.",
}


def targets(records: DataFrame) -> DataFrame:
    """(task_id, difficulty_bucket, step_count) -> task_id, bucket, step range and reference step count of each record."""
    bucket = F.coalesce(F.nullif("difficulty_bucket", F.lit("")), F.lit("medium"))
    return records.select("task_id", bucket.alias("bucket"), N.choice(bucket, C.BUCKET_STEPS, [2, 4]).alias("step_count_range"), F.coalesce("step_count", F.lit(0)).cast("int").alias("reference_step_count"))


def lookup(rows: DataFrame, side: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``name``, the struct of the side's row whose task_id equals (as text) the first of ``keys`` that finds one."""
    out = rows
    found = []
    for k, key in enumerate(keys):
        known = side.select(F.col("task_id").cast("string").alias(f"_k{k}"), F.struct(*side.columns).alias(f"_v{k}")).dropDuplicates([f"_k{k}"])
        out = out.join(known, rows[key].cast("string") == F.col(f"_k{k}"), "left")
        found.append(F.col(f"_v{k}"))
    return out.select(*rows.columns, F.coalesce(*found).alias(name))


def plan_cards(kb: DataFrame, most: int = 6) -> DataFrame:
    """Knowledge-base records with their diversity profile: four modes, each with peers of the record's signature or skills."""
    skills = F.array_join(F.array_sort("skill_tags"), "|")
    keyed = kb.withColumns({"_signature": F.coalesce(F.nullif(F.trim("knowledge_signature"), F.lit("")), F.lit("unknown")), "_skills": F.when(F.size("skill_tags") > 0, skills).otherwise(F.concat(F.lit("steps:"), N.step_bucket(F.col("step_count"))))})
    of = lambda key, name: P.peers(keyed, key, most).select(F.col("task_id").alias(f"_{name}"), F.col("peer_ids").alias(name))
    rows = keyed.join(of("_signature", "by_signature"), F.col("task_id") == F.col("_by_signature")).join(of("_skills", "by_skills"), F.col("task_id") == F.col("_by_skills"))
    half = lambda c: F.slice(c, F.lit(1), F.greatest(F.lit(1), F.floor(F.size(c) / 2).cast("int")))
    peers = {"same_structure": F.col("by_signature"), "scene_swap": F.col("by_skills"), "entity_swap": half("by_signature"), "surface_swap": half("by_skills")}
    bucket = F.coalesce(F.nullif("difficulty_bucket", F.lit("")), F.lit("medium"))
    target = F.struct(bucket.alias("bucket"), N.choice(bucket, C.BUCKET_STEPS, [2, 4]).alias("step_count_range"), F.col("step_count").alias("reference_step_count"), N.rank_of(bucket, C.BUCKETS, 1).alias("rank"))
    keeps = F.struct(
        F.col("skill_tags").alias("preserve_skill_tags"), F.col("operation_sequence").alias("preserve_operation_sequence"), F.lit("numeric").alias("preserve_answer_type"), F.slice("all_terms", 1, 8).alias("anchor_concepts"),
        F.slice("persons", 1, 4).alias("anchor_persons"), F.slice("focus_terms", 1, 8).alias("anchor_terms"), F.slice("units", 1, 6).alias("anchor_units"),
    )
    mode = lambda m: F.struct(F.lit(m).alias("mode"), peers[m].alias("peer_task_ids"), target.alias("target_difficulty"), keeps.alias("constraints"), F.lit(HINTS[m]).alias("mode_hint"))
    profile = F.struct("knowledge_signature", "skill_tags", "operation_sequence", F.array(*map(mode, MODES)).alias("candidate_modes"))
    return rows.select(*kb.columns, N.step_bucket(F.col("step_count")).alias("step_bucket"), profile.alias("diversity_profile"))


def card_summary(cards: DataFrame) -> DataFrame:
    """(kind, bucket, n): cards per step bucket and per difficulty."""
    both = F.explode(F.array(F.struct(F.lit("step_bucket").alias("kind"), F.col("step_bucket").alias("bucket")), F.struct(F.lit("difficulty").alias("kind"), F.col("difficulty_bucket").alias("bucket"))))
    return cards.select(both.alias("b")).groupBy("b.kind", "b.bucket").agg(F.count(F.lit(1)).alias("n"))


def mode_of(bucket: Column, variant: Column) -> Column:
    """The bucket's modes in turn."""
    modes = N.choice(bucket, C.BUCKET_MODES, C.BUCKET_MODES["very_hard"])
    return F.element_at(modes, (variant % F.size(modes) + 1).cast("int"))


def generation_plan(mastery: DataFrame, cards: DataFrame) -> DataFrame:
    """One row per seed and variant: the seed, its target, and the card that the bucket priorities pick.

    mastery: task_id, question, answer, mastery, target_count and, maybe null, target_difficulty and
    target_difficulty_bucket.  A seed without a count gets the variants of its difficulty profile.
    """
    own = cards.select(F.col("task_id").alias("_own"), F.col("difficulty_bucket").alias("source_difficulty_bucket")).dropDuplicates(["_own"])
    seeds = mastery.join(own, F.col("task_id") == F.col("_own"), "left").withColumn("source_difficulty_bucket", F.coalesce("source_difficulty_bucket", F.lit("medium")))
    label = F.coalesce(F.nullif("target_difficulty", F.lit("")), N.difficulty_label(F.col("mastery")))
    seeds = seeds.withColumn("target_difficulty", label)
    bucket = F.coalesce(F.nullif("target_difficulty_bucket", F.lit("")), N.choice(F.col("target_difficulty"), C.LABEL_BUCKET), "source_difficulty_bucket")
    total = F.when(F.col("target_count") > 0, F.col("target_count")).otherwise(F.greatest(F.lit(1), F.size(P.difficulty_profile(F.col("mastery"), F.col("source_difficulty_bucket")))))
    seeds = seeds.withColumns({"target_difficulty_bucket": bucket, "target_count": total.cast("int"), "target_step_count_range": N.choice(F.col("target_difficulty"), C.LABEL_STEPS, [2, 4])})
    rows = seeds.withColumn("variant_index", F.explode(F.sequence(F.lit(0), F.col("target_count") - 1)))
    picked = P.priority_pick(rows.select("task_id", "target_difficulty", F.col("target_difficulty_bucket").alias("target_bucket"), F.col("variant_index").alias("variant")), cards.select("task_id", F.col("difficulty_bucket").alias("bucket")))
    picked = picked.select(F.col("task_id").alias("_t"), F.col("variant").alias("_v"), "card_id")
    card = cards.select(F.col("task_id").alias("_c"), F.struct(*cards.columns).alias("card"))
    out = rows.join(picked, (F.col("task_id") == F.col("_t")) & (F.col("variant_index") == F.col("_v")), "left").join(card, F.col("card_id") == F.col("_c"), "left")
    text = lambda name: F.coalesce(F.col(f"card.{name}"), F.lit(""))
    listed = lambda name, n: F.coalesce(F.slice(F.col(f"card.{name}"), 1, n), F.array().cast("array<string>"))
    card_bucket = F.coalesce(F.nullif("card.difficulty_bucket", F.lit("")), "target_difficulty_bucket")
    priority = F.coalesce(N.choice(F.lower(F.trim("target_difficulty")), {k.lower(): C.BUCKET_PRIORITY[v] for k, v in C.LABEL_BUCKET.items()}), N.choice(F.col("target_difficulty_bucket"), C.BUCKET_PRIORITY, ["medium", "easy", "hard", "very_hard"]))
    return out.select(
        F.concat_ws("_", F.col("task_id").cast("string"), F.col("variant_index").cast("string")).alias("task_id"), F.col("task_id").alias("source_task_id"), F.col("task_id").alias("seed_task_id"), "variant_index",
        F.col("question").alias("source_question"), F.col("answer").alias("source_answer"), "source_difficulty_bucket", F.col("mastery").alias("mastery_score"), "target_count", "target_difficulty", "target_difficulty_bucket",
        "target_step_count_range", mode_of(F.col("target_difficulty_bucket"), F.col("variant_index")).alias("mode"), F.col("card.task_id").alias("plan_source_task_id"), text("question").alias("plan_source_question"),
        text("answer").alias("plan_source_answer"), text("surface_template").alias("plan_source_surface_template"), text("scene_template").alias("plan_source_scene_template"), text("scenario_template").alias("plan_source_scenario_template"),
        card_bucket.alias("plan_source_difficulty_bucket"), text("question").alias("question"), text("answer").alias("answer"), text("solution_text").alias("solution_steps"), text("surface_template").alias("surface_template"),
        text("scene_template").alias("scene_template"), text("scenario_template").alias("scenario_template"), card_bucket.alias("difficulty_bucket"), listed("all_terms", 8).alias("anchor_concepts"), listed("persons", 4).alias("anchor_persons"),
        listed("focus_terms", 8).alias("anchor_terms"), listed("units", 6).alias("anchor_units"), text("knowledge_signature").alias("knowledge_signature"), F.coalesce("card.operation_sequence", F.array().cast("array<string>")).alias("operation_sequence"),
        F.struct(priority.alias("candidate_bucket_priority"), card_bucket.alias("selected_bucket")).alias("selection_reason"),
    )


def sampling(bucket: Column, level: Column, temperatures: dict[str, float] | None = None, top_ps: dict[str, float] | None = None, temperature: float | None = None, top_p: float | None = None) -> Column:
    """struct(temperature, top_p): a given value, else that of the level, else that of the bucket, else the default."""

    def value(given, own, default):
        of = lambda key: N.choice(key, own) if own else F.lit(None).cast("double")
        return F.lit(float(given)) if given is not None else F.coalesce(of(level), of(bucket), N.choice(bucket, C.BUCKET_TEMPERATURES), F.lit(default))

    return F.struct(F.greatest(F.lit(0e0), value(temperature, temperatures, 0.5)).alias("temperature"), F.least(F.lit(1e0), F.greatest(F.lit(0e0), value(top_p, top_ps, 0.9))).alias("top_p"))


def alike(questions: DataFrame, threshold: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """(ord, question) -> (ords of repeats, pairs (a, b) of other questions that are alike, a before b).

    Without regard to case and blanks, equal questions are repeats of the first of them;
    others are alike if their token sets overlap by the threshold.  Pairs must share one
    of their rarest tokens (so many that none is missed).
    """
    told = questions.select("ord", F.lower(T.ws(F.col("question"))).alias("q")).filter("q <> ''")
    first = told.groupBy("q").agg(F.min("ord").alias("ord"))
    repeats = told.join(first.select("ord"), "ord", "left_anti").select("ord")
    sized = first.withColumn("w", T.token_set(F.col("q"))).filter(F.size("w") > 0).withColumn("m", F.size("w"))
    tokens = sized.select("ord", "m", F.explode("w").alias("t"))
    ranked = tokens.join(tokens.groupBy("t").agg(F.count(F.lit(1)).alias("n")), "t")
    place = F.row_number().over(Window.partitionBy("ord").orderBy("n", "t"))
    prefix = ranked.withColumn("r", place).filter(F.col("r") <= F.col("m") - F.ceil(F.col("m") * F.lit(threshold)) + 1).select("ord", "t", "m")
    later = prefix.select(F.col("ord").alias("b"), "t", F.col("m").alias("n"))
    pairs = prefix.join(later, "t").filter((F.col("ord") < F.col("b")) & (F.least("m", "n") >= F.greatest("m", "n") * F.lit(threshold))).select(F.col("ord").alias("a"), "b").distinct()
    left, right = sized.select(F.col("ord").alias("a"), F.col("w").alias("x")), sized.select(F.col("ord").alias("b"), F.col("w").alias("y"))
    return repeats, pairs.join(left, "a").join(right, "b").filter(T.jaccard(F.col("x"), F.col("y")) >= threshold).select("a", "b")


def rejected(questions: DataFrame, keep, threshold: float = 0.85) -> DataFrame:
    """ord of the questions that are too like an accepted one before them; a rejected one stops no other.

    The order is settled in rounds, each kept: what stands after nothing is accepted, and
    rejects what is like it.  A repeat is rejected whatever becomes of the first.
    """
    repeats, pairs = alike(questions, threshold)
    edges, out = keep(pairs), keep(repeats)
    while edges.limit(1).count():
        free = edges.select(F.col("a").alias("ord")).join(edges.select(F.col("b").alias("ord")), "ord", "left_anti").distinct()
        gone = keep(edges.join(free, F.col("a") == F.col("ord"), "left_semi").select(F.col("b").alias("ord")).distinct())
        out = out.unionByName(gone)
        edges = keep(edges.join(gone, F.col("a") == F.col("ord"), "left_anti").join(gone, F.col("b") == F.col("ord"), "left_anti"))
    return out


def generate(plan: DataFrame, backend: Backend, folder: Folder, retries: int = 2, max_tokens: int = 640) -> DataFrame:
    """Plan rows (ord, task_id, source_task_id, variant_index, question, target_difficulty_bucket, mode, ...) -> candidates.

    What can't be read is asked again; what is too like an earlier candidate is asked once
    more with that said.  A candidate that never came is marked as failed.
    """
    ask = F.struct("mode", F.col("target_difficulty_bucket").alias("bucket"), F.col("target_step_count_range").alias("step_count_range"))
    rows = folder.keep(plan.withColumns({"_target": F.to_json(ask), "_feedback": F.lit("")}))
    settings = sampling(F.col("target_difficulty_bucket"), F.col("target_difficulty"))

    def asked(pending: DataFrame, tries: int) -> DataFrame:
        done, turn = None, 0
        while turn <= tries and pending.limit(1).count():
            raw = folder.keep(infer(pending, prompts.again(F.col("question"), F.col("_target"), F.col("_feedback")), backend, settings["temperature"], settings["top_p"], max(128, max_tokens)))
            read = folder.keep(raw.withColumn("g", jsonx.parse_candidate(F.col("raw"), F.col("target_difficulty_bucket"))).withColumn("_turn", F.lit(turn + 1)))
            good = F.col("g.found") & (F.col("g.question") != "") & (F.col("g.answer") != "")
            part = read if turn == tries else read.filter(good)
            done = part if done is None else done.unionByName(part)
            pending = folder.keep(read.filter(~good).withColumn("_feedback", F.lit("no usable question and answer")).select(rows.columns))
            turn += 1
        return folder.keep(done)

    first = asked(rows, retries)
    stopped = rejected(first.select("ord", F.col("g.question").alias("question")), folder.keep)
    if stopped.limit(1).count():
        again = asked(rows.join(stopped, "ord", "left_semi").withColumn("_feedback", F.lit("too_similar_to_previous_candidate")), 0)
        better = again.filter("g.question <> ''")
        first = first.join(better.select("ord"), "ord", "left_anti").unionByName(better)
    failed = ~(F.col("g.found") & (F.col("g.question") != "") & (F.col("g.answer") != "") & (F.size("g.steps") > 0))
    return first.select(
        "ord", "task_id", "source_task_id", "variant_index", "g.question", "g.steps", "g.solution", "g.solution_steps", "g.answer", "g.final_answer", "g.difficulty_bucket", "g.step_count", "source_question", "source_answer",
        F.col("_target").alias("generation_target"), failed.alias("generation_failed"), F.col("_turn").alias("generation_attempts"), F.when(failed, F.coalesce(F.nullif("request_error", F.lit("")), F.lit("no usable output"))).otherwise("").alias("generation_error"),
        F.col("raw").alias("raw_model_output"),
    )


#: What each output file of the older generator holds of a candidate.
FINAL = "task_id source_task_id variant_index question steps solution solution_steps answer final_answer difficulty_bucket step_count source_question source_answer generation_target generation_failed generation_attempts generation_error".split()
RAW = "task_id source_task_id variant_index question source_question source_answer generation_target raw_model_output generation_failed generation_error".split()


def projections(candidates: DataFrame) -> dict[str, DataFrame]:
    """final, raw, successes and failures of the candidates."""
    good = ~F.coalesce("generation_failed", F.lit(False)) & (F.coalesce("question", F.lit("")) != "") & (F.size("steps") > 0) & (F.coalesce("answer", F.lit("")) != "")
    final = candidates.select(FINAL)
    return {"final": final, "raw": candidates.select(RAW), "successes": final.filter(F.coalesce(good, F.lit(False))), "failures": final.filter(~F.coalesce(good, F.lit(False)))}


def _noise_inputs(items: DataFrame, sources: DataFrame, goals: DataFrame) -> DataFrame:
    rows = lookup(lookup(items, sources, ["source_task_id"], "_source"), goals, ["source_task_id"], "_target")
    return rows.select(
        *items.columns, F.coalesce("difficulty_bucket", F.lit("")).alias("bucket"), F.coalesce("_source.question", F.lit("")).alias("source_question"), F.coalesce("_source.answer", F.lit("")).alias("source_answer"),
        F.coalesce("_source.scene_template", F.lit("")).alias("source_scene"), F.coalesce("_target.bucket", F.lit("")).alias("target_bucket"), F.coalesce(F.col("_target.step_count_range")[0], F.lit(2)).alias("low"),
        F.coalesce(F.col("_target.step_count_range")[1], F.lit(4)).alias("high"), F.coalesce("_target.reference_step_count", F.lit(0)).alias("reference_step_count"),
    )


ITEM = ["task_id", "source_task_id", "question", "solution", "answer", "difficulty_bucket", "step_count"]


def repair_noise(items: DataFrame, sources: DataFrame, goals: DataFrame, backend: Backend, folder: Folder) -> DataFrame:
    """Items with their noise report; those with noise are rewritten by the backend once and looked at again."""
    report = F.struct("issues", "is_clean", "overlap_ratio", "repetition_penalty").alias("noise_report")
    seen = folder.keep(R.noise(_noise_inputs(items.select(ITEM), sources, goals)))
    clean = seen.filter("is_clean").select(*ITEM, report, F.lit(False).alias("repaired"), F.lit(False).alias("repair_failed"), F.lit("").alias("repair_notes"))
    given = seen.filter("NOT is_clean")
    raw = folder.keep(infer(given, prompts.clean(F.col("question"), F.col("solution"), F.col("answer"), F.col("issues"), F.col("target_bucket")), backend, 0.1, 0.8, 900))
    read = raw.withColumn("g", jsonx.parse_candidate(F.col("raw"), F.coalesce(F.nullif("target_bucket", F.lit("")), "difficulty_bucket")))
    or_own = lambda name: F.coalesce(F.nullif(F.col(f"g.{name}"), F.lit("")), F.col(name)).alias(name)
    count = F.coalesce(F.nullif("g.given_step_count", F.lit(0)), F.nullif("step_count", F.lit(0)), F.nullif("reference_step_count", F.lit(0)), F.lit(1)).cast("int").alias("step_count")
    new = read.select("task_id", "source_task_id", or_own("question"), or_own("solution"), or_own("answer"), F.col("g.difficulty_bucket").alias("difficulty_bucket"), count, F.col("g.notes").alias("repair_notes"))
    again = R.noise(_noise_inputs(new, sources, goals))
    return clean.unionByName(again.select(*ITEM, report, F.lit(True).alias("repaired"), (~F.col("is_clean")).alias("repair_failed"), "repair_notes"))


def evaluate(items: DataFrame, sources: DataFrame, goals: DataFrame, backend: Backend, folder: Folder) -> DataFrame:
    """Items with their evaluation by the backend, or by rules where it gave none."""
    rows = _noise_inputs(items.select(ITEM), sources, goals)
    raw = folder.keep(infer(rows, prompts.evaluate(F.col("question"), F.col("solution"), F.col("answer")), backend, 0.0, 1.0, 700))
    read = raw.withColumn("e", jsonx.parse_evaluation("raw")).withColumn("scores", F.struct(*(N.clamp_score(F.col(f"e.{d}"), 1).alias(d) for d in R.EVALUATED)))
    told = read.withColumn("v", R.evaluation_verdict(F.col("e.verdict"), F.col("scores")))
    issues = F.when((F.size("e.issues") == 0) & ~F.col("v.passed"), F.array(F.lit("model_rejected"))).otherwise(F.col("e.issues"))
    model = told.filter("e.found AND request_error = ''").select(*ITEM, F.struct("v.verdict", "scores", issues.alias("issues"), F.coalesce(F.nullif("e.short_reason", F.lit("")), F.lit("model_evaluation")).alias("short_reason"), "v.overall_score", "v.passed").alias("evaluation"))
    ruled = R.heuristic_scores(told.filter("NOT (e.found AND request_error = '')").drop("scores", "v", "e"))
    rule = F.struct(F.when(F.col("passed"), "pass").otherwise("fail").alias("verdict"), F.struct(*(F.col(d).cast("int").alias(d) for d in R.EVALUATED)).alias("scores"), "issues", F.lit("heuristic_evaluation").alias("short_reason"), "overall_score", "passed")
    return model.unionByName(ruled.select(*ITEM, rule.alias("evaluation")))


def inspect(items: DataFrame, backend: Backend, folder: Folder, turn: int, votes: int = 3) -> DataFrame:
    """(task_id, question, solution, answer, source_question, target) -> task_id and the votes' report."""
    each = items.withColumn("vote", F.explode(F.sequence(F.lit(0), F.lit(max(1, votes) - 1))))
    ask = prompts.inspect(F.col("question"), F.col("solution"), F.col("answer"), F.col("source_question"), F.col("target"), F.col("vote"), turn)
    raw = folder.keep(infer(each, ask, backend, 0.15 + F.col("vote") * 0.05, 0.9, 700))
    read = raw.withColumn("i", jsonx.parse_inspection("raw"))
    scored = folder.keep(read.select(F.col("task_id").alias("item"), "i.verdict", "i.issues", "i.repair_suggestions", *(N.clamp_score(F.col(f"i.{d}"), 3).alias(d) for d in R.INSPECTED)))
    report = R.aggregate_votes(scored, R.INSPECTED)
    hints = R.top_reasons(scored.select("item", F.explode("repair_suggestions").alias("hint")), ["item"], "hint", 5).groupBy("item").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "hint"))), lambda s: s["hint"]).alias("repair_suggestions"))
    return folder.keep(report.join(hints, "item", "left").withColumn("repair_suggestions", F.coalesce("repair_suggestions", F.array().cast("array<string>"))).withColumnRenamed("item", "task_id"))


def quality_loop(items: DataFrame, sources: DataFrame, goals: DataFrame, backend: Backend, folder: Folder, votes: int = 3, max_rounds: int = 3) -> DataFrame:
    """Inspects items; repairs what fails on even rounds and generates it anew on odd ones; a last inspection decides.

    Adds passed, rounds, verdict, issues, repair_suggestions and overall_score to the items as they are at the end.
    """
    rows = lookup(lookup(items.select(ITEM), sources, ["source_task_id"], "_s"), goals, ["source_task_id"], "_g")
    target = F.to_json(F.col("_g"))
    pending = folder.keep(rows.select(*ITEM, F.coalesce("_s.question", F.lit("")).alias("source_question"), F.coalesce("_g.bucket", F.lit("medium")).alias("bucket"), F.coalesce(target, F.lit("{}")).alias("target")))
    columns, done = pending.columns, None
    for turn in range(max_rounds + 1):
        report = inspect(pending, backend, folder, turn, votes).select("task_id", "verdict", "issues", "critical_issues", "repair_suggestions", "overall_score")
        judged = folder.keep(pending.join(report, "task_id").withColumns({"passed": F.col("verdict") == "pass", "rounds": F.lit(turn)}))
        over = judged if turn == max_rounds else judged.filter("passed")
        done = over if done is None else done.unionByName(over)
        failed = judged.filter("NOT passed")
        if turn == max_rounds or not failed.limit(1).count():
            break
        issues = F.concat("issues", "repair_suggestions")
        ask = prompts.clean(F.col("question"), F.col("solution"), F.col("answer"), issues, F.col("target")) if turn % 2 == 0 else prompts.again(F.col("question"), F.col("target"), F.array_join(issues, ", "))
        raw = folder.keep(infer(failed, ask, backend, 0.15 if turn % 2 == 0 else 0.55, 0.9, 1200))
        read = raw.withColumn("g", jsonx.parse_candidate(F.col("raw"), F.col("bucket")))
        new = lambda name: F.coalesce(F.nullif(F.col(f"g.{name}"), F.lit("")), F.col(name)).alias(name)
        count = F.coalesce(F.nullif("g.given_step_count", F.lit(0)), "step_count").cast("int").alias("step_count")
        pending = folder.keep(read.select("task_id", "source_task_id", new("question"), new("solution"), new("answer"), F.col("g.difficulty_bucket").alias("difficulty_bucket"), count, "source_question", "bucket", "target").select(columns))
    return done.select(*ITEM, "passed", "rounds", "verdict", "issues", "critical_issues", "repair_suggestions", "overall_score")
