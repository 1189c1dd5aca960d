"""Prompts as projections of a row: a head line that names the task, one line per field, and what to return."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import ws

RETURNS = {
    "answer": "an object with steps (a list of texts) and final_answer",
    "score": "an object with the lists correctness, logical, standardization, completeness and efficiency (a number from 0 to 1 for each step) and final_answer_correct",
    "generate": "an object with question, steps (a list of texts) and answer (a number)",
    "solve": "an object with solvable, unique_answer, steps, answer (a number) and confidence (0 to 1)",
    "audit": "an object with question_valid, solvable, unique_answer, answer_correct, steps_correct, difficulty_match, estimated_difficulty, estimated_step_count, first_error_step, error_type, repair_action, correct_answer and short_reason",
    "repair": "an object with question, steps (a list of texts) and answer (a number)",
    "refine": "an object with steps, each beginning with its label (Step 1:, Step 2:, ...) and telling why it is taken",
    "inspect": "an object with verdict (pass or fail), scores (1 to 5), issues, repair_suggestions and short_reason",
    "evaluate": "an object with verdict (pass or fail), scores (1 to 5 for correctness, difficulty_match, brevity, non_redundancy, answer_quality), issues and short_reason",
    "clean": "an object with question, solution, answer, difficulty_bucket, step_count and repair_notes",
}


def block(value: Column) -> Column:
    """A nested value as JSON."""
    return F.to_json(value)


def line(name: str, value: Column) -> Column:
    """One field on one line; nothing where it is null or empty."""
    text = ws(value.cast("string"))
    return F.when(text != "", F.concat(F.lit(f"{name}: "), text))


def prompt(task: str, *lines: Column) -> Column:
    return F.concat_ws("\n", F.lit(f"Task: {task}"), *lines, F.lit(f"Return {RETURNS[task]}."))


def numbered(steps: Column) -> Column:
    """Steps as lines of their own."""
    return F.array_join(F.transform(steps, lambda s, i: F.concat(F.lit("Step "), (i + 1).cast("string"), F.lit(": "), ws(s))), "\n")


def answer(question: Column) -> Column:
    return prompt("answer", line("Question", question))


def score(question: Column, reference: Column, steps: Column, final: Column, attempt: int) -> Column:
    return prompt("score", line("Attempt", F.lit(attempt)), line("Question", question), line("Reference", reference), numbered(steps), line("Final answer", final))


def active_scene(knowledge: Column, attempt: int) -> Column:
    """The plan's scene of an attempt: a ring over the primary and the alternative ones."""
    scenes = F.concat(F.array(knowledge["diversity"]["primary_scene"]), knowledge["diversity"]["alternative_scenes"])
    return F.try_element_at(scenes, (F.lit(attempt) % F.size(scenes) + 1).cast("int"))


def generate(seed_question: Column, difficulty: Column, knowledge: Column, attempt: int, reason: Column) -> Column:
    plan = knowledge["diversity"]
    return prompt(
        "generate", line("Attempt", F.lit(attempt)), line("Question", seed_question), line("Difficulty", difficulty), line("Skills", block(knowledge["math"])), line("Scene", block(active_scene(knowledge, attempt))),
        line("Variation", plan["variation_mode"]), line("Style", plan["narrative_style"]), line("Numbers", plan["number_strategy"]), line("Inspiration", block(knowledge["kb_inspiration"])), line("The last try failed", reason),
    )


def solve(question: Column, vote: Column, turn: int) -> Column:
    """Sees nothing but the question."""
    return prompt("solve", line("Round", F.lit(turn)), line("Vote", vote), line("Question", question))


def _item(question: Column, steps: Column, final: Column, difficulty: Column) -> list[Column]:
    return [line("Question", question), line("Steps", F.array_join(steps, " | ")), line("Answer", final), line("Difficulty", difficulty)]


def audit(question: Column, steps: Column, final: Column, difficulty: Column, consensus: Column, seed_question: Column) -> Column:
    return prompt("audit", *_item(question, steps, final, difficulty), line("Blind consensus", consensus), line("Seed question", seed_question))


def repair(action: Column, question: Column, steps: Column, final: Column, difficulty: Column, reasons: Column, consensus: Column, note: Column, plan: Column, seed_question: Column) -> Column:
    return prompt(
        "repair", line("Action", action), *_item(question, steps, final, difficulty), line("Faults", F.array_join(reasons, ", ")), line("Blind consensus", consensus), line("Auditor's note", note), line("New plan", plan),
        line("Seed question", seed_question),
    )


def refine(question: Column, steps: Column, final: Column, turn: int, issue: Column) -> Column:
    return prompt("refine", line("Attempt", F.lit(turn + 1)), line("Question", question), line("Steps", F.array_join(steps, " | ")), line("Answer", final), line("The last try failed", issue))


def inspect(question: Column, solution: Column, final: Column, source_question: Column, target: Column, vote: Column, turn: int) -> Column:
    return prompt("inspect", line("Round", F.lit(turn)), line("Vote", vote), line("Question", question), line("Solution", solution), line("Answer", final), line("Source question", source_question), line("Target", target))


def evaluate(question: Column, solution: Column, final: Column) -> Column:
    return prompt("evaluate", line("Question", question), line("Solution", solution), line("Answer", final))


def clean(question: Column, solution: Column, final: Column, issues: Column, target: Column) -> Column:
    return prompt("clean", line("Question", question), line("Solution", solution), line("Answer", final), line("Faults", F.array_join(issues, ", ")), line("Target", target))


def again(card: Column, target: Column, feedback: Column) -> Column:
    """Generation after a failure, with what was wrong."""
    return prompt("generate", line("Question", card), line("Target", target), line("Feedback", feedback))
