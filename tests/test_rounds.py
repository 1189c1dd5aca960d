import json

import pytest
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import planning as P
from weftline.plans import assess, legacy, rounds
from weftline.plans.backend import HttpBackend, StubBackend, model_names
from weftline.sources import jsonl
from weftline.sources.store import Folder, export_summary
from weftline.streaming import precheck as stream

ITEM = "source_task_id string, plan_id string, difficulty string, question string, steps array<string>, answer string"


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, str(tmp_path / "stage"))


def plans(spark, words=("books",), n=6):
    scene = F.element_at(P.domain_array(), 1)
    none = F.array().cast("array<string>")
    inspired = F.struct(T.strings(words).alias("scene_keywords"), none.alias("possible_roles"), none.alias("possible_units"), none.alias("related_skill_tags"), F.lit("").alias("policy"))
    math = F.struct(none.alias("skill_tags"), none.alias("operation_sequence"), F.lit("").alias("knowledge_signature"), F.lit(1).alias("reference_step_count"), F.lit("Equal").alias("target_difficulty"))
    d = P.diversity(F.col("source_task_id"), F.lit(0)).withField("primary_scene", scene).withField("alternative_scenes", F.array(scene))
    rows = spark.range(1, n + 1).select(F.col("id").alias("ord"), F.col("id").cast("string").alias("source_task_id"))
    return rows.select("ord", "source_task_id", F.concat(F.lit("p"), "source_task_id").alias("plan_id"), F.struct(math.alias("math"), d.alias("diversity"), inspired.alias("kb_inspiration")).alias("knowledge"))


def seeds(spark, n=6, noun="books"):
    return spark.createDataFrame([(i, f"{i} boxes of {i + 1} {noun}. How many?", "Equal") for i in range(1, n + 1)], "task_id long, question string, target_difficulty string")


def scripted(log, **answers):
    """A backend that answers by task with texts, or with the next of a list of texts; each prompt goes to a log."""

    class Scripted:
        def complete(self, prompts, settings):
            out = []
            for p, s in zip(prompts, settings):
                with open(log, "a") as f:
                    f.write(json.dumps([p, s]) + "\n")
                given = answers[p.split("\n")[0].removeprefix("Task: ")]
                seen = sum(json.loads(x)[0].split("\n")[0] == p.split("\n")[0] for x in open(log))
                text = given[min(seen, len(given)) - 1] if isinstance(given, list) else given
                out.append(("", text) if text.startswith("Timeout") else (text, ""))
            return out

    return Scripted()


def asked(log, task):
    return [(p, s) for p, s in map(json.loads, open(log)) if p.startswith(f"Task: {task}\n")]


GOOD_AUDIT = json.dumps(dict(question_valid=True, solvable=True, unique_answer=True, answer_correct=True, steps_correct=True, difficulty_match=True, estimated_difficulty="Equal", repair_action="pass", error_type="none"))
BAD_AUDIT = json.dumps(dict(json.loads(GOOD_AUDIT), steps_correct=False, repair_action="repair_solution", short_reason="step 1 is wrong"))
VOTE = json.dumps(dict(solvable=True, unique_answer=True, answer="12", confidence=0.5, steps=["a", "b"]))
OTHER = json.dumps(dict(solvable=True, unique_answer=True, answer="13", confidence=0.5))


# -- generation


def test_generation_retries_only_what_failed(spark, folder):
    good, bad = rounds.generate(plans(spark), seeds(spark), StubBackend(), folder, max_retries=2)
    assert sorted(r["plan_id"] for r in good.collect()) == [f"p{i}" for i in range(1, 7)] and bad.count() == 0
    assert {r["plan_id"]: r["attempts"] for r in good.collect()} == {f"p{i}": 2 if (2 * i + 1) % 3 == 0 else 1 for i in range(1, 7)}
    first = json.loads(open(f"{folder.path}/generated.rounds/round_000.summary.json").read())
    assert first == {"round": 0, "attempted": 6, "success": 4, "failed": 2, "failure_types": {"invalid_json": 2}}
    assert folder.read("failed.jsonl", "plan_id string").count() == 0
    assert [r["plan_id"] for r in folder.read("generated.jsonl", "plan_id string").collect()] == [f"p{i}" for i in range(1, 7)]


def test_misaligned_plans_stay_failed(spark, folder):
    good, bad = rounds.generate(plans(spark, ("piano",), 1), seeds(spark, 1, "hats"), StubBackend(), folder, max_retries=1)
    assert good.count() == 0 and [(r["attempts"], r["failure_type"], r["next_plan"]) for r in bad.collect()] == [(2, "plan_mismatch", None)]


def test_generation_goes_on_where_it_was_left(spark, folder, tmp_path):
    log, fine = tmp_path / "log", json.dumps(dict(question="2 boxes of 3 books?", steps=["2 * 3 = 6"], answer="6"))
    _, bad = rounds.generate(plans(spark, n=1), seeds(spark, 1), scripted(log, generate="Timeout: none"), folder, max_retries=0)
    assert [(r["failure_type"], r["attempts"]) for r in bad.collect()] == [("request_error", 1)]
    good, bad = rounds.generate(plans(spark, n=2), seeds(spark, 2), scripted(log, generate=fine), folder, max_retries=1)
    assert {r["plan_id"]: r["attempts"] for r in good.collect()} == {"p1": 2, "p2": 2} and bad.count() == 0
    assert ["The last try failed: Timeout: none" in p for p, _ in asked(log, "generate")].count(True) == 1
    before = len(asked(log, "generate"))
    good, _ = rounds.generate(plans(spark, n=2), seeds(spark, 2), scripted(log, generate=fine), folder, max_retries=1)
    assert good.count() == 2 and len(asked(log, "generate")) == before


def test_failures_with_no_tries_left_stay(spark):
    kind = plans(spark).schema["knowledge"].dataType
    rows = plans(spark, n=4).withColumns({"attempts": F.col("ord").cast("int"), "failure_type": F.lit("similarity"), "plan": F.col("knowledge"), "next_plan": F.lit(None).cast(kind)})
    done = rows.filter("ord = 1")
    left = rounds.resumable_failures(rows, done, max_retries=3).collect()
    assert {r["plan_id"]: r["retry_round"] for r in left} == {"p2": 2, "p3": 3}
    assert all(r["next_plan"]["diversity"]["replanned_round"] == r["retry_round"] and not r["next_plan"]["kb_inspiration"]["scene_keywords"] for r in left)
    assert rounds.resumable_failures(rows, done, max_retries=-1, retry_completed=True).count() == 4


# -- validation


def validated(spark, folder, backend, question="How many?", step="So it is 12", **options):
    rows = spark.createDataFrame([("s", "a", "Equal", question, [step], "12")], ITEM).coalesce(1)
    good, bad, reports = rounds.validate(rows, backend, folder, plans(spark, n=1).withColumn("plan_id", F.lit("a")), **options)
    return good.collect(), bad.collect(), reports.orderBy("round").collect()


def test_a_wrong_answer_is_repaired(spark, folder):
    rows = [("1", "a", "Equal", "Tom has 3 bags of 4 eggs. How many eggs?", ["3 * 4 = 12"], "12"), ("2", "b", "Equal", "Ann has 5 bags of 6 eggs. How many eggs?", ["5 * 6 = 31"], "31")]
    good, bad, _ = rounds.validate(spark.createDataFrame(rows, ITEM), StubBackend(), folder, max_rounds=1)
    assert {r["plan_id"]: (r["answer"], r["round"]) for r in good.collect()} == {"a": ("12", 0), "b": ("30", 1)} and bad.count() == 0
    assert folder.complete(["validated.jsonl"]) and not folder.complete(["validated.jsonl", "validation_failed.jsonl"]) and not folder.complete(["nothing.jsonl"])


def test_a_split_vote_gets_a_third(spark, folder, tmp_path):
    log = tmp_path / "log"
    good, _, reports = validated(spark, folder, scripted(log, solve=[VOTE, OTHER, VOTE], audit=GOOD_AUDIT))
    assert [r["round"] for r in good] == [0] and [s["temperature"] for _, s in asked(log, "solve")] == pytest.approx([0.1, 0.15, 0.2])
    assert reports[0]["blind_summary"]["answers"] == ["12", "13", "12"] and reports[0]["blind_summary"]["representative_steps"] == ["a", "b"]


def test_wrong_steps_are_audited_and_repaired(spark, folder, tmp_path):
    log = tmp_path / "log"
    fixed = json.dumps(dict(question="Another?", steps=["GOOD, 12"], answer="12"))
    good, _, _ = validated(spark, folder, scripted(log, solve=VOTE, audit=[BAD_AUDIT, GOOD_AUDIT], repair=fixed))
    assert [(r["round"], r["question"], r["steps"]) for r in good] == [(1, "How many?", ["GOOD, 12"])]
    (prompt, setting), = asked(log, "repair")
    assert "Action: repair_solution" in prompt and "Auditor's note: step 1 is wrong" in prompt and setting["temperature"] == 0.2


def test_stubborn_failures_are_replanned(spark, folder, tmp_path):
    log = tmp_path / "log"
    fixes = [json.dumps(dict(question="Q?", steps=[f"GOOD {i}, 12"], answer=str(12 + i))) for i in range(9)]
    _, bad, reports = validated(spark, folder, scripted(log, solve=VOTE, audit=BAD_AUDIT, repair=fixes), max_rounds=2, replan_after=2)
    told = [p for p, _ in asked(log, "repair")]
    assert ["Action: regenerate_question" in p for p in told] == [False, True]
    assert bad[0]["active_plan"]["diversity"]["replan_reason"] == "stubborn_validation" and [r["replan_count"] for r in reports] == [0, 0, 1]
    assert [r["quality_failures"] for r in reports] == [0, 1, 0]


def test_unreadable_votes_lead_to_a_new_plan(spark, folder, tmp_path):
    log = tmp_path / "log"
    fixed = json.dumps(dict(question="Q?", steps=["GOOD, 12"], answer="12"))
    good, _, reports = validated(spark, folder, scripted(log, solve=["no"] * 6 + [VOTE], audit=GOOD_AUDIT, repair=fixed), max_rounds=3, retry_replan_after=2)
    assert [(r["repair_action"], r["error_type"], r["reasons"]) for r in reports[:2]] == [("retry_validation", "request_error", ["blind_request_error"])] * 2
    assert [r["retry_failures"] for r in reports] == [0, 1, 0] and len(asked(log, "repair")) == 1 and [r["round"] for r in good] == [2]
    assert reports[2]["active_plan"]["diversity"]["replan_reason"] == "validation_response_failure"


def test_a_lost_audit_is_asked_again(spark, folder, tmp_path):
    good, _, reports = validated(spark, folder, scripted(tmp_path / "log", solve=VOTE, audit=["Timeout: x", GOOD_AUDIT]))
    assert [r["reasons"] for r in reports] == [["audit_request_error"], []] and [r["round"] for r in good] == [1]


def test_backtracking_generates_anew(spark, folder):
    good, bad = rounds.validate_with_backtracking(plans(spark, n=3), seeds(spark, 3), StubBackend(), folder, backtracks=1, max_rounds=0)
    assert good.count() == 3 and bad.count() == 0


# -- answers and scores


ANSWERS = [("1_0", "1", 0, "q 2 3?", "6", ["2 * 3"], "6", "6", True), ("1_1", "1", 1, "q 2  3?", "6", ["2 * 3"], "6", "6", True)]
SCORES = json.dumps({k: [1.0] for k in ("correctness", "logical", "standardization", "completeness", "efficiency")} | {"final_answer_correct": True})


def test_equal_answers_are_scored_once(spark, folder, tmp_path):
    log = tmp_path / "log"
    out = assess.score(spark.createDataFrame(ANSWERS, assess.ANSWER), scripted(log, score=SCORES), folder)
    assert sorted((r["task_id"], r["step_score_mean"], r["steps"][0]["text"]) for r in out.collect()) == [("1_0", 1.0, "2 * 3"), ("1_1", 1.0, "2 * 3")] and len(asked(log, "score")) == 1
    assert len({r["task_id"] for r in assess.score(spark.createDataFrame(ANSWERS, assess.ANSWER), scripted(log, score=SCORES), folder).collect()}) == 2 and len(asked(log, "score")) == 1


def test_scores_are_asked_again(spark, folder, tmp_path):
    log = tmp_path / "log"
    out = assess.score(spark.createDataFrame(ANSWERS[:1], assess.ANSWER), scripted(log, score=["no json", SCORES]), folder)
    assert out.collect()[0]["overall_reason"] == "" and len(asked(log, "score")) == 2 and asked(log, "score")[0][1]["max_tokens"] == 1200
    with pytest.raises(RuntimeError, match="exhausted"):
        assess.score(spark.createDataFrame(ANSWERS[:1], assess.ANSWER), scripted(log, score="no"), Folder(spark, str(tmp_path / "b")), max_retries=0, fallback=False)


def test_half_done_duplicates_need_no_call(spark, folder, tmp_path):
    log = tmp_path / "log"
    assess.score(spark.createDataFrame(ANSWERS[:1], assess.ANSWER), scripted(log, score=SCORES), folder)
    out = assess.score(spark.createDataFrame(ANSWERS, assess.ANSWER), scripted(log, score="never"), folder)
    assert out.count() == 2 and len(asked(log, "score")) == 1


def test_answers_resume(spark, folder, tmp_path):
    log = tmp_path / "log"
    given = spark.createDataFrame([(1, "1", "2 and 3?", "6")], "ord long, task_id string, question string, answer string")
    reply = json.dumps(dict(steps=["x"], final_answer="6.0"))
    assert [r["is_correct"] for r in assess.answer(given, scripted(log, answer=reply), folder, attempts=2).collect()] == [True, True]
    out = assess.answer(given, scripted(log, answer=reply), folder, attempts=3)
    assert [r["task_id"] for r in out.collect()] == ["1_0", "1_1", "1_2"] and len(asked(log, "answer")) == 3


# -- the older tools


def test_noise_is_repaired_once(spark, folder, tmp_path):
    items = spark.createDataFrame([("1", "1", "short", "a b", "5", "easy", 1), ("2", "2", "How many eggs are in the big basket?", "a b", "5", "easy", 1)], "task_id string, source_task_id string, question string, solution string, answer string, difficulty_bucket string, step_count int")
    none = spark.createDataFrame([], "task_id string, question string, answer string, scene_template string")
    goals = spark.createDataFrame([("1", "easy", [1, 2], 1), ("2", "easy", [1, 2], 1)], "task_id string, bucket string, step_count_range array<int>, reference_step_count int")
    log = tmp_path / "log"
    out = legacy.repair_noise(items, none, goals, scripted(log, clean='{"question": "How many hens are on the green farm?"}'), folder).orderBy("task_id").collect()
    assert [(r["repaired"], r["repair_failed"], r["question"], r["solution"]) for r in out] == [(True, False, "How many hens are on the green farm?", "a b"), (False, False, "How many eggs are in the big basket?", "a b")]
    assert len(asked(log, "clean")) == 1


def test_quality_loop_repairs_then_generates(spark, folder, tmp_path):
    items = spark.createDataFrame([("1", "1", "q", "s", "5", "easy", 1)], "task_id string, source_task_id string, question string, solution string, answer string, difficulty_bucket string, step_count int")
    none, log = spark.createDataFrame([], "task_id string, question string"), tmp_path / "log"
    goals = spark.createDataFrame([("1", "easy")], "task_id string, bucket string")
    fine = json.dumps(dict(verdict="pass", scores=dict.fromkeys(("difficulty_match", "correctness", "answer_uniqueness", "step_validity", "brevity"), 5)))
    poor = json.dumps(dict(verdict="fail", issues=["vague"], repair_suggestions=["say more"]))
    backend = scripted(log, inspect=[poor, poor, fine], clean='{"question": "r"}', generate='{"question": "g", "answer": "7"}')
    out = legacy.quality_loop(items, none, goals, backend, folder, votes=1, max_rounds=2).collect()
    assert [(r["passed"], r["rounds"], r["question"], r["answer"], r["solution"]) for r in out] == [(True, 2, "g", "7", "s")]
    assert len(asked(log, "clean")) == 1 and "vague, say more" in asked(log, "clean")[0][0]


def test_evaluation_falls_back_to_rules(spark, folder, tmp_path):
    items = spark.createDataFrame([("1", "1", "How many eggs are there?", "two steps. then done.", "5", "easy", 1)], "task_id string, source_task_id string, question string, solution string, answer string, difficulty_bucket string, step_count int")
    none, goals = spark.createDataFrame([], "task_id string, question string, answer string, scene_template string"), spark.createDataFrame([], "task_id string, bucket string, step_count_range array<int>, reference_step_count int")
    out = legacy.evaluate(items, none, goals, scripted(tmp_path / "log", evaluate="Timeout: x"), folder).collect()[0]["evaluation"]
    assert out["short_reason"] == "heuristic_evaluation" and out["scores"]["correctness"] == 5
    low = json.dumps(dict(verdict="pass", scores=dict(correctness=3, difficulty_match=5, brevity=5, non_redundancy=5, answer_quality=5)))
    out = legacy.evaluate(items, none, goals, scripted(tmp_path / "log2", evaluate=low), folder).collect()[0]["evaluation"]
    assert (out["passed"], out["issues"], out["overall_score"]) == (False, ["model_rejected"], 4.6)


def test_later_alike_questions_are_rejected_in_order(spark, folder):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    w = base.split()
    rows = [base, " ".join(w[:19] + ["x"]), " ".join(w[:17] + ["x", "y", "z"]), "other", base.upper(), "", " ".join(w[:16] + ["x", "y", "z", "v"])]
    seen, want = [], []
    for i, q in enumerate(rows):
        a = set(q.lower().split())
        if a and any(len(a & b) / len(a | b) >= 0.85 for b in seen):
            want.append(i)
        elif a:
            seen.append(a)
    got = legacy.rejected(spark.createDataFrame(list(enumerate(rows)), "ord long, question string"), folder.keep)
    assert sorted(r["ord"] for r in got.collect()) == want and 1 in want and 2 not in want


# -- backends, files


def test_http_backend(monkeypatch):
    calls = []

    def call(self, path, body=None):
        calls.append((path, body))
        if path == "models":
            return {"data": [{"id": "b"}, {"id": "models/tiny"}]}
        if body["model"] == "/x/tiny/":
            fault = OSError("not found")
            fault.code = 404
            raise fault
        if "bad" in body["messages"][0]["content"]:
            raise OSError("down")
        return {"choices": [{"message": {"content": body["messages"][0]["content"].upper()}}]}

    monkeypatch.setattr(HttpBackend, "_call", call)
    monkeypatch.setattr("time.sleep", lambda s: calls.append(("sleep", s)))
    out = HttpBackend("http://h", "/x/tiny/", retries=2, concurrency=1).complete(["a", "bad", "c"], [{"temperature": 0.5}] * 3)
    assert out == [("A", ""), ("", "OSError: down"), ("C", "")] and [c[1] for c in calls if c[0] == "sleep"] == [3, 6]
    assert sum(c[0] == "models" for c in calls) == 1 and model_names("/x/tiny/") == {"/x/tiny/", "/x/tiny", "tiny"}


def test_refinement_keeps_other_columns(spark, folder):
    items = spark.createDataFrame([("s", "a", "How many are 3 and 4?", ["x"], "12", 9), ("s", None, "What are 1 and 1?", ["x"], "1", 8)], "source_task_id string, plan_id string, question string, steps array<string>, answer string, other int")
    good, bad = rounds.refine(items, StubBackend(), folder)
    assert sorted((r["other"], r["steps"][0][:7]) for r in good.collect()) == [(8, "Step 1:"), (9, "Step 1:")] and bad.count() == 0 and good.columns == items.columns


def test_jsonl(spark, tmp_path):
    assert jsonl.read(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\n\n{broken\n[{"a": 2}]\n{"a": 3}\n')
    assert [r["a"] for r in jsonl.read(spark, str(p), "a int", tolerant=True).orderBy("a").collect()] == [1, 3]
    with pytest.raises(Exception):
        jsonl.read(spark, str(p), "a int").collect()
    jsonl.write(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "out"), single=True)
    assert json.loads(next((tmp_path / "out").glob("part-*")).read_text()) == {"a": 1, "b": None}


def test_documents_and_dispatch(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1},\n {"a": 2}]')
    (tmp_path / "b.jsonl").write_text('{"a": 3}\n')
    assert sorted(r["a"] for r in jsonl.load(spark, str(tmp_path / "a.json"), "a int").collect()) == [1, 2]
    assert [r["a"] for r in jsonl.load(spark, str(tmp_path / "b.jsonl"), "a int").collect()] == [3]
    assert jsonl.load(spark, str(tmp_path / "c.json"), "a int").count() == 0
    numbered = jsonl.numbered(spark, str(tmp_path / "b.jsonl"), "a int")
    assert [(r["ord"], r["a"]) for r in jsonl.ordered_head(numbered, "ord", 1).collect()] == [(0, 3)]
    f = Folder(spark, str(tmp_path / "f"))
    f.document("x.json", {"ü": 1})
    assert (tmp_path / "f" / "x.json").read_text() == '{\n  "ü": 1\n}' and export_summary(3, 2)["pass_rate"] == 0.6667
    f.append("log.jsonl", spark.createDataFrame([(1,)], "a int"))
    f.append("log.jsonl", spark.createDataFrame([(2,)], "a int"))
    assert sorted(r["a"] for r in f.read("log.jsonl", "a int").collect()) == [1, 2]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, r in enumerate(("6", "7")):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"source_task_id": "s", "plan_id": f"p{i}", "question": "How many eggs?", "steps": [f"2 * 3 = {r}"], "answer": r}) + "\n")
    q = stream.start(stream.candidates(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = {r["plan_id"]: r["issues"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"p0": [], "p1": ["arithmetic_error"]}
