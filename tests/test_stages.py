import json

import pytest

from weftline.config import Config
from weftline.plans import stages
from weftline.plans.backend import StubBackend
from weftline.sources.store import Folder


@pytest.fixture
def seeds(spark, tmp_path):
    rows = [{"task_id": str(i + 10), "question": f"There are {i} bags of {i + 2} books. How many books altogether?", "answer": f"{i} * {i + 2} = <<{i}*{i + 2}={i * (i + 2)}>>\n#### {i * (i + 2)}", "question_type": "gsm"} for i in range(2, 5)]
    rows.append({"question": "What is 3 times 4?", "answer": "12"})
    (tmp_path / "seeds.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    return stages.read_seeds(spark, str(tmp_path / "seeds.jsonl"))


def test_a_run_from_seeds_to_training_records(spark, seeds, tmp_path):
    folder = Folder(spark, str(tmp_path / "run"))
    config = Config(n_answers=1, multiplier=3.0, n_min=1, n_max=4, qc_max_rounds=1, qc_backtracks=0, gen_max_retries=1, refine_max_rounds=1)
    out = stages.run(seeds, StubBackend(), folder, config)
    assert out.columns == ["instruction", "input", "output"] and 0 < out.count() <= 12
    assert all("\\boxed{" in r["output"] and r["output"].startswith("Step 1: Given the numbers") for r in out.collect())
    read = lambda name: json.loads((tmp_path / "run" / name).read_text())
    plans = read("plan.summary.json")
    assert plans["plan_count"] == 8 and plans["source_count"] == 4 and plans["unique_plan_signatures"] == 8
    assert read("manifest.json")["counts"]["kb_records"] == 4 and read("training.summary.json")["output_count"] == out.count()
    assert [r["task_id"] for r in folder.read("mastery.jsonl", "task_id string").collect()] == ["12", "13", "14", "3"]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "run").rglob("part-*")}
    assert stages.run(seeds, StubBackend(), folder, config).count() == out.count()
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "run").rglob("part-*")}
    cards = stages.build_plan_cards(folder, Folder(spark, str(tmp_path / "cards")))
    assert cards.count() == 4 and json.loads((tmp_path / "cards" / "summary.json").read_text())["plan_count"] == 4
    with pytest.raises(FileNotFoundError):
        stages.build_plan_cards(Folder(spark, str(tmp_path / "nothing")), folder)


def test_the_first_seeds(spark, seeds, tmp_path):
    assert [r["ord"] for r in stages.read_seeds(spark, str(tmp_path / "seeds.jsonl"), 2).collect()] == [0, 1]


def test_settings():
    assert Config.read({"N_ANSWERS": "10", "GEN_MAX_RETRIES": "x", "STAGE_FORCE": "Yes", "RUN_VALIDATION": "0", "BALANCE": "0.5"}) == Config(n_answers=10, stage_force=True, run_validation=False, balance=0.5)
