import hashlib

import pytest
from pyspark.sql import functions as F

from weftline import catalog
from weftline.functions import jsonx
from weftline.functions import text as T
from weftline.operators import kb, planning
from weftline.plans import rounds
from weftline.plans.backend import StubBackend, infer
from weftline.sources.store import Folder


def stable(text):
    return int(hashlib.sha256(text.encode()).hexdigest()[:16], 16)


@pytest.mark.parametrize("width", [3.0, 1e-3])
def test_scene_sources_against_all_pairs_in_small_cells(spark, monkeypatch, width):
    monkeypatch.setattr(planning, "SEED_BLOCK", 2)
    monkeypatch.setattr(planning, "RECORD_BLOCK", 7)
    buckets = ["easy", "medium", "hard", "very_hard"]
    records = [(i, str(i if i < 39 else 3), [f"s{i % 3}", f"t{i % 2}"], [f"o{i % 4}"], buckets[i % 4]) for i in range(40)]
    kb = spark.createDataFrame(records, "ord int, task_id string, skills array<string>, ops array<string>, bucket string")
    seeds = kb.filter("ord < 5").select("task_id", "skills", "ops", "bucket", F.lit("hard").alias("target_bucket"), F.lit(4).alias("target_count"))
    got = {(r["task_id"], r["variant"]): (r["score"], r["source_id"]) for r in planning.scene_sources(seeds, kb, width).collect()}
    want = {}
    for _, x, skills, ops, _ in records[:5]:
        score = lambda r: 20 * len({*r[2]} & {*skills}) + 8 * len({*r[3]} & {*ops}) - 10 * abs(buckets.index(r[4]) - 2)  # noqa: B023, E731
        others = sorted((r for r in records if r[1] != x), key=lambda r: (-score(r), stable(f"{x}|{r[1]}"), r[0]))  # noqa: B023
        for v in range(4):
            r = others[(stable(f"{x}|hard") + v) % len(others)]
            want[x, v] = (score(r), r[1])
    assert got == want


def test_parts_count_with_their_whole_brand_and_name(spark, sf):
    row = catalog._part_kb(spark, sf).join(catalog.t(spark, sf, "part").select(F.col("p_partkey").alias("ord"), "p_brand", "p_type", "p_name"), "ord").first()
    assert row["skills"] == [row["p_brand"], row["p_type"]] and row["ops"] == row["p_name"].split(" ")


def test_only_prompts_go_to_python_and_kept_rows_are_read_by_all_cores(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    kept = folder.keep(spark.range(25_000).coalesce(1).withColumn("nested", F.struct("id")))
    assert len(kept.inputFiles()) == 3
    asked = infer(kept, F.concat(F.lit("Question: 2 * "), F.col("id").cast("string")), StubBackend(), F.lit(0.5))
    assert "MapInPandas" not in asked._jdf.queryExecution().toString() and asked.columns == ["id", "nested", "raw", "request_error"]
    assert asked.filter("nested.id = id AND request_error = '' AND raw <> ''").count() == 25_000


def test_banks_of_texts_are_those_of_records(spark):
    say = lambda i: ["Maria buys 3 eggs. How many Total Eggs and total eggs?", "Tom packs 2 boxes.  How many?", " Maria  buys 3 eggs. How many Total Eggs and total eggs?"][i % 3]
    rows = [(i, None if i == 5 else str(90 - i), say(i), str(i % 2), "<<1+2=3>>", [None, "", "a", "b"][i % 4]) for i in range(24)] + [(99, "x", " ", "1", "", "a")]
    given = spark.createDataFrame(rows, "ord long, task_id string, question string, answer string, solution_steps string, question_type string")
    plain, texts = kb.records(given), kb.text_records(given).persist()
    assert texts.count() == 6 and texts.agg(F.sum("n")).first()[0] == 24
    for bank in (kb.concept_bank, kb.scene_bank, kb.template_bank, kb.knowledge_bank):
        assert bank(texts, given).collect() == bank(plain).collect()


def test_white_space_and_sentences(spark):
    texts = ["a b", " a  b\t\tc ", "a\n b c  d", "", None, "  ", "One.\nTwo  x. One . Two x! ?"]
    df = spark.createDataFrame([(x,) for x in texts], "x string").select(T.ws(F.col("x")).alias("w"), T.sentences(F.col("x")).alias("s")).collect()
    assert [r["w"] for r in df] == [" ".join((x or "").split()) for x in texts]
    assert df[-1]["s"] == ["One.", "Two x.", "One .", "Two x!", "?"]


def test_equal_replies_of_a_batch_are_read_once(spark, tmp_path):
    log = tmp_path / "log"

    def parse(x):
        with open(log, "a") as f:
            f.write(f"{x}\n")
        return {"a": x}

    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,), (None,)], "raw string").coalesce(1)
    assert [r[0] for r in df.select(jsonx._frame(parse, "a string, b int")("raw").alias("p")).select("p.a").collect()] == ["x", "y", "x", None, None]
    assert sorted(log.read_text().split()) == ["None", "x", "y"]


def test_texts_are_counted(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2), ("b", 1)], "x string, y int")
    assert sorted(map(tuple, catalog.counted(df, "x", "y").collect()), key=repr) == sorted([("a", 1, 2), (None, 2, 2), ("b", 1, 1)], key=repr)


def test_failures_without_a_plan_go_and_others_take_theirs(spark):
    plans = spark.range(6).select(F.concat_ws("_", F.lit("p"), F.col("id").cast("string")).alias("plan_id"), F.expr("named_struct('at', id)").alias("knowledge"))
    none = F.lit(None).cast("struct<at:bigint>")
    failed = spark.createDataFrame([("p_1",), ("p_1",), ("q",)], "plan_id string").select("plan_id", *(F.lit("x").alias(c) for c in ("source_task_id", "difficulty", "question", "error_type", "repair_action")), F.lit(0).alias("round"), F.when(F.col("plan_id") == "p_1", F.expr("named_struct('at', 7L)")).alias("next_plan"), none.alias("active_plan"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(rounds.P, "replan", lambda known, *_: known)
        out = rounds.failures_to_retry(failed, plans)
    assert sorted((r["plan_id"], r["plan"]["at"], r["next_plan"]["at"]) for r in out.collect()) == [("p_1", 1, 7), ("p_1", 1, 7)] and "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
