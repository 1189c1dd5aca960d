import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from weftline import catalog
from weftline.functions import arithmetic, jsonx
from weftline.functions import numeric as N
from weftline.functions import text as T
from weftline.operators import kb, planning, quota, validate

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(n for n in catalog.ORACLES if "stage" not in n))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got, want = catalog.QUERIES[name](spark, sf), con.sql(catalog.ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    a = sorted(repr([plain(r[c]) for c in names]) for r in got.collect())
    b = sorted(repr([plain(r[want.columns.index(c)]) for c in names]) for r in want.fetchall())
    assert a == b and a


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())).select(column).first()[0]


def test_equations():
    assert arithmetic.errors(["2 * 3 = 7"])[0]["calculated"] == 6
    assert arithmetic.errors(["20% of $120 = 0.20 * 120 = $24"]) == []
    assert [e["expression"] for e in arithmetic.errors(["(400 - 300) / 50 = 100 / 50 = 3"])] == ["100 / 50"]
    assert arithmetic.value("2 ** 3") is None and arithmetic.value("1 / 0") is None and arithmetic.value("-(2 + 3) * 2") == -10


@pytest.mark.parametrize("raw,want", [("$1,200 dollars", "1200"), ("3/4", "3/4"), ("none", ""), ("9,999", "9999")])
def test_normalize_answer(spark, raw, want):
    assert one(spark, T.normalize_answer(F.col("x")), x=raw) == want and jsonx.answer_of(raw) == want


@pytest.mark.parametrize("v,want", [(0.55, 0.6), (2.0, 0.2), (3.0, 0.4), (4.0, 0.8), (5.0, 1.0), (7.0, 0.0)])
def test_step_scores_snap(spark, v, want):
    assert math.isclose(one(spark, N.snap_score(F.col("x")), x=v), want) and math.isclose(jsonx.snapped(v), want)


@pytest.mark.parametrize("m,want", [(0.2, "Easy"), (0.2001, "Slightly Easy"), (0.6, "Equal"), (0.8, "Slightly Hard"), (0.8001, "Hard")])
def test_labels(spark, m, want):
    assert one(spark, N.difficulty_label(F.col("x")), x=m) == want


def test_untidy_json():
    body = '{"question": "q?", "steps": ["a", "b"], "answer": "5"}'
    for raw in (body, f"```json\n{body}\n```", f"Sure: {body} ok", '"' + body.replace('"', '\\"') + '"', body.replace('"5"}', '"5",}')):
        assert jsonx.generated(raw) == {"question": "q?", "steps": ["a", "b"], "answer": "5", "error": ""}
    assert jsonx.generated("nothing")["error"] == "response is not a valid JSON object"
    assert jsonx.victim('{"steps": ["one", "two"], "final_answer": 7')["steps"] == ["one", "two"]
    assert jsonx.generated('{"question":"q","solution":"first line\\nsecond line","answer":"9,999"}')["steps"] == ["first line", "second line"]


def test_equal_masteries_share_alike(spark):
    seeds = spark.createDataFrame([(i, i, 0.5, "x") for i in range(4)], "ord long, task_id long, mastery double, category string")
    assert [r["target_count"] for r in quota.settle(quota.allocate(seeds)).collect()] == [25] * 4


def test_mastery_formula(spark):
    a = spark.createDataFrame([(1, 1.0, True), (2, 1.0, False), (3, 0.5, True)], "task_id long, step_score_mean double, correct boolean")
    got = {r["task_id"]: round(r["mastery"], 4) for r in quota.mastery(a).collect()}
    assert got == {1: 0.6667, 2: 0.3333, 3: 0.5}


def test_residual_matches_the_loop(spark):
    import random

    rng = random.Random(3)
    for n in (1, 5, 40):
        rows = [(i, i, rng.random(), rng.choice("abc")) for i in range(n)]
        a = quota.allocate(spark.createDataFrame(rows, "ord long, task_id long, mastery double, category string"))
        held = sorted(a.collect(), key=lambda r: r["ord"])
        nums, left = [r["raw_count"] for r in held], held[0]["new_total"] - sum(r["raw_count"] for r in held)
        order, at = sorted(range(n), key=lambda i: -held[i]["weight"]), 0
        while left:
            i = order[at % n]
            step = (left > 0) - (left < 0)
            if 10 <= nums[i] + step <= 50:
                nums[i], left = nums[i] + step, left - step
            at += 1
            if at > 20 * n and left:
                break
        assert [r["target_count"] for r in sorted(quota.settle(a).collect(), key=lambda r: r["ord"])] == nums


def test_votes(spark):
    ddl = "votes array<struct<solvable:boolean,unique_answer:boolean,answer:string,confidence:double>>"
    rows = [([(True, True, "6", 0.2), (True, True, "6.0", 0.9)],), ([(True, True, "6", None), (True, True, "7", None)],), ([],)]
    got = [tuple(r) for r in spark.createDataFrame(rows, ddl).select(validate.vote_summary(F.col("votes")).alias("s"), validate.needs_tiebreak(F.col("votes"))).select("s.consensus", "s.consensus_count", "s.consensus_answer").collect()]
    assert got == [(True, 2, "6"), (False, 0, ""), (False, 0, "")]


def test_records_skip_empty_questions(spark):
    rows = [(0, "a", "Maria buys 3 eggs for $4. How many eggs?", "x\n#### 12", None, "t"), (1, "b", " ", "1", None, None)]
    out = kb.records(spark.createDataFrame(rows, "ord long, task_id string, question string, answer string, solution_steps string, question_type string")).collect()
    assert len(out) == 1 and out[0]["surface_template"] == "Maria buys <NUM> eggs for <MONEY>. How many eggs?" and out[0]["persons"] == ["Maria"] and out[0]["units"] == ["eggs"]


def test_banks_and_pools_of_all_kinds(spark, sf):
    records = catalog.known(spark, sf).select("ord", "persons", "focus_terms", "units", "task_id", "question_type").collect()
    seen = {}
    for r in sorted(records, key=lambda r: r["ord"]):
        for kind, terms in (("person", r["persons"]), ("focus_term", r["focus_terms"]), ("unit", r["units"])):
            for term in terms:
                seen.setdefault((kind, term.lower()), []).append((term, r["task_id"], r["question_type"]))
    want = sorted((kind, v[0][0], len(v), min(x[1] for x in v), len({x[2] for x in v})) for (kind, _), v in seen.items())
    got = catalog.QUERIES["concept_bank_all_kinds"](spark, sf).select("kind", "term", "cnt", "first_id", "n_types").collect()
    assert sorted(map(tuple, got)) == want and {w[0] for w in want} == {"person", "focus_term", "unit"}
    pools = {r["kind"]: (list(r["pool"]), r["size"]) for r in catalog.QUERIES["entity_pools_all_kinds"](spark, sf).collect()}
    for kind in ("person", "focus_term", "unit"):
        terms = [t for _, _, t in sorted((-w[2], w[1].lower(), w[1].strip()) for w in want if w[0] == kind and w[1].strip())]
        assert pools[kind] == (list(dict.fromkeys(terms)), len(set(terms)))


def test_peers_against_all_pairs(spark):
    rng = random.Random(4)
    rows = [(i, f"k{rng.randint(0, 1)}", f"s{min(rng.randint(0, 9), 5)}", f"c{min(rng.randint(0, 12), 4)}") for i in range(400)]
    rows += [(1000 + i, "k2", "same", f"c{i}") for i in range(30)] + [(2000 + i, "k3", f"s{i}", "same") for i in range(30)] + [(3000, "k4", None, "x"), (3001, "k4", "y", None)]
    kb = spark.createDataFrame(rows, "task_id long, key string, scene_template string, scenario_template string")
    got = {r["task_id"]: r["peer_ids"] for r in planning.peers(kb, "key", 3).collect()}
    low = lambda x: (x or "").lower()
    for i, k, s, c in rows:
        others = sorted((low(s2) == low(s), low(c2) == low(c), j) for j, k2, s2, c2 in rows if k2 == k and j != i)
        assert got[i] == [o[2] for o in others[:3]]


def test_vote_groups_join_the_first_head_they_equal(spark):
    kind = "votes array<struct<solvable:boolean,unique_answer:boolean,answer:string,confidence:double,steps:array<string>>>"
    vote = lambda a, c, s=None, ok=True: (ok, True, a, c, s)
    rows = [[vote("6", 0.2, ["x"]), vote("6.0", 0.9, ["y"]), vote("7", 0.9)], [vote("6", 0.5), vote("7", 0.5)], [vote("a b", 0.1), vote("6", None, None, False)], [], [vote("1/2", 0.3, ["p"]), vote("0.5", 0.3, ["q"]), vote("$1,000", 0.9)]]
    got = [r["s"] for r in spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, {kind}").orderBy("i").select(validate.vote_summary(F.col("votes"), True).alias("s")).collect()]
    assert [(s["consensus"], s["consensus_count"], s["consensus_answer"], s["representative_steps"]) for s in got] == [(True, 2, "6", ["y"]), (False, 0, "", []), (False, 0, "", []), (False, 0, "", []), (True, 2, "1/2", ["p"])]
    assert [s["solvable_votes"] for s in got] == [3, 2, 1, 0, 3] and got[0]["average_confidence"] == 0.6667


@pytest.mark.parametrize("text,want", [('{"a": 1e3, "b": [null, -0.5]}', {"a": 1000.0, "b": [None, -0.5]}), ("x {\"a\": {\"b\": 1}} y", {"a": {"b": 1}}), ("{'a': True, 'b': (1, 2)}", {"a": True, "b": [1, 2]}), ('"{\\"a\\": 1}"', {"a": 1}), ('{"a": "x\ny"}', None), ("[1,]", [1]), ('{"a" 1}', None), ("{" * 3000, None)])
def test_decode(text, want):
    assert jsonx.decode(text) == want


def test_audits_and_refinements_are_read():
    a = jsonx.audit('{"question_valid": "yes", "estimated_step_count": "x", "first_error_step": "2", "repair_action": "pass", "short_reason": " a  b "}')
    assert (a["question_valid"], a["solvable"], a["estimated_step_count"], a["first_error_step"], a["estimated_difficulty"], a["repair_action"], a["short_reason"], a["error"]) == (True, False, 0, 2, "Equal", "pass", "a b", "")
    assert jsonx.refined('{"steps": ["a", " "]}')["steps"] == ["a"] and jsonx.refined("{}")["error"] and jsonx.refined('{"steps": []}')["error"]


def test_places_in_ranges(spark):
    rng = random.Random(8)
    rows = [(f"{rng.randint(0, 10**6)}-{i}", rng.choice(["a", "b"])) for i in range(500)]
    got = {r["card_id"]: (r["card_bucket"], r["at"]) for r in planning.places(spark.createDataFrame(rows, "task_id string, bucket string"), 40).collect()}
    assert got == {i: (b, sorted(x for x, y in rows if y == b).index(i)) for i, b in rows}


def test_the_heaviest_rows(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([0.5, 0.5, rng.random()])) for i in range(600)]
    df = spark.createDataFrame(rows, "ord long, weight double")
    order = [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    for n in (0, 1, 250, 599, 600):
        assert sorted(r["ord"] for r in quota.heaviest(df, n, most=7, bins=5).collect()) == sorted(order[:n])
