"""Synthesis plans: scene sources, plan rows, replans; and the older plan cards and generation plans."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from hashlib import sha256
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import numeric as N
from ..functions import text as T
from ..session import shared_folder


def domain_array(full: bool = False) -> Column:
    fields = lambda d: F.struct(F.lit(d["domain"]).alias("domain"), F.lit(d["setting"]).alias("setting"), *(T.strings(d[k]).alias(k) for k in ("roles", "objects", "units")))
    return F.array(*(fields(d) for d in C.domains(full)))


def pick(values: list[str], at: Column) -> Column:
    return F.element_at(T.strings(values), (at % len(values) + 1).cast("int"))


#: Seeds and records of one cell of the comparison of seeds with records.
SEED_BLOCK, RECORD_BLOCK = 2000, 20_000


def scene_sources(seeds: DataFrame, kb: DataFrame, width: float = 3.0) -> DataFrame:
    """For each seed and variant the knowledge-base record at its place on the ranked ring.

    seeds: task_id, skills, ops, bucket (of the seed's record), target_bucket, target_count.
    kb: ord, task_id, skills, ops, bucket.  Records are ranked by match score, then by a
    stable hash with the seed's id, the seed itself left out; variant v takes place
    (rotation + v) mod n.  The sizes of the score levels come from the sets of skills and
    of operations.  Within the level of a place the hashes of all its records are counted
    in cells of bounded size; records are only kept from a band of the hash range, ``width``
    standard deviations around the place.  Where the counts show that a place lies
    outside its band, the band is widened.
    """
    sets = lambda c: F.array_distinct(F.coalesce(c, F.array().cast("array<string>")))
    named = lambda c: F.xxhash64(F.array_sort(c))
    kb = kb.select("ord", "task_id", sets("skills").alias("skills"), sets("ops").alias("ops"), "bucket").withColumns({"s": named("skills"), "o": named("ops")})
    seeds = seeds.select("task_id", sets("skills").alias("skills"), sets("ops").alias("ops"), "target_bucket", "target_count").withColumns({"xs": named("skills"), "xo": named("ops")})
    own = seeds.select("task_id", F.col("skills").alias("x"), F.col("ops").alias("y"), F.col("target_bucket").alias("z")).distinct().join(kb.select("task_id", "skills", "ops", "bucket"), "task_id")
    own = own.groupBy("task_id", N.knowledge_match(F.col("skills"), F.col("ops"), F.col("bucket"), F.col("x"), F.col("y"), F.col("z")).alias("score")).agg(F.count(F.lit(1)).alias("mine"))
    held = own.groupBy("task_id").agg(F.sum("mine").alias("held"))
    total = kb.agg(F.count(F.lit(1)).alias("total"))
    seeds = seeds.join(held, "task_id", "left").crossJoin(F.broadcast(total)).withColumn("n", F.greatest(F.col("total") - F.coalesce("held", F.lit(0)), F.lit(1)))
    rotation = N.stable_mod(F.concat_ws("|", "task_id", "target_bucket"), F.col("n"))
    places = seeds.filter("target_count > 0").withColumn("variant", F.explode(F.sequence(F.lit(0), F.col("target_count") - 1))).withColumn("place", (rotation + F.col("variant")) % F.col("n"))
    levels = seeds.select("task_id", "xs", "xo", "target_bucket").join(_level_sizes(seeds, kb), ["xs", "xo", "target_bucket"])
    levels = levels.join(own, ["task_id", "score"], "left").withColumn("m", F.col("m") - F.coalesce("mine", F.lit(0)))
    ahead = Window.partitionBy("task_id").orderBy(F.col("score").desc())
    levels = levels.withColumn("end", F.sum("m").over(ahead)).withColumn("begin", F.col("end") - F.col("m")).select("task_id", "score", "begin", "end")
    shared_folder(kb.sparkSession)
    wanted = places.select("task_id", "skills", "ops", "target_bucket", "variant", "place").join(levels, "task_id").filter("place >= begin AND place < end").checkpoint()
    asked = wanted.groupBy("task_id", "score").agg(*(F.first(c).alias(c) for c in ("skills", "ops")), F.first(N.rank_of(F.col("target_bucket"), C.BUCKETS, 1)).alias("rank"), F.first(F.col("end") - F.col("begin")).alias("m"), F.array_sort(F.collect_set(F.col("place") - F.col("begin"))).alias("ranks"))
    records = kb.select(F.col("task_id").alias("source_id"), F.col("ord").cast("bigint").alias("ord"), "skills", "ops", N.rank_of(F.col("bucket"), C.BUCKETS, 1).alias("rank")).filter("source_id IS NOT NULL")
    found = None
    while True:
        tried = _ranked(asked, records, width).checkpoint()
        good = tried.filter("inside").select("task_id", "score", F.explode("picks").alias("p"))
        found = good if found is None else found.unionByName(good)
        if width > 2**40 or not tried.filter("NOT inside").limit(1).count():
            break
        asked, width = asked.join(tried.filter("NOT inside").select("task_id", "score"), ["task_id", "score"], "left_semi"), width * 4
    found = found.select("task_id", "score", F.col("p.rank").alias("at"), F.col("p.source_id").alias("source_id"))
    return wanted.select("task_id", "variant", "place", "score", (F.col("place") - F.col("begin")).alias("at")).join(found, ["task_id", "score", "at"]).select("task_id", "variant", "place", "score", "source_id")


def _level_sizes(seeds: DataFrame, kb: DataFrame) -> DataFrame:
    """(xs, xo, target_bucket, score, m): how many records have a score with the seeds of those sets.

    Sets of skills meet sets of skills, and sets of operations sets of operations; records are only counted.
    """
    classes = kb.groupBy("s", "o", "bucket").agg(F.count(F.lit(1)).alias("m"))

    def overlaps(x: str, of: str, s: str, name: str) -> DataFrame:
        mine = seeds.groupBy(x).agg(F.first(of).alias("a"))
        return mine.crossJoin(kb.groupBy(s).agg(F.first(of).alias("b"))).select(x, s, N.overlap(F.col("a"), F.col("b")).alias(name))

    by_skills = overlaps("xs", "skills", "s", "a").join(classes, "s").groupBy("xs", "o", "bucket", "a").agg(F.sum("m").alias("m"))
    pairs = seeds.select("xs", "xo", "target_bucket").distinct()
    both = by_skills.join(overlaps("xo", "ops", "o", "b"), "o").join(pairs.select("xs", "xo").distinct(), ["xs", "xo"], "left_semi").groupBy("xs", "xo", "bucket", "a", "b").agg(F.sum("m").alias("m"))
    score = N.match_score(F.col("a"), F.col("b"), F.col("bucket"), F.col("target_bucket"))
    return both.join(pairs, ["xs", "xo"]).groupBy("xs", "xo", "target_bucket", score.alias("score")).agg(F.sum("m").alias("m"))


def _ranked(asked: DataFrame, records: DataFrame, width: float) -> DataFrame:
    """(task_id, score, inside, picks of rank and source_id): the records at the ranks of a seed's level, where its band holds them."""
    r, m = F.col("ranks"), F.col("m").cast("double")
    edge = lambda rank, sign: (rank + F.lit(0.5) + sign * width * (1 + F.sqrt((rank + 1) * F.greatest(m - rank, F.lit(1e0)) / m))) / m
    asked = asked.withColumns({"low": F.greatest(edge(r[0], -1), F.lit(0e0)), "high": F.least(edge(F.element_at(r, -1), 1), F.lit(1e0))})
    seeds, known = asked.count(), records.count()
    k = known // RECORD_BLOCK + 1
    cores = asked.sparkSession.sparkContext.defaultParallelism
    i = max(seeds // SEED_BLOCK + 1, min(seeds // 20 + 1, 4 * cores // k + 1))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("task_id", "score", "skills", "ops", "rank", "low", "high", block("task_id", i).alias("i"), every(k).alias("k")).repartition(i * k, "i", "k")
    right = records.select("*", every(i).alias("i"), block("source_id", k).alias("k")).repartition(i * k, "i", "k")
    cells = left.groupBy("i", "k").cogroup(right.groupBy("i", "k")).applyInArrow(_band, "task_id string, score int, below bigint, kept array<struct<h:bigint,ord:bigint,source_id:string>>")
    told = cells.groupBy("task_id", "score").agg(F.sum("below").alias("below"), F.array_sort(F.flatten(F.collect_list("kept"))).alias("kept"))
    rows = asked.select("task_id", "score", "ranks").join(told, ["task_id", "score"])
    inside = (F.col("below") <= r[0]) & (F.element_at(r, -1) < F.col("below") + F.size("kept"))
    picks = F.transform("ranks", lambda x: F.struct(x.alias("rank"), F.try_element_at("kept", (x - F.col("below") + 1).cast("int"))["source_id"].alias("source_id")))
    return rows.select("task_id", "score", inside.alias("inside"), F.when(inside, picks).alias("picks"))


def _band(seeds: pa.Table, records: pa.Table) -> pa.Table:
    """Per seed of a cell: how many records of its level have a hash before its band, and those inside it."""

    def holders(column: str) -> dict:
        held = defaultdict(list)
        for at, values in enumerate(records.column(column).to_pylist()):
            for v in values:
                held[v].append(at)
        return {v: np.array(at) for v, at in held.items()}

    names = records.column("source_id").to_pylist()
    ids, places = np.array([x.encode() for x in names] + [None], dtype=object)[:-1], np.array(records.column("ord").to_pylist(), dtype=object)
    where = defaultdict(list)
    for at, x in enumerate(names):
        where[x].append(at)
    skills, ops, ranks = holders("skills"), holders("ops"), records.column("rank").to_numpy()
    out = []
    for s in seeds.to_pylist():
        score = -10 * np.abs(ranks - s["rank"])
        for values, held, points in ((s["skills"], skills, 20), (s["ops"], ops, 8)):
            for v in values:
                if v in held:
                    score[held[v]] += points
        level = score == s["score"]
        level[where.get(s["task_id"], [])] = False
        at = np.flatnonzero(level)
        head = f"{s['task_id']}|".encode()
        h = np.frombuffer(b"".join([sha256(head + x).digest() for x in ids[at].tolist()]), ">u8")[::4].astype(np.uint64)
        low, high = (np.uint64(min(int(s[c] * 2.0**64), 2**64 - 1)) for c in ("low", "high"))
        kept = np.flatnonzero((h >= low) & (h <= high))
        signed = (h[kept] ^ np.uint64(2**63)).view(np.int64).tolist()
        out.append((s["task_id"], s["score"], int((h < low).sum()), [{"h": x, "ord": places[j], "source_id": names[j]} for x, j in zip(signed, at[kept].tolist())]))
    kept_type = pa.list_(pa.struct([("h", pa.int64()), ("ord", pa.int64()), ("source_id", pa.string())]))
    return pa.table([pa.array([o[n] for o in out], t) for n, t in enumerate((pa.string(), pa.int32(), pa.int64(), kept_type))], names=["task_id", "score", "below", "kept"])


def diversity(seed: Column, variant: Column, full: bool = False) -> Column:
    """Scene, mode, style and number strategy of a seed's variant."""
    pool, n = domain_array(full), len(C.domains(full))
    start = N.stable_mod(F.concat(seed, F.lit("|domain")), n) + variant
    scene = F.element_at(pool, (start % n + 1).cast("int"))
    mode = pick(C.VARIATION_MODES, N.stable_mod(F.concat(seed, F.lit("|variation")), 6) + variant)
    style = pick(C.NARRATIVE_STYLES, N.stable_mod(F.concat(seed, F.lit("|narrative")), 6) + F.floor(variant / n))
    numbers = pick(C.NUMBER_STRATEGIES, N.stable_mod(F.concat(seed, F.lit("|numbers")), 6) + variant)
    return _diversity(scene, F.array(*(F.element_at(pool, ((start + o) % n + 1).cast("int")) for o in (7, 13, 21))), mode, style, numbers, F.lit(0), F.lit(""))


def _diversity(scene: Column, others: Column, mode: Column, style: Column, numbers: Column, retry: Column, reason: Column) -> Column:
    """The diversity part of a plan; ``retry`` is 0 in a first plan."""
    named = F.concat_ws("|", scene["domain"], mode, style, numbers)
    return F.struct(
        scene.alias("primary_scene"), others.alias("alternative_scenes"), mode.alias("variation_mode"), style.alias("narrative_style"), numbers.alias("number_strategy"),
        F.lit(True).alias("same_template_new_scene_allowed"), F.lit(True).alias("scene_change_required"), retry.cast("int").alias("replanned_round"), reason.alias("replan_reason"),
        F.when(retry > 0, F.concat(named, F.lit("|retry:"), retry.cast("string"))).otherwise(named).alias("plan_signature"),
    )


def plan_rows(quotas: DataFrame, kb: DataFrame, pools: dict[str, Column] | None = None) -> DataFrame:
    """(task_id, target_count, target_difficulty, target_difficulty_bucket) -> one plan per variant.

    Unmatched seeds go; the last of equal keys in the knowledge base counts.
    """
    last = kb.groupBy("task_id").agg(*(F.max_by(c, "ord").alias(c) for c in kb.columns if c != "task_id"))
    held = lambda name, kind, none: (F.coalesce(name, F.lit(none)) if name in last.columns else F.lit(none)).cast(kind)
    known = last.select("task_id", "skill_tags", "operation_sequence", "difficulty_bucket", held("knowledge_signature", "string", "").alias("knowledge_signature"), held("step_count", "int", 0).alias("reference_step_count"))
    joined = quotas.join(known, "task_id")
    bucket = F.coalesce(F.nullif("target_difficulty_bucket", F.lit("")), N.choice(F.col("target_difficulty"), C.LABEL_BUCKET), F.lit("medium"))
    seeds = joined.select("task_id", F.col("skill_tags").alias("skills"), F.col("operation_sequence").alias("ops"), F.col("difficulty_bucket").alias("bucket"), bucket.alias("target_bucket"), F.greatest("target_count", F.lit(0)).alias("target_count"))
    source = scene_sources(seeds, last.select("ord", "task_id", F.col("skill_tags").alias("skills"), F.col("operation_sequence").alias("ops"), F.col("difficulty_bucket").alias("bucket")))
    source = source.join(last.select(F.col("task_id").alias("source_id"), "persons", "focus_terms", "units", F.col("skill_tags").alias("related")), "source_id")
    rows = source.join(joined.select("task_id", "skill_tags", "operation_sequence", "knowledge_signature", "reference_step_count", F.coalesce(F.nullif("target_difficulty", F.lit("")), F.lit("Equal")).alias("target_difficulty")), "task_id")
    key = F.concat_ws("|", "task_id", F.col("variant").cast("string"))

    def terms(column: str, kind: str, pool: str, n: int, spare: int) -> Column:
        values = F.transform(column, lambda x: F.trim(F.regexp_replace(x, "(?:'s|’s)$", "")) if kind == "person" else F.trim(x))
        values = F.array_distinct(F.filter(values, lambda x: x != ""))
        own = N.ring(values, N.stable_mod(F.concat(key, F.lit(f"|scene-{kind}")), F.greatest(F.size(values), F.lit(1))), n)
        fall = (pools or {}).get(pool, F.array().cast("array<string>"))
        other = N.ring(fall, N.stable_mod(F.concat(key, F.lit(f"|fallback-{kind}")), F.greatest(F.size(fall), F.lit(1))), spare)
        return F.when(F.size(own) > 0, own).otherwise(other)

    inspiration = F.struct(
        terms("focus_terms", "focus", "focus_term", 4, 2).alias("scene_keywords"), terms("persons", "person", "person", 2, 1).alias("possible_roles"), terms("units", "unit", "unit", 2, 1).alias("possible_units"),
        F.col("related").alias("related_skill_tags"), F.lit(INSPIRED).alias("policy"),
    )
    math = F.struct("skill_tags", "operation_sequence", "knowledge_signature", "reference_step_count", "target_difficulty")
    return rows.select(
        F.col("task_id").alias("source_task_id"), F.concat_ws("_", "task_id", F.col("variant").cast("string")).alias("plan_id"),
        F.struct(math.alias("math"), diversity(F.col("task_id"), F.col("variant")).alias("diversity"), inspiration.alias("kb_inspiration")).alias("knowledge"),
    )


def replanned(plan_id: Column, domain: Column, failure: Column, retry: Column, full: bool = False) -> Column:
    """The new diversity of a failed plan, or null where the failure keeps the plan."""
    pool, n = domain_array(full), len(C.domains(full))
    start = N.stable_mod(F.concat_ws("|", plan_id, F.lit("replan"), retry.cast("string")), n)
    at = F.when(F.element_at(pool, start + 1)["domain"] == domain, (start + 1) % n).otherwise(start)
    of = lambda what, values: pick(values, N.stable_mod(F.concat(plan_id, F.lit(f"|replan-{what}")), 6) + retry)
    mode, style, numbers = of("variation", C.VARIATION_MODES), of("narrative", C.NARRATIVE_STYLES), of("number", C.NUMBER_STRATEGIES)
    new = _diversity(F.element_at(pool, at + 1), F.array(*(F.element_at(pool, (at + o) % n + 1) for o in (5, 11, 19))), mode, style, numbers, retry, failure)
    return F.when(failure.isin(C.REPLAN_FAILURES), new)


def replan(knowledge: Column, plan_id: Column, failure: Column, retry: Column, full: bool = False) -> Column:
    """A failed plan's knowledge: new diversity and no inspiration, or as it is where the failure keeps the plan."""
    new = replanned(plan_id, knowledge["diversity"]["primary_scene"]["domain"], failure, retry, full)
    none = F.array().cast("array<string>")
    policy = F.when(failure == "similarity", F.lit(TOO_SIMILAR)).otherwise(F.lit(STUBBORN))
    bare = knowledge["kb_inspiration"].withField("scene_keywords", none).withField("possible_roles", none).withField("possible_units", none).withField("policy", policy)
    return F.when(failure.isin(C.REPLAN_FAILURES), knowledge.withField("diversity", new).withField("kb_inspiration", bare)).otherwise(knowledge)


def knowledge_type(spark) -> str:
    """The type of a plan's knowledge."""
    none = F.array().cast("array<string>")
    inspired = F.struct(none.alias("scene_keywords"), none.alias("possible_roles"), none.alias("possible_units"), none.alias("related_skill_tags"), F.lit("").alias("policy"))
    math = F.struct(none.alias("skill_tags"), none.alias("operation_sequence"), F.lit("").alias("knowledge_signature"), F.lit(0).alias("reference_step_count"), F.lit("").alias("target_difficulty"))
    known = F.struct(math.alias("math"), diversity(F.lit("x"), F.lit(0)).alias("diversity"), inspired.alias("kb_inspiration"))
    return spark.range(1).select(known.alias("k")).schema["k"].dataType.simpleString()


def plan_tokens(knowledge: Column) -> Column:
    """Keyword tokens of a plan's scenes and inspiration, whatever nests them."""
    scenes = F.concat(F.array(knowledge["diversity"]["primary_scene"]), knowledge["diversity"]["alternative_scenes"])
    words = F.flatten(F.transform(scenes, lambda s: F.concat(F.array(s["domain"], s["setting"]), s["roles"], s["objects"], s["units"])))
    inspired = knowledge["kb_inspiration"]
    return T.keyword_set(F.array_join(F.concat(words, inspired["scene_keywords"], inspired["possible_roles"], inspired["possible_units"]), " "))


#: What a plan says about its inspiration.
INSPIRED = "Take or leave: no wording, name, number or template of the knowledge base is to be copied, and the scene comes first."
TOO_SIMILAR = "The last question was too like another one: use the new scene, with new names, objects, values and words."
STUBBORN = "The last questions stayed wrong or of the wrong difficulty: build a new problem for the skills and the new scene, and keep nothing of the old one."


def peers(kb: DataFrame, key: str, most: int = 6) -> DataFrame:
    """(task_id, scene_template, scenario_template, key) -> peer_ids: others of the key, other scenes and scenarios first.

    A row may need peers of four kinds (other or same scene, other or same scenario), of each
    kind the ``most`` smallest ids.  Of each scene and scenario only most + 1 rows can be
    among them, of each scene or scenario the first 2 * most + 1 of those, of a key the
    first 5 * most + 2 of what is left.  So a row meets four short lists, however
    common its key is.
    """
    norm = kb.select("task_id", F.col(key).alias("key"), F.lower(T.ws(F.col("scene_template"))).alias("scene"), F.lower(T.ws(F.col("scenario_template"))).alias("scenario"))
    first = lambda rows, by, n: rows.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("task_id"))).filter(F.col("r") <= n).drop("r")
    both = first(norm, ["key", "scene", "scenario"], most + 1)
    of_scene, of_scenario = first(both, ["key", "scene"], 2 * most + 1), first(both, ["key", "scenario"], 2 * most + 1)
    of_key = first(of_scene.join(of_scenario.select("key", "task_id"), ["key", "task_id"], "left_semi"), ["key"], 5 * most + 2)
    rows = norm
    for name, kept, by in (("p1", of_key, ["key"]), ("p2", of_scenario, ["key", "scenario"]), ("p3", of_scene, ["key", "scene"]), ("p4", both, ["key", "scene", "scenario"])):
        listed = kept.select(*(F.col(c).alias(f"{name}_{c}") for c in by), F.struct("task_id", "scene", "scenario").alias(name)).groupBy(*(f"{name}_{c}" for c in by)).agg(F.collect_list(name).alias(name))
        rows = rows.join(listed, reduce(and_, (F.col(c).eqNullSafe(F.col(f"{name}_{c}")) for c in by)), "left")
    none = F.array().cast(rows.schema["p1"].dataType)
    every = F.array_distinct(F.concat(*(F.coalesce(p, none) for p in ("p1", "p2", "p3", "p4"))))
    others = F.filter(every, lambda p: p["task_id"] != F.col("task_id"))
    ranked = F.array_sort(F.transform(others, lambda p: F.struct((p["scene"] == F.col("scene")).alias("a"), (p["scenario"] == F.col("scenario")).alias("b"), p["task_id"].alias("id"))))
    return rows.select("task_id", F.transform(F.slice(ranked, 1, most), lambda s: s["id"]).alias("peer_ids"))


def places(cards: DataFrame, most: int = 200_000) -> DataFrame:
    """(task_id, bucket) -> card_id, card_bucket and at, the card's place in its bucket in id order.

    Ids are cut into ranges of about ``most`` cards at ids that the cards' hashes choose;
    a window numbers one range of a bucket, and the ranges before it are counted.
    """
    n = cards.count()
    blocks = n // most + 1
    cuts: list = []
    if blocks > 1:
        part = max(1, n // (20 * blocks))
        seen = sorted(r[0] for r in cards.filter(F.pmod(F.xxhash64("task_id"), F.lit(part)) == 0).select("task_id").collect())
        cuts = seen[:: max(1, len(seen) // blocks)]
    block = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("task_id"))) if cuts else F.lit(0)
    cut = cards.select(F.col("task_id").alias("card_id"), F.col("bucket").alias("card_bucket"), block.alias("block"))
    sizes = cut.groupBy(F.col("card_bucket").alias("b"), F.col("block").alias("k")).agg(F.count(F.lit(1)).alias("m"))
    before = sizes.withColumn("before", F.sum("m").over(Window.partitionBy("b").orderBy("k")) - F.col("m"))
    inside = F.row_number().over(Window.partitionBy("card_bucket", "block").orderBy("card_id")) - 1
    joined = cut.withColumn("inside", inside).join(before, (F.col("card_bucket") == F.col("b")) & (F.col("block") == F.col("k")))
    return joined.select("card_id", "card_bucket", (F.col("before") + F.col("inside")).alias("at"))


def priority_pick(seeds: DataFrame, cards: DataFrame) -> DataFrame:
    """Per seed and variant the card of the first bucket in priority that has any, on a hashed ring, not the seed itself if others are there.

    seeds: task_id, target_difficulty, target_bucket, variant.  cards: task_id, bucket.
    Cards get their place in their bucket once; a seed's place is computed, not searched.
    """
    placed = places(cards)
    sizes = {r["bucket"]: r["n"] for r in cards.filter(F.col("bucket").isin(C.BUCKETS)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_label = {k.lower(): C.BUCKET_PRIORITY[v] for k, v in C.LABEL_BUCKET.items()}
    label, bucket = F.lower(F.trim("target_difficulty")), F.lower(F.trim("target_bucket"))
    order = F.coalesce(N.choice(label, by_label), N.choice(bucket, C.BUCKET_PRIORITY, ["medium", "easy", "hard", "very_hard"]))
    chosen = F.try_element_at(F.filter(order, lambda b: F.array_contains(T.strings(sizes or [""]), b)), F.lit(1))
    text = F.concat_ws("|", "task_id", "target_difficulty", "target_bucket", F.col("variant").cast("string"), chosen)
    own = cards.select(F.col("task_id").alias("own_id"), F.col("bucket").alias("own_bucket"))
    rows = seeds.withColumn("selected_bucket", chosen).withColumn("n", N.choice(F.col("selected_bucket"), sizes or {"": 0})).join(own, F.col("task_id") == F.col("own_id"), "left")
    # The seed's own card stands last on the ring; it is passed over where there are others.
    inside = F.coalesce(F.col("own_bucket") == F.col("selected_bucket"), F.lit(False))
    start = N.stable_mod(text, F.col("n"), "sha1")
    rows = rows.withColumn("ring", F.when(inside & (F.col("n") > 1) & (start == F.col("n") - 1), 0).otherwise(start))
    own_at = placed.select(F.col("card_id").alias("o_id"), F.col("at").alias("own_at"))
    rows = rows.join(own_at, F.col("task_id") == F.col("o_id"), "left")
    # Ring place to place in id order: the own card is taken out of the sequence.
    place = F.when(inside & (F.col("n") > 1) & (F.col("ring") >= F.col("own_at")), F.col("ring") + 1).otherwise(F.col("ring"))
    rows = rows.withColumn("place", place)
    return rows.join(placed, (F.col("selected_bucket") == F.col("card_bucket")) & (F.col("place") == F.col("at"))).select("task_id", "variant", "selected_bucket", "card_id")


def difficulty_profile(mastery: Column, bucket: Column) -> Column:
    """Target buckets of a seed, one per planned variant."""
    r = N.rank_of(bucket, C.BUCKETS, 1)
    at = lambda d: F.element_at(T.strings(C.BUCKETS), F.least(F.greatest(r + d, F.lit(0)), F.lit(3)) + 1)
    return (
        F.when(mastery < 0.33, F.array(at(-1), at(0), at(0)))
        .when(mastery < 0.66, F.array(at(-1), at(0), at(1)))
        .when(mastery > 0.83, F.array(at(0), at(1), at(1), at(2)))
        .otherwise(F.array(at(0), at(1), at(1)))
    )
