"""Mastery of a seed and the quota of new samples that follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import numeric as N

MULTIPLIER, N_MIN, N_MAX, BALANCE, LAPS = 26, 10, 50, 0.3, 20


def mastery(attempts: DataFrame, method: str = "linear_cutoff") -> DataFrame:
    """(task_id, step_score_mean, correct) -> accuracy and the weighted Beta mean, by one partial aggregate."""
    w = N.evidence_weight(F.col("step_score_mean"), method)
    hit = F.when(F.col("correct"), 1e0).otherwise(0e0)
    return attempts.groupBy("task_id").agg(F.avg(hit).alias("accuracy"), ((1 + F.sum(w * hit)) / (2 + F.sum(w))).alias("mastery"))


def allocate(seeds: DataFrame, multiplier: float = MULTIPLIER, n_min: int = N_MIN, n_max: int = N_MAX, balance: float = BALANCE) -> DataFrame:
    """(ord, task_id, mastery, category) -> raw_count and weight.

    Global figures are one-row aggregates; nothing is windowed over all seeds.
    """
    m = F.coalesce(F.least(F.greatest(F.col("mastery").try_cast("double"), F.lit(0e0)), F.lit(1e0)), F.lit(0e0))
    seeds = seeds.withColumn("mastery", m).withColumn("category", F.coalesce(F.nullif(F.trim("category"), F.lit("")), F.lit("unknown")))
    groups = seeds.groupBy("category").agg(F.count(F.lit(1)).alias("in_category"))
    span = seeds.agg(F.min("mastery").alias("low"), F.max("mastery").alias("high"), F.count(F.lit(1)).alias("n"))
    span = span.crossJoin(groups.agg(F.max("in_category").alias("most")))
    joined = seeds.join(groups, "category").crossJoin(F.broadcast(span))
    width = F.when(F.col("high") - F.col("low") < 1e-8, F.lit(1e-8)).otherwise(F.col("high") - F.col("low"))
    part = N.learning_utility((F.col("mastery") - F.col("low")) / width) * F.pow(F.col("most") / F.col("in_category"), F.lit(balance)) + 1e-8
    weighed = joined.withColumn("weight", part)
    whole = weighed.agg(F.sum("weight").alias("total"))
    new = F.greatest(F.lit(0), F.greatest(F.col("n"), F.floor(F.col("n") * F.lit(float(multiplier)))) - F.col("n"))
    raw = F.bround(n_min + (new - F.col("n") * n_min) * F.col("weight") / F.col("total"), 0)
    out = weighed.crossJoin(F.broadcast(whole)).withColumn("new_total", new)
    return out.select("ord", "task_id", "mastery", "category", "weight", "new_total", F.least(F.greatest(raw, F.lit(n_min)), F.lit(n_max)).cast("int").alias("raw_count"))


def heaviest(rows: DataFrame, n: int, most: int = 100_000, bins: int = 1000) -> DataFrame:
    """ord of the first ``n`` rows by weight (then ord): those above a cut that histograms close in on, and a sorted rest of at most ``most`` rows."""
    sure, open_ = None, rows.select("weight", "ord")
    while n:
        r = open_.agg(F.count(F.lit(1)).alias("n"), F.min("weight").alias("a"), F.max("weight").alias("b"), F.min("ord").alias("c"), F.max("ord").alias("d")).first()
        if r["n"] <= max(n, most) or (r["a"], r["c"]) == (r["b"], r["d"]):
            last = open_.select("ord") if r["n"] <= n else open_.orderBy(F.col("weight").desc(), "ord").limit(n).select("ord")
            return last if sure is None else sure.unionByName(last)
        # Bin 0 comes first; among equal weights the ord decides.
        place = (F.lit(r["b"]) - F.col("weight")) / F.lit(r["b"] - r["a"]) if r["b"] > r["a"] else (F.col("ord") - F.lit(r["c"])) / F.lit(max(1, r["d"] - r["c"]))
        binned = open_.withColumn("bin", F.floor(place * bins))
        held = 0
        for b, size in sorted((x["bin"], x["count"]) for x in binned.groupBy("bin").count().collect()):
            if held + size > n:
                break
            held += size
            b += 1
        above = binned.filter(F.col("bin") < b).select("ord")
        sure = above if sure is None else sure.unionByName(above)
        n, open_ = n - held, binned.filter(F.col("bin") == b).select("weight", "ord")
    return rows.select("ord").limit(0) if sure is None else sure


def settle(allocated: DataFrame, n_min: int = N_MIN, n_max: int = N_MAX) -> DataFrame:
    """target_count: the raw counts moved by laps of one unit, in order of weight, until they add up.

    In lap k every seed with at least k units of slack moves by one, so full laps
    follow from the histogram of slacks (at most n_max - n_min + 1 rows) and only the
    last lap needs an order, of which only the cut is looked for.
    """
    spark = allocated.sparkSession
    first = allocated.agg(F.sum("raw_count").alias("s"), F.max("new_total").alias("t")).first()
    diff = (first["t"] or 0) - (first["s"] or 0)
    slack = (F.lit(n_max) - F.col("raw_count")) if diff > 0 else (F.col("raw_count") - F.lit(n_min))
    held = {r["slack"]: r["n"] for r in allocated.select(slack.alias("slack")).groupBy("slack").agg(F.count(F.lit(1)).alias("n")).collect()}
    left, full, rest = abs(diff), 0, 0
    while left:
        able = sum(n for s, n in held.items() if s > full)
        if not able:
            break
        if full == LAPS:
            # The loop ends one step into the next lap: only the first seed in order can still move.
            top = allocated.orderBy(F.col("weight").desc(), "ord").select(slack.alias("slack")).first()
            rest = int(top["slack"] > full)
            break
        if left < able:
            rest = left
            break
        left, full = left - able, full + 1
    sign = 1 if diff > 0 else -1
    more = heaviest(allocated.filter(slack > full), rest).withColumn("one", F.lit(1)) if rest else spark.createDataFrame([], "ord long, one int")
    moved = F.least(slack, F.lit(full)) + F.coalesce("one", F.lit(0))
    label = N.difficulty_label(F.col("mastery"))
    return allocated.join(more, "ord", "left").select(
        "ord", "task_id", "mastery", "category", "weight", "raw_count", (F.col("raw_count") + sign * moved).cast("int").alias("target_count"), label.alias("target_difficulty"),
        N.choice(label, C.LABEL_BUCKET).alias("target_difficulty_bucket"), N.choice(label, C.LABEL_STEPS).alias("target_step_count_range"),
    )
