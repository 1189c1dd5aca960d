"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets are water-filled: a source gets its weight's share of the budget, is
held at ``max_repeat`` times its size, and the excess is shared again by weight.
The budget is cut into blocks of equal words.  Blocks go to the sources by the
highest quotients votes / (2k + 1), then, by the same rule, from a source to its
shards (hash parts of bounded row count).  Inside a shard the documents stand in
a seeded order; the shard's quota of blocks is laid along that line, a second
time round where the quota exceeds the shard.

Only DataFrame functions run here.  The tables that windows see whole are the
per-source table and, per source, the per-shard table, never documents; a shard
holds about ``shard_rows`` documents whatever the size of its source.

Defined cases: null text counts 0 words; null is a source of its own, last in
order; an empty table gives an empty result; repeated rows each count; rows without
a doc_id stand in the order of their texts' hashes; sources of no words get target 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, materialize, release_driver, table

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MAX_REPEAT = 2
BLOCK_WORDS = 16
SHARD_ROWS = 1024
SEED = "mix-1"


def sainte_lague(parties: DataFrame, by: list[str], votes: str, seats: str, order: list[Column], out: str) -> DataFrame:
    """Adds ``out``: the seats each row wins from its group's ``seats`` by ``votes``.

    A divisor that never over-allocates settles all but at most one seat per
    party; the rest are ranked by quotient.  Ties go to ``order``.  Groups
    without votes win nothing.  Every party needs a unique ``order`` in its group.
    """
    group = Window.partitionBy(*by)
    first = (
        parties.withColumn("_n", F.count(F.lit(1)).over(group))
        .withColumn("_all", F.sum(votes).over(group))
        .withColumn("_room", F.greatest(F.col(seats) - F.col("_n") / F.lit(2.0), F.lit(0.0)))
        .withColumn("_base", F.when(F.col("_all") > 0, F.floor(F.col(votes) * F.col("_room") / F.col("_all") + F.lit(0.5))).otherwise(F.lit(0)).cast("long"))
        .withColumn("_base", F.when((F.col("_room") > 0) & (F.col(votes) > 0), F.col("_base")).otherwise(F.lit(0).cast("long")))
        .withColumn("_left", F.col(seats) - F.sum("_base").over(group))
        .withColumn("_more", F.when((F.col("_all") > 0) & (F.col(votes) > 0), F.ceil(F.col(votes) * F.least(F.col("_n") + 1, F.col(seats) + 1) / F.col("_all")) + 2).otherwise(F.lit(1)).cast("int"))
    )
    tried = first.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_more") - 1)))
    ranked = tried.withColumn("_q", F.col(votes) / (F.lit(2.0) * (F.col("_base") + F.col("_k")) + F.lit(1.0))).withColumn(
        "_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("_q").desc(), *order, F.col("_k")))
    )
    won = F.sum(F.when((F.col("_r") <= F.col("_left")) & (F.col("_q") > 0), 1).otherwise(0)).cast("long")
    return ranked.groupBy(*parties.columns, "_base").agg(won.alias("_won")).withColumn(out, F.col("_base") + F.col("_won")).drop("_base", "_won")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """Adds ``weight`` and ``target`` to a table (source, source_size)."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    everyone = Window.partitionBy(F.lit(0))
    filling = Window.partitionBy(F.lit(0)).orderBy("_ratio", F.col("source").asc_nulls_last())
    before, onward = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.col("source_size") * F.lit(float(max_repeat))
    return (
        sources.withColumn("weight", weight)
        .withColumn("_cap", cap)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_budget", F.sum("source_size").over(everyone) * F.lit(float(budget)))
        .withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
        .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(everyone)["_level"])
        .withColumn("target", F.coalesce(F.least(F.col("_level") * F.col("weight"), F.col("_cap")), F.col("_cap")))
        .drop("_cap", "_ratio", "_level")
    )


def _null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on equal or equally null keys; the right side's keys go."""
    renamed = b.select(*(F.col(k).alias(f"_b_{k}") if k in keys else F.col(k) for k in b.columns))
    cond = reduce(lambda x, y: x & y, (a[k].eqNullSafe(renamed[f"_b_{k}"]) for k in keys))
    return a.join(renamed, cond, "left").drop(*(f"_b_{k}" for k in keys))


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT, block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, text) -> (doc_id, size, source_size, target, taken)."""
    # Rows without a doc_id are dealt by their text.
    mark = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))))
    sized = materialize(docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(SPACE_WORD)), F.lit(0)).cast("long").alias("size"), mark.alias("_mark")))
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).alias("_shards")), weights, budget, max_repeat)
    sources = sources.withColumn("_blocks", F.floor(F.col("_budget") / F.lit(block_words) + F.lit(0.5)))
    sources = materialize(sainte_lague(sources, ["_budget"], "target", "_blocks", [F.col("source").asc_nulls_last()], "_quota"))
    number = F.conv(F.substring("_mark", 1, 8), 16, 10).cast("long")
    placed = _null_safe(sized, sources.select("source", "source_size", "target", "_shards", "_quota"), ["source"]).withColumn("_shard", number % F.col("_shards"))
    shards = placed.groupBy("source", "_shard", "_quota").agg(F.sum("size").alias("_shard_size"))
    shards = sainte_lague(shards, ["source"], "_shard_size", "_quota", [F.col("_shard")], "_share").select("source", "_shard", "_share", "_shard_size")
    line = Window.partitionBy("source", "_shard").orderBy("_mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = _null_safe(placed.withColumn("_end", F.sum("size").over(line)), shards, ["source", "_shard"])
    start = F.col("_end") - F.col("size")
    words = F.col("_share") * F.lit(block_words)

    def reached(length: Column) -> Column:
        return F.least(F.greatest(length - start, F.lit(0)), F.col("size"))

    taken = sum((reached(words - F.lit(turn) * F.col("_shard_size")) for turn in range(1, max_repeat)), reached(words))
    return laid.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op6_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents of which the mix takes words, and how many.

    Documents without words have nothing to take and go; an empty table stays empty.
    """
    release_driver(spark)
    return mix(docs).filter("taken > 0")


_APPORTION = """
SELECT *, base + won AS {out} FROM (
 SELECT {cols}, base, sum(CASE WHEN r <= left_over AND q > 0 THEN 1 ELSE 0 END)::BIGINT won FROM (
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY q DESC, {order}, k) r FROM (
   SELECT *, {votes} / (2e0 * (base + k) + 1e0) q FROM (
    SELECT *, unnest(generate_series(0, more - 1)) k FROM (
     SELECT *, {seats} - sum(base) OVER (PARTITION BY {by}) left_over,
       CASE WHEN alls > 0 AND {votes} > 0 THEN ceil({votes}::DOUBLE * least(n + 1, {seats} + 1) / alls)::BIGINT + 2 ELSE 1 END more FROM (
      SELECT *, CASE WHEN alls > 0 AND room > 0 AND {votes} > 0 THEN floor({votes} * room / alls + 0.5e0)::BIGINT ELSE 0 END base FROM (
       SELECT *, greatest({seats} - n / 2e0, 0e0) room FROM (
        SELECT *, count(*) OVER (PARTITION BY {by}) n, sum({votes}) OVER (PARTITION BY {by}) alls FROM {table}))))))) GROUP BY ALL)"""

ORACLE_SQL = f"""
WITH sized AS (
 SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
   md5('{SEED}|' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) mark FROM {{docs}}),
s0 AS (SELECT source, sum(size)::BIGINT source_size, ceil(count(*) / {SHARD_ROWS}e0)::BIGINT shards FROM sized GROUP BY source),
s1 AS (SELECT *, [3e0, 1e0, 2e0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] w, source_size * 2e0 cap,
   sum(source_size) OVER () * 1.5e0 budget FROM s0),
s2 AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
   / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) lvl FROM s1),
s3 AS (SELECT source, source_size, shards, budget, floor(budget / {BLOCK_WORDS}e0 + 0.5e0)::BIGINT blocks,
   coalesce(least((SELECT lvl FROM s2 WHERE lvl <= cap / w ORDER BY cap / w LIMIT 1) * w, cap), cap) target FROM s2),
s4 AS ({_APPORTION.format(out="quota", cols="source, source_size, shards, target", by="budget", votes="target", seats="blocks", order="source NULLS LAST", table="s3")}),
placed AS (SELECT z.*, s4.source_size, s4.target, s4.quota, ('0x' || substr(z.mark, 1, 8))::BIGINT % s4.shards shard
   FROM sized z JOIN s4 ON z.source IS NOT DISTINCT FROM s4.source),
h0 AS (SELECT source, shard, quota, sum(size)::BIGINT shard_size FROM placed GROUP BY ALL),
h1 AS ({_APPORTION.format(out="share", cols="source, shard, quota, shard_size", by="source", votes="shard_size", seats="quota", order="shard", table="h0")}),
laid AS (SELECT p.*, sum(size) OVER (PARTITION BY source, shard ORDER BY mark, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size begin FROM placed p)
SELECT l.doc_id, l.size, l.source_size, l.target,
  (least(greatest(h1.share * {BLOCK_WORDS} - begin, 0), size) + least(greatest(h1.share * {BLOCK_WORDS} - h1.shard_size - begin, 0), size))::BIGINT taken
FROM laid l JOIN h1 ON l.source IS NOT DISTINCT FROM h1.source AND l.shard = h1.shard
"""
