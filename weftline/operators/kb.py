"""Knowledge base: prepared seeds, records and the four banks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


TEXTS = ["question", "solution_steps", "answer"]


def marked(seeds: DataFrame) -> DataFrame:
    """Adds two hashes of a row's texts, which name them in joins."""
    return seeds.withColumns({"task_id": F.coalesce("task_id", F.col("ord").cast("string")), "h": F.xxhash64(*TEXTS), "g": F.xxhash64(F.lit("texts"), *TEXTS)})


def texts(seeds: DataFrame) -> DataFrame:
    """One row per distinct question, solution and answer: how many rows have them, their first place, least task and types.

    What is found in a text is found once; the banks add up ``n``.
    """
    by = ["h", "g", *TEXTS]
    typed = marked(seeds).groupBy(*by, "question_type").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord"), F.min("task_id").alias("task_id"))
    return typed.groupBy(*by).agg(F.sum("n").alias("n"), F.min("ord").alias("ord"), F.min("task_id").alias("task_id"), F.collect_set("question_type").alias("question_types"))


def text_records(seeds: DataFrame) -> DataFrame:
    """The records of distinct texts, with n, question_types, h and g in place of a question_type."""
    one = texts(seeds).repartition(2 * seeds.sparkSession.sparkContext.defaultParallelism, "h")
    return records(one.withColumn("question_type", F.struct("n", "question_types", "h", "g"))).withColumn("x", F.col("question_type")).drop("question_type").select("*", "x.*").drop("x")


def _counted(kb: DataFrame) -> DataFrame:
    """Plain records as rows that count once."""
    return kb if "n" in kb.columns else kb.withColumns({"n": F.lit(1), "question_types": F.array("question_type")})


def records(seeds: DataFrame) -> DataFrame:
    """(ord, task_id, question, answer, solution_steps, question_type) -> knowledge-base records; rows without a question go."""
    split = T.solution_and_answer(F.col("solution_steps"), F.col("answer"))
    base = seeds.select("ord", F.coalesce("task_id", F.col("ord").cast("string")).alias("task_id"), T.ws(F.col("question")).alias("question"), split.alias("s"), "question_type")
    base = base.filter("question <> ''").select("ord", "task_id", "question", F.col("s.solution").alias("solution_text"), F.col("s.answer").alias("answer"), "question_type")
    q, s = F.col("question"), F.col("solution_text")
    named = base.withColumns({"persons": T.persons(q), "focus_terms": T.focus_terms(q), "units": T.units(q), "skill_tags": T.operation_tags(q, s), "calculation_steps": T.calculation_steps(s)})
    named = named.withColumns({"all_terms": F.array_distinct(F.concat("persons", "focus_terms", "units")), "operation_sequence": T.operation_sequence(F.col("calculation_steps"), F.col("skill_tags"))})
    named = named.withColumn("surface_template", T.ws(T.mask_numbers(q)))
    named = named.withColumn("scene_template", T.ws(T.mask_entities(F.col("surface_template"), F.col("persons"), "<PERSON>")))
    short = F.slice(F.filter("focus_terms", lambda t: F.size(F.split(t, " ")) <= 2), 1, 8)
    return named.withColumns(
        {
            "scenario_template": T.ws(T.mask_entities(F.col("scene_template"), short, "<TERM>")),
            "step_count": F.size("calculation_steps"),
            "knowledge_signature": T.signature(F.col("skill_tags"), F.col("operation_sequence")),
            "difficulty_bucket": T.difficulty(F.size("calculation_steps"), q, s),
            "source_schema": F.lit("formatted"),
        }
    )


def _first(x, order) -> Column:
    return F.min_by(x, order)


def _sorted_set(x) -> Column:
    return F.array_sort(F.array_compact(F.collect_set(F.nullif(x, F.lit("")))))


def _types() -> Column:
    return F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.collect_set(F.transform("question_types", lambda t: F.nullif(t, F.lit(""))))))))


def _with_examples(bank: DataFrame, rows: DataFrame, by: list[str], order: list[str], value: Column, seeds: DataFrame | None, n: int = 3) -> DataFrame:
    """Adds the values of each group's first ``n`` rows; only those leave their partition.

    Rows of texts stand at their text's first place.  The first ``n`` of them have the texts of the first
    ``n`` seeds, so of ``seeds`` the rows of those texts are looked at.
    """
    keys = [f"_{c}" for c in by]
    rows = rows.select("*", *(F.col(c).alias(k) for c, k in zip(by, keys)))
    first = lambda x: x.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= n)
    rows = first(rows)
    if seeds is not None:
        rows = first(rows.drop("ord", "task_id", "_r").join(marked(seeds).select("h", "g", "ord", "task_id"), ["h", "g"]))
    listed = rows.withColumn("_v", value).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_v"))), lambda s: s["_v"]).alias("examples"))
    return bank.join(listed, reduce(and_, (bank[c] == F.col(k) for c, k in zip(by, keys)))).drop(*keys)


def concept_links(kb: DataFrame) -> DataFrame:
    """One row per occurrence of a person, focus term or unit: kind, key (its text without case), place, and what it occurs with."""
    return _links(kb, "ord", "task_id", "question", "question_type", "scene_template").withColumn("at", F.struct("ord", "pos"))


def _links(kb: DataFrame, *columns: str) -> DataFrame:
    parts = [kb.select(*columns, F.lit(kind).alias("kind"), F.posexplode(col).alias("pos", "term")) for kind, col in (("person", "persons"), ("focus_term", "focus_terms"), ("unit", "units"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("key", F.lower("term"))


def concept_bank(kb: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Per kind and term: first spelling, count and first three questions, most frequent first.

    The tasks, types and scenes of a term, which grow with the corpus, are the rows of ``concept_links``.
    ``kb`` holds records, or the records of the texts of ``seeds``; so in the other banks.
    """
    links = _links(_counted(kb), "ord", "task_id", "question", "question_types", "n", *(["h", "g"] if seeds is not None else []))
    bank = links.groupBy("kind", "key").agg(_first("term", F.struct("ord", "pos")).alias("term"), F.sum("n").alias("count"), F.min("task_id").alias("first_task_id"), _types().alias("question_types"))
    return _with_examples(bank, links.drop("question_types"), ["kind", "key"], ["ord", "pos"], F.col("question"), seeds).orderBy(F.col("count").desc(), "kind", "key")


def bank_links(kb: DataFrame, key: Column) -> DataFrame:
    """One row per record: the bank key it counts for, and its task, sequence and first concepts, for the banks of templates and signatures."""
    return kb.select(key.alias("key"), "ord", "task_id", "operation_sequence", F.slice("all_terms", 1, 10).alias("concepts"))


def scene_bank(kb: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    rows = _counted(kb).withColumn("key", F.lower("scene_template"))
    bank = rows.groupBy("key").agg(
        _first("scene_template", "ord").alias("scene_template"),
        _first("surface_template", "ord").alias("surface_template"),
        _first("scenario_template", "ord").alias("scenario_template"),
        F.sum("n").alias("count"),
        _types().alias("question_types"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("skill_tags")))).alias("skill_tags"),
        _sorted_set(F.col("difficulty_bucket")).alias("difficulty_buckets"),
        F.round(F.sum(F.col("step_count") * F.col("n")) / F.sum("n"), 3).alias("avg_step_count"),
    )
    return _with_examples(bank, rows, ["key"], ["ord"], F.struct("task_id", "question", "answer"), seeds).orderBy(F.col("count").desc(), "scene_template")


def template_bank(kb: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    rows = _counted(kb).withColumn("key", F.lower("surface_template"))
    bank = rows.groupBy("key").agg(
        _first("surface_template", "ord").alias("surface_template"),
        _first("scene_template", "ord").alias("scene_template"),
        _first("scenario_template", "ord").alias("scenario_template"),
        F.sum("n").alias("count"),
        _types().alias("question_types"),
        _sorted_set(F.col("difficulty_bucket")).alias("difficulty_buckets"),
    )
    return _with_examples(bank, rows, ["key"], ["ord"], F.col("question"), seeds).orderBy(F.col("count").desc(), "surface_template")


def knowledge_bank(kb: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    kb = _counted(kb)
    bank = kb.groupBy("knowledge_signature").agg(
        _first("skill_tags", "ord").alias("skill_tags"),
        _first("operation_sequence", "ord").alias("operation_sequence"),
        _first("difficulty_bucket", "ord").alias("difficulty_bucket"),
        F.sum("n").alias("count"),
        _types().alias("question_types"),
        F.round(F.sum(F.col("step_count") * F.col("n")) / F.sum("n"), 3).alias("avg_step_count"),
    )
    return _with_examples(bank, kb, ["knowledge_signature"], ["ord"], F.struct("task_id", "question", "answer"), seeds).orderBy(F.col("count").desc(), "knowledge_signature")


def entity_pools(bank: DataFrame) -> DataFrame:
    """Per kind the distinct terms, in bank order (count, then text)."""
    terms = bank.filter("trim(term) <> ''").select("kind", F.struct((-F.col("count")).alias("c"), F.lower("term").alias("k"), F.trim("term").alias("t")).alias("s"))
    return terms.groupBy("kind").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["t"])).alias("pool"))
