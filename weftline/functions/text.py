"""String functions as Column expressions (all run inside the JVM)."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def strings(values) -> Column:
    return F.array(*map(F.lit, values))


#: White space but for single blanks, which stay.
SPACES = r"(?U)[^\S ]\s*| \s+"


def ws(x: Column) -> Column:
    """White space collapsed to single blanks and trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), SPACES, " "))


def find_all(x: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(x, F.lit(pattern), F.lit(group))


def word_tokens(x: Column) -> Column:
    return find_all(x, C.WORD)


def token_set(x: Column) -> Column:
    return F.array_distinct(find_all(F.lower(F.coalesce(x, F.lit(""))), "[a-z0-9]+"))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token arrays; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0e0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def keyword_set(x: Column) -> Column:
    """Distinct alphabetic tokens of at least four letters."""
    return F.array_distinct(F.filter(find_all(F.lower(F.coalesce(x, F.lit(""))), "[a-z]+"), lambda t: F.length(t) >= 4))


def is_content(t: Column) -> Column:
    banned = sorted({*C.STOPWORDS, *C.QUESTION_WORDS, *C.ACTION_WORDS, *C.UNIT_WORDS})
    return (F.length(t) > 2) & ~F.lower(t).isin(banned)


def distinct_by_lower(a: Column) -> Column:
    """First spelling of each value, without regard to case."""
    return F.aggregate(a, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))


def persons(question: Column, limit: int = 12) -> Column:
    """Capitalised words, then capitalised phrases, whose first word is no list word."""
    found = F.transform(F.concat(find_all(question, C.CAPITAL_NAME, 1), find_all(question, C.CAPITAL_PHRASE, 0)), ws)
    skip = sorted({*C.STOPWORDS, *C.QUESTION_WORDS, *C.ACTION_WORDS})
    base = lambda p: F.lower(F.regexp_replace(F.element_at(F.split(p, " "), 1), "['’]s", ""))
    return F.slice(distinct_by_lower(F.filter(found, lambda p: (p != "") & ~base(p).isin(skip))), 1, limit)


def ngrams(tokens: Column, n: int) -> Column:
    """n-grams of neighbouring content tokens."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(F.array().cast("array<int>"))
    grams = F.transform(starts, lambda i: F.slice(tokens, i, n))
    return F.transform(F.filter(grams, lambda g: F.forall(g, is_content)), lambda g: F.array_join(g, " "))


def focus_runs(tokens: Column) -> Column:
    """Greedy runs of up to three content tokens; a run that ends early needs a token of more than three letters."""
    start = F.struct(F.array().cast("array<string>").alias("run"), F.array().cast("array<string>").alias("out"))

    def closed(acc):
        keep = (F.size(acc["run"]) > 0) & F.exists(acc["run"], lambda t: F.length(t) > 3)
        return F.when(keep, F.concat(acc["out"], F.array(F.array_join(acc["run"], " ")))).otherwise(acc["out"])

    def step(acc, t):
        grown = F.concat(acc["run"], F.array(t))
        full = F.size(grown) == 3
        nothing = F.array().cast("array<string>")
        return (
            F.when(is_content(t) & full, F.struct(nothing.alias("run"), F.concat(acc["out"], F.array(F.array_join(grown, " "))).alias("out")))
            .when(is_content(t), F.struct(grown.alias("run"), acc["out"].alias("out")))
            .otherwise(F.struct(nothing.alias("run"), closed(acc).alias("out")))
        )

    return F.aggregate(tokens, start, step, closed)


def focus_terms(question: Column, limit: int = 18) -> Column:
    found = lambda tokens: F.array_distinct(F.concat(focus_runs(tokens), ngrams(tokens, 2), ngrams(tokens, 3)))
    return F.slice(let(word_tokens(question), found), 1, limit)


def stem(pattern: str) -> str:
    """What every match of a pattern of one word (with or without its last letters) begins with."""
    return re.sub(r"\\b|\\|\w\?", "", pattern)


def units(x: Column) -> Column:
    """Unit words, by pattern order, then by place."""
    none = F.array().cast("array<string>")
    return let(F.lower(x), lambda t: F.array_distinct(F.concat(*(F.when(F.contains(t, F.lit(stem(p))), find_all(t, p)).otherwise(none) for p in C.UNIT_PATTERNS))))


def any_of(t: Column, pattern: str) -> Column:
    """Whether one of the pattern's words and signs is found; an expression is only run where its letters are there."""
    holds = lambda p: F.contains(t, F.lit(stem(p))) & (t.rlike(p) if "b" in re.findall(r"\\(.)", p) else F.lit(True))
    return reduce(or_, map(holds, pattern.split("|")))


def mask_numbers(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(x, C.MONEY, "<MONEY>"), C.PERCENT, "<PERCENT>"), C.NUMBER, "<NUM>")


def mask_entities(x: Column, entities: Column, token: str) -> Column:
    """Whole-word, case-blind replacement, longest entity first (ties by text)."""
    longest = F.array_sort(F.transform(F.array_distinct(entities), lambda e: F.struct((-F.length(e)).alias("n"), e.alias("e"))))
    return F.aggregate(longest, x, lambda acc, s: F.regexp_replace(acc, F.concat(F.lit(r"(?i)\b\Q"), s["e"], F.lit(r"\E\b")), F.lit(token)))


def operation_tags(question: Column, solution: Column) -> Column:
    text = F.lower(F.concat_ws("\n", F.coalesce(question, F.lit("")), F.coalesce(solution, F.lit(""))))
    found = lambda t: F.array_compact(F.array(*(F.when(any_of(t, p), F.lit(n)) for n, p in C.OPERATION_RULES)))
    return let(let(text, found), lambda tags: F.when(F.size(tags) > 0, tags).otherwise(strings(["general_arithmetic"])))


def calculation_steps(solution: Column) -> Column:
    one = lambda g: F.transform(find_all(F.coalesce(solution, F.lit("")), C.CALCULATION, g), ws)
    return F.zip_with(one(1), one(2), lambda e, r: F.struct(e.alias("expression"), r.alias("result")))


def operation_sequence(steps: Column, tags: Column) -> Column:
    def marks(s):
        e = F.lower(s["expression"])
        return F.array_compact(F.array(*(F.when(e.contains(m) | (e.contains("percent") if t == "percentage" else F.lit(False)), F.lit(t)) for t, m in C.SEQUENCE_MARKS)))

    return let(F.flatten(F.transform(steps, marks)), lambda found: F.when(F.size(found) > 0, found).otherwise(tags))


def signature(tags: Column, sequence: Column) -> Column:
    left = F.array_join(F.array_sort(F.array_distinct(tags)), "|")
    return F.when(F.size(sequence) > 0, F.concat(left, F.lit("::"), F.array_join(sequence, "->"))).otherwise(left)


def difficulty(step_count: Column, question: Column, solution: Column) -> Column:
    score = step_count * 2 + F.regexp_count(F.coalesce(solution, F.lit("")), F.lit(r"[+\-*/%]")) + F.size(word_tokens(question)) / F.lit(20e0)
    return F.when(score <= 2.5, "easy").when(score <= 5, "medium").when(score <= 8, "hard").otherwise("very_hard")


def solution_and_answer(solution_steps: Column, answer: Column) -> Column:
    """struct(solution, answer, schema) of a formatted or a raw record."""
    raw = F.coalesce(answer, F.lit(""))
    lines = F.split(raw, "\n")
    last = F.size(lines) - F.array_position(F.transform(F.reverse(lines), lambda x: x.contains("####")), True).cast("int") + 1
    trimmed = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    return (
        F.when(solution_steps.isNotNull(), F.struct(trimmed(solution_steps).alias("solution"), trimmed(raw).alias("answer"), F.lit("formatted").alias("schema")))
        .when(
            raw.contains("####"),
            F.struct(
                trimmed(F.array_join(F.slice(lines, F.lit(1), last - 1), "\n")).alias("solution"),
                trimmed(F.regexp_extract(F.element_at(lines, last), "(?s)####(.*)$", 1)).alias("answer"),
                F.lit("raw_gsm8k").alias("schema"),
            ),
        )
        .otherwise(F.struct(F.lit("").alias("solution"), trimmed(raw).alias("answer"), F.lit("unknown").alias("schema")))
    )


def final_answer(text: Column) -> Column:
    """JSON key, the last JSON list item's key, the mark on the last line, the last number, the last line."""
    keyed = F.coalesce(*(F.get_json_object(text, p) for p in ("$.final_answer", "$.answer")))
    listed = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<struct<final_answer:string,answer:string>>"))
    last = F.try_element_at(listed, F.lit(-1))
    marked = F.when(text.rlike(r"####\s*.+$"), F.regexp_extract(text, r"####\s*(.+)$", 1))
    numbers = find_all(F.translate(text, ",", ""), r"[-+]?\d+(?:,\d{3})*(?:\.\d+)?")
    return ws(F.coalesce(keyed, last["final_answer"], last["answer"], marked, F.try_element_at(numbers, F.lit(-1)), F.element_at(F.split(text, "\n"), -1)))


def number_token(x: Column) -> Column:
    return F.translate(F.lower(ws(x)), "$, %", "")


def normalize_answer(x: Column) -> Column:
    """The numeric text, or the last numeric token, or nothing."""
    read = lambda t: F.when(t.rlike(f"^(?:{C.NUMERIC})$"), t).otherwise(F.coalesce(F.try_element_at(find_all(t, C.NUMERIC), F.lit(-1)), F.lit("")))
    return let(F.translate(ws(x), ",$", ""), read)


def export_answer(x: Column) -> Column:
    return F.translate(ws(x), ",$", "")


def clean_steps(steps: Column) -> Column:
    return F.filter(F.transform(F.coalesce(steps, F.array().cast("array<string>")), ws), lambda s: s != "")


def text_steps(text: Column) -> Column:
    """Steps of free text: lines without ordinals, or the sentences of a single line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda x: F.trim(x) != "")
    bare = F.transform(lines, lambda x: F.regexp_replace(x, r"(?i)^\s*(?:step\s*)?\d+\s*[).:-]\s*", ""))
    sentences = F.split(F.trim(F.coalesce(text, F.lit(""))), r"(?<=[.!?])\s+(?=[A-Z0-9])")
    return clean_steps(F.when(F.size(lines) > 1, bare).otherwise(sentences))


def strip_label(step: Column) -> Column:
    return F.trim(F.regexp_replace(step, C.STEP_LABEL, ""))


def lower_first(x: Column) -> Column:
    return F.concat(F.lower(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))


def keyed_string(raw: Column, keys: list[str]) -> Column:
    """Value of the first key found: quoted, else unquoted up to a separator."""
    found = []
    for key in keys:
        strict, loose = rf'(?s)"{key}"\s*:\s*"((?:\\.|[^"\\])*)"', rf'(?s)"{key}"\s*:\s*([^,}}\]]+)'
        text = F.regexp_extract(raw, strict, 1)
        decoded = F.coalesce(F.get_json_object(F.concat(F.lit('["'), text, F.lit('"]')), "$[0]"), F.replace(F.replace(text, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit(" ")))
        found += [F.when(raw.rlike(strict), ws(decoded)), F.when(raw.rlike(loose), ws(F.regexp_replace(F.trim(F.regexp_extract(raw, loose, 1)), '^"+|"+$', "")))]
    return F.coalesce(*found, F.lit(""))


def sentences(x: Column) -> Column:
    return F.filter(F.transform(find_all(ws(x), r"[^.?!]+[.?!]"), lambda s: F.trim(s)), lambda s: s != "")


def repetition(x: Column) -> Column:
    return let(sentences(x), lambda s: F.when(F.size(s) == 0, F.lit(0e0)).otherwise(1 - F.size(F.array_distinct(s)) / F.size(s)))


def explanatory_step(text: Column, index: Column, total: Column) -> Column:
    """A "Calculate X: ..." step as a sentence with its purpose; other steps without their label."""
    last = (total > 1) & (index == total)
    connector = F.when(last, "Finally").otherwise(F.coalesce(F.try_element_at(strings(C.CONNECTORS), index), F.lit("Then")))

    def told(content):
        goal, work = lower_first(F.trim(F.regexp_extract(content, C.CALCULATE_PREFIX, 1))), F.trim(F.regexp_extract(content, C.CALCULATE_PREFIX, 2))
        first, end, middle = (F.format_string(form, connector, goal, work) for form in (C.EXPLAIN_FIRST, C.EXPLAIN_LAST, C.EXPLAIN_MIDDLE))
        return F.when(~content.rlike(C.CALCULATE_PREFIX), content).when(index == 1, first).when(last, end).otherwise(middle)

    return let(strip_label(text), told)


def training_steps(steps: Column) -> Column:
    """Numbered steps; numbers count all steps, the total only those with text."""
    one = lambda s, i, total: F.when(s != "", F.concat(F.lit("Step "), (i + 1).cast("string"), F.lit(": "), explanatory_step(s, (i + 1).cast("int"), total)))
    numbered = lambda clean: let(F.size(F.filter(clean, lambda s: s != "")), lambda total: F.transform(clean, lambda s, i: one(s, i, total)))
    return F.array_compact(let(F.transform(steps, ws), numbered))


def solution_text(steps: Column, solution: Column, answer: Column) -> Column:
    final = F.format_string(C.CLOSING, answer)
    body = F.rtrim(F.when(F.size(steps) > 0, F.array_join(training_steps(steps), "\n")).otherwise(ws(solution)))
    return let(body, lambda b: F.when(b == "", final).when(F.endswith(b, final), b).otherwise(F.concat(b, F.lit("\n"), final)))
