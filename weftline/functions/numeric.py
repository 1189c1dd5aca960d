"""Scoring and number functions as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .text import let, normalize_answer, number_token, strings, ws


def evidence_weight(q: Column, method: str = "linear_cutoff") -> Column:
    """Weight of an attempt whose steps score q (0 to 1)."""
    if method == "linear_cutoff":
        return F.greatest(F.lit(0e0), 2 * q - 1)
    if method == "sigmoid":
        return 1 / (1 + F.exp(-10 * (q - 0.5)))
    raise ValueError(f"unknown weight method: {method}")


def difficulty_label(mastery: Column) -> Column:
    out = F.lit(C.LABELS[-1])
    for limit, label in reversed(list(zip(C.LABEL_LIMITS, C.LABELS))):
        out = F.when(mastery <= limit, label).otherwise(out)
    return out


def choice(key: Column, table: dict, default=None) -> Column:
    """Value of a small fixed table."""
    out = F.lit(None) if default is None else (F.array(*map(F.lit, default)) if isinstance(default, list) else F.lit(default))
    for k, v in table.items():
        out = F.when(key == k, F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).otherwise(out)
    return out


def rank_of(key: Column, names: list[str], default: int) -> Column:
    return choice(key, {n: i for i, n in enumerate(names)}, default)


def learning_utility(m: Column) -> Column:
    return F.pow(m * (1 - m), F.lit(2e0))


def stable_mod(key: Column, n: Column | int, digest: str = "sha256") -> Column:
    """The first 64 bits of the key's digest, modulo n."""
    hexed = F.sha2(key, 256) if digest == "sha256" else F.sha1(key)
    return (F.conv(F.substring(hexed, 1, 16), 16, 10).cast("decimal(20,0)") % (F.lit(n) if isinstance(n, int) else n.cast("decimal(20,0)"))).cast("int")


def ring(pool: Column, start: Column, count: int) -> Column:
    """``count`` neighbours of a pool from ``start`` on, wrapping."""
    n = F.size(pool)
    at = F.when(n > 0, F.sequence(F.lit(0), F.least(F.lit(count), n) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda o: F.try_element_at(pool, (start + o) % F.greatest(n, F.lit(1)) + 1))


def snap_score(v: Column) -> Column:
    """The nearest allowed step score; 1 to 5 is mapped to 0 to 1 first; ties go to the lower one."""
    v = v.try_cast("double")
    nearest = lambda x: F.array_min(F.transform(F.array(*map(F.lit, C.STEP_SCORES)), lambda a: F.struct(F.abs(a - x).alias("d"), a.alias("a"))))["a"]
    return F.when(v.isNull() | F.isnan(v), 0e0).when((v >= 0) & (v <= 1), nearest(v)).when((v > 1) & (v <= 5), nearest(F.bround((v - 1) / 4, 1))).otherwise(0e0)


def plain_number(x: Column) -> Column:
    """Double of a plain decimal text, else null."""
    return F.when(x.rlike(r"^[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?$"), x.try_cast("double"))


def fraction(text: Column) -> Column:
    """Value of a normalised answer; a fraction by division, null by zero."""
    halves = lambda p: F.try_divide(plain_number(p[0]), plain_number(F.get(p, 1)))
    return F.when(text.contains("/"), let(F.split(text, "/"), halves)).otherwise(plain_number(text))


def numeric_value(x: Column) -> Column:
    return let(normalize_answer(x), fraction)


def close(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b)), F.lit(tolerance))


def same_value(a: Column, b: Column, text_a: Column, text_b: Column) -> Column:
    """Equality of two read answers: as numbers where both are, else as texts."""
    return F.when(a.isNull() | b.isNull(), text_a == text_b).otherwise(close(a, b, 1e-7))


def answers_equal(a: Column, b: Column) -> Column:
    return let(F.struct(numeric_value(a).alias("a"), numeric_value(b).alias("b")), lambda v: same_value(v["a"], v["b"], ws(a), ws(b)))


def is_correct(candidate: Column, reference: Column) -> Column:
    c, r = F.coalesce(candidate, F.lit("")), F.coalesce(reference, F.lit(""))

    def equal(v):
        a, b = plain_number(v["x"]), plain_number(v["y"])
        return F.when((v["x"] == "") | (v["y"] == ""), F.lit(False)).when(a.isNull() | b.isNull(), F.lit(False)).otherwise(close(a, b, 1e-6)) | (v["x"] == v["y"])

    read = F.struct(number_token(c).alias("x"), number_token(r).alias("y"))
    return (c != "") & (r != "") & (let(read, equal) | (F.lower(F.trim(c)) == F.lower(F.trim(r))))


def clamp_score(v: Column, unreadable: int = 1, unit_scale: bool = False) -> Column:
    """1 to 5; with ``unit_scale`` a score of 0 to 1 is stretched first."""
    v = v.try_cast("double")
    five = lambda x: F.least(F.lit(5), F.greatest(F.lit(1), F.bround(x, 0).cast("int")))
    out = F.when((v >= 0) & (v <= 1), F.least(F.lit(5), F.greatest(F.lit(1), F.bround(v * 4, 0).cast("int") + 1))).otherwise(five(v)) if unit_scale else five(v)
    return F.when(v.isNull(), F.lit(unreadable)).otherwise(out)


def issues(*rules: tuple[Column, str]) -> Column:
    """Names of the rules that hold, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in rules)))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def knowledge_match(skills_a: Column, ops_a: Column, bucket_a: Column, skills_b: Column, ops_b: Column, target: Column) -> Column:
    return match_score(overlap(skills_a, skills_b), overlap(ops_a, ops_b), bucket_a, target)


def match_score(skills: Column, ops: Column, bucket: Column, target: Column) -> Column:
    """Score of so many common skills and operations."""
    gap = F.abs(rank_of(bucket, C.BUCKETS, 1) - rank_of(target, C.BUCKETS, 1))
    return 20 * skills + 8 * ops - 10 * gap


def step_bucket(n: Column) -> Column:
    return F.when(n <= 1, "very_short").when(n <= 2, "short").when(n <= 4, "medium").otherwise("long")


def bucket_from_steps(n: Column) -> Column:
    return F.when(n <= 1, "easy").when(n <= 3, "medium").when(n <= 5, "hard").otherwise("very_hard")


def truthy(x: Column, lenient: bool) -> Column:
    """Boolean of a text; unknown words are true if ``lenient`` (assessment), else false (validation)."""
    t = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    yes = strings(["true", "1", "yes", "y"] + ([] if lenient else ["pass"]))
    if lenient:
        return F.array_contains(yes, t) | ~F.array_contains(strings(["false", "0", "no", "n", "", "0.0"]), t)
    number = plain_number(t)
    return F.array_contains(yes, t) | F.coalesce(number != 0, F.lit(False))


def failure_class(error: Column) -> Column:
    e = F.lower(F.coalesce(error, F.lit("")))
    any_of = lambda *w: reduce(or_, (e.contains(x) for x in w))
    return (
        F.when(any_of("not a valid json", "not valid json"), "invalid_json")
        .when(any_of("missing or invalid fields"), "missing_fields")
        .when(any_of("plan", "scene", "reasoning steps"), "plan_mismatch")
        .when(any_of("timeout", "connection", "apierror", "internalserver", "serviceunavailable", "ratelimit", "http"), "request_error")
        .otherwise("unknown")
    )
