"""Line deduplication with a log-template tree.

A line's tokens that hold a digit are variable fields.  The tree has a fixed depth:
the number of tokens, then the first three tokens; its leaves group the lines.  In a
leaf a token is constant at its position if the texts of the leaf show it there often
enough, else the position is a variable field, too; lines of equal constants share a
template.  A line has up to three templates:

* the fine one, where ``MIN_DOCS`` texts make a token constant; four fifths of the
  tokens without a digit must be constant, one of them with a letter (brackets and
  rules of code and tables are no repeats);
* the coarse one, where it takes ``SHARE`` of the leaf's texts, however large the
  corpus; it needs a constant token beyond the leading ones, a letter, and half of the
  tokens without a digit;
* the line itself, if its masked form has ``LONG_BYTES`` bytes.

The first two are dropped where ``MIN_DOCS`` different texts have them, the third
where ``LONG_DOCS`` have it: everywhere but in the template's first line, that of the
smallest doc_id.  Lines that share a finer template share the coarser one, so the first
line is left by both.  Exact copies of a text count once, so copies alone never
make a template; they are left to near-duplicate detection.

Only DataFrame functions run here.  Texts are split once, into a stored table of
lines; leaves, supports and counts read hashes of it, only lines of leaves that
two texts reach are read as text, and what a leaf, token or template finds is
joined back in salted parts, as one of them may hold any share of all lines.

Defined cases: null texts stay null with 0 lines; empty lines stay; null doc_ids come
last in order; rows of the same doc_id and text are treated alike; a text of any number
of lines is rewritten in one pass; an empty table is empty; further columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, materialize, release_driver, split_join, table, written

MIN_DOCS = 4
LEAD = 3
CONSTANT = 0.8
FIELD = "<*>"
LONG_BYTES = 50
LONG_DOCS = 2
SHARE = 0.3


def _lines(docs: DataFrame, lead: int) -> DataFrame:
    """One row per line that is not empty: its masked form, leaf and place."""
    line = docs.select("doc_id", "_h", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # One search tells whether a line is in normal form already, as nearly all lines are.
    masked = F.regexp_replace(F.regexp_replace("line", r"(?<!\S)[^\s0-9]*+[0-9]\S*+", FIELD), r"\s+", " ")
    normal = F.when(F.contains("line", F.lit("  ")) | F.col("line").rlike(r"[0-9\t\x0B\f\r]"), masked).otherwise(F.col("line"))
    line = line.select("doc_id", "_h", "pos", F.trim(normal).alias("line")).filter("line <> ''")
    tokens = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    return line.select("doc_id", "_h", "pos", "line", F.xxhash64(tokens, F.substring_index("line", " ", lead)).alias("leaf"), F.xxhash64("line").alias("form"))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, lead: int = LEAD, constant: float = CONSTANT, share: float = SHARE, long_bytes: int = LONG_BYTES, long_docs: int = LONG_DOCS) -> DataFrame:
    """(doc_id, _h, text) -> (doc_id, _h, pos) of the lines to drop."""
    lines = written(_lines(docs, lead), "lines")
    texts = F.count(F.lit(1))
    leaves = materialize(lines.select("leaf", "_h").distinct().groupBy("leaf").agg(texts.alias("m")).filter(F.col("m") >= min(min_docs, long_docs)))
    places = written(split_join(lines, leaves, ["leaf"], F.col("_h")), "places")
    support = places.select("leaf", "form", "_h").distinct().groupBy("leaf", "form").agg(texts.alias("d"))
    forms = materialize(places.groupBy("leaf", "form").agg(F.first("line").alias("line"), F.first("m").alias("m")).join(support, ["leaf", "form"]))
    # Where fewer texts than make a constant reach a leaf, with all its forms together, it has none.
    reached = materialize(forms.groupBy("leaf").agg(F.sum("d").alias("reached")).filter(F.col("reached") >= min_docs).select("leaf"))
    token = split_join(forms, reached, ["leaf"], F.col("form")).select("leaf", "form", "d", "m", F.posexplode(F.split("line", " ")).alias("at", "token"))
    token = token.select("leaf", "form", "d", "m", "at", F.xxhash64("leaf", "at", "token").alias("key"), (F.col("token") != FIELD).alias("word"), F.col("token").rlike(r"\p{L}").alias("letter"))
    seen = token.filter("word").groupBy("key").agg(F.sum("d").alias("seen")).filter(F.col("seen") >= min_docs)
    # Constants grow with the corpus: joined by a shuffle at every size.
    token = split_join(token, materialize(seen), ["key"], F.col("form"), "left", rows=0)
    steady = F.greatest(F.lit(min_docs), F.ceil(F.col("m") * F.lit(share)))
    token = token.select("leaf", "form", "at", "word", "letter", F.when(F.col("seen") >= min_docs, F.col("key")).alias("fine"), F.when(F.col("seen") >= steady, F.col("key")).alias("coarse"))
    has = lambda name: F.count_if(F.col("letter") & F.col(name).isNotNull()) > 0
    parsed = token.groupBy("leaf", "form").agg(
        F.array_sort(F.collect_list(F.struct("at", "fine", "coarse"))).alias("t"), F.count("fine").alias("n_fine"), F.count("coarse").alias("n_coarse"), F.count_if("word").alias("words"), has("fine").alias("l_fine"), has("coarse").alias("l_coarse")
    )
    fine = (F.col("n_fine") >= F.col("words") * F.lit(constant)) & F.col("l_fine")
    coarse = (F.col("n_coarse") > lead) & (F.col("n_coarse") * 2 >= F.col("words")) & F.col("l_coarse")
    of = lambda name: F.xxhash64("leaf", F.lit(name), F.col("t")[name])
    each = F.explode(F.array_compact(F.array(F.when(fine, of("fine")), F.when(coarse, of("coarse")))))
    recur = parsed.select("leaf", "form", each.alias("template"), F.lit(min_docs).alias("least"))
    whole = forms.filter(F.octet_length("line") >= long_bytes).select("leaf", "form", F.xxhash64("leaf", F.lit("long"), "form").alias("template"), F.lit(long_docs).alias("least"))
    # A form has at most three templates, which stand in one row for the join.
    listed = materialize(recur.unionByName(whole).groupBy("leaf", "form").agg(F.collect_list(F.struct("template", "least")).alias("of")))
    placed = split_join(places.select("leaf", "form", "doc_id", "_h", "pos"), listed, ["leaf", "form"], F.col("_h")).select("doc_id", "_h", "pos", F.explode("of").alias("of")).select("of.template", "of.least", "doc_id", "_h", "pos")
    rank = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("y"), F.col("pos").alias("z"))
    counted = placed.groupBy("template", "_h").agg(F.min(rank).alias("r"), F.first("least").alias("least")).groupBy("template").agg(texts.alias("m"), F.min("r").alias("r"), F.first("least").alias("least")).filter(F.col("m") >= F.col("least"))
    dropped = split_join(placed, materialize(counted.select("template", "r")), ["template"], F.col("_h")).filter(rank != F.col("r"))
    return dropped.select("doc_id", "_h", "pos").distinct()


def without(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the sorted places ``gone`` (from 0), as the stretches between them."""
    ends = F.concat(gone, F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(-1)), gone)
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def _rewritten(docs: DataFrame) -> DataFrame:
    """_row (the document), _n and _d (its lines and dropped lines) and _kept (the text left)."""
    keyed = docs.select(F.struct("*").alias("_row"), "doc_id", "text", F.xxhash64("text").alias("_h"))
    drop = recurring(keyed.select("doc_id", "text", "_h")).groupBy(F.col("doc_id").alias("_id"), F.col("_h").alias("_x")).agg(F.array_sort(F.collect_list("pos")).alias("_pos"))
    joined = keyed.join(bounded(materialize(drop)), keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed["_h"] == F.col("_x")), "left")
    lines = F.split("text", "\n")
    kept = F.when(F.col("_pos").isNull(), F.col("text")).otherwise(F.array_join(without(lines, F.col("_pos")), "\n"))
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines))
    return joined.select("_row", n.cast("long").alias("_n"), F.when(F.col("_pos").isNull(), F.lit(0)).otherwise(F.size("_pos")).cast("long").alias("_d"), kept.alias("_kept"))


def drop_templates(docs: DataFrame) -> DataFrame:
    """The documents with the text that is left of them; n_chars follows where there is such a column."""
    out = _rewritten(docs)
    own = {"text": F.col("_kept"), "n_chars": F.char_length("_kept").cast("long")}
    return out.select(*(own[c].alias(c) if c in own else F.col("_row")[c].alias(c) for c in docs.columns))


def op3_template_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _rewritten(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("_row.doc_id", F.col("_n").alias("n_lines"), F.col("_d").alias("n_dropped"), F.sha2(F.coalesce("_kept", F.lit("")), 256).alias("kept_sha256"))


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, without recurring lines; null texts stay null."""
    release_driver(spark)
    return drop_templates(docs)


#: Rows (rid, doc_id, text, kept) of the documents; {{docs}} is a table or a query in brackets.
_SQL = f"""
l0 AS (SELECT rid, doc_id, text, pos - 1 pos, trim(regexp_replace(regexp_replace(line, '[^\\s]*[0-9][^\\s]*', '{FIELD}', 'g'), '\\s+', ' ', 'g'), ' ') line
  FROM (SELECT rid, doc_id, text, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) pos FROM src)),
l1 AS (SELECT *, string_split(line, ' ') w FROM l0 WHERE line <> ''),
l2 AS (SELECT *, len(w) || ' ' || array_to_string(w[1:{LEAD}], ' ') leaf FROM l1),
lm AS (SELECT leaf, count(DISTINCT text) m FROM l2 GROUP BY leaf HAVING count(DISTINCT text) >= {min(MIN_DOCS, LONG_DOCS)}),
l3 AS (SELECT l2.*, m FROM l2 JOIN lm USING (leaf)),
f0 AS (SELECT leaf, line, any_value(w) w, any_value(m) m, count(DISTINCT text) d FROM l3 GROUP BY leaf, line),
f1 AS (SELECT leaf, line, m, d, unnest(w) token, generate_subscripts(w, 1) nth FROM f0),
f2 AS (SELECT *, CASE WHEN token <> '{FIELD}' THEN sum(d) OVER (PARTITION BY leaf, nth, token) ELSE 0 END seen FROM f1),
f3 AS (SELECT leaf, line, nth, token = '{FIELD}' field, CASE WHEN seen >= {MIN_DOCS} THEN token END fine, CASE WHEN seen >= greatest({MIN_DOCS}, ceil(m * {SHARE}e0)) THEN token END coarse FROM f2),
f4 AS (SELECT leaf, line, count(*) FILTER (NOT field) words, count(fine) n_fine, count(coarse) n_coarse, coalesce(bool_or(regexp_matches(fine, '\\pL')), false) a, coalesce(bool_or(regexp_matches(coarse, '\\pL')), false) b,
  string_agg(coalesce(fine, chr(1)), ' ' ORDER BY nth) t_fine, string_agg(coalesce(coarse, chr(1)), ' ' ORDER BY nth) t_coarse FROM f3 GROUP BY leaf, line),
f5 AS (SELECT leaf, line, 'fine ' || t_fine template, {MIN_DOCS} least FROM f4 WHERE n_fine >= words * {CONSTANT}e0 AND a
  UNION ALL SELECT leaf, line, 'coarse ' || t_coarse, {MIN_DOCS} FROM f4 WHERE n_coarse > {LEAD} AND n_coarse * 2 >= words AND b
  UNION ALL SELECT leaf, line, 'long ' || line, {LONG_DOCS} FROM f4 WHERE strlen(line) >= {LONG_BYTES}),
p0 AS (SELECT rid, doc_id, text, pos, leaf || chr(2) || template template, least FROM l3 JOIN f5 USING (leaf, line)),
p1 AS (SELECT template, min(struct_pack(x := doc_id IS NULL, y := doc_id, z := pos)) r FROM p0 GROUP BY template HAVING count(DISTINCT text) >= any_value(least)),
dropped AS (SELECT rid, list(DISTINCT pos) gone FROM p0 JOIN p1 USING (template) WHERE struct_pack(x := doc_id IS NULL, y := doc_id, z := pos) IS DISTINCT FROM r GROUP BY rid),
kept AS (SELECT src.*, len(gone) n_gone, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END kept
  FROM src LEFT JOIN dropped USING (rid))"""

ORACLE_SQL = f"""WITH src AS (SELECT row_number() OVER () rid, doc_id, text FROM {{docs}}), {_SQL}
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT n_lines, coalesce(n_gone, 0)::BIGINT n_dropped, sha256(coalesce(kept, '')) kept_sha256 FROM kept"""
