"""Queries of the library over the standard tables, each with an independent SQL text."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import constants as C
from .functions import jsonx as J
from .functions import numeric as N
from .functions import text as T
from .operators import kb as K
from .operators import planning as P
from .operators import quota as Q
from .operators import review as R
from .operators import validate as V
from .plans import assess as AS
from .plans import legacy as LE
from .plans import rounds as RO
from .plans.backend import StubBackend
from .session import drop_at_exit, shared_folder
from .sources.store import Folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def text(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


# -- synthetic seeds over lineitem and part ---------------------------------------------------------------------------

NAMES = ["Maria", "Omar", "Lena", "Kofi", "Anna", "Tom", "Ravi"]


def seeds(spark: SparkSession, d: str) -> DataFrame:
    """Word problems out of lineitem and part: four sentence forms, some with a wrong result."""
    j = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(t(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    k, q, p = F.col("l_linenumber"), F.col("l_quantity").cast("bigint"), F.col("p_size").cast("bigint")
    s = lambda c: c.cast("string")
    j = j.select((F.col("l_orderkey") * 8 + k).alias("ord"), F.element_at(T.strings(NAMES), k).alias("name"), k.alias("k"), q.alias("q"), p.alias("p"), F.col("p_name"), F.col("p_type").alias("question_type"))
    j = j.withColumn("r", F.col("q") * F.col("p") + F.when(F.col("k") == 3, 1).otherwise(0)).withColumn("fin", F.when(F.col("k") % 2 == 0, F.col("r") + F.col("k")).otherwise(F.col("r")))
    n, q, p, k = F.col("name"), s(F.col("q")), s(F.col("p")), F.col("k")
    question = (
        F.when(k % 4 == 0, text(n, " packs ", q, " boxes of ", F.col("p_name"), " at $", p, " each. How much is the total?"))
        .when(k % 4 == 1, text("Every day ", n, " counts ", q, " bags and ", p, " ", F.col("p_name"), " per bag. How many are left after ", s(k), "% are sold?"))
        .when(k % 4 == 2, text("In April Aunt ", n, " shares ", q, " books of ", F.col("p_name"), ", half for ", p, " dollars. What is the ratio? And what is the price?"))
        .otherwise(text("The ", F.col("p_name"), " workshop of ", n, "'s makes ", q, " items per hour for ", p, " hours. How many items altogether?"))
    )
    solution = text(n, " computes ", q, " * ", p, ".\n<<", q, "*", p, "=", s(F.col("r")), ">>", F.when(k % 2 == 0, text("\n<<", s(F.col("r")), "+", s(k), "=", s(F.col("fin")), ">>")).otherwise(""))
    j = j.withColumns({"question": question, "solution": solution, "task_id": s(F.col("ord"))})
    return j.withColumn("answer", text(F.col("solution"), "\n#### ", s(F.col("fin"))))


SEED = """seed AS (SELECT *, solution || chr(10) || '#### ' || fin::VARCHAR answer FROM (SELECT *, ord::VARCHAR task_id,
 CASE k % 4 WHEN 0 THEN name || ' packs ' || q || ' boxes of ' || p_name || ' at $' || p || ' each. How much is the total?'
  WHEN 1 THEN 'Every day ' || name || ' counts ' || q || ' bags and ' || p || ' ' || p_name || ' per bag. How many are left after ' || k || '% are sold?'
  WHEN 2 THEN 'In April Aunt ' || name || ' shares ' || q || ' books of ' || p_name || ', half for ' || p || ' dollars. What is the ratio? And what is the price?'
  ELSE 'The ' || p_name || ' workshop of ' || name || '''s makes ' || q || ' items per hour for ' || p || ' hours. How many items altogether?' END question,
 name || ' computes ' || q || ' * ' || p || '.' || chr(10) || '<<' || q || '*' || p || '=' || r || '>>' || CASE WHEN k % 2 = 0 THEN chr(10) || '<<' || r || '+' || k || '=' || fin || '>>' ELSE '' END solution
 FROM (SELECT *, CASE WHEN k % 2 = 0 THEN r + k ELSE r END fin FROM (SELECT l_orderkey * 8 + l_linenumber ord, ['Maria','Omar','Lena','Kofi','Anna','Tom','Ravi'][l_linenumber] name, l_linenumber k,
  l_quantity::BIGINT q, p_size::BIGINT p, p_name, p_type question_type, l_quantity::BIGINT * p_size::BIGINT + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END r FROM lineitem JOIN part ON l_partkey = p_partkey))))"""


def spread(df: DataFrame) -> DataFrame:
    """The rows of a small file over all cores, for work that is long per row."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, "ord")


def counted(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct values of those columns with their number n, over all cores: what is read from a text is read once.

    Kept before rows are exploded, as Spark moves a filter of the exploded list below the count.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def folder(spark) -> Folder:
    """A new folder for a stage's files, gone at the driver's end."""
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    drop_at_exit(spark, path)
    return Folder(spark, path)


def _given(df: DataFrame) -> DataFrame:
    return df.withColumn("solution_steps", F.col("solution")).withColumn("answer", F.col("fin").cast("string"))


def known(spark: SparkSession, d: str) -> DataFrame:
    return K.records(_given(spread(seeds(spark, d))))


def recorded(spark: SparkSession, d: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Those columns of the records of the seeds' texts as a table, as a bank reads them more than once; and the seeds."""
    given = _given(seeds(spark, d))
    return folder(spark).keep(K.text_records(given).select("ord", "task_id", "question", "question_types", "n", "h", "g", *columns)), given


# -- mastery and quota ------------------------------------------------------------------------------------------------


def attempts(spark, d) -> DataFrame:
    e = t(spark, d, "events")
    return e.select(F.col("user_id").alias("task_id"), F.least(F.col("value") / 100, F.lit(1e0)).alias("step_score_mean"), (F.col("event_id") % 10 < F.col("user_id") % 11).alias("correct"))


def _mastery_sql(weight: str) -> str:
    return f"""SELECT task_id, round(avg(c), 6) accuracy, round((1 + sum(w * c)) / (2 + sum(w)), 6) mastery FROM (SELECT user_id task_id, {weight} w, CASE WHEN event_id % 10 < user_id % 11 THEN 1e0 ELSE 0e0 END c
 FROM (SELECT *, least(value / 100, 1e0) s FROM events)) GROUP BY task_id"""


LINEAR = _mastery_sql("greatest(0e0, 2 * s - 1)")
LABEL_SQL = "CASE WHEN mastery <= 0.2 THEN 'Easy' WHEN mastery <= 0.4 THEN 'Slightly Easy' WHEN mastery <= 0.6 THEN 'Equal' WHEN mastery <= 0.8 THEN 'Slightly Hard' ELSE 'Hard' END"


def rounded_mastery(spark, d, method="linear_cutoff") -> DataFrame:
    return Q.mastery(attempts(spark, d), method).select("task_id", F.round("accuracy", 6).alias("accuracy"), F.round("mastery", 6).alias("mastery"))


@query(LINEAR)
def mastery_by_user(spark, d):
    return rounded_mastery(spark, d)


@query(_mastery_sql("1 / (1 + exp(-10 * (s - 0.5e0)))"))
def mastery_sigmoid(spark, d):
    return rounded_mastery(spark, d, "sigmoid")


@query(f"SELECT task_id, label, CASE label WHEN 'Easy' THEN 'easy' WHEN 'Slightly Easy' THEN 'easy' WHEN 'Equal' THEN 'medium' WHEN 'Slightly Hard' THEN 'hard' ELSE 'very_hard' END bucket FROM (SELECT task_id, {LABEL_SQL} label FROM ({LINEAR}))")
def difficulty_label(spark, d):
    label = N.difficulty_label(F.col("mastery"))
    return rounded_mastery(spark, d).select("task_id", label.alias("label"), N.choice(label, C.LABEL_BUCKET).alias("bucket"))


@query(f"SELECT label, count(*) n FROM (SELECT {LABEL_SQL} label FROM ({LINEAR})) GROUP BY label")
def difficulty_bucket_hist(spark, d):
    return rounded_mastery(spark, d).groupBy(N.difficulty_label(F.col("mastery")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def _quota_input(spark, d) -> DataFrame:
    group = F.when(F.col("task_id") % 10 < 6, "common").when(F.col("task_id") % 10 < 9, "some").otherwise(None)
    return rounded_mastery(spark, d).select(F.col("task_id").alias("ord"), "task_id", "mastery", group.alias("category"))


_QUOTA = f"""m AS (SELECT task_id, mastery, CASE WHEN task_id % 10 < 6 THEN 'common' WHEN task_id % 10 < 9 THEN 'some' ELSE 'unknown' END category FROM ({LINEAR})),
g AS (SELECT category, count(*) n FROM m GROUP BY category),
w AS (SELECT m.task_id, mastery, category, power((mastery - lo) / width * (1 - (mastery - lo) / width), 2) * power((SELECT max(n) FROM g) / n, 0.3e0) + 1e-8 weight
 FROM m JOIN g USING (category), (SELECT min(mastery) lo, greatest(max(mastery) - min(mastery), 1e-8) width FROM m)),
a AS (SELECT *, count(*) OVER () * 25 new_total, least(greatest(round_even(10 + (count(*) OVER () * 25 - count(*) OVER () * 10) * weight / sum(weight) OVER (), 0), 10), 50)::INT raw_count FROM w)"""


@query(f"WITH {_QUOTA} SELECT task_id, category, round(weight, 6) weight, raw_count FROM a")
def quota_allocation(spark, d):
    return Q.allocate(_quota_input(spark, d)).select("task_id", "category", F.round("weight", 6).alias("weight"), "raw_count")


@query(f"""WITH {_QUOTA}, df AS (SELECT max(new_total) - sum(raw_count) diff FROM a),
rk AS (SELECT a.*, row_number() OVER (ORDER BY weight DESC, task_id) - 1 pos, CASE WHEN diff > 0 THEN 50 - raw_count ELSE raw_count - 10 END slack FROM a, df),
lv AS (SELECT task_id, pos, unnest(range(1, slack + 1)) lvl FROM rk WHERE slack > 0),
tk AS (SELECT task_id, row_number() OVER (ORDER BY lvl, pos) nth FROM lv WHERE lvl <= 20 OR (lvl = 21 AND pos = 0))
SELECT rk.task_id, (raw_count + (CASE WHEN (SELECT diff FROM df) > 0 THEN 1 ELSE -1 END) * count(nth) FILTER (nth <= abs((SELECT diff FROM df))))::INT target_count FROM rk LEFT JOIN tk USING (task_id) GROUP BY rk.task_id, raw_count""")
def quota_residual(spark, d):
    return Q.settle(Q.allocate(_quota_input(spark, d))).select("task_id", "target_count")


@query(f"WITH {_QUOTA} SELECT task_id, unnest(range(raw_count))::INT variant, task_id::VARCHAR || '_' || unnest(range(raw_count)) plan_id FROM a")
def variant_expansion(spark, d):
    q = Q.allocate(_quota_input(spark, d)).filter("raw_count > 0")
    return q.select("task_id", F.explode(F.sequence(F.lit(0), F.col("raw_count") - 1)).alias("variant")).withColumn("plan_id", F.concat_ws("_", F.col("task_id").cast("string"), F.col("variant").cast("string")))


@query("SELECT c_custkey task, a::INT attempt, c_custkey::VARCHAR || '_' || a::VARCHAR attempt_id FROM customer, range(4) r(a)")
def attempt_expansion(spark, d):
    return t(spark, d, "customer").select(F.col("c_custkey").alias("task"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("attempt")).withColumn("attempt_id", F.concat_ws("_", F.col("task").cast("string"), F.col("attempt").cast("string")))


# -- stable hashes, rings, plans --------------------------------------------------------------------------------------


@query("SELECT p_partkey, (('0x' || substr(sha256(p_name || '|' || p_partkey), 1, 16))::UBIGINT % 21)::INT slot FROM part")
def stable_hash_mod(spark, d):
    return t(spark, d, "part").select("p_partkey", N.stable_mod(text(F.col("p_name"), "|", F.col("p_partkey").cast("string")), 21).alias("slot"))


@query("SELECT p_partkey, (('0x' || substr(sha1(p_name || '|' || p_partkey), 1, 16))::UBIGINT % 21)::INT slot FROM part")
def stable_hash_sha1(spark, d):
    return t(spark, d, "part").select("p_partkey", N.stable_mod(text(F.col("p_name"), "|", F.col("p_partkey").cast("string")), 21, "sha1").alias("slot"))


@query("""SELECT p_partkey, array_to_string(list_transform(range(least(3, len(w))), lambda o: w[((('0x' || substr(sha256(p_partkey || '|pick'), 1, 16))::UBIGINT % len(w))::INT + o) % len(w) + 1]), ',') picked
FROM (SELECT p_partkey, string_split(p_name || ' ' || lower(p_type) || ' ' || lower(p_brand), ' ') w FROM part)""")
def ring_select(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.split(F.concat_ws(" ", "p_name", F.lower("p_type"), F.lower("p_brand")), " ").alias("w"))
    return p.select("p_partkey", F.array_join(N.ring(F.col("w"), N.stable_mod(text(F.col("p_partkey").cast("string"), "|pick"), F.size("w")), 3), ",").alias("picked"))


_BUCKET = "['easy','medium','hard','very_hard'][(p_size % 4 + 1)::INT]"


def _part_kb(spark, d) -> DataFrame:
    return t(spark, d, "part").select(
        F.col("p_partkey").alias("ord"), F.col("p_partkey").cast("string").alias("task_id"), F.array("p_brand", "p_type").alias("skills"), F.split("p_name", " ").alias("ops"),
        F.element_at(T.strings(C.BUCKETS), F.col("p_size") % 4 + 1).alias("bucket"),
    )


@query(f"""WITH kb AS (SELECT p_partkey ord, p_partkey::VARCHAR id, [p_brand, p_type] skills, string_split(p_name, ' ') ops, p_size % 4 rk, {_BUCKET} bucket FROM part),
s AS (SELECT kb.*, 'medium' tb FROM kb JOIN supplier ON s_suppkey = ord),
x AS (SELECT s.id, s.tb, c.id source_id, (20 * len(list_intersect(s.skills, c.skills)) + 8 * len(list_intersect(s.ops, c.ops)) - 10 * abs(c.rk - 1))::INT score, c.ord FROM s, kb c WHERE s.id <> c.id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, ('0x' || substr(sha256(id || '|' || source_id), 1, 16))::UBIGINT, ord) - 1 pos, count(*) OVER (PARTITION BY id) n FROM x)
SELECT id task_id, v::INT variant, score, source_id FROM r, range(3) q(v) WHERE pos = ((('0x' || substr(sha256(id || '|' || tb), 1, 16))::UBIGINT % n)::BIGINT + v) % n""")
def scene_source_rank(spark, d):
    kb = _part_kb(spark, d)
    s = kb.join(t(spark, d, "supplier").select(F.col("s_suppkey").alias("ord")), "ord").select("task_id", "skills", "ops", "bucket", F.lit("medium").alias("target_bucket"), F.lit(3).alias("target_count"))
    return P.scene_sources(s, kb).select("task_id", "variant", "score", "source_id")


@query(f"""WITH c AS (SELECT p_partkey::VARCHAR id, {_BUCKET} b FROM part),
s AS (SELECT c.id, {LABEL_SQL.replace('mastery', '(s_suppkey % 10) / 10e0')} label, 'medium' tb, v::INT variant FROM c JOIN supplier ON s_suppkey::VARCHAR = c.id, range(2) q(v)),
l AS (SELECT s.*, CASE label WHEN 'Easy' THEN 'easy' WHEN 'Slightly Easy' THEN 'easy' WHEN 'Equal' THEN 'medium' WHEN 'Slightly Hard' THEN 'hard' ELSE 'very_hard' END pick FROM s),
r AS (SELECT l.id, variant, label, tb, pick, c.id card, row_number() OVER (PARTITION BY l.id, variant ORDER BY c.id = l.id, c.id) - 1 pos, count(*) OVER (PARTITION BY l.id, variant) n,
 max(c.id = l.id) OVER (PARTITION BY l.id, variant) own FROM l JOIN c ON c.b = pick),
h AS (SELECT *, (('0x' || substr(sha1(id || '|' || label || '|' || tb || '|' || variant || '|' || pick), 1, 16))::UBIGINT % n)::BIGINT st FROM r)
SELECT id task_id, variant, pick selected_bucket, card card_id FROM h WHERE pos = CASE WHEN own AND n > 1 AND st = n - 1 THEN 0 ELSE st END""")
def bucket_priority_pick(spark, d):
    cards = _part_kb(spark, d).select("task_id", "bucket")
    s = cards.join(t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("task_id")), "task_id")
    s = s.select("task_id", N.difficulty_label((F.col("task_id").cast("long") % 10) / F.lit(10e0)).alias("target_difficulty"), F.lit("medium").alias("target_bucket"), F.explode(F.array(F.lit(0), F.lit(1))).alias("variant"))
    return P.priority_pick(s, cards)


@query("""WITH k AS (SELECT p_partkey id, p_brand || p_type key, lower(p_name) sc, lower(p_name) || p_size sn FROM part),
r AS (SELECT a.id, b.id peer, row_number() OVER (PARTITION BY a.id ORDER BY b.sc = a.sc, b.sn = a.sn, b.id) n FROM k a JOIN k b ON a.key = b.key AND a.id <> b.id)
SELECT k.id task_id, coalesce(string_agg(peer::VARCHAR, ',' ORDER BY n), '') peers FROM k LEFT JOIN r ON r.id = k.id AND n <= 6 GROUP BY k.id""")
def peer_topk(spark, d):
    p = t(spark, d, "part").select(F.col("p_partkey").alias("task_id"), F.concat("p_brand", "p_type").alias("key"), F.col("p_name").alias("scene_template"), F.concat("p_name", F.col("p_size").cast("string")).alias("scenario_template"))
    return P.peers(p, "key").select("task_id", F.array_join(F.col("peer_ids").cast("array<string>"), ",").alias("peers"))


_DOM = "[" + ",".join(f"'{x['domain']}'" for x in C.domains()) + "]"


def _slot(key: str, n: int) -> str:
    return f"(('0x' || substr(sha256({key}), 1, 16))::UBIGINT % {n})::BIGINT"


def _list(values) -> str:
    return "[" + ",".join("'" + v + "'" for v in values) + "]"


@query(f"""SELECT id || '_' || v plan_id, {_DOM}[({_slot("id || '|domain'", 21)} + v) % 21 + 1] AS scene, {_list(C.VARIATION_MODES)}[({_slot("id || '|variation'", 6)} + v) % 6 + 1] AS vmode,
 {_list(C.NARRATIVE_STYLES)}[({_slot("id || '|narrative'", 6)} + v // 21) % 6 + 1] AS style, {_list(C.NUMBER_STRATEGIES)}[({_slot("id || '|numbers'", 6)} + v) % 6 + 1] AS numbers FROM (SELECT s_suppkey::VARCHAR id FROM supplier), range(25) q(v)""")
def plan_diversity(spark, d):
    s = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.explode(F.sequence(F.lit(0), F.lit(24))).alias("v"))
    x = s.withColumn("x", P.diversity(F.col("id"), F.col("v")))
    return x.select(F.concat_ws("_", "id", F.col("v").cast("string")).alias("plan_id"), F.col("x.primary_scene.domain").alias("scene"), F.col("x.variation_mode").alias("vmode"), F.col("x.narrative_style").alias("style"), F.col("x.number_strategy").alias("numbers"))


@query(f"""WITH s AS (SELECT s_suppkey || '_0' id, {_DOM}[s_suppkey % 21 + 1] cur, ['similarity','request_error','stubborn_validation'][s_suppkey % 3 + 1] why FROM supplier),
st AS (SELECT *, {_slot("id || '|replan|2'", 21)} st FROM s)
SELECT id plan_id, CASE WHEN why <> 'request_error' THEN {_DOM}[CASE WHEN {_DOM}[st + 1] = cur THEN (st + 1) % 21 ELSE st END + 1] END scene FROM st""")
def replan_domain_shift(spark, d):
    k = F.col("s_suppkey").cast("int")
    s = t(spark, d, "supplier").select(text(k.cast("string"), "_0").alias("plan_id"), F.element_at(T.strings([x["domain"] for x in C.domains()]), k % 21 + 1).alias("cur"), F.element_at(T.strings(["similarity", "request_error", "stubborn_validation"]), k % 3 + 1).alias("why"))
    return s.select("plan_id", P.replanned(F.col("plan_id"), F.col("cur"), F.col("why"), F.lit(2))["primary_scene"]["domain"].alias("scene"))


@query(f"SELECT s_suppkey, CASE WHEN m < 0.33 THEN lo || ',' || md || ',' || md WHEN m < 0.66 THEN lo || ',' || md || ',' || hi WHEN m > 0.83 THEN md || ',' || hi || ',' || hi || ',' || h2 ELSE md || ',' || hi || ',' || hi END profile FROM (SELECT s_suppkey, (s_suppkey % 10) / 10e0 m, {_list(C.BUCKETS)}[greatest(s_nationkey % 4 - 1, 0) + 1] lo, {_list(C.BUCKETS)}[s_nationkey % 4 + 1] md, {_list(C.BUCKETS)}[least(s_nationkey % 4 + 1, 3) + 1] hi, {_list(C.BUCKETS)}[least(s_nationkey % 4 + 2, 3) + 1] h2 FROM supplier)")
def difficulty_profile(spark, d):
    s = t(spark, d, "supplier")
    return s.select("s_suppkey", F.array_join(P.difficulty_profile((F.col("s_suppkey") % 10) / F.lit(10e0), F.element_at(T.strings(C.BUCKETS), F.col("s_nationkey") % 4 + 1)), ",").alias("profile"))


# -- text -------------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g'), ' ')) digest FROM documents")
def normalize_whitespace(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(T.ws(F.col("text"))).alias("digest"))


@query("SELECT doc_id, len(w) n, md5(array_to_string(w, ' ')) digest FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]+(?:''[A-Za-z]+)?') w FROM documents)")
def word_tokens(spark, d):
    w = T.word_tokens(F.col("text"))
    return t(spark, d, "documents").select("doc_id", F.size(w).cast("long").alias("n"), F.md5(F.array_join(w, " ")).alias("digest"))


@query("""WITH x AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) w FROM documents), p AS (SELECT a.doc_id, a.w wa, b.w wb FROM x a JOIN x b ON b.doc_id = a.doc_id + 1)
SELECT doc_id, round(CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0e0 ELSE len(list_intersect(wa, wb)) / len(list_distinct(list_concat(wa, wb))) END, 6) overlap FROM p""")
def token_jaccard(spark, d):
    x = t(spark, d, "documents").select("doc_id", T.token_set(F.col("text")).alias("w"))
    y = x.select((F.col("doc_id") - 1).alias("doc_id"), F.col("w").alias("v"))
    return x.join(y, "doc_id").select("doc_id", F.round(T.jaccard(F.col("w"), F.col("v")), 6).alias("overlap"))


_MASK = r"regexp_replace(regexp_replace(regexp_replace(question, '\$\s*\d+(?:,\d{3})*(?:\.\d+)?', '<MONEY>', 'g'), '\b\d+(?:\.\d+)?\s*%', '<PERCENT>', 'g'), '\b\d+(?:,\d{3})*(?:\.\d+)?\b', '<NUM>', 'g')"


@query(f"WITH {SEED} SELECT masked, count(*) n FROM (SELECT {_MASK} masked FROM seed) GROUP BY masked")
def mask_numbers(spark, d):
    return seeds(spark, d).groupBy(T.mask_numbers(F.col("question")).alias("masked")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SEED} SELECT scene, count(*) n FROM (SELECT CASE k % 4 WHEN 0 THEN replace(m, name, '<PERSON>') WHEN 1 THEN replace(m, name, '<PERSON>') WHEN 2 THEN replace(m, 'April Aunt ' || name, '<PERSON> <PERSON> <PERSON>') ELSE replace(m, name || '''s', '<PERSON>') END scene
 FROM (SELECT k, name, {_MASK} m FROM seed)) GROUP BY scene""")
def templates(spark, d):
    return known(spark, d).groupBy(F.col("scene_template").alias("scene")).agg(F.count(F.lit(1)).alias("n"))


_TAGS = "list_filter([" + ",".join(f"CASE WHEN regexp_matches(s, '{p}') THEN '{n}' END" for n, p in C.OPERATION_RULES) + "], lambda x: x IS NOT NULL)"


@query(f"WITH {SEED} SELECT array_to_string({_TAGS}, ',') tags, count(*) n FROM (SELECT lower(question || chr(10) || solution) s FROM seed) GROUP BY tags")
def operation_tags(spark, d):
    return seeds(spark, d).groupBy(F.array_join(T.operation_tags(F.col("question"), F.col("solution")), ",").alias("tags")).agg(F.count(F.lit(1)).alias("n"))


_SIG = f"array_to_string(list_sort({_TAGS}), '|') || '::multiplication' || CASE WHEN k % 2 = 0 THEN '->addition' ELSE '' END"


@query(f"WITH {SEED} SELECT knowledge_signature, count(*) n FROM (SELECT {_SIG} knowledge_signature FROM (SELECT k, lower(question || chr(10) || solution) s FROM seed)) GROUP BY 1")
def operation_signature(spark, d):
    return known(spark, d).groupBy("knowledge_signature").agg(F.count(F.lit(1)).alias("n"))


_DIFF = r"CASE WHEN v <= 2.5 THEN 'easy' WHEN v <= 5 THEN 'medium' WHEN v <= 8 THEN 'hard' ELSE 'very_hard' END"
_DIFFV = r"len(regexp_extract_all(solution, '<<')) * 2 + len(regexp_extract_all(solution, '[+\-*/%]')) + len(regexp_extract_all(question, '[A-Za-z]+(?:''[A-Za-z]+)?')) / 20e0"


@query(f"WITH {SEED} SELECT bucket, count(*) n FROM (SELECT {_DIFF} bucket FROM (SELECT {_DIFFV} v FROM seed)) GROUP BY bucket")
def kb_difficulty(spark, d):
    s = seeds(spark, d)
    return s.groupBy(T.difficulty(F.size(T.calculation_steps(F.col("solution"))), F.col("question"), F.col("solution")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


_UNITS = "list_distinct(flatten([" + ",".join(f"regexp_extract_all(lower(question), '{p}')" for p in C.UNIT_PATTERNS) + "]))"


@query(f"WITH {SEED} SELECT units, count(*) n FROM (SELECT array_to_string(list_sort({_UNITS}), ',') units FROM seed) GROUP BY units")
def unit_extraction(spark, d):
    return seeds(spark, d).groupBy(F.array_join(F.array_sort(T.units(F.col("question"))), ",").alias("units")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SEED} SELECT persons, count(*) n FROM (SELECT CASE k % 4 WHEN 2 THEN 'April,Aunt,' || name WHEN 3 THEN name || ',' || name || '''s' ELSE name END persons FROM seed) GROUP BY persons")
def person_extraction(spark, d):
    return seeds(spark, d).groupBy(F.array_join(F.array_sort(T.persons(F.col("question"))), ",").alias("persons")).agg(F.count(F.lit(1)).alias("n"))


_BANNED = _list(sorted({*C.STOPWORDS, *C.QUESTION_WORDS, *C.ACTION_WORDS, *C.UNIT_WORDS}))


@query(f"""WITH {SEED}, w AS (SELECT task_id, regexp_extract_all(question, '[A-Za-z]+(?:''[A-Za-z]+)?') w FROM seed), f AS (SELECT w, list_transform(w, lambda x: len(x) > 2 AND NOT list_contains({_BANNED}, lower(x))) c FROM w)
SELECT bigram, count(*) n FROM (SELECT w[i] || ' ' || w[i + 1] bigram FROM (SELECT w, c, unnest(range(1, len(w))) i FROM f) WHERE c[i] AND c[i + 1]) GROUP BY bigram""")
def focus_bigrams(spark, d):
    grams = folder(spark).keep(counted(seeds(spark, d), "question")).select("n", F.explode(T.ngrams(T.word_tokens(F.col("question")), 2)).alias("bigram"))
    return grams.groupBy("bigram").agg(F.sum("n").alias("n"))


@query(f"WITH {SEED} SELECT task_id, q || '*' || p || '=' || r || CASE WHEN k % 2 = 0 THEN ';' || r || '+' || k || '=' || fin ELSE '' END steps FROM seed")
def gsm_steps(spark, d):
    s = T.calculation_steps(F.col("solution"))
    return seeds(spark, d).select("task_id", F.array_join(F.transform(s, lambda x: F.concat_ws("=", x["expression"], x["result"])), ";").alias("steps"))


@query(f"WITH {SEED} SELECT task_id, md5(solution) solution, fin::VARCHAR answer, 'raw_gsm8k' source_schema FROM seed")
def solution_split(spark, d):
    x = seeds(spark, d).withColumn("x", T.solution_and_answer(F.lit(None).cast("string"), F.col("answer")))
    return x.select("task_id", F.md5("x.solution").alias("solution"), F.col("x.answer").alias("answer"), F.col("x.schema").alias("source_schema"))


@query(f"""WITH {SEED}, u AS (SELECT *, unnest({_UNITS}) term FROM seed) SELECT 'unit' kind, term, count(*) AS cnt, min(task_id) first_id, count(DISTINCT question_type) n_types, least(3, count(*)) n_examples FROM u GROUP BY term""")
def concept_bank(spark, d):
    b = K.concept_bank(*recorded(spark, d, "scene_template", "persons", "focus_terms", "units")).filter("kind = 'unit'")
    return b.select("kind", "term", F.col("count").alias("cnt"), F.col("first_task_id").alias("first_id"), F.size("question_types").cast("long").alias("n_types"), F.size("examples").cast("long").alias("n_examples"))


@query()
def concept_bank_all_kinds(spark, d):
    """The whole bank; the SQL text of concept_bank has the units only, as SQL can't find persons and focus terms."""
    b = K.concept_bank(*recorded(spark, d, "scene_template", "persons", "focus_terms", "units"))
    return b.select("kind", "term", F.col("count").alias("cnt"), F.col("first_task_id").alias("first_id"), F.size("question_types").cast("long").alias("n_types"), F.md5(F.array_join("examples", "|")).alias("examples"))


@query(f"WITH {SEED} SELECT task_id, question_type, term FROM (SELECT task_id, question_type, unnest({_UNITS}) term FROM seed)")
def concept_links(spark, d):
    """Occurrences of units."""
    return K.concept_links(known(spark, d)).filter("kind = 'unit'").select("task_id", "question_type", "term")


_SCENE = f"(SELECT *, CASE k % 4 WHEN 2 THEN replace(m, 'April Aunt ' || name, '<PERSON> <PERSON> <PERSON>') WHEN 3 THEN replace(m, name || '''s', '<PERSON>') ELSE replace(m, name, '<PERSON>') END scene FROM (SELECT *, {_MASK} m, lower(question || chr(10) || solution) s FROM seed))"
_BUCKET_OF = _DIFF.replace("v <=", f"{_DIFFV} <=")


@query(f"""WITH {SEED}, x AS (SELECT *, {_TAGS} tags, {_BUCKET_OF} bucket FROM {_SCENE}) SELECT lower(scene) key, count(*) cnt, round(avg(len(regexp_extract_all(solution, '<<'))), 3) avg_step_count, array_to_string(list_sort(list_distinct(list(question_type))), ',') question_types,
 array_to_string(list_sort(list_distinct(flatten(list(tags)))), ',') skill_tags, array_to_string(list_sort(list_distinct(list(bucket))), ',') buckets, array_to_string(list(task_id ORDER BY ord)[1:3], ',') examples, arg_min(m, ord) surface_template FROM x GROUP BY 1""")
def scene_bank(spark, d):
    b = K.scene_bank(*recorded(spark, d, "answer", "surface_template", "scene_template", "scenario_template", "skill_tags", "difficulty_bucket", "step_count"))
    joined = lambda c: F.array_join(c, ",")
    return b.select("key", F.col("count").alias("cnt"), "avg_step_count", joined("question_types").alias("question_types"), joined("skill_tags").alias("skill_tags"), joined("difficulty_buckets").alias("buckets"), joined(F.col("examples.task_id")).alias("examples"), "surface_template")


@query(f"""WITH {SEED}, x AS (SELECT *, {_BUCKET_OF} bucket FROM {_SCENE}) SELECT lower(m) key, count(*) cnt, array_to_string(list_sort(list_distinct(list(bucket))), ',') buckets, array_to_string(list_sort(list_distinct(list(question_type))), ',') question_types,
 least(3, count(*)) n_examples, arg_min(scene, ord) scene_template FROM x GROUP BY 1""")
def template_bank(spark, d):
    b = K.template_bank(*recorded(spark, d, "surface_template", "scene_template", "scenario_template", "difficulty_bucket"))
    return b.select("key", F.col("count").alias("cnt"), F.array_join("difficulty_buckets", ",").alias("buckets"), F.array_join("question_types", ",").alias("question_types"), F.size("examples").cast("long").alias("n_examples"), "scene_template")


@query(f"""WITH {SEED}, x AS (SELECT *, {_SIG} sig, {_TAGS} tags, {_BUCKET_OF} bucket FROM {_SCENE}) SELECT sig knowledge_signature, count(*) cnt, round(avg(1 + (k % 2 = 0)::INT), 3) avg_step_count, array_to_string(arg_min(tags, ord), ',') skill_tags,
 arg_min(CASE WHEN k % 2 = 0 THEN 'multiplication,addition' ELSE 'multiplication' END, ord) operation_sequence, arg_min(bucket, ord) difficulty_bucket, array_to_string(list_sort(list_distinct(list(question_type))), ',') question_types,
 array_to_string(list(task_id ORDER BY ord)[1:3], ',') examples FROM x GROUP BY 1""")
def knowledge_bank(spark, d):
    joined = lambda c: F.array_join(c, ",")
    return K.knowledge_bank(*recorded(spark, d, "answer", "knowledge_signature", "skill_tags", "operation_sequence", "difficulty_bucket", "step_count")).select(
        "knowledge_signature", F.col("count").alias("cnt"), "avg_step_count", joined("skill_tags").alias("skill_tags"), joined("operation_sequence").alias("operation_sequence"), "difficulty_bucket", joined("question_types").alias("question_types"),
        joined(F.col("examples.task_id")).alias("examples"),
    )


@query(f"WITH {SEED} SELECT {_SIG} AS key, task_id, CASE WHEN k % 2 = 0 THEN 'multiplication,addition' ELSE 'multiplication' END operation_sequence FROM (SELECT *, lower(question || chr(10) || solution) s FROM seed)")
def knowledge_links(spark, d):
    return K.bank_links(known(spark, d), F.col("knowledge_signature")).select("key", "task_id", F.array_join("operation_sequence", ",").alias("operation_sequence"))


@query(f"""WITH {SEED}, b AS (SELECT {_SIG} knowledge_signature, count(*) cnt FROM (SELECT *, lower(question || chr(10) || solution) s FROM seed) GROUP BY 1)
SELECT knowledge_signature, row_number() OVER (ORDER BY cnt DESC, knowledge_signature)::INT AS place FROM b""")
def bank_order(spark, d):
    """The order of a bank (a bank of a few signatures)."""
    listed = K.knowledge_bank(*recorded(spark, d, "answer", "knowledge_signature", "skill_tags", "operation_sequence", "difficulty_bucket", "step_count")).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("n"), "knowledge_signature"))), lambda s: s["knowledge_signature"]).alias("l"))
    return listed.select(F.posexplode("l").alias("p", "knowledge_signature")).select("knowledge_signature", (F.col("p") + 1).cast("int").alias("place"))


@query(f"WITH {SEED} SELECT kind, size FROM (SELECT 'unit' kind, count(DISTINCT u) size FROM (SELECT unnest({_UNITS}) u FROM seed))")
def entity_pools(spark, d):
    return K.entity_pools(K.concept_bank(*recorded(spark, d, "scene_template", "persons", "focus_terms", "units"))).filter("kind = 'unit'").select("kind", F.size("pool").cast("long").alias("size"))


@query()
def entity_pools_all_kinds(spark, d):
    """The pools of all kinds with their terms; the SQL text of entity_pools has the size of the units' only."""
    return K.entity_pools(K.concept_bank(*recorded(spark, d, "scene_template", "persons", "focus_terms", "units"))).select("kind", "pool", F.size("pool").cast("long").alias("size"))


# -- answers and scores -----------------------------------------------------------------------------------------------


def decorated(spark, d) -> DataFrame:
    """Answers in seven spellings."""
    k, f = F.col("k"), F.col("fin").cast("string")
    shown = F.when(k == 1, text("$", F.col("fin").cast("string"), " dollars")).when(k == 2, text(f, ".0")).when(k == 3, text("about 7 or ", f)).when(k == 4, text(f, "/0")).when(k == 5, text(f, "/2")).when(k == 6, "none").otherwise(text("{\"final_answer\": \"", f, "\"}"))
    return seeds(spark, d).select("task_id", "k", "fin", shown.alias("shown"))


_SHOWN = "CASE k WHEN 1 THEN '$' || fin || ' dollars' WHEN 2 THEN fin || '.0' WHEN 3 THEN 'about 7 or ' || fin WHEN 4 THEN fin || '/0' WHEN 5 THEN fin || '/2' WHEN 6 THEN 'none' ELSE '{\"final_answer\": \"' || fin || '\"}' END"


@query(f"WITH {SEED} SELECT task_id, CASE k WHEN 2 THEN fin || '.0' WHEN 4 THEN '0' WHEN 5 THEN '2' WHEN 6 THEN 'none' ELSE fin::VARCHAR END answer FROM seed")
def final_answer_extract(spark, d):
    return decorated(spark, d).select("task_id", T.final_answer(F.col("shown")).alias("answer"))


@query(f"WITH {SEED} SELECT task_id, CASE k WHEN 1 THEN fin::VARCHAR WHEN 2 THEN fin || '.0' WHEN 4 THEN fin || '/0' WHEN 5 THEN fin || '/2' WHEN 6 THEN '' ELSE fin::VARCHAR END answer FROM seed")
def normalize_answer(spark, d):
    return decorated(spark, d).select("task_id", T.normalize_answer(F.col("shown")).alias("answer"))


@query(f"WITH {SEED} SELECT task_id, CASE k WHEN 5 THEN fin / 2 WHEN 4 THEN NULL WHEN 6 THEN NULL ELSE fin::DOUBLE END AS value FROM seed")
def numeric_value(spark, d):
    return decorated(spark, d).select("task_id", N.numeric_value(F.col("shown")).alias("value"))


@query(f"WITH {SEED} SELECT task_id, k NOT IN (4, 5, 6) OR (k = 5 AND fin = 0) same FROM seed")
def answers_equal(spark, d):
    return decorated(spark, d).select("task_id", N.answers_equal(F.col("shown"), F.col("fin").cast("string")).alias("same"))


@query(f"WITH {SEED} SELECT task_id, k = 2 correct FROM seed")
def answer_correctness(spark, d):
    return decorated(spark, d).select("task_id", N.is_correct(F.col("shown"), F.col("fin").cast("string")).alias("correct"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(floor(CASE WHEN v <= 1 THEN v WHEN v <= 5 THEN round_even((v - 1) / 4, 1) ELSE 0 END * 5 + 0.5e0 - 1e-9) / 5, 1) score
FROM (SELECT *, round(l_discount * 10 + l_linenumber - 1, 2) v FROM lineitem)""")
def step_score_snap(spark, d):
    x = t(spark, d, "lineitem").withColumn("v", F.round(F.col("l_discount") * 10 + F.col("l_linenumber") - 1, 2))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", F.round(N.snap_score(F.col("v")), 1).alias("score"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, least(5, greatest(1, round_even(l_quantity / 7, 0)))::INT score FROM lineitem")
def clamp_score(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", N.clamp_score(F.col("l_quantity") / 7).alias("score"))


# -- validation -------------------------------------------------------------------------------------------------------


def checkable(spark, d, spread=spread) -> DataFrame:
    s = spread(seeds(spark, d))
    steps = F.array(text(F.col("name"), " computes ", F.col("q").cast("string"), " * ", F.col("p").cast("string"), " = ", F.col("r").cast("string")), text("So the result is ", F.col("fin").cast("string")), F.when(F.col("k") == 5, text("so the result is", F.col("fin").cast("string"))).otherwise(""))
    return s.select("task_id", "k", "q", "p", "question", steps.alias("steps"), F.when(F.col("k") == 7, "").otherwise(F.col("fin").cast("string")).alias("answer"))


_ISSUES = """list_filter([CASE WHEN k = 7 THEN 'invalid_answer' END, CASE WHEN k % 4 = 2 THEN 'multiple_subquestions' END, CASE WHEN k % 4 = 2 THEN 'multiple_subquestions' END,
 CASE WHEN k = 5 THEN 'duplicate_steps' END, CASE WHEN k = 3 THEN 'arithmetic_error' END], lambda x: x IS NOT NULL)"""


@query(f"WITH {SEED} SELECT task_id, array_to_string({_ISSUES}, ',') issues, array_to_string(list_filter([CASE WHEN k <> 7 AND fin::VARCHAR IN ('0','10','20','30','40','50','60','100','120') THEN 'overused_final_answer' END], lambda x: x IS NOT NULL), ',') warnings, k NOT IN (2, 3, 5, 6, 7) passed FROM seed")
def precheck_flags(spark, d):
    texts = ["question", "steps", "answer"]
    x = checkable(spark, d, lambda s: s).withColumns({"h": F.xxhash64(*texts), "g": F.xxhash64(F.lit("texts"), *texts)})
    checked = V.precheck(counted(x, "h", "g", *texts)).select("h", "g", F.array_join("issues", ",").alias("issues"), F.array_join("warnings", ",").alias("warnings"), "passed")
    return x.select("task_id", "h", "g").join(checked, ["h", "g"]).select("task_id", "issues", "warnings", "passed")


@query(f"WITH {SEED} SELECT task_id, q || ' * ' || p expression, r::DOUBLE claimed, (q * p)::DOUBLE calculated FROM seed WHERE k = 3")
def precheck_arith(spark, d):
    e = V.precheck(checkable(spark, d)).select("task_id", F.explode("arithmetic_errors").alias("e"))
    return e.select("task_id", "e.expression", "e.claimed", "e.calculated")


def voted(spark, d) -> DataFrame:
    """Three votes per seed; the second differs where k is 3, all differ where k is 5, the third is unsolvable where k is 6."""
    f, k = F.col("fin"), F.col("k")
    vote = lambda i, answer, ok, c: F.struct(ok.alias("solvable"), F.lit(True).alias("unique_answer"), answer.alias("answer"), F.lit(c).alias("confidence"))
    yes = F.lit(True)
    first, second, third = f.cast("string"), text((f + F.when(k.isin(3, 5), 1).otherwise(0)).cast("string"), ".0"), (f + F.when(k == 5, 2).otherwise(0)).cast("string")
    return spread(seeds(spark, d)).select("task_id", "k", "fin", F.array(vote(0, first, yes, 0.5), vote(1, second, yes, 0.9), vote(2, third, k != 6, 0.7)).alias("votes"))


@query(f"WITH {SEED} SELECT task_id, k <> 5 consensus, CASE WHEN k = 5 THEN 0 WHEN k IN (3, 6) THEN 2 ELSE 3 END n, CASE WHEN k = 5 THEN '' ELSE fin::VARCHAR END answer, 3 - (k = 6)::INT solvable, 0.7e0 confidence FROM seed")
def blind_consensus(spark, d):
    s = voted(spark, d).withColumn("s", V.vote_summary(F.col("votes")))
    return s.select("task_id", "s.consensus", F.col("s.consensus_count").alias("n"), F.col("s.consensus_answer").alias("answer"), F.col("s.solvable_votes").alias("solvable"), F.col("s.average_confidence").alias("confidence"))


@query(f"WITH {SEED} SELECT task_id, k IN (3, 5) tiebreak FROM seed")
def tiebreak_need(spark, d):
    return voted(spark, d).select("task_id", V.needs_tiebreak(F.slice("votes", 1, 2)).alias("tiebreak"))


@query(f"""WITH {SEED} SELECT task_id, array_to_string(list_filter([CASE WHEN k = 5 THEN 'no_blind_consensus' END, CASE WHEN k = 7 THEN 'answer_mismatch' END, CASE WHEN k = 1 THEN 'invalid_steps' END, CASE WHEN k = 2 THEN 'difficulty_mismatch' END], lambda x: x IS NOT NULL), ',') reasons,
 CASE k WHEN 5 THEN 'repair_question' WHEN 2 THEN 'repair_question' WHEN 7 THEN 'repair_solution' WHEN 1 THEN 'repair_solution' ELSE 'pass' END repair_action,
 CASE k WHEN 5 THEN 'wrong_step' WHEN 2 THEN 'difficulty_mismatch' WHEN 7 THEN 'wrong_step' WHEN 1 THEN 'wrong_step' ELSE 'none' END error_type FROM seed""")
def decide_validation(spark, d):
    k = F.col("k")
    audit = F.struct(
        *(F.lit(True).alias(c) for c in ("question_valid", "solvable", "unique_answer", "answer_correct")), (k != 1).alias("steps_correct"), (k != 2).alias("difficulty_match"),
        F.when(k == 2, "Hard").otherwise("Equal").alias("estimated_difficulty"), F.lit("repair_solution").alias("repair_action"), F.lit("wrong_step").alias("error_type"),
    )
    none = F.array().cast("array<string>")
    x = voted(spark, d).withColumns({"blind": V.vote_summary(F.col("votes")), "audit": audit, "issues": none, "warnings": none, "target_difficulty": F.lit("Equal"), "answer": F.when(k == 7, F.col("fin") + 1).otherwise(F.col("fin")).cast("string")})
    return V.decide(x).select("task_id", F.array_join("reasons", ",").alias("reasons"), "repair_action", "error_type")


@query("""WITH v AS (SELECT user_id item, event_type issue, count(*) n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, issue) rank FROM v)
SELECT item, string_agg(issue, ',' ORDER BY rank) issues FROM r WHERE rank <= 3 GROUP BY item""")
def vote_aggregate_top(spark, d):
    top = R.top_reasons(t(spark, d, "events").select(F.col("user_id").alias("item"), F.col("event_type").alias("issue")), ["item"], "issue", 3)
    return top.groupBy("item").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "issue"))), lambda s: s["issue"]), ",").alias("issues"))


@query("""SELECT item, pass_count, vote_count, difficulty, correctness, CASE WHEN pass_count >= vote_count // 2 + 1 AND NOT bad AND (difficulty + correctness) / 2 >= 3.8 THEN 'pass' ELSE 'fail' END verdict
FROM (SELECT user_id item, count(*) FILTER (event_type <> 'error') pass_count, count(*) vote_count, round(avg(1 + event_id % 5), 3) difficulty, round(avg(5 - (event_type = 'error')::INT), 3) correctness,
 count(*) FILTER (event_id % 97 = 0 AND event_type = 'error') > 0 bad FROM events GROUP BY user_id)""")
def vote_verdict(spark, d):
    e = t(spark, d, "events")
    issue = F.when((F.col("event_id") % 97 == 0) & (F.col("event_type") == "error"), F.array(F.lit("unsolvable"))).otherwise(F.array().cast("array<string>"))
    v = e.select(F.col("user_id").alias("item"), F.when(F.col("event_type") == "error", "fail").otherwise("pass").alias("verdict"), issue.alias("issues"), (1 + F.col("event_id") % 5).alias("difficulty"), (5 - (F.col("event_type") == "error").cast("int")).alias("correctness"))
    return R.aggregate_votes(v, ["difficulty", "correctness"]).select("item", "pass_count", "vote_count", "difficulty", "correctness", "verdict")


# -- de-duplication, noise, exports, retries ---------------------------------------------------------------------------


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) scored_as FROM documents")
def dedup_fanout(spark, d):
    x = t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sig"))
    one = x.groupBy("sig").agg(F.min("doc_id").alias("scored_as"))
    return x.join(one, x["sig"].eqNullSafe(one["sig"])).select("doc_id", "scored_as")


@query("""WITH r AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^.?!]+[.?!]') x FROM documents), s AS (SELECT doc_id, list_filter(list_transform(x, lambda v: trim(regexp_replace(v, '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g'), ' ')), lambda v: v <> '') s FROM r)
SELECT doc_id, round(CASE WHEN len(s) = 0 THEN 0e0 ELSE 1 - len(list_distinct(s)) / len(s) END, 6) penalty FROM s""")
def repetition_penalty(spark, d):
    return t(spark, d, "documents").select("doc_id", F.round(T.repetition(F.col("text")), 6).alias("penalty"))


def reviewed(spark, d) -> DataFrame:
    k, same = F.col("k"), F.col("k") % 3 == 0
    return seeds(spark, d).select(
        "task_id", "k", "question", "solution", F.col("fin").cast("string").alias("answer"), F.when(k % 2 == 0, "medium").otherwise("easy").alias("bucket"), (1 + (k % 2 == 0).cast("int")).alias("step_count"),
        F.when(same, F.col("question")).otherwise("Nothing alike here").alias("source_question"), F.lit("-1").alias("source_answer"), F.lit("A scene").alias("source_scene"), F.lit("medium").alias("target_bucket"), F.lit(2).alias("low"), F.lit(4).alias("high"),
    )


@query(f"WITH {SEED} SELECT task_id, array_to_string(list_filter([CASE WHEN k % 3 = 0 THEN 'answer_or_question_leaks_source' END, CASE WHEN k % 3 = 0 THEN 'near_duplicate_question' END, CASE WHEN k % 2 = 1 THEN 'difficulty_drift' END, CASE WHEN k % 2 = 1 THEN 'step_count_out_of_range' END], lambda x: x IS NOT NULL), ',') issues FROM seed")
def noise_flags(spark, d):
    return R.noise(reviewed(spark, d)).select("task_id", F.array_join("issues", ",").alias("issues"))


@query(f"WITH {SEED} SELECT task_id, 5 correctness, CASE WHEN k % 2 = 0 THEN 5 ELSE 4 END difficulty_match, 5 brevity, 5 answer_quality FROM seed")
def heuristic_eval(spark, d):
    return R.heuristic_scores(reviewed(spark, d)).select("task_id", "correctness", "difficulty_match", "brevity", "answer_quality")


@query(f"""WITH {SEED}, x AS (SELECT rid, task_id, fin::VARCHAR ref, unnest([name || ' computes ' || q || ' * ' || p || ' = ' || r, 'Done', p::VARCHAR, fin::VARCHAR]) step, unnest([1, 2, 3, 4]) nth FROM (SELECT row_number() OVER () rid, * FROM seed)),
y AS (SELECT *, len(string_split(step, ' ')) words, contains(replace(replace(lower(step), ' ', ''), ',', ''), ref)::INT hit, regexp_matches(step, '[0-9]')::INT digits FROM x)
SELECT task_id, array_to_string(list(round((least(5, CASE WHEN words >= 3 THEN 4 ELSE 3 END + digits + hit) - 1) / 4e0, 3) ORDER BY nth), ',') scores, array_to_string(list(round((least(5, greatest(1, 6 - greatest(1, words // 6))) - 1) / 4e0, 3) ORDER BY nth), ',') efficiencies
FROM y GROUP BY rid, task_id""")
def fallback_step_scores(spark, d):
    x = seeds(spark, d)
    step = text(F.col("name"), " computes ", F.col("q").cast("string"), " * ", F.col("p").cast("string"), " = ", F.col("r").cast("string"))
    x = x.withColumn("s", R.fallback_step_scores(F.array(step, F.lit("Done"), F.col("p").cast("string"), F.col("fin").cast("string")), F.col("fin").cast("string")))
    listed = lambda name: F.array_join(F.transform("s", lambda v: F.round(v[name], 3).cast("string")), ",")
    return x.select("task_id", listed("score").alias("scores"), listed("efficiency").alias("efficiencies"))


@query(f"""WITH {SEED} SELECT task_id, question AS input, 'Step 1: First, use the given information to find product; this gives the first quantity needed for the rest of the solution: ' || q || '*' || p || '=' || r || chr(10) ||
 'Step 2: ' || CASE WHEN k % 2 = 0 THEN 'Finally, combine the relevant given information or earlier quantities to find sum; this answers the question directly: ' || r || '+' || k ELSE 'Done' END || chr(10) || 'The answer is $\\boxed{{' || fin || '}}$.' AS output FROM seed WHERE k <> 6""")
def training_export(spark, d):
    s = seeds(spark, d)
    steps = F.array(text("Step 1: Calculate Product: ", F.col("q").cast("string"), "*", F.col("p").cast("string"), "=", F.col("r").cast("string")), F.when(F.col("k") % 2 == 0, text("2) calculate Sum: ", F.col("r").cast("string"), "+", F.col("k").cast("string"))).otherwise("Done"))
    x = s.select("task_id", "question", steps.alias("steps"), "solution", F.col("fin").cast("string").alias("answer"), F.when(F.col("k") == 6, None).otherwise(True).alias("passed"))
    return R.training_records(x, True).select("task_id", "input", "output")


@query("SELECT event_id, ('{' || string_split(props, '{')[2])::JSON ->> '$.k' AS k FROM events")
def json_lenient_parse(spark, d):
    e = t(spark, d, "events").withColumn("v", J.lenient(text("noise before ", F.col("props"), " and after")))
    return e.select("event_id", F.variant_get("v", "$.k", "string").alias("k"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE regexp_extract(props, '(\\d+)', 1) END AS value FROM events")
def json_keyed_string(spark, d):
    e = t(spark, d, "events")
    raw = F.when(F.col("event_id") % 2 == 0, text('{"final_answer" : "', F.col("event_type"), '", broken')).otherwise(F.col("props"))
    return e.select("event_id", T.keyed_string(raw, ["final_answer", "k"]).alias("value"))


_ERR = "CASE event_type WHEN 'view' THEN 'Response is NOT a valid JSON object' WHEN 'click' THEN 'missing or invalid fields: steps' WHEN 'signup' THEN 'question does not reflect the assigned plan' WHEN 'error' THEN 'HTTP 500' ELSE 'odd' END"
_CLASS = "CASE event_type WHEN 'view' THEN 'invalid_json' WHEN 'click' THEN 'missing_fields' WHEN 'signup' THEN 'plan_mismatch' WHEN 'error' THEN 'request_error' ELSE 'unknown' END"


def _errors(spark, d):
    return t(spark, d, "events").select("event_id", N.failure_class(F.expr(_ERR)).alias("failure_type"))


@query(f"SELECT event_id, {_CLASS} failure_type FROM events")
def failure_classify(spark, d):
    return _errors(spark, d)


@query(f"SELECT {_CLASS} failure_type, count(*) n FROM events GROUP BY 1")
def failure_histogram(spark, d):
    return _errors(spark, d).groupBy("failure_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SEED} SELECT task_id, CASE k WHEN 1 THEN 'missing steps' WHEN 2 THEN 'step 2 missing expected Step 2: label' WHEN 3 THEN 'too many steps still start mechanically' WHEN 4 THEN 'too few steps explain dependencies or reasoning purpose'
 WHEN 5 THEN 'some steps still pack multiple calculations with semicolons' ELSE '' END issue FROM seed""")
def step_quality_issue(spark, d):
    k = F.col("k")
    pair = lambda a, b: F.array(F.lit(a), F.lit(b))
    steps = (
        F.when(k == 1, pair("", " ")).when(k == 2, pair("Step 1: Given x", "Step 3: so y")).when(k == 3, pair("Step 1: Calculate x", "Step 2: compute y")).when(k == 4, pair("Step 1: x", "Step 2: y"))
        .when(k == 5, pair("Step 1: since x; y; z", "Step 2: so y")).otherwise(pair("Step 1: Given x", "step 2 : therefore y"))
    )
    return seeds(spark, d).select("task_id", V.step_quality_issue(steps).alias("issue"))


@query(f"WITH {SEED} SELECT task_id, CASE WHEN k = 4 THEN 'hard target produced too few reasoning steps' WHEN k % 4 IN (1, 2) OR k = 3 OR k = 7 THEN CASE WHEN k % 4 = 2 THEN '' WHEN k % 4 = 3 THEN '' ELSE 'question does not reflect the assigned plan scene or inspiration keywords' END ELSE '' END error FROM seed")
def plan_alignment(spark, d):
    words = F.array_union(T.keyword_set(F.lit("books shelves boxes workshop")), F.array().cast("array<string>"))
    s = seeds(spark, d)
    return s.select("task_id", V.alignment_error(F.col("question"), F.array(F.lit("one")), F.col("fin").cast("string"), words, F.when(F.col("k") == 4, "Hard").otherwise("Equal")).alias("error"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def left_anti_resume(spark, d):
    return t(spark, d, "documents").select("doc_id", "lang").join(t(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT user_id, max(event_id % 7 + 1) next_round, count(*) pending FROM events WHERE event_type = 'error' AND greatest(1, event_id % 7) <= 5 AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 250) GROUP BY user_id")
def resume_failures(spark, d):
    e = t(spark, d, "events")
    done = e.filter("event_type = 'purchase' AND value > 250").select("user_id").distinct()
    left = e.filter("event_type = 'error' AND greatest(1, event_id % 7) <= 5").join(done, "user_id", "left_anti")
    return left.groupBy("user_id").agg(F.max(F.col("event_id") % 7 + 1).alias("next_round"), F.count(F.lit(1)).alias("pending"))


@query("SELECT o_orderkey, coalesce(c_custkey, 1000000000000) plan_ord FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 3 > 0) ON o_custkey = c_custkey")
def ordered_by_plan(spark, d):
    plan = t(spark, d, "customer").filter("c_custkey % 3 > 0").select("c_custkey")
    x = t(spark, d, "orders").join(plan, F.col("o_custkey") == F.col("c_custkey"), "left")
    return x.select("o_orderkey", F.coalesce("c_custkey", F.lit(10**12)).alias("plan_ord")).orderBy("plan_ord", "o_orderkey")


@query("""SELECT o_orderkey, coalesce(c_mktsegment, 'unknown') category, coalesce(CASE WHEN c_acctbal > 5000 THEN 'Hard' END, 'Equal') difficulty FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 > 0) ON o_custkey = c_custkey""")
def lookup_join_defaults(spark, d):
    side = t(spark, d, "customer").filter("c_custkey % 5 > 0").select(F.col("c_custkey").cast("string").alias("key"), "c_mktsegment", F.when(F.col("c_acctbal") > 5000, "Hard").alias("level"))
    x = t(spark, d, "orders").withColumn("key", F.col("o_custkey").cast("string")).join(side, "key", "left")
    return x.select("o_orderkey", F.coalesce(F.nullif(F.trim("c_mktsegment"), F.lit("")), F.lit("unknown")).alias("category"), F.coalesce("level", F.lit("Equal")).alias("difficulty"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'next' WHEN o_orderkey % 3 = 1 THEN 'active' ELSE 'plan' END chosen, 'validation_' || CASE WHEN o_orderkey % 4 = 0 THEN 'repair_question' ELSE lower(o_orderstatus) END failure_type
FROM orders WHERE o_orderkey % 3 < 2 OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""")
def failure_to_retry(spark, d):
    k = F.col("o_orderkey")
    plan = t(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("plan_id"), F.lit("plan").alias("looked_up"))
    x = t(spark, d, "orders").join(plan, F.col("o_custkey") == F.col("plan_id"), "left")
    chosen = F.coalesce(F.when(k % 3 == 0, "next"), F.when(k % 3 == 1, "active"), F.col("looked_up"))
    kind = F.coalesce(F.when(k % 4 != 0, F.lower("o_orderstatus")), F.lit("repair_question"))
    return x.select("o_orderkey", chosen.alias("chosen"), text("validation_", kind).alias("failure_type")).filter("chosen IS NOT NULL")


@query("SELECT count(*) plans, count(DISTINCT nullif(p_brand, '')) scenes, count(DISTINCT p_name) signatures FROM part")
def plan_summary(spark, d):
    return t(spark, d, "part").agg(F.count(F.lit(1)).alias("plans"), F.countDistinct(F.nullif("p_brand", F.lit(""))).alias("scenes"), F.countDistinct("p_name").alias("signatures"))


@query(f"WITH {SEED} SELECT issue, count(*) n FROM (SELECT unnest({_ISSUES}) issue FROM seed) GROUP BY issue ORDER BY n DESC, issue LIMIT 8")
def round_top_reasons(spark, d):
    one = folder(spark).keep(counted(checkable(spark, d, lambda s: s), "question", "steps", "answer"))
    e = V.precheck(one).select("n", F.explode("issues").alias("issue")).groupBy("issue").agg(F.sum("n").alias("n"))
    return e.orderBy(F.col("n").desc(), "issue").limit(8)


@query("SELECT o_orderkey, round(sum(l_discount + l_tax) / 2, 6) step_score_sum, round(sum(l_discount + l_tax) / 2 / count(*), 6) step_score_mean FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def step_score_agg(spark, d):
    x = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_discount") + F.col("l_tax")).alias("s"), F.count(F.lit(1)).alias("n"))
    x = x.join(t(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return x.select("o_orderkey", F.round(F.col("s") / 2, 6).alias("step_score_sum"), F.round(F.col("s") / 2 / F.col("n"), 6).alias("step_score_mean"))


@query("SELECT p_size, CASE WHEN p_size <= 1 THEN 'very_short' WHEN p_size <= 2 THEN 'short' WHEN p_size <= 4 THEN 'medium' ELSE 'long' END step_bucket, CASE WHEN p_size <= 1 THEN 'easy' WHEN p_size <= 3 THEN 'medium' WHEN p_size <= 5 THEN 'hard' ELSE 'very_hard' END difficulty, count(*) n FROM part GROUP BY ALL")
def step_and_rank_buckets(spark, d):
    n = F.col("p_size")
    return t(spark, d, "part").groupBy("p_size", N.step_bucket(n).alias("step_bucket"), N.bucket_from_steps(n).alias("difficulty")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT a.p_partkey, len(list_intersect(string_split(a.p_name, ' '), string_split(b.p_name, ' '))) overlap FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def skill_overlap(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("a"))
    q = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b"))
    return p.join(q, "p_partkey").select("p_partkey", N.overlap(F.array_distinct("a"), F.array_distinct("b")).cast("long").alias("overlap"))


@query(f"WITH {SEED} SELECT task_id, lower(question) || '::' || fin fingerprint, question = source leak FROM (SELECT *, CASE WHEN k = 1 THEN question ELSE '' END AS source FROM seed)")
def fingerprints(spark, d):
    s = seeds(spark, d).withColumn("source", F.when(F.col("k") == 1, F.col("question")).otherwise(""))
    return s.select("task_id", text(F.lower(T.ws(F.col("question"))), "::", F.col("fin").cast("string")).alias("fingerprint"), R.leaks(F.lit("x"), F.col("question"), F.lit(""), F.col("source")).alias("leak"))


@query("SELECT event_id, 0 priority FROM events WHERE event_type = 'error' UNION ALL SELECT event_id, 1 FROM events WHERE event_type = 'view'")
def union_pending_priority(spark, d):
    e = t(spark, d, "events")
    return e.filter("event_type = 'error'").select("event_id", F.lit(0).alias("priority")).unionByName(e.filter("event_type = 'view'").select("event_id", F.lit(1).alias("priority")))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false WHEN 'error' THEN true ELSE false END strict, CASE event_type WHEN 'click' THEN false ELSE true END lenient FROM events")
def boolean_coercion(spark, d):
    word = F.expr("CASE event_type WHEN 'view' THEN 'Yes' WHEN 'click' THEN 'no' WHEN 'error' THEN 'pass' ELSE 'perhaps' END")
    strict = N.truthy(word, False)
    return t(spark, d, "events").select("event_id", strict.alias("strict"), N.truthy(word, True).alias("lenient"))


@query(f"WITH {SEED} SELECT task_id, 'Given the boxes' || ',' || 'So ' || fin steps FROM seed")
def normalize_steps_text(spark, d):
    s = seeds(spark, d)
    lines = text("Step 1: Given  the boxes\n2) So ", F.col("fin").cast("string"), "\n\n")
    return s.select("task_id", F.array_join(T.text_steps(lines), ",").alias("steps"))


@query(f"WITH {SEED} SELECT task_id, CASE k % 4 WHEN 3 THEN 'response is not a valid JSON object' WHEN 2 THEN 'missing or invalid fields: answer' ELSE '' END error, CASE WHEN k % 4 IN (2, 3) THEN NULL ELSE fin::VARCHAR END answer FROM seed")
def parse_generated(spark, d):
    f, k = F.col("fin").cast("string"), F.col("k")
    body = text('{"question": "How many?", "steps": ["a", "b"], "answer": "', f, '"}')
    raw = F.when(k % 4 == 0, text("```json\n", body, "\n```")).when(k % 4 == 1, text("Here: {\"data\": ", body, "} done")).when(k % 4 == 2, F.lit('{"question": "q", "steps": ["a",], "answer": "none"}')).otherwise("truncated [")
    return seeds(spark, d).withColumn("g", J.parse_generated(raw)).select("task_id", "g.error", "g.answer")


@query(f"WITH {SEED} SELECT task_id, CASE WHEN k % 2 = 0 THEN '' ELSE 'score array length mismatch for correctness' END error, CASE WHEN k % 2 = 0 THEN 0.6e0 END step_score_mean FROM seed")
def parse_scores(spark, d):
    arrays = '{"correctness": [1, 0.2], "logical": [1, 0.2], "standardization": [1, 0.2], "completeness": [1, 0.2], "efficiency": [1, 0.2]}'
    n = F.when(F.col("k") % 2 == 0, 2).otherwise(3)
    return seeds(spark, d).withColumn("s", J.parse_step_scores(F.lit(arrays), n)).select("task_id", "s.error", "s.step_score_mean")


@query()
def plan_rows(spark, d):
    """Plans for suppliers as seeds over a knowledge base of parts."""
    kb = _part_kb(spark, d).select("ord", "task_id", F.col("skills").alias("skill_tags"), F.col("ops").alias("operation_sequence"), F.col("bucket").alias("difficulty_bucket"), F.array(F.lit("Anna's")).alias("persons"), F.col("ops").alias("focus_terms"), F.array().cast("array<string>").alias("units"))
    quotas = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("task_id"), F.lit(4).alias("target_count"), F.lit("Equal").alias("target_difficulty"), F.lit("medium").alias("target_difficulty_bucket"))
    return P.plan_rows(quotas, kb, {"unit": T.strings(["books", "cups"])})


# -- stages around the stub backend -----------------------------------------------------------------------------------


def bags(spark, d) -> DataFrame:
    """Word problems for the stub: a bags of b eggs, for each customer."""
    c = t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 9 + 2).alias("a"), (F.col("c_custkey") % 7 + 2).alias("b"), "c_mktsegment")
    s = lambda x: F.col(x).cast("string")
    return c.withColumns({"ord": F.col("c_custkey"), "task_id": s("c_custkey"), "question": text("There are ", s("a"), " bags of ", s("b"), " eggs. How many eggs?"), "product": F.col("a") * F.col("b")})


BAGS = "bags AS (SELECT *, c_custkey::VARCHAR task_id, 'There are ' || a || ' bags of ' || b || ' eggs. How many eggs?' question, a * b product, (a + b) % 3 = 0 AS stumbles FROM (SELECT c_custkey, c_custkey % 9 + 2 a, c_custkey % 7 + 2 b, c_mktsegment FROM customer))"


@query(f"WITH {BAGS} SELECT task_id || '_' || n task_id, n::INT attempt_index, a || ' * ' || b || ' = ' || product steps, product::VARCHAR final_answer, c_custkey % 5 > 0 is_correct FROM bags, range(2) r(n)")
def answer_stage(spark, d):
    """Two answers per seed; the reference is wrong for every fifth."""
    seeds_ = bags(spark, d).withColumn("answer", (F.col("product") + (F.col("c_custkey") % 5 == 0).cast("int")).cast("string"))
    out = AS.answer(seeds_.select("ord", "task_id", "question", "answer"), StubBackend(), folder(spark), attempts=2)
    return out.select("task_id", "attempt_index", F.array_join("steps", "|").alias("steps"), "final_answer", "is_correct")


def answered(spark, d) -> DataFrame:
    """Three answers per seed: two alike and one without steps."""
    b = bags(spark, d).withColumn("attempt_index", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    steps = F.when(F.col("attempt_index") < 2, F.array(text(F.col("a").cast("string"), " * ", F.col("b").cast("string")), F.lit("done"))).otherwise(F.array().cast("array<string>"))
    p = F.col("product").cast("string")
    return b.select(F.concat_ws("_", "task_id", F.col("attempt_index").cast("string")).alias("task_id"), F.col("task_id").alias("source_task_id"), "attempt_index", "question", p.alias("reference_answer"), steps.alias("steps"), p.alias("final_answer"), p.alias("extracted_answer"), F.lit(True).alias("is_correct"))


@query(f"""WITH {BAGS} SELECT task_id || '_' || n task_id, CASE WHEN n < 2 THEN 2 ELSE 1 END step_count, CASE WHEN n < 2 THEN 1e0 ELSE 0.72 END step_score_mean, CASE WHEN n < 2 THEN 2e0 ELSE 0.72 END step_score_sum, true final_answer_correct,
 CASE WHEN n < 2 THEN '' ELSE 'heuristic_fallback_no_steps' END overall_reason FROM bags, range(3) r(n)""")
def score_stage(spark, d):
    return AS.score(answered(spark, d), StubBackend(), folder(spark)).select("task_id", "step_count", "step_score_mean", "step_score_sum", "final_answer_correct", "overall_reason")


@query(f"WITH {BAGS} SELECT task_id || '_' || n task_id, CASE WHEN stumbles OR n = 2 THEN 'heuristic' ELSE 'model' END scored_by, CASE WHEN n = 2 THEN '0.72' WHEN stumbles THEN '1.6' ELSE '2.0' END total FROM bags, range(3) r(n)")
def score_stage_without_retries(spark, d):
    """What one try can't score gets the heuristic report."""
    r = AS.score(answered(spark, d), StubBackend(), folder(spark), max_retries=0)
    return r.select("task_id", F.when(F.col("overall_reason") == "", "model").otherwise("heuristic").alias("scored_by"), F.col("step_score_sum").cast("string").alias("total"))


@query("""SELECT c_custkey task_id, coalesce(nullif(trim(CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END), ''), 'unknown') category, CASE WHEN c_custkey % 3 > 0 THEN 'q' || c_custkey END question FROM customer""")
def mastery_with_sources(spark, d):
    c = t(spark, d, "customer")
    sources = c.filter("c_custkey % 3 > 0 OR c_custkey % 4 > 0").select(F.col("c_custkey").alias("task_id"), F.col("c_custkey").alias("ord"), F.when(F.col("c_custkey") % 3 > 0, text("q", F.col("c_custkey").cast("string"))).alias("question"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_mktsegment")).alias("question_type"))
    return AS.with_sources(c.select(F.col("c_custkey").alias("task_id")), sources).select("task_id", "category", "question")


def planned(spark, d) -> DataFrame:
    """One plan per seed, about a library's books and shelves; every eleventh seed's plan is about nothing that its question shows."""
    scene = lambda domain: F.element_at(F.filter(P.domain_array(), lambda x: x["domain"] == domain), 1)
    word = lambda w: F.array(F.lit(w))
    none = F.array().cast("array<string>")
    inspired = F.struct(F.when(F.col("c_custkey") % 11 == 0, word("piano")).otherwise(word("eggs")).alias("scene_keywords"), none.alias("possible_roles"), none.alias("possible_units"), none.alias("related_skill_tags"), F.lit("").alias("policy"))
    math = F.struct(word("multiplication").alias("skill_tags"), word("multiplication").alias("operation_sequence"), F.lit("multiplication").alias("knowledge_signature"), F.lit(1).alias("reference_step_count"), F.lit("Equal").alias("target_difficulty"))
    first = P.diversity(F.col("task_id"), F.lit(0)).withField("primary_scene", scene("community_library")).withField("alternative_scenes", F.array(scene("bakery")))
    return bags(spark, d).select("ord", F.col("task_id").alias("source_task_id"), F.concat_ws("_", "task_id", F.lit("0")).alias("plan_id"), F.struct(math.alias("math"), first.alias("diversity"), inspired.alias("kb_inspiration")).alias("knowledge"))


def mastered(spark, d) -> DataFrame:
    return bags(spark, d).select("task_id", F.when(F.col("c_custkey") % 13 > 0, "Equal").alias("target_difficulty"), "question")


@query(f"WITH {BAGS} SELECT task_id || '_0' plan_id, product::VARCHAR answer, 1 + stumbles::INT attempts FROM bags WHERE c_custkey % 11 > 0")
def generate_stage(spark, d):
    good, _ = RO.generate(planned(spark, d), mastered(spark, d), StubBackend(), folder(spark), max_retries=1)
    return good.select("plan_id", "answer", "attempts")


@query(f"WITH {BAGS} SELECT task_id || '_0' plan_id, 'plan_mismatch' failure_type, 2 attempts, 'question does not reflect the assigned plan scene or inspiration keywords' error FROM bags WHERE c_custkey % 11 = 0")
def generate_stage_failures(spark, d):
    _, bad = RO.generate(planned(spark, d), mastered(spark, d), StubBackend(), folder(spark), max_retries=1)
    return bad.select("plan_id", "failure_type", "attempts", "error")


def offered(spark, d) -> DataFrame:
    """Candidates: right ones; wrong answers (every third); questions that no repair makes single (every seventh)."""
    k, s = F.col("c_custkey"), F.col("product")
    answer = F.when(k % 3 == 0, s + 1).otherwise(s).cast("string")
    question = F.when(k % 7 == 0, F.concat("question", F.lit(" And how many bags?"))).otherwise(F.col("question"))
    return bags(spark, d).select(F.col("task_id").alias("source_task_id"), F.concat_ws("_", "task_id", F.lit("0")).alias("plan_id"), F.lit("Equal").alias("difficulty"), question.alias("question"), F.array(F.concat_ws(" ", F.lit("So it is"), answer)).alias("steps"), answer.alias("answer"))


@query(f"WITH {BAGS} SELECT task_id || '_0' plan_id, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS round, product::VARCHAR answer FROM bags WHERE c_custkey % 7 > 0")
def validate_stage(spark, d):
    good, _, _ = RO.validate(offered(spark, d), StubBackend(), folder(spark), max_rounds=1)
    return good.select("plan_id", "round", "answer")


@query(f"WITH {BAGS} SELECT task_id || '_0' plan_id, 1 AS round, 'repair_solution' repair_action, 'invalid_format' error_type, 'multiple_subquestions' reasons FROM bags WHERE c_custkey % 7 = 0")
def validate_stage_failures(spark, d):
    _, bad, _ = RO.validate(offered(spark, d), StubBackend(), folder(spark), max_rounds=1)
    return bad.select("plan_id", "round", "repair_action", "error_type", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {BAGS} SELECT task_id || '_0' plan_id, 3 attempts, 'validation_invalid_format' failure_type, 'community_library' scene FROM bags WHERE c_custkey % 7 = 0")
def validation_failures_to_retry(spark, d):
    bad = offered(spark, d).filter("source_task_id % 7 = 0").withColumns({"round": F.lit(2), "error_type": F.lit("invalid_format"), "repair_action": F.lit("repair_solution"), "active_plan": F.lit(None).cast(P.knowledge_type(spark)), "next_plan": F.lit(None).cast(P.knowledge_type(spark))})
    return RO.failures_to_retry(bad, planned(spark, d)).select("plan_id", "attempts", "failure_type", F.col("next_plan.diversity.primary_scene.domain").alias("scene"))


@query(f"WITH {BAGS} SELECT task_id || '_0' plan_id, 'Step 1: Given the numbers, ' || a || ' * ' || b || ' = ' || product || '.' steps, c_custkey AS other FROM bags")
def refine_stage(spark, d):
    x = offered(spark, d).withColumn("question", F.regexp_replace("question", " And.*", "")).withColumn("other", F.col("source_task_id").cast("long"))
    good, _ = RO.refine(x, StubBackend(), folder(spark), max_rounds=1)
    return good.select("plan_id", F.array_join("steps", "|").alias("steps"), "other")


@query(f"""WITH s AS (SELECT s_suppkey::VARCHAR || '_0' id, ['similarity','request_error','stubborn_validation'][s_suppkey % 3 + 1] why FROM supplier), st AS (SELECT *, {_slot("id || '|replan|1'", 21)} st FROM s)
SELECT id plan_id, CASE WHEN why = 'request_error' THEN 'community_library' ELSE {_DOM}[CASE WHEN {_DOM}[st + 1] = 'community_library' THEN (st + 1) % 21 ELSE st END + 1] END scene, CASE WHEN why = 'request_error' THEN 'eggs' ELSE '' END keywords, CASE WHEN why = 'request_error' THEN 0 ELSE 1 END replanned_round FROM st""")
def replan_update(spark, d):
    """The plan after a failure: new diversity and no inspiration, or the plan as it was."""
    one = planned(spark, d).filter("ord = 1").select(F.col("knowledge").alias("known"))
    k = F.col("s_suppkey").cast("int")
    s = t(spark, d, "supplier").select(text(k.cast("string"), "_0").alias("plan_id"), F.element_at(T.strings(["similarity", "request_error", "stubborn_validation"]), k % 3 + 1).alias("why")).crossJoin(F.broadcast(one))
    s = s.withColumn("new", P.replan(F.col("known"), F.col("plan_id"), F.col("why"), F.lit(1)))
    return s.select("plan_id", F.col("new.diversity.primary_scene.domain").alias("scene"), F.array_join("new.kb_inspiration.scene_keywords", ",").alias("keywords"), F.col("new.diversity.replanned_round").alias("replanned_round"))


_WORDS = "list_sort(list_distinct(list_filter(regexp_extract_all(lower(s), '[a-z]+'), lambda x: len(x) >= 4)))"


@query(f"""WITH {BAGS} SELECT task_id || '_0' plan_id, array_to_string({_WORDS}, ',') tokens FROM (SELECT *, 'community_library a neighborhood library librarian volunteer reader books shelves returns books days shelves bakery a small bakery baker assistant customer trays pastries ingredients trays pieces kilograms '
 || CASE WHEN c_custkey % 11 = 0 THEN 'piano' ELSE 'eggs' END s FROM bags)""")
def plan_tokens(spark, d):
    """Keyword tokens of nested plans."""
    return planned(spark, d).select("plan_id", F.array_join(F.array_sort(P.plan_tokens(F.col("knowledge"))), ",").alias("tokens"))


# -- the older tools --------------------------------------------------------------------------------------------------


def carded(spark, d) -> DataFrame:
    """Knowledge-base records of parts with all that cards need."""
    p = t(spark, d, "part")
    words = F.split("p_name", " ")
    return p.select(
        F.col("p_partkey").alias("task_id"), F.col("p_name").alias("question"), F.col("p_brand").alias("answer"), F.lit("").alias("solution_text"), F.col("p_name").alias("surface_template"), F.col("p_name").alias("scene_template"),
        F.concat("p_name", F.col("p_size").cast("string")).alias("scenario_template"), F.concat("p_brand", F.lit("|"), "p_type").alias("knowledge_signature"), F.array(F.split("p_type", " ")[0]).alias("skill_tags"), F.array(F.lit("sum")).alias("operation_sequence"),
        (F.col("p_size") % 7).cast("int").alias("step_count"), F.element_at(T.strings(C.BUCKETS), F.col("p_size") % 4 + 1).alias("difficulty_bucket"), words.alias("all_terms"), F.array().cast("array<string>").alias("persons"), words.alias("focus_terms"), F.array().cast("array<string>").alias("units"),
    )


_PEER = "row_number() OVER (PARTITION BY a.id ORDER BY b.sc = a.sc, b.sn = a.sn, b.id) n FROM k a JOIN k b ON a.{0} = b.{0} AND a.id <> b.id"


@query(f"""WITH k AS (SELECT p_partkey id, p_brand || '|' || p_type sig, string_split(p_type, ' ')[1] skill, lower(p_name) sc, lower(p_name) || p_size sn, p_size FROM part),
g AS (SELECT a.id, b.id peer, {_PEER.format('sig')}), h AS (SELECT a.id, b.id peer, {_PEER.format('skill')}),
gl AS (SELECT id, list(peer ORDER BY n) l FROM g WHERE n <= 6 GROUP BY id), hl AS (SELECT id, list(peer ORDER BY n) l FROM h WHERE n <= 6 GROUP BY id)
SELECT k.id task_id, CASE WHEN p_size % 7 <= 1 THEN 'very_short' WHEN p_size % 7 <= 2 THEN 'short' WHEN p_size % 7 <= 4 THEN 'medium' ELSE 'long' END step_bucket,
 coalesce(array_to_string(gl.l, ','), '') same_structure, coalesce(array_to_string(hl.l, ','), '') scene_swap, coalesce(array_to_string(gl.l[1:greatest(1, len(gl.l) // 2)], ','), '') entity_swap,
 coalesce(array_to_string(hl.l[1:greatest(1, len(hl.l) // 2)], ','), '') surface_swap FROM k LEFT JOIN gl USING (id) LEFT JOIN hl USING (id)""")
def plan_cards(spark, d):
    cards = LE.plan_cards(carded(spark, d))
    mode = lambda m: F.array_join(F.element_at(F.filter("diversity_profile.candidate_modes", lambda x: x["mode"] == m), 1)["peer_task_ids"].cast("array<string>"), ",").alias(m)
    return cards.select("task_id", "step_bucket", *map(mode, LE.MODES))


@query("""WITH c AS (SELECT CASE WHEN p_size % 7 <= 1 THEN 'very_short' WHEN p_size % 7 <= 2 THEN 'short' WHEN p_size % 7 <= 4 THEN 'medium' ELSE 'long' END s, ['easy','medium','hard','very_hard'][(p_size % 4 + 1)::INT] b FROM part)
SELECT 'step_bucket' kind, s bucket, count(*) n FROM c GROUP BY s UNION ALL SELECT 'difficulty', b, count(*) FROM c GROUP BY b""")
def card_summary(spark, d):
    return LE.card_summary(carded(spark, d).withColumn("step_bucket", N.step_bucket(F.col("step_count"))))


@query(f"""WITH c AS (SELECT p_partkey id, {_BUCKET} b, p_name, string_split(p_name, ' ') w FROM part), s AS (SELECT s_suppkey id, (s_suppkey % 10) / 10e0 m FROM supplier),
l AS (SELECT s.id, v::INT variant, CASE WHEN m <= 0.2 THEN 'easy' WHEN m <= 0.4 THEN 'easy' WHEN m <= 0.6 THEN 'medium' WHEN m <= 0.8 THEN 'hard' ELSE 'very_hard' END tb, {LABEL_SQL.replace('mastery', 'm')} label FROM s, range(3) q(v)),
r AS (SELECT l.*, c.id card, c.p_name, c.w, row_number() OVER (PARTITION BY l.id, variant ORDER BY c.id = l.id, c.id) - 1 pos, count(*) OVER (PARTITION BY l.id, variant) n, max(c.id = l.id) OVER (PARTITION BY l.id, variant) own FROM l JOIN c ON c.b = l.tb),
h AS (SELECT *, (('0x' || substr(sha1(id || '|' || label || '|' || tb || '|' || variant || '|' || tb), 1, 16))::UBIGINT % n)::BIGINT st FROM r)
SELECT id || '_' || variant task_id, label target_difficulty, card plan_source_task_id, p_name question, array_to_string(w[1:8], ',') anchor_terms,
 CASE tb WHEN 'easy' THEN ['surface_swap','scene_swap'][variant % 2 + 1] WHEN 'medium' THEN ['same_structure','scene_swap','surface_swap'][variant % 3 + 1] WHEN 'hard' THEN ['same_structure','entity_swap','surface_swap'][variant % 3 + 1] ELSE ['same_structure','entity_swap'][variant % 2 + 1] END AS mode
FROM h WHERE pos = CASE WHEN own AND n > 1 AND st = n - 1 THEN 0 ELSE st END""")
def generation_plan(spark, d):
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("task_id"), F.lit("q").alias("question"), F.lit("1").alias("answer"), ((F.col("s_suppkey") % 10) / F.lit(10e0)).alias("mastery"), F.lit(3).alias("target_count"), *(F.lit(None).cast("string").alias(c) for c in ("target_difficulty", "target_difficulty_bucket")))
    return LE.generation_plan(s, carded(spark, d)).select("task_id", "target_difficulty", "plan_source_task_id", "question", F.array_join("anchor_terms", ",").alias("anchor_terms"), "mode")


@query(f"""SELECT p_partkey, CASE WHEN p_size % 4 = 3 THEN 0.9e0 ELSE CASE {_BUCKET} WHEN 'easy' THEN 0.3 WHEN 'medium' THEN 0.4 WHEN 'hard' THEN 0.6 ELSE 0.7 END END::DOUBLE temperature, 1e0 top_p FROM part""")
def sampling_settings(spark, d):
    bucket = F.element_at(T.strings(C.BUCKETS), F.col("p_size") % 4 + 1)
    x = t(spark, d, "part").withColumn("s", LE.sampling(bucket, F.lit("Equal"), temperatures={"very_hard": 0.9}, top_p=1.5))
    return x.select("p_partkey", "s.temperature", "s.top_p")


@query("""SELECT p_partkey task_id, ['easy','medium','hard','very_hard'][(p_size % 4 + 1)::INT] bucket, CASE p_size % 4 WHEN 0 THEN '1,2' WHEN 1 THEN '2,4' WHEN 2 THEN '4,6' ELSE '6,10' END step_range, (p_size % 7)::INT reference_step_count FROM part""")
def target_map(spark, d):
    return LE.targets(carded(spark, d)).select("task_id", "bucket", F.array_join(F.col("step_count_range").cast("array<string>"), ",").alias("step_range"), "reference_step_count")


@query("""SELECT o_orderkey, coalesce(a.c_mktsegment, b.c_mktsegment, 'none') found FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) a ON a.c_custkey = o_orderkey % 1000 LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) b ON b.c_custkey = o_custkey""")
def fallback_lookup(spark, d):
    """The first of two keys that finds a row, keys of any type."""
    rows = t(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 1000).alias("task_id"), F.col("o_custkey").alias("source_task_id"))
    side = t(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("task_id"), "c_mktsegment")
    return LE.lookup(rows, side, ["task_id", "source_task_id"], "v").select("o_orderkey", F.coalesce("v.c_mktsegment", F.lit("none")).alias("found"))


def _reviewable(spark, d) -> DataFrame:
    """Candidates of the older generator; every fourth is its source's question."""
    b = bags(spark, d)
    k, p = F.col("c_custkey"), F.col("product").cast("string")
    return b.select("task_id", F.col("task_id").alias("source_task_id"), F.when(k % 4 == 0, F.lit("Here are 5 cups of 6 pens. How many pens?")).otherwise(F.col("question")).alias("question"), text("It is ", p).alias("solution"), p.alias("answer"), F.lit("easy").alias("difficulty_bucket"), F.lit(1).alias("step_count"))


def _sources(spark, d) -> tuple[DataFrame, DataFrame]:
    b = bags(spark, d)
    return b.select("task_id", F.lit("Here are 5 cups of 6 pens. How many pens?").alias("question"), F.lit("-1").alias("answer"), F.lit("").alias("scene_template")), b.select("task_id", F.lit("easy").alias("bucket"), F.array(F.lit(1), F.lit(2)).alias("step_count_range"), F.lit(1).alias("reference_step_count"))


@query(f"WITH {BAGS} SELECT task_id, c_custkey % 4 = 0 repaired, c_custkey % 4 = 0 repair_failed, CASE WHEN c_custkey % 4 = 0 THEN 'answer_or_question_leaks_source,near_duplicate_question' ELSE '' END issues FROM bags")
def noise_repair(spark, d):
    """The stub keeps the question, so what leaks stays."""
    out = LE.repair_noise(_reviewable(spark, d), *_sources(spark, d), StubBackend(), folder(spark))
    return out.select("task_id", "repaired", "repair_failed", F.array_join("noise_report.issues", ",").alias("issues"))


@query(f"WITH {BAGS} SELECT task_id, 'pass' verdict, 5e0 overall_score, true passed, 'fine' short_reason FROM bags")
def evaluate_stage(spark, d):
    return LE.evaluate(_reviewable(spark, d), *_sources(spark, d), StubBackend(), folder(spark)).select("task_id", "evaluation.verdict", "evaluation.overall_score", "evaluation.passed", "evaluation.short_reason")


@query(f"WITH {BAGS} SELECT task_id, true passed, 0 rounds, 5e0 overall_score FROM bags")
def quality_loop(spark, d):
    return LE.quality_loop(_reviewable(spark, d), *_sources(spark, d), StubBackend(), folder(spark)).select("task_id", "passed", "rounds", "overall_score")


@query("""WITH q AS (SELECT p_partkey o, list_sort(list_distinct(string_split(lower(p_name), ' '))) w FROM part) SELECT o AS ord FROM q WHERE o NOT IN (SELECT min(o) FROM q GROUP BY w)""")
def sequential_similarity(spark, d):
    """Part names, of two words each, are alike only if they have the same ones."""
    return LE.rejected(t(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("question")), folder(spark).keep)


@query(f"""WITH {BAGS} SELECT task_id || '_' || v task_id, product::VARCHAR answer, stumbles AND false generation_failed FROM bags, range(1) r(v)""")
def generate_older(spark, d):
    plan = bags(spark, d).select("ord", F.concat_ws("_", "task_id", F.lit("0")).alias("task_id"), F.col("task_id").alias("source_task_id"), F.lit(0).alias("variant_index"), "question", F.lit("medium").alias("target_difficulty_bucket"), F.lit("Equal").alias("target_difficulty"), F.array(F.lit(2), F.lit(4)).alias("target_step_count_range"), F.lit("scene_swap").alias("mode"), F.lit("s").alias("source_question"), F.lit("1").alias("source_answer"))
    return LE.projections(LE.generate(plan, StubBackend(), folder(spark)))["successes"].select("task_id", "answer", "generation_failed")


# -- readers of model output ------------------------------------------------------------------------------------------


@query(f"WITH {SEED} SELECT task_id, CASE k % 4 WHEN 3 THEN 'audit response is not valid JSON' ELSE '' END error, CASE k % 4 WHEN 0 THEN 'Hard' WHEN 3 THEN NULL ELSE 'Equal' END label, CASE k % 4 WHEN 0 THEN 'repair_solution' WHEN 3 THEN NULL ELSE 'regenerate_question' END AS action, CASE WHEN k % 4 = 3 THEN NULL ELSE fin::VARCHAR END correct_answer FROM seed")
def parse_audit(spark, d):
    f, k = F.col("fin").cast("string"), F.col("k")
    raw = F.when(k % 4 == 0, text('{"estimated_difficulty": "Hard", "repair_action": "repair_solution", "correct_answer": "$', f, '"}')).when(k % 4 == 3, "[]").otherwise(text('{"estimated_difficulty": "odd", "repair_action": "guess", "correct_answer": ', f, ",}"))
    return seeds(spark, d).withColumn("a", J.parse_audit(raw)).select("task_id", "a.error", F.col("a.estimated_difficulty").alias("label"), F.col("a.repair_action").alias("action"), "a.correct_answer")


@query(f"WITH {SEED} SELECT task_id, CASE k % 4 WHEN 2 THEN 'blind response missing numeric answer' WHEN 3 THEN 'blind response is not valid JSON' ELSE '' END error, CASE WHEN k % 4 < 2 THEN fin::VARCHAR END answer, CASE k % 4 WHEN 0 THEN 1e0 WHEN 1 THEN 0e0 END confidence FROM seed")
def parse_vote(spark, d):
    f, k = F.col("fin").cast("string"), F.col("k")
    raw = F.when(k % 4 == 0, text('{"solvable": "yes", "unique_answer": 1, "answer": "', f, '", "confidence": 7}')).when(k % 4 == 1, text('x {"solvable": false, "unique_answer": true, "answer": ', f, ', "confidence": "high"} y')).when(k % 4 == 2, '{"solvable": true, "unique_answer": true, "answer": "none"}').otherwise("no")
    return seeds(spark, d).withColumn("v", J.parse_vote(raw)).select("task_id", "v.error", "v.answer", "v.confidence")


@query(f"WITH {SEED} SELECT task_id, CASE k % 3 WHEN 0 THEN 'Given x,So ' || fin WHEN 1 THEN 'one,two' ELSE 'a,b c' END steps, fin::VARCHAR final_answer FROM seed")
def parse_victim(spark, d):
    """Whole objects, broken ones, and cut-off ones."""
    f, k = F.col("fin").cast("string"), F.col("k")
    raw = F.when(k % 3 == 0, text('{"steps": ["Given  x", "So ', f, '"], "final_answer": "', f, '"}')).when(k % 3 == 1, text('{"steps": ["one", "two" "final_answer": ', f)).otherwise(text('{"steps": ["a", "b\\nc"], "answer": "', f, '", '))
    raw = F.when(k % 3 == 1, text('{"steps": ["one", "two", "final_answer": ', f)).otherwise(raw)
    v = seeds(spark, d).withColumn("v", J.parse_victim(raw))
    return v.select("task_id", F.array_join(F.filter("v.steps", lambda s: s != "final_answer"), ",").alias("steps"), "v.final_answer")


@query(f"WITH {SEED} SELECT task_id, CASE k % 3 WHEN 0 THEN 'pass' ELSE 'fail' END verdict, CASE k % 3 WHEN 0 THEN 4e0 END correctness, CASE k % 3 WHEN 0 THEN 'a,b' ELSE '' END issues FROM seed")
def parse_inspection(spark, d):
    k = F.col("k")
    raw = F.when(k % 3 == 0, '{"verdict": " PASS ", "scores": {"correctness": 4}, "issues": ["a", "", " b "]}').when(k % 3 == 1, '{"verdict": "maybe"}').otherwise("none")
    return seeds(spark, d).withColumn("i", J.parse_inspection(raw)).select("task_id", "i.verdict", "i.correctness", F.array_join("i.issues", ",").alias("issues"))


@query(f"WITH {SEED} SELECT task_id, CASE k % 3 WHEN 2 THEN '' ELSE 'q' END question, CASE k % 3 WHEN 2 THEN '' ELSE fin::VARCHAR END answer, CASE k % 3 WHEN 0 THEN 'a b' WHEN 1 THEN 'x' ELSE '' END solution, CASE k % 3 WHEN 0 THEN 'a,b' WHEN 1 THEN 'x' ELSE '' END steps, CASE k % 3 WHEN 1 THEN 'easy' ELSE 'hard' END difficulty_bucket FROM seed")
def parse_candidate(spark, d):
    f, k = F.col("fin").cast("string"), F.col("k")
    raw = F.when(k % 3 == 0, text('[1, {"x": 1}, {"question": "q", "steps": ["a", "b"], "final_answer": "', f, '"}]')).when(k % 3 == 1, text('{"result": {"question": "q", "reasoning_brief": "x", "answer": "', f, '", "difficulty_bucket": "easy"}}')).otherwise("none")
    g = seeds(spark, d).withColumn("g", J.parse_candidate(raw, F.lit("hard")))
    return g.select("task_id", "g.question", "g.answer", F.translate("g.solution", "\n", " ").alias("solution"), F.array_join("g.steps", ",").alias("steps"), "g.difficulty_bucket")
