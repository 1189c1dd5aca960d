"""Benchmark decontamination on a positional inverted index.

Words are lower-cased (A-Z only) runs of bytes that are no ASCII separator.  Each
benchmark item gives its windows of ten consecutive words (a shorter item, one
window).  The training corpus is read once: its postings (term, document, position)
for the terms of the test items are stored as a table in the shared folder, sharded
by document as Spark reads them and sorted by term inside a shard.  Terms that no
item has are left out, as no list of theirs is ever asked for.  Each document adds
one end posting, which holds its identity and its number of words.

A window's terms are ordered by the lengths of their lists.  The list of the rarest
term, with the term's offset in the window subtracted from each position, gives
places where the window may begin; they are intersected with the offset-adjusted
list of the next term, and what is left with those of all others.  Places that meet
every list are exact phrase matches; with ``least`` below 1, places that meet enough
lists are proximity matches, and as many of the rarest lists as can be missed, plus
one, are the start.  Texts are neither read again nor shuffled.

Only DataFrame functions run here.  Test terms, and the places of one step, are
broadcast where they have at most ``BROADCAST_ROWS`` rows (they are counted), else
the joins shuffle by document, term and position.

Defined cases: null text has no words; an item without words, or with a null id,
has no windows; items of one id are one item; equal windows of many items are one
window; repeated documents each get their row; further columns are not looked at; a
text of any length has one posting per word; an empty corpus gives no rows and an
empty benchmark no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, materialize, release_driver, table, written

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The term of the posting at a document's end; no word holds such a byte.
END = "\x00"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; the fast way where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), "")


def item_windows(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(item_id, text) -> (wid, window) of the distinct windows, and (wid, item) of the items that hold them."""
    listed = items.filter("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    begin = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1))))
    cut = materialize(listed.withColumn("_b", begin).select("item", F.expr(f"slice(w, _b, {width})").alias("window")).distinct())
    windows = materialize(cut.select("window").distinct().withColumn("wid", F.monotonically_increasing_id()))
    return windows, materialize(cut.join(windows, "window").select("wid", "item"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, _h, text) x (term, t) -> the stored index (t, rid, pos); t is -1 at a document's end, where doc_id and _h stand, too."""
    asked = bounded(materialize(terms.unionByName(terms.sparkSession.createDataFrame([(END, -1)], "term string, t long"))))
    # The number of a row is given before its words are spread, or each word would get one.
    numbered = docs.select("doc_id", "_h", words(F.col("text")).alias("w"), F.monotonically_increasing_id().alias("rid"))
    read = numbered.select("doc_id", "_h", "rid", F.posexplode(F.concat("w", F.array(F.lit(END)))).alias("pos", "term"))
    end = lambda c: F.when(F.col("t") == -1, F.col(c)).alias(c)
    return written(read.join(asked, "term").select("t", "rid", "pos", end("doc_id"), end("_h")).sortWithinPartitions("t", "rid", "pos"), "postings")


def occurrences(index: DataFrame, windows: DataFrame, terms: DataFrame, least: float = 1.0) -> DataFrame:
    """(rid, wid, start, length) wherever a window occurs.

    ``least`` is the share of a window's words that must stand at their places.
    """
    lists = index.filter("t >= 0").groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    rarity = F.row_number().over(Window.partitionBy("wid").orderBy("n", "t", "offset"))
    asked = windows.select("wid", F.size("window").alias("length"), F.posexplode("window").alias("offset", "term")).join(terms, "term").join(lists, "t", "left").fillna(0, ["n"])
    asked = asked.select("wid", "length", "offset", "t", "n", rarity.alias("r"), F.ceil(F.col("length") * F.lit(float(least))).alias("need"))
    # Of a window with more empty lists than words may be missing, nothing is looked up.
    full = F.count_if(F.col("n") > 0).over(Window.partitionBy("wid"))
    asked = materialize(asked.withColumn("full", full).filter("full >= need AND n > 0").drop("full"))
    ranked = F.row_number().over(Window.partitionBy("wid").orderBy("r"))
    asked = asked.withColumn("r", ranked)
    first = bounded(materialize(asked.filter("r <= length - need + 1").select("t", "wid", "offset")))
    places = index.select("t", "rid", "pos").join(first, "t").select("rid", "wid", (F.col("pos") - F.col("offset")).alias("start")).filter("start >= 0")
    places = materialize(places.distinct() if least < 1 else places)

    def intersected(places: DataFrame, others: DataFrame) -> DataFrame:
        """Adds ``met``: the other lists that hold the place.

        Lists that no place asks for, and lists of documents without a place, stay where they are.
        """
        lists = index.select("rid", "t", "pos").join(bounded(materialize(others.select("t").distinct())), "t", "left_semi")
        asked_rows = materialize(places.select("rid").distinct())
        if (few := bounded(asked_rows)) is not asked_rows:
            lists = lists.join(few, "rid", "left_semi")
        wanted = bounded(materialize(places.join(others, "wid").select("rid", "t", (F.col("start") + F.col("offset")).alias("pos"), "wid", "start")))
        return lists.join(wanted, ["rid", "t", "pos"]).groupBy("rid", "wid", "start").agg(F.count(F.lit(1)).alias("met"))

    sizes = asked.select("wid", "length", "need").distinct()
    if least < 1:
        met = intersected(places, asked.select("wid", "t", "offset"))
        return met.join(sizes, "wid").filter("met >= need").select("rid", "wid", "start", "length")
    # The next list first, alone: few places are left for the others.
    single = places.join(sizes.filter("length = 1"), "wid")
    second = materialize(intersected(places, asked.filter("r = 2").select("wid", "t", "offset")).select("rid", "wid", "start"))
    pairs = second.join(sizes.filter("length = 2"), "wid")
    met = intersected(second, asked.filter("r > 2").select("wid", "t", "offset")).join(sizes, "wid").filter("met = length - 2")
    return single.select("rid", "wid", "start", "length").unionByName(pairs.select("rid", "wid", "start", "length")).unionByName(met.select("rid", "wid", "start", "length"))


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, least: float = 1.0) -> DataFrame:
    """(doc_id, text) x (item_id, text) -> doc_id, _h, n_words, n_hit, n_items, items_sha256, contaminated."""
    windows, links = item_windows(items, width)
    terms = materialize(windows.select(F.explode("window").alias("term")).distinct().withColumn("t", F.monotonically_increasing_id()))
    index = postings(docs.select("doc_id", "text", F.xxhash64("text").alias("_h")), terms)
    found = materialize(occurrences(index, windows, terms, least))
    spans = found.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["start"] + x["length"]).alias("end"), (acc["total"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(acc["end"], x["start"]))).alias("total")
        ),
        lambda acc: acc["total"],
    )
    held = found.select("rid", "wid").distinct().join(bounded(links), "wid").select("rid", "item").distinct().groupBy("rid").agg(F.array_sort(F.collect_list("item")).alias("ids"))
    per_doc = spans.join(held, "rid").select("rid", covered.cast("long").alias("n_hit"), F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    joined = index.filter("t = -1").select("doc_id", "_h", "rid", F.col("pos").cast("long").alias("n_words")).join(per_doc, "rid", "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "_h", "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


def op9_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_h")


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: without the documents that hold a benchmark window.

    Documents without words stay; rows of the same doc_id and text share their fate.
    """
    release_driver(spark)
    hit = contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("doc_id").alias("_d"), F.col("_h").alias("_x")).distinct()
    keyed = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("_h"))
    gone = bounded(materialize(hit))
    release_driver(spark)
    return keyed.join(gone, keyed["doc_id"].eqNullSafe(F.col("_d")) & (keyed["_h"] == F.col("_x")), "left_anti").select("_row.*")


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') w FROM {{docs}}),
i AS (SELECT item_id::VARCHAR item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, len(w[b:b + {WINDOW - 1}]) n, array_to_string(w[b:b + {WINDOW - 1}], ' ') k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) b FROM i WHERE len(w) > 0)),
grams AS (SELECT rid, n, b, array_to_string(w[b:b + n - 1], ' ') k FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) b FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT g.rid, g.b, g.n, win.item FROM grams g JOIN win USING (n, k)),
hit AS (SELECT rid, count(DISTINCT p)::BIGINT n_hit FROM (SELECT rid, unnest(range(b, b + n)) p FROM occ) GROUP BY rid),
its AS (SELECT rid, count(*)::BIGINT n_items, string_agg(item, ',' ORDER BY item) ids FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit, coalesce(n_items, 0)::BIGINT n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
