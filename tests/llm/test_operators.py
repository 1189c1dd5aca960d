"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and extra columns; results against SQL or brute force."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import decontam, langid, linededup, mixing, neardup, quality, suffix, tokencount, topk, toxicity
from weftline.llm.common import split_join, texts_within

DDL = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "ka lo mi ne ru ta vo sa pe du fi go hu je".split()


def prose(rng, n, tail=""):
    return " ".join("".join(rng.choices(WORDS, k=rng.randint(1, 3))) for _ in range(n)) + tail


def corpus():
    rng = random.Random(5)
    base = [prose(rng, 80) for _ in range(6)]
    passage, notice = prose(rng, 70), "All of this text may be used under licence number"
    rows = [(i, b + "\n" + f"{notice} {i}") for i, b in enumerate(base)]
    rows += [(10 + i, base[0] + "\n" + f"{notice} 0") for i in range(3)]
    for i in range(8):
        w = base[1].split()
        w[rng.randrange(80)] = "zz"
        rows.append((20 + i, " ".join(w)))
    rows += [(40, prose(rng, 30) + " " + passage + " " + prose(rng, 30)), (41, passage + " " + prose(rng, 20)), (42, "X" * 300), (43, "x" * 300), (44, prose(rng, 6000))]
    rows += [(50, None), (51, ""), (52, " \n\t "), (53, "Ünï cödé"), (53, "Ünï cödé"), (None, base[2]), (54, "one two three"), (55, "One TWO three")]
    return [(i, t, rng.choice(["aa", "bb", None]), rng.choice(["s1", "s2", "s3", None]), None if t is None else len(t)) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DDL).repartition(5).persist()


def extra(docs):
    names = ["node", "n", "size", "rank", "score", "rejected", "_h", "_row", "part", "bucket", "start", "window", "pos", "line", "target", "id"]
    return docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))


def rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))) for r in df.collect()), key=repr)


def sql(docs, text, **tables):
    con = duckdb.connect()
    for name, df in {"documents": docs, **tables}.items():
        con.register(name, df.toArrow())
    out = con.sql(text)
    names = sorted(out.columns)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[out.columns.index(c)] for c in names)) for r in out.fetchall()), key=repr)


def test_mix(spark, docs):
    got = mixing.mix(extra(docs))
    assert rows(got) == sql(docs, mixing.ORACLE_SQL.format(docs="documents"))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got.collect())
    by = got.groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) <= 3 * mixing.BLOCK_WORDS for r in by)
    assert mixing.mix(docs.limit(0)).count() == 0
    many = docs.withColumn("doc_id", F.when(F.col("doc_id") > 9, F.col("doc_id")))
    assert rows(mixing.mix(many)) == sql(many, mixing.ORACLE_SQL.format(docs="documents"))


def test_sainte_lague_matches_quotients(spark):
    rng = random.Random(1)
    votes = [rng.randint(0, 900) for _ in range(30)] + [20_000]
    for seats in (0, 1, 17, 400, 5000):
        parties = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "p long, v long, s long")
        got = {r["p"]: r["won"] for r in mixing.sainte_lague(parties, ["s"], "v", "s", [F.col("p")], "won").collect()}
        best = sorted(((-v / (2 * k + 1), i) for i, v in enumerate(votes) if v for k in range(seats)))[:seats]
        want = defaultdict(int)
        for _, i in best:
            want[i] += 1
        assert got == {i: want[i] for i in range(len(votes))}


def test_decontamination(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    words = texts[1].split()
    items = [(1, " ".join(words[3:30]).upper()), (2, "one TWO, three"), (3, ""), (4, None), (None, "one two three"), (5, " ".join(words[5:16])), (1, "ünï CÖDÉ"), (6, "never seen at all")]
    items = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(extra(docs), items).drop("_h")
    assert rows(got) == sql(docs, decontam.ORACLE_SQL.format(docs="documents"), benchmark=items)
    assert any(r["contaminated"] for r in got.collect()) and not all(r["contaminated"] for r in got.collect())
    assert not any(r["contaminated"] for r in decontam.contamination(docs, items.limit(0)).collect())
    assert decontam.contamination(docs.limit(0), items).count() == 0


def test_proximity(spark):
    d = spark.createDataFrame([(1, "a b c d e x g h i j k"), (2, "a b z d e x g q i j k")], "doc_id long, text string").withColumn("_h", F.xxhash64("text"))
    windows, _ = decontam.item_windows(spark.createDataFrame([(7, "a b c d e f g h i j")], "item_id long, text string"), 10)
    terms = windows.select(F.explode("window").alias("term")).distinct().withColumn("t", F.monotonically_increasing_id())
    index = decontam.postings(d, terms)
    ids = {r["rid"]: r["doc_id"] for r in index.filter("t = -1").collect()}
    assert [ids[r["rid"]] for r in decontam.occurrences(index, windows, terms, 0.9).collect()] == [1]
    assert decontam.occurrences(index, windows, terms).count() == 0


def test_line_dedup(spark, docs):
    spark_rows = linededup._rewritten(docs)
    got = spark_rows.select("_row.doc_id", F.col("_n").alias("n_lines"), F.col("_d").alias("n_dropped"), F.sha2(F.coalesce("_kept", F.lit("")), 256).alias("kept_sha256"))
    assert rows(got) == sql(docs, linededup.ORACLE_SQL.format(docs="documents"))
    assert sum(r["n_dropped"] for r in got.collect()) >= 5
    kept = linededup.drop_templates(extra(docs))
    assert kept.columns == extra(docs).columns and kept.count() == docs.count()
    assert linededup.drop_templates(docs.limit(0)).count() == 0


def kept_lines(spark, texts):
    listed = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"].split("\n") for r in linededup.stage_lines(spark, listed, None).orderBy("doc_id").collect()]


def test_stage_drops_long_and_short_recurring_lines(spark):
    rng = random.Random(3)
    long, own = prose(rng, 55), [prose(rng, 30) for _ in range(6)]
    texts = [f"{own[i]}\n{long}" for i in range(2)] + [f"All rights reserved.\n{own[i]}\n}}\nby me" for i in range(2, 6)]
    # A line under 50 bytes of two texts, and an exact copy, are no repeats.
    texts += [f"{prose(rng, 30)}\nla la la la li" for _ in range(2)] + [f"{long[::-1]}\nx"] * 2
    want = [t.split("\n") for t in texts]
    want[1].remove(long)
    for i in range(3, 6):
        want[i] = [own[i], "}"]
    assert kept_lines(spark, texts) == want


def test_stage_generalises_fields(spark):
    rng = random.Random(4)
    own = [prose(rng, 30) for _ in range(60)]
    log = [f"[2024-01-{i:02}] 10:0{i} INFO page {i} of {i + 3} served" for i in range(1, 7)]
    assert kept_lines(spark, [f"{own[i]}\n{line}" for i, line in enumerate(log)]) == [[own[0], log[0]]] + [[own[i]] for i in range(1, 6)]
    # Each name and each town stands in more than MIN_DOCS texts, each pair of them in 3.
    names, towns = "Ann Bob Cid Dan Eve".split(), "Rome Oslo Bonn Lima".split()
    sent = [f"This letter was sent by {n} from {t}" for n in names for t in towns for _ in range(3)]
    assert kept_lines(spark, [f"{own[i]}\n{line}" for i, line in enumerate(sent)])[1:] == [[own[i]] for i in range(1, 60)]
    # Prose that only begins alike stays.
    alike = [f"It was then {prose(rng, 8)}" for _ in range(20)]
    assert kept_lines(spark, [f"{own[i]}\n{line}" for i, line in enumerate(alike)]) == [[own[i], line] for i, line in enumerate(alike)]


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(spark, docs, percent):
    listed = [(r["doc_id"], shingles(r["text"])) for r in docs.collect()]
    group = list(range(len(listed)))
    for _ in listed:
        for i, (_, a) in enumerate(listed):
            for j, (_, b) in enumerate(listed[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    least = {}
    for g, (i, _) in zip(group, listed):
        least[g] = min((x for x in (i, least.get(g)) if x is not None), default=None)
    want = sorted(((least[g] if s else i, i, i is None and not s or (i == least[g]) if i is not None else least[g] is None or True, len(s)) for g, (i, s) in zip(group, listed)), key=repr)
    got = sorted(((r["component_id"], r["doc_id"], r["kept"] if r["doc_id"] is not None else True, r["n_shingles"]) for r in neardup.near_duplicates(extra(docs), percent).collect()), key=repr)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert all(g[2] == (g[0] == g[1]) for g in got if g[1] is not None)


def test_near_duplicates_without_ids(spark):
    rng = random.Random(12)
    base = [prose(rng, 40) for _ in range(300)]
    listed = [(None, b) for b in base for _ in range(6)] + [(7, base[0]), (7, base[1]), (8, base[1]), (9, base[0] + " end"), (None, None), (None, " ")]
    df = spark.createDataFrame(listed, "doc_id long, text string").repartition(4)
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()]
    assert sorted(g for g in got if g[0] is not None) == [(7, 7, True), (7, 7, True), (8, 7, False), (9, 7, False)]
    assert sum(g == (None, 7, False) for g in got) == 12 and sum(g == (None, None, True) for g in got) == 298 * 6 + 2
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in neardup.stage_near_duplicates(spark, extra(df.withColumns({"source": F.lit("s"), "lang": F.lit("l")})), "").collect() if r["text"] and r["text"].strip())
    assert kept == sorted([(0, b) for b in base[2:]] + [(7, base[0]), (7, base[1])])


def test_near_duplicates_against_all_pairs(spark):
    """Recall on pairs of unequal sizes around the threshold."""
    rng = random.Random(13)
    listed = []
    for g in range(60):
        w = [prose(rng, 1) for _ in range(rng.randint(30, 200))]
        listed.append((3 * g, " ".join(w)))
        listed.append((3 * g + 1, " ".join(w + [prose(rng, 1) for _ in range(round((len(w) - 4) * rng.uniform(0.05, 0.3)))])))
        at = rng.randrange(len(w))
        listed.append((3 * g + 2, " ".join(w[:at] + ["zz"] + w[at + 1 :])))
    sets = {i: shingles(t) for i, t in listed}
    least = dict(zip(sets, sets))
    for _ in range(3):
        for i, a in sets.items():
            for j, b in sets.items():
                if 100 * len(a & b) >= 85 * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(listed, "doc_id long, text string")).collect()}
    assert got == least and 60 < len(set(least.values())) < 180


def test_near_duplicates_of_nothing(spark, docs):
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_similarity_estimate():
    rng = np.random.default_rng(1)
    for want in (0.6, 0.85):
        common = round(800 * want / (1 + want))
        err = []
        for _ in range(20):
            x = rng.integers(0, 1 << 63, 800 - common, dtype=np.uint64)
            s = neardup.sketches(np.concatenate([np.sort(x[:400]), np.sort(x[400 - common :][:400])]), np.array([0, 400, 800]))
            err.append(float(neardup.likely_similarity(np.array([(s[0] > s[1]).sum()]), np.array([(s[0] < s[1]).sum()]), np.array([400.0]), np.array([400.0]))[0]) - want)
        assert abs(np.mean(err)) < 0.03


def test_suffix_dedup(spark, docs):
    listed = sorted(((r["doc_id"] if r["doc_id"] is not None else suffix.NO_ID, (r["text"] or "").encode()) for r in docs.collect()))
    first, want = {}, []
    for i, b in listed:
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    for i, b in listed:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        want.append((None if i == suffix.NO_ID else i, hashlib.sha256(kept).hexdigest(), len(b), sum(gone), spans))
    got = [(r["doc_id"], r["kept_sha256"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix.remove_repeats(extra(docs)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(w[3] for w in want)
    assert suffix.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_dedup_names_copies_by_row(spark):
    rng = random.Random(11)
    a, b, c, d = (prose(rng, 40) for _ in range(4))
    listed = [(1, a), (None, a), (None, b), (None, None), (None, "short"), (7, a), (7, c), (7, None), (-3, d), (9, d), (9, d + b)]
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix.remove_repeats(spark.createDataFrame(listed, "doc_id long, text string")).collect()), key=repr)
    # b stands in document 9, too, so the null-id row of it goes by the strings, as a whole.
    gone = {(None, a), (None, b), (7, a), (9, d)}
    want = [(i, len(t or ""), len(d) if (i, t) == (9, d + b) else len(t) if (i, t) in gone else 0) for i, t in listed]
    assert got == sorted(want, key=repr)


def test_suffix_dedup_of_a_common_passage(spark):
    """A passage of all documents, some of which have no id or share one, against all strings."""
    rng = random.Random(21)
    passage = prose(rng, 30)
    listed = [(rng.choice([None, 3, i, i, i]), prose(rng, rng.randint(0, 12)) + " " + passage[rng.randrange(20) :] + prose(rng, rng.randint(0, 9))) for i in range(400)]
    first = {}
    for i, t in listed:
        b = t.encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], suffix.NO_ID), suffix.NO_ID if i is None else i)
    want = []
    for i, t in listed:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (suffix.NO_ID if i is None else i):
                gone[p : p + 50] = b"\1" * 50
        want.append((i, len(b), sum(gone)))
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix.remove_repeats(spark.createDataFrame(listed, "doc_id long, text string")).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_equal_hashes_of_stretches_are_verified():
    data = np.frombuffer(b"a" * 60 + b"b" * 60 + b"a" * 60, np.uint8)
    start, length, left = np.array([0, 60, 120]), np.array([60, 60, 60]), np.array([5, 5, 5])
    lead, of = suffix.same_stretches(data, start, length, left, np.array([7, 7, 7], np.uint64))
    assert len(lead) == 2 and of[0] == of[2] != of[1]
    lead, of = suffix.same_stretches(data, start, length, left, np.array([7, 8, 7], np.uint64))
    assert len(lead) == 2 and of[0] == of[2] != of[1]


def test_suffix_order():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    start = rng.integers(0, 340, 60)
    length = rng.integers(0, 51, 60)
    group = np.sort(rng.integers(0, 4, 60).astype(np.uint64))
    s = suffix.Suffixes(data, start, length)
    text = [data[a : a + n].tobytes() for a, n in zip(start, length)]
    order, common = s.classes(group)
    assert [(int(group[o]), text[o]) for o in order] == sorted((int(g), t) for g, t in zip(group, text))
    for x, y, c in zip(order, order[1:], common[1:]):
        n = next((i for i, (p, q) in enumerate(zip(text[x], text[y])) if p != q), min(len(text[x]), len(text[y])))
        assert c == (n if group[x] == group[y] else -1)


def test_token_counts(spark, docs):
    pieces = tokencount.vocabulary(f"{tokencount.TOKENIZERS}/{tokencount.MODEL}")

    def brute(word):
        s, best = tokencount.MARK + word, [(0.0, 0)]
        for j in range(1, len(s) + 1):
            options = [(best[i][0] - pieces[s[i:j]], best[i][1] + 1) for i in range(j) if s[i:j] in pieces]
            if s[j - 1] not in pieces:
                options.append((best[j - 1][0] - tokencount.UNKNOWN, best[j - 1][1] + len(s[j - 1].encode())))
            best.append(min(options))
        return best[-1][1]

    got = sorted(((r["doc_id"], r["n_pretokens"], r["n_tokens"]) for r in tokencount.count_tokens(extra(docs)).collect()), key=repr)
    want = [(r["doc_id"], len((r["text"] or "").split()), sum(map(brute, (r["text"] or "").split()))) for r in docs.collect()]
    assert sorted(want, key=repr) == got
    assert tokencount.count_tokens(docs.limit(0)).count() == 0


def test_long_pretokens_are_whole(spark):
    pieces = tokencount.vocabulary(f"{tokencount.TOKENIZERS}/{tokencount.MODEL}")
    rng = random.Random(8)
    long = ["".join(rng.choices(["the", "information", "国", "z", "Ü", "q9", "ation", "\U0001f9ff"], k=400)), "x" * 513, "x" * 512]

    def brute(word):
        s, best = tokencount.MARK + word, [(0.0, 0)]
        for j in range(1, len(s) + 1):
            options = [(best[i][0] - pieces[s[i:j]], best[i][1] + 1) for i in range(max(0, j - 64), j) if s[i:j] in pieces]
            if s[j - 1] not in pieces:
                options.append((best[j - 1][0] - tokencount.UNKNOWN, best[j - 1][1] + len(s[j - 1].encode())))
            best.append(min(options))
        return best[-1][1]

    assert max(map(len, pieces)) <= 64
    docs = spark.createDataFrame([(i, f"a {w} b") for i, w in enumerate(long)], "doc_id long, text string")
    got = sorted(tuple(r) for r in tokencount.count_tokens(docs).collect())
    assert got == [(i, 3, brute("a") + brute(w) + brute("b")) for i, w in enumerate(long)]


def test_words_of_all_learning_texts_are_indexed():
    texts = ["ka lo mi"] * 2100 + ["zuzu ka lo"] * 20
    assert "zuzu" in quality.QualityModel(texts, [i % 2 for i in range(len(texts))]).words.names


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.2, 8)], 0) for i in range(90)]
    vectors += [(100, None, 0), (120, [0.1] * 7 + [float("nan")], 0), (140, [0.1] * 7 + [None], 0), (None, [0.1] * 8, 0), (160, [], 0), (20, [0.2] * 8, 0), (20, [0.2] * 8, 0), (180, [0.5, 0.25], 0), (181, [0.5, -0.25], 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    for block in (65_536, 16):
        got = topk.top_k(df, lambda v: v % 20 == 0, block_rows=block, block_queries=3)
        assert rows(got) == sql(df, topk.ORACLE_SQL, embeddings=df)
    assert topk.top_k(df.limit(0), lambda v: v % 20 == 0).count() == 0
    names = df.select("*", *(F.lit(1).alias(c) for c in ("dim", "rid", "rb", "qb", "codes", "n", "score", "rank")))
    assert rows(topk.top_k(names, lambda v: v % 20 == 0)) == sql(df, topk.ORACLE_SQL, embeddings=df)


def test_top_k_of_large_components(spark):
    rng = random.Random(9)
    huge = [(i, [rng.choice([3e5, 4e5, -7.25e11, 1e17, -1e17, 2e20, 0.5]) * rng.random() for _ in range(3)]) for i in range(60)]
    df = spark.createDataFrame([(0, [300000.0, 1.0, 1.0]), (1, [300000.0, 0.0, 0.0]), (2, [400000.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in topk.top_k(df, lambda v: v == 0).orderBy("rank").collect()] == [(2, 64 * 64 * 300000 * 400000), (1, 64 * 64 * 300000 * 300000)]
    code = lambda x: int(min(max(x * 64.0, -float(2**63 - 1024)), float(2**63 - 1024)) // 1)
    codes = {i: [code(x) for x in v] for i, v in huge}
    got = topk.top_k(spark.createDataFrame(huge, "vec_id long, embedding array<double>"), lambda v: v % 20 == 0, k=5).collect()
    for q in (0, 20, 40):
        exact = sorted((-sum(a * b for a, b in zip(codes[q], c)), i) for i, c in codes.items() if i != q)[:5]
        mine = [r for r in got if r["query_id"] == q]
        assert sorted(r["vec_id"] for r in mine) == sorted(i for _, i in exact)
        assert {r["vec_id"]: r["score"] for r in mine} == {i: min(max(-s, -(2**63)), 2**63 - 1) for s, i in exact}


def test_segments_are_maximal():
    assert toxicity.maximal_segments(np.array([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5.0])) == [(0, 1, 4.0), (2, 3, 3.0), (4, 11, 7.0)]


def test_classifiers_on_held_out_rows(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    lang = langid.op1_kneser_ney_langid(spark, "/root/testdata/sf0.01").join(d.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (lang["lang"] == lang["lang_pred"]).mean() > 0.98 and lang["score"].between(0, 1).all()
    for op, label, least in ((quality.op2_random_indexing_quality, "quality", 0.9), (toxicity.op5_segment_toxicity, "toxic", 0.9)):
        r = op(spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out").toPandas()
        assert (r["predicted"] == r[label]).mean() > least and r["score"].between(0, 1).all()


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(i, t, "aa") for i, t in enumerate(["½ ²", "Ⅷ", "123_4", "½ a", None, "", "ka lo mi"] + ["ka lo mi"] * 40)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.train(docs)).collect()}
    assert [got[i] for i in range(7)] == ["und", "und", "und", "aa", "und", "und", "aa"]


def test_language_model_against_plain_kneser_ney():
    """Probabilities of the sorted hash arrays against counts of plain strings."""
    rng = random.Random(3)
    tokens = [prose(rng, 1) for _ in range(300)]
    counts = defaultdict(int)
    for t in tokens:
        counts[t] += 1
    model = langid.KneserNey(dict(counts))
    pad, n = langid.BEGIN * (langid.ORDER - 1), langid.ORDER
    full = defaultdict(int)
    for t, c in counts.items():
        s = pad + t + langid.END
        for i in range(n - 1, len(s)):
            full[s[i - n + 1 : i + 1]] += c
    tables = {n: full}
    for k in range(n - 1, 0, -1):  # of a lower order: how many different symbols precede it
        tables[k] = defaultdict(int)
        for g in tables[k + 1]:
            tables[k][g[1:]] += 1
    cut = {}
    for k, t in tables.items():
        one, two = sum(v == 1 for v in t.values()), sum(v == 2 for v in t.values())
        cut[k] = min(0.95, max(0.4, one / (one + 2 * two))) if one else 0.4

    def prob(g):
        k = len(g)
        if not k:
            return 1e-4
        same = {x: v for x, v in tables[k].items() if x[:-1] == g[:-1]}
        total = sum(same.values())
        if not total:
            return prob(g[1:])
        return max(same.get(g, 0) - cut[k], 0) / total + min(cut[k] * len(same), total) / total * prob(g[1:])

    asked = tokens[:20] + ["zzz", "kaqlo"]
    hashes, starts = langid.grams(asked)
    keyed = [np.unique(h, return_inverse=True) for h in hashes]
    before = [np.unique(h, return_inverse=True) for h in langid.contexts(asked)]
    got = np.add.reduceat(model.log_prob(keyed, before), starts)
    want = [sum(np.log(prob((pad + t + langid.END)[i - n + 1 : i + 1])) for i in range(n - 1, len(pad + t + langid.END))) for t in asked]
    assert np.allclose(got, want, atol=1e-4)


def test_ties_and_long_texts_of_languages():
    model = langid.LanguageModel({name: ["ka lo mi ne ru"] * 40 for name in ("bb", "aa")})
    lang, score, rejected = model.predict(["ka lo", "ka lo", "ka " * 400_000, "!"], langid.TokenTable(model.rows))
    assert lang == ["aa", "aa", "aa", "und"] and score[0] == score[1] == 0.5 and rejected[3]


def test_quality_pooling_and_network_against_plain_numbers():
    model = quality.QualityModel(["good words here", "fine words there"] * 5 + ["BAD!!! ### $$$", "AWFUL %%% !!!"] * 5, [1, 1] * 5 + [0, 0] * 5)
    text = "good Words HERE unknownword !!!"
    v, names = model.words.vectors, model.words.names
    at = dict(zip(names, range(len(names))))
    parts = []
    for p in quality.PART.findall(text):
        case = quality.case_of(p)
        word = v[at[p.lower()]] if p.lower() in at else None
        parts.append((word + v[case] if p[0].isalnum() else word) if word is not None else v[case])
    pooled = np.concatenate([np.mean(parts, 0), quality.shares(text, quality.Counter(quality.PART.findall(text)))])
    x = (pooled - model.mean) / model.spread
    z = float((np.tanh(x @ model.net[0] + model.net[1]) @ model.net[2] + model.net[3])[0]) / model.temperature
    assert abs(model.score([text])[0] - 1 / (1 + np.exp(-z))) < 1e-5


def test_segments_against_all_segments():
    """Every maximal segment by its definition: all proper prefixes and suffixes are positive, and no longer one contains it."""
    rng = random.Random(6)
    for _ in range(60):
        s = [rng.choice([-2.0, -1.0, 1.0, 1.5, 3.0]) for _ in range(rng.randint(1, 14))]
        good = [(a, b) for a in range(len(s)) for b in range(a + 1, len(s) + 1) if all(sum(s[a:m]) > 0 and sum(s[m:b]) > 0 for m in range(a + 1, b)) and sum(s[a:b]) > 0]
        want = sorted((a, b, sum(s[a:b])) for a, b in good if not any((x, y) != (a, b) and x <= a and b <= y for x, y in good))
        assert toxicity.maximal_segments(np.array(s)) == want


def test_classifiers_on_odd_tables(spark, tmp_path):
    """Empty and odd tables through the queries themselves."""
    rng = random.Random(7)
    rows_ = [(i, prose(rng, 20) + (" vile slur" if i % 2 else ""), "x", "s", 0) for i in range(60)] + [(1, prose(rng, 5), "x", "s", 0)] * 3 + [(None, "ka", "x", "s", 0), (70, None, "x", "s", 0), (71, "vile slur " * 60_000, "x", "s", 0), (72, "", None, None, None)]
    given = spark.createDataFrame(rows_, DDL)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)] + [(3, 1, 1), (None, 1, 1), (61, None, None)], "doc_id long, quality int, toxic int")
    for name, table, marks in (("full", extra(given), labels.withColumn("text", F.lit("x"))), ("empty", given.limit(0), labels.limit(0)), ("unlabelled", given, labels.limit(0))):
        folder = f"{tmp_path}/{name}"
        table.write.parquet(f"{folder}/documents.parquet")
        marks.write.parquet(f"{folder}/labels.parquet")
        for op in (quality.op2_random_indexing_quality, toxicity.op5_segment_toxicity, langid.op1_kneser_ney_langid):
            got = op(spark, folder).collect()
            assert len(got) == table.count() and all(0 <= r["score"] <= 1 for r in got)
            if name == "full" and "predicted" in got[0]:
                assert all(len({r["score"] for r in got if r["doc_id"] == i}) == (2 if i == 1 else 1) for i in (1, 5, 70, 71))


def test_split_join_without_broadcast(spark):
    left = spark.createDataFrame([(i % 3 if i % 2 else 0, i) for i in range(500)], "k long, v long")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k long, w string")
    for how in ("inner", "left"):
        assert rows(split_join(left, right, ["k"], F.col("v"), how, rows=1)) == rows(left.join(right, "k", how))


def test_learning_bytes_are_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * 900_000) for i in range(12)] + [(3, "x" * 900_000)] * 4 + [(20, "y" * 1_100_000)], "doc_id long, text string")
    wanted = [(r["doc_id"], r["h"], 900_000) for r in docs.select("doc_id", F.xxhash64("text").alias("h")).distinct().orderBy("doc_id").collect()]
    assert len(texts_within(docs, wanted, 5_000_000)) == 5 and len(texts_within(docs, wanted)) == 12


def test_classifiers_on_odd_rows(spark, docs):
    model = langid.train(docs)
    out = langid.identify(extra(docs), model, ["doc_id"]).collect()
    assert len(out) == docs.count() and all((r["lang_pred"] == "und") == (r["score"] == 0) for r in out)
    kept = langid.stage_language(spark, extra(docs), "")
    assert kept.columns == extra(docs).columns and kept.filter("text IS NULL").count() == 0 and kept.count() >= 20
    assert langid.identify(docs, langid.train(docs.limit(0))).filter("lang_pred <> 'und'").count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        scores = [module.train(d, none).score([None, "", "abc"]) for d in (docs, docs.limit(0))]
        assert all(((0 <= s) & (s <= 1)).all() for s in scores)
    model = quality.QualityModel(["good words here"] * 5 + ["BAD!!! ###"] * 5, [1] * 5 + [0] * 5)
    assert model.score([None, "", "good words here"])[2] > 0.5
