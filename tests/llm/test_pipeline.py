import ctypes
import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weftline.llm import decontam, langid, linededup, mixing, neardup


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert docs.count() <= before
        before = docs.count()
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert before > 100 and final and all(0 < r["taken"] <= 2 * r["size"] for r in final)


WORDS = "ka lo mi ne ru ta vo sa pe du fi go hu je".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(WORDS, k=rng.randint(1, 3))) for _ in range(n))


def small(spark, folder):
    """Documents with planted cases, and what of them must come out of each stage."""
    rng = random.Random(31)
    base = [prose(rng, 60) for _ in range(40)]
    benchmark, line = prose(rng, 12), prose(rng, 20)
    rows = [(i, b + ("\n" + line if i in (3, 4) else ""), "xx", f"s{i % 3}") for i, b in enumerate(base)]
    rows += [(50, base[5], "xx", "s0"), (51, base[5] + " ka", "xx", "s1"), (None, base[6], "xx", "s2"), (7, base[7], "xx", "s2"), (60, prose(rng, 20) + " " + benchmark.upper() + " " + prose(rng, 20), "xx", "s0")]
    rows += [(70, None, "xx", "s0"), (71, "", "xx", None), (72, "12 ½ !!", "xx", "s0"), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"n_chars": F.char_length("text").cast("long"), "_h": F.lit("own"), "node": F.lit(1), "start": F.lit(2)})
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, benchmark), (2, None), (None, base[9])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return base, line


def test_planted_cases_come_out(spark, tmp_path):
    base, line = small(spark, str(tmp_path))
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert {i for i, _ in kept["language_id"]} == set(range(40)) | {50, 51, 60, -1} and len(kept["language_id"]) == 45
    lines = dict(kept["line_dedup"])
    assert lines[3].endswith(line) and lines[4] == base[4] and len(kept["line_dedup"]) == 45
    near = [i for i, _ in kept["near_dedup"]]
    assert sorted(near) == sorted([*range(40), 60])
    assert [i for i, _ in kept["decontamination"]].count(60) == 0 and len(kept["decontamination"]) == 40
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    sizes = {r["doc_id"]: (r["size"], r["taken"]) for r in got}
    assert set(sizes) <= set(range(40)) and all(0 < t <= 2 * n for n, t in sizes.values()) and sizes == {r["doc_id"]: (r["size"], r["taken"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # The last stage against its SQL over what the one before it left.
    assert {i: n for i, (n, _) in sizes.items()} == {i: len(t.split()) for i, t in kept["decontamination"] if i in sizes}


@pytest.mark.parametrize("stage", [langid.stage_language, linededup.stage_lines, neardup.stage_near_duplicates, decontam.stage_decontaminate, mixing.stage_mix])
def test_stages_of_nothing(spark, tmp_path, stage):
    small(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    assert stage(spark, docs, str(tmp_path)).count() == 0


def resident(pid):
    """MB."""
    with open(f"/proc/{pid}/status") as f:
        return int(re.search(r"VmRSS:\s+(\d+)", f.read())[1]) / 1024


def hoard(alloc, fill, free, n=4000, size=100_000):
    """Leaves 400 MB freed but with the C library, as a block in a hundred stays."""
    held = [alloc(size) for _ in range(n)]
    for x in held:
        fill(x, size)
    for i, x in enumerate(held):
        if i % 100 != 99:
            free(x)
    return held[99::100]


@pytest.mark.parametrize("stage", [langid.stage_language, linededup.stage_lines, neardup.stage_near_duplicates, decontam.stage_decontaminate, mixing.stage_mix])
def test_stages_give_back_the_drivers_memory(spark, tmp_path, stage):
    small(spark, str(tmp_path))
    docs, platform, libc = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0), spark._jvm.org.apache.spark.unsafe.Platform, ctypes.CDLL("libc.so.6")
    libc.malloc.restype, libc.free.argtypes, libc.memset.argtypes = ctypes.c_void_p, [ctypes.c_void_p], [ctypes.c_void_p, ctypes.c_int, ctypes.c_size_t]
    stage(spark, docs, str(tmp_path)).count()
    jvm = hoard(platform.allocateMemory, lambda x, n: platform.setMemory(x, 1, n), platform.freeMemory)
    own = hoard(libc.malloc, lambda x, n: libc.memset(x, 1, n), libc.free)
    pids = (spark.sparkContext._gateway.proc.pid, os.getpid())
    before = [resident(p) for p in pids]
    stage(spark, docs, str(tmp_path))
    after = [resident(p) for p in pids]
    for held, free in ((jvm, platform.freeMemory), (own, libc.free)):
        for x in held:
            free(x)
    assert all(a < b - 200 for a, b in zip(after, before)), (before, after)
