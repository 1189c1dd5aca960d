"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_at_exit, shared_folder

#: Bytes of text that one numpy working set may cover; a longer document is a set of its own.
CHUNK_BYTES = 1_000_000

#: Tokens whose numbers are computed at once.
TOKENS_AT_ONCE = 16_384

#: A longer text is not learned from, and what a model learns from has so many bytes at most.
LEARN_BYTES = 1_000_000
LEARN_TOTAL = 64_000_000

#: A table of at most so many rows, which are counted first, may be broadcast.
BROADCAST_ROWS = 200_000

#: Parts that the rows of one key are dealt to where they are joined by a shuffle.
SALTS = 16

#: Word pattern of the contracts that split on ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a table that nothing reads any more."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark._jsc.hadoopConfiguration()).delete(held, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again; the driver's end deletes it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    drop_at_exit(spark, path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, which are counted; ``df`` should be a materialised table."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_for(rows: int, each: int = 50_000) -> int:
    """Partitions for a table of narrow rows, so that a small one does not write a file per shuffle partition."""
    return rows // each + 1


def compact(df: DataFrame) -> DataFrame:
    """``materialize``, then as many partitions as the rows ask for (never more than there were)."""
    kept = materialize(df)
    return kept.coalesce(partitions_for(kept.count()))


def split_join(left: DataFrame, right: DataFrame, key: list[str], spread: Column, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """``left`` joined with the materialised ``right``, which has one row per key.

    A key may hold any share of ``left``: a small ``right`` is broadcast, else
    the key's rows are dealt by ``spread`` over ``SALTS`` parts, each with a copy of
    the key's one row.
    """
    if rows and (small := bounded(right, rows)) is not right:
        return left.join(small, key, how)
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(copies, [*key, "_salt"], how).drop("_salt")


def bucket_of(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus`` (null for a null key)."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text", max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose text adds up to about ``max_bytes``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > max_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def release_memory() -> None:
    """Gives back what a worker process no longer needs, as an idle worker keeps its memory while other stages run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def release_driver(spark: SparkSession) -> None:
    """Gives back what the driver no longer needs: the memory of its Python, and what its JVM holds beside the heap.

    The C library keeps what the JVM's threads have freed, more the more plans a
    session has run. A JVM without the command that trims it keeps it.
    """
    release_memory()
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    jvm.System.gc()
    try:
        # By the interface's method, as the server's own class is not open to callers.
        kinds = array(jvm.Class, 4)
        for i, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = jvm.Class.forName(name)
        values = array(jvm.Object, 4)
        values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        jvm.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, values)
    except Py4JError:
        pass


class TokenTable:
    """Rows of numbers for tokens, computed once per distinct token.

    ``compute`` gets a list of unseen tokens and returns one row each.  The
    table forgets everything once it holds ``capacity`` tokens, so a worker's
    memory does not grow with the corpus.
    """

    def __init__(self, compute: Callable[[list], np.ndarray], capacity: int = 200_000):
        self.compute, self.capacity = compute, capacity
        self.index: dict = {}
        self.rows: np.ndarray | None = None

    def learn(self, counters: list[Counter]) -> None:
        if len(self.index) > self.capacity:
            self.index, self.rows = {}, None
        unseen = list({t for c in counters for t in c if t not in self.index})
        if not unseen:
            return
        fresh = np.concatenate([self.compute(unseen[at : at + TOKENS_AT_ONCE]) for at in range(0, len(unseen), TOKENS_AT_ONCE)])
        known = len(self.index)
        if self.rows is None or known + len(fresh) > len(self.rows):
            grown = np.zeros((max(2 * (known + len(fresh)), 1024), fresh.shape[1]), fresh.dtype)
            if known:
                grown[:known] = self.rows[:known]
            self.rows = grown
        self.rows[known : known + len(fresh)] = fresh
        self.index.update(zip(unseen, range(known, known + len(unseen))))

    def pooled(self, counters: list[Counter]) -> np.ndarray:
        """For each counter the sum of count times row."""
        self.learn(counters)
        width = self.rows.shape[1] if self.rows is not None else 1
        out = np.zeros((len(counters), width))
        look = self.index.__getitem__
        for at, c in enumerate(counters):
            if c:
                ids = np.fromiter(map(look, c), np.int64, len(c))
                out[at] = np.fromiter(c.values(), np.float64, len(c)) @ self.rows[ids]
        return out


def texts_within(docs: DataFrame, wanted: list[tuple], total: int = LEARN_TOTAL) -> dict[tuple, str]:
    """(doc_id, hash) -> text of the first ``wanted`` (doc_id, hash, bytes) rows that have ``total`` bytes together.

    So the driver gets a bounded number of bytes, however many rows share an id or a text.
    """
    keys, held = [], 0
    for doc_id, code, size in wanted:
        held += size
        if held > total:
            break
        keys.append((doc_id, code))
    kind = docs.schema["doc_id"].dataType.simpleString()
    asked = docs.sparkSession.createDataFrame(keys, f"doc_id {kind}, _h long")
    rows = docs.select("doc_id", F.xxhash64("text").alias("_h"), "text").filter(F.octet_length("text") <= LEARN_BYTES)
    rows = rows.join(F.broadcast(asked), ["doc_id", "_h"]).dropDuplicates(["doc_id", "_h"]).toArrow()
    return dict(zip(zip(rows.column("doc_id").to_pylist(), rows.column("_h").to_pylist()), rows.column("text").to_pylist()))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, most: int) -> list[tuple[str, int]]:
    """At most ``most`` labelled (text, label) rows of ``LEARN_TOTAL`` bytes to learn from, on the driver.

    The rows are those with the smallest hashes of doc_id among the labelled
    documents outside the held-out fold; ``most`` bounds what is broadcast and
    the rows of ids and sizes that the driver gets first.  Equal texts with equal
    labels count once.
    """
    free = labels.filter(F.col(label).isNotNull() & (bucket_of(F.col("doc_id"), modulus) != held))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = free.select("doc_id", F.col(label).cast("int").alias("label")).distinct().orderBy(*order, "label").limit(most)
    fit = docs.select("doc_id", F.xxhash64("text").alias("_h"), F.octet_length("text").alias("_n")).filter(F.col("_n") <= LEARN_BYTES)
    rows = fit.join(F.broadcast(chosen), "doc_id").distinct().orderBy(*order, "_h", "label").limit(most).collect()
    texts = texts_within(docs, list(dict.fromkeys((r["doc_id"], r["_h"], r["_n"]) for r in rows)))
    rows = sorted((r for r in rows if (r["doc_id"], r["_h"]) in texts), key=lambda r: (r["doc_id"], r["_h"], r["label"]))
    return list(dict.fromkeys((texts[r["doc_id"], r["_h"]], r["label"]) for r in rows))


def scored(docs: DataFrame, score: Callable[[list], np.ndarray], modulus: int, held: int, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; ``score`` maps a list of texts to numbers."""

    def run(batches):
        for chunk in text_chunks(batches):
            p = np.clip(np.asarray(score(chunk.column("text").to_pylist()), np.float64), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
        release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    fold = F.coalesce(bucket_of(F.col("doc_id"), modulus) == held, F.lit(False)).alias("held_out")
    return docs.select("doc_id", fold, "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
