"""Near-duplicate detection with SetSketch registers.

A document is its set of five-word shingles.  Equal sets collapse to one node.
Each node has a SetSketch: 256 registers, each the truncated logarithm of the
minimum of exponentially spaced values, drawn per element in ascending order, so
that an element stops as soon as it can't lower any register.  Registers are
mergeable by maximum and as locality-sensitive as minwise hashes.  Bands of six
register values make candidates (a pair at similarity 0.85 is missed by all 42
bands with probability 2e-9); the likelihood of the registers' joint order
estimates a candidate pair's similarity; pairs that are within ``MARGIN`` standard
errors of the threshold or above are confirmed on their full sets, so that of the true
pairs right at the threshold about one in three million is refuted by its estimate.

No bucket is expanded into all its pairs as rows.  First each node meets the
centres (a random member per bucket) with which it shares most buckets, and
confirmed links give components.  Buckets that still hold several components
are cut into blocks of bounded size; a pair of blocks is one task's work, which
compares sketches, confirms the pairs across components and returns only the
links that join something.  So every candidate pair is either confirmed, refuted
or already connected.

A row is known by its doc_id and the hash of its text, since a null or repeated doc_id
does not name one.

Defined cases: null or wordless texts have 0 shingles, are linked with nothing
and are kept; a text of fewer than five words is one shingle; rows with a null
doc_id take part, and a component is named by its smallest non-null doc_id; such a
row is marked kept only if its component has no doc_id at all; rows that share the
smallest doc_id are all marked kept; an empty table gives an empty result; further
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, compact, materialize, release_driver, release_memory, table, text_chunks
from .graph import components
from .rolling import Prefix, mixed

SHINGLE = 5
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 85
REGISTERS, LOG_BASE, RATE = 256, 1.1, 20.0
BAND_ROWS = 6
BANDS = REGISTERS // BAND_ROWS
CENTRES = 2
BLOCK = 512
CELL_ROWS = 2048
SET_BYTES = 6
#: Standard errors that an estimate may lie under the threshold.
MARGIN = 5.0
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
TURN = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xA0761D6478BD642F], np.uint64)


def floor_of_estimate(threshold: float) -> float:
    """A pair that is estimated lower is not confirmed."""
    return threshold - MARGIN * (threshold * (1 - threshold) / REGISTERS) ** 0.5


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and the texts' offsets into them."""
    joined = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    solid = ~SPACE[joined]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    word = mixed(Prefix(LOWER[joined]).of(begin, end) + (end - begin).astype(np.uint64))
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    at = np.searchsorted(begin, first)  # words before each text
    n, total = np.diff(at), len(word)
    owner = np.repeat(np.arange(len(texts)), n)
    rolled = np.zeros(max(total - width + 1, 0), np.uint64)
    for k in range(width):
        rolled += mixed(word[k : total - width + 1 + k] + TURN[k]) if total >= width else 0
    whole = owner[: len(rolled)] == owner[width - 1 :] if total >= width else np.zeros(0, bool)
    hashes, docs = [mixed(rolled[whole])], [owner[: len(rolled)][whole]]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        one = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            some = n[short] > k
            one[some] += mixed(word[at[short[some]] + k] + TURN[k])
        hashes.append(mixed(one + n[short].astype(np.uint64)))
        docs.append(short)
    h, d = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[fresh], d[fresh]
    return h, np.searchsorted(d, np.arange(len(texts) + 1))


def sketches(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, REGISTERS) uint8.

    Value j of an element lies in the j-th of REGISTERS intervals of equal
    probability under the exponential law and goes to the j-th register of the
    element's own permutation.
    """
    m, n = REGISTERS, len(offsets) - 1
    low = np.full(n * m, np.inf)
    h, owner = hashes, np.repeat(np.arange(n), np.diff(offsets))
    place, step = (mixed(h + TURN[0]) % np.uint64(m)), (mixed(h + TURN[1]) | np.uint64(1)) % np.uint64(m)
    for j in range(1, m + 1):
        u = (mixed(h * TURN[2] + np.uint64(j)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        x = -np.log1p(-(j - 1) / m) - np.log1p(-u / (m - j + 1))
        np.minimum.at(low, owner * m + ((place + step * np.uint64(j - 1)) % np.uint64(m)).astype(np.int64), x)
        if j == m:
            break
        going = low.reshape(n, m).max(1) > -np.log1p(-j / m)
        left = going[owner]
        if not left.all():
            h, owner, place, step = h[left], owner[left], place[left], step[left]
        if not len(h):
            break
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(low / RATE) / np.log(LOG_BASE))
    return np.where(np.isinf(low), 0, np.clip(k, 0, 255)).astype(np.uint8).reshape(n, m)


def likely_similarity(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity, given how many registers of a are above and below those of b."""
    equal = REGISTERS - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    low, high = np.zeros(np.shape(above)), np.minimum(u / v, v / u)
    s = (LOG_BASE - 1) / LOG_BASE

    def slope(j):
        pa_, pb_ = -np.log1p(-s * np.maximum(u - v * j, 1e-12)) / np.log(LOG_BASE), -np.log1p(-s * np.maximum(v - u * j, 1e-12)) / np.log(LOG_BASE)
        da, db = -s * v / (1 - s * (u - v * j)) / np.log(LOG_BASE), -s * u / (1 - s * (v - u * j)) / np.log(LOG_BASE)
        rest = np.maximum(1 - pa_ - pb_, 1e-12)
        return above * da / np.maximum(pa_, 1e-12) + below * db / np.maximum(pb_, 1e-12) - equal * (da + db) / rest

    for _ in range(24):
        mid = (low + high) / 2
        up = slope(mid) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


def packed(hashes: np.ndarray) -> bytes:
    """The sorted set in SET_BYTES bytes an element (its most significant ones)."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    wide[:, :SET_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    return wide.view(">u8").ravel().astype(np.uint64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _binary(chunk: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in chunk.column("text").cast(pa.binary()).to_pylist()]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _keys(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free hashes of each set."""
    def total(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return mixed(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64))

    return total(mixed(hashes + TURN[3])), total(mixed(hashes * TURN[4] + TURN[1]))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, h, n, node, node2, sketch); h is the hash of the text."""

    def run(batches):
        for chunk in text_chunks(batches):
            h, at = shingle_sets(_binary(chunk))
            node, node2 = _keys(h, at)
            rows = sketches(h, at)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("h"), pa.array(np.diff(at).astype(np.int64)), _signed(node), _signed(node2), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "h", "n", "node", "node2", "sketch"]
            )
        release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, f"doc_id {kind}, h long, n long, node long, node2 long, sketch binary")


def full_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text, node) -> (node, shingles) of the rows whose text has that node."""

    def run(batches):
        for chunk in text_chunks(batches):
            h, at = shingle_sets(_binary(chunk))
            node, _ = _keys(h, at)
            node = node.view(np.int64)
            asked = chunk.column("node").to_numpy()
            keep = np.flatnonzero(node == asked)
            yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array([packed(h[at[i] : at[i + 1]]) for i in keep], pa.binary())], names=["node", "shingles"])
        release_memory()

    return docs.select("text", "node").mapInArrow(run, "node long, shingles binary")


def _estimated(least: float):
    """Keeps the pairs whose sketches make the threshold likely."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b"))
                n_a, n_b = (b.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
                good = likely_similarity((x > y).sum(1), (x < y).sum(1), n_a, n_b) >= least
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(good))

    return run


def _confirmed(percent: int):
    def run(batches):
        for b in batches:
            good = [linked(unpacked(x), unpacked(y), percent) for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _block_pairs(x: np.ndarray, n: np.ndarray, comp: np.ndarray, band: int, left: np.ndarray, right: np.ndarray, percent: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of left and right positions) across components that are of like size, agree in enough registers, and have this band as their first common one."""
    rows, cols = [], []
    same_block = left is right
    for at, i in enumerate(left):
        others = right[at + 1 :] if same_block else right
        others = others[(comp[others] != comp[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
        if len(others):
            equal = x[others] == x[i]
            close = equal.sum(1) >= least * REGISTERS  # registers agree at least as often as elements do
            others, equal = others[close], equal[close]
            first = equal[:, : BANDS * BAND_ROWS].reshape(len(others), BANDS, BAND_ROWS).all(2).argmax(1) if len(others) else np.zeros(0, int)
            others = others[first == band]
            rows.append(np.full(len(others), i))
            cols.append(others)
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _across(percent: int, least: float):
    """Links between components inside pairs of blocks of buckets; a group of rows holds many whole pairs of blocks."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bucket", "low", "high"], ignore_index=True)
        x = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(-1, REGISTERS)
        n, comp, node = pdf["n"].to_numpy(), pdf["component"].to_numpy(), pdf["node"].to_numpy()
        band, block, low, high = (pdf[c].to_numpy() for c in ("band", "block", "low", "high"))
        key = pdf[["bucket", "low", "high"]].to_numpy()
        edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(pdf)]
        rows, cols = [], []
        for start, end in zip(edges, edges[1:]):
            at = np.arange(start, end)
            left = at[block[start:end] == low[start]]
            right = left if low[start] == high[start] else at[block[start:end] == high[start]]
            i, k = _block_pairs(x, n, comp, int(band[start]), left, right, percent, least)
            rows.append(i)
            cols.append(k)
        i, k = np.concatenate(rows), np.concatenate(cols)
        j = np.concatenate([likely_similarity((x[p] > x[q]).sum(1), (x[p] < x[q]).sum(1), n[p], n[q]) for p, q in ((i[c : c + 8192], k[c : c + 8192]) for c in range(0, max(len(i), 1), 8192))])
        keep = np.flatnonzero(j >= least)
        root = {c: c for c in comp.tolist()}

        def top(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        sets: dict[int, np.ndarray] = {}
        shingles, out = pdf["shingles"].to_numpy(), []
        for p in keep[np.argsort(-j[keep], kind="stable")].tolist():
            a, b = top(int(comp[i[p]])), top(int(comp[k[p]]))
            if a != b:
                for q in (int(i[p]), int(k[p])):
                    if int(node[q]) not in sets:
                        sets[int(node[q])] = unpacked(shingles[q])
                if linked(sets[int(node[i[p]])], sets[int(node[k[p]])], percent):
                    root[a] = b
                    out.append((int(node[i[p]]), int(node[k[p]])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text) -> (doc_id, h, n, first) of each row; ``first`` is the (_, doc_id, h) of the row that stands for its component."""
    least = floor_of_estimate(percent / 100)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    each = materialize(features(docs))
    # The smallest doc_id stands for a node, a null one only where there is no other.
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    nodes = materialize(each.filter("n > 0").groupBy("node", "node2").agg(F.min(row).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).drop("node2"))
    band = F.posexplode(F.array(*(F.xxhash64(F.lit(i), F.substring("sketch", i * BAND_ROWS + 1, BAND_ROWS)) for i in range(BANDS))))
    banded = nodes.select("node", band.alias("band", "bucket"))
    # A bucket's centre is the node that is smallest after an exclusive-or with the bucket's hash: random, and another one in each bucket.
    turned = F.col("node").bitwiseXOR(F.col("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min(turned).alias("lo"), F.max(turned).alias("hi")).filter("lo <> hi").select("bucket", F.col("lo").bitwiseXOR(F.col("bucket")).alias("centre"))
    members = compact(banded.join(buckets, "bucket"))
    shared = members.filter("node <> centre").groupBy("node", "centre").agg(F.count(F.lit(1)).alias("times"))
    best = F.row_number().over(Window.partitionBy("node").orderBy(F.col("times").desc(), "centre"))
    pairs = shared.withColumn("r", best).filter(F.col("r") <= CENTRES).select(F.col("node").alias("a"), F.col("centre").alias("b"))
    sketch = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    likely = compact(pairs.join(sketch("a"), "a").join(sketch("b"), "b").mapInArrow(_estimated(least), "a long, b long"))
    asked = materialize(nodes.join(members.select("node").distinct(), "node").select("node", F.col("rep.doc_id").alias("rep"), F.col("rep.h").alias("rep_h")))
    # The hash keeps the rows of a null or repeated doc_id apart.
    sets = materialize(full_sets(docs.join(asked, docs["doc_id"].eqNullSafe(asked["rep"]) & (docs["h"] == asked["rep_h"]))).dropDuplicates(["node"]))
    full = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"set_{s}"))
    links = compact(likely.join(full("a"), "a").join(full("b"), "b").mapInArrow(_confirmed(percent), "a long, b long"))
    found = components(links)

    named = members.select("bucket", "band", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed_ = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("m")).filter("lo <> hi")
    blocks = mixed_.select("bucket", F.ceil(F.col("m") / F.lit(BLOCK)).alias("blocks"))
    part = named.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    part = part.withColumn("other", other).select("bucket", "band", "node", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    # A task's group holds whole pairs of blocks, about CELL_ROWS rows together.
    part = compact(part)
    cells = part.count() // CELL_ROWS + 1
    part = part.withColumn("cell", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(cells)))
    part = part.join(nodes.select("node", "n", "sketch"), "node").join(sets, "node")
    more = compact(part.groupBy("cell").applyInPandas(_across(percent, least), "a long, b long"))
    found = components(links.union(more))

    rep = nodes.select(F.col("node").alias("x"), "rep").join(found, F.col("x") == F.col("node"), "left").select("x", "rep", F.col("component").alias("c"))
    smallest = rep.filter("c IS NOT NULL").groupBy(F.col("c").alias("of")).agg(F.min("rep").alias("first"))
    named = rep.join(smallest, F.col("c") == F.col("of"), "left").select("x", F.coalesce("first", "rep").alias("first"))
    return each.select("doc_id", "h", "n", "node").join(named, (F.col("node") == F.col("x")) & (F.col("n") > 0), "left").select("doc_id", "h", "n", "first")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_shingles, component_id, kept)."""
    component = F.coalesce("first.doc_id", "doc_id")
    return groups(docs, percent).select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def op8_setsketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of near duplicates (similarity 0.8 and more) stays.

    It is the row of the smallest doc_id; of rows without a doc_id, or of the same
    doc_id, the one of the smallest text hash; of rows that agree in both, any one.
    Null and wordless texts all stay.
    """
    release_driver(spark)
    each = materialize(groups(docs, 80).filter("n > 0"))
    release_driver(spark)
    stands = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h"))
    keys = each.select(F.col("doc_id").alias("_d"), F.col("h").alias("_x"), stands.alias("stands"))
    gone = materialize(keys.filter("NOT stands").select("_d", "_x").distinct())
    several = materialize(keys.filter("stands").groupBy("_d", "_x").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    keyed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    same = lambda side: keyed["_id"].eqNullSafe(side["_d"]) & (keyed["_h"] == side["_x"])
    left = keyed.join(bounded(gone), same(gone), "left_anti")
    if not several.limit(1).count():
        return left.select("_row.*")
    several = bounded(several)
    one = keyed.join(several, same(several), "left_semi").groupBy("_id", "_h").agg(F.first("_row").alias("_row"))
    return left.join(several, left["_id"].eqNullSafe(several["_d"]) & (left["_h"] == several["_x"]), "left_anti").select("_row.*").unionByName(one.select("_row.*"))
