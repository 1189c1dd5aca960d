"""Exact top-k inner-product search on a bit-sliced index.

Components are quantised to floor(scale * x).  A block of rows holds, for each
dimension and bit, one bitmap over its rows.  A query's score is the weighted sum
of those slices, taken by carry-save adders on bitmaps; a negative weight uses the
complemented slices, so that only additions occur.  The k best rows are selected
from the most significant score slice downward; the rows on the boundary are
resolved by smaller id.  A query meets every block, and the blocks' winners are
merged, so the result is exact.

The index is built once: a stored row per block, with its slices, ids and codes (in
as few bytes as they need).  Row blocks and query blocks have bounded sizes; each
pair of blocks is a task's work, and nothing is broadcast but tables of counted size.

Defined cases: rows with a null id, or a null, empty or non-finite vector take no
part; vectors of different lengths never meet; codes are exact in 64 bits, as DOUBLE to
BIGINT gives them, and so is their order, whatever the sum; a score beyond 64 bits is
returned as the nearest one within; a query with fewer than k candidates returns them
all; repeated rows are candidates of each other; equal scores go to the smaller id, then
to any row of it; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table, written

SCALE = 64
K = 20
QUERY_EVERY = 20
#: Rows and components of a row block, and queries of a query block.
BLOCK_ROWS = 65_536
BLOCK_CELLS = 8_000_000
BLOCK_QUERIES = 512
MOST_TASKS = 10_000
LIMIT = (1 << 63) - 1


class BitSlices:
    """Bit-sliced index of a block: ``codes`` is (rows, dims), int64."""

    def __init__(self, rows: int, dims: int, bits: int, slices: np.ndarray):
        self.rows, self.dims, self.bits = rows, dims, bits
        self.words = -(-rows // 64)
        self.live = self.bitmap(np.arange(self.words * 64) < rows)
        self.slices = np.stack([slices, ~slices & self.live])

    @classmethod
    def of(cls, codes: np.ndarray) -> BitSlices:
        rows, dims = codes.shape
        words = -(-rows // 64)
        low = codes.min()
        # The distance from the least code, which 64 bits hold without a sign.
        padded = np.zeros((dims, words * 64), np.uint64)
        padded[:, :rows] = (codes.astype(np.uint64) - low.astype(np.uint64)).T
        bits = max(1, int(padded.max()).bit_length())
        slices = np.empty((dims, bits, words), np.uint64)
        for b in range(bits):
            slices[:, b] = cls.bitmap(padded >> np.uint64(b) & np.uint64(1))
        return cls(rows, dims, bits, slices)

    def packed(self) -> bytes:
        return self.slices[0].tobytes()

    @classmethod
    def unpacked(cls, rows: int, dims: int, bits: int, data: bytes) -> BitSlices:
        return cls(rows, dims, bits, np.frombuffer(data, np.uint64).reshape(dims, bits, -(-rows // 64)))

    @staticmethod
    def bitmap(flags: np.ndarray) -> np.ndarray:
        return np.packbits(flags.astype(np.uint8), axis=-1, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, least significant first, of a score that orders the rows as the inner product does."""
        planes: dict[int, list] = {}
        size = np.where(query < 0, np.uint64(0) - query.astype(np.uint64), query.astype(np.uint64))
        for shift in range(int(size.max(initial=0)).bit_length()):
            for negative in (0, 1):
                dims = np.flatnonzero((size >> np.uint64(shift) & np.uint64(1)).astype(bool) & ((query < 0) == bool(negative)))
                if len(dims):
                    for b in range(self.bits):
                        planes.setdefault(shift + b, []).append(self.slices[negative, dims, b])
        out, weight = [], 0
        while planes and weight <= max(planes):
            held = planes.pop(weight, [])
            if held:
                total, carries = self.add(np.concatenate(held))
                out.append(total)
                if carries:
                    planes.setdefault(weight + 1, []).extend(carries)
            else:
                out.append(np.zeros(self.words, np.uint64))
            weight += 1
        return out

    @staticmethod
    def add(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sum slice and carry slices of bitmaps of one weight (full adders, then a half adder)."""
        carries = []
        while len(x) > 2:
            t = len(x) // 3
            a, b, c = x[:t], x[t : 2 * t], x[2 * t : 3 * t]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            x = np.concatenate([odd ^ c, x[3 * t :]])
        if len(x) == 2:
            carries.append(x[:1] & x[1:])
            return x[0] ^ x[1], carries
        return x[0], carries

    def top(self, query: np.ndarray, k: int, own: int | None) -> np.ndarray:
        """Positions of the k best rows, the boundary's lowest positions first; ``own`` takes no part."""
        tied = self.live.copy()
        if own is not None:
            tied[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        sure, n_sure = np.zeros_like(tied), 0
        for plane in reversed(self.scores(query)):
            both = tied & plane
            n = int(np.bitwise_count(both).sum())
            if n_sure + n > k:
                tied = both
            else:
                sure |= both
                n_sure += n
                tied &= ~plane
            if n_sure == k:
                break
        picked = self.positions(sure)
        return np.concatenate([picked, self.positions(tied, k - n_sure)]) if n_sure < k else picked

    def positions(self, bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
        at = np.flatnonzero(bitmap)
        if most is not None:
            at = at[:most]
        bits = np.unpackbits(bitmap[at].view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")
        row, bit = np.nonzero(bits)
        return (at[row] * 64 + bit)[:most]


def _narrow(codes: np.ndarray) -> np.ndarray:
    """The codes in the smallest signed integers that hold them."""
    low, high = codes.min(initial=0), codes.max(initial=0)
    return codes.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _unpacked(data: bytes, width: str, dims: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(width)).reshape(-1, dims).astype(np.int64)


def _index(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row per block: its slices, and the rows' ids and codes in id order."""
    pdf = pdf.sort_values(["vec_id", "rid"], ignore_index=True)
    codes = np.array(pdf["codes"].tolist(), np.int64)
    slices, narrow = BitSlices.of(codes), _narrow(codes)
    row = (int(pdf["dim"].iloc[0]), int(pdf["rb"].iloc[0]), len(pdf), slices.bits, slices.packed(), pdf["vec_id"].to_numpy(np.int64).tobytes(), pdf["rid"].to_numpy(np.int64).tobytes(), narrow.dtype.str, narrow.tobytes())
    return pd.DataFrame([row], columns=["dim", "rb", "n", "bits", "slices", "ids", "rids", "width", "codes"])


def _asked(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row per block of queries."""
    codes = _narrow(np.array(pdf["codes"].tolist(), np.int64))
    row = (int(pdf["dim"].iloc[0]), int(pdf["qb"].iloc[0]), pdf["vec_id"].to_numpy(np.int64).tobytes(), pdf["rid"].to_numpy(np.int64).tobytes(), codes.dtype.str, codes.tobytes())
    return pd.DataFrame([row], columns=["dim", "qb", "q_ids", "q_rids", "q_width", "q_codes"])


def _scored(codes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products; where 64 bits could overflow they are taken in unbounded integers and cut to 64 bits."""
    if int(np.abs(codes.astype(np.float64)).max(initial=0)) * int(np.abs(q.astype(np.float64)).max(initial=0)) * len(q) < 1 << 62:
        return codes @ q
    return np.array([max(-LIMIT - 1, min(LIMIT, sum(a * b for a, b in zip(map(int, c), map(int, q))))) for c in codes], np.int64)


def _search(k: int):
    """The k best rows for each query of a pair of a row block and a query block."""

    def run(blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "rid", "vec_id", "score")})]
        for row, asked in zip(blocks.itertuples(), queries.itertuples()):
            index = BitSlices.unpacked(row.n, row.dim, row.bits, row.slices)
            ids, rids, codes = np.frombuffer(row.ids, np.int64), np.frombuffer(row.rids, np.int64), _unpacked(row.codes, row.width, row.dim)
            place = dict(zip(rids.tolist(), range(row.n)))
            for qid, rid, q in zip(np.frombuffer(asked.q_ids, np.int64).tolist(), np.frombuffer(asked.q_rids, np.int64).tolist(), _unpacked(asked.q_codes, asked.q_width, row.dim)):
                at = index.top(q, k, place.get(rid))
                found.append(pd.DataFrame({"query_id": qid, "rid": rid, "vec_id": ids[at], "score": _scored(codes[at], q)}))
        return pd.concat(found)

    return run


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding) -> (vec_id, codes, dim, rid) of the rows that take part."""
    x = F.col("embedding")
    fit = F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    # The largest double under 2**63, so that the cast never overflows.
    most = float(LIMIT + 1 - 1024)
    code = F.transform(x, lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(most)), F.lit(-most))).cast("long"))
    vectors = vectors.select("vec_id", "embedding")
    return vectors.filter(fit).select(F.col("vec_id").cast("long").alias("vec_id"), code.alias("codes"), F.size(x).alias("dim"), F.monotonically_increasing_id().alias("rid"))


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The k best other rows for each row for which ``is_query(vec_id)`` holds."""
    rows = materialize(quantised(vectors, scale))
    spread = F.xxhash64("rid")
    sizes = materialize(rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query(F.col("vec_id"))).alias("nq")).select(
        F.col("dim").alias("d"),
        F.greatest(F.ceil(F.col("n") / F.least(F.lit(block_rows), F.greatest(F.lit(64), F.lit(BLOCK_CELLS) / F.col("dim")))), F.lit(1)).alias("row_blocks"),
        F.greatest(F.ceil(F.col("nq") / F.lit(block_queries)), F.lit(1)).alias("query_blocks"),
    ))
    sized = rows.join(sizes, F.col("dim") == F.col("d"))
    blocks = sized.withColumn("rb", F.pmod(spread, F.col("row_blocks"))).select("dim", "rb", "vec_id", "rid", "codes").groupBy("dim", "rb")
    index = written(blocks.applyInPandas(_index, "dim int, rb long, n int, bits int, slices binary, ids binary, rids binary, width string, codes binary"), "slices")
    queries = sized.filter(is_query(F.col("vec_id"))).withColumn("qb", F.pmod(spread, F.col("query_blocks"))).select("dim", "qb", "vec_id", "rid", "codes").groupBy("dim", "qb")
    asked = written(queries.applyInPandas(_asked, "dim int, qb long, q_ids binary, q_rids binary, q_width string, q_codes binary"), "queries")
    # Every block of queries meets every block of rows of its length; a group is one pair.
    part, other = ["dim", "rb", "qb"], sizes.withColumnRenamed("d", "dim")
    fan = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    pairs = int(other.agg(F.sum(F.col("row_blocks") * F.col("query_blocks"))).first()[0] or 1)
    tasks = min(3 * pairs, MOST_TASKS)
    r = index.join(other, "dim").withColumn("qb", fan("query_blocks")).drop("row_blocks", "query_blocks").repartition(tasks, *part)
    q = asked.join(other, "dim").withColumn("rb", fan("row_blocks")).drop("row_blocks", "query_blocks").repartition(tasks, *part)
    found = r.groupBy(*part).cogroup(q.groupBy(*part)).applyInPandas(_search(k), "query_id long, rid long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), lambda v: v % QUERY_EVERY == 0)


ORACLE_SQL = f"""
WITH fit AS (SELECT vec_id, row_number() OVER () rid, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) codes FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
pairs AS (SELECT q.vec_id query_id, q.rid, c.vec_id, list_sum(list_transform(range(1, len(q.codes) + 1), lambda i: q.codes[i] * c.codes[i]))::BIGINT score
  FROM fit q JOIN fit c ON q.rid <> c.rid AND len(q.codes) = len(c.codes) WHERE q.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, rank::INT rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) rank FROM pairs) WHERE rank <= {K}
"""
