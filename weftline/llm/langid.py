"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of words (a word is a run of letters,
lower-cased, with begin and end marks; contexts do not cross words).  A model is a
set of sorted hash arrays: for each order the n-grams' hashes with their discounted
probabilities, and the contexts' hashes with their interpolation weights; lookups
are binary searches.  The language of a text is the one with the lowest cross
entropy per symbol.  Calibration on learning documents that were left out of the
counts gives the score (a tempered posterior) and, per language, how high the cross
entropy of real text of that length may be; beyond that a text is rejected.

The models are fitted on a bounded sample (``SAMPLE`` documents per language, at most
``SAMPLE_ROWS`` rows and ``LEARN_TOTAL`` bytes in all, in equal shares); every text is
scored whole.

Defined cases: a null text, or one without a letter, is ``und``, rejected, score
0; equal cross entropies go to the first language by name; rows with null lang
or null doc_id are never learned from; with nothing to learn from every text is
``und``; repeated rows are predicted alike; an empty table is empty.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LEARN_BYTES, LEARN_TOTAL, TokenTable, bounded, bucket_of, materialize, release_driver, release_memory, table, text_chunks, texts_within

MODULUS, HELD = 4, 2
SAMPLE = 1_500
SAMPLE_ROWS = 150_000
ORDER = 4
BEGIN, END = "\x02", "\x03"


def _letters() -> re.Pattern:
    """Runs of letters: word characters without the underscore and all numbers, fractions and number signs among them."""
    others = [c for c in range(sys.maxunicode + 1) if chr(c).isalnum() and not chr(c).isalpha()]
    first = [c for i, c in enumerate(others) if not i or others[i - 1] != c - 1]
    last = [c for i, c in enumerate(others) if i + 1 == len(others) or others[i + 1] != c + 1]
    return re.compile(f"[^\\W_{''.join(f'{chr(a)}-{chr(b)}' for a, b in zip(first, last))}]+")


WORD = _letters()
UNKNOWN = "und"
#: Rejected beyond so many standard deviations above the mean cross entropy.
TOLERANCE = 8.0
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def grams(tokens: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the 1- to ORDER-grams that end at each symbol of each token, and the tokens' starts.

    A token's symbols are its letters and the end mark.  Hash k of a symbol
    covers it and the k symbols before it.
    """
    pad = BEGIN * (ORDER - 1)
    sym = np.frombuffer("".join(f"{pad}{t}{END}" for t in tokens).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    at = np.flatnonzero(sym != ord(BEGIN))
    starts = np.flatnonzero(np.concatenate([[True], sym[at[:-1]] == ord(END)])) if len(at) else np.zeros(0, np.int64)
    scattered, total, out = _mixed(sym + np.uint64(0x51ED27)), np.zeros(len(at), np.uint64), []
    for k in range(ORDER):
        total = total + scattered[at - k] * ODD[k]
        out.append(_mixed(total + np.uint64(k)))
    return out, starts


def contexts(tokens: list[str]) -> list[np.ndarray]:
    """Hash k: the k symbols before each symbol (k from 0 to ORDER - 1)."""
    pad = BEGIN * (ORDER - 1)
    sym = np.frombuffer("".join(f"{pad}{t}{END}" for t in tokens).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    at = np.flatnonzero(sym != ord(BEGIN))
    scattered, total, out = _mixed(sym + np.uint64(0x51ED27)), np.zeros(len(at), np.uint64), []
    out.append(_mixed(total))
    for k in range(1, ORDER):
        total = total + scattered[at - k] * ODD[k]
        out.append(_mixed(total + np.uint64(k)))
    return out


class SortedHashes:
    """A sorted array of hashes with one value each; 0 for a hash that isn't there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.float32(0))


class KneserNey:
    def __init__(self, counts: Counter):
        tokens, times = list(counts), np.fromiter(counts.values(), np.float64, len(counts))
        self.gram, self.weight = [], []
        hashes, starts = grams(tokens)
        before = contexts(tokens)
        times = np.repeat(times, np.diff(np.append(starts, len(hashes[0]))))
        for k in range(ORDER):
            if k == ORDER - 1:
                keys, first, inverse = np.unique(hashes[k], return_index=True, return_inverse=True)
                n = np.bincount(inverse, times)
            else:  # of a lower order: how many different symbols precede it
                _, longer = np.unique(hashes[k + 1], return_index=True)
                keys, first, inverse = np.unique(hashes[k][longer], return_index=True, return_inverse=True)
                first, n = longer[first], np.bincount(inverse).astype(np.float64)
            context, of = np.unique(before[k][first], return_inverse=True)
            total, kinds = np.bincount(of, n), np.bincount(of)
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = min(0.95, max(0.4, ones / (ones + 2 * twos))) if ones else 0.4
            self.gram.append(SortedHashes(keys, np.maximum(n - discount, 0) / total[of]))
            self.weight.append(SortedHashes(context, np.minimum(discount * kinds, total) / total))

    def log_prob(self, hashes: list, before: list) -> np.ndarray:
        """hashes, before: per order (distinct keys, places)."""
        p = np.full(len(hashes[0][1]), 1e-4, np.float64)
        for k in range(ORDER):
            (keys, at), (context, back) = hashes[k], before[k]
            weight = self.weight[k](context)
            p = self.gram[k](keys)[at] + np.where(weight > 0, weight, 1.0)[back] * p
        return np.log(p)


class LanguageModel:
    """``texts`` by language; every fifth text calibrates."""

    def __init__(self, texts: dict[str, list[str]]):
        self.names = sorted(n for n, t in texts.items() if any(words(x) for x in t))
        self.models = []
        kept: list[tuple[int, list[str]]] = []
        for at, name in enumerate(self.names):
            counts: Counter = Counter()
            for i, text in enumerate(texts[name]):
                w = words(text)
                if i % 5 == 4 and w and counts:
                    kept.append((at, w))
                else:
                    counts.update(w)
            if not counts:
                counts.update(kept[-1][1])
            self.models.append(KneserNey(counts))
        if self.names:
            self._calibrate(kept)

    def rows(self, tokens: list[str]) -> np.ndarray:
        """Per token: log probability in each language, its squares' sums per symbol, and its number of symbols."""
        hashes, starts = grams(tokens)
        keyed = [np.unique(h, return_inverse=True) for h in hashes]
        before = [np.unique(h, return_inverse=True) for h in contexts(tokens)]
        out = np.empty((len(tokens), len(self.names) + 1))
        for at, m in enumerate(self.models):
            out[:, at] = np.add.reduceat(m.log_prob(keyed, before), starts)
        out[:, -1] = np.diff(np.append(starts, len(hashes[0])))
        return out

    def entropies(self, bags: list[Counter], known: TokenTable) -> tuple[np.ndarray, np.ndarray]:
        """Cross entropy per symbol by language (rows without words: infinite), and symbols."""
        sums = known.pooled(bags)
        if sums.shape[1] == 1:
            return np.full((len(bags), len(self.names)), np.inf), np.zeros(len(bags))
        n = sums[:, -1]
        return np.where(n[:, None] > 0, -sums[:, :-1] / np.maximum(n, 1)[:, None], np.inf), n

    def _calibrate(self, kept: list) -> None:
        self.sharpness, self.mean, self.between, self.within = 4.0, np.full(len(self.names), np.inf), np.ones(len(self.names)), np.ones(len(self.names))
        if not kept:
            return
        truth = np.array([a for a, _ in kept])
        h, n = self.entropies([Counter(w) for _, w in kept], TokenTable(self.rows))
        own = h[np.arange(len(h)), truth]
        grid = np.geomspace(0.25, 16, 25)
        loss = [np.mean(np.log(np.exp(-t * np.sqrt(n)[:, None] * (h - own[:, None])).clip(max=1e30).sum(1))) for t in grid]
        self.sharpness = float(grid[int(np.argmin(loss))])
        for at in range(len(self.names)):
            mine, size = own[truth == at], n[truth == at]
            if len(mine):
                self.mean[at] = np.average(mine, weights=size)
                self.between[at] = max(0.02, float(np.average((mine - self.mean[at]) ** 2, weights=size)) ** 0.5)
                self.within[at] = max(1.0, float(np.mean((mine - self.mean[at]) ** 2 * size)))

    def predict(self, texts: list, known: TokenTable) -> tuple[list, np.ndarray, np.ndarray]:
        """Language, score, rejected."""
        bags = [Counter(words(t)) for t in texts]
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n = self.entropies(bags, known)
        best = h.argmin(1)
        low = h[np.arange(len(h)), best]
        some = n > 0
        gap = np.where(some[:, None], h - np.where(some, low, 0)[:, None], 0)
        score = np.where(some, 1 / np.exp(np.clip(-self.sharpness * np.sqrt(n)[:, None] * gap, -700, 0)).sum(1), 0)
        bound = self.mean[best] + TOLERANCE * np.sqrt(self.between[best] ** 2 + self.within[best] / np.maximum(n, 1))
        return [self.names[b] if s else UNKNOWN for b, s in zip(best, some)], score, ~some | (low > bound)


def train(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Fits on about ``sample`` documents per language, those with the smallest hashes of doc_id."""
    free = docs.select("lang", "doc_id", F.xxhash64("text").alias("_h"), F.octet_length("text").alias("_n")).filter(F.col("lang").isNotNull() & (bucket_of(F.col("doc_id"), MODULUS) != HELD))
    sizes = bounded(materialize(free.groupBy("lang").agg((F.lit(float(sample)) / F.count(F.lit(1))).alias("_part"))))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = free.filter(F.col("_n") <= LEARN_BYTES).join(sizes, "lang").filter(chance < F.col("_part")).select("lang", "doc_id", "_h", "_n")
    rows = rows.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "_h", "lang").limit(SAMPLE_ROWS).collect()
    share, used, wanted = LEARN_TOTAL // max(1, len({r["lang"] for r in rows})), Counter(), []
    for r in rows:
        used[r["lang"]] += r["_n"]
        if used[r["lang"]] <= share:
            wanted.append(r)
    held = texts_within(docs, list(dict.fromkeys((r["doc_id"], r["_h"], r["_n"]) for r in wanted)))
    texts: dict[str, list[str]] = {}
    for r in sorted(wanted, key=lambda r: (r["doc_id"], r["_h"], r["lang"])):
        if (r["doc_id"], r["_h"]) in held:
            texts.setdefault(r["lang"], []).append(held[r["doc_id"], r["_h"]])
    return LanguageModel(texts)


def identify(docs: DataFrame, model: LanguageModel, keep: list[str] = ["doc_id"]) -> DataFrame:
    """The columns ``keep`` of every document, and lang_pred, score, rejected."""

    def run(batches):
        known = TokenTable(model.rows)
        for chunk in text_chunks(batches, "_text"):
            lang, score, rejected = model.predict(chunk.column("_text").to_pylist(), known)
            yield pa.RecordBatch.from_arrays([*(chunk.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=[*keep, "lang_pred", "score", "rejected"])
        known = None
        release_memory()

    given = docs.select(*keep, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return given.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")


def op1_kneser_ney_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = docs.withColumn("held_out", F.coalesce(bucket_of(F.col("doc_id"), MODULUS) == HELD, F.lit(False)))
    return identify(fold, train(docs), ["doc_id", "held_out"])


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: without the documents that language identification rejects.

    Null texts and texts without a letter are rejected; repeated rows share their fate;
    where no row has a lang there is no model, and all are rejected.
    """
    release_driver(spark)
    keyed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    model = train(docs)
    release_driver(spark)  # the texts it was fitted on
    # Only texts go to the models; what they reject comes back as keys.
    told = identify(docs.select("doc_id", "text", F.xxhash64("text").alias("_x")), model, ["doc_id", "_x"]).filter("rejected")
    gone = bounded(materialize(told.select(F.col("doc_id").alias("_d"), "_x").distinct()))
    return keyed.join(gone, keyed["_id"].eqNullSafe(F.col("_d")) & (keyed["_h"] == F.col("_x")), "left_anti").select("_row.*")
