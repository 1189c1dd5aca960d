"""Toxicity by maximum-scoring segments.

Each word gets the log-odds of its rates in toxic and in other learning
documents under an informative Dirichlet prior (the pooled rates); words whose
odds are not significant score as background, and every score is lowered by a
drift, so that the expected score of clean text is negative.  A linear scan
finds all maximal-scoring segments of a document, every toxic passage.  A
segment's score becomes an extreme-value p-value (Karlin-Altschul: lambda from
the clean score distribution, K fitted on clean documents); the passages'
evidence is summed and mapped to a probability by a logistic fit.

Defined cases: null, empty and wordless texts have no segment and get the
no-evidence score; repeated rows score alike; if the learning rows hold one
class only, every score is that class's smoothed rate; ids and further columns
are not looked at; an empty table is empty.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import labelled_sample, scored, table

MODULUS, HELD = 5, 0
SAMPLE = 12_000
THRESHOLD = 0.5
#: Weight of the pooled rates in either side's rates, as a share of all learning words.
PRIOR = 0.1
#: A learning text this similar to an earlier one of its label (in its set of words) is left out of the counts.
COPY, SKETCH = 0.4, 64
SIGNIFICANT = 3.0
DRIFT = 0.25
WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), in linear time.

    Candidates are kept on a list; a new positive score joins the segments to
    its left as far back as the cumulated sums show that joining gains.
    """
    cum = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[list] = []  # start, end, cumulated score before and after, the nearest candidate that begins lower
    for at in np.flatnonzero(scores > 0).tolist():
        piece = [at, at + 1, float(cum[at]), float(cum[at + 1]), -1]
        while True:
            back = len(held) - 1
            while back >= 0 and held[back][2] >= piece[2]:
                back = held[back][4]
            if back < 0 or held[back][3] >= piece[3]:
                break
            piece[0], piece[2] = held[back][0], held[back][2]
            del held[back:]
        piece[4] = back
        held.append(piece)
    return [(a, b, after - before) for a, b, before, after, _ in held]


def without_copies(bags: list[Counter]) -> list[Counter]:
    """Leaves out near copies, whose every word would look significant (minima of hashed words, compared one to all before)."""
    kept, sketches = [], np.zeros((0, SKETCH), np.uint64)
    mult = (np.arange(SKETCH, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for bag in bags:
        codes = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in bag] or [0], np.uint64)
        sketch = (((codes[:, None] + np.uint64(1)) * mult) >> np.uint64(20)).min(0)
        if not len(kept) or (sketches == sketch).mean(1).max() < COPY:
            kept.append(bag)
            sketches = np.concatenate([sketches, sketch[None]])
    return kept


class ToxicityModel:
    def __init__(self, texts: list[str], labels: list[int]):
        y = np.array(labels, int)
        bags = [Counter(words(t)) for t in texts]
        self.rate = (y.sum() + 1) / (len(y) + 2)
        self.gain: dict[str, float] = {}
        self.fit = None
        if y.min(initial=1) == y.max(initial=0) or not len(y):
            return
        # A document counts a word once, so that one long text does not make a word toxic.
        toxic = [b for b, t in zip(bags, y) if t]
        sides = [Counter(w for b, t in zip(bags, y) if not t for w in b), Counter(w for b in without_copies(toxic) for w in b)]
        pooled = sides[0] + sides[1]
        n = [sides[0].total(), sides[1].total()]
        prior = PRIOR * pooled.total()
        for w, c in pooled.items():
            a = PRIOR * c
            t, o = sides[1][w] + a, sides[0][w] + a
            odds = math.log(t / (n[1] + prior - t)) - math.log(o / (n[0] + prior - o))
            if odds / math.sqrt(1 / t + 1 / o) >= SIGNIFICANT and odds > DRIFT:
                self.gain[w] = odds - DRIFT
        clean = [b for b, t in zip(bags, y) if not t]
        self.scale = self._lambda(clean)
        self.k = self._k([t for t, side in zip(texts, y) if not side])
        x = np.array([self.evidence(t) for t in texts])
        self.fit = self._logistic(x, y)

    def _lambda(self, clean: list[Counter]) -> float:
        """The positive root of E[exp(lambda * score)] = 1 over the words of clean text."""
        mass = Counter()
        for bag in clean:
            for w, c in bag.items():
                mass[self.gain.get(w, -DRIFT)] += c
        values, weight = np.array(list(mass), float), np.array(list(mass.values()), float)
        # At least a pseudo-count of each gain, so that lambda is finite.
        gains = np.array(sorted(self.gain.values()) or [1.0])
        values, weight = np.concatenate([values, gains, [-DRIFT]]), np.concatenate([weight, np.full(len(gains), 0.5), [1.0]])
        weight /= weight.sum()
        low, high = 1e-6, 50.0
        for _ in range(80):
            mid = (low + high) / 2
            with np.errstate(over="ignore"):
                low, high = (low, mid) if weight @ np.exp(mid * values) > 1 else (mid, high)
        return max(low, 1e-3)

    def _k(self, clean: list[str]) -> float:
        """K at which the expected number of chance segments in clean text is that seen."""
        length = seen = 0
        for t in clean:
            n, segments = self.segments(t)
            length += n
            seen += len(segments)
        return (seen + 0.5) / (length + 1)

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and the maximal segments (word positions)."""
        found = words(text)
        if self.gain.keys().isdisjoint(found):
            return len(found), []
        gain = self.gain
        return len(found), maximal_segments(np.array([gain.get(w, -DRIFT) for w in found]))

    def evidence(self, text: str | None) -> float:
        """Sum over segments of -log(p), p being the extreme-value tail of the segment's score."""
        n, segments = self.segments(text)
        out = 0.0
        for _, _, s in segments:
            expected = self.k * n * math.exp(-self.scale * s)
            out += -math.log(max(-math.expm1(-expected), 1e-12))
        return out

    @staticmethod
    def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
        """Slope and intercept of P(toxic) by evidence, by ridge-damped Newton steps."""
        design, w = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), design.T @ (y - p) - 1e-2 * w)
            w += np.clip(step, -2, 2)
        return float(w[0]), float(w[1])

    def score(self, texts: list) -> np.ndarray:
        if self.fit is None:
            return np.full(len(texts), self.rate)
        z = np.array([self.evidence(t) for t in texts]) * self.fit[0] + self.fit[1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    rows = labelled_sample(docs, labels, "toxic", MODULUS, HELD, sample)
    return ToxicityModel([t for t, _ in rows], [v for _, v in rows])


def op5_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model.score, MODULUS, HELD, THRESHOLD)
