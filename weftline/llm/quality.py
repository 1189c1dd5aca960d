"""Quality classifier: random-indexing word vectors, pooled, and a small network.

A text is read as parts: words (in lower case, each with its letter case as a part
of its own) and runs of marks.  Each part has a sparse ternary index vector made
from its hash; a part's word vector is the sum of the index vectors around it in the
learning texts (random indexing).  A document is pooled as the mean vector of all
its parts plus a few whole-document shares (repeated lines and sentences, cases,
marks).  A two-layer numpy network reads the pooled vector, and a temperature
fitted on a calibration part of the learning rows makes its outputs probabilities.

Defined cases: null, empty and wordless texts pool to zero and get the network's
answer to that; repeated rows score alike; with one class among the learning
rows every score is its smoothed rate; an empty table is empty.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import labelled_sample, scored, table

MODULUS, HELD = 4, 2
SAMPLE = 8_000
THRESHOLD = 0.7
DIM, NONZERO, WINDOW = 64, 6, 2
HIDDEN, EPOCHS, RATE = 24, 120, 0.01
VOCABULARY = 10_000
PART = re.compile(r"[^\W_]+|[^\w\s]{1,3}|_+")
SENTENCE = re.compile(r"[.!?]\s+|\n+")
CASES = ("<low>", "<cap>", "<up>", "<other>")


def case_of(core: str) -> int:
    if core.islower():
        return 0
    if core.isupper():
        return 2 if len(core) > 1 else 1
    return 1 if core[0].isupper() and core[1:].islower() else 3


def index_vectors(parts: list[str]) -> np.ndarray:
    """Sparse ternary vectors made from the parts' hashes."""
    code = np.array([zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in parts], np.uint64)
    out, row = np.zeros((len(parts), DIM), np.float32), np.arange(len(parts))
    for k in range(NONZERO):
        h = (code + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        out[row, (h >> np.uint64(40)).astype(np.int64) % DIM] += np.where(h >> np.uint64(63), 1, -1)
    return out


def shares(text: str, bag: Counter) -> list[float]:
    """Whole-document shares that no single word shows."""
    total = max(1, bag.total())
    lines = [x for x in text.split("\n") if x.strip()]
    sentences = [x for x in SENTENCE.split(text) if x.strip()]
    return [
        1 - len(set(lines)) / max(1, len(lines)),
        1 - len(set(sentences)) / max(1, len(sentences)),
        1 - len(bag) / total,
        max(bag.values(), default=0) / total,
        np.log1p(bag.total()) / 10,
        len(lines) / total,
    ]


class WordVectors:
    """Random-indexing vectors of the frequent parts of the learning texts.

    A part is a word or a run of marks.  In the stream that is indexed, a word is
    preceded by its letter case, so cases have word vectors too.
    """

    def __init__(self, texts: list[str]):
        streams = []
        for t in texts:
            stream: list[str] = []
            for p in PART.findall(t):
                stream += (CASES[case_of(p)], p.lower()) if p[0].isalnum() else (p,)
            streams.append(stream)
        df = Counter(p for s in streams for p in set(s))
        frequent = sorted((x for x in df.items() if x[1] > 1 and x[0] not in CASES), key=lambda x: (-x[1], x[0]))[:VOCABULARY]
        self.names = [*CASES, *(p for p, _ in frequent)]
        index = dict(zip(self.names, range(len(self.names))))
        base = index_vectors(self.names)
        vectors = base.copy()
        for s in streams:
            ids = np.array([i for p in s if (i := index.get(p)) is not None], np.int64)
            for gap in range(1, WINDOW + 1):
                for a, b in ((ids[:-gap], ids[gap:]), (ids[gap:], ids[:-gap])):
                    if len(a):
                        order = np.argsort(a, kind="stable")
                        starts = np.flatnonzero(np.diff(a[order], prepend=-1))
                        vectors[a[order][starts]] += np.add.reduceat(base[b[order]], starts, axis=0)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        # A word vector keeps its own index vector beside its contexts, or marks that stand among all words would look like them.
        self.vectors = np.concatenate([vectors, base / np.sqrt(NONZERO)], axis=1)
        self.forms = None

    def _expand(self) -> None:
        """Rows for the written forms of each word, with the case's vector added; the first four stand for unknown words."""
        v, forms, rows = self.vectors, {}, [*self.vectors[:4]]
        for i, name in enumerate(self.names[4:], 4):
            if name[0].isalnum():
                for form in dict.fromkeys((name, name.capitalize(), name.upper())):
                    forms[form] = len(rows)
                    rows.append(v[i] + v[case_of(form)])
            else:
                forms[name] = len(rows)
                rows.append(v[i])
        self.forms, self.rows = forms, np.array(rows, np.float32)

    def pooled(self, bags: list[Counter]) -> np.ndarray:
        """For each bag of written forms the mean vector of its parts."""
        if self.forms is None:
            self._expand()
        out, get = np.zeros((len(bags), self.rows.shape[1])), self.forms.get
        for at, bag in enumerate(bags):
            if bag:
                ids = [get(p, -1) for p in bag]
                if -1 in ids:
                    # An unknown word shows its case only; unknown marks show as the case "other".
                    ids = [i if i >= 0 else case_of(p) for i, p in zip(ids, bag)]
                counts = np.fromiter(bag.values(), np.float32, len(bag))
                out[at] = counts @ self.rows[ids] / counts.sum()
        return out


class QualityModel:
    def __init__(self, texts: list[str], labels: list[int], seed: int = 7):
        y = np.array(labels, np.float64)
        self.rate = (y.sum() + 1) / (len(y) + 2)
        self.net = None
        if not len(y) or y.min() == y.max():
            return
        self.words = WordVectors(texts)
        x = self.pool(texts)
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.spread
        rng = np.random.default_rng(seed)
        part = rng.permutation(len(y))
        calibrate, learn = part[: max(1, len(y) // 5)], part[max(1, len(y) // 5) :]
        self.net = self._train(x[learn], y[learn], rng)
        self.temperature = self._temperature(self._logit(x[calibrate]), y[calibrate])

    def pool(self, texts: list) -> np.ndarray:
        bags = [Counter(PART.findall(t)) if t else Counter() for t in texts]
        return np.concatenate([self.words.pooled(bags), np.array([shares(t or "", b) for t, b in zip(texts, bags)]).reshape(len(texts), -1)], axis=1)

    @staticmethod
    def _train(x: np.ndarray, y: np.ndarray, rng) -> list[np.ndarray]:
        net = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        first, second, step = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for at in range(0, len(y), 256):
                rows = order[at : at + 256]
                h = np.tanh(x[rows] @ net[0] + net[1])
                p = 1 / (1 + np.exp(-np.clip(h @ net[2] + net[3], -30, 30)))
                d = (p - y[rows]) / len(rows)
                back = d[:, None] * net[2] * (1 - h * h)
                grads = [x[rows].T @ back + 1e-3 * net[0], back.sum(0), h.T @ d + 1e-3 * net[2], d.sum(keepdims=True)]
                step += 1
                for i, g in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    net[i] = net[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        return net

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.net[0] + self.net[1]) @ self.net[2] + self.net[3]

    @staticmethod
    def _temperature(z: np.ndarray, y: np.ndarray) -> float:
        grid = np.geomspace(0.25, 8, 121)
        loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
        return float(grid[int(np.argmin(loss))])

    def score(self, texts: list) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.rate)
        x = (self.pool(texts) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(self._logit(x) / self.temperature, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    rows = labelled_sample(docs, labels, "quality", MODULUS, HELD, sample)
    return QualityModel([t for t, _ in rows], [v for _, v in rows])


def op2_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model.score, MODULUS, HELD, THRESHOLD)
