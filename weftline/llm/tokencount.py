"""Token counts by a trie-shared dynamic program.

The vocabulary is a public piece model's; a piece's unigram score is the natural
logarithm of 1 / (rank + 2), rank being its place in the model (the pieces stand
by frequency there), and nothing is trained.  A text is split at white space; a
pre-token starts with the word mark.  Distinct pre-tokens of a batch go into a
trie; the best forward score and its number of pieces are computed once per trie
node, so a shared prefix costs once, and the terminal nodes' counts are stored.
A character that no piece covers counts one token per UTF-8 byte (byte fallback).

Ties: the fewer tokens win, so the count never depends on the order of pieces.
Pre-tokens longer than ``CUT`` characters go through the same recurrence on their own,
with a window of the longest piece, so that the trie's depth and the table of counted
pre-tokens stay bounded.

Defined cases: null and empty texts have 0 tokens; ids and further columns pass
through untouched; repeated rows are counted each; an empty table is empty.
"""

from __future__ import annotations

import math
import os
from collections import Counter, deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import TokenTable, table, text_chunks

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
MODEL = "piece_bpe_32k.model"
MARK = "▁"
CUT = 512
UNKNOWN = -40.0
#: Pre-tokens whose counts a worker keeps.
CAPACITY = 1_000_000


def vocabulary(path: str) -> dict[str, float]:
    """Piece -> unigram score; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return {model.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(plain)}


class TrieCounter:
    """Forward scores over a trie of pre-tokens."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        self.tails = {p[i:] for p in pieces for i in range(len(p))}

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token (given without the word mark)."""
        root: dict = {}
        ends = []
        for at, word in enumerate(words):
            node = root
            for ch in MARK + word:
                node = node.setdefault(ch, {})
            ends.append((at, node))
        terminal: dict[int, list[int]] = {}
        for at, node in ends:
            terminal.setdefault(id(node), []).append(at)
        out = np.zeros(len(words), np.int64)
        pieces, longest, tails = self.pieces, self.longest, self.tails
        # A path in hand: the prefix, and for each of its lengths (-score, tokens).
        stack = [(root, "", 0)]
        best: list[tuple[float, int]] = [(0.0, 0)]
        path: list[str] = []
        while stack:
            node, ch, depth = stack.pop()
            if depth:
                del path[depth - 1 :], best[depth:]
                path.append(ch)
                cost, n = best[depth - 1]
                top = (cost - UNKNOWN, n + (len(ch.encode("utf-8", "surrogatepass")) if ch not in pieces else 1))
                if ch in pieces:
                    top = (cost - pieces[ch], n + 1)
                tail = ch
                for start in range(depth - 2, max(-1, depth - longest - 1), -1):
                    tail = path[start] + tail
                    if tail not in tails:
                        break  # nor is anything longer the end of a piece
                    score = pieces.get(tail)
                    if score is not None:
                        cost, n = best[start]
                        if (other := (cost - score, n + 1)) < top:
                            top = other
                best.append(top)
                if id(node) in terminal:
                    for at in terminal[id(node)]:
                        out[at] = top[1]
            for c, child in node.items():
                stack.append((child, c, depth + 1))
        return out


    def count_long(self, word: str) -> int:
        """Tokens of one pre-token, without a trie."""
        pieces, longest, tails = self.pieces, self.longest, self.tails
        s = MARK + word
        best: deque[tuple[float, int]] = deque([(0.0, 0)], maxlen=longest)
        for at, ch in enumerate(s):
            cost, n = best[-1]
            top = (cost - pieces[ch], n + 1) if ch in pieces else (cost - UNKNOWN, n + len(ch.encode("utf-8", "surrogatepass")))
            for size in range(2, min(longest, at + 1) + 1):
                tail = s[at + 1 - size : at + 1]
                if tail not in tails:
                    break  # nor is anything longer the end of a piece
                score = pieces.get(tail)
                if score is not None:
                    cost, n = best[-size]
                    if (other := (cost - score, n + 1)) < top:
                        top = other
            best.append(top)
        return best[-1][1]


@lru_cache(maxsize=1)
def worker_table(path: str) -> tuple[TrieCounter, TokenTable]:
    """The pre-tokens counted so far by this worker process; its tasks share it."""
    counter = TrieCounter(vocabulary(path))
    return counter, TokenTable(lambda words: counter.counts(words)[:, None].astype(np.float64), CAPACITY)


def count_tokens(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_pretokens, n_tokens), one row per document."""
    path = model_path or os.path.join(TOKENIZERS, MODEL)

    def run(batches):
        counter, known = worker_table(path)
        for chunk in text_chunks(batches):
            words = [t.split() if t else [] for t in chunk.column("text").to_pylist()]
            sums = known.pooled([Counter(w for w in ws if len(w) <= CUT) for ws in words])[:, 0]
            sums = sums + [sum(counter.count_long(w) for w in ws if len(w) > CUT) for ws in words]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array([len(ws) for ws in words], pa.int64()), pa.array(np.rint(sums).astype(np.int64))], names=["doc_id", "n_pretokens", "n_tokens"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_pretokens long, n_tokens long")


def op4_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
