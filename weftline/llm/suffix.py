"""Substring deduplication by hash-compared suffix sorting.

Every byte that a ``width``-byte string covers which also starts in a document with
a smaller doc_id is removed.  Equal strings choose the same anchor, the k-gram of
least hash among those inside them, so the strings of a document are runs around
anchors.  Three steps, each dealt by hash over as many parts as the bytes ask for:

Exact copies of a document with a smaller doc_id are removed whole and take no part.

1. Anchors: each part sends the hashes of its documents' anchors, each once; those that
   two different texts have go back to the parts.
2. Suffix sort: each part sends the bytes around its shared anchors, equal ones once
   with their smallest document; where they stand stays with the part.  Per anchor, the suffixes that begin at it, and the reversed
   prefixes that end there, are merge-sorted; two suffixes are compared by the
   length of their common extension, found by binary search on prefix polynomial
   hashes; the final neighbours' extensions are verified on the bytes (on a hash
   collision the bytes are sorted themselves).  A string of the run is then a pair of
   intervals of the two orders, and its smallest document is a grouped minimum.
3. Marks: which document has a stretch's strings first goes back to the parts that sent it.

A task holds one part: about ``PART_BYTES`` of text, or the anchors or stretches of
as much; work inside it goes on in pieces of ``CHUNK_BYTES``.  However many documents
share a passage, a part sends it once, so the group of its anchor grows by about a
hundred bytes with each ``PART_BYTES`` of text.  Equal hashes of stretches, as of
suffixes, are verified on the bytes.

Defined cases: null text is empty; texts under ``width`` bytes lose nothing; rows
with a null doc_id come after all others and are not compared with each other;
rows of the same doc_id never remove from one another; an empty table is empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, materialize, split_join, table, written
from .rolling import Prefix, mixed

WIDTH = 50
GRAM = 20
REACH = WIDTH - GRAM
PART_BYTES = 4_000_000
LEAST_PARTS = 24
#: A longer document is searched for anchors in overlapping pieces of so many bytes.
PIECE = 1 << 22
POSITION = np.uint64((1 << 24) - 1)
NO_ID = np.iinfo(np.int64).max


def anchors(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor, in documents that lie one after another in ``data``.

    Returns the document, the anchor's position, its hash, and the first and last
    start of the run's strings (positions in ``data``).
    """
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if len(data) < WIDTH:
        return empty
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = np.arange(len(data) - GRAM + 1)
    grams = mixed(Prefix(data).of(at, at + GRAM))
    low = (grams & ~POSITION) | at.astype(np.uint64)
    span = 1
    while 2 * span <= REACH + 1:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if (rest := REACH + 1 - span) > 0:
        low = np.minimum(low[:-rest], low[rest:])
    room = np.maximum(lengths - WIDTH + 1, 0)
    owner = np.repeat(np.arange(len(lengths)), room)
    string = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room) + np.repeat(starts, room)
    if not len(string):
        return empty
    anchor = (low[string] & POSITION).astype(np.int64)
    fresh = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.append(fresh[1:], len(string)) - 1
    return owner[fresh], anchor[fresh], grams[anchor[fresh]], string[fresh], string[last]


def pieces(texts: list[bytes]):
    """(indices of the texts, offsets in them, bytes, lengths) of about CHUNK_BYTES; long texts in overlapping pieces."""
    held, size = [], 0
    for at, text in enumerate(texts):
        for begin in range(0, max(len(text) - WIDTH + 1, 1), PIECE):
            part = text[begin : begin + PIECE + WIDTH - 1]
            if held and size + len(part) > CHUNK_BYTES:
                yield _piece(held)
                held, size = [], 0
            held.append((at, begin, part))
            size += len(part)
    if held:
        yield _piece(held)


def _piece(held: list) -> tuple:
    return np.array([h[0] for h in held]), np.array([h[1] for h in held]), np.frombuffer(b"".join(h[2] for h in held), np.uint8), np.array([len(h[2]) for h in held])


def _slot(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of an anchor, and the hash that names it there."""
    return (gram % np.uint64(buckets)).astype(np.int64), (gram >> np.uint64(32)).astype(np.uint32)


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins in sorted arrays, and their end."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.zeros(n, bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change), n)


def _send(buckets: int):
    """Per bucket, the anchors of a part of documents as (name, hash of the text): an anchor's smallest and largest hash only."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = [t or b"" for t in pdf["text"]]
        code, found = pdf["code"].to_numpy(np.int64).view(np.uint64), [np.zeros((2, 0), np.uint64)]
        for index, _, data, lengths in pieces(texts):
            owner, _, gram, _, _ = anchors(data, lengths)
            found.append(np.stack([gram, code[index[owner]]]))
        gram, code = np.concatenate(found, axis=1)
        bucket, name = _slot(gram, buckets)
        order = np.lexsort((code, name, bucket))
        bucket, name, code = bucket[order], name[order], code[order]
        edge = _edges(bucket, name)
        first, last = edge[:-1], edge[1:] - 1
        keep = np.unique(np.concatenate([first, last[code[last] != code[first]]]))
        bucket, name, code = bucket[keep], name[keep], code[keep]
        edge = _edges(bucket)
        part = int(pdf["part"].iloc[0])
        rows = [(int(bucket[a]), part, name[a:b].tobytes(), code[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:])]
        return pd.DataFrame(rows, columns=["bucket", "part", "names", "codes"])

    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """The anchors of a bucket that more than one text has, back to the parts that have them."""
    name, code = np.frombuffer(b"".join(pdf["names"]), np.uint32), np.frombuffer(b"".join(pdf["codes"]), np.uint64)
    part = np.repeat(pdf["part"].to_numpy(), [len(n) // 4 for n in pdf["names"]])
    order = np.argsort(name, kind="stable")
    name, code, part = name[order], code[order], part[order]
    edge = _edges(name)
    several = np.minimum.reduceat(code, edge[:-1]) != np.maximum.reduceat(code, edge[:-1]) if len(name) else np.zeros(0, bool)
    keep = np.repeat(several, np.diff(edge))
    name, part = name[keep], part[keep]
    order = np.lexsort((name, part))
    name, part = name[order], part[order]
    edge, bucket = _edges(part), int(pdf["bucket"].iloc[0])
    rows = [(int(part[a]), bucket, np.unique(name[a:b]).tobytes()) for a, b in zip(edge[:-1], edge[1:])]
    return pd.DataFrame(rows, columns=["part", "bucket", "names"])


def _copies(docs: pd.DataFrame, extra: pd.DataFrame) -> np.ndarray:
    """Which of the part's rows are exact copies; these come in rows of their own, as id and SHA-256 of the text."""
    named = {bytes(c) for x in extra["copies"] if x is not None for c in x}
    ids = {c[:8] for c in named}
    keys = (int(i).to_bytes(8, "big", signed=True) for i in docs["id"])
    return np.array([k in ids and k + hashlib.sha256(t or b"").digest() in named for k, t in zip(keys, docs["text"])], bool)


def _ordered(docs: pd.DataFrame, copies: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Ids and texts of a part without its copies, in an order that only depends on its rows."""
    docs = docs[~copies]
    docs = docs.assign(text=[t or b"" for t in docs["text"]]).sort_values(["id", "text"], ignore_index=True)
    return docs["id"].to_numpy(), docs["text"].tolist()


def same_stretches(data: np.ndarray, start: np.ndarray, length: np.ndarray, left: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leads and, for each stretch of bytes, its lead; equal hashes are verified on the bytes."""
    _, lead, of = np.unique(key, return_index=True, return_inverse=True)
    column = np.arange(WIDTH + REACH)
    padded = np.append(data, np.zeros(len(column), np.uint8))
    row = lambda at: np.where(column < length[at][:, None], padded[start[at][:, None] + column], 0)
    other = np.flatnonzero(lead[of] != np.arange(len(key)))
    for at in range(0, len(other), 65_536):
        a = other[at : at + 65_536]
        b = lead[of[a]]
        if (length[a] != length[b]).any() or (left[a] != left[b]).any() or (row(a) != row(b)).any():
            whole = np.concatenate([length[:, None], left[:, None], row(np.arange(len(key)))], axis=1)
            _, lead, of = np.unique(whole, axis=0, return_index=True, return_inverse=True)
            return lead, of.ravel()
    return lead, of


def _key(prefix: Prefix, start: np.ndarray, run: np.ndarray, left: np.ndarray) -> np.ndarray:
    return mixed(prefix.of(start, start + run + WIDTH) + (left << 8 | run).astype(np.uint64))


def _contexts(buckets: int):
    """The bytes around a part's shared anchors, per bucket: equal ones once, with their smallest document and whether they have more; and all their places."""

    def run(docs: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        out = []
        copies = _copies(docs, shared)
        shared = shared[shared["names"].notna()]
        if len(docs) and len(shared):
            part = int(docs["part"].iloc[0])
            ids, texts = _ordered(docs, copies)
            wanted = np.unique(np.concatenate([(np.uint64(b) << np.uint64(32)) | np.frombuffer(n, np.uint32).astype(np.uint64) for b, n in zip(shared["bucket"], shared["names"])]))
            for index, offset, data, lengths in pieces(texts):
                owner, at, gram, first, last = anchors(data, lengths)
                bucket, name = _slot(gram, buckets)
                keys = (bucket.astype(np.uint64) << np.uint64(32)) | name.astype(np.uint64)
                found = np.searchsorted(wanted, keys)
                keep = np.flatnonzero(wanted[np.minimum(found, len(wanted) - 1)] == keys)
                if not len(keep):
                    continue
                owner, at, gram, first, last, bucket = owner[keep], at[keep], gram[keep], first[keep], last[keep], bucket[keep]
                run_, left = last - first, at - first
                lead, of = same_stretches(data, first, run_ + WIDTH, left, _key(Prefix(data), first, run_, left))
                text, place = index[owner], at - (np.cumsum(lengths) - lengths)[owner] + offset[owner]
                low, high = np.full(len(lead), NO_ID), np.full(len(lead), np.iinfo(np.int64).min)
                np.minimum.at(low, of, ids[text])
                np.maximum.at(high, of, ids[text])
                # Stretches and places in the order of their buckets.
                by = np.argsort(bucket[lead], kind="stable")
                rank = np.empty(len(lead), np.int64)
                rank[by] = np.arange(len(lead))
                lead, low, high, of = lead[by], low[by], high[by], rank[of]
                places = np.argsort(of, kind="stable")
                edge, ends = _edges(bucket[lead]), np.searchsorted(of[places], np.arange(len(lead) + 1))
                for a, b in zip(edge[:-1], edge[1:]):
                    mine, mark = lead[a:b], places[ends[a] : ends[b]]
                    out.append(
                        (
                            part,
                            int(bucket[mine[0]]),
                            b"".join(data[f : l + WIDTH].tobytes() for f, l in zip(first[mine], last[mine])),
                            run_[mine].astype(np.uint8).tobytes(),
                            left[mine].astype(np.uint8).tobytes(),
                            gram[mine].tobytes(),
                            low[a:b].tobytes(),
                            (high[a:b] > low[a:b]).astype(np.uint8).tobytes(),
                            len(out),
                            (of[mark] - a).astype(np.uint32).tobytes(),
                            text[mark].astype(np.uint32).tobytes(),
                            place[mark].astype(np.uint32).tobytes(),
                        )
                    )
        return pd.DataFrame(out, columns=["part", "bucket", "bytes", "runs", "lefts", "grams", "lows", "several", "nth", "items", "rows", "places"])

    return run


class Suffixes:
    """Suffixes of a buffer, by start and length, compared through prefix hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.data, self.start, self.length = np.append(data, np.zeros(WIDTH, np.uint8)), start, length
        self.prefix = Prefix(self.data)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b, by binary search."""
        x, y = self.start[a], self.start[b]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.length[a], self.length[b])
        for _ in range(WIDTH.bit_length()):
            mid = (low + high + 1) // 2
            same = self.prefix.of(x, x + mid) == self.prefix.of(y, y + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Whether suffix a stands before suffix b; ``equal`` where they are the same."""
        common = self.extension(a, b)
        ends_a, ends_b = common >= self.length[a], common >= self.length[b]
        less = self.data[self.start[a] + common] < self.data[self.start[b] + common]
        return np.where(ends_a & ends_b, equal, np.where(ends_a, True, np.where(ends_b, False, less)))

    def merge_sorted(self, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes within groups; ``group`` is ascending.  All groups' runs of one width merge at once."""
        n = len(group)
        order = np.arange(n)
        first = np.searchsorted(group, group)
        size = np.searchsorted(group, group, side="right") - first
        local = order - first
        width = 1
        while (active := np.flatnonzero(size > width)).size:
            run = local[active] // width
            other = (run ^ 1) * width
            low = first[active] + np.minimum(other, size[active])
            high = first[active] + np.minimum(other + width, size[active])
            base, right = low.copy(), (run & 1).astype(bool)
            for _ in range(width.bit_length()):
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) // 2
                # Elements of the right run go after equal ones of the left.
                passes = self.before(order[mid], order[active[open_]], right[open_])
                low[open_], high[open_] = np.where(passes, mid + 1, low[open_]), np.where(passes, high[open_], mid)
            target = first[active] + (run & ~1) * width + (local[active] - run * width) + (low - base)
            moved = order.copy()
            moved[target] = order[active]
            order = moved
            width *= 2
        return order

    def classes(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order, and each suffix's common extension with the one before it (-1 at a group's first)."""
        order = self.merge_sorted(group)
        common = self.extension(order[:-1], order[1:])
        if not self._verified(order, common):
            rows = self._rows()
            order = np.lexsort((*rows.T[::-1], group))
            common = self._on_bytes(rows[order[:-1]], rows[order[1:]])
            common = np.minimum(common, np.minimum(self.length[order[:-1]], self.length[order[1:]]))
        common = np.where(group[1:] != group[:-1], -1, common)
        return order, np.concatenate([[-1], common])

    def _rows(self) -> np.ndarray:
        """Bytes plus one, 0 beyond a suffix's end."""
        column = np.arange(WIDTH)
        at = np.minimum(self.start[:, None] + column, len(self.data) - 1)
        return np.where(column < self.length[:, None], self.data[at].astype(np.uint16) + 1, 0).astype(np.uint16)

    @staticmethod
    def _on_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        differ = a != b
        return np.where(differ.any(1), differ.argmax(1), WIDTH)

    def _verified(self, order: np.ndarray, common: np.ndarray) -> bool:
        for at in range(0, len(common), 65_536):
            a, b = order[at : at + 65_536], order[at + 1 : at + 65_537]
            a = a[: len(b)]
            column = np.arange(WIDTH)
            last = len(self.data) - 1
            same = self.data[np.minimum(self.start[a][:, None] + column, last)] == self.data[np.minimum(self.start[b][:, None] + column, last)]
            if not (same | (column >= common[at : at + 65_536, None])).all():
                return False
        return True


def smallest_documents(data: np.ndarray, start: np.ndarray, run: np.ndarray, left: np.ndarray, gram: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """(items, REACH + 1): the smallest document that has the item's string which begins o bytes before its anchor.

    An item is the stretch of bytes from ``start`` of ``run`` + 1 overlapping
    strings, with its anchor ``left`` bytes in.
    """
    by = np.argsort(gram, kind="stable")
    start, run, left, group, doc = start[by], run[by], left[by], gram[by], doc[by]
    n = len(by)
    ahead = Suffixes(data, start + left, run + WIDTH - left)
    back = Suffixes(data[::-1].copy(), len(data) - (start + left), left)
    order_a, common_a = ahead.classes(group)
    order_b, common_b = back.classes(group)
    best = np.full((n, REACH + 1), NO_ID)
    class_a, class_b = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(REACH + 1):
        fit = np.flatnonzero((left >= o) & (run + WIDTH - left >= WIDTH - o))
        if len(fit):
            class_a[order_a] = np.cumsum(common_a < WIDTH - o)
            class_b[order_b] = np.cumsum(common_b < o)
            _, of = np.unique(class_a[fit] * (n + 1) + class_b[fit], return_inverse=True)
            low = np.full(of.max() + 1, NO_ID)
            np.minimum.at(low, of, doc[fit])
            best[fit, o] = low[of]
    out = np.empty_like(best)
    out[by] = best
    return out


def _marks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per part, the stretches of a bucket that lose something: for their strings, in runs, the smallest document that has them."""
    data = np.frombuffer(b"".join(pdf["bytes"]), np.uint8)
    run, left, several = (np.frombuffer(b"".join(pdf[c]), np.uint8).astype(np.int64) for c in ("runs", "lefts", "several"))
    gram, low = np.frombuffer(b"".join(pdf["grams"]), np.uint64), np.frombuffer(b"".join(pdf["lows"]), np.int64)
    start = np.concatenate([[0], np.cumsum(run + WIDTH)[:-1]])
    # Equal stretches of different parts are one item.
    lead, of = same_stretches(data, start, run + WIDTH, left, _key(Prefix(data), start, run, left) ^ mixed(gram))
    least = np.full(len(lead), NO_ID)
    np.minimum.at(least, of, low)
    best = smallest_documents(data, start[lead], run[lead], left[lead], gram[lead], least)
    rows, begin = [], 0
    for part, bucket, nth, n in zip(pdf["part"], pdf["bucket"], pdf["nth"], map(len, pdf["runs"])):
        mine = of[begin : begin + n]
        held = np.flatnonzero((best[mine] < low[begin : begin + n, None]).any(1) | ((several[begin : begin + n] > 0) & (best[mine] < NO_ID).any(1)))
        begin += n
        if len(held):
            table = best[mine[held]]
            change = np.ones(table.shape, bool)
            change[:, 1:] = table[:, 1:] != table[:, :-1]
            rows.append((int(part), int(bucket), int(nth), held.astype(np.uint32).tobytes(), change.sum(1).astype(np.uint8).tobytes(), np.nonzero(change)[1].astype(np.uint8).tobytes(), table[change].tobytes()))
    return pd.DataFrame(rows, columns=["part", "bucket", "nth", "held", "counts", "offsets", "values"])


def _starts(places: pd.DataFrame, marks: pd.DataFrame, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and begins of the part's strings that a smaller document has, sorted by row."""
    rows, begins = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    told = {(b, n): (h, c, o, v) for b, n, h, c, o, v in zip(marks["bucket"], marks["nth"], marks["held"], marks["counts"], marks["offsets"], marks["values"])}
    for bucket, nth, items, row, place in zip(places["bucket"], places["nth"], places["items"], places["rows"], places["places"]):
        if (found := told.get((bucket, nth))) is None:
            continue
        held, counts, offsets, values = (np.frombuffer(x, t) for x, t in zip(found, (np.uint32, np.uint8, np.uint8, np.int64)))
        # Each run of strings holds from its offset to the next run's.
        until = np.append(offsets[1:], 0).astype(np.int64)
        until[np.cumsum(counts) - 1] = REACH + 1
        table = np.repeat(values, until - offsets).reshape(len(held), REACH + 1)
        item, row, place = (np.frombuffer(x, np.uint32).astype(np.int64) for x in (items, row, place))
        at = np.minimum(np.searchsorted(held, item), len(held) - 1)
        keep = np.flatnonzero(held[at] == item)
        for a in range(0, len(keep), 65_536):
            k = keep[a : a + 65_536]
            which, offset = np.nonzero(table[at[k]] < ids[row[k]][:, None])
            rows.append(row[k][which])
            begins.append(place[k][which] - offset)
    row, begin = np.concatenate(rows), np.concatenate(begins)
    order = np.argsort(row, kind="stable")
    return row[order], begin[order]


def _removed(docs: pd.DataFrame, extra: pd.DataFrame) -> pd.DataFrame:
    if not len(docs):
        return pd.DataFrame({"doc_id": pd.Series(dtype="Int64"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []})
    copies = _copies(docs, extra)
    ids, texts = _ordered(docs, copies)
    row, begin = _starts(extra[extra["items"].notna()], extra[extra["held"].notna()], ids)
    edge = np.searchsorted(row, np.arange(len(ids) + 1))
    out = []
    for at, text in enumerate(texts):
        removed = spans = 0
        kept = text
        a, b = edge[at], edge[at + 1]
        if a < b:
            change = np.bincount(begin[a:b], minlength=len(text) + 1) - np.bincount(begin[a:b] + WIDTH, minlength=len(text) + 1)
            gone = np.cumsum(change)[:-1] > 0
            removed, spans = int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((None if ids[at] == NO_ID else int(ids[at]), len(text), removed, spans, hashlib.sha256(kept).hexdigest()))
    gone = docs[copies]
    out += [(None if i == NO_ID else int(i), len(t), len(t), 1, hashlib.sha256(b"").hexdigest()) for i, t in zip(gone["id"], gone["text"])]
    out = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return out.assign(doc_id=out["doc_id"].astype("Int64"))


def remove_repeats(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, size // part_bytes + 1)
    buckets = 2 * parts
    code = F.xxhash64("text")
    # Null and repeated doc_ids are dealt by their texts.
    part = F.pmod(F.xxhash64("doc_id", code), F.lit(parts))
    held = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("text").cast("binary").alias("text"), code.alias("code"), part.alias("part"))
    keyed = held.filter(F.octet_length("text") >= WIDTH).select("id", "part", F.sha2("text", 256).alias("sum"))
    first = keyed.groupBy("sum").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sum", "least")
    # An id alone does not name a row: null doc_ids share NO_ID, and a doc_id may stand on rows of different texts.
    named = F.concat(F.unhex(F.lpad(F.hex("id"), 16, "0")), F.unhex("sum"))
    copies = split_join(keyed, materialize(first), ["sum"], F.col("id")).filter("id > least").groupBy("part").agg(F.collect_set(named).alias("copies"))

    def with_copies(rows: DataFrame) -> DataFrame:
        return rows.withColumn("copies", F.lit(None).cast("array<binary>")).unionByName(copies, allowMissingColumns=True)

    by_part = held.groupBy("part")
    sent = by_part.applyInPandas(_send(buckets), "bucket long, part long, names binary, codes binary")
    shared = sent.groupBy("bucket").applyInPandas(_shared, "part long, bucket long, names binary")
    context = "part long, bucket long, bytes binary, runs binary, lefts binary, grams binary, lows binary, several binary, nth long, items binary, rows binary, places binary"
    # Stretches go to their buckets, places stay with their part; both come from one stored table.
    around = written(by_part.cogroup(with_copies(shared).groupBy("part")).applyInPandas(_contexts(buckets), context), "stretches")
    marks = around.select("part", "bucket", "nth", "bytes", "runs", "lefts", "grams", "lows", "several").groupBy("bucket").applyInPandas(_marks, "part long, bucket long, nth long, held binary, counts binary, offsets binary, values binary")
    back = around.select("part", "bucket", "nth", "items", "rows", "places").unionByName(marks, allowMissingColumns=True)
    return by_part.cogroup(with_copies(back).groupBy("part")).applyInPandas(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
