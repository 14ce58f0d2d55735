"""Benchmark decontamination with spaced seeds.

Fixed masks over windows of ``SPAN`` words keep 8 positions and ignore 4, so a
window still hashes alike after substitutions at ignored places. Hashes of the
test set are joined with those of every window of the training documents; each
hit fixes a diagonal (document position minus item position). On it ungapped
runs are scored with +1 a match and -3 a mismatch; every maximal one of ``LEAST``
words or more is an overlap. With a ``share`` so is, where no run is that long,
the item's whole extent if so many per cent of its words are equal, as
substitutions in a short item leave no long run; op7 and the pipeline ask for
``SHARE``.

The test set goes to the executors as an index in blocks of at most
``BLOCK_WORDS`` words; a larger test set takes more passes, each of the same
size, so what is broadcast never grows with the data.

Edge cases: null or empty texts, and items or documents of fewer than ``SPAN``
words, have no window and no overlap; equal items are all reported; repeated
rows are reported each; null ids pass through as null; empty tables give an
empty result; columns other than the ids and texts are ignored by ``overlaps``
and kept by ``drop_contaminated``, which judges every row by its own text,
whatever its id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_words, memory

SPAN = 12
#: Fixed: word positions of a window that each mask looks at.
MASKS = (
    (0, 1, 3, 4, 6, 9, 10, 11),
    (0, 1, 2, 5, 7, 8, 10, 11),
    (0, 2, 3, 4, 5, 8, 9, 11),
    (0, 1, 2, 3, 6, 7, 9, 11),
)
LEAST = 12
SHARE = 80  # per cent of an item's words
MISMATCH = 3
BLOCK_WORDS = 2_000_000
HITS = 1_000_000  # looked at together
_TABLE_BITS = 20

_rng = np.random.default_rng(41)
_COEF = _rng.integers(1, 2**63, (len(MASKS), len(MASKS[0])), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STRIP = b".,;:!?\"'()[]"


class WordHashes(dict):
    """Hashes of words without outer punctuation, remembered up to a bound."""

    def __missing__(self, w: bytes) -> int:
        if len(self) >= 250_000:
            self.clear()
        v = self[w] = xxhash.xxh3_64_intdigest(w.strip(_STRIP))
        return v


def seeds(h: np.ndarray, mask: int) -> np.ndarray:
    """One hash of each window of h under a mask."""
    n = len(h) - SPAN + 1
    x = np.zeros(n, np.uint64)
    for c, p in zip(_COEF[mask], MASKS[mask]):
        x += h[p : p + n] * c
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x


def best_overlap(same: np.ndarray) -> tuple[int, int, int]:
    """(start, length, matches) of the best run; the first of equal ones."""
    score = np.cumsum(np.where(same, 1, -MISMATCH))
    low = np.minimum.accumulate(np.r_[0, score[:-1]])
    gain = score - low
    e = int(np.argmax(gain))
    before = np.r_[0, score[:e]]
    s = int(len(before) - 1 - np.argmin(before[::-1]))
    return s, e + 1 - s, int(same[s : e + 1].sum())


def all_overlaps(same: np.ndarray, at: int = 0) -> list[tuple[int, int, int]]:
    """(start, length, matches) of every maximal run of LEAST words or more."""
    out, todo = [], [(at, same)]
    while todo:
        at, x = todo.pop()
        if len(x) < LEAST or not x.any():
            continue
        s, n, good = best_overlap(x)
        if n >= LEAST:
            out.append((at + s, n, good))
        todo += [(at + s + n, x[s + n :]), (at, x[:s])]
    return out


class Index:
    """Seeds of a block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int, str]]):
        cache = WordHashes()
        self.ids, self.words = [], []
        keys, who, at = [], [], []
        for i, t in items:
            w = lower_words(t)
            if len(w) < SPAN:
                continue
            h = np.array([cache[x] for x in w], np.uint64)
            self.ids.append(i)
            self.words.append(h)
            for m in range(len(MASKS)):
                x = seeds(h, m)
                keys.append(x)
                who.append(np.full(len(x), len(self.ids) - 1))
                at.append(np.arange(len(x)))
        cat = lambda xs, kind: np.concatenate(xs) if xs else np.empty(0, kind)
        keys, who, at = cat(keys, np.uint64), cat(who, np.int64), cat(at, np.int64)
        o = np.argsort(keys, kind="stable")
        self.keys, self.who, self.at = keys[o], who[o], at[o]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.keys >> np.uint64(64 - _TABLE_BITS)] = True

    def diagonals(self, h: np.ndarray) -> np.ndarray:
        """Distinct (item, position of the item's first word in h) of all hits."""
        out = []
        if len(h) >= SPAN:
            for m in range(len(MASKS)):
                x = seeds(h, m)
                pos = np.flatnonzero(self.table[x >> np.uint64(64 - _TABLE_BITS)])
                lo, hi = np.searchsorted(self.keys, x[pos], "left"), np.searchsorted(self.keys, x[pos], "right")
                n = hi - lo
                pos, lo, n = pos[n > 0], lo[n > 0], n[n > 0]
                # windows that many items share are expanded in parts
                part = np.cumsum(n) // HITS
                for a, z in zip(*(np.searchsorted(part, np.unique(part), side) for side in ("left", "right"))):
                    p, f, c = pos[a:z], lo[a:z], n[a:z]
                    k = np.repeat(f - np.r_[0, np.cumsum(c)[:-1]], c) + np.arange(c.sum())
                    out.append(np.unique(np.stack([self.who[k], np.repeat(p, c) - self.at[k]], 1), axis=0))
        return np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), np.int64)

    def verify(self, h: np.ndarray, i: int, d: int, share: int | None):
        w = self.words[i]
        a, z = max(d, 0), min(d + len(w), len(h))
        same = h[a:z] == w[a - d : z - d]
        runs = all_overlaps(same)
        if not runs and share is not None and 100 * (good := int(same.sum())) >= share * len(w):
            runs = [(0, z - a, good)]
        for s, n, good in runs:
            yield self.ids[i], a + s, a + s - d, n, good


def _found(index, share: int | None):
    """A function of numbered word hashes: rows of all overlaps."""

    def found(ids, hashes):
        rows = []
        whole = np.concatenate(hashes)
        start = np.r_[0, np.cumsum([len(x) for x in hashes])]
        for i, d in index.value.diagonals(whole).tolist():
            # The seed may reach over the end of a text; the texts it touches are
            # verified by themselves.
            w = len(index.value.words[i])
            k = int(np.searchsorted(start, max(d, 0), "right")) - 1
            while k < len(hashes) and start[k] < d + w:
                if len(hashes[k]) >= SPAN:
                    rows += [(ids[k], *x) for x in index.value.verify(hashes[k], i, d - int(start[k]), share)]
                k += 1
        return list(dict.fromkeys(rows))

    cache = WordHashes()

    def of(texts):
        """(row number, item_id, ...) of a batch's texts."""
        at, hashes, n, rows = [], [], 0, []
        for k, t in enumerate(texts):
            w = lower_words(t.as_py())
            if len(w) < SPAN:
                continue
            at.append(k)
            hashes.append(np.fromiter(map(cache.__getitem__, w), np.uint64, len(w)))
            n += len(w)
            if n >= 400_000:
                rows += found(at, hashes)
                at, hashes, n = [], [], 0
        return rows + (found(at, hashes) if at else [])

    return of


def _scan(index, share: int | None):
    def run(batches):
        memory("decontam")
        found = _found(index, share)
        for b in batches:
            ids = b.column(0).to_pylist()
            rows = [(ids[r[0]], *r[1:]) for r in found(b.column(1))]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"])

    return run


def _indexes(items: DataFrame):
    """The test set's index in blocks, broadcast one after the other."""
    spark = items.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0  # a word has a character at least
    blocks = max(1, -(-int(total) // (2 * BLOCK_WORDS)))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield spark.sparkContext.broadcast(Index([(r[0], r[1]) for r in own]))


def overlaps(docs: DataFrame, items: DataFrame, share: int | None = None) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, n_words, n_equal of every verified
    overlap, positions counted in words from 0."""
    out = None
    for index in _indexes(items):
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan(index, share), "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_equal long")
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, share: int | None = None) -> DataFrame:
    """docs without the rows whose texts overlap an item, all columns kept."""
    column = docs.columns.index("text")

    def filtered(index):
        def run(batches):
            memory("decontam")
            found = _found(index, share)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[r[0] for r in found(b.column(column))]] = False
                yield b.filter(pa.array(keep))

        return run

    for index in _indexes(items):
        docs = docs.mapInArrow(filtered(index), docs.schema)
    return docs
