"""Language-model scores by a hierarchical Pitman-Yor model.

Three layers of restaurants. Every word is a context with a restaurant of the
words that follow it; all of these share one parent, the word restaurant of the
whole corpus, whose customers are the tables of the contexts; each of its tables
orders its dish - a spelling - from a hierarchy of letter restaurants, one for
each context of the last three, two, one or no bytes, where every context is the
child of the next shorter one and the top one serves all bytes alike. Seating is
sampled by Gibbs sweeps of the Chinese-restaurant process: given everything else,
the number of tables of every dish is drawn anew by seating its customers one
after the other (in growing groups for large counts). A probability is the average
of the predictive probabilities of the sampled seatings after ``BURN_IN`` sweeps.

How it is spread out:

1. Words are counted. At most ``FREQUENT`` frequent ones form a book, which goes
   to all tasks with its numbers; other words are known by a hash of 63 bits.
2. Texts are cut into blocks, saved once. A block holds its tokens as numbers of
   its own distinct pairs of context and word; these pairs are dealt by hash to
   buckets, with training counts, so that a frequent pair costs a bucket one entry
   a block. A context outside the book lies whole in one bucket, one in the book is
   dealt by pair, so no bucket is hot.
3. Buckets sum up their pairs. A dish of one customer has one table; only pairs
   seen twice or more need sampling and become a table, rewritten by each sweep:
   contexts and words of the book are looked up, others are joined. Then the word
   restaurant is seated, one pass over the words seen twice or more - a word seen
   once has one customer and one table for good -, and the letters on the driver,
   which have at most 2^23 cells however large the corpus.
4. Buckets answer every pair of every block with its probability, half of them at a
   time, so that only half of the pairs are dealt on disk at once, and blocks sum
   them up by text. What a later step does not read is deleted at once.

Draws depend on the dish and the sweep alone, so results are the same however
rows are dealt, and held-out texts change nothing that is learnt.

Edge cases: null and empty texts consist of the end token; repeated rows are
scored each and train as often as they occur; rows with a null doc_id do not
train and have a null held_out; without any training row every probability
comes from uniform letters and base_score is null; an empty table gives an empty
result; other columns are ignored. A text is one block at least.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cleared, crc_mod, forget, lower_words, saved

BURN_IN, SAMPLES = 1, 2
FREQUENT = 250_000     # below 2^20, as two numbers share a long
MEMORY = 250_000       # words that a task counts before it passes them on
BLOCK_TOKENS = 800_000
BUCKET_TOKENS = 1_500_000
TURNS = 2              # buckets answer in so many turns, each of which deals its own rows only
THETA_CONTEXT, THETA_WORD, THETA_LETTER = 1.0, 10.0, 1.0
#: Fixed: bytes that no word holds, used for the end of a word and before it.
STOP, START = 0x20, 0x0A
#: Bits of a context by level: none, the low six bits of the last byte, five of the
#: one before it and four of the third.
BITS = (0, 6, 11, 15)
CELLS = 1 << (BITS[3] + 8)


# -- draws that depend on nothing but the dish and the sweep


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seed: np.ndarray, step: int) -> np.ndarray:
    x = mixed(seed + np.uint64((0x9E3779B97F4A7C15 * (step + 1)) % (1 << 64)))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def drawn(k: np.ndarray, p: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Binomial numbers from uniform ones: by inversion where the mean is below
    20, else by the normal approximation."""
    flip = p > 0.5
    q = np.where(flip, 1 - p, p)
    mean = k * q
    out = np.rint(mean + np.sqrt(mean * (1 - q) * -2 * np.log(u)) * np.cos(2 * np.pi * v))
    at = np.flatnonzero(mean < 20)
    kk, odds, uu = k[at], q[at] / (1 - q[at]), u[at]
    mass = np.exp(kk * np.log1p(-q[at]))
    below, x, live, j = mass.copy(), np.zeros(len(at)), np.arange(len(at)), 0
    while len(live := live[(uu[live] >= below[live]) & (j < kk[live])]):
        mass[live] *= (kk[live] - j) / (j + 1) * odds[live]
        below[live] += mass[live]
        j += 1
        x[live] = j
    out[at] = x
    out = np.clip(out, 0, k)
    return np.where(flip, k - out, out).astype(np.int64)


def seat(c: np.ndarray, a: np.ndarray, d: float, seed: np.ndarray) -> np.ndarray:
    """Tables of one dish each for c customers, a being the weight (theta + d *
    tables of the restaurant) * (parent's probability). Customers come one by
    one at first, later in groups of an eighth of those seated."""
    t = np.minimum(c, 1).astype(np.int64)
    done = t.copy()
    at, step = np.flatnonzero(c > 1), 0
    while len(at):
        k = np.minimum(np.maximum(1, done[at] // 8), c[at] - done[at])
        p = a[at] / (a[at] + np.maximum(done[at] - d * t[at], 1e-9))
        u = uniform(seed[at], 2 * step)
        t[at] += (u < p) if done[at[0]] < 16 and k.max() == 1 else drawn(k, p, u, uniform(seed[at], 2 * step + 1))
        done[at] += k
        at, step = at[done[at] < c[at]], step + 1
    return t


def discount(n1: float, n2: float) -> float:
    """From the numbers of ones and twos, within sensible bounds."""
    return float(np.clip(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.05, 0.95))


# -- letters


def events(col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter events of a column of words: keys (context of 15 bits, letter),
    word numbers and the first event of each word."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    n = np.diff(off)
    first = np.r_[0, np.cumsum(n + 4)]  # three starts before, one stop after
    buf = np.full(first[-1], START, np.uint8)
    word = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(word)) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n) if len(word) else np.empty(0, np.int64)
    buf[first[word] + 3 + place] = data[off[0] : off[-1]]
    buf[first[1:] - 1] = STOP
    owner = np.repeat(np.arange(len(n)), n + 1)
    at = np.arange(len(owner)) + 3 * (owner + 1)
    x = buf.astype(np.uint32)
    key = ((x[at - 3] & 15) << 19) | ((x[at - 2] & 31) << 14) | ((x[at - 1] & 63) << 8) | x[at]
    return key, owner, np.r_[0, np.cumsum(n + 1)[:-1]]


def up(key: np.ndarray, level: int) -> np.ndarray:
    """The cell of a level-3 key at a lower level."""
    return key & np.uint32((1 << (BITS[level] + 8)) - 1)


@dataclass
class Letters:
    """One sampled seating of the letter hierarchy, ready to predict."""

    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint32))   # observed level-3 cells
    p: np.ndarray = field(default_factory=lambda: np.empty(0))                 # their probabilities
    back: np.ndarray = field(default_factory=lambda: np.ones(1 << BITS[3], np.float32))  # weight of the parent
    below: np.ndarray = field(default_factory=lambda: np.full(1 << (BITS[2] + 8), 1 / 256, np.float32))  # all of level 2
    table: np.ndarray | None = None  # of all cells, made where many are asked

    def prob(self, key: np.ndarray) -> np.ndarray:
        out = self.back[key >> np.uint32(8)].astype(np.float64) * self.below[up(key, 2)]
        if len(self.keys):
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[k] == key
            out[hit] = self.p[k[hit]]
        return out

    def laid_out(self) -> Letters:
        """With the logarithms of all cells: 32 MB."""
        if self.table is None:
            table = np.empty(CELLS, np.float32)
            for a in range(0, CELLS, 1 << 18):
                table[a : a + (1 << 18)] = np.log(self.prob(np.arange(a, a + (1 << 18), dtype=np.uint32)))
            self.table = table
        return self

    def log_words(self, key: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural-log probability of every spelling."""
        if not len(first):
            return np.empty(0)
        return np.add.reduceat(self.laid_out().table[key].astype(np.float64), first)


def sweep_letters(keys: np.ndarray, counts: np.ndarray, before: Letters, tables: dict, n: int) -> tuple[Letters, dict]:
    """Gibbs sweep n from the longest contexts up, then predictions down. keys
    are sorted; ``tables`` holds each level's tables by context of the sweep
    before."""
    cells = [None] * 4
    key, c = keys, counts
    for level in (3, 2, 1, 0):
        ctx = (key >> np.uint32(8)).astype(np.int64)
        d = discount((c == 1).sum(), (c == 2).sum())
        parent = before.prob(key) if level == 3 else before.below[key] if level == 2 else np.full(len(key), 1 / 256)
        total_t = tables.get(level, np.zeros(1 << BITS[level]))[ctx]
        t = seat(c, (THETA_LETTER + d * total_t) * parent, d, mixed(key.astype(np.uint64) + np.uint64((4 * n + level) << 32)))
        cells[level] = (key, ctx, c, t, d)
        tables = tables | {level: np.bincount(ctx, t, 1 << BITS[level])}
        if level:
            pk, inv = np.unique(up(key, level - 1), return_inverse=True)
            key, c = pk, np.bincount(inv, t).astype(np.int64)
    dense = np.full(256, 1 / 256)
    for level in (0, 1, 2):
        key, ctx, c, t, d = cells[level]
        size = 1 << BITS[level]
        cu, tu = np.bincount(ctx, c, size), np.bincount(ctx, t, size)
        back = np.where(cu > 0, (THETA_LETTER + d * tu) / (THETA_LETTER + cu), 1.0)
        parents = 1 << BITS[max(level - 1, 0)]
        own = dense.reshape(-1, 256)[np.arange(size) % parents] * back[:, None]
        flat = own.reshape(-1)
        flat[key] += np.maximum(c - d * t, 0) / (THETA_LETTER + cu[ctx])
        dense = flat
    key, ctx, c, t, d = cells[3]
    cu, tu = np.bincount(ctx, c, 1 << BITS[3]), np.bincount(ctx, t, 1 << BITS[3])
    back = np.where(cu > 0, (THETA_LETTER + d * tu) / (THETA_LETTER + cu), 1.0)
    p = np.maximum(c - d * t, 0) / (THETA_LETTER + cu[ctx]) + back[ctx] * dense[up(key, 2)]
    return Letters(key, p, back.astype(np.float32), dense.astype(np.float32)), tables


# -- words


def _count(batches):
    """word, c_train, c_all of a task's texts, in parts of bounded size."""
    train, rest = Counter(), Counter()

    def out():
        words = list(train.keys() | rest.keys())
        t = [train[w] for w in words]
        a = [x + rest[w] for x, w in zip(t, words)]
        train.clear()
        rest.clear()
        for k in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(words[k : k + 50_000], pa.binary()), pa.array(t[k : k + 50_000], pa.int64()), pa.array(a[k : k + 50_000], pa.int64())], ["word", "c_train", "c_all"])

    for b in batches:
        for text, trains in zip(b.column(0), b.column(1).to_pylist()):
            into = train if trains else rest
            into.update(lower_words(text.as_py()))
            into[b""] += 1  # the end token
            if len(train) + len(rest) > MEMORY:
                yield from out()
    yield from out()


def rare_code(w: bytes) -> int:
    """Code of a word that is not in the book; codes in the book are its places."""
    return -(xxhash.xxh3_64_intdigest(w) >> 1) - 1


class Book:
    """Frequent words: place of each, hash of 63 bits and training count."""

    def __init__(self, rows):
        rows = sorted((xxhash.xxh3_64_intdigest(w) >> 1, bytes(w), c) for w, c in rows)
        self.at = {w: k for k, (_, w, _) in enumerate(rows)}
        self.h = np.array([h for h, _, _ in rows], np.uint64)
        self.c = np.array([c for _, _, c in rows], np.int64)

    def ident(self, code: np.ndarray) -> np.ndarray:
        """The hashes of words by their codes."""
        if not len(self.h):
            return (-code - 1).astype(np.uint64)
        return np.where(code >= 0, self.h[np.maximum(code, 0)], (-code - 1).astype(np.uint64))


def _coded(book):
    def run(batches):
        at = book.value.at
        for b in batches:
            codes = [at.get(w, None) for w in b.column(0).to_pylist()]
            codes = [rare_code(w) if k is None else k for k, w in zip(codes, b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes, pa.int64()), b.column(1)], ["word", "code", "c_train"])

    return run


def _gathered(batches, rows: int = 30_000):
    """Larger batches of the same rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


class Tally:
    """Customers of letters, summed over all cells: 32 MB."""

    def __init__(self):
        self.n = np.zeros(CELLS, np.uint32)

    def add(self, key: np.ndarray, c: np.ndarray | int) -> None:
        np.add.at(self.n, key, c)

    def rows(self, total: float):
        """Cells with customers; key CELLS is the number of tables."""
        k = np.flatnonzero(self.n)
        return _word_rows(1, np.r_[k, CELLS], np.r_[self.n[k].astype(float), total], np.zeros(len(k) + 1))


def _word_rows(kind, k, x, y):
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.astype(np.int64)), pa.array(x), pa.array(y)], ["kind", "k", "x", "y"])


def _seat_words(known, sent):
    """Draws the tables of every word: kind 0 has its code, the customers that
    stay after the discount and the log probability of its spelling; kind 1 the
    letters' customers, summed within the task."""

    def run(batches):
        book, (letters, d, tables, n) = known.value, sent.value
        tally, total = Tally(), 0
        for b in _gathered(batches):
            code, c = b.column("code").to_numpy(), b.column("c").to_numpy()
            key, owner, first = events(b.column("word"))
            lp0 = letters.log_words(key, first)
            t = seat(c, (THETA_WORD + d * tables) * np.exp(lp0), d, mixed(book.ident(code) + np.uint64(n)))
            yield _word_rows(0, code, np.maximum(c - d * t, 0.0), lp0)
            total += int(t.sum())
            tally.add(key, t[owner].astype(np.uint32))
        yield tally.rows(float(total))

    return run


def _count_letters(batches):
    """The letters' customers of words that have one table each."""
    tally, total = Tally(), 0
    for b in _gathered(batches):
        key, _, _ = events(b.column("word"))
        tally.add(key, 1)
        total += b.num_rows
    yield tally.rows(float(total))


def _spelt(sent):
    """Log probabilities, one for each sample, of words seen once or never."""

    def run(batches):
        d, seatings = sent.value
        for b in _gathered(batches):
            stay = np.where(b.column("c_train").to_numpy() > 0, 1 - d, 0.0)
            key, _, first = events(b.column("word"))
            out = []
            with np.errstate(divide="ignore"):
                for letters, weight, size in seatings:
                    out.append((np.logaddexp(np.log(stay), np.log(weight) + letters.log_words(key, first)) - np.log(size)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([b.column("code").combine_chunks(), *map(pa.array, out)], ["w", *_XS])

    return run


# -- blocks of texts and buckets of pairs


def squeeze(x: np.ndarray) -> bytes:
    """Compressed by planes of bytes."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes(), 1) if len(x) else b""


def expand(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    if not raw:
        return np.empty(0, kind)
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def place(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What pairs are dealt by: the context, with the word if it is in the book."""
    x = u.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(np.where(u >= 0, x ^ (w.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), x))


DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("held", "u1"), ("n", "<i8"), ("known", "<i8"), ("base", "<f8")])
#: Rows of a block: texts with each token's number of its pair; pairs by bucket,
#: both in the book (sorted places in one long) or not (contexts, words); counts.
TEXTS, BOTH, ANY = 0, 1, 2
_OUT = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_DDL = "key long, block long, kind int, a binary, b binary, c binary"


def _rows(rows, schema=_OUT):
    cols = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _blocks(sent, n_train: int, v: int, buckets: int):
    def run(batches):
        book = sent.value
        at, end = book.at, book.at.get(b"", rare_code(b""))
        base = np.log10((book.c + 0.1) / (n_train + 0.1 * (v + 1))) if n_train else np.zeros(len(book.c))
        part, block = TaskContext.get().partitionId(), 0

        def flush(docs, codes, sizes):
            nonlocal block
            me = (part << 32) + block
            block += 1
            code = np.concatenate(codes)
            size = np.array(sizes)
            first = np.r_[0, np.cumsum(size)[:-1]]
            own, local = np.unique(code, return_inverse=True)
            before = np.r_[0, local[:-1]]
            before[first] = np.searchsorted(own, end)
            trains = np.repeat(np.array([x[2] for x in docs], bool), size)
            pair, of = np.unique(before * len(own) + local, return_inverse=True)
            c = np.bincount(of, trains, len(pair)).astype(np.uint32)
            u, w = own[pair // len(own)], own[pair % len(own)]
            key, kind = (place(u, w) % np.uint64(buckets)).astype(np.int64), np.where((u >= 0) & (w >= 0), BOTH, ANY)
            o = np.lexsort((w, u, kind, key))
            number = np.empty(len(o), np.uint32)
            number[o] = np.arange(len(o))
            u, w, key, kind, c = u[o], w[o], key[o], kind[o], c[o]
            doc = np.zeros(len(docs), DOC)
            doc["id"], doc["null"], doc["held"], doc["n"] = [x[0] or 0 for x in docs], [x[0] is None for x in docs], [bool(x[1]) for x in docs], size
            m = code >= 0
            d = np.repeat(np.arange(len(size)), size)[m]
            doc["known"] = np.bincount(d, book.c[code[m]] > 0, len(size))
            doc["base"] = np.bincount(d, base[code[m]], len(size))
            yield (me, me, TEXTS, squeeze(doc), squeeze(number[of]), b"")
            cuts = np.flatnonzero(np.r_[True, (np.diff(key) != 0) | (np.diff(kind) != 0), True])
            for x, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if kind[x] == BOTH:
                    a, b = squeeze(np.diff((u[x:z].astype(np.uint64) << np.uint64(20)) | w[x:z].astype(np.uint64), prepend=np.uint64(0))), b""
                else:
                    a, b = squeeze(np.diff(u[x:z], prepend=0)), squeeze(w[x:z])
                yield (int(key[x]), me, int(kind[x]), a, b, squeeze(c[x:z]))

        docs, codes, sizes, held = [], [], [], 0
        for b in batches:
            for d, t, is_held, trains in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                words = lower_words(t.as_py())
                words.append(b"")
                code = np.fromiter(map(at.get, words, repeat(1 << 40)), np.int64, len(words))
                rare = np.flatnonzero(code == 1 << 40)
                if len(rare):
                    code[rare] = [rare_code(words[k]) for k in rare.tolist()]
                docs.append((d, is_held, trains))
                codes.append(code)
                sizes.append(len(code))
                held += len(code)
                if held >= BLOCK_TOKENS:
                    yield _rows(list(flush(docs, codes, sizes)))
                    docs, codes, sizes, held = [], [], [], 0
        if docs:
            yield _rows(list(flush(docs, codes, sizes)))

    return run


def _asked(table: pa.Table, kind: int):
    """(block, u, w, training counts) of a bucket's rows of a kind."""
    for block, k, a, b, c in zip(*(table.column(x).to_pylist() for x in ("block", "kind", "a", "b", "c"))):
        if k == kind:
            if kind == BOTH:
                x = np.cumsum(expand(a, np.uint64))
                u, w = (x >> np.uint64(20)).astype(np.int64), (x & np.uint64((1 << 20) - 1)).astype(np.int64)
            else:
                u, w = np.cumsum(expand(a, np.int64)), expand(b, np.int64)
            yield block, u, w, expand(c, np.uint32).astype(np.int64)


def _summed(blobs, kind: int):
    """Distinct pairs u, w of (block, u, w, c), their counts, and each blob's
    numbers of them."""
    u, w, c = (np.concatenate([b[k] for b in blobs]) for k in (1, 2, 3))
    if kind == BOTH:
        key, of = np.unique((u << 20) | w, return_inverse=True)
        u, w = key >> 20, key & ((1 << 20) - 1)
    else:
        o = np.lexsort((w, u))
        new = np.r_[True, (np.diff(u[o]) != 0) | (np.diff(w[o]) != 0)]
        of = np.empty(len(o), np.int64)
        of[o] = np.cumsum(new) - 1
        u, w = u[o][new], w[o][new]
    c = np.bincount(of, c, len(u)).astype(np.int64)
    return u, w, c, np.split(of, np.cumsum([len(b[1]) for b in blobs])[:-1])


#: What buckets tell: pairs seen twice or more; the numbers of pairs seen once, by
#: context and by word - of the book in one row of counts each -; and the words
#: outside the book.
MULTI, ONCE_U, ONCE_W, WANTED, BOOK_U, BOOK_W = range(6)
_PAIRS_DDL = "kind int, key long, u long, w long, c long, a binary"


def _pairs(size: int):
    def run(key, table):
        out, book = [], {k: np.zeros(size, np.uint32) for k in (BOOK_U, BOOK_W)}
        add = lambda kind, u, w, c: out.append((np.full(len(c), kind, np.int32), np.full(len(c), key[0].as_py()), u, w, c))
        for kind in (BOTH, ANY):
            if blobs := list(_asked(table, kind)):
                u, w, c, _ = _summed(blobs, kind)
                m, one = c > 1, c == 1
                add(MULTI, u[m], w[m], c[m])
                for told, counts, x in ((ONCE_U, BOOK_U, u[one]), (ONCE_W, BOOK_W, w[one])):
                    book[counts] += np.bincount(x[x >= 0], minlength=size).astype(np.uint32)
                    x, n = np.unique(x[x < 0], return_counts=True)
                    add(told, x, x, n.astype(np.int64))
                if kind == ANY:
                    x = np.unique(w[w < 0])
                    add(WANTED, x, x, np.zeros(len(x), np.int64))
        none = np.zeros(1, np.int64)
        for k in book:
            add(k, none, none, none)
        cols = [np.concatenate(x) for x in zip(*out)]
        a = pa.array([None] * (len(cols[0]) - 2) + [squeeze(x) for x in book.values()], pa.binary())
        return pa.table(dict(zip(("kind", "key", "u", "w", "c"), cols)) | {"a": a})

    return run


def _book_sums(key, table):
    """Counts of the book of some buckets, added up."""
    total = sum(expand(x.as_py(), np.uint32).astype(np.int64) for x in table.column("a"))
    return pa.table({"kind": pa.array([key[0].as_py()], pa.int32()), "a": pa.array([squeeze(total)], pa.binary())})


def _seat_pairs(known, sent, sample: int):
    """Draws the tables of every pair seen twice or more; those of a sample are
    kept in its column."""

    def run(batches):
        book, (d, tables, lp, n) = known.value, sent.value
        for b in _gathered(batches):
            key, u, w, c, tu, lw = (b.column(k).to_numpy() for k in range(6))
            at = lambda x, k: x[np.maximum(k, 0)] if len(x) else np.zeros(len(k))
            total = np.where(u >= 0, at(tables, u), tu)
            p = np.exp(np.where(w >= 0, at(lp, w), lw))
            t = seat(c, (THETA_CONTEXT + d * total) * p, d, mixed(mixed(book.ident(u) + np.uint64(n)) ^ book.ident(w)))
            t = t.astype(np.int32)
            kept = [b.column(6 + k).combine_chunks() if k != sample else pa.array(t) for k in range(SAMPLES)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, (key, u, w, c, t)), *kept], ["key", "u", "w", "c", "t", *_TS])

    return run


_TS = [f"t{k}" for k in range(SAMPLES)]
_XS = [f"x{k}" for k in range(SAMPLES)]
_TOLD = pa.schema([("block", pa.int64()), ("key", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def predict(c, t, total, customers, lp, d) -> np.ndarray:
    """log10 of the averaged predictive probability; t, total and lp have a row
    for each sample, lp being the word restaurant's natural log."""
    own = np.maximum(c - d * t, 0.0).sum(0)
    top = lp.max(0)
    rest = top + np.log(((THETA_CONTEXT + d * total) * np.exp(lp - top)).sum(0))
    with np.errstate(divide="ignore"):
        return (np.logaddexp(np.log(own), rest) - np.log(len(t) * (THETA_CONTEXT + customers))) / np.log(10)


#: Log probabilities travel as multiples of 1 / STEPS, those beyond -65535 / STEPS
#: as floats; the first byte tells which.
STEPS = 2048


def shorten(p: np.ndarray) -> bytes:
    if not len(p) or p.min() < -65535 / STEPS:
        return b"f" + squeeze(p.astype(np.float32))
    return b"s" + squeeze(np.rint(np.minimum(p, 0) * -STEPS).astype(np.uint16))


def lengthen(raw: bytes) -> np.ndarray:
    return expand(raw[1:], np.float32).astype(float) if raw[:1] == b"f" else expand(raw[1:], np.uint16) / -STEPS


def _answer(shared, sent):
    """Log probabilities of a bucket's pairs, block by block, and the training
    counts of words outside the book, plus one."""

    def run(key, table, told):
        book, (d, before, tables, lp) = shared.value, sent.value
        what, tu, tw, n = (told.column(c).to_numpy() for c in ("kind", "u", "w", "n"))
        xs = np.array([told.column(c).to_numpy() for c in _XS], float)
        m = what == MULTI
        mu, mw, mt = tu[m], tw[m], xs[:, m]
        o = np.lexsort((mw, mu))
        mu, mw, mt = mu[o], mw[o], mt[:, o]
        m = what == WANTED
        o = np.argsort(tw[m])
        word, word_n, word_lp = tw[m][o], n[m][o], xs[:, m][:, o]
        out = []
        for kind in (BOTH, ANY):
            blobs = list(_asked(table, kind))
            if not blobs:
                continue
            u, w, c, of = _summed(blobs, kind)
            t = np.tile(np.minimum(c, 1.0), (SAMPLES, 1))
            if kind == ANY:  # both are in order of context and word, and every pair seen twice is there
                t[:, c > 1] = mt
            else:  # the sweeps' draws, made again
                m = np.flatnonzero(c > 1)
                hu, hw = book.ident(u[m]), book.ident(w[m])
                for k in range(SAMPLES):
                    a = (THETA_CONTEXT + d * before[k][u[m]]) * np.exp(lp[k][w[m]])
                    t[k, m] = seat(c[m], a, d, mixed(mixed(hu + np.uint64(BURN_IN + k)) ^ hw))
            if kind == BOTH:
                total, customers, q = tables[:, u], book.c[u], lp[:, w]
                known = None
            else:
                first = np.flatnonzero(np.r_[True, np.diff(u) != 0])
                size = np.diff(np.r_[first, len(u)])
                total, customers = np.repeat(np.add.reduceat(t, first, axis=1), size, axis=1), np.repeat(np.add.reduceat(c, first), size)
                k = u >= 0
                total[:, k], customers[k] = tables[:, u[k]], book.c[u[k]]
                q, known = np.empty(t.shape), np.zeros(len(w), np.uint32)
                k = w >= 0
                q[:, k] = lp[:, w[k]]
                at = np.searchsorted(word, w[~k])
                q[:, ~k], known[~k] = word_lp[:, at], word_n[at] + 1
            p = predict(c, t, total, customers, q, d)
            for b, k in zip(blobs, of):
                out.append((b[0], key[0].as_py(), kind, shorten(p[k]), b"" if known is None else squeeze(known[k])))
        return pa.Table.from_batches([_rows(out, _TOLD)])

    return run


def _finish(n: int, v: int):
    """A block's texts, each with the sums of its tokens."""

    def run(key, texts, told):
        doc, number = expand(texts.column("a")[0].as_py(), DOC), expand(texts.column("b")[0].as_py(), np.uint32)
        rows = sorted(zip(*(told.column(c).to_pylist() for c in ("key", "kind", "a", "b"))), key=lambda r: r[:2])
        ps = [lengthen(r[2]) for r in rows]
        c = np.concatenate([expand(r[3], np.uint32).astype(np.int64) if r[1] == ANY else np.zeros(len(p), np.int64) for r, p in zip(rows, ps)])
        p = np.concatenate(ps)
        base = np.where(c > 0, np.log10((np.maximum(c, 1) - 0.9) / (n + 0.1 * (v + 1))), 0.0) if n else np.zeros(len(c))
        of = np.repeat(np.arange(len(doc)), doc["n"])
        add = lambda x: np.bincount(of, x[number], len(doc))
        null = doc["null"] > 0
        return pa.table({
            "doc_id": pa.array(doc["id"], pa.int64(), mask=null), "held_out": pa.array(doc["held"] > 0, pa.bool_(), mask=null),
            "n_tokens": pa.array(doc["n"], pa.int64()), "n_known": pa.array(doc["known"] + np.rint(add(c > 1)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(doc), n, np.int64)),
            "base_score": pa.array(doc["base"] + add(base), pa.float64(), mask=np.full(len(doc), n == 0)), "score": pa.array(add(p), pa.float64()),
        })

    return run


class Model:
    """The seating of contexts and words: a table of pairs seen twice or more, a
    table of the words seen twice or more, arrays for the book."""

    def __init__(self, spark, book, words: DataFrame, told: DataFrame):
        self.spark, self.known, self.book = spark, book, book.value
        kind = lambda k: told.where(F.col("kind") == k)
        zeros = [F.lit(0).cast("int").alias(c) for c in _TS]
        self.multi = saved(kind(MULTI).select(F.col("key").cast("int").alias("key"), "u", "w", F.col("c").cast("int").alias("c"), F.lit(1).alias("t"), *zeros), "pairs")
        used = lambda *kinds: forget(told, parts=tuple(f"kind={k}" for k in kinds))
        used(MULTI)
        self.once = saved(kind(ONCE_U).groupBy("u").agg(F.sum("c").alias("n")), "contexts")
        used(ONCE_U)
        # a few sums of FREQUENT numbers
        part = F.pmod("key", F.lit(8)).alias("part")
        rows = told.where(F.col("kind") >= BOOK_U).select("kind", part, "a").groupBy("kind", "part").applyInArrow(_book_sums, "kind int, a binary").collect()
        added = lambda k: sum((expand(r["a"], np.int64) for r in rows if r["kind"] == k), np.zeros(len(self.book.h), np.int64))
        used(BOOK_U, BOOK_W)
        self.once_book, of_words = added(BOOK_U).astype(float), added(BOOK_W)
        once_w = kind(ONCE_W).groupBy("w").agg(F.sum("c").alias("n"))
        if len(at := np.flatnonzero(of_words)):
            once_w = once_w.unionByName(spark.createDataFrame(pa.table({"w": at, "n": of_words[at]})))
        self.words = saved(words.where("c_train > 1").join(once_w.withColumnRenamed("w", "code"), "code", "left").select("word", "code", "c_train", F.coalesce("n", F.lit(0)).alias("n")), "words")
        self.few = words.where("c_train < 2")  # one table or none
        got = self.few.where("c_train = 1").mapInArrow(_count_letters, "kind int, k long, x double, y double").groupBy("k").agg(F.sum("x").alias("x")).toArrow()  # CELLS + 1 sums at most
        self.always = got.column("k").to_numpy(), got.column("x").to_numpy()
        self.alone = float(self.always[1][self.always[0] == CELLS].sum())
        n1 = self.once.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + self.once_book.sum()
        n2 = self.multi.where("c = 2").count()
        self.d = discount(n1, n2)
        ones = self.customers().agg(F.count_if(F.col("c") == 1).alias("one"), F.count_if(F.col("c") == 2).alias("two")).first()
        self.d_word = discount(ones["one"] + self.alone, ones["two"])
        self.letters, self.letter_tables, self.tables = Letters(), {}, 0.0
        self.book_tables, self.rare_tables = self.contexts()
        self.samples = []   # of the book: tables before and after, log probabilities
        self.rare = []      # of other words seen twice or more: log probabilities
        self.seatings = []  # letters, and the weight and size of the word restaurant

    def array(self, rows: DataFrame, at: str, value: str) -> np.ndarray:
        """By place in the book; FREQUENT rows at most."""
        got, out = rows.select(at, value).toArrow(), np.zeros(len(self.book.h))
        out[got.column(0).to_numpy()] = got.column(1).to_numpy()
        return out

    def customers(self) -> DataFrame:
        """The word restaurant's customers: tables of the contexts by word."""
        t = self.multi.groupBy("w").agg(F.sum("t").alias("t")).withColumnRenamed("w", "code")
        return self.words.join(t, "code", "left").select("word", "code", (F.col("n") + F.coalesce("t", F.lit(0))).alias("c"))

    def contexts(self) -> tuple[np.ndarray, DataFrame]:
        """Tables by context: of the book, and of others with pairs seen twice."""
        t = self.multi.groupBy("u").agg(F.sum("t").alias("t"))
        rare = t.where("u < 0").join(self.once, "u", "left").select("u", (F.col("t") + F.coalesce("n", F.lit(0))).cast("double").alias("tu"))
        return self.once_book + self.array(t.where("u >= 0"), "u", "t"), saved(rare, "tables")

    def sweep(self, n: int) -> None:
        sc = self.spark.sparkContext
        sent = sc.broadcast((self.letters, self.d_word, self.tables, n))
        seated = saved(self.customers().mapInArrow(_seat_words(self.known, sent), "kind int, k long, x double, y double"), "seated", by="kind")
        sent.destroy()
        got = seated.where("kind = 1").groupBy("k").agg(F.sum("x").alias("x")).toArrow()  # CELLS + 1 sums at most
        k, of = np.unique(np.r_[self.always[0], got.column("k").to_numpy()], return_inverse=True)
        c = np.rint(np.bincount(of, np.r_[self.always[1], got.column("x").to_numpy()], len(k))).astype(np.int64)
        left = float(seated.where("kind = 0").agg(F.coalesce(F.sum("x"), F.lit(0.0))).first()[0])
        left += (1 - self.d_word) * self.alone
        self.tables, k, c = float(c[k == CELLS].sum()), k[k < CELLS], c[k < CELLS]
        # all customers are those that stay plus a discount a table
        size, weight = THETA_WORD + left + self.d_word * self.tables, THETA_WORD + self.d_word * self.tables
        lp = F.when(F.col("x") > 0, F.log(F.col("x") + weight * F.exp("y"))).otherwise(F.lit(float(np.log(weight))) + F.col("y")) - F.lit(float(np.log(size)))
        words = seated.where("kind = 0").select(F.col("k").alias("w"), lp.cast("float").alias("lp"))
        own = self.array(words.where("w >= 0"), "w", "lp")
        before, tables = self.letters, self.book_tables
        if len(k):
            self.letters, self.letter_tables = sweep_letters(k.astype(np.uint32), c, before, self.letter_tables, n)
        both = self.multi.where("u >= 0 AND w >= 0")
        other = self.multi.where("u < 0 OR w < 0").join(self.rare_tables, "u", "left").join(words.where("w < 0"), "w", "left")
        cols = ["key", "u", "w", "c", "tu", "lp", *_TS]
        rows = both.select("key", "u", "w", "c", F.lit(0.0).alias("tu"), F.lit(0.0).cast("float").alias("lp"), *_TS).unionByName(other.fillna(0.0, ["tu", "lp"]).select(*cols))
        sent = sc.broadcast((self.d, self.book_tables, own, n))
        ddl = "key int, u long, w long, " + ", ".join(f"{c} int" for c in ("c", "t", *_TS))
        old = self.multi, self.rare_tables
        self.multi = saved(rows.mapInArrow(_seat_pairs(self.known, sent, n - BURN_IN), ddl), "pairs")
        sent.destroy()
        self.book_tables, self.rare_tables = self.contexts()
        forget(*old)
        if n >= BURN_IN:
            self.samples.append((tables, self.book_tables, own))
            self.rare.append(saved(words.where("w < 0"), "rare"))
            self.seatings.append((Letters(before.keys, before.p, before.back, before.below), weight, size))
        forget(seated)
        cleared(self.spark)

    def rare_words(self) -> DataFrame:
        """w, training count and the samples' log probabilities of words outside the
        book; those of the book that were seen once or never enter its arrays."""
        sent = self.spark.sparkContext.broadcast((self.d_word, self.seatings))
        ddl = "w long, " + ", ".join(f"{x} float" for x in _XS)
        few = saved(self.few.mapInArrow(_spelt(sent), ddl), "few")
        sent.destroy()
        for k, (_, _, own) in enumerate(self.samples):
            own += self.array(few.where("w >= 0"), "w", _XS[k])
        tagged = [r.select("w", *[F.col("lp").alias(x) if i == k else F.lit(None).cast("float").alias(x) for i, x in enumerate(_XS)]) for k, r in enumerate(self.rare)]
        many = reduce(DataFrame.unionByName, tagged).groupBy("w").agg(*[F.max(x).alias(x) for x in _XS])
        count = self.words.where("code < 0").select(F.col("code").alias("w"), F.col("c_train").cast("int").alias("n"))
        once = self.few.where("code < 0").select(F.col("code").alias("w"), F.col("c_train").cast("int").alias("n"))
        rare = saved(many.join(count, "w").unionByName(few.where("w < 0").join(once, "w")), "rare-words")
        forget(few)
        return rare


def scores(docs: DataFrame, held_out: int = 0, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    held = crc_mod(F.col("doc_id"), folds) == held_out
    counted = docs.select("text", F.coalesce(~held, F.lit(False)).alias("trains")).mapInArrow(_count, "word binary, c_train long, c_all long")
    vocabulary = saved(counted.groupBy("word").agg(F.sum("c_train").alias("c_train"), F.sum("c_all").alias("c_all")), "vocabulary")
    stats = vocabulary.agg(F.coalesce(F.sum("c_train"), F.lit(0)).alias("n"), F.count_if(F.col("c_train") > 0).alias("v")).first()
    n, v = int(stats["n"]), int(stats["v"])
    # Words and tokens by the power of two of their count: 64 rows at most. The
    # book holds the words from the least power on that keeps it in bounds.
    kinds = vocabulary.groupBy(F.floor(F.log2("c_all")).cast("int").alias("s")).agg(F.count(F.lit(1)).alias("v"), F.sum("c_all").alias("n")).orderBy("s").collect()
    total, least = 0, 63
    for r in reversed(kinds):
        total += r["v"]
        if total > FREQUENT:
            break
        least = r["s"]
    got = vocabulary.where(F.col("c_all") >= F.lit(2).cast("double") ** least).select("word", "c_train").toArrow()  # FREQUENT rows at most
    book = Book(zip(got.column("word").to_pylist(), got.column("c_train").to_pylist()))
    known_words = spark.sparkContext.broadcast(book)
    words = saved(vocabulary.select("word", "c_train").mapInArrow(_coded(known_words), "word binary, code long, c_train long"), "coded")
    forget(vocabulary)
    cleared(spark)
    buckets = 32 + sum(r["n"] for r in kinds) // BUCKET_TOKENS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"), F.coalesce(~held, F.lit(False)).alias("trains"))
    blocks = saved(rows.mapInArrow(_blocks(known_words, n, v, buckets), _DDL), "blocks", by="kind")
    asked = blocks.where(F.col("kind") != TEXTS).groupBy("key")
    told = saved(asked.applyInArrow(_pairs(len(book.h)), _PAIRS_DDL), "told", by="kind")
    cleared(spark)
    wanted = saved(told.where(F.col("kind") == WANTED).select(F.col("key").cast("int").alias("key"), "w"), "wanted")
    forget(told, parts=(f"kind={WANTED}",))
    model = Model(spark, known_words, words, told)
    forget(told)
    cleared(spark)
    for k in range(BURN_IN + SAMPLES):
        model.sweep(k)
    rare = model.rare_words()
    # pairs of the book are drawn again where they are asked
    multi = saved(model.multi.where("u < 0 OR w < 0"), "rare-pairs")
    forget(model.multi, model.words, words, model.once, model.rare_tables, *model.rare)
    cleared(spark)
    final = spark.sparkContext.broadcast((model.d, *(np.array(x) for x in zip(*model.samples))))
    parts = []
    for turn in range(TURNS):
        mine = F.pmod("key", F.lit(TURNS)) == turn
        known = multi.where(mine).select("key", F.lit(MULTI).alias("kind"), "u", "w", F.col("c").alias("n"), *[F.col(t).cast("float").alias(x) for t, x in zip(_TS, _XS)]).unionByName(
            wanted.where(mine).join(rare, "w").select("key", F.lit(WANTED).alias("kind"), F.lit(0).cast("long").alias("u"), "w", "n", *_XS)
        ).withColumn("key", F.col("key").cast("long"))
        turned = blocks.where(F.col("kind") != TEXTS).where(mine).groupBy("key").cogroup(known.groupBy("key"))
        parts.append(saved(turned.applyInArrow(_answer(known_words, final), "block long, key long, kind int, a binary, b binary"), "answers"))
        cleared(spark)
    answers = reduce(DataFrame.unionByName, parts)
    final.destroy()
    known_words.destroy()
    forget(multi, wanted, rare)
    forget(blocks, parts=(f"kind={BOTH}", f"kind={ANY}"))
    cleared(spark)
    texts = blocks.where(F.col("kind") == TEXTS).select("block", "a", "b")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_finish(n, v), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
