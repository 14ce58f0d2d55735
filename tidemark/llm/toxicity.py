"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Each word enters as the sum of a hashed word embedding and of the mean of its
hashed character-trigram embeddings; both tables, the two recurrent directions
and the attention are trained in numpy by back-propagation through time. A text
is cut into windows of ``WINDOW`` words every ``STEP`` words; every window is
scored and a text takes its most toxic window.

Training reads at most ``FIT_ROWS`` labelled documents, those of the smallest key
hashes in each class, one text of a doc_id (the first in order) and ``FIT_BYTES`` of
text in all; the next ``CHECK_ROWS`` calibrate the scores. All windows of these
texts are scored in every epoch, and a text learns by its ``LEARN_WINDOWS`` most
toxic ones. Scoring reads every window of every text.

Edge cases: null and empty texts score like one window of no words; repeated rows
score alike; of a doc_id with several labels the toxic one counts; null doc_ids
pass through; with no labels, or one class only, every
score is the prior; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, saved

WINDOW, STEP = 48, 32
FIT_ROWS, CHECK_ROWS, FIT_BYTES = 3000, 2000, 64 << 20
LEARN_WINDOWS = 12
WORDS, GRAMS, DIM, HIDDEN = 1 << 14, 1 << 15, 12, 8
EPOCHS, BATCH, RATE = 6, 64, 0.02
CUT = 0.7
MEMORY = 300_000  # words that a worker remembers


def rows_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed rows of words: each one's own, then those of its character trigrams,
    the word being set between < and >, and the first of each word's."""
    c = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.fromiter(map(len, words), np.int64, len(words))
    first = np.r_[0, np.cumsum(n)]
    at = np.arange(first[-1]) + np.repeat(2 * np.arange(len(n)), n)  # trigrams start at each character but the last two
    x = c[at] * np.uint32(2654435761) ^ c[at + 1] * np.uint32(2246822519) ^ c[at + 2] * np.uint32(3266489917)
    x ^= x >> np.uint32(15)
    x *= np.uint32(668265263)
    grams = (x >> np.uint32(9)) % np.uint32(GRAMS)
    place = (np.arange(first[-1]) - np.repeat(first[:-1], n)).astype(np.uint32)
    y = (c[at + 1] + np.uint32(1)) * (place * np.uint32(374761393) + np.uint32(2654435769))
    y ^= y >> np.uint32(13)
    y *= np.uint32(1274126177)
    own = np.add.reduceat(y, first[:-1]) if len(n) else np.empty(0, np.uint32)
    return ((own ^ (own >> np.uint32(16))) % np.uint32(WORDS)).astype(np.int64), grams.astype(np.int64), first[:-1]


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def starts(n: int) -> np.ndarray:
    """First words of all windows of a text of n words; the last one reaches the
    end."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.r_[np.arange(0, n - WINDOW, STEP), n - WINDOW]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters p: W word and G trigram tables; per direction d the input
    weights U, recurrent weights R and bias b of the gates (update, reset,
    candidate); attention A, v; output o, c."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        f = lambda *s: (r.normal(0, 1, s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"W": r.normal(0, 0.05, (WORDS, DIM)).astype(np.float32), "G": r.normal(0, 0.3, (GRAMS, DIM)).astype(np.float32)}
        for d in "fb":
            self.p |= {"U" + d: f(DIM, 3 * HIDDEN), "R" + d: f(HIDDEN, 3 * HIDDEN), "b" + d: np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": f(2 * HIDDEN, HIDDEN), "v": f(HIDDEN, 1), "o": f(2 * HIDDEN, 1), "c": np.full(1, -2.0, np.float32)}
        self.prior, self.scale, self.shift = None, 1.0, 0.0

    # x: (time, rows, DIM), m: (time, rows) 1 where a word is.

    def direction(self, x, m, d, keep):
        p, h = HIDDEN, np.zeros((x.shape[1], HIDDEN), np.float32)
        pre = x @ self.p["U" + d] + self.p["b" + d]
        R, out, saved = self.p["R" + d], np.empty((len(x), x.shape[1], p), np.float32), []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            gates = 0.5 * np.tanh(0.5 * (pre[t, :, : 2 * p] + h @ R[:, : 2 * p])) + 0.5
            z, r = gates[:, :p], gates[:, p:]
            n = np.tanh(pre[t, :, 2 * p :] + (r * h) @ R[:, 2 * p :])
            new = (h + z * (n - h)) if m is None else h + m[t][:, None] * z * (n - h)
            if keep:
                saved.append((t, h, z, r, n))
            out[t] = h = new
        return out, saved

    def forward(self, x, m, keep=False):
        f, sf = self.direction(x, m, "f", keep)
        b, sb = self.direction(x, m, "b", keep)
        s = np.concatenate([f, b], 2)
        u = np.tanh(s @ self.p["A"])
        a = (u @ self.p["v"])[:, :, 0]
        if m is not None:
            a = np.where(m > 0, a, -1e9)
        a = np.exp(a - a.max(0))
        if m is not None:
            a = a * m
        a /= np.maximum(a.sum(0), 1e-9)
        c = np.einsum("tn,tnd->nd", a, s)
        logit = (c @ self.p["o"])[:, 0] + self.p["c"][0]
        return logit, (x, m, sf, sb, s, u, a, c)

    def back_direction(self, dout, x, m, d, saved, g):
        p, R = HIDDEN, self.p["R" + d]
        dh = np.zeros((x.shape[1], p), np.float32)
        dpre = np.zeros((len(x), x.shape[1], 3 * p), np.float32)
        gR = np.zeros_like(R)
        for t, h, z, r, n in reversed(saved):
            dh = dh + dout[t]
            k = m[t][:, None]
            dz, dn = dh * k * (n - h) * z * (1 - z), dh * k * z * (1 - n * n)
            drh = dn @ R[:, 2 * p :].T
            dr = drh * h * r * (1 - r)
            gR[:, 2 * p :] += (r * h).T @ dn
            gR[:, :p] += h.T @ dz
            gR[:, p : 2 * p] += h.T @ dr
            dpre[t] = np.concatenate([dz, dr, dn], 1)
            dh = dh * (1 - k * z) + drh * r + dz @ R[:, :p].T + dr @ R[:, p : 2 * p].T
        g["R" + d] = gR
        g["U" + d] = np.einsum("tni,tnj->ij", x, dpre)
        g["b" + d] = dpre.sum((0, 1))
        return dpre @ self.p["U" + d].T

    def backward(self, dlogit, cache):
        x, m, sf, sb, s, u, a, c = cache
        g = {"o": c.T @ dlogit[:, None], "c": dlogit.sum(keepdims=True)}
        dc = dlogit[:, None] * self.p["o"][:, 0]
        ds = a[:, :, None] * dc
        da = np.einsum("nd,tnd->tn", dc, s)
        da = a * (da - (a * da).sum(0))
        g["v"] = np.einsum("tnh,tn->h", u, da)[:, None]
        du = da[:, :, None] * self.p["v"][:, 0] * (1 - u * u)
        g["A"] = np.einsum("tnd,tnh->dh", s, du)
        ds = ds + du @ self.p["A"].T
        dx = self.back_direction(ds[:, :, :HIDDEN], x, m, "f", sf, g)
        return dx + self.back_direction(ds[:, :, HIDDEN:], x, m, "b", sb, g), g

    def vectors(self, words: list[str]) -> np.ndarray:
        """Input vectors of words."""
        own, grams, first = rows_of(words)
        if not len(own):
            return np.empty((0, DIM), np.float32)
        n = np.diff(np.r_[first, len(grams)])[:, None].astype(np.float32)
        return self.p["W"][own] + np.add.reduceat(self.p["G"][grams], first) / n

    # -- training

    def fit(self, texts: list[str | None], toxic: np.ndarray, seed: int = 11) -> None:
        """Multiple-instance training: a text's windows compete, its most toxic
        one learns (all windows of clean texts that come near do)."""
        known, docs = {}, []
        r = np.random.default_rng(seed)
        for t in texts:
            w = words_of(t)
            ids = np.array([known.setdefault(x, len(known)) for x in w], np.int64)
            docs.append([ids[k : k + WINDOW] for k in starts(len(w))])
        own, flat, first = rows_of(list(known)) if known else (np.empty(0, np.int64),) * 3
        first = np.r_[first, len(flat)]

        def laid(wins):
            """Windows by time, where there are words, the words, each one's place."""
            ids = np.full((WINDOW, len(wins)), -1, np.int64)
            for k, w in enumerate(wins):
                ids[: len(w), k] = w
            used, at = np.unique(ids[ids >= 0], return_inverse=True)
            return ids >= 0, used, at

        def vectors(used):
            sizes = first[used + 1] - first[used]
            owner = np.repeat(np.arange(len(used)), sizes)
            cuts = np.repeat(first[used] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum()) if len(used) else np.empty(0, np.int64)
            vec = self.p["W"][own[used]].copy()
            np.add.at(vec, owner, self.p["G"][flat[cuts]] / sizes[owner][:, None].astype(np.float32))
            return vec, cuts, owner, sizes

        def most_toxic(wins):
            """The windows by which a text learns."""
            if len(wins) <= LEARN_WINDOWS:
                return wins
            logits = []
            for a in range(0, len(wins), 512):
                inside, used, at = laid(wins[a : a + 512])
                x = np.zeros((*inside.shape, DIM), np.float32)
                x[inside] = vectors(used)[0][at]
                logits.append(self.forward(x, inside.astype(np.float32))[0])
            return [wins[k] for k in np.argsort(-np.concatenate(logits), kind="stable")[:LEARN_WINDOWS]]

        sq = {k: np.zeros_like(v) for k, v in self.p.items()}
        pos, neg = np.flatnonzero(toxic), np.flatnonzero(~toxic)
        for epoch in range(EPOCHS):
            # classes in equal parts
            n = max(len(pos), min(len(neg), 3 * len(pos)))
            order = r.permutation(np.concatenate([r.choice(pos, n // 2 + 1, len(pos) < n // 2 + 1), r.choice(neg, n // 2 + 1, len(neg) < n // 2 + 1)]))
            rate = RATE * (1 - 0.8 * epoch / EPOCHS)
            for a in range(0, len(order), BATCH):
                batch = order[a : a + BATCH]
                own_wins = [most_toxic(docs[d]) for d in batch]
                doc = np.repeat(np.arange(len(batch)), list(map(len, own_wins)))
                inside, used, at = laid([w for wins in own_wins for w in wins])
                vec, cuts, owner, sizes = vectors(used)
                x = np.zeros((*inside.shape, DIM), np.float32)
                x[inside] = vec[at]
                logit, cache = self.forward(x, inside.astype(np.float32), True)
                # each text's windows weigh by how toxic they look
                top = np.full(len(batch), -1e9, np.float32)
                np.maximum.at(top, doc, logit)
                e = np.exp(3 * (logit - top[doc]))
                share = e / np.bincount(doc, e)[doc]
                y = toxic[batch].astype(np.float32)
                dl = (share * (sigmoid(logit) - y[doc]) / len(batch)).astype(np.float32)
                dx, g = self.backward(dl, cache)
                dv = np.zeros_like(vec)
                np.add.at(dv, at, dx[inside])
                for k, v in g.items():
                    np.clip(v, -1, 1, out=v)
                    sq[k] = 0.95 * sq[k] + 0.05 * v * v
                    self.p[k] -= rate * v / (np.sqrt(sq[k]) + 1e-4)
                for k, where, grad in (("W", own[used], dv), ("G", flat[cuts], dv[owner] / sizes[owner][:, None])):
                    rows_, back = np.unique(where, return_inverse=True)
                    total = np.zeros((len(rows_), DIM), np.float32)
                    np.add.at(total, back, grad)
                    sq[k][rows_] += total * total
                    self.p[k][rows_] -= 3 * rate * total / (np.sqrt(sq[k][rows_]) + 1e-4)

    def calibrate(self, texts: list[str | None], toxic: np.ndarray, odds: float) -> None:
        """Logistic calibration of the largest logits, clean texts weighted to
        ``odds`` clean ones per toxic one."""
        self.scale, self.shift = 1.0, 0.0
        p = np.clip(self.score(texts, Vectors(self)), 1e-12, 1 - 1e-12)
        x = np.stack([np.log(p / (1 - p)), np.ones(len(p))], 1)
        w = np.where(toxic, 1.0, odds * toxic.sum() / max((~toxic).sum(), 1))
        beta = np.array([1.0, 0.0])
        for _ in range(50):
            q = sigmoid(x @ beta)
            grad = x.T @ (w * (q - toxic)) + 0.5 * (beta - [1.0, 0.0])
            hess = (x * (w * q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(2)
            beta = beta - np.clip(np.linalg.solve(hess, grad), -1, 1)
        if beta[0] > 0:
            self.scale, self.shift = map(float, beta)

    # -- scoring

    def score(self, texts, vectors: Vectors) -> np.ndarray:
        """The largest window probability of each text."""
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        out = np.zeros(len(texts))
        words, spans = [], []

        def flush():
            if not spans:
                return
            vec = np.concatenate([vectors.of(words), np.zeros((1, DIM), np.float32)])
            d, s, n = (np.array(x, np.int64) for x in zip(*spans))
            for full in (True, False):  # windows shorter than the others need masks
                at = np.flatnonzero((n == WINDOW) == full)
                for a in range(0, len(at), 1024):
                    k = at[a : a + 1024]
                    steps = np.arange(WINDOW)[:, None]
                    inside = steps < n[k]
                    x = vec[np.where(inside, s[k] + steps, len(vec) - 1)]
                    logit, _ = self.forward(x, None if full else inside.astype(np.float32))
                    np.maximum.at(out, d[k], sigmoid(self.scale * logit.astype(np.float64) + self.shift))
            words.clear()
            spans.clear()

        for i, t in enumerate(texts):
            w = words_of(t)
            base = len(words)
            words.extend(w)
            spans.extend((i, base + k, min(WINDOW, len(w))) for k in starts(len(w)).tolist())
            if len(words) > 200_000:
                flush()
        flush()
        return out


class Vectors:
    """Input vectors of words under a network, remembered up to a bound."""

    def __init__(self, net: Network):
        self.net, self.at, self.known, self.size = net, {}, np.empty((1 << 12, DIM), np.float32), 0

    def of(self, words: list[str]) -> np.ndarray:
        if self.size > MEMORY:
            self.at, self.size = {}, 0
        k = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        if len(new := np.flatnonzero(k < 0)):
            fresh = list(dict.fromkeys(words[j] for j in new.tolist()))
            self.at |= zip(fresh, range(self.size, self.size + len(fresh)))
            while len(self.known) < self.size + len(fresh):
                self.known = np.concatenate([self.known, np.empty_like(self.known)])
            for j in range(0, len(fresh), 20_000):
                own = self.net.vectors(fresh[j : j + 20_000])
                self.known[self.size : self.size + len(own)] = own
                self.size += len(own)
            k[new] = [self.at[words[j]] for j in new.tolist()]
        return self.known[k]


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 1, rows: int = FIT_ROWS, check_rows: int = CHECK_ROWS) -> Network:
    """Learns from labelled rows outside the held-out fold: ``rows`` of them at
    most, half of either class, and ``check_rows`` more for calibration (the
    training rows again where there are no more)."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(crc_mod(F.col("doc_id"), 3) != held_out)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    pick = None
    for k in (0, 1):
        own = known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit((rows + check_rows) // 2)
        pick = own if pick is None else pick.unionByName(own)
    # one text of a doc_id; (rows + check_rows) texts at most
    texts = docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    texts = saved(texts.select("toxic", "text", F.xxhash64("doc_id").alias("h"), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")), "labelled")
    so_far = F.sum("n").over(Window.partitionBy("toxic").orderBy("h", "doc_id"))
    got = texts.where(F.col("n") <= FIT_BYTES // 64).withColumn("so_far", so_far).where(F.col("so_far") <= FIT_BYTES // 2).select("toxic", "text", "h", "doc_id").collect()
    got.sort(key=lambda r: (r["h"], r["doc_id"]))
    net = Network()
    if not sizes.get(0) or not sizes.get(1) or len({r["toxic"] for r in got}) < 2:
        net.prior = float(bool(sizes.get(1)) and not sizes.get(0))
        return net
    split = [[r for r in got if r["toxic"] == k] for k in (0, 1)]
    train = [r for own in split for r in own[: rows // 2]]
    check = [r for own in split for r in (own[rows // 2 :] if len(own) > rows // 2 + 50 else own)]
    net.fit([r["text"] for r in train], np.array([r["toxic"] == 1 for r in train]))
    net.calibrate([r["text"] for r in check], np.array([r["toxic"] == 1 for r in check]), sizes[0] / sizes[1])
    return net


def scores(docs: DataFrame, net: Network, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(net)  # fixed size

    def run(batches):
        net = sent.value
        vectors = Vectors(net)
        for b in batches:
            s = net.score([t.as_py() for t in b.column(1)], vectors)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), pa.array(s, pa.float64())], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_mod(F.col("doc_id"), 3) == held_out).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= CUT).cast("int"))
