"""Near-duplicate documents by MinHash with tensored banding.

1. Every text becomes its set of 5-word shingles (64-bit hashes) and 32
   minhashes. Equal sets are one class; only its smallest id goes on.
2. Tensored banding: the minhashes form two collections of pairs, 8 each at a
   threshold of 0.85 (10 at 0.8). A table's key is one pair of each collection,
   so 64 tables of 4 hashes cost 32 minhashes instead of 256. Keys of the first
   collection that stand alone are dropped before the second is combined with
   them, which leaves a few per cent of rows. There are as many pairs as it takes
   for a link at the threshold to be missed by all tables with probability 7e-5.
3. Sets of the documents that share a table key are kept. Among them pairs come
   from the rarest shingles of each set: two sets with i >= t*u, t being the
   threshold, share one of their n - ceil(t n) + 1 first shingles in any common
   order, so ordering by (approximate) frequency loses no pair, and texts that
   only share a frequent passage never meet.
4. Small groups are compared in pairs. Larger ones of much the same members -
   near copies share many shingles - become one: groups are united by their member
   of the smallest hash, so two meet with a probability of their members'
   similarity and none is split. Everyone is compared to a leader, which settles
   most of a group of near copies. Then members outside a group's largest
   component lead in turn, ever more of them at once: a block of leaders and one of
   members meet with their full sets, whose intersections are a product of
   matrices, and of their links only those that join components are passed on,
   fewer than there are members. A leader has met everyone and leaves the group, so
   a group ends when one component is left.
5. In small groups and with first leaders a signature of 128 minhashes discards
   hopeless pairs (a link fails that test with probability 7e-6). Every link is
   confirmed on the full sets.

The threshold, in per cent, is a parameter: 85 is op5's, the pipeline has 80.

Edge cases: null or empty texts (no words) have an empty set and link with
nothing; fewer than 5 words make one shingle; rows that share a doc_id share a
fate, and where their texts differ the links of all of them count; a null doc_id links with nothing and has a null component; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cleared, forget, lower_words, memory, saved
from .components import components

SHINGLE, THRESHOLD = 5, 85
N_SIG = 128                   # longer signature of candidates
MISS_TABLES, MISS_SIG = 7.5e-5, 7e-6  # chances to lose a link at the threshold, at most
SMALL = 16                    # groups of up to its square in pairs are compared at once
LEADERS, BLOCK = 32, 512      # leaders of a group in the first round; members that meet at once, up to
BLOCKS, LARGER = 16, 8        # so many blocks, then blocks grow up to so many times, and hold
BLOCK_SHINGLES = 500_000      # so many shingles at most on average
COLUMNS = 4096                # shingles of two blocks compared at once
FREQ_BITS = 18                # buckets of the approximate frequency table
BROADCAST_ROWS = 1_000_000    # 8-byte ids sent to all executors at most

_rng = np.random.default_rng(20240229)
_COEF = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = (_rng.integers(1, 2**63, N_SIG, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


def sub_keys(threshold: int) -> int:
    """Sub-keys (pairs of minhashes) in each of the two collections."""
    k = 1
    while 2 * (1 - (threshold / 100) ** 2) ** k > MISS_TABLES:
        k += 1
    return k


def sig_least(threshold: int) -> int:
    """Equal places that a signature test asks; places have a byte each."""
    p = threshold / 100 + (1 - threshold / 100) / 256
    m, below = 0, 0.0
    while (below := below + comb(N_SIG, m) * p**m * (1 - p) ** (N_SIG - m)) <= MISS_SIG:
        m += 1
    return m


PAIRS = sub_keys(THRESHOLD)
N_MIN = 4 * PAIRS             # minhashes: 2 collections of pairs
SIG_LEAST = sig_least(THRESHOLD)


class WordHashes(dict):
    """64-bit word hashes, remembered up to a bound."""

    def __init__(self, most: int = 250_000):
        self.most = most

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        v = self[w] = xxhash.xxh3_64_intdigest(w)
        return v


def shingles(text: str | None, cache: dict) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    w = lower_words(text)
    if not w:
        return np.empty(0, np.uint64)
    if len(w) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=len(w))], np.uint64)
    h = np.fromiter(map(cache.__getitem__, w), np.uint64, len(w))
    n = len(h) - SHINGLE + 1
    x = h[:n] * _COEF[0]
    for k in range(1, SHINGLE):
        x += h[k : k + n] * _COEF[k]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x.sort()
    return x[np.r_[True, x[1:] != x[:-1]]]


def minhashes(s: np.ndarray, k: int) -> np.ndarray:
    out = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 4096):  # bounded memory for very long texts
        np.minimum(out, (s[a : a + 4096] * _MUL[:k]).min(axis=1), out=out)
    return out


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """Two longs that tell sets apart."""
    d = xxhash.xxh3_128_digest(s)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _signatures(n_min: int):
    def run(batches):
        memory("neardup")
        cache = WordHashes()
        for b in batches:
            n, s1, s2, mins = [], [], [], []
            for t in b.column(1):
                s = shingles(t.as_py(), cache)
                n.append(len(s))
                a, z = set_digest(s)
                s1.append(a)
                s2.append(z)
                mins.append(minhashes(s, n_min).view(np.int64) if len(s) else np.empty(0, np.int64))
            off = np.r_[0, np.cumsum([len(m) for m in mins])].astype(np.int32)
            vals = np.concatenate(mins) if mins else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.ListArray.from_arrays(off, pa.array(vals))],
                ["doc_id", "n", "s1", "s2", "mins"],
            )

    return run


def _sets(batches):
    memory("neardup")
    cache = WordHashes()
    for b in batches:
        ids, ns, sets, sigs, digests = [], [], [], [], []
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            s = shingles(t.as_py(), cache)
            ids.append(i)
            ns.append(len(s))
            sets.append(s.view(np.int64))
            sigs.append((minhashes(s, N_SIG) >> np.uint64(56)).astype(np.uint8).tobytes())
            digests.append(set_digest(s))
        off = np.r_[0, np.cumsum([len(m) for m in sets])].astype(np.int32)
        vals = np.concatenate(sets) if sets else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), *[pa.array(x, pa.int64()) for x in (zip(*digests) if digests else ([], []))], pa.ListArray.from_arrays(off, pa.array(vals)), pa.array(sigs, pa.binary())],
            ["rep", "n", "s1", "s2", "set", "sig"],
        )


def _list_bounds(col) -> np.ndarray:
    return col.offsets.to_numpy()


def _frequencies(batches):
    total = np.zeros(1 << FREQ_BITS, np.int64)
    for b in batches:
        v = b.column(0).flatten().to_numpy().view(np.uint64)
        total += np.bincount((v >> np.uint64(64 - FREQ_BITS)).astype(np.int64), minlength=1 << FREQ_BITS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "c"])


def _prefixes(freq, threshold: int):
    def run(batches):
        for b in batches:
            rep, n, col = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)
            off, vals = _list_bounds(col), col.values.to_numpy()
            g, r, m, i = [], [], [], []
            for k in range(len(rep)):
                s = vals[off[k] : off[k + 1]]
                size = len(s)
                p = size - -(-threshold * size // 100) + 1
                i.append(np.arange(p))
                u = s.view(np.uint64)
                f = freq.value[(u >> np.uint64(64 - FREQ_BITS)).astype(np.int64)]
                g.append(s[np.lexsort((u, f))[:p]])
                r.append(np.full(p, rep[k]))
                m.append(np.full(p, n[k]))
            if g:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (g, r, m, i)], ["g", "rep", "n", "i"])

    return run


def _may_link(na: str, ia: str, nb: str, ib: str, threshold: int):
    """Whether sets of na and nb shingles whose first common one is the ia-th and
    ib-th can overlap enough; at later common ones the test is stricter."""
    most = F.least(F.col(na) - F.col(ia), F.col(nb) - F.col(ib))
    return (100 * F.least(na, nb) >= threshold * F.greatest(na, nb)) & ((100 + threshold) * most >= threshold * (F.col(na) + F.col(nb)))


def _pick(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is in ids; ids are broadcast only if counted
    to be few, else both sides are shuffled."""
    few = ids.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _near(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """pairs(a, b) whose signatures are near."""
    sig, least = sets.select("rep", "sig"), sig_least(threshold)

    def filtered(batches):
        for t in batches:
            x = np.frombuffer(b"".join(t.column(2).to_pylist()), np.uint8).reshape(-1, N_SIG)
            y = np.frombuffer(b"".join(t.column(3).to_pylist()), np.uint8).reshape(-1, N_SIG)
            m = (x == y).sum(axis=1) >= least
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], ["a", "b"]).filter(pa.array(m))

    return (
        pairs.join(sig.select(F.col("rep").alias("a"), F.col("sig").alias("x")), "a")
        .join(sig.select(F.col("rep").alias("b"), F.col("sig").alias("y")), "b")
        .select("a", "b", "x", "y").mapInArrow(filtered, "a long, b long")
    )


def _confirm(near: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links among pairs(a, b), on the full sets."""
    one = near.join(sets.select(F.col("rep").alias("b"), F.col("set").alias("sb")), "b")
    two = one.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("sa")), "a")
    i = F.size(F.array_intersect("sa", "sb"))
    return two.select("a", "b", i.alias("i"), (F.size("sa") + F.size("sb")).alias("t")).where(100 * F.col("i") >= threshold * (F.col("t") - F.col("i"))).select("a", "b")


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of a with every set of b."""
    out = np.zeros((len(a), len(b)), np.float32)
    x, y = (np.concatenate(s) if s else np.empty(0, np.int64) for s in (a, b))
    shared = np.intersect1d(x, y)

    def places(s, v):
        at = np.minimum(np.searchsorted(shared, v), max(len(shared) - 1, 0))
        hit = np.flatnonzero(shared[at] == v) if len(shared) else np.empty(0, np.int64)
        return np.repeat(np.arange(len(s)), [len(z) for z in s])[hit], at[hit]

    (ra, ca), (rb, cb) = places(a, x), places(b, y)
    for k in range(0, len(shared), COLUMNS):  # bounded memory for long sets
        m, n = np.zeros((len(a), COLUMNS), np.float32), np.zeros((len(b), COLUMNS), np.float32)
        for d, r, c in ((m, ra, ca), (n, rb, cb)):
            h = (c >= k) & (c < k + COLUMNS)
            d[r[h], c[h] - k] = 1
        out += m @ n.T
    return out


def _meet(threshold: int):
    """Links of blocks of a group's leaders and members in different components,
    on the full sets; of all links as many as join what they join."""

    def columns(t: pa.Table):
        rep, n, i, early, comp = (t.column(c).to_numpy() for c in ("rep", "n", "i", "early", "comp"))
        return rep, n, i, early, comp, [x.values.to_numpy() for x in t.column("set")]

    def run(key, leaders: pa.Table, members: pa.Table) -> pa.Table:
        out = []
        if len(leaders) and len(members):
            la, ln, li, le, lc, ls = columns(leaders)
            ma, mn, mi, me, mc, ms = columns(members)
            _, part = np.unique(np.r_[lc, mc], return_inverse=True)
            lp, mp = part[: len(la)], part[len(la) :]
            name = np.arange(part.max() + 1)  # of each component, as links join them
            for k in range(0, len(la), 512):
                row = lambda x: x[k : k + 512, None]
                most = np.minimum(row(ln - li), mn - mi)
                may = (row(lc) != mc) & (row(le) | me) & ((100 + threshold) * most >= threshold * (row(ln) + mn))
                may &= 100 * np.minimum(row(ln), mn) >= threshold * np.maximum(row(ln), mn)
                x, y = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
                if not len(x):
                    continue
                both = common([ls[k + z] for z in x], [ms[z] for z in y])
                link = may[np.ix_(x, y)] & ((100 + threshold) * both.astype(np.int64) >= threshold * (ln[k + x][:, None] + mn[y]))
                for z in np.flatnonzero(link.any(1)):
                    to = y[link[z]]
                    theirs, first = np.unique(name[mp[to]], return_index=True)
                    mine = name[lp[k + x[z]]]
                    out += [(la[k + x[z]], ma[w]) for w in to[first[theirs != mine]]]
                    name[np.isin(name, theirs)] = mine
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def classes_and_labels(docs: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per document its class, per class its representative, per linked
    representative its component."""
    spark, pairs_each = docs.sparkSession, sub_keys(threshold)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole = saved(docs.mapInArrow(_signatures(4 * pairs_each), "doc_id long, n long, s1 long, s2 long, mins array<bigint>"), "signatures")
    key = ["s1", "s2", "n"]
    signed = saved(whole.select("doc_id", *key), "signed")
    firsts_of = saved(
        whole.where("n > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min(F.struct("doc_id", "mins")).alias("m")).select(*key, F.col("m.doc_id").alias("rep"), F.col("m.mins").alias("mins")),
        "minhashes",
    )
    reps = saved(firsts_of.select(*key, "rep"), "reps")
    forget(whole)
    pair = lambda first, i: F.xxhash64(F.lit(int(first)), i, F.get("mins", 2 * i + first), F.get("mins", 2 * i + first + 1))
    sub = lambda first: F.transform(F.sequence(F.lit(0), F.lit(pairs_each - 1)), lambda i: pair(first, i))
    shared = lambda d: d.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k")
    first = firsts_of.select("rep", F.explode(sub(0)).alias("k"))
    # the second collection is sent only to the keys that are left
    first = saved(first.join(shared(first), "k", "left_semi"), "first")
    left = firsts_of.select("rep", sub(2 * pairs_each).alias("kb")).join(first, "rep")
    second = saved(left.select("rep", "k", F.explode("kb").alias("kb")).select("rep", F.xxhash64("k", "kb").alias("k")), "tables")
    forget(firsts_of, first)
    cleared(spark)
    # Of a doc_id with several texts all are one document.
    several = saved(signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi")).where("lo <> hi").select("doc_id"), "several")
    own = None
    if several.count():
        theirs = signed.where("n > 0").select("doc_id", *key).join(several, "doc_id", "left_semi").distinct()
        own = saved(theirs.join(reps, key).where("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct(), "own")
    survivors = saved(second.join(shared(second), "k", "left_semi").select(F.col("rep").alias("doc_id")).distinct(), "survivors")
    forget(second)
    cleared(spark)
    sets = saved(_pick(docs, survivors).mapInArrow(_sets, "rep long, n long, s1 long, s2 long, set array<bigint>, sig binary"), "sets")
    if sets.count() > survivors.count():  # rows that share a doc_id
        sets = saved(sets.join(reps, [*key, "rep"], "left_semi").dropDuplicates([*key, "rep"]), "sets")
    # 2^18 sums at most, whatever the input
    got = sets.select("set").mapInArrow(_frequencies, "bucket int, c long").groupBy("bucket").agg(F.sum("c").alias("c")).collect()
    freq = np.zeros(1 << FREQ_BITS, np.int64)
    for b, c in got:
        freq[b] = c
    prefix = sets.select("rep", "n", "set").mapInArrow(_prefixes(spark.sparkContext.broadcast(freq), threshold), "g long, rep long, n long, i long")
    # In a pair the smaller set's place is below 1 - 2t/(1+t) of its size: a
    # group needs one such member.
    early = F.col("i") * (100 + threshold) <= F.col("n") * (100 - threshold)
    prefix = saved(prefix.withColumn("early", early), "prefix")
    groups = prefix.groupBy("g").agg(
        F.count(F.lit(1)).alias("c"), F.count_if("early").alias("ce"), F.bit_xor(F.xxhash64("rep")).alias("who"), F.sum("i").alias("si"),
    ).where("c > 1 AND ce > 0")
    # Many shingles are shared by the very same sets: the first one is enough.
    groups = groups.groupBy("c", "who").agg(F.min(F.struct("si", "g", "ce")).alias("m")).select("m.g", "m.ce", (F.col("m.ce") * F.col("c")).alias("pairs"))
    met = saved(prefix.join(groups, "g"), "met")
    forget(prefix)
    cleared(spark)
    ordered = lambda d: d.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def paired(d: DataFrame) -> DataFrame:
        side = lambda x: d.select("g", "early", *[F.col(c).alias(c + x) for c in ("rep", "n", "i")])
        x, y = side("a").where("early").drop("early"), side("b")
        cond = _may_link("na", "ia", "nb", "ib", threshold) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("repa") < F.col("repb"))) | ((F.col("na") == F.col("nb")) & ~F.col("early")))
        return x.join(y, "g").where(cond & (F.col("repa") != F.col("repb"))).select(F.col("repa").alias("a"), F.col("repb").alias("b"))

    def starred(d: DataFrame) -> DataFrame:
        lead = d.where(first_leads).select("g", F.col("rep").alias("l"), F.col("n").alias("ln"), F.col("i").alias("li"))
        return d.join(lead, "g").where((F.col("rep") != F.col("l")) & _may_link("n", "i", "ln", "li", threshold)).select(F.col("l").alias("a"), F.col("rep").alias("b"))

    # about one of a group's early members, by hash
    first_leads = F.col("early") & (F.pmod(F.xxhash64("g", "rep"), F.col("ce")) < 1)
    small, large = met.where(F.col("pairs") <= SMALL * SMALL), met.where(F.col("pairs") > SMALL * SMALL)
    united = large.groupBy("g").agg(F.min(F.xxhash64("rep")).alias("_g"))
    large = large.join(united, "g").groupBy(F.col("_g").alias("g"), "rep", "n").agg(F.min("i").alias("i"), F.max("early").alias("early"))
    size = large.groupBy("g").agg(F.count_if("early").alias("ce"))
    large = saved(large.join(size, "g"), "large")
    tested = saved(ordered(paired(small).unionByName(starred(large))), "tested")
    links = saved(_confirm(_near(tested, sets, threshold), sets, threshold), "linked")
    if own is not None:
        links = saved(links.unionByName(own), "links")
    labels = components(links)
    live = saved(large.where(~first_leads).select("g", "rep", "n", "i", "early"), "live")
    forget(met, large, tested)
    cleared(spark)
    full = sets.select("rep", "set")
    blocks = lambda m, n: F.greatest(F.lit(1), F.ceil(m / F.greatest(F.lit(BLOCK), F.least(m / BLOCKS, F.lit(LARGER * BLOCK)))), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    dealt = lambda salt, of: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    k = LEADERS
    while True:
        named = live.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").select(*live.columns, F.coalesce("component", "rep").alias("comp"))
        named = saved(named, "named")
        parts = named.groupBy("g", "comp").agg(F.count(F.lit(1)).alias("c"), F.count_if("early").alias("e"), F.sum("n").alias("n"))
        apart = parts.groupBy("g").agg(F.sum("c").alias("m"), F.sum("e").alias("e"), F.sum("n").alias("sum"), F.max(F.struct("c", "comp", "n")).alias("top")).where("m > top.c AND e > 0")
        apart = apart.select("g", "m", "sum", (F.col("m") - F.col("top.c")).alias("s"), (F.col("sum") - F.col("top.n")).alias("rest"), F.col("top.comp").alias("main"))
        share = F.least(F.lit(1.0), k / F.col("s"))
        apart = apart.withColumn("members", blocks(F.col("m"), F.col("sum"))).withColumn("leaders", blocks(F.col("s") * share, F.col("rest") * share))
        named = saved(named.join(apart, "g").withColumn("leads", (F.col("comp") != F.col("main")) & (F.pmod(F.xxhash64("g", "rep"), F.col("s")) < k)), "apart")
        if not named.limit(1).count():
            break
        cols = ["g", "lead", "block", "rep", "n", "i", "early", "comp", "set"]
        leaders = named.where("leads").withColumn("lead", dealt(1, "leaders")).join(full, "rep").withColumn("block", every("members")).select(*cols)
        members = named.withColumn("block", dealt(2, "members")).join(full, "rep").withColumn("lead", every("leaders")).select(*cols).toDF(*cols)
        at = ["g", "lead", "block"]
        links = saved(links.unionByName(leaders.groupBy(*at).cogroup(members.groupBy(*at)).applyInArrow(_meet(threshold), "a long, b long")), "links")
        labels = components(links)
        cleared(spark)
        live, k = named.where("NOT leads").select(*live.columns), 8 * k
    forget(sets)
    return signed, reps, labels


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    signed, reps, labels = classes_and_labels(docs, threshold)
    named = reps.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").select("s1", "s2", "n", F.coalesce("component", "rep").alias("component"))
    with_set = signed.where("n > 0 AND doc_id IS NOT NULL").join(named, ["s1", "s2", "n"]).select("doc_id", "n", "component")
    alone = signed.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.when(F.col("n") >= 0, F.col("doc_id")).alias("component"))
    return with_set.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Documents of docs that are the first of their group, all columns kept."""
    gone = saved(near_duplicates(docs, threshold).where("NOT kept").select("doc_id").distinct(), "copies")
    few = gone.count() <= BROADCAST_ROWS
    key = gone.select(F.col("doc_id").alias("_gone"))
    return docs.join(F.broadcast(key) if few else key, docs["doc_id"].cast("long") == F.col("_gone"), "left_anti")
