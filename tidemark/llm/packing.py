"""Best-fit packing of tokenized documents under several capacities.

Documents become pieces of at most ``capacity.tokens`` tokens. Pieces of equal
length have the same demand vector (tokens, one document, length squared of
attention), so the search runs over counts per length - at most
``capacity.tokens`` numbers however large the corpus - and yields bin patterns
with multiplicities. Lengths are placed in decreasing order, each into the open
bins that it fits under every constraint and whose residual, after placing, has
the smallest weighted norm (or the largest weighted dot product with the
demand). Pieces then take the slots of their length by rank: ranks come from
salted groups, so a length that a third of all rows share is split, and the
plan, whose size does not depend on the number of rows, is broadcast: a length
opens bins at most twice and splits a stock of alike bins at most log2(tokens)
times, as what remains of it is halved, so there are at most tokens * (2 +
log2(tokens)) stocks, each with at most sqrt(2 * tokens) different lengths - 1.7
million rows of 32 bytes for 2,048 tokens, and some thousands in practice.

Where one document may not fill a sequence because of attention, pieces are cut
to the length that may.

Edge cases: null and empty texts hold only the end id and are packed like any
other; repeated rows are packed as often as they occur; null doc_ids pass
through; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass
from itertools import chain
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import memory, saved

TOKENIZER = "word_bpe_49k.json"
END_ID = 0
CACHE_WORDS = 650_000
GROUP_BYTES = 400_000  # of texts whose new words are learned together


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence; attention is the sum of squared lengths."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048


class WordIds(dict):
    """Token ids of white-space separated chunks, as little-endian bytes.

    The tokenizer drops white space and never joins tokens across it, so a text's
    ids are those of its chunks in order. Bounded; a full memory starts anew."""

    #: Characters that follow the letters of a chunk as one more word.
    TAIL = ".,;:!?*#$%&|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self[""] = b""

    def alone(self, chunk: str) -> bytes:
        return np.array(self.tok.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, new: list[str]) -> None:
        """Encodes unknown chunks. Those of letters, with or without marks behind,
        go many in one call: they are one or two words, whose last tokens show
        where each chunk ends."""
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
            self[""] = b""
        plain, words = [], []
        for w in new:
            if w.isalpha():
                plain.append(w)
                words.append(1)
            elif w.rstrip(self.TAIL).isalpha():
                plain.append(w)
                words.append(2)
            else:
                self[w] = self.alone(w)
        for a in range(0, len(plain), 4000):
            part = plain[a : a + 4000]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.ends[ids])
            at = np.cumsum(words[a : a + 4000])
            if len(last) != at[-1]:  # letters that change when normalized
                for w in part:
                    self[w] = self.alone(w)
                continue
            raw = ids.tobytes()
            cuts = (4 * last[at - 1] + 4).tolist()
            self.update(zip(part, map(raw.__getitem__, map(slice, [0, *cuts[:-1]], cuts))))

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Ids of some texts; those of a group are learned together."""
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        flat = list(chain.from_iterable(split))
        found = list(map(self.get, flat))
        if None in found:
            new = list(dict.fromkeys([w for w, v in zip(flat, found) if v is None]))
            self.learn(new)
            found = [self[w] if v is None else v for w, v in zip(flat, found)]
        out, at = [], 0
        for chunks in split:
            out.append(b"".join(found[at : at + len(chunks)]))
            at += len(chunks)
        return out


def word_ids(path: str) -> WordIds:
    """One memory per worker process and tokenizer."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    mine = memory("packing")
    if path not in mine:
        mine[path] = WordIds(path)
    return mine[path]


def pieces(docs: DataFrame, tokenizer: str, size: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def run(batches):
        ids = word_ids(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            rows = []
            keys = b.column(0).to_pylist()
            # groups of about GROUP_BYTES, however long their texts are
            size_of = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy()
            of_group = (np.cumsum(size_of) - size_of) // GROUP_BYTES if len(keys) else size_of
            cuts = np.flatnonzero(np.r_[True, of_group[1:] != of_group[:-1], True]).tolist() if len(keys) else [0]
            for g, z in zip(cuts[:-1], cuts[1:]):
                for d, raw in zip(keys[g:z], ids.texts(b.column(1).slice(g, z - g).to_pylist())):
                    raw += end
                    n = len(raw) // 4
                    for k, a in enumerate(range(0, n, size)):
                        part = raw[4 * a : 4 * (a + size)]
                        rows.append((d, k, a, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], cap: Capacity = Capacity(), weights: tuple[float, float, float] = (1.0, 0.25, 0.25), score: str = "norm") -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for ``counts`` pieces of each length, as (how many alike, [(length,
    pieces of it in one such bin), ...])."""
    full = np.array([cap.tokens, cap.documents, cap.attention], float)
    w = np.array(weights) / full
    left = np.empty((0, 3))                # residuals of the kinds of open bins
    kinds: list[list] = []                 # per kind: (bins, pattern) in stock
    index: dict[tuple, int] = {}
    bins_of = np.empty(0, np.int64)

    def put(res, bins, pattern):
        nonlocal left, bins_of
        key = tuple(int(x) for x in res)
        k = index.get(key)
        if k is None:
            k = index[key] = len(kinds)
            kinds.append([])
            if k == len(left):
                left = np.concatenate([left, np.zeros((max(64, k), 3))])
                bins_of = np.concatenate([bins_of, np.zeros(max(64, k), np.int64)])
            left[k] = res
        kinds[k].append((bins, pattern))
        bins_of[k] += bins

    for size in sorted(counts, reverse=True):
        n = counts[size]
        need = np.array([size, 1, size * size], float)
        if (need > full).any():
            raise ValueError(f"a piece of {size} tokens exceeds the capacity")
        while n:
            m = len(kinds)
            ok = (left[:m] >= need).all(axis=1) & (bins_of[:m] > 0)
            if ok.any():
                at = np.flatnonzero(ok)
                after = (left[at] - need) * w
                cost = (after**2).sum(axis=1) if score == "norm" else -(left[at] * w * need * w).sum(axis=1)
                k = int(at[np.argmin(cost)])
                res, (bins, pattern) = left[k].copy(), kinds[k].pop()
                bins_of[k] -= bins
            else:
                res, bins, pattern = full.copy(), n, ()
            q = int(min((res // need).min(), n))
            whole = min(bins, n // q)
            put(res - q * need, whole, (*pattern, (size, q)))
            n -= whole * q
            if pattern and bins > whole:
                put(res, bins - whole, pattern)
    return [(bins, list(pattern)) for stock in kinds for bins, pattern in stock if bins]


def slots(bins: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """Per length the rows (slots before, first sequence, slots in each bin,
    offset of the first) in order of slots."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    seq = 0
    for many, pattern in bins:
        offset = 0
        for size, q in pattern:
            out.setdefault(size, []).append((taken.get(size, 0), seq, q, offset))
            taken[size] = taken.get(size, 0) + many * q
            offset += size * q
        seq += many
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, tokenizer: str, cap: Capacity = Capacity(), score: str = "norm") -> DataFrame:
    """Pieces with sequence_id and gapless offset."""
    spark = docs.sparkSession
    cut = saved(pieces(docs, tokenizer, min(cap.tokens, isqrt(cap.attention))), "pieces")
    salts = 64 + cut.count() // 1_000_000
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    per = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("c"))
    before = per.withColumn("before", F.sum("c").over(Window.partitionBy("length").orderBy("salt")) - F.col("c")).select("length", "salt", "before")
    # one row per length: cap.tokens at most
    counts = {int(r["length"]): int(r["c"]) for r in per.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    table = slots(plan(counts, cap, score=score))
    sent = spark.sparkContext.broadcast(table)
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))).join(before, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("r") - 1).alias("r"))

    def place(batches):
        for b in batches:
            length, r = b.column("length").to_numpy(), b.column("r").to_numpy()
            seq, off = np.empty(len(r), np.int64), np.empty(len(r), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.r_[True, length[order][1:] != length[order][:-1], True]) if len(r) else [0]
            for a, z in zip(cuts[:-1], cuts[1:]):
                at = order[a:z]
                rows = sent.value[int(length[at[0]])]
                k = np.searchsorted(rows[:, 0], r[at], "right") - 1
                inside = r[at] - rows[k, 0]
                seq[at] = rows[k, 1] + inside // rows[k, 2]
                off[at] = rows[k, 3] + inside % rows[k, 2] * length[at]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)], [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
