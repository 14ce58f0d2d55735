"""Token counts by a compiled finite-state transducer.

The byte-level BPE vocabulary and its pre-tokenizer are compiled into one
deterministic transducer over characters. A state holds what of the text before
it can still matter: the open piece's kind and, for every suffix that is a proper
prefix of a longer vocabulary entry, its trie node, the last token before it and
its token count relative to now. Appending a byte then determines the last token
of the longer prefix without re-tokenizing: it is the one vocabulary suffix whose
predecessor token may stand before it. Each transition carries the number of
tokens it adds (negative when a merge swallows earlier ones), so the count of a
text is the sum along its path. States are compiled when first reached and
remembered; a full memory is compiled anew.

Long texts are cut into chunks. A chunk's state map is constant from its first
synchronizing place on - before a space that follows a non-space and precedes a
letter, any state has closed its piece - so the map is the text before that
place plus one (state, count). Maps compose associatively, and a prefix scan over
them yields the state before every chunk.

Edge cases: a null or empty text has 0 bytes and 0 tokens; texts are counted one
by one, so repeats and ties agree; null doc_ids pass through; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import accumulate
from operator import attrgetter, getitem

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
CHUNK = 1 << 16
MAX_STATES = 300_000

#: Fixed: characters with the Unicode property White_Space.
SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0                　")
_LETTER, _NUMBER = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
EMPTY = ((0, -1, 0),)


def sort_of(ch: str) -> str:
    return "S" if ch in SPACES else "L" if _LETTER.match(ch) else "N" if _NUMBER.match(ch) else "P"


def byte_alphabet() -> dict[str, int]:
    """The vocabulary's printable stand-ins of the 256 bytes: printable Latin-1
    bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class State(dict):
    """A compiled state: its transitions so far, and the tokens added on entry."""

    __slots__ = ("e", "key", "machine")

    def __missing__(self, ch: str) -> "State":
        return self.machine.compile(self, ch)


class Transducer:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        alphabet = byte_alphabet()
        self.special = [t["content"] for t in spec["added_tokens"]]
        special = set(self.special)
        text_of = lambda s: bytes(alphabet[c] for c in s)
        self.bytes_of = {i: text_of(s) for s, i in spec["model"]["vocab"].items() if s not in special}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.rank, self.parts = {}, {}
        for k, (a, b) in enumerate(pairs):
            x, y = text_of(a), text_of(b)
            left, right = self.id_of[x], self.id_of[y]
            self.rank[left, right] = k
            self.parts.setdefault(self.id_of[x + y], (left, right, k))
        self.edges: dict[tuple[int, int], list] = {}
        # Trie: children by (node, byte); token that ends at a node; whether it goes on.
        self.child: dict[tuple[int, int], int] = {}
        self.token_at: dict[int, int] = {}
        self.inner = {0}
        size = 1
        for b, i in self.id_of.items():
            node = 0
            for x in b:
                nxt = self.child.get((node, x))
                if nxt is None:
                    nxt = self.child[node, x] = size
                    size += 1
                    self.inner.add(node)
                node = nxt
            self.token_at[node] = i
        self.fits: dict[tuple[int, int], bool] = {}
        self.fed: dict[tuple, tuple] = {}
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.fed.clear()
        if len(self.fits) > 2 * MAX_STATES:
            self.fits.clear()
        self.root = self.state(("0",), 0)

    def state(self, key: tuple, e: int) -> State:
        s = self.states.get((key, e))
        if s is None:
            s = self.states[key, e] = State()
            s.e, s.key, s.machine = e, key, self
        return s

    # -- within a piece

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts at a token's left (0) or right (1) edge while it is merged,
        each with the rank of the merge that takes it up."""
        got = self.edges.get((token, side))
        if got is None:
            got, until, t = [], float("inf"), token
            while True:
                got.append((t, until))
                parts = self.parts.get(t)
                if parts is None:
                    break
                t, until = parts[side], parts[2]
            self.edges[token, side] = got
        return got

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging leaves token a before token b as they are: no merge
        across the border comes before those that take its sides up. Of equal
        merges the left one is first."""
        got = self.fits.get((a, b))
        if got is None:
            rank, left = self.rank, self.edge(b, 0)
            got = True
            for x, x_until in self.edge(a, 1):
                for y, y_until in left:
                    r = rank.get((x, y))
                    if r is not None and r < x_until and r <= y_until:
                        got = False
                        break
                if not got:
                    break
            self.fits[a, b] = got
        return got

    def step(self, b: tuple, byte: int) -> tuple[tuple, int]:
        """State and added tokens of a piece after one more byte."""
        chosen, grown = None, []
        for node, last, off in b:  # longest suffix first
            nxt = self.child.get((node, byte))
            if nxt is None:
                continue
            t = self.token_at.get(nxt)
            if chosen is None and t is not None and (last < 0 or self.may_follow(last, t)):
                chosen = t, off + 1
            if nxt in self.inner:
                grown.append((nxt, last, off))
        t, add = chosen
        return (*((n, last, off - add) for n, last, off in grown), (0, t, 0)), add

    def feed(self, b: tuple, ch: str) -> tuple[tuple, int]:
        got = self.fed.get((b, ch))
        if got is None:
            if len(self.fed) > 50_000:
                self.fed.clear()
            s, total = b, 0
            for x in ch.encode("utf-8", "surrogatepass"):
                s, d = self.step(s, x)
                total += d
            got = self.fed[b, ch] = s, total
        return got

    def tokens(self, piece: str) -> int:
        b, n = EMPTY, 0
        for ch in piece:
            b, d = self.feed(b, ch)
            n += d
        return n

    # -- across pieces

    def begin(self, ch: str) -> tuple[tuple, int]:
        b, d = self.feed(EMPTY, ch)
        k = sort_of(ch)
        if k == "S":
            return ("S", EMPTY, b, d, ch), d
        return ("A" if ch == "'" else k, b), d

    def move(self, key: tuple, ch: str) -> tuple[tuple, int]:
        """Next state and change of the token count, were the text to end here."""
        kind, k = key[0], sort_of(ch)
        if kind == "S":
            _, before, b, d, last = key
            if k == "S":
                nb, nd = self.feed(b, ch)
                return ("S", b, nb, nd, ch), nd
            if last == " ":  # the run gives its last space to the piece
                nb, n1 = self.feed(EMPTY, " ")
                nb, n2 = self.feed(nb, ch)
                return (k, nb), n1 + n2 - d
            new, n = self.begin(ch)
            return new, self.tokens(last) - d + n
        if kind == "A":
            if ch in "stmd":
                return ("0",), self.tokens("'" + ch) - 1
            if ch in "rvl":
                return ("A" + ch,), self.tokens(ch)
            kind = "P"
        elif kind[0] == "A":
            if kind + ch in ("Are", "Ave", "All"):
                return ("0",), self.tokens("'" + kind[1] + ch) - 1 - self.tokens(kind[1])
            key, kind = ("L", self.feed(EMPTY, kind[1])[0]), "L"
        if kind == k:
            nb, d = self.feed(key[1], ch)
            return (kind, nb), d
        return self.begin(ch)

    def compile(self, s: State, ch: str) -> State:
        key, e = self.move(s.key, ch)
        t = s[ch] = self.state(key, e)
        return t

    # -- texts

    def plain(self, text: str) -> int:
        if len(self.states) > MAX_STATES:
            self.reset()
        if len(text) <= CHUNK:
            return sum(map(attrgetter("e"), accumulate(text, getitem, initial=self.root)))
        maps = [chunk_map(self, text[a : a + CHUNK]) for a in range(0, len(text), CHUNK)]
        whole = prefix_scan(self, maps)[-1]
        return self.walk(self.root, whole.head)[1] + whole.tokens

    def walk(self, s: State, text: str) -> tuple[State, int]:
        """The state after a text and the tokens on the way."""
        n = 0
        for ch in text:
            s = s[ch]
            n += s.e
        return s, n

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; special strings are tokens of their own."""
        if not text:
            return 0
        if self.split and any(s in text for s in self.special):
            parts = self.split.split(text)
            return sum(map(self.plain, parts)) + len(parts) - 1
        return self.plain(text)


@dataclass
class ChunkMap:
    """Any state -> (text to run first, then a constant state and token count);
    without a synchronizing place the whole chunk is still to be run."""

    head: str
    state: State | None
    tokens: int


def chunk_map(m: Transducer, text: str) -> ChunkMap:
    at = next((k for k in range(1, len(text)) if text[k] == " " and text[k - 1] not in SPACES), None)
    if at is None:
        return ChunkMap(text, None, 0)
    # Any state that is not inside white space goes to the same one here.
    s, n = m.walk(m.root, text[at:])
    return ChunkMap(text[:at], s, n)


def compose(m: Transducer, x: ChunkMap, y: ChunkMap) -> ChunkMap:
    """First x, then y."""
    if x.state is None:
        return ChunkMap(x.head + y.head, y.state, y.tokens)
    s, n = m.walk(x.state, y.head)
    return ChunkMap(x.head, s if y.state is None else y.state, x.tokens + n + (0 if y.state is None else y.tokens))


def prefix_scan(m: Transducer, maps: list[ChunkMap]) -> list[ChunkMap]:
    """Compositions of every prefix; pairs first, so that all steps of a level
    are independent."""
    if len(maps) < 2:
        return maps
    pairs = [compose(m, maps[k], maps[k + 1]) for k in range(0, len(maps) - 1, 2)]
    odd = prefix_scan(m, pairs)
    out = [maps[0]]
    for k in range(1, len(maps)):
        out.append(odd[k // 2] if k % 2 else compose(m, odd[k // 2 - 1], maps[k]))
    return out


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker process and vocabulary."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""

    def run(batches):
        import gc

        gc.disable()  # the states hold no garbage
        try:
            m = transducer(path)
            for b in batches:
                n = [m.count(t.as_py()) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
        finally:
            gc.enable()

    t = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("text"), F.octet_length(t).cast("long").alias("n_bytes")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
