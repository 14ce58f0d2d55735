"""Quality rules: decision lists learned by sequential covering.

Statistics are native column expressions over whole texts. A bounded sample of
labelled statistics is read by the driver, which grows and prunes conjunctions
of thresholds and emits one ordered conditional expression; that expression is
then evaluated on every row without Python.

Edge cases: a null or empty text has no words, all counts 0 and fails the base
rules; rows are judged one by one, so repeated rows and ties get equal verdicts;
an empty table gives an empty result; without labels (or with one class only)
the list is empty and only the base rules decide. Columns of the input other
than the key and the text are ignored by :func:`judge` and kept by
:func:`filter_documents`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_col

#: Labelled rows that a fit may read, chosen by hash of the key.
FIT_ROWS = 20_000
WINDOW = 5
#: Fixed: characters that the contract counts as symbols.
SYMBOLS = "[#*$%&|<>]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside the windows of 5 words that occur twice or more."""
    n = WINDOW

    def windows(w: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(w) - n),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]),
        )
        return F.when(F.size(w) >= n, each).otherwise(F.array().cast("array<bigint>"))

    def repeated(h: Column) -> Column:
        once_sorted = F.sort_array(h)
        any_twice = let(once_sorted, lambda s: F.exists(F.sequence(F.lit(1), F.greatest(F.size(s) - 1, F.lit(1))), lambda i: F.coalesce(F.get(s, i) == F.get(s, i - 1), F.lit(False))))
        keyed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def places(s: Column) -> Column:
            twin = lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["p"]))

        def covered(p: Column) -> Column:
            widths = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(n)), F.lit(n)))
            return F.aggregate(widths, F.lit(0), lambda a, x: a + x)

        return F.when(any_twice, let(let(keyed, places), covered)).otherwise(F.lit(0))

    return let(windows(words), repeated)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and statistics of every whole text, all native."""
    t = F.coalesce(F.col(text), F.lit(""))

    def counted(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        )

    return docs.select(F.col(key), t.alias("_t")).select(
        key,
        let(words_col(F.col("_t")), counted).alias("_w"),
        (F.length("_t") - F.regexp_count("_t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _dup_lines(F.col("_t")).alias("n_dup_lines"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("_t", F.lit("!")).cast("long").alias("n_bang"),
        F.regexp_count("_t", F.lit("[0-9]")).cast("long").alias("n_digits"),
    ).select(key, F.col("_w.n_words").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
             F.col("_w.n_repeat_words").alias("n_repeat_words"), "n_upper", "n_bang", "n_digits")


def _dup_lines(t: Column) -> Column:
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Ratios that the learner may test; all finite for every text."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_rate": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "bang_share": F.col("n_bang") / chars,
        "digit_share": F.col("n_digits") / chars,
    }


@dataclass(frozen=True)
class Test:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        c = features()[self.feature]
        return c >= F.lit(self.threshold) if self.at_least else c <= F.lit(self.threshold)

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] <= self.threshold


class DecisionList:
    """Ordered conjunctions; the first that holds rejects, else the row stays."""

    def __init__(self, rules: list[tuple[Test, ...]]):
        self.rules = rules

    def kept(self) -> Column:
        if not self.rules:
            return F.lit(True)
        out = None
        for rule in self.rules:
            cond = rule[0].column()
            for test in rule[1:]:
                cond = cond & test.column()
            out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
        return out.otherwise(F.lit(True))

    def describe(self) -> list[str]:
        return [" AND ".join(f"{t.feature} {'>=' if t.at_least else '<='} {t.threshold:.6g}" for t in r) for r in self.rules]


def _covers(rule, x, n):
    m = np.ones(n, bool)
    for t in rule:
        m &= t.holds(x)
    return m


def cover(x: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.97, min_support: int = 8, max_tests: int = 4, cuts: int = 64) -> DecisionList:
    """Sequential covering for the rejected class: grow on two thirds by
    information gain, prune on one third by (p - n) / (p + n), keep a rule only
    if it is precise on both, remove what it covers, repeat."""
    n = len(bad)
    part = np.arange(n) % 3 == 2
    left, rules = np.ones(n, bool), []
    while (left & bad & ~part).sum() >= min_support:
        rule: list[Test] = []
        grow = left & ~part
        cur = grow.copy()
        while len(rule) < max_tests:
            p0, n0 = (cur & bad).sum(), (cur & ~bad).sum()
            if n0 == 0:
                break
            best, base = (1e-9, None), np.log2(p0 / (p0 + n0))
            for f, v in x.items():
                # Cuts lie midway between neighbouring values of the bad rows.
                u = np.unique(v[cur])
                if len(u) < 2:
                    continue
                u = (u[1:] + u[:-1]) / 2
                cand = np.unique(np.concatenate([u[np.linspace(0, len(u) - 1, min(cuts, len(u))).astype(int)], np.quantile(v[cur & bad], np.linspace(0, 1, 17))]))
                order = np.sort(v[cur & bad]), np.sort(v[cur & ~bad])
                for up in (True, False):
                    if up:
                        p = len(order[0]) - np.searchsorted(order[0], cand, "left")
                        q = len(order[1]) - np.searchsorted(order[1], cand, "left")
                    else:
                        p, q = (np.searchsorted(o, cand, "right") for o in order)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = np.where(p >= min_support, p * (np.log2(p / np.maximum(p + q, 1)) - base), -1.0)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), Test(f, up, float(cand[k])))
            if best[1] is None:
                break
            rule.append(best[1])
            cur &= best[1].holds(x)
        if not rule:
            break
        held = left & part

        def value(r):
            c = _covers(r, x, n) & held
            p, q = (c & bad).sum(), (c & ~bad).sum()
            return (p - q) / (p + q) if p + q else -1.0

        while len(rule) > 1 and value(rule[:-1]) >= value(rule):
            rule = rule[:-1]
        c = _covers(rule, x, n) & left
        p, q = (c & bad).sum(), (c & ~bad).sum()
        ph, qh = (c & held & bad).sum(), (c & held & ~bad).sum()
        if p < min_support or p / (p + q) < min_precision or (ph + qh and ph / (ph + qh) < min_precision):
            break
        rules.append(tuple(rule))
        left &= ~c
    return DecisionList(rules)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows: int = FIT_ROWS) -> DecisionList:
    """Learns from at most ``rows`` labelled documents, those of the smallest
    key hashes; labels other than 0 and 1 and null keys are ignored."""
    picked = (
        labels.select(F.col(key), F.col("quality").alias("_quality")).where(F.col("_quality").isin(0, 1) & F.col(key).isNotNull())
        .groupBy(key).agg(F.min("_quality").alias("_quality"))
        .orderBy(F.xxhash64(key), key).limit(rows)
    )
    sample = docs.select(key, text).join(F.broadcast(picked), key)  # at most `rows` keys
    stats = statistics(sample, key, text).join(F.broadcast(picked), key).where(~base_failed())
    names = list(features())
    got = stats.select(F.xxhash64(key).alias("_o"), key, "_quality", *[c.alias(f"_f{i}") for i, c in enumerate(features().values())]).collect()
    got.sort(key=lambda r: (r[0], r[1]))
    if not got:
        return DecisionList([])
    x = {f: np.array([r[f"_f{i}"] for r in got], float) for i, f in enumerate(names)}
    bad = np.array([r["_quality"] == 0 for r in got])
    if not bad.any() or bad.all():
        return DecisionList([])
    return cover(x, bad)


def judge(docs: DataFrame, rules: DecisionList, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, counts, base_failed and kept for every row."""
    return statistics(docs, key, text).select(
        key, *COUNTS, base_failed().alias("base_failed"), (~base_failed() & rules.kept()).alias("kept")
    )


def filter_documents(docs: DataFrame, rules: DecisionList, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns; row by row,
    without a shuffle."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    row = docs.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)]).alias("_row"), F.col(text).alias("_text"))
    judged = statistics(row, "_row", "_text").where(~base_failed() & rules.kept())
    return judged.select(*[F.col(f"_row.{n}").alias(c) for c, n in zip(docs.columns, names)])
