"""Awkward documents, and clashing column names."""

import random

from pyspark.sql import functions as F

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def text(seed, n):
    return " ".join(words(random.Random(seed), n))


def edited(t, rate, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(SYLLABLES) + "q" if rng.random() < rate else w for w in t.split(" "))


def documents(spark, rows, clash=True):
    """(doc_id, text) rows with more columns, named like those operators make."""
    d = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        for c in ("n", "k", "component", "word", "rep", "length", "_t", "_row", "h", "score"):
            d = d.withColumn(c, F.lit("clash"))
    return d


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Ünï cödé 日本語   x"), (None, "no id here at all, none"), (6, "twice twice twice twice twice twice"), (6, "twice twice twice twice twice twice"), (7, text(7, 30_000))]
