"""Language of web pages by Bayesian evidence fusion.

Four pieces of evidence are added as log-likelihoods: the visible text under
byte-trigram models, the language declared in the markup, the address suffix and
first path label, and a prior of the host. The text models come from a bounded
sample of labelled documents; how far markup and address can be trusted, and the
host priors, come from counts over all pages, grouped and pre-aggregated. Host
priors are smoothed towards their domain, domains towards the whole.

Edge cases: null or empty html gives no text and no declaration, a null or odd
url no host and no suffix; such pages get the overall prior from what is left.
Repeated rows and null ids are judged like any other; ties go to the language
first in order; without labelled documents lang is null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let, saved

FIT_ROWS = 4000
#: Trigrams of a text are far from independent: its mean log-likelihood counts
#: as that of so many of them at most.
EVIDENCE = 60
TABLE = 1 << 16
ALPHA = 20.0  # pages that a parent's prior counts as
BROADCAST_ROWS = 200_000

_HIDDEN = re.compile(r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_OPEN = re.compile(r"(?i)<!--|<(script|style|html|meta)\b")
_CLOSE = {k: re.compile(rf"(?i)</{k}\b") for k in ("script", "style")}
_LANG = re.compile(r"""(?i)\blang\s*=\s*(?:["']\s*)?([a-z]{2,3})\b""")
_NAMED = re.compile(r"""(?i)content-language["']""")
_CONTENT = re.compile(r"""(?i)content\s*=\s*["']\s*([a-z]{2,3})\b""")
_SKIP = re.compile(r"[^\W\d_]+")


def visible(html: str | None) -> str:
    return _html.unescape(_HIDDEN.sub(" ", html or ""))


def declared(html: str | None) -> str | None:
    """The language of the first html or meta tag of the whole page that tells
    one. What comments, scripts and styles hold is passed over; one that is never
    closed is text. Nothing is read twice, so the time is linear."""
    t, at, open_ended = html or "", 0, set()
    while m := _OPEN.search(t, at):
        at, kind = m.end(), (m[1] or "").lower()
        if kind in open_ended:
            continue
        if kind in ("html", "meta"):
            end = t.find(">", at)
            tag = t[at:end] if end >= 0 else t[at:]
            named = _NAMED.search(tag) if kind == "meta" else None
            found = _LANG.search(tag) if kind == "html" else named and _CONTENT.search(tag, named.end())
            if found:
                return found[1].lower()
            if end < 0:
                open_ended.add(kind)
            else:
                at = end
        elif kind:
            close = _CLOSE[kind].search(t, at)
            at = close.end() if close else at
            if not close:
                open_ended.add(kind)
        else:
            end = t.find("-->", m.start() + 2)
            at = end + 3 if end >= 0 else at
            if end < 0:
                open_ended.add(kind)
    return None


def grams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the letters of a text."""
    b = np.frombuffer((" " + " ".join(_SKIP.findall(text.lower())) + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    h = b[:-2] * np.uint32(40503) + b[1:-1] * np.uint32(2654435) + b[2:] * np.uint32(97531)
    return (h ^ (h >> np.uint32(16))) & np.uint32(TABLE - 1) if len(b) > 2 else np.empty(0, np.uint32)


class TextModel:
    """Byte-trigram log-probabilities by language."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.langs = sorted({lang for _, lang in rows})
        counts = np.full((max(len(self.langs), 1), TABLE), 0.1)
        for text, lang in rows:
            counts[self.langs.index(lang)] += np.bincount(grams(text or ""), minlength=TABLE)
        self.lp = np.ascontiguousarray(np.log(counts / counts.sum(1, keepdims=True)).T.astype(np.float32))

    def evidence(self, text: str) -> np.ndarray:
        g = grams(text)
        if not len(g):
            return np.zeros(len(self.langs))
        n = np.bincount(g, minlength=TABLE) if len(g) > TABLE else None
        mean = (n @ self.lp if n is not None else self.lp[g].sum(0, dtype=np.float64)) / len(g)
        return mean * min(len(g), EVIDENCE)


def fit(documents: DataFrame, rows: int = FIT_ROWS) -> TextModel:
    """From at most ``rows`` documents with a language, those of the smallest
    key hashes."""
    picked = documents.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(rows)
    got = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "lang").collect()
    return TextModel(sorted((r["text"] or "", r["lang"]) for r in got))


def _read(sent):
    def run(batches):
        model = sent.value
        for b in batches:
            say, seen = [], []
            for h in b.column(2):
                t = h.as_py()
                say.append(declared(t))
                seen.append(model.evidence(visible(t)).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(say, pa.string()), pa.array(seen, pa.list_(pa.float64()))], ["page_id", "url", "declared", "text_ll"])

    return run


def address(pages: DataFrame) -> DataFrame:
    """host, domain (its last two labels), suffix (last label) and first path
    label of two letters; null where the url has none."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    path = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    blank = lambda c: F.when(F.length(c) > 0, c)
    labels = F.split(host, r"\.")
    return pages.select(
        "page_id", "declared", "text_ll", blank(host).alias("host"),
        blank(F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")).alias("domain"),
        F.concat_ws("/", blank(F.substring_index(host, ".", -1)), blank(path)).alias("suffix"),
    )


def _argmax(values, langs):
    """The language of the largest value, the first in order of equal ones."""
    return let(values, lambda v: F.get(F.lit(langs), F.array_position(v, F.array_max(v)).cast("int") - 1))


def identify(pages: DataFrame, model: TextModel) -> DataFrame:
    """page_id, lang, probability, text_lang, declared, host for every row."""
    spark = pages.sparkSession
    langs = model.langs
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    if not langs:
        return rows.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("host"))
    sent = spark.sparkContext.broadcast(model)  # TABLE x languages numbers
    read = rows.mapInArrow(_read(sent), "page_id long, url string, declared string, text_ll array<double>")
    told = saved(address(read).withColumn("text_lang", _argmax(F.col("text_ll"), langs)), "evidence")
    count_of = [F.count_if(F.col("text_lang") == x).cast("double").alias(f"n{k}") for k, x in enumerate(langs)]
    ns = [f"n{k}" for k in range(len(langs))]
    by_host = told.groupBy("host", "domain").agg(*count_of)
    by_domain = by_host.groupBy("domain").agg(*[F.sum(n).alias(n) for n in ns])
    overall = by_domain.agg(*[F.sum(n).alias(n) for n in ns]).first()
    total = sum(overall[n] or 0.0 for n in ns)
    root = [((overall[n] or 0.0) + 1.0) / (total + len(ns)) for n in ns]
    smooth = lambda own, parent: F.array(*[(F.coalesce(own(n), F.lit(0.0)) + ALPHA * parent(k)) / (sum((F.coalesce(own(m), F.lit(0.0)) for m in ns), F.lit(0.0)) + ALPHA) for k, n in enumerate(ns)])
    domains = by_domain.where("domain IS NOT NULL").select("domain", smooth(lambda n: F.col(n), lambda k: F.lit(root[k])).alias("dp"))
    priors = saved(
        by_host.where("host IS NOT NULL").join(domains, "domain").select("host", smooth(lambda n: F.col(n), lambda k: F.get("dp", F.lit(k))).alias("prior")),
        "host-priors",
    )
    few = priors.count() <= BROADCAST_ROWS

    def trust(column: str) -> DataFrame:
        """log P(value | language) of a small set of values, by counts."""
        own = told.where(F.col(column).isNotNull()).groupBy(column).agg(*count_of)
        each = own.agg(*[F.sum(n).alias(n) for n in ns], F.count(F.lit(1)).alias("kinds")).first()
        kinds = each["kinds"] + 1
        return own.select(column, F.array(*[F.log((F.col(n) + 0.5) / F.lit((each[n] or 0.0) + 0.5 * kinds)) for n in ns]).alias(f"{column}_ll"))

    # joins on values that a third of all rows may share: skewed sides are split
    out = told.join(F.broadcast(priors) if few else priors, "host", "left")
    for column in ("declared", "suffix"):
        t = saved(trust(column), "trust")
        out = out.join(F.broadcast(t) if t.count() <= BROADCAST_ROWS else t, column, "left")
    at = lambda c, k: F.coalesce(F.get(c, F.lit(k)), F.lit(0.0))
    fused = F.array(*[
        at("text_ll", k) + at("declared_ll", k) + at("suffix_ll", k) + F.log(F.coalesce(F.get("prior", F.lit(k)), F.lit(root[k])))
        for k in range(len(langs))
    ])
    share = lambda v: let(F.array_max(v), lambda m: F.lit(1.0) / F.aggregate(v, F.lit(0.0), lambda a, x: a + F.exp(x - m)))
    return out.select("page_id", "text_lang", "declared", "host", fused.alias("v")).select("page_id", _argmax(F.col("v"), langs).alias("lang"), share(F.col("v")).alias("probability"), "text_lang", "declared", "host")
