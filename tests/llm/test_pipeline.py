import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import AWKWARD, documents, edited, text
from test_decontam import brute as leaks
from test_neardup import banded, similar
from test_neardup import brute as groups
from test_quality import brute as counts
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import packing, quality


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(4)
    items = [(k, text(700 + k, 30)) for k in range(4)]
    rows = [r for r in AWKWARD if r[0] != 6]
    for k in range(120):
        base = text(k // 3 if k < 60 else 100 + k, 40 + k % 60)
        t = edited(base, rng.choice([0, 0.005, 0.02]), k)
        if k % 9 == 0:
            t = " ".join(w + "###" for w in t.split())
        if k % 11 == 0:
            t = t + " " + rng.choice(items)[1] + " end"
        if k % 7 == 0:
            t = f"mail person{k}@mail.example.com at 10.20.30.{k + 1} " + t
        rows.append((100 + k, t))
    d = str(tmp_path_factory.mktemp("sf"))
    documents(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(100 + k, int(k % 9 > 0), 0) for k in range(0, 120)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_every_stage_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rules = quality.fit(docs, labels)
    assert len(rules.rules) == 1
    texts = lambda d: [(r["doc_id"], r["text"]) for r in d.collect()]
    order = lambda x: sorted(x, key=str)
    (n1, f1), (n2, f2), (n3, f3), (n4, f4), (n5, f5) = corpus_pipeline.STAGES
    # 1: base counts, then the learned list on the same statistics
    one = f1(spark, docs, sf_dir)
    stats = {r["doc_id"]: r for r in quality.statistics(docs).select("*", *[c.alias(f"f_{k}") for k, c in quality.features().items()]).collect()}

    def stays(i, t):
        c = counts(t)
        x = {k: np.array([stats[i][f"f_{k}"]]) for k in quality.features()}
        return not (c[0] < 10 or 100 * c[4] > 20 * c[0]) and not any(quality._covers(r, x, 1)[0] for r in rules.rules)

    want = [(i, t) for i, t in rows if stays(i, t)]
    assert order(texts(one)) == order(want) and 80 < len(want) < len(rows)
    # 2: one of each group
    two = f2(spark, one, sf_dir)
    keep = {i for i, (_, _, k) in groups(want).items() if k} | {None}
    left = [(i, t) for i, t in want if i in keep]
    assert order(texts(two)) == order(left) and len(left) < len(want)
    # 3: no benchmark passage
    three = f3(spark, two, sf_dir)
    hit = {r[0] for r in leaks([x for x in left if x[0] is not None], items)}
    clean = [(i, t) for i, t in left if i not in hit]
    assert order(texts(three)) == order(clean) and hit
    # 4: entities replaced, everything else as it was
    four = f4(spark, three, sf_dir)
    mail, ip = r"person\d+@mail\.example\.com", r"10\.20\.30\.\d+"
    new = dict(texts(four))
    assert len(new) == len(clean)
    for i, t in clean:
        m = re.match(rf"mail {mail} at {ip} (.*)$", t)
        assert new[i] == t if not m else re.fullmatch(r"mail \S+@\S+\.com at [\d.]+ (.*)", new[i])[1] == m[1] and not re.search(f"{mail}|{ip}", new[i])
    assert all(d.columns == docs.columns for d in (one, two, three, four))
    # 5: all of it packed
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    five = f5(spark, four, sf_dir).collect()
    ids = {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in new.items()}
    for r in five:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    assert sum(r["length"] for r in five) == sum(map(len, ids.values()))
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert order(map(tuple, whole)) == order(map(tuple, five)) or order(tuple(r)[:5] for r in whole) == order(tuple(r)[:5] for r in five)


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_near_duplicates_from_similarity_080(spark, sf_dir):
    rows = banded()
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, documents(spark, rows), sf_dir).collect()}
    assert kept == set(similar(rows, 80).values()) != set(similar(rows, 85).values())
