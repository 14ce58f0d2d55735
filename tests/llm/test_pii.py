import hashlib
import re

import pytest
from cases import documents
from pyspark.sql import functions as F

from tidemark.llm import pii

ROWS = [
    (1, "Call Mr. Adam Smith at +1 (456) 555-2186 or +1 456 555 2186; mail ab.c@mail6.example.com, AB.C@mail6.example.com ip 92.195.224.80."),
    (2, 'Frau Müller token = "0641917ea4e9feb9cda83477b57ac2654884f485" password=f8cb0ab732d29a210e 4495114827612972 x 123-45-6789'),
    (3, None), (4, ""), (5, "Госпожа Вера Иванова и Κύριος Νίκος"), (6, "nothing here 12, 1.2.3, 99999 a@b"), (None, "ip 92.195.224.80"), (2, "x"),
    (8, "ab.c@mail6.example.com"), (9, "word " * 30_000 + "ab.c@mail6.example.com" + " end" * 10),
]


@pytest.fixture(scope="module")
def out(spark):
    docs = documents(spark, ROWS)
    got = pii.replace_entities(docs, "k1")
    assert got.columns == [*docs.columns, "n_entities"]
    return got.select("doc_id", "text", "n_entities", "lang").collect()


def test_kinds_formats_and_coreference(out):
    by = {(r["doc_id"], len(r["text"] or "")): r for r in out}
    a = next(r for r in out if r["doc_id"] == 1)
    assert a["n_entities"] == 6
    m = re.fullmatch(r"Call Mr\. (\w+) (\w{5}) at \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3}) (\d{3}) (\d{4}); mail (\S+), (\S+) ip (\S+)\.", a["text"])
    assert m and m[1] in pii.GIVEN["latin", "m"].split() and m[2] != "Smith"
    assert m.group(3, 4, 5) == m.group(6, 7, 8) != ("456", "555", "2186")
    assert m[9] == m[10].lower() and m[9].endswith(".com") and m[9] != "ab.c@mail6.example.com" and m[10][:2].isupper()
    assert all(1 <= int(x) <= 254 for x in m[11].split(".")) and m[11] != "92.195.224.80"
    # the same entity elsewhere
    assert next(r for r in out if r["doc_id"] is None)["text"] == f"ip {m[11]}"
    assert next(r for r in out if r["doc_id"] == 8)["text"] == m[9]
    assert next(r for r in out if r["doc_id"] == 9)["text"] == "word " * 30_000 + m[9] + " end" * 10
    b = next(r for r in out if r["doc_id"] == 2 and r["n_entities"])
    m = re.fullmatch(r'Frau (M\S{5}|\S{6}) token = "([0-9a-f]{40})" password=([0-9a-f]{18}) (4\d{15}) x (\d{3}-\d\d-\d{4})', b["text"])
    assert m and b["n_entities"] == 5
    digits = [int(x) for x in m[4]]
    assert sum(x if k % 2 else x * 2 - 9 * (x > 4) for k, x in enumerate(digits)) % 10 == 0
    c = next(r for r in out if r["doc_id"] == 5)["text"]
    m = re.fullmatch(r"Госпожа (\w+) (\w{7}) и Κύριος (\w+)", c)
    assert m[1] in pii.GIVEN["cyrillic", "f"].split() and re.fullmatch("[А-я]+", m[2]) and re.match("[Α-Ωά-ώ]", m[3])
    assert by


def test_texts_without_entities_stay(out):
    same = {r["doc_id"]: r for r in out if r["doc_id"] in (3, 4, 6)}
    assert (same[3]["text"], same[4]["text"], same[6]["text"]) == (None, "", ROWS[5][1])
    assert all(r["n_entities"] == 0 for r in same.values())


def test_keys_matter_and_empty_table(spark, out):
    docs = documents(spark, ROWS[:2])
    other = [r["text"] for r in pii.replace_entities(docs, "k2").collect()]
    assert other != [r["text"] for r in out if r["doc_id"] in (1, 2) and r["n_entities"]]
    assert pii.replace_entities(docs.limit(0), "k").count() == 0


@pytest.mark.parametrize("bound", [10**6, 0])
def test_collisions_are_drawn_again(spark, monkeypatch, bound):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", bound)
    # octets of one digit have few replacements, so many collide at first
    ips = [f"{a}.{b}.{c}.1" for a in range(1, 10) for b in range(1, 10) for c in range(1, 6)]
    docs = documents(spark, [(k, f"at {ip} and {ip}") for k, ip in enumerate(ips)])
    assert pii.redrawn(pii.found_in(docs), "k").count() > 0
    got = pii.replace_entities(docs, "k").orderBy("doc_id").collect()
    new = [re.fullmatch(r"at (\S+) and (\S+)", r["text"]).groups() for r in got]
    assert all(a == b for a, b in new)
    assert len({a for a, _ in new}) == len(ips) and not {a for a, _ in new} & set(ips)


def test_no_python_in_the_plan(spark):
    d = documents(spark, ROWS)
    plan = d.select(pii.surrogate(F.col("text"), F.lit(0), "k"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_nearly_taken_formats_are_widened(spark):
    """All 105 lone names of a consonant and a vowel; all one-digit addresses."""
    names = [f"Mr {c}{v}" for c in "BCDFGHJKLMNPQRSTVWXYZ" for v in "aeiou"]
    ips = [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)]
    got = pii.replace_entities(documents(spark, list(enumerate(names + ips))), "k").orderBy("doc_id").collect()
    new = [r["text"] for r in got]
    assert len(set(new)) == len(new) and not set(new) & {*names, *ips}
    assert all(re.fullmatch(r"Mr [A-Z][a-z]+", x) for x in new[:105])
    assert all(all(1 <= int(o) <= 254 for o in x.split(".")) for x in new[105:])


def plain(e: str, attempt: int, key: str) -> str:
    """surrogate() for Latin letters, in Python."""
    titles = rf"(?:{pii.MALE}|{pii.FEMALE})"
    kind = (
        "email" if "@" in e else "name" if re.match(rf"{titles}\b", e) else "card" if re.fullmatch(r"(?:[0-9]{4}[ \-]?){3}[0-9]{4}", e)
        else "ip" if re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", e) else "ssn" if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", e)
        else "phone" if re.match(r"[+(]", e) else "secret"
    )
    body = re.sub("[^0-9]", "", e) if kind in ("card", "ssn", "phone") else e.lower() if kind == "email" else e.replace(".", "") if kind == "name" else e
    digest = b"".join(hashlib.sha512(f"{key}|{j}|{kind}:{body}|{attempt}".encode()).digest() for j in range(2))
    swap = lambda c, x, hexa=False: "abcdef"[x % 6] if hexa and c in "abcdef" else next((g[x % len(g)] for g in pii.GROUPS if c in g), c)
    more = "".join(swap(("00" if kind in ("phone", "ssn") else "ab")[k % 2], digest[(k + 90) % 128]) for k in range(pii.WIDE, attempt + 1)) if kind not in ("card", "ip") else ""
    if kind == "ip":
        out = []
        for k, o in enumerate(e.split(".")):
            x = digest[2 * k] * 256 + digest[2 * k + 1]
            out.append(1 + x % 254 if attempt >= pii.WIDE else 100 + x % 155 if len(o) == 3 else 10 + x % 90 if len(o) == 2 else 1 + x % 9)
        return ".".join(map(str, out))
    m = re.match(rf"\+[0-9]{{1,3}}(?=[ .\-(])[ .\-]?|\+[0-9]{{2}}|[0-9](?=[0-9 \-]{{14,}}$)|{titles}\b\.? ", e)
    head, rest, tail, given = m[0] if m else "", e[len(m[0]) if m else 0 :], "", ""
    if kind == "email":
        rest, tail = re.fullmatch(r"(.*)(\.[^.]*)", rest).groups()
    elif kind == "card":
        rest = rest[:-1]
    elif kind == "name" and " " in rest:
        names = pii.GIVEN["latin", "m" if re.match(rf"(?:{pii.MALE})\b", e) else "f"].split()
        given, rest = names[(digest[0] * 256 + digest[1]) % len(names)], rest[rest.index(" ") :]
    hexa = bool(re.fullmatch("[0-9a-f]+", rest))
    out, rank = "", 0
    for c in rest:
        rank += c.isalpha() or c.isdigit()
        out += swap(c, digest[rank % 128], hexa)
    out = head + given + (more + out if kind == "email" else out + more) + tail
    if kind == "card":
        total = sum((x * 2 - 9 * (x > 4)) if k % 2 == 0 else x for k, x in enumerate(int(c) for c in out if c.isdigit()))
        out += str(-total % 10)
    return out


def test_surrogates_equal_plain_python(spark):
    some = [
        "ab.c@mail6.example.com", "AB_c@x.org", "Mr. Adam Smith", "Frau Keller", "Miss Ada Lovelace", "4495114827612972", "4495 1148 2761 2972", "92.195.224.80", "1.2.33.4",
        "123-45-6789", "+1 (456) 555-2186", "+49 456 555 2186", "+491234567890", "0641917ea4e9feb9cda83477b57ac2654884f485", "Zq-9_xx80",
    ]
    rows = spark.createDataFrame([(e, n) for e in some for n in (0, 1, 3, 4, 7)], "e string, n int")
    for r in rows.select("e", "n", pii.surrogate(F.col("e"), F.col("n"), "key").alias("s")).collect():
        assert r["s"] == plain(r["e"], r["n"], "key"), (r["e"], r["n"])
