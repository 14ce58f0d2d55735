"""Surrogates for personal data, in native column expressions only.

Entities (e-mail addresses, phone numbers, IPv4 addresses, card numbers,
social-security numbers, secrets after a key word, names after a title) are
found by one pattern. A keyed digest of the entity's canonical form drives its
replacement: digits become digits, hex stays hex, letters stay letters of their
script and case, vowels stay vowels, octets stay octets, cards keep the issuer
digit and a valid check digit, given names come from the list of the title's
gender and the name's script. Equal entities, also when formatted differently,
get equal replacements.

Collision checks run on the distinct entities, aggregated before they are
shuffled: a replacement that another entity has too, or that is itself an entity
of the corpus, is drawn again with the next attempt number. From attempt ``WIDE``
on a format that is nearly taken is widened, by one more character with each
attempt: names, phone and social-security numbers at the end, addresses of
e-mails at the start, secrets at the end; octets are then of any number of digits.
So rounds end, whatever share of a format the corpus holds; cards, with 10^14
forms, keep theirs. Texts are then rewritten row by row; only texts with entities
drawn again need a look-up, joined by the text's hash and broadcast when counted to
be small.

Coreference is by canonical form: titles count, so "Mr Adam Smith", "Mr Smith" and
"Herr Smith" are three entities.

Edge cases: a null text stays null, an empty one empty; rows are independent of
doc_id, so nulls and repeats there are harmless; ties are broken by the smaller
canonical form; an empty table gives an empty result; other columns pass
through. A text without entities is returned as it was, character by character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, saved

BROADCAST_ROWS = 200_000
WIDE = 4  # attempts in an entity's own format

#: Fixed: titles by gender, in the languages covered.
MALE = "Mr|Mister|Herr|Señor|Monsieur|Signor|Господин|Κύριος"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Madame|Signora|Госпожа|Κυρία"
#: Fixed: given names by script and gender.
GIVEN = {
    ("latin", "m"): "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul Robert Simon Thomas Victor",
    ("latin", "f"): "Ada Bella Clara Diana Emma Flora Greta Helena Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sara Tessa Vera",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел",
    ("cyrillic", "f"): "Алла Белла Вера Галина Дарья Елена Ирина Клара Лидия Мария Ольга Полина",
    ("greek", "m"): "Ανδρέας Γιάννης Δημήτρης Ηλίας Κώστας Λουκάς Μάριος Νίκος Πέτρος Στέλιος",
    ("greek", "f"): "Άννα Βάσω Γεωργία Δήμητρα Ελένη Κατερίνα Λουκία Μαρία Νίκη Σοφία",
}

#: Patterns by type, in order of preference.
PATTERNS = {
    "secret": r"(?:(?<=password=)|(?<=passwd=)|(?<=secret=)|(?<=token=)|(?<=api_key=)|(?<=token = \")|(?<=secret = \")|(?<=api_key = \")|(?<=password = \"))[A-Za-z0-9_\-]{8,}",
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}@(?:[A-Za-z0-9\-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9\-])",
    "card": r"(?<![0-9.\-])(?:[0-9]{4}[ \-]?){3}[0-9]{4}(?![0-9\-])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)|[0-9]{3})[ .\-][0-9]{3}[ .\-]?[0-9]{4}(?![0-9])|\+[0-9]{8,15}(?![0-9])",
    "name": rf"\b(?:{MALE}|{FEMALE})\b\.?[ ]\p{{Lu}}\p{{Ll}}+(?:[ ]\p{{Lu}}\p{{Ll}}+)?",
}
ANY = "|".join(PATTERNS.values())
#: A text without these holds no entity; spares most texts the full pattern.
HINT = rf"[@0-9]|{MALE}|{FEMALE}|password|passwd|secret|token|api_key"


def kind(e: Column) -> Column:
    """Type of an entity, from its own form."""
    return (
        F.when(e.contains("@"), "email")
        .when(e.rlike(rf"^(?:{MALE}|{FEMALE})\b"), "name")
        .when(e.rlike(r"^(?:[0-9]{4}[ \-]?){3}[0-9]{4}$"), "card")
        .when(e.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip")
        .when(e.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(e.rlike(r"^[+(]|^[0-9]{3}[ .\-][0-9]{3}[ .\-]?[0-9]{4}$"), "phone")
        .otherwise("secret")
    )


def canonical(e: Column) -> Column:
    """What makes two spellings the same entity."""

    def of(e: Column, k: Column) -> Column:
        body = (
            F.when(k.isin("card", "ssn", "phone"), F.regexp_replace(e, "[^0-9]", ""))
            .when(k == "email", F.lower(e))
            .when(k == "name", F.regexp_replace(e, r"\.", ""))
            .otherwise(e)
        )
        return F.concat(k, F.lit(":"), body)

    return let(e, lambda x: let(kind(x), lambda k: of(x, k)))


#: Fixed: characters by script and sort; replacements stay within a group.
GROUPS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "АЕИОУЭЮЯ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ"]
POOL = "".join(GROUPS)
_ENDS = [len("".join(GROUPS[: k + 1])) for k in range(len(GROUPS))]


def _byte(digest: Column, i: Column) -> Column:
    """Byte i of a hex digest of 128 bytes, which wraps around."""
    return F.conv(F.substring(digest, 2 * F.pmod(i, F.lit(128)) + 1, F.lit(2)), 16, 10).cast("int")


def _swap(c: Column, x: Column, hexa: Column) -> Column:
    """A character of the same sort; those of no group stay."""

    def of_group(at: Column) -> Column:
        own = F.element_at(F.filter(F.lit([list(t) for t in zip([0, *_ENDS], _ENDS)]), lambda g: at <= F.get(g, F.lit(1))), 1)
        return let(own, lambda g: F.substring(F.lit(POOL), F.get(g, F.lit(0)) + F.pmod(x, F.get(g, F.lit(1)) - F.get(g, F.lit(0))) + 1, F.lit(1)))

    at = F.instr(F.lit(POOL), c)
    return (
        F.when(hexa & c.rlike("[a-f]"), F.substring(F.lit("abcdef"), F.pmod(x, F.lit(6)) + 1, F.lit(1)))
        .when((F.length(c) == 0) | (at == 0), c).otherwise(let(at, of_group))
    )


def _swapped(e: Column, digest: Column) -> Column:
    """Every letter and digit swapped by its rank among letters and digits, so
    that formatting does not change the replacement."""
    hexa = e.rlike("^[0-9a-f]+$")
    rank = lambda i: F.length(F.regexp_replace(F.substring(e, F.lit(1), i + 1), r"[^\p{L}0-9]", ""))
    return F.array_join(F.transform(F.split(e, ""), lambda c, i: _swap(c, _byte(digest, rank(i)), hexa)), "")


def _ip(e: Column, digest: Column, attempt: Column) -> Column:
    """Octets of as many digits, or of any number."""
    def octet(o: Column, i: Column) -> Column:
        x = _byte(digest, 2 * i) * 256 + _byte(digest, 2 * i + 1)
        return F.when(attempt >= WIDE, 1 + F.pmod(x, F.lit(254))).when(F.length(o) == 3, 100 + F.pmod(x, F.lit(155))).when(F.length(o) == 2, 10 + F.pmod(x, F.lit(90))).otherwise(1 + F.pmod(x, F.lit(9))).cast("string")

    return F.array_join(F.transform(F.split(e, r"\."), octet), ".")


def _more(e: Column, k: Column, digest: Column, attempt: Column) -> Column:
    """Characters that widen an entity's format: digits or letters of its script."""
    book = F.when(k.isin("phone", "ssn"), "00").when(e.rlike(r"\p{IsCyrillic}$"), "аб").when(e.rlike(r"\p{IsGreek}$"), "αβ").otherwise("ab")
    one = lambda i: _swap(F.substring(book, F.pmod(i, F.lit(2)) + 1, F.lit(1)), _byte(digest, i + 90), F.lit(False))
    return F.when((attempt >= WIDE) & ~k.isin("card", "ip"), F.array_join(F.transform(F.sequence(F.lit(WIDE), F.greatest(attempt, F.lit(WIDE))), one), "")).otherwise("")


def _checked(s: Column) -> Column:
    """A card number without its last digit, with the one that makes it valid."""
    digits = F.split(F.regexp_replace(s, "[^0-9]", ""), "")
    value = lambda d, i: F.pmod((d * (2 - i % 2)).cast("int"), F.lit(10)) + F.when((i % 2 == 0) & (d > 4), 1).otherwise(0)
    total = F.aggregate(F.transform(digits, lambda d, i: value(d.cast("int"), i)), F.lit(0), lambda a, x: a + x)
    return F.concat(s, F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))


def _given(e: Column, digest: Column) -> Column:
    """A given name by the title's gender and the name's script."""
    gender = F.when(e.rlike(rf"^(?:{MALE})\b"), "m").otherwise("f")
    script = F.when(e.rlike(r"\p{IsCyrillic}+$"), "cyrillic").when(e.rlike(r"\p{IsGreek}+$"), "greek").otherwise("latin")
    book = F.create_map(*[x for (s, g), names in GIVEN.items() for x in (F.lit(s + g), F.lit(names.split()))])
    x = _byte(digest, F.lit(0)) * 256 + _byte(digest, F.lit(1))
    return let(F.try_element_at(book, F.concat(script, gender)), lambda names: F.get(names, F.pmod(x, F.size(names))))


#: What of an entity stays at its start and end. A card's last digit is set
#: anew; a name of two words gets a given name from a list, a lone one, which
#: has too few choices to stay distinct, is swapped.
_KEPT_HEAD = r"^(?:\+[0-9]{1,3}(?=[ .\-(])[ .\-]?|\+[0-9]{2}|[0-9](?=[0-9 \-]{14,}$)|(?:%s|%s)\b\.? )" % (MALE, FEMALE)


def surrogate(e: Column, attempt: Column, key: str) -> Column:
    """The replacement of an entity at an attempt."""

    def drawn(seed: Column) -> Column:
        digest = F.concat(*[F.sha2(F.concat(F.lit(f"{key}|{j}|"), seed), 512) for j in range(2)])
        return let(digest, lambda d: let(F.struct(kind(e).alias("k"), F.regexp_extract(e, _KEPT_HEAD, 0).alias("head")), lambda s: built(d, s["k"], s["head"])))

    def built(d: Column, k: Column, head: Column) -> Column:
        tail = F.when(k == "email", F.length(F.regexp_extract(e, r"\.[^.]*$", 0))).when(k == "card", 1).otherwise(0)
        two = (k == "name") & e.rlike(r" \S+ \S+$")
        first = F.when(two, F.length(F.regexp_extract(e, r" (\S+) \S+$", 1))).otherwise(0)
        body = F.substring(e, F.length(head) + first + 1, F.length(e) - F.length(head) - first - tail)
        more = _more(e, k, d, attempt)
        plain = F.concat(head, F.when(two, _given(e, d)).otherwise(F.lit("")), F.when(k == "email", more).otherwise(""), let(body, lambda b: _swapped(b, d)), F.when(k == "email", "").otherwise(more))
        return F.when(k == "ip", _ip(e, d, attempt)).otherwise(let(plain, lambda p: F.when(k == "card", _checked(p)).otherwise(F.concat(p, F.substring(e, F.length(e) - tail + 1, tail)))))

    return let(F.concat(canonical(e), F.lit("|"), attempt.cast("string")), drawn)


def entities(text: Column) -> Column:
    """All entities of a text, in order."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def found_in(docs: DataFrame, text: str = "text") -> DataFrame:
    """h, e, canonical: the distinct entities of every text, by its hash."""
    t = F.col(f"`{text}`")
    found = docs.select(F.xxhash64(t).alias("h"), F.explode(entities(t)).alias("e")).select("h", "e", canonical(F.col("e")).alias("canonical"))
    return saved(found.distinct(), "found")


def redrawn(found: DataFrame, key: str) -> DataFrame:
    """canonical and attempt of the entities whose first replacement collides;
    all others keep attempt 0."""
    # one spelling stands for all of an entity
    state = saved(found.groupBy("canonical").agg(F.min("e").alias("e")).withColumn("attempt", F.lit(0)), "entities")
    real = state.select(F.col("canonical").alias("s"))
    while True:
        drawn = saved(state.select("*", canonical(surrogate(F.col("e"), F.col("attempt"), key)).alias("s")), "drawn")
        twice = drawn.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(F.col("attempt") * -1, F.col("canonical"))).alias("first"))
        clash = (
            drawn.join(twice.where("c > 1").select("s", F.col("first.canonical").alias("first")), "s").where("canonical <> first").select("canonical")
            .unionByName(drawn.join(real, "s", "left_semi").select("canonical")).distinct()
        )
        clash = saved(clash, "clashes")
        if not clash.limit(1).count():
            return state.where("attempt > 0").select("canonical", "attempt")
        state = saved(drawn.join(clash.withColumn("_again", F.lit(1)), "canonical", "left").select("canonical", "e", (F.col("attempt") + F.coalesce("_again", F.lit(0))).alias("attempt")), "entities")


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with ``text`` rewritten under a secret ``key``, other columns
    untouched, and the number of entities in the last column, ``n_entities``."""
    found = found_in(docs, text)
    again = saved(redrawn(found, key), "redrawn")
    t = F.col(f"`{text}`")
    names = docs.columns
    base = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("_row"), t.alias("_t"))

    def new_text(at):
        def on(found: Column) -> Column:
            parts = F.split(F.col("_t"), ANY, -1)
            new = F.transform(found, lambda e: surrogate(e, at(e), key))
            text_new = F.array_join(F.zip_with(parts, new, lambda p, s: F.concat(F.coalesce(p, F.lit("")), F.coalesce(s, F.lit("")))), "")
            return F.struct(F.when(F.size(found) > 0, text_new).otherwise(F.col("_t")).alias("t"), F.size(found).cast("long").alias("n"))

        return on

    if not again.limit(1).count():
        done = base.select("_row", let(entities(F.col("_t")), new_text(lambda e: F.lit(0))).alias("_o"))
    else:
        # a row for each text with entities drawn again
        books = found.select("h", "canonical").distinct().join(again, "canonical").groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("canonical", "attempt"))).alias("_book"))
        books = saved(books.withColumnRenamed("h", "_h"), "books")
        both = base.join(F.broadcast(books) if books.count() <= BROADCAST_ROWS else books, F.xxhash64("_t") == F.col("_h"), "left")
        done = both.select("_row", let(entities(F.col("_t")), new_text(lambda e: F.coalesce(F.try_element_at(F.col("_book"), canonical(e)), F.lit(0)))).alias("_o"))
    cols = [F.col("_o.t").alias(c) if c == text else F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)]
    return done.select(*cols, F.coalesce(F.col("_o.n"), F.lit(0)).cast("long").alias("n_entities"))
