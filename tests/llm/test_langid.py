import random
import time

from tidemark.llm import langid

VOCAB = {"aa": "tala mika sona pelo kari".split(), "bb": "grunz schtopf knarx wurf pfalz".split()}


def sentence(lang, seed, n=40):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCAB[lang]) for _ in range(n))


def docs(spark):
    rows = [(100 * n + k, sentence(lang, k), lang) for n, lang in enumerate(VOCAB) for k in range(30)] + [(None, "x", "aa"), (999, None, "bb"), (998, "x", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_fusion(spark):
    rows = []
    for k in range(200):
        lang = "aa" if k % 4 else "bb"
        declared = lang if k % 10 else "aa"
        rows.append((k, f"http://{'one' if lang == 'aa' else 'two'}.site{k % 5}.{lang}/p{k}", f'<html lang="{declared}"><script>schtopf</script><p>{sentence(lang, 1000 + k)}</p></html>'))
    rows += [(300, "http://two.site1.bb/x", None), (301, None, ""), (302, "odd", "<p>&nbsp;</p>"), (303, "http://two.site1.bb/y", '<html lang="bb"><p>' + "tala"), (None, None, None), (0, None, sentence("bb", 5))]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, lang string, prior string")
    model = langid.fit(docs(spark))
    assert model.langs == ["aa", "bb"]
    got = langid.identify(pages, model).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got if r["page_id"] is not None}
    assert all(by[k]["lang"] == ("aa" if k % 4 else "bb") for k in range(1, 200))
    # no text: the host decides; nothing at all: the overall prior
    assert by[300]["lang"] == "bb" and by[300]["host"] == "two.site1.bb" and by[301]["lang"] == "aa"
    assert all(0.5 <= r["probability"] <= 1 for r in got)
    assert langid.identify(pages.limit(0), model).count() == 0
    none = langid.identify(pages, langid.fit(docs(spark).limit(0))).collect()
    assert len(none) == len(rows) and {r["lang"] for r in none} == {None}


def test_host_priors_are_smoothed_by_brute_force(spark):
    rows = [(k, f"http://h{k % 3}.d.example/x", f"<p>{sentence('bb' if k % 3 == 0 else 'aa', k)}</p>") for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = langid.fit(docs(spark))
    r = {x["page_id"]: x for x in langid.identify(spark.createDataFrame(rows + [(900, "http://h0.d.example/z", None), (901, "http://h1.d.example/z", None)], pages.schema), model).collect()}
    assert r[900]["lang"] == "bb" and r[901]["lang"] == "aa"


def test_markup():
    assert langid.declared('<!DOCTYPE html><HTML class=x LANG="De-AT">') == "de"
    assert langid.declared('<meta http-equiv="content-language" content="fr">') == "fr"
    assert langid.declared(None) is None and langid.declared("<p lang='x'>") is None
    assert langid.visible("<style>p</style>a<!-- b -->&amp;<b>c</b>").split() == ["a", "&", "c"]


def test_declarations_anywhere_in_the_page(spark):
    long = "x<p> " * 1000
    for before in (f"<!-- {long} -->", f"<style>{long}</style>", f"<SCRIPT src=a>{long}</SCRIPT >", long, "<!-- never closed " + long, "<script>" + long):
        assert langid.declared(f'<!doctype html>{before}<html class=x lang="bb">') == "bb"
        assert langid.declared(f'<html>{before}<meta http-equiv="content-language" content="bb">') == "bb"
    assert langid.declared(f'<html data-x="{"y" * 5000}" lang=bb>') == "bb"
    assert langid.declared('<!--[if IE 8]><html lang="aa"><![endif]--><!--[if gt IE 8]><!--><html lang="bb"><!--<![endif]-->') == "bb"
    assert langid.declared("<script>'<html lang=aa>'</script>") is None
    page = f'<!-- {"y" * 5000} --><html lang="bb"><p>{sentence("bb", 1)}</p></html>'
    pages = spark.createDataFrame([(1, "http://one.site.bb/", page)], "page_id long, url string, html string")
    assert [r["declared"] for r in langid.identify(pages, langid.fit(docs(spark))).collect()] == ["bb"]


def test_declarations_are_found_in_linear_time():
    for part in ("<html ", "<meta ", "<!--", "<script ", "<html lang= ", '<meta content-language" ', " " * 5):
        start = time.perf_counter()
        assert langid.declared("<html lang=" + " " * 5 + '">' + part * 200_000) is None
        assert langid.declared("<html lang=" + part * 200_000) is None
        assert time.perf_counter() - start < 5
