"""Language identification: accuracy with wrong declarations, evidence, edge cases."""

import random

import pytest

from fleetzone.llm import language

SCHEMA = "doc_id long, text string, lang string, source string, confidence string"
WORDS = {"en": "the of and that with from this have which were their there would about other".split(),
         "de": "der die und nicht eine werden auch nach wurde über durch zwischen können schön".split(),
         "fr": "les des dans pour qui avec être cette leurs même très après où déjà français".split()}


def rows():
    rnd = random.Random(9)
    out = []
    for i in range(900):
        true = ["en", "de", "fr"][i % 3]
        declared = true if rnd.random() < 0.85 else rnd.choice(["en", "de", "fr", None, "xx"])
        text = " ".join(rnd.choices(WORDS[true], k=rnd.choice([2, 10, 60])))
        out.append((i, text, declared, f"a.{true}.example.org" if i % 2 else None, "c"))
    return out


@pytest.fixture(scope="module")
def scored(spark):
    data = rows() + [(5000, None, "en", "h", "c"), (5001, "", "de", None, "c"), (5002, "12 34 !!", "fr", "h", "c"),
                     (None, "the of and that", None, None, "c"), (5003, "the of " * 40000, "en", "h", "c"),
                     (5004, "the of and", "en", "h", "c"), (5004, "the of and", "en", "h", "c")]
    return language.identify(spark.createDataFrame(data, SCHEMA)).collect()


def test_text_beats_wrong_declarations(scored):
    own = [r for r in scored if r.doc_id is not None and r.doc_id < 900]
    assert len(own) == 900
    right = sum(r.lang == ["en", "de", "fr"][r.doc_id % 3] for r in own)
    assert right >= 890 and all(r.kept for r in own)


def test_edge_rows(scored):
    by = {r.doc_id: r for r in scored}
    for i in (5000, 5001, 5002):
        assert by[i].lang == "und" and by[i].confidence == 0 and not by[i].kept
    assert by[None].lang == "en" and by[5003].lang == "en"
    assert sum(r.doc_id == 5004 for r in scored) == 2


def test_empty_table(spark):
    assert language.identify(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_declarations_at_all(spark):
    df = spark.createDataFrame([(1, "some text", None, None, "c")], SCHEMA)
    assert [r.lang for r in language.identify(df).collect()] == ["und"]


def test_host_priors_are_smoothed_down_the_hierarchy(spark):
    data = [("a.x.de", 0)] * 50 + [("b.x.de", 1)] + [("c.y.fr", 1)] * 50
    got = {r.host: list(r.prior) for r in language.host_priors(
        spark.createDataFrame(data, "host string, reads int"), 2).collect()}
    assert all(abs(sum(p) - 1) < 1e-9 for p in got.values())
    assert got["a.x.de"][0] > got["b.x.de"][0] > 0.5 > got["c.y.fr"][0]     # b leans on its domain


def test_a_language_of_a_thousandth_is_found(spark):
    """60 of 60,000 rows, correctly declared and on one host."""
    rnd = random.Random(3)
    cs = "který jsou nebo také podle protože mezi během však ještě první může".split()
    data = [(i, " ".join(rnd.choices(WORDS[x], k=12)), x, "h", "c") for i in range(59940) for x in [["en", "de", "fr"][i % 3]]]
    data += [(100_000 + i, " ".join(rnd.choices(cs, k=12)), "cs", "a.example.cz", "c") for i in range(60)]
    out = language.identify(spark.createDataFrame(data, SCHEMA).repartition(4)).where("doc_id >= 100000").collect()
    assert [(r.lang, r.kept) for r in out] == [("cs", True)] * 60


def test_a_rare_filler_does_not_vouch_for_itself(spark):
    """60 rows of 30,060 declare "xx"; their words have never been seen under it but in themselves."""
    rnd = random.Random(6)
    names = ["".join(rnd.choices("aeioubdfglmnrst", k=7)) for _ in range(3000)]
    text = lambda x: " ".join(rnd.choices(WORDS[x], k=8) + rnd.choices(names, k=8))
    data = [(i, text(x), x, "h", "c") for i in range(30_000) for x in [["en", "de", "fr"][i % 3]]]
    data += [(100_000 + i, text("en"), "xx", "h", "c") for i in range(60)]
    out = language.identify(spark.createDataFrame(data, SCHEMA).repartition(4)).where("doc_id >= 100000").collect()
    assert [r.lang for r in out] == ["en"] * 60


def test_more_languages_than_a_block(spark):
    """Every language keeps its own counts when a task sees more of them than it holds at once."""
    rnd = random.Random(4)
    codes = [a + b for a in "abcdefghijklm" for b in "abcdefghijk"]
    assert len(codes) > language.BLOCK
    words = {c: ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(8)] for c in codes}
    data = [(i, " ".join(rnd.choices(words[c], k=20)), c, None, c) for i, c in enumerate(codes * 4)]
    got = {r.doc_id: r.lang for r in language.identify(spark.createDataFrame(data, SCHEMA).coalesce(1)).collect()}
    assert sum(got[i] == c for i, _, _, _, c in data) > 0.99 * len(data)


def test_host_and_markup_language(spark):
    rows = [("https://user:p@M.News.Example.ORG.:8080/a?b=//c.de/#x", '<!DOCTYPE html>\n<HTML class="a" xml:lang=\'de-AT\'>'),
            ("net/en/7817?utm_source=feed", '<html data-lang="fr"><p lang="en">'), ("//x.de", "<html\nlang = pt_BR>"),
            ("http://[::1]:80/", ""), (None, None)]
    df = spark.createDataFrame(rows, "url string, html string")
    out = df.select(language.host_of(df.url), language.markup_language(df.html)).collect()
    assert [tuple(r) for r in out] == [("m.news.example.org", "de-AT"), (None, None), ("x.de", "pt_BR"), ("[::1]", None), (None, None)]


def test_pages_give_their_address_and_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in language.identify_pages(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    assert {r.declared for r in got.values()} == {"en", "de", "fr", "es"}
    assert sum(got[r.page_id].lang == got[r.page_id].declared for r in rows) > 0.8 * len(rows)
    # A word of both languages: the suffix decides.
    html = lambda lang, text: f"<html lang={lang!r}><body><article><p>{text}</p></article></body></html>"
    data = [(i, f"http://h{i % 7}.example.{x}/p", html(x, " ".join(WORDS[x] * 3 + ["hotel"] * 10))) for i in range(300) for x in [["de", "fr"][i % 2]]]
    data += [(1000 + k, f"http://new.site.{x}/", html("", "hotel")) for k, x in enumerate(["de", "fr"])]
    priors = {r.page_id: r.lang for r in language.identify_pages(
        spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert [priors[1000], priors[1001]] == ["de", "fr"]


def plain_fit(texts, declared, language_names):
    """Mean log-likelihood per trigram, own trigrams left out, with dictionaries and one document at a time."""
    import math
    from collections import Counter
    grams = []
    for x in texts:
        codes, _ = language.trigrams([(x or "").encode()])
        grams.append(Counter(codes.tolist()))
    counts = {x: Counter() for x in language_names}
    for g, d in zip(grams, declared):
        if d in counts:
            weight = min(1, language.DOC_WEIGHT / max(sum(g.values()), 1))
            counts[d].update({c: n * weight for c, n in g.items()})
    out = []
    for g, d in zip(grams, declared):
        size, row = sum(g.values()), []
        for x in language_names:
            own = min(1, language.DOC_WEIGHT / max(size, 1)) if x == d else 0
            total = sum(counts[x].values()) + 0.1 * language.BUCKETS - own * size
            row.append(sum(n * math.log(max(counts[x][c] + 0.1 - own * n, 0.1) / total) for c, n in g.items()) / max(size, 1))
        out.append(row)
    return out


def test_likelihoods_against_a_plain_version(spark):
    data = rows()[:300] + [(5000, None, "en", "h", "c"), (5003, "the of " * 2000, "en", "h", "c"), (5004, "der die", "de", "h", "c")]
    src = spark.createDataFrame([(i, x, d, s) for i, x, d, s, _ in data], "id long, text string, declared string, host string")
    names, table, totals = language.text_model(src)
    import numpy as np
    got = {r.id: r.fit for r in src.repartition(3).mapInArrow(language._score_rows(names, table, totals), language._SCORES).collect()}
    want = plain_fit([d[1] for d in data], [d[2] for d in data], names)
    for (i, text, *_), row in zip(data, want):
        if text:
            assert np.allclose(got[i], row, atol=0.01), (i, got[i], row)


def test_a_language_of_three_documents_is_found_at_any_size(spark):
    rnd = random.Random(12)
    cs = "který jsou nebo také podle protože mezi během však ještě první může".split()
    for n in (60, 30_000):
        data = [(i, " ".join(rnd.choices(WORDS[x], k=12)), x, "h", "c") for i in range(n) for x in [["en", "de", "fr"][i % 3]]]
        data += [(100_000 + i, " ".join(rnd.choices(cs, k=40)), "cs", "a.example.cz", "c") for i in range(3)]
        data += [(200_000, " ".join(rnd.choices(WORDS["en"], k=40)), "once", "h", "c")]
        out = {r.doc_id: (r.lang, r.kept) for r in language.identify(
            spark.createDataFrame(data, SCHEMA).repartition(4)).where("doc_id >= 100000").collect()}
        assert out == {**{100_000 + i: ("cs", True) for i in range(3)}, 200_000: ("en", True)}


def test_thousands_of_wrong_values_drop_out_in_blocks(spark, monkeypatch):
    """Three languages, two rare ones and 90 junk values over English texts, tested four values at a time."""
    monkeypatch.setattr(language, "BLOCK", 4)
    rnd = random.Random(15)
    rare = {"cs": "který jsou nebo také podle protože mezi během však ještě první může".split(),
            "pl": "który jest oraz także według ponieważ między podczas jednak jeszcze pierwszy może".split()}
    data = [(i, " ".join(rnd.choices(WORDS[x], k=12)), x, "h", "c") for i in range(1500) for x in [["en", "de", "fr"][i % 3]]]
    data += [(10_000 + i, " ".join(rnd.choices(WORDS["en"], k=12)), "j" + chr(97 + i % 15) + chr(97 + i // 15 % 6), "h", "c")
             for i in range(270)]
    data += [(20_000 + i, " ".join(rnd.choices(rare[x], k=20)), x, None, "c") for i in range(20) for x in [["cs", "pl"][i % 2]]]
    src = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = {r.doc_id: r.lang for r in language.identify(src).collect()}
    assert all(got[i] == "en" for i in range(10_000, 10_270))
    assert all(got[20_000 + i] == ["cs", "pl"][i % 2] for i in range(20))
    assert sum(got[i] == ["en", "de", "fr"][i % 3] for i in range(1500)) == 1500
