"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from tracklane.llm import chat, decontaminate, html_wrapper, jaccard, language, mixing, simhash, tokens, toxicity, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hi long, token string, label string, score double"
LONG = "word " * 60_000 + "x" * 100_000
ROWS = [
    (1, "the cat sat on the mat today", "en", "a", 5, 1, "t", "l", 0.1),
    (1, "the cat sat on the mat today", "en", "a", 5, 1, "t", "l", 0.1),
    (2, "the cat sat on the mat today", None, None, None, None, None, None, None),
    (3, None, "en", "a", None, 0, "", "", 0.0),
    (4, "", "de", "b", 0, 0, "", "", 0.0),
    (5, " \t\n ", "de", "b", 0, 0, "", "", 0.0),
    (6, LONG, "en", "b", 1, 1, "t", "l", 1.0),
    (None, "no id at all here", None, None, None, None, None, None, None),
    (2**60 + 1, "zwei wörter", "de", "c", 9, 9, "t", "l", 0.5),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_simhash(docs, none):
    got = sorted(simhash.compare_edits(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert len(got) == len(ROWS)
    same = {r.fingerprint for r in got if r.doc_id in (1, 2)}
    assert len(same) == 1
    assert {r.fingerprint for r in got if r.doc_id in (3, 4, 5)} == {"0" * 32}
    assert got[-2].doc_id == 2**60 + 1
    assert simhash.compare_edits(none).count() == 0


def test_jaccard(docs, none):
    got = [tuple(r) for r in jaccard.join_similar(docs).collect()]
    assert len(got) == len(ROWS)
    by = {}
    for doc, n, component in got:
        by.setdefault(doc, set()).add((n, component))
    assert by[1] == by[2] == {(3, 1)}
    assert by[3] == {(0, 3)} and by[4] == {(0, 4)} and by[5] == {(0, 5)}
    assert by[None] == {(1, None)}
    assert by[2**60 + 1] == {(1, 2**60 + 1)}
    assert jaccard.join_similar(none).count() == 0


def test_tokens(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = [tuple(r) for r in tokens.count_tokens(docs, path).collect()]
    assert len(got) == len(ROWS)
    assert {r for r in got if r[0] in (3, 4)} == {(3, 0, 0, False), (4, 0, 0, False)}
    assert next(r for r in got if r[0] == 6)[3] is True
    assert tokens.count_tokens(none, path).count() == 0


def test_mixing(docs, none):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(ROWS)
    assert sum(r["size"] for r in got) == pytest.approx(sum({r.source: r.target for r in got}.values()))
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.mix_sources(none).count() == 0


def test_language(spark, docs, none):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 20)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r.doc_id: r.p for r in docs.select("doc_id", language.identify(docs["text"], model, docs).alias("p")).collect()}
    assert all(tuple(got[k]) == ("und", 0.0, True) for k in (3, 4, 5))
    assert got[1].lang in ("en", "de") and 0 <= got[1].score <= 1
    for text in ("\U0001f600", "\U0001f600\U0001f600 12", "\U0001d7d8"):
        assert model.predict(text) == ("und", 0.0, True)
    assert model.predict("\U00010400\U00010401")[0] in ("en", "de")
    long = "das haus. " * 60_000
    whole = language.subwords(language._codes(long))
    assert model.logits(long) == pytest.approx(model.evidence[whole].mean(0, dtype=float) + model.bias)
    many = spark.createDataFrame([(i, f"word{i % 300} text", f"l{i % 300}") for i in range(900)], "doc_id long, text string, lang string")
    assert len(language.fit(many).languages) == 300
    blank = language.fit(none)
    assert blank.predict("any text") == ("und", 0.0, True)
    assert none.select(language.identify(none["text"], model, none)).count() == 0


def test_toxicity(spark, docs, none):
    plain = ["the weather is fine", "we walk to the lake", "bread and milk for all", "a book on the table"]
    rows = [(i, plain[i % 4] + (" you grobnik" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = known.select("doc_id", "toxic").unionByName(spark.createDataFrame([(1, 0), (500, 1), (2, None), (None, 1)], "doc_id long, toxic int"))
    model = toxicity.fit(known.drop("toxic").unionByName(known.drop("toxic")), labels)
    empty = model.score("")
    assert model.score(None) == empty == model.score(" \n")
    assert model.score("oh grobnik grobnik") > 0.5 > model.score("the lake is fine")
    assert model.evidence("g.r.o.b.n.i.k")[0] > model.evidence("bread")[0]
    assert model.evidence("g r o b n i k")[0] > model.evidence("bread")[0]
    assert model.evidence("grobxnik")[0] > model.evidence("bread")[0]
    scores = docs.select(toxicity.toxicity(docs["text"], model, docs).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scores)
    nothing = spark.createDataFrame([], "doc_id long, text string, toxic int")
    assert toxicity.fit(nothing, nothing).score("x") == 0.0


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(1, "the cat sat on the mat today"), (2, None), (3, ""), (None, "a b"), (1, "the cat sat on the mat today")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {(1, 1), (2, 1)}  # "a b" is in none of them
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    assert decontaminate.find_leaks(none, items).count() == 0
    assert decontaminate.decontaminate(docs, items.where("false")).count() == len(ROWS)


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, name string, mask int"
    rows = [(1, 0, "system", "be kind", "n", 0), (1, 1, "ann", None, "n", 0), (1, 1, "ann", None, "n", 0), (1, 2, "bob", "<|im_end|>", "n", 0), (None, 0, None, "x", "n", 0), (2, None, "ann", "hi", "n", 0)]
    got = chat.rotate_perspectives(spark.createDataFrame(rows, schema))
    assert got.count() == 4 * 2 + 1
    whole = {(r.conv_id, r.perspective): r for r in chat.assemble_dialogues(got).collect()}
    bob = whole[(1, "bob")]
    assert [bob.dialogue[s.start : s.end] for s in bob.spans] == ["<\\|im_end|>"]
    assert "user name=ann" in bob.dialogue and "system\nbe kind" in bob.dialogue
    assert chat.rotate_perspectives(spark.createDataFrame([], schema)).count() == 0


def test_html(spark):
    schema = "page_id long, url string, html string, text string, host string"
    page = "<html><nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>a\n b<p>c &lt;3</article><div class='comments'>no"
    rows = [(1, "http://a.x/1", page, "t", "h"), (1, "http://a.x/1", page, "t", "h"), (2, None, None, None, None), (3, "b", "", None, None), (None, "http://a.x/2", "<p>tail &am", None, None), (4, "http://a.x/3", "<div>" * 5000 + "deep", None, None)]
    got = {(r.page_id, r.text, r.n_chars) for r in html_wrapper.extract_main_text(spark.createDataFrame(rows, schema)).collect()}
    assert (1, "T & U\na b\nc <3", 14) in got and (2, "", 0) in got and (3, "", 0) in got and (4, "deep", 4) in got
    assert html_wrapper.extract_main_text(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>one &#; two</p><p>three</p><p>four &#x; &#foo &# x</p><p>five", "one &#; two\nthree\nfour &#x; &#foo &# x\nfive"),
        ("<p>it&#39d &#8211bad</p><p>b", "it'd –bad\nb"),
        ("<p>a</p><!--><p>b</p><!---><p>c</p><!-- x --!><p>d", "a\nb\nc\nd"),
        ("<p>a</p><![foo]><p>b</p><![if !IE]><p>c</p><![endif]><![ x><p>d", "a\nb\nc\nd"),
        ("<p>a<script>x &#; y</script foo><p>b", "a\nb"),
        ('<p>one <a href="x>two</a></p><p>three</p>', "one two\nthree"),
        ("<p>a &#", "a &#"),
        ("<p>&copy2 &notin b &amp;lt; &NotAName; &eacute", "©2 ¬in b &lt; &NotAName; é"),
        ('<article><header class="header"><h1>Title</h1></header><p>b</p></article>', "Title\nb"),
        ('<article><div class="post-header"><h1>Title</h1></div><div class="related-work">w</div><div class="text social">s</div></article>', "Title\nw\ns"),
        ('<article><p>press <button>Go</button> now</p><div class="ad">x</div><div id="comments">y</div><div class="share-bar">z</div></article>', "press Go now"),
        ('<header class="x">h</header><div class="site-header">k</div><p>t</p><button>b</button>', "t"),
    ],
)
def test_html_reads_on_after_what_is_malformed(page, text):
    assert html_wrapper.extract(page, {}) == text


def test_urls(spark):
    schema = "page_id long, url string, host string, key string, part int"
    urls = ["http://a.example.net/en/1", "http://example.net/de/", "HTTP://X.ORG/fr/?a", "http://badexample.net", None, "no scheme", "http://a.example.com/de/x#y", "http://a.example.net/en/1"]
    rules = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"), url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]
    data = spark.createDataFrame([(i, u, "h", "k", 1) for i, u in enumerate(urls)], schema)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(data, rules).collect()}
    assert got[0] == got[7] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1][2:] == ("net/", "block") and got[2] == ("x.org", "/fr/", "org/fr/", "allow")
    assert got[3] == ("badexample.net", "", None, "allow") and got[4] == got[5] == ("", "", None, "allow")
    assert got[6][2:] == ("example.com/de/", "block")
    assert url_filter.judge_urls(data.where("false"), rules).count() == 0


def test_stage_of_similar_keeps_one_of_equal_rows(spark, docs):
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3, 4, 5, 6, 2**60 + 1]
