import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vinework.llm import ctw, html, licences, pages, queries, toxicity

LICENCES = {
    "GPL-3.0": "GNU General Public License, version 3",
    "proprietary": "All rights reserved",
    "MIT": "MIT License",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "Apache-2.0": "Apache License, Version 2.0",
}


def test_licence_query_finds_the_licence_lines(spark, documents):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    found = queries.op6_license_scan(spark, sf).collect()
    assert len(found) == len(texts)
    for r in found:
        there = {name for name, words in LICENCES.items() if words in texts[r.doc_id]}
        assert (r.licence in there) if r.origin == "own" else not there


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    files = [
        ("a/LICENSE", f"MIT License\n\n{mit}"),
        ("a/b/x.c", "code here"),
        ("a/b/c/y.c", "more code"),
        ("a/b/c/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("ab/x.c", "not below a"),
        ("a/n.c", "Licensed under CC BY-NC 4.0.\nint main;\n" + "other words " * 50),
        (None, None),
        (None, "All rights reserved."),
        ("a/b/z.c", ""),
        ("a/b/z.c", ""),
    ]
    rows = licences.scan(spark.createDataFrame(files, "path string, text string")).collect()
    found = {(r.path, r._lc_licence, r._lc_origin, r._lc_from) for r in rows}
    assert len(rows) == len(files)
    assert found == {
        ("a/LICENSE", "MIT", "own", None),
        ("a/b/x.c", "MIT", "inherited", "a"),
        ("a/b/z.c", "MIT", "inherited", "a"),
        ("a/b/c/y.c", "GPL-3.0", "inherited", "a/b/c"),
        ("a/b/c/COPYING", "GPL-3.0", "own", None),
        ("ab/x.c", None, None, None),
        ("a/n.c", "CC-BY-NC-4.0", "own", None),
        (None, None, None, None),
        (None, "proprietary", "own", None),
    }


def test_licences_of_odd_rows(odd):
    found = licences.scan(odd.withColumn("path", F.concat_ws("/", "source", "doc_id")))
    assert found.count() == odd.count() and found.filter("_lc_licence IS NOT NULL").count() == 0
    assert licences.scan(odd.limit(0).withColumnRenamed("path_", "path")).count() == 0


def test_bound_loses_no_licence():
    """What the bound on the cosine rejects has a smaller cosine."""
    import numpy as np

    model = licences._Templates(licences.TEMPLATES, 100, {0: 50, 3: 7})
    rng, words = random.Random(3), [w.decode() for w in licences._words(" ".join(t for _, t in licences.TEMPLATES))]
    for _ in range(300):
        unit = licences._words(" ".join(rng.choices([*words, "foo", "bar", "qux"], k=rng.randint(1, 12))))
        hashes = licences._hash_words(unit)
        found = model.find(hashes)
        known, others = np.where(found >= 0, model.idf[found], 0).sum(), (found < 0).sum()
        assert model.best(found, hashes)[1] <= known / np.sqrt(max(known**2 + others * model.rarest**2, 1e-300)) + 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div class=ad>Buy</div><aside class="sidebar"><p>Related</p></aside><article class="post"><header><h1>Title &amp; more</h1></header>
<p>First   <b>line<br>goes on</p><p><b>Unclosed<p>Next &lt;one&gt; &#233;<form>Name <input></form><div class="share">Share</div>
<ul><li>item</ul></article><section id="comments"><article>Reader says</article></section><!-- ad <p>x</p> --><div>{line}</div>
<footer>&copy; Site</footer>"""


def test_blocks_of_a_page():
    text = [t for t, place in html.blocks(PAGE.format(line="Loose")) if place == html.ARTICLE]
    assert text == ["Title & more", "First line goes on", "Unclosed", "Next <one> é", "item"]
    assert [t for t, place in html.blocks(PAGE.format(line="Loose")) if place == html.OPEN] == ["Loose"]
    assert html.blocks("") == [] and html.blocks("a < b <") == [("a < b <", html.OPEN)]
    assert html.blocks("<nav>Menu<article>Text</article>") == [("Menu", html.ASIDE), ("Text", html.ARTICLE)]
    assert html.blocks("<script>x") == [] and html.blocks("<p " + "'" * 3001 + ">t") != []


def test_names_of_wrappers_do_not_hide_an_article():
    article = "<article><p>Text</p></article>"
    for start in (
        '<body class="no-sidebar">',
        '<html class="comments"><body class="one-sidebar sidebar-first">',
        '<body><div id="content" class="has-sidebar">',
        '<body><div class="comments-open">',
        '<body><div class="sidebar-left"><div class="related">',
        "<body><form>",
        '<body><main id="comments">',
        '<body><div class="comments"><main>',
    ):
        assert html.blocks(f"{start}<h1>Head</h1>{article}")[-1] == ("Text", html.ARTICLE), start
    assert html.blocks(f'<div class="sidebar-left"><h1>Head</h1>{article}</div>') == [("Head", html.OPEN), ("Text", html.ARTICLE)]
    for start in ('<div class="comments-open"><div id="comments">', '<ol class="comment-list"><li>', '<div class="related-posts">', "<aside>"):
        assert html.blocks(f"{article}{start}<article>Other</article>") == [("Text", html.ARTICLE), ("Other", html.ASIDE)], start


def test_unclosed_and_empty_elements_cut_nothing_else():
    article, both = "<article><p>one</p><p>two</p></article>", [("one", html.ARTICLE), ("two", html.ARTICLE)]
    for start in (
        "<head><title>T</title><body>",
        "<html><head><meta charset=u><link rel=x>",
        "<head><noscript><img src=x><body>",
        '<svg width="1"/>',
        "<svg><path/>",
        "<math/>",
        *(f"<div><{name}></div>" for name in ("object", "canvas", "select", "noscript", "audio")),
    ):
        assert html.blocks(start + article) == both, start
    assert html.blocks("<article><p>a<object data=x><p>b</p></article><p>c") == [("a", html.ARTICLE), ("c", html.OPEN)]
    assert html.blocks("<p>a<object>f<p>g</object>b<svg><text>n</text></svg>c") == [("abc", html.OPEN)]
    formula = "<math><semantics><mi>a</mi><mo>+</mo><mi>b</mi><annotation>TeX</annotation></semantics></math>"
    assert html.blocks(f"<article><p>x {formula} y</p></article>") == [("x a+b y", html.ARTICLE)]
    assert html.blocks("<p>x<style>p") == html.blocks("<p>x<textarea><p>y") == [("x", html.OPEN)]


def test_differences_decide_unmarked_blocks(spark):
    plain = "<body><div>Name of the site</div><p>{}</p><div>Last line</div>"
    rows = [
        (1, "http://a.com/x/1", plain.format("One")),
        (2, "http://a.com/x/2", plain.format("Two")),
        (3, "http://www.a.com/x/2", plain.format("Two")),
        (4, "http://b.com/", plain.format("Alone")),
        (5, None, None),
        (6, "http://[bad", ""),
        (7, None, "text only"),
    ]
    out = pages.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("key", F.lit(1)))
    found = {r.page_id: r._mt_text for r in out.collect()}
    assert found == {1: "One", 2: "Two", 3: "Two", 4: "Name of the site\nAlone\nLast line", 5: "", 6: "", 7: "text only"}


def test_pages_query(spark, sf):
    import html as standard
    import re

    found = {r.page_id: r for r in queries.op7_html_extraction(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        texts = [" ".join(standard.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        text = "\n".join(t for t in texts if t)
        assert (found[r.page_id].text, found[r.page_id].n_chars) == (text, len(text))


def test_no_pages(spark):
    assert pages.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


@pytest.mark.parametrize("cells", [1 << 26, 8])
def test_longest_common_subsequence(monkeypatch, cells):
    monkeypatch.setattr(pages, "CELLS", cells)
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        found = pages.common_lines(a, b)
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in (a[i] for i in found))
        assert len(found) == brute.subsequence(a, b) and found == sorted(found)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = queries.op8_toxicity(spark, sf).collect()
    assert all(r.held_out == (brute.residue(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    caught = sum(p for p, t in held if t)
    assert caught >= 0.85 * sum(t for _, t in held) and sum(p for p, t in held if not t) <= 0.02 * len(held)


def test_curve_is_fitted_on_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 60)
    rows = [(f"plain words {chr(97 + i // 8) * 3} {'idiot moron' if i % 4 == 0 else ''}", int(i % 4 == 0)) for i in range(200)]
    docs = spark.createDataFrame(rows, "text string, toxic int")
    lexicon = toxicity.learn(docs)
    found = toxicity.toxicity(docs.withColumn("truth", F.col("toxic")), lexicon).collect()
    assert all((r._tx_score >= 0.5) == bool(r.truth) for r in found)


def test_folding():
    assert toxicity.fold("An 1D10T, stуpid!! $cum​ ｍoron") == " an idiot stypid scum moron " or toxicity.fold("1D10T") == " idiot "
    assert toxicity.fold("ѕсum") == " scum " and toxicity.fold("") == " " and toxicity.fold("...") == " "


def test_longest_entry_counts_and_phrases_hide():
    entries = {" trash": 2.0, " trash ": 3.0, " trash can ": 0.0, " bad ": 1.0}
    machine = toxicity.Lexicon(entries, (0, 0, 0)).automaton()
    value = lambda text: toxicity._matches(machine, toxicity.fold(text))
    assert value("trash") == 3 and value("trashy") == 2 and value("a trash can") == 0 and value("trash can bad bad") == 2


def test_toxicity_of_odd_rows(spark, odd):
    rows = odd.withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    lexicon = toxicity.learn(rows)
    found = toxicity.toxicity(rows, lexicon).collect()
    assert len(found) == odd.count() and all(0 <= r._tx_score <= 1 for r in found)
    assert all(r._tx_score < 1e-20 for r in toxicity.toxicity(rows, toxicity.learn(rows.limit(0))).collect())
    assert toxicity.toxicity(rows.limit(0), lexicon).count() == 0


def test_unigrams_of_the_query(spark, sf, documents):
    found = {r.doc_id: r for r in queries.op10_lm_scoring(spark, sf).collect()}
    assert len(found) == len(documents)
    for i, tokens, known, train, base in brute.unigrams(documents):
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, train, brute.residue(i, 10) == 0)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_context_tree_matches_the_book(spark, odd, odd_rows):
    rows = [(i, t if t is None or len(t) < 2000 else t[:2000]) for i, t, _, _ in odd_rows]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, key string")
    train = (F.col("doc_id") != 7) & (F.col("doc_id") != 8)
    found = ctw.score(docs, train).collect()
    tree = brute.ContextTree([t for i, t in rows if i not in (7, 8)], ctw.DEPTH)
    expected = sorted((str(i), tree.score(t)) for i, t in rows)
    assert [x for x, _ in expected] == [x for x, _ in sorted((str(r.doc_id), r._lm_score) for r in found)]
    for (_, a), (_, b) in zip(expected, sorted((str(r.doc_id), r._lm_score) for r in found), strict=True):
        assert a == pytest.approx(b, rel=1e-5)


def test_scores_without_training_texts(spark, odd):
    found = ctw.score(odd.filter("doc_id IN (1, 2, 7)"), F.lit(False)).collect()
    assert {r.doc_id: round(r._lm_bits, 6) for r in found} == {1: 8, 2: 8, 7: 8}
    assert ctw.score(odd.limit(0), F.lit(True)).count() == 0


def test_large_prefixes_get_copies():
    deal = ctw._Deal([5, 6, 7], [100, 3, 2], 4)
    assert deal.copies[deal.group[5]] == 4 and deal.copies[deal.group[6]] == 1


def test_licence_files_and_headers_of_real_projects(spark):
    """Whole licence files, standard headers in comments, and their directories."""
    gnu = """/* This {what} is free software; you can redistribute it and/or
 * modify it under the terms of the GNU {name}
 * as published by the Free Software Foundation; either version {version} of the License, or
 * (at your option) any later version.
 *
 * This {what} is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU {name} for more details.
 */

int main;
"""
    headers = {
        "GPL-2.0": gnu.format(what="program", name="General Public License", version="2"),
        "GPL-3.0": gnu.format(what="program", name="General Public License", version="3"),
        "AGPL-3.0": gnu.format(what="program", name="Affero General Public License", version="3"),
        "LGPL-2.1": gnu.format(what="library", name="Lesser General Public License", version="2.1"),
        "LGPL-3.0": gnu.format(what="library", name="Lesser General Public License", version="3"),
    }
    texts = dict(licences.whole_texts())
    owner = "Copyright (c) 2020, Some Owner\nAll rights reserved.\n\n"
    files = [(f"{name}/LICENSE", owner * name.startswith("BSD") + text) for name, text in texts.items()]
    files += [(f"{name}/x.c", "int x;") for name in texts]
    files += [(f"h/{name}.c", text) for name, text in headers.items()]
    files += [(f"b/{name}.c", "\n".join(f"# {line}" for line in texts[name].split("\n")) + "\n\nx = 1") for name in licences.SHORT_TEXTS]
    found = {r.path: r for r in licences.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    for name in texts:
        assert (found[f"{name}/LICENSE"]._lc_licence, found[f"{name}/x.c"]._lc_licence) == (name, name)
    assert {name: found[f"h/{name}.c"]._lc_licence for name in headers} == {name: name for name in headers}
    assert {name: found[f"b/{name}.c"]._lc_licence for name in licences.SHORT_TEXTS} == {name: name for name in licences.SHORT_TEXTS}
