"""Real page layouts, licences and toxicity against plain versions, and cases that once lost text."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vinework.llm import html, licences, pages, queries, simhash, substrings, toxicity

LONG = " ".join(f"word{i % 7}" for i in range(60))


def kept(page):
    return [t for t, place in html.blocks(page) if place != html.ASIDE]


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ('<article><h2 id="social-impact">A</h2><p id="related-work">B</p></article>', ["A", "B"]),
        ('<article><section class="widget-theory"><p>A</p></section><div class="share-price-table">B</div></article>', ["A", "B"]),
        ('<article><p>one <span class="ad">two</span> three</p></article>', ["one two three"]),
        ('<article><div class="entry-content ad-free"><p>A</p></div></article>', ["A"]),
        (f'<body><form id="aspnetForm"><input type="hidden" name="s"><input name="q"><div><p>{LONG}</p></div></form></body>', [LONG]),
        ('<form><input type="hidden"><p>Short</p></form>', ["Short"]),
        ('<div id="page" class="social"><nav>m</nav><div class="sidebar">s</div><p>A</p></div>', ["A"]),
        ('<div class="widget"><div class="share"><p>A</p></div></div>', ["A"]),
        ('<article><section id="comments"><h2>Comments</h2><p>On comments</p></section></article>', ["Comments", "On comments"]),
        ('<article><p>A</p><div id="comments"><h3>3 replies</h3><p>B</p></div></article>', ["A"]),
        ('<article><p>A</p><div class="related-posts">B</div><div class="cookie-notice">C</div><div class="adSlot">D</div></article>', ["A"]),
        ('<article><p>A</p><form><p>Sign up</p><input name="mail"><button>Go</button></form></article>', ["A"]),
        ('<div class="sidebar-left"><h1>T</h1><p>A</p></div><div class="left_sidebar">B</div>', ["T", "A"]),
        ('<div class="ad">B</div><article></article>', []),
        ('<div class="comments-open no-sidebar"><p>A</p></div>', ["A"]),
    ],
)
def test_layouts_keep_their_text(page, expected):
    assert kept(page) == expected


def site(host, n, rng):
    """Pages without any mark: shared lines around texts of their own, some lines in several texts."""
    shared = [f"{host} line {i}" for i in range(rng.randint(2, 6))]
    out = []
    for i in range(n):
        own = [f"{host} {i} says {rng.randrange(10**9)}" for _ in range(rng.randint(1, 5))]
        cut = rng.randint(1, len(shared) - 1)
        path = f"/{'ab'[i % 2]}/{i:03}"
        out.append((host, path, [*shared[:cut], *own, *shared[cut:]]))
    return out


def test_pages_without_marks_are_differenced(spark):
    rng = random.Random(2)
    found = [p for k in range(6) for p in site(f"h{k}.example", 1 + 4 * k, rng)]
    rows = [(i, f"http://{host}{path}", "".join(f"<div>{t}</div>" for t in lines)) for i, (host, path, lines) in enumerate(found)]
    rng.shuffle(rows)
    out = {r.page_id: r for r in pages.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)).collect()}
    for i, lines in enumerate(brute.differenced(found)):
        assert out[i]._mt_text == "\n".join(lines)
        assert out[i]._mt_gone == len(found[i][2]) - len(lines)
    assert sum(r._mt_gone for r in out.values()) > 100


def test_null_paths_inherit_nothing(spark):
    mit = dict(licences.whole_texts())["MIT"]
    rows = [(1, mit, None, None), (2, "plain", "en", "s"), (3, "plain", None, "s"), (4, mit, "de", "s"), (5, "plain", "de", "s"), (None, "plain", "de", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    folder = f"/tmp/layouts-{random.getrandbits(60):x}"
    docs.write.parquet(f"{folder}/documents.parquet")
    found = {(r.doc_id, r.licence, r.origin, r.inherited_from) for r in queries.op6_license_scan(spark, folder).collect()}
    assert found == {
        (1, "MIT", "own", None), (2, None, None, None), (3, None, None, None), (4, "MIT", "own", None), (5, "MIT", "inherited", "s/de"), (None, "MIT", "inherited", "s/de"),
    }


def test_licences_match_plain_cosines(spark):
    rng = random.Random(4)
    words = [w.decode() for w in licences._words(" ".join(t for _, t in licences.TEMPLATES))]
    lines = [" ".join(rng.choices([*words, "foo", "bar"], k=rng.randint(1, 10))) for _ in range(60)]
    for name_text in rng.sample(list(licences.TEMPLATES), 8):
        part = name_text[1].split()
        del part[rng.randrange(len(part))]
        lines.append(" ".join(part))
    files = [(f"d{i % 4}/e{i % 3}/f{i}", line) for i, line in enumerate(lines)] + [("d1/LICENSE", lines[-1]), ("d2/e1/COPYING", lines[-2])]
    everything = [set(brute.ALNUM.findall(t.encode().translate(brute.LOWER))) for _, t in files]
    templates = [*licences.TEMPLATES, *licences.headers()]
    own, found = {}, {r.path: r for r in licences.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    for path, text in files:
        score, name = brute.licence_score(text.encode(), templates, everything)
        if score >= licences.LEAST:
            own[path] = (score, name)
        r = found[path]
        assert (r._lc_origin == "own") == (path in own), (path, score)
        if path in own:
            assert r._lc_score == pytest.approx(score, rel=1e-9) and r._lc_licence == name
    licensed = {p.rpartition("/")[0] for p in own}  # each file is one line, so whole files
    for path, r in found.items():
        if path not in own:
            assert r._lc_from == brute.inherited(licensed, path.rpartition("/")[0])


def toxic_rows(n_toxic, n_clean, seed=1):
    rng = random.Random(seed)
    plain = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    bad = ["idiot", "moron", "scumbag", "scumlike", "trash"]
    rows = []
    for i in range(n_toxic):
        rows.append((" ".join([*rng.choices(plain, k=12), rng.choice(bad), *(["rareword"] if i < 30 else [])]), 1))
    for i in range(n_clean):
        rows.append((" ".join([*rng.choices(plain, k=12), *(["trash can"] if i % 50 == 0 else []), *(["scumble"] if i % 40 == 0 else [])]), 0))
    return rows


def test_toxicity_matches_the_plain_lexicon(spark):
    rows = toxic_rows(200, 400)
    docs = spark.createDataFrame(rows, "text string, toxic int")
    found = toxicity.learn(docs, phrases=("clown fish",))
    expected = brute.lexicon(rows, ("clown fish",))
    assert found.entries == pytest.approx(expected)
    assert found.entries[" trash can "] == 0
    texts = [t for t, _ in rows[::20]] + ["a trash can, a trash bag", "You SCUMBAG! scumble", "", None, "сlоwn fish ıdiot"]
    scored = toxicity.toxicity(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string"), found).collect()
    for r in scored:
        assert r._tx_weight == pytest.approx(brute.matched_weight(expected, toxicity.fold(texts[r.id] or "")))


def test_a_word_stays_an_entry_when_the_data_grow(spark):
    for n in (2_030, 20_000):
        docs = spark.createDataFrame(toxic_rows(n, n), "text string, toxic int")
        assert " rareword " in toxicity.learn(docs).entries


def test_labelled_rows_are_bounded(spark, monkeypatch):
    """Copies with different labels at the border give the same sample every time."""
    rows = [(f"text number {i % 7}", i % 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "text string, label int")
    found = {tuple(sorted(map(tuple, toxicity._bounded(docs.repartition(k), 150)[0].collect()))) for k in (1, 3, 7)}
    assert len(found) == 1 and len(found.pop()) <= 150


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_several_rows_without_ids(spark, monkeypatch, size):
    """Rows without an id are ordered by a hash of their texts where they fill several chunks, then by their texts."""
    monkeypatch.setattr(substrings, "CHUNK_BYTES", size)
    monkeypatch.setattr(substrings, "LEAST_BYTES", size)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(None, f"{c} {passage} {c}") for c in "abcdefgh"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    keyed, n = substrings._chunked(docs, "doc_id", "text")
    chunk = {r[0]: r[1] for r in keyed.select(substrings.TEXT, substrings.CHUNK).collect()}
    assert (n > 8) == (size == 40) and max(chunk.values()) < n
    order = sorted(chunk, key=lambda t: (chunk[t], t))
    found = {r._sd_kept: r._sd_removed for r in substrings.find_repeats(docs).collect()}
    assert found[order[0]] == 0 and sum(v == 30 for v in found.values()) == len(order) - 1


def test_rows_that_differ_in_nulls_stay_apart(spark):
    rows = [(None, None), (None, ""), (1, "a b c d e"), (1, "v w x y z"), (None, "=|="), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.text) for r in simhash.drop_near_duplicates(docs.unionAll(docs)).collect()}
    # Texts without words are one group, named by the row with the smallest id.
    assert found == {(2, None), (1, "a b c d e"), (1, "v w x y z"), (None, "=|=")}
