import math
import re

import pytest
from pyspark.sql import functions as F

from vinework.functions import text as words
from vinework.functions.text import ENGLISH, SIMPLE, UNSTEMMED
from vinework.operators import fulltext
from vinework.operators.hybrid import fuse, hybrid
from vinework.runtime import cut_lineage

# Pairs of the algorithm's published sample vocabulary, and of its description.
STEMS = dict(
    pair.split(":")
    for pair in """
    consign:consign consigned:consign consigning:consign consignment:consign consist:consist consisted:consist
    consistency:consist consistent:consist consistently:consist consisting:consist consists:consist consolation:consol
    consolations:consol consolatory:consolatori console:consol consoled:consol consoles:consol consolidate:consolid
    consolidated:consolid consolidating:consolid consoling:consol consolingly:consol consols:consol consonant:conson
    consort:consort consorted:consort consorting:consort conspicuous:conspicu conspicuously:conspicu
    conspiracy:conspiraci conspirator:conspir conspirators:conspir conspire:conspir conspired:conspir
    conspiring:conspir constable:constabl constables:constabl constance:constanc constancy:constanc constant:constant
    knack:knack knackeries:knackeri knacks:knack knag:knag knave:knave knaves:knave knavish:knavish kneaded:knead
    kneading:knead knee:knee kneel:kneel kneeled:kneel kneeling:kneel kneels:kneel knees:knee knell:knell knelt:knelt
    knew:knew knick:knick knif:knif knife:knife knight:knight knightly:knight knights:knight knit:knit knits:knit
    knitted:knit knitting:knit knives:knive knob:knob knobs:knob knock:knock knocked:knock knocker:knocker
    knockers:knocker knocking:knock knocks:knock knopp:knopp knot:knot knots:knot
    ties:tie cries:cri gas:gas gaps:gap kiwis:kiwi this:this hoped:hope hopping:hop luxuriated:luxuri cry:cri by:by
    say:say news:news skies:sky dying:die early:earli proceed:proceed generate:generat generously:generous
    """.split()
)


@pytest.mark.parametrize(("word", "stem"), sorted(STEMS.items()))
def test_stems(word, stem):
    assert words.stem_word(word) == stem


def test_other_scripts_pass_through():
    assert [words.stem_word(w) for w in ("été", "v2", "x", "größen")] == ["été", "v2", "x", "größen"]


def test_terms_of_each_configuration(spark):
    df = spark.createDataFrame([("The Running dogs, in 2 houses! The end",), (None,)], "t string")

    def of(config):
        return [r.x for r in df.select(words.terms(F.col("t"), config).alias("x")).collect()]

    assert of(SIMPLE) == [["the", "running", "dogs", "in", "2", "houses", "the", "end"], None]
    assert of(UNSTEMMED) == [["running", "dogs", "2", "houses", "end"], None]
    assert of(ENGLISH) == [["run", "dog", "2", "hous", "end"], None]


TEXTS = [
    (1, "graph databases store graphs"),
    (2, "a vector database; and a graph of vectors"),
    (3, "graph one two three four five six database"),
    (4, "nothing here"),
    (5, ""),
    (6, "databases, graphs, databases, graphs"),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(TEXTS, "id bigint, content string")


def asked(spark, *texts, config=ENGLISH):
    return fulltext.query_terms(spark.createDataFrame(list(enumerate(texts)), "qid int, text string"), config)


def english(text):
    found = [(i + 1, w) for i, w in enumerate(re.findall(r"[a-z0-9]+", text.lower()))]
    return [(i, words.stem_word(w)) for i, w in found if w not in words.STOP_WORDS]


def test_match_needs_all_terms_and_some_term(spark, corpus):
    index = fulltext.postings(corpus)
    found = fulltext.match(index, asked(spark, "graph database", "the of", "vectors", "graph unknown"))
    expected = set()
    for q, text in enumerate(["graph database", "the of", "vectors", "graph unknown"]):
        wanted = {t for _, t in english(text)}
        expected |= {(q, i) for i, t in TEXTS if wanted and wanted <= {x for _, x in english(t)}}
    assert {(r.qid, r.id) for r in found.collect()} == expected


def proximity(text, query):
    where = {}
    for i, t in english(text):
        where.setdefault(t, []).append(i)
    wanted = sorted({t for _, t in english(query)})
    if len(wanted) == 1:
        return sum(0.1 / j**2 for j in range(1, len(where[wanted[0]]) + 1)) / 1.64493406685
    miss = 1.0
    for n, a in enumerate(wanted):
        for b in wanted[:n]:
            for x in where[a]:
                for y in where[b]:
                    gap = abs(x - y)
                    miss *= 1 if gap > 100 else 1 - 0.1 * math.sqrt(1 / (1.005 + 0.05 * math.exp(gap / 1.5 - 2)))
    return 1 - miss


def test_proximity_rank_against_brute_force(spark, corpus):
    queries = ["graph database", "graph", "vector graph database"]
    index = fulltext.postings(corpus, positions=True)
    found = fulltext.rank_proximity(index, asked(spark, *queries)).collect()
    assert len(found) == 9
    for r in found:
        assert r.score == pytest.approx(proximity(dict(TEXTS)[r.id], queries[r.qid]), abs=1e-12)


def test_proximity_has_no_limit_of_position_or_count(spark):
    filler = "word " * 16_400
    texts = [(1, f"alpha beta {filler}"), (2, f"{filler} alpha beta"), (3, "beta " * 300 + filler + " alpha beta"), (4, f"alpha {filler} beta")]
    index = fulltext.postings(spark.createDataFrame(texts, "id bigint, content string"), words.SIMPLE, positions=True)
    queries = spark.createDataFrame([(0, "alpha beta"), (1, "word")], "qid bigint, text string")
    found = {(r.qid, r.id): r.score for r in fulltext.rank_proximity(index, fulltext.query_terms(queries, words.SIMPLE)).collect()}
    assert found[0, 1] == found[0, 2] > 0.09 and found[0, 3] == pytest.approx(found[0, 1]) and found[0, 4] == 0
    assert found[1, 1] == pytest.approx(0.1, abs=1e-4)


def test_frequent_terms_are_looked_up_for_candidates_only(spark):
    texts = [(i, f"common {'rare' if i == 7 else 'other'}") for i in range(50)]
    index = cut_lineage(fulltext.postings(spark.createDataFrame(texts, "id bigint, content string"), words.SIMPLE), "index")
    queries = spark.createDataFrame([(q, "common rare") for q in range(20)], "qid bigint, text string")
    found = fulltext.hits(index, fulltext.query_terms(queries, words.SIMPLE))
    assert found.count() == 40 and {r.id for r in found.collect()} == {7}


def test_restricted_postings_equal_the_index(spark, corpus):
    terms = asked(spark, "graph database")
    whole = fulltext.postings(corpus, positions=True).filter(F.col("term").isin("graph", "databas", ""))
    assert sorted(map(repr, fulltext.query_postings(corpus, terms, positions=True).collect())) == sorted(map(repr, whole.collect()))


def test_index_on_disk_gives_the_same_ranks(spark, corpus, tmp_path):
    index = fulltext.postings(corpus, positions=True)
    fulltext.save_postings(index, str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    terms = asked(spark, "graph database")
    assert sorted(fulltext.rank_bm25(stored, terms).collect()) == sorted(fulltext.rank_bm25(index, terms).collect())


def test_bm25_against_brute_force(spark, corpus):
    found = {r.id: r.score for r in fulltext.rank_bm25(fulltext.postings(corpus), asked(spark, "graph database")).collect()}
    sizes = {i: len(re.findall(r"[a-z0-9]+", t.lower())) for i, t in TEXTS}
    mean = sum(sizes.values()) / len(sizes)
    bags = {i: [w for _, w in english(t)] for i, t in TEXTS}
    for i, score in found.items():
        total = 0.0
        for term in ("graph", "databas"):
            df = sum(term in bag for bag in bags.values())
            tf = bags[i].count(term)
            total += math.log(1 + (6 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * sizes[i] / mean))
        assert score == pytest.approx(total, abs=1e-12)
    assert sorted(found) == [1, 2, 3, 6]


def test_fusion_scores(spark):
    near = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "qid int, id string, _near int")
    worded = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "qid int, id string, _worded int")
    rows = {r.id: (r.rank, r.score) for r in fuse(near, worded, 4).collect()}
    assert rows == {"b": (1, pytest.approx(1 / 62 + 1 / 61)), "a": (2, pytest.approx(1 / 61))}
    assert {r.id for r in fuse(near, worded, 4, keep_text_only=True).collect()} == {"a", "b", "c"}


def test_hybrid_filter_holds_for_both_lists(spark, corpus):
    vectors = corpus.withColumn("embedding", F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")))
    queries = spark.createDataFrame([(0, "graph database", [1.0, 1.0])], "qid int, text string, embedding array<float>")
    found = hybrid(vectors, queries, 3, "l2", where=F.col("id") > 1, keep_text_only=True).collect()
    assert {r.id for r in found} <= {2, 3, 4, 5, 6}
    index = fulltext.postings(vectors, positions=True)
    again = hybrid(vectors, queries, 3, "l2", where=F.col("id") > 1, keep_text_only=True, index=index).collect()
    assert sorted(found) == sorted(again)
    assert all(r.distance == pytest.approx(1 - r.score) for r in found)


def test_row_wise_match(spark):
    df = spark.createDataFrame([(["a", "b"], ["a"]), (["a"], ["a", "b"]), (["a"], [])], "t array<string>, q array<string>")
    assert [r.x for r in df.select(words.matches_all(F.col("t"), F.col("q")).alias("x")).collect()] == [True, False, False]
