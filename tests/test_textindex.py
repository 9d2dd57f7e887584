import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vinework import runtime
from vinework.functions.text import ENGLISH, SIMPLE
from vinework.operators import fulltext
from vinework.operators.hybrid import hybrid
from vinework.sources import textindex
from vinework.sources.collection import CollectionStore
from vinework.sources.textindex import TextIndex

WORDS = [f"w{i}" for i in range(40)]


def texts(seed, ids):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    out = [(i, " ".join(rng.choices(WORDS, weights, k=rng.choice([0, 1, 3, 20, 200])))) for i in ids]
    return [(i, None if t == "" and i % 2 else t) for i, t in out]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, content string")


def queries(spark):
    asked = ["w0", "w0 w1", "w1 w2 w3", "w0 w0", "w35 w1", "unknown w0", "", "w39 w38 w37", None]
    return spark.createDataFrame(list(enumerate(asked)), "qid int, text string")


def ranked(df):
    return sorted((r.qid, r["rank"], r.id, r.score) for r in df.collect())


def expected(spark, rows, k, digits=9):
    asked = fulltext.query_terms(queries(spark), SIMPLE)
    return ranked(fulltext.top_texts(fulltext.rank_bm25(fulltext.postings(frame(spark, rows), SIMPLE), asked), k, digits))


@pytest.fixture
def index(spark, tmp_path):
    return TextIndex(spark, str(tmp_path / "index"), SIMPLE, id_type="bigint", buckets=4, block_docs=8).create()


@pytest.mark.parametrize("k", [1, 3, 1000])
def test_search_equals_ranking_every_match(spark, index, k):
    rows = texts(1, range(400))
    index.add(frame(spark, rows))
    assert ranked(index.search(queries(spark), k, digits=9)) == expected(spark, rows, k)


def test_changes_keep_the_index_exact(spark, index):
    rows = dict(texts(1, range(200)))
    index.add(frame(spark, list(rows.items())))
    for seed in (2, 3):
        fresh = dict(texts(seed, range(100 * seed - 100, 100 * seed + 60)))
        index.add(frame(spark, list(fresh.items())))
        rows |= fresh
        gone = list(range(seed, 300, 7))
        index.delete(frame(spark, [(i, None) for i in [*gone, 10_000]]))
        rows = {i: t for i, t in rows.items() if i not in gone}
        assert ranked(index.search(queries(spark), 5, digits=9)) == expected(spark, list(rows.items()), 5)
    index.compact()
    again = TextIndex(spark, index.path, SIMPLE, id_type="bigint", buckets=4, block_docs=8).create()
    assert len(again._committed()) == 1
    assert ranked(again.search(queries(spark), 5, digits=9)) == expected(spark, list(rows.items()), 5)
    again.add(frame(spark, [(1, "w0 w1 w2 w3")]))
    rows[1] = "w0 w1 w2 w3"
    assert ranked(again.search(queries(spark), 5, digits=9)) == expected(spark, list(rows.items()), 5)
    live = {(r.term, r.id, r.tf, r.length) for r in again.postings().collect()}
    assert live == {tuple(r) for r in fulltext.postings(frame(spark, list(rows.items())), SIMPLE).collect()}


def test_frequent_terms_are_mostly_not_scored(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(["a"] * rng.randint(1, 30) + ["b"] * rng.randint(1, 30) + ["c"] * rng.randint(0, 200))) for i in range(6000)]
    index = TextIndex(spark, str(tmp_path / "i"), SIMPLE, id_type="bigint", buckets=4, block_docs=16).create()
    index.add(frame(spark, rows))
    asked = spark.createDataFrame([(1, "a b"), (2, "a"), (3, "b c")], "qid int, text string")
    for r in index.scored_blocks(asked, 5, digits=9).collect():
        # No single document has the largest counts of both b and c, so the bounds of that pair are looser.
        assert r.blocks > 300 and r.scored < r.blocks * (0.8 if r.qid == 3 else 0.33), r
    whole = fulltext.top_texts(fulltext.rank_bm25(fulltext.postings(frame(spark, rows), SIMPLE), fulltext.query_terms(asked, SIMPLE)), 5, 9)
    assert ranked(index.search(asked, 5, digits=9)) == ranked(whole)


def test_scan_reads_the_buckets_and_bounds_only(spark, index):
    index.add(frame(spark, texts(1, range(50))))
    asked = spark.createDataFrame([("w0",)], "term string")
    blocks = index._blocks(index._numbers(asked, "term"), index._committed())
    plan = blocks.select("term", "block", "max_tf")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<term:string,block:bigint,max_tf:int>" in plan


def test_a_failed_batch_does_not_count(spark, index, monkeypatch):
    index.add(frame(spark, texts(1, range(30))))
    before = ranked(index.search(queries(spark), 4, digits=9))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(index, "_commit", fail)
        with pytest.raises(RuntimeError):
            index.add(frame(spark, texts(2, range(60))))
    assert ranked(index.search(queries(spark), 4, digits=9)) == before
    index.add(frame(spark, texts(3, range(20))))
    rows = dict(texts(1, range(30))) | dict(texts(3, range(20)))
    assert ranked(index.search(queries(spark), 4, digits=9)) == expected(spark, list(rows.items()), 4)


def test_empty_index_and_empty_batches(spark, index):
    assert index.search(queries(spark), 4).count() == 0
    index.add(frame(spark, []))
    index.delete(frame(spark, [(1, None)]))
    index.compact()
    assert index.search(queries(spark), 4).count() == 0 and index.postings().count() == 0


def test_repeated_ids_need_an_order(spark, index):
    rows = spark.createDataFrame([(1, "w0", 1), (1, "w1", 2)], "id bigint, content string, seq int")
    index.add(rows)
    assert [r.term for r in index.postings().filter("term <> ''").collect()] == ["w1"]
    with pytest.raises(Exception, match="seq column"):
        index.add(rows.drop("seq"))


def test_collection_keeps_its_index_and_hybrid_search_uses_it(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "text"), ENGLISH, buckets=4)
    store = CollectionStore(spark, str(tmp_path / "rows"), buckets=2, index=index).create()
    rows = [("a", "graph databases store graphs", [1.0, 0.0]), ("b", "a vector database", [0.0, 1.0]), ("c", "graph of a database", [1.0, 1.0]), ("d", "nothing", [0.5, 0.1])]
    store.add(spark.createDataFrame(rows, "id string, content string, embedding array<float>"))
    store.add(spark.createDataFrame([("d", "database of a graph, a graph", [0.5, 0.1])], "id string, content string, embedding array<float>"))
    store.delete(spark.createDataFrame([("a",)], "id string"))
    asked = spark.createDataFrame([(1, "graph database", [1.0, 0.2])], "qid int, text string, embedding array<float>")
    for where in (None, F.col("id") != "c"):
        plain = hybrid(store.read(), asked, 3, where=where, config=ENGLISH, digits=9, keep_text_only=True)
        stored = hybrid(store.read(), asked, 3, where=where, config=ENGLISH, digits=9, keep_text_only=True, index=index)
        assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect())) and plain.count() > 0
    with pytest.raises(ValueError, match="bm25"):
        hybrid(store.read(), asked, 3, ranking="proximity", index=index)
    store.drop()
    assert not index.exists()


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange REBALANCE") + plan.count("Exchange rangepartitioning")


def test_postings_are_made_where_their_block_is(spark, index, monkeypatch):
    written = {}
    plain = TextIndex._write_dealt

    def spy(self, rows, name, seq, *order):
        written[name, seq] = exchanges(rows)
        plain(self, rows, name, seq, *order)

    monkeypatch.setattr(TextIndex, "_write_dealt", spy)
    monkeypatch.setattr("vinework.sources.textindex.LEAST_WORDS", 64)  # several tasks for few words
    index.add(frame(spark, texts(1, range(60))))
    index.add(frame(spark, texts(2, range(30, 90))))
    index.compact()
    assert [written["postings", seq] for seq in (1, 2, 3)] == [1, 1, 1]


def grouped(entries):
    """Bounds and documents per term and block, by plain means."""
    found = {}
    for term, block, i, tf, length in entries:
        found.setdefault((term, block), []).append((i, tf, length))
    return {k: (len(v), max(x[1] for x in v), min(x[2] for x in v), tuple(zip(*sorted(v), strict=True))) for k, v in found.items()}


def test_rare_terms_have_a_row_per_task_and_not_one_per_block(spark, index, monkeypatch):
    monkeypatch.setattr("vinework.functions.runs.RUN", 4)  # also runs that end before a term's last block
    rows = [(i, f"w{i % 90} w{i % 70} " + " ".join(["all"] * (1 + i % 3))) for i in range(600)]
    index.add(frame(spark, rows))
    index.add(frame(spark, [(i, t + " all") for i, t in rows[100:200]]))
    index.delete(frame(spark, [(i, None) for i in range(0, 600, 50)]))
    index.compact()
    committed = index._committed()
    place = {r.id: (r.block, r.length) for r in index.live_docs().collect()}
    now = {i: t + (" all" if 100 <= i < 200 else "") for i, t in rows if i % 50}
    assert place.keys() == now.keys()
    entries = [(w, place[i][0], i, t.split().count(w), place[i][1]) for i, t in now.items() for w in set(t.split())]
    split = textindex._split(index._blocks(None, committed)).collect()
    assert {(r.term, r.block): (r.n, r.max_tf, r.min_length, (tuple(r.ids), tuple(r.tfs), tuple(r.lengths))) for r in split} == grouped(entries)
    stored = index._blocks(None, committed).collect()
    assert len(split) == len(grouped(entries)) and len(stored) < len(split) / 1.5
    assert sum(r.term == "all" for r in stored) > 20 and all(r.n < 4 + max(r.sizes) for r in stored)


def test_a_compaction_shuffles_a_row_per_task_and_not_one_per_entry(spark, index, monkeypatch):
    dealt = []
    kind = type(index.live_docs())
    plain = kind.repartition

    def spy(self, n, *columns):
        dealt.append(self)
        return plain(self, n, *columns)

    rows = texts(4, range(300))
    index.add(frame(spark, rows))
    index.delete(frame(spark, [(i, None) for i in range(0, 300, 3)]))
    with monkeypatch.context() as patch:
        # The entries are read before the older batches go.
        patch.setattr(textindex, "delete_folder", lambda *_: None)
        patch.setattr(kind, "repartition", spy)
        index.compact()
        files = spark.read.parquet(f"{index.path}/postings").filter("seq < 3")
        assert dealt[-1].count() <= 2 * files.rdd.getNumPartitions() + 2
    live = {(r.term, r.id, r.tf, r.length) for r in index.postings().collect()}
    assert live == {tuple(r) for r in fulltext.postings(frame(spark, [r for r in rows if r[0] % 3]), SIMPLE).collect()}


def test_a_compaction_of_deleted_documents_only(spark, index):
    index.add(frame(spark, texts(5, range(40))))
    index.delete(frame(spark, [(i, None) for i in range(40)]))
    index.compact()
    assert index.postings().count() == 0 and index.live_docs().count() == 0
    index.add(frame(spark, [(1, "w0")]))
    assert [(r.term, r.id) for r in index.postings().filter("term <> ''").collect()] == [("w0", 1)]


def test_texts_of_a_batch_are_not_kept_beside_the_index(spark, index):
    before = set(Path(runtime._own_dir(spark)).rglob("*.parquet"))
    index.add(frame(spark, texts(6, range(40))))
    index.compact()
    assert set(Path(runtime._own_dir(spark)).rglob("*.parquet")) == before
