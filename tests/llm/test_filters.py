import collections

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.oracle import duck, duck_result, spark_result
from vinework.llm import decontaminate, langid, mixing, queries

ITEMS = [
    (1, "one two three"),
    (2, None),
    (3, " ... "),
    (None, "漢字 текст"),
    (10, "word word word word word word word word word word word word word word"),
    (10, "word word word word word word word word word word word word word word"),
    (7, "The quick brown fox jumps over the lazy dog and then some more words follow here"),
]


def digest(found):
    return found.select(
        "doc_id", "_dc_words", "_dc_hit", F.size("_dc_items"), F.sha2(F.concat_ws(",", "_dc_items"), 256), decontaminate.contaminated()
    ).collect()


def test_decontamination_query(spark, sf, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    found = sorted(tuple(r) for r in queries.op2_decontamination(spark, sf).collect())
    assert found == sorted(brute.contamination(documents, items))
    assert any(r[-1] for r in found)


def test_decontamination_odd_rows_in_one_and_many_blocks(spark, odd, odd_rows):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    expected = collections.Counter(brute.contamination([r[:2] for r in odd_rows], ITEMS))
    for size in (decontaminate.BLOCK_BYTES, 200):
        found = decontaminate.find_contamination(odd, items, block_bytes=size)
        assert collections.Counter(tuple(r) for r in digest(found)) == expected


def test_decontamination_drops_rows(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert {7, 9}.isdisjoint(r.doc_id for r in kept.collect())
    assert decontaminate.drop_contaminated(odd, items.limit(0)).count() == odd.count()
    assert decontaminate.drop_contaminated(odd.limit(0), items).count() == 0


def test_language_held_out_accuracy(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = queries.op3_language_id(spark, sf).collect()
    assert all(r.held_out == (brute.residue(r.doc_id, 4) == 2) for r in found) and len(found) == len(truth)
    assert all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_products_are_those_of_bundles():
    """The sum over trigrams is the inner product of the bundled document with the profile."""
    import numpy as np

    text = "Einige Wörter, und mehr".encode()
    keys, index, first = langid._trigrams(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    profile = np.random.default_rng(0).normal(size=(1, langid.DIMENSIONS))
    bundle = langid._bound(keys)[index].astype(float).sum(axis=0)
    assert first.tolist() == [0, len(index)]
    assert np.isclose(langid._Products(profile).of(keys)[index, 0].sum(), bundle @ profile[0])


def test_languages_of_odd_rows(odd):
    found = langid.identify(odd, langid.learn(odd)).collect()
    by_id = {r.doc_id: r for r in found}
    assert by_id[1]._li_lang == by_id[2]._li_lang == by_id[3]._li_lang == "und" and by_id[2]._li_score == 0
    assert by_id[8]._li_lang in ("en", "de") and len(found) == odd.count()
    kept = langid.keep_identified(odd, langid.learn(odd))
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3
    assert kept.filter("lang IS NULL").count() == 0


def test_language_query_matches_plain_bundles(spark, sf, documents):
    """Texts bundled letter by letter, compared with bundled profiles by their cosines."""
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    bundles = {i: brute.bundle(t) for i, t in documents}
    langs = sorted({r.lang for r in rows.values() if r.lang})
    profiles = [sum(b for i, b in bundles.items() if brute.residue(i, 4) != 2 and rows[i].lang == lang) for lang in langs]
    for r in queries.op3_language_id(spark, sf).collect():
        own = bundles[r.doc_id]
        cosines = np.array([own @ p / max(np.linalg.norm(own) * np.linalg.norm(p), 1e-300) for p in profiles])
        assert r.held_out == (brute.residue(r.doc_id, 4) == 2)
        if not own.any():
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        assert r.lang_pred == langs[int(cosines.argmax())]
        assert r.score == pytest.approx(cosines.max() / np.maximum(cosines, 0).sum(), rel=1e-6)


def test_texts_in_no_known_language_go(spark):
    """The stage depends on what the model knows."""
    texts = {
        "en": "the quick brown fox jumps over the lazy dog and then it sleeps under the tree",
        "de": "der schnelle braune Fuchs springt über den faulen Hund und schläft dann unter dem Baum",
    }
    rows = [(i, texts[lang], lang) for i in range(20) for lang in texts]
    rows += [(100, "это предложение написано на языке которого никто здесь не знает", None), (101, texts["de"], None), (102, "ok", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {(r.doc_id, r.lang) for r in langid.keep_identified(docs, langid.learn(docs)).collect()}
    assert kept == {(i, lang) for i in range(20) for lang in texts} | {(101, "de"), (102, next(x for i, x in kept if i == 102))}
    greek = spark.createDataFrame([("ένα κείμενο σε μια άλλη γλώσσα που δεν έχει τίποτα κοινό", "el")], "text string, lang string")
    assert {r.doc_id for r in langid.keep_identified(docs, langid.learn(greek)).collect()} <= {100, 102}


def test_nothing_learned(odd):
    model = langid.learn(odd.limit(0))
    assert {r._li_lang for r in langid.identify(odd, model).collect()} == {"und"}
    assert langid.identify(odd.limit(0), model).count() == 0


def test_mixing_matches_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert spark_result(queries.op4_source_mixing(spark, sf)) == duck_result(duck(sf), queries.OP4_SQL)


def test_mixing_of_repeated_ids_of_different_sizes(spark, tmp_path):
    """Rows of one id are taken together, also where a small and a large one share it."""
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{i % 4}") for i in range(120)] + [(i, "w " * 90, f"s{i % 4}") for i in range(0, 120, 2)]
    rows += [(i, "w", f"s{i % 4}") for i in range(0, 120, 5)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert spark_result(queries.op4_source_mixing(spark, str(tmp_path))) == duck_result(con, queries.OP4_SQL)


def test_mixing_odd_rows(odd, odd_rows):
    found = mixing.shares(odd.select("doc_id", "text", "source")).collect()
    assert sorted(str(r["size"]) for r in found) == sorted(str(len((t or "").encode().split())) for _, t, _, _ in odd_rows)
    sizes, targets, taken = collections.Counter(), {}, collections.Counter()
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        targets[r.source_size, r.target] = r
    assert sum(t for _, t in targets) <= sum(r["size"] for r in found) * (1 + 1e-9)
    again = mixing.shares(odd.select("doc_id", "text", "source").repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    del sizes, taken


def test_mixing_plan_is_native(odd):
    plan = mixing.mix(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mix_returns_taken_documents(odd):
    mixed = mixing.mix(odd)
    rows = mixed.collect()
    assert all(1 <= r.copies <= 3 for r in rows) and mixed.columns[:5] == odd.columns[:5]
    assert mixing.mix(odd.limit(0)).count() == 0
    assert mixing.shares(odd.limit(0).select("doc_id", "text", "source")).count() == 0


def test_mixing_sql_with_nulls_and_empty_sources():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM (VALUES (1, 'a b c', NULL), (2, NULL, 'x'), (3, 'd e', 'y')) t(doc_id, text, source)")
    assert len(con.execute(queries.OP4_SQL).fetchall()) == 3
