import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vinework.llm import queries, simhash, substrings
from vinework.llm.components import connected


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def test_simhash_query(spark, sf, documents):
    found = [tuple(r) for r in queries.op1_simhash(spark, sf).collect()]
    assert by_id(found) == by_id(brute.components(documents))


def test_simhash_odd_rows(odd, odd_rows):
    found = simhash.near_duplicates(odd)
    rows = found.select("doc_id", F.lower(F.lpad(F.hex("_sh_fp"), 16, "0")), "_sh_id", "fp", "root").collect()
    assert by_id([tuple(r)[:3] for r in rows]) == by_id(brute.components([r[:2] for r in odd_rows]))


def test_one_document_of_a_group_stays(odd, odd_rows):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    expected = brute.components([r[:2] for r in odd_rows])
    groups = {least for _, _, least in expected}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(g for g in groups if g is not None)


def test_simhash_empty(odd):
    none = odd.limit(0)
    assert simhash.near_duplicates(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


def test_position_sets_cover_the_guaranteed_matches():
    from itertools import combinations

    for distance in range(6):
        wanted = [set(p) for p in simhash.position_sets(distance)]
        assert all(any(w <= set(shared) for w in wanted) for shared in combinations(range(8), 8 - distance))
    assert len(simhash.position_sets(4)) == 70 and {len(p) for p in simhash.position_sets(4)} == {4}


def test_long_posting_lists_in_parts(spark, monkeypatch):
    """A chain in one posting list, cut into parts: links across parts hold it together."""
    monkeypatch.setattr(simhash, "LONG_LIST", 3)
    prints = [0x1234_5678_9ABC_DE00 ^ (1 << i) for i in range(20)] + [0xFF, 0x0F_FF00_0000_0000]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp bigint"))
    found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in connected(links).collect()}
    expected = {p: r for p, r in brute.groups(prints).items()}
    linked = {p for p, r in expected.items() if list(expected.values()).count(r) > 1}
    assert set(found) == linked
    assert len({found[p] for p in linked}) == len({expected[p] for p in linked})


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (-5, 300), (300, 250)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 100 for i in range(100, 140))
    assert found[250] == found[300] == found[-5] == -5


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_substring_query(spark, sf, documents):
    found = [tuple(r) for r in queries.op5_substring_dedup(spark, sf).collect()]
    assert by_id(found) == by_id(brute.kept_words(documents))


def test_substrings_odd_rows(odd, odd_rows):
    rows = sorted((r[:2] for r in odd_rows), key=lambda r: (r[0] is None, r[0] or 0))
    found = substrings.find_repeats(odd).select("doc_id", "_sd_words", "_sd_removed", "_sd_sha256", "chunk", "key").collect()
    assert by_id([tuple(r)[:4] for r in found]) == by_id(brute.kept_words(rows))


def test_spans_and_kept_texts_agree(odd, odd_rows):
    texts = {(r[0], r[1]) for r in odd_rows}
    for row in substrings.find_repeats(odd).collect():
        options = [t for i, t in texts if i == row.doc_id]
        assert any(_cut(t, row._sd_spans) == (row._sd_kept or "").split() for t in options)


def _cut(text, spans):
    raw = (text or "").encode()
    for span in reversed(spans):
        raw = raw[: span.start] + b" " + raw[span.stop :]
    return raw.decode().replace("\x0b", " ").replace("\x0c", " ").split()


def test_cut_texts_keep_rows_and_columns(odd):
    out = substrings.drop_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert all(r.text is None or r.n_chars == len(r.text) for r in out.collect())


def test_substrings_empty(odd):
    assert substrings.drop_repeats(odd.limit(0)).count() == 0


@pytest.mark.parametrize("direct", [0, 256])
def test_substrings_with_many_small_chunks(spark, documents, monkeypatch, direct):
    """Both exchanges equal brute force, also where chunks are many and a text is longer than a chunk."""
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 5000)
    monkeypatch.setattr(substrings, "LEAST_BYTES", 5000)
    monkeypatch.setattr(substrings, "DIRECT", direct)
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    n = substrings._chunked(docs, "doc_id", "text")[1]
    assert n > 30
    columns = ["doc_id", "_sd_words", "_sd_removed", "_sd_sha256"]
    found = [tuple(r) for r in substrings.find_repeats(docs).select(*columns).collect()]
    assert by_id(found) == by_id(brute.kept_words(documents))


def test_substrings_chunks_follow_bytes(spark, monkeypatch):
    """An id, or no id, with a third of the text is cut; shuffle partitions don't multiply the runs."""
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(substrings, "LEAST_BYTES", 20_000)
    words = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    passage = " ".join(f"p{j}" for j in range(25))
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"{words(i)} {passage}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed, n = substrings._chunked(docs, "doc_id", "text")
    sizes = [r.n for r in keyed.groupBy(substrings.CHUNK).agg(F.sum(F.octet_length(substrings.TEXT)).alias("n")).collect()]
    assert len(sizes) <= n and max(sizes) < 3 * substrings.CHUNK_BYTES
    spans = keyed.groupBy(substrings.CHUNK).agg(F.min(substrings.ID).alias("a"), F.max(substrings.ID).alias("b"), F.count(substrings.ID).alias("n"))
    order = [(r.a, r.b) for r in spans.orderBy(substrings.CHUNK).collect() if r.n]
    assert all(x[1] <= y[0] for x, y in zip(order, order[1:], strict=False))
    removed = [r._sd_removed for r in substrings.find_repeats(docs).collect()]
    assert sorted(removed) == [0] + [25] * 899
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert substrings._chunked(docs, "doc_id", "text")[1] == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_links_to_one_smaller_key_need_no_round(spark, monkeypatch):
    from vinework.llm import components

    rows = [(5, 1), (6, 1), (9, 7)]
    chain = spark.createDataFrame([(5, 3), (3, 1), (2, 8)], "a bigint, b bigint")
    assert sorted(map(tuple, components.connected(chain).collect())) == [(1, 1), (2, 2), (3, 1), (5, 1), (8, 2)]
    monkeypatch.setattr(components, "_star", None)
    found = components.connected(spark.createDataFrame(rows, "a bigint, b bigint"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (5, 1), (6, 1), (7, 7), (9, 7)]
