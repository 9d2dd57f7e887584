import random

import pytest

SF = "/root/testdata/sf0.001"
# Names that operators might use for themselves.
CLASHING = ["key", "chunk", "bucket", "words", "n", "id", "size", "place", "group", "score", "label", "root", "fp", "list", "rank", "copies", "taken", "path_", "window", "document"]


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf):
    """(id, text) of the given documents, by id."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


@pytest.fixture(scope="session")
def odd_rows():
    """(id, text, lang, source): nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    long = " ".join(rng.choices(vocabulary, k=30_000))
    rows = [
        (0, passage, "en", "s1"),
        (1, None, "en", "s1"),
        (2, "", "de", None),
        (3, " \t\n ", None, "s2"),
        (4, f"{long} {passage}", "en", "s2"),
        (5, passage, "de", "s3"),
        (5, passage, "de", "s3"),
        (6, f"Before {passage.upper()} after", "en", "s1"),
        (7, "one two three", "en", "s1"),
        (8, "Ünïcödé 漢字 текст 😀 \x0b\x0c end", "de", "s2"),
        (9, "word " * 500, "en", "s3"),
        (10, passage + " tail of words that are new", None, ""),
        (None, "a row without an id " + passage, "en", None),
        (-3, f"{passage} {passage}", "en", "s1"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns of clashing names."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(*r, None if r[1] is None else len(r[1]), *[None] * len(CLASHING)) for r in odd_rows]
    return spark.createDataFrame(rows, schema).repartition(3)
