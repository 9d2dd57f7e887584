"""A stored text index: postings in blocks, kept up to date, searched with block-max pruning.

Documents of a batch are dealt to blocks of about ``block_docs`` documents of
similar length. For a term and a block the largest term frequency and the
smallest length among the term's documents are stored, from which the largest
BM25 share of the term in the block follows for any corpus statistics. A posting
row is a run: one term's documents in some blocks of one task, with these bounds
per block, so that rare terms don't have a row per block.

A search first reads these bounds only. A block can hold a result of a query
only if it has all its terms, and no result in it scores more than the sum of
its bounds. The best few blocks of every query are scored, their k-th best
score becomes the query's threshold, and of the rest only blocks that can reach
it are scored. The result equals that of ranking every match.

On disk, postings are partitioned by batch and by a hash bucket of the term, so
a search lists and reads the buckets of its terms. A batch is a new folder: an
upsert or a deletion rewrites nothing, it names the older rows that are gone.
The batch counts when its row in ``batches`` is written, which comes last;
what a failed batch left is overwritten by the next. :meth:`TextIndex.compact`
rewrites the live rows as one batch. One writer at a time.

Rows are shuffled once, by block: a block's texts meet in one task, which makes
all its postings in whole columns (:mod:`vinework.functions.runs`) and writes
them to the buckets. A compaction shuffles entries, packed into a row per task
that is to hold them; the marks of deleted documents travel among them. Neither
single words nor finished postings are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vinework.functions import runs
from vinework.functions import text as words
from vinework.functions.text import ENGLISH, TextConfig
from vinework.operators import fulltext
from vinework.runtime import cut_lineage, delete_folder, folder_exists, scratch
from vinework.sources.collection import last_of_batch

LENGTH_STEPS = 8  # classes of length per factor e
FIRST_BLOCKS = 4  # of each query, scored before its threshold is known
TASK_WORDS = 1 << 22  # of the blocks that one task writes, and the least that is worth another task
LEAST_WORDS = 1 << 18


class TextIndex:
    def __init__(
        self, spark: SparkSession, path: str, config: TextConfig = ENGLISH, *, id_type: str = "string", buckets: int = 256, block_docs: int = 128
    ) -> None:
        self.spark, self.path, self.config = spark, path.rstrip("/"), config
        self.id_type, self.buckets, self.block_docs = id_type, buckets, block_docs

    # ---- folders

    def exists(self) -> bool:
        return folder_exists(self.spark, f"{self.path}/batches")

    def create(self, replace: bool = False) -> TextIndex:
        """Create the index unless it exists; ``replace`` empties it."""
        if replace or not self.exists():
            self.drop()
            self._commit(0, 0, 0, 0, 0)
        return self

    def drop(self) -> None:
        delete_folder(self.spark, self.path)

    def _committed(self) -> list:
        """Rows of the batches that count: those since the last compaction."""
        rows = self.spark.read.schema("n bigint, words bigint, gone bigint, base int, seq int").parquet(f"{self.path}/batches").collect()
        base = max(r["base"] for r in rows)
        return sorted((r for r in rows if r["seq"] >= base), key=lambda r: r["seq"])

    def _commit(self, seq: int, n: int, n_words: int, gone: int, base: int) -> None:
        row = self.spark.createDataFrame([(n, n_words, gone, base)], "n bigint, words bigint, gone bigint, base int")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batches/seq={seq}")

    def _table(self, name: str, schema: str, buckets: list[int] | None = None, rows: list | None = None) -> DataFrame:
        """Rows of the batches that count; with ``buckets``, of these only."""
        seqs = [r["seq"] for r in (rows or self._committed())]
        parts = "seq int, bucket int"
        if not folder_exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], f"{schema}, {parts}")
        found = self.spark.read.schema(f"{schema}, {parts}").parquet(f"{self.path}/{name}").filter(F.col("seq").isin(seqs))
        return found if buckets is None else found.filter(F.col("bucket").isin(buckets))

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets).cast("bigint")).cast("int").alias("bucket")

    def _numbers(self, rows: DataFrame, key: str) -> list[int]:
        # One small number per bucket at most.
        return sorted(r["bucket"] for r in rows.select(self._bucket(key)).distinct().collect())

    def _write(self, rows: DataFrame, name: str, seq: int, *order: str) -> None:
        # A hot bucket is written by several tasks.
        self._write_dealt(rows.hint("rebalance", "bucket"), name, seq, *order)

    def _write_dealt(self, rows: DataFrame, name: str, seq: int, *order: str) -> None:
        """Every task writes what it has of each bucket."""
        rows.sortWithinPartitions("bucket", *order).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/seq={seq}")

    # ---- contents

    @property
    def _doc_schema(self) -> str:
        return f"id {self.id_type}, block bigint, length int"

    def _docs(self, buckets: list[int] | None = None, rows: list | None = None) -> DataFrame:
        return self._table("docs", self._doc_schema, buckets, rows)

    def _gone(self, rows: list) -> DataFrame | None:
        """Replaced and deleted documents, None if there are none."""
        return self._table("gone", self._doc_schema, rows=rows).select("id", "block", "length") if any(r["gone"] for r in rows) else None

    def _blocks(self, buckets: list[int] | None, rows: list) -> DataFrame:
        """Posting rows: runs of blocks, named by their first."""
        return self._table("postings", runs.posting_schema(self.id_type), buckets, rows)

    def live_docs(self) -> DataFrame:
        """``id, block, length`` of all documents."""
        rows = self._committed()
        docs, gone = self._docs(rows=rows).select("id", "block", "length"), self._gone(rows)
        return docs if gone is None else docs.join(gone.select("id", "block"), ["id", "block"], "left_anti")

    def postings(self, asked: DataFrame | None = None) -> DataFrame:
        """Live postings in the shape of :func:`fulltext.postings`, of the terms of ``asked`` if given."""
        rows = self._committed()
        blocks, gone = self._blocks(None if asked is None else self._numbers(asked, "term"), rows), self._gone(rows)
        if asked is not None:
            blocks = blocks.join(asked.select("term").distinct(), "term", "left_semi")
        found = _entries(_split(blocks))
        found = found if gone is None else found.join(gone.select("id", "block"), ["id", "block"], "left_anti")
        whole = self.live_docs().select(F.lit(fulltext.WHOLE).alias("term"), "id", F.lit(1).cast("bigint").alias("tf"), "length")
        return found.select("term", "id", F.col("tf").cast("bigint").alias("tf"), "length").unionByName(whole)

    # ---- changes

    def add(self, documents: DataFrame, *, text_col: str = "content", id_col: str = "id") -> None:
        """Insert or replace documents. A ``seq`` column orders rows with the same id, as in :func:`last_of_batch`."""
        with scratch(self.spark):
            self._add(documents, text_col, id_col)

    def _add(self, documents: DataFrame, text_col: str, id_col: str) -> None:
        order = ["seq"] if "seq" in documents.columns else []
        rows = documents.select(F.col(id_col).cast(self.id_type).alias("id"), F.col(text_col).alias("content"), *order)
        rows = last_of_batch(rows) if order else rows
        text = F.coalesce("content", F.lit(""))
        texts = cut_lineage(rows.select("id", "content", F.size(words.tokens(text)).alias("length")), "texts")
        # Without an order, rows with the same id have to be equal; their digests are compared, so no text is shuffled for it.
        docs = cut_lineage(last_of_batch(texts.select("id", "length", F.xxhash64("content").alias("_mark"))).select("id", "length"), "docs")
        if texts.count() > docs.count():
            texts = last_of_batch(texts)
        seq = self._committed()[-1]["seq"] + 1
        classes = self._classes(docs)
        block = self._block(classes, seq)
        dealt = texts.withColumn("block", block).repartition(self._tasks(sum(r["words"] for r in classes)), "block")
        terms = dealt.select("id", "block", "length", words.terms(text, self.config).alias("terms"))
        found = terms.mapInArrow(runs.of_texts, runs.posting_schema(self.id_type))
        self._append(found, docs.withColumn("block", block).select("id", "block", "length"), seq)

    def delete(self, ids: DataFrame) -> None:
        """Remove documents; unknown ids are ignored."""
        seq = self._committed()[-1]["seq"] + 1
        keys = cut_lineage(ids.select(F.col("id").cast(self.id_type).alias("id")).distinct(), "ids")
        gone, removed = self._mark_gone(keys, seq)
        self._commit(seq, -gone, -removed, gone, self._committed()[-1]["base"])

    def compact(self) -> None:
        """Rewrite all live rows as one batch and delete the older ones."""
        with scratch(self.spark):
            self._compact()

    def _compact(self) -> None:
        rows = self._committed()
        seq = rows[-1]["seq"] + 1
        docs = cut_lineage(self.live_docs(), "live")
        classes, gone = self._classes(docs), self._gone(rows)
        n_words = sum(r["words"] for r in classes)
        entries = self._blocks(None, rows).select("term", "block", "ids", "tfs", "lengths")
        if gone is not None:
            # Deleted documents go where their entries go, so that a mark among the entries stands for a join.
            marks = gone.select(F.lit(None).cast("string").alias("term"), "block", F.array("id").alias("ids"), F.array(F.lit(0)).alias("tfs"), F.array("length").alias("lengths"))
            entries = entries.unionByName(marks)
            n_words += gone.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        if classes:
            tasks = self._tasks(n_words)
            # Where no document of a class is left, its entries are dropped wherever they go.
            deal = runs.dealing([(r["kind"], r["parts"], r["least"]) for r in classes], seq, self._names_of(tasks))
            lots = entries.withColumn("hashes", F.transform("ids", lambda key: F.xxhash64(key))).mapInArrow(deal, runs.lot_schema(self.id_type))
            found = lots.repartition(tasks, "task").mapInArrow(runs.of_lots, runs.posting_schema(self.id_type))
        else:
            found = self._blocks([], rows).drop("seq", "bucket")
        self._append(found, docs.withColumn("block", self._block(classes, seq)).select("id", "block", "length"), seq, base=seq)
        for row in rows:
            for name in ("postings", "docs", "gone"):
                delete_folder(self.spark, f"{self.path}/{name}/seq={row['seq']}")
        for row in rows:
            delete_folder(self.spark, f"{self.path}/batches/seq={row['seq']}")

    def _classes(self, docs: DataFrame) -> list:
        """Classes of length, one per step of length (some 200 rows): ``kind, parts, least, words``."""
        n, n_words = F.count(F.lit(1)), F.sum("length")
        # Blocks of long documents are smaller, so that one task can hold any block.
        parts = F.greatest(F.ceil(n / self.block_docs), F.ceil(n_words / TASK_WORDS)).cast("bigint")
        return sorted(docs.groupBy(_kind().alias("kind")).agg(parts.alias("parts"), F.min("length").alias("least"), n_words.alias("words")).collect())

    def _block(self, classes: list, seq: int) -> Column:
        """Number of a document's block, which are its batch, its class of length and a part of the class."""
        parts = F.create_map(*(F.lit(x) for r in classes for x in (r["kind"], r["parts"]))) if classes else None
        part = F.pmod(F.xxhash64("id"), parts[_kind()]) if classes else F.lit(0).cast("bigint")
        return F.lit(seq).cast("bigint") * (1 << runs.BATCH_SHIFT) + _kind().cast("bigint") * (1 << runs.KIND_SHIFT) + part

    def _tasks(self, n_words: int) -> int:
        """Tasks to deal the blocks of so many words to."""
        return max(1, -(-n_words // TASK_WORDS), min(self.spark.sparkContext.defaultParallelism, -(-n_words // LEAST_WORDS)))

    def _names_of(self, tasks: int) -> list[int]:
        """A value for each of the tasks that Spark deals to a task of its own."""
        found = self.spark.range(64 * tasks).select(F.col("id").cast("int").alias("name"))
        found = found.groupBy(F.pmod(F.hash("name"), F.lit(tasks)).alias("task")).agg(F.min("name").alias("name"))
        return sorted(r["name"] for r in found.collect())

    def _append(self, found: DataFrame, docs: DataFrame, seq: int, base: int | None = None) -> None:
        """Write a batch. The tasks that made posting rows write them."""
        self._write_dealt(found.withColumn("bucket", self._bucket("term")), "postings", seq)
        self._write(docs.withColumn("bucket", self._bucket("id")), "docs", seq, "id")
        fresh = self.spark.read.schema(f"{self._doc_schema}, bucket int").parquet(f"{self.path}/docs/seq={seq}")
        total = fresh.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("words")).first()
        gone, removed = (0, 0) if base is not None else self._mark_gone(fresh.select("id"), seq)
        base = self._committed()[-1]["base"] if base is None else base
        self._commit(seq, total["n"] - gone, total["words"] - removed, gone, base)

    def _mark_gone(self, ids: DataFrame, seq: int) -> tuple[int, int]:
        """Name the live rows of ``ids`` that are older; their number and words."""
        rows = self._committed()
        old, before = self._docs(self._numbers(ids, "id"), rows).select("id", "block", "length"), self._gone(rows)
        old = old.join(ids.select("id"), "id", "left_semi")
        old = old if before is None else old.join(before.select("id", "block"), ["id", "block"], "left_anti")
        old = cut_lineage(old, "gone")
        total = old.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("words")).first()
        self._write(old.withColumn("bucket", self._bucket("id")), "gone", seq, "id")
        return total["n"], total["words"]

    # ---- search

    def search(self, queries: DataFrame, k: int = 4, *, digits: int | None = None, text_col: str = "text", qid_col: str = "qid") -> DataFrame:
        """Best k documents that have all terms of a query, by BM25: ``qid, rank, id, score``."""
        return self._search(queries, k, digits, text_col, qid_col)[0]

    def scored_blocks(self, queries: DataFrame, k: int = 4, *, digits: int | None = None, text_col: str = "text", qid_col: str = "qid") -> DataFrame:
        """``qid, blocks, scored``: blocks with all terms of a query, and how many of them a search scores."""
        return self._search(queries, k, digits, text_col, qid_col)[1]

    def _search(self, queries: DataFrame, k: int, digits: int | None, text_col: str, qid_col: str) -> tuple[DataFrame, DataFrame]:
        rows = self._committed()
        n_docs, n_words = sum(r["n"] for r in rows), sum(r["words"] for r in rows)
        statistics = F.lit(float(n_docs)), F.lit(n_words / max(n_docs, 1))
        asked = cut_lineage(fulltext.query_terms(queries, self.config, text_col=text_col, qid_col=qid_col), "asked")
        blocks, gone = self._blocks(self._numbers(asked, "term"), rows), self._gone(rows)
        # Only postings of asked terms may be shuffled by the joins below.
        blocks = _split(blocks.join(asked.select("term").distinct(), "term", "left_semi"))
        bounds = cut_lineage(blocks.select("term", "block", "n", "max_tf", "min_length"), "bounds")
        weighed = cut_lineage(self._weighed(asked, bounds, blocks, gone), "weighed")
        candidates = cut_lineage(_candidates(weighed, bounds, *statistics), "candidates")
        best = Window.partitionBy("qid").orderBy(F.col("bound").desc(), "block")
        placed = candidates.withColumn("place", F.row_number().over(best))
        placed = cut_lineage(placed, "placed")

        def scores(chosen: DataFrame) -> DataFrame:
            # Written: Spark knows its size, and sends it to the postings if it is small.
            wanted = cut_lineage(chosen.select("qid", "block").join(weighed, "qid"), "wanted")
            found = wanted.join(blocks.select("term", "block", "ids", "tfs", "lengths"), ["term", "block"])
            each = _entries(found, "qid", "df", "n_terms")
            each = each if gone is None else each.join(gone.select("id", "block"), ["id", "block"], "left_anti")
            share = words.bm25(F.col("tf"), F.col("df"), F.col("length"), *statistics)
            whole = each.groupBy("qid", "id").agg(F.count(F.lit(1)).alias("_n"), F.first("n_terms").alias("n_terms"), F.sum(share).alias("score"))
            return whole.filter(F.col("_n") == F.col("n_terms")).select("qid", "id", "score")

        first = cut_lineage(scores(placed.filter(F.col("place") <= FIRST_BLOCKS)), "first")
        least = fulltext.top_texts(first, k, digits).filter(F.col("rank") == k).select("qid", F.col("score").alias("least"))
        # Sums are taken in another order than the scores.
        bound = F.col("bound") * (1 + 1e-9)
        bound = bound if digits is None else F.round(bound, digits)
        rest = placed.filter(F.col("place") > FIRST_BLOCKS).join(least, "qid", "left").filter(F.col("least").isNull() | (bound >= F.col("least")))
        rest = cut_lineage(rest.select("qid", "block"), "rest")
        top = fulltext.top_texts(first.unionByName(scores(rest)), k, digits)
        taken = F.col("place") <= FIRST_BLOCKS
        more = rest.groupBy("qid").agg(F.count(F.lit(1)).alias("more"))
        counts = placed.groupBy("qid").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(taken).alias("begun")).join(more, "qid", "left")
        return top, counts.select("qid", "blocks", (F.col("begun") + F.coalesce("more", F.lit(0))).alias("scored"))

    def _weighed(self, asked: DataFrame, bounds: DataFrame, blocks: DataFrame, gone: DataFrame | None) -> DataFrame:
        """``asked`` with the number of live documents of each term."""
        frequency = bounds.groupBy("term").agg(F.sum("n").alias("df"))
        if gone is not None:
            touched = blocks.join(gone.select("block").distinct(), "block", "left_semi")
            lost = _entries(touched.select("term", "block", "ids", "tfs", "lengths")).join(gone.select("id", "block"), ["id", "block"], "left_semi")
            lost = lost.groupBy("term").agg(F.count(F.lit(1)).alias("lost"))
            frequency = frequency.join(lost, "term", "left").select("term", (F.col("df") - F.coalesce("lost", F.lit(0))).alias("df"))
        return asked.join(frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))


def _kind() -> Column:
    """Class of a document's length."""
    return F.floor(F.log1p(F.col("length").cast("double")) * LENGTH_STEPS).cast("int")


def _split(found: DataFrame) -> DataFrame:
    """Posting rows of runs as a row per term and block."""
    each = found.select("term", F.explode(F.arrays_zip("blocks", "starts", "sizes", "max_tfs", "min_lengths")).alias("b"), "ids", "tfs", "lengths")
    bounds = [F.col(f"b.{stored}").alias(name) for stored, name in (("blocks", "block"), ("sizes", "n"), ("max_tfs", "max_tf"), ("min_lengths", "min_length"))]
    return each.select("term", *bounds, *(F.slice(name, F.col("b.starts") + 1, F.col("b.sizes")).alias(name) for name in ("ids", "tfs", "lengths")))


def _entries(blocks: DataFrame, *columns: str) -> DataFrame:
    """One row per document of each row of a term and block."""
    entry = F.explode(F.arrays_zip("ids", "tfs", "lengths")).alias("e")
    found = blocks.select("term", "block", *columns, entry)
    return found.select("term", "block", *columns, F.col("e.ids").alias("id"), F.col("e.tfs").alias("tf"), F.col("e.lengths").alias("length"))


def _candidates(weighed: DataFrame, bounds: DataFrame, n_docs: Column, mean_length: Column) -> DataFrame:
    """``qid, block, bound``: blocks with all terms of a query; it starts from the blocks of its rarest term."""
    rarest = weighed.groupBy("qid").agg(F.min(F.struct("df", "term")).alias("_r")).filter("_r.df > 0")
    possible = bounds.select("term", "block").join(rarest.select("qid", F.col("_r.term").alias("term")), "term").select("qid", "block")
    found = possible.join(weighed, "qid").join(bounds, ["term", "block"])
    share = words.bm25(F.col("max_tf"), F.col("df"), F.col("min_length"), n_docs, mean_length)
    whole = found.groupBy("qid", "block").agg(F.count(F.lit(1)).alias("_n"), F.first("n_terms").alias("n_terms"), F.sum(share).alias("bound"))
    return whole.filter(F.col("_n") == F.col("n_terms")).select("qid", "block", "bound")
