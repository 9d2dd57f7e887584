"""Exact and cell-restricted nearest neighbours for batches of queries.

Distances are one matrix product per Arrow batch with a running top-k per
task, so at most k rows per query leave a task and no pair of query and row is
ever a DataFrame row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.functions import kernels
from vinework.functions.vectors import Metric

# Queries that are shipped to the tasks at a time.
SHIPPED_QUERIES = 8_192
SHIPPED_BYTES = 64 << 20
# Vectors of one block of rows, and of queries, when both are distributed.
ROW_BLOCK_BYTES = 16 << 20
QUERY_BLOCK_BYTES = 8 << 20


def knn(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 4,
    metric: Metric | str = Metric.COSINE,
    *,
    where: Column | None = None,
    carry: Sequence[str] = (),
    digits: int | None = None,
    id_col: str = "id",
    vec_col: str = "embedding",
    qid_col: str = "qid",
    query_vec: str = "embedding",
    plan: str = "auto",
    shipped_queries: int = SHIPPED_QUERIES,
) -> DataFrame:
    """k nearest corpus rows of every query: ``qid, rank, id, distance, *carry``.

    ``where`` restricts the corpus before ranking. Rows rank by distance, then
    id; undefined distances come after all numbers and rows without a vector
    last. ``digits`` rounds distances before ranking. ``carry`` names corpus
    columns to hand through, such as the vector or the content.

    With ``plan="ship"`` queries travel to the rows, ``shipped_queries`` and
    64 MB at a time, and the corpus is read once for each such batch. With
    ``plan="blocks"`` both sides are cut to blocks that meet in a grid. Both
    are exact. ``auto`` ships queries that fit one batch, so no more than that
    ever reaches the driver, and uses blocks for all larger sets.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if plan not in ("auto", "ship", "blocks"):
        raise ValueError("plan must be 'auto', 'ship' or 'blocks'")
    metric = Metric(metric).value
    rows = corpus if where is None else corpus.filter(where)
    rows = rows.select(*dict.fromkeys([id_col, vec_col, *carry]))
    asked = queries.filter(F.col(query_vec).isNotNull()).select(
        F.col(qid_col).alias("_qid"), F.col(query_vec).cast("array<double>").alias("_qvec")
    )
    columns = list(dict.fromkeys([id_col, *carry]))
    n, dim = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("_qvec")), F.lit(0))).first()
    batches = max(1, -(-n // shipped_queries), -(-n * 8 * dim // SHIPPED_BYTES))
    if plan == "ship" or (plan == "auto" and batches == 1):
        dealt = asked.withColumn("_batch", F.pmod(F.xxhash64("_qid"), F.lit(batches)))
        parts = [dealt.filter(F.col("_batch") == i).drop("_batch").toArrow() for i in range(batches)]
        near = reduce(
            DataFrame.unionByName,
            [_with_shipped_queries(rows, batch, asked, k, metric, digits, columns, id_col, vec_col) for batch in parts],
        )
    else:
        near = blockwise(
            rows.withColumn("_cell", F.lit(0)), asked.withColumn("_cell", F.lit(0)),
            k, metric, digits=digits, columns=columns, id_col=id_col, vec_col=vec_col, dim=max(1, dim),
        )
    return ranked(near, k, id_col).withColumnRenamed("_qid", qid_col)


def ranked(near: DataFrame, k: int, id_col: str = "id") -> DataFrame:
    """Merge per-task results; Spark limits each group before the shuffle."""
    order = Window.partitionBy("_qid").orderBy(F.col("distance").asc_nulls_last(), F.col(id_col))
    rest = [c for c in near.columns if c not in ("_qid", id_col, "distance")]
    top = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select("_qid", "rank", id_col, "distance", *rest)


def _result_schema(rows: DataFrame, asked: DataFrame, columns: Sequence[str]) -> T.StructType:
    fields = [T.StructField("_qid", asked.schema["_qid"].dataType)]
    fields += [T.StructField(c, rows.schema[c].dataType) for c in columns]
    return T.StructType([*fields, T.StructField("distance", T.DoubleType())])


def _with_shipped_queries(rows, batch, asked, k, metric, digits, columns, id_col, vec_col):
    schema = _result_schema(rows, asked, columns)
    qids = batch.column("_qid").combine_chunks()
    dim = len(batch.column("_qvec")[0]) if batch.num_rows else 0
    vectors, _ = kernels.matrix(batch.column("_qvec"), dim)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = kernels.NearestRows(qids, vectors, metric, k, digits, columns)
        for part in batches:
            state.add(part, id_col, vec_col)
        out = state.result("_qid")
        if out is not None:
            yield from out.to_batches()

    return rows.mapInArrow(nearest, schema)


def blockwise(
    rows: DataFrame,
    asked: DataFrame,
    k: int,
    metric: str,
    *,
    digits: int | None,
    columns: Sequence[str],
    id_col: str,
    vec_col: str,
    dim: int,
    block_rows: int | None = None,
    block_queries: int | None = None,
) -> DataFrame:
    """Top-k per query among rows of the same ``_cell``, both sides distributed.

    Each cell is cut into a grid of row blocks and query blocks by hash, with
    as many blocks as its size asks for, so one crowded cell is spread over
    many tasks and every task holds two bounded blocks.
    """
    block_rows = block_rows or max(1, ROW_BLOCK_BYTES // (8 * dim))
    block_queries = block_queries or max(1, QUERY_BLOCK_BYTES // (8 * dim))
    grid = (
        rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
        .join(asked.groupBy("_cell").agg(F.count(F.lit(1)).alias("_m")), "_cell")
        .select(
            "_cell",
            F.ceil(F.col("_n") / block_rows).alias("_row_blocks"),
            F.ceil(F.col("_m") / block_queries).alias("_query_blocks"),
        )
    )
    spread_rows = (
        rows.join(grid, "_cell")
        .withColumn("_rb", F.pmod(F.xxhash64(F.col(id_col)), F.col("_row_blocks")))
        .withColumn("_qb", F.explode(_numbers("_query_blocks")))
        .drop("_row_blocks", "_query_blocks")
    )
    spread_queries = (
        asked.join(grid, "_cell")
        .withColumn("_qb", F.pmod(F.xxhash64(F.col("_qid")), F.col("_query_blocks")))
        .withColumn("_rb", F.explode(_numbers("_row_blocks")))
        .drop("_row_blocks", "_query_blocks")
    )
    block = ["_cell", "_rb", "_qb"]
    columns = list(columns)
    schema = _result_schema(rows, asked, columns)
    names = [f.name for f in schema.fields]

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            vectors, _ = kernels.matrix(right.column("_qvec"), len(right.column("_qvec")[0]))
            state = kernels.NearestRows(right.column("_qid").combine_chunks(), vectors, metric, k, digits, columns)
            state.add(left, id_col, vec_col)
            return state.result("_qid")
        kept = left.select(columns).slice(0, 0)
        kept = kept.add_column(0, "_qid", right.column("_qid").slice(0, 0))
        return kept.append_column("distance", pa.array([], pa.float64())).select(names)

    return spread_rows.groupBy(*block).cogroup(spread_queries.groupBy(*block)).applyInArrow(nearest, schema)


def _numbers(count: str) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1)
