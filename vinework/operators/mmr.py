"""Diversity re-ranking of nearest-neighbour candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.functions import kernels
from vinework.functions.vectors import Metric
from vinework.operators.knn import knn
from vinework.runtime import cut_lineage


def mmr(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 4,
    fetch_k: int = 20,
    weight: float = 0.5,
    metric: Metric | str = Metric.COSINE,
    *,
    where: Column | None = None,
    carry: tuple[str, ...] = (),
    digits: int | None = None,
    id_col: str = "id",
    vec_col: str = "embedding",
    qid_col: str = "qid",
    query_vec: str = "embedding",
) -> DataFrame:
    """Pick k of the ``fetch_k`` nearest rows per query, in pick order.

    Candidates follow the metric, selection always uses cosine similarity.
    Ids compete for the ``fetch_k`` places; only the rows that get one are read
    again for their vectors and carried columns. A query's list never holds
    more than ``fetch_k`` rows. Ids are unique in the corpus.
    """
    near = knn(
        corpus, queries, fetch_k, metric, where=where,
        digits=digits, id_col=id_col, vec_col=vec_col, qid_col=qid_col, query_vec=query_vec,
    )
    # Written, so that the search runs once and Spark knows how few rows ask.
    near = cut_lineage(near, "near").join(corpus.select(*dict.fromkeys([id_col, *carry, vec_col])), id_col)
    kept = [c for c in carry if c != vec_col]
    entry = F.struct("rank", F.col(id_col), "distance", *kept, F.col(vec_col).cast("array<double>").alias("_vec"))
    lists = near.groupBy(qid_col).agg(F.array_sort(F.collect_list(entry), lambda a, b: a["rank"] - b["rank"]).alias("_near"))
    asked = queries.select(F.col(qid_col), F.col(query_vec).cast("array<double>").alias("_qvec"))
    types = {f.name: f.dataType for f in near.schema.fields}
    columns = [id_col, "distance", *kept]
    schema = T.StructType(
        [T.StructField(qid_col, types[qid_col]), T.StructField("pick", T.IntegerType())]
        + [T.StructField(c, types[c]) for c in columns]
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch.column("_near").flatten()
            sizes = pc.list_value_length(batch.column("_near")).to_numpy(zero_copy_only=False)
            dim = len(batch.column("_qvec")[0]) if batch.num_rows else 0
            asked_for, _ = kernels.matrix(batch.column("_qvec"), dim)
            known, present = kernels.matrix(pc.struct_field(entries, "_vec"), dim)
            vectors = np.zeros((len(entries), dim))
            vectors[present] = known
            rows, owners, picks = [], [], []
            start = 0
            for q, size in enumerate(sizes):
                chosen = kernels.diverse_picks(asked_for[q], vectors[start : start + size], k, weight)
                rows += [start + c for c in chosen]
                owners += [q] * len(chosen)
                picks += range(1, len(chosen) + 1)
                start += size
            taken = entries.take(pa.array(rows, pa.int64()))
            arrays = [batch.column(qid_col).take(pa.array(owners, pa.int64())), pa.array(picks, pa.int32())]
            arrays += [pc.struct_field(taken, c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, [qid_col, "pick", *columns])

    return lists.join(asked, qid_col).mapInArrow(choose, schema)
