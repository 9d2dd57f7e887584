"""Physical layouts that make look-ups and traversals cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cluster_by_property(nodes: DataFrame, prop: str, path: str, *, index: str = "range", files: int | None = None) -> None:
    """Rewrite a label's table for look-ups on one property.

    ``range`` sorts the table by the property, so that file and row-group
    statistics skip almost everything for equality and ranges. ``bloom`` keeps
    the order and adds a Bloom filter on the property, for equality only.
    Range boundaries also split a value that fills many rows, because rows are
    ranged by the property and then by id.
    """
    if index == "range":
        order = [F.col(prop), F.col("id")]
        ranged = nodes.repartitionByRange(files, *order) if files else nodes.repartitionByRange(*order)
        ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    elif index == "bloom":
        writer = nodes.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{prop}", "true")
        writer.parquet(path)
    else:
        raise ValueError("index must be 'range' or 'bloom'")


def cluster_by_properties(nodes: DataFrame, props: Sequence[str], path: str, *, files: int | None = None, bits: int = 8) -> None:
    """Rewrite a label's table for look-ups on several properties together, in Z-order.

    Every property gets a rank of ``bits`` bits by its quantiles, and rows are
    ranged by the interleaved bits of all ranks. A file then spans a small range
    of each property, where an order by one property alone would leave the
    others unsorted. Strings rank by their first bytes. Nulls come first; rows
    with equal ranks are ranged by id, so a frequent value spans many files.
    """
    if not 1 <= len(props) * bits <= 62:
        raise ValueError("the interleaved ranks must fit 62 bits")
    numbers = [_as_number(nodes, prop).alias(f"_n{i}") for i, prop in enumerate(props)]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    names = [f"_n{i}" for i in range(len(props))]
    borders = nodes.select(*numbers).approxQuantile(names, shares, 0.25 / (1 << bits))
    place = F.lit(0).cast("bigint")
    for i, (prop, cuts) in enumerate(zip(props, borders, strict=True)):
        rank = _rank(_as_number(nodes, prop), sorted(set(cuts)))
        for bit in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(props) + i))
    placed = nodes.withColumn("_z", place)
    order = [F.col("_z"), F.col("id")]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).drop("_z").write.mode("overwrite").parquet(path)


def _as_number(nodes: DataFrame, prop: str) -> Column:
    kind, value = nodes.schema[prop].dataType, F.col(prop)
    if isinstance(kind, T.StringType):
        first = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def _rank(number: Column, cuts: list[float]) -> Column:
    """How many of the ascending borders a number reaches, 0 for null; the borders are few, so the search is unrolled."""
    if not cuts:
        return F.lit(0).cast("bigint")
    half = len(cuts) // 2
    below = _rank(number, cuts[:half]) if half else F.lit(0).cast("bigint")
    above = _rank(number, cuts[half + 1 :]) + (half + 1) if cuts[half + 1 :] else F.lit(half + 1).cast("bigint")
    return F.when(number >= cuts[half], above).otherwise(below)


def bucket_edges(edges: DataFrame, table: str, buckets: int, by: str = "start_id") -> DataFrame:
    """Save edges bucketed and sorted by one end; returns the saved table.

    Every hop that joins on that end then reads the edges in place: only the
    frontier is shuffled, at any depth.
    """
    edges.write.mode("overwrite").bucketBy(buckets, by).sortBy(by).format("parquet").saveAsTable(table)
    return edges.sparkSession.table(table)
