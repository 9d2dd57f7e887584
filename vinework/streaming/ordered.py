"""Keyed streams in which a late row never replaces a newer one."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Ship these helpers with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Newest(StatefulProcessor):
    """Keeps the order of the newest row of every key, in the state store."""

    def __init__(self, order: str, kind: T.DataType) -> None:
        self.order, self.kind = order, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", T.StructType([T.StructField("order", self.kind)]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = None
        for row in rows:
            if row[self.order] is None:
                continue
            # Equal orders in one batch: the result must not depend on their arrival.
            if best is None or (row[self.order], str(row)) > (best[self.order], str(best)):
                best = row
        if best is None:
            return
        known = self.latest.get() if self.latest.exists() else None
        if known is None or best[self.order] > known[0]:
            self.latest.update((best[self.order],))
            yield best

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """The rows of a stream that are newer than every earlier row with their key, one per key and batch.

    ``order`` is a column whose values grow with time; rows without it, or
    without a key, are left out. What is kept per key is one value, in RocksDB
    on the executors and in the query's checkpoint, so it survives them.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    known = stream.filter(stream[key].isNotNull() & stream[order].isNotNull())
    newest = _Newest(order, stream.schema[order].dataType)
    return known.groupBy(key).transformWithState(newest, outputStructType=stream.schema, outputMode="Update", timeMode="None")
