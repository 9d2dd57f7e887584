"""Queries over exported dumps, which are first written from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vinework.operators.pattern import match
from vinework.plans.inputs import commerce_graph, scratch_path
from vinework.plans.registry import query
from vinework.sources.dumps import SCHEMA, dump_graph, read_dump, stream_dump


def _dump(spark, sf_dir) -> str:
    """Customers, orders and who placed them, as lines of tagged JSON."""
    graph = commerce_graph(spark, sf_dir, ["Customer", "Order"], ["PLACED"])
    customer = F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    order = F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    path = scratch_path(spark, "dump")

    def write(rows, tag, label, properties, *keys):
        entity = F.struct(*keys, F.lit(label).alias("label"), properties.alias("properties"))
        rows.select(F.concat(F.to_json(entity), F.lit(f"::{tag}")).alias("value")).write.mode("append").text(path)

    write(graph.nodes("Customer"), "vertex", "Customer", customer, "id")
    write(graph.nodes("Order"), "vertex", "Order", order, "id")
    placed = graph.edges("PLACED").withColumn("id", F.col("end_id"))
    write(placed, "edge", "PLACED", F.struct(F.col("o_orderdate").cast("date").alias("day")), "id", "start_id", "end_id")
    return path


_SCAN_SQL = """
  SELECT 'vertex' AS kind, 'Order' AS label, count(*) AS n, min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders
  UNION ALL SELECT 'edge', 'PLACED', count(*), min(o_orderkey), max(o_orderkey) FROM orders"""


def _summary(rows):
    key = F.col("id").bitwiseAND(F.lit((1 << 48) - 1))
    return rows.groupBy("kind", "label").agg(F.count("properties").alias("n"), F.min(key).alias("least"), F.max(key).alias("most"))


@query("dump_scan", _SCAN_SQL)
def dump_scan(spark, sf_dir):
    """Labels are judged while the lines are read."""
    return _summary(read_dump(spark, _dump(spark, sf_dir), labels=["Order", "PLACED"]))


@query(
    "dump_pattern",
    """SELECT c_name AS name, any_value(c_acctbal) AS acctbal, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total,
              strftime(max(o_orderdate), '%Y-%m-%d') AS last_day
       FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY c_custkey, c_name""",
)
def dump_pattern(spark, sf_dir):
    """A pattern straight on a dump: typed properties, labels of ends by the numbers in their ids."""
    graph = dump_graph(
        spark, _dump(spark, sf_dir), {"Customer": "name string, acctbal double", "Order": "price double, status string"}, {"PLACED": "day string"}
    )
    found = match(graph, "c", "Customer").out("r", "PLACED", "o", "Order").where("o", status="F")
    rows = found.returns("c.name", "c.acctbal", key="c", price="o.price", day="r.day")
    grouped = rows.groupBy("key", "name").agg(
        F.any_value("acctbal").alias("acctbal"), F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("price"), 2).alias("total"), F.max("day").alias("last_day"),
    )
    return grouped.drop("key")


@query("dump_stream", _SCAN_SQL)
def dump_stream(spark, sf_dir):
    """The dump as a stream, appended to a table."""
    target, progress = scratch_path(spark, "dump-rows"), scratch_path(spark, "dump-progress")
    rows = stream_dump(spark, _dump(spark, sf_dir), labels=["Order", "PLACED"])
    rows.writeStream.option("checkpointLocation", progress).trigger(availableNow=True).start(target, format="parquet").awaitTermination()
    return _summary(spark.read.schema(SCHEMA).parquet(target))
