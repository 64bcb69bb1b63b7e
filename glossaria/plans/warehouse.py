"""Queries over the star schema and the event table: the engine's plain relational surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.operators.ranking import top_k
from glossaria.tables import table


def pricing_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'")
    price, left = F.col("l_extendedprice"), 1 - F.col("l_discount")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum(price), 2).alias("sum_base_price"),
        F.round(F.sum(price * left), 2).alias("sum_disc_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count(F.lit(1)).alias("n"),
    )


def top_orders(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    revenue = items.groupBy("l_orderkey").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    return orders.join(revenue, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderpriority", "revenue").orderBy(F.col("revenue").desc(), "o_orderkey").limit(20)


def nation_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue per nation. The sides are joined by key; Spark broadcasts those whose statistics are below its threshold."""
    items = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation", "n_nationkey", "n_name")
    per_order = items.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    per_customer = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.sum("r").alias("r"))
    named = per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("r").alias("r"))
    return named.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", F.round("r", 2).alias("revenue"))


def max_by_group(spark: SparkSession, sf: str) -> DataFrame:
    volume = table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_quantity").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    return volume.groupBy("l_partkey").agg(F.max("qty").alias("qty"), F.max_by("l_suppkey", F.struct("qty", "l_suppkey")).alias("supplier"))


def top3_parts(spark: SparkSession, sf: str) -> DataFrame:
    volume = table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_quantity").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return top_k(volume, ["l_suppkey"], [F.col("qty").desc(), F.col("l_partkey")], 3).withColumn("rank", F.col("rank").cast("bigint"))


def share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "events", "user_id", "event_type").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("user_id")), 6))


def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "events", "event_type", "props").select("event_type", F.explode(F.json_object_keys("props")).alias("field"))
    return keys.groupBy("event_type", "field").agg(F.count(F.lit(1)).alias("n"))


def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling hours; the batch twin of the streaming query."""
    e = table(spark, sf, "events", "ts", "event_type", "value")
    return e.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))


def event_sessions(spark: SparkSession, sf: str, gap_minutes: int = 30) -> DataFrame:
    """Sessions of a user: events no more than the gap apart."""
    e = table(spark, sf, "events", "user_id", "ts")
    sessions = e.groupBy("user_id", F.session_window("ts", f"{gap_minutes} minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return sessions.select("user_id", F.col("w.start").alias("start"), "n")


def cube_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Token, lemma and tag counters of the reference kind as grouping sets of one scan."""
    o = table(spark, sf, "orders", "o_orderstatus", "o_orderpriority", "o_totalprice")
    c = o.cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return c.select(F.coalesce("o_orderstatus", F.lit("*")).alias("status"), F.coalesce("o_orderpriority", F.lit("*")).alias("priority"), "n", "total")


QUERIES = {
    "pricing_summary": pricing_summary,
    "top_orders": top_orders,
    "nation_revenue": nation_revenue,
    "max_by_group": max_by_group,
    "top3_parts": top3_parts,
    "share_of_total": share_of_total,
    "json_fields": json_fields,
    "event_windows": event_windows,
    "event_sessions": event_sessions,
    "cube_counts": cube_counts,
}
ORACLE = {
    "pricing_summary": """
        SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
               round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""",
    "top_orders": """
        SELECT o_orderkey, o_orderpriority, revenue FROM orders JOIN (SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY l_orderkey) r ON o_orderkey = l_orderkey
        ORDER BY revenue DESC, o_orderkey LIMIT 20""",
    "nation_revenue": """
        SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "max_by_group": "SELECT l_partkey, max(qty) AS qty, arg_max(l_suppkey, (qty, l_suppkey)) AS supplier FROM (SELECT l_partkey, l_suppkey, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL) v GROUP BY l_partkey",
    "top3_parts": "SELECT l_suppkey, l_partkey, qty, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY qty DESC, l_partkey) AS rank FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL) v) x WHERE rank <= 3",
    "share_of_total": "SELECT user_id, event_type, n, round(n / sum(n) OVER (PARTITION BY user_id), 6) AS share FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) c",
    "json_fields": "SELECT event_type, field, count(*) AS n FROM (SELECT event_type, unnest(json_keys(props)) AS field FROM events) k GROUP BY ALL",
    "event_windows": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL",
    "event_sessions": """
        SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
            SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events) e) g GROUP BY user_id, s""",
    "cube_counts": """
        SELECT coalesce(o_orderstatus, '*') AS status, coalesce(o_orderpriority, '*') AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
}
