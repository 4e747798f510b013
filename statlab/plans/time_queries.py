"""Joins along time, ordered windows and streams on the tables, one query each; ``time_sql`` holds the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlab.operators import intervals, ordered, theta
from statlab.operators.asof import asof_join
from statlab.operators.ranges import ordered as in_ranges
from statlab.operators.ranges import ticks
from statlab.plans.table_queries import table
from statlab.streaming import state, windows

HOUR = 3_600_000_000
MONTH_START = 1_704_067_200_000_000
DAY = 24 * HOUR


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their time in microseconds."""
    events = table(spark, sf, "events")
    return events.select("event_id", "user_id", "event_type", "value", ticks(events, "ts").alias("moment"))


def _placed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders at seconds of the events' month, a third of them by one user."""
    second = F.pmod(F.col("o_orderkey") * 7919, F.lit(2_592_000))
    user = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey") % 160)
    return table(spark, sf, "orders").select("o_orderkey", user.cast("long").alias("buyer"), (second * 1_000_000 + MONTH_START).alias("placed"))


# --- joins along time


def asof_orders_events(spark: SparkSession, sf: str) -> DataFrame:
    """Each order with the last event of its buyer, none for most of the buyers without events."""
    return asof_join(_placed_orders(spark, sf), _events(spark, sf), "placed", "moment", [("buyer", "user_id")], tie=["event_id"], prefix="e_")


def asof_next_error(spark: SparkSession, sf: str) -> DataFrame:
    """Each purchase with the user's next error, within a day."""
    events = _events(spark, sf)
    bought, failed = (events.where(F.col("event_type") == t).drop("event_type") for t in ("purchase", "error"))
    return asof_join(bought, failed, "moment", "moment", ["user_id"], direction="forward", allow_equal=False, tolerance=DAY, how="inner", tie=["event_id"], prefix="e_")


def asof_any_user(spark: SparkSession, sf: str) -> DataFrame:
    """Each order with the last event of all before it: no key at all."""
    return asof_join(_placed_orders(spark, sf), _events(spark, sf).select("event_id", "moment"), "placed", "moment", allow_equal=False, prefix="e_")


def overlapping_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of a customer's orders that are open at the same time, one order in 500 for ten years."""
    orders = table(spark, sf, "orders")
    days = F.when(F.col("o_orderkey") % 500 == 0, 3650).otherwise(F.col("o_orderkey") % 30)
    day = F.unix_date(F.to_date("o_orderdate"))
    spans = orders.select("o_orderkey", "o_custkey", day.alias("opened"), (day + days).cast("int").alias("closed"))
    pairs = intervals.overlap_join(spans, spans, ("opened", "closed"), ("opened", "closed"), [("o_custkey", "o_custkey")], prefix="other_")
    return pairs.where("o_orderkey < other_o_orderkey").select("o_custkey", "o_orderkey", "other_o_orderkey")


def events_in_spans(spark: SparkSession, sf: str) -> DataFrame:
    """What falls within each part's hours, p_size of them, after a start that its key gives; one part in 100 takes all."""
    part = table(spark, sf, "part")
    start = F.when(F.col("p_partkey") % 100 == 0, F.lit(MONTH_START)).otherwise(F.pmod(F.col("p_partkey") * 37, F.lit(720)) * HOUR + MONTH_START)
    hours = F.when(F.col("p_partkey") % 100 == 0, F.lit(10_000)).otherwise(F.col("p_size"))
    spans = part.select("p_partkey", start.alias("since"), (start + hours * HOUR).alias("until"))
    met = intervals.range_join(_events(spark, sf), spans, "moment", "since", "until", sums={"n": ("count", "*"), "value": ("sum", "value")})
    return met.groupBy(F.col("span_p_partkey").alias("p_partkey")).agg(F.sum("n").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def cheaper_and_larger(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with a later key and a lower balance, pair by pair."""
    known = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    pairs = theta.theta_join(known, known, ("s_suppkey", "<", "s_suppkey"), ("s_acctbal", ">", "s_acctbal"), prefix="other_", rows_per_block=8)
    return pairs.select("s_suppkey", "s_acctbal", "other_s_suppkey", "other_s_acctbal")


def dominated_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Per large part the number of parts that cost less and are no smaller."""
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    pairs = theta.theta_join(part.where("p_size >= 48"), part, ("p_retailprice", ">", "p_retailprice"), ("p_size", "<=", "p_size"), rows_per_block=50)
    return pairs.groupBy("p_partkey").agg(F.count("*").alias("n"), F.min("right_p_retailprice").alias("cheapest"))


# --- windows over the whole table


def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    order = in_ranges(_events(spark, sf), ["moment", "event_id"], rows_per_range=20_000)
    found = ordered.running(order, {"total": ("sum", "value"), "n": ("count", "value"), "least": ("min", "value"), "most": ("max", "value")})
    return found.select("event_id", F.round("total", 4).alias("total"), "n", "least", "most")


def moving_windows(spark: SparkSession, sf: str) -> DataFrame:
    order = in_ranges(_events(spark, sf), ["moment", "event_id"], rows_per_range=20_000)
    found = ordered.neighbours(order, {"before": ("event_type", 1), "far_before": ("event_id", 1500), "next_at": ("moment", -1)})
    around = {"mean7": F.avg("value"), "most7": F.max("value")}
    found = ordered.framed(type(order)(found, order.starts), around, 3, 3)
    return found.select("event_id", "before", "far_before", "next_at", F.round("mean7", 6).alias("mean7"), "most7")


def global_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Lines by quantity, a third of which is set to one value."""
    quantity = F.when(F.col("l_orderkey") % 3 == 0, F.lit(25.0)).otherwise(F.col("l_quantity"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", quantity.alias("quantity"))
    found = ordered.ranks(in_ranges(lines, ["quantity"], rows_per_range=50_000), ["quantity"], 10)
    return found.groupBy("quantity", "rank", "dense_rank", F.round("percent_rank", 9).alias("percent_rank"), F.round("cume_dist", 9).alias("cume_dist")) \
        .agg(F.count("*").alias("n"), F.min("row_number").alias("from_row"), F.max("row_number").alias("to_row"), F.min("ntile").alias("from_tile"), F.max("ntile").alias("to_tile"))


# --- streams


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events' files as a stream; a stream's path is a folder or, as here, a pattern, never a single file."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return windows.read_stream(spark, f"{sf}/event[s].parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _micros(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.unix_micros(c) for c in ("start", "end")})


def _counts() -> list:
    return [F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")]


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    result = windows.windowed(_event_stream(spark, sf), "ts", "2 hours", _counts(), ["event_type"], width="6 hours")
    return _micros(windows.finished(result, "tumbling"))


def stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    result = windows.windowed(_event_stream(spark, sf), "ts", "2 hours", _counts(), width="3 hours", slide="1 hour")
    return _micros(windows.finished(result, "sliding"))


def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    result = windows.windowed(_event_stream(spark, sf), "ts", "2 hours", _counts(), ["user_id"], gap="4 hours")
    return _micros(windows.finished(result, "sessions"))


def stream_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Events at least twelve hours after the one of their user that was kept before."""
    return windows.finished(state.drop_repeats(_event_stream(spark, sf), "user_id", "ts", "event_id", 12 * 3600, "2 hours"), "repeats")


def stream_visits(spark: SparkSession, sf: str) -> DataFrame:
    result = state.visits(_event_stream(spark, sf), "user_id", "ts", "event_id", "event_type", "value", 8 * 3600, "2 hours")
    return windows.finished(result, "visits").withColumn("total", F.round("total", 4))


QUERIES = {
    f.__name__: f
    for f in [
        asof_orders_events, asof_next_error, asof_any_user, overlapping_orders, events_in_spans, cheaper_and_larger, dominated_parts,
        running_totals, moving_windows, global_ranks, stream_tumbling, stream_sliding, stream_sessions, stream_repeats, stream_visits,
    ]
}
