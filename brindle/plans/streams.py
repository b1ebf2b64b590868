"""Stream queries: the event table arrives as a stream and is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle import sinks
from brindle.operators import pipeline
from brindle.plans.keyspace import SCORE_SQL
from brindle.plans.pipelines import SESSION_SQL, TREND_SQL
from brindle.registry import query
from brindle.session import fresh_path
from brindle.sources.tables import Tables
from brindle.streaming import channel_source, channels, counters, sessions, stock
from brindle.streaming.runner import drain, drained, file_stream, to_batches

SINCE = "2024-01-10 00:00:00"
MESSAGE_SQL = """(SELECT event_id AS seq, event_type || CASE WHEN user_id < 100 THEN ':' || user_id ELSE '' END AS channel,
  CASE WHEN value > 250 THEN 'KILL' ELSE 'song ' || event_type || ':singer ' || user_id END AS data, ts FROM events)"""


MOST_FILES = 64  # of a part; more tasks than that do not write at once


def table_stream(t: Tables, name: str, order: str = "event_id", parts: int = 3, beyond: int | None = None, late: int = 0) -> DataFrame:
    """One table of the folder as a stream: parts that follow each other by `order`, one per micro-batch.

    With `beyond`, a heartbeat that many seconds after the newest time ends the stream. With `late`, one row in five
    comes that many seconds later than its place in the order. Each part has as many files as tasks read the table, some without rows if the part is small, so that every
    micro-batch takes one whole part.
    """
    rows, inbox = getattr(t, name), fresh_path(t.spark, "arriving")
    at = F.col(order).cast("timestamp").cast("double") if order in ("ts", "l_shipdate") else F.col(order).cast("double")
    low, high = rows.agg(F.min(at), F.max(at)).first()
    if late:
        at = at + F.when(F.pmod(F.xxhash64(*rows.columns), F.lit(5)) == 0, F.lit(late)).otherwise(F.lit(0))
    part = F.least(F.floor((at - F.lit(low)) * parts / F.lit(max(high - low, 1.0))), F.lit(parts - 1))
    files = min(MOST_FILES, max(1, rows.rdd.getNumPartitions()))
    for k in range(parts):  # one write after the other, as files are read in the order they came
        rows.where(F.coalesce(part, F.lit(0)) == k).repartition(files).write.mode("append").parquet(inbox)
        there = len(t.spark.read.schema(rows.schema).parquet(inbox).inputFiles())
        for _ in range(there, files * (k + 1)):
            rows.limit(0).coalesce(1).write.mode("append").parquet(inbox)
    if beyond is not None:
        latest = F.lit(high + beyond).cast("timestamp")
        sessions.heartbeat(t.spark, rows, order, latest).write.mode("append").parquet(inbox)
    return file_stream(t.spark, inbox, rows.schema, maxFilesPerTrigger=str(files))


def messages(t: Tables) -> DataFrame:
    """Events as messages: a channel per type, with a sub-channel for regular users."""
    user = F.col("user_id").cast("string")
    channel = F.when(F.col("user_id") < 100, F.concat_ws(":", "event_type", user)).otherwise(F.col("event_type"))
    song = F.concat(F.lit("song "), F.col("event_type"), F.lit(":singer "), user)
    return table_stream(t, "events").select(
        F.col("event_id").alias("seq"), channel.alias("channel"),
        F.when(F.col("value") > 250, channels.STOP).otherwise(song).alias("data"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


@query("stream_channel_filter", f"""
SELECT seq, channel, channel || ' : ' || data AS line FROM {MESSAGE_SQL} WHERE (channel = 'click' OR channel LIKE 'view:%') AND ts >= TIMESTAMP '{SINCE}'""")
def stream_channel_filter(t: Tables) -> DataFrame:
    """One channel and one family of channels, heard from a moment on."""
    heard = channels.subscribe(messages(t), ["click"], ["view:*"], since=SINCE)
    lines = heard.select("seq", "channel", F.concat_ws(" : ", "channel", "data").alias("line"))
    return drained(lines).drop("batch")


@query("stream_subscription", f"""
SELECT seq, channel, data FROM {MESSAGE_SQL} WHERE channel = 'click' AND ts >= TIMESTAMP '{SINCE}'""")
def stream_subscription(t: Tables) -> DataFrame:
    """A subscription to a channel source that begins when some messages are already gone."""
    folder, home = fresh_path(t.spark, "channel"), fresh_path(t.spark, "subscriber")
    sent = t.events.select(F.col("event_id").alias("seq"), F.col("event_type").alias("kind"), "user_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    user = F.col("user_id").cast("string")
    sent = sent.select(
        "seq", F.when(F.col("user_id") < 100, F.concat_ws(":", "kind", user)).otherwise(F.col("kind")).alias("channel"),
        F.when(F.col("value") > 250, channels.STOP).otherwise(F.concat(F.lit("song "), F.col("kind"), F.lit(":singer "), user)).alias("data"), "ts")
    began = F.lit(SINCE).cast("timestamp")

    def heard() -> DataFrame:
        stream = channel_source.listen(t.spark, folder, sent.schema, start="latest")
        return drained(channels.subscribe(stream, ["click"]).select("seq", "channel", "data"), home=home).drop("batch")

    channel_source.publish(sent.where(F.col("ts") < began), folder)
    heard()  # from now on
    channel_source.publish(sent.where(F.col("ts") >= began), folder)
    return heard()


@query("stream_message_split", f"""
SELECT seq, split_part(data, ':', 1) AS song, split_part(data, ':', 2) AS singer FROM {MESSAGE_SQL} WHERE channel LIKE 'purchase%' AND data <> 'KILL'""")
def stream_message_split(t: Tables) -> DataFrame:
    heard = channels.subscribe(messages(t), patterns=["purchase*"]).where(F.col("data") != channels.STOP)
    return drained(channels.split_fields(heard, "song", "singer").select("seq", "song", "singer")).drop("batch")


@query("stream_poison_pill", f"""
SELECT seq, channel, data FROM {MESSAGE_SQL} WHERE channel LIKE 'signup%' AND seq < (SELECT min(seq) FROM {MESSAGE_SQL} WHERE channel LIKE 'signup%' AND data = 'KILL')""")
def stream_poison_pill(t: Tables) -> DataFrame:
    """Messages handled before the one that stops the consumer."""
    heard = channels.subscribe(messages(t), patterns=["signup*"])
    return channels.consume(heard, lambda batch: batch.select("seq", "channel", "data")).drop("batch")


@query("stream_handler_batches", f"SELECT channel, count(*) AS handled FROM {MESSAGE_SQL} GROUP BY 1")
def stream_handler_batches(t: Tables) -> DataFrame:
    """A handler of one's own per micro-batch: here it counts what it was given."""
    path = fresh_path(t.spark, "handled")
    store = to_batches(path)

    def work(batch: DataFrame, number: int) -> None:
        store(batch.groupBy("channel").agg(F.count("*").alias("handled")), number)

    drain(messages(t), work)
    return t.spark.read.parquet(path).groupBy("channel").agg(F.sum("handled").alias("handled"))


@query("stream_leaderboard", f"""
SELECT key, row_number() OVER (PARTITION BY key ORDER BY score DESC, member DESC) AS rank, member, CAST(score AS DOUBLE) AS score
FROM {SCORE_SQL} QUALIFY rank <= 3""")
def stream_leaderboard(t: Tables) -> DataFrame:
    user = F.concat(F.lit("user:"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    changes = table_stream(t, "events").select(
        F.col("event_type").alias("key"), user.alias("member"), F.col("value").cast("decimal(18,2)").alias("delta"))
    return counters.live_leaderboard(changes, 3).select("key", "rank", "member", "score")


@query("stream_counters", """
SELECT 'user:' || user_id AS key, event_type AS field, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, count(*) AS writes FROM events GROUP BY 1, 2""")
def stream_counters(t: Tables) -> DataFrame:
    changes = table_stream(t, "events").select(
        F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("key"), F.col("event_type").alias("field"),
        F.col("value").cast("decimal(18,2)").alias("delta"))
    return counters.counters(changes)


@query("stream_dedup_horizon", """
SELECT event_id, user_id, event_type, epoch_us(ts) AS ts FROM events
WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id) QUALIFY lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 1 HOUR""")
def stream_dedup_horizon(t: Tables) -> DataFrame:
    """Events of a kind that the user had not caused in the hour before; some come half an hour late."""
    events = table_stream(t, "events", "ts", beyond=3 * 3600, late=1800).select("event_id", "user_id", "event_type", "ts")
    return sessions.fresh_within(events, ["user_id", "event_type"], "ts", "event_id", 3600, delay=3600)


@query("stream_presence", f"SELECT user_id, started, ended, events FROM ({SESSION_SQL})")
def stream_presence(t: Tables) -> DataFrame:
    """When was a user online, worked out as events come in, some of them half an hour late? Breaks above eight hours end a session."""
    events = table_stream(t, "events", "ts", beyond=10 * 3600, late=1800)
    return sessions.presence(events, "user_id", "ts", 8 * 3600, delay=3600)


@query("stream_stock_guard", """
SELECT l_partkey AS item, l_orderkey AS orderid, l_linenumber AS line,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) <= p_size AS accepted
FROM lineitem JOIN part ON p_partkey = l_partkey""", bigint=["line"])
def stream_stock_guard(t: Tables) -> DataFrame:
    """Requests for items as a stream, accepted while stock lasts."""
    on_hand = t.part.select(F.col("p_partkey").alias("item"), F.col("p_size").alias("quantity"))
    requests = table_stream(t, "lineitem", "l_shipdate").select(
        F.col("l_partkey").alias("item"), F.col("l_shipdate").alias("at"), F.col("l_orderkey").alias("orderid"),
        F.col("l_linenumber").alias("line"), "l_suppkey", "l_extendedprice")
    order = [F.col(c) for c in ("at", "orderid", "line", "l_suppkey", "l_extendedprice")]
    return stock.sell(requests, on_hand, "item", order, "quantity").select("item", "orderid", "line", "accepted")


@query("stream_file_arrival_trend", TREND_SQL)
def stream_file_arrival_trend(t: Tables) -> DataFrame:
    """CSV files arrive, each adds to the average of its days; then the trend of the days."""
    inbox, path = fresh_path(t.spark, "inbox"), fresh_path(t.spark, "runs")
    arriving = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("run"), "value")
    sinks.write_csv(arriving.repartition(4, "run"), inbox)
    stream = file_stream(t.spark, inbox, "event_id bigint, run date, value double", "csv", header="true", maxFilesPerTrigger="1")
    store = to_batches(path)

    def load(batch: DataFrame, number: int) -> None:
        amount = F.col("value").cast("decimal(18,2)")
        store(batch.groupBy("run").agg(F.sum(amount).alias("total"), F.count("*").alias("n")), number)

    drain(stream, load)
    runs = t.spark.read.parquet(path).groupBy("run").agg(
        (F.sum("total").cast("double") / F.sum("n")).alias("average"))
    return pipeline.trend(runs, "run", "average")
