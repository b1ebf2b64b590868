from datetime import datetime, timedelta

from pyspark.sql import functions as F

from brindle.operators.keyspace import allocate
from brindle.plans.streams import table_stream
from brindle.session import exists, fresh_path
from brindle.sources.tables import Tables
from brindle.streaming import channels, counters, sessions, stock
from brindle.streaming.runner import drain, drained, file_stream
from tests.conftest import rows


def arriving(spark, *batches):
    """A stream that gets each DataFrame as a micro-batch of its own."""
    folder = fresh_path(spark, "arriving")
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(folder)
    return file_stream(spark, folder, batches[0].schema, maxFilesPerTrigger="1", latestFirst="false")


SENT = [
    ("harbour", "ship 12 docks"), ("harbour:east", "crane moves"), ("harbour", "ship 14 docks"), ("airport", "fog"), ("harbour:west", "tug leaves"),
    ("harbour", "KILL"), ("harbour", "ship 15 docks")]


def messages(spark, sent, first=1):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(first + i, c, d, start + timedelta(minutes=first + i)) for i, (c, d) in enumerate(sent)],
        "seq long, channel string, data string, ts timestamp")


def test_subscriber_stops_on_the_pill(spark):
    heard = channels.subscribe(arriving(spark, messages(spark, SENT)), ["harbour"], ["harbour:*"])
    handled = channels.consume(heard, lambda batch: batch.select("seq", F.concat_ws(" : ", "channel", "data").alias("line")))
    assert rows(handled, "seq") == [(1,), (2,), (3,), (5,)]


def test_pill_holds_for_later_batches(spark):
    stream = arriving(spark, messages(spark, SENT[:2]), messages(spark, SENT[2:], 3), messages(spark, [("harbour", "x")], 20))
    handled = channels.consume(channels.subscribe(stream, ["harbour"]), lambda batch: batch.select("seq"))
    assert rows(handled, "seq") == [(1,), (3,)]


def test_pill_ends_a_live_query_and_holds_after_a_restart(spark):
    home, folder = fresh_path(spark, "home"), fresh_path(spark, "arriving")

    def listen(live, *batches):
        for batch in batches:
            batch.coalesce(1).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, batches[0].schema, maxFilesPerTrigger="1")
        return channels.consume(channels.subscribe(stream, ["harbour"]), lambda batch: batch.select("seq"), home=home, live=live)

    assert rows(listen(True, messages(spark, SENT[:1]), messages(spark, SENT[1:], 2)), "seq") == [(1,), (3,)]
    assert not spark.streams.active
    assert rows(listen(False, messages(spark, SENT[:1], 50)), "seq") == [(1,), (3,)]


def test_nothing_before_the_subscription(spark):
    heard = channels.subscribe(messages(spark, SENT), ["harbour"], since="2024-01-01 00:03:00")
    assert rows(heard, "seq") == [(3,), (6,), (7,)]


def test_split(spark):
    df = spark.createDataFrame([("Tide:Low",), ("still",)], "data string")
    assert rows(channels.split_fields(df, "song", "singer"), "song", "singer") == [("Tide", "Low"), ("still", None)]


def changes(spark, data, column):
    return spark.createDataFrame(data, f"key string, {column} string, delta int")


def test_counters_over_batches(spark):
    stream = arriving(spark, changes(spark, [("well", "drawn", 310), ("well", "depth", 9)], "field"), changes(spark, [("well", "drawn", 17)], "field"))
    assert rows(counters.counters(stream)) == [("well", "depth", 9, 1), ("well", "drawn", 327, 2)]


def test_leaderboard_over_batches(spark):
    first = [("lap", "ivy", 31), ("lap", "max", 44), ("lap", "zoe", 58), ("lap", "bo", 2)]
    stream = arriving(spark, changes(spark, first, "member"), changes(spark, [("lap", "ivy", 30), ("lap", "zoe", -9)], "member"))
    board = counters.live_leaderboard(stream, 3)
    assert rows(board, "rank", "member", "score") == [(1, "ivy", 61), (2, "zoe", 49), (3, "max", 44)]


def test_stock_over_batches_equals_one_batch(spark):
    requests = spark.range(300).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("item"), F.col("id").alias("at"))
    on_hand = spark.createDataFrame([(1, 100), (2, 5), (3, 0)], "item long, quantity int")
    parts = [requests.where(F.col("at").between(a, a + 99)) for a in (0, 100, 200)]
    sold = stock.sell(arriving(spark, *parts), on_hand, "item", [F.col("at")], "quantity")
    at_once = allocate(requests, on_hand, "item", [F.col("at")], "quantity")
    assert sold.select("batch").distinct().count() == 3
    assert rows(sold, "item", "at", "accepted") == rows(at_once, "item", "at", "accepted")


def test_streams_go_on_where_they_stopped(spark):
    folder, home, shop_home = fresh_path(spark, "in"), fresh_path(spark, "home"), fresh_path(spark, "home")
    on_hand = spark.createDataFrame([(0, 4)], "item long, quantity int")

    def more(first, count):
        spark.range(first, first + count).selectExpr("id - id AS item", "id AS at").coalesce(1).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, "item long, at long")
        changes = stream.selectExpr("'k' AS key", "'f' AS field", "at - at + 1 AS delta")
        sold = stock.sell(stream, on_hand, "item", [F.col("at")], "quantity", home=shop_home)
        return rows(counters.counters(changes, home=home), "value"), sold.where("accepted").count(), sold.count()

    assert more(0, 3) == ([(3,)], 3, 3)
    assert more(3, 5) == ([(8,)], 4, 8)


def test_no_input_no_rows(spark, tmp_path):
    nothing = file_stream(spark, str(tmp_path), "id long")
    assert rows(drained(nothing)) == [] and drained(nothing).columns == ["id", "batch"]


def test_handler_sees_every_batch_once(spark):
    seen = []
    drain(arriving(spark, spark.range(3), spark.range(5)), lambda batch, number: seen.append((number, batch.count())))
    assert sorted(seen) == [(0, 3), (1, 5)] or sorted(n for _, n in seen) == [3, 5]


AT = datetime(2031, 3, 1, 6)
SEEN = [("a", 0), ("a", 50), ("b", 55), ("a", 105), ("b", 130), ("a", 170), ("c", 170), ("a", 240), ("b", 191), ("c", 230)]


def seen(spark, picked, beat=None):
    events = [(k, *SEEN[k]) for k in picked] + ([(None, None, beat)] if beat else [])
    return spark.createDataFrame([(k, key, AT + timedelta(minutes=m)) for k, key, m in events], "id int, k string, ts timestamp_ntz")


def test_dedup_within_the_horizon_in_any_order(spark):
    for order in ([0, 1, 2, 3, 4, 5, 6, 7, 8, 9], [4, 3, 1, 2, 0, 9, 7, 8, 6, 5]):
        parts = [seen(spark, order[:5]), seen(spark, order[5:]), seen(spark, [], 900)]
        fresh = sessions.fresh_within(arriving(spark, *parts), ["k"], "ts", "id", 3600, delay=4 * 3600)
        # An event exactly an hour after the last one is not fresh; 8 comes 61 minutes after 4.
        assert rows(fresh, "id") == [(0,), (2,), (4,), (5,), (6,), (7,), (8,)]


def test_late_events_of_the_delay_count_and_later_ones_do_not(spark):
    """One user at 0 and 30 minutes, the second event coming after another user's at 300 and 301 minutes."""
    first = spark.createDataFrame([(0, "a", AT), (1, "b", AT + timedelta(minutes=300))], "id int, k string, ts timestamp_ntz")
    second = spark.createDataFrame([(2, "b", AT + timedelta(minutes=301))], "id int, k string, ts timestamp_ntz")
    third = spark.createDataFrame([(3, "a", AT + timedelta(minutes=30))], "id int, k string, ts timestamp_ntz")
    for delay, events in ((300 * 60, [("a", 2), ("b", 2)]), (60, [("a", 1), ("b", 2)])):
        stream = arriving(spark, first, second, third, seen(spark, [], 2000))
        assert rows(sessions.presence(stream, "k", "ts", 3600, delay), "k", "events") == events


def test_presence_goes_on_after_a_restart_and_closed_sessions_leave_the_state(spark):
    folder, home = fresh_path(spark, "arriving"), fresh_path(spark, "home")

    def run():
        stream = file_stream(spark, folder, seen(spark, []).schema, maxFilesPerTrigger="1")
        return rows(sessions.presence(stream, "k", "ts", 3600, 3600, home=home), "k", "events")

    # Each run takes up where the one before left off; the last one hears of a time beyond all sessions.
    for picked, beat in (([0, 2], None), ([1, 3, 4], None), ([5, 6, 7, 8, 9], None), ([], 900)):
        seen(spark, picked, beat).coalesce(1).write.mode("append").parquet(folder)
        out = run()
        assert len(out) < 7 or beat
    assert out == [("a", 1), ("a", 1), ("a", 3), ("b", 1), ("b", 1), ("b", 1), ("c", 2)]
    held = spark.read.format("statestore").load(f"{home}/checkpoint")
    assert [r.k for r in held.select("value.k").collect()] == [None]


def test_state_folders_do_not_pile_up(spark):
    home = fresh_path(spark, "home")
    parts = [spark.range(k, k + 1).selectExpr("id - id AS item", "id AS at") for k in range(5)]
    on_hand = spark.createDataFrame([(0, 3)], "item long, quantity int")
    sold = stock.sell(arriving(spark, *parts), on_hand, "item", [F.col("at")], "quantity", home=home)
    assert sold.where("accepted").count() == 3
    assert not exists(spark, f"{home}/sold/batch=2") and exists(spark, f"{home}/sold/batch=3")


def test_parts_of_a_table_are_written_by_all_tasks(spark, tmp_path):
    made = spark.range(3000).select(F.col("id").alias("event_id"), F.lit("x").alias("event_type"))
    few = made.where("event_id < 2 OR event_id >= 2000")  # the first part has two rows, the second none
    for name, events in (("even", made), ("uneven", few)):
        events.repartition(4).write.parquet(f"{tmp_path}/{name}/events.parquet")
        t, seen = Tables(spark, f"{tmp_path}/{name}"), []
        tasks = t.events.rdd.getNumPartitions()
        assert tasks > 1

        def note(batch, number):
            files = batch.where("event_id IS NOT NULL").select(F.input_file_name()).distinct().count()
            seen.append((files, *batch.agg(F.min("event_id"), F.max("event_id"), F.count("*")).first()))

        drain(table_stream(t, "events"), note)
        if name == "even":
            assert seen == [(tasks, 0, 999, 1000), (tasks, 1000, 1999, 1000), (tasks, 2000, 2999, 1000)]
        else:
            assert [s[1:] for s in seen] == [(0, 1, 2), (None, None, 0), (2000, 2999, 1000)]
