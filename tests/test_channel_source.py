"""The channel source: positions, restarts, segments that are not whole, and a subscription that begins late."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from brindle.session import fresh_path
from brindle.streaming import channel_source, channels
from brindle.streaming.runner import drained
from tests.conftest import rows

SCHEMA = "seq bigint, channel string, data string, ts timestamp"


def said(spark, first, *words):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([(first + i, "harbour" if i % 2 else "airport", w, start + timedelta(minutes=first + i)) for i, w in enumerate(words)], SCHEMA)


def test_a_subscription_hears_what_comes_after_it_began_and_goes_on_after_a_restart(spark):
    folder, home, early = (fresh_path(spark, n) for n in ("channel", "late", "early"))
    channel_source.publish(said(spark, 1, "a", "b", "c"), folder)

    def heard(home, start):
        stream = channels.subscribe(channel_source.listen(spark, folder, SCHEMA, start), ["harbour"], ["air*"])
        return rows(drained(stream, home=home), "seq")

    assert heard(home, "latest") == [] and heard(early, "earliest") == [(1,), (2,), (3,)]
    channel_source.publish(said(spark, 4, "d", "e").repartition(2), folder)
    channel_source.publish(said(spark, 6, None), folder)
    assert heard(home, "latest") == [(4,), (5,), (6,)]
    assert heard(early, "latest") == [(k,) for k in range(1, 7)]
    assert heard(home, "latest") == [(4,), (5,), (6,)]
    assert heard(fresh_path(spark, "second"), "1") == [(4,), (5,), (6,)]


def test_a_segment_counts_when_it_is_whole(spark):
    folder = fresh_path(spark, "channel")
    assert channel_source.segments(folder) == 0
    for k in range(3):
        channel_source.publish(said(spark, k, "x"), folder)
    assert channel_source.segments(folder) == 3
    store, path = channel_source._place(folder)
    store.delete_file(f"{channel_source._segment(path, 1)}/_SUCCESS")
    assert channel_source.segments(folder) == 1


def test_a_micro_batch_takes_so_many_segments(spark):
    folder = fresh_path(spark, "channel")
    for k in range(4):
        channel_source.publish(said(spark, 10 * k, "x", "y"), folder)
    reader = channel_source.Reader({"path": folder, "most": "3"}, said(spark, 0, "x").schema)
    start = reader.initialOffset()
    first = reader.latestOffset()
    assert (start, first) == ({"segments": 0}, {"segments": 3})
    assert len(reader.partitions(start, first)) >= 3 and reader.latestOffset() == {"segments": 4}
    assert sum(b.num_rows for p in reader.partitions(first, {"segments": 4}) for b in reader.read(p)) == 2


def test_columns_that_are_not_asked_for_are_not_read(spark):
    folder = fresh_path(spark, "channel")
    channel_source.publish(said(spark, 1, "a", "b").withColumn("seq", F.col("seq").cast("int")), folder)
    stream = channel_source.listen(spark, folder, "data string, seq bigint")
    assert rows(drained(stream).drop("batch")) == [("a", 1), ("b", 2)]
