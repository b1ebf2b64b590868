"""Requests against a limited stock, as they stream in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.keyspace import allocate
from brindle.session import remove, scratch_of_its_own
from brindle.streaming.runner import drain, home_of, stored


def sell(
    requests: DataFrame,
    stock: DataFrame,
    item: str,
    order: Sequence[Column],
    quantity: str,
    home: str | None = None,
) -> DataFrame:
    """Each request, accepted while stock lasts.

    The state is what every item sold up to a micro-batch, one table per batch, of
    which the last two are kept; what a batch writes in between is cleared.
    A batch is served by the distributed numbering of `allocate`, so one item
    with most of the requests does not end up in one task.
    """
    spark, home = requests.sparkSession, home_of(requests, home)
    decisions, sold = f"{home}/out", f"{home}/sold"

    def handle(batch: DataFrame, number: int) -> None:
        left = stock.select(item, F.col(quantity).cast("bigint").alias("_left"))
        if number > 0:
            before = spark.read.parquet(f"{sold}/batch={number - 1}")
            left = left.join(before, item, "left").withColumn("_left", F.col("_left") - F.coalesce("sold", F.lit(0))).drop("sold")
        with scratch_of_its_own(spark):
            allocate(batch, left, item, order, "_left").write.mode("overwrite").parquet(f"{decisions}/batch={number}")
        served = spark.read.parquet(f"{decisions}/batch={number}").where("accepted")
        counts = served.groupBy(item).agg(F.count("*").alias("sold"))
        if number > 0:
            counts = before.unionByName(counts).groupBy(item).agg(F.sum("sold").alias("sold"))
        counts.write.mode("overwrite").parquet(f"{sold}/batch={number}")
        remove(spark, f"{sold}/batch={number - 2}")

    drain(requests, handle, home=home)
    undecided = spark.createDataFrame([], requests.schema).withColumn("accepted", F.lit(True))
    return stored(spark, decisions, undecided)
