"""Round trips through the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle import sinks
from brindle.operators import keyspace as kv
from brindle.registry import query
from brindle.session import fresh_path
from brindle.sources import files
from brindle.sources.tables import Tables

PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def _sums(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.sum("p_size").alias("size"))


@query("sink_roundtrip_csv_json", """
SELECT format, p_partkey, p_name, p_size, p_retailprice FROM part, (VALUES ('csv'), ('json')) f(format)""", bigint=["p_size"])
def sink_roundtrip_csv_json(t: Tables) -> DataFrame:
    """Parts written and read back as CSV and as JSON lines."""
    csv = files.read_csv(t.spark, sinks.write_csv(t.part, fresh_path(t.spark, "csv")), PART_SCHEMA)
    json = t.spark.read.schema(PART_SCHEMA).json(sinks.write_json(t.part, fresh_path(t.spark, "json")))
    both = csv.withColumn("format", F.lit("csv")).unionByName(json.withColumn("format", F.lit("json")))
    return both.select("format", "p_partkey", "p_name", "p_size", "p_retailprice")


@query("sink_replace_all", """
SELECT 'part' AS name, count(*) AS rows, sum(p_size) AS size FROM part WHERE p_type = 'PROMO' UNION ALL SELECT 'rest', count(*), sum(p_size) FROM part WHERE p_type <> 'PROMO'
UNION ALL SELECT 'emptied', 0, NULL""", bigint=["size"])
def sink_replace_all(t: Tables) -> DataFrame:
    """A family is replaced as a whole by a second load; another one is emptied."""
    base, promo = fresh_path(t.spark, "family"), F.col("p_type") == "PROMO"
    sinks.replace_all(t.spark, {"part": t.part, "rest": t.part.limit(0)}, base)
    now = sinks.replace_all(t.spark, {"part": t.part.where(promo), "rest": t.part.where(~promo)}, base)
    other = fresh_path(t.spark, "family")
    sinks.replace_all(t.spark, {"part": t.part}, other)
    gone = sinks.empty_all(t.spark, other, ["part"])
    return _sums(now["part"], "part").unionByName(_sums(now["rest"], "rest")).unionByName(_sums(gone["part"], "emptied"))


@query("sink_append", "SELECT p_type AS type, count(*) * 2 AS rows FROM part GROUP BY 1")
def sink_append(t: Tables) -> DataFrame:
    """The first append creates the table, the second adds to it."""
    path = fresh_path(t.spark, "append")
    sinks.append(t.part, path)
    return sinks.append(t.part, path).groupBy(F.col("p_type").alias("type")).agg(F.count("*").alias("rows"))


@query("sink_hash_batch", """
SELECT 'part:' || p_partkey AS key, 'name' AS field, p_name AS value FROM part UNION ALL SELECT 'part:' || p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part""")
def sink_hash_batch(t: Tables) -> DataFrame:
    """All fields of all hashes in one write."""
    fields = t.part.withColumnsRenamed({"p_name": "name", "p_size": "size"})
    hashes = kv.wide_to_hash(fields, kv.key_of("part", F.col("p_partkey")), ["name", "size"])
    return sinks.append(hashes, fresh_path(t.spark, "hashes"))
