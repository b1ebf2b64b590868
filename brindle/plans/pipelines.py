"""Batch pipelines: intervals, branches, merges by position, trends, places, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle import sinks
from brindle.functions.arrays import choose, choose_up_to
from brindle.functions.casts import to_int
from brindle.functions.dates import epoch_seconds
from brindle.functions.hashing import stable_hash, stable_hash_sql
from brindle.functions.text import decoded
from brindle.operators import pipeline as p
from brindle.operators import sampling, sessions
from brindle.operators.documents import exact_mean
from brindle.operators.nearest import nearest, nearest_k
from brindle.operators.ordering import top_per_key
from brindle.operators.skew import plain_side
from brindle.registry import query
from brindle.session import fresh_path
from brindle.sources import files
from brindle.sources.tables import Tables

START, END = 1704672000, 1705881600  # 2024-01-08 and 2024-01-22
EPOCH_SQL = "CAST(floor(epoch(ts)) AS BIGINT)"


@query("interval_filter", f"SELECT event_id, event_type, {EPOCH_SQL} AS modified FROM events WHERE {EPOCH_SQL} BETWEEN {START} AND {END}")
def interval_filter(t: Tables) -> DataFrame:
    rows = p.in_time_interval(t.events, "ts", START, END)
    return rows.select("event_id", "event_type", epoch_seconds(F.col("ts")).alias("modified"))


@query("epoch_threshold", f"SELECT event_id, {EPOCH_SQL} AS modified FROM events WHERE {EPOCH_SQL} > {START}")
def epoch_threshold(t: Tables) -> DataFrame:
    """Lines of a CSV file whose third column is a later epoch; the header falls out by itself."""
    rows = t.events.select("event_id", "event_type", epoch_seconds(F.col("ts")).alias("modified"))
    lines = files.read_csv_lines(t.spark, sinks.write_csv(rows, fresh_path(t.spark, "lines")))
    late = p.after_epoch(lines, 2, START)
    return late.select(F.col("_c0").cast("bigint").alias("event_id"), F.col("_c2").cast("bigint").alias("modified"))


@query("interval_increments", f"""
SELECT {START} + ({EPOCH_SQL} - {START}) // 604800 * 604800 AS interval, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids
FROM events WHERE {EPOCH_SQL} >= {START} AND {EPOCH_SQL} < {START} + 2 * 604800 GROUP BY 1""")
def interval_increments(t: Tables) -> DataFrame:
    """Weekly batches, one of them run twice: each week is stored once."""
    rows = t.events.select("event_id", "ts")
    path, week = fresh_path(t.spark, "weeks"), 7 * 24 * 3600
    for start in (START, START + week, START):
        sinks.write_interval(p.in_time_interval(rows, "ts", start, start + week - 1), path, start)
    return t.spark.read.parquet(path).groupBy("interval").agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids"))


def _sheet(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("props").alias("piece"), F.col("event_type").alias("type"),
        F.concat(F.lit("O'Neil, \"no. "), F.col("user_id").cast("string"), F.lit("\"`")).alias("composer"),
        epoch_seconds(F.col("ts")).alias("modified"),
    )


@query("interval_etl_split", f"""
WITH f AS (SELECT * FROM events WHERE {EPOCH_SQL} BETWEEN {START} AND {END})
SELECT 'piece' AS name, replace(props, '"', '') AS value, event_type AS type, count(*) AS rows FROM f GROUP BY 2, 3
UNION ALL SELECT 'composer', 'ONeil no. ' || user_id, NULL, 1 FROM f GROUP BY user_id""")
def interval_etl_split(t: Tables) -> DataFrame:
    """Filter the interval, stop if it is empty, split into two tables and load both."""
    batch = _sheet(p.in_time_interval(t.events, "ts", START, END))

    def load():
        pieces, composers = p.split_sheet(batch, ["piece", "type"], "composer")
        base = fresh_path(t.spark, "sheet")
        loaded_pieces = sinks.append(pieces, f"{base}/pieces")
        loaded_composers = sinks.append(composers, f"{base}/composer")
        counted = loaded_pieces.groupBy(F.lit("piece").alias("name"), F.col("piece").alias("value"), "type").agg(F.count("*").alias("rows"))
        return counted.unionByName(loaded_composers.select(
            F.lit("composer").alias("name"), F.col("composer").alias("value"), F.lit(None).cast("string").alias("type"), F.lit(1).cast("bigint").alias("rows")))

    empty = t.spark.createDataFrame([], "name string, value string, type string, rows bigint")
    return p.branch(not batch.isEmpty(), load, lambda: empty)


@query("callable_steps", "SELECT user_id, count(*) AS bought FROM events WHERE event_type = 'purchase' AND value > 10 GROUP BY 1")
def callable_steps(t: Tables) -> DataFrame:
    """Plain functions and lambdas as steps of a job."""
    def bought(df: DataFrame) -> DataFrame:
        return df.where(F.col("event_type") == "purchase")

    return p.run_steps(
        t.events, bought, lambda df: df.where(F.col("value") > 10), lambda df: df.groupBy("user_id").agg(F.count("*").alias("bought"))
    )


@query("branch_on_empty", "SELECT 'split' AS taken, event_type, count(*) AS rows FROM events WHERE value > 100 GROUP BY 2")
def branch_on_empty(t: Tables) -> DataFrame:
    """Go on where the filter leaves rows, else report the end."""
    big = t.events.where(F.col("value") > 100)
    by_type = big.groupBy("event_type").agg(F.count("*").alias("rows"))
    return p.branch(
        big.isEmpty(),
        lambda: t.events.agg(F.lit("end").alias("taken"), F.lit("").alias("event_type"), F.count("*").alias("rows")),
        lambda: by_type.select(F.lit("split").alias("taken"), "event_type", "rows"),
    )


@query("branch_on_sum", """
SELECT 'spells' AS taken, s_suppkey AS class, count(*) AS spells FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 2""")
def branch_on_sum(t: Tables) -> DataFrame:
    """Count the spells only if some class has any; otherwise list the classes."""
    counts = t.lineitem.groupBy(F.col("l_suppkey").alias("class")).agg(F.count("*").alias("spells"))
    return p.branch(
        p.is_positive(counts, "spells"),
        lambda: counts.join(t.supplier.select(F.col("s_suppkey").alias("class")), "class").select(F.lit("spells").alias("taken"), "class", "spells"),
        lambda: t.supplier.select(F.lit("merge").alias("taken"), F.col("s_suppkey").alias("class"), F.lit(0).alias("spells")),
    )


@query("empty_batch_guard", """
SELECT 'accepted' AS outcome, event_type AS batch, count(*) AS rows FROM events GROUP BY 2 UNION ALL SELECT 'rejected', 'refund', 0""")
def empty_batch_guard(t: Tables) -> DataFrame:
    """The events pass; a batch that holds nothing is turned away."""
    passed = p.reject_empty(t.events, "events")
    out = passed.groupBy(F.lit("accepted").alias("outcome"), F.col("event_type").alias("batch")).agg(F.count("*").alias("rows"))
    try:
        p.reject_empty(t.events.where(F.col("event_type") == "refund"), "refunds")
    except ValueError:
        row = t.spark.createDataFrame([("rejected", "refund", 0)], out.schema)
        return out.unionByName(row)
    return out


@query("positional_merge", """
WITH a AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos, p_name AS part FROM part),
b AS (SELECT row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1 AS pos, s_name AS supplier FROM supplier),
c AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_name AS customer FROM customer)
SELECT pos, part, supplier, customer FROM a FULL JOIN b USING (pos) FULL JOIN c USING (pos)""")
def positional_merge(t: Tables) -> DataFrame:
    """Names of three tables side by side by row position."""
    return p.positional_merge({
        "part": (t.part.withColumnRenamed("p_name", "part"), [F.col("p_partkey")]),
        "supplier": (t.supplier.withColumnRenamed("s_name", "supplier"), [F.col("s_acctbal").desc(), F.col("s_suppkey")]),
        "customer": (t.customer.withColumnRenamed("c_name", "customer"), [F.col("c_custkey")]),
    })


def _pick_sql(items: str, count: str) -> str:
    """Three picks without replacement by document, the first `count` of them joined."""
    at = [f"{stable_hash_sql('doc_id', str(i))} % greatest(len(a{i}), 1)" for i in range(3)]
    return f"""(SELECT doc_id, array_to_string([p0, p1, a2[1 + {at[2]}]][1:least({count}, len(a0))], ',') AS picks FROM
      (SELECT *, a1[1 + {at[1]}] AS p1, a1[1:{at[1]}] || a1[2 + {at[1]}:] AS a2 FROM
        (SELECT *, a0[1 + {at[0]}] AS p0, a0[1:{at[0]}] || a0[2 + {at[0]}:] AS a1 FROM (SELECT doc_id, {items} AS a0 FROM documents))))"""


_BACK = "list_reverse(string_split(text, ' '))"


@query("character_assembly", f"""
WITH n AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_name AS name, 1 + {stable_hash_sql('c_custkey', "'level'")} % 3 AS level,
    '[' || {" || ', ' || ".join(f"CAST(6 + {stable_hash_sql('c_custkey', str(i))} % 14 AS VARCHAR)" for i in range(5))} || ']' AS attributes FROM customer),
r AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos, lower(p_type) AS race FROM part),
d AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, lang AS language, source AS class, w.picks AS proficiencies, s.picks AS spells FROM documents
  JOIN {_pick_sql("string_split(text, ' ')", '2')} w USING (doc_id) JOIN {_pick_sql(_BACK, f"1 + {stable_hash_sql('doc_id')} % least(3, len(a0))")} s USING (doc_id))
SELECT pos, name, level, attributes, race, language, class, proficiencies, spells FROM n FULL JOIN r USING (pos) FULL JOIN d USING (pos)""")
def character_assembly(t: Tables) -> DataFrame:
    """Columns of three tables merged by position into characters, and loaded.

    Traits are random picks that repeat: two words of the text as proficiencies,
    one to three of its words, read from the end, as spells.
    """
    who = F.col("c_custkey")
    scores = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: 6 + F.pmod(stable_hash(who, i), F.lit(14)))
    names = t.customer.select(
        "c_custkey", F.col("c_name").alias("name"), (1 + F.pmod(stable_hash(who, F.lit("level")), F.lit(3))).alias("level"),
        F.concat(F.lit("["), F.array_join(scores.cast("array<string>"), ", "), F.lit("]")).alias("attributes"),
    )
    races = t.part.select("p_partkey", F.lower("p_type").alias("race"))
    docs = t.documents.select("doc_id", F.col("lang").alias("language"), F.col("source").alias("class"))
    # The texts take no part in the merge; their words are split once, picked and joined by id.
    words = t.documents.select(
        "doc_id", F.split("text", " ").alias("words"))
    picks = words.select(
        "doc_id",
        F.array_join(choose(F.col("words"), F.lit(2), F.col("doc_id")), ",").alias("proficiencies"),
        F.array_join(choose_up_to(F.reverse("words"), 3, F.col("doc_id")), ",").alias("spells"),
    )

    def packed(df, *columns):
        return df.withColumn("_row", F.struct(*columns))

    merged = p.positional_merge({
        "n": (packed(names, "name", "level", "attributes").withColumnRenamed("_row", "n"), [F.col("c_custkey")]),
        "r": (packed(races, "race").withColumnRenamed("_row", "r"), [F.col("p_partkey")]),
        "d": (packed(docs, "doc_id", "language", "class").withColumnRenamed("_row", "d"), [F.col("doc_id")]),
    })
    characters = merged.select("pos", "n.*", "r.*", "d.*").join(picks, "doc_id", "left").drop("doc_id")
    return sinks.append(characters, fresh_path(t.spark, "characters"))


@query("json_recordset", "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events", bigint=["k"])
def json_recordset(t: Tables) -> DataFrame:
    """Rows from JSON arrays of records held in a text column."""
    texts = t.events.select("event_id", F.concat(F.lit("["), "props", F.lit("]")).alias("records"))
    return files.record_set(texts, "records", "k int")


@query("class_legal_spells", """
WITH k AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
r AS (SELECT s_name AS class, s_nationkey % 3 + 1 AS level, p_partkey AS spell, p_size AS spell_level, row_number() OVER (PARTITION BY s_suppkey ORDER BY p_size, p_partkey) AS position
  FROM k JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE p_size <= 2)
SELECT class, level, spell, spell_level, position FROM r WHERE position <= level + 3""", bigint=["level", "spell_level"])
def class_legal_spells(t: Tables) -> DataFrame:
    """Spells a class may learn: known to it, of level two at most, level + 3 of them."""
    spells = t.part.where(F.col("p_size") <= 2).select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("spell_level"))
    known = t.lineitem.select("l_suppkey", "l_partkey").join(spells, "l_partkey").distinct()
    classes = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("class"), (F.col("s_nationkey") % 3 + 1).alias("level"))
    highest = classes.agg(F.max("level")).first()[0] or 0
    first = top_per_key(known, ["l_suppkey"], [F.col("spell_level"), F.col("l_partkey")], highest + 3)
    legal = first.join(classes, "l_suppkey").where(F.col("position") <= F.col("level") + 3)
    return legal.select("class", "level", F.col("l_partkey").alias("spell"), "spell_level", "position")


RUN_SQL = "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average FROM events GROUP BY 1"
TREND_SQL = f"""
SELECT run, average, lag(average) OVER w AS previous, CASE WHEN lag(average) OVER w IS NULL THEN 'first' WHEN average > lag(average) OVER w THEN 'increasing'
  WHEN average < lag(average) OVER w THEN 'decreasing' ELSE 'same' END AS direction FROM ({RUN_SQL}) WINDOW w AS (ORDER BY run)"""


@query("run_average_trend", TREND_SQL)
def run_average_trend(t: Tables) -> DataFrame:
    """Average per daily run and its direction against the run before."""
    runs = t.events.groupBy(F.to_date("ts").alias("run")).agg(exact_mean("value").alias("average"))
    return p.trend(runs, "run", "average")


@query("seen_within_hour", """
SELECT event_id, user_id FROM events QUALIFY ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 1 HOUR""")
def seen_within_hour(t: Tables) -> DataFrame:
    """Events of users who had been seen in the hour before."""
    return sessions.seen_within(t.events, "user_id", "ts", "event_id", 3600).select("event_id", "user_id")


SESSION_SQL = """
WITH m AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 8 HOUR THEN 0 ELSE 1 END AS s FROM events),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM m)
SELECT user_id, CAST(session AS BIGINT) AS session, epoch_us(min(ts)) AS started, epoch_us(max(ts)) AS ended, count(*) AS events FROM n GROUP BY 1, 2"""


@query("presence_sessions", SESSION_SQL)
def presence_sessions(t: Tables) -> DataFrame:
    """When was a user online? Breaks above eight hours end a session."""
    return sessions.presence(t.events, "user_id", "ts", "event_id", 8 * 3600)


@query("users_online", f"""SELECT user_id, events FROM ({SESSION_SQL}) WHERE started <= epoch_us(TIMESTAMP '2024-01-15 12:00:00')
  AND ended >= epoch_us(TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 8 HOUR)""")
def users_online(t: Tables) -> DataFrame:
    """Who is online at noon of a day?"""
    noon = 1705320000 * 1_000_000
    return sessions.online(presence_sessions(t), noon, 8 * 3600).select("user_id", "events")


@query("blacklist_semi_anti", """
WITH h AS (SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, url LIKE 'http://%' AS plain FROM pages)
SELECT page_id, host, host IN (SELECT host FROM h WHERE plain) AS blacklisted FROM h""")
def blacklist_semi_anti(t: Tables) -> DataFrame:
    """Pages of blacklisted hosts and the others; a host seen over plain http is listed."""
    pages = t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/:?#]+)", 1).alias("host"), F.col("url").startswith("http://").alias("plain"))
    listed = plain_side(pages.where("plain").select("host").distinct())
    blocked = pages.join(listed, "host", "left_semi").select("page_id", "host", F.lit(True).alias("blacklisted"))
    return blocked.unionByName(pages.join(listed, "host", "left_anti").select("page_id", "host", F.lit(False).alias("blacklisted")))


_KM = """2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"""


@query("nearest_country", f"""
WITH a AS (SELECT c_custkey, (c_custkey * 37 % 17900) / 100.0::DOUBLE - 89.5 AS lat, (c_custkey * 911 % 35900) / 100.0::DOUBLE - 179.5 AS lon FROM customer),
b AS (SELECT n_name, r_name, n_nationkey * 6.5::DOUBLE - 78 AS lat, (n_nationkey * 97 % 360) - 179.0::DOUBLE AS lon FROM nation JOIN region ON r_regionkey = n_regionkey)
SELECT c_custkey AS id, arg_min(n_name, km) AS country, arg_min(r_name, km) AS continent, round(min(km), 3) AS km
FROM (SELECT *, {_KM} AS km FROM a, b) GROUP BY 1""")
def nearest_country(t: Tables) -> DataFrame:
    """Country and continent nearest to a position of each customer."""
    key = F.col("c_custkey")
    points = t.customer.select(key.alias("id"), (F.pmod(key * 37, F.lit(17900)) / 100 - 89.5).alias("lat"), (F.pmod(key * 911, F.lit(35900)) / 100 - 179.5).alias("lon"))
    n = F.col("n_nationkey")
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("continent"),
        (n * F.lit(6.5) - 78).alias("lat"), (F.pmod(n * 97, F.lit(360)) - F.lit(179.0)).alias("lon"))
    return nearest(points, places).select("id", "country", "continent", F.round("km", 3).alias("km"))


@query("nearest_customers", f"""
WITH a AS (SELECT s_suppkey, (s_suppkey * 7919 % 178001) / 1000.0::DOUBLE - 89 AS lat, (s_suppkey * 104729 % 358001) / 1000.0::DOUBLE - 179 AS lon FROM supplier),
b AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 48.1 + (c_custkey * 31 % 10007) / 1e5::DOUBLE ELSE (c_custkey * 15485863 % 178001) / 1000.0::DOUBLE - 89 END AS lat,
  CASE WHEN c_custkey % 3 = 0 THEN 11.5 + (c_custkey * 37 % 10009) / 1e5::DOUBLE ELSE (c_custkey * 32452843 % 358001) / 1000.0::DOUBLE - 179 END AS lon FROM customer)
SELECT s_suppkey AS id, row_number() OVER (PARTITION BY s_suppkey ORDER BY km, c_custkey) AS rank, c_custkey AS customer, round(km, 3) AS km
FROM (SELECT *, {_KM} AS km FROM a, b) QUALIFY rank <= 5""")
def nearest_customers(t: Tables) -> DataFrame:
    """The five customers nearest to each supplier; a third of the customers live in one town."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")

    def spread(key, factor, width):
        return F.pmod(key * F.lit(factor), F.lit(width))

    points = t.supplier.select(s.alias("id"), (spread(s, 7919, 178001) / 1000 - 89).alias("lat"), (spread(s, 104729, 358001) / 1000 - 179).alias("lon"))
    town = F.pmod(c, F.lit(3)) == 0
    places = t.customer.select(
        c.alias("customer"),
        F.when(town, 48.1 + spread(c, 31, 10007) / 1e5).otherwise(spread(c, 15485863, 178001) / 1000 - 89).alias("lat"),
        F.when(town, 11.5 + spread(c, 37, 10009) / 1e5).otherwise(spread(c, 32452843, 358001) / 1000 - 179).alias("lon"))
    return nearest_k(points, places, 5).select("id", F.col("rank").cast("bigint").alias("rank"), "customer", F.round("km", 3).alias("km"))


@query("random_row", f"SELECT c_custkey AS id, c_name AS name FROM customer ORDER BY {stable_hash_sql('c_custkey', '7')}, 1 LIMIT 1")
def random_row(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return sampling.random_rows(rows, "id", 1, seed=7)


@query("random_sample_k", f"SELECT p_partkey AS id, p_name AS name FROM part ORDER BY {stable_hash_sql('p_partkey', '11')}, 1 LIMIT 5")
def random_sample_k(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return sampling.random_rows(rows, "id", 5, seed=11)


@query("random_sentence", f"""
WITH adj AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS at, count(*) OVER () AS n FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS word FROM part)),
noun AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS at, count(*) OVER () AS n FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS word FROM part)),
verb AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS at, count(*) OVER () AS n FROM (SELECT DISTINCT event_type || 's' AS word FROM events)),
c AS (SELECT c_custkey AS id, {', '.join(f"{stable_hash_sql('c_custkey', repr(slot))} AS h{k}" for k, slot in enumerate(("adjective1", "noun1", "verb", "adjective2", "noun2")))} FROM customer)
SELECT id, upper(a[1]) || a[2:] AS sentence FROM (SELECT id, a1.word || ' ' || n1.word || ' ' || v.word || ' ' || a2.word || ' ' || n2.word AS a FROM c
  JOIN adj a1 ON a1.at = h0 % a1.n JOIN noun n1 ON n1.at = h1 % n1.n JOIN verb v ON v.at = h2 % v.n JOIN adj a2 ON a2.at = h3 % a2.n JOIN noun n2 ON n2.at = h4 % n2.n)""")
def random_sentence(t: Tables) -> DataFrame:
    """A sentence for every customer, from the words of tables."""
    part = F.split("p_name", " ")
    rows = t.customer.select(F.col("c_custkey").alias("id"))
    adjectives, nouns = (t.part.select(F.get(part, F.lit(k)).alias("word")) for k in (0, 1))
    return sampling.sentences(rows, "id", adjectives, nouns, t.events.select(F.concat("event_type", F.lit("s")).alias("word")))


@query("multi_file_json", "SELECT event_id, event_type, CAST(value AS DOUBLE) AS value FROM events")
def multi_file_json(t: Tables) -> DataFrame:
    """A folder of several JSON files, read as one table."""
    path = fresh_path(t.spark, "json")
    sinks.write_json(t.events.select("event_id", "event_type", "value").repartition(3), path)
    return files.read_json_lines(t.spark, path, "event_id bigint, event_type string, value double")


@query("scalar_casts_defaults_intervals", """
SELECT o_orderkey AS id, CAST(CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_before, CAST(CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS day_before,
  TRY_CAST(o_orderstatus AS BIGINT) AS not_a_number, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS urgency, CAST(o_totalprice AS BIGINT) >= 0 AS has_price,
  coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, 'unpaid') AS priority, o_orderpriority AS text, o_orderdate < TIMESTAMP '2001-08-02' AS past FROM orders""")
def scalar_casts_defaults_intervals(t: Tables) -> DataFrame:
    """Interval arithmetic, casts that may fail, defaults for missing values, bytes to text."""
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.add_months(F.to_date("o_orderdate"), -1).alias("month_before"),
        F.date_sub(F.to_date("o_orderdate"), 1).alias("day_before"), to_int(F.col("o_orderstatus")).alias("not_a_number"),
        to_int(F.substring("o_orderpriority", 1, 1)).alias("urgency"), (F.col("o_totalprice").cast("bigint") >= 0).alias("has_price"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")), F.lit("unpaid")).alias("priority"),
        decoded(F.col("o_orderpriority").cast("binary")).alias("text"),
        (F.col("o_orderdate") < F.lit("2001-08-02").cast("timestamp_ntz")).alias("past"),
    )


@query("sql_over_frame", "SELECT c_mktsegment AS segment, count(*) AS purchases FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def sql_over_frame(t: Tables) -> DataFrame:
    """The same functions serve SQL: DataFrames are named in the text."""
    return t.spark.sql(
        "SELECT c_mktsegment AS segment, count(*) AS purchases FROM {o} JOIN {c} ON c_custkey = o_custkey GROUP BY 1",
        o=t.orders, c=t.customer)
