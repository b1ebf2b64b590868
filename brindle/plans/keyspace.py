"""Key-value queries over the event log and the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle import stored
from brindle.functions import arrays, maps
from brindle.functions.text import part_of
from brindle.operators import keyspace as kv
from brindle.operators import commands, lists, queues, ranked, seen
from brindle.operators.changes import delete_where
from brindle.operators.documents import insert
from brindle.registry import query
from brindle.session import fresh_path
from brindle.sources.tables import Tables

AS_OF = "2024-01-30 12:00:00"
FIELDS = ("click", "error", "purchase", "signup", "view")


def user_key(t: Tables, column: str = "user_id"):
    return kv.key_of("user", F.col(column))


def writes(t: Tables) -> DataFrame:
    """Events as hash writes: the user's key, the event type as field."""
    return t.events.select(
        F.col("event_id").alias("seq"), user_key(t).alias("key"), F.col("event_type").alias("field"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )


def hashes(t: Tables) -> DataFrame:
    return kv.last_write(writes(t), ["key", "field"], "value")


def scores(t: Tables) -> DataFrame:
    """A sorted set per event type: users scored by the sum of values."""
    return kv.add_scores(t.events.select(
        F.col("event_type").alias("key"), kv.key_of("user", F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("member"),
        F.col("value").cast("decimal(18,2)").alias("delta"),
    ))


HASH_SQL = """(SELECT 'user:' || user_id AS key, event_type AS field, CAST(arg_max(value, event_id) AS DECIMAL(18,2)) AS value
  FROM events GROUP BY 1, 2)"""
SCORE_SQL = """(SELECT event_type AS key, 'user:' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS member, sum(CAST(value AS DECIMAL(18,2))) AS score
  FROM events GROUP BY 1, 2)"""


@query("kv_mget", """
WITH s AS (SELECT 'user:' || user_id AS key, CAST(CAST(arg_max(value, event_id) AS DECIMAL(18,2)) AS DOUBLE) AS value FROM events GROUP BY 1)
SELECT 'user:' || c_custkey AS key, value FROM customer LEFT JOIN s ON s.key = 'user:' || c_custkey""")
def kv_mget(t: Tables) -> DataFrame:
    """The last value of every customer's key; NULL where there is none."""
    store = kv.last_write(writes(t), ["key"], "value")
    return kv.get_many(store, t.customer.select(kv.key_of("user", F.col("c_custkey")).alias("key")))


@query("kv_key_pattern", """
SELECT DISTINCT event_type || ':' || user_id || ':seen' AS key FROM events
WHERE event_type || ':' || user_id || ':seen' GLOB '?i*:1?:*'""")
def kv_key_pattern(t: Tables) -> DataFrame:
    store = t.events.select(F.concat_ws(":", "event_type", "user_id", F.lit("seen")).alias("key")).distinct()
    return kv.keys(store, "?i*:1?:*")


@query("kv_stored_key_pattern", """
SELECT DISTINCT event_type || ':' || user_id || ':seen' AS key FROM events
WHERE event_type || ':' || user_id || ':seen' GLOB 'purchase:1?:s*'""")
def kv_stored_key_pattern(t: Tables) -> DataFrame:
    """Keys by pattern from a store clustered by key: the fixed head of the pattern picks the row groups that are read."""
    store = t.events.select(F.concat_ws(":", "event_type", "user_id", F.lit("seen")).alias("key")).distinct()
    base = fresh_path(t.spark, "store")
    stored.create(store, base, "key", 16)
    return kv.keys(stored.read(t.spark, base), "purchase:1?:s*")


@query("kv_exists", """
SELECT 'user:' || c_custkey AS key, c_custkey IN (SELECT user_id FROM events WHERE event_type = 'signup') AS present FROM customer""")
def kv_exists(t: Tables) -> DataFrame:
    """Which customers are members of the signed-up set?"""
    signed = t.events.where(F.col("event_type") == "signup").select(user_key(t).alias("key"))
    return kv.exists_many(signed, t.customer.select(kv.key_of("user", F.col("c_custkey")).alias("key")))


@query("kv_hash_pivot", f"""
SELECT key, {', '.join(f"CAST(max(value) FILTER (field = '{f}') AS DOUBLE) AS {f}" for f in FIELDS)} FROM {HASH_SQL} GROUP BY 1""")
def kv_hash_pivot(t: Tables) -> DataFrame:
    return kv.hash_to_wide(hashes(t), FIELDS)


@query("kv_hash_filter", f"""
WITH w AS (SELECT key, {', '.join(f"CAST(max(value) FILTER (field = '{f}') AS DOUBLE) AS {f}" for f in FIELDS)} FROM {HASH_SQL} GROUP BY 1)
SELECT key, click, view FROM w WHERE purchase < 60 AND NOT coalesce(error > 100, false)""")
def kv_hash_filter(t: Tables) -> DataFrame:
    """Hashes with a low price field, after deleting those whose error field is high."""
    wide = kv.hash_to_wide(hashes(t), FIELDS)
    kept = delete_where(wide, F.col("error") > 100)
    return kept.where(F.col("purchase") < 60).select("key", "click", "view")


@query("kv_hash_fields", f"""
WITH h AS (SELECT key, field, CAST(value AS VARCHAR) AS value FROM {HASH_SQL} WHERE field <> 'error'),
u AS (SELECT key, field, CASE WHEN field = 'view' THEN 'brown' ELSE value END AS value FROM h
  UNION ALL SELECT DISTINCT 'user:' || user_id, 'updated', 'true' FROM events
  UNION ALL SELECT DISTINCT 'user:' || user_id, 'view', 'brown' FROM events WHERE 'user:' || user_id NOT IN (SELECT key FROM h WHERE field = 'view'))
SELECT key, string_agg(field || '=' || value, ',' ORDER BY field || '=' || value) AS fields FROM u GROUP BY 1""")
def kv_hash_fields(t: Tables) -> DataFrame:
    """Set one field, add a flag field, delete a field of every hash."""
    wide = kv.hash_to_wide(hashes(t).withColumn("value", F.col("value").cast("string")), FIELDS)
    pairs = [c for f in FIELDS for c in (F.lit(f), F.col(f))]
    record = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    record = maps.set_fields(record, view=F.lit("brown"), updated=F.lit("true"))
    return wide.select("key", maps.as_text(maps.delete_fields(record, "error")).alias("fields"))


@query("kv_hash_get", f"""
SELECT 'user:' || c_custkey AS key, f AS field, CAST(value AS DOUBLE) AS value
FROM customer CROSS JOIN (VALUES ('signup'), ('view')) v(f) LEFT JOIN {HASH_SQL} h ON h.key = 'user:' || c_custkey AND h.field = f""")
def kv_hash_get(t: Tables) -> DataFrame:
    """Two fields of every customer's hash; NULL where there is none."""
    asked = t.customer.select(kv.key_of("user", F.col("c_custkey")).alias("key"))
    return kv.fetch_fields(hashes(t), asked, "signup", "view")


@query("kv_list_ops", """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
p AS (SELECT doc_id, list_append(list_prepend('first', a), 'last') AS b, a[1] AS mark FROM d),
i AS (SELECT *, list_position(b, mark) AS k FROM p),
j AS (SELECT *, b[1:k-1] || ['before'] || b[k:] AS c FROM i)
SELECT doc_id, len(c) AS size, c[1] AS head, c[-1] AS tail, array_to_string(c[1:3], '|') AS first3, array_to_string(c[-2:], '|') AS last2,
  array_to_string(c[2:], '|') AS left_popped, array_to_string(c[1:len(c)-1], '|') AS right_popped FROM j""")
def kv_list_ops(t: Tables) -> DataFrame:
    """The lines of each document as a list: push, insert, range, index, length and pop."""
    lines = F.split("text", "\n")
    items = arrays.push_right(arrays.push_left(lines, F.lit("first")), F.lit("last"))
    items = arrays.insert_before(items, F.get(lines, F.lit(0)), F.lit("before"))
    lists = t.documents.select("doc_id", items.alias("items"))
    c = F.col("items")

    def text(a):
        return F.array_join(a, "|")

    return lists.select(
        "doc_id", F.size(c).alias("size"), arrays.at(c, 0).alias("head"), arrays.at(c, -1).alias("tail"),
        text(arrays.slice_range(c, 0, 2)).alias("first3"), text(arrays.slice_range(c, -2, -1)).alias("last2"),
        text(arrays.pop_left(c)["rest"]).alias("left_popped"), text(arrays.pop_right(c)["rest"]).alias("right_popped"),
    )


@query("kv_list_table", """
WITH l AS (SELECT 'user:' || user_id AS key, CASE event_type WHEN 'error' THEN -1 ELSE 1 END * (event_id + 1) AS pos, event_type || ' ' || event_id AS item FROM events),
n AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY key) AS size FROM l WINDOW w AS (PARTITION BY key ORDER BY pos))
SELECT 'first3' AS what, key, i AS position, item FROM n WHERE i <= 2
UNION ALL SELECT 'last2', key, i, item FROM n WHERE i >= size - 2 UNION ALL SELECT 'popped', key, 0, item FROM n WHERE i = 0
UNION ALL SELECT 'second', key, 0, item FROM n WHERE i = 1""")
def kv_list_table(t: Tables) -> DataFrame:
    """A list per user from pushes to both ends: its ends, a pop, and the head after it."""
    log = t.events.select(
        (F.col("event_id") + 1).alias("seq"), F.when(F.col("event_type") == "error", "lpush").otherwise("rpush").alias("op"),
        user_key(t).alias("key"), F.concat_ws(" ", "event_type", "event_id").alias("item"))
    items = lists.from_pushes(log)
    popped, rest = lists.pop(items)
    parts = {
        "first3": lists.item_range(items, 0, 2), "last2": lists.item_range(items, -2, -1),
        "popped": popped.withColumn("position", F.lit(0)), "second": lists.item_range(rest, 0, 0),
    }
    out = None
    for what, df in parts.items():
        one = df.select(F.lit(what).alias("what"), "key", F.col("position").cast("bigint").alias("position"), "item")
        out = one if out is None else out.unionByName(one)
    return out


@query("kv_set_ops", """
WITH s AS (SELECT DISTINCT strftime(ts, 'day:%Y-%m-%d') AS key, 'user:' || user_id AS m FROM events),
a AS (SELECT m FROM s WHERE key = 'day:2024-01-10'), b AS (SELECT m FROM s WHERE key = 'day:2024-01-20')
SELECT 'inter' AS op, m AS member FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT 'union', m FROM (SELECT * FROM a UNION SELECT * FROM b)
UNION ALL SELECT 'diff', m FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'members', m FROM a
UNION ALL SELECT 'size:' || key, CAST(count(*) AS VARCHAR) FROM s GROUP BY key""")
def kv_set_ops(t: Tables) -> DataFrame:
    """The users of each day as sets: intersection, union, difference and members of two of them, sizes of all."""
    day = F.concat(F.lit("day:"), F.date_format("ts", "yyyy-MM-dd"))
    sets = t.events.select(day.alias("key"), user_key(t).alias("member")).distinct()
    sizes = kv.cardinality(sets).select(
        F.concat(F.lit("size:"), F.col("key")).alias("op"), F.col("size").cast("string").alias("member"))
    a, b = "day:2024-01-10", "day:2024-01-20"
    parts = {
        "inter": kv.intersection(sets, a, b), "union": kv.union(sets, a, b),
        "diff": kv.difference(sets, a, b), "members": kv.members(sets, a),
    }
    for op, df in parts.items():
        sizes = sizes.unionByName(df.withColumn("op", F.lit(op)))
    return sizes


@query("kv_set_move", """
WITH log AS (SELECT event_id AS seq, user_id AS m, CASE event_type WHEN 'signup' THEN 'add' WHEN 'error' THEN 'rem' WHEN 'purchase' THEN 'move' END AS op
  FROM events WHERE event_type IN ('signup', 'error', 'purchase')),
tr AS (SELECT *, lag(op) OVER (PARTITION BY m ORDER BY seq) AS before FROM log),
st AS (SELECT m, arg_max(op, seq) AS op FROM log GROUP BY 1)
SELECT 'online' AS key, 'user:' || m AS member FROM st WHERE op = 'add'
UNION ALL SELECT DISTINCT 'buyers', 'user:' || m FROM tr WHERE op = 'move' AND before = 'add'""")
def kv_set_move(t: Tables) -> DataFrame:
    """Sign-ups go online, errors drop out, purchases move those online to the buyers."""
    kind = F.col("event_type")
    log = t.events.where(kind.isin("signup", "error", "purchase")).select(
        F.col("event_id").alias("seq"),
        F.when(kind == "signup", "add").when(kind == "error", "rem").otherwise("move").alias("op"),
        F.lit("online").alias("key"), user_key(t).alias("member"), F.lit("buyers").alias("target"),
    )
    return kv.set_state_with_moves(log)


@query("kv_set_move_chain", """
WITH log AS (SELECT event_id AS seq, user_id AS m, event_type FROM events WHERE event_type IN ('signup', 'view', 'purchase')),
tr AS (SELECT *, max(seq) FILTER (event_type = 'signup') OVER (PARTITION BY m ORDER BY seq) AS s, lag(event_type) OVER w AS p1 FROM log WINDOW w AS (PARTITION BY m ORDER BY seq)),
run AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY m ORDER BY seq) AS r FROM tr),
first AS (SELECT m, r, min(seq) FILTER (event_type = 'view') AS v FROM run WHERE r > 0 GROUP BY m, r),
moved AS (SELECT m, min(v) AS seq FROM first WHERE v IS NOT NULL GROUP BY m),
buys AS (SELECT run.m, run.seq FROM run WHERE event_type = 'purchase'),
views AS (SELECT m, v AS seq, 1 AS arrive FROM first WHERE v IS NOT NULL),
seen AS (SELECT m, seq, 'a' AS what FROM views UNION ALL SELECT m, seq, 'p' FROM buys),
taken AS (SELECT m, what, lag(what) OVER (PARTITION BY m ORDER BY seq) AS before, row_number() OVER (PARTITION BY m ORDER BY seq DESC) AS back FROM seen),
online AS (SELECT first.m FROM first JOIN (SELECT m, max(r) AS r FROM run GROUP BY m) USING (m, r) WHERE v IS NULL)
SELECT 'online' AS key, 'user:' || m AS member FROM online
UNION ALL SELECT 'viewers', 'user:' || m FROM taken WHERE back = 1 AND what = 'a'
UNION ALL SELECT DISTINCT 'buyers', 'user:' || m FROM taken WHERE what = 'p' AND before = 'a'""")
def kv_set_move_chain(t: Tables) -> DataFrame:
    """Sign-ups go online, a view moves those online to the viewers, a purchase moves viewers to the buyers."""
    kind = F.col("event_type")
    log = t.events.where(kind.isin("signup", "view", "purchase")).select(
        F.col("event_id").alias("seq"), F.when(kind == "signup", "add").otherwise("move").alias("op"),
        F.when(kind == "purchase", "viewers").otherwise("online").alias("key"), user_key(t).alias("member"),
        F.when(kind == "purchase", "buyers").otherwise("viewers").alias("target"),
    )
    return kv.set_state_with_moves(log)


@query("kv_zadd", """
WITH log AS (SELECT event_id AS seq, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events WHERE event_type IN ('signup', 'purchase', 'error')),
b AS (SELECT user_id, max(seq) FILTER (event_type IN ('signup', 'error')) AS base FROM log GROUP BY 1)
SELECT 'board' AS key, 'user:' || user_id AS member, CAST(sum(value) FILTER (event_type <> 'error') AS DOUBLE) AS score FROM log JOIN b USING (user_id)
WHERE base IS NULL OR seq >= base GROUP BY 2 HAVING count(*) FILTER (event_type <> 'error') > 0""")
def kv_zadd(t: Tables) -> DataFrame:
    """A board where sign-ups set a score, purchases add to it and errors remove the member."""
    op = F.when(F.col("field") == "signup", "zadd").when(F.col("field") == "purchase", "zincrby").when(F.col("field") == "error", "zrem")
    log = writes(t).select("seq", op.alias("op"), F.lit("board").alias("key"), F.col("key").alias("member"), F.col("value").alias("score"))
    return kv.replay_scores(log.where(F.col("op").isNotNull()))


NUMBER_TEXT = "regexp_replace(regexp_replace(CAST({0} AS VARCHAR), '([.][0-9]*?)0+$', '\\1'), '[.]$', '')"


@query("kv_replay_mixed", f"""
WITH e AS (SELECT event_id AS seq, 'user:' || user_id AS key, event_type AS op, CAST(value AS DECIMAL(18,2)) AS v FROM events),
dead AS (SELECT key, max(seq) AS d FROM e WHERE op = 'error' GROUP BY key),
a AS (SELECT e.* FROM e LEFT JOIN dead USING (key) WHERE d IS NULL OR seq > d)
SELECT key, 'hash' AS kind, 'last' AS item, CAST(arg_max(v, seq) AS VARCHAR) AS value FROM a WHERE op = 'view' GROUP BY key
UNION ALL SELECT key || ':pages', 'set', 'p' || (seq % 3), NULL FROM e WHERE op = 'click' GROUP BY 1, 3
UNION ALL SELECT 'board', 'zset', key, {NUMBER_TEXT.format('sum(v)')} FROM e WHERE op = 'purchase' GROUP BY key
UNION ALL SELECT key || ':visits', 'string', NULL, CAST(count(*) AS VARCHAR) FROM e WHERE op = 'signup' GROUP BY key""")
def kv_replay_mixed(t: Tables) -> DataFrame:
    """A log that mixes hashes, sets, boards and counters; errors delete the user's hash."""
    kind, key = F.col("event_type"), user_key(t)
    pairs = {"view": "hset", "click": "sadd", "purchase": "zincrby", "signup": "incr", "error": "del"}
    op = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in pairs.items()])
    named = F.when(kind == "click", F.concat(key, F.lit(":pages"))).when(kind == "purchase", F.lit("board")).when(
        kind == "signup", F.concat(key, F.lit(":visits"))).otherwise(key)
    item = F.when(kind == "view", "last").when(kind == "click", F.concat(F.lit("p"), (F.col("event_id") % 3).cast("string"))).when(kind == "purchase", key)
    value = F.when(kind == "signup", F.lit("1")).otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    log = t.events.select(F.col("event_id").alias("seq"), op.alias("op"), named.alias("key"), item.alias("item"), value.alias("value"))
    return commands.replay(log.where(F.col("op").isNotNull())).drop("pos")


def tasks(t: Tables) -> DataFrame:
    """Events as commands on three lists: clicks and views push at the two ends, purchases and errors take from them."""
    kind = F.col("event_type")
    op = F.when(kind == "click", "rpush").when(kind == "view", "lpush").when(kind == "purchase", "lpop").when(kind == "error", "rpop")
    return t.events.select(
        F.col("event_id").alias("seq"), op.alias("op"), F.concat(F.lit("tasks:"), (F.col("user_id") % 3).cast("string")).alias("key"),
        user_key(t).alias("item"),
    ).where(F.col("op").isNotNull())


#: Both ends of every list as running totals over the commands that find something.
TAPE_SQL = """c AS (
  SELECT event_id AS seq, 'tasks:' || (user_id % 3) AS key, 'user:' || user_id AS item, event_type IN ('click', 'view') AS push,
         CASE event_type WHEN 'click' THEN 'rpush' WHEN 'view' THEN 'lpush' WHEN 'purchase' THEN 'lpop' ELSE 'rpop' END AS op
  FROM events WHERE event_type IN ('click', 'view', 'purchase', 'error')
), balance AS (SELECT *, sum(CASE WHEN push THEN 1 ELSE -1 END) OVER (PARTITION BY key ORDER BY seq) AS b FROM c),
found AS (
  SELECT *, push OR b >= coalesce(least(0, min(b) OVER (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 0) AS finds FROM balance
), ends AS (
  SELECT *, sum(CASE op WHEN 'lpush' THEN -1 WHEN 'lpop' THEN 1 ELSE 0 END) OVER w AS l,
         sum(CASE op WHEN 'rpush' THEN 1 WHEN 'rpop' THEN -1 ELSE 0 END) OVER w AS r
  FROM found WHERE finds WINDOW w AS (PARTITION BY key ORDER BY seq)
), tape AS (
  SELECT *, CASE op WHEN 'lpush' THEN l WHEN 'lpop' THEN l - 1 WHEN 'rpush' THEN r - 1 ELSE r END AS slot FROM ends
)"""


@query("kv_queue_replay", f"""
WITH {TAPE_SQL}, taken AS (SELECT *, lag(item) OVER (PARTITION BY key, slot ORDER BY seq) AS got FROM tape)
SELECT seq, c.op, c.key, got AS item FROM c LEFT JOIN (SELECT seq, got FROM taken) USING (seq) WHERE NOT push""")
def kv_queue_replay(t: Tables) -> DataFrame:
    """What every pop of three long lists takes; NULL where the list was empty."""
    return queues.taken(queues.placed(tasks(t)))


@query("kv_queue_left", f"""
WITH {TAPE_SQL}, last AS (SELECT key, slot, arg_max(push, seq) AS held, arg_max(item, seq) AS item FROM tape GROUP BY key, slot)
SELECT key, row_number() OVER (PARTITION BY key ORDER BY slot) - 1 AS position, item FROM last WHERE held""")
def kv_queue_left(t: Tables) -> DataFrame:
    """What is left in the three lists, in order."""
    return lists.item_range(queues.remaining(queues.placed(tasks(t))), 0, -1).select("key", "position", "item")


@query("kv_replay_log_full", """
WITH e AS (SELECT event_id AS seq, user_id AS u, event_type AS op, value FROM events),
span AS (
  SELECT *, count(*) FILTER (op IN ('error', 'signup')) OVER (PARTITION BY u ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM e
), cut AS (
  SELECT u, s, seq, op, EXISTS (SELECT 1 FROM span x WHERE x.u = span.u AND x.s = span.s AND x.op = 'click') AS there FROM span WHERE op IN ('error', 'signup')
), member AS (SELECT u, max(s) AS s FROM cut WHERE op = 'signup' AND there GROUP BY u),
last AS (SELECT u, count(*) FILTER (op IN ('error', 'signup')) AS s FROM e GROUP BY u),
own AS (
  SELECT 'user:' || u || ':pages' AS key, seq, op, value FROM span JOIN last USING (u, s) WHERE op IN ('click', 'purchase')
  UNION ALL SELECT 'member:' || u, seq, op, value FROM span JOIN member USING (u, s) WHERE op IN ('click', 'purchase')
), balance AS (SELECT *, sum(CASE op WHEN 'click' THEN 1 ELSE -1 END) OVER (PARTITION BY key ORDER BY seq) AS b FROM own),
found AS (
  SELECT *, b < coalesce(least(0, min(b) OVER (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 0) AS none FROM balance
), pushed AS (SELECT key, seq, row_number() OVER (PARTITION BY key ORDER BY seq) AS k FROM found WHERE op = 'click'),
taken AS (SELECT key, count(*) FILTER (op = 'purchase' AND NOT none) AS n FROM found GROUP BY key)
SELECT key, 'list' AS kind, 'page' || seq AS item, k - n - 1 AS position, CAST(NULL AS VARCHAR) AS value FROM pushed JOIN taken USING (key) WHERE k > n
UNION ALL SELECT 'last:' || u, 'string', NULL, NULL, 'saw ' || arg_max(seq, seq) FROM e WHERE op = 'view' GROUP BY u""")
def kv_replay_log_full(t: Tables) -> DataFrame:
    """A log with lists, texts, deletions and changes of names: on signing up, a user's pages become the member's."""
    kind, pages = F.col("event_type"), F.concat(user_key(t), F.lit(":pages"))
    pairs = {"click": "rpush", "view": "set", "purchase": "lpop", "signup": "rename", "error": "del"}
    op = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in pairs.items()])
    item = F.when(kind == "click", F.concat(F.lit("page"), F.col("event_id"))).when(kind == "signup", kv.key_of("member", F.col("user_id")))
    log = t.events.select(
        F.col("event_id").alias("seq"), op.alias("op"), F.when(kind == "view", kv.key_of("last", F.col("user_id"))).otherwise(pages).alias("key"),
        item.alias("item"), F.when(kind == "view", F.concat(F.lit("saw "), F.col("event_id"))).alias("value"),
    )
    found = commands.replay(log.where(F.col("op").isNotNull()))
    listed = lists.item_range(found.where("kind = 'list'").withColumn("sub", F.lit(0)), 0, -1)
    rest = found.where("kind <> 'list'").withColumn("position", F.lit(None).cast("bigint"))
    columns = ["key", "kind", "item", "position", "value"]
    return listed.select(columns).unionByName(rest.select(columns))


@query("kv_delete_key", f"SELECT key, field, CAST(value AS DOUBLE) AS value FROM {HASH_SQL} WHERE key NOT IN ('user:2', 'user:3')")
def kv_delete_key(t: Tables) -> DataFrame:
    """All hashes but two that are deleted by key."""
    return kv.delete_key(hashes(t), "user:2", "user:3")


@query("kv_reference_sets", """
WITH p AS (SELECT DISTINCT o_custkey AS c, l_partkey AS m, l_suppkey AS s FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT DISTINCT 'person:' || c || ':movies' AS key, 'movie:' || m AS member FROM p
UNION SELECT DISTINCT 'movie:' || m || ':actors', 'person:' || c FROM p
UNION SELECT DISTINCT 'movie:' || m || ':directors', 'person:' || s FROM p""")
def kv_reference_sets(t: Tables) -> DataFrame:
    """References both ways, one set per role: a person's movies, a movie's actors and directors."""
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey", "l_suppkey")
    person, movie = kv.key_of("person", F.col("o_custkey")), kv.key_of("movie", F.col("l_partkey"))
    roles = F.array(
        F.struct(F.concat(person, F.lit(":movies")).alias("key"), movie.alias("member")),
        F.struct(F.concat(movie, F.lit(":actors")).alias("key"), person.alias("member")),
        F.struct(F.concat(movie, F.lit(":directors")).alias("key"), kv.key_of("person", F.col("l_suppkey")).alias("member")),
    )
    return bought.select(F.inline(roles)).distinct()


@query("kv_leaderboard_top3", f"""
SELECT key, row_number() OVER (PARTITION BY key ORDER BY score DESC, member DESC) AS rank, member, CAST(score AS DOUBLE) AS score
FROM {SCORE_SQL} QUALIFY rank <= 3""")
def kv_leaderboard_top3(t: Tables) -> DataFrame:
    return kv.leaderboard(scores(t), 3)


@query("kv_zrank", f"""
SELECT key, member, CAST(score AS DOUBLE) AS score, row_number() OVER (PARTITION BY key ORDER BY score, member) - 1 AS rank,
  row_number() OVER (PARTITION BY key ORDER BY score DESC, member DESC) - 1 AS revrank FROM {SCORE_SQL}""")
def kv_zrank(t: Tables) -> DataFrame:
    return kv.zrank(scores(t))


@query("kv_zrange", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score, member) - 1 AS position, count(*) OVER (PARTITION BY key) AS n FROM {SCORE_SQL})
SELECT 'low' AS side, key, member, position FROM r WHERE position BETWEEN 0 AND 2
UNION ALL SELECT 'end', key, member, position FROM r WHERE position BETWEEN n - 3 AND n - 1""")
def kv_zrange(t: Tables) -> DataFrame:
    """The three lowest members by index from the start, and the three last by index from the end."""
    zset = scores(t)
    low = kv.zrange(zset, 0, 2).withColumn("side", F.lit("low"))
    end = kv.zrange(zset, -3, -1).withColumn("side", F.lit("end"))
    return low.unionByName(end).select("side", "key", "member", "position")


@query("kv_zscore", f"""
SELECT 'purchase' AS key, 'user:' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS member, CAST(score AS DOUBLE) AS score
FROM customer LEFT JOIN {SCORE_SQL} z ON z.key = 'purchase' AND z.member = 'user:' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')""")
def kv_zscore(t: Tables) -> DataFrame:
    asked = t.customer.select(
        F.lit("purchase").alias("key"), kv.key_of("user", F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("member"))
    return kv.zscore(scores(t), asked)


@query("kv_ttl_live", f"""
WITH s AS (SELECT user_id, CASE WHEN arg_max(event_type, event_id) <> 'signup' THEN max(ts) + INTERVAL 6 HOUR END AS expires_at,
    CASE WHEN user_id = 2 THEN 'user:two' ELSE 'user:' || user_id END AS key FROM events GROUP BY user_id)
SELECT 'user:' || c_custkey AS key, CAST(CASE WHEN s.user_id IS NULL OR s.expires_at <= TIMESTAMP '{AS_OF}' THEN -2
  WHEN s.expires_at IS NULL THEN -1 ELSE floor(epoch(s.expires_at)) - floor(epoch(TIMESTAMP '{AS_OF}')) END AS BIGINT) AS ttl
FROM customer LEFT JOIN s ON s.key = 'user:' || c_custkey""")
def kv_ttl_live(t: Tables) -> DataFrame:
    """Remaining time of every customer's session key; one key was renamed, sign-ups never expire."""
    sessions = t.events.groupBy(user_key(t).alias("key")).agg(
        F.max("ts").alias("last"), F.max_by("event_type", "event_id").alias("kind"))
    ends = F.when(F.col("kind") != "signup", F.col("last") + F.expr("INTERVAL 6 HOURS"))
    store = kv.rename_key(sessions.select("key", ends.alias("expires_at")), "user:2", "user:two")
    asked = t.customer.select(kv.key_of("user", F.col("c_custkey")).alias("key"))
    return kv.ttl(store, asked, F.lit(AS_OF).cast("timestamp_ntz"))


@query("kv_replay_log", """
WITH log AS (SELECT event_id AS seq, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events WHERE event_type IN ('signup', 'purchase', 'error')),
b AS (SELECT user_id, max(seq) FILTER (event_type IN ('signup', 'error')) AS base FROM log GROUP BY 1)
SELECT 'user:' || user_id AS key, CAST(sum(value) FILTER (event_type <> 'error') AS DOUBLE) AS value FROM log JOIN b USING (user_id)
WHERE base IS NULL OR seq >= base GROUP BY 1 HAVING count(*) FILTER (event_type <> 'error') > 0""")
def kv_replay_log(t: Tables) -> DataFrame:
    """Balances after replaying the event log: sign-ups set, purchases add, errors delete."""
    op = F.when(F.col("field") == "signup", "set").when(F.col("field") == "purchase", "incr").when(
        F.col("field") == "error", "del")
    log = writes(t).select("seq", op.alias("op"), "key", "value").where(F.col("op").isNotNull())
    return kv.replay(log, ["key"])


@query("kv_last_write", f"SELECT key, field, CAST(value AS DOUBLE) AS value FROM {HASH_SQL}")
def kv_last_write(t: Tables) -> DataFrame:
    return hashes(t)


@query("kv_running_counter", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, sum(CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN -1 ELSE 0 END) AS change FROM events GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS day, CAST(change AS BIGINT) AS change, CAST(sum(change) OVER (ORDER BY day) AS BIGINT) AS counter FROM d""")
def kv_running_counter(t: Tables) -> DataFrame:
    """A maintained counter: its changes per day and its value after each day."""
    step = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "error", -1).otherwise(0)
    days = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.sum(step).alias("change"))
    # One row per calendar day is left here, so a single window over all of them is small.
    return days.withColumn("counter", F.sum("change").over(Window.orderBy("day")))


@query("kv_reference_join", """
SELECT DISTINCT c_name AS name, p_name || ' #' || p_partkey AS title FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey""")
def kv_reference_join(t: Tables) -> DataFrame:
    """Entity hashes and reference sets in one key space; the person is read from the set's key."""
    people = kv.wide_to_hash(t.customer.withColumnRenamed("c_name", "name"), kv.key_of("person", F.col("c_custkey")), ["name"])
    titled = t.part.withColumn("title", F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")))
    movies = kv.wide_to_hash(titled, kv.key_of("movie", F.col("p_partkey")), ["title"])
    entities = insert(people, movies)
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = bought.select("o_custkey", "l_partkey").distinct()
    references = pairs.select(
        kv.key_of("person", F.col("o_custkey"), F.lit("movies")).alias("key"),
        kv.key_of("movie", F.col("l_partkey")).alias("member"),
    )
    person = F.concat_ws(":", part_of(F.col("key"), 0), part_of(F.col("key"), 1))
    named = kv.follow(kv.keys(references, "person:*:movies"), entities, person, "name", "name")
    return kv.follow(named, entities, F.col("member"), "title", "title").select("name", "title")


@query("stock_guard", """
SELECT l_partkey AS item, l_orderkey AS orderid, l_linenumber AS line,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) <= p_size AS accepted
FROM lineitem JOIN part ON p_partkey = l_partkey""", bigint=["line"])
def stock_guard(t: Tables) -> DataFrame:
    """Every request for an item, accepted while stock lasts."""
    stock = t.part.select(F.col("p_partkey").alias("item"), F.col("p_size").alias("quantity"))
    requests = t.lineitem.select(
        F.col("l_partkey").alias("item"), F.col("l_shipdate").alias("at"), F.col("l_orderkey").alias("orderid"),
        F.col("l_linenumber").alias("line"), "l_suppkey", "l_extendedprice",
    )
    order = [F.col(c) for c in ("at", "orderid", "line", "l_suppkey", "l_extendedprice")]
    return kv.allocate(requests, stock, "item", order, "quantity").select("item", "orderid", "line", "accepted")


# --- stored for few or very many questions ---------------------------------------


def stored_scores(t: Tables) -> ranked.Ranked:
    return ranked.store(scores(t), fresh_path(t.spark, "scores"), 16)


@query("kv_stored_rank", f"""
WITH r AS (SELECT key, member, score, row_number() OVER (PARTITION BY key ORDER BY score, member) - 1 AS rank, count(*) OVER (PARTITION BY key) AS n FROM {SCORE_SQL}),
asked AS (SELECT DISTINCT event_type AS key, 'user:' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS member FROM events WHERE event_id % 1000 = 7
  UNION SELECT 'view', 'nobody')
SELECT key, member, CAST(score AS DOUBLE) AS score, rank, n - 1 - rank AS revrank FROM asked LEFT JOIN r USING (key, member)""")
def kv_stored_rank(t: Tables) -> DataFrame:
    """Ranks of a few members of a stored board, from the buckets they lie in."""
    member = kv.key_of("user", F.lpad(F.col("user_id").cast("string"), 9, "0"))
    asked = t.events.where("event_id % 1000 = 7").select(F.col("event_type").alias("key"), member.alias("member"))
    nobody = t.spark.createDataFrame([("view", "nobody")], "key string, member string")
    return ranked.ranks(stored_scores(t), asked.unionByName(nobody))


@query("kv_stored_range", f"""
SELECT key, member, CAST(score AS DOUBLE) AS score, row_number() OVER (ORDER BY score, member) - 1 AS rank FROM {SCORE_SQL} WHERE key = 'view'
QUALIFY rank BETWEEN 40 AND 99""")
def kv_stored_range(t: Tables) -> DataFrame:
    """Ranks 40 to 99 of a stored board."""
    return ranked.rank_range(stored_scores(t), t.spark, "view", 40, 99)


@query("seen_set", """
SELECT event_id, user_id, user_id IN (SELECT user_id FROM events WHERE event_type = 'signup' AND event_id % 4 = 0) AS seen FROM events WHERE event_type = 'purchase'""")
def seen_set(t: Tables) -> DataFrame:
    """Which purchases come from users of a stored set: a filter settles most of the others."""
    signed = t.events.where("event_type = 'signup' AND event_id % 4 = 0")
    kept = seen.store(signed, "user_id", fresh_path(t.spark, "signed"), 8)
    bought = t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id")
    yes, no = seen.split(kept, bought, "user_id")
    return yes.withColumn("seen", F.lit(True)).unionByName(no.withColumn("seen", F.lit(False)))
