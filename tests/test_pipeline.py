import json
import math
import random

import pytest
from pyspark.sql import functions as F

from brindle import sinks
from brindle.functions.casts import cast_for_load
from brindle.functions.dates import calendar, minute_of_day
from brindle.functions.geo import haversine_km
from brindle.operators import pipeline as p
from brindle.operators import sampling, sessions
from brindle.operators import nearest as operators_nearest
from brindle.operators.nearest import nearest, nearest_k
from brindle.session import fresh_path
from brindle.sources import files
from tests.conftest import rows

CHARACTERS = {
    "first": {"race": ["halfling", "tiefling", "dragonborn"], "name": ["Derek", "Sandra", "Fred"]},
    "second": {"attributes": [[8, 13], [15, 15], [9, 7]]},
    "third": {"spells": [["ice-storm", "light"], []]},
}


def test_parallel_arrays_from_files(spark, tmp_path):
    for name, content in CHARACTERS.items():
        (tmp_path / f"{name}_node.json").write_text(json.dumps(content))
    (tmp_path / "second_note.json").write_text('{"race": ["ignored"]}')
    schema = "race array<string>, name array<string>, attributes array<array<int>>, spells array<array<string>>"
    docs = files.read_json_documents(spark, str(tmp_path / "*_node.json"), schema)
    assert [r.source.rsplit("/", 1)[1] for r in docs.orderBy("source").collect()] == ["first_node.json", "second_node.json", "third_node.json"]
    merged = files.merge_arrays(docs, ["race", "name", "attributes", "spells"]).orderBy("pos").collect()
    assert [tuple(r)[1:] for r in merged] == [
        ("halfling", "Derek", [8, 13], ["ice-storm", "light"]), ("tiefling", "Sandra", [15, 15], []), ("dragonborn", "Fred", [9, 7], None)]


def test_csv_with_mark_and_na(spark, tmp_path):
    path = tmp_path / "countries.csv"
    path.write_bytes("﻿country,latitude,longitude,name\nNA,-22.95764,18.49041,Namibia\nAD,42.546245,1.601554,Andorra\n".encode())
    found = files.read_csv(spark, str(path), "country string, latitude double, longitude double, name string")
    assert rows(found, "country", "name") == [("AD", "Andorra"), ("NA", "Namibia")]


def test_csv_round_trip_keeps_quotes(spark):
    df = spark.createDataFrame([(1, 'say "hi", you'), (2, None), (3, "two\\lines")], "id int, t string")
    back = files.read_csv(spark, sinks.write_csv(df, fresh_path(spark, "t")), "id int, t string")
    assert rows(back) == rows(df)


def test_positional_threshold_skips_the_header(spark):
    lines = spark.createDataFrame([("id", "modified"), ("a", "10"), ("b", "11"), ("c", "x")], "_c0 string, _c1 string")
    assert rows(p.after_epoch(lines, 1, 10)) == [("b", "11")]


def test_interval_is_closed(spark):
    df = spark.range(10).withColumnRenamed("id", "modified")
    assert rows(p.in_interval(df, "modified", 3, 5)) == [(3,), (4,), (5,)]


def test_split_and_guard(spark):
    sheet = spark.createDataFrame([("It's", "O'Neil", 1), ("a,b", "O'Neil", 2)], "piece string, composer string, modified int")
    pieces, composers = p.split_sheet(sheet, ["piece"], "composer")
    assert rows(pieces) == [("Its",), ("ab",)] and rows(composers) == [("ONeil",)]
    with pytest.raises(ValueError):
        p.reject_empty(sheet.limit(0), "rows")
    assert not p.is_positive(sheet.limit(0), "modified") and p.is_positive(sheet, "modified")


def test_positional_merge_pads(spark):
    a = spark.createDataFrame([("x",), ("y",), ("z",)], "a string")
    b = spark.createDataFrame([(1,), (2,)], "b int")
    merged = p.positional_merge({"a": (a, [F.col("a")]), "b": (b, [F.col("b").desc()])})
    assert rows(merged) == [(0, "x", 2), (1, "y", 1), (2, "z", None)]


def test_trend(spark):
    runs = spark.createDataFrame([(1, 30.0), (2, 31.0), (3, 31.0), (4, 20.0)], "run int, average double")
    assert [r.direction for r in p.trend(runs, "run", "average").orderBy("run").collect()] == ["first", "increasing", "same", "decreasing"]


def test_record_set(spark):
    df = spark.createDataFrame([(1, '[{"name": "France", "lat": 46}, {"name": "Japan", "lat": 36}]'), (2, "[]")], "id int, j string")
    assert rows(files.record_set(df, "j", "name string, lat double")) == [(1, "France", 46.0), (1, "Japan", 36.0)]


def test_family_replacement(spark):
    base = fresh_path(spark, "family")
    sinks.replace_all(spark, {"a": spark.range(3), "b": spark.range(5)}, base)
    now = sinks.replace_all(spark, {"a": spark.range(7), "b": spark.range(1)}, base)
    assert (now["a"].count(), now["b"].count()) == (7, 1)
    assert sinks.empty_all(spark, base, ["a", "b"])["a"].count() == 0
    assert sinks.read_current(spark, base, ["b"])["b"].count() == 0


def test_scratch_is_cleared(spark):
    import os

    from brindle import session

    session.clear_scratch(spark)
    copy = session.materialize(spark.range(5))
    assert copy.count() == 5
    folder = copy.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder) and session.clear_scratch(spark) == 1 and not os.path.exists(folder)


def test_load_types(spark):
    df = spark.sql("SELECT 1 AS i, 1.5D AS d, DATE '2024-01-01' AS day, 'x' AS s, TIMESTAMP '2024-01-01 00:00:00' AS at")
    assert [f.dataType.simpleString() for f in cast_for_load(df).schema] == ["int", "decimal(18,2)", "date", "string", "timestamp_ntz"]


def test_dates(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ '2025-09-18 13:45:00' AS t").select(
        *[c.alias(n) for n, c in calendar(F.col("t")).items()], minute_of_day(F.col("t")).alias("m")).first()
    assert tuple(row) == (2025, 3, 9, 18, "Thursday", 825)


def _km(a, b):
    (la, lo), (lb, lp) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(h))


def test_distance(spark):
    here, there = (59.437, 24.7536), (58.3776, 26.729)
    got = spark.range(1).select(haversine_km(*[F.lit(x) for x in (*here, *there)]).alias("km")).first().km
    assert got == pytest.approx(_km(here, there)) and 160 < got < 170


@pytest.fixture
def globe(spark):
    rng = random.Random(3)
    # A dense town, one yard with more places than a cell holds, places all over, the poles, both sides of the date line.
    places = [(59 + rng.random() / 100, 24 + rng.random() / 100) for _ in range(300)]
    places += [(10 + rng.random() / 1e6, 20 + rng.random() / 1e6) for _ in range(100)]
    places += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)] + [(90.0, 0.0), (0.0, 179.99), (0.0, -179.99)]
    places += [(0.0, 0.0)] * 90  # one spot
    points = [(59 + rng.random() / 50, 24 + rng.random() / 50) for _ in range(60)] + [(10.0, 20.0), (0.0, 0.0)]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)] + [(-90.0, 10.0), (0.0, 180.0), (89.9, 170.0)]
    points += points[:3]  # positions that repeat
    pl = spark.createDataFrame([(i, *x) for i, x in enumerate(places)], "place int, lat double, lon double")
    pt = spark.createDataFrame([(i, *x) for i, x in enumerate(points)], "id int, lat double, lon double")
    return pt, pl, points, places


def _sphere(a):
    lat, lon = map(math.radians, a)
    return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)


@pytest.mark.parametrize("k", [1, 4, 95])
def test_nearest_equals_brute_force(globe, k):
    pt, pl, points, places = globe
    spots = [_sphere(p) for p in places]
    expected = []
    for i, a in enumerate(map(_sphere, points)):
        far = sorted((sum((x - y) ** 2 for x, y in zip(a, s)), j) for j, s in enumerate(spots))
        expected += [(i, r + 1, j) for r, (_, j) in enumerate(far[:k])]
    assert sorted(tuple(r) for r in nearest_k(pt, pl, k).select("id", "rank", "place").collect()) == sorted(expected)
    if k == 1:
        assert sorted(tuple(r) for r in nearest(pt, pl).select("id", "place").collect()) == [(i, j) for i, _, j in sorted(expected)]


def test_few_cells_are_opened_for_a_position(globe):
    """A position ends with a handful of cells, not with all of them."""
    pt, pl, points, _ = globe
    spots, tree = operators_nearest._grown(operators_nearest._positioned(pl), 1)
    cells = operators_nearest._descended(operators_nearest._positioned(pt.select("lat", "lon").distinct()), tree, 1)
    assert tree.where("NOT inner").count() > 50
    assert cells.count() < 12 * len(set(points))
    assert spots.count() == pl.select("lat", "lon").distinct().count()


def test_places_are_met_as_lists(globe):
    """A position meets a row for each list of places, not for each place; lists are short, also where many places lie close."""
    pt, pl, _, _ = globe
    spots, tree = operators_nearest._grown(operators_nearest._positioned(pl), 4)
    lists = operators_nearest._listed(spots, tree, ["place"])
    sizes = [len(r.places) for r in lists.collect()]
    assert sum(sizes) == spots.count() and max(sizes) < 2 * operators_nearest.CAPACITY
    assert len(sizes) < tree.where("NOT inner").count() + 4
    few = pl.where("place < 25")
    met = operators_nearest._best(pt, few, 1)
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_nearest_k_without_enough_places(spark):
    places = spark.createDataFrame([("p", 1.0, 1.0), ("q", 40.0, 10.0), ("lost", None, 3.0), ("nan", float("nan"), 3.0)], "name string, lat double, lon double")
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0), (3, float("nan"), 0.0), (None, 0.0, 0.0)], "id int, lat double, lon double")
    got = nearest_k(points, places, 3).select("id", "rank", "name").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, r, n) for i in (1, None) for r, n in ((1, "p"), (2, "q"))], key=str)
    assert nearest_k(points, places.limit(0), 3).count() == 0 == nearest_k(points.limit(0), places, 3).count()
    with pytest.raises(ValueError):
        nearest_k(points, places, 0)


def test_sessions_equal_brute_force(spark):
    rng = random.Random(5)
    data = sorted((rng.choice([1, 1, 1, 2, 3]), rng.randint(0, 40_000)) for _ in range(400))
    events = spark.createDataFrame([(i, u, s) for i, (u, s) in enumerate(data)], "id int, user int, s long").withColumn("ts", F.timestamp_seconds("s"))
    fresh, open_sessions, last = [], {}, {}
    for i, (u, s) in enumerate(data):
        if u not in last or s - last[u] > 600:
            fresh.append(i)
            open_sessions.setdefault(u, []).append([s, s, 0])
        now = open_sessions[u][-1]
        now[1], now[2] = s, now[2] + 1
        last[u] = s
    assert rows(sessions.first_sightings(events, "user", "ts", "id", 600)) == sorted([(i,) for i in fresh], key=str)
    assert sessions.seen_within(events, "user", "ts", "id", 600).count() == len(data) - len(fresh)
    found = sessions.presence(events, "user", "ts", "id", 600)
    expected = [(u, n + 1, a * 10**6, b * 10**6, c) for u, ss in open_sessions.items() for n, (a, b, c) in enumerate(ss)]
    assert rows(found) == sorted(expected, key=str)


def test_sampling_repeats(spark):
    df = spark.range(100)
    one = rows(sampling.random_rows(df, "id", 5, 1))
    assert len(set(one)) == 5 and one == rows(sampling.random_rows(df, "id", 5, 1)) and one != rows(sampling.random_rows(df, "id", 5, 2))
    nouns = spark.createDataFrame([("cloud",), ("whale",), ("cloud",), (None,)], "word string")
    one = lambda w: spark.createDataFrame([(w,)], "word string")
    said = sampling.sentences(spark.range(50), "id", one("a red"), nouns, one("eats"))
    assert {r.sentence for r in said.collect()} == {f"A red {a} eats a red {b}" for a in ("cloud", "whale") for b in ("cloud", "whale")}
    assert said.count() == 50
