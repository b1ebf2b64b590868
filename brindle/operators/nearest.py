"""Nearest places to each point on the globe.

Places lie in a tree of cells on the unit sphere; a cell with more than `CAPACITY` places is split, so cells are small
where places are dense. Every distinct position goes down the tree, a level a round, and keeps the cells that may still
hold one of its nearest: a cell is left out once the cells before it are known to hold `k` places that are nearer than
its nearest corner could be. The bounds are those of the places inside, so nothing is lost and no width covers the globe.

Candidates are compared by the straight line through the globe, which grows with the distance on it and costs no
trigonometry per pair. Only the winners' distances are worked out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.geo import haversine_km, on_unit_sphere
from brindle.session import materialize

CAPACITY = 64  # places that a cell holds before it is split
STEP = 2  # bits of each axis that a level adds: up to 64 cells in a cell
LEVELS = 10  # the cells of the last level are 12 m wide and are not split
_AXES = ("_x", "_y", "_z")
_CELL = ("_cx", "_cy", "_cz")
_AT = ["lat", "lon"]


def nearest(points: DataFrame, places: DataFrame) -> DataFrame:
    """Add the nearest place's columns and `km` to each point.

    Both sides have `lat` and `lon`; their other columns have different names. Ties go to the first place in column
    order. A point without a position (NULL or NaN), or without any place to go to, keeps NULL; a place without a
    position is nobody's nearest. Rows of points that repeat stay.
    """
    return points.join(_best(points, places, 1).drop("rank"), _AT, "left").select(*points.columns, *_named(places), "km")


def nearest_k(points: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """A row for each point and each of its `k` nearest places: the point's columns, `rank` from 1, the place's, `km`.

    Positions and ties are treated as by `nearest`. Where there are fewer places than `k`, all come; points without a
    position have no row.
    """
    if k < 1:
        raise ValueError("k is 1 or more")
    return points.join(_best(points, places, k), _AT).select(*points.columns, "rank", *_named(places), "km")


def _named(places: DataFrame) -> list[str]:
    return [c for c in places.columns if c not in _AT]


def _best(points: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """The nearest places of each distinct position of the points: lat, lon, rank, the place's columns, km."""
    spots, tree = _grown(_positioned(places), k)
    open_cells = _descended(_positioned(points.select(*_AT).distinct()), tree, k)
    # Within the cells that are left every place is measured: a list of places at a time, of which only the best go on.
    lists = _listed(spots, tree, _named(places))
    if tree.where("inner").isEmpty():
        lists = F.broadcast(lists)  # one cell, so at most CAPACITY places, and all positions have its key
    chord = lambda p: _squares([F.col(a) - p[a] for a in _AXES]).alias("chord")
    measured = F.transform("places", lambda p: F.struct(chord(p), p["place"].alias("place")))
    best = F.array_min(measured) if k == 1 else F.explode(F.slice(F.sort_array(measured), 1, k))
    met = open_cells.join(lists, ["level", *_CELL]).select(*_AT, best.alias("_best")).select(*_AT, "_best.*")
    order = Window.partitionBy(*_AT).orderBy("chord", "place")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("place._lat"), F.col("place._lon"))
    return ranked.select(*_AT, "rank", *[F.col(f"place.`{c}`") for c in _named(places)], km.alias("km"))


def _positioned(df: DataFrame) -> DataFrame:
    """The rows with a position, and where it is on the unit sphere."""
    known = df.where(~(F.col("lat").isNull() | F.col("lon").isNull() | F.isnan("lat") | F.isnan("lon")))
    return known.withColumns(dict(zip(_AXES, on_unit_sphere(F.col("lat"), F.col("lon")))))


def _cell(axis: str, level: Column) -> Column:
    most = 1 << (STEP * LEVELS)
    finest = F.least(F.floor((F.col(axis) + 1) * (most // 2)), F.lit(most - 1)).cast("int")
    return F.floor(finest / F.pow(F.lit(2.0), STEP * (LEVELS - level))).cast("int")


def _grown(places: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The places with the cell of the tree that holds them, and the cells of the tree with the bounds of their places.

    Of several places at one spot, `k` are enough: the first ones win every tie.
    """
    at_spot = Window.partitionBy(*_AT).orderBy(*[c for c in places.columns if c not in (*_AT, *_AXES)])
    spots = places.withColumn("_nth", F.row_number().over(at_spot)).where(F.col("_nth") <= k).drop("_nth")
    levels = spots.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    levels = levels.withColumns({c: _cell(a, F.col("level")) for c, a in zip(_CELL, _AXES)})
    bounds = [f(a).alias(f"{a}_{side}") for a in _AXES for side, f in (("lo", F.min), ("hi", F.max))]
    cells = levels.groupBy("level", *_CELL).agg(F.count("*").alias("n"), *bounds)
    around = Window.partitionBy("level", *[F.shiftright(c, STEP) for c in _CELL])  # the cells of one cell above
    split = (F.col("level") == 0) | (F.sum("n").over(around) > CAPACITY)
    tree = cells.withColumn("_split", split).where("_split").drop("_split")
    tree = materialize(tree.withColumn("inner", (F.col("n") > CAPACITY) & (F.col("level") < LEVELS)), "tree")
    leaves = tree.where(~F.col("inner")).select("level", *_CELL)
    return levels.join(leaves, ["level", *_CELL]), tree


def _listed(spots: DataFrame, tree: DataFrame, named: list[str]) -> DataFrame:
    """The places of each cell that is not split, as lists of about CAPACITY; a cell of the last level has as many as it takes."""
    cells = tree.where(~F.col("inner")).select("level", *_CELL, F.ceil(F.col("n") / CAPACITY).alias("_lists"))
    place = F.struct(*named, F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).alias("place")
    dealt = spots.join(cells, ["level", *_CELL]).withColumn("_list", F.pmod(F.xxhash64("lat", "lon", *named), F.col("_lists")))
    return dealt.groupBy("level", *_CELL, "_list").agg(F.collect_list(F.struct(*_AXES, place)).alias("places")).drop("_list")


def _squares(steps: list[Column]) -> Column:
    return sum((s * s for s in steps[1:]), steps[0] * steps[0])


def _descended(positions: DataFrame, tree: DataFrame, k: int) -> DataFrame:
    """The cells without cells below them that may hold one of the `k` nearest places of a position."""
    depth = tree.agg(F.max("level").alias("depth")).first()["depth"] or 0  # without places there is no tree
    cells = positions.withColumns({"level": F.lit(0), **{c: F.lit(0) for c in _CELL}, "inner": F.lit(depth > 0)})
    cells = cells.withColumns({"n": F.lit(0).cast("bigint"), "near": F.lit(0.0), "far": F.lit(4.0)})
    cells = materialize(cells, "positions")  # written, since joins on constants would become products
    gaps = [F.greatest(F.col(f"{a}_lo") - F.col(a), F.col(a) - F.col(f"{a}_hi"), F.lit(0.0)) for a in _AXES]
    spans = [F.greatest(F.abs(F.col(a) - F.col(f"{a}_lo")), F.abs(F.col(a) - F.col(f"{a}_hi"))) for a in _AXES]
    by_far = Window.partitionBy(*_AT).orderBy("far", "level", *_CELL)
    whole = Window.partitionBy(*_AT)
    for level in range(1, depth + 1):
        below = tree.where(F.col("level") == level).withColumns({f"{c}_over": F.shiftright(c, STEP) for c in _CELL})
        split = cells.where("inner").select(*_AT, *_AXES, *[F.col(c).alias(f"{c}_over") for c in _CELL])
        opened = split.join(below, [f"{c}_over" for c in _CELL]).withColumns({"near": _squares(gaps), "far": _squares(spans)})
        kept = cells.where(~F.col("inner")).unionByName(opened.select(*cells.columns))
        # The least distance within which whole cells hold k places; a cell that begins beyond it is out.
        bound = kept.withColumn("_enough", F.when(F.sum("n").over(by_far) >= k, F.col("far")))
        bound = bound.withColumn("_enough", F.min("_enough").over(whole))
        cells = materialize(bound.where(F.col("_enough").isNull() | (F.col("near") <= F.col("_enough"))).drop("_enough"), "cells")
    return cells.select(*_AT, *_AXES, "level", *_CELL)
