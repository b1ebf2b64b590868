"""Stored tables that are changed file by file, and sums kept up to date by difference."""

import random

import pytest
from pyspark.sql import functions as F

from brindle import stored
from brindle.operators import delta, star
from brindle.operators import keyspace as kv
from brindle.session import fresh_path
from tests.conftest import rows


def table(spark, n=4000, files=20):
    base = fresh_path(spark, "table")
    stored.create(spark.range(n).select("id", F.concat(F.lit("v"), "id").alias("value")), base, "id", files)
    return base


def test_a_small_change_rewrites_the_files_it_touches(spark):
    base = table(spark)
    before = set(stored._files(spark, base, 0))
    changes = spark.createDataFrame([(k, "new") for k in (5, 6, 7, 8, 9, 1000, 1001, 1002, 9001, 9002)], "id long, value string")
    made = stored.upsert(spark, base, "id", changes)
    assert len(before) == 20 and made.number == 1 and 2 <= made.touched <= 4 and made.kept == 20 - made.touched
    assert len(before & set(stored._files(spark, base, 1))) == made.kept
    now = dict(rows(stored.read(spark, base)))
    assert len(now) == 4002 and now[5] == now[1002] == now[9002] == "new" and now[10] == "v10"
    assert len(rows(stored.read(spark, base, version=0))) == 4000
    assert dict(rows(stored.read(spark, base, version=0)))[5] == "v5"


def test_update_delete_and_keys_that_are_not_there(spark):
    base = table(spark, 300, 6)
    made = stored.update(spark, base, "id", spark.createDataFrame([(3, "x"), (900, "y")], "id long, value string"))
    assert made.touched == 1 and dict(rows(stored.read(spark, base)))[3] == "x"
    made = stored.delete(spark, base, "id", spark.createDataFrame([(4,), (299,), (500,)], "id long"))
    assert made.touched == 2 and stored.read(spark, base).count() == 298
    made = stored.delete(spark, base, "id", spark.createDataFrame([(7000,)], "id long"))
    assert (made.number, made.written, made.kept) == (2, 0, len(stored._files(spark, base, 2)))
    assert stored.vacuum(spark, base, keep=1) == 3 and stored.versions(spark, base) == [2] and stored.read(spark, base).count() == 298


def test_rows_without_a_key_stay_and_changes_need_one(spark):
    base = fresh_path(spark, "table")
    stored.create(spark.createDataFrame([(None, "a"), (1, "b")], "id long, value string"), base, "id", 2)
    for bad in ([(None, "c")], [(1, "c"), (1, "d")]):
        with pytest.raises(ValueError, match="one row for each key"):
            stored.upsert(spark, base, "id", spark.createDataFrame(bad, "id long, value string"))
    stored.upsert(spark, base, "id", spark.createDataFrame([(1, "c")], "id long, value string"))
    assert rows(stored.read(spark, base)) == [(1, "c"), (None, "a")]


def test_a_change_that_fails_leaves_the_old_version(spark, monkeypatch):
    base = table(spark, 100, 4)
    changes = spark.createDataFrame([(1, "new")], "id long, value string")

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(stored, "_commit", fail)  # files are written, but no version names them
    with pytest.raises(RuntimeError, match="lost"):
        stored.upsert(spark, base, "id", changes)
    monkeypatch.undo()
    assert stored.versions(spark, base) == [0] and dict(rows(stored.read(spark, base)))[1] == "v1"
    stored.upsert(spark, base, "id", changes)
    assert dict(rows(stored.read(spark, base)))[1] == "new"
    assert stored.vacuum(spark, base, keep=1) >= 2 and stored.read(spark, base).count() == 100


def test_of_two_changes_to_one_version_one_fails(spark):
    base = table(spark, 100, 4)
    other = spark.createDataFrame([(2, "other")], "id long, value string")

    def meanwhile(rows_):
        stored.upsert(spark, base, "id", other)
        return rows_.withColumn("value", F.lit("mine"))

    with pytest.raises(stored.Conflict):
        stored.rewrite(spark, base, "id", spark.createDataFrame([(1,)], "id long"), meanwhile)
    now = dict(rows(stored.read(spark, base)))
    assert now[2] == "other" and now[1] == "v1"
    with pytest.raises(stored.Conflict):
        stored.create(spark.range(3), base, "id", 1)


def test_changed_keys_count_repeated_rows(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "x"), (5, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "d"), (4, "e"), (None, "y"), (5, None)], "k int, v string")
    assert rows(delta.changed_keys(old, new.select("v", "k"), "k")) == [(1,), (3,), (4,)]
    with pytest.raises(ValueError, match="the old rows have"):
        delta.changed_keys(old, new.drop("v"), "k")


ITEMS = "purchaseid int, productid int, supplierid int, quantity int"


def shop(spark, rng, items, prices, stores):
    return {
        "items": spark.createDataFrame(items, ITEMS),
        "products": spark.createDataFrame([(p, rng_price, f"c{p % 2}") for p, rng_price in prices.items()], "productid int, price int, categoryname string"),
        "purchases": spark.createDataFrame(list(stores.items()), "purchaseid int, storeid int"),
    }


def sales(source):
    return star.fact_sales(source["items"], source["products"], source["purchases"], keep=["categoryname"])


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_by_difference_is_the_full_refresh(spark, seed):
    rng = random.Random(seed)
    items = [(rng.randrange(60), rng.choice([None, *range(12)]), 1, rng.randrange(1, 4)) for _ in range(400)] + [(7, 3, 1, 1)] * 200
    prices, stores = {p: 10 + p for p in range(10)}, {o: o % 4 for o in range(50)}
    after = [r for r in items if r[0] != 11 and rng.random() > 0.05] + [(rng.randrange(70), rng.randrange(14), 1, 5) for _ in range(30)]
    after = [(o, p, s, q + 1) if o == 13 else (o, p, s, q) for o, p, s, q in after]
    more = {**prices, 2: 99, 11: 5}
    del more[4]
    old, new = shop(spark, rng, items, prices, stores), shop(spark, rng, after, more, {**stores, 20: 9, 55: 2})
    by, sums = ["storekey", "categoryname"], ["salesamount"]
    lookups = {"products": ("productid", "productid"), "purchases": ("purchaseid", "purchaseid")}
    changes = delta.signed_changes(sales, old, new, "items", "purchaseid", lookups)
    kept = delta.refreshed(delta.tallied(sales(old), by, sums), changes, by, sums)
    assert rows(kept) == rows(delta.tallied(sales(new), by, sums))
    nothing = delta.signed_changes(sales, new, new, "items", "purchaseid", lookups)
    assert nothing.count() == 0


def test_what_did_not_change_is_not_built_again(spark):
    rng = random.Random(3)
    items = [(o, o % 5, 1, 1) for o in range(300)]
    old = shop(spark, rng, items, {p: 1 for p in range(5)}, {o: 0 for o in range(300)})
    new = shop(spark, rng, [*items, (7, 1, 1, 1)], {p: 1 for p in range(5)}, {o: int(o == 9) for o in range(300)})
    lookups = {"products": ("productid", "productid"), "purchases": ("purchaseid", "purchaseid")}
    changes = delta.signed_changes(sales, old, new, "items", "purchaseid", lookups)
    assert sorted({r.saleid for r in changes.collect()}) == [7, 9] and changes.count() == 5


def test_a_key_pattern_reads_the_row_groups_of_its_head(spark):
    base = fresh_path(spark, "keys")
    names = spark.range(60_000).select(F.concat(F.lit("k"), F.lpad("id", 6, "0"), F.lit(":x")).alias("key"))
    stored.create(names, base, "key", 12)
    found = kv.keys(stored.read(spark, base), "k0123*:x")
    assert "StringStartsWith(key,k0123)" in found._jdf.queryExecution().executedPlan().toString()
    plan = found._jdf.queryExecution().executedPlan()
    assert len(found.collect()) == 100
    # Rows of the row groups that may hold such keys: one or two files of twelve.
    assert 100 <= plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value() <= 15_000
