"""Queries on tables where one key holds a third of the rows, with joins and slabs kept apart."""

import duckdb
import pytest

from brindle import registry, session
from brindle.plans import load_all
from tests.compare import connect, differences

load_all()
SOURCE = "/root/testdata/sf0.001"
HOT = {
    "lineitem": {"l_orderkey": "5", "l_partkey": "7", "l_suppkey": "3"},
    "orders": {"o_custkey": "3"},
    "events": {"user_id": "8"},
    "pages": {"url": "'http://hot.example.com/' || page_id"},
    "customer": {"c_nationkey": "4"},
}
NAMES = [
    "last5_purchases_per_customer", "suppliers_of_product", "orders_without_items", "sales_grouping_sets", "top_suppliers_rank",
    "scd2_point_in_time", "constraint_violations", "doc_embed_unembed", "kv_replay_log", "kv_zrank", "kv_set_move", "kv_exists",
    "stock_guard", "stream_stock_guard", "graph_cast_list", "graph_never_directed", "graph_schema", "graph_detach_delete",
    "seen_within_hour", "presence_sessions", "blacklist_semi_anti",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations"):
        swaps = ", ".join(f"CASE WHEN n % 3 = 0 THEN {v} ELSE {c} END AS {c}" for c, v in HOT.get(name, {}).items())
        replaced = f"* EXCLUDE n REPLACE ({swaps})" if swaps else "* EXCLUDE n"
        rows = f"SELECT *, row_number() OVER () AS n FROM '{SOURCE}/{name}.parquet'"
        con.execute(f"COPY (SELECT {replaced} FROM ({rows})) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def apart(spark):
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    usual = {k: spark.conf.get(k) for k in settings}
    before = dict(session.RUNTIME)
    session.RUNTIME.update(settings)
    yield spark
    session.RUNTIME.clear()
    session.RUNTIME.update(before)
    for k, v in usual.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_hot(apart, folder, name):
    assert name in registry.SQL
    assert differences(apart, connect(folder), name, folder) is None
