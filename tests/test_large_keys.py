import pytest
from pyspark.sql import functions as F

from loomgraph.operators import layouts
from loomgraph.queries import QUERIES
from loomgraph.sources import tables

KEYS = [0, tables.STRIDE - 1, tables.STRIDE, tables.STRIDE + 5]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of which orders, documents and events have a few rows with small and large keys, and the rest none."""
    out = tmp_path_factory.mktemp("large")
    key_of = {"orders": "o_orderkey", "documents": "doc_id", "events": "event_id"}
    for name, schema in tables.SCHEMAS.items():
        empty = spark.createDataFrame([], schema)
        more = [F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema if f.name != key_of.get(name)]
        frame = spark.createDataFrame([(k,) for k in KEYS], f"{key_of[name]} long").select(key_of[name], *more) if name in key_of else empty
        frame.coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return str(out)


def test_large_keys_have_ids_of_their_own(spark, folder):
    g = tables.graph_of_tables(spark, folder).only(["graph.type"])
    rows = sorted(tuple(r) for r in layouts.typed_triples(g).select("subject", "objectString").collect())
    assert len({s for s, _ in rows}) == len(rows) == 3 * len(KEYS)
    found = layouts.typed_triples(g.subjects([s for s, _ in rows])).select("subject", "objectString")
    assert sorted(tuple(r) for r in found.collect()) == rows


def test_read_plan_has_large_keys(spark, folder):
    assert {r.predicate: r.n for r in QUERIES["read_plan"](spark, folder).collect()} == {"graph.type": 3 * len(KEYS)}


def test_ids_of_small_keys_are_those_of_sql(spark):
    own, sql = (F.expr(f("Event", "k", tables.STRIDE)) for f in (tables._uid, tables.uid_sql))
    assert spark.createDataFrame([(k,) for k in KEYS[:2]], "k long").where(own != sql).count() == 0
    huge = spark.createDataFrame([(1 << 55,)], "k long").select(own.alias("u")).first().u
    assert next(t for t in tables.graph_of_tables(spark, "/root/testdata/sf0.001").node_tables[-1:]).key_of(huge) == 1 << 55
