"""Every operator of the engine as a query over the supplied tables, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.storage import scratch
from loomgraph.functions.types import KINDS, TYPE_PREDICATE, VALUE_COLUMNS, Predicate, escaped_name, parse_timestamp, rotated_array, uid_from_hex, uid_to_hex
from loomgraph.operators import algorithms, filters, layouts, paging, partitioned, views
from loomgraph.plans import density, partitioner
from loomgraph.plans.catalog import ClusterState, ReservedFilter, Schema
from loomgraph.sources.results import graph_of_results
from loomgraph.sources.stored import register_formats, snapshot, write_graph
from loomgraph.sources.tables import EDGE_TYPES, JOINED, NODE_TYPES, STRIDE, graph_of_tables, schema_of_tables, state_of_tables, uid_sql
from loomgraph.streaming.events import windowed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


# -- the graph in SQL

_SQL_TYPES = {"objectUid": "BIGINT", "objectString": "VARCHAR", "objectLong": "BIGINT", "objectDouble": "DOUBLE", "objectTimestamp": "TIMESTAMP",
              "objectBoolean": "BOOLEAN", "objectGeo": "VARCHAR", "objectPassword": "VARCHAR"}
_COLUMNS = list(VALUE_COLUMNS)


def _values(kind: str, expression: str) -> str:
    tag, own, _ = KINDS[kind]
    return ", ".join(f"CAST({expression if c == own else 'NULL'} AS {_SQL_TYPES[c]}) AS \"{c}\"" for c in _COLUMNS) + f", '{tag}' AS \"objectType\""


def _branches() -> list[str]:
    out = []
    for t in NODE_TYPES:
        subject = uid_sql(t.name, t.key)
        out.append(f"SELECT {subject} AS subject, '{TYPE_PREDICATE}' AS predicate, {_values('string', repr(t.name))} FROM {t.table}")
        for name, kind, column in t.properties:
            out.append(f"SELECT {subject}, '{name}', {_values(kind, column)} FROM {t.table} WHERE {column} IS NOT NULL")
        if t.lang:
            name, column, lang = t.lang
            out.append(f"SELECT {subject}, '{name}@' || {lang}, {_values('string', column)} FROM {t.table} WHERE {column} IS NOT NULL AND {lang} IS NOT NULL")
    for name, kind, owner, table, key, column in JOINED:
        out.append(f"SELECT {uid_sql(owner, key)}, '{name}', {_values(kind, column)} FROM {table} WHERE {column} IS NOT NULL")
    for e in EDGE_TYPES:
        distinct = "DISTINCT " if e.distinct else ""
        out.append(f"SELECT {distinct}{uid_sql(e.source, e.source_key)}, '{e.predicate}', {_values('uid', uid_sql(e.target, e.target_key))} FROM {e.table}")
    return out


_TRIPLES = "triples AS (" + "\nUNION ALL ".join(_branches()) + ")"
_EDGES = "edges AS (SELECT subject, predicate, \"objectUid\" FROM triples WHERE \"objectType\" = 'uid')"
_NODES = "nodes AS (SELECT * EXCLUDE (\"objectUid\") FROM triples WHERE \"objectType\" <> 'uid')"
_PROPERTIES = [p for p in schema_of_tables().properties]
_WIDE = (
    "wide AS (SELECT subject, "
    + ", ".join(f"min(CASE WHEN predicate = '{p.name}' THEN \"{KINDS[p.kind][1]}\" END) AS \"{p.name}\"" for p in _PROPERTIES)
    + " FROM triples WHERE \"objectType\" <> 'uid' GROUP BY subject)"
)
_TEXT = """CASE "objectType" WHEN 'uid' THEN CAST("objectUid" AS VARCHAR) WHEN 'long' THEN CAST("objectLong" AS VARCHAR)
    WHEN 'double' THEN CAST("objectDouble" AS VARCHAR) WHEN 'boolean' THEN CAST("objectBoolean" AS VARCHAR) WHEN 'geo' THEN "objectGeo"
    WHEN 'timestamp' THEN regexp_replace(strftime("objectTimestamp", '%Y-%m-%d %H:%M:%S.%f'), '(\\.\\d+?)0+$', '\\1')
    WHEN 'password' THEN "objectPassword" ELSE "objectString" END"""


def _with(select: str, *parts: str) -> str:
    return f"WITH {', '.join([_TRIPLES, *parts])} {select}"


def query(name: str, sql: str | None = None):
    """Register a query of (graph, spark, folder), and its SQL."""

    def register(f):
        QUERIES[name] = lambda spark, folder: f(graph_of_tables(spark, folder))
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


def _uid(type_name: str, key: int) -> int:
    return next(t.number for t in NODE_TYPES if t.name == type_name) * STRIDE + key + 1


# -- layouts and catalogue

query("triples_typed", _with("FROM triples"))(layouts.typed_triples)
query("triples_string", _with(f"SELECT subject, predicate, {_TEXT} AS \"objectString\", \"objectType\" FROM triples"))(layouts.string_triples)
query("nodes_typed", _with("FROM nodes", _NODES))(layouts.typed_nodes)
query("nodes_wide", _with("FROM wide", _WIDE))(layouts.wide_nodes)
query("edges", _with("FROM edges", _EDGES))(layouts.edges)
query("nodes_from_wide", _with("SELECT * FROM nodes WHERE predicate NOT LIKE '%@%'", _NODES))(lambda g: layouts.unpivoted(g, layouts.wide_nodes(g)))
query(
    "schema_predicates",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{p.name}', '{p.kind}', '{KINDS[p.kind][0]}', {p.lang})" for p in schema_of_tables().by_name.values())
    + ") AS t(predicate, type, tag, lang)",
)(lambda g: g.schema.to_frame(g.spark))
query(
    "node_maps",
    _with(f"""SELECT subject, len(list(DISTINCT predicate)) AS n, string_agg(predicate || '=' || value, ';' ORDER BY predicate) AS pairs
        FROM (SELECT subject, predicate, min({_TEXT}) AS value FROM triples WHERE "objectType" <> 'uid' GROUP BY ALL) GROUP BY subject"""),
)(lambda g: layouts.node_maps(g).select(
    "subject", F.size("properties").cast("long").alias("n"),
    F.array_join(F.transform(F.map_entries("properties"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("pairs"),
))

# -- query results in JSON

_SEEN = Schema.of(
    [Predicate("name", "string"), Predicate("alias", "string", True), Predicate("acctbal", "float"), Predicate("tags", "string"), Predicate("customer.nation", "uid")]
)


def _results(g) -> DataFrame:
    """Customers as a store's results, a report each, with texts and lists that look like one another."""
    uid = lambda kind, key: uid_to_hex(F.expr(uid_sql(kind, key)))
    node = F.struct(
        uid("Customer", "c_custkey").alias("uid"), F.concat(F.lit("[draft] "), "c_name").alias("name"), F.col("c_name").alias("alias@en"),
        F.lit("dropped").alias("other@en"), F.col("c_acctbal").alias("acctbal"), F.array("c_mktsegment", F.concat(F.lit('["'), "c_mktsegment", F.lit('"]'))).alias("tags"),
        F.array(F.struct(uid("Nation", "c_nationkey").alias("uid"))).alias("customer.nation"),
    )
    customers = next(t.table for t in g.node_tables if "mktsegment" in t.columns)
    return customers.select(F.to_json(F.struct(F.array(node).alias("result"))).alias("value"))


_CUSTOMER = uid_sql("Customer", "c_custkey")
query(
    "json_triples",
    f"""SELECT {_CUSTOMER} AS subject, 'name' AS predicate, {_values('string', "'[draft] ' || c_name")} FROM customer
        UNION ALL SELECT {_CUSTOMER}, 'alias@en', {_values('string', 'c_name')} FROM customer
        UNION ALL SELECT {_CUSTOMER}, 'acctbal', {_values('float', 'c_acctbal')} FROM customer WHERE c_acctbal IS NOT NULL
        UNION ALL SELECT {_CUSTOMER}, 'tags', {_values('string', 'c_mktsegment')} FROM customer
        UNION ALL SELECT {_CUSTOMER}, 'tags', {_values('string', """'["' || c_mktsegment || '"]'""")} FROM customer
        UNION ALL SELECT {_CUSTOMER}, 'customer.nation', {_values('uid', uid_sql('Nation', 'c_nationkey'))} FROM customer""",
)(lambda g: layouts.typed_triples(graph_of_results(_results(g), _SEEN)))
query("json_wide", f"SELECT {_CUSTOMER} AS subject, c_acctbal AS acctbal, NULL::VARCHAR AS alias, '[draft] ' || c_name AS name, c_mktsegment AS tags FROM customer")(
    lambda g: layouts.wide_nodes(graph_of_results(_results(g), _SEEN))
)
_REPORT = """{"groups": {"1": {"members": {"1": {"addr": "node1:5080"}}, "tablets": {"a": {"predicate": "0-name"}, "b": {"predicate": "\\u0000\\u0000title"}}},
    "2": {"members": {"2": {"addr": "node2:5080"}, "3": {"addr": "node3:5081"}}, "tablets": {"c": {"predicate": "7-other"}, "d": {"predicate": "size"}}}},
    "maxUID": "10000", "cid": "350fd4f5-771d-4021-8ef9-cd1b79aa6ea0"}"""
query("cluster_state", "FROM (VALUES ('1', 'name', 'node1:7080', 10000), ('1', 'title', 'node1:7080', 10000), ('2', 'size', 'node2:7080,node3:7081', 10000)) AS t(grp, predicate, targets, highest)")(
    lambda g: g.spark.createDataFrame(
        [(k, p, ",".join(sorted(state.members[k])), state.max_uid) for state in [ClusterState.from_json(_REPORT)] for k, names in state.predicates.items() for p in names],
        "grp string, predicate string, targets string, highest int",
    )
)

# -- filters

_ONE, _FEW = _uid("Customer", 5), [_uid("Nation", 3), _uid("Customer", 5), _uid("Order", 7)]
query("filter_subject_eq", _with(f"FROM triples WHERE subject = {_ONE}"))(lambda g: layouts.typed_triples(g.subjects([_ONE])))
query("filter_subject_in", _with(f"FROM triples WHERE subject IN ({', '.join(map(str, _FEW))})"))(lambda g: layouts.typed_triples(g.subjects(_FEW)))
query("filter_subject_column", _with(f"FROM triples WHERE subject IN ({', '.join(map(str, _FEW))})"))(
    lambda g: layouts.typed_triples(g).where(filters.subject_in(*_FEW))
)
query("filter_predicate_eq", _with("FROM triples WHERE predicate = 'acctbal'"))(lambda g: layouts.typed_triples(g).where(filters.predicate_in("acctbal")))
query("filter_predicate_in", _with("FROM triples WHERE predicate IN ('brand', 'customer.nation', 'toxic')"))(
    lambda g: layouts.typed_triples(g).where(filters.predicate_in("brand", "customer.nation", "toxic"))
)
query("filter_wide_notnull", _with("FROM wide WHERE brand IS NOT NULL", _WIDE))(lambda g: layouts.wide_nodes(g).where(filters.wide_not_null("brand")))
query("filter_wide_eq", _with("FROM wide WHERE mktsegment = 'BUILDING'", _WIDE))(lambda g: layouts.wide_nodes(g).where(filters.wide_in("mktsegment", "BUILDING")))
query("filter_wide_in", _with("FROM wide WHERE size IN (1, 5, 9)", _WIDE))(lambda g: layouts.wide_nodes(g).where(filters.wide_in("size", 1, 5, 9)))
query("filter_object_notnull", _with("FROM triples WHERE \"objectDouble\" IS NOT NULL"))(lambda g: layouts.typed_triples(g).where(filters.object_not_null("objectDouble")))
query("filter_object_eq", _with("FROM triples WHERE \"objectString\" = 'O'"))(lambda g: layouts.typed_triples(g).where(filters.object_in("objectString", "O")))
query("filter_object_in", _with("FROM triples WHERE \"objectLong\" IN (1, 2, 3)"))(lambda g: layouts.typed_triples(g).where(filters.object_in("objectLong", 1, 2, 3)))
query("filter_object_string_in", _with(f"SELECT subject, predicate, {_TEXT} AS \"objectString\", \"objectType\" FROM triples WHERE {_TEXT} IN ('7', 'BUILDING', 'true')"))(
    lambda g: layouts.string_triples(g).where(filters.object_in("objectString", "7", "BUILDING", "true"))
)
query("filter_object_type_eq", _with("FROM triples WHERE \"objectType\" = 'timestamp'"))(lambda g: layouts.typed_triples(g).where(filters.object_type_in("timestamp")))
query("filter_object_type_in", _with("FROM triples WHERE \"objectType\" IN ('boolean', 'geo')"))(lambda g: layouts.typed_triples(g).where(filters.object_type_in("boolean", "geo")))
query("filter_contradiction", _with("FROM triples WHERE predicate = 'brand' AND predicate = 'name'"))(
    lambda g: layouts.typed_triples(g).where(filters.predicate_in("brand") & filters.predicate_in("name"))
)
query("filter_always_true", _with("FROM edges", _EDGES))(lambda g: layouts.edges(g).where(F.lit(True)))
query("filter_always_false", _with("FROM edges WHERE false", _EDGES))(lambda g: layouts.edges(g).where(F.lit(False)))
query("filter_residual", _with("FROM nodes WHERE \"objectString\" LIKE 'Brand#1%' OR NOT (\"objectLong\" >= 3) OR \"objectDouble\" > 9000", _NODES))(
    lambda g: layouts.typed_nodes(g).where(F.col("objectString").startswith("Brand#1") | ~(F.col("objectLong") >= 3) | (F.col("objectDouble") > 9000))
)
query("filter_all_kinds", _with(f"FROM triples WHERE subject = {_ONE} AND predicate IN ('name', 'acctbal') AND \"objectType\" = 'double' AND \"objectDouble\" IS NOT NULL"))(
    lambda g: layouts.typed_triples(g).where(filters.subject_in(_ONE) & filters.predicate_in("name", "acctbal") & filters.object_type_in("double") & filters.object_not_null("objectDouble"))
)
for _name, _operator in (("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">=")):
    query(f"filter_range_{_name}", _with(f"FROM triples WHERE predicate = 'size' AND \"objectLong\" {_operator} 10"))(
        lambda g, o=_operator: layouts.typed_triples(g).where(filters.compared("size", "int", o, 10))
    )
_NATIONS = [_uid("Nation", 3), _uid("Nation", 7)]
query("filter_edge_uid_in", _with(f"FROM edges WHERE \"objectUid\" IN ({', '.join(map(str, _NATIONS))})", _EDGES))(lambda g: layouts.edges(g).where(filters.edge_to(*_NATIONS)))
query("filter_any_value", _with("FROM triples WHERE " + " OR ".join(f"CAST(\"{c}\" AS VARCHAR) IN ('7', 'BUILDING', 'true')" for c in _COLUMNS)))(
    lambda g: layouts.typed_triples(g).where(filters.any_value(7, "BUILDING", "true"))
)
query("lang_strings", _with("SELECT subject, predicate, \"objectString\" FROM triples WHERE predicate LIKE 'text@%'"))(
    lambda g: layouts.typed_triples(g.only(["text"])).where(F.col("predicate").startswith("text@")).select("subject", "predicate", "objectString")
)
query("lang_one", _with("SELECT subject, \"objectString\" FROM triples WHERE predicate = 'text@de'"))(
    lambda g: layouts.typed_triples(g.only(["text"])).where(filters.predicate_in("text@de")).select("subject", "objectString")
)
query("lang_base", _with("SELECT subject, predicate, length(\"objectString\") AS n FROM triples WHERE predicate = 'text' OR predicate LIKE 'text@%'"))(
    lambda g: layouts.typed_triples(g).where(filters.language_of("text")).select("subject", "predicate", F.length("objectString").cast("long").alias("n"))
)

# -- projections

query("project_wide_subset", _with("SELECT subject, name FROM wide WHERE brand = 'Brand#13' OR mktsegment = 'MACHINERY'", _WIDE))(
    lambda g: layouts.wide_nodes(g).where(filters.wide_in("brand", "Brand#13") | filters.wide_in("mktsegment", "MACHINERY")).select("subject", "name")
)
query("project_reordered", _with("SELECT retailprice, \"graph.type\", subject, size FROM wide WHERE retailprice IS NOT NULL", _WIDE))(
    lambda g: layouts.wide_nodes(g).select("retailprice", F.col("`graph.type`"), "subject", "size").where("retailprice IS NOT NULL")
)
query("project_long", _with("SELECT \"objectDouble\" FROM triples WHERE predicate = 'acctbal'"))(
    lambda g: layouts.typed_triples(g).where(filters.predicate_in("acctbal")).select("objectDouble")
)

# -- node selections and set operations

_HAS = lambda *names: "SELECT DISTINCT subject FROM triples WHERE predicate IN (" + ", ".join(f"'{n}'" for n in names) + ")"
query("has_any", _with(_HAS("brand", "toxic")))(lambda g: filters.has_any(g, "brand", "toxic"))
query("has_and_has", _with(f"SELECT subject, predicate, \"objectUid\" FROM edges WHERE subject IN ({_HAS('mktsegment', 'status')}) AND subject IN ({_HAS('customer.nation')})", _EDGES))(
    lambda g: filters.having(layouts.edges(g), g, ["mktsegment", "status"], ["customer.nation"])
)
query("has_then_get", _with(f"SELECT subject, \"objectString\" FROM triples WHERE predicate = 'name' AND subject IN ({_HAS('acctbal')})"))(
    lambda g: filters.having(layouts.typed_triples(g.only(["name"])), g, ["acctbal"]).select("subject", "objectString")
)
query("nodes_union", _with(f"{_HAS('brand')} UNION {_HAS('mktsegment')}"))(lambda g: filters.has_any(g, "brand").unionAll(filters.has_any(g, "mktsegment")).distinct())
query("nodes_intersect", _with(f"{_HAS('name')} INTERSECT {_HAS('acctbal')}"))(lambda g: filters.has_any(g, "name").intersect(filters.has_any(g, "acctbal")))
query("nodes_except", _with(f"{_HAS('name')} EXCEPT {_HAS('acctbal')}"))(lambda g: filters.lacking(filters.has_any(g, "name"), filters.has_any(g, "acctbal")))
query("anti_reserved_nodes", _with("FROM triples WHERE subject NOT IN (FROM gone)", "gone AS MATERIALIZED (SELECT DISTINCT subject FROM triples WHERE predicate = 'graph.type' AND \"objectString\" IN ('Document', 'Event', 'Order'))"))(
    lambda g: filters.lacking(
        layouts.typed_triples(g), layouts.typed_triples(g.only([TYPE_PREDICATE])).where(filters.object_in("objectString", "Document", "Event", "Order")).select("subject")
    )
)
query("reserved_include", _with("SELECT predicate, count(*) AS n FROM triples WHERE predicate NOT LIKE 'graph.%' OR predicate LIKE 'graph.t%' GROUP BY predicate"))(
    lambda g: layouts.typed_triples(g.reserved(ReservedFilter("graph.t*"))).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))
)
query("reserved_exclude", _with("SELECT predicate, count(*) AS n FROM triples WHERE predicate NOT LIKE 'graph.%' GROUP BY predicate"))(
    lambda g: layouts.typed_triples(g.reserved(ReservedFilter(None, "graph.type"))).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))
)
query("reserved_column", _with("SELECT predicate, count(*) AS n FROM triples WHERE predicate NOT LIKE 'graph.%' GROUP BY predicate"))(
    lambda g: layouts.typed_triples(g).where(ReservedFilter("graph.*", "graph.t*").column(F.col("predicate"))).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))
)

# -- ids, pages, density

_SUBJECTS = "subjects AS (SELECT DISTINCT subject FROM triples)"
query("uid_hex", _with("SELECT subject, '0x' || lower(hex(subject)) AS uid FROM subjects", _SUBJECTS))(
    lambda g: layouts.typed_triples(g).select("subject").distinct().withColumn("uid", uid_to_hex(F.col("subject")))
)
query("uid_round_trip", _with("SELECT count(*) AS n, count(*) AS same FROM edges", _EDGES))(
    lambda g: layouts.edges(g).agg(F.count(F.lit(1)).alias("n"), F.count_if(uid_from_hex(uid_to_hex(F.col("objectUid"))) == F.col("objectUid")).alias("same"))
)
query("uid_range", _with(f"FROM edges WHERE subject >= {_uid('Customer', 10)} AND subject < {_uid('Customer', 60)}", _EDGES))(
    lambda g: layouts.edges(g).where(filters.subject_range(_uid("Customer", 10), _uid("Customer", 60)))
)
query("uid_cardinality", _with("SELECT max(subject) AS highest, count(DISTINCT subject) AS subjects FROM triples"))(
    lambda g: layouts.typed_triples(g).agg(F.max("subject").alias("highest"), F.count_distinct("subject").alias("subjects"))
)
query("chunk_ids", _with("SELECT subject, (row_number() OVER (ORDER BY subject) - 1) // 100 AS chunk FROM subjects", _SUBJECTS))(
    lambda g: paging.chunk_ids(layouts.typed_triples(g.only([TYPE_PREDICATE])), 100)
)
query("page", _with(f"FROM edges WHERE subject IN (SELECT DISTINCT subject FROM edges WHERE subject > {_uid('Customer', 20)} ORDER BY subject LIMIT 50)", _EDGES))(
    lambda g: paging.page(layouts.edges(g), _uid("Customer", 20), 50)
)
query("uid_gaps", _with("SELECT subject, gap FROM (SELECT subject, subject - lag(subject) OVER (ORDER BY subject) AS gap FROM subjects) WHERE gap IS NOT NULL", _SUBJECTS))(
    lambda g: paging.gaps(layouts.typed_triples(g.only([TYPE_PREDICATE])))
)
query("sparsity_median", _with("SELECT list_sort(list(gap))[len(list(gap)) // 2 + 1] AS median FROM (SELECT subject - lag(subject) OVER (ORDER BY subject) AS gap FROM subjects) WHERE gap IS NOT NULL", _SUBJECTS))(
    lambda g: paging.upper_median_gap(layouts.typed_triples(g.only([TYPE_PREDICATE])))
)
query("dense_runs", _with("""SELECT min(subject) AS first, max(subject) AS last, count(*) AS subjects FROM (
    SELECT subject, sum(begins) OVER (ORDER BY subject) AS run FROM (
    SELECT subject, CASE WHEN subject - lag(subject) OVER (ORDER BY subject) < 100 THEN 0 ELSE 1 END AS begins FROM subjects)) GROUP BY run HAVING count(*) > 2""", _SUBJECTS))(
    lambda g: paging.dense_runs(layouts.typed_triples(g.only([TYPE_PREDICATE])), 100, 2)
)
query("id_probe", _with(f"SELECT subject FROM subjects WHERE subject >= {_uid('Customer', 7)} ORDER BY subject LIMIT 20", _SUBJECTS))(
    lambda g: g.spark.createDataFrame([(u,) for u in paging.prober(layouts.typed_triples(g.only([TYPE_PREDICATE])))(_uid("Customer", 7), 20)], "subject long")
)
query("id_histogram", _with(f"SELECT subject // {STRIDE} AS bucket, count(*) AS n FROM subjects GROUP BY 1", _SUBJECTS))(
    lambda g: paging.id_histogram(layouts.typed_triples(g), STRIDE)
)

# -- partitioning

_STATE = state_of_tables()
_HELD = "held AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{g}')" for g, names in sorted(_STATE.predicates.items()) for n in sorted(names)) + ") AS t(name, grp))"


def _dealt_sql(parts: str) -> str:
    """Predicates with the number of their part: groups in order, in each names by MD5 dealt to ``parts`` parts."""
    return f"""sized AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY md5(name)) - 1 AS nth, count(*) OVER (PARTITION BY grp) AS n FROM held),
        dealt AS (SELECT name, grp, nth % {parts} AS own, {parts} AS parts FROM sized),
        bases AS (SELECT grp, sum(parts) OVER (ORDER BY grp) - parts AS base FROM (SELECT DISTINCT grp, parts FROM dealt)),
        numbered AS (SELECT name, CAST(base + own AS INTEGER) AS part FROM dealt JOIN bases USING (grp))"""


_PARTED = "SELECT subject, predicate, part FROM triples JOIN numbered ON name = split_part(predicate, '@', 1)"


def _by_part(make):
    return lambda g: layouts.typed_triples(g).select("subject", "predicate", partitioned.predicate_part(make(g)).alias("part"))


query("part_singleton", _with("SELECT subject, predicate, 0 AS part FROM triples"))(_by_part(lambda g: partitioner.singleton(_STATE, g.schema)))
query("part_group", _with(_PARTED, _HELD, _dealt_sql("1")))(_by_part(lambda g: partitioner.group(_STATE, g.schema)))
query("part_alpha", _with(_PARTED, _HELD, _dealt_sql("2")))(_by_part(lambda g: partitioner.alpha(_STATE, g.schema, 2)))
query("part_predicate", _with(_PARTED, _HELD, _dealt_sql("(1 + (n - 1) // 3)")))(_by_part(lambda g: partitioner.predicate(_STATE, g.schema, 3)))
query("part_shard", _with("SELECT predicate, CAST(('0x' || right(md5(predicate), 8))::BIGINT % 8 AS INTEGER) AS shard FROM (SELECT DISTINCT predicate FROM triples)"))(
    lambda g: layouts.typed_triples(g).select("predicate").distinct().select("predicate", F.expr("int(conv(right(md5(predicate), 8), 16, 10) % 8)").alias("shard"))
)
query("part_uid_range", _with("SELECT subject, predicate, (subject - 1) // 1000 AS part FROM edges", _EDGES))(
    lambda g: layouts.edges(g).select("subject", "predicate", partitioned.uid_part(1000).alias("part"))
)
query("part_predicate_uid_range", _with("SELECT subject, predicate, part, (subject - 1) // 1000000 AS uid_part FROM triples JOIN numbered ON name = split_part(predicate, '@', 1)", _HELD, _dealt_sql("(1 + (n - 1) // 3)")))(
    lambda g: layouts.typed_triples(g).select(
        "subject", "predicate", partitioned.predicate_part(partitioner.predicate(_STATE, g.schema, 3)).alias("part"), partitioned.uid_part(1000000).alias("uid_part")
    )
)
query("read_plan", _with("SELECT predicate, count(*) AS n FROM triples GROUP BY predicate"))(
    lambda g: partitioned.read_plan(g, partitioner.uid_range(partitioner.predicate(_STATE, g.schema, 10), _highest(g), 20_000_000)).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))
)


query("read_plan_capped", _with("SELECT predicate, count(*) AS n FROM triples GROUP BY predicate"))(
    lambda g: partitioned.read_plan(g, _capped(g)).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))
)
query("transaction_read", _with("FROM triples WHERE predicate IN ('name', 'nation.region')"))(lambda g: layouts.typed_triples(snapshot(g.only(["name", "nation.region"]))))
query("format_edges", _with(f"FROM edges WHERE predicate = 'customer.nation' AND subject < {_uid('Customer', 500)}", _EDGES))(
    lambda g: _by_format(g, "loomgraph-edges").where((F.col("predicate") == "customer.nation") & (F.col("subject") < _uid("Customer", 500)))
)
query("format_triples", _with("FROM triples WHERE predicate = 'acctbal' AND \"objectDouble\" > 9000"))(
    lambda g: _by_format(g, "loomgraph-triples").where((F.col("predicate") == "acctbal") & (F.col("objectDouble") > 9000))
)


def _by_format(g, name: str) -> DataFrame:
    """Two edges and a property, stored, and read through a data source format."""
    path = scratch(g.spark, "graph")
    write_graph(g.only(["customer.nation", "nation.region", "acctbal"]), path)
    register_formats(g.spark)
    return g.spark.read.format(name).load(path)


def _capped(g) -> list[partitioner.Part]:
    """Six ranges at most, cut where a search finds that the ids are no longer dense."""
    probe = paging.prober(layouts.typed_triples(g.only([TYPE_PREDICATE])))
    detect = lambda part, uids: density.dense_end(probe, STRIDE, uids, 10)
    return partitioner.uid_range(partitioner.singleton(_STATE, g.schema), _highest(g), 1_000_000, 6, detect)


def _highest(g) -> int:
    """The highest subject of any triple."""
    return reduce(DataFrame.unionAll, [b.table.select(b.subject.alias("subject")) for b in g.branches]).agg(F.max("subject")).first()[0] or 1


query("array_rotation", _with("SELECT subject, string_agg(predicate, ',' ORDER BY predicate <= first, predicate) AS turned FROM (SELECT *, min(predicate) OVER (PARTITION BY subject) AS first FROM (SELECT DISTINCT subject, predicate FROM triples)) GROUP BY subject"))(
    lambda g: layouts.typed_triples(g).groupBy("subject").agg(F.sort_array(F.collect_set("predicate")).alias("p"))
    .select("subject", F.array_join(rotated_array(F.col("p"), 1), ",").alias("turned"))
)
query("predicate_metrics", _with("SELECT predicate, count(*) AS triples, count(DISTINCT subject) AS subjects, min(subject) AS first, max(subject) AS last FROM triples GROUP BY predicate"))(
    lambda g: partitioned.predicate_metrics(layouts.typed_triples(g))
)

# -- graph views and algorithms

query("gf_vertices", _with("SELECT subject AS id, " + ", ".join(f"\"{p.name}\" AS \"{escaped_name(p.name)}\"" for p in _PROPERTIES) + " FROM wide", _WIDE))(views.frame_vertices)
_LINKS = "links AS (SELECT subject AS src, \"objectUid\" AS dst, predicate FROM triples WHERE \"objectType\" = 'uid')"
query("gf_edges", _with("FROM links", _LINKS))(views.frame_edges)
query("gx_vertices", _with("SELECT subject AS id, predicate, \"objectType\" AS type, coalesce(\"objectString\", '') AS text FROM nodes", _NODES))(
    lambda g: views.property_vertices(g).select("id", "property.predicate", F.col("property.objectType").alias("type"), F.coalesce("property.objectString", F.lit("")).alias("text"))
)
query("gx_edges", _with("FROM links", _LINKS))(lambda g: views.property_edges(g).select("src", "dst", F.col("attr.predicate").alias("predicate")))
query("triplets", _with("SELECT s.name AS src_name, l.predicate, d.name AS dst_name FROM links l JOIN wide s ON s.subject = l.src JOIN wide d ON d.subject = l.dst", _LINKS, _WIDE))(
    lambda g: views.triplets(views.frame_vertices(g), views.frame_edges(g)).select(F.col("src.name").alias("src_name"), F.col("edge.predicate").alias("predicate"), F.col("dst.name").alias("dst_name"))
)
query("degrees", _with("SELECT id, sum(o) AS out_degree, sum(i) AS in_degree FROM (SELECT src AS id, 1 AS o, 0 AS i FROM links UNION ALL SELECT dst, 0, 1 FROM links) GROUP BY id", _LINKS))(
    lambda g: algorithms.degrees(views.frame_edges(g))
)
_RANKS = ["r0 AS (SELECT subject AS id, 1.0::DOUBLE AS rank FROM subjects)", "out AS (SELECT src, count(*) AS n FROM links GROUP BY src)"]
for _i in range(10):
    _RANKS.append(
        f"""r{_i + 1} AS MATERIALIZED (SELECT s.subject AS id, 0.15 + 0.85 * coalesce(given, 0) AS rank FROM subjects s LEFT JOIN (
            SELECT dst, sum(rank / n) AS given FROM links JOIN out USING (src) JOIN r{_i} ON id = src GROUP BY dst) ON dst = s.subject)"""
    )
query("pagerank", _with("SELECT id, round(rank * (count(*) OVER ()) / sum(rank) OVER (), 6) AS pagerank FROM r10", _SUBJECTS.replace(" AS (", " AS MATERIALIZED ("), _LINKS.replace(" AS (", " AS MATERIALIZED ("), *_RANKS))(
    lambda g: algorithms.pagerank(layouts.typed_triples(g.only([TYPE_PREDICATE])).select(F.col("subject").alias("id")), views.frame_edges(g), 10).select("id", F.round("pagerank", 6).alias("pagerank"))
)
_CLOSING = " UNION ALL SELECT DISTINCT o.src, n.dst FROM links o JOIN links n ON n.src = o.dst WHERE o.predicate = 'order.customer'"
# no path of the graph is longer than ten edges, after which no rank moves
query("pagerank_tolerance", ORACLE_SQL["pagerank"])(
    lambda g: algorithms.pagerank(layouts.typed_triples(g.only([TYPE_PREDICATE])).select(F.col("subject").alias("id")), views.frame_edges(g), tolerance=1e-9).select("id", F.round("pagerank", 6).alias("pagerank"))
)
query(
    "triangle_count",
    _with(
        """SELECT subject AS id, count(c) AS triangles FROM subjects LEFT JOIN (
            SELECT unnest([x.a, x.b, y.b]) AS c FROM flat x JOIN flat y ON x.b = y.a JOIN flat z ON z.a = x.a AND z.b = y.b) ON c = subject GROUP BY subject""",
        _SUBJECTS, _LINKS,
        f"flat AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM (SELECT src, dst FROM links{_CLOSING}))",
    ),
)(lambda g: _triangles(g))


def _triangles(g) -> DataFrame:
    """Triangles of the graph with an edge from each order to its customer's nation, as the graph itself has none."""
    links = views.frame_edges(g).select("src", "dst")
    orders = views.frame_edges(g.only(["order.customer"])).select("src", F.col("dst").alias("customer"))
    nations = views.frame_edges(g.only(["customer.nation"])).select(F.col("src").alias("customer"), "dst")
    closing = orders.join(nations, "customer").select("src", "dst").distinct()
    ids = layouts.typed_triples(g.only([TYPE_PREDICATE])).select(F.col("subject").alias("id"))
    return algorithms.triangle_count(ids, links.unionAll(closing))


# -- events

QUERIES["event_windows"] = lambda spark, folder: windowed(spark.read.parquet(f"{folder}/events.parquet"), "1 hour").withColumn("value", F.round("value", 4))
ORACLE_SQL["event_windows"] = "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL"
QUERIES["parsed_dates"] = lambda spark, folder: spark.read.parquet(f"{folder}/events.parquet").select(
    "event_id", parse_timestamp(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))).alias("ts")
)
ORACLE_SQL["parsed_dates"] = "SELECT event_id, ts FROM events"
