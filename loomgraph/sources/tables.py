"""The graph over relational tables: rows are nodes, columns properties, foreign keys edges.

A node's id is its type's number times a stride, plus its key, plus one: ids
start at one, and each type has a range of its own.  Keys of a stride or more go
on in further blocks of ``BLOCK`` strides, in which each type has its range again,
so that no key is too large.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.types import KINDS, TYPE_PREDICATE, Predicate
from loomgraph.plans.catalog import ClusterState, Schema
from loomgraph.sources.graph import Branch, Graph, NodeTable

#: Ids of a node type in a block; strides of a block, more than there are node types.
STRIDE = 10_000_000
BLOCK = 16


@dataclass(frozen=True)
class NodeType:
    number: int
    name: str
    table: str
    key: str
    #: predicate, graph type, column
    properties: tuple[tuple[str, str, str], ...]
    #: a string column whose rows also exist under the row's language: predicate, column, language column
    lang: tuple[str, str, str] | None = None


@dataclass(frozen=True)
class EdgeType:
    predicate: str
    table: str
    source: str
    source_key: str
    target: str
    target_key: str
    distinct: bool = False


#: The property graph over the supplied tables.
NODE_TYPES = (
    NodeType(1, "Region", "region", "r_regionkey", (("name", "string", "r_name"),)),
    NodeType(2, "Nation", "nation", "n_nationkey", (("name", "string", "n_name"),)),
    NodeType(
        3, "Customer", "customer", "c_custkey",
        (("name", "string", "c_name"), ("acctbal", "float", "c_acctbal"), ("mktsegment", "string", "c_mktsegment")),
    ),
    NodeType(4, "Supplier", "supplier", "s_suppkey", (("name", "string", "s_name"), ("acctbal", "float", "s_acctbal"))),
    NodeType(
        5, "Part", "part", "p_partkey",
        (
            ("name", "string", "p_name"), ("brand", "string", "p_brand"), ("ptype", "string", "p_type"),
            ("size", "int", "p_size"), ("retailprice", "float", "p_retailprice"),
        ),
    ),
    NodeType(
        6, "Order", "orders", "o_orderkey",
        (
            ("status", "string", "o_orderstatus"), ("totalprice", "float", "o_totalprice"),
            ("orderdate", "datetime", "o_orderdate"), ("priority", "string", "o_orderpriority"),
        ),
    ),
    NodeType(
        7, "Document", "documents", "doc_id",
        (("text", "string", "text"), ("source", "string", "source"), ("n_chars", "int", "n_chars")), ("text", "text", "lang"),
    ),
    NodeType(
        8, "Event", "events", "event_id",
        (("ts", "datetime", "ts"), ("event_type", "string", "event_type"), ("value", "float", "value"), ("props", "geo", "props")),
    ),
)

#: Properties from a table of their own: predicate, graph type, node type, table, key, column.
JOINED = (("toxic", "bool", "Document", "labels", "doc_id", "toxic"),)

EDGE_TYPES = (
    EdgeType("nation.region", "nation", "Nation", "n_nationkey", "Region", "n_regionkey"),
    EdgeType("customer.nation", "customer", "Customer", "c_custkey", "Nation", "c_nationkey"),
    EdgeType("supplier.nation", "supplier", "Supplier", "s_suppkey", "Nation", "s_nationkey"),
    EdgeType("part.supplier", "lineitem", "Part", "l_partkey", "Supplier", "l_suppkey", True),
    EdgeType("order.customer", "orders", "Order", "o_orderkey", "Customer", "o_custkey"),
    EdgeType("order.part", "lineitem", "Order", "l_orderkey", "Part", "l_partkey", True),
)

#: Columns that the graph reads.  Tables named here are planned without a look into their files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, event_type string, value double, props string",
    "labels": "doc_id bigint, toxic int",
}

_NUMBERS = {t.name: t.number for t in NODE_TYPES}


def uid_sql(type_name: str, key: str, stride: int = STRIDE) -> str:
    return f"(CAST({key} AS BIGINT) + {_NUMBERS[type_name] * stride + 1})"


def _uid(type_name: str, key: str, stride: int) -> str:
    """As ``uid_sql`` for keys below the stride; larger ones go to further blocks."""
    return f"({uid_sql(type_name, key, stride)} + CAST({key} AS BIGINT) div {stride} * {(BLOCK - 1) * stride})"


def schema_of_tables() -> Schema:
    found = {TYPE_PREDICATE: Predicate(TYPE_PREDICATE, "string")}
    for t in NODE_TYPES:
        for name, kind, _ in t.properties:
            found[name] = Predicate(name, kind, bool(t.lang and t.lang[0] == name))
    for name, kind, *_ in JOINED:
        found[name] = Predicate(name, kind)
    for e in EDGE_TYPES:
        found[e.predicate] = Predicate(e.predicate, "uid")
    return Schema.of(found.values())


def state_of_tables(max_uid: int | None = None, groups: int = 3) -> ClusterState:
    """A cluster that would hold this graph: predicates in the order of their names, dealt to groups in turn."""
    names = list(schema_of_tables().by_name)
    return ClusterState(
        {str(g + 1): frozenset({f"node{g + 1}:9080"}) for g in range(groups)},
        {str(g + 1): frozenset(names[g::groups]) for g in range(groups)},
        max_uid,
        "00000000-0000-0000-0000-000000000000",
    )


def graph_of_tables(spark: SparkSession, folder: str, stride: int = STRIDE) -> Graph:
    """The graph over the tables in a folder, ``{folder}/{table}.parquet``."""
    read: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name not in read:
            reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
            read[name] = reader.parquet(f"{folder}/{name}.parquet")
        return read[name]

    schema = schema_of_tables()
    by_name = schema.by_name

    def key_of(number: int):
        def of(uid: int) -> int | None:
            n, rest = divmod(uid - 1, stride)
            return n // BLOCK * stride + rest if uid > 0 and n % BLOCK == number else None

        return of

    def cast(column: str, kind: str):
        return F.col(column).cast(KINDS[kind][2])

    branches, node_tables = [], []
    for t in NODE_TYPES:
        subject, key, of = F.expr(_uid(t.name, t.key, stride)), F.col(t.key), key_of(t.number)
        branches.append(Branch(by_name[TYPE_PREDICATE], table(t.table), subject, F.lit(t.name), None, key, of))
        for name, kind, column in t.properties:
            branches.append(Branch(by_name[name], table(t.table).filter(F.col(column).isNotNull()), subject, cast(column, kind), None, key, of))
        if t.lang:
            name, column, lang = t.lang
            with_lang = table(t.table).filter(F.col(column).isNotNull() & F.col(lang).isNotNull())
            branches.append(Branch(by_name[name], with_lang, subject, F.col(column), F.col(lang), key, of))
        wide = {TYPE_PREDICATE: F.lit(t.name)} | {n: cast(c, k) for n, k, c in t.properties}
        source = table(t.table)
        for name, kind, owner, other, other_key, column in JOINED:
            if owner == t.name:
                more = table(other).select(F.col(other_key).alias("joined_key"), cast(column, kind).alias("joined_value"))
                source = source.join(more, F.col(t.key) == F.col("joined_key"), "left")
                wide[name] = F.col("joined_value")
        node_tables.append(NodeTable(source, subject, wide, key, of))
    for name, kind, owner, other, other_key, column in JOINED:
        own = table(other).filter(F.col(column).isNotNull())
        branches.append(Branch(by_name[name], own, F.expr(_uid(owner, other_key, stride)), cast(column, kind), None, F.col(other_key), key_of(_NUMBERS[owner])))
    for e in EDGE_TYPES:
        own = table(e.table).filter(F.col(e.source_key).isNotNull() & F.col(e.target_key).isNotNull())
        branches.append(
            Branch(
                by_name[e.predicate], own, F.expr(_uid(e.source, e.source_key, stride)), F.expr(_uid(e.target, e.target_key, stride)),
                None, F.col(e.source_key), key_of(_NUMBERS[e.source]), e.distinct,
            )
        )
    return Graph(spark, schema, tuple(branches), tuple(node_tables))
