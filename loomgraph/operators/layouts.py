"""The five tabular layouts of a graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.types import (
    EDGES,
    KINDS,
    STRING_TRIPLES,
    TYPED_NODES,
    TYPED_TRIPLES,
    VALUE_COLUMNS,
    as_text,
)
from loomgraph.sources.graph import Branch, Graph


def _named(branch: Branch) -> Column:
    name = F.lit(branch.predicate.name)
    return F.concat(name, F.lit("@"), branch.lang) if branch.lang is not None else name


def _union(graph: Graph, parts: list[DataFrame], schema) -> DataFrame:
    if not parts:
        return graph.spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts)


def _rows(branch: Branch, *columns: Column) -> DataFrame:
    rows = branch.table.select(branch.subject.alias("subject"), _named(branch).alias("predicate"), *columns)
    return rows.distinct() if branch.distinct else rows


def _typed(branch: Branch, columns: list[str]) -> list[Column]:
    tag, own, _ = KINDS[branch.predicate.kind]
    values = [(branch.value if c == own else F.lit(None)).cast(VALUE_COLUMNS[c]).alias(c) for c in columns]
    return [*values, F.lit(tag).alias("objectType")]


def typed_triples(graph: Graph) -> DataFrame:
    """All triples, each value in the column of its type."""
    columns = list(VALUE_COLUMNS)
    return _union(graph, [_rows(b, *_typed(b, columns)) for b in graph.branches], TYPED_TRIPLES)


def string_triples(graph: Graph) -> DataFrame:
    """All triples, values as text."""
    parts = [
        _rows(b, as_text(b.value, b.predicate.kind).alias("objectString"), F.lit(KINDS[b.predicate.kind][0]).alias("objectType"))
        for b in graph.branches
    ]
    return _union(graph, parts, STRING_TRIPLES)


def typed_nodes(graph: Graph) -> DataFrame:
    """The triples that are properties, each value in the column of its type."""
    columns = [c for c in VALUE_COLUMNS if c != "objectUid"]
    return _union(graph, [_rows(b, *_typed(b, columns)) for b in graph.branches if not b.predicate.is_edge], TYPED_NODES)


def edges(graph: Graph) -> DataFrame:
    """The triples that are edges."""
    return _union(graph, [_rows(b, b.value.cast("long").alias("objectUid")) for b in graph.branches if b.predicate.is_edge], EDGES)


def wide_nodes(graph: Graph) -> DataFrame:
    """A row a node, a column a property, in the order of names.  Language-tagged values are left out.

    Node tables are projected as they are; a graph without them is pivoted, where the smallest value stands for a list.
    """
    properties = graph.schema.properties
    if graph.node_tables:
        parts = [
            t.table.select(
                t.subject.alias("subject"),
                *[t.columns.get(p.name, F.lit(None)).cast(KINDS[p.kind][2]).alias(p.name) for p in properties],
            )
            for t in graph.node_tables
            if t.columns
        ]
        if parts:
            return reduce(DataFrame.unionAll, parts)
    plain = [b for b in graph.branches if not b.predicate.is_edge and b.lang is None]
    columns = [c for c in VALUE_COLUMNS if c != "objectUid"]
    rows = _union(graph, [_rows(b, *_typed(b, columns)) for b in plain], TYPED_NODES)
    own = [F.min(F.when(F.col("predicate") == p.name, F.col(KINDS[p.kind][1]))).alias(p.name) for p in properties]
    return rows.groupBy("subject").agg(*own) if own else rows.select("subject").distinct()


def unpivoted(graph: Graph, wide: DataFrame) -> DataFrame:
    """The typed node rows of a wide layout."""
    columns = [c for c in VALUE_COLUMNS if c != "objectUid"]
    parts = []
    for p in graph.schema.properties:
        tag, own, _ = KINDS[p.kind]
        value = F.col(f"`{p.name}`")
        parts.append(
            wide.filter(value.isNotNull()).select(
                "subject", F.lit(p.name).alias("predicate"),
                *[(value if c == own else F.lit(None)).cast(VALUE_COLUMNS[c]).alias(c) for c in columns],
                F.lit(tag).alias("objectType"),
            )
        )
    return reduce(DataFrame.unionAll, parts)


def node_maps(graph: Graph) -> DataFrame:
    """A row a node: ``subject`` and ``properties``, a map from predicate to value as text; lists keep their smallest."""
    properties = graph.only(p.name for p in graph.schema.properties)
    one = string_triples(properties).groupBy("subject", "predicate").agg(F.min("objectString").alias("value"))
    return one.groupBy("subject").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("predicate", "value")))).alias("properties"))
