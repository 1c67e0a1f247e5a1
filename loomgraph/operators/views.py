"""Vertex and edge tables for graph algorithms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.types import VALUE_COLUMNS, escaped_name
from loomgraph.operators.layouts import edges, typed_nodes, wide_nodes
from loomgraph.sources.graph import Graph


def frame_vertices(graph: Graph) -> DataFrame:
    """A row a node: ``id`` and its properties under names without dots."""
    wide = wide_nodes(graph)
    return wide.toDF("id", *[escaped_name(c) for c in wide.columns[1:]])


def frame_edges(graph: Graph) -> DataFrame:
    return edges(graph).select(F.col("subject").alias("src"), F.col("objectUid").alias("dst"), "predicate")


def property_vertices(graph: Graph) -> DataFrame:
    """A row a property: ``id`` and ``property``, a struct of its name, type and typed values."""
    columns = [c for c in VALUE_COLUMNS if c != "objectUid"]
    return typed_nodes(graph).select(F.col("subject").alias("id"), F.struct("predicate", "objectType", *columns).alias("property"))


def property_edges(graph: Graph) -> DataFrame:
    return edges(graph).select(F.col("subject").alias("src"), F.col("objectUid").alias("dst"), F.struct("predicate").alias("attr"))


def triplets(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """``src``, ``edge`` and ``dst`` as structs, for the edges of which both ends are vertices."""

    def whole(name: str) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in vertices.columns]).alias(name)

    source, target = vertices.select(F.col("id").alias("src_id"), whole("src")), vertices.select(F.col("id").alias("dst_id"), whole("dst"))
    edge = links.select(F.col("src").alias("src_id"), F.col("dst").alias("dst_id"), F.struct(*links.columns).alias("edge"))
    return edge.join(source, "src_id").join(target, "dst_id").select("src", "edge", "dst")
