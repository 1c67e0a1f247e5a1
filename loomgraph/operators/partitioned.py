"""Read plans applied to layouts, and partition numbers as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loomgraph.functions.types import to_signed, unsigned_order
from loomgraph.operators.layouts import typed_triples
from loomgraph.plans.partitioner import Part
from loomgraph.sources.graph import Graph


def in_uid_range(uids: tuple[int, int]) -> Column:
    """Whether the subject lies in a half-open range of unsigned ids."""
    first, until = uids
    if until < 1 << 63:
        return (F.col("subject") >= first) & (F.col("subject") < until)
    key = unsigned_order(F.col("subject"))
    above = key >= unsigned_order(F.lit(to_signed(first)))
    return above if until >= 1 << 64 else above & (key < unsigned_order(F.lit(to_signed(until))))


def read_part(graph: Graph, part: Part, layout=typed_triples) -> DataFrame:
    """What one part of a plan holds; only its predicates' branches are planned."""
    rows = layout(graph.only(part.predicates))
    if part.uids:
        rows = rows.filter(in_uid_range(part.uids))
    if part.subjects is not None:
        rows = rows.filter(F.col("subject").isin([to_signed(u) for u in part.subjects]))
    return rows


def read_plan(graph: Graph, parts: list[Part], layout=typed_triples) -> DataFrame:
    """All parts, with their number in ``part``."""
    return reduce(DataFrame.unionAll, [read_part(graph, p, layout).withColumn("part", F.lit(i)) for i, p in enumerate(parts)])


def predicate_part(parts: list[Part]) -> Column:
    """The number of the part that a row's predicate (or its predicate of which it is a language) belongs to."""
    base = F.substring_index("predicate", "@", 1)
    pairs = [x for i, p in enumerate(parts) for n in sorted(p.predicates) for x in (F.lit(n), F.lit(i))]
    return F.element_at(F.create_map(*pairs), base) if pairs else F.lit(None).cast("int")


def uid_part(size: int) -> Column:
    """The number of the uniform range of ``size`` ids that a subject lies in; ids start at one."""
    return F.expr(f"(subject - 1) div {size}")


def spread(rows: DataFrame, parts: list[Part], size: int, partitions: int) -> DataFrame:
    """Rows laid out by predicate part and id range, sorted by subject, as a stored graph wants them."""
    placed = rows.withColumn("predicate_part", predicate_part(parts)).withColumn("uid_part", uid_part(size))
    return placed.repartition(partitions, "predicate_part", "uid_part").sortWithinPartitions("predicate", "subject")


def observed(rows: DataFrame, name: str = "read") -> tuple[DataFrame, Observation]:
    """Rows that count themselves as they are read: rows, characters, and distinct subjects (approximately)."""
    seen = Observation(name)
    size = [F.length(F.col(c)) for c, kind in rows.dtypes if kind == "string"]
    chars = F.sum(reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)) for x in size])) if size else F.lit(0)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), chars.alias("chars"), F.approx_count_distinct("subject").alias("subjects")), seen


def predicate_metrics(rows: DataFrame) -> DataFrame:
    """``predicate``, ``triples``, ``subjects`` and the range of subjects."""
    return rows.groupBy("predicate").agg(
        F.count(F.lit(1)).alias("triples"), F.count_distinct("subject").alias("subjects"), F.min("subject").alias("first"), F.max("subject").alias("last")
    )
