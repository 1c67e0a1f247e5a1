"""Filters and node selections.

Plain filters are conditions for ``where``; Catalyst moves them into the branches
of a layout and on into the scan.  Node selections are semi-joins.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.types import KINDS, VALUE_COLUMNS, to_signed
from loomgraph.operators.layouts import typed_triples
from loomgraph.sources.graph import Graph


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def subject_in(*uids: int) -> Column:
    """Ids may be given signed or unsigned."""
    return F.col("subject").isin([to_signed(u) for u in uids])


def subject_range(first: int, until: int) -> Column:
    if first >= until:
        raise ValueError(f"empty id range: {first}, {until}")
    return (F.col("subject") >= first) & (F.col("subject") < until)


def predicate_in(*names: str) -> Column:
    return F.col("predicate").isin(list(names))


def language_of(name: str) -> Column:
    """A predicate with all its languages."""
    return (F.col("predicate") == name) | F.col("predicate").startswith(f"{name}@")


def object_type_in(*tags: str) -> Column:
    return F.col("objectType").isin(list(tags))


def object_not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def object_in(column: str, *values: object) -> Column:
    return F.col(column).isin(list(values))


def edge_to(*uids: int) -> Column:
    return F.col("objectUid").isin([to_signed(u) for u in uids])


def compared(name: str, kind: str, operator: str, value: object) -> Column:
    """The values of a property that are ``<``, ``<=``, ``>`` or ``>=`` a value."""
    column = F.col(KINDS[kind][1])
    tests = {"<": column < value, "<=": column <= value, ">": column > value, ">=": column >= value}
    return (F.col("predicate") == name) & tests[operator]


def has_any(graph: Graph, *names: str) -> DataFrame:
    """The subjects that have at least one of the predicates."""
    return typed_triples(graph.only(names)).select("subject").distinct()


def having(rows: DataFrame, graph: Graph, *groups: Iterable[str]) -> DataFrame:
    """The rows whose subject has one predicate of each group."""
    for names in groups:
        rows = rows.join(has_any(graph, *names), "subject", "left_semi")
    return rows


def lacking(rows: DataFrame, subjects: DataFrame) -> DataFrame:
    """The rows whose subject is not among ``subjects``; nothing is collected."""
    return rows.join(subjects, "subject", "left_anti")


def wide_not_null(*names: str) -> Column:
    """Any of the columns of a wide layout has a value."""
    return _any(F.col(f"`{n}`").isNotNull() for n in names)


def wide_in(name: str, *values: object) -> Column:
    return F.col(f"`{name}`").isin(list(values))


def any_value(*values: object) -> Column:
    """Any typed value column of a typed layout holds one of the values, compared as text."""
    texts = [str(v) for v in values]
    return _any(F.col(c).cast("string").isin(texts) for c in VALUE_COLUMNS)
