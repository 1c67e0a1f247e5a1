"""A graph as a list of branches: for each predicate, where its subjects and values stand in which table.

Layouts are unions over branches.  As each branch states its predicate and tag
as constants, Catalyst drops the branches that a filter rules out and reads only
the columns that the rest needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession

from loomgraph.functions.types import Predicate, to_signed
from loomgraph.plans.catalog import ReservedFilter, Schema


@dataclass(frozen=True)
class Branch:
    """The triples of one predicate.

    ``lang``: a column with the language, for the rows named ``predicate@language``.
    ``key_of``: the raw key that a subject has, None if it is none of this branch's; with ``key`` it lets a
    filter on subjects reach the scan.
    """

    predicate: Predicate
    table: DataFrame
    subject: Column
    value: Column
    lang: Column | None = None
    key: Column | None = None
    key_of: Callable[[int], int | None] | None = None
    distinct: bool = False


@dataclass(frozen=True)
class NodeTable:
    """A table with a row for each node of a type, for the wide layout."""

    table: DataFrame
    subject: Column
    columns: dict[str, Column]
    key: Column | None = None
    key_of: Callable[[int], int | None] | None = None


@dataclass(frozen=True)
class Graph:
    spark: SparkSession
    schema: Schema
    branches: tuple[Branch, ...]
    node_tables: tuple[NodeTable, ...] = ()
    groups: dict[str, str] = field(default_factory=dict)

    def reserved(self, keep: ReservedFilter) -> Graph:
        """Without the reserved predicates that the filter leaves out."""
        return self.only(p for p in self.schema.by_name if keep(p))

    def only(self, names: Iterable[str]) -> Graph:
        """Only the predicates of these names."""
        wanted = set(names)
        return replace(
            self,
            schema=self.schema.filter(lambda p: p.name in wanted),
            branches=tuple(b for b in self.branches if b.predicate.name in wanted),
            node_tables=tuple(replace(t, columns={n: c for n, c in t.columns.items() if n in wanted}) for t in self.node_tables),
        )

    def subjects(self, uids: Iterable[int]) -> Graph:
        """Only these subjects, signed or unsigned, by filters on the tables' own keys where there are any."""
        wanted = [to_signed(u) for u in uids]

        def cut(part):
            if part.key is None:
                return replace(part, table=part.table.filter(part.subject.isin(wanted)))
            keys = [k for k in map(part.key_of, wanted) if k is not None]
            return replace(part, table=part.table.filter(part.key.isin(keys))) if keys else None

        return replace(
            self,
            branches=tuple(x for x in map(cut, self.branches) if x),
            node_tables=tuple(x for x in map(cut, self.node_tables) if x),
        )


