"""What can be put in the place of the engine's own: partitioners, layouts, probes and middles of a search.

Any callable of the same shape serves; nothing has to be derived from these.  What runs queries against a remote store
is :class:`loomgraph.sources.remote.Executor`.
"""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame

from loomgraph.plans.catalog import ClusterState, Schema
from loomgraph.plans.partitioner import Part
from loomgraph.sources.graph import Graph


@runtime_checkable
class Partitioner(Protocol):
    """Cuts a graph into parts that are disjoint and leave nothing out; see :mod:`loomgraph.plans.partitioner`."""

    def __call__(self, state: ClusterState, schema: Schema) -> list[Part]: ...


@runtime_checkable
class Layout(Protocol):
    """Shows a graph as a table with a column ``subject``; see :mod:`loomgraph.operators.layouts`."""

    def __call__(self, graph: Graph) -> DataFrame: ...


@runtime_checkable
class Middle(Protocol):
    """The place between two ids at which a search probes next, None to end it; see :mod:`loomgraph.plans.density`."""

    def __call__(self, left: int, right: int) -> int | None: ...
