"""The reader: ``spark.read.loom.triples(path)`` and its kin, with the options of :mod:`loomgraph.plans.options`."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import layouts, views
from loomgraph.operators.paging import prober
from loomgraph.operators.partitioned import read_plan
from loomgraph.plans import density
from loomgraph.plans.catalog import ClusterState, ReservedFilter, Schema
from loomgraph.plans.options import Options
from loomgraph.plans.partitioner import Part, plan
from loomgraph.sources.graph import Graph
from loomgraph.sources.stored import read_graph, snapshot
from loomgraph.sources.tables import graph_of_tables


@dataclass(frozen=True)
class GraphReader:
    """Reads a graph from a folder of tables or a stored graph."""

    spark: SparkSession
    options: Options = Options()

    def option(self, name: str, value: object) -> GraphReader:
        return replace(self, options=Options.of(dict(self.options.values) | {name.lower(): value}))

    def graph(self, *targets: str) -> Graph:
        """The graph of the first target, without the reserved predicates that the options leave out.

        All targets must show the same schema.  In transaction mode ``read`` everything that is read through the
        graph comes from one copy of its triples, taken now, whatever happens to the target after that.
        """
        paths = list(targets) or self.options.targets
        found = [self._open(p) for p in paths]
        if any(g.schema != found[0].schema for g in found):
            raise ValueError("Targets belong to different graphs")
        keep = ReservedFilter(
            self.options.get("loomgraph.include.reserved-predicates"), self.options.get("loomgraph.exclude.reserved-predicates")
        )
        graph = found[0].reserved(keep)
        return snapshot(graph) if self.options.choice("loomgraph.transaction.mode", "none", "read") == "read" else graph

    def _open(self, path: str) -> Graph:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        triples = jvm.org.apache.hadoop.fs.Path(f"{path}/triples")
        if triples.getFileSystem(conf).exists(triples):
            return read_graph(self.spark, path)
        return graph_of_tables(self.spark, path)

    def schema(self, *targets: str) -> Schema:
        return self.graph(*targets).schema

    def triples(self, *targets: str) -> DataFrame:
        mode = self.options.choice("loomgraph.triples.mode", "typed", "string")
        return (layouts.typed_triples if mode == "typed" else layouts.string_triples)(self.graph(*targets))

    def nodes(self, *targets: str) -> DataFrame:
        mode = self.options.choice("loomgraph.nodes.mode", "typed", "wide")
        return (layouts.typed_nodes if mode == "typed" else layouts.wide_nodes)(self.graph(*targets))

    def edges(self, *targets: str) -> DataFrame:
        return layouts.edges(self.graph(*targets))

    def vertices(self, *targets: str) -> DataFrame:
        return views.frame_vertices(self.graph(*targets))

    def links(self, *targets: str) -> DataFrame:
        return views.frame_edges(self.graph(*targets))

    def plan(self, state: ClusterState, *targets: str) -> list[Part]:
        """The parts that the options' partitioner makes of the graph; a dense region is probed for only if needed."""
        graph = self.graph(*targets)
        length = density.probe_length(self.options.number("loomgraph.chunkSize"))
        lowest = self.options.number("loomgraph.partitioner.uidRange.uidsPerPartition")

        def detect(part: Part, uids: int) -> tuple[int, int]:
            subjects = layouts.typed_triples(graph.only(part.predicates)).select("subject")
            return density.dense_end(prober(subjects), lowest, uids, length)

        return plan(state, graph.schema, self.options, detect)

    def planned_triples(self, state: ClusterState, *targets: str) -> DataFrame:
        """Typed triples read part by part, with ``part``."""
        return read_plan(self.graph(*targets), self.plan(state, *targets))

    def max_uid(self, *targets: str) -> int:
        return layouts.typed_triples(self.graph(*targets)).agg(F.max("subject").alias("m")).first()["m"]


def install() -> None:
    """Give every ``spark.read`` a property ``loom``."""
    DataFrameReader.loom = property(lambda self: GraphReader(self._spark))
