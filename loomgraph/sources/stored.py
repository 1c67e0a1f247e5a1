"""Graphs stored as triples: Parquet, a folder a predicate, sorted by subject.

A filter on predicates reads only their folders; one on subjects skips row
groups by their statistics.  The same folder serves as data source formats, which
are told such filters too.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from loomgraph.functions.storage import scratch
from loomgraph.functions.types import EDGES, KINDS, TYPED_NODES, TYPED_TRIPLES, Predicate
from loomgraph.operators.layouts import typed_triples
from loomgraph.plans.catalog import Schema
from loomgraph.sources.graph import Branch, Graph


def write_graph(graph: Graph, path: str, partitions: int | None = None) -> None:
    """Store a graph's triples and schema under a path."""
    schema = graph.schema.to_frame(graph.spark)
    schema.coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")
    rows = typed_triples(graph).withColumn("folder", F.substring_index("predicate", "@", 1))
    keys = [F.col("folder"), F.col("subject")]
    rows = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    rows.sortWithinPartitions("folder", "subject").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/triples")


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/triples").select(*TYPED_TRIPLES.names, "folder")


def read_graph(spark: SparkSession, path: str) -> Graph:
    """The stored graph; its layouts read only the folders of the predicates that they need."""
    found = spark.read.parquet(f"{path}/schema").collect()  # a row a predicate
    schema = Schema.of(Predicate(r["predicate"], r["type"], r["lang"]) for r in found)
    triples = read_triples(spark, path)
    branches = []
    for p in schema.by_name.values():
        own = triples.filter(F.col("folder") == p.name)
        value = F.col(KINDS[p.kind][1])
        branches.append(Branch(p, own.filter(F.col("predicate") == p.name), F.col("subject"), value))
        if p.lang:
            tagged = own.filter(F.col("predicate").startswith(f"{p.name}@")).withColumn("lang", F.expr("substring(predicate, instr(predicate, '@') + 1)"))
            branches.append(Branch(p, tagged, F.col("subject"), value, F.col("lang")))
    return Graph(spark, schema, tuple(branches))


def snapshot(graph: Graph) -> Graph:
    """The graph as it is now, from a copy in the shared folder."""
    path = scratch(graph.spark, "snapshot")
    write_graph(graph, path)
    return read_graph(graph.spark, path)


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


def _opened(path: str):
    """File system and path of a folder by URI or plain path; object stores and HDFS need their libraries on the machines."""
    from pyarrow import fs

    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


class _Reader(DataSourceReader):
    """Takes the filters on subject, predicate and value columns that mean the same in Parquet; Spark keeps the rest.

    A filter on predicates also names the folders to read.
    """

    def __init__(self, path: str, schema, edges: bool | None):
        self.path, self.schema, self.edges = path, schema, edges
        self.pushed: list[tuple[str, str, object]] = []
        self.predicates: set[str] | None = None

    def pushFilters(self, filters):
        import datetime

        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else None
            operator = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in", IsNotNull: "valid"}.get(type(f))
            value = getattr(f, "value", None)
            plain = column in self.schema.names and not isinstance(value, (float, datetime.date)) and (operator == "valid" or value is not None)
            if operator is None or not plain or (operator == "in" and any(v is None or isinstance(v, (float, datetime.date)) for v in value)):
                yield f  # NaN and time zones compare differently elsewhere
                continue
            self.pushed.append((column, operator, list(value) if operator == "in" else value))
            if column == "predicate" and operator in ("==", "in"):
                named = {v.partition("@")[0] for v in (value if operator == "in" else [value])}
                self.predicates = named if self.predicates is None else self.predicates & named

    def partitions(self):
        from urllib.parse import unquote

        from pyarrow import fs

        files, base = _opened(f"{self.path}/triples")
        found = files.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        named = lambda path: {unquote(d[len("folder=") :]) for d in path.split("/") if d.startswith("folder=")}
        kept = [f.path for f in found if f.path.endswith(".parquet") and (self.predicates is None or named(f.path) & self.predicates)]
        return [_File(f) for f in sorted(kept)] or [_File("")]

    def read(self, partition):
        import pyarrow as pa
        import pyarrow.dataset as ds

        if not partition.value:
            return
        kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "timestamp_ntz": pa.timestamp("us")}
        names = self.schema.names
        tests = [] if self.edges is None else [ds.field("objectType") == "uid" if self.edges else ds.field("objectType") != "uid"]
        for column, operator, value in self.pushed:
            own = ds.field(column)
            tests.append(
                own.is_valid() if operator == "valid" else own.isin(value) if operator == "in" else own == value if operator == "==" else
                own > value if operator == ">" else own >= value if operator == ">=" else own < value if operator == "<" else own <= value
            )
        files, _ = _opened(self.path)
        condition = reduce(lambda a, b: a & b, tests) if tests else None
        for batch in ds.dataset(partition.value, filesystem=files, format="parquet").to_batches(columns=names, filter=condition):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(kinds[f.dataType.simpleString()]) for f in self.schema], names=names)


class _GraphSource(DataSource):
    layout = TYPED_TRIPLES
    edges: bool | None = None

    def schema(self):
        return self.layout

    def reader(self, schema):
        path = self.options.get("path")
        if not path:
            raise ValueError("No target given; name a stored graph in load(…)")
        return _Reader(path, self.layout, self.edges)


class TriplesSource(_GraphSource):
    @classmethod
    def name(cls):
        return "loomgraph-triples"


class NodesSource(_GraphSource):
    layout, edges = TYPED_NODES, False

    @classmethod
    def name(cls):
        return "loomgraph-nodes"


class EdgesSource(_GraphSource):
    layout, edges = EDGES, True

    @classmethod
    def name(cls):
        return "loomgraph-edges"


def register_formats(spark: SparkSession) -> None:
    """Make ``spark.read.format("loomgraph-triples")``, ``…-nodes`` and ``…-edges`` known, with filters pushed down.

    They read what pyarrow's file systems open; :func:`read_graph` reads whatever Spark does, and in the JVM.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (TriplesSource, NodesSource, EdgesSource):
        spark.dataSource.register(source)
