"""Results that a remote store gives to queries, run beside one another in tasks.

What runs a query is an :class:`Executor`, made in each task by a factory that Spark can send there: it has the query's
text and gives the result as JSON.  The rows go on to :func:`loomgraph.sources.results.graph_of_results`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame

#: Tells that a store refused a result as too large.
EXHAUSTED = "RESOURCE_EXHAUSTED"


@runtime_checkable
class Executor(Protocol):
    """Runs one query against a store."""

    def query(self, text: str) -> str:
        """The result, as JSON."""


class ResultTooLarge(RuntimeError):
    """A store refused a result; smaller chunks or parts help."""


def answered(executor: Executor, text: str) -> str:
    """A query's result; a refusal for its size says what helps."""
    try:
        return executor.query(text)
    except Exception as e:
        if EXHAUSTED in str(e):
            raise ResultTooLarge(
                "The store's result is larger than it may send. Lower loomgraph.chunkSize, loomgraph.partitioner.predicate.predicatesPerPartition "
                f"or loomgraph.partitioner.uidRange.uidsPerPartition. It said: {e}"
            ) from e
        raise


def run_queries(queries: DataFrame, executor: Callable[[], Executor], column: str = "query") -> DataFrame:
    """``value``: the JSON result of each query, a row each; null queries have none."""
    import pyarrow as pa

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is not None:
                    own = own or executor()
                    yield pa.RecordBatch.from_pydict({"value": pa.array([answered(own, text)], pa.string())})

    return queries.select(f"`{column}`").mapInArrow(run, "value string")
