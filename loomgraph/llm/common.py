"""Shared plumbing of the training-data operators: scratch tables and batch helpers.

Every cut in a plan goes through the folder that the cluster names in
``spark.checkpoint.dir``, because that is the only place that executors and
driver share.  Nothing here uses machine-local folders on a cluster.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.storage import discard, shared_folder
from loomgraph.functions.storage import stored as written

__all__ = ["IdPool", "discard", "each_slice", "fields", "open_folder", "scratch_path", "shared_folder", "slices", "written"]

#: Python workers cut Arrow batches into slices of about this many text bytes.
SLICE_BYTES = 2_000_000


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/loomgraph/{label}-{uuid.uuid4().hex}"


def open_folder(uri: str):
    """The file system and path of a folder given by URI or plain path, on driver or executor."""
    from pyarrow import fs

    if re.match(r"[a-z0-9+.-]+:", uri):
        return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
    return fs.LocalFileSystem(), uri


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` bytes of ``column``, at least a row each."""
    lengths = batch.column(column)
    total = lengths.nbytes
    if batch.num_rows <= 1 or total <= most:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), column, most)
    yield from slices(batch.slice(half), column, most)


def each_slice(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, column, most)


def fields(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found exactly, so extra columns cannot clash with added ones."""
    return df.select(*[F.col(f"`{n}`") for n in names])


class IdPool:
    """Token ids of known strings, in flat arrays, to be gathered for whole batches."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.size = np.zeros(1, np.int64)
        self.start = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def add(self, strings: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Remember strings that are new, with how many ids each has and all ids, one after another."""
        self.known.update(zip(strings, range(len(self.known), len(self.known) + len(strings)), strict=True))
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.pool = np.concatenate([self.pool, ids])

    def numbers(self, strings: list[str]) -> np.ndarray:
        """The number of each string, -1 for those not known."""
        return np.fromiter(map(self.known.get, strings, repeat(-1)), np.int64, len(strings))

    def learned(self, strings: list[str]) -> np.ndarray:
        """The number of each string, after learning those not known."""
        out = self.numbers(strings)
        unknown = np.flatnonzero(out < 0)
        if len(unknown):
            new = [strings[i] for i in unknown]
            self.learn(list(dict.fromkeys(new)))
            out[unknown] = self.numbers(new)
        return out

    def learn(self, new: list[str]) -> None:
        """Add strings that are not known yet."""
        raise NotImplementedError

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings given by number, one after another, and where each ends."""
        size = self.size[numbers]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.arange(total) + np.repeat(self.start[numbers] - ends + size, size)], ends
