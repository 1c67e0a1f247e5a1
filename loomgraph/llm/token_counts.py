"""Token counts by a separator scan over flat token files.

A token file is a run of little-endian ids, each document closed by the
end-of-document id; nothing says where documents begin.  The scan cuts files
into byte ranges, finds the separators of each range by one vector comparison,
and keeps a row a range: its tokens, its separators and where the last is.  A
prefix scan over those rows, first within groups of ``GROUP`` ranges, then over the
groups, tells each range how many documents ended before it and where the one
that it continues began; so ranges need not align with documents, and no file
has to fit one task.

Edge cases: a file whose last document is not closed yields that document with
``closed`` false if it has tokens; empty files yield nothing; a separator that
follows another, or begins a file, closes a document of 0 tokens.  For texts:
null counts as empty and has 0 tokens; a text of any length is tokenised whole; an
end-of-document marker spelt out in a text is ordinary text; repeated rows and null
ids pass through; an empty table gives an empty table; columns other than the id and
the text are not read, so that none can clash.  A vocabulary that is wider than the
files' ids raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import discard, each_slice, fields, open_folder, scratch_path, written
from loomgraph.llm.packing import TEXT_BYTES, WordTokenizer

#: Bytes of a range, and ranges of a group in the prefix scan.
RANGE, GROUP = 1 << 22, 1024

_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path, ordinary=True)
    return _tokenizers[path]


def write_files(df: DataFrame, path: str, end_id: int, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Tokenise texts into flat files, one a task.  Returns their folder and a table with a row for each
    text: its id, ``file`` and ``nth`` (its number in the file).  Ids must fit ``width`` bytes."""
    from tokenizers import Tokenizer

    highest = max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)
    if max(highest, end_id) >= 1 << (8 * width):
        raise ValueError(f"ids up to {max(highest, end_id)} don't fit {width} bytes")
    spark = df.sparkSession
    folder = scratch_path(spark, "tokens")
    picked = fields(df, id_col, text_col)
    out_schema = T.StructType(
        [T.StructField(id_col, picked.schema[0].dataType), T.StructField("file", T.StringType()), T.StructField("nth", T.LongType())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = _tokenizer(path), TaskContext.get()
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.bin"  # names of failed attempts are never read
        end, nth = np.array([end_id], np.uint32), 0
        with files.open_output_stream(f"{base}/{name}", compression=None) as out:
            for part in each_slice(batches, text_col, TEXT_BYTES):
                found = tokenizer.encode(part.column(1))
                ids = np.concatenate([x for doc in found for x in (doc, end)])
                out.write(ids.astype(f"<u{width}").tobytes())
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([name] * n, pa.string()), pa.array(range(nth, nth + n), pa.int64())], names=out_schema.names
                )
                nth += n

    table, _ = written(picked.mapInArrow(run, out_schema), "order")
    return table, folder


def list_files(table: DataFrame, folder: str) -> DataFrame:
    """``file`` and ``bytes`` of the files that a table names."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        for batch in batches:
            names = batch.column(0).to_pylist()
            sizes = [files.get_file_info(f"{base}/{n}").size for n in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["file", "bytes"])

    return table.select("file").distinct().mapInArrow(run, "file string, bytes bigint")


def scan(files: DataFrame, folder: str, end_id: int, width: int = 2, range_bytes: int = RANGE, group: int = GROUP) -> DataFrame:
    """Every document of the files, columns ``file`` and ``bytes``: ``file``, ``nth``, ``start``, ``n_tokens``, ``closed``."""
    size = range_bytes // width * width
    ranges = files.filter(F.col("bytes") >= width).select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(bytes - 1) div {size}"))).alias("block")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, base = open_folder(folder)
        for batch in batches:
            for name, total, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with source.open_input_file(f"{base}/{name}") as f:
                    raw = f.read_at(min(size, total - block * size), block * size)
                ids = np.frombuffer(raw, f"<u{width}", len(raw) // width)
                first = block * (size // width)
                ends = np.flatnonzero(ids == end_id) + first
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": [name], "block": [block], "tokens_until": [first + len(ids)], "n": [len(ends)],
                        "last": pa.array([int(ends[-1]) if len(ends) else None], pa.int64()), "ends": pa.array([ends], pa.list_(pa.int64())),
                    }
                )

    found, _ = written(
        ranges.repartition("file", "block").mapInArrow(run, "file string, block bigint, tokens_until bigint, n bigint, last bigint, ends array<bigint>"),
        "ranges",
    )
    # the prefix scan carries two numbers: separators so far, and the place of the last
    light = found.select("file", "block", "n", "last", "tokens_until", F.expr(f"block div {group}").alias("many"))
    groups = light.groupBy("file", "many").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    before_group = Window.partitionBy("file").orderBy("many").rowsBetween(Window.unboundedPreceding, -1)
    group_base = groups.select(
        "file", "many", F.coalesce(F.sum("n").over(before_group), F.lit(0)).alias("base_n"), F.max("last").over(before_group).alias("base_last")
    )
    before = Window.partitionBy("file", "many").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        light.select("file", "many", "block", F.sum("n").over(before).alias("own_n"), F.max("last").over(before).alias("own_last"))
        .join(group_base, ["file", "many"])
        .select(
            "file", "block",
            (F.col("base_n") + F.coalesce("own_n", F.lit(0))).alias("done"),
            (F.coalesce("own_last", "base_last", F.lit(-1)) + 1).alias("begun"),
        )
    )
    closed = (
        found.filter("n > 0")
        .select("file", "block", "ends")
        .join(bases, ["file", "block"])
        .select("file", "done", "begun", "ends", F.posexplode("ends").alias("k", "end"))
        .select(
            "file",
            (F.col("done") + F.col("k")).alias("nth"),
            F.when(F.col("k") == 0, F.col("begun")).otherwise(F.get("ends", F.col("k") - 1) + 1).alias("start"),
            "end",
        )
        .select("file", "nth", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed"))
    )
    rest = (
        light.groupBy("file")
        .agg(F.sum("n").alias("nth"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"), F.max("tokens_until").alias("tokens"))
        .filter("tokens > start")
        .select("file", "nth", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    )
    return closed.unionAll(rest)


def count(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write every text to flat token files, scan them, and return each text's id, ``n_tokens``, ``file`` and ``start``."""
    order, folder = write_files(df, path, end_id, 2, id_col, text_col)
    # the listing is small: a row a file
    files, files_path = written(list_files(order, folder), "files")
    found = scan(files, folder, end_id)
    discard(df.sparkSession, folder, files_path)  # the scan has stored what it found
    return order.join(found, ["file", "nth"]).select(F.col(f"`{id_col}`").alias("doc_id"), "n_tokens", "file", "start")
