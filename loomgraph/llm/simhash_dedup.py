"""SimHash near-duplicate detection with a Gray-order hierarchical index.

1. Each text gets a 64-bit fingerprint from its 3-word shingles.  Equal
   fingerprints are one node from here on, so copies never meet again.
2. Two fingerprints that differ in at most three bits agree on one of four
   16-bit blocks.  Each node goes, under each block, to the slot of that block's
   value.  A slot with too many nodes is split by the blocks of the bits that
   its nodes don't yet share, and so on.  After ``DEEPEST`` splits the nodes of a slot
   share all but 16 bits, so that it cannot have more than 65,536, however many there are.
3. A task sorts the nodes of its slots by Gray rank, so that neighbours agree
   on most bits, and builds a tree: a tree node holds the bits on which all
   below it agree.  Pairs of tree nodes are compared from the top, and a pair
   whose shared patterns already differ in four bits is dropped with all below
   it; so is one whose members are linked already.  What remains yields links,
   at most one fewer than the nodes of the slot.
4. Links become components in Spark (:mod:`loomgraph.llm.components`).

Edge cases: a null text counts as empty; a text without words has fingerprint
zero and is linked like any other; one with fewer than three words has a single
shingle; a text of any length is read whole.  Repeated rows and null ids stay; a
component's id is its smallest non-null id, of any orderable type.  An empty table
gives an empty table; columns other than the id and the text are not read, and
:func:`keep_one` carries them unchanged whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import discard, each_slice, fields, written
from loomgraph.llm.components import components

BITS, DISTANCE = 64, 3
#: Nodes in a slot beyond which it is split, and splits after which a slot is searched whole.
FULL, DEEPEST = 20_000, 4
#: Children of a tree node; pairs of tree nodes handled at once; nodes of a task's round.
FAN, FRONTIER, ROUND = 16, 100_000, 100_000


def fingerprints(texts: list[str | None], seed: int = 42) -> np.ndarray:
    """The fingerprint of each text as an unsigned 64-bit integer."""
    import xxhash

    hashes, sizes = [], []
    for t in texts:
        words = t.encode().lower().split() if t else []  # bytes: only A-Z changes, only ASCII white space splits
        n = len(words)
        if n >= 3:
            shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
            hashes.append(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed))))
            sizes.append(n - 2)
        elif n:
            hashes.append(xxhash.xxh64_digest(b" ".join(words), seed))
            sizes.append(1)
        else:
            sizes.append(0)
    out = np.zeros(len(texts), ">u8")
    sizes = np.array(sizes, np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8), axis=1)
        starts = np.cumsum(sizes[full]) - sizes[full]
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(counts * 2 > sizes[full][:, None], axis=1).view(">u8")[:, 0]
    return out.astype(np.uint64)


def with_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id and ``fp``, the fingerprint as a signed 64-bit integer."""
    picked = fields(df, id_col, text_col)
    out = T.StructType([T.StructField(id_col, picked.schema[0].dataType), T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in each_slice(batches, text_col):
            fps = fingerprints(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], names=out.names)

    return picked.mapInArrow(run, out)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayTree:
    """A forest over fingerprints, one tree for each group, to link those that differ in few bits."""

    def __init__(self, groups: np.ndarray, fps: np.ndarray):
        self.order = np.lexsort((gray_rank(fps), groups))
        self.fps, groups = fps[self.order], groups[self.order]
        n = len(fps)
        self.root = np.arange(n)
        fresh = np.r_[True, groups[1:] != groups[:-1]] if n else np.zeros(0, bool)
        start_of = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if n else np.zeros(0, np.int64)
        place = np.arange(n) - start_of
        # a level: the first member of each node, bits on which all members agree, and their values
        self.levels = [(np.arange(n), np.full(n, ~np.uint64(0)), self.fps)]
        self.children: list[np.ndarray] = []
        width = 1
        while n and len(self.levels[-1][0]) > int(fresh.sum()):
            width *= FAN
            starts = np.flatnonzero(place % width == 0)
            same_and = np.bitwise_and.reduceat(self.fps, starts)
            same_or = np.bitwise_or.reduceat(self.fps, starts)
            below = self.levels[-1][0]
            self.children.append(np.r_[np.searchsorted(below, starts), len(below)])
            self.levels.append((starts, ~(same_and ^ same_or), same_and))

    def _unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                jumped = self.root[self.root]
                if (jumped == self.root).all():
                    break
                self.root = jumped

    def _united(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        starts = self.levels[level][0]
        low, high = np.minimum.reduceat(self.root, starts), np.maximum.reduceat(self.root, starts)
        return (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])

    def link(self) -> np.ndarray:
        """For each fingerprint, in the given order, the index of the one that stands for its links."""
        n = len(self.fps)
        top = len(self.levels) - 1
        if n:
            tops = np.arange(len(self.levels[top][0]))
            self._search([(top, tops[i : i + FRONTIER], tops[i : i + FRONTIER]) for i in range(0, len(tops), FRONTIER)])
        out = np.empty(n, np.int64)
        out[self.order] = self.order[self.root]
        return out

    def _search(self, work: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        while work:
            level, a, b = work.pop()
            _, mask, value = self.levels[level]
            # nodes that differ in too many of the bits that both have settled differ in all members
            near = np.bitwise_count((value[a] ^ value[b]) & mask[a] & mask[b]) <= DISTANCE
            a, b = a[near], b[near]
            if level == 0:
                self._unite(a, b)
                continue
            left = ~self._united(level, a, b)
            a, b = a[left], b[left]
            if not len(a):
                continue
            bounds = self.children[level - 1]
            na, nb = bounds[a + 1] - bounds[a], bounds[b + 1] - bounds[b]
            size = na * nb
            cuts = np.searchsorted(np.cumsum(size), np.arange(FRONTIER, int(size.sum()) + FRONTIER, FRONTIER))
            blocks = np.unique(np.r_[0, np.minimum(cuts + 1, len(a))])
            cross, own = [], []
            for s, e in zip(blocks[:-1], blocks[1:], strict=True):
                k = size[s:e]
                at = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
                width = np.repeat(nb[s:e], k)
                x = np.repeat(bounds[a[s:e]], k) + at // width
                y = np.repeat(bounds[b[s:e]], k) + at % width
                if level > 1:
                    own.append((level - 1, x[x == y], y[x == y]))
                cross.append((level - 1, x[x < y], y[x < y]))
            work += [*cross, *own]  # what is close together is linked first


def _blocks(bits: list[int]) -> list[list[int]]:
    """Cut positions into DISTANCE + 1 runs of about equal length."""
    parts = DISTANCE + 1
    size, more = divmod(len(bits), parts)
    out, at = [], 0
    for i in range(parts):
        end = at + size + (i < more)
        out.append(bits[at:end])
        at = end
    return out


def _spread(nodes: DataFrame) -> DataFrame:
    """Each node under each of its blocks: ``taken`` holds the bits that its slot's nodes share."""
    masks = F.array(*[F.lit(_signed(m)) for m in _next_masks([0])])
    return _slotted(nodes.select("fp", F.explode(masks).alias("taken")))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _slotted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("slot", F.xxhash64("taken", F.col("fp").bitwiseAND(F.col("taken"))))


def _split(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Rows of full slots, each under each block of the bits not yet taken; ``masks``: the values of ``taken``."""
    options = F.lit(None).cast("array<bigint>")
    for mask in masks:
        grown = F.array(*[F.lit(_signed(m)) for m in _next_masks([mask])])
        options = F.when(F.col("taken") == F.lit(_signed(mask)), grown).otherwise(options)
    return _slotted(rows.select("fp", F.explode(options).alias("taken")))


def _next_masks(masks: list[int]) -> list[int]:
    """The bits that may be shared next: those of each mask and of one block of the rest."""
    out = []
    for mask in masks:
        free = [i for i in range(BITS) if not mask >> i & 1]
        out += [mask | sum(1 << i for i in block) for block in _blocks(free)]
    return out


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the rows of each slot; the rows come ordered by slot."""

    def links(slot, taken, fp):
        fps = fp.view(np.uint64)
        # nodes meet if they agree on the bits taken: the group is the mask and the bits
        keys = np.stack([taken.view(np.uint64), fps & taken.view(np.uint64)], axis=1)
        _, groups = np.unique(keys.view([("m", "u8"), ("v", "u8")])[:, 0], return_inverse=True)
        to = GrayTree(groups.astype(np.int64), fps).link()
        at = np.flatnonzero(to != np.arange(len(to)))
        return pa.RecordBatch.from_arrays([pa.array(fp[to[at]]), pa.array(fp[at])], names=["a", "b"])

    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
        n += batch.num_rows
        if n < ROUND:
            continue
        slot, taken, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        whole = int(np.searchsorted(slot, slot[-1]))  # the last slot may go on
        if whole:
            yield links(slot[:whole], taken[:whole], fp[:whole])
        held, n = [(slot[whole:], taken[whole:], fp[whole:])], n - whole
    if n:
        yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))


def near_links(nodes: DataFrame, full: int = FULL) -> DataFrame:
    """Links (a, b) between distinct fingerprints, column ``fp`` of a stored table, that connect exactly
    those that a chain of steps of at most DISTANCE bits connects."""
    rows, masks = _spread(nodes), _next_masks([0])
    done = None
    for depth in range(DEEPEST + 1):
        if depth < DEEPEST:
            # a row for each ``full`` rows at most
            over = rows.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > full).select("slot", F.lit(True).alias("over"))
            over, path = written(over, "slots")
            crowded = not over.isEmpty()
            marked = rows.join(over, "slot", "left") if crowded else rows
        else:
            crowded = False
            marked = rows
        some = marked.filter("over IS NULL") if crowded else marked
        found = some.select("slot", "taken", "fp").repartition("slot").sortWithinPartitions("slot").mapInArrow(_linked, "a bigint, b bigint")
        done = found if done is None else done.unionAll(found)
        if not crowded:
            return done
        rows = _split(marked.filter("over"), masks)
        masks = _next_masks(masks)
    return done


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", full: int = FULL) -> DataFrame:
    """Every row's id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``."""
    spark = df.sparkSession
    marked, _ = written(with_fingerprints(df, id_col, text_col), "fingerprints")
    nodes, nodes_path = written(marked.groupBy("fp").agg(F.min(f"`{id_col}`").alias("smallest")), "nodes")
    roots = components(near_links(nodes.select("fp"), full))
    named, named_path = written(
        nodes.join(roots.withColumnRenamed("v", "fp"), "fp", "left").select("fp", "smallest", F.coalesce("root", "fp").alias("root")), "named"
    )
    best, best_path = written(named.groupBy("root").agg(F.min("smallest").alias("component_id")), "best")
    whole, _ = written(named.join(best, "root").select("fp", "component_id"), "components")
    discard(spark, nodes_path, named_path, best_path)
    return marked.join(whole, "fp").select(
        F.col(f"`{id_col}`").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of the rows whose id is the smallest of its component.  Of rows that repeat an id, all
    stay if it is the smallest; rows with a null id stay only if no row of their component has one."""
    found = groups(df, id_col, text_col).filter("component_id IS NULL OR doc_id = component_id").select(F.struct("doc_id").alias("kept")).distinct()
    # the row goes as one column, so that no name of its own can clash
    whole = df.select(F.struct(F.col(f"`{id_col}`").alias("doc_id")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    return whole.join(found, F.col("key").eqNullSafe(F.col("kept")), "left_semi").select("row.*")
