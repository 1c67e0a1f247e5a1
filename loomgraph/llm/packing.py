"""Best-fit packing of tokenised documents into fixed-length sequences by exact complements.

1. Each partition tokenises its documents, cuts those longer than a sequence,
   and numbers its pieces within each length.  The pieces become a table.
2. The histogram of piece lengths, at most ``capacity`` rows whatever the
   input, goes to the driver, where :func:`plan` fills sequences: it opens one
   with the largest length left and asks an index of the sums of one, two or
   three lengths left for those that exactly fill the gap; failing that, it adds
   the largest length that fits (best fit) and asks again.  What a step
   consumes, it consumes as often as the counts allow, so the number of steps
   depends on the number of lengths and not on the number of documents.
3. A piece's rank among all of its length is its number in its partition plus
   the counts of the partitions before; the plan's row for that length and rank
   range gives its sequence and place.

Edge cases: a null or empty text is one piece that holds only the end id; equal
texts are packed as often as they occur; a text of any length is read whole and cut
after it is tokenised; null ids pass through; an empty table gives an empty table;
columns other than the id and the text are not read, so that none can clash.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import IdPool, each_slice, fields, written

#: Words, and ids of all of them, beyond which a worker forgets them.
REMEMBERED, REMEMBERED_IDS = 600_000, 8_000_000
#: Text bytes that are encoded together.
TEXT_BYTES = 8_000_000

_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+").fullmatch
#: Byte-level models spell a byte that is no visible Latin-1 character as one from 256 on; these are what the
#: letters above take in UTF-8.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_SPELT = {b: chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256)}
_BYTE_LETTERS = {c: "".join(_SPELT[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


class WordTokenizer(IdPool):
    """Encodes texts word by word, remembering a bounded number of words.

    The tokenizer drops white space and never joins what it separates, so a
    text's ids are those of its space-separated words, one after another.
    Likewise it lower-cases, and parts closing punctuation from a letter or
    digit before it, so that variants of a word share their stem's ids.  A stem
    of Latin letters is one unit of the merges; it goes to the tokenizer's
    model directly, which a few probes confirm to be the same.
    """

    def __init__(self, path: str, ordinary: bool = False):
        """``ordinary``: take the special tokens' strings in a text as ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        self.model = self.tokenizer.model
        self.direct = all(
            self._merged(probe) == self.tokenizer.encode(probe, add_special_tokens=False).ids
            for probe in ("a", "word", "abcdefghijklmnopqrstuvwxyz", "été", "straße", "mañana")
        )
        super().__init__()

    def _merged(self, stem: str) -> list[int]:
        return [t.id for t in self.model.tokenize(stem if stem.isascii() else stem.translate(_BYTE_LETTERS))]

    def learn(self, words: list[str]) -> None:
        plain: dict[str, None] = {}
        odd: dict[str, None] = {}
        split = []
        for word in words:
            stem = word.rstrip(",.;:!?")
            low = stem.lower()
            if self.direct and _LETTERS(low):
                plain[low] = None
            elif stem.isascii() and stem[-1:].isalnum():
                odd[low] = None
            else:
                odd[word] = None
                continue
            if low != word:
                tail = word[len(stem) :]
                odd[tail] = None
                split.append((word, low, tail))
        known = self.known
        new = [w for w in plain if w not in known]
        lists = [*map(self._merged, new)]
        rest = [w for w in odd if w not in known and w not in plain]
        lists += [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        new += rest
        if new:
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.add(new, sizes, np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())))
        more = [x for x in split if x[0] not in known]
        if more:
            pairs = np.array([[known[low], known[tail]] for _, low, tail in more]).ravel()
            ids, _ = self.gather(pairs)
            self.add([x[0] for x in more], self.size[pairs].reshape(-1, 2).sum(1), ids)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null has none."""
        if not len(texts):
            return []
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = pc.dictionary_encode(lists.flatten())
        distinct = words.dictionary.to_pylist()
        if len(self.known) > REMEMBERED or len(self.pool) > REMEMBERED_IDS:
            self.forget()
        flat, ends = self.gather(self.learned(distinct)[words.indices.to_numpy()])
        cuts = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return np.split(flat, np.r_[0, ends][cuts[:-1]])


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces(df: DataFrame, path: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' pieces: id, ``piece``, ``start``, ``length``, ``ids`` (packed little-endian
    unsigned 32-bit), and ``part`` and ``nth``, which number the pieces of a length."""
    picked = fields(df, id_col, text_col)
    kind = picked.schema[0].dataType
    out = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("nth", T.LongType()),
        ]
    )
    step, end = 4 * capacity, end_id.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, seen = _tokenizer(path), TaskContext.get().partitionId(), Counter()
        for some in each_slice(batches, text_col, TEXT_BYTES):
            row, piece, start, length, ids, nth = [], [], [], [], [], []
            for i, found in enumerate(tokenizer.encode(some.column(1))):
                packed = found.tobytes() + end
                for k, at in enumerate(range(0, len(packed), step)):
                    one = packed[at : at + step]
                    n = len(one) // 4
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(n)
                    ids.append(one)
                    nth.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0).take(pa.array(row, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([part] * len(row), pa.int32()),
                    pa.array(nth, pa.int64()),
                ],
                names=out.names,
            )

    return picked.mapInArrow(run, out)


class ComplementIndex:
    """The lengths left, indexed by the sums that one, two or three of them make.

    ``present`` has the single lengths.  ``pairs`` counts, for each sum, the pairs of lengths left that make it, and
    ``larger`` has those pairs by their larger members; triples are found by their largest member and the sum that a pair
    must add.  A length that is used up leaves all of them.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {n: k for n, k in counts.items() if k}
        self.present = np.zeros(capacity + 1, bool)
        self.present[list(self.left)] = True
        self.larger: dict[int, np.ndarray] = {}
        self.pairs = np.zeros(capacity + 1, np.int64)
        for n in self.left:
            self._count(n, 1)

    def _count(self, n: int, by: int) -> None:
        """Count, or discount, the pairs of ``n`` with itself and with every larger length."""
        upto = self.capacity - n
        if n <= upto:
            self.pairs[2 * n : self.capacity + 1] += by * self.present[n : upto + 1]

    def take(self, length: int, many: int) -> None:
        self.left[length] -= many
        if not self.left[length]:
            self._count(length, -1)
            below = np.flatnonzero(self.present[: min(length, self.capacity - length + 1)])
            self.pairs[below + length] -= 1
            self.present[length] = False

    def largest(self, most: int) -> int:
        """The largest length left of at most ``most``, or 0."""
        found = np.flatnonzero(self.present[: max(most, 0) + 1])
        return int(found[-1]) if len(found) else 0

    def has(self, lengths: tuple[int, ...], used: Counter) -> bool:
        need = Counter(lengths)
        return all(self.left.get(n, 0) >= k + used[n] for n, k in need.items())

    def pair(self, total: int, most: int, used: Counter) -> tuple[int, int] | None:
        """The pair with the largest member, of at most ``most``, that sums to ``total``."""
        if not 2 <= total <= self.capacity or not self.pairs[total]:
            return None
        if total not in self.larger:
            self.larger[total] = np.arange(total - 1, (total - 1) // 2, -1)
        a = self.larger[total]
        a = self.larger[total] = a[self.present[a] & self.present[total - a]]
        for x in a[a <= most].tolist():
            if self.has((x, total - x), used):
                return x, total - x
        return None

    def exact(self, gap: int, used: Counter) -> tuple[int, ...]:
        """A single, a pair or a triple of lengths left that sums to ``gap``, or nothing."""
        if self.present[gap] and self.has((gap,), used):
            return (gap,)
        if found := self.pair(gap, gap - 1, used):
            return found
        a = np.arange(gap - 2, (gap + 2) // 3 - 1, -1)
        for x in a[self.present[a] & (self.pairs[gap - a] > 0)].tolist() if gap > 2 else ():
            if self.has((x,), used) and (found := self.pair(gap - x, x, used + Counter([x]))):
                return (x, *found)
        return ()


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, how many, first sequence, offset): pieces of ``length`` with ranks from
    the first go to consecutive sequences from the first, all at ``offset``."""
    index = ComplementIndex({n: k for n, k in counts.items() if k}, capacity)
    next_rank: Counter = Counter()
    out, sequence = [], 0
    while first := index.largest(capacity):
        lengths, used = [first], Counter([first])
        gap = capacity - first
        while gap:
            if found := index.exact(gap, used):
                lengths += found
                used.update(found)
                break
            n = index.largest(gap)
            while n and index.left[n] <= used[n]:
                n = index.largest(n - 1)
            if not n:
                break
            lengths.append(n)
            used[n] += 1
            gap -= n
        many = min(index.left[n] // k for n, k in used.items())
        offset = 0
        for n in lengths:
            out.append((n, next_rank[n], many, sequence, offset))
            next_rank[n] += many
            offset += n
        for n, k in used.items():
            index.take(n, k * many)
        sequence += many
    return out


def place(table: DataFrame, capacity: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces and drop ``part`` and ``nth``.

    ``table`` must be stored: its numbering is read more than once.
    """
    spark = table.sparkSession
    per_part = table.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = spark.createDataFrame(
        plan(counts, capacity), "plan_length long, plan_first long, plan_many long, plan_sequence long, plan_offset long"
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = table.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    return (
        # at most a few rows for each of the lengths up to the capacity, whatever the input
        ranked.join(
            F.broadcast(rows),
            (F.col("length") == F.col("plan_length"))
            & (F.col("rank") >= F.col("plan_first"))
            & (F.col("rank") < F.col("plan_first") + F.col("plan_many")),
        )
        .withColumn("sequence_id", F.col("plan_sequence") + F.col("rank") - F.col("plan_first"))
        .withColumn("offset", F.col("plan_offset"))
        .drop("part", "nth", "base", "rank", *rows.columns)
    )


def pack(df: DataFrame, path: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its ids, sequence and place."""
    table, _ = written(pieces(df, path, end_id, capacity, id_col, text_col), "pieces")
    return place(table, capacity)


def digest(df: DataFrame, path: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with the checksum of its ids, its sequence and its place."""
    named = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    light = pieces(named, path, end_id, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    table, _ = written(light, "pieces")
    return place(table, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
