"""Byte-level BPE encoding and decoding with recursive SQL inside each partition.

Per partition, texts are cut into the pieces that the tokenizer's pattern
gives; the distinct pieces that are not tokens themselves become
(word, position, token) rows in an in-process DuckDB.  A recursive query joins
neighbouring rows with the merge table and contracts, in every word, the
leftmost pair of minimum rank, until no word has a pair left.  Decoding joins ids
with the vocabulary and concatenates by an ordered aggregation.

A piece of more than ``SHORT`` bytes is cut in stretches of that many, each
contracted as a word of its own.  Where two stretches meet, a few tokens on
either side are then contracted again as one word; while that changes its first
or last token, what stands around is contracted again in turn, twice as wide.  The
result is exact: a sequence of tokens is the encoding of its bytes if, and only
if, each two neighbours alone are the encoding of theirs, because no contraction
ever crosses a place that none crosses in its two neighbours; and a window whose
first and last tokens stay leaves all pairs of neighbours as some encoding had
them.  So the work grows with the length of a piece, not with its square, and
only a change that carries along a whole run (as in a run of one letter) makes
windows long.  In those all occurrences of a pair go at once where the new token
cannot form a pair of smaller rank (see :func:`_vocabulary`), in queries of a
bounded number of steps.

Edge cases: a null or empty text has no ids and decodes to no bytes; a text of any
length is read whole, a piece of a megabyte without a space included; row count,
repeated rows, ties and null ids pass through; an empty table gives an empty
table; columns other than the id and the text are not read, so that none can
clash.  Lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomgraph.llm.common import IdPool, each_slice, fields

#: Bytes of distinct pieces that one recursive query takes, and rows of all its steps together.
QUERY_BYTES, QUERY_ROWS = 400_000, 4_000_000
#: Text bytes that are encoded together; bytes of long pieces that are stitched together.
TEXT_BYTES, STITCHED = 8_000_000, 2_000_000
#: Words and pieces, and ids of all of them, beyond which a worker forgets them.
REMEMBERED, REMEMBERED_IDS = 1_500_000, 12_000_000
#: Bytes of a stretch of a longer piece; bytes up to which a window takes one contraction a step; tokens on each side of a junction.
SHORT, WINDOW, MARGIN = 40, 200, 4
#: Ids that one ordered aggregation decodes.
DECODED_IDS = 500_000

#: A state row is a token, its place in its word and what it makes with its right neighbour.
_START = """
SELECT 0 AS step, s.word, s.pos, s.token, m.merged, m.again
FROM (SELECT word, pos, token, lead(token) OVER (PARTITION BY word ORDER BY pos) AS after FROM start) s
LEFT JOIN merges m ON m.pair = s.token::BIGINT * 4294967296 + s.after
"""

#: What stops the query below when it meets rows that are not in order.
_DISORDER = "rows are not in order"
_CHECKED = f"""CASE WHEN next_word < word OR (next_word = word AND next_pos <= pos) OR last_word > word OR (last_word = word AND last_pos >= pos)
    THEN error('{_DISORDER}')::INTEGER"""

#: One contraction a word and step: its leftmost pair of minimum rank.  Neighbours are those in the stream of rows, which
#: saves a sort a step; every step checks that the stream is in order of word and place, and stops if it is not.
_STREAMED = f"""
WITH RECURSIVE grown AS (
    SELECT 0 AS step, s.word, s.pos, s.token, m.merged
    FROM (SELECT word, pos, token, {_CHECKED} WHEN next_word = word THEN next_token END AS after
          FROM (SELECT *, lag(pos) OVER () AS last_pos, lag(word) OVER () AS last_word, lead(word) OVER () AS next_word,
                       lead(pos) OVER () AS next_pos, lead(token) OVER () AS next_token FROM start)) s
    LEFT JOIN merges m ON m.pair = s.token::BIGINT * 4294967296 + s.after
    UNION ALL
    (SELECT t.step + 1, t.word, t.pos, t.token, m.merged
     FROM (SELECT step, word, pos, CASE WHEN pos = best THEN merged ELSE token END AS token,
                  {_CHECKED}
                  WHEN pos = best THEN CASE WHEN second_word = word THEN second END
                  WHEN next_word = word THEN CASE WHEN next_pos = best THEN next_merged ELSE next_token END END AS after
           FROM (SELECT *, lag(pos) OVER () AS last_pos, lag(word) OVER () AS last_word,
                        lead(pos) OVER () AS next_pos, lead(word) OVER () AS next_word, lead(merged) OVER () AS next_merged,
                        lead(token) OVER () AS next_token, lead(token, 2) OVER () AS second, lead(word, 2) OVER () AS second_word
                 FROM (SELECT g.*, b.best FROM grown g JOIN (
                     SELECT word, (min(merged::BIGINT * 65536 + pos) % 65536)::INTEGER AS best
                     FROM grown WHERE merged IS NOT NULL GROUP BY word) b ON b.word = g.word))
           WHERE NOT (last_word IS NOT DISTINCT FROM word AND last_pos IS NOT DISTINCT FROM best)) t
     LEFT JOIN merges m ON m.pair = t.token::BIGINT * 4294967296 + t.after)
)
"""

#: The same by sorting, for the case that a stream is out of order.
_SORTED = f"""
WITH RECURSIVE grown AS (
    {_START}
    UNION ALL
    (SELECT t.step + 1, t.word, t.pos, t.token, m.merged, m.again
     FROM (SELECT step, word, pos, CASE WHEN spot = best THEN merged ELSE token END AS token,
                  CASE WHEN spot = best THEN second WHEN next_spot = best THEN next_merged ELSE first END AS after
           FROM (SELECT *, min(spot) OVER whole AS best, lag(spot) OVER line AS last_spot, lead(spot) OVER line AS next_spot,
                        lead(merged) OVER line AS next_merged, lead(token) OVER line AS first, lead(token, 2) OVER line AS second
                 FROM (SELECT *, merged::BIGINT * 65536 + pos AS spot FROM grown)
                 WINDOW line AS (PARTITION BY word ORDER BY pos),
                        whole AS (PARTITION BY word ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
           WHERE best IS NOT NULL AND last_spot IS DISTINCT FROM best) t
     LEFT JOIN merges m ON m.pair = t.token::BIGINT * 4294967296 + t.after)
)
"""

#: The same, but all occurrences of the pair at once where its ``again`` allows it, and STEPS steps at most.
_LONG = f"""
WITH RECURSIVE grown AS (
    {_START}
    UNION ALL
    (WITH same AS (
        SELECT *, coalesce(merged = min(merged) OVER (PARTITION BY word), false) AS hit,
               count(merged) OVER (PARTITION BY word) AS pairs,
               row_number() OVER (PARTITION BY word ORDER BY pos) AS nth
        FROM grown WHERE step < STEPS
    ), runs AS (
        SELECT *, nth - row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS run,
               row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS among
        FROM same WHERE pairs > 0
    ), taken AS (
        SELECT *, hit AND CASE WHEN again THEN row_number() OVER (PARTITION BY word, hit, run ORDER BY pos) % 2 = 1
                               ELSE among = 1 END AS take
        FROM runs
    ), placed AS (
        SELECT *, lag(take, 1, false) OVER (PARTITION BY word ORDER BY pos) AS eaten FROM taken
    ), next AS (
        SELECT step, word, pos, token, lead(token) OVER (PARTITION BY word ORDER BY pos) AS after
        FROM (SELECT step, word, pos, CASE WHEN take THEN merged ELSE token END AS token FROM placed WHERE NOT eaten)
    )
    SELECT t.step + 1, t.word, t.pos, t.token, m.merged, m.again
    FROM next t LEFT JOIN merges m ON m.pair = t.token::BIGINT * 4294967296 + t.after)
)
"""

_DONE = """
SELECT word, token, merged IS NOT NULL AS more FROM grown JOIN (SELECT word, max(step) AS step FROM grown GROUP BY word) USING (word, step)
ORDER BY word, pos
"""

_DECODE = """
SELECT doc, list_aggregate(list(v.hex ORDER BY pos), 'string_agg', '') AS hex
FROM ids JOIN vocabulary v ON v.token = ids.token GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base-64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def _vocabulary(path: str):
    """The ranks, a connection that holds the merge table, the token of each byte, and the bytes of each token.

    A merge row says that two neighbouring tokens make a third.  ``again`` is
    true if no token of smaller rank starts or ends with the new one: then no
    pair around it can come before the other occurrences of the same pair.
    """
    import duckdb

    ranks = read_ranks(path)
    unsafe = set()
    left, right, made = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and a > rank:
                unsafe.add(a)
            if b is not None and b > rank:
                unsafe.add(b)
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                made.append(rank)
    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})  # nothing is spilled
    con.execute("SET disabled_optimizers = 'join_order,build_side_probe_side'")  # the left side of a join streams
    again = [m not in unsafe for m in made]
    pair = (np.array(left, np.int64) << 32) + np.array(right, np.int64)
    con.register("m", pa.table({"pair": pair, "merged": pa.array(made, pa.int32()), "again": again}))
    con.execute("CREATE TABLE merges AS SELECT * FROM m")
    con.unregister("m")
    con.register("v", pa.table({"token": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]}))
    con.execute("CREATE TABLE vocabulary AS SELECT * FROM v")
    con.unregister("v")
    single = np.full(256, -1, np.int32)
    for token, rank in ranks.items():
        if len(token) == 1:
            single[token[0]] = rank
    width = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    width[list(ranks.values())] = [len(token) for token in ranks]
    return ranks, con, single, width


def _batches(pieces: list[bytes], rows: int) -> Iterator[list[bytes]]:
    """Runs of pieces for a query each, one at least."""
    at = 0
    while at < len(pieces):
        end, size, made = at, 0, 0
        while end < len(pieces):
            n = len(pieces[end])
            if end > at and (size + n > QUERY_BYTES or made + n * (n + 1) // 2 > rows):
                break
            size, made, end = size + n, made + n * (n + 1) // 2, end + 1
        yield pieces[at:end]
        at = end


def _start(lengths: np.ndarray, token: np.ndarray) -> pa.Table:
    word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    pos = (np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
    return pa.table({"word": word, "pos": pos, "token": token})


def _words(pieces: list[bytes], con, single: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Some of the pieces at a time, how many ids each has, and their ids, by one contraction a word and step."""
    import duckdb

    for some in _batches(pieces, QUERY_ROWS):
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        con.register("start", _start(lengths, single[np.frombuffer(b"".join(some), np.uint8)]))
        try:
            got = con.sql(_STREAMED + _DONE).to_arrow_table()
        except duckdb.Error as e:
            if _DISORDER not in str(e):
                raise
            got = con.sql(_SORTED + _DONE).to_arrow_table()
        con.unregister("start")
        yield some, np.bincount(got.column("word").to_numpy(), minlength=len(some)), got.column("token").to_numpy().astype(np.uint32)


def _run(piece: bytes, con, single: np.ndarray) -> np.ndarray:
    """The ids of one long window, by queries of as many steps as keep their rows within ``QUERY_ROWS``."""
    token, more = single[np.frombuffer(piece, np.uint8)], True
    while more:
        con.register("start", _start(np.array([len(token)]), token))
        got = con.sql(_LONG.replace("STEPS", str(max(4, QUERY_ROWS // len(token)))) + _DONE).to_arrow_table()
        con.unregister("start")
        token = got.column("token").to_numpy().astype(np.int32)
        more = bool(pc.any(got.column("more")).as_py())
    return token.astype(np.uint32)


def _windows(pieces: list[bytes], con, single: np.ndarray) -> dict[bytes, np.ndarray]:
    """The ids of each distinct stretch or window."""
    out = {}
    distinct = dict.fromkeys(pieces)
    for some, sizes, ids in _words([p for p in distinct if len(p) <= WINDOW], con, single):
        out.update(zip(some, np.split(ids, np.cumsum(sizes)[:-1]), strict=True))
    out.update((p, _run(p, con, single)) for p in distinct if len(p) > WINDOW)
    return out


def _stitched(pieces: list[bytes], con, single: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each of some long pieces has, and their ids, by stretches and windows around their junctions."""
    raw = b"".join(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes)
    cuts = np.concatenate([np.arange(e - n, e, SHORT) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)])
    stretches = [raw[a:b] for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(raw)], strict=True)]
    known = _windows(stretches, con, single)
    tokens = np.concatenate([known[s] for s in stretches])
    # junctions and the pieces' ends, as places in bytes, which contractions leave as they are
    junctions, margin = np.setdiff1d(cuts, ends - sizes), MARGIN
    while len(junctions):
        places = np.r_[0, np.cumsum(width[tokens])]
        first, last = np.searchsorted(places, ends - sizes), np.searchsorted(places, ends)
        at = np.searchsorted(places, junctions)
        owner = np.searchsorted(ends, junctions, "right")
        low, high = np.maximum(at - margin, first[owner]), np.minimum(at + margin, last[owner])
        # windows that overlap are one
        begins = np.flatnonzero(np.r_[True, low[1:] >= np.maximum.accumulate(high)[:-1]])
        low, high, owner = low[begins], np.maximum.reduceat(high, begins), owner[begins]
        texts = [raw[a:b] for a, b in zip(places[low].tolist(), places[high].tolist(), strict=True)]
        known = _windows(texts, con, single)
        parts, left, done = [], [], 0
        for a, b, text, own in zip(low.tolist(), high.tolist(), texts, owner.tolist(), strict=True):
            new = known[text]
            parts += [tokens[done:a], new]
            if a > first[own] and new[0] != tokens[a]:
                left.append(places[a])
            if b < last[own] and new[-1] != tokens[b - 1]:
                left.append(places[b])
            done = b
        tokens = np.concatenate([*parts, tokens[done:]])
        junctions, margin = np.unique(np.array(left, np.int64)), margin * 2
    places = np.cumsum(width[tokens])
    return np.diff(np.searchsorted(places, ends, "left") + 1, prepend=0), tokens


def merge_pieces(pieces: list[bytes], path: str) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Some of the non-empty pieces at a time, how many ids each has, and their ids, by the recursive queries."""
    _, con, single, width = _vocabulary(path)
    yield from _words([p for p in pieces if len(p) <= SHORT], con, single)
    some, size = [], 0
    for piece in pieces:
        if len(piece) > SHORT:
            some.append(piece)
            size += len(piece)
            if size >= STITCHED:
                yield some, *_stitched(some, con, single, width)
                some, size = [], 0
    if some:
        yield some, *_stitched(some, con, single, width)


class Encoder(IdPool):
    """Encodes texts in batches and remembers a bounded number of words.

    Where a space follows what is no white space, the pattern always parts the
    text.  So a text is the words between single spaces, each but the first with
    the space before it, and words recur.  A text with a word that is empty or
    ends in white space is cut by the pattern as a whole.
    """

    def __init__(self, path: str, pattern: str):
        import regex

        self.path, self.cut = path, regex.compile(pattern).findall
        self.ranks = _vocabulary(path)[0]
        super().__init__()

    def learn(self, new: list[str]) -> None:
        """Remember the ids of each word and of its pieces; a piece that is a token is its own id."""
        known, ranks = self.known, self.ranks
        cut = [self.cut(word) for word in new]
        tokens: dict[str, int] = {}
        pieces: dict[bytes, str] = {}
        for piece in dict.fromkeys(chain.from_iterable(cut)):
            if piece not in known:
                raw = piece.encode()
                if (rank := ranks.get(raw)) is None:
                    pieces[raw] = piece
                else:
                    tokens[piece] = rank
        self.add(list(tokens), np.ones(len(tokens), np.int64), np.fromiter(tokens.values(), np.uint32, len(tokens)))
        for some, sizes, ids in merge_pieces(sorted(pieces), self.path):
            self.add([pieces[raw] for raw in some], sizes, ids)
        many = [(word, own) for word, own in zip(new, cut, strict=True) if len(own) > 1 and word not in known]
        if many:
            numbers = self.numbers(list(chain.from_iterable(own for _, own in many)))
            counts = np.fromiter((len(own) for _, own in many), np.int64, len(many))
            ids, _ = self.gather(numbers)
            self.add([word for word, _ in many], np.add.reduceat(self.size[numbers], np.cumsum(counts) - counts), ids)

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Each text's ids, packed as little-endian unsigned 32-bit integers."""
        if not len(texts):
            return []
        if len(self.known) > REMEMBERED or len(self.pool) > REMEMBERED_IDS:
            self.forget()
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        lists = pc.split_pattern(texts, " ")
        words = pc.dictionary_encode(lists.flatten())
        distinct, index = words.dictionary.to_pylist(), words.indices.to_numpy()
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        starts = np.cumsum(counts) - counts
        odd = np.fromiter((not w or w[-1].isspace() for w in distinct), bool, len(distinct))
        whole = np.add.reduceat(odd[index].astype(np.int64), starts) > 0
        plain = np.repeat(~whole, counts)
        first = np.zeros(len(index), bool)
        first[starts] = True
        later, initial = np.unique(index[plain & ~first]), np.unique(index[plain & first])
        number = np.zeros((2, len(distinct)), np.int64)
        number[0, later] = self.learned([" " + distinct[i] for i in later])
        number[1, initial] = self.learned([distinct[i] for i in initial])
        flat, ends = self.gather(number[first[plain].astype(np.int64), index[plain]])
        own = counts[~whole]
        parts = iter(np.split(flat, ends[np.cumsum(own)[:-1] - 1]) if len(own) else [])
        out = []
        for i, by_pattern in enumerate(whole):
            if by_pattern:
                ids, _ = self.gather(self.learned(self.cut(texts[i].as_py())))
            else:
                ids = next(parts)
            out.append(ids.astype("<u4").tobytes())
        return out


def decode(packed: list[bytes], path: str) -> list[bytes]:
    """The bytes of each text, from its packed ids, by an ordered aggregation."""
    con = _vocabulary(path)[1]
    out = [b""] * len(packed)
    at = 0
    while at < len(packed):
        end, size = at, 0
        while end < len(packed) and (end == at or size + len(packed[end]) // 4 <= DECODED_IDS):
            size += len(packed[end]) // 4
            end += 1
        lengths = np.fromiter((len(p) // 4 for p in packed[at:end]), np.int64, end - at)
        doc = np.repeat(np.arange(at, end, dtype=np.int32), lengths)
        pos = np.arange(size, dtype=np.int32)
        token = np.frombuffer(b"".join(packed[at:end]), "<u4").astype(np.int32)
        con.register("ids", pa.table({"doc": doc, "pos": pos, "token": token}))
        for d, text in con.sql(_DECODE).fetchall():
            out[d] = bytes.fromhex(text)
        con.unregister("ids")
        at = end
    return out


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id and ``ids``, an array of token ids."""
    picked = fields(df, id_col, text_col)
    out = T.StructType([T.StructField(id_col, picked.schema[0].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for part in each_slice(batches, text_col, TEXT_BYTES):
            packed = encoder.encode(part.column(1))
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends), flat, type=pa.list_(pa.field("element", pa.int32(), False)))
            yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[id_col, "ids"])

    return picked.mapInArrow(run, out)


def digest(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text; return counts and digests of both."""
    picked = fields(df, id_col, text_col)
    out = T.StructType(
        [
            T.StructField("doc_id", picked.schema[0].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for part in each_slice(batches, text_col, TEXT_BYTES):
            packed = encoder.encode(part.column(1))
            texts = decode(packed, path)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                names=out.names,
            )

    return picked.mapInArrow(run, out)
