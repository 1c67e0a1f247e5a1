"""Near-duplicate passages by compact windows.

A text is its sequence of 5-word shingles, ASCII letters in lower case.  Under
each of ``HASHES`` hash orders, the Cartesian tree of the sequence has a node for each
shingle: the widest stretch in which it is the smallest.  Nodes of at least
``WIDTH`` shingles (50 words) are compact windows: one row stands for all passages
that share this minimum.  Only minima of some stretch of that width have one, about
two in ``WIDTH``, and they are found by a sliding minimum before the tree is built.

1. Windows are grouped by hash order and minimum.  Members of a small group are
   paired.  In a crowded one, members are sorted by a second signature of what
   stands around, so that like stand next to like; each is paired with the first
   and the one before, and under the first order its stretches are compared
   exactly (3).  Windows that crowd within some megabytes of text are sorted and
   paired so in groups of their own there.  All other pairs of a crowded group's
   windows, one of each content, are compared by :class:`_Crowd`, with no cap.
   Of a minimum that returns in even steps through a periodic stretch, its first
   and last window go, and all starts there are compared exactly.
2. The pairs of two texts are joined as intervals: windows must overlap, when
   aligned, in enough shingles, and a passage needs the first order or two others.
3. Both sides of a candidate meet as shingle hashes and are verified: a stretch
   of ``WIDTH`` shingles counts if its Jaccard similarity is 0.8 or more.
   Stretches of crowded groups are grouped by their whole content, so that an
   exact repeat is found in a group of any size without pairs.

Equal texts are one text up to the end.  A hash order keeps every stretch's
minimum, so an exact repeat of 50 words is always found; a near repeat is found
if the first order or two others agree, which a stretch does with probability 0.995,
or in a crowded group any order, whatever the group's size: the tests measure 0.95 or more of near repeats found in groups of 2 to 1000.

Words are compared by hash: shingles of two sides by 32 bits within their candidate,
where 41 of 46 must agree in alignment, whole stretches and whole texts by 64 bits.

Edge cases: null and empty texts, and texts of fewer than 50 words, have no
passages; a text of any length is read whole; rows with a null id take no part;
ids may be of any orderable type (others than whole numbers are numbered in their
order first); repeated rows are equal texts, and of unlike texts under one id some
links may be missed; passages that repeat only within one
text don't count; an empty table gives an empty table; columns other than the id
and the text are not read, and :func:`strip` carries them unchanged whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import discard, each_slice, written
from loomgraph.llm.components import components
from loomgraph.operators import paging

#: Words of a shingle, words of the shortest passage, shingles of that, hash orders.
SHINGLE, PASSAGE = 5, 50
WIDTH = PASSAGE - SHINGLE + 1
HASHES = 5
#: Members up to which a group is paired out; shingles by which aligned places may drift.
SMALL, DRIFT = 4, 5
#: Windows of a chunk; of a minimum in a chunk beyond which it is dealt to groups of BLOCK; windows paired at once.
CHUNK, LOCAL, BLOCK, GROUPED = 600_000, 8, 1000, 200_000
#: Windows of crowded groups, and pairs of them, that are compared at once; a group is never cut.
CROWD, PAIRED = 5000, 20_000
#: Pairs of windows that are aligned side by side.
ABREAST = 2048
#: Steps of all values at once towards the nearest smaller ones.
ROUNDS = 24
#: Shared shingles of two stretches of WIDTH at a similarity of 0.8: m / (2 * WIDTH - m) >= 0.8.
ENOUGH = -(-8 * WIDTH // 9)
#: Requests on one text that a row holds.
REQUESTS = 2000
#: Bits of a place in stretches that are verified many at once (longer ones are one by one), and shingles of those.
_SPOT, SPANNED = 12, 400_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = np.uint64((1 << 28) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
#: The first bytes of a number, by how many.
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _spread(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, and the last ends; a null is empty."""
    flat = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and how many each text has."""
    space = _SPACE[data]
    cut = np.zeros(len(data) + 1, bool)  # where a text begins or ends
    cut[offsets] = True
    before, after = cut.copy(), cut
    before[1:] |= space
    after[:-1] |= space
    first, last = np.flatnonzero(before[:-1] & ~space), np.flatnonzero(after[1:] & ~space)
    return first, last + 1, np.diff(np.searchsorted(first, offsets))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all texts, ASCII letters in lower case, one after another, and how many each text has.
    Words of up to 16 bytes are hashed as two numbers and their length."""
    import xxhash

    data, offsets = _spread(texts)
    first, end, n_words = _words(data, offsets)
    data = np.r_[_LOWER[data], np.zeros(16, np.uint8)]
    size = end - first
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    with np.errstate(over="ignore"):
        head, tail = eight[first] & _BYTES[np.minimum(size, 8)], eight[first + 8] & _BYTES[np.clip(size - 8, 0, 8)]
        h = _mix(_mix(tail + size.astype(np.uint64) * _ODD) + head)
    long = np.flatnonzero(size > 16)
    if len(long):
        whole = memoryview(data)
        h[long] = np.fromiter((xxhash.xxh64_intdigest(whole[a:b]) for a, b in zip(first[long].tolist(), end[long].tolist(), strict=True)), np.uint64, len(long))
    return h, n_words


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, one after another, and how many each has."""
    h, n_words = word_hashes(texts)
    with np.errstate(over="ignore"):
        x = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
        for i in range(SHINGLE):
            x = x * _ODD + h[i : len(h) - SHINGLE + 1 + i]
        x = _mix(x)
    counts = np.maximum(n_words - SHINGLE + 1, 0)
    # shingles that run over the end of a text go
    place = np.arange(len(h)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    keep = (np.repeat(n_words, n_words) - place >= SHINGLE)[: len(x)]
    return x[keep], counts


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    n = len(x)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = x
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _places(counts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each shingle its text and its place there, and the shingles at which a stretch of ``width`` begins."""
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, place, np.flatnonzero(np.repeat(counts, counts) - place >= width)


def _smaller(values: np.ndarray, last: np.ndarray, step: int) -> np.ndarray:
    """The nearest smaller value's place that way, or -1 where none is up to the ``last``.  What lies between a value and
    where it points is larger, so that it may go on to where that points.  Where that takes more than ``ROUNDS``, as in a
    periodic stretch, values are taken one by one."""
    n = len(values)
    to = np.where(last, -1, np.arange(n) + step)
    todo = np.flatnonzero(to >= 0)
    for _ in range(ROUNDS):
        at = to[todo]
        larger = values[at] > values[todo]
        todo = todo[larger]
        to[todo] = to[at[larger]]
        todo = todo[to[todo] >= 0]
        if not len(todo):
            return to
    part = np.cumsum(last[::-step])[::-step]  # from each last on
    slow = np.flatnonzero(np.isin(part, part[todo]))[::-step]
    stack: list[int] = []
    kept = values.tolist()
    for i, fresh in zip(slow.tolist(), last[slow].tolist(), strict=True):
        if fresh:
            stack = []
        while stack and kept[stack[-1]] > kept[i]:
            stack.pop()
        to[i] = stack[-1] if stack else -1
        stack.append(i)
    return to


def compact_windows(
    x: np.ndarray, counts: np.ndarray, order: int, width: int = WIDTH, places: tuple[np.ndarray, ...] | None = None
) -> tuple[np.ndarray, ...]:
    """(text, left, place, right) of every Cartesian tree node of at least ``width`` shingles under an order.

    Equal shingles rank by place, so that each stretch has one minimum.
    """
    if len(x) < width:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    owner, place, inside = places or _places(counts, width)
    with np.errstate(over="ignore"):
        ranked = (_mix(x + np.uint64(order + 1) * _ODD) & ~_PLACE) | place.astype(np.uint64)
    lowest = _sliding_minimum(ranked, width)
    lowest, text = lowest[inside], owner[inside]
    fresh = np.flatnonzero(np.r_[True, (lowest[1:] != lowest[:-1]) | (text[1:] != text[:-1])]) if len(lowest) else np.zeros(0, np.int64)
    rank, text = lowest[fresh], text[fresh]
    at = (rank & _PLACE).astype(np.int64)
    # ancestors of a wide node are wide: its nearest smaller neighbours are among the minima
    other = np.r_[True, text[1:] != text[:-1]]
    left, right = _smaller(rank, other, -1), _smaller(rank, np.r_[other[1:], True], 1)
    lo = np.where(left >= 0, at[left] + 1, 0)
    hi = np.where(right >= 0, at[right] - 1, counts[text] - 1)
    return text, lo, at, hi


def _text_ids(texts: pa.Array) -> np.ndarray:
    """As Spark's xxhash64 of the text."""
    import xxhash

    data, offsets = _spread(texts)
    whole, at = memoryview(data), offsets.tolist()
    return np.fromiter((xxhash.xxh64_intdigest(whole[a:b], 42) for a, b in zip(at, at[1:], strict=False)), np.uint64, len(texts)).view(np.int64)


def _light(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text its id, a hash, and the number of its words."""
    for part in each_slice(batches, "text"):
        n_words = _words(*_spread(part.column(1)))[2]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_text_ids(part.column(1))), pa.array(n_words.astype(np.int32))], names=["id", "text_id", "n_words"])


# A window is a minimum, a text and a packed number: from the top, bits of a second signature of what stands around, the
# hash order, whether its group is crowded, whether it stands for others elsewhere, and how far it reaches on either side
# of its place, up to WIDTH - 1.
_AT, _SIDE = 28, 6
_RIGHT, _LEFT, _REP, _CROWDED, _ORDER, _NEAR = _AT, _AT + _SIDE, _AT + 2 * _SIDE, _AT + 2 * _SIDE + 1, _AT + 2 * _SIDE + 2, _AT + 2 * _SIDE + 5
#: The order that marks starts of stretches rather than a window.
_STARTS = 7
#: Sides of requests that are no side of a pair: stretches for the exact way, windows of crowded groups.
_EXACT, _REST = -1, -2


def _bits(packed: np.ndarray, place: int, size: int) -> np.ndarray:
    return (packed >> place) & ((1 << size) - 1)


def _runs(same: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last of each four or more windows in even steps, each reaching from behind the one before to where the first ends."""
    step = np.diff(at)
    chained = same & (step > 0) & (step < WIDTH) & (lo[1:] == at[:-1] + 1) & (hi[1:] == hi[:-1])
    even = chained[1:] & chained[:-1] & (step[1:] == step[:-1])
    edges = np.flatnonzero(np.diff(np.r_[0, even.astype(np.int8), 0]))
    for begin, end in edges.reshape(-1, 2).tolist():
        if end - begin >= 2:
            yield begin, end + 1


class _Chunk:
    """Windows of some texts, to be sent to the groups of their minima.

    Of a minimum that returns in even steps through a periodic stretch, the first and the last window go, marked as
    crowded, and the starts of all stretches of the first order.  A minimum with more than ``LOCAL`` windows gets groups
    of its own, of ``BLOCK`` windows with like surroundings; of each the first also goes to the common group.  So a
    group has at most ``LOCAL`` windows a chunk, however common its minimum.
    """

    def __init__(self) -> None:
        self.held: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(HASHES)]
        self.size = 0

    def add(self, texts: pa.Array, ids: np.ndarray) -> None:
        x, counts = shingle_hashes(texts)
        starts, places = np.cumsum(counts) - counts, _places(counts)
        if len(x) < WIDTH:
            return
        with np.errstate(over="ignore"):
            around = _sliding_minimum(_mix(x + np.uint64(HASHES + 1) * _ODD), WIDTH)
        summed = _Sums(x)
        for j in range(HASHES):
            text, lo, at, hi = compact_windows(x, counts, j, WIDTH, places)
            with np.errstate(over="ignore"):
                minimum = _mix(x[starts[text] + at] ^ (np.uint64(j + 1) * _ODD)).view(np.int64)
                middle = starts[text] + np.minimum(np.maximum(at - WIDTH // 2, 0), counts[text] - WIDTH)
                near = (_mix(around[middle]) >> np.uint64(_NEAR)).astype(np.int64) << _NEAR
            own, starts_of, crowded, more = ids[text], starts[text], np.zeros(len(at), bool), []
            # windows come by text and place; in a periodic stretch only those of its minimum are wide
            same = (text[1:] == text[:-1]) & (minimum[1:] == minimum[:-1])
            gone = np.zeros(len(at), bool)
            for a, b in _runs(same, at, lo, hi) if same.any() else ():
                base, period = starts[text[a]], at[a + 1] - at[a]
                run = x[base + at[a] : base + at[b] + 1]
                if (run[period:] == run[:-period]).all():
                    gone[a + 1 : b] = crowded[a] = crowded[b] = True
                    lo[b] = lo[a]
                    if j == 0:
                        begin, end = max(int(lo[a]), int(at[a]) - WIDTH + 1), min(int(at[b]), int(hi[a]) - WIDTH + 1)
                        more.append((own[a], np.arange(begin, end + 1, WIDTH), end))
            if more or gone.any():
                minimum, near, own, starts_of, lo, at, hi, crowded = (v[~gone] for v in (minimum, near, own, starts_of, lo, at, hi, crowded))
            left, right = np.minimum(at - lo, WIDTH - 1), np.minimum(hi - at, WIDTH - 1)
            packed = near | (j << _ORDER) | (crowded.astype(np.int64) << _CROWDED) | (left << _LEFT) | (right << _RIGHT) | at
            content = summed.hashes(starts_of + at - left, starts_of + at + right + 1)
            self.held[j].append((minimum, packed, own, content))
            for t, begins, end in more:
                packed = (_STARTS << _ORDER) | (np.minimum(end - begins, WIDTH - 1) << _RIGHT) | begins
                with np.errstate(over="ignore"):
                    self.held[j].append((_mix(begins.astype(np.uint64) + np.uint64(int(t) & ((1 << 64) - 1))).view(np.int64), packed, np.full(len(begins), t), np.zeros(len(begins), np.int64)))
            self.size += len(at)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for held in self.held:
            if not held:
                continue
            minimum, packed, text, content = (np.concatenate(c) for c in zip(*held, strict=True))
            common = minimum
            order = np.argsort(minimum, kind="stable")
            m = minimum[order]
            fresh = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
            sizes = np.diff(np.r_[fresh, len(m)])
            if (sizes > LOCAL).any():
                some = order[np.repeat(sizes > LOCAL, sizes)]
                some = some[np.lexsort((text[some], packed[some], minimum[some]))]
                key = minimum[some]
                begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                number = np.arange(len(some)) - np.repeat(begins, np.diff(np.r_[begins, len(some)]))
                heads = np.flatnonzero(number % BLOCK == 0)
                packed[some] |= 1 << _CROWDED
                with np.errstate(over="ignore"):
                    salt = _mix(text[some[heads]].view(np.uint64) + np.uint64(1)) ^ key[heads].view(np.uint64)
                own = _mix(np.repeat(salt, np.diff(np.r_[heads, len(some)]))).view(np.int64)
                extra = minimum[some[heads]], packed[some[heads]] | (1 << _REP), text[some[heads]]
                common = np.r_[minimum, extra[0]]
                minimum[some] = own
                minimum, packed, text = (np.concatenate([c, e]) for c, e in zip((minimum, packed, text), extra, strict=True))
                content = np.r_[content, content[some[heads]]]
            moved = pa.array(common, mask=common == minimum)
            yield pa.RecordBatch.from_arrays([pa.array(minimum), pa.array(packed), pa.array(text), pa.array(content), moved], names=["minimum", "packed", "text", "content", "common"])
        self.__init__()


def _windows(df: DataFrame) -> DataFrame:
    """The compact windows of each text, once a task: ``minimum``, ``packed``, ``text``, ``content`` (a hash of the
    window's shingles) and ``common`` (the minimum, where the window is in a group of its chunk)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        chunk = _Chunk()
        for part in each_slice(batches, "text"):
            ids = _text_ids(part.column(0))
            new = [i for i, t in enumerate(ids.tolist()) if not (t in seen or seen.add(t))]
            chunk.add(part.column(0).take(pa.array(new, pa.int32())), ids[new])
            if chunk.size >= CHUNK:
                yield from chunk.rows()
        yield from chunk.rows()

    return df.select("text").mapInArrow(run, "minimum bigint, packed bigint, text bigint, content bigint, common bigint")


_PAIRS = "hash_no tinyint, a bigint, b bigint, at_a int, at_b int, lo int, hi int"
_NAMES = ["hash_no", "a", "b", "at_a", "at_b", "lo", "hi"]
_MORE = ["content", "common"]
_KINDS = [pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]


def _grouped_pairs(minimum: np.ndarray, packed: np.ndarray, text: np.ndarray, small: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs, as columns of ``_NAMES``, of whole groups of windows that come in order."""
    new = np.r_[True, (minimum[1:] != minimum[:-1]) | (packed[1:] != packed[:-1]) | (text[1:] != text[:-1])]  # else an equal text from another task
    starts = new & (_bits(packed, _ORDER, 3) == _STARTS)
    if starts.any():
        t, at, more = text[starts], packed[starts] & ((1 << _AT) - 1), _bits(packed[starts], _RIGHT, _SIDE)
        yield np.zeros(len(t), np.int64), t, t, at, at, at, at + more
    keep = new & ~starts
    minimum, packed, text = minimum[keep], packed[keep], text[keep]
    first = np.flatnonzero(np.r_[True, minimum[1:] != minimum[:-1]]) if len(minimum) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, len(minimum)])
    many = np.repeat(sizes > 1, sizes)
    minimum, packed, text = minimum[many], packed[many], text[many]
    sizes = sizes[sizes > 1]
    if not len(sizes):
        return
    first = np.cumsum(sizes) - sizes
    crowded = (np.maximum.reduceat(_bits(packed, _CROWDED, 1), first) > 0) | (sizes > small)
    nth = np.arange(len(text)) - np.repeat(first, sizes)
    whole, head = np.repeat(crowded, sizes), np.repeat(first, sizes)
    at, left, right, order = packed & ((1 << _AT) - 1), _bits(packed, _LEFT, _SIDE), _bits(packed, _RIGHT, _SIDE), _bits(packed, _ORDER, 3)

    def pairs(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
        low, high = -np.minimum(left[p], left[q]), np.minimum(right[p], right[q])
        fit = (text[p] != text[q]) & (high - low + 1 >= WIDTH - DRIFT)  # aligned at the minimum, both windows span this much
        p, q, low, high = p[fit], q[fit], low[fit], high[fit]
        swap = text[p] > text[q]
        p, q = np.where(swap, q, p), np.where(swap, p, q)
        return order[p], text[p], text[q], at[p], at[q], low, high

    for k in range(1, small):
        later = np.flatnonzero(~whole & (nth >= k))
        if len(later):
            yield pairs(later - k, later)
    later = np.flatnonzero(whole & (nth > 0))
    if len(later):
        yield pairs(head[later], later)
        later = later[nth[later] > 1]
        yield pairs(later - 1, later)
    alone = np.flatnonzero(whole & (order == 0) & (_bits(packed, _REP, 1) == 0))
    if len(alone):
        own = at[alone]
        yield order[alone], text[alone], text[alone], own, own, own - left[alone], np.minimum(own, own + right[alone] - WIDTH + 1)


def _crowded_windows(minimum: np.ndarray, packed: np.ndarray, text: np.ndarray, content: np.ndarray, common: np.ndarray, small: int) -> tuple[np.ndarray, ...]:
    """The windows of crowded groups, one of each text and content, as columns of ``_NAMES``, their content and minimum."""
    keep = np.flatnonzero(_bits(packed, _ORDER, 3) != _STARTS)
    minimum, packed, text, content, common = (c[keep] for c in (minimum, packed, text, content, common))
    first = np.flatnonzero(np.r_[True, minimum[1:] != minimum[:-1]]) if len(minimum) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, len(minimum)])
    flagged = np.maximum.reduceat(_bits(packed, _CROWDED, 1), first) > 0 if len(first) else np.zeros(0, bool)
    some = np.flatnonzero(np.repeat(flagged | (sizes > small), sizes) & (_bits(packed, _REP, 1) == 0))
    some = some[np.lexsort((text[some], content[some], common[some]))]
    minimum, packed, text, content, common = (c[some] for c in (minimum, packed, text, content, common))
    new = np.r_[True, (common[1:] != common[:-1]) | (content[1:] != content[:-1]) | (text[1:] != text[:-1])] if len(some) else np.zeros(0, bool)
    packed, text, content, common = (c[new] for c in (packed, text, content, common))
    at = packed & ((1 << _AT) - 1)
    return np.full(len(at), _REST), text, text, at, at, at - _bits(packed, _LEFT, _SIDE), at + _bits(packed, _RIGHT, _SIDE), content, common


def _pairing(small: int = SMALL, rest: bool = False):
    """Pairs of windows that share a minimum; rows come ordered by minimum, packed and text.

    A window of a crowded group under the first order also comes alone, as a pair with itself: its stretches from lo to
    hi go to the exact way.  With ``rest`` each window of a crowded group comes too, as order ``_REST``, with its content and
    minimum: they are compared by :func:`_crowded_links`.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(columns) -> Iterator[pa.RecordBatch]:
            for out in _grouped_pairs(*columns[:3], small):
                if len(out[0]):
                    own = [pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(out, _KINDS, strict=True)]
                    yield pa.RecordBatch.from_arrays([*own, *[pa.nulls(len(out[0]), pa.int64())] * 2] if rest else own, names=_NAMES + _MORE if rest else _NAMES)
            if rest:
                out = _crowded_windows(*columns, small)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(out, [*_KINDS, pa.int64(), pa.int64()], strict=True)], names=_NAMES + _MORE)

        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for batch in batches:
            own = [c.to_numpy() for c in batch.columns[:4]]
            if rest:
                own.append(pc.coalesce(batch.column(4), batch.column(0)).to_numpy())
            held.append(tuple(own if rest else own[:3]))
            n += batch.num_rows
            if n < GROUPED:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last group may go on
            if cut:
                yield from made([c[:cut] for c in columns])
            else:  # the group goes on as one that is crowded, from its last window
                yield from made([columns[0], columns[1] | (1 << _CROWDED), *columns[2:]])
                columns[1][-1] |= (1 << _CROWDED) | (1 << _REP)
                cut = n - 1
            held = [tuple(c[cut:] for c in columns)]
            n -= cut
        if n:
            yield from made([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of two texts whose windows agree under enough orders; rows come ordered by a, b, at_a."""

    def close(a: int, b: int, runs: list) -> Iterator[tuple]:
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for orders, _, _, lo_a, hi_a, lo_b, hi_b in runs:
            if 0 in orders or len(orders) > 1:
                at = max(0, lo_a), max(0, lo_b)
                old = found.get(at, (0, 0))
                found[at] = max(old[0], hi_a), max(old[1], hi_b)
        for (lo_a, lo_b), (hi_a, hi_b) in found.items():
            yield a, b, lo_a, hi_a, lo_b, hi_b

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["a", "b", "lo_a", "hi_a", "lo_b", "hi_b"])

    now, runs, near, out = None, [], [], []
    for batch in batches:
        for j, a, b, at_a, at_b, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (a, b) != now:
                if now:
                    out += close(*now, runs)
                now, runs, near = (a, b), [], []
            near = [run for run in near if at_a - run[2] < WIDTH]  # no later row reaches the others
            for run in near:
                if abs(run[1] - (at_a - at_b)) <= DRIFT:
                    run[0].add(j)
                    run[1], run[2] = at_a - at_b, at_a
                    run[3], run[4] = min(run[3], at_a + lo), max(run[4], at_a + hi)
                    run[5], run[6] = min(run[5], at_b + lo), max(run[6], at_b + hi)
                    break
            else:
                near.append([{j}, at_a - at_b, at_a, at_a + lo, at_a + hi, at_b + lo, at_b + hi])
                runs.append(near[-1])
        if out:
            yield batch_of(out)
            out = []
    if now:
        out += close(*now, runs)
    if out:
        yield batch_of(out)


def _matches(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each place of ``x`` the place of an equal value in ``y``, or -1.  A value that ``y`` has more than
    once is matched where the last value before it that ``y`` has only once leads one to expect it."""
    order = np.argsort(y, kind="stable")
    ys = y[order]
    left, right = np.searchsorted(ys, x, "left"), np.searchsorted(ys, x, "right")
    times = right - left
    where = np.full(len(x), -1)
    once = np.flatnonzero(times == 1)
    where[once] = order[left[once]]
    many = np.flatnonzero(times > 1)
    if len(many):
        before = np.searchsorted(once, many) - 1
        shift = np.where(before >= 0, once[before] - where[once[before]], 0) if len(once) else np.zeros(len(many), np.int64)
        # occurrences in y by value, then place, as one rising key
        span = len(x) + len(y) + 1
        keys = np.searchsorted(ys, ys, "left") * span + order
        want = np.clip(many - shift, 0, span - 1)
        at = np.searchsorted(keys, left[many] * span + want)
        after, prior = np.minimum(at, right[many] - 1), np.maximum(at - 1, left[many])
        nearer = np.abs(order[prior] - want) <= np.abs(order[after] - want)
        where[many] = order[np.where(nearer, prior, after)]
    return where


def shared_spans(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches of ``x`` (start and end in shingles, and the place in ``y`` that matches the start) in which
    runs of WIDTH have at least ENOUGH shingles that ``y`` has in about the same alignment."""
    if len(x) < WIDTH or not len(y):
        return []
    where = _matches(x, y)
    hits = np.flatnonzero(where >= 0)
    shifts, counts = np.unique(hits - where[hits], return_counts=True)
    total = np.cumsum(np.r_[0, counts])
    low, high = np.searchsorted(shifts, shifts - DRIFT), np.searchsorted(shifts, shifts + DRIFT, "right")
    good = np.zeros(len(x) - WIDTH + 1, bool)
    matched = np.zeros(len(x), bool)
    for shift in shifts[total[high] - total[low] >= ENOUGH]:
        aligned = np.zeros(len(x), bool)
        aligned[hits[np.abs(hits - where[hits] - shift) <= DRIFT]] = True
        sums = np.cumsum(np.r_[0, aligned])
        runs = sums[WIDTH:] - sums[:-WIDTH] >= ENOUGH
        good |= runs
        cover = np.cumsum(np.r_[runs, np.zeros(WIDTH, bool)].astype(np.int64) - np.r_[np.zeros(WIDTH, bool), runs])[: len(x)] > 0
        matched |= aligned & cover
    out = []
    starts = np.flatnonzero(good)
    for run in np.split(starts, np.flatnonzero(np.diff(starts) > WIDTH) + 1) if len(starts) else []:
        own = np.flatnonzero(matched[run[0] : run[-1] + WIDTH]) + run[0]
        out.append((int(own[0]), int(own[-1]) + 1, int(where[own[0]])))
    return out


def _all_spans(raw: pa.Array, mine: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
    """:func:`shared_spans` of many pairs of rows of ``raw`` at once, either way: pair, way (1: of ``other`` in
    ``mine``), start, end and the place that matches the start.  No side may have 1 << _SPOT shingles or more."""
    offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64) // 4
    short = np.frombuffer(raw.buffers()[2] or b"", np.uint32)
    n = len(mine)
    # all first sides, then all second ones; keys by pair, value, side and place
    rows = np.r_[mine, other]
    size = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(size)
    base = ends - size
    owner = np.repeat(np.arange(2 * n), size)
    place = np.arange(len(owner)) - base[owner]
    values = short[place + offsets[rows][owner]]
    keys = ((owner % n).astype(np.uint64) << np.uint64(33 + _SPOT)) | (values.astype(np.uint64) << np.uint64(1 + _SPOT))
    keys = np.sort(keys | ((owner >= n).astype(np.uint64) << np.uint64(_SPOT)) | place.astype(np.uint64))
    value, side = keys >> np.uint64(1 + _SPOT), ((keys >> np.uint64(_SPOT)) & np.uint64(1)).astype(np.int64)
    spot = (keys & np.uint64((1 << _SPOT) - 1)).astype(np.int64)
    at = base[(keys >> np.uint64(33 + _SPOT)).astype(np.int64) + side * n] + spot  # among all sides' shingles
    first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(keys) else np.zeros(0, np.int64)
    total = np.diff(np.r_[first, len(keys)])
    seconds = np.add.reduceat(side, first) if len(first) else first
    middle = first + total - seconds  # where the second sides of a value begin
    run = np.repeat(np.arange(len(first)), total)
    begin, end = np.where(side == 0, middle[run], first[run]), np.where(side == 0, (first + total)[run], middle[run])
    times = end - begin
    where = np.full(len(owner), -1)
    once = np.flatnonzero(times == 1)
    where[at[once]] = spot[begin[once]]
    many = np.flatnonzero(times > 1)
    if len(many):
        last = np.maximum.accumulate(np.where(where >= 0, np.arange(len(where)), -1))[at[many]]
        shift = np.where(last >= base[owner[at[many]]], place[last] - where[last], 0)
        want = np.clip(spot[many] - shift, 0, (2 << _SPOT) - 1)
        # the occurrences on either side by value, then place, as one rising key
        rising = (run * 2 + side << _SPOT + 1) | spot
        found = np.searchsorted(rising, (run[many] * 2 + 1 - side[many] << _SPOT + 1) | want)
        after, prior = np.minimum(found, end[many] - 1), np.maximum(found - 1, begin[many])
        nearer = np.abs(spot[prior] - want) <= np.abs(spot[after] - want)
        where[at[many]] = spot[np.where(nearer, prior, after)]
    hits = np.flatnonzero(where >= 0)
    lean = np.full(len(owner), -(1 << 62))  # of each shingle its side and shift
    lean[hits] = (owner[hits] * 4 + 2 << _SPOT) + place[hits] - where[hits]
    ordered = np.sort(lean[hits])
    fresh = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    shifts, upto = ordered[fresh], np.r_[fresh, len(ordered)]
    low, high = np.searchsorted(shifts, shifts - DRIFT), np.searchsorted(shifts, shifts + DRIFT, "right")
    # shifts with the same shifts about them align the same shingles
    enough = np.flatnonzero((upto[high] - upto[low] >= ENOUGH) & np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])][: len(shifts)])
    enough = enough[size[shifts[enough] >> _SPOT + 2] >= WIDTH]
    low, high, of = shifts[low[enough]], shifts[high[enough] - 1], shifts[enough] >> _SPOT + 2
    nth = np.arange(len(of)) - np.searchsorted(of, of)
    good, matched = np.zeros(len(owner), bool), np.zeros(len(owner), bool)
    for k in range(int(nth.max()) + 1 if len(nth) else 0):
        own = np.flatnonzero(nth == k)
        length = size[of[own]]
        stop = np.cumsum(length)
        spots = np.arange(int(stop[-1])) + np.repeat(base[of[own]] - stop + length, length)
        aligned = (lean[spots] >= np.repeat(low[own], length)) & (lean[spots] <= np.repeat(high[own], length))
        sums = np.cumsum(np.r_[0, aligned])
        runs = np.zeros(len(spots), bool)
        runs[: len(spots) - WIDTH + 1] = sums[WIDTH:] - sums[:-WIDTH] >= ENOUGH
        runs &= place[spots] <= np.repeat(length, length) - WIDTH
        steps = np.r_[runs, np.zeros(WIDTH, np.int8)].astype(np.int8)
        steps[WIDTH:] -= runs
        good[spots] |= runs
        matched[spots] |= aligned & (np.cumsum(steps[: len(spots)], dtype=np.int32) > 0)
    starts = np.flatnonzero(good)
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    fresh = np.flatnonzero(np.r_[True, (np.diff(starts) > WIDTH) | (owner[starts[1:]] != owner[starts[:-1]])])
    marks = np.flatnonzero(matched)
    least = marks[np.searchsorted(marks, starts[fresh])]
    most = marks[np.searchsorted(marks, starts[np.r_[fresh[1:] - 1, len(starts) - 1]] + WIDTH) - 1]
    return owner[least] % n, owner[least] // n, place[least], place[most] + 1, where[least]


def _reach(runs: np.ndarray) -> np.ndarray:
    """In each column the places that some of the runs of WIDTH that begin at the marked places have."""
    n = len(runs)
    out = np.zeros((n + WIDTH - 1, runs.shape[1]), bool)
    out[:n] = runs
    for i in range(1, n):
        out[i] |= out[i - 1]
    out[n:] = out[n - 1]
    # a place behind WIDTH is reached from the later starts only
    later = np.zeros(runs.shape[1], bool)
    for i in range(n - 1, 0, -1):
        later |= runs[i]
        if i + WIDTH - 1 >= n:
            out[i + WIDTH - 1] = later
    return out


def _enough(marks: np.ndarray) -> np.ndarray:
    """In each column the places at which a run of WIDTH begins that has ENOUGH marks."""
    marks = marks.view(np.uint8)
    out = np.empty((len(marks) - WIDTH + 1, marks.shape[1]), bool)
    total = marks[:WIDTH].sum(axis=0, dtype=np.uint8)
    for i in range(len(out)):
        if i:
            total += marks[i + WIDTH - 1]
            total -= marks[i - 1]
        np.greater_equal(total, ENOUGH, out=out[i])
    return out


def _packed(marks: np.ndarray) -> np.ndarray:
    """The marks of each column, 64 at most, as bits of one number."""
    out = np.zeros(marks.shape[1], np.uint64)
    for i, row in enumerate(marks):
        out |= row.astype(np.uint64) << np.uint64(i)
    return out


def _outermost(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last mark of each row, or its width and -1."""
    width, some = marks.shape[1], marks.any(1)
    return np.where(some, marks.argmax(1), width), np.where(some, width - 1 - marks[:, ::-1].argmax(1), -1)


class _Crowd:
    """Windows of crowded groups, none of a group like another, aligned at the shingle that the group shares.

    All pairs of a group are compared, but for those that cannot be near and those that add nothing:

    * Of the WIDTH shingles of a near stretch all but WIDTH - ENOUGH are in the other window, so that at least one of the
      WIDTH - ENOUGH + 1 rarest is.  Only windows that hold one of these, by the group's own counts, are compared, and
      none for a stretch with more shingles that no other text of the group has.
    * Two windows that are already of one class add nothing once each stretch is covered, for the window of the larger id
      by smaller ids, as far as the pair reaches.  All near stretches of a window hold the shared shingle, so that a
      window is of one class and its spans are one.

    Rows come ordered by group, id and place.
    """

    def __init__(self, group: np.ndarray, ids: np.ndarray, at: np.ndarray, lo: np.ndarray, raw: list[bytes]) -> None:
        n, size = len(ids), np.array([len(r) // 4 for r in raw], np.int64)
        self.shift = WIDTH - 1 - (at - lo).astype(np.int64)  # the column of the first shingle
        self.id, self.start = ids.tolist(), (lo - self.shift).tolist()
        fresh = np.r_[True, group[1:] != group[:-1]]
        self.own = np.cumsum(fresh | np.r_[True, ids[1:] != ids[:-1]])
        row = np.repeat(np.arange(n), size)
        column = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + self.shift[row]
        keys = np.frombuffer(b"".join(raw), np.uint32).astype(np.uint64) | (np.cumsum(fresh).astype(np.uint64)[row] << np.uint64(32))
        order = np.argsort(keys, kind="stable")  # by row within a key
        new = np.r_[True, keys[order][1:] != keys[order][:-1]]
        code, by = np.cumsum(new) - 1, row[order]
        texts = np.bincount(code, new | np.r_[True, self.own[by][1:] != self.own[by][:-1]]).astype(np.int64)  # that have it
        self.codes = np.full((n, 2 * WIDTH - 1), -1, np.int32)
        self.codes[row[order], column[order]] = code
        once = new | np.r_[True, by[1:] != by[:-1]]
        self.holders, holds = by[once], np.bincount(code, once).astype(np.int64)
        self.first = np.cumsum(holds) - holds
        self.last = self.first + holds
        back, some = np.argsort(texts, kind="stable"), []
        rank = np.empty(len(texts), np.int32)
        rank[back] = np.arange(len(texts))
        shared = np.where(self.codes >= 0, texts[self.codes] > 1, False)
        begins = np.arange(WIDTH)[:, None]
        alive = _enough(np.ascontiguousarray(shared.T)) & (begins >= self.shift) & (begins + WIDTH <= self.shift + size)
        # by any id and by smaller ones: stretches to be covered, the places covered, and those that may be at most
        self.open, width = [_packed(alive).tolist() for _ in range(2)], self.codes.shape[1]
        self.low, self.high = [[width] * n for _ in range(2)], [[-1] * n for _ in range(2)]
        least, most = _outermost(_reach(alive).T & shared)
        self.least, self.most = least.tolist(), most.tolist()
        alive = np.ascontiguousarray(alive.T)
        self.needy = np.stack([alive.any(axis=1)] * 2)  # what is not covered as far as it may be
        self.root = list(range(n))
        ranks = np.lib.stride_tricks.sliding_window_view(np.where(self.codes >= 0, rank[self.codes], -1), WIDTH, axis=1)
        for rows, starts in zip(*(np.array_split(v, max(1, len(v) // 20_000)) for v in np.nonzero(alive)), strict=True):
            least = back[np.partition(ranks[rows, starts], WIDTH - ENOUGH, axis=1)[:, : WIDTH - ENOUGH + 1]]
            some.append(np.unique((rows[:, None] * len(texts) + least)[texts[least] > 1]))
        self.row, self.code = np.divmod(np.unique(np.concatenate(some)), len(texts))

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def roots(self) -> np.ndarray:
        root = np.array(self.root)
        while True:
            up = root[root]
            if (up == root).all():
                return up
            root = up

    def links(self) -> Iterator[tuple]:
        """Rows as of :func:`_verified`."""
        row, code, done, step = self.row, self.code, self.first[self.code].copy(), 1
        while len(row):
            sizes = np.minimum(self.last[code] - done, step)
            for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(np.cumsum(sizes) // PAIRED)) + 1):
                size = sizes[part]
                ends = np.cumsum(size)
                other = self.holders[np.arange(int(ends[-1])) + np.repeat(done[part] - ends + size, size)]
                done[part] += size
                mine, other = np.divmod(np.unique(np.repeat(row[part], size) * len(self.own) + other), len(self.own))
                yield from self.compared(mine, other)
            # rows that still need others, and codes of several classes
            roots, needy = self.roots(), self.needy.any(axis=0)
            low, high = (f.reduceat(roots[self.holders], self.first) for f in (np.minimum, np.maximum))
            keep = (done < self.last[code]) & (needy[row] | (low != high)[code])
            row, code, done, step = row[keep], code[keep], done[keep], min(4 * step, PAIRED)

    def compared(self, mine: np.ndarray, other: np.ndarray) -> Iterator[tuple]:
        roots = self.roots()
        needed = (self.own[mine] != self.own[other]) & ((roots[mine] != roots[other]) | self.needy[(other < mine).astype(np.int64), mine])
        mine, other = mine[needed], other[needed]
        if not len(mine):
            return
        some, *there = self.near(mine, other)
        mine, other = mine[some], other[some]
        back, *here = self.near(other, mine)
        returns = np.full(len(mine), -1)
        returns[back] = np.arange(len(back))
        here, there = ([_packed(near.T).tolist(), *(v.tolist() for v in more)] for near, *more in (here, there))
        for k, (i, j, r, near, least, most) in enumerate(zip(mine.tolist(), other.tolist(), returns.tolist(), *there[:3], strict=True)):
            joins, by = r >= 0 and self.find(i) != self.find(j), int(j < i)
            if joins or least < self.low[by][i] or most > self.high[by][i] or near & self.open[by][i]:
                yield self.linked(i, j, near, least, most, there[3][k])
            if joins:
                yield self.linked(j, i, *(v[r] for v in here))
                a, b = sorted((self.find(i), self.find(j)))
                self.root[b] = a

    def near(self, mine: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """Which of the pairs have near stretches; of these the stretches of ``mine``, the first and last place that is
        matched in one, and the place of ``other`` that matches the first.  A passage's alignment drifts from that of
        the shared shingle, and its shingles from that."""
        parts = [self.aligned(mine[k : k + ABREAST], other[k : k + ABREAST], k) for k in range(0, max(1, len(mine)), ABREAST)]
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def aligned(self, mine: np.ndarray, other: np.ndarray, first: int) -> tuple[np.ndarray, ...]:
        """:meth:`near` of some pairs, numbered from ``first``.  Arrays have a column a pair, so that each step is on whole rows."""
        wide, width = 2 * DRIFT, self.codes.shape[1]
        x, y = np.ascontiguousarray(self.codes[mine].T), np.full((width + 2 * wide, len(mine)), -2, np.int32)  # what lies outside is like nothing
        y[wide:-wide] = self.codes[other].T
        np.copyto(y, -2, where=y < 0)
        marks, hit = x == y[wide : wide + width], np.empty(x.shape, bool)
        for d in range(2 * wide + 1):
            marks |= np.equal(x, y[d : d + width], out=hit)
        near = _enough(marks)
        some = np.flatnonzero(near.any(axis=0))
        x, y, marks, near = (np.ascontiguousarray(v[:, some]) for v in (x, y, marks, near))
        matched = marks & _reach(near)
        # where a shingle has its like at another drift only, the like of some drifts at a time is to be enough; all have the middle
        drifted = np.flatnonzero((marks != (x == y[wide : wide + width])).any(axis=0))
        if len(drifted):
            a, b = np.ascontiguousarray(x[:, drifted]), np.ascontiguousarray(y[:, drifted])
            each = [a == b[d : d + width] for d in range(2 * wide + 1)]
            for d in range(1, wide + 1):
                each[wide - d] |= each[wide - d + 1]
                each[wide + d] |= each[wide + d - 1]
            own = np.concatenate([each[d] | each[d + wide] for d in range(wide + 1)], axis=1)
            runs = _enough(own)
            seen = own & _reach(runs)
            near[:, drifted], matched[:, drifted] = (v.reshape(len(v), wide + 1, -1).any(axis=1) for v in (runs, seen))
        keep = np.flatnonzero(near.any(axis=0))
        least, most = _outermost(np.ascontiguousarray(matched[:, keep].T))
        # the nearest of the equal places
        value, at = x[least, keep], np.full(len(keep), width)
        for d in sorted(range(2 * wide + 1), key=lambda d: abs(d - wide))[::-1]:
            at = np.where(y[least + d, keep] == value, d - wide + least, at)
        return some[keep] + first, np.ascontiguousarray(near[:, keep].T), least, most, at

    def linked(self, i: int, j: int, near: int, least: int, most: int, at: int) -> tuple:
        for by in (0, 1) if j < i else (0,):  # a smaller id is any id too
            self.open[by][i] &= ~near
            if least < self.low[by][i]:
                self.low[by][i] = least
            if most > self.high[by][i]:
                self.high[by][i] = most
            if not self.open[by][i] and self.low[by][i] <= self.least[i] and self.high[by][i] >= self.most[i]:
                self.needy[by, i] = False
        start = self.start[i]
        return self.id[i], start + least, start + most + SHINGLE, self.id[j], self.start[j] + at


def _crowded_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the windows of crowded groups; rows come ordered by common, id and at."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]

    def made(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.filter(pc.greater_equal(pc.binary_length(table.column("raw")), 4 * WIDTH))  # others are of unlike texts under one id
        if table.num_rows > 1:
            *columns, raw = table.columns
            rows = set(_Crowd(*(c.to_numpy() for c in columns), raw.to_pylist()).links())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["id", "start", "end", "of", "of_start"])

    held, n, enough = [], 0, CROWD
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        table = pa.Table.from_batches(held)
        common = table.column("common").to_numpy()
        cut = int(np.searchsorted(common, common[-1]))  # the last group may go on
        yield from made(table.slice(0, cut))
        held = table.slice(cut).to_batches()
        n -= cut
        enough = CROWD + n
    if n:
        yield from made(pa.Table.from_batches(held))


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The two sides of each candidate come after one another."""
    kinds, names = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()], ["id", "start", "end", "of", "of_start"]
    left = None
    for batch in batches:
        both = batch if left is None else pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
        left = both.slice(both.num_rows - 1)
        a, b, lo_a, lo_b, side = (c.to_numpy() for c in both.columns[:5])
        same = (side[:-1] == 0) & (side[1:] == 1)
        for c in (a, b, lo_a, lo_b):
            same &= c[1:] == c[:-1]
        at = np.flatnonzero(same)
        raw = both.column(5)
        size = pc.binary_length(raw).to_numpy() // 4
        long = np.maximum(size[at], size[at + 1]) >= 1 << _SPOT
        rows = []
        for i in at[long].tolist():
            x, y = (np.frombuffer(raw[k].as_buffer(), np.uint32) for k in (i, i + 1))
            rows += [(a[i], lo_a[i] + start, lo_a[i] + end + SHINGLE - 1, b[i], lo_b[i] + to) for start, end, to in shared_spans(x, y)]
            rows += [(b[i], lo_b[i] + start, lo_b[i] + end + SHINGLE - 1, a[i], lo_a[i] + to) for start, end, to in shared_spans(y, x)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        rest = at[~long]
        for some in np.split(rest, np.flatnonzero(np.diff(np.cumsum(size[rest] + size[rest + 1] + 1) // SPANNED)) + 1):
            pair, way, start, end, to = _all_spans(raw, some, some + 1)
            if len(pair):
                i, back = some[pair], way == 1
                own, of = np.where(back, lo_b[i], lo_a[i]), np.where(back, lo_a[i], lo_b[i])
                out = np.where(back, b[i], a[i]), own + start, own + end + SHINGLE - 1, np.where(back, a[i], b[i]), of + to
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(out, kinds, strict=True)], names=names)


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of which each goes on a word further than the one before, on either side, as one; rows come ordered by id, of, start."""
    names, held = ["id", "start", "end", "of", "of_start"], None
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if held is not None:
            columns = [np.r_[h, c] for h, c in zip(held, columns, strict=True)]
        own, start, end, of, of_start = columns
        if not len(own):
            continue
        on = (own[1:] == own[:-1]) & (of[1:] == of[:-1]) & (end[1:] == end[:-1] + 1) & (of_start[1:] - start[1:] == of_start[:-1] - start[:-1])
        first = np.flatnonzero(np.r_[True, ~on])
        out = own[first], start[first], end[np.r_[first[1:] - 1, len(own) - 1]], of[first], of_start[first]
        held = [c[-1:] for c in out]  # the last may go on
        if len(first) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(c[:-1]) for c in out], names=names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=names)


class _Sums:
    """Running sums of values times powers, whose differences give a hash of any run of values."""

    def __init__(self, x: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            up = np.cumprod(np.r_[np.uint64(1), np.full(len(x) - 1, _ODD)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(len(x) - 1, _ODD_INVERSE)], dtype=np.uint64)
            self.sums = np.cumsum(np.r_[np.uint64(0), x * up], dtype=np.uint64)

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of runs of any length, so that the length counts too."""
        with np.errstate(over="ignore"):
            own = _mix((self.sums[end] - self.sums[begin]) * self.down[begin])
            return _mix(own + (end - begin).astype(np.uint64) * _ODD).view(np.int64)


def run_hashes(x: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A hash of each run of ``width`` values."""
    if len(x) < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        s = _Sums(x)
        return _mix((s.sums[width:] - s.sums[:-width]) * s.down[: len(x) - width + 1])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text, the requested stretches as 32-bit hashes, and the exact ways' stretches as one hash each."""
    names = ["a", "b", "lo_a", "lo_b", "side", "raw", "whole", "id", "at"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
    for part in each_slice(batches, "text"):
        ids = part.column(0).to_numpy()
        x, counts = shingle_hashes(part.column(1))
        base = np.cumsum(counts) - counts
        lists = part.column(2)
        owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        flat = lists.flatten()
        side, lo, hi = (flat.field(n).to_numpy() for n in ("side", "lo", "hi"))
        near = np.flatnonzero(side != _EXACT)
        if len(near):
            short = _mix(x).astype("<u4")
            first = base[owner[near]] + lo[near]
            size = np.maximum(np.minimum(hi[near], counts[owner[near]] - 1) - lo[near] + 1, 0)
            ends = np.cumsum(size)
            picked = short[np.arange(int(ends[-1])) + np.repeat(first - ends + size, size)]
            raw = pa.Array.from_buffers(
                pa.binary(), len(near), [None, pa.py_buffer(np.r_[0, ends * 4].astype(np.int32).tobytes()), pa.py_buffer(picked.tobytes())]
            )
            own = flat.take(pa.array(near))
            yield pa.RecordBatch.from_arrays(
                [*(own.field(n) for n in ("a", "b", "lo_a", "lo_b", "side")), raw, *(pa.nulls(len(near), k) for k in kinds[6:])], names=names
            )
        exact = np.flatnonzero(side == _EXACT)
        if len(exact):
            size = np.maximum(np.minimum(hi[exact], counts[owner[exact]] - WIDTH) - lo[exact] + 1, 0)
            ends = np.cumsum(size)
            at = np.unique(np.arange(int(ends[-1])) + np.repeat(base[owner[exact]] + lo[exact] - ends + size, size))
            text = np.searchsorted(np.cumsum(counts), at, "right")  # texts without shingles share a place with the next
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(at), k) for k in kinds[:6]), pa.array(run_hashes(x)[at].view(np.int64)), pa.array(ids[text]), pa.array((at - base[text]).astype(np.int32))],
                names=names,
            )


def links(df: DataFrame, id_col: str, text_col: str, small: int = SMALL) -> tuple[DataFrame, DataFrame, list[str]]:
    """Tables of the texts (``id``, ``text_id``, ``first_id``, ``copies``, ``n_words``; a row a document) and of
    the links (``id``, ``start``, ``end`` in words, ``of``, ``of_start``) between first ids; and scratch paths."""
    spark = df.sparkSession
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).filter("id IS NOT NULL")
    light, light_path = written(docs.mapInArrow(_light, "id bigint, text_id bigint, n_words int"), "texts")
    firsts, firsts_path = written(light.groupBy("text_id").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "firsts")
    # no window spans fewer words, and one hash of a row reaches each of its windows' groups
    pairs, pairs_path = written(
        _windows(docs).repartition("minimum").sortWithinPartitions("minimum", "packed", "text").mapInArrow(_pairing(small, rest=True), f"{_PAIRS}, content bigint, common bigint"), "pairs"
    )
    first_of = lambda name: firsts.select(F.col("text_id").alias(name), F.col("first_id").alias(f"id_{name}"))
    stretches = (
        pairs.filter("a <> b").select(*_NAMES).repartition("a", "b").sortWithinPartitions("a", "b", "at_a", "at_b")
        .mapInArrow(_candidates, "a bigint, b bigint, lo_a int, hi_a int, lo_b int, hi_b int")
        .join(first_of("a"), "a").join(first_of("b"), "b")
        .select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "lo_a", "hi_a", "lo_b", "hi_b")
    )
    candidates, candidates_path = written(stretches, "candidates")
    whole = pairs.filter("a = b AND hash_no >= 0").join(first_of("a"), "a")
    # of windows of crowded groups with the same content, that of the smallest id; a group of one content has no near repeats
    unlike, unlike_path = written(
        pairs.filter(f"hash_no = {_REST}").join(first_of("a"), "a").groupBy("common", "content")
        .agg(F.min(F.struct("id_a", "at_a", "lo", "hi")).alias("w")).select("common", "w.*"), "unlike"
    )
    crowds = unlike.groupBy("common").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("common")
    windows = unlike.join(crowds, "common").select(
        F.col("id_a").alias("id"),
        F.struct(F.col("common").alias("a"), F.col("id_a").alias("b"), F.col("at_a").alias("lo_a"), F.col("lo").alias("lo_b"), F.lit(_REST).alias("side"), "lo", "hi").alias("r"),
    )
    requests = (
        candidates.select(F.col("a").alias("id"), F.struct("a", "b", "lo_a", "lo_b", F.lit(0).alias("side"), F.col("lo_a").alias("lo"), F.col("hi_a").alias("hi")).alias("r"))
        .unionAll(candidates.select(F.col("b").alias("id"), F.struct("a", "b", "lo_a", "lo_b", F.lit(1).alias("side"), F.col("lo_b").alias("lo"), F.col("hi_b").alias("hi")).alias("r")))
        .unionAll(whole.select(F.col("id_a").alias("id"), F.struct("a", "b", F.col("at_a").alias("lo_a"), F.col("at_b").alias("lo_b"), F.lit(_EXACT).alias("side"), "lo", "hi").alias("r")))
        .unionAll(windows)
    )
    # a text that very many others share passages with is read in several rows
    numbers = requests.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > REQUESTS)
    numbers, numbers_path = written(numbers, "numbers")
    salted = requests.join(numbers, "id", "left").withColumn(
        "salt", F.when(F.col("n").isNotNull(), F.pmod(F.xxhash64("r"), F.expr(f"n div {REQUESTS} + 1"))).otherwise(F.lit(0).cast("long"))
    )
    asked, asked_path = written(salted.groupBy("id", "salt").agg(F.collect_list("r").alias("requests")).select("id", "requests"), "requests")
    cut, cut_path = written(
        asked.join(docs, "id").select("id", "text", "requests").select("id", "text", "requests").mapInArrow(_cut, _CUT), "cut"
    )
    near = (
        cut.filter("side >= 0").select("a", "b", "lo_a", "lo_b", "side", "raw")
        .repartition("a", "b", "lo_a").sortWithinPartitions("a", "b", "lo_a", "lo_b", "side")
        .mapInArrow(_verified, "id bigint, start int, end int, of bigint, of_start int")
    )
    crowded = (
        cut.filter(f"side = {_REST}").select(F.col("a").alias("common"), F.col("b").alias("id"), F.col("lo_a").alias("at"), F.col("lo_b").alias("lo"), "raw")
        .repartition("common").sortWithinPartitions("common", "id", "at")
        .mapInArrow(_crowded_links, "id bigint, start int, end int, of bigint, of_start int")
    )
    equal = cut.filter("whole IS NOT NULL").select("whole", "id", "at")
    heads, heads_path = written(
        equal.groupBy("whole").agg(F.min(F.struct("id", "at")).alias("head"), F.max("id").alias("last")).filter("head.id <> last").select("whole", "head"), "heads"
    )
    same = (
        equal.join(heads, "whole").select("id", F.col("at").alias("start"), (F.col("at") + PASSAGE).alias("end"), F.col("head.id").alias("of"), F.col("head.at").alias("of_start"))
        .repartition("id", "of").sortWithinPartitions("id", "of", "start").mapInArrow(_joined, "id bigint, start int, end int, of bigint, of_start int")
    )
    found, found_path = written(near.unionAll(crowded).unionAll(same), "links")
    texts, texts_path = written(light.join(firsts, "text_id"), "texts")
    discard(spark, light_path, firsts_path, pairs_path, candidates_path, unlike_path, numbers_path, asked_path, cut_path, heads_path)
    return texts, found, [texts_path, found_path]


_CUT = "a bigint, b bigint, lo_a int, lo_b int, side int, raw binary, whole bigint, id bigint, at int"


def _islands(spans: DataFrame) -> DataFrame:
    """Each distinct (id, start), with the furthest ``end`` from there, and the ``low`` and ``high`` of the united spans
    that it lies in.  However many spans a text has, a row a word at most is left to sort."""
    reach = Window.partitionBy("id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("id").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    marked = spans.groupBy("id", "start").agg(F.max("end").alias("end")).withColumn("before", F.max("end").over(reach))
    low = marked.withColumn("low", F.max(F.expr("CASE WHEN before IS NULL OR start > before THEN start END")).over(upto)).drop("before")
    return low.withColumn("high", F.max("end").over(Window.partitionBy("id", "low")))


def _numbered(df: DataFrame, id_col: str) -> tuple[DataFrame | None, DataFrame]:
    """For ids that are no whole numbers: a table of ``id`` and ``number`` in their order; and ``df`` with numbers for ids."""
    if isinstance(df.schema[id_col].dataType, T.IntegralType):
        return None, df
    ids = df.select(F.col(f"`{id_col}`").alias("id")).filter("id IS NOT NULL")
    ranged, _ = paging.ranged(ids, "id")
    names, _ = written(paging.placed(ranged).select("id", F.col("place").alias("number")), "numbers")
    texts = df.join(names, df[f"`{id_col}`"] == names["id"], "left")
    return names, texts


def passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """A row for each passage of a document that other documents share: ``doc_id``, ``start_word``, ``end_word``
    (exclusive), ``class_id`` (the smallest id among documents with a passage of its class)."""
    named = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    names, numbered = _numbered(named, "doc_id")
    if names is not None:
        found = passages(numbered.select(F.col("number").alias("doc_id"), "text"), small=small)
        back = lambda column, alias: names.select(F.col("number").alias(column), F.col("id").alias(alias))
        return found.join(back("doc_id", "own"), "doc_id").join(back("class_id", "of"), "class_id").select(F.col("own").alias("doc_id"), "start_word", "end_word", F.col("of").alias("class_id"))
    spark, kind = df.sparkSession, named.schema["doc_id"].dataType
    texts, found, (_, found_path) = links(named, "doc_id", "text", small)
    copied = texts.filter(f"copies > 1 AND n_words >= {PASSAGE}").select(F.col("first_id").alias("id"), F.lit(0).alias("start"), F.col("n_words").alias("end")).distinct()
    spans, spans_path = written(_islands(found.select("id", "start", "end").unionAll(copied)), "spans")
    node = lambda i, low: F.concat_ws(":", F.col(i).cast("string"), F.col(low).cast("string"))
    own = spans.select("id", "start", F.col("low"))
    # a linked place of the other text lies within one of its own spans; very many texts may ask about one place
    places, places_path = written(_containing(found.select("of", "of_start").distinct(), spans), "places")
    other = found.select("id", "start", "of", "of_start").distinct().join(own, ["id", "start"]).join(places, ["of", "of_start"])
    joined, joined_path = written(other.select(node("id", "low").alias("a"), node("of", "of_low").alias("b")).distinct(), "nodes")
    roots = components(joined)
    united = spans.select("id", "low", "high").distinct().withColumn("v", node("id", "low")).join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    united, united_path = written(united, "united")
    best, best_path = written(united.groupBy("root").agg(F.min("id").alias("class_id")), "classes")
    classed, _ = written(united.join(best, "root").select(F.col("id").alias("first_id"), "low", "high", "class_id"), "classed")
    discard(spark, found_path, spans_path, places_path, joined_path, united_path, best_path)
    return texts.select("id", "first_id").join(classed, "first_id").select(
        F.col("id").cast(kind).alias("doc_id"), F.col("low").alias("start_word"), F.col("high").alias("end_word"), F.col("class_id").cast(kind).alias("class_id")
    )


def _containing(asks: DataFrame, spans: DataFrame) -> DataFrame:
    """With ``of_low``: where the united span of ``of`` begins that holds the place ``of_start``; by merging both by place."""
    marks = spans.select(F.col("id").alias("of"), F.col("low").alias("of_start"), F.lit(0).alias("kind")).distinct()
    upto = Window.partitionBy("of").orderBy("of_start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = marks.unionAll(asks.select("of", "of_start", F.lit(1).alias("kind")))
    return both.withColumn("of_low", F.max(F.expr("CASE WHEN kind = 0 THEN of_start END")).over(upto)).filter("kind = 1 AND of_low IS NOT NULL").drop("kind")


def _through(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the stretches that are linked with places of one text, the parts whose places there one of smaller id has
    too, if as long as a near passage.  Rows come ordered by text, then id.  Only words that a smaller id has go: the
    places, not the classes, decide, since a class may join passages of which its smallest id has one."""
    now = own = None
    taken, fresh = bytearray(), []
    for batch in batches:
        rows = []
        for of, place, i, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if of != now:
                now, own, taken, fresh = of, i, bytearray(), []
            elif i != own:
                for lo, hi in fresh:
                    taken.extend(bytes(max(0, hi - len(taken))))
                    taken[lo:hi] = b"\1" * (hi - lo)
                own, fresh = i, []
            seen = np.frombuffer(bytes(taken[place : place + end - start]), np.uint8)
            edges = np.flatnonzero(np.diff(np.r_[0, seen, 0].astype(np.int8)))
            rows += [(i, start + lo, start + hi) for lo, hi in edges.reshape(-1, 2).tolist() if hi - lo >= ENOUGH + SHINGLE - 1]
            fresh.append((place, place + end - start))
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["id", "start", "end"])


def strip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """All rows and columns of ``df``; from each text go the passages that a document of smaller id has, and
    the whole text if that of a smaller id is equal and has a passage's words."""
    spark = df.sparkSession
    names, numbered = _numbered(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), "doc_id")
    if names is None:
        texts, found, paths = links(numbered, "doc_id", "text", small)
    else:
        texts, found, paths = links(numbered.select(F.col("number").alias("doc_id"), "text"), "doc_id", "text", small)
    # of two linked texts, the one of the smaller id keeps the passage, also if both are linked with a third of a larger id only
    through = (
        found.filter("of > id").select("of", "of_start", "id", "start", "end").distinct()
        .repartition("of").sortWithinPartitions("of", "id", "start").mapInArrow(_through, "id bigint, start int, end int")
    )
    cut = _islands(found.filter("of < id").select("id", "start", "end").unionAll(through)).select("id", "low", "high").distinct()
    listed, listed_path = written(cut.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans")).withColumnRenamed("id", "first"), "cuts")
    gone = texts.select("id", "first_id", F.expr(f"id > first_id AND n_words >= {PASSAGE}").alias("whole")).distinct()
    plan = gone.join(listed, F.col("first_id") == F.col("first"), "left").filter("whole OR spans IS NOT NULL").select("id", F.struct("whole", "spans").alias("cut"))
    if names is not None:
        plan = plan.withColumnRenamed("id", "number").join(names, "number").select("id", "cut")
    plan, _ = written(plan, "plan")
    discard(spark, listed_path, *paths)
    at = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cuts = batch.columns
            own = row.flatten()
            out = [
                t if t is None or c is None else "" if c["whole"] else without_words(t, [(x["low"], x["high"]) for x in c["spans"]])
                for t, c in zip(own[at].to_pylist(), cuts.to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else c for i, c in enumerate(own)], names=batch.schema.field(0).type.names)

    # the row goes as one column, so that no name of its own can clash
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.struct(F.col(f"`{id_col}`").alias("id")).alias("key"))
    marked = whole.join(plan, F.col("key.id") == F.col("id"), "left").select("row", "cut")
    return marked.mapInArrow(run, df.schema)


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words numbered from each start to each end, and the space after them."""
    import re

    starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    starts.append(len(text))
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : starts[min(start, len(starts) - 1)]])
        at = starts[min(end, len(starts) - 1)]
    out.append(text[at:])
    return "".join(out)
