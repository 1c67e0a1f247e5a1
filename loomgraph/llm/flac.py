"""FLAC media columns: lossless 8-bit mono streams, decoded into seekable PCM blocks.

The encoder cuts a payload into frames, predicts each with the fixed polynomial
or the quantised LPC predictor that leaves the smaller code, and Rice-codes the residuals,
or keeps the frame verbatim where that is smaller.
The decoder follows the published format: it finds frames by sync code and
header CRC-8, verifies each frame's CRC-16, decodes constant, verbatim, fixed and
LPC subframes with partitioned Rice residuals, and checks the stream's MD5.
Frames of many streams are decoded side by side, one sample of each a step, so
that the work is in vector operations.

The query stores the column of streams, reads it back, decodes it, stores the PCM
blocks with their sample offsets, and takes digests and features from those as read.
It does so for a share of the texts after the other (``WAVES``, by a hash of the text),
and deletes the streams and blocks of one share before the next, so that it needs disk
for one share only; every text is in one.

Edge cases: a null text counts as empty; an empty text is 64 zero bytes; a text of
any length is one stream of as many frames as it takes; row count, repeated rows,
ties and null ids pass through; an empty table gives an empty table; columns other
than the id and the text are not read, so that none can clash.  A stream that
fails a checksum raises ``ValueError``; a null stream has no blocks.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import discard, each_slice, fields, slices, written

#: Samples of a frame, and the sample rate that the header states.
BLOCK, RATE = 4096, 8000
#: Text bytes encoded, and stream bytes decoded, side by side.
ENCODED, DECODED = 1_500_000, 5_000_000
#: Order of the LPC predictors that compete with the fixed ones, and precision of their quantised coefficients.
LPC, PRECISION = 8, 12
#: Shares of the texts that the query handles one after the other.
WAVES = 2


def _crc_step(value: int, poly: int, bits: int) -> int:
    top = 1 << (bits - 1)
    for _ in range(8):
        value = ((value << 1) ^ poly) if value & top else value << 1
    return value & ((1 << bits) - 1)


_CRC8 = [_crc_step(i, 0x07, 8) for i in range(256)]
_CRC16 = np.array([_crc_step(i << 8, 0x8005, 16) for i in range(256)], np.uint16)
_tables = _CRC16[None]


def crc8(data: bytes) -> int:
    out = 0
    for b in data:
        out = _CRC8[out ^ b]
    return out


def _crc16_tables(size: int) -> np.ndarray:
    """Row d: what each byte value, d bytes before the last, adds to the CRC-16."""
    global _tables
    while len(_tables) < size:
        more = [_tables[-1]]
        for _ in range(4096):
            last = more[-1]
            more.append(((last << 8) & 0xFFFF).astype(np.uint16) ^ _CRC16[last >> 8])
        _tables = np.concatenate([_tables, more[1:]])
    return _tables


def crc16(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-16 of each byte range; ranges must not be empty.  The CRC is linear, so that each byte's
    part depends only on its value and its distance from the end."""
    sizes = ends - starts
    table = _crc16_tables(int(sizes.max()))
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    parts = table[np.repeat(sizes, sizes) - 1 - at, data[np.repeat(starts, sizes) + at]]
    return np.bitwise_xor.reduceat(parts, first)


def _number(n: int) -> bytes:
    """A frame number in the format's extension of UTF-8."""
    if n < 0x80:
        return bytes([n])
    tail = []
    limit = 0x20
    while n >= limit * 2 if not tail else n >= limit:
        tail.append(0x80 | (n & 0x3F))
        n >>= 6
        limit = 0x40 >> len(tail)
    lead = (0xFF << (7 - len(tail))) & 0xFF
    return bytes([lead | n, *reversed(tail)])


def _read_number(data: memoryview | bytes, at: int) -> int | None:
    """Bytes that the coded number takes, or None if there is none."""
    lead = data[at]
    if lead < 0x80:
        return 1
    ones = 0
    while lead & (0x80 >> ones):
        ones += 1
        if ones > 7:
            return None
    if ones < 2 or any(data[at + i] >> 6 != 2 for i in range(1, ones)):
        return None
    return ones


def pad(text: bytes) -> bytes:
    """The payload: zero bytes added up to a positive multiple of 64."""
    size = max(64, -(-len(text) // 64) * 64)
    return text + bytes(size - len(text))


def _residuals(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best fixed order of each frame, and residuals (of no meaning at a frame's first samples)."""
    differences = [x.astype(np.int16)]
    for _ in range(4):
        differences.append(np.diff(differences[-1], prepend=np.int16(0)))
    cost = np.stack([np.add.reduceat(np.abs(d), starts, dtype=np.int32) for d in differences])
    order = cost.argmin(0)
    best = differences[0]
    for p in np.unique(order[order > 0]):
        best = np.where(np.repeat(order == p, sizes), differences[p], best)
    return order, best.astype(np.int32)


def _lpc(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantised coefficients and shift of each frame by autocorrelation, and the residuals."""
    n, place = len(starts), np.arange(len(x)) - np.repeat(starts, sizes)
    real = x.astype(np.float64)
    auto = np.empty((order + 1, n))
    for lag in range(order + 1):
        product = np.zeros_like(real)
        product[lag:] = real[lag:] * real[: len(real) - lag]
        auto[lag] = np.add.reduceat(np.where(place >= lag, product, 0), starts)
    auto[0] += 1e-9 + auto[0] * 1e-9
    a = np.zeros((order, n))
    error = auto[0].copy()
    for i in range(order):
        k = (auto[i + 1] - (a[:i] * auto[i:0:-1]).sum(0)) / error
        a[:i], a[i] = a[:i] - k * a[:i][::-1], k
        error *= 1 - k * k
    top = np.abs(a).max(0)
    shift = np.clip(PRECISION - 1 - np.ceil(np.log2(np.maximum(top, 1e-9)) + 1e-9), 0, 15).astype(np.int64)
    limit = (1 << (PRECISION - 1)) - 1
    q = np.clip(np.rint(a * (1 << shift)), -limit - 1, limit).astype(np.int64)
    guess = np.zeros(len(x), np.int64)
    wide = x.astype(np.int64)
    for j in range(order):
        late = np.zeros_like(wide)
        late[j + 1 :] = wide[: len(wide) - j - 1]
        guess += np.repeat(q[j], sizes) * late
    return q, shift, (wide - (guess >> np.repeat(shift, sizes))).astype(np.int32)


def _put(words: np.ndarray, ends: np.ndarray, values: np.ndarray) -> None:
    """Write values so that each ends before its bit place; places rise, and bits so far zero stay free to be set."""
    if not len(ends):
        return
    last = ends - 1
    word, values = last >> 6, values.astype(np.uint64)
    shift = (63 - (last & 63)).astype(np.uint64)
    starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    words[word[starts]] |= np.bitwise_or.reduceat(values << shift, starts)
    over = (values >> np.uint64(1)) >> (np.uint64(63) - shift)
    split = np.flatnonzero(over)
    words[word[split] - 1] |= over[split]


def _rice(e: np.ndarray, coded: np.ndarray, starts: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """Residuals as unsigned numbers, each frame's parameter, each residual's bits, and each frame's."""
    u = (e << 1) ^ (e >> 31)
    u[~coded] = 0
    mean = np.add.reduceat(u, starts, dtype=np.int64) / np.maximum(sizes - order, 1)
    k = np.clip(np.floor(np.log2(mean * 0.7 + 1e-3) + 1).astype(np.int64), 0, 14)
    ks = np.repeat(k.astype(np.int32), sizes)
    width = (u >> ks) + ks + 1
    width[~coded] = 0
    return u, k, width, np.add.reduceat(width, starts, dtype=np.int64)


def encode_streams(payloads: list[bytes], lpc_order: int = LPC, block: int = BLOCK) -> list[bytes]:
    """Each payload, of a positive multiple of 64 bytes, as a FLAC stream; order 0: by fixed predictors only."""
    if not payloads:
        return []
    counts = [-(-len(p) // block) for p in payloads]
    sizes = np.array([min(block, len(p) - s) for p in payloads for s in range(0, len(p), block)], np.int64)
    starts = np.cumsum(sizes) - sizes
    x = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int32) - 128
    place = np.arange(len(x)) - np.repeat(starts, sizes)
    order, e = _residuals(x, starts, sizes)
    coded = place >= np.repeat(order, sizes)
    u, k, width, code_bits = _rice(e, coded, starts, sizes, order)
    by_lpc = np.zeros(len(starts), bool)
    if lpc_order:
        coefs, shifts, other = _lpc(x, starts, sizes, lpc_order)
        late = place >= lpc_order
        found = _rice(other, late, starts, sizes, np.full(len(starts), lpc_order))
        by_lpc = found[3] + 9 + (PRECISION + 8) * lpc_order < code_bits + 8 * order
        many = np.repeat(by_lpc, sizes)
        order, coded = np.where(by_lpc, lpc_order, order), np.where(many, late, coded)
        u, width = np.where(many, found[0], u), np.where(many, found[2], width)
        k, code_bits = np.where(by_lpc, found[1], k), np.where(by_lpc, found[3], code_bits)
    extra = np.where(by_lpc, 4 + 5 + PRECISION * lpc_order, 0)
    # what no predictor makes smaller is stored as it is: all samples stand where others have a few to start from
    verbatim = 8 * order + extra + 10 + code_bits >= 8 * sizes
    by_lpc &= ~verbatim
    order, extra, code_bits = np.where(verbatim, sizes, order), np.where(verbatim, 0, extra), np.where(verbatim, 0, code_bits)
    coded &= ~np.repeat(verbatim, sizes)
    width[~coded] = 0
    ks = np.repeat(k.astype(np.int32), sizes)
    heads = []
    for c, p in zip(counts, payloads, strict=True):
        for i in range(c):
            size = min(block, len(p) - i * block)
            head = b"\xff\xf8\x74\x02" + _number(i) + struct.pack(">H", size - 1)  # 16-bit block size, 8 kHz, mono, 8 bits
            heads.append(head + bytes([crc8(head)]))
    head_size = np.array([len(h) for h in heads], np.int64)
    kind = np.where(verbatim, 1, np.where(by_lpc, 32 + lpc_order - 1, 8 + order))
    code_at = 8 * head_size + 8 + 8 * order + extra + np.where(verbatim, 0, 10)
    frame_size = -(-(code_at + code_bits) // 8) + 2
    frame_at = np.cumsum(frame_size) - frame_size
    words = np.zeros(int(frame_size.sum()) // 8 + 2, np.uint64)
    ends = np.cumsum(width, dtype=np.int64) + np.repeat(frame_at * 8 + code_at - (np.cumsum(code_bits) - code_bits), sizes)
    value = (u & ((1 << ks) - 1)) | (1 << ks)  # the one that ends the zeros, then the low bits
    _put(words, ends[coded], value[coded])
    at = frame_at * 8 + 8 * head_size + 8
    _put(words, at, kind << 1)
    warm = np.flatnonzero(~coded)
    if len(warm):
        _put(words, (np.repeat(at, sizes)[warm] + 8 * place[warm] + 8), x[warm] & 255)
    at = at + 8 * order
    if by_lpc.any():
        own = at[by_lpc]
        _put(words, own + 4, np.full(len(own), PRECISION - 1))
        _put(words, own + 9, shifts[by_lpc])
        for j in range(lpc_order):
            _put(words, own + 9 + PRECISION * (j + 1), coefs[j][by_lpc] & ((1 << PRECISION) - 1))
        at = at + extra
    _put(words, (at + 10)[~verbatim], k[~verbatim])  # method 0, partition order 0, then the parameter
    packed = words.astype(">u8").view(np.uint8)[: int(frame_size.sum())]
    head_bytes = np.frombuffer(b"".join(heads), np.uint8)
    head_first = np.cumsum(head_size) - head_size
    packed[np.repeat(frame_at - head_first, head_size) + np.arange(len(head_bytes))] = head_bytes
    sums = crc16(packed, frame_at, frame_at + frame_size - 2)
    packed[frame_at + frame_size - 2] = sums >> 8
    packed[frame_at + frame_size - 1] = sums & 255
    streams, frame, raw = [], 0, packed.tobytes()
    signed = (x & 255).astype(np.uint8).tobytes()
    done = 0
    for c, p in zip(counts, payloads, strict=True):
        own_at, own_size = frame_at[frame : frame + c], frame_size[frame : frame + c]
        begin, end = int(own_at[0]), int(own_at[-1] + own_size[-1])
        info = struct.pack(">HH", block, block) + int(own_size.min()).to_bytes(3, "big") + int(own_size.max()).to_bytes(3, "big")
        info += ((RATE << 44) | (7 << 36) | len(p)).to_bytes(8, "big") + hashlib.md5(signed[done : done + len(p)]).digest()
        points = b"".join(
            struct.pack(">QQH", i * block, int(a) - begin, min(block, len(p) - i * block)) for i, a in enumerate(own_at)
        )
        streams.append(
            b"fLaC\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(points).to_bytes(3, "big") + points + raw[begin:end]
        )
        frame, done = frame + c, done + len(p)
    return streams


def _header(data: bytes, at: int, stream_block: int) -> tuple[int, int] | None:
    """Header size and samples of the frame that starts at ``at``, or None if no header does."""
    if at + 6 > len(data) or data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8:
        return None
    code, rate = data[at + 2] >> 4, data[at + 2] & 15
    if code == 0 or rate == 15 or data[at + 3] >> 4 or data[at + 3] >> 1 & 7 not in (0, 1) or data[at + 3] & 1:
        return None  # only mono of 8 bits is stored
    try:
        size = 4 + (_read_number(data, at + 4) or len(data))
        extra = (1 if code == 6 else 2 if code == 7 else 0) + (1 if rate == 12 else 2 if rate in (13, 14) else 0)
        if crc8(data[at : at + size + extra]) != data[at + size + extra]:
            return None
        if code in (6, 7):
            samples = int.from_bytes(data[at + size : at + size + code - 5], "big") + 1
        else:
            samples = 192 if code == 1 else 576 << (code - 2) if code <= 5 else 256 << (code - 8)
    except IndexError:
        return None
    return size + extra + 1, samples


class _Bits:
    """Reads from many places of one buffer at once."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data + bytes(16), np.uint8)
        self.words = np.zeros(len(raw) - 8, np.uint64)
        for i in range(8):
            self.words |= raw[i : len(raw) - 8 + i].astype(np.uint64) << np.uint64(56 - 8 * i)

    def window(self, at: np.ndarray) -> np.ndarray:
        """At least 57 bits from each bit place, left-aligned."""
        return self.words[at >> 3] << (at & 7).astype(np.uint64)

    def read(self, at: np.ndarray, bits: int) -> np.ndarray:
        return (self.window(at) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(at), np.int64)

    def signed(self, at: np.ndarray, bits: int) -> np.ndarray:
        value = self.read(at, bits)
        return value - ((value >> (bits - 1)) << bits)

    def zeros(self, at: np.ndarray) -> np.ndarray:
        """How many zero bits come before the next one."""
        _, exponent = np.frexp((self.window(at) >> np.uint64(11)).astype(np.float64))
        count = 53 - exponent
        far = np.flatnonzero(count >= 53)
        if len(far):
            count = count.astype(np.int64)
            count[far] = 50 + self.zeros(at[far] + 50)
        return count


def _decode_residuals(bits: _Bits, at: np.ndarray, order: int, sizes: np.ndarray) -> np.ndarray:
    """Residuals as a matrix, a column a frame; frames must come by falling size.  ``at``: where each starts."""
    n = len(at)
    method, parts = bits.read(at, 2), bits.read(at + 2, 4)
    if (method > 1).any():
        raise ValueError("reserved residual coding")
    at = at + 6
    out = np.zeros((int(sizes[0]), n), np.int32)
    wide = 4 + method
    part_size = sizes >> parts
    next_part = np.zeros(n, np.int64)  # the sample at which the next parameter stands
    k = np.zeros(n, np.int64)
    raw = np.full(n, -1, np.int64)
    for t in range(order, int(sizes[0])):
        live = int(np.searchsorted(-sizes, -t, side="left"))  # frames longer than t
        if not live:
            break
        new = np.flatnonzero(next_part[:live] <= t)
        if len(new):
            for w in (4, 5):
                some = new[wide[new] == w]
                if len(some):
                    k[some] = bits.read(at[some], w)
                    at[some] += w
                    escape = some[k[some] == (1 << w) - 1]
                    raw[some] = -1
                    raw[escape] = bits.read(at[escape], 5)
                    at[escape] += 5
            next_part[new] = (t // part_size[new] + 1) * part_size[new]
        if (raw[:live] < 0).all():
            go, kk = slice(0, live), k[:live]
            window = bits.window(at[go])
            _, exponent = np.frexp((window >> np.uint64(11)).astype(np.float64))
            q = 53 - exponent.astype(np.int64)
            used = q + 1 + kk
            if used.max() <= 53:
                low = (((window << (q + 1).view(np.uint64)) >> np.uint64(1)) >> (np.uint64(63) - kk.view(np.uint64))).view(np.int64)
                at[go] += used
            else:
                q = bits.zeros(at[go]).astype(np.int64)
                at[go] += q + 1
                low = ((bits.window(at[go]) >> np.uint64(1)) >> (np.uint64(63) - kk.view(np.uint64))).view(np.int64)
                at[go] += kk
            u = (q << kk) | low
            out[t, go] = (u >> 1) ^ -(u & 1)
            continue
        rice = np.flatnonzero(raw[:live] < 0)
        if len(rice):
            q = bits.zeros(at[rice])
            at[rice] += q + 1
            low = ((bits.window(at[rice]) >> np.uint64(1)) >> (np.uint64(63) - k[rice].astype(np.uint64))).astype(np.int64)
            at[rice] += k[rice]
            u = (q.astype(np.int64) << k[rice]) | low
            out[t, rice] = (u >> 1) ^ -(u & 1)
        for i in np.flatnonzero(raw[:live] >= 0):
            one = np.array([i])
            out[t, i] = bits.signed(at[one], int(raw[i]))[0] if raw[i] else 0
            at[i] += raw[i]
    return out


def _decode_frames(data: bytes, at: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The samples of each frame; ``at``: the byte after each header."""
    bits = _Bits(data)
    place = at * 8
    kind = bits.read(place + 1, 6)
    wasted = np.zeros(len(at), np.int64)
    flagged = np.flatnonzero(bits.read(place + 7, 1))
    place = place + 8
    for i in flagged:
        wasted[i] = int(bits.zeros(place[i : i + 1])[0]) + 1
        place[i] += wasted[i]
    depth = 8 - wasted
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(at)
    for i in np.flatnonzero(kind == 0):
        out[i] = np.full(sizes[i], bits.signed(place[i : i + 1], int(depth[i]))[0] << wasted[i], np.int32)
    for i in np.flatnonzero(kind == 1):
        out[i] = bits.signed(place[i] + np.arange(sizes[i]) * int(depth[i]), int(depth[i])).astype(np.int32) << wasted[i]
    if (((kind > 1) & (kind < 8)) | ((kind > 12) & (kind < 32))).any():
        raise ValueError("reserved subframe")
    for first, last, is_lpc in ((8, 12, False), (32, 63, True)):
        for order in range(last - first + 1):
            p = order + is_lpc
            pick = np.flatnonzero(kind == first + order)
            if not len(pick):
                continue
            pick = pick[np.argsort(-sizes[pick], kind="stable")]
            own, size, deep = place[pick], sizes[pick], depth[pick]
            warm = np.zeros((p, len(pick)), np.int64)
            for d in np.unique(deep):
                some = deep == d
                for j in range(p):
                    warm[j, some] = bits.signed(own[some] + j * d, int(d))
            own = own + p * deep
            if is_lpc:
                precision, shift = bits.read(own, 4) + 1, bits.signed(own + 4, 5)
                own = own + 9
                coefs = np.zeros((p, len(pick)), np.int64)
                for w in np.unique(precision):
                    some = precision == w
                    for j in range(p):
                        coefs[j, some] = bits.signed(own[some] + j * w, int(w))
                own = own + p * precision
            e = _decode_residuals(bits, own, p, size)
            if is_lpc:
                x = e.astype(np.int64)
                x[:p] = warm
                for t in range(p, len(x)):
                    x[t] += (coefs * x[t - p : t][::-1]).sum(0) >> shift
            else:
                steps = [warm]
                for _ in range(p):
                    steps.append(np.diff(steps[-1], axis=0))
                x = e[p:]
                for j in range(p - 1, -1, -1):  # from the last difference back to the samples
                    x = np.cumsum(np.concatenate([steps[j][:1], x]), axis=0)
            for c, i in enumerate(pick):
                out[i] = x[: sizes[i], c].astype(np.int32) << wasted[i]
    return out


def decode_streams(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """Each stream's blocks as (sample offset, unsigned 8-bit PCM), all checksums verified."""
    where, sizes, owner, infos = [], [], [], []
    ranges: list[tuple[int, int]] = []
    base = 0
    for n, s in enumerate(streams):
        if s[:4] != b"fLaC":
            raise ValueError("not a FLAC stream")
        at, last, info = 4, False, b""
        while not last:
            last, kind, size = bool(s[at] & 128), s[at] & 127, int.from_bytes(s[at + 1 : at + 4], "big")
            if kind == 0:
                info = s[at + 4 : at + 4 + size]
            at += 4 + size
        stream_block = int.from_bytes(info[:2], "big")
        infos.append(info)
        found = []
        hit = s.find(b"\xff\xf8", at)
        while hit >= 0:
            if head := _header(s, hit, stream_block):
                found.append((hit, *head))
            hit = s.find(b"\xff\xf8", hit + 1)
        if not found or found[0][0] != at:
            raise ValueError("no frame where the first should be")
        for (begin, head, samples), end in zip(found, [*[f[0] for f in found[1:]], len(s)], strict=True):
            ranges.append((base + begin, base + end))
            where.append(base + begin + head)
            sizes.append(samples)
            owner.append(n)
        base += len(s)
    if not streams:
        return []
    data = b"".join(streams)
    raw = np.frombuffer(data, np.uint8)
    span = np.array(ranges, np.int64)
    bad = np.flatnonzero(crc16(raw, span[:, 0], span[:, 1]))  # over its own CRC too, a frame's CRC is zero
    if len(bad):  # what looked like a header may lie within a frame: join it to the frame before
        gone = set()
        i = 0
        while i < len(ranges):
            j = i
            while crc16(raw, np.array([ranges[i][0]]), np.array([ranges[j][1]]))[0]:
                j += 1
                if j >= len(ranges) or owner[j] != owner[i]:
                    raise ValueError("a frame fails its checksum")
                gone.add(j)
            i = j + 1
        left = [i for i in range(len(ranges)) if i not in gone]
        where, sizes, owner = [where[i] for i in left], [sizes[i] for i in left], [owner[i] for i in left]
    frames = _decode_frames(data, np.array(where, np.int64), np.array(sizes, np.int64))
    out: list[list[tuple[int, bytes]]] = [[] for _ in streams]
    done = [0] * len(streams)
    sums = [hashlib.md5() for _ in streams]
    for n, samples in zip(owner, frames, strict=True):
        sums[n].update(samples.astype(np.int8).tobytes())
        out[n].append((done[n], (samples + 128).astype(np.uint8).tobytes()))
        done[n] += len(samples)
    for n, info in enumerate(infos):
        if int.from_bytes(info[13:18], "big") & ((1 << 36) - 1) != done[n] or (any(info[18:34]) and sums[n].digest() != info[18:34]):
            raise ValueError("a stream fails its length or MD5")
    return out


def feature(payload: bytes) -> str:
    """Level statistics of the samples, as whole numbers: sum, sum of squares, peak, crossings of the middle."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"sum={int(x.sum())};energy={int((x * x).sum())};peak={int(np.abs(x).max())};crossings={crossings}"


def _named(df: DataFrame, *columns: str) -> DataFrame:
    """The columns under private names, so that an id may have any name."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lpc_order: int = LPC) -> DataFrame:
    """Every row's id, ``n_bytes`` of its text and ``media``, a FLAC stream of the padded bytes."""
    picked = fields(df, id_col, text_col)
    out = T.StructType(
        [T.StructField(id_col, picked.schema[0].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in each_slice(batches, text_col, ENCODED):
            raw = [(t or "").encode() for t in part.column(1).to_pylist()]
            streams = encode_streams([pad(r) for r in raw], lpc_order)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array(streams, pa.binary())], names=out.names
            )

    return picked.mapInArrow(run, out)


_BLOCK = T.StructType(
    [T.StructField("block", T.IntegerType()), T.StructField("sample_offset", T.LongType()), T.StructField("n_samples", T.IntegerType()), T.StructField("pcm", T.BinaryType())]
)


def blocks(df: DataFrame, media_col: str = "media", *carried: str) -> DataFrame:
    """Per stream the ``carried`` columns, ``media_bytes``, ``media_sha256`` and ``blocks``, an array of ``block``,
    ``sample_offset``, ``n_samples`` and ``pcm``: a sample lies in the last block whose offset does not exceed it."""
    picked = fields(df, media_col, *carried)
    out = T.StructType([*picked.schema[1:], T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()), T.StructField("blocks", T.ArrayType(_BLOCK))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in each_slice(batches, media_col, DECODED):
            media = part.column(0).to_pylist()
            whole = [m for m in media if m is not None]
            found = iter(decode_streams(whole))
            own = [[] if m is None else next(found) for m in media]
            ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
            flat = [b for each in own for b in each]
            inner = pa.StructArray.from_arrays(
                [
                    pa.array([i for each in own for i in range(len(each))], pa.int32()),
                    pa.array([o for o, _ in flat], pa.int64()),
                    pa.array([len(p) for _, p in flat], pa.int32()),
                    pa.array([p for _, p in flat], pa.binary()),
                ],
                names=_BLOCK.names,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[1:],
                    pa.array([None if m is None else len(m) for m in media], pa.int64()),
                    pa.array([None if m is None else hashlib.sha256(m).hexdigest() for m in media], pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), inner),
                ],
                names=out.names,
            )

    return picked.mapInArrow(run, out)


def decode(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row for each block of each stream: id, ``block``, ``sample_offset``, ``n_samples`` and ``pcm``."""
    return blocks(_named(df, media_col, id_col), "c0", "c1").select(F.col("c1").alias(id_col), F.inline("blocks"))


def _measured(df: DataFrame) -> DataFrame:
    """Digests and features of the payloads whose blocks were read."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [df.schema["c1"].dataType, T.LongType(), T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType(), T.StringType()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "blocks", DECODED):
                held = part.column(4)
                pcm, ends = held.flatten().field("pcm").to_pylist(), np.cumsum([0, *held.value_lengths().to_pylist()])
                payloads = [b"".join(pcm[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(p) for p in payloads], pa.int64()),
                        pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                        pa.array([zlib.crc32(p[-64:]) for p in payloads], pa.int64()),
                        part.column(2),
                        part.column(3),
                        pa.array([feature(p) for p in payloads], pa.string()),
                    ],
                    names=names,
                )

    picked = df.select("c1", "n_bytes", "media_bytes", "media_sha256", "blocks")
    return picked.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", waves: int = WAVES) -> DataFrame:
    """Store every text as FLAC, read the stored bytes back, and return digests and features of both."""
    named = _named(df, text_col, id_col)
    parts = []
    for wave in range(waves):
        own = named.filter(F.pmod(F.xxhash64("c0"), F.lit(waves)) == wave)
        media, media_path = written(encode(own, "c1", "c0"), "media")
        pcm, pcm_path = written(blocks(media, "media", "c1", "n_bytes"), "pcm")
        found, _ = written(_measured(pcm), "digests")
        discard(df.sparkSession, media_path, pcm_path)
        parts.append(found)
    return reduce(DataFrame.unionAll, parts)
