import hashlib
import struct
import zlib

import numpy as np
import pytest

from llm_cases import awkward, empty
from loomgraph.llm import flac as f


def payloads():
    rng = np.random.default_rng(0)
    walk = np.clip(np.cumsum(rng.integers(-3, 4, 9984)) + 128, 0, 255).astype(np.uint8)
    return [
        f.pad(b""), f.pad(b"hello"), f.pad(bytes(10000)), rng.integers(0, 256, 64 * 333).astype(np.uint8).tobytes(), bytes([0, 255] * 3200), b"\xff\xf8t\x02" * 1600,
        f.pad(b"the quick brown fox " * 700), walk.tobytes(), bytes(range(256)) * 64, bytes([128] * 4095 + [0] + [128] * 4096),
    ]


@pytest.mark.parametrize("order", [0, 1, 4, 8, 32])
def test_round_trip(order):
    streams = f.encode_streams(payloads(), order)
    out = f.decode_streams(streams)
    assert [b"".join(p for _, p in blocks) for blocks in out] == payloads()
    for blocks in out:
        assert [o for o, _ in blocks] == [sum(len(p) for _, p in blocks[:i]) for i in range(len(blocks))]
    assert [f.encode_streams([p], order)[0] for p in payloads()] == streams


def test_predictors_pay():
    walk = payloads()[7]
    assert len(f.encode_streams([walk])[0]) < 0.6 * len(walk) and len(f.encode_streams([walk], 8)[0]) < 0.65 * len(walk)


def test_numbers():
    for n in (0, 127, 128, 2047, 2048, 65535, 65536, (1 << 21) - 1, 1 << 21, (1 << 26) - 1, 1 << 26, (1 << 31) - 1):
        coded = f._number(n)
        assert f._read_number(coded, 0) == len(coded)
        if n < 0xD800:
            assert coded == chr(n).encode()


def test_damage_is_found():
    stream = bytearray(f.encode_streams([f.pad(b"some text to keep " * 400)])[0])
    for at in (len(stream) - 1, len(stream) - 40, len(stream) // 2, 26):
        bad = bytearray(stream)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            f.decode_streams([bytes(bad)])
    with pytest.raises(ValueError):
        f.decode_streams([b"RIFF" + bytes(60)])


class Writer:
    def __init__(self):
        self.bits = []

    def put(self, value, width):
        self.bits += [(value >> (width - 1 - i)) & 1 for i in range(width)]

    def rice(self, e, k):
        u = e * 2 if e >= 0 else -e * 2 - 1
        self.bits += [0] * (u >> k) + [1]
        self.put(u & ((1 << k) - 1), k)

    def bytes(self):
        return np.packbits(self.bits).tobytes()


def stream_of(samples, subframe):
    """A stream of one frame with a hand-made subframe, and no MD5."""
    head = b"\xff\xf8\x74\x02\x00" + struct.pack(">H", len(samples) - 1)
    body = head + bytes([f.crc8(head)]) + subframe.bytes()
    raw = np.frombuffer(body, np.uint8)
    body += struct.pack(">H", int(f.crc16(raw, np.array([0]), np.array([len(raw)]))[0]))
    info = struct.pack(">HH", 4096, 4096) + bytes(6) + ((8000 << 44) | (7 << 36) | len(samples)).to_bytes(8, "big") + bytes(16)
    return b"fLaC\x80\x00\x00\x22" + info + body


def decoded(samples, subframe):
    return np.frombuffer(f.decode_streams([stream_of(samples, subframe)])[0][0][1], np.uint8).astype(int).tolist()


def test_other_subframes():
    constant = Writer()
    constant.put(0, 8)
    constant.put(-7 & 255, 8)
    assert decoded([0] * 20, constant) == [121] * 20
    samples = [5, -9, 100, -128, 127, 0, 33, -1] * 4
    verbatim = Writer()
    verbatim.put(1 << 1, 8)
    for s in samples:
        verbatim.put(s & 255, 8)
    assert decoded(samples, verbatim) == [s + 128 for s in samples]
    wasted = Writer()  # two low bits are always zero
    wasted.put((1 << 1) | 1, 8)
    wasted.bits += [0, 1]
    for s in samples:
        wasted.put((s >> 2) & 63, 6)
    assert decoded(samples, wasted) == [(s >> 2 << 2) + 128 for s in samples]


def test_partitions_and_escapes():
    samples = [(i * i) % 61 - 30 for i in range(32)]
    rice = Writer()  # order 1, four partitions, the third escaped to raw bits, 5-bit parameters
    rice.put((8 + 1) << 1, 8)
    rice.put(samples[0] & 255, 8)
    rice.put(1, 2)
    rice.put(2, 4)
    e = [samples[i] - samples[i - 1] for i in range(1, 32)]
    for part, (a, b) in enumerate(((1, 8), (8, 16), (16, 24), (24, 32))):
        if part == 2:
            rice.put(31, 5)
            rice.put(9, 5)
            for i in range(a, b):
                rice.put(e[i - 1] & 511, 9)
            continue
        rice.put(part + 1, 5)
        for i in range(a, b):
            rice.rice(e[i - 1], part + 1)
    assert decoded(samples, rice) == [s + 128 for s in samples]


def test_long_unary_run():
    samples = [0] * 16 + [120] + [0] * 15
    rice = Writer()
    rice.put(8 << 1, 8)
    rice.put(0, 2)
    rice.put(0, 4)
    rice.put(0, 4)
    for s in samples:
        rice.rice(s, 0)
    assert decoded(samples, rice) == [s + 128 for s in samples]


def test_tables(spark):
    df, rows = awkward(spark)
    found = sorted(map(tuple, f.digest(df).collect()), key=str)
    expected = []
    for i, t in rows:
        raw = (t or "").encode()
        p = f.pad(raw)
        assert len(p) % 64 == 0 and len(p) > 0 and p.startswith(raw)
        media = f.encode_streams([p])[0]
        expected.append((i, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(media), hashlib.sha256(media).hexdigest(), f.feature(p)))
    assert found == sorted(expected, key=str)
    blocks = f.decode(f.encode(df.where("doc_id = 12"), lpc_order=4)).orderBy("block").collect()
    text = next(t for i, t in rows if i == 12)
    assert b"".join(b.pcm for b in blocks) == f.pad(text.encode()) and [b.sample_offset for b in blocks] == [4096 * j for j in range(len(blocks))]
    assert f.digest(empty(spark)).count() == 0
    assert f.decode(f.encode(empty(spark))).count() == 0


def test_smaller_predictor_is_taken():
    tone = bytes(int(128 + 60 * np.sin(i * 1.1) + 50 * np.sin(i * 2.3)) for i in range(16384))
    noise = np.random.default_rng(1).integers(0, 256, 4096).astype(np.uint8).tobytes()
    for payload, kinds in ((tone, {32 + f.LPC - 1}), (noise + bytes(64), {1}), (bytes(4096), set(range(8, 13)))):
        mixed, fixed = f.encode_streams([payload])[0], f.encode_streams([payload], 0)[0]
        assert len(mixed) <= len(fixed) and b"".join(p for _, p in f.decode_streams([mixed])[0]) == payload
        first = mixed.index(b"\xff\xf8\x74\x02")
        assert mixed[first + 8] >> 1 in kinds and len(mixed) <= len(payload) + 150


def test_streams_and_blocks_are_stored_and_read(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["abc" * 5000, None, "x", "", "abc" * 5000])], "media long, text string")
    table = f.encode(df.withColumnRenamed("media", "n"), "n")
    table.write.parquet(str(tmp_path / "media"))
    rows = f.blocks(spark.read.parquet(str(tmp_path / "media")), "media", "n", "n_bytes")
    rows.write.parquet(str(tmp_path / "pcm"))
    found = {r.n: r for r in spark.read.parquet(str(tmp_path / "pcm")).collect()}
    assert [b.sample_offset for b in found[0].blocks] == [0, 4096, 8192, 12288] and [b.n_samples for b in found[0].blocks] == [4096, 4096, 4096, 15040 - 12288]
    assert found[0].media_sha256 == found[4].media_sha256 and bytes(found[1].blocks[0].pcm) == bytes(64)
    # a sample by its offset
    block = max((b for b in found[0].blocks if b.sample_offset <= 9000), key=lambda b: b.sample_offset)
    assert block.pcm[9000 - block.sample_offset] == b"abc"[9000 % 3]
    assert f.digest(df, "media").columns[0] == "doc_id" and f.digest(df, "media", waves=3).count() == 5
    none = spark.createDataFrame([(1, None)], "id long, media binary")
    assert f.decode(none, "id").count() == 0


def test_a_megabyte(spark):
    text = "x" * 1_000_001
    (r,) = f.digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert r.n_bytes == 1_000_001 and r.payload_bytes == 1_000_064 and r.payload_sha256 == hashlib.sha256(f.pad(text.encode())).hexdigest()
