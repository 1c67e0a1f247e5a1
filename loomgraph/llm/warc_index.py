"""WARC archives with a two-level capture index.

Writing: each task writes one archive, a gzip member a record, and returns the
records' places.  Payloads that occur before under a smaller id become revisit records.

Index: the places are sorted by key, the URL with its host reversed and the
record's id, into shards; a shard is a file of gzip blocks of ``LINES`` lines, and
its directory has the first key, offset and size of each block.  The shards'
first keys, one a shard, are all that a reader holds of the whole index.

Reading: a query goes to its shard by binary search over the shards' first
keys; there a binary search over the directory gives one block, which is read
by its byte range; a binary search in the block gives the record's place in
an archive, which is read by its byte range in turn.

A lost executor costs the repetition of its tasks: an attempt writes files of
its own name, and only names that a finished attempt returned are ever read.

Edge cases: a null payload counts as empty; a payload of any length is one record;
null URLs share the key ``-`` and are told apart by id; ids may be of any type that
text can be cast to, also with line breaks; rows that repeat an id are records of their own, all of
them responses if the id is the smallest with the payload; a null id never is
the smallest unless there is no other; an empty table makes an empty archive;
columns other than those named are not read, so that none can clash.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import discard, open_folder, scratch_path, written

#: Lines of a block of the index, and records of a shard.
LINES, SHARD = 1000, 100_000
#: Tasks that share the pages of one payload.
SALTS = 16
#: Fixed time of all records, as the tables have none.
DATE = "2000-01-01T00:00:00Z"


def url_key(url: str | None) -> str:
    """The URL with its host reversed, so that a site's pages sort together; no spaces."""
    if url is None:
        return "-"
    scheme, found, rest = url.partition("://")
    if found:
        host, tail = re.fullmatch(r"([^/?#]*)(.*)", rest, re.S).groups()
        name, port, number = host.rpartition("@")[2].lower().partition(":")
        url = ",".join(reversed(name.split("."))) + port + number + ")" + (tail or "/")
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_name(record: object) -> str:
    """An id as it stands in headers and index lines: ``-`` for null, else its text behind ``=``, without what would break a line."""
    return "-" if record is None else "=" + quote(str(record), safe="")


def capture_key(url: str | None, record: object) -> str:
    return f"{url_key(url)} {record:020d}" if isinstance(record, int) and record >= 0 else f"{url_key(url)} {record_name(record)}"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(url: str | None, record: object, payload: bytes, keeper: object) -> bytes:
    """A response record, or, if ``keeper`` is given, a revisit record that refers to it."""
    revisit = keeper is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-record:{record_name(record)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:x-record:{record_name(keeper)}>",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers of a record, its kind, digest, the record that it refers to, and payload (None: a revisit)."""
    head, _, block = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = block[: int(named["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = named["warc-payload-digest"].removeprefix("sha1:")
    kind = named["warc-type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"{named['warc-record-id']} fails its digest")
    name = lambda v: unquote(v[len("<urn:x-record:=") : -1]) if v and v.startswith("<urn:x-record:=") else None
    return {
        "record": name(named["warc-record-id"]), "kind": kind, "digest": digest, "bytes": size, "url": named["warc-target-uri"],
        "refers_to": name(named.get("warc-refers-to")), "payload": payload if kind == "response" else None,
    }


@dataclass
class Archive:
    """Where an archive and its index lie.  ``firsts``: the first key of each shard, in order."""

    spark: SparkSession
    folder: str
    firsts: list[str]
    shards: list[tuple[str, int]]


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> Archive:
    """Write a record for each row, then the two levels of the index."""
    spark = df.sparkSession
    folder = scratch_path(spark, "warc")
    rows = df.select(
        F.col(f"`{id_col}`").alias("record"), F.col(f"`{url_col}`").alias("url"), F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    copies, copies_path = written(
        rows.groupBy("sha1").agg(F.min("record").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "copies"
    )
    # a payload that very many pages have is dealt to several tasks
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("record", "url"), F.lit(SALTS)).cast("int"))
    marked = salted.join(copies.select("sha1", "keeper", salts), ["sha1", "salt"], "left").select(
        "record", "url", "payload", F.expr("CASE WHEN NOT record <=> keeper THEN keeper END").alias("keeper")
    )

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        at, out = 0, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                out = out or files.open_output_stream(f"{base}/{name}", compression=None)
                keys, places, sizes = [], [], []
                for record, url, payload, keeper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    member = _gzip(record_bytes(url, record, payload.encode(), keeper))
                    out.write(member)
                    keys.append(capture_key(url, record))
                    places.append(at)
                    sizes.append(len(member))
                    at += len(member)
                yield pa.RecordBatch.from_pydict({"key": keys, "file": [name] * len(keys), "offset": places, "size": sizes})
        finally:
            if out:
                out.close()

    places, places_path = written(marked.mapInArrow(put, "key string, file string, offset bigint, size bigint"), "places")
    n = places.count()
    shards = max(1, -(-n // SHARD), min(spark.sparkContext.defaultParallelism, n // (4 * LINES)))

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, base = open_folder(folder)
        name = f"index-{task.partitionId():06d}-{task.taskAttemptId()}"
        held: list[str] = []
        directory: list[tuple[str, int, int]] = []
        at, out = 0, None

        def block(lines: list[str]) -> None:
            nonlocal at
            member = _gzip("".join(lines).encode())
            out.write(member)
            directory.append((lines[0].partition("\t")[0], at, len(member)))
            at += len(member)

        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or files.open_output_stream(f"{base}/{name}.gz", compression=None)
            for key, *place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(f"{key}\t{json.dumps(place)}\n")
                if len(held) == LINES:
                    block(held)
                    held = []
        if held:
            block(held)
        if out:
            out.close()
            # the directory lies behind the shard; its size is part of what the shard's name stands for
            raw = _gzip(json.dumps(directory).encode())
            with files.open_output_stream(f"{base}/{name}.dir", compression=None) as f:
                f.write(raw)
            yield pa.RecordBatch.from_pydict({"first": [directory[0][0]], "name": [name], "size": [len(raw)]})

    # keys end with the id, so that one URL with very many captures still spreads over shards
    ordered = places.repartitionByRange(shards, "key").sortWithinPartitions("key", "file", "offset")
    found, found_path = written(ordered.mapInArrow(index, "first string, name string, size bigint"), "shards")
    shard_rows = sorted((r["first"], r["name"], r["size"]) for r in found.collect())  # a row a shard of SHARD records
    discard(spark, copies_path, places_path, found_path)
    return Archive(spark, folder, [r[0] for r in shard_rows], [(r[1], r[2]) for r in shard_rows])


def lookup(archive: Archive, queries: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The records of each distinct (URL, id) of ``queries``: ``record``, ``kind``, ``bytes``, ``digest``,
    ``refers_to`` (ids as text), ``url`` and ``payload`` (null for revisits)."""
    folder, firsts, shards = archive.folder, archive.firsts, archive.shards
    if not shards:
        return archive.spark.createDataFrame([], _RECORD)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [capture_key(u, r) for r, u in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            # a key that begins a shard may also end the one before
            spans = [(max(0, bisect_left(firsts, k) - 1), max(0, bisect_right(firsts, k) - 1)) for k in keys]
            pairs = [(s, k) for k, (a, b) in zip(keys, spans, strict=True) for s in range(a, b + 1)]
            yield pa.RecordBatch.from_pydict({"shard": pa.array([p[0] for p in pairs], pa.int32()), "key": pa.array([p[1] for p in pairs], pa.string())})

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        opened: dict[str, object] = {}
        at_shard = at_block = None
        directory: list = []
        block_firsts: list[str] = []
        lines: list[str] = []
        keys: list[str] = []

        def handle(name: str):
            if name not in opened:
                if len(opened) >= 64:
                    opened.pop(next(iter(opened))).close()
                opened[name] = files.open_input_file(f"{base}/{name}")
            return opened[name]

        for batch in batches:
            wanted: list[tuple[str, int, int]] = []
            for shard, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != at_shard:
                    name, size = shards[shard]
                    directory = json.loads(zlib.decompress(handle(f"{name}.dir").read_at(size, 0), 31))
                    block_firsts = [d[0] for d in directory]
                    at_shard, at_block = shard, None
                for number in range(max(0, bisect_left(block_firsts, key) - 1), max(0, bisect_right(block_firsts, key) - 1) + 1):
                    if number != at_block:
                        _, offset, size = directory[number]
                        raw = handle(f"{shards[shard][0]}.gz").read_at(size, offset)
                        lines = zlib.decompress(raw, 31).decode().split("\n")[:-1]
                        keys = [line.partition("\t")[0] for line in lines]
                        at_block = number
                    for i in range(bisect_left(keys, key), bisect_right(keys, key)):
                        wanted.append(tuple(json.loads(lines[i].partition("\t")[2])))
            wanted.sort()
            for i in range(0, len(wanted), 256):
                got = [parse_record(zlib.decompress(handle(f).read_at(size, offset), 31)) for f, offset, size in wanted[i : i + 256]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[c.name] for g in got], pa.binary() if c.name == "payload" else pa.int64() if c.name == "bytes" else pa.string()) for c in _RECORD],
                    names=_RECORD.names,
                )
        for f in opened.values():
            f.close()

    routed = (
        queries.select(F.col(f"`{id_col}`").alias("record"), F.col(f"`{url_col}`").alias("url"))
        .mapInArrow(route, "shard int, key string")
        .distinct()
        .repartition(len(shards), "shard", F.substring(F.sha1("key"), 1, 1))
        .sortWithinPartitions("shard", "key")
    )
    return routed.mapInArrow(read, _RECORD)


_RECORD = T.StructType(
    [
        T.StructField("record", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def digest(df: DataFrame) -> DataFrame:
    """Write an archive of all pages, look every page up in it and return what its record says."""
    found = lookup(write(df), df)
    kind = df.schema["page_id"].dataType
    return found.select(
        F.col("record").cast(kind).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
