"""Secret scanning: keyword automaton, anchored expressions near hits, checksum validation.

One pass of an Aho-Corasick automaton over a text finds the few places where a
secret can start; only there an anchored regular expression runs.  Kinds whose
tokens carry an embedded checksum are kept only if it holds.

Runs of hexadecimal digits have no keyword of their own, but every run of 24
digits starts with four of them, so all 16**4 four-digit strings serve as the
keywords; this loses no run.

Edge cases: a null or empty text has no spans; a text of any length is read whole,
in one pass; row count, repeated rows, ties and null ids pass through unchanged; an
empty table gives an empty table; columns other than the id and the text are not
read, and :func:`redact` carries them unchanged whatever their names.  Offsets are
code points, ends exclusive.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import each_slice, fields

#: Kinds in the order used to sort spans that start together.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = ("assign", "access", "hex")

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType(), False),
            T.StructField("start", T.IntegerType(), False),
            T.StructField("end", T.IntegerType(), False),
        ]
    ),
    False,
)

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def base62_crc32(body: str) -> str:
    """The six-digit base-62 CRC-32 that ends checksummed access tokens."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _DIGITS[digit] + out
    return out


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        a.add_word(word, (0, len(word)))
    a.add_word("akia", (1, 4))
    for digits in product("0123456789abcdef", repeat=4):
        a.add_word("".join(digits), (2, 4))
    for prefix in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"):
        a.add_word(prefix, (3, 4))
    a.add_word("npm_", (4, 4))
    a.make_automaton()
    return a


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """Spans of a text as (start, kind number, end), sorted."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):  # a few letters grow when lower-cased; offsets must not move
        low = text.translate(_TO_LOWER)
    done = [0] * len(KINDS)
    found = []
    for last, (kind, size) in _automaton().iter(low):
        at = last - size + 1
        if at < done[kind]:
            continue
        if kind == 2:
            m = _HEX.match(text, at)
            if m:
                done[2] = m.end()
                if m.end() - at >= 24:
                    found.append((at, 2, m.end()))
        elif kind == 0:
            m = _ASSIGN.match(text, at)
            if m:
                done[0] = m.end()
                if len(m[2]) >= 6:
                    found.append((at, 0, m.end()))
        elif kind == 1:
            m = _ACCESS.match(text, at)
            if m:
                done[1] = m.end()
                if m.end() - at >= 20:
                    found.append((at, 1, m.end()))
        else:
            m = _CHECKED.match(text, at)
            if m and base62_crc32(m[1]) == m[2]:
                done[kind] = m.end()
                found.append((at, kind, m.end()))
    found.sort()
    return found


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id and ``spans``, an array of (kind, start, end) by start, then kind."""
    picked = fields(df, id_col, text_col)
    out = T.StructType([T.StructField(id_col, picked.schema[0].dataType), T.StructField("spans", SPANS, False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([pa.field("kind", pa.string(), False), pa.field("start", pa.int32(), False), pa.field("end", pa.int32(), False)])
        for part in each_slice(batches, text_col):
            rows = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find_spans(t)]
                for t in part.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(rows, pa.list_(pa.field("element", kind, False)))], names=[id_col, "spans"]
            )

    return picked.mapInArrow(run, out)


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, overlapping ones merged, replaced by ``mark``."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at = [], 0
    end = -1
    for s, _, e in spans:
        if s >= end:
            if end >= 0:
                out.append(mark)
                at = end
            out.append(text[at:s])
            end = e
        else:
            end = max(end, e)
    out.append(mark)
    out.append(text[end:])
    return "".join(out)


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All columns and rows of ``df``, with the secrets in ``text_col`` replaced by ``mark``."""
    at = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).flatten()
            texts = pa.array([redacted(t, mark) for t in own[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(own)], names=batch.schema.field(0).type.names)

    # the row goes as one column, so that its columns may have any name
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).mapInArrow(run, df.schema)


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the spans of every text."""
    found = scan(df, id_col, text_col)

    def of(*kinds: str):
        return F.filter("spans", lambda x: x["kind"].isin(*kinds))

    def joined(spans):
        said = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
        return F.concat_ws(",", said)

    return found.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(of(*BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
