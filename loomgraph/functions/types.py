"""Graph value types, layout schemas, the node-id codec and scalar expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Predicates of the engine itself; they can be selected apart from the data's.
RESERVED = "graph."
TYPE_PREDICATE = RESERVED + "type"

#: Graph type -> (tag in objectType, typed column, Spark type).
KINDS: dict[str, tuple[str, str, T.DataType]] = {
    "uid": ("uid", "objectUid", T.LongType()),
    "string": ("string", "objectString", T.StringType()),
    "int": ("long", "objectLong", T.LongType()),
    "float": ("double", "objectDouble", T.DoubleType()),
    "datetime": ("timestamp", "objectTimestamp", T.TimestampNTZType()),
    "bool": ("boolean", "objectBoolean", T.BooleanType()),
    "geo": ("geo", "objectGeo", T.StringType()),
    "password": ("password", "objectPassword", T.StringType()),
    "default": ("string", "objectString", T.StringType()),
}

#: The typed value columns in order.
VALUE_COLUMNS: dict[str, T.DataType] = {column: kind for _, column, kind in KINDS.values()}


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


_SUBJECT = ("subject", T.LongType(), False)
_PREDICATE = ("predicate", T.StringType(), False)
_TYPE = ("objectType", T.StringType(), False)

TYPED_TRIPLES = _schema(_SUBJECT, _PREDICATE, *[(c, k, True) for c, k in VALUE_COLUMNS.items()], _TYPE)
STRING_TRIPLES = _schema(_SUBJECT, _PREDICATE, ("objectString", T.StringType(), False), _TYPE)
TYPED_NODES = T.StructType([f for f in TYPED_TRIPLES if f.name != "objectUid"])
EDGES = _schema(_SUBJECT, _PREDICATE, ("objectUid", T.LongType(), False))


@dataclass(frozen=True)
class Predicate:
    """One entry of a graph's schema."""

    name: str
    kind: str
    lang: bool = False

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown graph type: {self.kind}")

    @property
    def is_edge(self) -> bool:
        return self.kind == "uid"

    @property
    def reserved(self) -> bool:
        return self.name.startswith(RESERVED)


def as_text(value: Column, kind: str) -> Column:
    """A value as the string layout shows it: ids signed, timestamps with at least one decimal."""
    if kind == "datetime":
        return F.regexp_replace(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"(\.\d+?)0+$", "$1")
    return value.cast("string")


# node ids: unsigned 64-bit, held in the same bits of a signed long


def uid_from_hex(text: Column) -> Column:
    """``0x…`` to the long of the same bits."""
    return F.conv(F.regexp_replace(text, "^0[xX]", ""), 16, -10).cast("long")


def uid_to_hex(uid: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(uid)))


def unsigned_order(uid: Column) -> Column:
    """A key that sorts longs by their unsigned values."""
    return uid.bitwiseXOR(F.lit(-(1 << 63)))


def to_signed(uid: int) -> int:
    """An unsigned id, or one that is signed already, as a signed long."""
    if not -(1 << 63) <= uid < 1 << 64:
        raise ValueError(f"not a 64-bit id: {uid}")
    return uid - (1 << 64) if uid >= 1 << 63 else uid


def to_unsigned(uid: int) -> int:
    return uid & ((1 << 64) - 1)


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 with or without offset; the offset goes, the wall clock stays."""
    return F.to_timestamp_ntz(F.regexp_replace(text, r"([zZ]|[+-]\d{2}:?\d{2})$", ""))


def escaped_name(name: str) -> str:
    """A column name without dots: ``_`` is doubled, then ``.`` becomes ``_``."""
    return name.replace("_", "__").replace(".", "_")


def abbreviated(text: str, most: int, middle: str = "…") -> str:
    """``text`` with its middle left out if it is longer than ``most``."""
    if len(text) <= most or most < len(middle) + 2:
        return text
    left = most - len(middle)
    return text[: left // 2 + left % 2] + middle + text[len(text) - left // 2 :]


def rotated_left(items: list, by: int) -> list:
    """``items`` turned left; negative numbers turn right."""
    if not items:
        return items
    by %= len(items)
    return items[by:] + items[:by]


def rotated_array(items: Column, by: int) -> Column:
    """The array turned left by ``by`` places."""
    size = F.size(items)
    at = F.when(size > 0, F.pmod(F.lit(by), size)).otherwise(F.lit(0))
    return F.when(size > 0, F.concat(F.slice(items, at + 1, size), F.slice(items, F.lit(1), at))).otherwise(items)
