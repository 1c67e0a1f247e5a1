"""The schema of a graph, the choice of reserved predicates, and the state of a cluster that holds it."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.types import KINDS, RESERVED, Predicate


@dataclass(frozen=True)
class Schema:
    """A set of predicates."""

    predicates: frozenset[Predicate]

    @staticmethod
    def of(predicates: Iterable[Predicate]) -> Schema:
        return Schema(frozenset(predicates))

    @property
    def by_name(self) -> dict[str, Predicate]:
        return {p.name: p for p in sorted(self.predicates, key=lambda p: p.name)}

    @property
    def properties(self) -> list[Predicate]:
        return [p for p in self.by_name.values() if not p.is_edge]

    @property
    def edges(self) -> list[Predicate]:
        return [p for p in self.by_name.values() if p.is_edge]

    def filter(self, keep: Callable[[Predicate], bool]) -> Schema:
        return Schema.of(p for p in self.predicates if keep(p))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """``predicate``, ``type``, ``tag`` and ``lang``."""
        rows = [(p.name, p.kind, KINDS[p.kind][0], p.lang) for p in self.by_name.values()]
        return spark.createDataFrame(rows, "predicate string, type string, tag string, lang boolean")


class ReservedFilter:
    """Which reserved predicates to read: globs, comma-separated, in which only ``*`` is special.

    Others are always read.  Exclusion wins over inclusion.
    """

    def __init__(self, include: str | None = None, exclude: str | None = None):
        self.include = self._patterns(include if include is not None else RESERVED + "*")
        self.exclude = self._patterns(exclude) if exclude is not None else []

    @staticmethod
    def _patterns(globs: str) -> list[str]:
        names = globs.split(",")
        if any(not n.startswith(RESERVED) for n in names):
            raise ValueError(f"Reserved predicate filters must start with '{RESERVED}': {', '.join(names)}")
        return ["^" + ".*".join(re.escape(part) for part in n.split("*")) + "$" for n in names]

    def __call__(self, name: str) -> bool:
        if not name.startswith(RESERVED):
            return True
        return any(re.match(p, name) for p in self.include) and not any(re.match(p, name) for p in self.exclude)

    def column(self, predicate: Column) -> Column:
        """The same over a column of names."""
        said = lambda patterns: F.lit(False) if not patterns else F.rlike(predicate, F.lit("|".join(patterns)))
        return ~predicate.startswith(RESERVED) | (said(self.include) & ~said(self.exclude))


def plain_predicate(name: str) -> str | None:
    """A tablet's predicate without its namespace; None if that is not the default one."""
    if name.startswith("0-"):
        return name[2:]
    if name.startswith("\0"):
        return name.lstrip("\0")
    return None if re.match("[0-9]+-", name) else name


@dataclass(frozen=True)
class ClusterState:
    """Which group of machines holds which predicates."""

    members: dict[str, frozenset[str]]
    predicates: dict[str, frozenset[str]]
    max_uid: int | None
    cid: str

    @staticmethod
    def from_json(text: str, port_offset: int = 2000) -> ClusterState:
        """From a state report.  An id limit that is missing, negative or no number is none at all."""
        root = json.loads(text)
        members, predicates = {}, {}
        for name, group in root["groups"].items():
            found = set()
            for member in (group.get("members") or {}).values():
                host, _, port = member["addr"].rpartition(":")
                found.add(f"{host}:{int(port) + port_offset}")
            members[name] = frozenset(found)
            names = (plain_predicate(t["predicate"]) for t in (group.get("tablets") or {}).values())
            predicates[name] = frozenset(n for n in names if n is not None)
        limit = root.get("maxUID", root.get("maxLeaseId"))
        limit = str(limit) if limit is not None else ""
        value = int(limit) if re.fullmatch("[0-9]+", limit) and int(limit) < 1 << 64 else None
        return ClusterState(members, predicates, value, str(uuid.UUID(root["cid"])))

    def check_same(self, other: ClusterState) -> None:
        if self.cid != other.cid:
            raise ValueError(f"Targets belong to different clusters: {self.cid}, {other.cid}")

    @property
    def targets(self) -> list[str]:
        return sorted(set().union(*self.members.values())) if self.members else []
