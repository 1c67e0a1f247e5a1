"""Read planning: which predicates and which id ranges go together.

A plan is a list of parts with disjoint contents whose union is the whole graph.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from loomgraph.functions.types import rotated_left
from loomgraph.plans.catalog import ClusterState, Schema
from loomgraph.plans.options import Options

MAX_UID = (1 << 64) - 1


@dataclass(frozen=True)
class Part:
    """Predicates and, if bounded, the half-open range of ids to read from the first reachable target."""

    targets: tuple[str, ...]
    predicates: frozenset[str]
    uids: tuple[int, int] | None = None
    subjects: frozenset[int] | None = None

    def __post_init__(self) -> None:
        if self.uids and not self.uids[0] < self.uids[1]:
            raise ValueError(f"empty id range: {self.uids}")


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def by_digest(names: frozenset[str] | set[str]) -> list[str]:
    """Names in the order of their MD5, which deals them out evenly and alike everywhere."""
    return sorted(names, key=lambda n: hashlib.md5(n.encode()).hexdigest())


def shard_of(name: str, shards: int) -> int:
    """The shard of a name by its MD5 as a number."""
    return int(hashlib.md5(name.encode()).hexdigest(), 16) % shards


def dealt(names: frozenset[str] | set[str], parts: int) -> list[frozenset[str]]:
    """Names dealt to parts in turn."""
    order = by_digest(names)
    return [frozenset(order[i::parts]) for i in range(parts) if order[i::parts]]


def _held(state: ClusterState, schema: Schema) -> list[tuple[str, tuple[str, ...], frozenset[str]]]:
    known = set(schema.by_name)
    out = [(g, tuple(sorted(state.members.get(g, ()))), frozenset(p & known)) for g, p in sorted(state.predicates.items())]
    return [x for x in out if x[2]]


def singleton(state: ClusterState, schema: Schema) -> list[Part]:
    return [Part(tuple(state.targets), frozenset(schema.by_name))]


def group(state: ClusterState, schema: Schema) -> list[Part]:
    return [Part(targets, names) for _, targets, names in _held(state, schema)]


def _turned(targets: tuple[str, ...], sets: list[frozenset[str]]) -> list[Part]:
    return [Part(tuple(rotated_left(list(targets), i)), s) for i, s in enumerate(sets)]


def alpha(state: ClusterState, schema: Schema, per_member: int = 1) -> list[Part]:
    if per_member <= 0:
        raise ValueError(f"partitionsPerAlpha must be larger than zero: {per_member}")
    return [p for _, targets, names in _held(state, schema) for p in _turned(targets, dealt(names, max(1, len(targets) * per_member)))]


def predicate(state: ClusterState, schema: Schema, per_part: int = 1000) -> list[Part]:
    if per_part <= 0:
        raise ValueError(f"predicatesPerPartition must be larger than zero: {per_part}")
    return [p for _, targets, names in _held(state, schema) for p in _turned(targets, dealt(names, ceil_div(len(names), per_part)))]


def cardinality(part: Part, max_uid: int | None) -> int:
    """How many ids a part may hold: its range, else its ids, else the limit, else all there are."""
    if part.uids:
        return part.uids[1] - part.uids[0]
    if part.subjects is not None:
        return len(part.subjects)
    return max_uid if max_uid is not None else MAX_UID


def uniform(part: Part, parts: int, size: int, first: int) -> list[Part]:
    return [
        replace(part, uids=(first + i * size, first + (i + 1) * size), targets=tuple(rotated_left(list(part.targets), i)))
        for i in range(parts)
    ]


def split_counts(uids: int, dense: int, gap: int, size: int, most: int) -> tuple[int, int]:
    """How many parts the dense ids up to ``dense`` get, and how many the sparse rest with gaps of ``gap``."""
    sparse = (uids - dense) // gap if gap > 0 else 0
    dense_parts, sparse_parts = ceil_div(dense, size), ceil_div(sparse, size)
    if dense_parts + sparse_parts <= most:
        return dense_parts, sparse_parts
    if sparse_parts > 1 and dense_parts < most:
        return dense_parts, most - dense_parts
    sparse_parts = min(sparse_parts, 1)
    return most - sparse_parts, sparse_parts


def uid_range(
    parts: list[Part],
    max_uid: int | None,
    size: int = 1_000_000,
    most: int = 10_000,
    detect: Callable[[Part, int], tuple[int, int]] | None = None,
) -> list[Part]:
    """Each part cut into ranges of ``size`` ids, at most ``most`` of them.

    If uniform ranges were too many, ``detect`` tells where the dense ids end and how wide gaps are
    after that; dense and sparse ids then get ranges of their own, disjoint and together complete.
    """
    if size <= 0:
        raise ValueError(f"uidsPerPartition must be larger than zero: {size}")
    if most <= 0:
        raise ValueError(f"maxPartitions must be larger than zero: {most}")
    if any(p.uids for p in parts):
        raise ValueError("an id range cannot be cut into id ranges again")
    out: list[Part] = []
    for part in parts:
        uids = cardinality(part, max_uid)
        wanted = ceil_div(uids, size)
        if wanted <= 1:
            out.append(part)
        elif wanted <= most:
            out += uniform(part, wanted, size, 1)
        else:
            dense, gap = detect(part, uids) if detect else (uids, 0)
            dense_parts, sparse_parts = split_counts(uids, dense, gap, size, most)
            if not sparse_parts and dense < uids:  # without an estimate the rest is still read
                dense_parts, sparse_parts = (dense_parts, 1) if dense_parts < most else (max(most - 1, 0), 1)
            after = 1
            if dense_parts:
                own = uniform(part, dense_parts, ceil_div(dense, dense_parts), 1)
                after = own[-1].uids[1]
                out += own
            if sparse_parts and after <= uids:
                out += uniform(part, sparse_parts, ceil_div(uids + 1 - after, sparse_parts), after)
    return out


def plan(
    state: ClusterState, schema: Schema, options: Options, detect: Callable[[Part, int], tuple[int, int]] | None = None
) -> list[Part]:
    """The parts that the option ``partitioner`` asks for: a name, or a name and ``+uid-range``."""
    name = options.get("loomgraph.partitioner")
    base, plus, ranged = name.partition("+")
    if base == "uid-range" and not plus:
        base, ranged = "singleton", "uid-range"
    makers = {
        "singleton": lambda: singleton(state, schema),
        "group": lambda: group(state, schema),
        "alpha": lambda: alpha(state, schema, options.number("loomgraph.partitioner.alpha.partitionsPerAlpha")),
        "predicate": lambda: predicate(state, schema, options.number("loomgraph.partitioner.predicate.predicatesPerPartition")),
    }
    if base not in makers or (ranged and ranged != "uid-range"):
        raise ValueError(f"Unknown partitioner: {name}")
    parts = makers[base]()
    if not ranged:
        return parts
    options.choice("loomgraph.partitioner.uidRange.estimator", "maxUid")
    given = options.get("loomgraph.partitioner.uidRange.estimator.maxUid.id")
    return uid_range(
        parts,
        int(given) if given is not None else state.max_uid,
        options.number("loomgraph.partitioner.uidRange.uidsPerPartition"),
        options.number("loomgraph.partitioner.uidRange.maxPartitions"),
        detect,
    )
