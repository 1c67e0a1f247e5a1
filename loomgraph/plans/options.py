"""Reader options, by names that ignore case."""

from __future__ import annotations

import json
from dataclasses import dataclass

#: Option names and defaults.
DEFAULTS: dict[str, str | None] = {
    "loomgraph.target": None,
    "loomgraph.targets": None,
    "loomgraph.triples.mode": "typed",
    "loomgraph.nodes.mode": "typed",
    "loomgraph.include.reserved-predicates": None,
    "loomgraph.exclude.reserved-predicates": None,
    "loomgraph.transaction.mode": "none",
    "loomgraph.chunkSize": "100000",
    "loomgraph.partitioner": "predicate+uid-range",
    "loomgraph.partitioner.alpha.partitionsPerAlpha": "1",
    "loomgraph.partitioner.predicate.predicatesPerPartition": "1000",
    "loomgraph.partitioner.uidRange.uidsPerPartition": "1000000",
    "loomgraph.partitioner.uidRange.maxPartitions": "10000",
    "loomgraph.partitioner.uidRange.estimator": "maxUid",
    "loomgraph.partitioner.uidRange.estimator.maxUid.id": None,
}


@dataclass(frozen=True)
class Options:
    values: tuple[tuple[str, str], ...] = ()

    @staticmethod
    def of(values: dict[str, object] | None = None) -> Options:
        return Options(tuple(sorted((k.lower(), str(v)) for k, v in (values or {}).items())))

    def get(self, name: str) -> str | None:
        return dict(self.values).get(name.lower(), DEFAULTS.get(name))

    def number(self, name: str) -> int:
        """A number that must be larger than zero."""
        value = int(self.get(name))
        if value <= 0:
            raise ValueError(f"{name} must be larger than zero: {value}")
        return value

    def choice(self, name: str, *allowed: str) -> str:
        value = self.get(name)
        if value not in allowed:
            raise ValueError(f"{name} must be one of {', '.join(allowed)}: {value}")
        return value

    @property
    def targets(self) -> list[str]:
        """All given by target, path, targets and paths; the last two are JSON arrays."""
        out: list[str] = []
        for name in ("loomgraph.targets", "paths"):
            if (many := self.get(name)) is not None:
                out += json.loads(many)
        out += [one for name in ("loomgraph.target", "path") if (one := self.get(name)) is not None]
        if not out:
            raise ValueError("No targets given; name them in load(…) or by option loomgraph.target")
        return out
