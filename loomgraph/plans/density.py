"""Where the dense ids of a graph end: a search that probes a few consecutive ids at a time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

#: A probe: up to ``k`` consecutive ids from one on, in order.
Probe = Callable[[int, int], list[int]]


def gaps(uids: list[int]) -> list[int]:
    return [b - a for a, b in zip(uids, uids[1:], strict=False)]


def is_sparse(uids: list[int], threshold: int = (1 << 31) - 1, repeats: int = 2) -> bool:
    """Whether no ``repeats`` gaps in a row are below the threshold; too few ids are dense."""
    if repeats < 1:
        raise ValueError(f"the number of repeated gaps must be larger than zero: {repeats}")
    if len(uids) <= repeats:
        return False
    run = 0
    for gap in gaps(uids):
        run = run + 1 if gap < threshold else 0
        if run >= repeats:
            return False
    return True


def upper_median(values: list[int]) -> int:
    return sorted(values)[len(values) // 2]


@dataclass(frozen=True)
class GapEstimate:
    """The running mean of the probes' median gaps."""

    value: float = 0.0
    weight: int = 0

    def update(self, found: list[int]) -> GapEstimate:
        if not found:
            return self
        return GapEstimate((self.value * self.weight + upper_median(found)) / (self.weight + 1), self.weight + 1)


def binary_middle(left: int, right: int, narrowest: int = 0) -> int | None:
    return (left + right) // 2 if right - left > narrowest else None


def log_middle(left: int, right: int) -> int | None:
    """All bits set up to the mean number of bits of both ends, if that lies between them."""
    if left.bit_length() >= right.bit_length():
        return None
    bits = (left.bit_length() + right.bit_length()) // 2
    middle = (1 << bits) - 1
    return middle if left < middle < right else None


def dense_end(probe: Probe, lowest: int, uids: int, length: int, middle: Callable[[int, int], int | None] = log_middle) -> tuple[int, int]:
    """The first id from which on ids are sparse, as far as probes tell, and the estimated gap there."""
    left, right, estimate = lowest, uids, GapEstimate()
    while (at := middle(left, right)) is not None:
        found = probe(at, length)
        if not found:
            right = at
        elif is_sparse(found):
            right, estimate = at, estimate.update(gaps(found))
        else:
            left = at
    return right, int(estimate.value)


def probe_length(chunk_size: int) -> int:
    return max(chunk_size // 100, 10)
