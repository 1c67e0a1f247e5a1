import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomgraph.functions.types import Predicate, abbreviated, escaped_name, rotated_left, to_signed, to_unsigned
from loomgraph.plans import density, partitioner
from loomgraph.plans.catalog import ClusterState, ReservedFilter, Schema, plain_predicate
from loomgraph.plans.options import Options

CID = "5aacce50-a95f-440b-a32e-fbe6b4003980"
SCHEMA = Schema.of(Predicate(f"pred{i}", "string") for i in range(1, 7))
STATE = ClusterState(
    {"1": frozenset({"h1:9080", "h2:9080"}), "2": frozenset({"h3:9080"}), "3": frozenset({"h4:9080"}), "4": frozenset({"h5:9080", "h6:9080"})},
    {"1": frozenset({"pred1", "pred2", "pred3", "pred4"}), "2": frozenset({"pred5"}), "3": frozenset(), "4": frozenset({"pred6", "other"})},
    10000,
    CID,
)


def test_state_report():
    report = {
        "groups": {
            "1": {"members": {"1": {"addr": "alpha1:7080"}, "2": {"addr": "alpha2:7080"}}, "tablets": {"a": {"predicate": "0-name"}, "b": {"predicate": "1-title"}, "c": {"predicate": "\0\0x"}}},
            "2": {},
        },
        "maxUID": "10000",
        "cid": CID,
    }
    state = ClusterState.from_json(json.dumps(report))
    assert state.members == {"1": {"alpha1:9080", "alpha2:9080"}, "2": set()}
    assert state.predicates == {"1": {"name", "x"}, "2": set()}
    assert state.max_uid == 10000 and state.cid == CID
    for limit, expected in (("-1", None), ("text", None), (str((1 << 64) - 1), (1 << 64) - 1), (str(1 << 64), None), ("0", 0), (5, 5)):
        assert ClusterState.from_json(json.dumps(report | {"maxUID": limit})).max_uid == expected
    del report["maxUID"]
    assert ClusterState.from_json(json.dumps(report)).max_uid is None
    assert ClusterState.from_json(json.dumps(report | {"maxLeaseId": 7})).max_uid == 7
    with pytest.raises(ValueError):
        state.check_same(ClusterState.from_json(json.dumps(report | {"cid": "00000000-0000-0000-0000-000000000001"})))


def test_namespaces():
    assert [plain_predicate(p) for p in ("name", "0-name", "12-name", "\0name", "a-1")] == ["name", "name", None, "name", "a-1"]


def test_reserved_filter():
    assert ReservedFilter()("graph.type") and ReservedFilter()("name")
    assert not ReservedFilter("graph.x*")("graph.type") and ReservedFilter("graph.x*,graph.t*pe")("graph.type")
    assert not ReservedFilter("graph.*", "graph.type")("graph.type") and ReservedFilter("graph.*", "graph.type")("graph.types")
    assert not ReservedFilter("graph.t?pe")("graph.type")
    with pytest.raises(ValueError):
        ReservedFilter("name")


def test_md5_deal():
    names = frozenset({"release_date", "starring", "director", "running_time", "graph.type", "name", "revenue", "title"})
    assert [set(s) for s in partitioner.dealt(names, 4)] == [
        {"graph.type", "release_date"}, {"director", "running_time"}, {"name", "revenue"}, {"starring", "title"},
    ]


def test_partitioners():
    assert [p.predicates for p in partitioner.singleton(STATE, SCHEMA)] == [set(SCHEMA.by_name)]
    assert [p.predicates for p in partitioner.group(STATE, SCHEMA)] == [{"pred1", "pred2", "pred3", "pred4"}, {"pred5"}, {"pred6"}]
    assert [len(p.predicates) for p in partitioner.predicate(STATE, SCHEMA, 3)] == [2, 2, 1, 1]
    assert [len(p.predicates) for p in partitioner.alpha(STATE, SCHEMA, 1)] == [2, 2, 1, 1]
    assert partitioner.alpha(STATE, SCHEMA, 2)[1].targets == ("h2:9080", "h1:9080")
    assert 0 <= partitioner.shard_of("name", 7) < 7


def test_uid_ranges():
    base = partitioner.singleton(STATE, SCHEMA)
    assert [p.uids for p in partitioner.uid_range(base, 10000, 2000)] == [(1 + i * 2000, 1 + (i + 1) * 2000) for i in range(5)]
    assert partitioner.uid_range(base, 10000, 10000) == base
    for wrong in ({"size": 0}, {"most": 0}):
        with pytest.raises(ValueError):
            partitioner.uid_range(base, 10000, **wrong)
    with pytest.raises(ValueError):
        partitioner.uid_range(partitioner.uid_range(base, 10000, 2000), 10000)


@settings(deadline=None)
@given(st.integers(2, 10**6), st.integers(1, 5000), st.integers(2, 40), st.floats(0, 1), st.integers(0, 2000))
def test_ranges_cover_once(uids, size, most, part, gap):
    dense = max(1, min(uids, int(uids * part)))
    parts = partitioner.uid_range(partitioner.singleton(STATE, SCHEMA), uids, size, most, lambda p, n: (dense, gap))
    ranges = [p.uids for p in parts]
    if ranges != [None]:
        assert ranges[0][0] == 1 and ranges[-1][1] > uids and len(ranges) <= max(most, 2)
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_plan_by_name():
    for name, n in (("singleton", 1), ("group", 3), ("predicate", 3), ("uid-range", 5), ("group+uid-range", 15), ("alpha+uid-range", 20)):
        options = Options.of({"loomgraph.partitioner": name, "loomgraph.partitioner.uidrange.uidsperpartition": 2000})
        assert len(partitioner.plan(STATE, SCHEMA, options)) == n
    with pytest.raises(ValueError):
        partitioner.plan(STATE, SCHEMA, Options.of({"loomgraph.partitioner": "other"}))


def test_options():
    assert Options.of({"path": "a", "paths": '["b", "c"]'}).targets == ["b", "c", "a"]
    with pytest.raises(ValueError):
        Options().targets
    with pytest.raises(ValueError):
        Options.of({"loomgraph.chunkSize": 0}).number("loomgraph.chunkSize")
    with pytest.raises(ValueError):
        Options.of({"loomgraph.nodes.mode": "other"}).choice("loomgraph.nodes.mode", "typed", "wide")


def _search(left, right, target, middle, up):
    steps = []
    while (at := middle(left, right)) is not None:
        if steps and at == steps[-1]:
            break
        steps.append(at)
        if at >= target if up else at > target:
            right = at
        else:
            left = at
    return left, right, steps


def test_log_middle():
    assert _search(0, 1000000, 3, density.log_middle, False)[2][:2] == [1023, 31]
    assert density.log_middle(0, 20) == 3 and density.log_middle(10, 20) is None or density.log_middle(10, 20) == 15
    assert density.log_middle(8, 9) is None
    assert density.binary_middle(0, 10, 10) is None and density.binary_middle(0, 20, 10) == 10


def test_density():
    assert not density.is_sparse([1, 2]) and not density.is_sparse([1, 2, 3, 4])
    far = [1, 1 << 40, 2 << 40, 3 << 40]
    assert density.is_sparse(far) and not density.is_sparse([*far, (3 << 40) + 1, (3 << 40) + 2])
    assert density.upper_median([1, 2, 3, 4]) == 3
    estimate = density.GapEstimate().update([4, 4]).update([8])
    assert estimate.value == 6 and estimate.update([]) == estimate
    held = [*range(1, 5001), *[5000 + (1 << 40) * i for i in range(1, 200)]]
    end, gap = density.dense_end(lambda u, k: [x for x in held if x >= u][:k], 100, held[-1], 10)
    assert 5000 < end <= 16384 * 4 and gap == pytest.approx(1 << 40, rel=0.01)


def test_small_functions():
    assert [to_signed(u) for u in (0, (1 << 64) - 1, -5)] == [0, -1, -5] and to_unsigned(-1) == (1 << 64) - 1
    with pytest.raises(ValueError):
        to_signed(1 << 64)
    assert escaped_name("a_b.c") == "a__b_c"
    assert abbreviated("abcdefghij", 5) == "ab…ij" and abbreviated("abc", 5) == "abc"
    assert [rotated_left([1, 2, 3], i) for i in (0, 1, 3, 4, -1, -4)] == [[1, 2, 3], [2, 3, 1], [1, 2, 3], [2, 3, 1], [3, 1, 2], [3, 1, 2]]
    assert rotated_left([], 3) == []
    with pytest.raises(ValueError):
        Predicate("x", "other")
