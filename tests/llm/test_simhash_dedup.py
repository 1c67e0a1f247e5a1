import numpy as np
import pytest
import xxhash

from llm_cases import awkward, empty, prose
from loomgraph.llm import simhash_dedup as s


def fingerprint(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, groups=None):
    """The smallest index reachable from each, over steps of at most three bits within a group."""
    fps = np.array(fps, np.uint64)
    groups = np.zeros(len(fps)) if groups is None else np.array(groups)
    near = (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3) & (groups[:, None] == groups[None, :])
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(1)
        if (new == label).all():
            return label
        label = new


def canonical(labels):
    _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
    return first[inverse]


def near_set(rng, centres, each):
    base = rng.integers(0, 2**63, centres).astype(np.uint64)
    flips = [base[rng.integers(0, centres, each)] ^ (np.uint64(1) << rng.integers(0, 64, each).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, each).astype(np.uint64)) for _ in range(3)]
    return np.unique(np.concatenate([base, *flips]))


@pytest.mark.parametrize("groups", [1, 3, 50, 400])
def test_tree_links_equal_brute_force(groups):
    rng = np.random.default_rng(groups)
    fps = near_set(rng, 200, 300)
    g = rng.integers(0, groups, len(fps))
    assert (canonical(s.GrayTree(g, fps).link()) == canonical(linked(fps, g))).all()


def test_tree_of_few():
    assert s.GrayTree(np.zeros(0, np.int64), np.zeros(0, np.uint64)).link().tolist() == []
    assert s.GrayTree(np.zeros(1, np.int64), np.array([5], np.uint64)).link().tolist() == [0]
    chain = np.array([0, 0b111, 0b111111, 0b1111111111], np.uint64)  # the last is four bits away
    assert canonical(s.GrayTree(np.zeros(4, np.int64), chain).link()).tolist() == [0, 0, 0, 3]


def test_gray_rank():
    codes = np.arange(64, dtype=np.uint64)
    codes ^= codes >> np.uint64(1)
    assert s.gray_rank(codes).tolist() == list(range(64))


def test_fingerprints():
    texts = [None, "", "one", "Two words", "a B c", prose(1, 100), "É é A a", "a\x1cb c\x85d e", " \n"]
    assert s.fingerprints(texts).tolist() == [fingerprint(t) for t in texts]


def expected_rows(rows):
    fps = [fingerprint(t) for _, t in rows]
    label = linked(fps)
    best = {c: min((i for (i, _), x in zip(rows, label, strict=True) if x == c and i is not None), default=None) for c in set(label)}
    return sorted(((i, f"{f:016x}", best[c]) for (i, _), f, c in zip(rows, fps, label, strict=True)), key=str)


@pytest.mark.parametrize("full", [20_000, 3])
def test_tables(spark, full):
    """The smaller bound splits slots again and again."""
    near = [(100 + i, prose(50, 400) + f" tail{i}") for i in range(12)] + [(200 + i, prose(60 + i, 60)) for i in range(30)] + [(300, prose(50, 400))]
    df, rows = awkward(spark, near)
    assert sorted(map(tuple, s.groups(df, full=full).collect()), key=str) == expected_rows(rows)
    assert s.groups(empty(spark)).count() == 0


def test_on_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, s.groups(df).collect()), key=str) == expected_rows(rows)


def test_keep_one(spark):
    df, rows = awkward(spark)
    df = df.selectExpr("*", "'x' AS kept_id", "'x' AS row", "'x' AS `with.dot`")
    kept = s.keep_one(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    expected = {r[0] for r in expected_rows(rows) if r[0] is not None and r[0] == r[2]}
    found = [r.doc_id for r in kept.collect()]
    assert {i for i in found if i is not None} == expected and found.count(6) == 2 and 7 not in found


def test_ids_that_are_text(spark):
    rows = [("b", prose(1, 60)), ("a", prose(1, 60)), (None, prose(1, 60)), ("c", prose(2, 60)), ("d", "x" * 1_000_000)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert {(r.doc_id, r.component_id) for r in s.groups(df).collect()} == {("a", "a"), ("b", "a"), (None, "a"), ("c", "c"), ("d", "d")}
    assert sorted(r.doc_id for r in s.keep_one(df).collect()) == ["a", "c", "d"]
