import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import awkward, empty, prose
from loomgraph.llm import substring_dedup as s


def words_of(text):
    return (text or "").encode().lower().split()


def shared_words(rows):
    """For each id the words in runs of 50 that another text also has."""
    runs = defaultdict(set)
    texts = {}
    for i, t in rows:
        if i is not None:
            texts[i] = words_of(t)
    for i, w in texts.items():
        for k in range(len(w) - s.PASSAGE + 1):
            runs[tuple(w[k : k + s.PASSAGE])].add((i, k))
    out = defaultdict(set)
    for places in runs.values():
        if len({i for i, _ in places}) > 1:
            for i, k in places:
                out[i].update(range(k, k + s.PASSAGE))
    return out, texts


def covered(found):
    out = defaultdict(set)
    for r in found:
        out[r.doc_id].update(range(r.start_word, r.end_word))
    return out


def test_compact_windows_are_the_wide_nodes_of_the_tree():
    rng = np.random.default_rng(4)
    counts = np.array([3, 60, 0, 200, 46, 45])
    x = rng.integers(0, 40, int(counts.sum())).astype(np.uint64)
    for order in range(3):
        with np.errstate(over="ignore"):
            rank = s._mix(x + np.uint64(order + 1) * s._ODD) & ~s._PLACE
        expected = set()
        for t, (a, n) in enumerate(zip(np.cumsum(counts) - counts, counts, strict=True)):
            own = rank[a : a + n].tolist()
            for c in range(n):
                lo = c
                while lo and own[lo - 1] > own[c]:
                    lo -= 1
                hi = c
                while hi + 1 < n and own[hi + 1] >= own[c]:
                    hi += 1
                if hi - lo + 1 >= 20:
                    expected.add((t, lo, c, hi))
        assert set(zip(*(a.tolist() for a in s.compact_windows(x, counts, order, 20)), strict=True)) == expected


def test_shingles():
    x, counts = s.shingle_hashes(pa.array(["a b c d e f", None, "", " A  b c\nd E F ", "a b c d"]))
    assert counts.tolist() == [2, 0, 0, 2, 0] and x[:2].tolist() == x[2:].tolist() and x[0] != x[1]


def corpus():
    """Exact passages of many sizes, in few and in very many documents, next to boilerplate and unrelated text."""
    r = random.Random(5)
    common, boiler = prose(900, 70), prose(901, 30)
    rows = [(i, f"{prose(i, r.randrange(20, 150))}\n{common}\n{prose(5000 + i, r.randrange(20, 150))}") for i in range(100, 160)]
    rows += [(i, f"{prose(i, 80)} {boiler} {prose(5000 + i, 80)}") for i in range(200, 240)]
    for n, length in enumerate((50, 51, 55, 60, 100, 49, 40)):
        passage = prose(800 + n, length)
        rows += [(300 + 10 * n + k, f"{prose(2000 + 10 * n + k, 60)} {boiler} {passage} {prose(3000 + 10 * n + k, 60)}") for k in range(3)]
    rows += [(500 + k, prose(77, 200)) for k in range(4)]
    rows += [(600, "and " * 300), (601, "and " * 280 + prose(1, 60)), (602, "x y " * 200)]
    return rows


def test_every_exact_repeat_is_found(spark):
    df, rows = awkward(spark, corpus())
    found = s.passages(df).collect()
    exact, texts = shared_words(rows)
    ours = covered(found)
    for i, places in exact.items():
        assert places <= ours[i], i
    clean = [i for i in texts if i not in exact]
    assert clean and not any(ours[i] for i in clean)
    assert sum(len(ours[i] - exact[i]) for i in ours) <= 0.05 * sum(map(len, ours.values()))
    classes = defaultdict(set)
    for r in found:
        classes[r.class_id].add(r.doc_id)
    assert set(range(500, 504)) in classes.values() and classes[100] >= set(range(100, 160)) and all(k == min(v) for k, v in classes.items())
    assert s.passages(empty(spark)).count() == 0


def edited(text, every, r):
    return " ".join("edit" + str(r.randrange(10**6)) if n % every == every - 1 else w for n, w in enumerate(text.split()))


def test_near_repeats(spark):
    r = random.Random(8)
    rows = []
    for n in range(30):
        passage = prose(700 + n, 120)
        rows += [(2 * n, f"{prose(n, 60)} {passage} {prose(4000 + n, 60)}"), (2 * n + 1, f"{prose(100 + n, 60)} {edited(passage, 48, r)} {prose(6000 + n, 60)}")]
    found = {i.doc_id for i in s.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) >= 54
    far = [(i, f"{prose(i, 60)} {edited(prose(99, 120), 8, r)} {prose(900 + i, 60)}") for i in range(10)]
    assert s.passages(spark.createDataFrame(far, "doc_id long, text string")).count() == 0


def test_strip_leaves_one_of_each(spark):
    df, rows = awkward(spark, corpus())
    out = s.strip(df)
    assert out.columns == df.columns and out.count() == len(rows)
    left = [(r.doc_id, r.text) for r in out.collect()]
    again, texts = shared_words(left)
    assert not any(again.values())
    exact, before = shared_words(rows)
    after = dict(left)
    copies = {i for i in before if any(before[j] == before[i] and j < i for j in before)}
    for i, t in rows:
        if i is not None and i not in exact and i not in copies:
            assert after[i] == t
    common = prose(900, 70)
    assert [i for i, t in left if t and common in t] == [100]
    assert after[500] == prose(77, 200) and after[501] == after[503] == ""
    assert s.strip(empty(spark)).count() == 0


def test_words_cut():
    assert s.without_words("a b  c\nd e", [(1, 3)]) == "a d e" and s.without_words("a b", [(0, 2)]) == "" and s.without_words("a b", [(1, 2)]) == "a "


@pytest.mark.parametrize("small", [1, 2, 100])
def test_group_sizes_do_not_matter(spark, small):
    rows = [(i, f"{prose(i, 60)} {prose(900 + i % 3, 70)} {prose(5000 + i, 60)}") for i in range(24)]
    exact, _ = shared_words(rows)
    ours = covered(s.passages(spark.createDataFrame(rows, "doc_id long, text string"), small=small).collect())
    assert all(exact[i] <= ours[i] for i in exact) and len(exact) == 24


def windows(rows):
    """Rows of (minimum, order, crowded, rep, left, right, at, text) as the pairing takes them."""
    out = [(m, (j << s._ORDER) | (c << s._CROWDED) | (rep << s._REP) | (left << s._LEFT) | (right << s._RIGHT) | at, t) for m, j, c, rep, left, right, at, t in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(out), strict=True)], names=["minimum", "packed", "text"])


def paired(batches, small):
    return [tuple(r.values()) for out in s._pairing(small)(batches) for r in out.to_pylist()]


def test_pairs_of_groups():
    r = random.Random(2)
    rows = [(r.randrange(40), 1, 0, 0, r.randrange(46), r.randrange(46), r.randrange(500), r.randrange(12)) for _ in range(200)]
    expected = set()
    for i, p in enumerate(rows):
        for q in rows[:i]:
            if p[0] == q[0] and p[-1] != q[-1]:
                a, b = sorted((p, q), key=lambda w: w[-1])
                low, high = -min(a[4], b[4]), min(a[5], b[5])
                if high - low + 1 >= s.WIDTH - s.DRIFT:
                    expected.add((1, a[-1], b[-1], a[6], b[6], low, high))
    assert set(paired([windows(rows)], 1000)) == expected and expected
    one = windows(rows)
    assert set(paired([one.slice(i, 7) for i in range(0, 200, 7)], 1000)) == expected


def test_crowded_groups(monkeypatch):
    n = 30
    rows = [(7, 0, 0, 0, 45, 45, 50 + t, t) for t in range(n)]
    found = paired([windows(rows)], 4)
    assert {(a, b) for _, a, b, *_ in found if a != b} == {(k - 1, k) for k in range(1, n)} | {(0, k) for k in range(1, n)}
    assert sorted((a, lo, hi) for _, a, b, _, _, lo, hi in found if a == b) == [(t, 5 + t, 50 + t) for t in range(n)]
    # two windows of a group that is marked as crowded, one of them standing for others
    assert [x[:3] for x in paired([windows([(7, 0, 1, 1, 45, 45, 50, 1), (7, 0, 0, 0, 45, 45, 50, 2)])], 4)] == [(0, 1, 2), (0, 2, 2)]
    # a group larger than what is paired at once stays connected
    monkeypatch.setattr(s, "GROUPED", 8)
    whole = windows(rows)
    found = paired([whole.slice(i, 4) for i in range(0, n, 4)], 4)
    assert {(k - 1, k) for k in range(1, n)} <= {(a, b) for _, a, b, *_ in found} and {a for _, a, b, *_ in found if a == b} == set(range(n))


def test_common_minima_get_groups_of_their_own(monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 10)
    chunk = s._Chunk()
    texts = [f"{prose(i, 60)} {prose(900, 70)} {prose(5000 + i, 60)}" for i in range(64)]
    chunk.add(pa.array(texts), np.arange(64))
    rows = pa.Table.from_batches(chunk.rows())
    sizes = np.unique(rows.column("minimum").to_numpy(), return_counts=True)[1]
    assert 9 <= sizes.max() <= 10
    left = pa.Table.from_batches(chunk.rows(), rows.schema)
    assert left.num_rows == 0


def test_periodic_stretches_send_two_windows():
    chunk = s._Chunk()
    chunk.add(pa.array(["x y " * 2000]), np.array([5]))
    rows = pa.Table.from_batches(chunk.rows())
    order = s._bits(rows.column("packed").to_numpy(), s._ORDER, 3)
    assert (order < s.HASHES).sum() <= 4 * s.HASHES  # the stretch's end may have windows of its own
    starts = np.concatenate([np.arange(r[5], r[6] + 1) for r in paired([rows.combine_chunks().to_batches()[0]], 4) if r[1] == r[2]])
    assert len(np.unique(starts)) == 4000 - s.PASSAGE + 1


def test_periodic_repeats_are_found(spark):
    rows = [(1, f"{prose(1, 60)} {'and so ' * 500} {prose(2, 60)}"), (2, f"{prose(3, 70)} {'so and ' * 40}"), (3, prose(4, 200)), (4, "and so " * 26)]
    exact, _ = shared_words(rows)
    ours = covered(s.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert all(exact[i] <= ours[i] for i in exact) and set(exact) == {1, 2, 4} and not ours[3]


def test_orders_miss_few_near_stretches():
    rng = np.random.default_rng(3)
    n, shared = 20_000, s.ENOUGH
    x = rng.integers(0, 1 << 63, (n, 2 * s.WIDTH - shared)).astype(np.uint64)
    agree = []
    for order in range(s.HASHES):
        with np.errstate(over="ignore"):
            rank = s._mix(x + np.uint64(order + 1) * s._ODD)
        agree.append(rank.argmin(1) < shared)
    assert (agree[0] | (np.sum(agree[1:], 0) > 1)).mean() > 0.99


def variant(words, i, k):
    """The words with ``k`` replaced at even distances, by other ones for each i."""
    return [f"w{i}x{n}" if n % (len(words) // k) == (7 * i) % (len(words) // k) else w for n, w in enumerate(words)]


@pytest.mark.parametrize("size", [2, 5, 50, 1000])
def test_near_repeats_in_groups(spark, size):
    """Variants of a passage of 120 words with two words changed each, next to boilerplate that all texts share."""
    boiler, groups = prose(901, 30), max(1, 60 // size)
    rows = []
    for g in range(groups):
        passage = prose(700 + g, 120).split()
        rows += [(g * size + i, f"{prose(20_000 + g * size + i, 30)} {boiler} {prose(40_000 + g * size + i, 30)} {' '.join(variant(passage, i, 2))}") for i in range(size)]
    clean = [(100_000 + i, f"{prose(60_000 + i, 60)} {boiler} {prose(80_000 + i, 60)}") for i in range(200)]
    found = s.passages(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()
    classes = defaultdict(set)
    for r in found:
        classes[r.class_id].add(r.doc_id)
    assert not any(i >= 100_000 for c in classes.values() for i in c)
    # found, and in the class of the group's first
    assert sum(len(classes[g * size] & set(range(g * size, (g + 1) * size))) for g in range(groups)) >= 0.95 * len(rows)


def test_ids_of_other_types(spark):
    rows = [(f"doc-{i:03d}", t) for i, t in corpus()[:20]] + [(None, prose(1, 80))]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    found = s.passages(df).collect()
    exact, _ = shared_words(rows)
    ours = covered(found)
    assert all(exact[i] <= ours[i] for i in exact) and {r.class_id for r in found} == {"doc-100"} and found[0].asDict().keys() == {"doc_id", "start_word", "end_word", "class_id"}
    left = {r.doc_id: r.text for r in s.strip(df).collect()}
    assert len(left) == len(rows) and [i for i, t in left.items() if prose(900, 70) in t] == ["doc-100"]


def test_columns_of_any_name(spark):
    df, rows = awkward(spark)
    odd = df.selectExpr("*", "'a' AS cut_id", "'b' AS cut_all", "'c' AS cut_spans", "'d' AS row", "'e' AS `with.dot`", "'f' AS cut", "'g' AS id")
    out = s.strip(odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    assert all((r["cut_id"], r["with.dot"], r["row"], r["id"]) == ("a", "e", "d", "g") for r in out.collect()) and out.count() == len(rows)


def test_a_megabyte(spark):
    long, passage = prose(1, 150_000), prose(2, 60)
    rows = [(1, f"{long} {passage}"), (2, f"{prose(3, 60)} {passage}"), (3, "x" * 1_000_000), (4, long)]
    ours = covered(s.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert len(ours[1]) == 150_060 and set(range(60, 120)) <= ours[2] and not ours[3] and len(ours[4]) == 150_000


def test_strip_leaves_one_of_near_variants(spark):
    passage = prose(31, 90).split()
    # each variant has a word of its own in the middle, so that no 50 words are the same in two of them
    variants = {i: " ".join([*passage[:44], f"edit{i}", *passage[45:]]) for i in range(1, 21)}
    rows = [(i, f"{prose(100 + i, 60)} {v} {prose(200 + i, 60)}") for i, v in variants.items()]
    assert not shared_words(rows)[0]
    left = {r.doc_id: r.text for r in s.strip(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kept = [i for i, v in variants.items() if len(set(v.split()) & set(left[i].split())) > 80]
    assert kept == [1]


def test_through_cuts_only_what_a_smaller_id_has():
    rows = [(9, 0, 1, 10, 110), (9, 20, 2, 0, 100), (9, 200, 3, 0, 60), (9, 90, 4, 5, 55)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["of", "of_start", "id", "start", "end"])
    found = [(r["id"], r["start"], r["end"]) for out in s._through([batch]) for r in out.to_pylist()]
    assert found == [(2, 0, 80)]


def test_candidates_of_many_shifts():
    shifts = [100 * k for k in range(20)]
    rows = [(j, 1, 2, 5000 + j, 5000 + j - shift, 0, 45) for j in (1, 2) for shift in shifts]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), s._KINDS, strict=True)], names=s._NAMES)
    assert sum(out.num_rows for out in s._candidates([batch])) == len(shifts)


def test_unlike_texts_under_one_id(spark):
    common = prose(900, 70)
    rows = [(1, f"{prose(i, 100)} {common}") for i in range(7)] + [(1, prose(50, 55)), (2, common), (2, "short")]
    found = s.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == {1, 2}


def test_near_repeats_of_common_pieces(spark):
    """Every two pieces of 30 words stand together in one pair of texts, one word apart, so that each shingle but those of
    the junction is in a crowded group, in which most windows are of other pairs."""
    pieces = [prose(910 + i, 30) for i in range(12)]
    both = [f"{p} {q}" for p in pieces for q in pieces if p != q]
    rows = []
    for n, passage in enumerate(both):
        words = passage.split()
        words[30] = f"edit{n}"
        rows += [(2 * n, f"{prose(20_000 + n, 60)} {passage} {prose(40_000 + n, 60)}"), (2 * n + 1, f"{prose(60_000 + n, 60)} {' '.join(words)} {prose(80_000 + n, 60)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = {r.doc_id: r.class_id for r in s.passages(df).collect()}
    assert all(classes[i] in (i, i - i % 2) for i in classes)
    assert sum(classes.get(2 * n + 1) == 2 * n for n in range(len(both))) >= 0.98 * len(both)


def test_strip_of_common_pieces(spark):
    """As above; only the text of the larger id loses the passage."""
    pieces = [prose(910 + i, 30) for i in range(8)]
    both = [f"{p} {q}" for p in pieces for q in pieces if p != q]
    rows = []
    for n, passage in enumerate(both):
        words = passage.split()
        words[30] = f"edit{n}"
        rows += [(2 * n, f"{prose(20_000 + n, 60)} {passage} {prose(40_000 + n, 60)}"), (2 * n + 1, f"{prose(60_000 + n, 60)} {' '.join(words)} {prose(80_000 + n, 60)}")]
    left = {r.doc_id: r.text for r in s.strip(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(left[i] == t for i, t in rows if i % 2 == 0)
    assert sum(f"edit{n}" not in left[2 * n + 1] for n in range(len(both))) >= 0.98 * len(both)


def test_crowded_windows_are_compared_in_all_pairs():
    """All near stretches of a group are covered, and its classes those of all pairs; ids come in any order of likeness."""
    r = np.random.default_rng(6)
    pieces, rows = r.integers(0, 1 << 32, (6, 45), np.uint32), []
    for i in range(80):
        left, right, edit = pieces[2 if i % 2 else r.integers(0, 2)].copy(), pieces[5 if i % 2 else r.integers(3, 5)].copy(), r.integers(0, 86)
        content = np.r_[left, np.uint32(7), right]
        if edit < 45 or edit > 50:
            content[edit : edit + 5] = r.integers(0, 1 << 32, len(content[edit : edit + 5]), np.uint32)
        content[45] = 7
        rows.append(content)
    raw = [c.tobytes() for c in rows]
    crowd = s._Crowd(np.zeros(80, np.int64), np.arange(80), np.full(80, 45), np.zeros(80, np.int64), raw)
    ours, smaller = defaultdict(set), defaultdict(set)
    for i, start, end, of, _ in crowd.links():
        ours[i].update(range(start, end))
        if of < i:
            smaller[i].update(range(start, end))
    root = list(range(80))
    for i in range(80):
        every, less = set(), set()
        for j in range(80):
            for start, end, _ in s.shared_spans(rows[i], rows[j]) if i != j else ():
                every.update(range(start, end + s.SHINGLE - 1))
                if j < i:
                    less.update(range(start, end + s.SHINGLE - 1))
                root = [min(root[i], root[j]) if x in (root[i], root[j]) else x for x in root]
        assert ours[i] == every and smaller[i] == less, i
    assert [crowd.find(i) for i in range(80)] == root and len(set(root)) > 1


def test_pairs_are_verified_at_once(monkeypatch):
    """As :func:`shared_spans` finds them one by one, which is left to very long stretches only."""
    r = np.random.default_rng(9)
    rows, expected = [], set()
    for n in range(150):
        x = r.integers(0, 1 << 32, int(r.integers(0, 160)), np.uint32) if n % 3 else np.tile(r.integers(0, 1 << 32, int(r.integers(1, 30)), np.uint32), 8)
        y = np.r_[r.integers(0, 9, int(r.integers(0, 20)), np.uint32), x[int(r.integers(0, 5)) :]]
        for _ in range(n % 6 if len(y) else 0):
            at = int(r.integers(0, len(y)))
            y = [np.delete(y, at), np.insert(y, at, 5), np.r_[y[:at], y[at + 1 :], y[:60]]][int(r.integers(0, 3))].astype(np.uint32)
            if not len(y):
                break
        expected |= {(n, 7 + a, 7 + b + s.SHINGLE - 1, 1000 + n, 3 + c) for a, b, c in s.shared_spans(x, y)}
        expected |= {(1000 + n, 3 + a, 3 + b + s.SHINGLE - 1, n, 7 + c) for a, b, c in s.shared_spans(y, x)}
        rows += [(n, 1000 + n, 7, 3, k, v.tobytes()) for k, v in enumerate((x, y))]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 3, pa.binary()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["a", "b", "lo_a", "lo_b", "side", "raw"])

    def found(step):
        return {tuple(o.values()) for out in s._verified([whole.slice(i, step) for i in range(0, len(rows), step)]) for o in out.to_pylist()}

    with monkeypatch.context() as m:
        m.setattr(s, "shared_spans", None)
        assert found(300) == found(7) == expected and len(expected) > 100
        m.setattr(s, "SPANNED", 500)
        assert found(300) == expected
    monkeypatch.setattr(s, "_SPOT", 7)
    assert found(300) == expected


def test_long_exact_repeats_are_few_links(spark):
    rows = [(i, f"{prose(i, 60)} {prose(900, 500)} {prose(5000 + i, 60)}") for i in range(12)]
    _, found, _ = s.links(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    assert found.count() <= 40 * len(rows)  # not one a word
    exact, _ = shared_words(rows)
    ours = defaultdict(set)
    for r in found.collect():
        ours[r["id"]].update(range(r["start"], r["end"]))
    assert all(exact[i] <= ours[i] for i in exact)


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_links_that_go_on_are_joined(size):
    r = np.random.default_rng(1)
    rows = sorted({(int(i), int(a), int(a) + 50, int(of), int(a + d)) for i, a, of, d in zip(*(r.integers(0, n, 900) for n in (3, 90, 2, 2)), strict=True)}, key=lambda x: (x[0], x[3], x[1]))
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["id", "start", "end", "of", "of_start"])
    out = [tuple(o.values()) for part in s._joined([whole.slice(i, size) for i in range(0, len(rows), size)]) for o in part.to_pylist()]
    words = lambda links: {(i, start + k, of, to + k) for i, start, end, of, to in links for k in range(end - start - 49)}
    assert words(out) == words(rows) and len(out) < len(rows)


def test_word_hashes():
    r = random.Random(4)
    texts = ["".join(r.choice(["a", "B", "é", "漢", "\0", " ", "\t", "\x0b", "\x1c"]) for _ in range(r.randrange(80))) for _ in range(2000)]
    texts += ["", None, " ", "x" * 8, "x" * 9, "x" * 16, "x" * 17, "x" * 16 + "\0", "X" * 8, "x" * 8 + "\0"]
    for array in (pa.array(texts), pa.array(texts).slice(11), pa.array([None, ""]), pa.array([], pa.string())):
        h, counts = s.word_hashes(array)
        words = [words_of(t) for t in array.to_pylist()]
        assert counts.tolist() == list(map(len, words))
        known = dict(zip((w for own in words for w in own), h.tolist(), strict=True))
        assert [known[w] for own in words for w in own] == h.tolist() and len(set(known.values())) == len(known)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_nearest_smaller_values(monkeypatch, rounds):
    monkeypatch.setattr(s, "ROUNDS", rounds)
    r = np.random.default_rng(2)
    for values in (r.permutation(300), np.r_[np.arange(150), np.arange(150)[::-1] + 0.5]):
        last = r.random(300) < 0.02
        last[0] = True
        ours = s._smaller(values, last, -1).tolist()
        for i in range(300):
            begin = max(k for k in range(i + 1) if last[k])
            assert ours[i] == max((k for k in range(begin, i) if values[k] < values[i]), default=-1)
        assert s._smaller(values[::-1], last[::-1], 1)[::-1].tolist() == [299 - k if k >= 0 else -1 for k in ours]
