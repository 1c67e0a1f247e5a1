import math
import re
from collections import Counter

import pytest
import xxhash

from llm_cases import awkward, empty, prose
from loomgraph.llm import quality_rules as q


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def counts(text):
    w = words_of(text)
    text = text or ""
    lines = [x for x in text.split("\n") if words_of(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words_of(text)]
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:], strict=False)]
    return [signed(x) % q.BUCKETS for x in [*h, *pairs]]


def scores(rows, trusted):
    all_counts, own = Counter(), Counter()
    for i, t in rows:
        all_counts.update(grams(t))
        if i in trusted:
            own.update(grams(t))
    n, t = sum(all_counts.values()) + q.BUCKETS, sum(own.values()) + q.BUCKETS
    weight = [math.log((own[b] + 1) / t) - math.log((all_counts[b] + 1) / n) for b in range(q.BUCKETS)]
    return [sum(weight[b] for b in grams(text)) / len(grams(text)) if words_of(text) else None for _, text in rows]


def check(found, rows, trusted):
    expected = []
    for (i, t), score in zip(rows, scores(rows, trusted), strict=True):
        c = counts(t)
        expected.append((i, *c, not c[-1] and score >= q.THRESHOLD, score))
    key = lambda r: (str(r[0]), r[1:6], round(r[8], 5) if r[8] is not None else 0)
    found, expected = sorted(found, key=key), sorted(expected, key=key)
    assert [r[:8] for r in found] == [r[:8] for r in expected]
    for a, b in zip(found, expected, strict=True):
        assert a[8] == pytest.approx(b[8], abs=2e-6) if b[8] is not None else a[8] is None


def test_awkward_tables(spark):
    junk = [(30, " | ".join(["zq", "qz"] * 100)), (31, "a b c a b c d"), (32, "a a a a"), (33, "##x|y\n\n \nz\nz\n z"), (34, prose(6, 60).replace(" ", " & "))]
    df, rows = awkward(spark, junk)
    trusted = spark.createDataFrame([(6,), (12,), (12,), (None,), (77,)], "id long")
    check([tuple(r) for r in q.digest(df, trusted).collect()], rows, {6, 12})
    assert q.digest(empty(spark), trusted).count() == 0
    check([tuple(r) for r in q.digest(df, trusted.limit(0)).collect()], rows, set())


def test_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and toxic = 0").selectExpr("doc_id as id")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    check([tuple(r) for r in q.digest(df, labels).collect()], rows, {r.id for r in labels.collect()})


def test_good_documents_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = q.digest(spark.read.parquet(f"{folder}/documents.parquet"), labels.where("quality = 1 and toxic = 0").selectExpr("doc_id as id"))
    rows = found.join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_no_python_in_the_plan(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id as id")
    plan = q.digest(df, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_sample_is_the_smallest_hashes(spark):
    ids = spark.range(0, 20_000, 1, 16).unionAll(spark.range(10)).selectExpr("id")
    found = {r.trusted_id for r in q.sample(ids, 700).collect()}
    order = sorted(range(20_000), key=lambda i: signed(xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42)))
    assert found == set(order[:700])
    assert q.sample(ids, 50_000).count() == 20_000 and q.sample(ids.limit(0), 5).count() == 0
    plan = q.sample(ids, 700)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan


def test_rows_that_stay_are_unchanged(spark):
    df, rows = awkward(spark)
    odd = df.selectExpr("*", "'b' AS row", "'c' AS id", "'d' AS `with.dot`", "'e' AS trusted_id")
    trusted = spark.createDataFrame([(6,)], "id long")
    found = q.keep(odd, trusted)
    assert found.columns == odd.columns and found.dtypes == odd.dtypes
    kept = Counter(r.doc_id for r in q.digest(df, trusted).where("kept").collect())
    assert Counter(r.doc_id for r in found.collect()) == kept and kept and all((r.judged, r["with.dot"], r.id) == ("clash", "d", "c") for r in found.collect())


def test_long_texts(spark):
    rows = [(1, prose(1, 100_000)), (2, "x" * 1_000_000), (3, "y " * 60_000)]
    found = {r.doc_id: r for r in q.digest(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1,)], "id long")).collect()}
    for i, t in rows:
        assert tuple(found[i][:7]) == (i, *counts(t))
