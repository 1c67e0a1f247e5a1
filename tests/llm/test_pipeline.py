from collections import Counter

import corpus_pipeline as p
from llm_cases import awkward, prose
from loomgraph.llm import quality_rules, secret_scan, simhash_dedup, substring_dedup
from test_packing import check
from test_substring_dedup import shared_words
from tokenizers import Tokenizer


def test_stages(spark, sf):
    truth = Tokenizer.from_file(__import__("public_tokenizers").path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    start = docs
    for n, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, sf).cache()
        if n < len(p.STAGES) - 1:
            assert out.columns == start.columns and out.dtypes == start.dtypes, name
        if n == 0:
            trusted = p.trusted_ids(spark, sf)
            kept = quality_rules.digest(docs, trusted).where("kept").select("doc_id")
            assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in kept.collect()) and 0 < out.count() < docs.count()
        elif n == 1:
            groups = simhash_dedup.groups(docs).collect()
            assert sorted(r.doc_id for r in out.collect()) == sorted({r.component_id for r in groups})
        elif n == 2:
            assert out.count() == docs.count()
            rows = [(r.doc_id, r.text) for r in out.collect()]
            assert not any(shared_words(rows)[0].values()) and all(r.n_chars == len(r.text) for r in out.collect())
        elif n == 3:
            found = {r.doc_id: r.text for r in out.collect()}
            assert found == {r.doc_id: secret_scan.redacted(r.text) for r in docs.collect()}
        else:
            check(truth, [(r.doc_id, r.text) for r in docs.collect()], out.collect(), 4096)
        docs = out
    assert p.run(spark, sf).count() == docs.count()


def test_awkward_rows(spark, sf):
    df, rows = awkward(spark)
    df = df.selectExpr("*", "'x' AS cut_id", "'x' AS cut_all", "'x' AS cut_spans", "'x' AS kept_id", "'x' AS row", "'x' AS `with.dot`", "'x' AS c0")
    for n, (_, stage) in enumerate(p.STAGES):
        for docs in (df, df.limit(0), df.select("doc_id", "text", "lang", "source", "n_chars")):
            out = stage(spark, docs, sf)
            if n < len(p.STAGES) - 1:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
                assert all(r["cut_id"] == r["row"] == r["with.dot"] == "x" for r in out.collect() if docs is df)
            assert out.count() >= 0
    assert substring_dedup.strip(df).count() == len(rows)
    assert p.passages(spark, df, sf).where("doc_id = 12").first().n_chars == len(dict(rows)[12])


def test_a_megabyte(spark, sf):
    text = prose(1, 120_000)
    docs = spark.createDataFrame([(1, text, "en", "a", len(text)), (2, f"{prose(2, 100)} {prose(3, 100)}", "en", "a", 1), (3, "x" * 1_000_000, "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in p.STAGES[1:-1]:
        assert {r.doc_id: r.text for r in stage(spark, docs, sf).collect()} == {r.doc_id: r.text for r in docs.collect()}, name
