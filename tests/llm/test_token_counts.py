import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from llm_cases import awkward, empty
from loomgraph.llm import token_counts as c

PATH, END = P.path("word_bpe_49k.json"), 49407


def test_texts(spark):
    truth = Tokenizer.from_file(PATH)
    truth.encode_special_tokens = True
    df, rows = awkward(spark, [(30, "a <|endoftext|> b"), (31, "<|endoftext|>")])
    found = c.count(df.repartition(3), PATH, END).collect()
    expected = sorted(((i, len(truth.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=str) == expected
    assert c.count(empty(spark), PATH, END).count() == 0


def brute(ids):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == END:
            out.append((len(out), start, i - start, True))
            start = i + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("range_bytes,group", [(2, 2), (7, 3), (64, 4), (1 << 20, 1024)])
@pytest.mark.parametrize("width", [2, 4])
def test_ranges_need_not_align(spark, tmp_path, range_bytes, group, width):
    rng = np.random.default_rng(range_bytes * width)
    files = {
        "mixed": [*rng.integers(0, 100, 50), END, END, *rng.integers(0, 100, 3), END, *rng.integers(0, 100, 90), END], "open": [1, 2, END, 3, 4, 5], "none": [7] * 100,
        "only": [END] * 20, "empty": [], "first": [END, 1],
    }
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, f"<u{width}").tobytes())
    listing = spark.createDataFrame([(n, len(i) * width) for n, i in files.items()], "file string, bytes long")
    found = c.scan(listing, str(tmp_path), END, width, max(range_bytes, width), group).collect()
    expected = sorted((n, *d) for n, ids in files.items() for d in brute(ids))
    assert sorted((r.file, r.nth, r.start, r.n_tokens, r.closed) for r in found) == expected
    assert sorted((r.file, r.bytes) for r in c.list_files(listing, str(tmp_path)).collect()) == sorted((r.file, r.bytes) for r in listing.collect())


def test_ids_must_fit(spark):
    import pytest

    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="1 bytes"):
        c.write_files(df, PATH, 1, width=1)
    with pytest.raises(ValueError, match="2 bytes"):
        c.write_files(df, PATH, 70_000)
