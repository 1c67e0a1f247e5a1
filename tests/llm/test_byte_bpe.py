import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import awkward, empty
from loomgraph.llm import byte_bpe as b

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return b.Encoder(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def truth(encoder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


ODD = [
    "", "a" * 3000 + "  \n x", "x  y\x1c!!\x1cz", "'s 't don't  we'll\n\n\n  foo   ", "　 　a", "日本語テキスト" * 50, "0" * 500, "-" * 2001, " " * 700, "abab" * 300, "the" * 200,
    "the the the" * 50, "<|endoftext|>", "🙂" * 40, "aA" * 33,
]


def test_odd_texts(encoder, truth):
    got = encoder.encode(ODD)
    assert [ids(g) for g in got] == [truth.encode_ordinary(t) for t in ODD]
    assert b.decode(got, PATH) == [t.encode() for t in ODD]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet=st.sampled_from("abcetho ns'\n.,0é日 \t ABC!"), max_size=120), max_size=5))
def test_random_texts(encoder, truth, texts):
    got = encoder.encode(texts)
    assert [ids(g) for g in got] == [truth.encode_ordinary(t) for t in texts]
    assert b.decode(got, PATH) == [t.encode() for t in texts]


def test_all_ways_of_contracting_agree(truth, monkeypatch):
    words = [w.encode() for w in ("international", "unbelievably", "aaaaaaaabaaaa", "thethethe", "Straßenbahnhaltestelle", "xyzzyzzyxx", "0" * 37)]
    expected = [truth._encode_single_piece(w) for w in words]
    _, con, single, width = b._vocabulary(PATH)
    ((some, sizes, ids),) = b._words(words, con, single)
    assert some == words and [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expected
    for rows in (b.QUERY_ROWS, 60):  # a query of all steps, and of four
        monkeypatch.setattr(b, "QUERY_ROWS", rows)
        assert [b._run(w, con, single).tolist() for w in words] == expected
    for short, window, margin in ((1, 5, 1), (3, 200, 1), (7, 0, 2)):
        for name, value in (("SHORT", short), ("WINDOW", window), ("MARGIN", margin)):
            monkeypatch.setattr(b, name, value)
        sizes, ids = b._stitched(words, con, single, width)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expected


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet=st.sampled_from("abcethon0é日="), min_size=41, max_size=400), min_size=1, max_size=4))
def test_long_pieces_are_stitched_exactly(truth, pieces):
    _, con, single, width = b._vocabulary(PATH)
    raw = [p.encode() for p in pieces]
    sizes, ids = b._stitched(raw, con, single, width)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [truth._encode_single_piece(p) for p in raw]


def test_a_megabyte_without_spaces(truth, tmp_path, monkeypatch):
    """Each in at most 30 CPU seconds, and without a file written."""
    monkeypatch.chdir(tmp_path)
    r, n = random.Random(1), 1_000_000
    texts = [
        "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=n)), base64.b64encode(r.randbytes(3 * n // 4)).decode(), "".join(r.choices("0123456789", k=n)),
        "".join(map(chr, r.choices(range(0x4E00, 0x9000), k=n // 3))), "a" * n, "abc" * (n // 3), "=-" * (n // 2), "\u3000" + "的一是不了" * (n // 15),
    ]
    encoder = b.Encoder(PATH, P.PATTERN)
    for text in texts:
        began = time.thread_time()
        (got,) = encoder.encode([text])
        assert time.thread_time() - began < 30
        assert ids(got) == truth.encode_ordinary(text) and b.decode([got], PATH) == [text.encode()]
    assert not list(tmp_path.iterdir())


def test_streams_out_of_order_are_sorted(encoder, truth, monkeypatch):
    words = [w.encode() for w in ("international", "unbelievably", "thethethe", "xyzzyzzyxx")]
    ((some, sizes, ids),) = b.merge_pieces(words, PATH)
    monkeypatch.setattr(b, "_STREAMED", b._STREAMED.replace("FROM start)", "FROM (SELECT * FROM start ORDER BY pos, word))"))
    with pytest.raises(Exception, match=b._DISORDER):
        con = b._vocabulary(PATH)[1]
        con.execute("CREATE OR REPLACE TEMP TABLE start AS SELECT * FROM (VALUES (0, 0, 64), (1, 0, 65), (0, 1, 66)) t(word, pos, token)")
        try:
            con.sql(b._STREAMED + b._DONE).fetchall()
        finally:
            con.execute("DROP TABLE temp.start")
    ((again, sizes_again, ids_again),) = b.merge_pieces(words, PATH)
    assert some == again and sizes.tolist() == sizes_again.tolist() and ids.tolist() == ids_again.tolist()


def test_tables(spark, truth):
    df, rows = awkward(spark)
    found = sorted(map(tuple, b.digest(df, PATH, P.PATTERN).collect()), key=str)
    expected = []
    for i, t in rows:
        own = truth.encode_ordinary(t or "")
        raw = np.array(own, "<u4").tobytes()
        expected.append((i, len(own), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert found == sorted(expected, key=str)
    arrays = {r.doc_id: r.ids for r in b.encode(df, PATH, P.PATTERN).collect()}
    assert arrays[5] == truth.encode_ordinary("Two Words") and arrays[1] == []
    assert b.digest(empty(spark), PATH, P.PATTERN).count() == 0
