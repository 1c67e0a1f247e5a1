import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_cases import awkward, empty
from loomgraph.llm import packing as k

PATH = P.path("word_bpe_49k.json")
ODD = [
    "", "a" * 3000 + "  \n x", "x  y\x1c!!\x1cz É é İ  ΑΣ Σ", "'s 't don't  we'll\n\n\n  foo   ", "　 　a\x85b", "日本語テキスト" * 50, "0" * 500,
    "<|endoftext|> a <|startoftext|>b x<|endoftext|>", "́ é ́x x́, é, Å K", " " * 700, "The, THE!! the;.,\n9.9 a.. a.b.c, -, !!! ...x",
    "don't. IT'S: 'T, 't. a'LL!", "Straße STRASSE Ñandú ÿ Ÿ ß", None,
]


@pytest.fixture(scope="module")
def truth():
    return Tokenizer.from_file(PATH)


def ids(truth, text):
    return truth.encode(text or "", add_special_tokens=False).ids


def test_words_as_whole_texts(truth):
    w = k.WordTokenizer(PATH)
    assert w.direct
    for _ in range(2):
        assert [x.tolist() for x in w.encode(pa.array(ODD, pa.string()))] == [ids(truth, t) for t in ODD]
    w.direct = False
    w.forget()
    assert [x.tolist() for x in w.encode(pa.array(ODD, pa.string()))] == [ids(truth, t) for t in ODD]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet=st.sampled_from("aBcÉéñ'st.,!?0 \n\t-́ ßİ"), max_size=80), max_size=4))
def test_random_texts(truth, texts):
    w = k.WordTokenizer(PATH)
    assert [x.tolist() for x in w.encode(pa.array(texts, pa.string()))] == [ids(truth, t) for t in texts]


@settings(deadline=None, max_examples=100)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 30), max_size=40))
def test_plan_places_each_piece_once(counts):
    rows = k.plan(counts, 64)
    ranks, fill = defaultdict(list), defaultdict(list)
    for length, first, many, sequence, offset in rows:
        for i in range(many):
            ranks[length].append(first + i)
            fill[sequence + i].append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(fill) == list(range(len(fill)))


def test_plan_fills_gaps_exactly():
    assert k.plan({60: 1, 4: 1, 30: 1}, 64)[:2] == [(60, 0, 1, 0, 0), (4, 0, 1, 0, 60)]
    for counts in ({40: 5, 14: 5, 10: 5}, {40: 3, 10: 3, 8: 3, 6: 3}, {20: 9, 4: 3}):
        total = sum(a * b for a, b in counts.items())
        assert max(r[3] + r[2] for r in k.plan(counts, 64)) == -(-total // 64)
    spread = {n: 40 for n in range(100, 1500, 7)}
    total = sum(a * b for a, b in spread.items())
    assert max(r[3] + r[2] for r in k.plan(spread, 4096)) <= 1.005 * total / 4096 + 1


def check(truth, rows, found, capacity):
    pieces = Counter()
    for i, t in rows:
        own = [*ids(truth, t), 1]
        for n, at in enumerate(range(0, len(own), capacity)):
            raw = np.array(own[at : at + capacity], "<u4").tobytes()
            pieces[(i, n, at, len(raw) // 4, zlib.crc32(raw))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces
    fill = defaultdict(list)
    for r in found:
        fill[r.sequence_id].append((r.offset, r.length))
    for own in fill.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:j]) for j in range(len(own))]
        assert sum(n for _, n in own) <= capacity
    return len(fill)


def test_tables(spark, truth):
    df, rows = awkward(spark)
    many = k.digest(df.repartition(5), PATH, 1, 512).collect()
    n = check(truth, rows, many, 512)
    total = sum(len(ids(truth, t)) + 1 for _, t in rows)
    assert n <= -(-total // 512) + 2
    check(truth, rows, k.digest(df, PATH).collect(), 4096)
    packed = k.pack(df, PATH).where("doc_id = 5").first()
    assert np.frombuffer(packed.ids, "<u4").tolist() == [*ids(truth, "Two Words"), 1]
    assert k.digest(empty(spark), PATH).count() == 0


def test_triples_of_scarce_lengths():
    # 12 + 12 + 6 comes first and needs a second 12
    assert sorted(k.ComplementIndex({12: 1, 9: 2, 6: 1}, 30).exact(30, Counter())) == [9, 9, 12]


@settings(deadline=None, max_examples=300)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 3), max_size=9), st.lists(st.integers(1, 24), max_size=3), st.integers(1, 40))
def test_every_exact_combination_is_found(counts, taken, gap):
    index = k.ComplementIndex(counts, 40)
    used = Counter()
    for n in taken:  # some lengths are used up, and some are in the sequence that is being filled
        if index.left.get(n, 0) > 1:
            index.take(n, index.left[n] - 1)
        elif index.left.get(n, 0):
            index.take(n, 1)
    for n in taken[:1]:
        if index.left.get(n, 0):
            used[n] += 1
    left = Counter({n: c for n, c in index.left.items() if c}) - used
    possible = {c for size in (1, 2, 3) for c in combinations_with_replacement(sorted(left), size) if sum(c) == gap and not Counter(c) - left}
    found = index.exact(gap, used)
    assert bool(found) == bool(possible) and (not found or tuple(sorted(found)) in possible)
    pairs = Counter(a + b for a, b in combinations_with_replacement(sorted(n for n, c in index.left.items() if c), 2) if a + b <= 40)
    assert {s: int(n) for s, n in enumerate(index.pairs) if n} == dict(pairs)


def test_a_megabyte(spark, truth):
    rows = [(1, "word " * 200_000), (2, "x" * 200_000), (3, "日本" * 100_000)]
    check(truth, rows, k.digest(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect(), 4096)
