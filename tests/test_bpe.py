import random
import re
import sys
from collections import Counter

import numpy as np
import pytest

from tokenloom.functions.registered import register_text_functions
from tokenloom.functions.text import PIECE_PATTERN
from tokenloom.operators import bpe

TEXTS = [
    "low lower lowest low low", "newer wider newest", "aaaa aaa aa aaaaa", "été été 😀😀 x y", "", "  \n\n tab\t",
    "it's they're 12 123 1234 !!! !!?", "abcabcabcabc bcabca",
]


def pieces(text):
    pattern = PIECE_PATTERN.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    return [m.group(0) for m in re.finditer(pattern, text, re.ASCII if text.isascii() else 0)]


def merge(parts, pair):
    out, i = [], 0
    while i < len(parts):
        if tuple(parts[i : i + 2]) == pair:
            out.append(parts[i] + parts[i + 1])
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


def plain_training(words, n):
    words, merges = {w: [bytes([b]) for b in w.encode()] for w in words}, []
    freq = Counter(p for t in TEXTS for p in pieces(t))
    while len(merges) < n:
        pairs = Counter()
        for w, parts in words.items():
            for pair in zip(parts, parts[1:]):
                pairs[pair] += freq[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p[0].hex(), p[1].hex()))
        merges.append(best)
        words = {w: merge(parts, best) for w, parts in words.items()}
    return merges, words


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize("n", [3, 25, 500])
def test_merges_and_ids_equal_a_plain_loop(spark, corpus, n):
    distinct = {p for t in TEXTS for p in pieces(t)}
    expected, words = plain_training(distinct, n)
    merges = bpe.train_bpe(corpus, n)
    got = [(bytes.fromhex(r["left"]), bytes.fromhex(r["right"])) for r in merges.orderBy("rank").collect()]
    assert got == expected
    symbols = {s: i for i, s in reversed(list(enumerate(bpe._symbols(expected))))}
    encoded = bpe.encode_bpe(corpus, merges)
    for row in bpe.decode_bpe(encoded, merges).collect():
        assert row["ids"] == [symbols[s] for p in pieces(row["text"]) for s in words[p]]
        assert row["decoded"] == row["text"]


@pytest.mark.parametrize("sample", [2, 40, 10_000])
def test_poor_guesses_cost_passes_but_change_nothing(spark, monkeypatch, sample):
    rng = random.Random(sample)
    texts = [" ".join("".join(rng.choice("aabcd") for _ in range(rng.randint(1, 9))) for _ in range(40)) for _ in range(30)]
    monkeypatch.setattr(sys.modules[__name__], "TEXTS", texts)
    monkeypatch.setattr(bpe, "LEADERS", 8)  # many ties at the edge of what the driver sees
    monkeypatch.setattr(bpe, "PLAN", 12)
    monkeypatch.setattr(bpe, "CUT_EVERY", 10)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    got = bpe.train_bpe(df, 60, sample=sample).orderBy("rank").collect()
    expected, _ = plain_training({p for t in texts for p in pieces(t)}, 60)
    assert [(bytes.fromhex(r["left"]), bytes.fromhex(r["right"])) for r in got] == expected


def test_a_merge_reads_the_holders_of_its_pair_only():
    words = [[1, 2, 3], [2, 3, 2, 3], [4, 5], [1, 1, 1]]
    index = bpe.PairIndex(np.concatenate(words), np.array([len(w) for w in words]), np.array([5, 2, 9, 1]))
    read = []
    plain = index.symbols
    index.symbols = lambda i: read.append(i) or plain(i)
    delta = index.merge(2, 3, 6)
    assert sorted(read) == [0, 1]
    assert {(k >> 32, k & 0xFFFFFFFF): n for k, n in delta.items()} == {
        (1, 2): -5, (2, 3): -9, (1, 6): 5, (3, 2): -2, (6, 6): 2}
    read.clear()
    index.merge(1, 6, 7)  # a pair that the first merge made
    assert read == [0] and index.symbols(0) == [7]
    index.merge(1, 1, 8)
    assert index.symbols(3) == [8, 1] and index.weights[1 << 32 | 1] == 0 and index.weights[4 << 32 | 5] == 9


def test_no_text_no_merges(spark):
    empty = spark.createDataFrame([(0, ""), (1, "")], "doc_id bigint, text string")
    assert bpe.train_bpe(empty, 5).count() == 0 and bpe.train_bpe(empty.limit(0), 5).count() == 0


def test_published_byte_order():
    assert bpe.BYTE_ORDER[:3] == [33, 34, 35] and sorted(bpe.BYTE_ORDER) == list(range(256))
    assert bpe.BYTE_ORDER[188:190] == [0, 1] and bpe.BYTE_ORDER[-1] == 173


def test_sql_functions(spark, corpus):
    merges = bpe.train_bpe(corpus, 10)
    register_text_functions(spark, merges)
    row = spark.sql(
        "SELECT char_tokenize('') e, word_tokenize('a, b') w, piece_tokenize(\"it's\") p, "
        "wer('a c', 'a b c d') r, bpe_encode('low') b"
    ).first()
    assert (row["e"], row["w"], row["p"], row["r"]) == ([], ["a", ",", "b"], ["it", "'s"], 0.5)
    one = spark.createDataFrame([(0, "low")], "doc_id int, text string")
    assert row["b"] == bpe.encode_bpe(one, merges).first()["ids"]


def test_many_pieces_are_merged_at_a_time_as_one_by_one():
    rng = random.Random(5)
    words = [[rng.randint(1, 3) for _ in range(rng.randint(1, 9))] for _ in range(200)]
    freq = np.array([rng.randint(1, 9) for _ in words])
    flat, sizes = np.concatenate(words), np.array([len(w) for w in words])
    index, pieces = bpe.PairIndex(flat, sizes, freq), bpe.Pieces(flat, sizes)
    for m in [(1, 1, 4), (2, 3, 5), (4, 4, 6), (5, 1, 7), (3, 9, 8)]:
        assert dict(zip(*(x.tolist() for x in pieces.change(m, freq)))) == index.merge(*m)
        assert pieces.flat.tolist() == [s for i in range(len(words)) for s in index.symbols(i)]


def test_merges_that_make_the_start_of_an_earlier_one():
    rules = [tuple(map(str.encode, r.split())) for r in ("b c", "a bc", "abc d", "a b", "ab c", "c c", "abc c", "a a", "aa aa", "b c")]
    rng = random.Random(6)
    pieces = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 10))).encode() for _ in range(500)] + [b"", b"aaaaa"]
    one = bpe._piece_encoder(rules)
    flat, sizes = bpe._pieces_encoder(rules)(pieces)
    assert [p.tolist() for p in np.split(flat, np.cumsum(sizes)[:-1])] == [one(p) for p in pieces]
