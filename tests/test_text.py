import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import WordLevel
from tokenizers.pre_tokenizers import Whitespace
from tokenizers.trainers import WordLevelTrainer

from tokenloom.functions.text import SPECIALS, char_tokens, piece_tokens, word_tokens
from tokenloom.operators import vocab
from tokenloom.operators.encode import decode_chars, decode_words, encode_chars, encode_words
from tokenloom.sources.corpus import read_corpus, read_pairs
from tokenloom.sources.vocab_store import load_or_build_vocab, load_vocab

TEXTS = [
    "", "a", "!?", "Hello, world! it's 3.5", "été Ünï 中文字", "smile 😀 x²½ a_b", "[PAD]", "!![PAD] [UNK]x[SOS]",
    "a a a b b hello hello", "nb sp em\x0bvt\x85nel", "  two  spaces \n\n and\ttabs ", "zz qq",
]


def frame(spark, texts, parts=3):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)


def library(texts):
    tokenizer = Tokenizer(WordLevel(unk_token="[UNK]"))
    tokenizer.pre_tokenizer = Whitespace()
    tokenizer.train_from_iterator(texts, WordLevelTrainer(special_tokens=SPECIALS, min_frequency=2))
    return tokenizer


def test_tokens_of_edge_texts(spark):
    rows = frame(spark, TEXTS).select(
        "text", char_tokens(F.col("text")).alias("c"), word_tokens(F.col("text")).alias("w"), piece_tokens(F.col("text")).alias("p")
    ).collect()
    for row in rows:
        assert row["c"] == list(row["text"])
        assert "".join(row["p"]) == row["text"]
        assert row["w"] == [w for w, _ in Whitespace().pre_tokenize_str(row["text"])]


def test_word_split_of_every_common_character(spark):
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}" for c in points]
    known = frame(spark, texts).filter(~F.col("text").rlike(r"\p{Cn}"))  # by the JVM's Unicode table
    rows = known.select("text", word_tokens(F.col("text")).alias("w")).collect()
    assert len(rows) > 11_000
    odd = [r["text"] for r in rows if r["w"] != [w for w, _ in Whitespace().pre_tokenize_str(r["text"])]]
    assert not odd, odd[:20]


def test_char_round_trip_and_policies(spark):
    docs = frame(spark, TEXTS)
    chars = vocab.char_vocab(docs)
    assert [r["token"] for r in chars.orderBy("id").collect()] == sorted(set("".join(TEXTS)))
    back = decode_chars(encode_chars(docs, chars), chars)
    assert back.filter("decoded <> text").count() == 0
    other = frame(spark, ["ab~Жa"])
    assert encode_chars(other, chars, unk_policy="drop").first()["ids"] == encode_chars(frame(spark, ["aba"]), chars).first()["ids"]
    assert encode_chars(other, chars, unk_policy=77).first()["ids"][2:4] == [77, 77]
    with pytest.raises(Exception, match="not in the vocabulary"):
        encode_chars(other, chars).collect()


def test_words_as_the_library_gives_them(spark):
    docs = frame(spark, TEXTS)
    tokenizer = library(TEXTS)
    words = vocab.word_vocab(docs)
    assert {r["token"]: r["id"] for r in words.collect()} == tokenizer.get_vocab()
    for limit in (1000, 1):  # looked up in tasks, and joined
        encoded = encode_words(docs, words, "doc_id", max_rows=limit)
        decoded = decode_words(encoded, words, "doc_id", max_rows=limit).collect()
        assert len(decoded) == len(TEXTS)
        for row in decoded:
            expected = tokenizer.encode(row["text"]).ids
            assert row["ids"] == expected
            assert row["decoded"] == tokenizer.decode(expected)


def test_vocabulary_cap_and_empty_corpus(spark):
    docs = frame(spark, ["a a a b b c c d"])
    assert [r["token"] for r in vocab.word_vocab(docs, max_size=6).orderBy("id").collect()] == SPECIALS + ["a", "b"]
    empty = docs.filter("doc_id < 0")
    assert vocab.word_vocab(empty).count() == 4
    assert vocab.char_vocab(empty).count() == 0


def test_store_rebuilds_for_another_corpus(spark, tmp_path):
    one, two = frame(spark, ["a a b b"]), frame(spark, ["c c d d"])
    path = str(tmp_path)
    first = load_or_build_vocab(one, path)
    assert first.count() == load_or_build_vocab(one, path).count() == 6
    assert len(list(tmp_path.iterdir())) == 1
    tokens = {r["token"] for r in load_or_build_vocab(two, path).collect()}
    assert tokens == {*SPECIALS, "c", "d"}
    assert len(list(tmp_path.iterdir())) == 2
    assert load_vocab(spark, f"{path}/none") is None


def test_text_files(spark, tmp_path):
    texts = {"b.txt": "two\nlines\n", "a.txt": "first\nfile\nhere\n", "c.txt": "é\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    whole = read_corpus(spark, str(tmp_path), "text").orderBy("doc_id").collect()
    assert [r["text"] for r in whole] == [texts[n] for n in sorted(texts)]
    lines = read_corpus(spark, str(tmp_path), "lines").orderBy("doc_id").collect()
    assert "".join(r["text"] for r in lines) == "".join(texts[n] for n in sorted(texts))
    assert len({r["doc_id"] for r in lines}) == 6


def test_pairs_from_map_and_struct(spark):
    made = spark.sql("SELECT 1 AS id, map('en', 'x', 'it', 'y') AS translation")
    struct = spark.sql("SELECT 1 AS id, named_struct('en', 'x', 'it', 'y') AS translation")
    for df in (made, struct):
        assert read_pairs(df, "en", "it").first().asDict() == {"pair_id": 1, "src": "x", "trg": "y"}


def test_words_of_a_large_vocabulary_meet_it_in_blocks(spark, monkeypatch):
    from tokenloom.operators import dictionary, encode

    monkeypatch.setattr(dictionary, "BLOCK_ROWS", 3)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "a", "é", "x,y", "[PAD]", f"w{rng.randint(0, 300)}"]) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate([*texts, "", None])], "doc_id bigint, text string, source string").repartition(4)
    words = vocab.word_vocab(docs.filter("text is not null"))
    rows = {}
    for max_rows in (10_000, 5):
        encoded = encode.encode_words(docs, words, "doc_id", max_rows=max_rows)
        assert encoded.columns == ["doc_id", "text", "source", "ids"]
        decoded = encode.decode_words(encoded, words, "doc_id", max_rows=max_rows)
        assert decoded.columns == ["doc_id", "text", "source", "ids", "decoded"]
        rows[max_rows] = sorted(((r["doc_id"], r["text"], r["source"], r["ids"] or [], r["decoded"] or "") for r in decoded.collect()), key=str)
    assert rows[5] == rows[10_000] and len(rows[5]) == 62
    plan = encode.encode_words(docs, words, "doc_id", max_rows=5)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(_words" not in plan


def test_functions_hold_little_beside_their_result(spark, monkeypatch):
    """A batch of 8 million characters: the result has 4 bytes of each, the work beside it a bounded part."""
    import tracemalloc

    import pyarrow as pa

    from tokenloom.functions import text as functions

    letters = [chr(c) for c in range(97, 123)]
    col = pa.array([("".join(letters) * 40)[: 1000 + k % 7] for k in range(8000)])
    encode = functions.char_to_id(letters, list(range(26)), "error").func
    tracemalloc.start()
    ids = encode(col)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n = sum(map(len, col.to_pylist()))
    assert peak < 4 * n + (24 << 20)
    # Slices of any length give the same rows, empty ones and nulls included.
    odd = pa.array(["abc", None, "", "z" * 50, "b", None])
    words = pa.array([["a", "q"], None, [], ["b"] * 9, ["a"]], pa.list_(pa.string()))
    several = []
    for size in (1 << 20, 7, 1):
        monkeypatch.setattr(functions, "SLICE", size)
        coded = functions.char_to_id(letters, list(range(26)), "error").func(odd)
        dropped = functions.char_to_id(["a", "z"], [0, 1], "drop").func(odd)
        numbers = functions.token_to_id(["a", "b"], [5, 6], 0).func(words)
        several.append([r.to_pylist() for r in (
            coded, dropped, numbers, functions.ids_text.func(coded), functions.id_to_chars(letters, list(range(26))).func(coded),
            functions.id_to_text(["a", "b"], [5, 6], [0], " ").func(numbers))])
    assert several[0] == several[1] == several[2]
    assert several[0][0] == [[0, 1, 2], [], [], [25] * 50, [1], []] and several[0][1][0] == [0] and several[0][5][0] == "a"


def test_coverage_from_counts_that_made_the_vocabulary(spark):
    rows = [("en", "a b a c"), ("en", "d"), ("it", "a a e"), (None, "b b"), ("it", None)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    counts = vocab.word_counts(docs, by=["lang"])
    words = vocab.ranked_vocab(counts.groupBy("token").agg(F.sum("freq").alias("freq")))
    assert sorted(words.collect()) == sorted(vocab.word_vocab(docs).collect())
    got = {r["lang"]: (r["n_tokens"], r["n_unknown"]) for r in vocab.coverage(docs, words, "lang", counts=counts).collect()}
    assert got == {"en": (5, 2), "it": (3, 1), None: (2, 0)}


def test_words_cut_in_tasks_are_those_of_the_patterns(spark, monkeypatch):
    import pyarrow as pa

    from tokenloom.functions import text as functions
    from tokenloom.functions import words
    from tokenloom.functions.text import marked_word_tokens

    points = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [*TEXTS, "".join(points), *("é".join(points[i : i + 40]) for i in range(0, 20_000, 37)), "[PA", "D]", "[[PAD]][PAD", "[SOS]", None]
    plain, marked = (words.word_cutter(spark, m) for m in (False, True))
    rows = frame(spark, texts, 1).orderBy("doc_id").select(
        word_tokens(F.col("text")).alias("w"), marked_word_tokens(F.col("text")).alias("m")).collect()
    for size in (1 << 20, 5):
        monkeypatch.setattr(functions, "SLICE", size)
        assert plain(pa.array(texts)).to_pylist() == [r["w"] or [] for r in rows]
        assert marked(pa.array(texts)).to_pylist() == [r["m"] or [] for r in rows]
        assert marked(pa.array(texts).slice(3, 4)).to_pylist() == [r["m"] for r in rows[3:7]]
    assert plain(pa.array([], pa.string())).to_pylist() == []
    counts = {(r["doc_id"] % 2, w): 0 for r in frame(spark, TEXTS).collect() for w in plain(pa.array([r["text"]]))[0].as_py()}
    for i, t in enumerate(TEXTS):
        for w in plain(pa.array([t]))[0].as_py():
            counts[i % 2, w] += 1
    monkeypatch.setattr(words, "COUNTED", 9)
    docs = frame(spark, [*TEXTS, None]).select((F.col("doc_id") % 2).alias("odd"), "text")
    assert {(r["odd"], r["token"]): r["freq"] for r in vocab.word_counts(docs, by=["odd"]).collect()} == counts


def test_only_words_beyond_the_first_ones_are_joined(spark, monkeypatch):
    """Blocks ask for the words that are not looked up in the tasks, once each, and carry no text that nobody wants."""
    from tokenloom.operators import dictionary, encode

    asked = []
    monkeypatch.setattr(dictionary, "BATCH_BYTES", 64)
    monkeypatch.setattr(dictionary, "lookup_join", lambda big, *a, f=dictionary.lookup_join, **k: asked.append(big) or f(big, *a, **k))
    texts = [f"the the a rare{i % 20} once{i} [PAD]" for i in range(40)]
    docs = frame(spark, [*texts, "", None])
    words = vocab.word_vocab(docs)
    encoded = encode_words(docs, words, "doc_id", max_rows=9, keep_text=False)
    assert encoded.columns == ["doc_id", "ids"]
    decoded = decode_words(encoded, words, "doc_id", max_rows=9, keep_ids=False)
    assert decoded.columns == ["doc_id", "decoded"]
    # All 40 texts have "the" and "a", which are among the first nine; `once…` are in no vocabulary.
    met = [{r[0] for r in df.select(c).distinct().collect()} for df, c in zip(asked, ("token", "id"))]
    first = {r["token"] for r in words.filter("id < 9").collect()}
    assert {"the", "a"} <= first and not met[0] & first and min(met[1]) == 9 and len(met[1]) == len(met[0]) - 40
    ids = {r["token"]: r["id"] for r in words.collect()}
    known = {i: [w for w in t.split() if w in ids and w != "[PAD]"] for i, t in enumerate([*texts, ""])} | {41: []}
    assert {r["doc_id"]: r["decoded"] or "" for r in decoded.collect()} == {i: " ".join(w) for i, w in known.items()}
    codes = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert all(codes[i] == [ids.get(w, 0) for w in t.split()] for i, t in enumerate([*texts, ""])) and not codes[41]
