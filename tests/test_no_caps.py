"""Results do not depend on the size of a vocabulary, a file split or an Arrow batch."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import bpe, encode, scoring, splits, vocab
from tokenloom.operators.positions import dense_order
from tokenloom.session import once
from tokenloom.sources.corpus import read_corpus, turn_key


def test_dense_order_over_many_parts(spark):
    rows = spark.range(0, 5000, 1, 13).select(F.hash("id").alias("k"), "id")
    got = [(r["k"], r["id"]) for r in dense_order(rows, "k", "id").orderBy("idx").collect()]
    assert got == sorted(got)
    assert [r["idx"] for r in dense_order(rows, "k", "id").select("idx").orderBy("idx").collect()] == list(range(5000))


def test_no_word_is_lost_beyond_thirty_thousand(spark):
    n = 30_500
    words = spark.range(n).select(F.concat(F.lit("w"), F.col("id")).alias("w"))
    docs = words.select(F.concat_ws(" ", "w", "w").alias("text"))
    built = vocab.word_vocab(docs)
    assert built.count() == n + 4
    assert built.select("id").distinct().count() == n + 4 and built.agg(F.max("id")).first()[0] == n + 3


def test_unknown_ids_stop_decoding_for_any_vocabulary_size(spark):
    table = spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int")
    docs = spark.createDataFrame([(1, [4, 5]), (2, [])], "doc_id bigint, ids array<int>")
    bad = spark.createDataFrame([(1, [4, 99])], "doc_id bigint, ids array<int>")
    for rows in (10, 0):
        got = {r["doc_id"]: r["decoded"] for r in encode.decode_words(docs, table, "doc_id", max_rows=rows).collect()}
        assert got == {1: "a b", 2: ""}
        with pytest.raises(Exception):
            encode.decode_words(bad, table, "doc_id", max_rows=rows).collect()


def test_lines_give_the_files_back(spark, tmp_path):
    texts = {"a": "one\ntwo", "b": "three\n\nfour\n", "c": "\n", "d": "five"}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    rows = read_corpus(spark, str(tmp_path), "lines").orderBy("doc_id").collect()
    assert "".join(r["text"] for r in rows) == "".join(texts[k] for k in sorted(texts))


def test_turn_keys_are_unique_or_stop_the_job(spark):
    turns = spark.createDataFrame([(1, 100), (2, 0), (2, None)], "c bigint, t bigint")
    keys = [r[0] for r in turns.select(turn_key(F.col("c"), F.col("t"))).collect()]
    assert len(set(keys)) == 3
    with pytest.raises(Exception, match="no key for turn"):
        spark.createDataFrame([(1, 1 << 20)], "c bigint, t bigint").select(turn_key(F.col("c"), F.col("t"))).collect()


def test_score_with_several_arrays(spark):
    rows = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0, 5.0], 2.0)], "a array<double>, b array<double>, c double")

    def load():
        return lambda a, b, c: a.sum(axis=1) + b.sum(axis=1) + c

    assert scoring.score_with(rows, load, ["a", "b", "c"], width=[2, 3, 0]).first()["score"] == 17.0


def test_split_leakage_counts_copies(spark):
    parts = spark.createDataFrame([(1, "x", "train"), (2, "x", "train"), (3, "x", "val"), (4, "y", "val")],
                                  "doc_id bigint, text string, split string")
    assert [tuple(r) for r in splits.split_leakage(parts, "doc_id", "text").collect()] == [(3, 2)]


@pytest.mark.parametrize("bits", [1 << 15, 1 << 20])
def test_leaked_rows_go_whatever_the_filter_holds(spark, bits):
    rng = random.Random(bits)
    rows = [(i, f"text {rng.randint(0, 9000)}", "train" if i < 8000 else "val") for i in range(9000)] + [(9999, None, "val"), (9998, "", "val")]
    parts = spark.createDataFrame(rows, "doc_id bigint, text string, split string").repartition(4)
    known = {t for _, t, s in rows if s == "train"}
    kept = {r["doc_id"] for r in splits.drop_leakage(parts, "doc_id", "text", bits=bits).collect()}
    assert kept == {i for i, t, s in rows if s == "train" or t not in known}
    assert splits.drop_leakage(parts.limit(0), "doc_id", "text", bits=bits).count() == 0


def test_shared_tables_follow_their_files(spark, tmp_path):
    place, made = str(tmp_path / "t"), []

    def count():
        made.append(spark.read.parquet(place).count())
        return spark.range(made[-1])

    spark.range(3).write.parquet(place)
    assert once(spark.read.parquet(place), "x", count).count() == once(spark.read.parquet(place), "x", count).count() == 3
    spark.range(2).write.mode("append").parquet(place)
    assert once(spark.read.parquet(place), "x", count).count() == 5 and made == [3, 5]


def test_vocabulary_of_the_training_part(spark):
    parts = spark.createDataFrame([("a a b b", "train"), ("c c c a", "val")], "text string, split string")
    assert {r["token"] for r in vocab.fit_vocab(parts, "train").filter("not is_special").collect()} == {"a", "b"}
    assert {r["token"] for r in vocab.fit_vocab(parts).filter("not is_special").collect()} == {"a", "b", "c"}


def loop(freq, n):
    words, merges = {w: [bytes([b]) for b in w.encode()] for w in freq}, []
    while len(merges) < n:
        pairs = Counter()
        for w, parts in words.items():
            for pair in zip(parts, parts[1:]):
                pairs[pair] += freq[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p[0].hex(), p[1].hex()))
        merges.append(best)
        for w, parts in words.items():
            out, i = [], 0
            while i < len(parts):
                hit = tuple(parts[i : i + 2]) == best
                out.append(parts[i] + parts[i + 1] if hit else parts[i])
                i += 2 if hit else 1
            words[w] = out
    return merges


def trained(spark, freq, n):
    docs = spark.createDataFrame([(w,) for w, k in freq.items() for _ in range(k)], "text string").repartition(2)
    rows = bpe.train_bpe(docs, n).orderBy("rank").collect()
    return [(bytes.fromhex(r["left"]), bytes.fromhex(r["right"])) for r in rows]


def test_a_run_of_one_symbol_outranks_other_pairs(spark):
    freq = {"aaaa": 100, "cd": 50, "ef": 40, "gh": 30}
    assert trained(spark, freq, 4) == [(b"a", b"a"), (b"aa", b"aa"), (b"c", b"d"), (b"e", b"f")]


@pytest.mark.parametrize("seed", range(4))
def test_merges_of_random_words_equal_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    freq = {}
    for _ in range(12):
        word = "".join(rng.choice("ab") * rng.randint(1, 4) for _ in range(rng.randint(1, 4)))
        freq[word] = rng.randint(1, 30)
    assert trained(spark, freq, 10) == loop(freq, 10)


def test_staged_blocks_are_read_in_bounded_groups(spark):
    """A reader decodes thousands of rows of a row group at once, so a group must hold few ids."""
    import numpy as np
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from tokenloom.operators.packing import token_blocks

    @F.pandas_udf("array<int>")
    def made(doc_id):
        return doc_id.map(lambda d: np.random.default_rng(d).integers(0, 1 << 30, 200_000).astype(np.int32))

    docs = spark.range(40).coalesce(1).select(F.col("id").alias("doc_id")).withColumn("ids", made("doc_id"))
    stream = token_blocks(docs, "doc_id", 64)
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in stream.blocks.inputFiles()]
    held = [g.row_group(i).column(c).num_values for g in groups for i in range(g.num_row_groups)
            for c in range(g.num_columns) if g.row_group(i).column(c).path_in_schema.startswith("ids")]
    assert sum(held) == 8_000_000 == stream.total and max(held) <= 2_000_000


def test_many_samples_do_not_pass_through_the_driver(spark):
    from pyspark.sql import functions as F

    from tokenloom.operators.packing import random_windows
    from tokenloom.operators.positions import stream_index

    rows = [(d, list(range(d * 100, d * 100 + d % 40))) for d in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, ids array<int>")
    index = stream_index(docs, "doc_id", F.size("ids"))
    tokens = [t for _, ids in rows for t in ids]
    made = random_windows(docs, index, 300, 8, 1, max_rows=20)
    assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()
    got = made.collect()
    assert len(got) == 300 and all(r["x"] == tokens[r["start"] : r["start"] + 8] and r["y"] == tokens[r["start"] + 1 : r["start"] + 9] for r in got)
    few = random_windows(docs, index, 300, 8, 1).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, got))
