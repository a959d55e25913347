import math
import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import packing, splits
from tokenloom.operators.positions import running_sums, stream_index


def docs_of(spark, sizes, ids=None, parts=4):
    ids = ids or list(range(len(sizes)))
    rows, at = [], 0
    for key, n in zip(ids, sizes):
        rows.append((key, list(range(at, at + n))))
        at += n
    return spark.createDataFrame(rows, "doc_id bigint, ids array<int>").repartition(parts)


def indexed(docs):
    return stream_index(docs, "doc_id", F.size("ids"))


def blocks(docs, T, block=packing.BLOCK):
    return packing.token_blocks(docs, "doc_id", T, block=block)


def naive_windows(total, B, T):
    rows = max(0, total - 1) // (B * T) * B
    return {w: (list(range(w * T, w * T + T)), list(range(w * T + 1, w * T + T + 1))) for w in range(rows)}


def test_offsets_of_scattered_keys(spark):
    rng = random.Random(1)
    ids = sorted(rng.sample(range(10**12), 150) + list(range(100)))
    sizes = [rng.choice([0, 0, 1, 5, 40]) for _ in ids]
    docs = docs_of(spark, sizes, ids)
    index = indexed(docs)
    got = {r["doc_id"]: r["offset"] for r in index.offsets.collect()}
    at = 0
    for key, n in zip(ids, sizes):
        assert got[key] == at
        at += n
    assert index.total == at


@pytest.mark.parametrize("total", [0, 1, 4, 5, 8, 9, 16, 17, 33])
@pytest.mark.parametrize("shape", ["one", "ones", "mixed"])
def test_windows_are_slices_of_the_stream(spark, total, shape):
    sizes = {"one": [total], "ones": [1] * total, "mixed": [min(3, total), 0, max(0, total - 3)]}[shape]
    docs = docs_of(spark, sizes or [0])
    for block in (1, 3, 4, 7, 1000):
        made = packing.pack_windows(blocks(docs, 4, block), 2).collect()
        assert {r["window_id"]: (r["x"], r["y"]) for r in made} == naive_windows(total, 2, 4)
        assert len(made) == len({r["window_id"] for r in made})
        assert all((r["batch_id"], r["row"]) == divmod(r["window_id"], 2) for r in made)


def test_a_document_with_most_tokens_and_partitions(spark):
    sizes = [3, 500, 2, 0, 1, 7]
    expected = naive_windows(sum(sizes), 4, 8)
    for parts in (1, 4, 32):
        docs = docs_of(spark, sizes, parts=parts)
        made = packing.pack_windows(blocks(docs, 8, 30), 4).collect()
        assert {r["window_id"]: (r["x"], r["y"]) for r in made} == expected


def test_random_windows_repeat_and_stay_inside(spark):
    docs = docs_of(spark, [5, 0, 90, 3, 2])
    index = indexed(docs)
    first = {r["sample_id"]: r for r in packing.random_windows(docs, index, 200, 7, 1, 20, 90).collect()}
    again = packing.random_windows(docs.repartition(1), index, 200, 7, 1, 20, 90).collect()
    assert len(first) == 200 and all(first[r["sample_id"]] == r for r in again)
    for r in first.values():
        assert 20 <= r["start"] < 90 - 7
        assert r["x"] == list(range(r["start"], r["start"] + 7))
        assert r["y"] == [i + 1 for i in r["x"]]
    joined = packing.random_windows(docs, index, 200, 7, 1, 20, 90, max_rows=0).collect()
    assert all(first[r["sample_id"]] == r for r in joined) and len(joined) == 200
    with pytest.raises(ValueError):
        packing.random_windows(docs, index, 1, 7, 1, 0, 7)


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_only_documents_under_a_sample_are_encoded(spark, max_rows):
    rng = random.Random(6)
    sizes = [rng.choice([0, 1, 2, 9, 60]) for _ in range(80)]
    docs = docs_of(spark, sizes).withColumnRenamed("ids", "hidden")
    index = stream_index(docs, "doc_id", F.size("hidden"))
    begins = [0, 5, 5, index.total // 2, index.total - 8]
    samples = spark.createDataFrame(list(enumerate(begins)), "sample_id bigint, begin bigint")
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    met = [i for i, e in enumerate(ends) if any(b < e and b + 7 >= e - sizes[i] for b in begins) and sizes[i]]

    def encode(df):
        wrong = F.raise_error(F.concat(F.lit("not under a sample: "), F.col("doc_id").cast("string"))).cast("array<bigint>")
        return df.withColumn("ids", F.when(F.col("doc_id").isin(met), F.col("hidden")).otherwise(wrong))

    made = packing.windows_at(docs, index, samples, 7, encode, max_rows).collect()
    assert {r["sample_id"]: (r["x"], r["y"]) for r in made} == {
        i: (list(range(b, b + 7)), list(range(b + 1, b + 8))) for i, b in enumerate(begins)}


def test_one_scan_and_one_encoding(spark):
    docs = docs_of(spark, [5] * 40)
    read = spark.sparkContext.accumulator(0)

    def encode(df):
        count = F.udf(lambda ids: read.add(1) or ids, "array<int>").asNondeterministic()
        return df.withColumn("ids", count("ids"))

    stream = packing.token_blocks(docs, "doc_id", 4, encode)
    assert packing.pack_windows(stream, 2).count() == len(naive_windows(200, 2, 4))
    assert read.value == 40


def test_prefixes_and_cursor_and_plan(spark):
    docs = docs_of(spark, [17])
    index = indexed(docs)
    windows = packing.pack_windows(blocks(docs, 4), 2)
    prefixes = packing.prefix_expand(windows.filter("window_id = 1")).orderBy("t").collect()
    assert [(r["context"], r["target"]) for r in prefixes] == [
        ([4], 5), ([4, 5], 6), ([4, 5, 6], 7), ([4, 5, 6, 7], 8)
    ]
    steps = packing.batches_for_steps(windows, 2, 1, 4).select("step", "batch_id", "epoch").distinct()
    assert sorted(map(tuple, steps.collect())) == [(0, 1, 0), (1, 0, 1), (2, 1, 1), (3, 0, 2)]
    plan = packing.epoch_plan(index, 2, 4, 32).first()
    assert (plan["n_tokens"], plan["n_batches"], plan["tail_tokens"], plan["micro_batches"]) == (17, 2, 1, 4)
    with pytest.raises(ValueError):
        packing.epoch_plan(index, 2, 4, 30)


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_prefix_split_covers_once(spark, fraction):
    docs = docs_of(spark, [4, 0, 9, 1, 6])
    parts = splits.prefix_split(docs, indexed(docs), fraction).collect()
    cut = int(fraction * 20)
    tokens = {s: sorted(t for r in parts if r["split"] == s for t in r["ids"]) for s in ("train", "val")}
    assert tokens == {"train": list(range(cut)), "val": list(range(cut, 20))}


@pytest.mark.parametrize("n", [0, 1, 10, 333])
def test_random_split_is_exact_and_repeats(spark, n):
    df = spark.range(n).withColumnRenamed("id", "key")
    one = splits.random_split(df, "key", 0.9, 7)
    two = splits.random_split(df.repartition(32), "key", 0.9, 7)
    rows = {r["key"]: r["split"] for r in one.collect()}
    assert rows == {r["key"]: r["split"] for r in two.collect()}
    assert sum(s == "train" for s in rows.values()) == int(0.9 * n) and len(rows) == n


def test_shuffled_batches(spark):
    df = spark.range(21).withColumnRenamed("id", "key")
    rows = splits.shuffle_batches(df, "key", 8, 1).collect()
    assert sorted((r["batch_id"], r["row"]) for r in rows) == [divmod(i, 8) for i in range(21)]
    other = splits.shuffle_batches(df, "key", 8, 1, epoch=1).collect()
    assert {r["key"]: r["batch_id"] for r in rows} != {r["key"]: r["batch_id"] for r in other}


def test_running_sums_in_blocks(spark):
    rows = [(s, t, t + s) for s, n in ((0, 100), (1, 3), (2, 28)) for t in range(n)]
    df = spark.createDataFrame(rows, "seq bigint, t bigint, x bigint").repartition(5)
    for block in (3, 1000):
        got = {(r["seq"], r["t"]): r["sum_x"] for r in running_sums(df, "seq", "t", ["x"], block).collect()}
        assert got == {(s, t): sum(u + s for u in range(t + 1)) for s, t, _ in rows}


def test_streams_of_several_keys(spark):
    rng = random.Random(3)
    rows = [(d, rng.choice("aab"), list(range(100 * d, 100 * d + rng.choice([0, 1, 4, 30])))) for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, ids array<int>").repartition(5)
    for block in (2, 9, 500):
        stream = packing.token_blocks(docs, "doc_id", 4, by=("source",), block=block)
        got = {(r["source"], r["window_id"]): r["run"] for r in packing.cut_windows(stream).collect()}
        expected = {}
        for source in "ab":
            tokens = [t for _, s, ids in rows if s == source for t in ids]
            expected |= {(source, w): tokens[4 * w : 4 * w + 5] for w in range((len(tokens) - 1) // 4)}
        assert got == expected
        assert dict(map(tuple, stream.totals.collect())) == {s: sum(len(r[2]) for r in rows if r[1] == s) for s in "ab"}


def test_corpus_rows_never_meet_in_one_task(spark):
    docs = docs_of(spark, [5] * 40)
    plan = packing.pack_windows(blocks(docs, 4), 2)._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("SinglePartition")[1:]:
        # What meets in one task is already summed per part.
        assert "HashAggregate(keys=[part" in part[:400]


def test_blocks_are_coded_in_slices_of_a_batch(spark, monkeypatch):
    """One function per task makes blocks of texts; it never holds the ids of a batch together."""
    import tracemalloc

    import pyarrow as pa

    from tokenloom.operators import vocab
    from tokenloom.operators.encode import CharEncoder, encode_chars
    from tokenloom.operators.packing import _coded

    texts = ["abcde" * 3, "", None, "é中😀" * 7, "a", "bb" * 40]
    docs = spark.createDataFrame([(i, t, f"s{i % 2}") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    chars = vocab.char_vocab(docs)
    encode = CharEncoder(chars)
    for by in ((), ("source",)):
        made = [packing.token_blocks(docs, "doc_id", 4, e, by, block=16).blocks for e in (encode, lambda df: encode_chars(df, chars))]
        rows = [sorted((*[r[c] for c in by], r["start"], r["size"], r["ids"], r["head"], r["tail"]) for r in b.collect()) for b in made]
        assert rows[0] == rows[1] and sum(r[len(by) + 1] for r in rows[0]) == sum(len(t or "") for t in texts)
    batch = pa.RecordBatch.from_arrays([pa.array(["abcde" * 1000] * 4000)], ["ids"])
    code = encode.in_task()
    tracemalloc.start()
    n = sum(len(b.column("ids").flatten()) for b in _coded([batch], (), code))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 20_000_000 and peak < 2 * n
    with pytest.raises(Exception, match="not in the vocabulary"):
        other = spark.createDataFrame([(1, "ab~")], "doc_id bigint, text string")
        packing.token_blocks(other, "doc_id", 4, encode).blocks.collect()


STEPS_AT = [(3, 0, 3), (3, 5, 6), (2, 1, 4), (3, -4, 9), (3, -2, 0), (1, 0, 5), (8, 7, 3), (3, 2, 1), (3, 1, -2)]


@pytest.mark.parametrize("max_rows", [packing.MAX_BROADCAST_ROWS, 1])
def test_steps_of_windows_as_a_loop_gives_them(spark, monkeypatch, max_rows):
    monkeypatch.setattr(packing, "MAX_BROADCAST_ROWS", max_rows)
    ids = [0, 0, 0, 1, None, -1, 2, 7, 1]  # repeated, without a number, and numbers that no step comes to
    windows = spark.createDataFrame([(i // 2, b, [i]) for i, b in enumerate(ids)], "window_id bigint, batch_id bigint, x array<int>")
    for n, start, n_steps in STEPS_AT:
        made = packing.batches_for_steps(windows, n, start, n_steps)
        assert made.columns == ["batch_id", "window_id", "x", "step", "epoch"]
        cursor = [(s, int(math.fmod(s + start, n)), (s + start) // n) for s in range(n_steps)]
        expected = [(b, i // 2, [i], s, e) for s, at, e in cursor for i, b in enumerate(ids) if at == b]
        assert sorted(map(tuple, made.collect())) == sorted(expected)
    assert packing.batches_for_steps(windows.limit(0), 0, 5, 3).count() == 0


def test_windows_do_not_move_to_their_steps(spark):
    """However many steps there are: windows are the largest table, and a shuffle would write them all."""
    windows = spark.range(1000).select(F.col("id").alias("window_id"), (F.col("id") / 2).cast("bigint").alias("batch_id"),
                                       F.array("id").alias("x"), F.array("id").alias("y"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        n = packing.MAX_BROADCAST_ROWS + 1
        made = packing.batches_for_steps(windows, n, 5, n + 3)
        assert "Exchange hashpartitioning" not in made._jdf.queryExecution().executedPlan().toString()
        assert made.count() == 1000 + 2 * 3  # the steps after the last batch come to batches 5, 6 and 7 again
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_windows_far_into_a_stream(spark):
    """Places in the stream that 32 bits do not hold, inside blocks and over their ends."""
    B, T, shift = 2, 4, 3 * 10**9
    near = blocks(docs_of(spark, [7, 0, 9, 1, 20, 14]), T, block=9)
    far = packing.TokenBlocks(near.blocks.withColumn("start", F.col("start") + shift), near.totals.select((F.col("total") + shift).alias("total")), T)
    made = packing.pack_windows(far, B)
    expected = {shift // T + w: x for w, x in naive_windows(51, B, T).items()}
    assert {r["window_id"]: (r["x"], r["y"]) for r in made.collect()} == expected
    n = (far.total - 1) // (B * T)
    steps = packing.batches_for_steps(made, n, n - 2, 3).select("step", "batch_id", "epoch", "row")
    assert sorted(map(tuple, steps.collect())) == [(s, n - 2 + s, 0, r) for s in range(2) for r in range(B)]
