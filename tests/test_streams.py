import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tokenloom.operators import packing, vocab
from tokenloom.streaming.metrics import append_to, metrics_windows
from tokenloom.streaming.packing import LEFT, pack_batch, pack_stream, packed_windows
from tokenloom.streaming.vocab import compacted, current_counts, follow_counts, live_segments

METRICS = "run_id bigint, step bigint, ts timestamp, name string, value double"


def add_file(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def test_metric_windows_close_across_a_restart(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i % 3, i, start + dt.timedelta(hours=3 * i), "loss", float(i)) for i in range(40)]
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = spark.readStream.schema(METRICS).parquet(str(source))
        append_to(metrics_windows(stream), out, state).awaitTermination()
        return spark.read.parquet(out)

    add_file(spark, rows[:20], METRICS, source)
    first = run().count()
    add_file(spark, rows[20:], METRICS, source)
    closed = run()
    expected = Counter((r[2].date(), r[0]) for r in rows if r[2].date() < dt.date(2024, 1, 5))
    got = {(r["start"].date(), r["run_id"]): r["n"] for r in closed.collect()}
    assert got == dict(expected) and 0 < first < len(expected)
    run()
    assert spark.read.parquet(out).count() == len(expected)


def test_word_counts_over_batches_equal_one_count(spark, tmp_path):
    texts = ["a b a", "b c", "", "a é !", "c c c", "a", "d d"]
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for k, text in enumerate(texts):
        add_file(spark, [(text,)], "text string", source)
        stream = spark.readStream.schema("text string").parquet(str(source))
        follow_counts(stream, out, state, fan=2).awaitTermination()
        whole = vocab.word_counts(spark.createDataFrame([(t,) for t in texts[: k + 1]], "text string"))
        assert sorted(map(tuple, current_counts(spark, out).collect())) == sorted(map(tuple, whole.collect()))
    assert live_segments(spark, out) == [(2, 0, 3), (1, 4, 5), (0, 6, 6)]


def test_few_segments_after_many_batches():
    live, written = [], 0
    for batch in range(1000):
        live, merges = compacted(live, batch, 8)
        written += sum(made[2] - made[1] + 1 for made, _ in merges)
        assert [s[1] for s in live] == [0, *[s[2] + 1 for s in live[:-1]]] and live[-1][2] == batch
        assert len(live) <= 7 * 4
    assert written <= 3 * 1000  # each batch is rewritten once per level


def test_a_repeated_count_adds_nothing(spark, tmp_path):
    """The last batch again, as after a failure between its results and the progress log."""
    source, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    for text in ("a b", "b", "a", "c"):
        add_file(spark, [(text,)], "text string", source)
        follow_counts(spark.readStream.schema("text string").parquet(str(source)), out, str(state), fan=2).awaitTermination()
    expected = sorted(map(tuple, current_counts(spark, out).collect()))
    for name in ("3", ".3.crc"):
        (state / "commits" / name).unlink(missing_ok=True)
    follow_counts(spark.readStream.schema("text string").parquet(str(source)), out, str(state), fan=2).awaitTermination()
    assert sorted(map(tuple, current_counts(spark, out).collect())) == expected


def windows_of(tokens, T):
    return [(tokens[w * T : w * T + T], tokens[w * T + 1 : w * T + T + 1]) for w in range(max(0, len(tokens) - 1) // T)]


def packed(spark, out):
    found = {}
    for r in packed_windows(spark, out).collect():
        found.setdefault(r["source"], {})[r["window_id"]] = (r["x"], r["y"])
    return {s: [w[i] for i in range(len(w))] for s, w in found.items()}


DOCS = "doc_id bigint, source string, ids array<int>"


def test_packing_goes_on_where_the_last_run_ended(spark, tmp_path):
    """Three runs of several files, some sources silent or too short for a window in a run."""
    rng = random.Random(1)
    docs = [(d, rng.choice(["big", "big", "small", "", None]), list(range(d * 100, d * 100 + rng.choice([0, 1, 3, 17])))) for d in range(90)]
    docs = [d if not (30 <= d[0] < 60 and d[1] == "small") else (d[0], "big", d[2]) for d in docs] + [(95, "late", [7])]
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    streams = {}
    for part in (docs[:30], docs[30:60], docs[60:]):
        for half in (part[::2], part[1::2]):
            add_file(spark, half, DOCS, source)
        pack_stream(spark.readStream.schema(DOCS).parquet(str(source)), out, state, 4).awaitTermination()
        for _, s, ids in sorted(part, key=lambda d: d[0]):
            streams.setdefault(s or "", []).extend(ids)
        assert packed(spark, out) == {s: windows_of(t, 4) for s, t in streams.items() if len(t) > 4}
    pack_stream(spark.readStream.schema(DOCS).parquet(str(source)), out, state, 4).awaitTermination()
    assert packed(spark, out) == {s: windows_of(t, 4) for s, t in streams.items() if len(t) > 4}


def test_a_repeated_batch_changes_nothing(spark):
    left = spark.createDataFrame([("a", 3, [1, 2]), ("b", 0, [])], LEFT)
    docs = spark.createDataFrame([(1, "a", [3, 4, 5]), (2, "a", [6] * 9), (3, "c", [])], DOCS)
    for _ in range(2):
        windows, after = pack_batch(docs, left, 4)
        tokens = [1, 2, 3, 4, 5] + [6] * 9
        assert sorted((r["window_id"], r["x"], r["y"]) for r in windows.collect()) == [
            (3 + w, x, y) for w, (x, y) in enumerate(windows_of(tokens, 4))]
        assert {r["source"]: (r["next_id"], r["ids"]) for r in after.collect()} == {
            "a": (6, tokens[12:]), "b": (0, []), **({"c": (0, [])} if any(r["source"] == "c" for r in after.collect()) else {})}


def test_one_batch_equals_batch_packing(spark, tmp_path):
    docs = [(d, "s", [d] * (d % 5)) for d in range(30)]
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    add_file(spark, docs, DOCS, source)
    pack_stream(spark.readStream.schema(DOCS).parquet(str(source)), out, state, 4).awaitTermination()
    batch = packing.pack_windows(packing.token_blocks(spark.createDataFrame(docs, DOCS), "doc_id", 4), 1)
    expected = {r["window_id"]: (r["x"], r["y"]) for r in batch.collect()}
    assert dict(enumerate(packed(spark, out)["s"])) == expected


def test_a_table_of_one_file_or_a_folder_of_files_is_followed(spark, tmp_path):
    from tokenloom.plans.streams import follow

    rows = [(d, "s", [d]) for d in range(20)]
    add_file(spark, rows, DOCS, tmp_path / "made")
    (one,) = (tmp_path / "made").glob("part-*.parquet")
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "documents.parquet").write_bytes(one.read_bytes())
    (tmp_path / "one" / "other.parquet").write_bytes(one.read_bytes())
    for half in (rows[:10], rows[10:]):
        add_file(spark, half, DOCS, tmp_path / "many" / "documents.parquet")
    for name in ("one", "many"):
        met = []
        follow(spark, str(tmp_path / name), "documents").writeStream.foreachBatch(
            lambda batch, _: met.extend(r["doc_id"] for r in batch.collect())
        ).option("checkpointLocation", str(tmp_path / f"state_{name}")).trigger(availableNow=True).start().awaitTermination()
        assert sorted(met) == list(range(20)), name
