"""Streaming jobs run to the end of what is there, and byte pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions.registered import register_text_functions
from tokenloom.operators import bpe, vocab
from tokenloom.operators.encode import encode_chars
from tokenloom.plans.corpus import WORD_VOCAB_SQL, corpus
from tokenloom.plans.logs import NUDGE
from tokenloom.plans.pairs import PAIRS_SQL, pairs_table, word_edits_sql
from tokenloom.plans.registry import CHARS_SQL, as_text, query, six, whole
from tokenloom.session import once, stage, staging_path
from tokenloom.sources.corpus import table
from tokenloom.sources.metric_log import event_metrics
from tokenloom.streaming.metrics import append_to, metrics_windows
from tokenloom.streaming.packing import pack_stream, packed_windows
from tokenloom.streaming.vocab import current_counts, follow_counts


def follow(spark, folder: str, name: str):
    """A table, one file or a folder of files, as a stream of its files."""
    schema = table(spark, folder, name).schema
    # A pattern that only this name fits: as a plain path, a stream takes folders only.
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.[p]arquet")


@query(
    "metrics_stream",
    """WITH days AS (SELECT date_trunc('day', ts) AS day, user_id, event_type, value FROM events)
    SELECT epoch_us(CAST(day AS TIMESTAMP)) AS start_us, user_id AS run_id, event_type AS name, count(*) AS n,
    round(avg(value) + 1e-9, 6) AS mean, max(value) AS "max" FROM days
    WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL""",
)
def metrics_stream(spark, folder):
    place, state = staging_path(spark, "closed"), staging_path(spark, "progress")
    closed = metrics_windows(event_metrics(follow(spark, folder, "events")))
    append_to(closed, place, state).awaitTermination()
    done = spark.read.schema(closed.schema).parquet(place)
    return done.select(
        F.unix_micros("start").alias("start_us"), "run_id", "name", "n",
        six(F.col("mean") + NUDGE).alias("mean"), "max",
    )


@query("vocab_stream", WORD_VOCAB_SQL)
def vocab_stream(spark, folder):
    place, state = staging_path(spark, "counts"), staging_path(spark, "progress")
    follow_counts(follow(spark, folder, "documents"), place, state).awaitTermination()
    built = vocab.ranked_vocab(current_counts(spark, place))
    return built.select("token", *whole("id", "freq"), "is_special")


STREAM_T = 64


@query(
    "pack_stream",
    f"""WITH {CHARS_SQL}, numbered AS (SELECT source, id,
      row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS pos,
      count(*) OVER (PARTITION BY source) AS n FROM stream JOIN documents USING (doc_id)),
    placed AS (
      SELECT source, n, pos // {STREAM_T} AS window_id, pos, id FROM numbered
      UNION ALL SELECT source, n, pos // {STREAM_T} - 1, pos, id FROM numbered
      WHERE pos % {STREAM_T} = 0 AND pos > 0)
    SELECT coalesce(source, '') AS source, window_id,
    string_agg(id, ' ' ORDER BY pos) FILTER (pos < window_id * {STREAM_T} + {STREAM_T}) AS x,
    string_agg(id, ' ' ORDER BY pos) FILTER (pos > window_id * {STREAM_T}) AS y
    FROM placed WHERE window_id < (n - 1) // {STREAM_T} GROUP BY source, window_id""",
)
def pack_stream_query(spark, folder):
    chars = stage(vocab.char_vocab(corpus(spark, folder)), "chars")
    docs = follow(spark, folder, "documents").select("doc_id", "source", "text")
    place, state = staging_path(spark, "windows"), staging_path(spark, "progress")
    pack_stream(docs, place, state, STREAM_T, lambda df: encode_chars(df, chars)).awaitTermination()
    return packed_windows(spark, place).select("source", "window_id", as_text("x").alias("x"), as_text("y").alias("y"))


N_MERGES = 320

# Pieces without look-ahead: a mark goes before the last of several spaces that precede something
# visible, texts are cut at the marks, and what is left of the pattern finds the pieces.
MARK = "chr(1)"
PLAIN_PIECES = r"''(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
def pieces_sql(table: str, key: str, text: str) -> str:
    return f"""
segments AS (SELECT {key} AS key, unnest(parts) AS segment, generate_subscripts(parts, 1) AS s FROM (SELECT {key},
  string_split(regexp_replace({text}, '(\\s+)(\\s\\S)', '\\1' || {MARK} || '\\2', 'g'), {MARK}) AS parts FROM {table})),
found AS (SELECT key, s, regexp_extract_all(segment, '{PLAIN_PIECES}') AS parts FROM segments),
pieces AS MATERIALIZED (SELECT key, s, unnest(parts) AS piece, generate_subscripts(parts, 1) AS i FROM found),
w0 AS MATERIALIZED (SELECT piece, count(*) AS freq, regexp_replace(hex(encode(piece)), '(..)', '<\\1>', 'g') AS word
  FROM pieces GROUP BY piece)"""


def merges_sql(n: int) -> str:
    """CTEs `merges(rank, l, r)` and `spelled(piece, s)` after `pieces_sql`.

    One row of state: all pieces as they are spelled so far, and the merges. Each round adds one merge.
    """
    return f"""
state(key, k, words, found) USING KEY (key) AS (
  SELECT 0, 0, list({{'p': piece, 'w': word, 'f': freq}}), CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[]) FROM w0
  UNION ALL
  SELECT 0, k + 1, list_transform(words, lambda x: {{'p': x.p, 'w': replace(x.w, '<' || m.l || '><' || m.r || '>',
    '<' || m.l || m.r || '>'), 'f': x.f}}), list_append(found, {{'l': m.l, 'r': m.r}})
  FROM state, LATERAL (
    SELECT pair[1] AS l, pair[2] AS r FROM (SELECT x.f AS f, unnest(list_zip(s[:len(s) - 1], s[2:])) AS pair FROM
      (SELECT x, string_split(substring(x.w, 2, length(x.w) - 2), '><') AS s FROM (SELECT unnest(words) AS x)) WHERE len(s) > 1)
    GROUP BY pair ORDER BY sum(f) DESC, l, r LIMIT 1) m
  WHERE k < {n}),
merges AS (SELECT i - 1 AS rank, found[i].l AS l, found[i].r AS r
  FROM (SELECT found, unnest(range(1, len(found) + 1)) AS i FROM state)),
spelled AS (SELECT x.p AS piece, string_split(substring(x.w, 2, length(x.w) - 2), '><') AS s
  FROM (SELECT unnest(words) AS x FROM state))"""


MERGES_SQL = pieces_sql("documents", "doc_id", "text") + "," + merges_sql(N_MERGES)
BYTES_SQL = ", ".join(f"('{b:02X}', {i})" for i, b in enumerate(bpe.BYTE_ORDER))


def merges_of(spark, folder):
    """The merges of a folder, learned once per session and state of its files."""
    return once(table(spark, folder, "documents"), "merges", lambda: stage(bpe.train_bpe(corpus(spark, folder), N_MERGES), "merges"))


@query(
    "bpe_train",
    f"""WITH RECURSIVE {MERGES_SQL} SELECT CAST(rank AS INTEGER) AS rank, l AS "left", r AS "right", l || r AS merged FROM merges""",
)
def bpe_train(spark, folder):
    return merges_of(spark, folder)


# CTE `coded_rows(key, ids)`: the ids of every text.
CODED_SQL = f"""
ids AS (SELECT symbol, min(id) AS id FROM (SELECT * FROM (VALUES {BYTES_SQL}) b(symbol, id)
  UNION ALL SELECT l || r, 256 + rank FROM merges) GROUP BY symbol),
parts AS (SELECT piece, unnest(s) AS symbol, generate_subscripts(s, 1) AS k FROM spelled),
coded AS (SELECT piece, list(id ORDER BY k) AS ids FROM parts JOIN ids USING (symbol) GROUP BY piece),
coded_rows AS (SELECT key, flatten(list(ids ORDER BY s, i)) AS ids FROM pieces JOIN coded USING (piece) GROUP BY key)"""


@query(
    "bpe_encode",
    f"""WITH RECURSIVE {MERGES_SQL}, {CODED_SQL}
    SELECT doc_id, coalesce(len(ids), 0) AS n_ids, coalesce(array_to_string(ids, ' '), '') AS ids
    FROM documents LEFT JOIN coded_rows ON key = doc_id""",
)
def bpe_encode(spark, folder):
    encoded = bpe.encode_bpe(corpus(spark, folder), merges_of(spark, folder))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), as_text("ids").alias("ids"))


@query("bpe_decode", "SELECT doc_id, text FROM documents")
def bpe_decode(spark, folder):
    merges = merges_of(spark, folder)
    encoded = bpe.encode_bpe(corpus(spark, folder), merges)
    return bpe.decode_bpe(encoded, merges).select("doc_id", F.col("decoded").alias("text"))


UDF_MERGES = 24


@query(
    "text_udf",
    f"""WITH RECURSIVE {PAIRS_SQL}, {word_edits_sql("pairs", "pair_id", "src", "trg")},
    counted AS (SELECT pair_id, count(*) AS n_words, count(DISTINCT token) AS n_distinct FROM aw GROUP BY pair_id),
    {pieces_sql("pairs", "pair_id", "src")}, {merges_sql(UDF_MERGES)}, {CODED_SQL}
    SELECT pair_id, length(src) AS n_chars, coalesce(n_words, 0) AS n_words, coalesce(n_distinct, 0) AS n_distinct,
    CAST(d AS BIGINT) AS edits, round(d / nullif(n, 0), 6) AS wer, coalesce(array_to_string(ids, ' '), '') AS ids
    FROM pairs LEFT JOIN counted USING (pair_id) LEFT JOIN distances USING (pair_id)
    LEFT JOIN coded_rows ON coded_rows.key = pair_id""",
)
def text_udf(spark, folder):
    pairs = pairs_table(spark, folder)
    register_text_functions(spark, bpe.train_bpe(pairs, UDF_MERGES, "src"))
    return spark.sql(
        """SELECT pair_id, CAST(size(char_tokenize(src)) AS BIGINT) n_chars,
        CAST(size(word_tokenize(src)) AS BIGINT) n_words,
        CAST(size(array_distinct(word_tokenize(src))) AS BIGINT) n_distinct,
        CAST(word_edits(src, trg) AS BIGINT) edits, round(wer(src, trg), 6) wer,
        array_join(bpe_encode(src), ' ') ids FROM {pairs}""",
        pairs=pairs,
    )
