"""Characters and words: scanning, vocabularies, encoding, positions and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import char_tokens, word_tokens
from tokenloom.operators import packing, splits, vocab
from tokenloom.operators.packing import Encoder
from tokenloom.operators.encode import CharEncoder, decode_chars, decode_words, encode_chars, encode_words
from tokenloom.operators.positions import StreamIndex, stream_index
from tokenloom.plans.registry import CHARS_SQL, as_text, query, vocab_sql, whole, words_sql
from tokenloom.session import spread, stage, staging_path
from tokenloom.sources.corpus import read_corpus, table, turn_key
from tokenloom.sources.vocab_store import load_or_build_vocab

WORDS_SQL = words_sql("documents", "doc_id", "text", "words")
VOCAB_SQL = vocab_sql("words", "vocab")
SEED = 42


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return read_corpus(spark, f"{folder}/documents.parquet")


def char_texts(spark: SparkSession, folder: str) -> tuple[DataFrame, Encoder]:
    """Documents as text, and what makes them character ids."""
    docs = corpus(spark, folder)
    chars = stage(vocab.char_vocab(docs), "chars")
    return docs, CharEncoder(chars)


def char_blocks(spark: SparkSession, folder: str, T: int) -> packing.TokenBlocks:
    docs, encode = char_texts(spark, folder)
    return packing.token_blocks(docs, "doc_id", T, encode)


def char_stream(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, StreamIndex]:
    """Documents as character ids, the vocabulary, and where the documents lie in the stream."""
    docs = corpus(spark, folder)
    chars = stage(vocab.char_vocab(docs), "chars")
    return encode_chars(docs, chars).drop("text"), chars, stream_index(docs, "doc_id", F.length("text"))


@query("corpus_scan", "SELECT doc_id, text FROM documents")
def corpus_scan(spark, folder):
    return corpus(spark, folder)


@query(
    "corpus_profile",
    """SELECT (SELECT count(*) FROM documents) AS docs,
    (SELECT CAST(sum(length(text)) AS BIGINT) FROM documents) AS chars,
    (SELECT count(DISTINCT ch) FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents)) AS vocab_size,
    (SELECT substring(text, 1, 1000) FROM documents ORDER BY doc_id LIMIT 1) AS preview""",
)
def corpus_profile(spark, folder):
    docs = corpus(spark, folder)
    facts = docs.agg(
        F.count("*").alias("docs"),
        F.sum(F.length("text")).alias("chars"),
        F.min_by(F.substring("text", 1, 1000), "doc_id").alias("preview"),
    )
    size = vocab.char_vocab(docs).agg(F.count("*").alias("vocab_size"))
    return facts.withColumn("vocab_size", size.scalar()).select(
        *whole("docs", "chars", "vocab_size"), "preview"
    )


@query(
    "char_tokens",
    """SELECT doc_id, CAST(len(string_split(text, '')) AS BIGINT) AS n_tokens,
    md5(array_to_string(string_split(text, ''), '|')) AS tokens_md5 FROM documents""",
)
def char_tokens_query(spark, folder):
    tokens = corpus(spark, folder).select("doc_id", char_tokens(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("tokens", "|")).alias("tokens_md5"),
    )


@query(
    "word_tokens",
    f"""WITH {WORDS_SQL} SELECT doc_id, count(token) AS n_tokens, coalesce(string_agg(token, ' ' ORDER BY i), '') AS tokens
    FROM documents LEFT JOIN words USING (doc_id) GROUP BY doc_id""",
)
def word_tokens_query(spark, folder):
    tokens = corpus(spark, folder).select("doc_id", word_tokens(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


@query("char_vocab", f"WITH {CHARS_SQL} SELECT ch AS token, id FROM vocab")
def char_vocab(spark, folder):
    return vocab.char_vocab(corpus(spark, folder)).select("token", *whole("id"))


@query(
    "char_encode",
    f"""WITH {CHARS_SQL} SELECT doc_id, count(*) AS n_ids, md5(string_agg(id, ' ' ORDER BY i)) AS ids_md5
    FROM stream GROUP BY doc_id""",
)
def char_encode(spark, folder):
    docs = corpus(spark, folder)
    encoded = encode_chars(docs, vocab.char_vocab(docs))
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.md5(as_text("ids")).alias("ids_md5")
    )


@query("char_decode", "SELECT doc_id, text FROM documents")
def char_decode(spark, folder):
    docs = corpus(spark, folder)
    chars = stage(vocab.char_vocab(docs), "chars")
    return decode_chars(encode_chars(docs, chars), chars).select("doc_id", F.col("decoded").alias("text"))


WORD_VOCAB_SQL = f"""WITH {WORDS_SQL}, {VOCAB_SQL}
    SELECT token, id, CAST(freq AS BIGINT) AS freq, false AS is_special FROM vocab
    UNION ALL SELECT * FROM (VALUES ('[UNK]', 0, 0, true), ('[PAD]', 1, 0, true),
    ('[SOS]', 2, 0, true), ('[EOS]', 3, 0, true))"""


@query("word_vocab", WORD_VOCAB_SQL)
def word_vocab(spark, folder):
    built = vocab.word_vocab(corpus(spark, folder))
    return built.select("token", *whole("id", "freq"), "is_special")


@query("vocab_store", WORD_VOCAB_SQL)
def vocab_store(spark, folder):
    docs = corpus(spark, folder)
    place = staging_path(spark, "vocab")
    load_or_build_vocab(docs, place)
    again = load_or_build_vocab(docs, place)
    return again.select("token", *whole("id", "freq"), "is_special")


@query(
    "token_id_join",
    f"""WITH {words_sql("documents", "doc_id, lang", "text", "words")}, {VOCAB_SQL}
    SELECT lang, count(*) AS n_tokens, count(*) - count(vocab.id) AS n_unknown,
    round((count(*) - count(vocab.id)) / count(*), 6) AS unknown_rate
    FROM words LEFT JOIN vocab USING (token) GROUP BY lang""",
)
def token_id_join(spark, folder):
    docs = spread(table(spark, folder, "documents").select("lang", "text"))
    counts = stage(vocab.word_counts(docs, by=["lang"]), "counts")  # texts are cut into words once
    words = vocab.ranked_vocab(counts.groupBy("token").agg(F.sum("freq").alias("freq")))
    return vocab.coverage(docs, stage(words, "words"), "lang", counts=counts)


@query(
    "word_encode",
    f"""WITH {WORDS_SQL}, {VOCAB_SQL}
    SELECT doc_id, count(token) AS n_ids,
    coalesce(string_agg(coalesce(id, 0), ' ' ORDER BY i) FILTER (token IS NOT NULL), '') AS ids
    FROM documents LEFT JOIN words USING (doc_id) LEFT JOIN vocab USING (token) GROUP BY doc_id""",
)
def word_encode(spark, folder):
    docs = corpus(spark, folder)
    encoded = encode_words(docs, stage(vocab.word_vocab(docs), "words"), "doc_id", keep_text=False)
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), as_text("ids").alias("ids")
    )


@query(
    "word_decode",
    f"""WITH {WORDS_SQL}, {VOCAB_SQL}
    SELECT doc_id, coalesce(string_agg(token, ' ' ORDER BY i) FILTER (id IS NOT NULL), '') AS decoded
    FROM documents LEFT JOIN words USING (doc_id) LEFT JOIN vocab USING (token) GROUP BY doc_id""",
)
def word_decode(spark, folder):
    docs = corpus(spark, folder)
    words = stage(vocab.word_vocab(docs), "words")
    encoded = encode_words(docs, words, "doc_id", keep_text=False)
    return decode_words(encoded, words, "doc_id", keep_ids=False).select("doc_id", "decoded")


@query(
    "token_offsets",
    """SELECT doc_id, length(text) AS n_tokens,
    CAST(sum(length(text)) OVER (ORDER BY doc_id) - length(text) AS BIGINT) AS "offset",
    CAST(sum(length(text)) OVER () AS BIGINT) AS total FROM documents""",
)
def token_offsets(spark, folder):
    index = stream_index(corpus(spark, folder), "doc_id", F.length("text"))
    return index.offsets.select(
        "doc_id", F.col("size").alias("n_tokens"), "offset", F.lit(index.total).cast("bigint").alias("total")
    )


def _windows_sql(B: int, T: int) -> str:
    """CTE `windows` of full batches; position p lies in window p // T, and may be a last target."""
    return f"""full_rows AS (SELECT greatest(n - 1, 0) // {B * T} * {B} AS rows FROM size),
    placed AS (
      SELECT pos // {T} AS window_id, pos, id FROM stream
      UNION ALL SELECT pos // {T} - 1, pos, id FROM stream WHERE pos % {T} = 0 AND pos > 0),
    windows AS (
      SELECT window_id, window_id // {B} AS batch_id, window_id % {B} AS "row",
      string_agg(id, ' ' ORDER BY pos) FILTER (pos < window_id * {T} + {T}) AS x,
      string_agg(id, ' ' ORDER BY pos) FILTER (pos > window_id * {T}) AS y
      FROM placed WHERE window_id < (SELECT rows FROM full_rows) GROUP BY window_id)"""


B, T = 4, 64
WINDOWS_SQL = f"{CHARS_SQL}, {_windows_sql(B, T)}"


@query("pack_windows", f"WITH {WINDOWS_SQL} SELECT * FROM windows")
def pack_windows(spark, folder):
    return packing.pack_windows(char_blocks(spark, folder, T), B).select(
        "window_id", "batch_id", "row", as_text("x").alias("x"), as_text("y").alias("y")
    )


@query(
    "next_token",
    f"""WITH {CHARS_SQL}, shifted AS (
      SELECT doc_id, i, id, lead(id) OVER (PARTITION BY doc_id ORDER BY i) AS next_id FROM stream)
    SELECT doc_id, count(next_id) AS n_pairs,
    md5(coalesce(string_agg(id, ' ' ORDER BY i) FILTER (next_id IS NOT NULL), '')) AS x_md5,
    md5(coalesce(string_agg(next_id, ' ' ORDER BY i), '')) AS y_md5
    FROM documents LEFT JOIN shifted USING (doc_id) GROUP BY doc_id""",
)
def next_token(spark, folder):
    docs = corpus(spark, folder)
    shifted = packing.next_tokens(encode_chars(docs, vocab.char_vocab(docs)))
    return shifted.select(
        "doc_id",
        F.size("x").cast("bigint").alias("n_pairs"),
        F.md5(as_text("x")).alias("x_md5"),
        F.md5(as_text("y")).alias("y_md5"),
    )


@query(
    "epoch_plan",
    f"""WITH {CHARS_SQL} SELECT n AS n_tokens, greatest(n - 1, 0) // {B * T} AS n_batches,
    greatest(n - 1, 0) // {B * T} * {B} AS n_windows,
    n - greatest(n - 1, 0) // {B * T} * {B * T} AS tail_tokens, CAST(32 AS BIGINT) AS micro_batches FROM size""",
)
def epoch_plan(spark, folder):
    index = stream_index(corpus(spark, folder), "doc_id", F.length("text"))
    return packing.epoch_plan(index, B, T, 32 * B * T)


SPLIT_ROWS_SQL = """SELECT doc_id, split, count(*) AS n_tokens, md5(string_agg(id, ' ' ORDER BY pos)) AS ids_md5
    FROM parts WHERE split IS NOT NULL GROUP BY doc_id, split"""


def _split_rows(parts: DataFrame) -> DataFrame:
    return parts.select(
        "doc_id", "split", F.size("ids").cast("bigint").alias("n_tokens"), F.md5(as_text("ids")).alias("ids_md5")
    )


@query(
    "prefix_split",
    f"""WITH {CHARS_SQL}, parts AS (
      SELECT *, CASE WHEN pos < floor(CAST(0.9 AS DOUBLE) * n) THEN 'train' ELSE 'val' END AS split
      FROM stream, size) {SPLIT_ROWS_SQL}""",
)
def prefix_split(spark, folder):
    docs, _, index = char_stream(spark, folder)
    return _split_rows(splits.prefix_split(docs, index, 0.9))


@query(
    "tiny_subset",
    f"""WITH {CHARS_SQL}, parts AS (
      SELECT *, CASE WHEN pos < floor(CAST(0.01 AS DOUBLE) * n) THEN 'train'
        WHEN pos < floor(CAST(0.015 AS DOUBLE) * n) THEN 'val' END AS split
      FROM stream, size) {SPLIT_ROWS_SQL}""",
)
def tiny_subset(spark, folder):
    docs, _, index = char_stream(spark, folder)
    return _split_rows(splits.tiny_subset(docs, index, 0.01, 0.005))


@query(
    "random_split",
    f"""WITH ranked AS (
      SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws('|', doc_id, '{SEED}')), doc_id) AS r,
      count(*) OVER () AS n FROM documents)
    SELECT doc_id, CASE WHEN r <= floor(CAST(0.9 AS DOUBLE) * n) THEN 'train' ELSE 'val' END AS split
    FROM ranked""",
)
def random_split(spark, folder):
    return splits.random_split(corpus(spark, folder), "doc_id", 0.9, SEED).select("doc_id", "split")


@query(
    "split_leakage",
    f"""WITH ranked AS (
      SELECT doc_id, text, row_number() OVER (ORDER BY md5(concat_ws('|', doc_id, '{SEED}')), doc_id) AS r,
      count(*) OVER () AS n FROM documents),
    parts AS (SELECT doc_id, text, r <= floor(CAST(0.9 AS DOUBLE) * n) AS train FROM ranked)
    SELECT v.doc_id, count(*) AS n_train FROM parts v JOIN parts t ON v.text = t.text AND t.train
    WHERE NOT v.train GROUP BY v.doc_id""",
)
def split_leakage(spark, folder):
    parts = splits.random_split(corpus(spark, folder), "doc_id", 0.9, SEED)
    return splits.split_leakage(parts, "doc_id", "text")


PARTS_SQL = f"""ranked AS (
      SELECT doc_id, text, row_number() OVER (ORDER BY md5(concat_ws('|', doc_id, '{SEED}')), doc_id) AS r,
      count(*) OVER () AS n FROM documents),
    parts AS (SELECT doc_id, text, CASE WHEN r <= floor(CAST(0.9 AS DOUBLE) * n) THEN 'train' ELSE 'val' END AS split FROM ranked)"""


@query(
    "clean_split",
    f"""WITH {PARTS_SQL} SELECT doc_id, split FROM parts
    WHERE split = 'train' OR text NOT IN (SELECT text FROM parts WHERE split = 'train')""",
)
def clean_split(spark, folder):
    parts = splits.random_split(corpus(spark, folder), "doc_id", 0.9, SEED)
    return splits.drop_leakage(parts, "doc_id", "text").select("doc_id", "split")


@query(
    "train_vocab",
    f"""WITH {PARTS_SQL}, train AS (SELECT doc_id, text FROM parts WHERE split = 'train'),
    {words_sql("train", "doc_id", "text", "words")}, {VOCAB_SQL}
    SELECT token, id, CAST(freq AS BIGINT) AS freq, false AS is_special FROM vocab
    UNION ALL SELECT * FROM (VALUES ('[UNK]', 0, 0, true), ('[PAD]', 1, 0, true),
    ('[SOS]', 2, 0, true), ('[EOS]', 3, 0, true))""",
)
def train_vocab(spark, folder):
    parts = splits.random_split(corpus(spark, folder), "doc_id", 0.9, SEED)
    built = vocab.fit_vocab(parts, fit_on="train")
    return built.select("token", *whole("id", "freq"), "is_special")


@query(
    "random_windows",
    f"""WITH {CHARS_SQL}, samples AS (
      SELECT id AS sample_id, CAST(('0x' || substring(md5(concat_ws('|', id, '{SEED}')), 1, 15)) AS BIGINT)
        % (n - {T}) AS start FROM size, LATERAL (SELECT unnest(range(n // 1000)) AS id)),
    wanted AS (SELECT sample_id, start, start + unnest(range({T + 1})) AS pos FROM samples)
    SELECT sample_id, start, string_agg(id, ' ' ORDER BY pos) FILTER (pos < start + {T}) AS x,
    string_agg(id, ' ' ORDER BY pos) FILTER (pos > start) AS y
    FROM wanted JOIN stream USING (pos) GROUP BY sample_id, start""",
)
def random_windows(spark, folder):
    docs, encode = char_texts(spark, folder)
    index = stream_index(docs, "doc_id", F.length("text"))
    sampled = packing.random_windows(docs, index, index.total // 1000, T, SEED, encode=encode)
    return sampled.select("sample_id", "start", as_text("x").alias("x"), as_text("y").alias("y"))


@query(
    "batch_cursor",
    f"""WITH {WINDOWS_SQL}, batches AS (SELECT rows // {B} AS n FROM full_rows),
    steps AS (SELECT s AS step, (s + 5) % n AS batch_id, (s + 5) // n AS epoch
      FROM batches, LATERAL (SELECT unnest(range(n + 3)) AS s))
    SELECT step, epoch, batch_id, "row", x, y FROM steps JOIN windows USING (batch_id)""",
)
def batch_cursor(spark, folder):
    stream = char_blocks(spark, folder, T)
    windows = packing.pack_windows(stream, B)
    n_batches = max(0, stream.total - 1) // (B * T)
    stepped = packing.batches_for_steps(windows, n_batches, 5, n_batches + 3)
    return stepped.select("step", "epoch", "batch_id", "row", as_text("x").alias("x"), as_text("y").alias("y"))


TURNS_SQL = """
turn_texts AS (SELECT conv_id * 1048576 + turn AS doc_id, text FROM conversations),
split_text AS (SELECT doc_id, string_split(text, '') AS parts FROM turn_texts WHERE text <> ''),
tok AS (SELECT doc_id, unnest(parts) AS ch, generate_subscripts(parts, 1) AS i FROM split_text),
vocab AS (SELECT ch, row_number() OVER (ORDER BY ch) - 1 AS id FROM (SELECT DISTINCT ch FROM tok)),
stream AS (SELECT doc_id, i, id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos FROM tok JOIN vocab USING (ch)),
size AS (SELECT count(*) AS n FROM stream)
"""


@query(
    "prefix_examples",
    f"""WITH {TURNS_SQL}, full_rows AS (SELECT greatest(n - 1, 0) // 32 * 4 AS rows FROM size),
    targets AS (SELECT (pos - 1) // 8 AS window_id, (pos - 1) % 8 AS t, pos, id AS target FROM stream
      WHERE pos > 0 AND (pos - 1) // 8 < (SELECT rows FROM full_rows))
    SELECT window_id, t, string_agg(stream.id, ' ' ORDER BY stream.pos) AS context, target
    FROM targets JOIN stream ON stream.pos // 8 = window_id AND stream.pos < targets.pos
    GROUP BY window_id, t, target""",
)
def prefix_examples(spark, folder):
    turns = spread(table(spark, folder, "conversations")).select(
        turn_key(F.col("conv_id"), F.col("turn")).alias("doc_id"), "text"
    )
    chars = stage(vocab.char_vocab(turns), "chars")
    stream = packing.token_blocks(turns, "doc_id", 8, CharEncoder(chars))
    windows = packing.pack_windows(stream, 4).select("window_id", "x", "y")
    return packing.prefix_expand(windows).select(
        "window_id", *whole("t"), as_text("context").alias("context"), *whole("target")
    )
