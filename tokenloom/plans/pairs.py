"""Sentence pairs: padded examples, word translation and its scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators import bigram, evaluation, examples, splits, translation, vocab
from tokenloom.operators.encode import decode_words
from tokenloom.plans.corpus import SEED
from tokenloom.plans.registry import as_text, query, six, vocab_sql, whole, words_sql
from tokenloom.session import once, spread, stage, staging_path
from tokenloom.sources.corpus import read_pairs, table, turn_pairs
from tokenloom.sources.predictions import predictions, save_predictions

SEQ_LEN, SHORT = 350, 64

PAIRS_SQL = """
pairs AS (SELECT a.conv_id * 1048576 + a.turn AS pair_id, a.text AS src, b.text AS trg
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant')"""
IDS_SQL = f"""{PAIRS_SQL},
{words_sql("pairs", "pair_id", "src", "src_words")}, {words_sql("pairs", "pair_id", "trg", "trg_words")},
{vocab_sql("src_words", "src_vocab")}, {vocab_sql("trg_words", "trg_vocab")},
src_ids AS (SELECT pair_id, i, coalesce(id, 0) AS id FROM src_words LEFT JOIN src_vocab USING (token)),
trg_ids AS (SELECT pair_id, i, coalesce(id, 0) AS id FROM trg_words LEFT JOIN trg_vocab USING (token)),
encoded AS (
  SELECT pair_id, src, trg, coalesce(s.ids, []) AS s, coalesce(t.ids, []) AS t FROM pairs
  LEFT JOIN (SELECT pair_id, list(id ORDER BY i) AS ids FROM src_ids GROUP BY pair_id) s USING (pair_id)
  LEFT JOIN (SELECT pair_id, list(id ORDER BY i) AS ids FROM trg_ids GROUP BY pair_id) t USING (pair_id))"""


def _padded_sql(tokens: str) -> str:
    return f"""array_to_string({tokens} || list_transform(range(seq_len - len({tokens})), lambda q: 1), ' ')"""


# Long enough for every pair: no pair is left out.
EXAMPLES_SQL = f"""{IDS_SQL},
lens AS (SELECT greatest({SEQ_LEN}, max(len(s)) + 2, max(len(t)) + 1) AS seq_len FROM encoded),
fitting AS (SELECT *, [2] || s || [3] AS e, [2] || t AS d, t || [3] AS l FROM encoded, lens)"""


def pairs_table(spark, folder) -> DataFrame:
    return read_pairs(turn_pairs(spread(table(spark, folder, "conversations"))), "user", "assistant")


def encoded_pairs(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    pairs = pairs_table(spark, folder)
    src, trg = vocab.word_vocab(pairs, "src"), stage(vocab.word_vocab(pairs, "trg"), "words")
    return examples.encode_pairs(pairs, src, trg), src, trg


def _whole_length(encoded: DataFrame) -> int:
    """A sequence length that every pair fits, at least SEQ_LEN."""
    most = encoded.agg(F.max(F.size("src_ids")), F.max(F.size("trg_ids"))).first()
    return max(SEQ_LEN, (most[0] or 0) + 2, (most[1] or 0) + 1)


def _examples(spark, folder) -> DataFrame:
    encoded = stage(encoded_pairs(spark, folder)[0], "encoded")
    length = _whole_length(encoded)
    kept, _ = examples.length_guard(encoded, length, "error")
    return examples.assemble_examples(kept, length)


@query("parallel_scan", f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def parallel_scan(spark, folder):
    return pairs_table(spark, folder)


@query(
    "length_profile",
    f"""WITH {IDS_SQL},
    sized AS (SELECT len(s) AS a, len(t) AS b, row_number() OVER (ORDER BY len(s)) AS ra,
      row_number() OVER (ORDER BY len(t)) AS rb, count(*) OVER () AS n FROM encoded)
    SELECT max(a) AS max_src, min(a) AS min_src, round(avg(a), 6) AS avg_src,
    min(a) FILTER (ra >= ceil(0.95 * n)) AS p95_src, max(b) AS max_trg, min(b) AS min_trg,
    round(avg(b), 6) AS avg_trg, min(b) FILTER (rb >= ceil(0.95 * n)) AS p95_trg FROM sized""",
)
def length_profile(spark, folder):
    profile = examples.length_profile(encoded_pairs(spark, folder)[0])
    return profile.select(
        *whole("max_src", "min_src", "p95_src", "max_trg", "min_trg", "p95_trg"),
        six(F.col("avg_src")).alias("avg_src"),
        six(F.col("avg_trg")).alias("avg_trg"),
    )


@query(
    "length_guard",
    f"""WITH {IDS_SQL} SELECT pair_id, len(s) AS n_src, len(t) AS n_trg,
    CASE WHEN len(s) > {SHORT} - 2 THEN 'source too long' WHEN len(t) > {SHORT} - 1 THEN 'target too long'
      ELSE 'kept' END AS status FROM encoded""",
)
def length_guard(spark, folder):
    kept, rejected = examples.length_guard(encoded_pairs(spark, folder)[0], SHORT)
    both = kept.withColumn("reason", F.lit("kept")).unionByName(rejected)
    return both.select(
        "pair_id",
        F.size("src_ids").cast("bigint").alias("n_src"),
        F.size("trg_ids").cast("bigint").alias("n_trg"),
        F.col("reason").alias("status"),
    )


@query(
    "seq2seq_examples",
    f"""WITH {EXAMPLES_SQL} SELECT pair_id, {_padded_sql("e")} AS encoder_input,
    {_padded_sql("d")} AS decoder_input, {_padded_sql("l")} AS label_output,
    len(e) AS enc_len, len(d) AS dec_len, src AS src_text, trg AS trg_text FROM fitting""",
)
def seq2seq_examples(spark, folder):
    inputs = ["encoder_input", "decoder_input", "label_output"]
    return _examples(spark, folder).select(
        "pair_id", *[as_text(c).alias(c) for c in inputs], *whole("enc_len", "dec_len"), "src_text", "trg_text"
    )


@query(
    "padding_mask",
    f"""WITH {EXAMPLES_SQL} SELECT pair_id, repeat('1', len(e)) || repeat('0', seq_len - len(e)) AS encoder_mask,
    repeat('1', len(d)) || repeat('0', seq_len - len(d)) AS decoder_mask FROM fitting""",
)
def padding_mask(spark, folder):
    masks = {"encoder_mask": "encoder_input", "decoder_mask": "decoder_input"}
    return _examples(spark, folder).select(
        "pair_id", *[F.array_join(examples.padding_mask(ids).cast("array<string>"), "").alias(m) for m, ids in masks.items()]
    )


@query(
    "causal_mask",
    f"""WITH {EXAMPLES_SQL}, places AS (SELECT pair_id, len(d) AS n, unnest(range(seq_len)) AS q_pos FROM fitting)
    SELECT pair_id, q_pos, least(q_pos + 1, n) AS visible FROM places""",
)
def causal_mask(spark, folder):
    return examples.causal_mask(_examples(spark, folder)).select("pair_id", *whole("q_pos", "visible"))


@query(
    "shuffle_batches",
    f"""WITH {PAIRS_SQL}, ranked AS (
      SELECT pair_id, row_number() OVER (ORDER BY md5(concat_ws('|', pair_id, '{SEED}', '3')), pair_id) - 1 AS r FROM pairs)
    SELECT pair_id, r // 8 AS batch_id, r % 8 AS "row" FROM ranked""",
)
def shuffle_batches(spark, folder):
    batched = splits.shuffle_batches(pairs_table(spark, folder), "pair_id", 8, SEED, 3)
    return batched.select("pair_id", "batch_id", *whole("row"))


SMOOTHED_SQL = f"""{EXAMPLES_SQL},
frames AS (SELECT pair_id, unnest([2] || t) AS prev, unnest(t || [3]) AS next FROM fitting),
sizes AS (SELECT count(*) + 4 AS v FROM trg_vocab),
counts AS (SELECT prev, next, count(*) AS n FROM frames GROUP BY ALL),
contexts AS (SELECT prev, sum(n) AS total, count(*) AS kinds FROM counts GROUP BY prev),
spread AS (SELECT prev, sum(ln((n + 1) / (total + v))) + (max(v) - max(kinds)) * ln(1 / (max(total) + max(v))) AS logs
  FROM counts JOIN contexts USING (prev), sizes GROUP BY prev)
SELECT CAST(sum(n) AS BIGINT) AS positions, round(sum(n * (-0.9 * ln((n + 1) / (total + v)) - 0.1 / v * logs)) / sum(n), 6) AS loss
FROM counts JOIN contexts USING (prev) JOIN spread USING (prev), sizes"""


@query("smoothed_loss", f"WITH {SMOOTHED_SQL}")
def smoothed_loss(spark, folder):
    encoded, _, words = encoded_pairs(spark, folder)
    kept = stage(encoded, "encoded")
    length = _whole_length(kept)
    size = words.count()
    counts = bigram.pair_counts(bigram.framed(kept, "trg_ids"), [], "trg_ids")
    model = stage(bigram.fit_bigram(counts, size), "model")
    loss = bigram.smoothed_loss(examples.assemble_examples(kept, length), model, size)
    return loss.select("positions", six(F.col("loss")).alias("loss"))


ITERS = 5
TRAIN_SHARE = 0.9
PARTS_SQL = f"""{IDS_SQL},
ranked AS (SELECT pair_id, row_number() OVER (ORDER BY md5(concat_ws('|', pair_id, '{SEED}')), pair_id) AS r,
  count(*) OVER () AS n FROM pairs),
parts AS (SELECT pair_id, r <= floor(CAST({TRAIN_SHARE} AS DOUBLE) * n) AS train FROM ranked)"""


def _lexical_sql(only_train: bool) -> str:
    where = " WHERE pair_id IN (SELECT pair_id FROM parts WHERE train)" if only_train else ""
    return f"""{PARTS_SQL},
src_types AS (SELECT pair_id, id AS src, count(*) AS ns FROM src_ids GROUP BY ALL),
trg_types AS (SELECT pair_id, id AS trg, count(*) AS nt FROM trg_ids GROUP BY ALL),
met AS (SELECT * FROM src_types JOIN trg_types USING (pair_id){where}),
t0 AS (SELECT DISTINCT src, trg, CAST(1 AS DOUBLE) AS p FROM met)""" + "".join(
        f""",
e{k} AS (SELECT src, trg, nt * ns * p / sum(ns * p) OVER (PARTITION BY pair_id, trg) AS share
  FROM met JOIN t{k - 1} USING (src, trg)),
g{k} AS (SELECT src, trg, sum(share) AS share FROM e{k} GROUP BY ALL),
t{k} AS (SELECT src, trg, share / sum(share) OVER (PARTITION BY src) AS p FROM g{k})"""
        for k in range(1, ITERS + 1)
    )


@query(
    "lexical_translation",
    f"WITH {_lexical_sql(False)} SELECT src, trg, round(p, 6) AS p FROM t{ITERS}",
)
def lexical_translation(spark, folder):
    encoded = stage(encoded_pairs(spark, folder)[0], "encoded")
    fitted = translation.fit_lexical(encoded, ITERS)
    return fitted.select(*whole("src", "trg"), six(F.col("p")).alias("p"))


PREDICTED_SQL = f"""{_lexical_sql(True)},
best AS (SELECT src, arg_min(trg, (-round(p, 9), trg)) AS trg FROM t{ITERS} WHERE trg > 3 GROUP BY src),
held AS (SELECT * FROM pairs WHERE pair_id IN (SELECT pair_id FROM parts WHERE NOT train)),
moved AS (SELECT pair_id, i, coalesce(trg, 0) AS id FROM src_ids LEFT JOIN best ON best.src = src_ids.id),
texts AS (SELECT pair_id, coalesce(string_agg(token, ' ' ORDER BY i) FILTER (token IS NOT NULL), '') AS predicted
  FROM moved LEFT JOIN trg_vocab USING (id) GROUP BY pair_id),
predictions AS (SELECT pair_id AS id, src AS source, trg AS expected, coalesce(predicted, '') AS predicted
  FROM held LEFT JOIN texts USING (pair_id))"""


def predicted(spark, folder) -> DataFrame:
    """Held-out pairs translated by the model of the training pairs; made once per session and state of the files."""

    def make() -> DataFrame:
        encoded, _, words = encoded_pairs(spark, folder)
        parts = stage(splits.random_split(encoded, "pair_id", TRAIN_SHARE, SEED), "encoded")
        fitted = translation.fit_lexical(parts.filter("split = 'train'"), ITERS)
        made = translation.translate_greedy(parts.filter("split = 'val'"), fitted)
        decoded = decode_words(made, words, "pair_id", "pred_ids", "predicted")
        return stage(predictions(decoded, "pair_id", "src", "trg", "predicted"), "predictions")

    return once(table(spark, folder, "conversations"), "predictions", make)


@query("translate_greedy", f"WITH {PREDICTED_SQL} SELECT * FROM predictions")
def translate_greedy(spark, folder):
    return predicted(spark, folder)


@query("prediction_table", f"WITH {PREDICTED_SQL} SELECT * FROM predictions")
def prediction_table(spark, folder):
    place = staging_path(spark, "saved")
    save_predictions(predicted(spark, folder), place)
    return spark.read.parquet(place).select("id", "source", "expected", "predicted")


# The comparison engine's edit distance counts bytes, so it is asked about the texts with every distinct
# character spelled as one byte of its own, which leaves all distances as they are.
CER_SQL = f"""{PREDICTED_SQL},
sides AS (SELECT id, 'a' AS side, predicted AS text FROM predictions UNION ALL SELECT id, 'b', expected FROM predictions),
letters AS (SELECT id, side, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i
  FROM sides WHERE text <> ''),
codes AS (SELECT ch, CASE WHEN k < 128 THEN chr(CAST(k AS INTEGER)) ELSE error('too many characters') END AS code
  FROM (SELECT ch, row_number() OVER (ORDER BY ch) AS k FROM (SELECT DISTINCT ch FROM letters))),
spelled AS (SELECT id, side, string_agg(code, '' ORDER BY i) AS text FROM letters JOIN codes USING (ch) GROUP BY id, side),
both_texts AS (SELECT id, coalesce(a.text, '') AS a, coalesce(b.text, '') AS b FROM predictions
  LEFT JOIN (SELECT * FROM spelled WHERE side = 'a') a USING (id) LEFT JOIN (SELECT * FROM spelled WHERE side = 'b') b USING (id))
SELECT CAST(sum(levenshtein(a, b)) AS BIGINT) AS edits, CAST(sum(length(b)) AS BIGINT) AS length,
round(sum(levenshtein(a, b)) / sum(length(b)), 6) AS cer FROM both_texts"""


@query("char_error_rate", f"WITH {CER_SQL}")
def char_error_rate(spark, folder):
    rate = evaluation.char_error_rate(predicted(spark, folder))
    return rate.select(*whole("edits", "length"), six(F.col("cer")).alias("cer"))


def word_edits_sql(table: str, key: str, a: str, b: str) -> str:
    """CTE `distances(key, d, n)`: word edits of two columns, and the words of the second.

    Row by row: `line` has the distances of the words so far to every prefix of b.
    """
    return f"""
{words_sql(table, key, a, "aw")}, {words_sql(table, key, b, "bw")},
names AS (SELECT token, row_number() OVER () AS k FROM
  (SELECT DISTINCT token FROM (SELECT token FROM aw UNION ALL SELECT token FROM bw))),
al AS (SELECT {key}, list(k ORDER BY i) AS a FROM aw JOIN names USING (token) GROUP BY {key}),
bl AS (SELECT {key}, list(k ORDER BY i) AS b FROM bw JOIN names USING (token) GROUP BY {key}),
both_lists AS (SELECT {key}, coalesce(a, []) AS a, coalesce(b, []) AS b
  FROM {table} LEFT JOIN al USING ({key}) LEFT JOIN bl USING ({key})),
distances AS (SELECT {key}, len(b) AS n, list_reduce([range(len(b) + 1)] || list_transform(a, lambda x: [x]),
  lambda line, x: list_reduce(
    [[line[1] + 1]] || list_transform(range(1, len(b) + 1), lambda j: [b[j], line[j], line[j + 1]]),
    lambda made, y: made || [least(y[3] + 1, made[len(made)] + 1, y[2] + CASE WHEN y[1] = x[1] THEN 0 ELSE 1 END)]))[-1] AS d
  FROM both_lists)"""


WER_SQL = f"""{PREDICTED_SQL}, {word_edits_sql("predictions", "id", "predicted", "expected")}
SELECT CAST(sum(d) AS BIGINT) AS edits, CAST(sum(n) AS BIGINT) AS length, round(sum(d) / sum(n), 6) AS wer FROM distances"""


@query("word_error_rate", f"WITH {WER_SQL}")
def word_error_rate(spark, folder):
    rate = evaluation.word_error_rate(predicted(spark, folder))
    return rate.select(*whole("edits", "length"), six(F.col("wer")).alias("wer"))


def _grams_sql(words: str, name: str) -> str:
    levels = [
        f"SELECT id, {n} AS n, list_aggregate(list_slice(w, k, k + {n - 1}), 'string_agg', ' ') AS gram "
        f"FROM (SELECT id, w, unnest(range(1, len(w) - {n - 2})) AS k FROM {words})"
        for n in range(1, 5)
    ]
    return f"{name} AS (SELECT id, n, gram, count(*) AS c FROM ({' UNION ALL '.join(levels)}) GROUP BY ALL)"


BLEU_SQL = f"""{PREDICTED_SQL},
{words_sql("predictions", "id", "predicted", "pw")}, {words_sql("predictions", "id", "expected", "ew")},
pl AS (SELECT id, list(token ORDER BY i) AS w FROM pw GROUP BY id),
el AS (SELECT id, list(token ORDER BY i) AS w FROM ew GROUP BY id),
{_grams_sql("pl", "pg")}, {_grams_sql("el", "eg")},
levels AS (SELECT n, sum(pg.c) AS made, sum(least(pg.c, coalesce(eg.c, 0))) AS hits
  FROM pg LEFT JOIN eg USING (id, n, gram) GROUP BY n),
shares AS (SELECT n, coalesce(hits / nullif(made, 0), 0) AS p
  FROM (VALUES (1), (2), (3), (4)) r(n) LEFT JOIN levels USING (n)),
sizes AS (SELECT (SELECT count(*) FROM pw) AS a, (SELECT count(*) FROM ew) AS b),
scores AS (SELECT a, b, CASE WHEN a > b THEN 1.0 ELSE exp(1 - b / a) END AS brevity,
  (SELECT CASE WHEN min(p) = 0 THEN 0.0 ELSE exp(sum(ln(greatest(p, 1e-300))) / 4) END FROM shares) AS mean FROM sizes)
SELECT {", ".join(f"(SELECT round(p, 6) FROM shares WHERE n = {n}) AS precision_{n}" for n in range(1, 5))},
a AS pred_len, b AS exp_len, round(brevity, 6) AS brevity, round(brevity * mean, 6) AS bleu FROM scores"""


@query("bleu", f"WITH {BLEU_SQL}")
def bleu(spark, folder):
    score = evaluation.corpus_bleu(predicted(spark, folder))
    numbers = [f"precision_{n}" for n in range(1, 5)] + ["brevity", "bleu"]
    return score.select(*[six(F.col(c)).alias(c) for c in numbers], *whole("pred_len", "exp_len"))
