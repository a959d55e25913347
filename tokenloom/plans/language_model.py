"""Next-token tables, their losses, and the text they generate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import bigram, generate, ngram, packing, splits
from tokenloom.operators.encode import decode_chars, encode_chars
from tokenloom.operators.vocab import char_vocab
from tokenloom.plans.corpus import B, SEED, T, char_stream, corpus
from tokenloom.plans.registry import CHARS_SQL, as_text, query, six, whole
from tokenloom.session import once, stage
from tokenloom.sources.corpus import table

# Pairs of adjacent characters that lie in one document and one split.
PAIRS_SQL = f"""{CHARS_SQL},
parts AS (SELECT doc_id, pos, id, n, v,
  CASE WHEN pos < floor(CAST(0.9 AS DOUBLE) * n) THEN 'train' ELSE 'val' END AS split FROM stream, size),
pairs AS (SELECT split, v, doc_id, pos, id AS prev,
  lead(id) OVER (PARTITION BY doc_id, split ORDER BY pos) AS next FROM parts),
counts AS (SELECT split, prev, next, v, count(*) AS n FROM pairs WHERE next IS NOT NULL GROUP BY ALL),
seen AS (SELECT prev, next, n FROM counts WHERE split = 'train'),
contexts AS (SELECT prev, sum(n) AS total FROM seen GROUP BY prev)
"""


def _split_counts(spark, folder):
    docs, chars, index = char_stream(spark, folder)
    parts = splits.prefix_split(docs, index)
    counts = stage(bigram.pair_counts(parts, ["split"]), "pairs")
    train = counts.filter(F.col("split") == "train").drop("split")
    return docs, chars, index, parts, counts, train


@query(
    "bigram_fit",
    f"""WITH {PAIRS_SQL} SELECT c.prev, c.next, c.n AS "count", CAST(total AS BIGINT) AS total,
    round((c.n + 1) / (total + v), 6) AS p
    FROM counts c JOIN contexts USING (prev) WHERE split = 'train'""",
)
def bigram_fit(spark, folder):
    _, chars, _, _, _, train = _split_counts(spark, folder)
    model = bigram.fit_bigram(train, chars.count())
    return model.select(*whole("prev", "next"), F.col("n").alias("count"), "total", six(F.col("p")).alias("p"))


@query(
    "bigram_loss",
    f"""WITH {PAIRS_SQL},
    scored AS (SELECT c.split, c.n, c.v, (coalesce(s.n, 0) + 1) / (coalesce(total, 0) + c.v) AS p
      FROM counts c LEFT JOIN contexts USING (prev) LEFT JOIN seen s ON s.prev = c.prev AND s.next = c.next)
    SELECT split, CAST(sum(n) AS BIGINT) AS tokens, round(sum(-n * ln(p)) / sum(n), 6) AS nll,
    round(exp(sum(-n * ln(p)) / sum(n)), 6) AS perplexity, round(ln(max(v)), 6) AS uniform_nll
    FROM scored GROUP BY split""",
)
def bigram_loss(spark, folder):
    _, chars, _, _, counts, train = _split_counts(spark, folder)
    uniform = bigram.uniform_loss(chars).first()
    model = bigram.fit_bigram(train, uniform["vocab_size"])
    loss = bigram.bigram_loss(counts, model, ["split"], uniform["vocab_size"])
    return loss.select(
        "split",
        "tokens",
        six(F.col("nll")).alias("nll"),
        six(F.col("perplexity")).alias("perplexity"),
        six(F.lit(uniform["uniform_nll"])).alias("uniform_nll"),
    )


@query(
    "uniform_baseline",
    f"WITH {CHARS_SQL} SELECT count(*) AS vocab_size, round(ln(count(*)), 6) AS uniform_nll FROM vocab",
)
def uniform_baseline(spark, folder):
    loss = bigram.uniform_loss(char_vocab(corpus(spark, folder)))
    return loss.select("vocab_size", six(F.col("uniform_nll")).alias("uniform_nll"))


EVAL_BATCHES = 200


def _sampled_sql(split: str, low: str, high: str, seed: int) -> str:
    return f"""SELECT '{split}' AS split, s AS sample_id, {low} + CAST(('0x' || substring(
      md5(concat_ws('|', s, '{seed}')), 1, 15)) AS BIGINT) % ({high} - {low} - {T}) AS start
      FROM cut, range({EVAL_BATCHES * B}) r(s)"""


@query(
    "split_loss",
    f"""WITH {PAIRS_SQL}, cut AS (SELECT n, v, CAST(floor(CAST(0.9 AS DOUBLE) * n) AS BIGINT) AS c FROM size),
    samples AS ({_sampled_sql("train", "0", "c", SEED)} UNION ALL {_sampled_sql("val", "c", "n", SEED + 1)}),
    wanted AS (SELECT split, sample_id, start + unnest(range({T})) AS pos FROM samples),
    scored AS (
      SELECT w.split, sample_id // {B} AS batch,
        -ln((coalesce(s.n, 0) + 1) / (coalesce(total, 0) + (SELECT v FROM size))) AS loss
      FROM wanted w JOIN stream a ON a.pos = w.pos JOIN stream b ON b.pos = w.pos + 1
      LEFT JOIN contexts ON contexts.prev = a.id LEFT JOIN seen s ON s.prev = a.id AND s.next = b.id),
    batches AS (SELECT split, batch, avg(loss) AS loss FROM scored GROUP BY ALL)
    SELECT split, count(*) AS batches, round(avg(loss), 6) AS loss FROM batches GROUP BY split""",
)
def split_loss(spark, folder):
    _, chars, index, _, _, train = _split_counts(spark, folder)
    cut = int(0.9 * index.total)
    n = EVAL_BATCHES * B
    bounds = {"train": (SEED, 0, cut), "val": (SEED + 1, cut, index.total)}
    samples = [packing.sample_begins(index, n, T, *b).withColumn("split", F.lit(s)) for s, b in bounds.items()]
    sampled = packing.windows_at(
        corpus(spark, folder), index, samples[0].unionByName(samples[1]), T, lambda df: encode_chars(df, chars))
    size = chars.count()
    model = bigram.fit_bigram(train, size)
    return bigram.split_loss(sampled, model, B, size).select(
        "split", "batches", six(F.col("loss")).alias("loss")
    )


ORDER = 3
GRAMS_SQL = f"""{PAIRS_SQL},
grams AS (
  SELECT split, doc_id, id AS next, pos, lag(id, 1) OVER w AS c1, lag(id, 2) OVER w AS c2
  FROM parts WINDOW w AS (PARTITION BY doc_id, split ORDER BY pos)),
levels AS (
  SELECT 1 AS n, '' AS context, next FROM grams WHERE split = 'train'
  UNION ALL SELECT 2, c1::VARCHAR, next FROM grams WHERE split = 'train' AND c1 IS NOT NULL
  UNION ALL SELECT 3, c2 || ' ' || c1, next FROM grams WHERE split = 'train' AND c2 IS NOT NULL),
model AS (
  SELECT n, context, next, count(*) AS "count", sum(count(*)) OVER (PARTITION BY n, context) AS total,
  row_number() OVER (PARTITION BY n, context ORDER BY count(*) DESC, next) AS "rank"
  FROM levels GROUP BY n, context, next)
"""


@query(
    "ngram_fit",
    f"""WITH {GRAMS_SQL} SELECT CAST(n AS BIGINT) AS n, context, next, "count", CAST(total AS BIGINT) AS total,
    "rank" FROM model""",
)
def ngram_fit(spark, folder):
    _, _, _, parts, _, _ = _split_counts(spark, folder)
    train = parts.filter(F.col("split") == "train")
    model = ngram.fit_ngram(ngram.gram_counts(train, ORDER, []), ORDER)
    return model.select(*whole("n"), "context", *whole("next", "count", "total", "rank"))


@query(
    "ngram_score",
    f"""WITH {GRAMS_SQL}, val AS (SELECT * FROM grams WHERE split = 'val'),
    scored AS (
      SELECT doc_id, coalesce(ln(a."count" / a.total), ln(0.4) + ln(b."count" / b.total),
        2 * ln(0.4) + ln(c."count" / c.total),
        2 * ln(0.4) - ln((SELECT max(total) FROM model WHERE n = 1))) AS score
      FROM val
      LEFT JOIN model a ON a.n = 3 AND a.context = c2 || ' ' || c1 AND a.next = val.next
      LEFT JOIN model b ON b.n = 2 AND b.context = c1::VARCHAR AND b.next = val.next
      LEFT JOIN model c ON c.n = 1 AND c.next = val.next)
    SELECT doc_id, count(*) AS tokens, round(sum(score), 6) AS backoff_score FROM scored GROUP BY doc_id""",
)
def ngram_score(spark, folder):
    _, _, _, parts, _, _ = _split_counts(spark, folder)
    train, val = parts.filter(F.col("split") == "train"), parts.filter(F.col("split") == "val")
    model = stage(ngram.fit_ngram(ngram.gram_counts(train, ORDER, []), ORDER), "ngrams")
    scores = ngram.score_ngram(model, val, ORDER, "doc_id")
    return scores.select("doc_id", "tokens", six(F.col("backoff_score")).alias("backoff_score"))


STEPS, GENERATE_ORDER = 30, 4
# Each document is a prompt that goes on after its last characters; the line feed ends a text.
RECENT = GENERATE_ORDER - 1


def _levels_sql() -> str:
    levels = ["SELECT '' AS context, next FROM grams"]
    for k in range(1, GENERATE_ORDER):
        context = " || ' ' || ".join(f"c{j}" for j in range(k, 0, -1))
        levels.append(f"SELECT CAST({context} AS VARCHAR), next FROM grams WHERE c{k} IS NOT NULL")
    return " UNION ALL ".join(levels)


def _generate_sql(seed: int | None, top_k: int | None = None, returns: int = 1) -> str:
    """Generation as recursion: in each step the longest context that is known, then its draw."""
    lags = ", ".join(f"lag(id, {k}) OVER w AS c{k}" for k in range(1, GENERATE_ORDER))
    kept = "" if top_k is None else f"WHERE r <= {top_k}"
    met = " ".join(
        f"LEFT JOIN contexts t{k} ON t{k}.context = array_to_string(recent[-{k}:], ' ') AND len(recent) >= {k}"
        for k in range(1, GENERATE_ORDER))
    longest = ", ".join(f"t{k}.context" for k in range(GENERATE_ORDER - 1, 0, -1))
    total = ", ".join(f"t{k}.total" for k in range(GENERATE_ORDER - 1, 0, -1))
    draw = f"CAST(('0x' || substring(md5(concat_ws('|', prompt_id, step, '{seed}')), 1, 15)) AS BIGINT) % total"
    chosen = "lo = 0" if seed is None else f"{draw} >= lo AND {draw} < hi"
    return f"""WITH RECURSIVE {CHARS_SQL},
grams AS (SELECT id AS next, {lags} FROM stream WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
levels AS ({_levels_sql()}),
counted AS (SELECT context, next, count(*) AS n FROM levels GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY context ORDER BY n DESC, next) AS r FROM counted),
choices AS MATERIALIZED (SELECT c.*, ch FROM (SELECT context, next, sum(n) OVER (PARTITION BY context ORDER BY r) - n AS lo,
  sum(n) OVER (PARTITION BY context ORDER BY r) AS hi FROM ranked {kept}) c JOIN vocab ON id = next),
contexts AS MATERIALIZED (SELECT context, max(hi) AS total FROM choices GROUP BY context),
prompts AS (SELECT doc_id * {returns} + unnest(range({returns})) AS prompt_id, coalesce(recent, []) AS recent FROM documents
  LEFT JOIN (SELECT doc_id, list(id ORDER BY i)[-{RECENT}:] AS recent FROM stream GROUP BY doc_id) USING (doc_id)),
made AS (
  SELECT prompt_id, 0 AS step, recent, '' AS text, false AS done FROM prompts
  UNION ALL SELECT prompt_id, step + 1, (recent || [next])[-{RECENT}:], text || ch, ch = chr(10)
  FROM (SELECT made.*, coalesce({longest}, '') AS context, coalesce({total}, (SELECT total FROM contexts WHERE context = '')) AS total
    FROM made {met} WHERE NOT done AND step < {STEPS}) JOIN choices USING (context) WHERE {chosen})
SELECT prompt_id, arg_max(text, step) AS text, max(step) AS n_tokens FROM made GROUP BY prompt_id"""


def _prompts(spark, folder):
    texts = corpus(spark, folder)
    chars = stage(char_vocab(texts), "chars")
    docs = encode_chars(texts, chars).drop("text")
    ends = chars.filter(F.col("token") == "\n").first()
    counts = once(table(spark, folder, "documents"), "contexts", lambda: generate.context_counts(
        ngram.gram_counts(docs, GENERATE_ORDER, []), GENERATE_ORDER))
    # A prompt goes on after its last characters, so only those are encoded for it.
    ends_of = encode_chars(texts.withColumn("text", F.right("text", F.lit(RECENT))), chars).drop("text")
    return ends_of.withColumnRenamed("doc_id", "prompt_id"), counts, ends["id"] if ends else -1, chars


def _as_texts(made, chars):
    return decode_chars(made, chars, "out", "text").select("prompt_id", "text", F.size("out").alias("n_tokens"))


@query("generate_greedy", _generate_sql(None))
def generate_greedy(spark, folder):
    prompts, counts, ends, chars = _prompts(spark, folder)
    return _as_texts(generate.generate_greedy(prompts, counts, GENERATE_ORDER, STEPS, ends), chars)


@query("generate_sample", _generate_sql(SEED))
def generate_sample(spark, folder):
    prompts, counts, ends, chars = _prompts(spark, folder)
    return _as_texts(generate.generate_sample(prompts, counts, GENERATE_ORDER, STEPS, SEED, eos_id=ends), chars)


TOP_K, RETURNS = 50, 5


@query("generate_topk", _generate_sql(SEED, TOP_K, RETURNS))
def generate_topk(spark, folder):
    prompts, counts, ends, chars = _prompts(spark, folder)
    made = generate.generate_sample(prompts, counts, GENERATE_ORDER, STEPS, SEED, TOP_K, RETURNS, ends)
    return _as_texts(made, chars)
