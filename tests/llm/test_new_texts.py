"""Language identification, the filter audit and fill-in-middle."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SCHEMA, prose
from pyspark.sql import functions as F

from tokenloom.llm import audit, infill, kernels, langid
from tokenloom.llm.queries import INFILL_SQL, QUERIES, SQL
from tokenloom.llm.shared import held_out

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def texts_of_all_kinds(seed, n=200):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcXYZ é😀 .\n<PSM>") for _ in range(6000))
    odd = ["", None, "a", "é", base * 3, "x" * 30_000, "\n" * 500, "é" * 20_000, base[:3000] + "q" * 20 + base[100:5000],
           "has <P> in it", "<S>", "a<M", "<", "<P", "P>", "<S" * 40]
    return odd + ["".join(rng.choice("abc def é😀\n<>") for _ in range(rng.randint(0, 3000))) for _ in range(n)]


def plain_infill(doc_id, text):
    """(n, form, prefix, middle, output) the plain way."""
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 20:
        return len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("room", [32 << 20, 2000])
def test_places_equal_a_plain_scan(monkeypatch, room):
    monkeypatch.setattr(infill, "CACHE_BYTES", room)
    texts = texts_of_all_kinds(3)
    data, offsets = kernels.column_bytes(pa.array(texts))
    cache = infill.ChunkCache()
    rng = random.Random(1)
    for _ in range(2):  # the second time from the cache, as far as it reaches
        cutter = infill.Cutter(data, offsets, cache)
        for r, text in enumerate(texts):
            tokens = TOKEN.findall(text or "")
            assert cutter.count(r) == len(tokens)
            for k in {0, len(tokens), *(rng.randint(0, len(tokens)) for _ in range(10))}:
                head = "".join(tokens[:k])
                assert cutter.place(r, k) == (len(head.encode()), len(head))
    assert cache.hits > 0 and (room < 10_000 or cache.hits >= cache.misses)


def test_chunks_follow_content():
    rng = random.Random(8)
    shared = prose(rng, 4000)
    texts = [shared, "one more beginning " + shared, shared[1234:] + " and an end"]
    data, offsets = kernels.column_bytes(pa.array(texts))
    bounds = np.r_[infill.chunk_bounds(data, offsets), len(data)]
    raw = data.tobytes()
    chunks = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert b"".join(chunks) == raw and len(set(chunks)) < 0.5 * len(chunks)
    assert max(map(len, chunks)) <= infill.MOST_GAP


def test_fill_in_middle_and_back(spark, edge, edge_rows, nothing):
    texts = texts_of_all_kinds(5)
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)] + [(None, "no id", None, None, 0)], SCHEMA)
    docs = docs.unionByName(docs.limit(20)).withColumn("form", F.lit("mine")).withColumn("output", F.lit(7)).repartition(3)
    made = infill.fill_in_middle(docs)
    got = sorted((tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=str)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got == sorted(((i, *plain_infill(i, t)) for i, t in rows), key=str)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    back = made.select("doc_id", infill.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    out = infill.fill_in_middle(edge).collect()
    assert sorted(((r["doc_id"], r["output"]) for r in out), key=str) == sorted(
        ((i, plain_infill(i, t)[4]) for i, t, *_ in edge_rows), key=str)
    assert infill.fill_in_middle(nothing).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 4097])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    plain = [(words >> np.uint32(k) & 1).sum() for k in range(32)]
    assert audit.positional_popcount(words).tolist() == plain


def plain_audit(rows, labels):
    """Rows (doc_id, text, lang) filtered one order after the other."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = defaultdict(list)
    for i, text, lang in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), any(c in "#$%&*|" for c in text),
                 any(j is not None and i is not None and j < i and (u or "") == text for j, u, _ in rows))
        parts[lang or ""].append((fails, i in good, i in toxic))
    out, sums = {}, defaultdict(int)
    for part, docs in parts.items():
        for order in permutations(range(5)):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                out[part, "".join("ABCDE"[k] for k in order), step] = [
                    len(left), len(gone), sum(d[0][f] for d in docs) - len(gone),
                    sum(d[0][f] and sum(d[0]) == 1 for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
                sums[part, f] += len(gone)
    return {k: (*v, sums[k[0], "ABCDE".index(k[1][k[2] - 1])]) for k, v in out.items()}


def found_rows(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.select(*[c.split()[0] for c in audit.RESULT.split(", ")]).collect()}


def test_audit_equals_filtering_in_every_order(spark, edge, edge_rows, nothing):
    rng = random.Random(12)
    base = prose(rng, 260)
    rows = [(i, rng.choice([base, base, prose(rng, rng.randint(1, 500)), "WORD " * 300, "a#b " + base, None, ""]),
             rng.choice(["en", "fr", None, "x y"])) for i in rng.sample(range(-50, 500), 150)]
    rows += [(None, base, "en"), (None, None, "de"), rows[0], rows[1], (rows[2][0], base, "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, *_ in rows[:100] if i is not None] + [(None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    docs = docs.withColumn("fails", F.lit("mine")).withColumn("digest", F.lit(1)).withColumn("part", F.lit(0))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert found_rows(audit.audit(docs, marks, F.col("lang"))) == plain_audit(rows, labels)
    whole = found_rows(audit.audit(edge, marks.limit(0), F.col("lang")))
    assert whole == plain_audit([r[:3] for r in edge_rows], [])
    assert audit.audit(nothing, marks, F.col("lang")).count() == 0


def test_queries_equal_their_sql_on_odd_rows(spark, edge, tmp_path):
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, 1, 0), (8, 1, 1), (1, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert SQL["op13_fill_in_middle"] == INFILL_SQL
    for name in ("op12_filter_audit", "op13_fill_in_middle"):
        result = con.execute(SQL[name])
        names = [d[0] for d in result.description]
        expected = sorted(map(tuple, result.fetchall()), key=str)
        assert sorted((tuple(r) for r in QUERIES[name](spark, str(tmp_path)).select(*names).collect()), key=str) == expected


SYLLABLES = {"aa": "ka to mi ren sul".split(), "bb": "ka zu per ög lin".split(), "cc": "ка то ми зе".split()}


def invented(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(2)
    rows = [(i, invented(rng, lang, rng.randint(3, 80)), lang) for i, lang in enumerate(rng.choices(["aa", "bb", "cc"], k=900))]
    return spark.createDataFrame([*rows, (None, "ka ka", "dd"), (5000, "zu", None)], "doc_id long, text string, lang string").repartition(4)


def test_languages_of_held_out_rows(spoken, edge, nothing):
    held = held_out(F.col("doc_id"), 5, 0)
    model = langid.fit(spoken, ~held, per_language=150)
    assert model.languages == ["aa", "bb", "cc"]
    out = langid.predict(spoken.drop("lang"), model).join(spoken, "doc_id").filter(held)
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    rows = langid.predict(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"} and {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0.0}
    assert langid.predict(nothing, model).count() == 0
    blind = langid.fit(nothing, ~held)
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(edge, blind).collect()} == {("und", 0.0)}


def test_word_first_scores_equal_a_plain_version(spoken):
    """Every table kept whole, so that the plain version needs no hashes."""
    every = F.lit(True)
    model = langid.fit(spoken.filter("doc_id is not null"), every, per_language=10**6)
    rows = [(r["text"], r["lang"]) for r in spoken.filter("lang is not null and doc_id is not null").collect()]
    counts = [defaultdict(lambda: defaultdict(int)) for _ in range(6)]
    for text, lang in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            counts[0][word][lang] += 1
            spelled = f" {word} "
            for n in range(1, 6):
                for k in range(len(spelled) - n + 1):
                    counts[n][spelled[k : k + n]][lang] += 1
    languages = model.languages
    totals = [{lang: sum(c[lang] for c in counts[k].values()) for lang in languages} for k in range(6)]
    known = [{w for w, c in counts[k].items() if k or max(c.values()) >= langid.LEAST_COUNT} for k in range(6)]

    def logs(kind, key):
        c = counts[kind][key]
        return np.array([np.log((c[x] + 0.5) / (totals[kind][x] + 0.5 * len(known[kind]))) for x in languages])

    def word_score(word):
        if word in known[0]:
            return logs(0, word)
        spelled, score = f" {word} ", np.zeros(len(languages))
        for at in range(len(spelled)):
            for n in range(5, 0, -1):
                if at >= n - 1 and spelled[at - n + 1 : at + 1] in known[n]:
                    score += logs(n, spelled[at - n + 1 : at + 1])
                    break
        return score / len(spelled)

    texts = ["kato mi-ren PERÖG, zu!", "neverseen zuzuzuzuzuzu q1q", "Катото ми", "", "ÖG ög", "x" * 3000]
    data, offsets = kernels.column_bytes(pa.array(texts))
    got, n = model.scores(data, offsets)
    for text, row, count in zip(texts, got, n):
        found = re.findall(r"[^\W\d_]+", text.lower())
        assert count == len(found)
        np.testing.assert_allclose(row, model.prior + sum(map(word_score, found)), atol=1e-9)
