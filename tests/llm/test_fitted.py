import random

import numpy as np
import pytest
from conftest import SCHEMA, prose
from pyspark.sql import functions as F

from tokenloom.llm import decontaminate, quality, toxicity
from tokenloom.llm.shared import held_out

BAD = "idiot moron scum".split()


@pytest.fixture(scope="module")
def labelled(spark):
    """Shouting is bad quality; three words are toxic."""
    rng = random.Random(7)
    docs, labels = [], []
    for d in range(600):
        words = prose(rng, rng.randint(20, 120)).split()
        good, toxic = rng.random() > 0.25, rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(3, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        text = " ".join(words)
        docs.append((d, text if good else "!! ".join(text.upper().split()), "en", "a", 0))
        labels.append((d, int(good), int(toxic)))
    return (spark.createDataFrame(docs, SCHEMA).repartition(4),
            spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (9999, None, None)], "doc_id long, quality int, toxic int"))


def accuracy(scored, labels, label, least):
    rows = scored.join(labels.dropDuplicates(["doc_id"]), "doc_id").filter(held_out(F.col("doc_id"), 5, 0))
    return rows.agg(F.avg((F.col("score") >= least) .cast("int").eqNullSafe(F.col(label)).cast("int"))).first()[0]


def test_quality_on_held_out_rows(labelled, edge, nothing):
    docs, labels = labelled
    votes = quality.fit(docs, labels, "quality", ~held_out(F.col("doc_id"), 5, 0))
    assert accuracy(quality.score_documents(docs, votes), labels, "quality", 0.3) > 0.97
    scored = quality.score_documents(edge, votes)
    assert scored.count() == edge.count() and scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert quality.score_documents(nothing, votes).count() == 0
    blind = quality.fit(nothing, labels.limit(0), "quality", F.lit(True))
    assert {r["score"] for r in quality.score_documents(edge, blind).select("score").collect()} == {0.5}


def test_block_products_are_exact_neighbours(monkeypatch):
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.05, (300, quality.TERMS)).astype(np.float32)
    labels = rng.integers(0, 2, 300)
    votes = quality.NeighbourVotes(counts, labels, np.ones(300), 0.5)
    got = votes.score(counts[:20])
    vectors = votes.vectors
    for i in range(20):
        likeness = vectors @ vectors[i]
        near = np.argsort(-likeness)[: quality.NEIGHBOURS]
        weight = np.maximum(likeness[near], 0) ** quality.SHARPNESS
        assert got[i] == pytest.approx((weight * labels[near]).sum() / weight.sum(), abs=1e-3)


def test_toxicity_on_held_out_rows_with_offsets(labelled, edge, nothing):
    docs, labels = labelled
    model = toxicity.fit(docs, labels, "toxic", ~held_out(F.col("doc_id"), 5, 0))
    scored = toxicity.score_documents(docs, model)
    assert accuracy(scored, labels, "toxic", 0.7) > 0.95
    checked = 0
    for r in scored.join(docs.select("doc_id", "text"), "doc_id").filter("spans <> ''").collect():
        for span in r["spans"].split(","):
            start, end, _ = span.split(":")
            words = r["text"][int(start) : int(end)].lower().split()
            checked += sum(w.strip("!") in BAD for w in words)
    assert checked > 300
    out = toxicity.score_documents(edge, model)
    assert out.count() == edge.count() and out.filter("score is null").count() == 0
    assert toxicity.score_documents(nothing, model).count() == 0
    blind = toxicity.fit(nothing, labels.limit(0), "toxic", F.lit(True))
    assert toxicity.score_documents(edge, blind).filter("spans <> ''").count() == 0


def test_gaps_give_the_marginals_of_the_whole_chain():
    rng = np.random.default_rng(3)
    model = toxicity.ToxicField(np.empty(0, np.uint64), np.empty(0), -1.2, np.array([[0.0, -1.0], [-0.7, 0.9]]), np.zeros(4))
    for _ in range(20):
        n = int(rng.integers(1, 12))
        at = np.sort(rng.choice(30, n, replace=False))
        score = rng.normal(0, 3, n)
        got = model.marginals(score, at, np.zeros(n, np.int64))
        # Plain forward-backward over every token, between two long runs of plain tokens.
        pad = 200
        full = np.zeros(30 + 2 * pad)
        full[at + pad] = score
        factor = np.stack([np.ones(len(full)), np.exp(model.bias + full)], 1)
        trans = np.exp(model.transitions)
        forward, backward = np.ones((len(full), 2)), np.ones((len(full), 2))
        for t in range(len(full)):
            forward[t] = (forward[t - 1] @ trans if t else np.ones(2)) * factor[t]
            forward[t] /= forward[t].sum()
        for t in range(len(full) - 2, -1, -1):
            backward[t] = trans @ (backward[t + 1] * factor[t + 1])
            backward[t] /= backward[t].sum()
        both = forward * backward
        np.testing.assert_allclose(got, (both[:, 1] / both.sum(1))[at + pad], atol=1e-9)


def test_many_texts_at_once_equal_one_by_one():
    rng = np.random.default_rng(4)
    model = toxicity.ToxicField(np.empty(0, np.uint64), np.empty(0), -1.0, np.array([[0.0, -1.0], [-0.5, 0.7]]), np.zeros(4))
    lengths = [3, 1, 7, 2]
    at = [np.sort(rng.choice(40, n, replace=False)) for n in lengths]
    score = [rng.normal(0, 2, n) for n in lengths]
    rows = np.repeat([0, 2, 3, 9], lengths)
    got = model.marginals(np.concatenate(score), np.concatenate(at), rows)
    one = [model.marginals(s, a, np.zeros(len(s), np.int64)) for s, a in zip(score, at)]
    np.testing.assert_allclose(got, np.concatenate(one))


def bm25(items):
    index = decontaminate.ItemIndex([(i, *decontaminate.item_words(t, None)) for i, t in items])
    return index


def test_block_max_search_equals_scoring_everything():
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randint(5, 40))) for i in range(60)]
    index = bm25(items)
    for _ in range(60):
        base = rng.choice(items)[1].split()
        words = base[rng.randint(0, 3) :] + prose(rng, rng.randint(0, 40)).split()
        known = sorted({int(k) for k in index.lookup(decontaminate.item_words(" ".join(words), "")[0]) if k >= 0})
        scores = {}
        for t in known:
            for n, w in zip(index.items[t], index.weights[t]):
                scores[int(n)] = scores.get(int(n), 0.0) + float(w)
        expected = {n: s for n, s in scores.items() if s >= decontaminate.THRESHOLD}
        assert dict(index.search(known)) == pytest.approx(expected)
        passage = np.zeros(len(known), np.int64)
        assert not expected or list(index.live(passage, np.array(known))) == [0]


def test_items_are_found_wherever_they_stand(spark, edge, edge_rows, nothing):
    rng = random.Random(10)
    items = [(i, prose(rng, rng.randint(8, 60))) for i in range(30)]
    bench = spark.createDataFrame([*items, (90, None), (91, "")], "item_id long, text string")
    docs, expected = [], set()
    for d in range(200):
        words = prose(rng, rng.randint(0, 300))
        if d % 4 == 0:
            i, text = rng.choice(items)
            cut = rng.randint(0, len(words))
            words = words[:cut] + " " + (text.upper() if d % 8 else text) + " " + words[cut:]
            expected.add((d, i))
        docs.append((d, words, "en", "a", 0))
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    for size in (1000, 7):  # one index, and several
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame, bench, size).collect()}
        assert got == expected
    assert decontaminate.contaminated(edge, bench).count() == 0 and decontaminate.contaminated(nothing, bench).count() == 0
    assert decontaminate.contaminated(frame, bench.limit(0)).count() == 0
    # The same scores whether the items lie in one index or in several.
    whole, parts = ({(r["doc_id"], r["item_id"]): (r["score"], r["question_overlap"]) for r in decontaminate.contaminated(frame, bench, size).collect()}
                    for size in (1000, 7))
    assert all(parts[k] == pytest.approx(whole[k]) for k in whole)
    short = spark.createDataFrame([(1, "zebra"), (2, "Purple Zebra")], "item_id long, text string")
    texts = spark.createDataFrame([(1, "a zebra here"), (2, "the purple zebra"), (3, "zebra, purple"), (4, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(texts, short).collect()) == [(1, 1), (2, 1), (2, 2)]
    answered = bench.limit(3).withColumn("answer", F.lit("no such answer anywhere"))
    assert decontaminate.contaminated(frame, answered).count() == 0
