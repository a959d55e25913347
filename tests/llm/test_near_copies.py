import random
from collections import Counter

import brute
import pytest
from conftest import SCHEMA, prose

from tokenloom.llm import jaccard, repeats
from tokenloom.llm.graphs import components


def frame(spark, docs, parts=5):
    return spark.createDataFrame([(d, t, None, None, None) for d, t in docs.items()], SCHEMA).repartition(parts)


def classes(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.fixture(scope="module")
def hot():
    """A large group of near copies at the edge of the threshold, one of exact copies, shared passages."""
    rng = random.Random(1)
    stem, passage = prose(rng, 150).split(), prose(rng, 60)
    docs = {}
    for d in range(120):
        words = list(stem)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
        docs[d] = " ".join(words)
    for d in range(120, 160):
        docs[d] = " ".join(stem[:100])
    for d in range(160, 220):
        docs[d] = prose(rng, rng.randint(3, 80)) + " " + passage
    for d in range(220, 300):
        docs[d] = prose(rng, rng.randint(1, 60))
    return docs


def test_components_equal_all_pairs(spark, hot):
    assert classes(jaccard.near_duplicates(frame(spark, hot))) == brute.jaccard_components(hot)


def test_links_are_all_counted(spark, hot, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    docs = hot | {300: hot[299].upper(), 301: "", 302: " ", 303: None}
    sets = {d: brute.shingle_set(t) for d, t in docs.items()}
    links = {d: sum(100 * len(s & u) >= 80 * len(s | u) for e, u in sets.items() if e != d and s) for d, s in sets.items()}
    got = {r["doc_id"]: r["n_links"] for r in jaccard.near_duplicates(frame(spark, docs), with_links=True).collect()}
    assert got == links and got[0] > 2 and got[120] == 39 and got[301] == 0


def test_threshold_is_exact(spark):
    # 20 and 25 of 25 shingles: union 25, intersection 20 is linked; one less is not.
    words = [f"w{i}" for i in range(29)]
    docs = {1: " ".join(words), 2: " ".join(words[:24]), 3: " ".join([*words[:23], "x"])}
    got = classes(jaccard.near_duplicates(frame(spark, docs)))
    assert got == brute.jaccard_components(docs) and got[2][1] == 1


def test_edge_rows(edge, edge_rows, nothing):
    got = jaccard.near_duplicates(edge).collect()
    assert len(got) == len(edge_rows)
    known = {d: t for d, t, *_ in edge_rows if d is not None}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == brute.jaccard_components(known)
    lost = [r for r in got if r["doc_id"] is None]
    assert lost[0]["n_shingles"] == 1 and lost[0]["component_id"] is None
    assert jaccard.near_duplicates(nothing).count() == 0


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 5000), (7, 3)]
    random.Random(2).shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {k: 1000 for k in range(1000, 1100)}


def removed(df):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def test_repeated_passages_equal_brute_force(spark):
    rng = random.Random(3)
    passages = [prose(rng, rng.randint(20, 80)) for _ in range(6)]
    docs = {}
    for d in range(150):
        parts = [prose(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : rng.randint(a, len(p))], prose(rng, rng.randint(0, 5))]
        docs[d] = "é".join(parts)
    docs |= {200: "ab" * 300, 201: "ba" * 120, 202: "x" * 199, 203: "x" * 199, 204: "y" * 200, 205: "z" * 401,
             206: docs[3], 207: docs[3], 208: None, 209: ""}
    expected = Counter((d, *v) for d, v in brute.repeated_bytes(docs).items())
    assert removed(repeats.repeated_spans(frame(spark, docs))) == expected


def test_long_texts_are_cut_into_stretches(spark, monkeypatch):
    from tokenloom.llm import kernels

    rng = random.Random(5)
    shared = prose(rng, 3000)
    docs = {1: prose(rng, 60_000) + shared + prose(rng, 100_000), 2: prose(rng, 50) + shared, 3: prose(rng, 200)}
    assert len(docs[1]) > kernels.CHUNK
    got = {r["doc_id"]: r for r in repeats.repeated_spans(frame(spark, docs, 2), with_text=True).collect()}
    assert got[2]["n_removed"] >= len(shared) and got[3]["n_removed"] == 0
    assert {d: r["n_removed"] for d, r in got.items()} == {d: v[1] for d, v in brute.repeated_bytes(docs).items()}
    assert len(got[1]["kept_text"]) == got[1]["n_bytes"] - got[1]["n_removed"]


def test_repeated_blocks_and_a_partial_copy(spark):
    rng = random.Random(9)
    texts = {d: prose(rng, 120) for d in range(8)}
    parts = {100 + d: prose(rng, 9) + t[150 + d : 450 + 5 * d] + prose(rng, 9) for d, t in texts.items()}
    rows = [(d, t, None, None, None) for d, t in [*texts.items(), *texts.items(), *parts.items()]]
    # Three partitions of eight rows: the first two are equal, and so are their blocks.
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), SCHEMA)
    got = removed(repeats.repeated_spans(docs))
    brute_force = brute.repeated_bytes(texts | {1000 + d: t for d, t in texts.items()} | parts)
    assert got == Counter((d % 1000, *v) for d, v in brute_force.items())


def test_repeats_edge_rows(edge, edge_rows, nothing):
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in repeats.repeated_spans(edge).collect()}
    texts = {i: t for i, (_, t, *_) in enumerate(edge_rows)}
    expected = brute.repeated_bytes(texts)
    assert got == {(edge_rows[i][0], *v[:2]) for i, v in expected.items()}
    assert repeats.repeated_spans(nothing).count() == 0
