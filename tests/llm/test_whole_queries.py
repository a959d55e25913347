"""The registered queries on a small table, against plain versions of what they must return."""

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import pytest
from conftest import SCHEMA, prose
from pyspark.sql import functions as F

from tokenloom.llm import mixing, sharding
from tokenloom.llm.queries import QUERIES


def documents(edge_rows):
    """Rows with distinct ids: odd ones, copies, near copies, personal data, secrets and shared passages."""
    rng = random.Random(21)
    seen, rows = set(), []
    for r in edge_rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            rows.append(r)
    passage = prose(rng, 70)
    for d in range(1000, 1060):
        words = prose(rng, rng.randint(0, 150)).split()
        odd = ["mail ann.lee@example.org now", "host 10.0.0.1 or 300.1.1.1", "4111 1111 1111 1111", "+49 (30) 1234-5678", "12 34",
               "password = hunter22x", "AKIA" + "Q7" * 9, "0123456789abcdef" * 2, 'token: "Zx9+/abcDEF012"', passage]
        for _ in range(rng.randint(0, 3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(odd))
        rows.append((d, " ".join(words), "en", rng.choice(["a", "a", "b", None, ""]), 0))
        if d % 5 == 0:
            rows.append((d + 500, " ".join(words).replace("river", "lake", 1), "en", "b", 0))
    return rows


@pytest.fixture(scope="module")
def small(spark, edge_rows, tmp_path_factory):
    rows = documents(edge_rows)
    folder = str(tmp_path_factory.mktemp("small"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return folder, {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}


def result(spark, name, small):
    return {r["doc_id"]: r for r in QUERIES[name](spark, small[0]).collect()}


def test_near_copies_with_their_links(spark, small):
    got, texts = result(spark, "op1_ngram_jaccard_join", small), small[1]
    classes = brute.jaccard_components(texts)
    sets = {d: brute.shingle_set(t) for d, t in texts.items()}
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == classes
    for d, s in sets.items():
        links = sum(1 for e, t in sets.items() if e != d and s and t and 100 * len(s & t) >= 80 * len(s | t))
        assert got[d]["n_links"] == links


@pytest.mark.parametrize("name, spans, kinds", [
    ("op2_personal_data", brute.pii_base, ("email", "ip", "card", "phone")), ("op6_secret_scan", brute.secret_base, ("assign", "access", "hex"))])
def test_base_spans(spark, small, name, spans, kinds):
    got, texts = result(spark, name, small), small[1]
    assert set(got) == set(texts) and sum(len(spans(t)) for t in texts.values()) > 20
    for d, text in texts.items():
        found = spans(text)
        assert got[d]["base_sha256"] == brute.digest(found)
        assert [got[d][f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in found) for k in kinds]
        assert set(f"{k}:{a}:{b}" for k, a, b in found) <= set(got[d]["spans"].split(","))


def test_repeated_passages(spark, small):
    got, texts = result(spark, "op4_suffix_dedup", small), small[1]
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for d, r in got.items()} == brute.repeated_bytes(texts)


def test_shards(spark, small):
    got, texts = result(spark, "op5_resharding", small), small[1]
    assert set(got) == set(texts) and {r["law"] for r in got.values()} == {"bytes"}
    load, slots = defaultdict(int), defaultdict(list)
    for d, r in got.items():
        raw = (texts[d] or "").encode()
        assert (r["size"], r["text_crc32"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), None)
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(load) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_the_mix(spark, small):
    got, (_, texts, sources) = result(spark, "op7_source_mixing", small), small
    size = {d: len(brute.words(t)) for d, t in texts.items()}
    whole = defaultdict(int)
    for d, s in sources.items():
        whole[s] += size[d]
    order = sorted(s for s in whole if s is not None) + [s for s in whole if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        left = 1.5 * sum(whole.values()) - sum(target.values())
        shares = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if shares[s] > 2 * whole[s]}
        if not full:
            break
        for s in full:
            target[s] = 2.0 * whole[s]
        open_ -= full
    target |= shares
    taken = defaultdict(int)
    for d, r in got.items():
        assert (r["size"], r["source_size"]) == (size[d], whole[sources[d]])
        assert r["target"] == pytest.approx(target[sources[d]])
        assert r["taken"] in (0, size[d], 2 * size[d])
        taken[sources[d]] += r["taken"]
    longest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= longest for s in order)
    assert result(spark, "op7_source_mixing", small) == got


def test_fingerprints_of_edited_texts(spark, small):
    got, texts = result(spark, "op9_imatch_fingerprints", small), small[1]
    edited = brute.edited_texts(list(texts.items()))
    ids = sorted(texts)
    for i, d in enumerate(ids):
        r, after = got[d], got[ids[(i + 1) % len(ids)]]
        assert r["n_chars"] == len(texts[d] or "") and r["edited_sha256"] == hashlib.sha256(edited[d].encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["near_next"] == 1.0) >= (r["fingerprint"] == after["fingerprint"])
        assert (r["near_edited"] == 1.0) >= (r["fingerprint"] == r["edited_fingerprint"])
    same = defaultdict(set)
    for d, t in texts.items():
        same[t or ""].add(got[d]["fingerprint"])
    assert all(len(f) == 1 for f in same.values())


def test_columns_of_any_name_stay(spark):
    rows = spark.createDataFrame([(i, "a b c " * i, f"s{i % 3}") for i in range(20)], "doc_id long, text string, source string")
    clash = {"_id": "1", "_place": "2", "_mix_id": "3", "_from_shard": "4", "_base": "5", "_move_block": "6", "_weight": "7"}
    rows = rows.withColumns({k: F.lit(v) for k, v in clash.items()})
    sized = rows.withColumn("n", mixing.word_count(F.col("text"))).withColumn("tag", mixing.tagged(F.col("source")))
    made = mixing.mix_sources(sized, "n", F.array("tag"), ["doc_id", "tag"]).rows
    dealt = sharding.reshard(rows, F.lit(0), sharding.document_size(F.col("text")), ["doc_id"], 4)
    for out in (made, dealt):
        assert out.count() == 20 and set(rows.columns) <= set(out.columns)
        assert {tuple(r[k] for k in clash) for r in out.collect()} == {tuple(clash.values())}
