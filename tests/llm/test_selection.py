"""Sharding, vector codes and importance resampling, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebind.llm import ball_codes, importance, sharding
from casebind.llm.numbering import numbered

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- numbering -----------------------------------------------------------------------------

def test_numbering_any_order(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(3), rng.choice([None, 1, 2, 3]), rng.randrange(4)) for _ in range(500)]
    rows += [(1, 2, 2)] * 300  # most rows are equal
    frame = spark.createDataFrame(rows, "part int, a int, b int").repartition(7)
    got = [tuple(r) for r in numbered(frame, ["a", "b"], ["part"]).collect()]
    for part in range(3):
        own = sorted((n, -1 if a is None else a, b) for p, a, b, n in got if p == part)
        assert [n for n, _, _ in own] == list(range(len(own)))
        assert [x[1:] for x in own] == sorted((-1 if a is None else a, b) for p, a, b in rows if p == part)
    assert numbered(frame.limit(0), ["a"]).count() == 0


# ---- shards --------------------------------------------------------------------------------

def bids(key, weights):
    out = []
    for i, w in enumerate(weights):
        u = (int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        out.append(-1.0 if w <= 0 else w / -math.log(u))
    return out.index(max(out))


def test_shards_of_any_table(spark, docs, no_docs, rows):
    got = [r.asDict() for r in sharding.manifest(docs).collect()]
    assert len(got) == len(rows)
    expect = Counter()
    for i, text, _ in rows:
        data, key = (text or "").encode(), "" if i is None else i
        expect[i, len(data) + 1, zlib.crc32(data), bids(key, [1] * 8), bids(key, [1] * 9)] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == expect
    for shard in range(8):
        own = sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        order = [(-math.inf if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in own]
        assert order == sorted(order)
    assert {r["law"] for r in got} == {"key"}
    assert sharding.manifest(no_docs).count() == 0


def test_shards_follow_weights_and_move_little(spark):
    keys = spark.range(20000).select(F.col("id").alias("doc_id"))
    weights = [1.0, 3.0, 0.0, 2.0]
    shares = {r["shard"]: r["count"] for r in sharding.assign_shards(keys, weights).groupBy("shard").count().collect()}
    assert set(shares) == {0, 1, 3}
    assert all(abs(shares[i] / 20000 - weights[i] / 6) < 0.02 for i in shares)
    grown = sharding.moved(keys, weights, [*weights, 2.0])
    assert {r["shard"] for r in grown.select("shard").distinct().collect()} == {4}
    assert abs(grown.count() / 20000 - 0.25) < 0.02
    shrunk = sharding.moved(keys, weights, weights[:3])  # the last shard goes
    assert {r["from_shard"] for r in shrunk.select("from_shard").distinct().collect()} == {3}
    with pytest.raises(ValueError):
        sharding.assign_shards(keys, [0.0])


def test_shards_are_written_whole(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path)
    back = spark.read.parquet(path)
    want = {(r["doc_id"], r["shard"]): r["n"] for r in
            sharding.assign_shards(docs).groupBy("doc_id", "shard").agg(F.count("*").alias("n")).collect()}
    assert {(r["doc_id"], r["shard"]): r["n"] for r in
            back.groupBy("doc_id", "shard").agg(F.count("*").alias("n")).collect()} == want


# ---- vector codes --------------------------------------------------------------------------

def plain_codes(rows, parts, k, rounds):
    """(vec_id, code, error) of each kept row, and the codebooks' digest, by comparing with all entries."""
    kept = [(i, np.floor(np.array(v, float) * 1024).astype(np.int64)) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1].tolist()))
    books = [np.array(b) for b in zip(*(np.split(kept[j][1], parts) for j in order[:k]), strict=True)]
    split = [np.array(p) for p in zip(*(np.split(v, parts) for _, v in kept), strict=True)]
    for step in range(rounds + 1):
        far = [((x[:, None, :] - b[None]) ** 2).sum(axis=2) for x, b in zip(split, books, strict=True)]
        code = [f.argmin(axis=1) for f in far]
        if step < rounds:
            for b, x, c in zip(books, split, code, strict=True):
                for e in set(c.tolist()):
                    b[e] = x[c == e].sum(axis=0) // (c == e).sum()
    error = sum(f.min(axis=1) for f in far)
    text = ",".join(str(x) for b in books for x in b.ravel().tolist())
    return (Counter((kept[j][0], "".join(f"{c[j]:02x}" for c in code), int(error[j])) for j in range(len(kept))),
            hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_vector_codes_of_any_table(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 8))
    vectors = (centres[rng.integers(0, 9, 400)] + rng.normal(size=(400, 8)) * (0.02 if seed == 1 else 0.4)).round(2)
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    rows += [(7, rows[3][1])] * 200 + [(None, [0.5] * 8), (None, [0.25] * 8)]  # copies, repeated and missing ids
    rows += [(900, None), (901, [1.0, None] * 4), (902, [float("nan")] * 8), (903, [float("inf")] * 8)]
    rng.shuffle(rows)
    table = [(None if i is None else int(i), v, None if k % 5 == 0 else f"l{k % 3}", "own", 1.5)
             for k, (i, v) in enumerate(rows)]
    frame = spark.createDataFrame(
        table, "vec_id long, embedding array<float>, label string, code string, keep double").repartition(5)
    got = ball_codes.compress(frame, entries=40, rounds=3).collect()
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want, digest = plain_codes(single, 4, 40, 3)
    assert Counter((r["vec_id"], r["code"], r["error"]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
    by_label = Counter()
    for r in got:
        by_label[r["label"]] += r["error"]
    assert all(r["label_error"] == by_label[r["label"]] and r["keep"] == 1.5 for r in got)


def test_vector_codes_of_few_or_odd_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert ball_codes.compress(spark.createDataFrame([], schema)).count() == 0
    one = ball_codes.compress(spark.createDataFrame([(5, [1.0, 2.0, 3.0, 4.0], None)], schema)).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in one] == [("00000000", 0, 0)]
    assert one[0]["codebooks_sha256"] == hashlib.sha256(b"1024,2048,3072,4096").hexdigest()
    odd = {r["vec_id"]: (r["code"], r["error"]) for r in ball_codes.compress(spark.createDataFrame(
        [(1, [], 1), (2, [1.0] * 3, 1), (3, [1.0] * 4, 1), (4, [1.0] * 8, 1), (6, [9e30] * 4, 1)], schema)).collect()}
    assert odd[1] == odd[2] == odd[4] == (None, None) and odd[3] == ("00000000", 0) and odd[6][0] == "01010101"


def test_balls_spare_work_and_change_nothing():
    rng = np.random.default_rng(8)
    centres = rng.integers(-3000, 3000, size=(60, 6)).astype(float)
    parts = (centres[rng.integers(0, 60, 3000)] + rng.integers(-90, 90, size=(3000, 6))).astype(float)
    start = ball_codes.Codebook(centres + 3)
    home, far = start.nearest(parts, None)
    radius = np.zeros(60)
    np.maximum.at(radius, home, np.sqrt(far))
    book = ball_codes.Codebook.with_balls(centres, radius + np.sqrt(54.0) + 1e-6)
    compared = []
    plain = book._closest
    book._closest = lambda p, among: compared.append(len(p) * len(among)) or plain(p, among)
    code, far = book.nearest(parts, home)
    every = ((parts[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (code == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert sum(compared) < every.size / 10


# ---- importance ----------------------------------------------------------------------------

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_features(text):
    w = plain_words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain_bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def plain_resample(rows, target, percent=5):
    s = Counter(plain_bucket(f) for _, t in rows for f in plain_features(t))
    t = Counter(plain_bucket(f) for x in target for f in plain_features(x))
    s_all, t_all = s.total(), t.total()
    out = []
    for i, text in rows:
        f = plain_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
                     for b in map(plain_bucket, f))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append((i, len(plain_words(text)), len(f), weight, score))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -math.inf if r[0] is None else r[0]))
    drawn = able[:percent * len(able) // 100]
    return Counter(out), [(r[0], r[4]) for r in drawn]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aB9 .\né日😀\x00", max_size=40), max_size=8))
def test_payloads_of_any_text(texts):
    bucket, doc, n_words = importance.features(pa.array(texts, pa.string()))
    want = Counter((i, plain_bucket(f)) for i, t in enumerate(texts) for f in plain_features(t))
    assert Counter(zip(doc.tolist(), bucket.tolist(), strict=True)) == want
    assert n_words.tolist() == [len(plain_words(t)) for t in texts]


def test_payloads_of_long_words():
    texts = ["x" * 5000 + " y", None, "a " + "é" * 300 + " b " + "z" * 513 + " " + "w" * 512, "x" * 5000]
    bucket, doc, _ = importance.features(pa.array(texts, pa.string()))
    want = Counter((i, plain_bucket(f)) for i, t in enumerate(texts) for f in plain_features(t))
    assert Counter(zip(doc.tolist(), bucket.tolist(), strict=True)) == want


@pytest.mark.parametrize("percent", [5, 60])
def test_resampling_of_any_table(spark, docs, no_docs, rows, percent):
    target = [None, "", "alpha7 beta3 the of and", "the9 of1 and to", rows[5][1]]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs.withColumn("rank", F.lit("own")), frame, percent=percent).collect()
    want, drawn = plain_resample([(i, t) for i, t, _ in rows], target, percent)
    assert Counter((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in got) == want
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["doc_id"], r["score"]) for r in ranked] == drawn
    assert {r["lang"] for r in got} == {None} and {r["block"] for r in got} == {7}
    assert importance.resample(no_docs, frame).count() == 0
    assert importance.resample(docs, frame.limit(0)).count() == len(rows)
