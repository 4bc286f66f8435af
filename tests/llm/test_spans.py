"""Words and shingles, substring removal, fingerprints, licences."""

import functools
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebind.llm import arrays, fingerprints, license_scan
from casebind.llm.substring_dedup import dedup_substrings, parse

SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.just("w" * 300)), max_size=8))
def test_words_of_any_text(texts):
    column = pa.array([None if t is None else t.encode("utf8", "ignore").decode() for t in texts], pa.large_string())
    for kind, pattern, lower in ((arrays.SPACED, SPACED, False), (arrays.ALPHANUMERIC, ALNUM, True)):
        w = arrays.words(column, kind, lower)
        raw = w.data.tobytes()
        got = [[raw[s:e].decode() for s, e in zip(w.start[a:b], w.end[a:b], strict=True)]
               for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        want = [re.findall(pattern, lowered(t or "") if lower else t or "") for t in column.to_pylist()]
        assert got == want
        flat = [x for ws in want for x in ws]
        assert len(set(w.hash.tolist())) == len(set(flat))


def test_a_slice_of_a_column_hashes_alike():
    column = pa.array(["a b", "c d e", None, "a b c d e f g"], pa.string())
    whole, part = arrays.words(column), arrays.words(column.slice(1, 3))
    assert part.hash.tolist() == whole.hash[2:].tolist()
    assert [t.num_rows for t in arrays.pieces(pa.table({"text": column}), "text", 8)] == [3, 1]


def removal(rows, n=13):
    first, out = {}, Counter()
    for i, t, _ in rows:
        w = re.findall(SPACED, t or "")
        for k in range(len(w) - n + 1):
            if i is not None:
                key = tuple(w[k:k + n])
                first[key] = min(i, first.get(key, i))
    for i, t, _ in rows:
        w = re.findall(SPACED, t or "")
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k:k + n])] < i:
                gone[k:k + n] = [True] * n
        out[i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)] += 1
    return out


def test_substrings_against_brute_force(docs, no_docs, rows):
    for block in (2_000, 8 << 20):  # many blocks and shards, and one
        out = dedup_substrings(docs, block_bytes=block).collect()
        got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out)
        assert got == removal(rows)
        assert sum(r["n_removed"] for r in out) > 300
        for r in out:  # factors cover what is removed
            covered = set()
            for f in r["factors"]:
                assert f["n_words"] >= 13
                covered |= set(range(f["first_word"], f["first_word"] + f["n_words"]))
            assert len(covered) == r["n_removed"]
    assert dedup_substrings(no_docs).count() == 0


def test_factors_end_where_the_block_changes():
    assert parse(np.array([-1, 2, 2, 5, -1, 5]), 13) == [(1, 14, 2), (3, 13, 5), (5, 13, 5)]
    assert parse(np.array([-1, -1]), 13) == []


def shingle_set(t):
    w = re.findall(SPACED, t)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def mix64(h):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 1):
        h = ((h ^ h >> 33) * factor) % 2 ** 64
    return h


def word_hash(word):
    raw = word.encode()
    if len(raw) > 256:
        return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    h = mix64(len(raw) + 0x9E3779B97F4A7C15)
    for k in range(0, len(raw), 8):
        h = mix64((h * 0x9E3779B97F4A7C15 + int.from_bytes(raw[k:k + 8], "little")) % 2 ** 64)
    return h


def plain_sketch(t):
    """Distinct shingle hashes below a quarter of the range, else the least one."""
    out = set()
    for run in shingle_set(t):
        short = len(run) < 5
        h = 0
        for word in run:
            h = (h * (0x9E3779B97F4A7C15 if short else 0xD6E8FEB86659FD93) + word_hash(word)) % 2 ** 64
        out.add(mix64(h ^ 0xFF51AFD7ED558CCD if short else h))
    return {h for h in out if h < 2 ** 62} or set(sorted(out)[:1])


def plain_likeness(a, b):
    if max([*a, *b], default=2 ** 62) >= 2 ** 62:  # at least one has but a least hash
        return float(a == b)
    return len(a & b) / len(a | b)


def test_fingerprints_of_edited_texts(docs, no_docs, rows):
    order = sorted(((-(1 << 63) if i is None else i, t or "") for i, t, _ in rows))
    for block in (2_000, 8 << 20):
        out = fingerprints.compared(docs, block_bytes=block).collect()
        got = Counter((r["doc_id"], r["n_chars"], r["edited"]) for r in out)
        want = Counter()
        for k, (i, t) in enumerate(order):
            n, half = order[(k + 1) % len(order)][1], len(t) // 2
            want[None if i == -(1 << 63) else i, len(t), t[:len(t) - half] + n[:half]] += 1
        assert got == want
        want = Counter()
        for k, (i, t) in enumerate(order):
            n, half = order[(k + 1) % len(order)][1], len(t) // 2
            own, edited, after = map(plain_sketch, (t, t[:len(t) - half] + n[:half], n))
            want[(None if i == -(1 << 63) else i, *("".join(f"{h:016x}" for h in sorted(x)) for x in (own, edited)),
                  plain_likeness(own, edited), plain_likeness(own, after))] += 1
        assert Counter((r["doc_id"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"])
                       for r in out) == want
    assert fingerprints.compared(no_docs).count() == 0


def test_sketches_estimate_and_merge(docs):
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(8000))
    part = " ".join(long.split()[2000:4000])
    big, small, same, empty, other, none = fingerprints.sketches([long, part, part, "", "a b", None])
    assert str(small) == str(same) and small.likeness(same) == 1 and str(empty) == str(none)
    assert small.containment(big) == 1 and abs(big.containment(small) - 0.25) < 0.06
    assert abs(big.likeness(small) - 0.25) < 0.06
    assert empty.likeness(none) == 1 and empty.likeness(other) == 0
    assert empty.containment(big) is None and other.containment(big) in (None, 0)
    assert str(big.merged(small)) == str(big)
    assert str(fingerprints.Sketch.read(str(big))) == str(big)
    words = long.split()
    passages = fingerprints.sketches([" ".join(words[k:k + 24]) for k in range(0, 7200, 24)])
    known = [p.containment(big) for p in passages]
    assert set(known) <= {1, None} and known.count(None) <= 5  # a short passage in a long text
    whole = functools.reduce(fingerprints.Sketch.merged, passages)
    assert whole.containment(big) == 1 and abs(len(whole.kept) * 4 / (300 * 20) - 1) < 0.1
    made = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    assert made[-9] == str(empty)  # a null text


def base_places(text, phrases):
    w = re.findall(ALNUM, lowered(text or ""))
    return len(w), sorted((k, label) for p, label in phrases.items() for q in [p.split()]
                          for k in range(len(w)) if w[k:k + len(q)] == q)


def test_licences_against_brute_force(spark, docs, no_docs, rows):
    texts = ["All RIGHTS reserved, cc-by cc by general public license; general public license",
             "The GNU General Public License, version 3. all rights, all rights reserved",
             "permission is hereby granted free of charge to any person obtaining a copy of this work and "
             "associated documentation files to deal in the software without restriction",
             "cc\nby cc by", "x " * 40000 + "all rights reserved", "cc by" * 3, "by cc by cc"]
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved",
               "by cc": "turned", "rights reserved": "short"}
    more = docs.select("doc_id", "text").union(spark.createDataFrame(
        [(1000 + k, t) for k, t in enumerate(texts)], "doc_id bigint, text string"))
    given_texts = [(i, t) for i, t, _ in rows] + [(1000 + k, t) for k, t in enumerate(texts)]
    for use in (license_scan.PHRASES, phrases):
        out = license_scan.scan_licences(more, use).collect()
        got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                      for r in out)
        want = Counter()
        for i, t in given_texts:
            n, at = base_places(t, use)
            want[i, n, len(at), at[0][0] if at else None, at[-1][0] if at else None,
                 ",".join(sorted({x for _, x in at}))] += 1
        assert got == want
        assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in out)
        labels = {r["doc_id"]: (r["labels"], r["score"]) for r in out}
        assert "mit" in labels[1002][0] and 0.6 < labels[1002][1] < 1
        assert labels[-6][1] == 0
    assert license_scan.scan_licences(no_docs).count() == 0


def test_phrases_of_one_word_and_paragraphs_of_notices(spark):
    rows = [(1, "quite proprietary stuff"), (2, "proprietary"), (3, "nothing here"), (4, "proprietary, proprietary")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = license_scan.scan_licences(d, {"proprietary": "closed", "quite proprietary": "very"}).collect()
    assert {r["doc_id"]: (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out} == {
        1: (2, 0, 1, "closed,very"), 2: (1, 0, 0, "closed"), 3: (0, None, None, ""), 4: (2, 0, 1, "closed")}
    kept = [(10, "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                 "endorse or promote products derived from this software without specific prior written permission."),
            (11, "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                 "CONDITIONS OF ANY KIND, either express or implied."),
            (12, "in the use of this software and in all copies of the work, the above is without any of the terms")]
    out = license_scan.scan_licences(spark.createDataFrame(kept, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in out} == {10: "bsd", 11: "apache-2.0", 12: ""}


def test_every_notice_is_found_whole_and_with_a_word_changed(spark):
    rows = []
    for k, (_, text) in enumerate(license_scan.NOTICES):
        w = text.split()
        rows += [(2 * k, "Some prose before. " + text + ". More after"),
                 (2 * k + 1, " ".join([*w[:len(w) // 2], "xqz", *w[len(w) // 2 + 1:]]))]
    out = {r["doc_id"]: r for r in license_scan.scan_licences(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for k, (label, text) in enumerate(license_scan.NOTICES):
        assert label in out[2 * k]["labels"].split(",") and out[2 * k]["score"] > 0.85
        if len(text.split()) >= 12:
            assert label in out[2 * k + 1]["labels"].split(",")


def test_matching_statistics_against_brute_force():
    rng = random.Random(2)
    for _ in range(30):
        templates = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(3)]
        text = [rng.randrange(4) for _ in range(30)]
        a = license_scan.Automaton(templates)
        runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i, len(t) + 1)}
        got = list(a.statistics(text))
        for k, (length, state) in enumerate(got):
            want = max(n for n in range(k + 2) if tuple(text[k + 1 - n:k + 1]) in runs)
            assert length == want
            for t, end in a.ends[state].items() if length else ():
                match = text[k + 1 - length:k + 1]
                assert templates[t][end - length:end] == match


def test_digests_are_of_the_kept_words(spark):
    from casebind.llm.queries import QUERIES
    row = QUERIES["op1_substring_dedup"](spark, "/root/testdata/sf0.001").filter("doc_id = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(F.col("doc_id") == 0).first()["text"]
    assert row["kept_sha256"] == hashlib.sha256(" ".join(re.findall(SPACED, text)).encode()).hexdigest()
