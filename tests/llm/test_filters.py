"""Chat logs, line removal, toxicity, decontamination, mixing, personal data, near duplicates."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebind.llm import chat, decontaminate, line_dedup, mixing, ngram_join, pii, toxicity

SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOG = "conv_id bigint, message int, seq int, event string, role string, text string"


# ---- chat ----------------------------------------------------------------------------------

def fold(events):
    out = {}
    order = ("message", "edit", "regenerate", "delete", "delta")
    for conv, message, seq, event, role, text in sorted(
            events, key=lambda e: (e[2], order.index(e[3]) if e[3] in order else 9, e[5] or "")):
        if event not in order:
            continue
        m = out.setdefault((conv, message), {"seq": seq, "role": role, "text": None, "told": False})
        text = text or ""
        if event == "message" or (m["text"] is None and not m["told"]):
            m["role"] = role if event == "message" or not m["told"] else m["role"]
        m["told"] |= event == "message"
        m["text"] = None if event == "delete" else text if event != "delta" else (m["text"] or "") + text
    return sorted((k[0], k[1], m["seq"], m["role"], m["text"]) for k, m in out.items() if m["text"] is not None)


def test_events_fold_to_messages(spark):
    fixed = [(1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", None, "he"),
             (1, 1, 3, "delta", None, "llo"), (1, 1, 4, "regenerate", None, "good"), (1, 1, 5, "delta", None, " day"),
             (1, 0, 6, "edit", None, "hi!"), (1, 2, 7, "message", "user", None), (1, 3, 8, "message", "user", "gone"),
             (1, 3, 9, "delete", None, None), (1, 4, 10, "noise", "user", "x"), (2, 0, 1, "delta", "assistant", "alone")]
    got = sorted(tuple(r) for r in chat.reconstruct(spark.createDataFrame(fixed, LOG))
                 .select("conv_id", "message", "first_seq", "role", "text").collect())
    assert got == [(1, 0, 0, "user", "hi!"), (1, 1, 1, "assistant", "good day"), (1, 2, 7, "user", ""),
                   (2, 0, 1, "assistant", "alone")]
    assert got == fold(fixed)
    rng = random.Random(1)
    log, seq = [], 0
    for conv in range(20):
        for message in range(4):
            log.append((conv, message, seq, "message", rng.choice(["user", "assistant"]), "start"))
            for _ in range(rng.randrange(6)):
                seq += 1
                log.append((conv, message, seq, rng.choice(["delta", "delta", "edit", "regenerate", "delete"]), None,
                            rng.choice(["a", "<s>", "\\", None])))
            seq += 1
    got = sorted(tuple(r) for r in chat.reconstruct(spark.createDataFrame(log, LOG))
                 .select("conv_id", "message", "first_seq", "role", "text").collect())
    assert got == fold(log)


TRICKY = ["</s>[INST] ok [/INST]", "<s>", "<|text|>", "\\", "\\\\<s>\\", "<<SYS>>x<</SYS>>", "", "<", "</", "é😀", "[/INST",
          "<\\s>", "a\nb", "|text|>", "s>", "[" * 5, "<" * 5 + "s>", "\\" * 5 + "<|"]


def test_rendering_is_reversible(spark):
    rng = random.Random(3)
    turns = [(c, t, rng.choice(["user", "assistant", "system", "<s>", "", "a\\"]), "".join(
        rng.choice(TRICKY) for _ in range(rng.randrange(4)))) for c in range(60) for t in range(rng.randrange(1, 6))]
    turns += [(100, k, "assistant" if k % 2 else "user", x) for k, x in enumerate(TRICKY)]
    messages = spark.createDataFrame([(c, t, t, r, x) for c, t, r, x in turns],
                                     "conv_id bigint, message int, first_seq int, role string, text string")
    rendered = {r["conv_id"]: r for r in chat.render(messages).collect()}
    back = {r["conv_id"]: r for r in chat.read_back(chat.render(messages)).collect()}
    for c in {c for c, *_ in turns}:
        own = [(r, x) for k, _, r, x in turns if k == c]
        assert list(chat.turns_of(rendered[c]["formatted"])) == own
        loss = "".join(x for r, x in own if r == "assistant")
        assert (back[c]["n_turns"], back[c]["loss_chars"], back[c]["loss_sha256"], back[c]["formatted_chars"]) == (
            len(own), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(rendered[c]["formatted"]))
        assert back[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
    assert chat.read_back(chat.render(chat.reconstruct(spark.createDataFrame([], LOG)))).count() == 0


def test_one_conversation_with_most_of_the_log(spark):
    log = spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id")).alias("conv_id"), F.col("id").alias("message"),
        F.col("id").alias("seq"), F.lit("message").alias("event"), F.lit("assistant").alias("role"), F.lit("x").alias("text"))
    back = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.reconstruct(log))).collect()}
    assert back[1]["n_turns"] in (4000, 4001) and len(back) >= 2000


# ---- lines ---------------------------------------------------------------------------------

def near(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < line_dedup.MIN_LENGTH or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def lines_left(rows):
    lines = [(i, p, x) for i, t in rows for p, x in enumerate((t or "").split("\n")) if x]
    gone = {(i, p) for k, (i, p, x) in enumerate(lines) if any(near(x, y) for _, _, y in lines[:k])}
    return {i: "\n".join(x for p, x in enumerate((t or "").split("\n")) if (i, p) not in gone) for i, t in rows}


def edited(rng, s):
    k, c = rng.randrange(len(s) + 1), rng.choice("abxé9語")
    return rng.choice([s[:k] + c + s[k:], s[:k] + s[k + 1:], s[:k] + c + s[k + 1:]])


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_brute_force(spark, seed):
    rng, rows = random.Random(seed), [(None, "first of all lines\nabcdefghijkl")]
    base = ["abcdefghijkl", "the quick brown fox é jumps", "a" * 14, "short", "0123456789", "日本語のテキストは長いです", "ab" * 8]
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(7)):
            s = rng.choice([*base, ""])
            for _ in range(rng.randrange(3)):
                s = edited(rng, s)
            lines.append(s)
        rows.append((i * 3 - 40, "\n".join(lines)))
    rows += [(1000, None), (1001, "\n\n"), (1002, "y" * 3000 + "1"), (1003, "y" * 3000 + "2")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = lines_left(rows)
    assert {r["doc_id"]: r["text"] for r in out} == want
    for r in out:
        assert r["n_kept"] == sum(x != "" for x in want[r["doc_id"]].split("\n"))
        assert r["n_lines"] >= r["n_kept"]


def test_lines_of_any_table(docs, no_docs, rows):
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_kept"]
    assert out.count() == len(rows) and out.filter("pos <> 7 OR _kept <> 'own'").count() == 0
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_lines_of_rows_that_share_an_id(spark):
    """Every line stays somewhere: only lines that are equal or near to an earlier one go."""
    given = [(1, "the quick brown fox jumps"), (7, "a line that only this row holds"),
             (7, "the quick brown fox jumpz\nshared by both rows"), (8, "shared by both rows\nlast line of all"),
             (None, "rows without an id come first"), (None, "another row without an id\nrows without an id come first"),
             (9, "another row without an id"), (9, "another row without an id")]
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(given)], "doc_id bigint, text string, k int")
    got = {r["k"]: r["text"] for r in line_dedup.dedup_lines(frame).collect()}
    assert got == {0: given[0][1], 1: given[1][1], 2: "shared by both rows", 3: "last line of all", 4: given[4][1],
                   5: "another row without an id", 6: "", 7: ""}
    rng, rows = random.Random(5), []
    for _ in range(50):
        rows.append((rng.choice([None, 3, 4]), "\n".join(sorted({"%030x" % rng.getrandbits(120) for _ in range(rng.randrange(1, 5))}))))
    rows += rows[:5]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)  # no two lines are alike


# ---- toxicity ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def toxic_world(spark):
    """Marker words in one of four documents, sometimes written to hide them."""
    rng, rows, labels = random.Random(8), [], []
    clean = [a + b for a in ("tha", "ing", "ere", "ond", "ast") for b in ("lor", "sen", "dip", "mat", "kro")]
    for i in range(700):
        words, bad = [rng.choice(clean) for _ in range(rng.randrange(1, 40))], i % 4 == 0
        if bad:
            marker = rng.choice(["moron", "idiot", "stupid"])
            hidden = {0: marker.replace("o", "0").replace("i", "1"), 1: " ".join(marker), 2: marker.replace("o", "ooo")}
            words.insert(rng.randrange(len(words) + 1), hidden.get(i % 12 // 4 if i > 400 else 9, marker))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(rows, "doc_id bigint, text string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_toxicity_on_held_out_rows(spark, toxic_world, docs, no_docs, rows):
    texts, labels = toxic_world
    model = toxicity.train(texts, labels)
    out = toxicity.score(texts, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    for r in out:
        assert r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in out if r["held"]]
    right = [r for r in held if r["predicted"] == (r["doc_id"] % 4 == 0)]
    assert len(right) >= 0.95 * len(held) and sum(r["predicted"] for r in held) > 10
    # labels of held-out rows are not learned from
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(texts, turned)
    assert again.markers == model.markers and (again.weights == model.weights).all()
    decode = model.decoder()
    assert [decode(w) for w in ("m0r0n", "1d10t", "st.u.p.i.d", "idiooot")] == ["moron", "idiot", "stupid", "idiot"]
    scored = toxicity.score(docs, model)
    assert scored.count() == len(rows) and scored.filter("score IS NULL").count() == 0
    assert sorted(scored.columns) == sorted([*docs.columns, "predicted"])
    assert toxicity.score(no_docs, model).count() == 0


def test_toxicity_without_labels(spark, toxic_world, no_docs):
    texts, labels = toxic_world
    for none in (labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int")), labels.filter("toxic = 0")):
        scores = toxicity.score(texts, toxicity.train(texts, none)).select("score", "predicted").distinct().collect()
        assert len(scores) == 1
    model = toxicity.train(no_docs, labels)
    assert toxicity.score(texts, model).count() == 700


HIDDEN = {
    "stupid": ["sstupid", "stuppid", "STTUPID", "sStupid", "5tupid", "stup|d", "s-t-u-p-i-d", "stu.pid"],
    "idiot": ["iidiot", "iIidiot", "IiIiIdiot", "idio7", "idio+", "idi0t!", "1diot", "idi0t$", "(idi0t)", "idiotT"],
    "obese": ["08353", "0bese", "obes3", "08E5E"], "ass": ["4$$", "a$$", "4ss", "455", "4$$!"], "télé": ["téélé", "TÉÉLÉ", "7élé"],
}


def test_every_form_that_the_lattice_models_is_restored():
    model = toxicity.Model(toxicity.np.zeros(28 ** 3), dict.fromkeys(HIDDEN, 5.0), toxicity.np.zeros(4))
    forms = [f for some in HIDDEN.values() for f in some]
    texts = toxicity.pa.array([t for f in forms for t in (f, f"so {f}, then {f}")])
    evidence = toxicity._evidence(texts, model, model.decoder(), model.table())
    assert [t for t, n in zip(texts.to_pylist(), evidence[:, 2], strict=True) if n != 1] == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abIi7$!|+(€£.-'é日 ", max_size=12), max_size=5))
def test_the_prefilter_passes_what_the_lattice_changes(texts):
    texts = toxicity.lowered(toxicity.pa.array(texts, toxicity.pa.string()))
    w = toxicity.words(texts, toxicity.SPACED)
    passed = toxicity._suspects(w.data, w.start, w.end)
    for start, end, odd in zip(w.start, w.end, passed, strict=True):
        word = w.data[start:end].tobytes().decode()
        assert odd == any(len(o) > 1 for o in toxicity.lattice(word))
        inside = toxicity._STRIPPED.sub("", word)
        assert (inside in toxicity.readings(word)) == any(len(o) > 1 for o in toxicity.lattice(inside))


def test_each_distinct_word_is_decoded_once():
    calls = []
    model = toxicity.Model(toxicity.np.zeros(28 ** 3), {"idiot": 5.0}, toxicity.np.zeros(4))
    texts = toxicity.pa.array(["iidiot idio7 iidiot", "iidiot", "plain words", None] * 50)
    toxicity._evidence(texts, model, lambda t: calls.append(t) or t, model.table())
    assert sorted(calls) == ["idio7", "iidiot"]


def test_marker_beginnings_are_cut_by_characters():
    markers = ["réeu*", "réeuxa*", "éêàüöñ*", "дура*", "дурачь*", "été"]
    model = toxicity.Model(toxicity.np.zeros(28 ** 3), dict.fromkeys(markers, 5.0), toxicity.np.zeros(4))
    found = {"réeuxati": 2, "RÉEUXATI": 2, "Réeux": 1, "réeu": 0, "éêàüöñu": 1, "ÉÊÀÜÖÑU": 1, "éêàüöñ": 0,
             "ДУРАЧЬЁ": 2, "дурак": 1, "дура": 0, "ÉTÉ": 1, "x réeuxab, Été.": 3, "": 0}
    texts = toxicity.pa.array([*found, None], toxicity.pa.string())
    evidence = toxicity._evidence(texts, model, model.decoder(), model.table())
    assert dict(zip(found, evidence[:, 2], strict=False)) == found and evidence[-1, 2] == 0
    # bytes that are not UTF-8 do not stop a task
    raw = toxicity.pa.array([b"\xff R\xc3\x89EUXATI"])
    broken = toxicity.pa.Array.from_buffers(toxicity.pa.string(), 1, raw.buffers())
    assert toxicity._evidence(broken, model, model.decoder(), model.table())[0, 2] == 2


# ---- decontamination -----------------------------------------------------------------------

def tokens(text):
    return re.findall(ALNUM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contained(rows, items):
    out = Counter()
    for i, t in rows:
        w = tokens(t)
        for k, x in items:
            q = tokens(x)
            n = min(5, len(q))
            own = {tuple(q[a:a + n]) for a in range(len(q) - n + 1)} if q else set()
            there = {tuple(w[a:a + n]) for a in range(len(w) - n + 1)} if q else set()
            if own and len(own & there) >= 0.8 * len(own):
                out[i, k, round(len(own & there) / len(own), 9)] += 1
    return out


def test_items_against_brute_force(spark):
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(300)}" for _ in range(n))) for k, n in enumerate(
        [1, 2, 4, 5, 6, 9, 12, 15, 16, 17, 31, 33, 64, 100, 300])]
    items += [(50, None), (51, ""), (52, "?!"), (None, "alone in the list of all items here"), (53, items[9][1])]
    rows = []
    for i in range(120):
        text = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(400))]
        if i % 2:
            part = tokens(rng.choice(items)[1])
            for _ in range(rng.randrange(3)):
                if part:
                    part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = [x.upper() + "," for x in part]
        rows.append((i, " ".join(text)))
    rows += [(500, None), (501, ""), (None, items[10][1]), (7, rows[7][1]), (502, "w1 " * 30000 + items[11][1])]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    want = contained(rows, items)
    for limit in (decontaminate.MAX_INDEX_BYTES, 0):
        got = Counter((r["doc_id"], r["item_id"], round(r["containment"], 9))
                      for r in decontaminate.find_items(d, b, max_index_bytes=limit).collect())
        assert got == want
        left = Counter((r["doc_id"], r["text"]) for r in decontaminate.decontaminate(d, b, max_index_bytes=limit).collect())
        hit = {i for i, _, _ in want}
        assert left == Counter(r for r in rows if r[0] not in hit)
        assert decontaminate.find_items(d.limit(0), b, max_index_bytes=limit).count() == 0
        assert decontaminate.find_items(d, b.limit(0), max_index_bytes=limit).count() == 0


# ---- mixing --------------------------------------------------------------------------------

def reshared(sizes, weights, share=1.5, cap=2):
    left, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_ and left > 1e-9:
        total = sum(weights[k] for k in open_)
        add = {k: left * weights[k] / total for k in open_}
        left = 0.0
        for k, x in add.items():
            target[k] += x
            if target[k] >= cap * sizes[k]:
                left += target[k] - cap * sizes[k]
                target[k] = float(cap * sizes[k])
                open_.discard(k)
    return target


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=7))
def test_targets_against_resharing(spark, sizes):
    rows = [(None if k == len(sizes) - 1 else f"s{k}", n) for k, n in enumerate(sizes)]
    got = {r["source"]: r["target"] for r in mixing.targets(
        spark.createDataFrame(rows, "source string, source_size bigint")).collect()}
    want = reshared(sizes, [(3, 1, 2)[k % 3] for k in range(len(sizes))])
    for (name, _), t in zip(rows, want, strict=True):
        assert got[name] == pytest.approx(t, abs=1e-6)


def test_the_mix_comes_to_its_targets(docs, no_docs, rows):
    marks = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 4.0).alias("weight")).distinct()
    out = mixing.mix(docs, marks).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() >= {"node", "block", "taken"}
    by = defaultdict(list)
    for r in out:
        by[r["source"]].append(r)
        assert r["size"] == len(re.findall(SPACED, r["text"] or "")) and 0 <= r["taken"] <= 2 * r["size"]
        assert r["epochs"] * r["size"] <= r["taken"]
    for own in by.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < 1
        assert own[0]["source_size"] == sum(r["size"] for r in own)
    again = mixing.mix(docs.repartition(3), marks)
    assert Counter((r["doc_id"], r["text"], r["taken"]) for r in again.collect()) == Counter(
        (r["doc_id"], r["text"], r["taken"]) for r in out)
    assert mixing.mix(no_docs).count() == 0


def test_heavier_documents_are_drawn_more_often(spark):
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    marks = d.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0).alias("weight"))
    drawn = mixing.mix(d, marks, share=0.5).filter("taken > 0")
    n = {r["k"]: r["count"] for r in drawn.groupBy((F.col("doc_id") % 2).alias("k")).count().collect()}
    assert n[0] + n[1] == 2000 and 1.6 < n[0] / n[1] < 2.6


def test_the_query_by_quality_uses_the_marks(spark, tmp_path):
    import duckdb

    from casebind.llm.queries import ORACLES, QUERIES
    rng = random.Random(5)
    (spark.createDataFrame([(i, "w " * rng.randrange(1, 9), f"s{i % 3}") for i in range(900)],
                           "doc_id bigint, text string, source string")
     .coalesce(1).write.parquet(f"{tmp_path}/documents.parquet"))
    # good, poor, without a mark, and marked several times
    marks = [(i, q, 0) for i in range(900) for q in ([1], [0], [None], [1, 1, 0])[i % 4]]
    (spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
     .coalesce(1).write.parquet(f"{tmp_path}/labels.parquet"))
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    taken = {}
    for name in ("op8_mixing", "op8_mixing_by_quality"):
        ours = QUERIES[name](spark, str(tmp_path)).collect()
        taken[name] = {r["doc_id"]: r["taken"] for r in ours}
        assert taken[name] == {r[0]: r[4] for r in con.execute(ORACLES[name]).fetchall()}
    extra = {k: sum(taken["op8_mixing_by_quality"][i] - taken["op8_mixing"][i] for i in range(900) if i % 4 in k)
             for k in ((0, 3), (1, 2))}
    assert extra[0, 3] > 100 and extra[1, 2] < -100


# ---- personal data -------------------------------------------------------------------------

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def by_the_rules(text):
    out = []
    for kind, pattern in RULES.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group(0))
            if {"email": lambda: True, "ip": lambda: max(map(int, m.group(0).split("."))) <= 255,
                    "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                    "phone": lambda: 8 <= len(digits) <= 15}[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_the_rules(spark, docs, no_docs):
    rng, texts = random.Random(5), []
    for letters, n, size in (("a.b@c-d_e+%1 (2)3-4.5é9 00+25@x.y:;", 700, 60), ("0123456789 -.", 700, 90), ("0123456789 -", 200, 200)):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(size))) for _ in range(n)]
    texts += [None, "", "000.0.0255.1 1.2.3.4.5.6.7.8 256.1.1.1", "a@b.c_d@e.f a@b.c.d@e.f.g x@y", "1" * 20000, "a" * 50000,
              "a." * 20000, "+1" + " " * 20000, "😀 a@b.co é 4111 1111 1111 1111", "1-" * 20000, "a@" + "b." * 5000 + "c",
              "4111111111111111, " * 300, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" a@b.cd']
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in pii.find_spans(d).collect()}
    for i, t in enumerate(texts):
        assert [tuple(s) for s in out[i]["base"]] == by_the_rules(t), repr(t)[:90]
        for s in out[i]["added"]:  # apart from the base and inside the text
            assert 0 <= s["start"] < s["end"] <= len(t)
            assert not any(b["start"] < s["end"] and b["end"] > s["start"] for b in out[i]["base"])
    assert pii.find_spans(docs).count() == docs.count()
    assert pii.find_spans(no_docs).count() == 0


def test_trees_learn_from_every_candidate(spark, monkeypatch):
    texts = spark.range(12_000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit('token = "'), F.sha1(F.col("id").cast("string").cast("binary")), F.lit('"')).alias("text"))
    found = texts.select("doc_id", pii.candidates(F.col("text"), pii.base_spans(F.col("text"))).alias("candidates"))
    kept, write = [], pii.staged
    monkeypatch.setattr(pii, "staged", lambda df, label: kept.append(write(df, label)) or kept[-1])
    pii.train(found)
    assert kept[0].count() == found.agg(F.sum(F.size("candidates"))).first()[0] > 20_000


def test_trees_add_secrets_and_redaction_replaces_spans(spark):
    rng, rows = random.Random(9), []
    for i in range(1200):
        hexed = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        rows.append((i, [f"foo bar token = \"{hexed}\" baz", f"write to me{i}@mail.example.com now",
                         f"just words and {rng.randrange(10**6, 10**8)} things", "longwordwithoutanydigits" + "x" * (i % 9)][i % 4]))
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pii.find_spans(d)
    out = {r["doc_id"]: r for r in found.collect()}
    assert sum(len(out[i]["added"]) > 0 for i in range(0, 1200, 4)) > 250
    assert not any(out[i]["added"] for i in range(3, 1200, 4))
    clean = {r["doc_id"]: r["t"] for r in d.join(found, "doc_id").select(
        "doc_id", pii.redacted(F.col("text"), F.concat("base", "added")).alias("t")).collect()}
    assert clean[1] == "write to [email] now" and re.search("[0-9a-f]{40}", clean[0]) is None


# ---- near duplicates -----------------------------------------------------------------------

def links_of(rows):
    text = {}
    for i, t in rows:
        text.setdefault(t or "", []).append(i)
    sets = {}
    for t in text:
        w = re.findall(SPACED, t)
        sets[t] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links = {t: [u for u in text if u != t and sets[t] and len(sets[t] & sets[u]) >= 0.8 * len(sets[t] | sets[u])] for t in text}
    ids, out = {t: min(i for i in own if i is not None) for t, own in text.items() if any(i is not None for i in own)}, {}
    for t in ids:
        seen, todo = {t}, [t]
        while todo:
            todo += [u for u in links[todo.pop()] if u not in seen and not seen.add(u)]
        for i in text[t]:
            out[i, t] = (ids[t], len(text[t]), len(links[t]), min(ids[u] for u in seen))
    return out


def test_near_duplicates_against_brute_force(docs, no_docs, rows, monkeypatch):
    own = [(i, t) for i, t, _ in rows if i is not None]
    want = links_of(own)
    assert sum(v[2] for v in want.values()) > 50
    given_docs = docs.filter("doc_id IS NOT NULL")
    for chunk in (1000, 4):  # whole clusters, and clusters cut into tiles
        monkeypatch.setattr(ngram_join, "CHUNK_ROWS", chunk)
        out = ngram_join.near_duplicates(given_docs).collect()
        assert len(out) == len(own)
        got = {r["doc_id"]: (r["class_id"], r["n_copies"], r["n_links"], r["group_id"]) for r in out}
        assert got == {i: v for (i, _), v in want.items()}
    every = ngram_join.near_duplicates(docs)
    assert every.count() == len(rows) and every.filter("group_id IS NULL OR n_links IS NULL").count() == 0
    assert ngram_join.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_group_stays(docs, rows):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    groups = {v[3] for v in links_of([(i, t) for i, t, _ in rows if i is not None]).values()}
    assert {i for i in left if i is not None} <= groups
    assert len(left) == len(set(left) - {None}) + left.count(None)


def test_rows_that_share_an_id_are_texts_of_their_own(spark):
    base = [f"w{k}" for k in range(60)]
    other = [f"v{k}" for k in range(60)]

    def near(words, k):
        return " ".join([*words[:k], "x", *words[k + 1:]])

    given = [(3, " ".join(base)), (7, near(base, 59)), (7, " ".join(other)), (7, "a text of nobody else " * 3),
             (9, near(other, 0)), (9, near(other, 0)), (10, "alone here"), (10, "alone here"), (None, "alone here"),
             (None, " ".join(f"u{k}" for k in range(60)))]
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(given)], "doc_id bigint, text string, k int")
    kept = sorted(r["k"] for r in ngram_join.one_of_each(frame).collect())
    # one of 0 and 1, one of 2, 4 and 5, row 3, one of 6, 7 and 8, row 9
    assert len(kept) == 5 and {3, 9} <= set(kept)
    assert len({0, 1} & set(kept)) == len({2, 4, 5} & set(kept)) == len({6, 7, 8} & set(kept)) == 1


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = ngram_join.bands_for(threshold)
        assert 1 - (1 - threshold ** rows) ** bands >= ngram_join.RECALL and bands * rows <= ngram_join.MAX_HASHES


def test_components_of_paths_and_hubs(spark):
    from casebind.llm.components import components
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 400)] + [(500, 501), (501, 500), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 400)}, 501: 500}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# ---- pipeline ------------------------------------------------------------------------------

def test_pipeline_stages(spark, docs, toxic_world, tmp_path):
    import corpus_pipeline
    texts, labels = toxic_world
    rng = random.Random(12)
    item = " ".join(f"item{rng.randrange(100)}" for _ in range(30))
    more = texts.union(spark.createDataFrame(
        [(9000, "some start\n" + item + "\nand the end of it"), (9001, "a plain and clean text of its own\n" + "z" * 60)],
        "doc_id bigint, text string"))
    whole = docs.select("*").unionByName(more, allowMissingColumns=True)
    whole.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, counts = now.columns, [now.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/out{k}")
        now = spark.read.parquet(f"{tmp_path}/out{k}")
        counts.append(now.count())
        assert now.columns == columns or k == 4, name
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0] - 150 and counts[-1] > 0
    ids = {r["doc_id"] for r in now.collect()}
    assert 9000 not in ids and 9001 in {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/out3").collect()}
    # own columns with the names of added ones keep their values
    kept = spark.read.parquet(f"{tmp_path}/out3").filter("score IS NOT NULL")
    assert kept.count() > 0 and kept.filter("score <> 'own' OR _kept <> 'own' OR n_lines <> 'own'").count() == 0
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(map(str, ran.collect())) == Counter(map(str, now.collect()))


def test_pipeline_of_empty_tables(spark, docs, toxic_world, tmp_path):
    import corpus_pipeline
    _, labels = toxic_world
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
