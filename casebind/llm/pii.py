"""Personal data in texts: candidate spans, boosted trees, redaction; built-in functions only.

Rules with a check (Luhn digit, address parts, digit counts) give base spans that always count.
Beside them generators of high recall propose overlapping spans: long digit runs, anything
around an ``@``, long code-like strings, values after words like ``password``. Gradient-boosted
trees (MLlib) score each by its format and context. They learn from three in four of all
candidates, marked by the base rules and by key words before the value; each generator's
threshold is the lowest score that keeps ``PRECISION`` on the others. The candidates' features
are kept on disk and learned from in parallel, so no task or driver holds them. Trees are applied
as one SQL expression, in the row of the text.

All patterns are written so that matching never backtracks into what it has taken, which keeps
the time linear in the text and the stack flat. No text is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebind.sources.staging import staged

PRECISION = 0.98
TREES, DEPTH = 10, 3

# What counts as each kind. Possessive forms of the rules; a word run is entered at
# its beginning (or where the match before ended), as the leftmost match would.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # runs of 16 to 19 digits, from their beginning to their end
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}

GENERATORS = {
    "number": r"\+?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
    "contact": r"(?:(?<![^\s@<>()\[\]])|\G)[^\s@<>()\[\]]++@[^\s@<>()\[\]]++",
    "code": r"(?:(?<![A-Za-z0-9+/_-])|\G)[A-Za-z0-9+/_-]{16,}+",
    "value": r"(?i)(?:password|passwd|secret|token|api[_-]?key)[\s=:\"']{1,4}+[^\s\"']{6,}+",
}
_TRIED = {"number": "[0-9]", "contact": "@", "code": r"[A-Za-z0-9+/_-]{16}",
          "value": "(?i)passw|secret|token|key"}
_CONTEXT = {
    "contact": r"(?i)mail|phone|tel|call|fax|contact",
    "payment": r"(?i)card|visa|pay|account|iban",
    "secret": r"(?i)passw|secret|token|key|pwd",
}
_SPAN = "array<struct<start: int, end: int, hit: string>>"
BEFORE = 24


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once though a lambda uses it for every entry."""
    return F.get(F.transform(F.array(value), body), 0)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _sums_before(numbers: Column) -> Column:
    """Per entry the sum of those before it, by way of sums over blocks of root-many entries."""
    block = F.greatest(F.ceil(F.sqrt(F.size(numbers))).cast("int"), F.lit(1))
    cuts = F.sequence(F.lit(0), F.floor(F.size(numbers) / block).cast("int"))

    def within(blocks: Column) -> Column:
        starts = F.transform(cuts, lambda j: _sum(F.slice(blocks, F.lit(1), j)))
        return _let(starts, lambda first: F.transform(numbers, lambda _, i: (
            F.get(first, F.floor(i / block).cast("int"))
            + _sum(F.slice(numbers, (F.floor(i / block) * block + 1).cast("int"), i % block)))))

    return _let(F.transform(cuts, lambda j: _sum(F.slice(numbers, j * block + 1, block))), within)


def spans_of(text: Column, pattern: str, needs: str | None = None) -> Column:
    """Leftmost matches that do not overlap: start, end (code points, exclusive) and text."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.filter(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit")),
                     lambda p: p["hit"].isNotNull())  # but the gap after the last match
    sized = F.transform(parts, lambda p: F.struct(
        F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("size"), p["hit"].alias("hit")))

    def placed(parts: Column) -> Column:
        sizes = F.transform(parts, lambda p: p["gap"] + p["size"])
        return F.transform(
            F.arrays_zip(parts.alias("part"), _let(sizes, _sums_before).alias("before")),
            lambda x: F.struct((x["before"] + x["part"]["gap"]).alias("start"),
                               (x["before"] + x["part"]["gap"] + x["part"]["size"]).alias("end"),
                               x["part"]["hit"].alias("hit")))

    return F.when(text.rlike(needs or pattern), _let(sized, placed)).otherwise(F.array().cast(_SPAN))


def _valid(kind: str, hit: Column) -> Column:
    """The check of a kind on what its pattern matched."""
    digits = F.regexp_replace(hit, "[^0-9]++", "")
    part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?<=0))"
    return {
        "email": F.lit(True),
        "ip": hit.rlike(rf"^{part}\.{part}\.{part}\.{part}$"),
        "card": F.when(F.length(digits).between(16, 19), F.call_function("luhn_check", digits)).otherwise(False),
        "phone": F.length(digits).between(8, 15),
    }[kind]


def base_spans(text: Column) -> Column:
    """kind, start and end of what the base rules find, by kind as listed, then start."""
    def of(kind: str) -> Column:
        good = F.filter(spans_of(text, BASE[kind], _NEEDS[kind]), lambda s: _valid(kind, s["hit"]))
        return F.transform(good, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return F.concat(*map(of, BASE))


FEATURES = ("length", "digits", "digit_share", "upper_share", "hex", "at", "dots", "separators",
            "plus", "near_contact", "near_payment", "near_secret", "quoted", "generator")


def candidates(text: Column, base: Column) -> Column:
    """Spans of all generators with features, and the mark they are learned by."""
    def described(s: Column, name: str, number: int) -> Column:
        hit = s["hit"]
        begin = F.greatest(s["start"] - BEFORE, F.lit(0))
        before = F.substring(text, begin + 1, s["start"] - begin)
        n = F.length(hit).cast("double")

        def of(chars: str) -> Column:
            return n - F.length(F.regexp_replace(hit, chars, ""))

        near = {k: before.rlike(p) for k, p in _CONTEXT.items()}
        values = {
            "length": n, "digits": of("[0-9]"), "digit_share": of("[0-9]") / n,
            "upper_share": of("[A-Z]") / n, "hex": hit.rlike("^[0-9a-fA-F]++$"),
            "at": F.contains(hit, F.lit("@")), "dots": of(r"\."), "separators": of(r"[\x20()-]"),
            "plus": F.startswith(hit, F.lit("+")), "near_contact": near["contact"],
            "near_payment": near["payment"], "near_secret": near["secret"],
            "quoted": before.rlike("[\"'=:]$"), "generator": F.lit(number)}
        known = F.exists(base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))
        told = (near["secret"] if name != "value" else F.lit(True)) & (of("[0-9]") > 0)
        return F.struct(F.lit(name).alias("generator_name"), s["start"].alias("start"),
                        s["end"].alias("end"), known.alias("known"),
                        (known | told).cast("int").alias("label"),
                        *(v.cast("double").alias(k) for k, v in values.items()))

    def of_generator(number: int, name: str) -> Column:
        return F.transform(spans_of(text, GENERATORS[name], _TRIED[name]),
                           lambda s: described(s, name, number))

    return F.concat(*(of_generator(i, g) for i, g in enumerate(GENERATORS)))


Tree = float | tuple[str, float, "Tree", "Tree"]


def _read_tree(lines: list[str]) -> Tree:
    """One printed tree as nested (feature, limit, at most, above); consumes its lines."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.removeprefix("Predict:"))
    feature, limit = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line).groups()
    low = _read_tree(lines)
    lines.pop(0)  # the matching Else
    return FEATURES[int(feature)], float(limit), low, _read_tree(lines)


def _walk(tree: Tree, candidate: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, limit, low, high = tree
    return F.when(candidate[feature] <= limit, _walk(low, candidate)).otherwise(_walk(high, candidate))


@dataclass
class Model:
    """Trees with their weights, and the score from which each generator's spans are redacted."""

    trees: list[tuple[float, Tree]]
    thresholds: dict[str, float]

    def score(self, candidate: Column) -> Column:
        """Probability that a candidate is to be redacted."""
        margin = reduce(Column.__add__, [w * _walk(t, candidate) for w, t in self.trees], F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    def selects(self, candidate: Column) -> Column:
        limit = reduce(lambda rest, g: F.when(candidate["generator_name"] == g, self.thresholds[g])
                       .otherwise(rest), self.thresholds, F.lit(2.0))
        return self.score(candidate) >= limit


def train(found: DataFrame) -> Model:
    """Trees from the candidates in ``found``, thresholds from those left out; none without both marks."""
    spans = (found.select("doc_id", F.explode("candidates").alias("c")).select("doc_id", "c.*")
             .withColumn("part", F.xxhash64("doc_id", "start", "end", "generator"))
             .select("generator_name", "part", F.col("label").cast("double").alias("label"), *FEATURES))
    spans = staged(spans, "training-spans")
    learned = F.pmod(F.col("part"), F.lit(4)) > 0
    marks = [r["label"] for r in spans.where(learned).select("label").distinct().collect()]  # two
    if len(marks) < 2:
        return Model([], {})
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fitted = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=9,
                           checkpointInterval=-1).fit(vectors.transform(spans.where(learned)))
    lines = [x for x in fitted.toDebugString.splitlines()[1:] if x.strip()]
    trees = []
    while lines:
        lines.pop(0)  # its heading
        trees.append(_read_tree(lines))
    model = Model(list(zip(fitted.treeWeights, trees, strict=True)), {})
    p = F.floor(model.score(F.struct(*FEATURES)) * 100).cast("int")
    # at most 101 rows per generator
    rows = (spans.where(~learned).groupBy("generator_name", p.alias("p"))
            .agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect())
    for g in GENERATORS:
        good = n = 0
        for r in sorted((r for r in rows if r["generator_name"] == g), key=lambda r: -r["p"]):
            good, n = good + r["good"], n + r["n"]
            if good >= PRECISION * n and r["p"] >= 50:
                model.thresholds[g] = r["p"] / 100
    return model


def find_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, base and added, both array<struct<kind, start, end>>.

    ``base`` holds what the rules find, by kind as listed, then start; ``added`` what the trees
    select beside it, kind ``other``, by start, none overlapping another. Offsets count code
    points. A null text is empty and has no spans; repeated rows have equal spans.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = (docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text")))
             .select("doc_id", "base", candidates(F.col("text"), F.col("base")).alias("candidates")))
    found = staged(found, "spans")
    model = train(found)
    if not model.trees:
        return found.select("doc_id", "base", F.array().cast(
            "array<struct<kind: string, start: int, end: int>>").alias("added"))
    chosen = F.filter("candidates", lambda c: ~c["known"] & model.selects(c))
    wins = F.filter("chosen", lambda c: ~F.exists("chosen", lambda o: (
        (o["start"] < c["end"]) & (o["end"] > c["start"]) & (
            (o["length"] > c["length"]) | ((o["length"] == c["length"])
                                           & (o["generator"] < c["generator"]))))))
    return (found.withColumn("chosen", chosen)
            .select("doc_id", "base", F.array_sort(F.array_distinct(F.transform(wins, lambda c: F.struct(
                F.lit("other").alias("kind"), c["start"].alias("start"), c["end"].alias("end")))))
                .alias("added")))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
                       lambda a, s: F.when(s["start"] >= a["at"], F.struct(
                           s["end"].alias("at"), F.concat(
                               a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                               F.lit("["), s["kind"], F.lit("]")).alias("out"))).otherwise(a))
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
