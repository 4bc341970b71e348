"""Mixing to target weights by soft membership. DataFrame functions only.

A classifier fitted on a bounded sample of labelled rows (MOST_EXAMPLES) gives every
document its chance of belonging to each domain: naive Bayes over the presence of the
MOST_TERMS most telling words and a few properties of the text. Rates r >= 0 are then
fitted by projected gradient so that the expected tokens of each domain meet its target:

    minimise  1/2 * sum over d of (x[d] - target[d])^2 / share[d]
              + RIDGE/2 * sum over documents of m * (r - 1)^2,
    x[d] = sum over documents of r * m * p[d]      (m: the document's share of all tokens)

A step needs only x, one distributed sum of as many numbers as there are domains; then

    r <- max(0, r - step * (sum over d of p[d] * (x[d] - target[d]) / share[d]
                            + RIDGE * (r - 1))).

So r follows from a document's own p and the few vectors the steps have used, and is an
expression: rates are never stored or joined. The sums run over groups of equal p.

copies = floor(r + u), u a hash of doc_id and text in [0, 1), is r on average.

Defined cases: a null text has no tokens and no words. Labels of unknown domains and null
doc_ids are left out; without labels of two domains all chances are equal. A domain with
no expected tokens is not steered. Targets that rates cannot meet, as where documents cannot
be told apart, are reported by a warning and in Mix.reached. Equal rows have equal rates. Empty tables give none.
Other columns stay and may have any names.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.line_quality import let
from playpulse.llm.names import free_names
from playpulse.llm.scratch import cut

MOST_EXAMPLES = 12_000
MOST_TERMS = 160
CHI2 = 20.0
LIFT = 4.0
RIDGE = 1e-3
STEPS = 60
TOLERANCE = 1e-6
#: A domain further from its target than this share of it is reported by a warning.
MISSED = 0.02
#: What lies between words: bytes that are no ASCII digit, letter or part of other characters.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """Words of a text, lower-cased, without white space and punctuation."""
    return F.array_remove(F.split(F.lower(text), _BREAK), "")


def _terms(text: Column, words: Column) -> Column:
    """Distinct words of a text and marks for its properties."""
    n = F.greatest(F.size(words), F.lit(1))

    def of_distinct(distinct: Column) -> Column:
        odd = F.regexp_count(text, F.lit(r"[#*$%&|<>!]"))
        upper = F.regexp_count(text, F.lit(r"[A-Z]"))
        marks = [
            ("#short", n < 50),
            ("#odd", odd * 5 > n),
            ("#upper", upper * 3 > F.length(text)),
            ("#repeats", F.size(distinct) * 3 < n),
        ]
        told = F.array(*(F.when(test, F.lit(mark)) for mark, test in marks))
        return F.concat(distinct, F.array_compact(told))

    return let(F.array_distinct(words), of_distinct)


@dataclass
class Classifier:
    """Naive Bayes: a base for each domain, and what a term's presence adds to it."""

    domains: list[str]
    base: list[float]
    gains: dict[str, list[float]]

    def posterior(self, text: Column, words: Column) -> Column:
        """Chances of the domains, in their order."""
        n = len(self.domains)
        if not self.gains:
            total = math.log(sum(math.exp(b) for b in self.base))
            return F.array(*(F.lit(math.exp(b - total)) for b in self.base))
        known = F.array(*(F.lit(t) for t in self.gains))
        gain = F.map_from_arrays(
            known, F.array(*(F.array(*(F.lit(x) for x in g)) for g in self.gains.values()))
        )

        def of_gains(gains: Column) -> Column:
            def sum_for(d: int) -> Column:
                return F.aggregate(gains, F.lit(self.base[d]), lambda s, g: s + F.get(g, F.lit(d)))

            return let(F.array(*(sum_for(d) for d in range(n))), of_sums)

        def of_sums(sums: Column) -> Column:
            powers = F.transform(sums, lambda s: F.exp(s - F.array_max(sums)))
            return let(powers, lambda ps: F.transform(ps, lambda p: p / _sum(ps)))

        hits = F.array_intersect(_terms(text, words), known)
        # Rounded, so that equal evidence found in another order is the same group.
        found = let(F.transform(F.array_sort(hits), lambda t: F.element_at(gain, t)), of_gains)
        return F.transform(found, lambda p: F.round(p, 9))


    def judged(self, text: Column) -> Column:
        """(n: the text's words, p: its chances), the words split once."""
        return let(
            _words(text),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n"), self.posterior(text, words).alias("p")
            ),
        )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def fit_classifier(documents: DataFrame, labels: DataFrame, domains: list[str]) -> Classifier:
    """labels: (doc_id, domain). At most MOST_EXAMPLES rows, by a hash of doc_id, are used."""
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
        .groupBy("doc_id")
        .agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64("doc_id", F.lit(29)))
        .limit(MOST_EXAMPLES)
    )
    sample = cut(sample)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The sample is bounded, so it is broadcast whatever the size of the labels.
    examples = cut(
        documents.select("doc_id", text.alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .select("domain", let(_words(F.col("text")), lambda w: _terms(F.col("text"), w)).alias("terms"))
    )
    seen = {r["domain"]: r["n"] for r in examples.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    sizes = [seen.get(d, 0) for d in domains]
    total = sum(sizes)
    base = [math.log((n + 0.5) / (total + 0.5 * len(domains))) for n in sizes]
    if sum(n > 0 for n in sizes) < 2:
        return Classifier(domains, [0.0] * len(domains), {})
    counts = (
        examples.select("domain", F.explode("terms").alias("term"))
        .where("term <> ''")
        .groupBy("term")
        .agg(*(F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)))
    )
    # Chi-squared of presence against domain.
    have = sum((F.col(f"n{i}") for i in range(len(domains))), F.lit(0))
    chi2 = F.lit(0.0)
    for i, n in enumerate(sizes):
        if n:
            expected = have * (n / total)
            off = F.col(f"n{i}") - expected
            chi2 = chi2 + off * off * (total / (total - have)) / expected
    # Only terms that one domain has far more often than the rest: common words tell the
    # length of a text and little else, and would be counted as evidence many times over.
    lifts = [
        (F.col(f"n{i}") + 0.5) / (n + 1.0) * (total - n + 1.0) / (have - F.col(f"n{i}") + 0.5)
        for i, n in enumerate(sizes)
    ]
    chosen = (
        counts.where(have < total)
        .withColumn("chi2", F.round(chi2, 6))
        .where((F.col("chi2") > CHI2) & (F.greatest(*lifts) > LIFT))
        .orderBy(F.desc("chi2"), "term")
        .limit(MOST_TERMS)
        .collect()
    )
    gains = {}
    for row in sorted(chosen, key=lambda r: r["term"]):
        p = [(row[f"n{i}"] + 0.5) / (n + 1.0) for i, n in enumerate(sizes)]
        gains[row["term"]] = [math.log(x / (1 - x)) for x in p]
        base = [b + math.log(1 - x) for b, x in zip(base, p, strict=True)]
    return Classifier(domains, base, gains)


def _rate(p: Column, steps: list[list[float]], step: float) -> Column:
    """The rate of a document after these steps (vectors of pull by domain)."""
    if not steps:
        return F.lit(1.0)
    vectors = F.array(*(F.array(*(F.lit(x) for x in v)) for v in steps))

    def move(rate: Column, pull: Column) -> Column:
        slope = F.aggregate(
            F.zip_with(p, pull, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x
        )
        return F.greatest(F.lit(0.0), rate - F.lit(step) * (slope + F.lit(RIDGE) * (rate - 1)))

    return F.aggregate(vectors, F.lit(1.0), move)


@dataclass
class Mix:
    """A fitted mix: what gives any document its posterior and rate."""

    classifier: Classifier
    steps: list[list[float]]
    reached: list[float]
    targets: list[float]

    def missed(self) -> float:
        """How far the steered domain furthest off is from its target, as a share of it."""
        pairs = [(x, t) for x, t in zip(self.reached, self.targets, strict=True) if x > 0 and t > 0]
        return max((abs(x - t) / t for x, t in pairs), default=0.0)

    def rate(self, p: Column) -> Column:
        return _rate(p, self.steps, 1 / (1 + RIDGE))


def fit(
    documents: DataFrame, labels: DataFrame, targets: dict[str, float], keep: str | None = None
) -> tuple[Mix, DataFrame]:
    """Fit rates; returns the mix and (doc_id, text_hash, n_tokens, p) of every row.

    targets: weights of the domains. The mix has as many tokens as the documents have, or,
    where `keep` names a domain, as many as leave that domain's expected tokens unchanged.
    """
    domains = list(targets)
    classifier = fit_classifier(documents, labels, domains)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = cut(
        documents.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("text"))
        .select("doc_id", "text_hash", classifier.judged(F.col("text")).alias("j"))
        .select("doc_id", "text_hash", F.col("j.n").alias("n_tokens"), F.col("j.p").alias("p"))
    )
    groups = cut(rows.groupBy("p").agg(F.sum("n_tokens").cast("double").alias("n")))

    def reach(steps: list[list[float]]) -> list[float]:
        rate = _rate(F.col("p"), steps, 1 / (1 + RIDGE))
        sums = groups.select("p", (F.col("n") * rate).alias("n")).agg(
            *(F.coalesce(F.sum(F.col("n") * F.col("p")[d]), F.lit(0.0)) for d in range(len(domains)))
        )
        return list(sums.first())

    tokens = reach([])
    total = sum(tokens)
    mix = Mix(classifier, [], tokens, tokens)
    if not total:
        return mix, rows
    shares = [t / total for t in tokens]
    weights = [targets[d] / sum(targets.values()) for d in domains]
    scale = 1.0
    if keep is not None and targets[keep] > 0:
        scale = shares[domains.index(keep)] / weights[domains.index(keep)]
    goal = [w * scale for w in weights]
    mix.targets = [g * total for g in goal]
    now = shares
    for _ in range(STEPS):
        mix.steps.append([(x - g) / s if s > 0 else 0.0 for x, g, s in zip(now, goal, shares, strict=True)])
        after = [t / total for t in reach(mix.steps)]
        moved = max(abs(a - b) for a, b in zip(after, now, strict=True))
        now = after
        if moved < TOLERANCE:
            break
    mix.reached = [x * total for x in now]
    if mix.missed() > MISSED:
        told = ", ".join(
            f"{d} {x / t:.3f}" for d, x, t in zip(domains, mix.reached, mix.targets, strict=True) if t
        )
        warnings.warn(f"targets not met, tokens as a share of each: {told}", stacklevel=2)
    return mix, rows


def copies_of(rate: Column, doc_id: Column, text_hash: Column) -> Column:
    """How often a document is taken: its rate on average, the same at every run."""
    luck = F.pmod(F.xxhash64(doc_id, text_hash, F.lit(41)), F.lit(1 << 40)) / (1 << 40)
    return F.floor(rate + luck).cast("int")


def rates(
    documents: DataFrame, labels: DataFrame, targets: dict[str, float], keep: str | None = None
) -> DataFrame:
    """(doc_id, n_tokens, p, rate, copies) of every row; p in the order of targets."""
    mix, rows = fit(documents, labels, targets, keep)
    rated = rows.withColumn("rate", mix.rate(F.col("p")))
    return rated.select(
        "doc_id",
        "n_tokens",
        "p",
        "rate",
        copies_of(F.col("rate"), F.col("doc_id"), F.col("text_hash")).alias("copies"),
    )


def mix(
    documents: DataFrame, labels: DataFrame, targets: dict[str, float], keep: str | None = None
) -> DataFrame:
    """Every document as often as its copies say, all columns unchanged. No shuffle of texts."""
    fitted, _ = fit(documents, labels, targets, keep)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # One expression, so that nothing in it is worked out twice; no copies, no row.
    copies = let(
        fitted.classifier.judged(text)["p"],
        lambda p: copies_of(fitted.rate(p), F.col("doc_id"), F.xxhash64("text")),
    )
    (copy,) = free_names(documents, "__copy")
    taken = F.explode(F.array_repeat(F.lit(1), copies)).alias(copy)
    return documents.select("*", taken).drop(copy)
