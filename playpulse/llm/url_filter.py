"""URL verdicts: host and path rules first, character language models for the rest.

URLs that a rule decides are the training rows: those allowed train one model, those
blocked another. A model is a variable-order Markov chain over characters: the chance of a
character after the last ORDER characters is the count there, smoothed with the chance
after one character less (Witten-Bell: the more kinds of character have followed, the more
weight the shorter context gets), down to a flat chance. A URL's score is the difference
of the two log-likelihoods for each character. The threshold is the one that separates
held-out training URLs best, so the scores are calibrated on rows no model has seen.

All counts are grouped in Spark over every URL of the table, and equal texts count once
with their number, so a host that owns a third of all pages is folded before anything is
counted. Chances are worked out once for each distinct sequence of ORDER + 1 characters
and joined to the sequences of each text; nothing but a histogram of HISTOGRAM bins and a
few totals reaches the driver.

Defined cases: a null URL, or any URL where rules leave one class without rows, is
allowed. A URL without :// has empty host and path, and its whole text is scored. Equal
URLs have equal verdicts.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.scratch import cut

#: Rule (host and path), verdict.
RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}
ORDER = 5
HELD_OUT_ONE_IN = 5
BIN = 0.01
HISTOGRAM = 4000

_START, _END = "\x02", "\x03"


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    known = F.coalesce(at > 0, F.lit(False))
    host = F.when(known, _lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")
    path = F.when(known, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the longest is asked first
        at = rule.index("/")
        own_host, own_path = rule[:at], rule[at:]
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _model_text(url: Column) -> Column:
    """What is modelled: the lower-cased URL without its scheme, digits alike."""
    bare = F.regexp_replace(_lower(url), r"^[a-z]+://", "")
    return F.translate(bare, string.digits, "0" * 10)


def _grams(texts: DataFrame, order: int) -> DataFrame:
    """Each text's sequences of order + 1 characters, one for each character and the end."""
    padded = F.concat(F.lit(_START * order), F.col("s"), F.lit(_END))
    places = F.sequence(F.lit(1), F.length("s") + 1)
    return texts.select(
        *texts.columns,
        F.explode(F.transform(places, lambda i: F.substring(padded, i, F.lit(order + 1)))).alias("g"),
    )


def _chances(wanted: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """(g, ratio): log of the chance of g's last character as accepted over as rejected.

    counts: (g, yes, no) of the training texts.
    """
    # A shorter sequence's count is the sum over the full ones that end with it.
    sides = ("yes", "no")
    kinds = counts.select(F.substring("g", -1, 1).alias("c")).distinct().count() + 1
    rows = wanted.select("g", *(F.lit(1.0 / kinds).alias(f"p_{s}") for s in sides))
    for k in range(order + 1):
        own = F.col("g").substr(F.lit(order + 1 - k), F.lit(k + 1))
        context = F.col("g").substr(F.lit(order + 1 - k), F.lit(k))
        by_own = counts.groupBy(own.alias("own")).agg(*(F.sum(s).alias(s) for s in sides))
        by_context = by_own.groupBy(F.col("own").substr(F.lit(1), F.lit(k)).alias("context")).agg(
            *(F.sum(s).alias(f"n_{s}") for s in sides),
            *(F.count_if(F.col(s) > 0).alias(f"kinds_{s}") for s in sides),
        )
        joined = (
            rows.withColumn("own", own)
            .withColumn("context", context)
            .join(by_own, "own", "left")
            .join(by_context, "context", "left")
        )
        rows = joined.select(
            "g",
            *(
                F.coalesce(
                    F.when(
                        F.col(f"n_{s}") > 0,
                        (F.coalesce(s, F.lit(0)) + F.col(f"kinds_{s}") * F.col(f"p_{s}"))
                        / (F.col(f"n_{s}") + F.col(f"kinds_{s}")),
                    ),
                    F.col(f"p_{s}"),
                ).alias(f"p_{s}")
                for s in sides
            ),
        )
    return rows.select("g", (F.log("p_yes") - F.log("p_no")).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """The score that separates held-out accepted and rejected texts best."""
    edge = F.least(
        F.greatest(F.round(F.col("score") / BIN), F.lit(-HISTOGRAM / 2)), F.lit(HISTOGRAM / 2)
    )
    rows = (
        scored.groupBy(edge.cast("int").alias("bin"))
        .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        .orderBy("bin")
        .collect()
    )
    n_yes, n_no = sum(r["yes"] for r in rows), sum(r["no"] for r in rows)
    if not n_yes or not n_no:
        return 0.0
    best, at, below_yes, below_no = -1.0, [0.0], 0, 0
    for r, after in zip(rows, [*rows[1:], None], strict=True):
        below_yes, below_no = below_yes + r["yes"], below_no + r["no"]
        right = below_no / n_no + 1 - below_yes / n_yes
        end = (after["bin"] if after else r["bin"] + 1) * BIN
        if right > best:
            best, at = right, [(r["bin"] * BIN + end) / 2]
    return at[0]


def verdicts(pages: DataFrame, rules: dict[str, str] | None = None, order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of pages.

    score: log-likelihood difference for each character; below the threshold is blocked.
    """
    rules = RULES if rules is None else rules
    url = F.col("url").cast("string")
    host, path = parts(url)
    named = pages.select("page_id", url.alias("url"), host.alias("host"), path.alias("path"))
    decided = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        decided = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(decided)
    judged = named.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("by_rule", decided).withColumn("s", _model_text(F.col("url")))
    texts = cut(
        judged.where(F.col("s").isNotNull())
        .groupBy("s")
        .agg(
            F.count_if(F.col("by_rule") == "allow").alias("yes"),
            F.count_if(F.col("by_rule") == "block").alias("no"),
        )
        .withColumn("held", F.pmod(F.xxhash64("s"), F.lit(HELD_OUT_ONE_IN)) == 0)
    )
    n_yes, n_no = texts.where("not held").agg(F.sum("yes"), F.sum("no")).first()
    if not n_yes or not n_no:
        verdict = F.coalesce("by_rule", F.lit("allow"))
        return judged.select(
            "page_id", "host", "path", "rule", verdict.alias("verdict"), F.lit(0.0).alias("score")
        )
    grams = _grams(texts, order)
    counts = cut(
        grams.where(~F.col("held") & (F.col("yes") + F.col("no") > 0))
        .groupBy("g")
        .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    )
    chances = cut(_chances(cut(grams.select("g").distinct()), counts, order))
    scores = cut(
        grams.join(chances, "g")
        .groupBy("s")
        .agg(
            (F.sum("ratio") / F.count("*")).alias("score"),
            F.first("yes").alias("yes"),
            F.first("no").alias("no"),
            F.first("held").alias("held"),
        )
    )
    limit = _threshold(scores.where("held and yes + no > 0"))
    # Pages of one host may be very many, but they have as many texts: no key is hot.
    by_model = F.when(F.col("score") < limit, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(scores.select("s", "score"), "s", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", by_model).alias("verdict"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
