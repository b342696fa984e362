"""URL filter: host rules first, then a ratio of two character language models.

URLs on which a rule decides are the training text: one model of variable order for the
accepted ones and one for the rejected. A model gives the next character the interpolated
(Witten-Bell) probability over all context lengths up to `ORDER`; a longer context
counts for more the more often, and the more narrowly, it was seen. The score of a URL
is the mean log-likelihood ratio per character. The threshold is calibrated on a fifth of the
ruled URLs with models that have not seen that fifth.

DataFrame functions only. URLs are cut to windows of ORDER + 1 characters; equal windows are
counted before anything is shuffled, models and ratios are per distinct window, and a
URL's score is a join of its windows with their ratios. Counts cover all rows.

Defined cases: a null URL or one without `://` has an empty host and path, takes no rule
and is judged by its characters (null: as empty); without ruled URLs of both kinds every
ratio is 0 and what no rule decides is allowed; repeated rows are judged each; an empty table
gives an empty one; no columns but page_id and url are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovemart.llm.common import written

#: Longest context, in characters.
ORDER = 4
#: Characters a model holds possible below all contexts: prior 1 / ALPHABET each.
ALPHABET = 256
#: Held-out folds: 1 in FOLDS of the ruled URLs calibrates the threshold.
FOLDS = 5
#: Width of the score bins in which the threshold is looked for, and their number each side.
BIN, BINS = 0.02, 500

START, END = "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with its subdomains below a path."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


PRODUCTION_RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

COUNTS = ["allow_all", "block_all", "allow_fit", "block_fit"]


def host_of(url: Column) -> Column:
    """Between `://` and `/`, `?`, `#` or the end; A-Z lower-cased."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    """From the end of the host to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    longest = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.rule), r.rule)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        longest = F.when(fits, F.struct(F.lit(rule.rule).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(longest)
    return longest


def windows(urls: DataFrame, order: int) -> DataFrame:
    """One row per character: `gram`, the character after the `order` characters before it."""
    padded = F.concat(F.lit(START * order), F.coalesce("url", F.lit("")), F.lit(END))
    starts = F.sequence(F.lit(1), F.length(padded) - order)
    grams = F.transform(starts, lambda i: F.substring(padded, i, F.lit(order + 1)))
    return urls.withColumn("gram", F.explode(grams))


def _log_ratio(grams: DataFrame, order: int) -> DataFrame:
    """`ratio_all` and `ratio_fit` of distinct windows with counts: log p(allow) / p(block).

    The model of order k comes from that of order k - 1, one row per event of k + 1 characters.
    """
    model = None
    for k in range(order + 1):
        event = F.col("gram").substr(F.lit(order + 1 - k), F.lit(k + 1))
        events = grams.groupBy(event.alias("event")).agg(*[F.sum(c).alias(c) for c in COUNTS])
        events = events.withColumn("context", F.col("event").substr(F.lit(1), F.lit(k)))
        contexts = events.groupBy("context").agg(
            *[F.sum(c).alias(f"total_{c}") for c in COUNTS],
            *[F.sum((F.col(c) > 0).cast("long")).alias(f"kinds_{c}") for c in COUNTS],
        )
        model_k = events.join(contexts, "context")
        if model is None:
            shorter = {c: F.lit(1.0 / ALPHABET) for c in COUNTS}
        else:
            model_k = model_k.withColumn("shorter", F.col("event").substr(F.lit(2), F.lit(k))).join(model, "shorter")
            shorter = {c: F.col(f"p_{c}") for c in COUNTS}
        probability = []
        for c in COUNTS:
            total, kinds = F.col(f"total_{c}"), F.col(f"kinds_{c}")
            blended = (F.col(c) + kinds * shorter[c]) / (total + kinds)
            probability.append(F.when(total > 0, blended).otherwise(shorter[c]).alias(f"p_{c}"))
        model = model_k.select(F.col("event").alias("shorter"), *probability)
    return model.select(
        F.col("shorter").alias("gram"),
        (F.log("p_allow_all") - F.log("p_block_all")).alias("ratio_all"),
        (F.log("p_allow_fit") - F.log("p_block_fit")).alias("ratio_fit"),
    )


def threshold(scores: DataFrame) -> float:
    """Score that parts held-out accepted from rejected URLs with the least balanced error.

    `scores` has `ruled` and `score`. Among equally good bin borders the middle one is taken.
    """
    bins = (
        scores.withColumn("_bin", F.greatest(F.least(F.floor(F.col("score") / BIN), F.lit(BINS)), F.lit(-BINS)))
        .groupBy("_bin")
        .agg(*[F.sum((F.col("ruled") == v).cast("long")).alias(v) for v in ("allow", "block")])
        .orderBy("_bin")
        .collect()  # 2 * BINS + 1 rows at most
    )
    allow, block = sum(r["allow"] for r in bins), sum(r["block"] for r in bins)
    if not allow or not block:
        return 0.0
    best, borders = 2.0, []
    low_allow = low_block = 0
    at = {r["_bin"]: r for r in bins}
    for i in range(min(at), max(at) + 2):
        error = low_allow / allow + (block - low_block) / block
        if error < best:
            best, borders = error, []
        if error == best:
            borders.append(i)
        if i in at:
            low_allow += at[i]["allow"]
            low_block += at[i]["block"]
    return BIN * borders[len(borders) // 2]


def judge(pages: DataFrame, rules: tuple[Rule, ...] = PRODUCTION_RULES, order: int = ORDER) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the score (null where a rule decides)."""
    parsed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parsed.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    # Equal URLs are cut and scored once, and go by a number from here on.
    fold = F.pmod(F.xxhash64("url"), F.lit(FOLDS))
    distinct = ruled.groupBy("url", F.col("_rule.verdict").alias("ruled")).agg(F.count("*").alias("rows"))
    texts = written(distinct.withColumn("held", fold == 0).withColumn("text_id", F.monotonically_increasing_id()), "urls")
    cut = windows(texts, order)
    counts = {
        f"{verdict}_{kind}": (F.col("ruled") == verdict) & (F.lit(kind == "all") | ~F.col("held"))
        for kind in ("all", "fit")
        for verdict in ("allow", "block")
    }
    model = cut.groupBy("gram").agg(
        *[F.sum(F.when(counts[c], F.col("rows")).otherwise(0)).alias(c) for c in COUNTS]
    )
    ratios = written(_log_ratio(written(model, "grams"), order), "ratios")
    asked = cut.where("ruled is null or held").select("text_id", "gram", F.col("ruled").isNull().alias("free"))
    ratio = F.when(F.col("free"), F.col("ratio_all")).otherwise(F.col("ratio_fit"))
    sums = asked.join(ratios, "gram").groupBy("text_id").agg(F.avg(ratio).alias("score"))
    scores = written(texts.drop("held").join(sums, "text_id"), "scores")
    least = threshold(scores.where("ruled is not null").select("ruled", "score"))
    free = scores.where("ruled is null").select(F.coalesce("url", F.lit("")).alias("_url"), F.col("url").isNull().alias("_none"), "score")
    method = F.when(F.col("score") >= least, "allow").otherwise("block")
    own = ["page_id", "host", "path"]
    # Pages that a rule decides need no score, and there is no key they could share.
    by_rule = ruled.where("_rule is not null").select(
        *own, F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("verdict"), F.lit(None).cast("double").alias("score")
    )
    asked = ruled.where("_rule is null").withColumns({"_url": F.coalesce("url", F.lit("")), "_none": F.col("url").isNull()})
    by_method = asked.join(free, ["_url", "_none"], "left").select(
        *own, F.lit(None).cast("string").alias("rule"), method.alias("verdict"), "score"
    )
    return by_rule.union(by_method)
