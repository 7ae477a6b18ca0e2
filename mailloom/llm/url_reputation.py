"""URL filters by empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted per host. Each host's rate of bad pages has a beta prior centred
on the posterior mean of its registered domain, which in turn is shrunk to its public suffix, and that to the rate
of all labelled pages. How strong the prior of a level is follows from the spread of the observed rates (method of
moments). A host is blocked if the lower posterior bound of its rate exceeds the threshold. Explicit rules go first.
Every host of the pages is judged: one without outcomes has n = 0 and so the mean of the deepest level above it that has
some, with the strength of a host's prior.

The suffix is the last label and the registered domain the last two. There is no table of public suffixes here, so all
hosts below a suffix like co.uk count as one domain.

Everything is built-in expressions and aggregates. Counting is pre-aggregated in each map task, so a host with a
third of all pages sends one row per task; the last join takes only blocked hosts from the small side, and a hot
host there is split by adaptive execution.

Rows: one per input row. A null url, or one without `://`, has an empty host and path and no rule; that host is
judged like any other, by the overall rate if it has no outcomes. Outcomes for unknown pages and null outcomes are ignored; several outcomes of one page all count.
Repeated pages are judged like any other. Empty tables give no rows, or all pages allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailloom.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# --- fixed values: the rules of the registered query ---------------------------
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# --------------------------------------------------------------------------------

#: A host is blocked if mean - BOUND standard deviations of its posterior exceed THRESHOLD.
BOUND, THRESHOLD = 1.645, 0.5
#: The strength of a prior, in pages, stays within these limits.
WEAKEST, STRONGEST = 1.0, 1000.0

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def domain_of(host: Column) -> Column:
    """The last two labels."""
    return F.substring_index(host, ".", -2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is the url's or above it and whose path starts the url's; else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _level(counts: DataFrame) -> DataFrame:
    """Add the strength of the prior and the posterior mean to a level's rows of n, bad and prior."""
    rate = F.col("bad") / F.col("n")
    # Moments over all groups of the level: E[(rate - prior)^2] = v (1/n + (1 - 1/n) / (s + 1)), v = prior (1 - prior).
    v = F.col("prior") * (1 - F.col("prior"))
    spread = counts.where("n > 1").agg(
        F.sum((F.col("n") * F.pow(rate - F.col("prior"), 2)).cast("decimal(38,12)")).cast("double").alias("seen"),
        F.sum(v.cast("decimal(38,12)")).cast("double").alias("noise"),
        F.sum((v * (F.col("n") - 1)).cast("decimal(38,12)")).cast("double").alias("scale"),
    )
    share = (F.col("seen") - F.col("noise")) / F.col("scale")
    strength = F.when(share.isNull(), STRONGEST).when(share <= 1 / (STRONGEST + 1), STRONGEST).otherwise(
        F.greatest(F.lit(WEAKEST), 1 / share - 1)
    )
    # The moments are one number, whatever the input.
    return counts.withColumn("s", F.lit(spread.select(strength).first()[0])).withColumn(
        "mean", (F.col("bad") + F.col("prior") * F.col("s")) / (F.col("n") + F.col("s"))
    )


def reputation(pages: DataFrame, outcomes: DataFrame, url: str = "url", page: str = "page_id", bad: str = "bad") -> DataFrame:
    """Posterior mean, deviation and lower bound of the rate of bad pages for every host of the pages.

    `outcomes` holds `page` and `bad` (0 or 1).
    """
    counted = (
        pages.select(F.col(page).alias("_page"), host_of(F.col(url)).alias("host"))
        .join(outcomes.select(F.col(page).alias("_page"), F.col(bad).cast("long").alias("bad")).where("bad is not null"), "_page", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad")
    )
    # Every level reads the counts of hosts again; the pages are counted once.
    counted = stored(counted, "hosts")
    overall = counted.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("prior")).first()[0]
    by_suffix = counted.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = _level(by_suffix.withColumn("prior", F.lit(overall).cast("double")))
    by_domain = counted.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = _level(by_domain.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix"))
    hosts = _level(counted.join(domains.select("domain", F.col("mean").alias("prior")), "domain"))
    strength = F.col("n") + F.col("s")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (strength + 1))
    return hosts.select("host", "n", "bad", "prior", "s", "mean", deviation.alias("deviation")).withColumn(
        "bound", F.col("mean") - BOUND * F.col("deviation")
    )


def judge(pages: DataFrame, outcomes: DataFrame, url: str = "url", page: str = "page_id", rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every page; rules decide first, else the host's posterior bound.

    Other columns of the pages are not carried.
    """
    blocked = reputation(pages, outcomes, url, page).where(F.col("bound") > THRESHOLD).select("host", F.lit(True).alias("low"))
    judged = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url"))
    judged = judged.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    own = F.lit(None).cast("string")
    for rule, verdict in rules:
        own = F.when(F.col("rule") == rule, verdict).otherwise(own)
    verdict = F.coalesce(own, F.when(F.col("low"), "block").otherwise("allow"))
    return judged.join(blocked, "host", "left").select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"))
