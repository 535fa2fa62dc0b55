"""URL filters: rules, and for what no rule decides the reputation of the host.

A page's outcome is bad if its label says so. A host's rate of bad pages is shrunk towards that of
its registered domain, the domain's towards that of its suffix, the suffix's towards the overall rate,
each as a beta-binomial posterior whose prior's weight is estimated from how much the rates of a level
vary beyond chance. A host is blocked if the lower bound of its posterior exceeds the rate tolerated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingmill.llm.common import stored

ALLOW, BLOCK = "allow", "block"
TOLERATED = 0.25  # rate of bad pages
DEVIATIONS = 1.645  # of the posterior below its mean: one-sided 95 %
MOST_WEIGHT = 1000.0  # of a prior, in pages
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Below a country's two letters, these are part of the suffix.
SECOND_LEVEL = r"(?:co|com|net|org|ac|edu|gov)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """After the first `://` up to `/`, `?`, `#` or the end, in lower case as to A-Z; then up to `?`,
    `#` or the end. Both are empty if the URL is null or has no `://`."""
    text = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, parts, 1), UPPER, LOWER), F.regexp_extract(text, parts, 2)


def suffix_of(host: Column) -> Column:
    """The last label, or the last two below a country's; without user, port and closing dot."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$|\.$", "")
    return F.regexp_extract(name, rf"((?:^|(?<=\.)){SECOND_LEVEL}\.[a-z][a-z]|[^.]*)$", 1)


def domain_of(host: Column) -> Column:
    """The suffix and one label more, if there is one."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$|\.$", "")
    return F.regexp_extract(name, rf"((?:[^.]*\.)?(?:(?:^|(?<=\.)){SECOND_LEVEL}\.[a-z][a-z]|[^.]*))$", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of its text and verdict, or null. A rule fits its host
    and all hosts below it, and paths that begin with its path."""
    # The longest first, so the first that fits is the one; equal lengths by text.
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        made = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, made).otherwise(found)
    return found


def outcomes(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """page, bad: 1 if any label of the page says toxic or of no quality. Labels without a key or with
    neither mark are none."""
    bad = F.greatest(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0)), F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0)))
    marked = labels.filter(F.col(key).isNotNull() & (F.col("toxic").isNotNull() | F.col("quality").isNotNull()))
    return marked.groupBy(F.col(key).cast("long").alias("page")).agg(F.max(bad).alias("bad"))


def host_counts(pages: DataFrame, labelled: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """host, domain, suffix, n labelled pages, k bad ones; every host that occurs."""
    host, _ = host_and_path(url)
    rows = pages.select(F.col(key).cast("long").alias("page"), host.alias("host")).join(labelled, "page", "left")
    counted = rows.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    return counted.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "k")


def _weight(children: DataFrame) -> float:
    """The weight of the priors of a level, in pages, by moments: how far the children's rates lie from
    their parents' means, less what chance explains."""
    seen = children.filter("n > 0")
    row = seen.agg(
        F.sum("n").alias("n"),
        F.sum(F.pow(F.col("k") - F.col("n") * F.col("mean"), 2) / F.col("n")).alias("spread"),
        F.sum(F.col("mean") * (1 - F.col("mean"))).alias("chance"),
        F.sum(F.col("n") * F.col("mean") * (1 - F.col("mean"))).alias("variance"),
    ).first()
    if not row.n or row.spread <= row.chance:
        return MOST_WEIGHT
    return min(max(row.variance / (row.spread - row.chance) - 1, 1.0), MOST_WEIGHT)


def reputation(counts: DataFrame) -> DataFrame:
    """host, mean, bound: the posterior mean of each host's rate of bad pages and its lower bound.

    Without a labelled page, a host has what its domain has; without any label at all the rate is a
    half with the most weight."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    overall = (total.k + 0.5) / (total.n + 1)
    summed = [F.sum("n").alias("n"), F.sum("k").alias("k")]

    def posterior(children: DataFrame) -> DataFrame:
        weight = _weight(children)
        mean = (F.lit(weight) * F.col("mean") + F.col("k")) / (F.lit(weight) + F.col("n"))
        size = F.lit(weight) + F.col("n")
        return children.withColumn("mean", mean).withColumn("size", size)

    suffixes = posterior(counts.groupBy("suffix").agg(*summed).withColumn("mean", F.lit(float(overall))))
    domains = counts.groupBy("suffix", "domain").agg(*summed)
    domains = posterior(domains.join(suffixes.select("suffix", "mean"), "suffix"))
    hosts = posterior(counts.join(domains.select("suffix", "domain", "mean"), ["suffix", "domain"]))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1))
    return hosts.select("host", "mean", (F.col("mean") - DEVIATIONS * deviation).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict, and the host's mean and bound.

    URLs that are null or have no `://` share the empty host. Rows stay rows, also equal ones; an
    empty table gives none; other columns are ignored."""
    counts = stored(host_counts(pages, outcomes(labels), key, url), "hosts")
    host, path = host_and_path(url)
    rows = pages.select(F.col(key).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fits", rule_for(F.col("host"), F.col("path"), rules))
    # Hosts are unique on the right; a host with many pages is split by adaptive execution.
    judged = rows.join(reputation(counts), "host", "left")
    method = F.when(F.col("bound") > TOLERATED, BLOCK).otherwise(ALLOW)
    return judged.select(
        "page_id", "host", "path", F.col("fits.rule").alias("rule"), F.coalesce("fits.verdict", method).alias("verdict"), "mean", "bound"
    )
