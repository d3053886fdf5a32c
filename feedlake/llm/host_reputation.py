"""URL filter by Empirical-Bayes host reputation, in DataFrame operations only.

Labelled page outcomes (bad or not) are summed by host. Beta-binomial priors run down from all pages to the public suffix, to
the registered domain, to the host: each level's prior mean is its parent's posterior mean, and its strength is estimated by the
method of moments from how far the rates at that level scatter around their parents beyond sampling. A host is blocked when the
lower bound (mean - z sd) of its posterior bad rate is over `max_bad` and its registered domain has a labelled page; a host
without labels rests on its domain's mean. Hand rules (host and path, longest first) come before the method.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.rows import quoted
from feedlake.workspace import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BAD = 0.5
Z = 2.0
LEAST, MOST = 2.0, 1000.0
#: Public suffixes of two labels; others are the last label.
SUFFIXES = ["ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "org.uk"]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): between the first :// and /, ?, # or the end, A-Z lower-cased; then up to ?, # or the end. Both are empty
    for null and for text without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def registered(host: Column) -> tuple[Column, Column]:
    """(registered domain, public suffix) of a host; a bare label is both."""
    two = F.substring_index(host, ".", -2)
    wide = two.isin(SUFFIXES)
    suffix = F.when(wide, two).otherwise(F.substring_index(host, ".", -1))
    return F.when(wide, F.substring_index(host, ".", -3)).otherwise(two), suffix


def hand_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting (verdict, "host/path") rule, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest last, so outermost
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame, parent: str) -> float:
    """Prior strength of (parent, n, bad) rows around their parent's rate; one row of sums goes through the driver."""
    n, f = F.col("n").cast("double"), F.col("bad").cast("double")
    by = children.where("n > 0").groupBy(parent).agg(
        F.sum(n).alias("t"), F.sum(f).alias("f"), F.count(F.lit(1)).alias("k"), F.sum(f * f / n).alias("q"), F.sum(n * n).alias("nn")
    )
    m = F.col("f") / F.col("t")
    v = m * (1 - m)
    row = by.agg(
        F.sum(F.col("q") - F.col("f") * m - v * (F.col("k") - 1)).alias("over"),
        F.sum(v * (F.col("t") - F.col("nn") / F.col("t") - F.col("k") + 1)).alias("spare"),
    ).first()
    over, spare = row["over"] or 0.0, row["spare"] or 0.0
    if over <= 0 or spare <= 0:
        return MOST
    return max(LEAST, min(MOST, spare / over - 1))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, bad: 1, 0 or null for unlabelled) page rows -> host, n, bad, rate and low (posterior mean and lower bound),
    domain_n (labelled pages of its registered domain).

    Sums combine map-side, so a host with a third of all pages costs a row a task; every later step has a row a host.
    """
    domain, suffix = registered(F.col("host"))
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = materialize(hosts.withColumns({"domain": domain, "suffix": suffix}), "reputation-hosts")
    total = lambda df, *by: df.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = materialize(total(hosts, "domain", "suffix"), "reputation-domains")
    suffixes = materialize(total(domains, "suffix"), "reputation-suffixes")
    all_ = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((all_["bad"] or 0) + 0.5) / ((all_["n"] or 0) + 1)
    s = [_strength(suffixes.withColumn("top", F.lit(1)), "top"), _strength(domains, "suffix"), _strength(hosts, "domain")]
    post = lambda prior, strength: (F.col("bad") + prior * strength) / (F.col("n") + strength)
    up = suffixes.select("suffix", post(F.lit(mean), s[0]).alias("up"))
    up = domains.join(up, "suffix").select("domain", F.col("n").alias("domain_n"), post(F.col("up"), s[1]).alias("up"))
    a = F.col("bad") + F.col("up") * s[2]
    b = F.col("n") - F.col("bad") + (1 - F.col("up")) * s[2]
    rated = hosts.join(up, "domain").select("host", "n", "bad", "domain_n", (a / (a + b)).alias("rate"), F.sqrt(a * b / (a + b + 1)).alias("sd"), (a + b).alias("w"))
    return rated.select("host", "n", "bad", "domain_n", "rate", (F.col("rate") - Z * F.col("sd") / F.col("w")).alias("low"))


def url_filter(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = (), id_col: str = "page_id", url: str = "url", max_bad: float = MAX_BAD
) -> DataFrame:
    """page id, host, path, rule, verdict, rate (posterior bad rate of the host) for every page row.

    `outcomes`: (url, bad) of page rows, bad 1, 0 or null. Null urls and text without :// have the empty host, judged as one
    host. Repeated rows are judged alike, extra columns are not read, an empty table gives no rows. The host table comes
    back by a join that Spark broadcasts when small and otherwise splits at hot hosts.
    """
    host, path = url_parts(F.col(quoted(url)))
    seen = outcomes.select(url_parts(F.col("url"))[0].alias("host"), F.col("bad").cast("bigint").alias("bad"))
    rated = materialize(host_reputation(seen).select("host", "rate", ((F.col("low") > max_bad) & (F.col("domain_n") > 0)).alias("blocked")), "reputation")
    rows = pages.select(F.col(quoted(id_col)).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, word = hand_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    joined = rows.join(rated, "host", "left")
    return joined.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(word, method).alias("verdict"), "rate")
