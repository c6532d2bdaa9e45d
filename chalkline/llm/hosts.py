"""URL filter: rules, then empirical-Bayes host reputation, in built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.session import materialized

# A host is blocked if the upper bound of its good share lies below this share.
LEAST_GOOD = 0.5
# Standard deviations from the posterior mean to the bound.
DEVIATIONS = 1.645
# Pseudo-counts of a level's prior when its groups tell nothing of their spread.
WEAKEST, STRONGEST = 1.0, 1000.0
# More rules than this belong into a table of their own; these are put into every row's expression.
MOST_RULES = 1000
# Public suffixes of more than one label; every other host ends in a suffix of one. A full table of them
# can be given instead.
SUFFIXES = ("ac.jp", "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "gov.uk", "org.au", "org.uk")
# Suffix of all hosts that are addresses; no host can bear it.
ADDRESS = "#"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A(?:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A(?:.*?)://[^/?#]*([^?#]*)", 1)


def _bare(host: Column) -> Column:
    return F.regexp_replace(host, r":[0-9]*\z", "")


def is_address(host: Column) -> Column:
    """IPv4 and bracketed IPv6 addresses, with or without a port."""
    return _bare(host).rlike(r"\A(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[.*\])\z")


def _last_labels(host: Column, suffixes: Sequence[str], more: int) -> Column:
    """The labels of the longest public suffix and ``more`` before it."""
    bare = _bare(host)
    out = F.substring_index(bare, ".", -1 - more)
    for n in sorted({s.count(".") + 1 for s in suffixes} - {1}):  # the longest is put outermost
        known = F.substring_index(bare, ".", -n).isin([s for s in suffixes if s.count(".") + 1 == n])
        out = F.when(known, F.substring_index(bare, ".", -n - more)).otherwise(out)
    return out


def registered_domain(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """A host's public suffix and the label before it, without its port; addresses are domains of their own."""
    return F.when(is_address(host), _bare(host)).otherwise(_last_labels(host, suffixes, 1))


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The longest public suffix of a host: its last label if ``suffixes`` has none; ``ADDRESS`` for addresses."""
    return F.when(is_address(host), ADDRESS).otherwise(_last_labels(host, suffixes, 0))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule, or null.

    A rule (host, path, verdict) fits its host and all subdomains where the path starts with the rule's path. Of
    equally long rules the first by text counts.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1], r[2]), reverse=True)
    for rule_host, rule_path, verdict in ordered:  # the longest is put outermost
        fits = ((host == rule_host) | host.endswith(F.lit("." + rule_host))) & path.startswith(F.lit(rule_path))
        found = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found).otherwise(out)
    return out


def _shrunk(level: DataFrame, prior: Column) -> DataFrame:
    """Adds alpha and beta of each group's posterior: a beta prior around ``prior`` whose strength is fitted to all
    groups of the level by moments: pseudo-counts such that the spread of the groups' shares is what it is.

    The strength is one number, fetched by a job, so that no level's plan holds those above it twice."""
    share = F.col("good") / F.nullif("total", F.lit(0))
    fit = level.withColumn("prior", prior).agg(
        F.sum("total").alias("n"),
        F.count_if(F.col("total") > 0).alias("k"),
        F.sum(F.col("total").cast("double") * F.col("total")).alias("squares"),
        F.sum(F.col("total") * (share - F.col("prior")) * (share - F.col("prior"))).alias("between"),
        F.sum(F.col("total") * F.col("prior") * (1 - F.col("prior"))).alias("mean_variance"),
    )
    # E[between] = v * (k + rho * (n - k)) for a mean variance v of single outcomes and a correlation rho within groups
    rho = F.try_divide(F.try_divide(F.col("between") * F.col("n"), F.col("mean_variance")) - F.col("k"), F.col("n") - F.col("k"))
    strength = F.when(
        (F.col("mean_variance") > 0) & (F.col("n") > F.col("k")),
        F.round(F.least(F.lit(STRONGEST), F.greatest(F.lit(WEAKEST), F.when(rho > 0, 1 / rho - 1).otherwise(STRONGEST))), 6),
    ).otherwise(F.lit(STRONGEST))
    s = fit.select(strength.alias("s")).first()["s"]
    return level.withColumn("prior", prior).withColumn("strength", F.lit(STRONGEST if s is None else s)).withColumns({
        "alpha": F.col("good") + F.col("strength") * F.col("prior"),
        "beta": F.col("total") - F.col("good") + F.col("strength") * (1 - F.col("prior")),
    })


def _mean() -> Column:
    return F.col("alpha") / (F.col("alpha") + F.col("beta"))


def reputations(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """``host``, ``mean`` and ``upper`` of all hosts; outcomes: host, good (0, 1, or null for a page without a label).

    The prior of a suffix is the share of all outcomes, that of a registered domain its suffix's posterior mean, that of
    a host its domain's, which alone counts for a host without labels. ``upper``: posterior mean plus ``DEVIATIONS`` standard deviations of the beta posterior.
    Outcomes are grouped once, by host, and these counts are written; the levels are summed up from them, each of them
    with one job for the number that fits its prior.
    """
    hosts = outcomes.groupBy("host").agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("total")).withColumns(
        {"domain": registered_domain(F.col("host"), suffixes), "suffix": suffix_of(F.col("host"), suffixes)}
    )
    hosts = materialized(hosts, "hosts")
    sums = (F.sum("good").alias("good"), F.sum("total").alias("total"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    overall = hosts.agg(F.try_divide(F.sum("good"), F.sum("total")).alias("share")).first()["share"]
    suffix_level = _shrunk(suffixes, F.lit(overall).cast("double")).select("suffix", _mean().alias("suffix_mean"))
    domain_level = _shrunk(domains.join(suffix_level, "suffix"), F.col("suffix_mean")).select("domain", "suffix", _mean().alias("domain_mean"))
    a, b = F.col("alpha"), F.col("beta")
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return _shrunk(hosts.join(domain_level, ["domain", "suffix"]), F.col("domain_mean")).select(
        "host", "domain", "suffix", "domain_mean", _mean().alias("mean"), (_mean() + DEVIATIONS * spread).alias("upper")
    )


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], label: str = "quality", least_good: float = LEAST_GOOD,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` of every page.

    ``pages``: page_id, url. ``labels``: doc_id and 0/1 outcomes; a label tells of the page whose page_id it bears.
    The longest fitting rule decides; without one the method does: a host is blocked if its posterior upper bound is
    below ``least_good``; a host without labelled pages is judged by what its domain and suffix say. ``suffixes`` are
    the public suffixes of more than one label; addresses are pooled with no other host but by all addresses' share.

    Null urls and urls without ``://`` have an empty host and path, which no rule fits; they are one host to the method.
    A null page_id has no label; several labels of one id count as their least; other columns are not read. Labels of
    pages that are repeated count for each. No rows give no rows, no labels block nothing by method.

    Hosts are grouped with partial sums, so a hot host is no hot group; its verdict comes back by a join of one row per
    blocked host, which adaptive execution broadcasts or splits.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = (
        labels.select(F.col("doc_id").alias("page_id"), F.col(label).alias("good")).where("page_id is not null and good in (0, 1)")
        .groupBy("page_id").agg(F.min("good").cast("long").alias("good"))
    )
    outcomes = parts.select("page_id", "host").join(known, "page_id", "left").select("host", "good")
    blocked = reputations(outcomes, suffixes).where(F.col("upper") < least_good).select("host", F.lit("block").alias("method"))
    return (
        parts.join(blocked, "host", "left")
        .withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
        .select(
            "page_id", "host", "path", F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", "method", F.lit("allow")).alias("verdict"),
        )
    )
