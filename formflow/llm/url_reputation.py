"""URL filter: rules first, then the host's reputation by empirical Bayes.

Labelled pages give each host a number of pages and of bad ones. A host's rate is
shrunk towards that of its registered domain, the domain's towards that of its suffix,
the suffix's towards the overall rate: at each level the parent's posterior mean is the
mean of a beta prior, whose strength is estimated by the method of moments from how
much more the children differ than binomial counts would. A page is blocked if the
lower posterior bound of its host's rate is above a limit, so a host is not blocked on
little evidence.

Counts per host are combined on the map side; only hosts, not pages, take part in the
joins of the levels, and the join of pages to hosts carries the url alone. Three
strengths and the overall rate are the only numbers that come to the driver.

Defined results: a null url, or one without ``://``, has an empty host and path; a null
label counts as not labelled; repeated rows are judged (and, if labelled, counted) one
by one; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import ROW, packed, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels below which names are registered, unless a caller passes its own list.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "com.br", "co.jp", "co.in", "co.nz", "co.za")
#: Hosts that are addresses, and so their own domain.
ADDRESS = "^[0-9]+([.][0-9]+){3}$|[\\[\\]:]"
#: Blocked from this lower bound of the bad rate on; the bound is so many deviations below the mean.
LIMIT, DEVIATIONS = 0.4, 1.645


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    prefix: str  # host, / and the beginning of a path


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.translate(F.coalesce(F.regexp_extract(rest, "^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as (prefix, verdict); a rule list is short and becomes one CASE."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r.prefix)):
        name, _, rest = rule.prefix.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        value = F.struct(F.lit(rule.prefix).alias("prefix"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<prefix:string,verdict:string>")


def domain_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    """Registered domain: the label before the suffix, and the suffix. User, port and final dots are left out; a host of
    one label and one that is an address are their own."""
    name = F.regexp_replace(host, "^.*@|:[0-9]*$|[.]+$|[.]+:[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    return F.when(name.rlike(ADDRESS), name).when(two.isin(*long_suffixes), F.substring_index(name, ".", -3)).otherwise(two)


def suffix_of(domain: Column) -> Column:
    below = (F.instr(domain, ".") > 0) & ~domain.rlike(ADDRESS)
    return F.when(below, F.substring(domain, F.instr(domain, ".") + 1, F.length(domain))).otherwise(domain)


def _strength(children: DataFrame) -> float:
    """Strength of the beta prior over ``children(n, bad, prior)``.

    The squared distance of a child's bad pages from n * p is expected to be
    n p (1 - p) (1 + (n - 1) rho); the strength is 1 / rho - 1.
    """
    over, scale = children.agg(
        F.sum((F.col("bad") - F.col("n") * F.col("prior")) ** 2 - F.expr("n * prior * (1 - prior)")),
        F.sum(F.expr("n * (n - 1) * prior * (1 - prior)")),
    ).first()
    rho = min(max((over or 0.0) / scale, 0.001), 0.95) if scale else 0.5
    return 1 / rho - 1


def host_rates(pages: DataFrame, outcomes: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """Per host: labelled pages, bad ones, posterior mean and deviation of its bad rate."""
    labelled = outcomes.where("bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    urls = pages.select("page_id", host_of(F.col("url")).alias("host")).join(labelled, "page_id", "left")
    hosts = urls.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), long_suffixes))
    hosts = staged(hosts.withColumn("suffix", suffix_of(F.col("domain"))), "hosts")
    n, bad = (x or 0 for x in hosts.agg(F.sum("n"), F.sum("bad")).first())
    overall = (bad + 1) / (n + 2)

    def posterior(children: DataFrame) -> DataFrame:
        strength = _strength(children)
        mean = (F.col("prior") * strength + F.col("bad")) / (F.col("n") + strength)
        out = children.withColumn("rate", mean)
        return out.withColumn("deviation", F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + strength + 1)))

    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = posterior(hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(overall)))
    of_suffix = suffixes.select("suffix", F.col("rate").alias("prior"))
    domains = posterior(hosts.groupBy("suffix", "domain").agg(*sums).join(of_suffix, "suffix"))
    of_domain = domains.select("domain", F.col("rate").alias("prior"))
    return posterior(hosts.join(of_domain, "domain")).select("host", "n", "bad", "rate", "deviation")


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    keep: list[str] | None = None,
    limit: float = LIMIT,
    long_suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """Rows of ``pages(page_id, url, ...)`` packed, with host, path, rule, the host's bad rate and its lower
    bound, and the verdict. ``outcomes(page_id, bad)`` labels some of them."""
    url = F.col("url")
    rows = packed(pages, keep, host=host_of(url), path=path_of(url))
    rows = rows.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    rates = host_rates(pages, outcomes, long_suffixes).select("host", "rate", F.greatest(F.lit(0.0), F.col("rate") - DEVIATIONS * F.col("deviation")).alias("bound"))
    judged = rows.join(rates, "host", "left")
    return judged.select(
        ROW,
        "host",
        "path",
        F.col("match.prefix").alias("rule"),
        F.coalesce("match.verdict", F.when(F.col("bound") > limit, "block").otherwise("allow")).alias("verdict"),
        F.round("rate", 6).alias("bad_rate"),
        F.round("bound", 6).alias("bad_bound"),
    )


def keep_allowed(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], **how) -> DataFrame:
    """The rows of ``pages`` that are not blocked, with their columns."""
    return judge(pages, outcomes, rules, **how).where("verdict = 'allow'").select(f"{ROW}.*")
