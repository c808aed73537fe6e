"""Filtering urls by rules and by the reputation of their hosts, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import stored
from earshot.operators.lookup import lookup_join

#: Labels that stand for "any registrant" before a country code, as in co.uk.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Levels of the prior, the most particular first.
LEVELS = ("host", "domain", "suffix")


def host_of(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without a host."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    """The host's labels, without user, port and a dot at the end."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), "[.]?(:[0-9]*)?$", "")
    return F.split(bare, "[.]")


def _tail(labels: Column, n: Column) -> Column:
    """The last `n` labels, or all."""
    size = F.least(n, F.size(labels))
    return F.array_join(F.slice(labels, F.size(labels) - size + 1, size), ".")


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """The registered domain of a host, and the suffix under which it is registered.

    The suffix is the last label, or the last two where the last is a country code of two letters behind
    one of SECOND_LEVEL; the domain has one label more. A host that is an address of numbers is its own
    domain, without a suffix.
    """
    labels = _labels(host)
    country = F.element_at(labels, -1).rlike("^[a-z]{2}$") & (F.size(labels) > 2)
    second = country & F.get(labels, F.size(labels) - 2).isin(*SECOND_LEVEL)
    width = F.when(second, F.lit(2)).otherwise(F.lit(1))
    address = host.rlike("^([0-9]+[.])+[0-9]+(:[0-9]*)?$|^\\[")
    domain = F.when(address, host).otherwise(_tail(labels, width + 1))
    return domain, F.when(address, F.lit("")).otherwise(_tail(labels, width))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of `rules` (verdict, host and path as in `net/`) that fits, as a struct of rule and
    verdict, or null. A rule fits its host and all subdomains, if the path starts with the rule's; of
    two as long, the one with the longer host wins. One comparison a rule and row."""
    fitting = []
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        if not name or not slash or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {verdict} {rule}")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        fitting.append((len(rule), len(name), rule, verdict, fits))
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The shortest is the last that is asked.
    for _, _, rule, verdict, fits in sorted(fitting, key=lambda x: x[:3]):
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def _posteriors(children: DataFrame, strength: float) -> DataFrame:
    """`children` (labelled, bad, mu) with alpha and beta of their posterior.

    Prior: Beta(mu * s, (1 - mu) * s), mu being the parent's posterior mean. The strength s is common to
    a level and follows from its children by moments: if shares of children differ by no more than their
    counts explain, s is large and the children say what their parent says. `strength` is taken where
    no child has two outcomes.
    """
    n, y, mu = F.col("labelled"), F.col("bad"), F.col("mu")
    spread = mu * (1 - mu)
    seen = F.col("labelled") > 0
    fit = children.agg(
        F.sum(F.when(seen, (y - n * mu) * (y - n * mu) / n)).alias("_square"),
        F.sum(F.when(seen, spread)).alias("_one"),
        F.sum(F.when(seen, spread * (n - 1))).alias("_more"),
    )
    rho = F.greatest(F.lit(1e-4), F.least(F.lit(0.5), (F.col("_square") - F.col("_one")) / F.col("_more")))
    fit = fit.select(F.when(F.col("_more") > 0, 1 / rho - 1).otherwise(F.lit(strength)).alias("_s"))
    # One line, so the nested loop only adds a column.
    return (
        children.crossJoin(F.broadcast(fit))
        .withColumns({"alpha": mu * F.col("_s") + y, "beta": (1 - mu) * F.col("_s") + n - y})
        .drop("_s")
    )


def reputations(pages: DataFrame, outcomes: DataFrame, strength: float = 10.0) -> DataFrame:
    """(host, labelled, bad, mean, deviation): what is believed of the share of bad pages on each host of
    `pages` (page_id, url), given `outcomes` (page_id, bad boolean or null).

    Counts of hosts are shrunk towards their registered domain, domains towards their suffix, suffixes
    towards all pages, each by a beta-binomial prior whose strength is estimated on its level. Pages are
    counted by host in the map tasks; domains and suffixes are counted from hosts. A page is bad if any
    of its outcomes is, and unlabelled if all are null. Several rows of a page count each.
    """
    judged = outcomes.groupBy(F.col("page_id").alias("_id")).agg(F.max("bad").alias("_bad"))
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"))
    seen = seen.join(judged.where("_bad is not null"), F.col("page_id") == F.col("_id"), "left")
    counted = seen.groupBy("host").agg(F.count("_bad").alias("labelled"), F.count_if("_bad").alias("bad"))
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = stored(counted.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = stored(hosts.groupBy("domain", "suffix").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(
        ((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("labelled"), F.lit(0)) + 1)).alias("mu")
    )
    known = stored(_posteriors(suffixes.crossJoin(F.broadcast(whole)), strength), "suffixes")
    for table, key in ((domains, "suffix"), (hosts, "domain")):
        above = known.select(key, (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("mu"))
        # Most domains may be of one suffix, most hosts of one domain.
        below = lookup_join(table, above, key, spread_on=[c for c in ("host", "domain") if c in table.columns], profile=table)
        known = stored(_posteriors(below, strength), key)
    a, b = F.col("alpha"), F.col("beta")
    return known.select(
        "host",
        "labelled",
        "bad",
        (a / (a + b)).alias("mean"),
        F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))).alias("deviation"),
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]] = (),
    limit: float = 0.5,
    deviations: float = 3.0,
    strength: float = 10.0,
) -> DataFrame:
    """A row per row of `pages` (page_id, url): page_id, host, path, rule, verdict, host_mean, host_bound.

    The longest of `rules` that fits decides (`rule_for`). Where none does, a page is blocked if the
    lower posterior bound of its host's share of bad pages, the posterior mean less `deviations`
    posterior deviations (`reputations`), is above `limit`. By Cantelli's inequality the share is then
    above the limit with a probability of k^2 / (1 + k^2) at least, 0.9 for 3 deviations, whatever the
    shape of the posterior; hosts of few outcomes are not blocked for chance.

    Pages meet their host's reputation by a lookup that broadcasts the hosts only if they are measured
    to be small and cuts hot hosts into pieces otherwise.

    Null url or one without `://`: host and path are empty; such pages have a reputation together. No
    outcomes at all: nothing is blocked but by a rule. Null page_id: judged, never labelled. Repeated
    rows are judged each. Empty table: no rows. Other columns are ignored.
    """
    believed = reputations(pages, outcomes, strength).select(
        "host", F.col("mean").alias("host_mean"), (F.col("mean") - deviations * F.col("deviation")).alias("host_bound")
    )
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = lookup_join(parsed, believed, "host", spread_on=["page_id", "path"], profile=parsed)
    found = rule_for(F.col("host"), F.col("path"), list(rules))
    by_method = F.when(F.col("host_bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("_rule", found).select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_method).alias("verdict"),
        "host_mean",
        "host_bound",
    )
