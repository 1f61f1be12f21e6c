"""URL filtering by rules and by empirical-Bayes host reputation.

Labelled page outcomes (1 bad, 0 good) are counted by host, registered domain and public
suffix.  Rates shrink from the top down through beta-binomial priors: a suffix towards the
overall rate, a domain towards its suffix, a host towards its domain.  How strongly is
estimated by moments at each level: children that differ little from their parents pool
more.  A host is blocked if the lower bound of its posterior bad rate passes a limit, so
little evidence never blocks.  The bound is that of a normal curve with the beta posterior's mean
and variance: against the beta quantile it is off by 0.06 at most at 5 pseudo-counts, the
least there are, 0.025 at 20 and 0.006 at 100; a host is blocked from a rate of 0.78 (beta: 0.82)
at 5, 0.67 (0.68) at 20.

Rules come first: a rule fits its host and all subdomains if the url's path starts with the
rule's path; the longest wins.

Defined cases: a null url or one without ``://`` has an empty host and path and is judged
as the host ""; pages without an outcome inform nothing but are judged; repeated rows count
and are judged each; hosts without outcomes inherit their domain's or suffix's rate; with no
outcomes at all the overall rate is one half and nothing is blocked; an empty table gives an
empty table.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellforge.llm.tables import lower_ascii, stash, unstash, unused

URL_PATTERN = r"://([^/?#]*)([^?#]*)"

# Second-level labels under which names are registered (as in co.uk).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
COUNTRY_CHARS = 2

LEAST_STRENGTH, MOST_STRENGTH = 5.0, 1000.0  # pseudo-counts of a prior
Z, BAD_LIMIT = 1.645, 0.5


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL_PATTERN, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def host_suffix(host: Column) -> Column:
    """The last label, or the last two where the second-level label is a registry's."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    second = F.when(n >= 3, F.element_at(parts, -2)).otherwise("")
    two = (F.length(F.element_at(parts, -1)) == COUNTRY_CHARS) & second.isin(*SECOND_LEVEL)
    return F.when(two, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.element_at(parts, -1))


def registered_domain(host: Column) -> Column:
    """The suffix and one label before it; the host itself where there is none."""
    parts = F.split(host, r"\.")
    keep = F.least(F.size(F.split(host_suffix(host), r"\.")) + 1, F.size(parts))
    return F.array_join(F.slice(parts, -keep, keep), ".")


def with_suffixes(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and more -> also ``suffix`` and ``domain`` by a table of public suffix rules
    (column ``rule``): names (``co.uk``), wildcards (``*.ck``: every label before it) and
    exceptions (``!www.ck``), of which an exception wins, else the longest.  A host that no
    rule fits has its last label as suffix.  Hosts meet the rules by an ordinary join of
    their endings, so the table may be of any size."""
    parts = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(parts, -k, k), ".").alias("tail")))
    ends = hosts.select("host", F.size(parts).alias("n"), F.explode(tails).alias("t")).select("host", "n", "t.k", "t.tail")
    told = rules.select(F.trim(F.col("rule")).alias("rule")).where("rule is not null and rule != ''").distinct()
    told = told.select(
        F.regexp_replace("rule", r"^(!|\*\.)", "").alias("tail"), F.col("rule").startswith("!").alias("excepted"),
        F.col("rule").startswith("*.").cast("int").alias("wild"),
    )
    # Labels of the suffix: a wildcard takes one more than its name, an exception one less.
    labels = F.col("k") + F.col("wild") - F.col("excepted").cast("int")
    fits = ends.join(told, "tail").where(labels <= F.col("n")).groupBy("host").agg(F.max(F.struct("excepted", labels.alias("labels"))).alias("best"))
    best = hosts.join(fits.withColumnRenamed("host", "ruled"), F.col("host") == F.col("ruled"), "left")
    labels, n = F.coalesce("best.labels", F.lit(1)), F.size(parts)
    suffix = F.array_join(F.slice(parts, -labels, labels), ".")
    more = F.least(labels + 1, n)
    return best.withColumn("suffix", suffix).withColumn("domain", F.array_join(F.slice(parts, -more, more), ".")).drop("ruled", "best")


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting of ``(verdict, "host/path")``; else null."""
    found = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _strength(level: DataFrame) -> Column:
    """Pseudo-counts of the beta prior from ``n, k, mean`` (mean: the parent's rate): the
    spread of the children's rates beyond that of binomial draws, by moments."""
    n, k, mean = F.col("n"), F.col("k"), F.col("mean")
    noise = F.sum(mean * (1 - mean))  # of sum n (k/n - mean)^2
    square = F.sum(n * (k / n - mean) * (k / n - mean))
    extra = F.sum((n - 1) * mean * (1 - mean))
    rho = F.try_divide(square - noise, extra)
    rho = F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(1.0 / (MOST_STRENGTH + 1)))
    return F.greatest(1.0 / rho - 1.0, F.lit(LEAST_STRENGTH))


def _shrunk(level: DataFrame) -> DataFrame:
    """``n, k, mean, known`` (the parent's rate and its pseudo-counts) with ``weight`` and the
    level's own ``rate``.  A prior counts no more than what its parent is known by."""
    strength = level.where("n > 0").agg(F.coalesce(_strength(level), F.lit(MOST_STRENGTH)).alias("strength"))
    # One row, an aggregate without keys: the join is a lookup of one value.
    with_strength = level.join(F.broadcast(strength))
    with_strength = with_strength.withColumn("strength", F.least("strength", "known")).withColumn("weight", F.col("n") + F.col("strength"))
    return with_strength.withColumn("rate", (F.col("k") + F.col("strength") * F.col("mean")) / F.col("weight"))


def host_reputation(outcomes: DataFrame, suffix_rules: DataFrame | None = None) -> DataFrame:
    """``host, outcome (0/1 or null) -> host, domain, suffix, n, k, prior, rate, low, high``:
    the posterior bad rate of every host with its bounds.  ``suffix_rules``: a table of public
    suffix rules (``with_suffixes``); without it SECOND_LEVEL names registries' labels."""
    hosts = outcomes.groupBy("host").agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).cast("double").alias("k"))
    if suffix_rules is None:
        hosts = hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", host_suffix(F.col("host")))
    else:
        hosts = with_suffixes(hosts, suffix_rules)
    hosts = stash(hosts, "hosts")
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0.0))
    overall = hosts.agg(((k + 0.5) / (n + 1.0)).alias("mean"), (n + 1.0).alias("known"))
    suffixes = stash(_shrunk(suffixes.join(F.broadcast(overall))), "suffixes")  # one row, as above
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = _shrunk(domains.join(suffixes.select("suffix", F.col("rate").alias("mean"), F.col("weight").alias("known")), "suffix"))
    domains = stash(domains, "domains")
    judged = hosts.join(domains.select("domain", "suffix", F.col("rate").alias("mean"), F.col("weight").alias("known")), ["domain", "suffix"])
    judged = stash(_shrunk(judged), "reputation")
    for done in (hosts, suffixes, domains):
        unstash(done)
    spread = Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return judged.select(
        "host", "domain", "suffix", "n", "k", F.col("mean").alias("prior"), "rate",
        F.greatest(F.col("rate") - spread, F.lit(0.0)).alias("low"), F.least(F.col("rate") + spread, F.lit(1.0)).alias("high"),
    )


def judge_urls(
    pages: DataFrame, url: str, outcome: str, rules: list[tuple[str, str]], limit: float = BAD_LIMIT, suffix_rules: DataFrame | None = None
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, bad_rate, bad_low`` (replaced if there)."""
    drop = [c for c in ("host", "path", "rule", "verdict", "bad_rate", "bad_low") if c not in (url, outcome)]
    parsed = pages.drop(*drop).withColumn("host", url_host(F.col(f"`{url}`"))).withColumn("path", url_path(F.col(f"`{url}`")))
    rates = host_reputation(parsed.select("host", F.col(f"`{outcome}`").cast("int").alias("outcome")), suffix_rules)
    joined = parsed.join(rates.select("host", F.col("rate").alias("bad_rate"), F.col("low").alias("bad_low")), "host")
    found = unused(joined, "_rule")
    ruled = joined.withColumn(found, longest_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("bad_low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return (
        ruled.withColumn("rule", F.col(f"{found}.rule"))
        .withColumn("verdict", F.coalesce(F.col(f"{found}.verdict"), own))
        .drop(found)
    )
