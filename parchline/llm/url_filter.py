"""URL filter by empirical-Bayes host reputation, in DataFrame functions only.

Labelled outcomes of pages (bad or not) are counted per host. Reputations are shrunk level by level
through beta-binomial priors: the share of all pages is the prior of each suffix, a suffix's
posterior mean the prior of its registered domains, a domain's that of its hosts. How strongly each
level is shrunk is estimated from the data: the strength of a level's prior is the one that matches the
spread of its children (method of moments), held between ``LEAST_STRENGTH`` and ``MOST_STRENGTH``. A host is
blocked if the lower posterior bound of its bad share, mean minus ``z`` standard deviations,
reaches ``limit``; hosts without labels inherit the bound of their prior.

Explicit rules come first: a rule (``host/path``) fits its host and all subdomains if the url's path starts
with the rule's path; the longest one wins (equal lengths: the first in code point order).

The registered domain of a host is its last two labels, three if the last two are a known
two-label suffix; the suffix is what is left of it without its first label.

Counts are partial sums per host and only hosts are joined with reputations; a host that holds a
third of all pages is split by the adaptive skew join. The priors of suffixes and the overall
figures come from sums over domains.

Defined results: a null url or one without ``://`` has an empty host and path and is judged as the
empty host; pages without labels count for nobody; null labels are ignored; several labels of one page all count;
repeated pages are each answered. Rules are at most ``MAX_RULES``, as they become one expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
MAX_RULES = 2000

#: Public suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = (
    "ac.uk co.uk gov.uk org.uk com.au net.au org.au co.jp ne.jp or.jp co.nz com.br com.cn com.mx co.in co.za com.tr co.kr"
).split()


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def suffix_of(domain: Column) -> Column:
    dot = F.instr(domain, ".")
    return F.when(dot > 0, F.expr("substring(domain, instr(domain, '.') + 1)")).otherwise(domain)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null. ``rules``: (rule, verdict)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    tests = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        rule_host, slash, rest = rule.partition("/")
        fits = (host == rule_host) | host.endswith("." + rule_host)
        tests.append(F.when(fits & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def _strength(n: Column, prior: Column, children: Column, squares: Column) -> Column:
    """Prior strength from the spread of the children's shares.

    Under a prior of mean p and strength s, the squared deviation of a child with n_i labels, weighted
    by n_i, is expected to be p (1 - p) (s + n_i) / (s + 1); summed over the children and solved for s.
    """
    even = prior * (1 - prior)
    spread = squares / even
    found = (n - spread) / (spread - children)
    return F.when((even <= 0) | (spread <= children), F.lit(MOST_STRENGTH)).otherwise(
        F.least(F.lit(MOST_STRENGTH), F.greatest(F.lit(LEAST_STRENGTH), found))
    )


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, n, bad, mean, deviation for every host of ``pages``; ``outcomes`` has page_id and bad (0 or 1)."""
    marks = outcomes.filter("page_id is not null and bad in (0, 1)").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")
    )
    hosts = (
        pages.select("page_id", url_host(F.col("url")).alias("host"))
        .join(marks, "page_id", "left")
        .groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("domain", registered_domain(F.col("host")))
        .withColumn("suffix", suffix_of(F.col("domain")))
    )
    domains = _level(hosts, ["suffix", "domain"])
    suffixes = _level(domains, ["suffix"])
    everything = _level(suffixes, [])
    share = F.when(F.col("n") > 0, (F.col("bad") + 0.5) / (F.col("n") + 1)).otherwise(F.lit(0.5))
    strength = _strength(F.col("n"), share, F.col("children"), F.col("squares"))
    top = everything.select(F.struct(share.alias("prior"), strength.alias("strength"))).scalar()
    suffixes = _shrunk(suffixes.withColumn("prior", top["prior"]).withColumn("strength", top["strength"]))
    domains = _shrunk(domains.join(_priors(suffixes, "suffix"), "suffix"))
    hosts = hosts.join(_priors(domains.drop("suffix"), "domain"), "domain")
    a, b = F.col("strength") * F.col("prior") + F.col("bad"), F.col("strength") * (1 - F.col("prior")) + F.col("n") - F.col("bad")
    return hosts.select(
        "host",
        "n",
        "bad",
        (a / (a + b)).alias("mean"),
        F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))).alias("deviation"),
    )


def _level(children: DataFrame, keys: list[str]) -> DataFrame:
    """Sums per parent: labels, bad ones, labelled children, and the weighted squared deviation of their shares."""
    n, bad = F.col("n").cast("decimal(20,0)"), F.col("bad").cast("decimal(20,0)")
    own = F.when(F.col("n") > 0, F.round(F.col("bad") * F.col("bad") / F.col("n"), 6).cast("decimal(26,6)"))
    sums = children.groupBy(*keys).agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n"),
        F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias("bad"),
        F.count(F.when(F.col("n") > 0, 1)).alias("children"),
        F.coalesce(F.sum(own).cast("double"), F.lit(0.0)).alias("own"),
    )
    # sum n_i (b_i/n_i - b/n)^2 = sum b_i^2/n_i - b^2/n
    around = F.when(F.col("n") > 0, F.greatest(F.lit(0.0), F.col("own") - F.col("bad") * F.col("bad") / F.col("n"))).otherwise(F.lit(0.0))
    return sums.withColumn("squares", around).drop("own")


def _shrunk(level: DataFrame) -> DataFrame:
    """Posterior mean of each row under its prior."""
    mean = (F.col("bad") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength"))
    return level.withColumn("mean", mean).drop("prior", "strength")


def _priors(level: DataFrame, key: str) -> DataFrame:
    """What a level's rows are to their children: prior mean and strength."""
    strength = _strength(F.col("n"), F.col("mean"), F.col("children"), F.col("squares"))
    return level.select(key, F.col("mean").alias("prior"), strength.alias("strength"))


def judged(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]],
    limit: float = 0.25,
    z: float = 1.645,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's bound, for every page."""
    reputation = host_reputation(pages, outcomes)
    bound = reputation.select("host", F.greatest(F.lit(0.0), F.col("mean") - z * F.col("deviation")).alias("bound"))
    found = pages.select(
        F.col("page_id"), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    ).withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    by_host = F.when(F.col("bound") >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return found.join(bound, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce(by_rule, by_host).alias("verdict"), F.round("bound", 6).alias("bound")
    )
