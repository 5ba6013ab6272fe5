"""URL filter: host rules first, else a host reputation shrunk from host to registered domain to suffix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import lower_ascii

#: (verdict, host, start of the path)
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: A host is blocked if its share of bad pages is above THRESHOLD with the certainty of Z standard deviations (95 %).
THRESHOLD, Z = 0.5, 1.645
#: Suffixes of two labels under which domains are registered; all others have one label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")
#: Bounds of the correlation of outcomes within a group, which says how far groups are from their parent.
LEAST_RHO, MOST_RHO = 0.01, 0.99


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: from there up to ``? #`` or the end."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"\A[^/?#]*", 0)), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, else null. A rule fits its host and subdomains if the path starts so."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain (suffix and one label more) and suffix of a host; a port is no part of them."""
    bare = F.regexp_replace(host, r":[0-9]*\z", "")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*SUFFIXES)
    return F.when(long, F.substring_index(bare, ".", -3)).otherwise(two), F.when(long, two).otherwise(F.substring_index(bare, ".", -1))


def _strength(groups: DataFrame) -> float:
    """Weight of the parent in a beta prior, by moments: the spread of ``k`` of ``n`` around the parent's mean ``m``."""
    v = F.col("m") * (1 - F.col("m"))
    r = groups.agg(F.sum((F.col("k") - F.col("n") * F.col("m")) ** 2 - F.col("n") * v).alias("a"), F.sum(F.col("n") * (F.col("n") - 1) * v).alias("b")).first()
    rho = min(max((r["a"] or 0.0) / r["b"] if r["b"] else MOST_RHO, LEAST_RHO), MOST_RHO)
    return (1 - rho) / rho


def reputation(outcomes: DataFrame, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """``host, n, k, mean, bound, verdict`` for each host of ``outcomes`` (``host``, ``bad``: 1, 0 or null where not labelled).

    Beta-binomial shrinkage: suffixes around the mean of all pages, domains around their suffix, hosts around their domain. How
    strongly is estimated at each level from all its groups. A host without outcomes has its domain's mean. ``bound`` is the
    lower posterior bound of the bad share (normal approximation); above ``threshold`` the host is blocked. One number per level
    reaches the driver; counts are combined before each shuffle.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = hosts.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix"))
    total = hosts.agg(F.sum("n"), F.sum("k")).first()
    mean = ((total[1] or 0.0) + 1) / ((total[0] or 0.0) + 2)
    up = lambda t, *by: t.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = up(hosts, "domain", "suffix")
    suffixes = up(domains, "suffix").withColumn("m", F.lit(mean))
    post = lambda s: ((F.col("k") + s * F.col("m")) / (F.col("n") + s))
    s = _strength(suffixes)
    domains = domains.join(suffixes.select(F.col("suffix").alias("_s"), post(s).alias("m")), F.col("suffix") == F.col("_s"))
    s = _strength(domains)
    hosts = hosts.join(domains.select(F.col("domain").alias("_d"), post(s).alias("m")), F.col("domain") == F.col("_d"))
    s = _strength(hosts)
    p = post(s)
    found = hosts.select("host", "n", "k", p.alias("mean"), (p - z * F.sqrt(p * (1 - p) / (F.col("n") + s + 1))).alias("bound"))
    return found.withColumn("verdict", F.when(F.col("bound") > threshold, F.lit("block")).otherwise(F.lit("allow")))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, outcomes: DataFrame | None = None, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``; the longest fitting rule decides, else the host's reputation.

    ``outcomes`` (``url``, ``bad``) are labelled pages. Without them the pages that a rule decides are the labelled ones: blocked
    is bad, allowed is good. A null url or one without ``://`` has an empty host and path and no rule; the empty host is judged
    like any other. Repeated rows are judged alike, other columns ignored; without outcomes every mean is one half, which allows.
    """
    host, path = host_and_path(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("r", fitting_rule(F.col("host"), F.col("path"), rules))
    bad = F.when(F.col("r.verdict") == "block", 1).when(F.col("r.verdict") == "allow", 0)
    if outcomes is None:
        seen = p.select("host", bad.alias("bad"))
    else:
        seen = p.select("host", F.lit(None).cast("int").alias("bad")).unionAll(outcomes.select(host.alias("host"), F.col("bad").cast("int").alias("bad")))
    rep = reputation(seen, threshold, z).select(F.col("host").alias("_h"), F.col("verdict").alias("_v"))
    joined = p.join(rep, F.col("host") == F.col("_h"))
    return joined.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", "_v").alias("verdict"))


def filter_urls(pages: DataFrame, **options) -> DataFrame:
    """The allowed rows of ``pages``, with their columns. Pages are told apart by url, so repeated page ids are no matter."""
    v = judge_urls(pages.select(F.col("url").alias("page_id"), "url"), **options).where("verdict = 'allow'").select(F.col("page_id").alias("__url")).distinct()
    return pages.join(v, F.col("url").eqNullSafe(F.col("__url")), "left_semi")
