"""URL filters by rules and, where no rule fits, by the reputation of hosts.

All work is DataFrame and SQL functions. Pages with a known outcome are counted by host,
registered domain and suffix. Each level's share of bad pages has a beta prior around the
share of the level above: all pages for a suffix, the suffix for a domain, the domain for
a host. How strongly a level keeps to the one above follows from the data: the moment
estimate of the correlation of outcomes within a group of that level. So a host with few
outcomes is judged as its domain is, and one with many by its own. A url is blocked if the
lower bound of its host's posterior (Wilson's interval for the posterior's mean and weight)
is over what is tolerated.

Null urls and urls without `://` have an empty host and path, and are judged as the pages of
the empty host. Repeated ids: all outcomes of an id count for each of its pages; null
outcomes and null ids do not count. Without any outcome all is allowed. Ports and user names
stay in the host, as written, and are left out of the domain; an address of four numbers is
its own domain and suffix. Pages pass one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common

#: Suffixes of two names under which domains are registered; others have one name. A list for a deployment is passed in its place.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in", "com.cn", "co.za")
#: Share of bad pages that is tolerated, how many deviations below the mean the bound lies, and the bounds of a prior's weight in pages.
TOLERATED, DEVIATIONS, WEIGHTS = 0.4, 1.645, (1.0, 10_000.0)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict on a host and all its subdomains where the path starts so: `net/es/`."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.text.partition("/")
        return ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")


RULES = (Rule("com/", "allow"), Rule("example.com/en/", "block"), Rule("www.example.com/en/", "allow"), Rule("net/es/", "block"), Rule("net/fr/", "block"))


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or end; A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(text, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        out = F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def with_domain(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Hosts with domain (a suffix and one name more, or the whole name if it has no more) and suffix."""
    bare = F.regexp_replace(F.regexp_replace("host", r"^.*@", ""), r":[0-9]*$", "")
    last = lambda n: F.substring_index("_bare", ".", -n)
    number = F.col("_bare").rlike(r"^[0-9]+(\.[0-9]+){3}$")
    names = F.when(last(2).isin(list(suffixes)), 2).otherwise(1)
    suffix = F.when(number, F.col("_bare")).when(names == 2, last(2)).otherwise(last(1))
    domain = F.when(number, F.col("_bare")).when(names == 2, last(3)).otherwise(last(2))
    return hosts.withColumn("_bare", bare).withColumns({"domain": domain, "suffix": suffix}).drop("_bare")


def host_counts(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, pages, seen, bad): pages (page_id, host), and outcomes (page_id, bad) that are known, counted by host."""
    by_id = outcomes.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(F.count("bad").alias("seen"), F.count_if("bad").alias("bad"))
    # pages that share id and host are one row, so that an id that is repeated on both sides is no product
    by_page = pages.groupBy("page_id", "host").agg(F.count("*").alias("pages")).join(by_id, "page_id", "left")
    known = lambda c: F.coalesce(F.sum(F.col("pages") * F.col(c)), F.lit(0)).alias(c)
    return by_page.groupBy("host").agg(F.sum("pages").alias("pages"), known("seen"), known("bad"))


def _prior_weight() -> Column:
    """Weight of a level's prior in pages, from groups (seen, bad, above): 1 / rho - 1 for the moment estimate of rho, the correlation within groups."""
    share = F.col("bad") / F.col("seen")
    spread = F.sum(F.col("seen") * (share - F.col("above")) * (share - F.col("above")) / (F.col("above") * (1 - F.col("above"))))
    rho = (spread - F.count("*")) / F.nullif(F.sum(F.col("seen") - 1), F.lit(0))
    low, high = WEIGHTS
    return F.coalesce(F.when(rho <= 0, high).otherwise(F.least(F.greatest(1 / rho - 1, F.lit(low)), F.lit(high))), F.lit(high)).alias("weight")


def _shrunk(groups: DataFrame) -> DataFrame:
    """Groups (seen, bad, above) with weight and mean, the posterior's: towards the level above by the level's weight."""
    weight = groups.where("seen > 0").agg(_prior_weight())  # one row
    return groups.join(F.broadcast(weight)).withColumn("mean", (F.col("bad") + F.col("weight") * F.col("above")) / (F.col("seen") + F.col("weight")))


def wilson_low(mean: Column, n: Column, z: float) -> Column:
    return (mean + z * z / (2 * n) - z * F.sqrt(mean * (1 - mean) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def reputations(hosts: DataFrame, deviations: float = DEVIATIONS, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(host, pages, seen, bad, domain, suffix, mean, bound) of hosts (host, pages, seen, bad)."""
    named = common.kept(with_domain(hosts, suffixes), "hosts")
    counts = F.sum("seen").alias("seen"), F.sum("bad").alias("bad")
    domains = named.groupBy("suffix", "domain").agg(*counts)
    root = named.agg(((F.sum("bad") + 0.5) / (F.sum("seen") + 1)).alias("above"))  # one row
    by_suffix = _shrunk(domains.groupBy("suffix").agg(*counts).join(F.broadcast(root))).select("suffix", F.col("mean").alias("above"))
    by_domain = common.kept(_shrunk(domains.join(by_suffix, "suffix")).select("domain", F.col("mean").alias("above")), "domains")
    sizes = by_domain.join(named.groupBy("domain").agg(F.count("*").alias("hosts")), "domain")
    judged = _shrunk(common.joined_to_groups(named, sizes, "domain", "hosts"))
    bound = wilson_low(F.col("mean"), F.col("seen") + F.col("weight"), deviations)
    return judged.select("host", "pages", "seen", "bad", "domain", "suffix", "mean", bound.alias("bound"))


def filtered(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES, tolerated: float = TOLERATED, deviations: float = DEVIATIONS, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_share, bad_bound) of every page (page_id, url)."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = common.kept(reputations(common.kept(host_counts(parts.select("page_id", "host"), outcomes), "host_counts"), deviations, suffixes), "reputations")
    judged = common.joined_to_groups(parts, known.select("host", "pages", "mean", "bound"), "host", "pages")
    ruled = judged.withColumn("_rule", first_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("_rule.verdict", F.when(F.col("bound") > tolerated, "block").otherwise("allow"))
    return ruled.select("page_id", "host", "path", F.col("_rule.text").alias("rule"), verdict.alias("verdict"), F.col("mean").alias("bad_share"), F.col("bound").alias("bad_bound"))


def op11_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad if the label under its id says that it is poor or toxic."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return filtered(pages, outcomes).withColumns({c: F.round(c, 6) for c in ("bad_share", "bad_bound")})
