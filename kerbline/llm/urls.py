"""URL filter: stated rules first, then empirical-Bayes host reputation.  DataFrame functions only.

Labelled pages (good or bad) are counted per host.  A beta-binomial prior is passed down from all pages to the
suffix, the registered domain and the host: each level's rate of bad pages is shrunk towards its parent's with
the weight of a prior worth ``strength`` pages, fitted per level from the spread of the children's rates
(method of moments).  A host is blocked where the lower bound of its posterior rate of bad pages is over the
limit, so a host with few labels can't be blocked on chance alone; hosts without labels take the posterior of
their domain or suffix.

Rules (verdict, host, path) go before: a rule fits its host and all subdomains where the path begins with the
rule's; the longest fitting rule wins.  The rules are an argument, a list held in the plan: keep it to some
thousands.

A null URL or one without ``://`` has an empty host and path, no rule and the verdict of the root prior.  The
registered domain is the suffix and the label before it; a host's suffix is its last two labels where they are on the
list of suffixes (an argument), else its last label.  Reputation is kept by host name alone: ports and user names,
which are part of the reported host, are left out of it.  Repeated pages are judged each; a repeated label counts as often as it stands there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import LOWER, UPPER, checkpoint, small, unwrapped, wrapped

#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Two-label suffixes under which names are registered; hand in a longer list where one is at hand.
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "com.mx", "com.ar", "co.jp", "ne.jp", "co.nz", "co.za", "co.in", "com.cn", "com.tr")
#: Blocked where mean - Z * deviation of the posterior rate of bad pages is over the limit.
Z, LIMIT = 1.645, 0.2
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1000.0


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def name_of(host: Column) -> Column:
    """A host without user name and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def domain_of(name: Column, suffixes=SUFFIXES) -> Column:
    return F.when(F.substring_index(name, ".", -2).isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))


def suffix_of(name: Column, suffixes=SUFFIXES) -> Column:
    return F.when(F.substring_index(name, ".", -2).isin(*suffixes), F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict); null where none fits."""
    longest = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r))
    if not longest:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    fits = lambda r: ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])
    return F.coalesce(*[F.when(fits(r), F.struct(F.lit(r[1] + r[2]).alias("rule"), F.lit(r[0]).alias("verdict"))) for r in longest])


def _shrunk(children: DataFrame) -> DataFrame:
    """Adds the posterior of each child under its parent's mean: mean and strength of the prior, then a and b.

    children: n, bad and the parent's ``pa``, ``pb`` and ``mean``.  One prior strength is fitted for the whole level from sums of
    integers and of products, so that any order of adding gives nearly the same.
    """
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("mean"), F.lit(2.0)))
    within = F.sum(F.col("mean") * (1 - F.col("mean")))
    scale = F.sum((F.col("n") - 1) * F.col("mean") * (1 - F.col("mean")))
    fit = children.agg(F.round(F.try_divide(spread - within, scale), 6).alias("rho"))  # null where every child has one label
    strength = F.when(F.col("rho").isNull() | (F.col("rho") <= 1 / (1 + MAX_STRENGTH)), MAX_STRENGTH).otherwise(F.greatest(F.lit(MIN_STRENGTH), 1 / F.col("rho") - 1))
    rest = F.col("pa") + F.col("pb") - F.col("n")
    prior, worth = (F.col("pa") - F.col("bad")) / rest, F.least(F.col("strength"), rest)
    return children.crossJoin(F.broadcast(fit.select(strength.alias("strength")))).withColumns({"a": prior * worth + F.col("bad"), "b": (1 - prior) * worth + F.col("n") - F.col("bad")})


def reputation(outcomes: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """Labelled pages (host, bad 0/1) -> level, name, a, b: Beta posteriors of the rate of bad pages.

    Levels are root, suffix, domain and host.  Labels are counted per host first, so no shuffle carries pages.
    """
    hosts = checkpoint(outcomes.where(F.col("bad").isNotNull()).groupBy(name_of(F.col("host")).alias("host")).agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")))
    root = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).select(F.lit("root").alias("level"), F.lit("").alias("name"), (F.col("bad") + 1.0).alias("a"), (F.col("n") - F.col("bad") + 1.0).alias("b"))
    up, levels = root, [root]
    suffix, domain = (lambda h: suffix_of(h, suffixes)), (lambda h: domain_of(h, suffixes))
    for level, key, above in (("suffix", suffix, lambda h: F.lit("")), ("domain", domain, suffix), ("host", lambda h: h, domain)):
        rows = hosts.groupBy(key(F.col("host")).alias("name"), above(F.col("host")).alias("above")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        parents = up.select(F.col("name").alias("above"), F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"))
        up = checkpoint(_shrunk(rows.join(parents, "above")).select(F.lit(level).alias("level"), "name", "a", "b"))
        levels.append(up)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


def lower_bound(a: Column, b: Column, z: float = Z) -> Column:
    mean = a / (a + b)
    return mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))


def _with_verdicts(seen: DataFrame, outcomes: DataFrame, rules, z: float, limit: float, suffixes) -> DataFrame:
    """Rows with host and path, and with rule, verdict and bad_bound.

    Pages are judged per distinct host: hosts are few beside pages, and the table of judged hosts is broadcast only
    where its count allows.
    """
    rep = checkpoint(reputation(outcomes, suffixes))
    of = lambda level, name: rep.where(F.col("level") == level).select(F.col("name").alias(name), F.struct("a", "b").alias(f"{level}_ab"))
    name = name_of(F.col("host"))
    hosts = seen.select("host").distinct().withColumns({"name": name, "domain": domain_of(name, suffixes), "suffix": suffix_of(name, suffixes)})
    root = F.broadcast(rep.where(F.col("level") == "root").select(F.struct("a", "b").alias("root_ab")))  # one row
    judged = hosts.join(of("host", "name"), "name", "left").join(of("domain", "domain"), "domain", "left").join(of("suffix", "suffix"), "suffix", "left").crossJoin(root)
    ab = F.coalesce("host_ab", "domain_ab", "suffix_ab", "root_ab")
    judged = checkpoint(judged.select("host", F.round(lower_bound(ab["a"], ab["b"], z), 6).alias("bad_bound")))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("bad_bound") > limit, "block").otherwise("allow"))
    ruled = seen.join(small(judged, judged.count()), "host").withColumn("r", best_rule(F.col("host"), F.col("path"), rules))
    return ruled.withColumns({"rule": F.col("r.rule"), "verdict": verdict}).drop("r")


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = Z, limit: float = LIMIT, suffixes=SUFFIXES) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict, and bad_bound: the bound that the method judged by; ``outcomes`` has host and bad."""
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return _with_verdicts(seen, outcomes, rules, z, limit, suffixes).select("page_id", "host", "path", "rule", "verdict", "bad_bound")


def keep(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = Z, limit: float = LIMIT, suffixes=SUFFIXES) -> DataFrame:
    """The pages that are allowed, each row judged by its own url, whatever its page_id; rows keep all their columns."""
    seen = wrapped(pages, host=host_of(F.col("url")), path=path_of(F.col("url")))
    return unwrapped(_with_verdicts(seen, outcomes, rules, z, limit, suffixes).where(F.col("verdict") == "allow"))
