"""URL filter: list rules first, then the reputation of the host.

Reputation is empirical Bayes: labelled page outcomes are shrunk through
beta-binomial priors, from all pages to the suffix, the registered domain and
the host. The mean of a level's prior is its parent's posterior mean; its
strength comes from how much the level's rates differ beyond chance
(moments), held to a prior guess where little can be learnt, and from how
sure the parent's mean is. A host with a bad page is blocked if the lower bound
of its posterior bad rate, a quantile of the beta distribution, reaches the
threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import ascii_lower, saved, skew_join

#: (verdict, host/path) rules of the contract.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Suffixes of two labels under which names are registered; otherwise the last label is the suffix.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "co.za", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr")


@dataclass(frozen=True)
class Params:
    """``alpha``: the quantile that is the posterior bound; ``limit``: the
    bound from which a host is blocked; ``rho``: least and greatest correlation
    of outcomes within a level's group; ``guess``: its prior guess, and the
    further outcomes of groups that the guess weighs."""

    alpha: float = 0.05
    limit: float = 0.5
    rho: tuple[float, float] = (0.001, 0.5)
    guess: tuple[float, float] = (0.1, 20.0)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, null if none."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def domain_columns(host: Column, long_suffixes=LONG_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; user names and ports are left
    out. An IP address is its own domain, of the suffix ``ip``."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    labels = F.split(bare, r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
    long, ip = last(2).isin(*long_suffixes), bare.rlike(r"^(\d{1,3}(\.\d{1,3}){3}|\[.*\])$")
    return F.when(ip, bare).when(long, last(3)).otherwise(last(2)), F.when(ip, "ip").when(long, last(2)).otherwise(last(1))


def _rho(level: DataFrame, whole: float, params: Params) -> float:
    """Correlation of outcomes within a level's groups (columns n, bad, m: its
    parent's mean); ``whole``: the mean of all outcomes."""
    spread = F.col("m") * (1 - F.col("m"))
    rate = F.col("bad") / F.col("n")
    over, room = level.agg(F.sum(F.col("n") * (rate - F.col("m")) * (rate - F.col("m")) - spread), F.sum(spread * (F.col("n") - 1))).first()
    weight = params.guess[1] * whole * (1 - whole)
    return min(max(((over or 0.0) + params.guess[0] * weight) / ((room or 0.0) + weight), params.rho[0]), params.rho[1])


def _posterior(level: DataFrame, rho: float) -> DataFrame:
    """``level`` (n, bad, m, and ``sure``: the outcomes behind m) with a and b
    of the posterior beta distribution: rates within the group and the mean
    itself vary, so the prior weighs less the less sure the mean is."""
    apart = 1 - (1 - F.lit(rho)) * (1 - 1 / (F.col("sure") + 1))
    k = 1 / apart - 1
    return level.withColumn("a", F.col("bad") + k * F.col("m")).withColumn("b", F.col("n") - F.col("bad") + k * (1 - F.col("m")))


def _mean() -> tuple[Column, Column]:
    """Mean of a posterior, and the outcomes behind it."""
    whole = F.col("a") + F.col("b")
    return (F.col("a") / whole).alias("m"), whole.alias("sure")


#: Outcomes beyond these do not narrow a posterior further; so STEPS of its continued fraction are enough.
MOST, STEPS = 10_000.0, 250


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of x > 0: Stirling's series at x + 10."""
    z, low = x + 10, F.lit(1.0)
    for i in range(10):
        low = low * (x + i)
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return series - F.log(low)


def beta_below(a: Column, b: Column, x: float) -> Column:
    """P(rate <= x) of a beta distribution: its continued fraction, evaluated
    forwards on the side where it converges."""
    swap = F.lit(x) >= (a + 1) / (a + b + 2)
    # The columns are bound once to a struct, not repeated in each step.
    own = F.struct(F.when(swap, b).otherwise(a).alias("p"), F.when(swap, a).otherwise(b).alias("q"), F.when(swap, 1 - x).otherwise(x).alias("x"))

    def value(o: Column) -> Column:
        p, q, at = o["p"], o["q"], o["x"]

        def turn(s: Column, m: Column) -> Column:
            even = m * (q - m) * at / ((p + 2 * m - 1) * (p + 2 * m))
            odd = -(p + m) * (p + q + m) * at / ((p + 2 * m) * (p + 2 * m + 1))
            d1, c1 = 1 / (1 + even * s["d"]), 1 + even / s["c"]
            half = F.struct((s["h"] * d1 * c1).alias("h"), d1.alias("d"), c1.alias("c"))
            return F.transform(F.array(half), lambda t: F.struct((1 + odd / t["c"]).alias("c"), (1 / (1 + odd * t["d"])).alias("d"),
                                                                 (t["h"] * (1 + odd / t["c"]) / (1 + odd * t["d"])).alias("h")))[0]

        first = 1 / (1 - (p + q) * at / (p + 1))
        start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
        cf = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, lambda s, m: turn(s, m.cast("double")), lambda s: s["h"])
        front = F.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * F.log(at) + q * F.log(1 - at)) / p
        return front * cf

    low = F.transform(F.array(own), value)[0]
    return F.when(swap, 1 - low).otherwise(low)


def host_reputation(outcomes: DataFrame, params: Params = Params(), long_suffixes=LONG_SUFFIXES) -> DataFrame:
    """(host, n, bad, mean, below) of each host with a labelled page;
    ``below``: the posterior probability that its bad rate is under the limit.

    ``outcomes``: host and bad (0 or 1). Each level is a grouped table; no
    group of pages or hosts is ever gathered in one place."""
    domain, suffix = domain_columns(F.col("host"), long_suffixes)
    hosts = saved(outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    domains = saved(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("kids")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("kids"))
    total = domains.agg(F.sum("n"), F.sum("bad")).first()
    n, bad = total[0] or 0, total[1] or 0
    whole = (bad + 1) / (n + 2)
    top = suffixes.withColumn("m", F.lit(whole)).withColumn("sure", F.lit(float(n + 2)))
    top = _posterior(top, _rho(top, whole, params)).select("suffix", "kids", *_mean())
    middle = skew_join(domains.withColumnRenamed("kids", "hosts"), top, "suffix", "kids", domains.count())
    middle = saved(_posterior(middle, _rho(middle, whole, params)).select("domain", "hosts", *_mean()), "middle")
    low = saved(skew_join(hosts, middle, "domain", "hosts", hosts.count()), "low")
    ruled = _posterior(low, _rho(low, whole, params)).withColumn("scale", F.least(F.lit(1.0), F.lit(MOST) / (F.col("a") + F.col("b"))))
    below = beta_below(F.col("a") * F.col("scale"), F.col("b") * F.col("scale"), params.limit)
    return ruled.select("host", "n", "bad", _mean()[0].alias("mean"), below.alias("below"))


def judged(pages: DataFrame, labels: DataFrame, rules=RULES, params: Params = Params(), long_suffixes=LONG_SUFFIXES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict.

    The outcome of a page is the ``labels`` row with its id: bad if quality
    is 0 or toxic is 1, none if both are null or the page_id is null. A page
    without rule takes its host's verdict: block if the host has a bad page and
    its posterior bound reaches the limit, else allow; hosts without outcomes
    are allowed, as are null urls and urls without ://, whose host and path are
    empty. Repeated rows stay; other columns are not read. An empty table of
    labels blocks no host, an empty table of pages gives no rows.
    ``long_suffixes``: suffixes of two labels, such as a table of public ones."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    own = pages.select("page_id", host.alias("host"), path.alias("path"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    marked = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")).where("bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    known = own.where("host <> ''").select("page_id", "host").join(marked, "page_id").select("host", "bad")
    blocked = host_reputation(known, params, long_suffixes).where((F.col("bad") > 0) & (F.col("below") <= F.lit(params.alpha))).select("host")
    counted = saved(own.groupBy("host").agg(F.count("*").alias("pages")).join(blocked, "host").withColumn("blocked", F.lit(True)), "blocked")
    name, said = rule_columns(F.col("host"), F.col("path"), rules)
    out = skew_join(own, counted, "host", "pages", own.count(), "left")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(said, F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict"))
