"""URL filters: explicit rules, then host reputation by empirical Bayes.

Labelled page outcomes are counted per host, registered domain and suffix. Each level's rate is
shrunk towards that of the level above by a beta prior whose strength comes from how much the
rates below really differ, and a host is blocked where the lower bound of its posterior bad
rate passes a limit above the overall rate. Where no outcomes are given they are the explicit
rules' own: a page that a rule blocks is bad, one that a rule allows is good, and all others of
the host are judged by those.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import fresh, stored

# Fixed values: (verdict, host, path) of the registered query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Suffixes of two labels, below which names are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "com.mx", "gov.uk", "org.au", "org.uk")
# The bound lies Z standard deviations below the mean. A host is blocked where even the bound means
# odds of a bad page LIFT times those overall. Prior strengths are kept between the two limits.
Z, LIFT, MIN_STRENGTH, MAX_STRENGTH = 1.645, 2.0, 1.0, 1000.0


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, nulls if none; of equals the first.

    A rule fits its host and the subdomains, where the path starts with its own. The rules are
    one expression, so this is for lists of some hundreds.
    """
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where they are a known suffix."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and one label before it."""
    three = F.substring_index(host, ".", -3)
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), three).otherwise(two)


def _strength(level: DataFrame) -> Column:
    """Prior strength by moments, over rows of n, bad and the prior rate of the level above.

    A rate over n outcomes differs from its prior p by p(1-p)/n (1 + (n-1) rho) on average
    square, where rho = 1 / (strength + 1). Without evidence the strength is the greatest.
    """
    spread = F.col("prior") * (1 - F.col("prior"))
    off = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2)
    rho = F.sum(off - spread) / F.sum((F.col("n") - 1) * spread)
    low, high = 1 / (MAX_STRENGTH + 1), 1 / (MIN_STRENGTH + 1)
    held = F.least(F.greatest(F.coalesce(rho, F.lit(low)), F.lit(low)), F.lit(high))
    return level.filter("n > 0").agg((1 / held - 1).alias("m")).scalar()


def reputation(outcomes: DataFrame) -> DataFrame:
    """(host, n, bad, mean, bound, limit) of every host in ``outcomes`` (host, bad).

    ``bad`` is 1 for a bad page, 0 for a good one and null where the page has no label; hosts
    without labels get their domain's rate. ``mean`` is the posterior mean of the bad rate,
    ``bound`` its lower bound, ``limit`` the rate at LIFT times the overall odds, which is the
    same in all rows. No outcomes give no rows; a null host is one of its own.
    """
    hosts = stored(
        outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    ).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    overall = hosts.agg((F.sum("bad") + 1) / (F.sum("n") + 2)).scalar()

    def shrunk(level: DataFrame) -> DataFrame:
        strength = _strength(level)
        rate = (F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)
        return level.withColumn("rate", rate).withColumn("strength", strength)

    suffixes = stored(shrunk(hosts.groupBy("suffix").agg(*sums).withColumn("prior", overall)))
    above = suffixes.select("suffix", F.col("rate").alias("prior"))
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    domains = stored(shrunk(domains.join(above, domains.suffix.eqNullSafe(above.suffix)).drop(above.suffix)))
    above = domains.select("domain", F.col("rate").alias("prior"))
    own = shrunk(hosts.join(above, hosts.domain.eqNullSafe(above.domain)).drop(above.domain))
    total = F.col("n") + F.col("strength")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1))
    limit = LIFT * overall / (1 - overall + LIFT * overall)
    return own.select("host", "n", "bad", F.col("rate").alias("mean"), (F.col("rate") - Z * deviation).alias("bound"), limit.alias("limit"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    url: str = "url",
    id_col: str = "page_id",
    outcome_id: str = "doc_id",
    bad: str = "bad",
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, bad_rate and bad_bound.

    The longest fitting rule gives the verdict; else a page is blocked if its host's ``bad_bound``
    passes the limit that ``reputation`` sets. ``outcomes`` labels pages by id: ``bad`` 1 or 0, a page
    with several rows being bad if one says so; without it the rules' verdicts are the outcomes, and
    repeated rows count each time. A null url, or one without ://, has an empty host and path. Input
    columns of the result's names are replaced.
    """
    added = ["host", "path", "rule", "verdict", "bad_rate", "bad_bound"]
    kept = [c for c in pages.columns if c.lower() not in added]
    whole, page = fresh(pages, "__url"), fresh(pages, "__id")
    held = pages.select(*[pages[f"`{c}`"] for c in kept], pages[f"`{url}`"].alias(whole), pages[f"`{id_col}`"].alias(page))
    held = held.withColumns({"host": F.coalesce(host_of(F.col(whole)), F.lit("")), "path": F.coalesce(path_of(F.col(whole)), F.lit(""))})
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    if outcomes is None:
        seen = held.select("host", F.when(verdict == "block", 1).when(verdict == "allow", 0).alias("bad"))
    else:
        told = outcomes.filter(f"`{bad}` is not null").groupBy(F.col(f"`{outcome_id}`").alias("__of")).agg(F.max(f"`{bad}`").cast("int").alias("bad"))
        ids = held.select("host", page)
        seen = ids.join(told, ids[page] == told["__of"], "left").select("host", "bad")
    known = stored(reputation(seen)).select(
        F.col("host").alias("__host"), F.col("mean").alias("bad_rate"), F.col("bound").alias("bad_bound"), (F.col("bound") > F.col("limit")).alias("__bad")
    )
    by_host = F.when(F.col("__bad"), "block").otherwise("allow")
    return held.join(known, F.col("host") == F.col("__host"), "left").select(
        *[f"`{c}`" for c in kept], "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"), "bad_rate", "bad_bound"
    )


_STRENGTH = f"1 / least(greatest(coalesce(sum(n * (bad / n - prior) ** 2 - prior * (1 - prior)) / nullif(sum((n - 1) * prior * (1 - prior)), 0), {1 / (MAX_STRENGTH + 1)!r}), {1 / (MAX_STRENGTH + 1)!r}), {1 / (MIN_STRENGTH + 1)!r}) - 1"
_TWO = "array_to_string(list_slice(string_split(host, '.'), -2, -1), '.')"
_IS_TWO = f"{_TWO} IN ({', '.join(repr(s) for s in TWO_LABEL_SUFFIXES)})"
_LONGEST = sorted(RULES, key=lambda r: -len(r[1] + r[2]))


def _case(values: list[str]) -> str:
    tests = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v}'" for (_, h, p), v in zip(_LONGEST, values)]
    return f"CASE {' '.join(tests)} END"


ORACLE_SQL = rf"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
ruled AS (
  SELECT *, {_case([h + p for _, h, p in _LONGEST])} AS rule, {_case([k for k, _, _ in _LONGEST])} AS told FROM p),
seen AS (SELECT host, CASE told WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS bad FROM ruled),
hosts AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
         CASE WHEN {_IS_TWO} THEN array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') ELSE {_TWO} END AS dom,
         CASE WHEN {_IS_TWO} THEN {_TWO} ELSE string_split(host, '.')[-1] END AS suf
  FROM seen GROUP BY host),
overall AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS o FROM hosts),
s0 AS (SELECT suf, sum(n) AS n, sum(bad) AS bad, (SELECT o FROM overall) AS prior FROM hosts GROUP BY 1),
s AS (SELECT suf, (bad + m * prior) / (n + m) AS rate FROM s0, (SELECT {_STRENGTH} AS m FROM s0 WHERE n > 0)),
d0 AS (SELECT dom, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS prior FROM hosts JOIN s USING (suf) GROUP BY 1),
d AS (SELECT dom, (bad + m * prior) / (n + m) AS rate FROM d0, (SELECT {_STRENGTH} AS m FROM d0 WHERE n > 0)),
h0 AS (SELECT host, n, bad, rate AS prior FROM hosts JOIN d USING (dom)),
h AS (SELECT host, n + m AS total, (bad + m * prior) / (n + m) AS rate FROM h0, (SELECT {_STRENGTH} AS m FROM h0 WHERE n > 0))
SELECT page_id, ruled.host, path, rule,
       coalesce(told, CASE WHEN rate - {Z} * sqrt(rate * (1 - rate) / (total + 1)) > {LIFT} * o / (1 - o + {LIFT} * o) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN h ON h.host = ruled.host, overall
"""
