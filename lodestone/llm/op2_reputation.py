"""URL filter by empirical-Bayes host reputation, in DataFrame functions only.

A page is good when its label says quality 1 and toxic 0. Good pages of a host are
binomial; the host's rate has a beta prior around its registered domain's mean, that
one around its suffix's, that one around the mean of all labelled pages:

    mean of a group = (good + M * mean of its parent) / (labelled + M)

M, the strength of a level's prior, comes from the beta-binomial moments of that level's
groups, within 1 and 1000. A page without a rule is blocked when the upper bound of its
host's posterior (mean + Z standard deviations) is under `MIN_GOOD`, else allowed.
A rule, the longest that fits host and path, goes before that.

The suffix is the last label of the host without port, or the last two if the last has
two letters and the one before is a usual second level (`co.uk`); the registered domain
has one label more. Only page_id and url are read of the pages. Groups are counted before
any shuffle; a host with a third of all pages is split by the adaptive skew join.

Null urls, and those without `://`, have an empty host and path and are judged as the
host ''. Several labels of a page all count; null labels do not. Repeated pages keep
their rows. Without labels every mean is 1/2 and nothing is blocked but by rule. Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
SECOND = ("ac", "co", "com", "edu", "gov", "net", "org")
Z = 1.645
MIN_GOOD = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_host(pages: DataFrame) -> DataFrame:
    """page_id, host, path, domain and suffix of each page."""
    url = F.coalesce("url", F.lit(""))
    labels = F.split(F.regexp_replace("host", r":[0-9]*$", ""), r"\.")
    deep = (F.length(F.element_at("labels", -1)) == 2) & (F.size("labels") > 2) & F.get("labels", F.size("labels") - 2).isin(*SECOND)
    tail = lambda n: F.array_join(F.slice("labels", F.greatest(F.size("labels") - n + 1, F.lit(1)), n), ".")
    return (
        pages.select("page_id", F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER).alias("host"), F.regexp_extract(url, _URL, 2).alias("path"))
        .withColumn("labels", labels)
        .withColumn("deep", F.when(deep, 2).otherwise(1))
        .select("page_id", "host", "path", tail(F.col("deep") + 1).alias("domain"), tail(F.col("deep")).alias("suffix"))
    )


def rule(rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits a page's host and path, and its verdict; else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def strength(groups: DataFrame) -> Column:
    """M of a level from its groups' sizes n and good pages k, by beta-binomial moments."""
    n, k, g = F.sum("n"), F.sum("k"), F.count(F.lit(1))
    p = k / n
    spread = F.sum(F.col("k") * F.col("k") / F.col("n")) - n * p * p
    rest = n - F.sum(F.col("n") * F.col("n")) / n - (g - 1)
    rho = F.try_divide(F.try_divide(spread, p * (1 - p)) - (g - 1), rest)
    m = F.round(F.try_divide(1 - rho, rho), 3)
    return F.coalesce(F.when(rho <= 0, 1000.0).otherwise(F.greatest(F.least(m, F.lit(1000.0)), F.lit(1.0))), F.lit(1.0))


def reputations(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, n labelled pages, k good ones, and the posterior's mean and upper bound, for
    every host among the pages (of `with_host`)."""
    outcome = labels.where(F.col("quality").isNotNull() & F.col("toxic").isNotNull()).select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("long").alias("good"))
    hosts = (
        pages.join(outcome, "page_id", "left")
        .groupBy("host", "domain", "suffix")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    m = [level.where("n > 0").agg(strength(level).alias(name)) for level, name in ((hosts, "m_host"), (domains, "m_domain"), (suffixes, "m_suffix"))]
    top = suffixes.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("mean_all"))
    one = m[0].crossJoin(m[1]).crossJoin(m[2]).crossJoin(top).first()  # four numbers
    m_host, m_domain, m_suffix, mean_all = map(F.lit, one)
    s = suffixes.select("suffix", ((F.col("k") + m_suffix * mean_all) / (F.col("n") + m_suffix)).alias("mean_suffix"))
    d = domains.join(s, "suffix").select("domain", "suffix", ((F.col("k") + m_domain * F.col("mean_suffix")) / (F.col("n") + m_domain)).alias("mean_domain"))
    a, b = F.col("k") + m_host * F.col("mean_domain"), F.col("n") - F.col("k") + m_host * (1 - F.col("mean_domain"))
    mean = a / (a + b)
    upper = mean + F.lit(Z) * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.join(d, ["domain", "suffix"]).select("host", "n", "k", F.round(mean, 6).alias("reputation"), F.round(upper, 6).alias("upper_bound"))


def judged(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, reputation and upper_bound of every page."""
    known = with_host(pages)
    name, verdict = rule(rules)
    method = F.when(F.col("upper_bound") < MIN_GOOD, "block").otherwise("allow")
    out = known.join(reputations(known, labels), "host", "left")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "reputation", "upper_bound")


def op2_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), l AS (SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS labels FROM u
), e AS (SELECT *, CASE WHEN length(labels[-1]) = 2 AND len(labels) > 2 AND labels[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 2 ELSE 1 END AS deep FROM l
), p AS (
  SELECT page_id, host, path, array_to_string(labels[greatest(len(labels) - deep, 1):], '.') AS domain, array_to_string(labels[greatest(len(labels) - deep + 1, 1):], '.') AS suffix FROM e
), o AS (
  SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END AS good FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL
), h AS (
  SELECT host, domain, suffix, count(good) AS n, CAST(coalesce(sum(good), 0) AS BIGINT) AS k FROM p LEFT JOIN o ON p.page_id = o.doc_id GROUP BY ALL
), d AS (SELECT domain, suffix, CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS k FROM h GROUP BY ALL
), s AS (SELECT suffix, CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS k FROM d GROUP BY ALL
), levels AS (SELECT 'h' AS level, n, k FROM h WHERE n > 0 UNION ALL SELECT 'd', n, k FROM d WHERE n > 0 UNION ALL SELECT 's', n, k FROM s WHERE n > 0
), moments AS (
  SELECT level, CAST(sum(n) AS DOUBLE) AS n, sum(k) / sum(n) AS p, sum(k * k / n) AS kk, CAST(sum(n * n) AS DOUBLE) AS nn, count(*) AS g FROM levels GROUP BY level
), rho AS (
  SELECT level, ((kk - n * p * p) / nullif(p * (1 - p), 0) - (g - 1)) / nullif(n - nn / n - (g - 1), 0) AS r FROM moments
), m AS (
  SELECT max(CASE WHEN level = 'h' THEN v END) AS m_host, max(CASE WHEN level = 'd' THEN v END) AS m_domain, max(CASE WHEN level = 's' THEN v END) AS m_suffix
  FROM (SELECT level, coalesce(CASE WHEN r <= 0 THEN 1000.0::DOUBLE WHEN r IS NULL THEN NULL ELSE greatest(least(round((1 - r) / r, 3), 1000.0::DOUBLE), 1.0::DOUBLE) END, 1.0::DOUBLE) AS v FROM rho)
), g AS (
  SELECT coalesce(m_host, 1.0::DOUBLE) AS m_host, coalesce(m_domain, 1.0::DOUBLE) AS m_domain, coalesce(m_suffix, 1.0::DOUBLE) AS m_suffix, (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM s) AS mean_all FROM m
), ms AS (SELECT suffix, (k + m_suffix * mean_all) / (n + m_suffix) AS mean_suffix FROM s, g
), md AS (SELECT domain, suffix, (k + m_domain * mean_suffix) / (n + m_domain) AS mean_domain FROM d JOIN ms USING (suffix), g
), ab AS (
  SELECT host, k + m_host * mean_domain AS a, n - k + m_host * (1 - mean_domain) AS b FROM h JOIN md USING (domain, suffix), g
), rep AS (
  SELECT host, round(a / (a + b), 6) AS reputation, round(a / (a + b) + 1.645::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 6) AS upper_bound FROM ab
), rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), urls AS (SELECT DISTINCT host, path FROM p
), fit AS (
  SELECT urls.host, urls.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM urls JOIN rules r ON (urls.host = r.host OR ends_with(urls.host, '.' || r.host)) AND starts_with(urls.path, r.path) GROUP BY ALL
)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, CASE WHEN upper_bound < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, reputation, upper_bound
FROM p LEFT JOIN rep ON p.host = rep.host LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path
"""
