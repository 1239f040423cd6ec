"""URL filters: stated rules first, then an empirical-Bayes reputation of the host.

Labelled pages give every host a number of outcomes and of bad ones.  Rates are shrunk through beta-binomial priors from the suffix to
the registered domain to the host: each level's prior mean is the posterior mean of the level above (for suffixes the
overall rate), its strength the method-of-moments estimate over the level's groups.  A host is blocked if the lower
posterior bound of its bad rate, mean - z * sd of the beta posterior, is above ``max_bad``; a host without labels
has its prior, so it is judged by its domain's pages.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or
the end; both empty for a null url or one without ``://``.  A registered domain is the last two labels of the host
(three if the last two are in ``two_label_suffixes``), its suffix what follows its first label.

Defined results: pages with the same url get the same verdict, a page labelled twice counts once with its worst label,
null labels don't count, without any label every host is allowed, an empty table gives an empty table, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage

#: The stated rules (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BAD, Z = 0.2, 1.645


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does.  The list is part of the plan, so it is a stated, short one."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [(host == h) | host.endswith(f".{h}") for _, h, _ in longest]
    fits = [f & path.startswith(p) for f, (_, _, p) in zip(fits, longest)]
    pick = lambda value: F.coalesce(*(F.when(f, F.lit(value(r))) for f, r in zip(fits, longest)), F.lit(None).cast("string"))
    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


def domain_of(host: Column, two_label_suffixes: list[str]) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(two_label_suffixes), F.substring_index(host, ".", -3)).otherwise(last_two) if two_label_suffixes else last_two


def suffix_of(domain: Column) -> Column:
    return F.when(F.instr(domain, ".") > 0, F.expr("substring(domain, instr(domain, '.') + 1)")).otherwise(domain)


def _strength(groups: DataFrame) -> float:
    """Method-of-moments strength of the prior of (n, bad, prior): one number, aggregated over the groups with outcomes."""
    s = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2) / (F.col("prior") * (1 - F.col("prior"))))
    got = groups.where("n > 0 AND prior > 0 AND prior < 1").agg(s.alias("s"), F.count("*").alias("g"), F.sum(F.col("n") - 1).alias("m")).first()
    rho = (got["s"] - got["g"]) / got["m"] if got["m"] else 1e-4
    rho = min(max(rho, 1e-4), 0.9)
    return 1 / rho - 1


def reputation(outcomes: DataFrame, *, two_label_suffixes: list[str] | None = None) -> DataFrame:
    """(host, n, bad_rate, strength) for each host of ``outcomes`` (host, bad 0/1 or null): mean and size of its beta posterior."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), two_label_suffixes or []))
    hosts = cut_lineage(hosts.withColumn("suffix", suffix_of(F.col("domain"))), "hosts")
    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    overall = bad / n if n else 0.0
    total = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]

    def posterior(groups: DataFrame, key: str) -> tuple[DataFrame, float]:
        k = _strength(groups)
        mean = (F.col("bad") + F.lit(k) * F.col("prior")) / (F.col("n") + F.lit(k))
        return groups.withColumn("mean", mean), k

    suffixes, _ = posterior(hosts.groupBy("suffix").agg(*total).withColumn("prior", F.lit(overall)), "suffix")
    domains = hosts.groupBy("domain", "suffix").agg(*total).join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")
    domains, _ = posterior(cut_lineage(domains, "domains"), "domain")
    hosts = hosts.join(domains.select("domain", F.col("mean").alias("prior")), "domain")
    hosts, k = posterior(cut_lineage(hosts, "host-priors"), "host")
    return cut_lineage(hosts.select("host", "n", F.col("mean").alias("bad_rate"), (F.col("n") + F.lit(k)).alias("strength")), "reputation")


def judge(pages: DataFrame, labels: DataFrame, *, rules: list[tuple[str, str, str]] = RULES, max_bad: float = MAX_BAD, z: float = Z,
          two_label_suffixes: list[str] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled of each row of ``pages``; ``labels`` is (page_id, bad 0/1)."""
    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    worst = labels.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy(F.col("page_id").cast("long").alias("id")).agg(F.max("bad").alias("bad"))
    outcomes = cut.select("page_id", "host").join(worst, F.col("page_id") == F.col("id"), "left").select("host", "bad")
    known = reputation(outcomes, two_label_suffixes=two_label_suffixes)
    low = F.col("bad_rate") - z * F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.col("strength") + 1))
    known = known.select(F.col("host").alias("h"), F.col("n").alias("n_labelled"), F.when(low > max_bad, "block").otherwise("allow").alias("method"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return cut.join(known, F.col("host") == F.col("h")).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "method").alias("verdict"), "n_labelled")


def digest(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes: the quality label of the id of the page; poor quality is bad."""
    return judge(pages, labels.select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad")))


def _level(name: str, key: str, rows: str) -> str:
    return f"""
{name}_k AS (SELECT 1 / least(greatest(CASE WHEN sum(n - 1) > 0 THEN (sum(n * (bad / n - prior) * (bad / n - prior) / (prior * (1 - prior))) - count(*)) / sum(n - 1) ELSE 1e-4 END, 1e-4), 0.9) - 1 AS k
  FROM ({rows}) WHERE n > 0 AND prior > 0 AND prior < 1),
{name} AS (SELECT g.*, (bad + k * prior) / (n + k) AS mean, n + k AS strength FROM ({rows}) g, {name}_k)"""


ORACLE = rf"""
WITH p AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)) AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
w AS (SELECT doc_id, max(1 - quality) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
h0 AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad, array_to_string(string_split(host, '.')[-2:], '.') AS domain FROM p LEFT JOIN w ON p.page_id = w.doc_id GROUP BY host),
h AS (SELECT *, CASE WHEN contains(domain, '.') THEN substr(domain, strpos(domain, '.') + 1) ELSE domain END AS suffix FROM h0),
{_level('s', 'suffix', "SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) FROM h) AS prior FROM h GROUP BY suffix")},
{_level('d', 'domain', "SELECT h.domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value(s.mean) AS prior FROM h JOIN s ON h.suffix = s.suffix GROUP BY h.domain")},
{_level('r', 'host', "SELECT h.host, h.n, h.bad, d.mean AS prior FROM h JOIN d ON h.domain = d.domain")},
j AS (SELECT p.*, r.n::BIGINT AS n_labelled, CASE WHEN mean - {Z} * sqrt(mean * (1 - mean) / (strength + 1)) > {MAX_BAD} THEN 'block' ELSE 'allow' END AS method,
  CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p JOIN r USING (host))
SELECT page_id, host, path, rule, CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' WHEN 'example.com/de/' THEN 'block' WHEN 'net/' THEN 'block' ELSE method END AS verdict,
  n_labelled FROM j
"""
