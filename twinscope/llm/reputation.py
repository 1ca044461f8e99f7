"""URL filters: rules by host and path, then an empirical-Bayes reputation of the host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinscope.llm.components import written

#: Common suffixes of two labels under which names are registered, used where no
#: table of suffixes is given.
TWO_LABEL_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "co.za", "com.br", "com.cn", "com.mx", "co.in", "co.kr"]
#: Prior counts are kept in this range, so that a level without spread or with few groups is no certainty.
LEAST_PRIOR, MOST_PRIOR = 1.0, 1000.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path; both empty without ``://`` or url."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """The public suffix, and the registered domain: the suffix with one more label."""
    labels = F.split(host, r"\.")
    two = F.concat_ws(".", F.slice(labels, -2, 2))
    n = F.when(F.size(labels) >= 3, F.when(two.isin(TWO_LABEL_SUFFIXES), 2).otherwise(1)).otherwise(1)
    tail = lambda k: F.when(F.size(labels) > k, F.array_join(F.slice(labels, -k, k), ".")).otherwise(host)
    return F.when(n == 2, tail(2)).otherwise(tail(1)), F.when(n == 2, tail(3)).otherwise(tail(2))


def by_suffix_table(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``hosts`` with ``suffix`` and ``domain`` by a table with a column ``suffix``, such as a
    public suffix list: the longest one that a host ends in, else its last label. Null suffixes
    and repeats count for nothing; a host that is a suffix itself is its own domain."""
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(labels, -k, k), ".").alias("suffix")))
    known = suffixes.where("suffix is not null").select(F.lower("suffix").alias("suffix")).distinct()
    found = hosts.select("host", F.explode(tails).alias("t")).select("host", "t.*").join(known, "suffix").groupBy("host").agg(F.max("k").alias("_k"))
    n = F.coalesce("_k", F.lit(1))
    tail = lambda k: F.when(F.size(labels) > k, F.array_join(F.slice(labels, -k, k), ".")).otherwise(F.col("host"))
    return hosts.join(found, "host", "left").withColumns({"suffix": tail(n), "domain": tail(n + 1)}).drop("_k")


def _prior_counts(groups: DataFrame) -> DataFrame:
    """Strength of a beta prior from the spread of the groups' rates, by moments: one row."""
    totals = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"),
        F.count(F.lit(1)).cast("double").alias("k"),
        F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).cast("double").alias("n2"),
        F.coalesce(F.sum(F.col("bad") * F.col("bad") / F.col("n")), F.lit(0.0)).alias("b2"),
    )
    mean = (F.col("bad") + 0.5) / (F.col("n") + 1)
    # sum of n (rate - mean)^2 over the groups
    spread = F.col("b2") - 2 * mean * F.col("bad") + mean * mean * F.col("n")
    unit = mean * (1 - mean)
    freedom = F.col("n") - F.try_divide(F.col("n2"), F.col("n")) - (F.col("k") - 1)
    rho = F.try_divide(spread - (F.col("k") - 1) * unit, freedom * unit)
    strength = F.coalesce(F.when(rho > 0, 1 / rho - 1), F.lit(MOST_PRIOR))
    return totals.select(mean.alias("mean"), F.least(F.greatest(strength, F.lit(LEAST_PRIOR)), F.lit(MOST_PRIOR)).alias("prior"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, ident: str, z: float = 1.28, suffixes: DataFrame | None = None) -> DataFrame:
    """Per host: labelled pages ``n``, bad ones ``bad``, posterior ``rate`` and its lower ``bound``.

    A host's rate is shrunk to its registered domain's, that to its suffix's, that to the overall
    rate; each prior's strength comes from the spread at that level. The bound is ``z`` standard
    deviations of the host's beta posterior under its mean. Hosts without labelled pages have
    their domain's rate. ``outcomes`` has ``ident`` and ``bad`` (0 or 1; null: not labelled).
    """
    # One outcome per page id, so that repeated labels don't multiply pages.
    judged = outcomes.where(F.col("bad").isNotNull()).groupBy(ident).agg(F.max("bad").alias("_bad"))
    hosts = (
        pages.join(judged, ident, "left")
        .groupBy("host")
        .agg(F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).cast("long").alias("bad"))
    )
    suffix, domain = suffix_and_domain(F.col("host"))
    named = hosts.withColumns({"suffix": suffix, "domain": domain}) if suffixes is None else by_suffix_table(hosts, suffixes)
    # Every level reads the hosts.
    hosts = written(named, "hosts")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrunk(groups: DataFrame, parent_rate: Column) -> DataFrame:
        prior = _prior_counts(groups.where(F.col("n") > 0))
        # One row: the prior of this level.
        return groups.crossJoin(F.broadcast(prior.select(F.col("mean").alias("_mean"), F.col("prior").alias("_prior")))).withColumn(
            "rate", (F.col("bad") + F.col("_prior") * parent_rate) / (F.col("n") + F.col("_prior"))
        )

    top = shrunk(suffixes, F.col("_mean")).select("suffix", F.col("rate").alias("_suffix_rate"))
    middle = shrunk(domains.join(top, "suffix"), F.col("_suffix_rate")).select("domain", F.col("rate").alias("_domain_rate"))
    low = shrunk(hosts.join(middle, "domain"), F.col("_domain_rate"))
    total = F.col("n") + F.col("_prior")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1))
    return low.select("host", "n", "bad", "rate", (F.col("rate") - z * deviation).alias("bound"))


def _fits(rule: str) -> Column:
    name, path = rule[: rule.index("/")], rule[rule.index("/") :]
    return ((F.col("host") == name) | F.col("host").endswith(f".{name}")) & F.col("path").startswith(path)


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], ident: str = "page_id", url: str = "url", most_bad: float = 0.25, z: float = 1.28, suffixes: DataFrame | None = None
) -> DataFrame:
    """Rows of ``pages`` with ``host``, ``path``, ``rule``, ``bad_bound`` and ``verdict``.

    ``rules`` are (verdict, host and path): a rule fits its host and all subdomains where the path
    starts with the rule's; the longest wins (of equal ones the first). Pages that no rule fits
    are blocked if the lower posterior bound of their host's rate of bad pages is over
    ``most_bad``. ``suffixes`` is a table of public suffixes (see ``by_suffix_table``); without it
    a short list of common ones stands in. The rule list is a stated set of a few hundred at most, as it becomes part of
    the plan. A null url has empty host and path, and is judged as the host without a name;
    repeated pages are judged each; columns named like the added ones are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "bad_bound")
    host, path = host_and_path(F.col(url))
    named = pages.withColumns({"host": host, "path": path})
    reputation = host_reputation(named.select(ident, "host"), outcomes.select(ident, "bad"), ident, z, suffixes)
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    rule = F.coalesce(*[F.when(_fits(r), F.lit(r)) for _, r in ordered], F.lit(None).cast("string"))
    by_rule = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for v, r in ordered], F.lit(None).cast("string"))
    joined = named.withColumn("rule", rule).join(reputation.select("host", F.col("bound").alias("bad_bound")), "host")
    by_host = F.when(F.col("bad_bound") > most_bad, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(*pages.columns, "host", "path", "rule", "bad_bound", F.coalesce(by_rule, by_host).alias("verdict"))
