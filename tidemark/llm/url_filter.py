"""Operator 6, URL filters: empirical-Bayes reputation of hosts, from labelled page outcomes.

Outcomes are counted per host. The chance of a good page is shrunk level by level: the corpus to the suffix, that to the
registered domain, that to the host. At each level the parent's mean is the centre of a beta prior; its strength is the
method of moments' estimate over that level's groups. A host is blocked if even the upper posterior bound of its chance
of good pages stays below the cutoff. Little evidence leaves a host near its parents' chance, with their bound: a host
without outcomes is blocked where its domain's other hosts speak against it strongly enough, and so is the empty host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, keys_hint, stage

#: Suffixes of two labels under which names are registered; other suffixes are the last label.
TWO_LABEL_SUFFIXES = tuple(
    "ac.jp ac.kr ac.nz ac.uk ac.za co.id co.il co.in co.jp co.ke co.kr co.nz co.th co.uk co.za com.ar com.au com.bd com.br com.cn com.co com.eg com.hk com.mx com.my com.ng com.pe com.ph com.pk com.pl "
    "com.sg com.tr com.tw com.ua com.vn edu.au edu.cn go.jp gov.au gov.br gov.cn gov.in gov.uk ne.jp net.au net.br net.cn or.jp or.kr org.au org.br org.cn org.in org.uk org.za".split())
#: Bounds of a prior's strength, the normal quantile of the bound, and the cutoff.
STRENGTH, Z, CUTOFF = (2.0, 1000.0), 1.645, 0.5


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """A host without its port and a dot at the end."""
    return F.regexp_replace(host, r"\.?(:[0-9]*)?$", "")


def is_address(name: Column) -> Column:
    return name.rlike(r"^([0-9.]+|\[.*\])$")


def suffix_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The public suffix of a host's name: one of two labels, or else the last label; `ip` for an address of numbers."""
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    return F.when(is_address(name), F.lit("ip")).when(two.isin(*suffixes), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The registered domain: one label before the suffix; an address of numbers is its own."""
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    return F.when(is_address(name), name).when(two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits; null where none does. rules: (action, host/path)."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # a longer one overrides
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def shrink(counts: DataFrame, level: str, parent: DataFrame, up: str) -> DataFrame:
    """Posterior (level, a, b) of each group of counts (level, up, n, k), under the posterior means of parent (up, mean).

    Strength by moments: with p the groups' shares about their parents' means m, the variance between groups is what
    sum n (p - m)^2 / sum n holds beyond the binomial part; strength = m (1 - m) / variance - 1, within STRENGTH.
    """
    means = keys_hint(stage(parent.select(up, F.col("mean").alias("m")), "means"))  # broadcast if small: a parent of most groups is no hot key
    with_mean = counts.join(means, up)
    seen = with_mean.filter("n > 0")
    noise = F.sum(F.col("m") * (1 - F.col("m")))  # the expected sum of n (p - m)^2 without spread between groups
    moments = seen.agg(F.sum("n").alias("n"), F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), 2) / F.col("n")).alias("ss"), noise.alias("noise"), (F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))) / F.sum("n")).alias("v"))
    between = F.col("ss") / F.col("n") - F.col("noise") / F.col("n")
    strength = moments.select(F.coalesce(F.when(between > 0, F.least(F.greatest(F.col("v") / between - 1, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))), F.lit(STRENGTH[1])).alias("s"))
    out = with_mean.crossJoin(F.broadcast(strength))  # one row
    a, b = F.col("m") * F.col("s") + F.col("k"), (1 - F.col("m")) * F.col("s") + F.col("n") - F.col("k")
    return out.select(*[c for c in counts.columns if c not in ("n", "k")], a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(host, mean, upper) for every host of pages (id, host), from outcomes (id, good 0/1).

    Hosts without outcomes take their domain's mean. An id with several outcomes is good only if all are. Pages with the
    same id each count. Without any outcome the mean is that of a uniform prior, 0.5.
    """
    one = outcomes.groupBy("id").agg(F.min("good").alias("good"))
    joined = pages.join(one, "id", "left")
    hosts = joined.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host"), suffixes), "suffix": suffix_of(F.col("host"), suffixes), "root": F.lit(1)})
    hosts = stage(hosts, "hosts")  # every level reads it
    domains = hosts.groupBy("domain", "suffix", "root").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    tops = domains.groupBy("suffix", "root").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    top = tops.groupBy("root").agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("mean"))
    s = shrink(tops, "suffix", top, "root")
    d = shrink(domains, "domain", s, "suffix")
    h = shrink(hosts, "host", d, "domain")
    upper = F.col("mean") + Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("a") + F.col("b") + 1))
    return h.select("host", "mean", upper.alias("upper"))


def url_filter(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", label_id_col: str = "doc_id", suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """Judge every url: by the longest rule that fits its host (or a parent) and path, else by its host's reputation.

    A page's outcome is good if its label has quality 1 and toxic 0. Returns one row per row of pages: id_col, host,
    path, rule (null if none), verdict (allow or block), good_bound double (the host's upper bound). rules is a short
    configuration list (at most 1,000), and so is suffixes: those of two labels, such as co.uk.

    Null urls, or urls without ://, have an empty host and path: no rule fits, and the empty host is judged like others.
    Null labels are no outcome; null ids have none. Repeated rows come back as often. Other columns are ignored. An
    empty pages table gives an empty table; empty labels leave every host at 0.5 and allowed.
    """
    if len(rules) > 1000:
        raise ValueError("more than 1,000 rules")
    seen = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    outcomes = labels.select(F.col(label_id_col).alias("id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good")).filter("id is not null and good is not null")
    reputation = host_reputation(seen.select("id", "host"), outcomes, suffixes)
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("upper") < CUTOFF, F.lit("block")).otherwise(F.lit("allow"))
    known = keys_hint(stage(reputation.select("host", "upper"), "reputation"))  # broadcast if small, so that a giant host is no hot key
    out = seen.join(known, "host", "left")
    return out.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(action, own).alias("verdict"), F.col("upper").alias("good_bound"))
