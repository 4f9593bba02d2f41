"""URL verdicts from rules and from empirical-Bayes host reputation, in DataFrame functions alone.

Rules come first: the longest that fits host (or a parent domain of it) and path decides. Other urls get the method's verdict:
labelled page outcomes (bad or not) are counted by host, registered domain and suffix; each level's rate is shrunk by a
beta-binomial prior centred on its parent's shrunk rate, whose strength is estimated from the spread of rates at that level
(method of moments). A host is blocked if even the lower posterior bound of its bad rate is above a threshold, so little
evidence never blocks. Hosts without labels inherit their domain's posterior.

Counting is partial before the shuffle, so a host with a third of all pages costs one row per task; the counts by host and the
posteriors by domain are stored once, so the pages are read twice, and the join back is an ordinary join that Spark may split.

Defined results: a null url or one without `://` has empty host and path, fits no rule and gets the corpus-wide verdict.
Labels: several rows for an id count as bad if any is; null label columns are ignored; both null is unlabelled. Repeated
pages give repeated rows. A url of any length is judged whole. Only the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

Rule = tuple[str, str, str]
#: Suffixes of two labels under which names are registered; a parameter, to be replaced by a whole public suffix list.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "com.br", "co.in", "co.za", "co.kr", "com.cn", "com.tr", "com.mx")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    found = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring_index(F.substring_index(F.regexp_replace(url, "(?s)^.*?://", ""), "?", 1), "#", 1)
    host = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.char_length(host) + 1, F.char_length(rest))
    return F.when(found, F.translate(host, _UPPER, _LOWER)).otherwise(""), F.when(found, path).otherwise("")


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits, else nulls. Rules are a short configured list."""
    rule = verdict = F.lit(None).cast("string")
    for what, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        rule, verdict = F.when(fits, domain + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _shrunk(level: DataFrame, key: str, parent: str | None) -> DataFrame:
    """Adds to rows (key, parent, n, bad, prior) the level's prior strength and the posterior's alpha and beta."""
    p = F.sum("bad") / F.sum("n")
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2)) / F.sum("n")
    noise = F.sum(F.col("prior") * (1 - F.col("prior"))) / F.sum("n")
    across = F.greatest(spread - noise, F.lit(1e-6))
    strength = F.least(F.lit(1000.0), F.greatest(F.lit(2.0), p * (1 - p) / across - 1))
    known = level.where("n > 0").agg(F.coalesce(strength, F.lit(2.0)).alias("strength"))
    return level.join(F.broadcast(known)).withColumns({"alpha": F.col("bad") + F.col("strength") * F.col("prior"), "beta": F.col("n") - F.col("bad") + F.col("strength") * (1 - F.col("prior"))})


def registered(host: Column, suffixes: Sequence[str]) -> tuple[Column, Column]:
    """(suffix, registered domain) of a host without its user and port. `suffixes` are those of two labels; all others have one.

    The registered domain is the suffix and the label before it; an address made of numbers is both.
    """
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two, address = F.substring_index(name, ".", -2), name.rlike(r"^[0-9.]+$|^\[")
    long = two.isin(*suffixes) if suffixes else F.lit(False)
    suffix = F.when(address, name).when(long, two).otherwise(F.substring_index(name, ".", -1))
    return suffix, F.when(address, name).when(long, F.substring_index(name, ".", -3)).otherwise(two)


def host_reputation(pages: DataFrame, labels: DataFrame, z: float = 1.645, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(host, n_labelled, bad_rate, bad_bound) of every host of pages (page_id, host), from labels (page_id, bad)."""
    known = pages.join(labels, "page_id", "left")
    counts = known.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    suffix, domain = registered(F.col("host"), suffixes)
    hosts = stored(counts.withColumns({"suffix": suffix, "domain": domain}), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = tops.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("prior"))

    def rate(level: DataFrame, key: str) -> DataFrame:
        return level.select(F.col(key), (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("prior"))

    tops = _shrunk(tops.join(F.broadcast(overall)), "suffix", None)
    domains = stored(_shrunk(domains.join(rate(tops, "suffix"), "suffix"), "domain", "suffix"), "domains")
    hosts = _shrunk(hosts.join(rate(domains, "domain"), "domain"), "host", "domain")
    a, b = F.col("alpha"), F.col("beta")
    mean = a / (a + b)
    return hosts.select("host", F.col("n").alias("n_labelled"), mean.alias("bad_rate"), (mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("bad_bound"))


def url_verdicts(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], *, page_id: str = "page_id", url: str = "url", label_id: str = "doc_id", threshold: float = 0.5, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate, bad_bound of every page; labels hold (label_id, quality, toxic)."""
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    bad = F.when(F.coalesce(F.col("quality"), F.col("toxic")).isNotNull(), (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int"))
    outcomes = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("page_id")).agg(F.max(bad).alias("bad"))
    reputation = host_reputation(rows.select("page_id", "host"), outcomes, suffixes=suffixes)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_bound") > threshold, "block").otherwise("allow")
    out = rows.join(reputation, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "bad_rate", "bad_bound")
    return out.withColumns({c: F.round(c, 6) for c in ("bad_rate", "bad_bound")})
